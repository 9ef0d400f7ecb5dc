"""Evidence to assessments: correctness, scores and statuses of candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrank.functions import scalars as S

COUNTS = ("tests_total", "tests_passed", "tests_failed", "tests_error", "tests_skipped")


MISSING = "missing_evaluation_result"


def correctness(missing: Column | None = None) -> Column:
    """struct(correctness, reason). Missing evidence comes first, for the reason missing, a failure's own, where there is one; then
    infrastructure, then problems without tests."""
    verdict = lambda c, r=None: F.struct(F.lit(c).alias("correctness"), F.lit(r).cast("string").alias("reason"))
    right = (F.col("tests_passed") == F.col("tests_total")) & (F.col("tests_failed") + F.col("tests_error") + F.col("tests_skipped") == 0) & ~F.col("timeout")
    return (
        F.when(~F.col("has_result"), F.struct(F.lit("indeterminate").alias("correctness"), F.coalesce(*([] if missing is None else [missing]), F.lit(MISSING)).alias("reason")))
        .when(F.col("infrastructure_error"), verdict("indeterminate", "infrastructure_error"))
        .when(F.col("tests_total") == 0, verdict("indeterminate", "no_tests_executed"))
        .when(right, verdict("correct"))
        .otherwise(verdict("incorrect"))
    )


def assess(evals: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """evals with correctness, indeterminate_reason, pass_rate, score, all_tests_passed, code_sha256, code_lines and code_chars.
    failures: candidate_id and error_type, the reason of a candidate that has no result."""
    missing = None
    if failures is not None:
        evals = evals.join(failures.groupBy("candidate_id").agg(F.max("error_type").alias("_failure")), "candidate_id", "left")
        missing = F.col("_failure")
    rate = S.ratio("tests_passed", "tests_total")
    some = F.when(F.col("code") != "", F.col("code"))
    return evals.withColumn("_v", correctness(missing)).drop("_failure").select(
        "*", F.col("_v.correctness").alias("correctness"), F.col("_v.reason").alias("indeterminate_reason"), rate.alias("pass_rate"), rate.alias("score"),
        (F.col("_v.correctness") == "correct").alias("all_tests_passed"), S.sha256("code").alias("code_sha256"), S.line_count(some).alias("code_lines"), F.length(some).cast("long").alias("code_chars"),
    ).drop("_v")


def evaluation_status() -> Column:
    """A candidate's outcome from its reconciled tests."""
    return (
        F.when(F.col("infrastructure_error"), "infrastructure_error")
        .when(F.col("timeout"), "timeout")
        .when((F.col("tests_total") > 0) & (F.col("tests_passed") == F.col("tests_total")), "passed")
        .otherwise("failed")
    )


def sandbox_status(started: Column, exit_code: Column, stderr: Column, timed_out: Column, out_of_memory: Column, flooded: Column) -> Column:
    """What a finished run means: infrastructure first, then resources, then time, then the program's own exit."""
    return (
        F.when(~started | F.coalesce(exit_code.isin(125, 126, 127), F.lit(False)), "infrastructure_error")
        .when(out_of_memory | flooded, "resource_exceeded")
        .when(timed_out, "timeout")
        .when(exit_code.isNull(), "infrastructure_error")
        .when(exit_code == 0, "success")
        .when(S.compile_error(stderr), "syntax_error")
        .otherwise("runtime_error")
    )


def exit_signal(exit_code: Column) -> Column:
    return F.when((exit_code > 128) & (exit_code < 160), exit_code - 128)


def model_error_type(test_errors: Column) -> Column:
    """Why a model's sample failed; null if it passed."""
    return (
        F.when(F.col("status") == "passed", F.lit(None).cast("string"))
        .when(F.col("status").isin("infrastructure_error", "timeout", "syntax_error"), F.col("status"))
        .when(F.col("tests_error") > 0, F.when(F.exists(test_errors, lambda e: e.isin("ImportError", "ModuleNotFoundError")), "import_error").otherwise("runtime_error"))
        .otherwise("assertion_failure")
    )


# The exception names that a failure's subcategory may be.
SUBCATEGORIES = ("AssertionError", "AttributeError", "IndexError", "KeyError", "MemoryError", "NameError", "RecursionError", "StopIteration", "SyntaxError", "TypeError", "ValueError", "ZeroDivisionError")


def subcategory(error_type: Column) -> Column:
    return F.when(error_type.isin(*SUBCATEGORIES), error_type).otherwise("other")


def failure_category(generation_status: Column, code: Column, raw: Column, passed: Column, error_type: Column, dominant: Column) -> Column:
    """The taxonomy's category; "none" for what passed."""
    kind = F.coalesce(error_type, F.lit("runtime_error"))
    return (
        F.when(generation_status == "generation_error", "generation_failure")
        .when(code.isNull(), F.when(S.stripped(F.coalesce(raw, F.lit(""))) != "", "code_extraction_failure").otherwise("generation_failure"))
        .when(passed, "none")
        .when((kind == "runtime_error") & (dominant == "MemoryError"), "memory_error")
        .when(kind.isin("syntax_error", "import_error", "runtime_error", "assertion_failure", "timeout", "memory_error", "infrastructure_error", "generation_failure", "code_extraction_failure"), kind)
        .otherwise("runtime_error")
    )


def reconciled(expected: DataFrame, events: DataFrame, keys: list[str], position: str = "position") -> DataFrame:
    """A row for each expected test: its last event's status, or an error where no event came. Events of other tests go."""
    last = events.groupBy(*keys).agg(F.max_by(F.struct("status", "error_type"), position).alias("_e"))
    return expected.join(last, keys, "left").select(*expected.columns, F.coalesce("_e.status", F.lit("error")).alias("status"), F.when(F.col("_e").isNull(), "MissingResult").otherwise(F.col("_e.error_type")).alias("error_type"))
