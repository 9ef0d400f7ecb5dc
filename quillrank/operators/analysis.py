"""Outcomes of two variants, failures, diversity, coverage and what to do about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillrank.functions import scalars as S

THRESHOLD = 0.2


def outcome(base: Column, dpo: Column) -> Column:
    return (
        F.when(base == dpo, "unchanged")
        .when(dpo > base, F.when((base == 0.0) & (dpo == 1.0), "complete_improvement").otherwise("partial_improvement"))
        .otherwise(F.when((base == 1.0) & (dpo == 0.0), "complete_regression").otherwise("partial_regression"))
    )


def severity(kind: Column, delta: Column, threshold: float = THRESHOLD) -> Column:
    return F.when(kind.startswith("complete"), "high").when(kind == "unchanged", "none").when(F.abs(delta) >= threshold, "medium").otherwise("low")


def verdict(training: Column, benchmark: Column, under: float = 0.5, over: float = 2.0) -> Column:
    ratio = F.try_divide(training, benchmark)
    return F.when((benchmark == 0) & (training == 0), "absent_from_both").when(benchmark == 0, "not_in_benchmark").when(ratio < under, "underrepresented").when(ratio > over, "overrepresented").otherwise("balanced")


def failure_rates(tests: DataFrame) -> DataFrame:
    """Runs and failures of each test for both variants, side by side, with what they say; a variant without runs fails none."""
    def n(v: str, *status: str) -> Column:
        return F.count_if((F.col("model_variant") == v) & (F.col("status").isin(*status) if status else F.lit(True)))

    out = tests.groupBy("problem_id", "test_case_id").agg(*[x for v in ("base", "dpo") for x in (n(v).alias(f"{v}_runs"), n(v, "failed", "error").alias(f"{v}_failures"))])
    for v in ("base", "dpo"):
        out = out.withColumn(f"{v}_rate", S.ratio(f"{v}_failures", f"{v}_runs"))
    delta = F.col("dpo_rate") - F.col("base_rate")
    return out.withColumns({"hard": (F.col("base_rate") >= 0.5) & (F.col("dpo_rate") >= 0.5), "dpo_specific": delta >= THRESHOLD, "base_specific": -delta >= THRESHOLD})


def diversity(codes: DataFrame) -> DataFrame:
    """Distinct outputs over all of them, for each variant: distinct ones are counted within a problem and summed."""
    per = codes.groupBy("model_variant", "problem_id").agg(F.count_distinct(S.sha256("code")).alias("distinct"), F.count("*").alias("n"))
    return per.groupBy("model_variant").agg(F.sum("distinct").alias("distinct"), F.sum("n").alias("n")).withColumn("diversity", S.ratio("distinct", "n"))


def mode(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """The most frequent value of a group, the first by name of equal ones, with its count."""
    n = rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"))
    order = Window.partitionBy(*by).orderBy(F.desc("n"), value)
    return n.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")


def shares(training: DataFrame, benchmark: DataFrame, key: str, universe: DataFrame) -> DataFrame:
    """Shares of each key in two populations, over a universe of keys, with verdict and ratio."""
    def share(df: DataFrame, name: str) -> DataFrame:
        n = df.groupBy(key).agg(F.count("*").alias("_n"))
        return n.select(key, (F.col("_n") / F.sum("_n").over(Window.partitionBy(F.lit(0)))).alias(name))

    out = universe.select(key).distinct().join(share(training, "training_share"), key, "left").join(share(benchmark, "benchmark_share"), key, "left").na.fill(0.0, ["training_share", "benchmark_share"])
    t, b = F.col("training_share"), F.col("benchmark_share")
    return out.withColumns({"coverage_ratio": F.try_divide(t, b), "verdict": verdict(t, b)})


def score(impact: Column, strength: Column, cost: Column) -> Column:
    return F.round(0.5 * impact + 0.3 * strength + 0.2 * (1 - cost), 6)


def refinement(pairs: DataFrame, benchmark: DataFrame, least: float = THRESHOLD) -> DataFrame:
    """What to do with each pair; every pair keeps its row. A benchmark's problem comes first."""
    b = benchmark.select("problem_id").distinct().withColumn("_b", F.lit(True))
    action = (
        F.when(F.col("_b"), "remove_benchmark")
        .when(F.col("score_margin") < least, "remove_low_margin")
        .when(F.col("chosen_sha256") == F.col("rejected_sha256"), "remove_identical")
        .when(F.col("rejected_correctness") == "indeterminate", "regenerate")
        .otherwise("retain")
    )
    return pairs.join(b, "problem_id", "left").withColumn("action", action).drop("_b")
