"""Preference pairs: which of two candidates is chosen, or why neither is."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillrank.functions import scalars as S
from quillrank.operators.ranking import pair_matrix

Policy = Callable[[Column, Column, Column], Column]
MARGIN = 0.2


def strict(chosen: Column, rejected: Column, margin: Column) -> Column:
    """Null if the pair is admitted, else the reason; here a correct over an incorrect one."""
    return F.when((chosen == "correct") & (rejected == "incorrect"), F.lit(None).cast("string")).otherwise("not_correct_vs_incorrect")


def by_margin(least: float = MARGIN) -> Policy:
    return lambda chosen, rejected, margin: F.when(margin + S.EPSILON >= least, F.lit(None).cast("string")).otherwise("insufficient_margin")


def all_better(chosen: Column, rejected: Column, margin: Column) -> Column:
    return F.lit(None).cast("string")


POLICIES: dict[str, Policy] = {"strict": strict, "margin": by_margin(), "all_better": all_better}


def decisions(assessed: DataFrame, candidates: DataFrame | None = None, policy: Policy = strict, max_pairs: int | None = None, prompts_ok: DataFrame | None = None, more: tuple[str, ...] = ()) -> DataFrame:
    """A row for each two candidates of a problem: with reason null a pair, else a rejection.

    candidates: candidate_id and code_sha256 of those whose record is there, and the columns more; None: assessed has these itself.
    prompts_ok: problem_id and lineage_ok; a problem whose prompts don't agree loses all its pairs. max_pairs: the pairs of a problem
    with the largest margins that stay. Digests ride along with the candidates, of which there are fewer than pairs; of the columns
    more, such as a code, a pair has the chosen one's and the rejected one's.
    """
    if candidates is not None:
        own = candidates.select(F.col("candidate_id").alias("_id"), F.col("code_sha256").alias("_sha"), *[F.col(c).alias(f"_{c}") for c in more])
        assessed = assessed.drop("code_sha256", *more).join(own, F.col("candidate_id") == F.col("_id"), "left").withColumnsRenamed({"_sha": "code_sha256"} | {f"_{c}": c for c in more})
    pairs = pair_matrix(assessed, "code_sha256", *more)
    a_wins = F.col("relation") == "A_BETTER"
    side = lambda name, win: F.when(a_wins if win else ~a_wins, F.col(f"{name}_a")).otherwise(F.col(f"{name}_b"))
    columns = {"id": "candidate_id", "correctness": "correctness", "score": "score", "sha256": "code_sha256"} | {c: c for c in more}
    pairs = pairs.withColumns({f"{role}_{to}": side(c, win) for to, c in columns.items() for role, win in (("chosen", True), ("rejected", False))})
    if prompts_ok is not None:
        pairs = pairs.join(prompts_ok.select("problem_id", "lineage_ok"), "problem_id", "left")
    else:
        pairs = pairs.withColumn("lineage_ok", F.lit(True))
    reason = (
        F.when(~F.coalesce("lineage_ok", F.lit(False)), "integrity_failure")
        .when(F.col("relation") == "INDETERMINATE", "indeterminate")
        .when(F.col("relation") == "TIE", "tie")
        .when(F.col("chosen_sha256").isNull() | F.col("rejected_sha256").isNull(), "integrity_failure")
        .when(F.col("chosen_sha256") == F.col("rejected_sha256"), "identical_code")
        .otherwise(policy(F.col("chosen_correctness"), F.col("rejected_correctness"), F.col("score_margin")))
    )
    pairs = pairs.withColumn("reason", reason)
    if max_pairs is not None:
        order = Window.partitionBy("problem_id", F.col("reason").isNull()).orderBy(F.desc("score_margin"), "chosen_id", "rejected_id")
        pairs = pairs.withColumn("reason", F.when(F.col("reason").isNull() & (F.row_number().over(order) > max_pairs), "max_pairs_per_problem").otherwise(F.col("reason")))
    strong = (F.col("chosen_correctness") == "correct") & (F.col("rejected_correctness") == "incorrect")
    return pairs.withColumns({"preference_id": S.preference_id("chosen_id", "rejected_id"), "strength": F.when(strong, "strong").otherwise("medium")})


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where("reason is null")


def rejected(rows: DataFrame) -> DataFrame:
    return rows.where("reason is not null")


def deduplicated(pairs: DataFrame, keys: tuple[str, ...] = ("prompt", "chosen_code", "rejected_code")) -> DataFrame:
    """pairs with survivor_id, the smallest preference_id of an equal training record, and is_duplicate; none is dropped."""
    least = F.min("preference_id").over(Window.partitionBy(*keys))
    return pairs.withColumns({"survivor_id": least, "is_duplicate": F.col("preference_id") != least})


def pairless_reason(assessed: DataFrame) -> DataFrame:
    """Why a problem has no pair, by its candidates' correctness alone."""
    n = assessed.groupBy("problem_id").agg(F.count("*").alias("n"), F.count_if(F.col("correctness") == "indeterminate").alias("i"), F.count_if(F.col("correctness") == "correct").alias("c"), F.count_distinct(F.when(F.col("correctness") != "indeterminate", F.col("correctness"))).alias("kinds"))
    reason = F.when(F.col("n") < 2, "insufficient_candidates").when(F.col("i") == F.col("n"), "all_candidates_indeterminate").when(F.col("c") == F.col("n"), "all_candidates_correct").when(F.col("kinds") == 1, "all_candidates_tied").otherwise("no_qualifying_preference")
    return n.select("problem_id", reason.alias("pairless_reason"))
