"""Ranks within a problem, with explicit ties, and comparisons of all pairs of a problem."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillrank.functions.scalars import EPSILON


def ranked(assessed: DataFrame) -> DataFrame:
    """assessed with rank, tie_group, tie_group_size and tied: correct ones first, then by tests passed; equal ones share a rank and
    the next takes its place in the count. Indeterminate candidates keep their row with a null rank. One shuffle, by problem."""
    known = F.col("correctness") != "indeterminate"
    order = Window.partitionBy("problem_id", known).orderBy((F.col("correctness") != "correct"), F.desc("tests_passed"))
    group = Window.partitionBy("problem_id", known, "correctness", "tests_passed")
    size = F.when(known, F.count("*").over(group))
    return assessed.withColumns({
        "rank": F.when(known, F.rank().over(order)).cast("long"),
        "tie_group": F.when(known, F.format_string("%s_tg%03d", F.col("problem_id"), F.dense_rank().over(order))),
        "tie_group_size": size.cast("long"),
        "tied": F.coalesce(size > 1, F.lit(False)),
    })


def relation() -> Column:
    """How a stands to b."""
    return (
        F.when((F.col("correctness_a") == "indeterminate") | (F.col("correctness_b") == "indeterminate"), "INDETERMINATE")
        .when(F.abs(F.col("score_a") - F.col("score_b")) <= EPSILON, "TIE")
        .when(F.col("score_a") > F.col("score_b"), "A_BETTER")
        .otherwise("B_BETTER")
    )


def pair_matrix(assessed: DataFrame, *more: str) -> DataFrame:
    """A row for each two candidates of a problem, a before b by id. The problem is an equal key, so the join is by hash or merge and
    a problem's size bounds what meets."""
    columns = ("candidate_id", "correctness", "score", *more)
    a = assessed.select("problem_id", *[F.col(c).alias(f"{c}_a") for c in columns])
    b = assessed.select(F.col("problem_id").alias("_p"), *[F.col(c).alias(f"{c}_b") for c in columns])
    both = a.join(b, (F.col("problem_id") == F.col("_p")) & (F.col("candidate_id_a") < F.col("candidate_id_b"))).drop("_p")
    return both.withColumns({"relation": relation(), "score_margin": F.abs(F.col("score_a") - F.col("score_b"))})


def rank_statistics(rows: DataFrame) -> DataFrame:
    """Counts for each problem and, with a null problem_id, for all."""
    when = lambda c: F.count_if(c).alias
    total = F.col("tests_total") > 0
    known = (F.col("correctness") != "indeterminate") & total
    return rows.rollup("problem_id").agg(
        F.count("*").alias("candidates"), when(F.col("correctness") == "correct")("fully_correct"), when(known & (F.col("tests_passed") > 0) & (F.col("correctness") != "correct"))("partially_correct"),
        when(known & (F.col("tests_passed") == 0))("zero_score"), when(F.col("correctness") == "indeterminate")("indeterminate"), when(F.col("tied"))("tied"),
    )


def expected_rank_breaks(rows: DataFrame) -> DataFrame:
    """Tie groups whose rank isn't one more than the candidates before them."""
    groups = rows.where("rank is not null").groupBy("problem_id", "tie_group").agg(F.min("rank").alias("rank"), F.max("rank").alias("last"), F.count("*").alias("n"))
    before = Window.partitionBy("problem_id").orderBy("tie_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("expected", 1 + F.coalesce(F.sum("n").over(before), F.lit(0)))
    return groups.where("rank <> expected or rank <> last")
