"""Validators of stored artifacts: they recompute what was stored, or hold it against what it must agree with.

Each gives a row for every violation, check_name and key, and none for a sound artifact. Checks of rows are filters; checks against
other tables are joins by id; nothing is gathered.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrank.functions import scalars as S
from quillrank.operators import assess
from quillrank.operators.ranking import expected_rank_breaks


def found(rows: DataFrame, key: str, **checks: Column) -> DataFrame:
    """A row for each check that a row of rows fails; a null condition is no failure."""
    names = F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in checks.items()])
    out = rows.select(F.explode(F.array_compact(names)).alias("check_name"), F.col(key).cast("string").alias("key"))
    return out


def united(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def counted(violations: DataFrame) -> DataFrame:
    return violations.groupBy("check_name").agg(F.count("*").alias("violations"))


def repeated(rows: DataFrame, key: str, name: str = "duplicate_id") -> DataFrame:
    """Keys of more than one row."""
    return rows.groupBy(F.col(key).cast("string").alias("key")).agg(F.count("*").alias("n")).where("n > 1").select(F.lit(name).alias("check_name"), "key")


def recomputed(assessments: DataFrame, evals: DataFrame) -> DataFrame:
    """Assessments whose score or correctness isn't what the evidence gives; one without a candidate's evidence is unknown."""
    stored = assessments.select("candidate_id", F.col("score").alias("_score"), F.col("correctness").alias("_correctness"))
    both = stored.join(evals.withColumn("_there", F.lit(True)), "candidate_id", "left").withColumn("_v", assess.correctness())
    there = F.col("_there").isNotNull()
    return found(
        both, "candidate_id", unknown_candidate=~there, score_recompute=there & (F.abs(F.col("_score") - S.ratio("tests_passed", "tests_total")) > S.EPSILON),
        correctness_recompute=there & ~F.col("_v.correctness").eqNullSafe(F.col("_correctness")),
    )


def one_to_one(left: DataFrame, right: DataFrame, key: str, names: tuple[str, str]) -> DataFrame:
    """Keys that only one side has."""
    a, b = left.select(key).distinct().withColumn("_a", F.lit(True)), right.select(key).distinct().withColumn("_b", F.lit(True))
    return found(a.join(b, key, "full_outer"), key, **{names[0]: F.col("_b").isNull(), names[1]: F.col("_a").isNull()})


def tie_groups(ranks: DataFrame) -> DataFrame:
    """Tie groups of more than one rank or score, or whose size isn't the stored one."""
    g = ranks.where("tie_group is not null").groupBy("tie_group").agg(F.count_distinct("rank").alias("r"), F.count_distinct(F.round("score", 9)).alias("s"), F.count("*").alias("n"), F.min("tie_group_size").alias("low"), F.max("tie_group_size").alias("high"))
    return found(g, "tie_group", tie_rank=F.col("r") != 1, tie_score=F.col("s") != 1, tie_size=(F.col("n") != F.col("low")) | (F.col("n") != F.col("high")))


def tied_winners(ranks: DataFrame, comparisons: DataFrame) -> DataFrame:
    """Comparisons (candidate_a, candidate_b, relation) that prefer one of two candidates of a tie group."""
    group = ranks.where("tie_group is not null").select("candidate_id", "tie_group")
    for x in "ab":
        comparisons = comparisons.join(group.select(F.col("candidate_id").alias(f"candidate_{x}"), F.col("tie_group").alias(f"_{x}")), f"candidate_{x}")
    return found(comparisons, "candidate_a", artificial_preference=(F.col("_a") == F.col("_b")) & (F.col("relation") != "TIE"))


def ranking_run(assessments: DataFrame, ranks: DataFrame, evals: DataFrame, comparisons: DataFrame | None = None) -> DataFrame:
    known = F.col("correctness") != "indeterminate"
    total = F.col("tests_passed") + F.col("tests_failed") + F.col("tests_error") + F.col("tests_skipped")
    parts = [
        found(assessments, "candidate_id", counts=total != F.col("tests_total")),
        found(ranks, "candidate_id", rank_null=known != F.col("rank").isNotNull(), tied=F.col("tied") != F.coalesce(F.col("tie_group_size") > 1, F.lit(False))),
        repeated(assessments, "candidate_id"), recomputed(assessments, evals), one_to_one(assessments, ranks, "candidate_id", ("only_assessed", "only_ranked")), tie_groups(ranks),
        expected_rank_breaks(ranks).select(F.lit("expected_rank").alias("check_name"), F.col("tie_group").alias("key")),
    ]
    return united(*parts, *([tied_winners(ranks, comparisons)] if comparisons is not None else []))


def against_ranks(pairs: DataFrame, ranks: DataFrame) -> DataFrame:
    """Pairs with a side that has no rank, or whose chosen one isn't ranked above."""
    for role in ("chosen", "rejected"):
        pairs = pairs.join(ranks.select(F.col("candidate_id").alias(f"{role}_id"), F.col("rank").alias(f"_{role}")), f"{role}_id", "left")
    a, b = F.col("_chosen"), F.col("_rejected")
    return found(pairs, "preference_id", unknown_candidate=a.isNull() | b.isNull(), direction=a >= b)


def provenance(pairs: DataFrame, candidates: DataFrame) -> DataFrame:
    """Sides of pairs without a candidate, or whose digest isn't the candidate's."""
    c = candidates.select("candidate_id", F.col("code_sha256").alias("_sha"))
    out = [pairs.join(c, F.col(f"{role}_id") == F.col("candidate_id"), "left").select("preference_id", F.lit(role).alias("role"), "_sha", F.col(f"{role}_sha256").alias("sha")) for role in ("chosen", "rejected")]
    return found(united(*out), "preference_id", no_candidate=F.col("_sha").isNull(), code_digest=F.col("_sha") != F.col("sha"))


def reversed_pairs(pairs: DataFrame) -> DataFrame:
    """Two candidates of which each is preferred to the other."""
    a, b = F.least("chosen_id", "rejected_id"), F.greatest("chosen_id", "rejected_id")
    n = pairs.groupBy("problem_id", a.alias("a"), b.alias("b")).agg(F.count_distinct(F.col("chosen_id") < F.col("rejected_id")).alias("n")).where("n > 1")
    return n.select(F.lit("reversed").alias("check_name"), F.concat_ws("/", "a", "b").alias("key"))


def preference_run(pairs: DataFrame, ranks: DataFrame, candidates: DataFrame) -> DataFrame:
    own = lambda c: F.col(c).startswith(F.concat("problem_id", F.lit("_c")))
    return united(
        found(pairs, "preference_id", not_better=F.col("chosen_score") <= F.col("rejected_score"), same_code=F.col("chosen_sha256") == F.col("rejected_sha256"), foreign_id=~(own("chosen_id") & own("rejected_id")),
              wrong_id=F.col("preference_id") != S.preference_id("chosen_id", "rejected_id")),
        repeated(pairs, "preference_id"), against_ranks(pairs, ranks), provenance(pairs, candidates), reversed_pairs(pairs),
    )


def statistics(stored: DataFrame, again: DataFrame, key: str, value: str) -> DataFrame:
    """Keys whose stored value isn't the recomputed one, either way."""
    a, b = stored.select(key, F.col(value).alias("_a")), again.select(key, F.col(value).alias("_b"))
    return found(a.join(b, key, "full_outer"), key, statistics=~F.col("_a").eqNullSafe(F.col("_b")))


def duplicate_links(candidates: DataFrame) -> DataFrame:
    """candidates (candidate_id, code_sha256, duplicate_of) that name one that isn't there, or has other code."""
    first = candidates.select(F.col("candidate_id").alias("duplicate_of"), F.col("code_sha256").alias("_sha")).distinct()
    linked = candidates.where("duplicate_of is not null").join(first, "duplicate_of", "left")
    return found(linked, "candidate_id", duplicate_unknown=F.col("_sha").isNull(), duplicate_differs=F.col("_sha") != F.col("code_sha256"))


def generation_run(candidates: DataFrame, prompts: DataFrame, missing: DataFrame) -> DataFrame:
    """candidates: candidate_id, problem_id, code_sha256, duplicate_of, run_id, the manifest's run and prompt_sha256, by which each
    row is held against the prompts kept (prompt_sha256); a null one names none. missing: problem_id of units that are neither there
    nor failed."""
    return united(
        found(candidates, "candidate_id", malformed_id=~F.col("candidate_id").rlike(r"^p\d+_c\d{3,}$"), run_mismatch=~F.col("run_id").eqNullSafe(F.col("manifest_run_id"))),
        repeated(candidates, "candidate_id"), duplicate_links(candidates),
        candidates.where("prompt_sha256 is not null").join(prompts.select("prompt_sha256"), "prompt_sha256", "left_anti").select(F.lit("no_prompt").alias("check_name"), F.col("candidate_id").alias("key")),
        missing.select(F.lit("missing_generation").alias("check_name"), F.col("problem_id").alias("key")),
    )


DIFFICULTIES, LEAST_TESTS = ("easy", "medium", "hard"), 5


def dataset(problems: DataFrame, tests: DataFrame, expected: int | None = None) -> DataFrame:
    """problems: problem_id, prompt, difficulty. tests: problem_id, test_id and passed, by the reference solution."""
    per = problems.select("problem_id").distinct().join(tests.groupBy("problem_id").agg(F.count("*").alias("n"), F.count_distinct("test_id").alias("ids"), F.count_if(~F.col("passed")).alias("failed")), "problem_id", "left")
    n = F.coalesce("n", F.lit(0))
    parts = [
        found(problems, "problem_id", blank_prompt=S.stripped("prompt") == "", unknown_difficulty=~F.col("difficulty").isin(*DIFFICULTIES)), repeated(problems, "problem_id"),
        found(per, "problem_id", few_tests=n < LEAST_TESTS, duplicate_test_id=F.col("ids") < n, reference_fails=F.col("failed") > 0),
    ]
    if expected is not None:
        parts.append(found(problems.agg(F.count("*").alias("n")), "n", dataset_size=F.col("n") != expected))
    return united(*parts)


def model_evaluation(evals: DataFrame, identity: Mapping[str, str] | None = None) -> DataFrame:
    """evals of two variants. A sample needs its counterpart with the same seed; identity: columns that must have one value."""
    total = F.col("tests_passed") + F.col("tests_failed") + F.col("tests_error")
    side = lambda v: evals.where(F.col("model_variant") == v).select("problem_id", "sample_index", F.col("seed").alias(v))
    both = side("base").join(side("dpo"), ["problem_id", "sample_index"], "full_outer").withColumn("k", F.concat_ws("#", "problem_id", "sample_index"))
    parts = [found(evals, "candidate_id", counts=total != F.col("tests_total")), found(both, "k", unpaired=F.col("base").isNull() | F.col("dpo").isNull(), seeds_differ=F.col("base") != F.col("dpo"))]
    parts += [found(evals, "candidate_id", **{f"foreign_{c}": ~F.col(c).eqNullSafe(F.lit(v))}) for c, v in (identity or {}).items()]
    return united(*parts)


def one_value(rows: DataFrame, by: str, value: Column, name: str) -> DataFrame:
    """Groups with more than one value."""
    return found(rows.groupBy(by).agg(F.count_distinct(value).alias("n")), by, **{name: F.col("n") > 1})
