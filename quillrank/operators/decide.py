"""Decisions on tables of facts: recommendations, promotions, resumption, reproducibility, reuse and retries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrank.functions import scalars as S
from quillrank.operators import analysis

# What each recommendation counts for, as impact, strength of the evidence and cost.
WEIGHED = {
    "expand_benchmark": (0.6, 0.9, 0.5), "investigate_regression": (0.7, 0.8, 0.3), "investigate_mode_collapse": (0.5, 0.6, 0.4), "increase_problem_difficulty": (0.4, 0.6, 0.7),
    "refine_preference_pairs": (0.6, 0.8, 0.5), "adjust_dpo_hyperparameters": (0.5, 0.5, 0.2), "no_action": (0.0, 0.3, 0.0),
}
FEW_PAIRS = 50


def recommendations(outcomes: DataFrame, gaps: DataFrame, difficulties: DataFrame, diversity: DataFrame, pairs: DataFrame, curve: DataFrame, most: int = 10) -> DataFrame:
    """category, evidence (JSON), impact, strength, cost and score, the best first.

    outcomes: outcome, category and dpo_solved of each problem. gaps and difficulties: name, verdict, training_share,
    benchmark_share and coverage_ratio. diversity: one row of base, dpo and warning. pairs: one row of trained_pairs. curve: one row of verdict.
    Names in the evidence are those of categories and difficulties, which are few.
    """
    counts = outcomes.agg(F.count("*").alias("n"), F.count_if(F.col("outcome").endswith("improvement")).alias("improvements"), F.count_if(F.col("outcome").endswith("regression")).alias("regressions"))
    names = lambda c: F.array_sort(F.collect_set(c))
    unsolved = outcomes.where("not dpo_solved").select(F.col("category").alias("name")).where("name is not null").distinct().withColumn("_u", F.lit(True))
    starved = gaps.where("verdict = 'underrepresented'").join(unsolved, "name", "left").agg(names("name").alias("underrepresented"), names(F.when(F.col("_u"), F.col("name"))).alias("unsolved"))
    overlap = F.size("unsolved")

    def one(df: DataFrame, category: str, on: Column, evidence: Sequence[str], values: tuple[Column, Column, Column] | None = None) -> DataFrame:
        impact, strength, cost = values or tuple(map(F.lit, WEIGHED[category]))
        return df.where(on).select(F.lit(category).alias("category"), F.to_json(F.struct(*evidence)).alias("evidence"), impact.cast("double").alias("impact"), strength.cast("double").alias("strength"), cost.cast("double").alias("cost"))

    unmeasured = gaps.where("verdict = 'not_in_benchmark'").agg(names("name").alias("absent"))
    skew = difficulties.agg(
        names(F.when((F.col("verdict") == "overrepresented") & (F.col("name") == "easy"), F.col("name"))).alias("skewed"),
        names(F.when((F.col("verdict") == "underrepresented") & F.col("name").isin("medium", "hard"), F.col("name"))).alias("starved"),
    )
    rows = reduce(DataFrame.unionByName, [
        one(starved, "add_data", F.size("underrepresented") > 0, ["underrepresented", "unsolved"], (S.clamp(0.3 + 0.1 * overlap), F.when(overlap > 0, 0.7).otherwise(0.4), F.lit(0.6))),
        one(unmeasured, "expand_benchmark", F.size("absent") > 0, ["absent"]),
        one(counts, "investigate_regression", F.col("regressions") > F.col("improvements"), ["regressions", "improvements"]),
        one(diversity, "investigate_mode_collapse", F.coalesce("warning", F.lit(False)), ["base", "dpo"]),
        one(skew, "increase_problem_difficulty", (F.size("skewed") > 0) | (F.size("starved") > 0), ["skewed", "starved"]),
        one(pairs, "refine_preference_pairs", (F.col("trained_pairs") > 0) & (F.col("trained_pairs") < FEW_PAIRS), ["trained_pairs"]),
        one(curve, "adjust_dpo_hyperparameters", F.col("verdict").isin("undertrained", "overtrained"), ["verdict"]),
    ])
    none = counts.join(rows.agg(F.count("*").alias("found")))  # a row beside a row
    rows = rows.unionByName(one(none, "no_action", F.col("found") == 0, ["n", "improvements"]))
    return rows.withColumn("score", analysis.score(F.col("impact"), F.col("strength"), F.col("cost"))).orderBy(F.desc("score"), "category").limit(most)


# What a registered model may become.
PROMOTIONS = (("EXPERIMENTAL", "VALIDATED"), ("EXPERIMENTAL", "RETIRED"), ("EXPERIMENTAL", "REJECTED"), ("VALIDATED", "RECOMMENDED"), ("VALIDATED", "RETIRED"), ("VALIDATED", "REJECTED"), ("RECOMMENDED", "RETIRED"))


def promotion(old: Column, new: Column, evaluation: Column, passed: Column) -> Column:
    """Why a model may not go from one status to another, or null. To be recommended it needs an evaluation that met its criteria."""
    legal = reduce(Column.__or__, [(old == a) & (new == b) for a, b in PROMOTIONS])
    return F.when(~F.coalesce(legal, F.lit(False)), "illegal_transition").when((new == "RECOMMENDED") & evaluation.isNull(), "no_evaluation").when((new == "RECOMMENDED") & ~F.coalesce(passed, F.lit(False)), "criteria_failed")


def registered(registry: DataFrame, new: DataFrame) -> DataFrame:
    """registry with the models of new that it doesn't have, as EXPERIMENTAL; one that comes twice is registered once."""
    fresh = new.dropDuplicates(["model_id"]).join(registry.select("model_id"), "model_id", "left_anti").withColumn("status", F.lit("EXPERIMENTAL"))
    return registry.unionByName(fresh.select(*registry.columns))


# Settings that a run that goes on must have in common with the one before.
CRITICAL = ("model.name", "model.revision", "lora.r", "lora.alpha", "lora.target_modules", "quantization.bits", "quantization.quant_type")


def changed_settings(stored: Column, current: Column, paths: Sequence[str] = CRITICAL) -> Column:
    """Of two JSON configurations, the paths whose values differ; an absent one and null are alike."""
    at = lambda c, p: F.get_json_object(c, f"$.{p}")
    return F.array_compact(F.array(*[F.when(~at(stored, p).eqNullSafe(at(current, p)), F.lit(p)) for p in paths]))


def resumption(changed: Column, same_data: Column, force: Column) -> Column:
    """Other data can be forced, other critical settings can't."""
    return F.when(F.size(changed) > 0, "incompatible").when(~same_data & ~force, "dataset_changed").when(~same_data, "forced").otherwise("resume")


def environment_diffs(recorded: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """keys, recorded and current value of each setting that isn't the same in both; one that is missing is null."""
    a, b = recorded.select(*keys, F.col("value").alias("recorded")), current.select(*keys, F.col("value").alias("current"))
    return a.join(b, keys, "full_outer").where(~F.col("recorded").eqNullSafe(F.col("current")))


def reproducible(checks: Mapping[str, Column], diffs: Column) -> Column:
    """True unless a check failed or the environment differs; a null check wasn't made, which is no failure."""
    return reduce(Column.__and__, [F.coalesce(c, F.lit(True)) for c in checks.values()]) & (diffs == 0)


# The failures that are the infrastructure's, and may be tried again, and those of a candidate, which are final.
RETRIED, FINAL = ("model_load", "tokenizer", "inference", "timeout"), ("empty_output", "code_extraction")


def next_attempts(units: DataFrame, attempts: DataFrame, keys: list[str], most: int = 3) -> DataFrame:
    """keys, attempts and action of each unit: settled if one of its attempts has an output or failed for good, exhausted after most
    tries, or else try, so that a run that was interrupted goes on by key. attempts: keys and error_type, null for an output."""
    n = attempts.groupBy(*keys).agg(F.count("*").alias("attempts"), F.bool_or(F.col("error_type").isNull()).alias("_ok"), F.bool_or(F.col("error_type").isin(*FINAL)).alias("_final"))
    out = units.select(*keys).distinct().join(n, keys, "left").na.fill(0, ["attempts"])
    action = F.when(F.col("_ok"), "settled").when(F.col("_final"), "failed").when(F.col("attempts") >= most, "exhausted").otherwise("try")
    return out.select(*keys, "attempts", action.alias("action"))
