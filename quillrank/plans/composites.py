"""Queries that are put together from several operators, and driver-side records."""

from __future__ import annotations

import json
import tempfile
from pathlib import Path

from pyspark.sql import functions as F

from quillrank.functions import scalars as S
from quillrank.operators import analysis, assess, metrics, pairs, ranking
from quillrank.plans import candidates, models
from quillrank.plans.registry import query
from quillrank.sources import jsonl, scratch
from quillrank.sources.adapters import table, view


@query("s3_repair_tail", "SELECT 5::BIGINT AS removed, 1::BIGINT AS lines")
def _(spark, sf):
    with tempfile.TemporaryDirectory() as d:
        path = Path(d) / "x.jsonl"
        path.write_text('{"a":1}\n{"a":')
        removed = jsonl.repair(str(path))
        return spark.createDataFrame([(removed, len(path.read_text().splitlines()))], "removed long, lines long")


@query("s5_atomic_document", "SELECT count(*) AS regions FROM region")
def _(spark, sf):
    n = table(spark, sf, "region").count()
    with tempfile.TemporaryDirectory() as d:
        jsonl.write_document(f"{d}/m.json", {"regions": n})
        return spark.createDataFrame([(json.loads(Path(f"{d}/m.json").read_text())["regions"],)], "regions long")


@query("s7_replace", "SELECT r_regionkey, r_name FROM region")
def _(spark, sf):
    path, r = scratch.folder(spark, "s7"), table(spark, sf, "region").select("r_regionkey", "r_name")
    jsonl.append(r.limit(2), path)
    jsonl.replace(r, path)
    return jsonl.read(spark, path, r.schema, r.columns)


@query("s10_problem_dataset", "SELECT problem_id, prompt FROM problems")
def _(spark, sf):
    path, p = scratch.folder(spark, "s10"), view(spark, sf, "problems").select("problem_id", "prompt")
    jsonl.replace(p, path)
    back = jsonl.read(spark, path, p.schema, p.columns)
    twice = back.groupBy("problem_id").agg(F.count("*").alias("n")).where("n > 1")
    return back.join(twice, "problem_id", "left_anti")


@query("s14_split_file", "SELECT count(*) AS rows, count(*) FILTER (trim(text) = '') AS blank FROM turns WHERE role = 'assistant'")
def _(spark, sf):
    t = view(spark, sf, "turns").where("role = 'assistant'")
    return t.agg(F.count("*").alias("rows"), F.count_if(S.stripped("text") == "").alias("blank"))


@query("p11_exit_signal", "SELECT o_orderkey, CASE WHEN o_custkey % 200 > 128 AND o_custkey % 200 < 160 THEN o_custkey % 200 - 128 END AS signal FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", assess.exit_signal(F.col("o_custkey") % 200).alias("signal"))


@query("j5_pair_sides", "SELECT preference_id, hc AS chosen_sha256, hr AS rejected_sha256 FROM decided WHERE reason IS NULL")
def _(spark, sf):
    return pairs.accepted(candidates.decided(spark, sf)).select("preference_id", "chosen_sha256", "rejected_sha256")


@query("j6_unknown_problem", "SELECT reason, count(*) AS n FROM (SELECT CASE WHEN m.problem_id NOT IN (SELECT problem_id FROM evals WHERE generation_index = 3) THEN 'integrity_failure' ELSE reason END AS reason FROM decided m) GROUP BY reason")
def _(spark, sf):
    a = candidates.assessed(spark, sf)
    known = view(spark, sf, "evals").where("generation_index = 3").select("problem_id", F.lit(True).alias("lineage_ok"))
    d = pairs.decisions(a, policy=pairs.strict, prompts_ok=known)
    return d.groupBy("reason").agg(F.count("*").alias("n"))


@query("f15_sample_seed", "SELECT DISTINCT problem_id, sample_index, (42 + substr(problem_id, 2)::BIGINT * 1000 + sample_index)::BIGINT AS seed FROM model_evals")
def _(spark, sf):
    ordinal = F.substring("problem_id", 2, 20).cast("long")
    return view(spark, sf, "model_evals").select("problem_id", "sample_index", (42 + ordinal * 1000 + F.col("sample_index")).alias("seed")).distinct()


def leaked(training, benchmark):
    """How many problems of the training rows are the benchmark's."""
    return training.select("problem_id").distinct().join(benchmark.select("problem_id"), "problem_id", "left_semi").agg(F.count("*").alias("leaked"))


@query("f31_markdown", "SELECT '| ' || status || ' | ' || count(*) || ' |' AS line FROM runs GROUP BY status")
def _(spark, sf):
    n = view(spark, sf, "runs").groupBy("status").agg(F.count("*").alias("n"))
    return n.select(F.format_string("| %s | %d |", "status", "n").alias("line"))


@query("d7_training_dataset", "SELECT count(*) AS pairs, count(*) < 500 AS small, count(DISTINCT problem_id) AS problems, round(avg(score_margin), 9) AS mean_margin FROM decided WHERE reason IS NULL")
def _(spark, sf):
    p = pairs.accepted(candidates.decided(spark, sf))
    return p.agg(F.count("*").alias("pairs"), (F.count("*") < 500).alias("small"), F.count_distinct("problem_id").alias("problems"), F.round(F.avg("score_margin"), 9).alias("mean_margin"))


@query("g8_evaluation_work_list", "SELECT problem_id, v AS model_variant, s::BIGINT AS sample_index FROM (SELECT DISTINCT problem_id FROM model_evals), (SELECT unnest(['base', 'dpo']) AS v), (SELECT unnest(range(0, 12)) AS s) EXCEPT SELECT problem_id, model_variant, sample_index FROM model_evals")
def _(spark, sf):
    e = view(spark, sf, "model_evals").select("problem_id", "model_variant", "sample_index")
    grid = e.select("problem_id").distinct().withColumn("model_variant", F.explode(F.array(F.lit("base"), F.lit("dpo")))).withColumn("sample_index", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(11).cast("long"))))
    return grid.join(e, ["problem_id", "model_variant", "sample_index"], "left_anti")


@query("c1_result_record", "SELECT candidate_id, tests_passed + tests_failed + tests_error + tests_skipped AS tests_total, tests_error > 0 AS runtime_error, timeout FROM evals WHERE has_result")
def _(spark, sf):
    e = view(spark, sf, "evals").where("has_result")
    return e.select("candidate_id", (F.col("tests_passed") + F.col("tests_failed") + F.col("tests_error") + F.col("tests_skipped")).alias("tests_total"), (F.col("tests_error") > 0).alias("runtime_error"), "timeout")


@query("c2_record_flags", "SELECT model_variant, count(*) FILTER (status = 'passed' AND tests_total > 0 AND tests_passed = tests_total) AS correct, count(*) FILTER (status = 'infrastructure_error') AS infrastructure FROM model_evals GROUP BY model_variant")
def _(spark, sf):
    return view(spark, sf, "model_evals").groupBy("model_variant").agg(F.count_if(metrics.correct()).alias("correct"), F.count_if(F.col("status") == "infrastructure_error").alias("infrastructure"))


@query("c4_rank_all", "SELECT problem_id, max(rank) AS last_rank, count(DISTINCT tie_group) AS groups FROM ranks GROUP BY problem_id")
def _(spark, sf):
    return candidates.ranked(spark, sf).groupBy("problem_id").agg(F.max("rank").alias("last_rank"), F.count_distinct("tie_group").alias("groups"))


@query("c5_rank_and_compare", "SELECT problem_id, count(*) AS comparisons, count(*) FILTER (relation = 'TIE') AS ties FROM matrix GROUP BY problem_id")
def _(spark, sf):
    return ranking.pair_matrix(candidates.assessed(spark, sf)).groupBy("problem_id").agg(F.count("*").alias("comparisons"), F.count_if(F.col("relation") == "TIE").alias("ties"))


@query("c6_pair_record", "SELECT preference_id, kc AS chosen_correctness, kr AS rejected_correctness, round(greatest(sa, sb), 9) AS chosen_score, round(least(sa, sb), 9) AS rejected_score FROM decided WHERE reason IS NULL")
def _(spark, sf):
    p = pairs.accepted(candidates.decided(spark, sf))
    return p.select("preference_id", "chosen_correctness", "rejected_correctness", F.round("chosen_score", 9).alias("chosen_score"), F.round("rejected_score", 9).alias("rejected_score"))


@query("c7_dedup_keys", "SELECT count(DISTINCT preference_id) AS pair_keys, count(DISTINCT hc || hr) AS code_keys FROM decided WHERE reason IS NULL")
def _(spark, sf):
    return pairs.accepted(candidates.decided(spark, sf)).agg(F.count_distinct("preference_id").alias("pair_keys"), F.count_distinct("chosen_sha256", "rejected_sha256").alias("code_keys"))


@query("c8_finalized_run", "SELECT (SELECT count(*) FROM decided WHERE reason IS NULL) + (SELECT count(*) FROM decided WHERE reason IS NOT NULL) = (SELECT sum(n * (n - 1) / 2) FROM (SELECT count(*) AS n FROM evals GROUP BY problem_id)) AS complete")
def _(spark, sf):
    d = candidates.decided(spark, sf).agg(F.count("*").alias("rows"), F.lit(1).alias("k"))
    n = view(spark, sf, "evals").groupBy("problem_id").agg(F.count("*").alias("n")).agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("want"), F.lit(1).alias("k"))
    return d.join(n, "k").select((F.col("rows") == F.col("want")).alias("complete"))


@query("c9_classified_variant", f"SELECT model_variant, problem_id, {models._CATEGORY} AS category, count(*) AS n FROM model_evals GROUP BY ALL")
def _(spark, sf):
    return models.classified(spark, sf).groupBy("model_variant", "problem_id", "category").agg(F.count("*").alias("n"))


@query("c10_problem_outcomes", "SELECT o.problem_id, kind AS outcome, category, difficulty FROM outcomes o LEFT JOIN problems USING (problem_id)")
def _(spark, sf):
    return models.outcomes(spark, sf).join(view(spark, sf, "problems").select("problem_id", "category", "difficulty"), "problem_id", "left").select("problem_id", "outcome", "category", "difficulty")


@query("c11_diversity_report", "SELECT round(max(d) FILTER (model_variant = 'base'), 9) AS base, round(max(d) FILTER (model_variant = 'dpo'), 9) AS dpo FROM (SELECT model_variant, sum(d)::DOUBLE / sum(n) AS d FROM (SELECT model_variant, problem_id, count(DISTINCT code) AS d, count(*) AS n FROM model_evals GROUP BY ALL) GROUP BY ALL)")
def _(spark, sf):
    return analysis.diversity(view(spark, sf, "model_evals")).groupBy().pivot("model_variant", ["base", "dpo"]).agg(F.round(F.first("diversity"), 9))


@query("c12_trained_problems", "SELECT DISTINCT problem_id FROM decided WHERE reason IS NULL")
def _(spark, sf):
    return pairs.accepted(candidates.decided(spark, sf)).select("problem_id").distinct()


@query("c13_rates_by_category", f"SELECT model_variant, round(coalesce(count(*) FILTER (k = 'timeout')::DOUBLE / nullif(count(*) FILTER (k <> 'infrastructure_error'), 0), 0), 9) AS timeout_rate FROM (SELECT model_variant, {models._CATEGORY} AS k FROM model_evals) GROUP BY model_variant")
def _(spark, sf):
    k = F.col("category")
    return models.classified(spark, sf).groupBy("model_variant").agg(F.round(S.ratio(F.count_if(k == "timeout"), F.count_if(k != "infrastructure_error")), 9).alias("timeout_rate"))


@query("c23_problem_checks", "SELECT problem_id FROM problems WHERE trim(prompt) = '' OR difficulty NOT IN ('easy', 'medium', 'hard')")
def _(spark, sf):
    return view(spark, sf, "problems").where((S.stripped("prompt") == "") | ~F.col("difficulty").isin("easy", "medium", "hard")).select("problem_id")


@query("c24_latest_for_upstream", "SELECT upstream_id, max(created_at) AS created_at FROM runs GROUP BY upstream_id")
def _(spark, sf):
    return view(spark, sf, "runs").groupBy("upstream_id").agg(F.max("created_at").alias("created_at"))


@query("c27_table_facade", "SELECT count(*) AS n FROM runs WHERE status = 'completed'")
def _(spark, sf):
    return view(spark, sf, "runs").where("status = 'completed'").agg(F.count("*").alias("n"))
