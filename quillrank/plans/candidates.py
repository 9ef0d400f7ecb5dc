"""Queries on candidates: evidence, assessments, ranks, comparisons and preference pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillrank.functions import scalars as S
from quillrank.operators import assess, pairs, ranking
from quillrank.plans.registry import part, query
from quillrank.sources.adapters import view

part("assessed", """
SELECT *, CASE WHEN NOT has_result OR infrastructure_error OR tests_total = 0 THEN 'indeterminate'
    WHEN tests_passed = tests_total AND tests_failed + tests_error + tests_skipped = 0 AND NOT timeout THEN 'correct' ELSE 'incorrect' END AS correctness,
  CASE WHEN NOT has_result THEN 'missing_evaluation_result' WHEN infrastructure_error THEN 'infrastructure_error' WHEN tests_total = 0 THEN 'no_tests_executed' END AS indeterminate_reason,
  CASE WHEN tests_total > 0 THEN tests_passed::DOUBLE / tests_total ELSE 0.0::DOUBLE END AS score, sha256(code) AS code_sha256
FROM evals""")
part("ranks", """
SELECT *, CASE WHEN correctness <> 'indeterminate' THEN rank() OVER (PARTITION BY problem_id, correctness <> 'indeterminate' ORDER BY correctness <> 'correct', tests_passed DESC) END AS rank,
  CASE WHEN correctness <> 'indeterminate' THEN problem_id || '_tg' || lpad((dense_rank() OVER (PARTITION BY problem_id, correctness <> 'indeterminate' ORDER BY correctness <> 'correct', tests_passed DESC))::VARCHAR, 3, '0') END AS tie_group,
  CASE WHEN correctness <> 'indeterminate' THEN count(*) OVER (PARTITION BY problem_id, correctness, tests_passed) END AS tie_group_size
FROM assessed""")
part("matrix", """
SELECT a.problem_id, a.candidate_id AS ca, b.candidate_id AS cb, a.score AS sa, b.score AS sb, a.correctness AS ka, b.correctness AS kb, a.code_sha256 AS ha, b.code_sha256 AS hb, abs(a.score - b.score) AS score_margin,
  CASE WHEN 'indeterminate' IN (a.correctness, b.correctness) THEN 'INDETERMINATE' WHEN abs(a.score - b.score) <= 1e-9 THEN 'TIE' WHEN a.score > b.score THEN 'A_BETTER' ELSE 'B_BETTER' END AS relation
FROM assessed a JOIN assessed b ON a.problem_id = b.problem_id AND a.candidate_id < b.candidate_id""")
part("sides", """
SELECT *, CASE WHEN relation = 'A_BETTER' THEN ca ELSE cb END AS chosen_id, CASE WHEN relation = 'A_BETTER' THEN cb ELSE ca END AS rejected_id,
  CASE WHEN relation = 'A_BETTER' THEN ka ELSE kb END AS kc, CASE WHEN relation = 'A_BETTER' THEN kb ELSE ka END AS kr, CASE WHEN relation = 'A_BETTER' THEN ha ELSE hb END AS hc, CASE WHEN relation = 'A_BETTER' THEN hb ELSE ha END AS hr FROM matrix""")
part("decided", """
SELECT *, CASE WHEN relation = 'INDETERMINATE' THEN 'indeterminate' WHEN relation = 'TIE' THEN 'tie' WHEN ha = hb THEN 'identical_code' WHEN kc = 'correct' AND kr = 'incorrect' THEN NULL ELSE 'not_correct_vs_incorrect' END AS reason,
  CASE WHEN kc = 'correct' AND kr = 'incorrect' THEN 'strong' ELSE 'medium' END AS strength, 'pref_' || chosen_id || '__' || rejected_id AS preference_id FROM sides""")


def assessed(spark: SparkSession, sf: str) -> DataFrame:
    return assess.assess(view(spark, sf, "evals"))


def ranked(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.ranked(assessed(spark, sf))


def decided(spark: SparkSession, sf: str, policy: str = "strict", max_pairs: int | None = None) -> DataFrame:
    return pairs.decisions(assessed(spark, sf), None, pairs.POLICIES[policy], max_pairs)


@query("p5_classify_correctness", "SELECT candidate_id, correctness, indeterminate_reason FROM assessed")
def _(spark, sf):
    return assessed(spark, sf).select("candidate_id", "correctness", "indeterminate_reason")


@query("p7_assessment_projection", "SELECT candidate_id, problem_id, strategy, score, tests_total, tests_passed, correctness = 'correct' AS all_tests_passed, code_sha256, 2::BIGINT AS code_lines, length(code) AS code_chars FROM assessed")
def _(spark, sf):
    return assessed(spark, sf).select("candidate_id", "problem_id", "strategy", "score", "tests_total", "tests_passed", "all_tests_passed", "code_sha256", "code_lines", "code_chars")


@query("p8_pass_rate", "SELECT candidate_id, score AS pass_rate FROM assessed")
def _(spark, sf):
    return view(spark, sf, "evals").select("candidate_id", S.ratio("tests_passed", "tests_total").alias("pass_rate"))


@query("p12_candidate_status", "SELECT candidate_id, CASE WHEN infrastructure_error THEN 'infrastructure_error' WHEN timeout THEN 'timeout' WHEN tests_total > 0 AND tests_passed = tests_total THEN 'passed' ELSE 'failed' END AS status FROM evals WHERE has_result")
def _(spark, sf):
    return view(spark, sf, "evals").where("has_result").select("candidate_id", assess.evaluation_status().alias("status"))


@query("p9_sandbox_status", """
SELECT o_orderkey, CASE WHEN s = 0 OR x IN (125, 126, 127) THEN 'infrastructure_error' WHEN o THEN 'resource_exceeded' WHEN t THEN 'timeout' WHEN x IS NULL THEN 'infrastructure_error' WHEN x = 0 THEN 'success' WHEN c THEN 'syntax_error' ELSE 'runtime_error' END AS status,
  CASE WHEN x > 128 AND x < 160 THEN x - 128 END AS signal
FROM (SELECT o_orderkey, o_orderkey % 17 AS s, CASE WHEN o_orderkey % 5 = 0 THEN 0 WHEN o_orderkey % 7 = 1 THEN NULL ELSE o_custkey % 170 END AS x, o_orderkey % 19 = 3 AS o, o_orderkey % 23 = 4 AS t, o_orderkey % 3 = 1 AS c FROM orders)""")
def _(spark, sf):
    from quillrank.sources.adapters import table

    o = table(spark, sf, "orders").selectExpr("o_orderkey", "o_orderkey % 17 <> 0 AS s", "CASE WHEN o_orderkey % 5 = 0 THEN 0 WHEN o_orderkey % 7 = 1 THEN NULL ELSE o_custkey % 170 END AS x", "o_orderkey % 19 = 3 AS o", "o_orderkey % 23 = 4 AS t", "CASE o_orderkey % 3 WHEN 1 THEN '  File x\nSyntaxError: invalid' WHEN 2 THEN 'Traceback (most recent call last):\nSyntaxError: x' ELSE NULL END AS e")
    return o.select("o_orderkey", assess.sandbox_status(F.col("s"), F.col("x"), F.col("e"), F.col("t"), F.col("o"), F.lit(False)).alias("status"), assess.exit_signal(F.col("x")).alias("signal"))


@query("p10_compile_error", "SELECT o_orderkey, o_orderkey % 3 = 1 AS compile_error FROM orders")
def _(spark, sf):
    from quillrank.sources.adapters import table

    e = table(spark, sf, "orders").selectExpr("o_orderkey", "CASE o_orderkey % 3 WHEN 1 THEN 'TabError: mixed' WHEN 2 THEN 'Traceback (most recent call last):\nSyntaxError: x' ELSE NULL END AS e")
    return e.select("o_orderkey", S.compile_error("e").alias("compile_error"))


for _policy, _case in (("strict", "CASE WHEN kc = 'correct' AND kr = 'incorrect' THEN NULL ELSE 'not_correct_vs_incorrect' END"), ("margin", "CASE WHEN score_margin + 1e-9 >= 0.2 THEN NULL ELSE 'insufficient_margin' END"), ("all_better", "NULL")):

    @query(f"p16_policy_{_policy}", f"SELECT problem_id, ca AS candidate_a, cb AS candidate_b, CASE WHEN relation = 'INDETERMINATE' THEN 'indeterminate' WHEN relation = 'TIE' THEN 'tie' WHEN ha = hb THEN 'identical_code' ELSE {_case} END AS reason FROM sides")
    def _(spark, sf, policy=_policy):
        return decided(spark, sf, policy).select("problem_id", F.col("candidate_id_a").alias("candidate_a"), F.col("candidate_id_b").alias("candidate_b"), "reason")


@query("p17_strength", "SELECT strength, count(*) AS n FROM decided WHERE reason IS NULL GROUP BY strength")
def _(spark, sf):
    return pairs.accepted(decided(spark, sf)).groupBy("strength").agg(F.count("*").alias("n"))


@query("p22_pairless_reason", """
SELECT problem_id, CASE WHEN count(*) < 2 THEN 'insufficient_candidates' WHEN count(*) FILTER (correctness = 'indeterminate') = count(*) THEN 'all_candidates_indeterminate' WHEN count(*) FILTER (correctness = 'correct') = count(*) THEN 'all_candidates_correct'
  WHEN count(DISTINCT CASE WHEN correctness <> 'indeterminate' THEN correctness END) = 1 THEN 'all_candidates_tied' ELSE 'no_qualifying_preference' END AS pairless_reason
FROM assessed GROUP BY problem_id""")
def _(spark, sf):
    return pairs.pairless_reason(assessed(spark, sf))


@query("j3_pair_matrix", "SELECT problem_id, ca AS candidate_a, cb AS candidate_b FROM matrix")
def _(spark, sf):
    return ranking.pair_matrix(assessed(spark, sf)).select("problem_id", F.col("candidate_id_a").alias("candidate_a"), F.col("candidate_id_b").alias("candidate_b"))


@query("j4_compare", "SELECT ca AS candidate_a, cb AS candidate_b, relation, round(score_margin, 9) AS score_margin FROM matrix")
def _(spark, sf):
    return ranking.pair_matrix(assessed(spark, sf)).select(F.col("candidate_id_a").alias("candidate_a"), F.col("candidate_id_b").alias("candidate_b"), "relation", F.round("score_margin", 9).alias("score_margin"))


@query("d3_preference_pairs", "SELECT preference_id, problem_id, chosen_id, rejected_id, round(score_margin, 9) AS score_margin, strength FROM decided WHERE reason IS NULL")
def preference_pairs(spark, sf):
    return pairs.accepted(decided(spark, sf)).select("preference_id", "problem_id", "chosen_id", "rejected_id", F.round("score_margin", 9).alias("score_margin"), "strength")


@query("d4_rejection_reasons", "SELECT reason, count(*) AS n, count(DISTINCT problem_id) AS problems FROM decided WHERE reason IS NOT NULL GROUP BY reason")
def _(spark, sf):
    return pairs.rejected(decided(spark, sf)).groupBy("reason").agg(F.count("*").alias("n"), F.count_distinct("problem_id").alias("problems"))


@query("d5_rejection_rows", "SELECT problem_id, ca AS candidate_a, cb AS candidate_b, reason, relation, round(sa, 9) AS score_a, round(sb, 9) AS score_b FROM decided WHERE reason IS NOT NULL")
def _(spark, sf):
    r = pairs.rejected(decided(spark, sf))
    return r.select("problem_id", F.col("candidate_id_a").alias("candidate_a"), F.col("candidate_id_b").alias("candidate_b"), "reason", "relation", F.round("score_a", 9).alias("score_a"), F.round("score_b", 9).alias("score_b"))


@query("w7_top_pairs", "SELECT problem_id, preference_id, round(score_margin, 9) AS score_margin FROM decided WHERE reason IS NULL QUALIFY row_number() OVER (PARTITION BY problem_id ORDER BY score_margin DESC, chosen_id, rejected_id) <= 2")
def _(spark, sf):
    return pairs.accepted(decided(spark, sf, max_pairs=2)).select("problem_id", "preference_id", F.round("score_margin", 9).alias("score_margin"))


@query("w6_dedup_survivor", """
SELECT preference_id, min(preference_id) OVER (PARTITION BY problem_id, hc, hr) AS survivor_id, preference_id <> min(preference_id) OVER (PARTITION BY problem_id, hc, hr) AS is_duplicate FROM decided WHERE reason IS NULL""")
def _(spark, sf):
    return pairs.deduplicated(pairs.accepted(decided(spark, sf)), ("problem_id", "chosen_sha256", "rejected_sha256")).select("preference_id", "survivor_id", "is_duplicate")


@query("w1_competition_rank", "SELECT candidate_id, rank FROM ranks")
def _(spark, sf):
    return ranked(spark, sf).select("candidate_id", "rank")


@query("w2_tie_group", "SELECT candidate_id, tie_group FROM ranks")
def _(spark, sf):
    return ranked(spark, sf).select("candidate_id", "tie_group")


@query("w3_tie_size", "SELECT candidate_id, tie_group_size, coalesce(tie_group_size > 1, false) AS tied FROM ranks")
def _(spark, sf):
    return ranked(spark, sf).select("candidate_id", "tie_group_size", "tied")


@query("w4_indeterminate_kept", "SELECT rank IS NULL AS unranked, count(*) AS n, count(DISTINCT problem_id) AS problems FROM ranks GROUP BY ALL")
def _(spark, sf):
    return ranked(spark, sf).groupBy(F.col("rank").isNull().alias("unranked")).agg(F.count("*").alias("n"), F.count_distinct("problem_id").alias("problems"))


@query("a3_ranking_statistics", """
SELECT problem_id, count(*) AS candidates, count(*) FILTER (correctness = 'correct') AS fully_correct, count(*) FILTER (correctness = 'incorrect' AND tests_passed > 0) AS partially_correct,
  count(*) FILTER (correctness <> 'indeterminate' AND tests_passed = 0) AS zero_score, count(*) FILTER (correctness = 'indeterminate') AS indeterminate, count(*) FILTER (tie_group_size > 1) AS tied
FROM ranks GROUP BY ROLLUP (problem_id)""")
def _(spark, sf):
    return ranking.rank_statistics(ranked(spark, sf))


@query("a29_ranking_overview", "SELECT problem_id, count(*) AS candidates, count(DISTINCT tie_group) AS tie_groups, max(score) AS best FROM ranks GROUP BY problem_id")
def _(spark, sf):
    return ranked(spark, sf).groupBy("problem_id").agg(F.count("*").alias("candidates"), F.count_distinct("tie_group").alias("tie_groups"), F.max("score").alias("best"))


@query("o1_rank_order", "SELECT problem_id, candidate_id, row_number() OVER (PARTITION BY problem_id ORDER BY rank IS NULL, rank, candidate_id) AS position FROM ranks")
def _(spark, sf):
    w = Window.partitionBy("problem_id").orderBy(F.col("rank").isNull(), "rank", "candidate_id")
    return ranked(spark, sf).select("problem_id", "candidate_id", F.row_number().over(w).cast("long").alias("position"))


@query("a2_evaluation_statistics", """
SELECT count(*) AS candidates, count(*) FILTER (s = 'passed') AS passed, count(*) FILTER (s IN ('failed', 'timeout')) AS failed, count(*) FILTER (s = 'timeout') AS timeouts, count(*) FILTER (s = 'infrastructure_error') AS infrastructure_errors,
  sum(tests_total)::BIGINT AS tests_total, sum(tests_passed)::BIGINT AS tests_passed, sum(tests_failed)::BIGINT AS tests_failed, sum(tests_error)::BIGINT AS tests_error, sum(tests_skipped)::BIGINT AS tests_skipped
FROM (SELECT *, CASE WHEN infrastructure_error THEN 'infrastructure_error' WHEN timeout THEN 'timeout' WHEN tests_total > 0 AND tests_passed = tests_total THEN 'passed' ELSE 'failed' END AS s FROM evals WHERE has_result)""")
def _(spark, sf):
    e = view(spark, sf, "evals").where("has_result").withColumn("s", assess.evaluation_status())
    n = lambda *s: F.count_if(F.col("s").isin(*s))
    return e.agg(F.count("*").alias("candidates"), n("passed").alias("passed"), n("failed", "timeout").alias("failed"), n("timeout").alias("timeouts"), n("infrastructure_error").alias("infrastructure_errors"), *[F.sum(c).alias(c) for c in assess.COUNTS])


@query("a4_preference_statistics", "SELECT problem_id, count(*) AS considered, count(*) FILTER (reason IS NULL) AS generated, count(*) FILTER (reason IS NOT NULL) AS rejected, count(*) FILTER (reason = 'tie') AS ties, count(*) FILTER (reason IS NULL AND strength = 'strong') AS strong FROM decided GROUP BY ROLLUP (problem_id)")
def _(spark, sf):
    return decided(spark, sf).rollup("problem_id").agg(F.count("*").alias("considered"), F.count_if(F.col("reason").isNull()).alias("generated"), F.count_if(F.col("reason").isNotNull()).alias("rejected"), F.count_if(F.col("reason") == "tie").alias("ties"), F.count_if(F.col("reason").isNull() & (F.col("strength") == "strong")).alias("strong"))


@query("a5_candidates_considered", "SELECT count(DISTINCT c) AS candidates FROM (SELECT ca AS c FROM decided UNION ALL SELECT cb FROM decided)")
def _(spark, sf):
    return decided(spark, sf).select(F.explode(F.array("candidate_id_a", "candidate_id_b")).alias("c")).agg(F.count_distinct("c").alias("candidates"))


_BUCKET = "CASE round(score_margin, 9) WHEN 0.15 THEN '0.1' WHEN 0.25 THEN '0.2' WHEN 0.35 THEN '0.3' WHEN 0.85 THEN '0.8' WHEN 0.95 THEN '0.9' ELSE printf('%.1f', round(score_margin, 1)) END"


@query("a6_quality_report", f"SELECT {_BUCKET} AS margin_bucket, count(*) AS n FROM decided WHERE reason IS NULL GROUP BY ALL")
def _(spark, sf):
    return pairs.accepted(decided(spark, sf)).groupBy(S.rounded_bucket(F.round("score_margin", 9)).alias("margin_bucket")).agg(F.count("*").alias("n"))


@query("a7_balance", "SELECT count(*) AS pairs, round(avg(CASE WHEN relation = 'A_BETTER' THEN sa ELSE sb END), 9) AS mean_chosen, round(avg(CASE WHEN relation = 'A_BETTER' THEN sb ELSE sa END), 9) AS mean_rejected, round(avg(score_margin), 9) AS mean_margin, round(100.0 * count(*) FILTER (strength = 'strong') / count(*), 9) AS strong_percent FROM decided WHERE reason IS NULL")
def _(spark, sf):
    p = pairs.accepted(decided(spark, sf))
    return p.agg(F.count("*").alias("pairs"), F.round(F.avg("chosen_score"), 9).alias("mean_chosen"), F.round(F.avg("rejected_score"), 9).alias("mean_rejected"), F.round(F.avg("score_margin"), 9).alias("mean_margin"), F.round(100.0 * F.count_if(F.col("strength") == "strong") / F.count("*"), 9).alias("strong_percent"))


@query("j24_ranks_for_display", "SELECT candidate_id, rank, score, strategy FROM ranks")
def _(spark, sf):
    return ranked(spark, sf).select("candidate_id", "rank").join(assessed(spark, sf).select("candidate_id", "score", "strategy"), "candidate_id")


@query("u9_duplicate_keys", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1")
def _(spark, sf):
    from quillrank.sources.adapters import table

    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")).where("n > 1")


@query("p28_status_transitions", "SELECT upstream_id, run_id, f AS from_status, status AS to_status FROM (SELECT *, lag(status) OVER (PARTITION BY upstream_id ORDER BY created_at, run_id) AS f FROM runs) WHERE f IS NOT NULL AND (f, status) NOT IN (('running', 'running'), ('running', 'completed'), ('running', 'failed'), ('failed', 'running'))")
def _(spark, sf):
    w = Window.partitionBy("upstream_id").orderBy("created_at", "run_id")
    steps = view(spark, sf, "runs").select("upstream_id", "run_id", F.lag("status").over(w).alias("from_status"), F.col("status").alias("to_status")).where("from_status is not null")
    # The transitions that a run may make, of those between these three statuses.
    edges = spark.createDataFrame([("running", "running"), ("running", "completed"), ("running", "failed"), ("failed", "running")], "from_status string, to_status string")
    return steps.join(F.broadcast(edges), ["from_status", "to_status"], "left_anti").select("upstream_id", "run_id", "from_status", "to_status")
