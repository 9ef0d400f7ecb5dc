"""Queries on model variants: metrics, statistics, outcomes, failures, coverage."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillrank.functions import scalars as S
from quillrank.operators import analysis, assess, metrics, order
from quillrank.plans.registry import part, query
from quillrank.sources.adapters import table, view

part("valid", "SELECT *, status = 'passed' AND tests_total > 0 AND tests_passed = tests_total AS correct, CASE WHEN tests_total > 0 THEN tests_passed::DOUBLE / tests_total ELSE 0.0::DOUBLE END AS rate FROM model_evals WHERE status <> 'infrastructure_error'")
part("per_problem", "SELECT model_variant, problem_id, count(*) AS n, count(*) FILTER (correct) AS c, max(rate) AS best, bool_or(correct) AS solved FROM valid GROUP BY ALL")
part("paired", "SELECT b.problem_id, b.n AS bn, b.c AS bc, b.best AS bb, b.solved AS bs, d.n AS dn, d.c AS dc, d.best AS db, d.solved AS ds FROM per_problem b JOIN per_problem d USING (problem_id) WHERE b.model_variant = 'base' AND d.model_variant = 'dpo'")
part("outcomes", """SELECT *, CASE WHEN kind LIKE 'complete%' THEN 'high' WHEN kind = 'unchanged' THEN 'none' WHEN abs(db - bb) >= 0.2 THEN 'medium' ELSE 'low' END AS severity FROM (
  SELECT *, CASE WHEN bb = db THEN 'unchanged' WHEN db > bb THEN CASE WHEN bb = 0 AND db = 1 THEN 'complete_improvement' ELSE 'partial_improvement' END ELSE CASE WHEN bb = 1 AND db = 0 THEN 'complete_regression' ELSE 'partial_regression' END END AS kind FROM paired)""")


def evals(spark, sf):
    return view(spark, sf, "model_evals")


def problems(spark, sf):
    return metrics.per_problem(evals(spark, sf))


def outcomes(spark, sf):
    p = metrics.paired(problems(spark, sf))
    kind = analysis.outcome(F.col("base_best"), F.col("dpo_best"))
    return p.withColumn("outcome", kind).withColumn("severity", analysis.severity(F.col("outcome"), F.col("dpo_best") - F.col("base_best")))


@query("p4_valid_only", "SELECT model_variant, count(*) AS n FROM valid GROUP BY model_variant")
def _(spark, sf):
    return evals(spark, sf).where(metrics.VALID).groupBy("model_variant").agg(F.count("*").alias("n"))


@query("p13_model_error_type", "SELECT candidate_id, model_variant, CASE WHEN status = 'passed' THEN NULL WHEN status IN ('infrastructure_error', 'timeout', 'syntax_error') THEN status WHEN tests_error > 0 THEN CASE WHEN test_error = 'ImportError' THEN 'import_error' ELSE 'runtime_error' END ELSE 'assertion_failure' END AS error_type FROM model_evals")
def _(spark, sf):
    return evals(spark, sf).select("candidate_id", "model_variant", assess.model_error_type(F.array("test_error")).alias("error_type"))


_CATEGORY = "CASE WHEN generation_status = 'generation_error' THEN 'generation_failure' WHEN status = 'passed' THEN 'none' WHEN status IN ('infrastructure_error', 'timeout', 'syntax_error') THEN status WHEN tests_error > 0 THEN CASE WHEN test_error = 'ImportError' THEN 'import_error' ELSE 'runtime_error' END ELSE 'assertion_failure' END"


def classified(spark, sf):
    e = evals(spark, sf).withColumn("error_type", assess.model_error_type(F.array("test_error")))
    return e.withColumn("category", assess.failure_category(F.col("generation_status"), F.col("code"), F.col("code"), F.col("status") == "passed", F.col("error_type"), F.col("test_error")))


@query("p14_failure_taxonomy", f"SELECT candidate_id, model_variant, {_CATEGORY} AS category FROM model_evals")
def _(spark, sf):
    return classified(spark, sf).select("candidate_id", "model_variant", "category")


@query("p15_subcategory", "SELECT position, CASE WHEN error_type IN ('TypeError', 'KeyError', 'MemoryError', 'IndexError', 'AssertionError') THEN error_type ELSE 'other' END AS subcategory FROM tests WHERE error_type IS NOT NULL")
def _(spark, sf):
    return view(spark, sf, "tests").where("error_type is not null").select("position", assess.subcategory(F.col("error_type")).alias("subcategory"))


@query("p18_outcomes", "SELECT problem_id, kind AS outcome, severity, round(db - bb, 9) AS delta FROM outcomes")
def _(spark, sf):
    return outcomes(spark, sf).select("problem_id", "outcome", "severity", F.round(F.col("dpo_best") - F.col("base_best"), 9).alias("delta"))


@query("u10_outcome_buckets", "SELECT CASE WHEN kind LIKE '%improvement' THEN 'improved' WHEN kind LIKE '%regression' THEN 'regressed' ELSE 'unchanged' END AS bucket, count(*) AS n FROM outcomes GROUP BY ALL")
def _(spark, sf):
    o = F.col("outcome")
    return outcomes(spark, sf).groupBy(F.when(o.endswith("improvement"), "improved").when(o.endswith("regression"), "regressed").otherwise("unchanged").alias("bucket")).agg(F.count("*").alias("n"))


@query("p26_pass_rate_buckets", "SELECT candidate_id, model_variant, CASE WHEN rate = 0 THEN '0%' WHEN rate <= 0.2 THEN '1-20%' WHEN rate <= 0.4 THEN '20-40%' WHEN rate <= 0.6 THEN '40-60%' WHEN rate <= 0.8 THEN '60-80%' WHEN rate < 1 THEN '80-99%' ELSE '100%' END AS bucket FROM valid")
def _(spark, sf):
    return evals(spark, sf).where(metrics.VALID).select("candidate_id", "model_variant", S.pass_rate_bucket(S.ratio("tests_passed", "tests_total")).alias("bucket"))


@query("a17_failure_distribution", "SELECT b AS bucket, count(rate) AS n FROM (SELECT unnest(['0%', '1-20%', '20-40%', '40-60%', '60-80%', '80-99%', '100%']) AS b) LEFT JOIN (SELECT rate, CASE WHEN rate = 0 THEN '0%' WHEN rate <= 0.2 THEN '1-20%' WHEN rate <= 0.4 THEN '20-40%' WHEN rate <= 0.6 THEN '40-60%' WHEN rate <= 0.8 THEN '60-80%' WHEN rate < 1 THEN '80-99%' ELSE '100%' END AS k FROM valid) ON b = k GROUP BY b")
def _(spark, sf):
    n = evals(spark, sf).where(metrics.VALID).groupBy(S.pass_rate_bucket(S.ratio("tests_passed", "tests_total")).alias("bucket")).agg(F.count("*").alias("n"))
    names = spark.createDataFrame([(b,) for b in S.PASS_RATE_BUCKETS], "bucket string")
    return names.join(n, "bucket", "left").na.fill(0, ["n"])


@query("a8_split_lengths", "SELECT role, count(*) AS n, round(avg(length(text)), 9) AS mean_chars, max(length(text)) AS max_chars FROM turns GROUP BY role")
def _(spark, sf):
    n = F.length("text").cast("long")
    return view(spark, sf, "turns").groupBy("role").agg(F.count("*").alias("n"), F.round(F.avg(n), 9).alias("mean_chars"), F.max(n).alias("max_chars"))


_RANK = "max(v) FILTER (r = greatest(1, least(n, round_even({p} * n / 100.0, 0)::BIGINT))) AS p{p}"


@query("a10_nearest_rank", f"SELECT role, {', '.join(_RANK.format(p=p) for p in (50, 90, 95, 99))}, max(v) AS max, round(avg(v), 9) AS mean FROM (SELECT role, length(text) AS v, row_number() OVER (PARTITION BY role ORDER BY length(text)) AS r, count(*) OVER (PARTITION BY role) AS n FROM turns) GROUP BY role")
def _(spark, sf):
    out = metrics.percentile_at(view(spark, sf, "turns").select("role", F.length("text").cast("long").alias("v")), ["role"], "v", [50, 90, 95, 99])
    return out.withColumn("mean", F.round("mean", 9))


@query("a11_latency", f"SELECT model_variant, {', '.join(_RANK.format(p=p) for p in (50, 95))}, round(avg(v), 9) AS mean, round(sum(g) / (sum(v) / 1000.0), 9) AS tokens_per_s FROM (SELECT model_variant, duration_ms AS v, generated_tokens AS g, row_number() OVER (PARTITION BY model_variant ORDER BY duration_ms) AS r, count(*) OVER (PARTITION BY model_variant) AS n FROM model_evals) GROUP BY model_variant")
def _(spark, sf):
    e = evals(spark, sf)
    p = metrics.percentile_at(e, ["model_variant"], "duration_ms", [50, 95]).select("model_variant", "p50", "p95", F.round("mean", 9).alias("mean"))
    rate = e.groupBy("model_variant").agg(F.round(F.sum("generated_tokens") / (F.sum("duration_ms") / 1000.0), 9).alias("tokens_per_s"))
    return p.join(rate, "model_variant")


def _at_k(k: int) -> str:
    miss = " * ".join(f"((n - c - {i} + 1)::DOUBLE / (n - {i} + 1))" for i in range(1, k + 1))
    return f"CASE WHEN c = 0 THEN 0.0 WHEN n - c < {k} THEN 1.0 ELSE 1 - {miss} END"


for _k in (1, 5, 10):

    @query(f"a12_pass_at_{_k}", f"SELECT model_variant, problem_id, round({_at_k(_k)}, 9) AS pass_at_k FROM per_problem WHERE n >= {_k}")
    def _(spark, sf, k=_k):
        return problems(spark, sf).where(F.col("n") >= k).select("model_variant", "problem_id", F.round(S.pass_at_k("n", "c", k), 9).alias("pass_at_k"))

    @query(f"a13_mean_pass_at_{_k}", f"SELECT model_variant, count(*) AS problems, round(avg({_at_k(_k)}), 9) AS pass_at_k FROM per_problem WHERE n >= {_k} GROUP BY model_variant")
    def _(spark, sf, k=_k):
        return metrics.mean_pass_at_k(problems(spark, sf), k).withColumn("pass_at_k", F.round("pass_at_k", 9))


@query("a14_mean_test_pass_rate", "SELECT model_variant, round(avg(rate), 9) AS mean_rate FROM valid GROUP BY model_variant")
def _(spark, sf):
    return evals(spark, sf).where(metrics.VALID).groupBy("model_variant").agg(F.round(F.coalesce(F.avg(S.ratio("tests_passed", "tests_total")), F.lit(0.0)), 9).alias("mean_rate"))


@query("a15_solve_rate", "SELECT model_variant, round(avg(s::INT), 9) AS solve_rate FROM (SELECT model_variant, problem_id, bool_or(status = 'passed' AND tests_total > 0 AND tests_passed = tests_total) AS s FROM model_evals GROUP BY ALL) GROUP BY model_variant")
def _(spark, sf):
    s = evals(spark, sf).groupBy("model_variant", "problem_id").agg(F.bool_or(metrics.correct()).alias("s"))
    return s.groupBy("model_variant").agg(F.round(F.avg(F.col("s").cast("int")), 9).alias("solve_rate"))


@query("a16_rates", "SELECT model_variant, round(avg(syntax_valid::INT) FILTER (generation_status = 'generated'), 9) AS syntax_rate, round(avg((status <> 'infrastructure_error')::INT), 9) AS execution_rate, round(avg((status = 'timeout')::INT), 9) AS timeout_rate, round(avg((generation_status = 'generation_error')::INT), 9) AS generation_failure_rate FROM model_evals GROUP BY model_variant")
def rates(spark, sf):
    share = lambda c: F.round(F.avg(c.cast("int")), 9)
    return evals(spark, sf).groupBy("model_variant").agg(share(F.when(F.col("generation_status") == "generated", F.col("syntax_valid"))).alias("syntax_rate"), share(F.col("status") != "infrastructure_error").alias("execution_rate"), share(F.col("status") == "timeout").alias("timeout_rate"), share(F.col("generation_status") == "generation_error").alias("generation_failure_rate"))


@query("a18_metrics_summary", f"SELECT model_variant, count(*) AS problems, round(avg(CASE WHEN n >= 1 THEN {_at_k(1)} END), 9) AS pass_at_1, round(avg(CASE WHEN n >= 5 THEN {_at_k(5)} END), 9) AS pass_at_5, round(avg(best), 9) AS mean_best, round(avg(solved::INT), 9) AS solved FROM per_problem GROUP BY model_variant")
def _(spark, sf):
    k = lambda k: F.round(F.avg(F.when(F.col("n") >= k, S.pass_at_k("n", "c", k))), 9).alias(f"pass_at_{k}")
    return problems(spark, sf).groupBy("model_variant").agg(F.count("*").alias("problems"), k(1), k(5), F.round(F.avg("best"), 9).alias("mean_best"), F.round(F.avg(F.col("solved").cast("int")), 9).alias("solved"))


_CATEGORIES = ("generation_failure", "code_extraction_failure", "syntax_error", "import_error", "runtime_error", "assertion_failure", "timeout", "memory_error", "infrastructure_error")


@query("a19_failure_analysis", "SELECT model_variant, " + ", ".join(f"count(*) FILTER (k = '{c}') AS {c}" for c in _CATEGORIES) + f" FROM (SELECT model_variant, {_CATEGORY} AS k FROM model_evals) GROUP BY model_variant")
def _(spark, sf):
    return classified(spark, sf).groupBy("model_variant").pivot("category", list(_CATEGORIES)).count().na.fill(0)


@query("a20_error_profile", f"SELECT model_variant, k AS category, n, round(n::DOUBLE / sum(CASE WHEN k <> 'infrastructure_error' THEN n END) OVER (PARTITION BY model_variant), 9) AS rate FROM (SELECT model_variant, {_CATEGORY} AS k, count(*) AS n FROM model_evals GROUP BY ALL)")
def _(spark, sf):
    n = classified(spark, sf).groupBy("model_variant", "category").agg(F.count("*").alias("n"))
    total = F.sum(F.when(F.col("category") != "infrastructure_error", F.col("n"))).over(Window.partitionBy("model_variant"))
    return n.withColumn("rate", F.round(F.col("n") / total, 9))


@query("a21_dominant_subcategory", "SELECT problem_id, error_type, n FROM (SELECT problem_id, error_type, count(*) AS n FROM tests WHERE error_type IS NOT NULL GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY problem_id ORDER BY n DESC, error_type) = 1")
def _(spark, sf):
    return analysis.mode(view(spark, sf, "tests"), ["problem_id"], "error_type")


@query("a22_best_and_solved", "SELECT model_variant, problem_id, best, solved FROM per_problem")
def _(spark, sf):
    return problems(spark, sf).select("model_variant", "problem_id", "best", "solved")


@query("a23_diversity", "SELECT model_variant, sum(d)::BIGINT AS distinct_outputs, sum(n)::BIGINT AS n, round(sum(d)::DOUBLE / sum(n), 9) AS diversity FROM (SELECT model_variant, problem_id, count(DISTINCT sha256(code)) AS d, count(*) AS n FROM model_evals GROUP BY ALL) GROUP BY model_variant")
def _(spark, sf):
    return analysis.diversity(evals(spark, sf)).select("model_variant", F.col("distinct").alias("distinct_outputs"), "n", F.round("diversity", 9).alias("diversity"))


@query("a24_mode_collapse", "SELECT round((d - b) / b, 9) AS relative_change, (b - d) / b >= 0.2 AS warning FROM (SELECT sum(CASE WHEN model_variant = 'base' THEN d END)::DOUBLE / sum(CASE WHEN model_variant = 'base' THEN n END) AS b, sum(CASE WHEN model_variant = 'dpo' THEN d END)::DOUBLE / sum(CASE WHEN model_variant = 'dpo' THEN n END) AS d FROM (SELECT model_variant, problem_id, count(DISTINCT sha256(code)) AS d, count(*) AS n FROM model_evals GROUP BY ALL))")
def _(spark, sf):
    d = analysis.diversity(evals(spark, sf)).groupBy().pivot("model_variant", ["base", "dpo"]).agg(F.first("diversity"))
    change = S.relative_change("dpo", "base")
    return d.select(F.round(change, 9).alias("relative_change"), (-change >= analysis.THRESHOLD).alias("warning"))


_FAILED = "count(*) FILTER (model_variant = '{v}' AND status IN ('failed', 'error')) AS {v}_failures, count(*) FILTER (model_variant = '{v}') AS {v}_runs"
part("test_rates", f"SELECT *, CASE WHEN base_runs > 0 THEN base_failures::DOUBLE / base_runs ELSE 0.0::DOUBLE END AS br, CASE WHEN dpo_runs > 0 THEN dpo_failures::DOUBLE / dpo_runs ELSE 0.0::DOUBLE END AS dr FROM (SELECT problem_id, test_case_id, {_FAILED.format(v='base')}, {_FAILED.format(v='dpo')} FROM tests GROUP BY ALL)")


@query("a25_test_failures", "SELECT problem_id, test_case_id, base_runs, base_failures, dpo_runs, dpo_failures FROM test_rates")
def _(spark, sf):
    return analysis.failure_rates(view(spark, sf, "tests")).select("problem_id", "test_case_id", "base_runs", "base_failures", "dpo_runs", "dpo_failures")


@query("p20_test_flags", "SELECT problem_id, test_case_id, br >= 0.5 AND dr >= 0.5 AS hard, dr - br >= 0.2 AS dpo_specific, br - dr >= 0.2 AS base_specific FROM test_rates")
def _(spark, sf):
    return analysis.failure_rates(view(spark, sf, "tests")).select("problem_id", "test_case_id", "hard", "dpo_specific", "base_specific")


@query("p21_interesting_tests", "SELECT problem_id, test_case_id FROM test_rates WHERE base_failures > 0 OR dpo_failures > 0")
def _(spark, sf):
    return analysis.failure_rates(view(spark, sf, "tests")).where("hard or dpo_specific or base_specific or base_failures > 0 or dpo_failures > 0").select("problem_id", "test_case_id")


@query("j15_test_counters", "SELECT coalesce(b.problem_id, d.problem_id) AS problem_id, coalesce(b.test_case_id, d.test_case_id) AS test_case_id, coalesce(b.n, 0) AS base_runs, coalesce(d.n, 0) AS dpo_runs FROM (SELECT problem_id, test_case_id, count(*) AS n FROM tests WHERE model_variant = 'base' GROUP BY ALL) b FULL JOIN (SELECT problem_id, test_case_id, count(*) AS n FROM tests WHERE model_variant = 'dpo' GROUP BY ALL) d ON b.problem_id = d.problem_id AND b.test_case_id = d.test_case_id")
def _(spark, sf):
    t = view(spark, sf, "tests")
    side = lambda v: t.where(F.col("model_variant") == v).groupBy("problem_id", "test_case_id").agg(F.count("*").alias(f"{v}_runs"))
    return side("base").join(side("dpo"), ["problem_id", "test_case_id"], "full_outer").na.fill(0)


part("brand_shares", "SELECT category, coalesce(t.n::DOUBLE / sum(t.n) OVER (), 0) AS ts, coalesce(b.n::DOUBLE / sum(b.n) OVER (), 0) AS bs FROM (SELECT DISTINCT category FROM problems) LEFT JOIN (SELECT category, count(*) AS n FROM problems JOIN (SELECT problem_id FROM model_evals WHERE status = 'passed') USING (problem_id) WHERE ordinal % 3 > 0 GROUP BY ALL) t USING (category) LEFT JOIN (SELECT category, count(*) AS n FROM problems WHERE ordinal % 7 = 0 GROUP BY ALL) b USING (category)")


def coverage(spark, sf):
    p = view(spark, sf, "problems")
    training = evals(spark, sf).where("status = 'passed'").select("problem_id").join(p.where("ordinal % 3 > 0"), "problem_id")
    return analysis.shares(training, p.where("ordinal % 7 = 0"), "category", p)


@query("a26_category_shares", "SELECT category, round(ts, 9) AS training_share, round(bs, 9) AS benchmark_share, CASE WHEN bs > 0 THEN round(ts / bs, 9) END AS coverage_ratio FROM brand_shares")
def _(spark, sf):
    return coverage(spark, sf).select("category", *[F.round(c, 9).alias(c) for c in ("training_share", "benchmark_share", "coverage_ratio")])


@query("p19_coverage_verdict", "SELECT category, CASE WHEN bs = 0 AND ts = 0 THEN 'absent_from_both' WHEN bs = 0 THEN 'not_in_benchmark' WHEN ts / bs < 0.5 THEN 'underrepresented' WHEN ts / bs > 2 THEN 'overrepresented' ELSE 'balanced' END AS verdict FROM brand_shares")
def _(spark, sf):
    return coverage(spark, sf).select("category", "verdict")


@query("a27_strategy_coverage", "SELECT category, count(*) AS n, round(avg(rate), 9) AS mean_rate, string_agg(DISTINCT difficulty, ',' ORDER BY difficulty) AS difficulties FROM valid JOIN problems USING (problem_id) GROUP BY category")
def _(spark, sf):
    rows = evals(spark, sf).where(metrics.VALID).join(view(spark, sf, "problems"), "problem_id")
    return rows.groupBy("category").agg(F.count("*").alias("n"), F.round(F.avg(S.ratio("tests_passed", "tests_total")), 9).alias("mean_rate"), F.array_join(F.array_sort(F.collect_set("difficulty")), ",").alias("difficulties"))


@query("j25_gaps_and_outcomes", "SELECT category, count(*) AS problems, count(*) FILTER (NOT ds) AS unsolved FROM outcomes JOIN problems USING (problem_id) JOIN brand_shares s USING (category) WHERE s.bs > 0 AND s.ts / s.bs < 1 GROUP BY category")
def _(spark, sf):
    rows = outcomes(spark, sf).join(view(spark, sf, "problems").select("problem_id", "category"), "problem_id").join(coverage(spark, sf).where("coverage_ratio < 1").select("category"), "category")
    return rows.groupBy("category").agg(F.count("*").alias("problems"), F.count_if(~F.col("dpo_solved")).alias("unsolved"))


@query("a28_win_tie_loss", "SELECT count(*) FILTER (d > 0) AS win, count(*) FILTER (d = 0) AS tie, count(*) FILTER (d < 0) AS loss, round(count(*) FILTER (d > 0)::DOUBLE / count(*) FILTER (d <> 0), 9) AS win_rate FROM (SELECT dc * bn - bc * dn AS d FROM paired)")
def _(spark, sf):
    return metrics.win_tie_loss(metrics.paired(problems(spark, sf))).withColumn("win_rate", F.round("win_rate", 9))


@query("j13_paired_problems", "SELECT problem_id, bn AS base_n, bc AS base_c, dn AS dpo_n, dc AS dpo_c FROM paired")
def _(spark, sf):
    return metrics.paired(problems(spark, sf)).select("problem_id", "base_n", "base_c", "dpo_n", "dpo_c")


@query("a37_mcnemar", "SELECT b AS base_only, d AS dpo_only, round(least(1.0, 2 * (SELECT sum(exp(lgamma(b + d + 1) - lgamma(i + 1) - lgamma(b + d - i + 1) - (b + d) * ln(2))) FROM range(0, least(b, d) + 1) t(i))), 6) AS p_value FROM (SELECT count(*) FILTER (bs AND NOT ds) AS b, count(*) FILTER (NOT bs AND ds) AS d FROM paired)")
def _(spark, sf):
    return metrics.mcnemar(metrics.paired(problems(spark, sf))).withColumn("p_value", F.round("p_value", 6))


def _indexed(p, value):
    """idx, from 0 in the order of problems, and value."""
    return order.numbered(p.select("problem_id", F.expr(value).alias("value")), "problem_id", name="idx", first=0).select(F.col("idx").cast("int").alias("idx"), "value")


#: Of hashed_draws(), as SQL: the draws of 1000 resamples of n problems.
_DRAWS = "SELECT i AS iteration, (('0x' || substr(md5('42:' || i || ':' || j), 1, 12))::BIGINT % n) AS idx FROM (SELECT count(*) AS n FROM paired), (SELECT unnest(range(0, 1000)) AS i), (SELECT idx AS j FROM values_)"
for _name, _value, _sql in (("a34_bootstrap", "dpo_c / dpo_n", "dc::DOUBLE / dn"), ("a35_paired_bootstrap", "dpo_c / dpo_n - base_c / base_n", "dc::DOUBLE / dn - bc::DOUBLE / bn")):

    @query(_name)  # of all paired problems, 1000 resamples of random.Random(42), which SQL has not
    def _(spark, sf, value=_value):
        values = _indexed(metrics.paired(problems(spark, sf)), value)
        out = metrics.interval(values, metrics.seeded_means(values, values.count()))
        return out.select(*[F.round(c, 9).alias(c) for c in ("point", "lower", "upper", "mean")])

    for _statistic, _of, _agg in (("mean", F.avg, "avg"), ("median", F.median, "median")):

        @query(f"{_name}_hashed_{_statistic}", f"WITH values_ AS (SELECT row_number() OVER (ORDER BY problem_id) - 1 AS idx, {_sql} AS value FROM paired), draws_ AS ({_DRAWS}) SELECT (SELECT round({_agg}(value), 9) FROM values_) AS point, round(quantile_cont(m, 0.025), 9) AS lower, round(quantile_cont(m, 0.975), 9) AS upper, round(avg(m), 9) AS mean FROM (SELECT iteration, {_agg}(value) AS m FROM draws_ JOIN values_ USING (idx) GROUP BY iteration)")
        def _(spark, sf, value=_value, of=_of):
            values = _indexed(metrics.paired(problems(spark, sf)), value)
            out = metrics.bootstrap(values, metrics.hashed_draws(spark, values.count()), statistic=of)
            return out.select(*[F.round(c, 9).alias(c) for c in ("point", "lower", "upper", "mean")])


@query("a36_linear_percentile", "SELECT model_variant, round(quantile_cont(duration_ms, 0.025), 9) AS low, round(quantile_cont(duration_ms, 0.975), 9) AS high FROM model_evals GROUP BY model_variant")
def _(spark, sf):
    return evals(spark, sf).groupBy("model_variant").agg(F.round(F.percentile("duration_ms", F.lit(0.025)), 9).alias("low"), F.round(F.percentile("duration_ms", F.lit(0.975)), 9).alias("high"))


part("success", f"SELECT max(CASE WHEN model_variant = 'dpo' THEN p1 END) - max(CASE WHEN model_variant = 'base' THEN p1 END) AS d1, max(CASE WHEN model_variant = 'dpo' THEN t END) - max(CASE WHEN model_variant = 'base' THEN t END) AS dt FROM (SELECT model_variant, avg({_at_k(1)}) AS p1 FROM per_problem GROUP BY ALL) JOIN (SELECT model_variant, avg((status = 'timeout')::INT) AS t FROM model_evals GROUP BY ALL) USING (model_variant)")


@query("p24_success_criteria", "SELECT d1 >= 0.01 AS pass_at_1_improves, dt <= 0.02 AS timeout_rate_not_increased, d1 >= 0.01 AND dt <= 0.02 AS success FROM success")
def _(spark, sf):
    p1 = metrics.mean_pass_at_k(problems(spark, sf), 1).groupBy().pivot("model_variant", ["base", "dpo"]).agg(F.first("pass_at_k"))
    t = evals(spark, sf).groupBy().pivot("model_variant", ["base", "dpo"]).agg(F.avg((F.col("status") == "timeout").cast("int")))
    both = p1.select(F.col("base").alias("b1"), F.col("dpo").alias("d1"), F.lit(1).alias("k")).join(t.select(F.col("base").alias("bt"), F.col("dpo").alias("dt"), F.lit(1).alias("k")), "k")
    better, quick = F.coalesce(F.col("d1") - F.col("b1") >= 0.01, F.lit(False)), F.coalesce(F.col("dt") - F.col("bt") <= 0.02, F.lit(True))
    return both.select(better.alias("pass_at_1_improves"), quick.alias("timeout_rate_not_increased"), (better & quick).alias("success"))


@query("p25_iteration_decision", "SELECT CASE WHEN count(*) < 30 THEN 'insufficient_evidence' WHEN count(*) FILTER (kind LIKE '%regression') > count(*) FILTER (kind LIKE '%improvement') THEN 'adjust_training' WHEN (SELECT count(*) FROM brand_shares WHERE bs > 0 AND ts / bs < 0.5) > 0 THEN 'refine_data' WHEN (SELECT count(*) FROM brand_shares WHERE bs = 0 AND ts > 0) > 0 THEN 'expand_benchmark' ELSE 'accept_model' END AS decision FROM outcomes")
def _(spark, sf):
    o = outcomes(spark, sf).agg(F.count("*").alias("n"), F.count_if(F.col("outcome").endswith("regression")).alias("r"), F.count_if(F.col("outcome").endswith("improvement")).alias("i"), F.lit(1).alias("k"))
    c = coverage(spark, sf).agg(F.count_if(F.col("verdict") == "underrepresented").alias("u"), F.count_if(F.col("verdict") == "not_in_benchmark").alias("m"), F.lit(1).alias("k"))
    return o.join(c, "k").select(F.when(F.col("n") < 30, "insufficient_evidence").when(F.col("r") > F.col("i"), "adjust_training").when(F.col("u") > 0, "refine_data").when(F.col("m") > 0, "expand_benchmark").otherwise("accept_model").alias("decision"))


@query("o5_top_recommendations", "SELECT category, n FROM (SELECT category, count(*) AS n FROM problems GROUP BY category) ORDER BY -n, category LIMIT 10")
def _(spark, sf):
    return view(spark, sf, "problems").groupBy("category").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "category").limit(10)


@query("o6_recommendation_score", "SELECT p_partkey, round(0.5 * (p_size / 50.0) + 0.3 * ((p_partkey % 10) / 10.0) + 0.2 * (1 - (p_partkey % 7) / 7.0), 6) AS score FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", analysis.score(F.col("p_size") / 50.0, F.col("p_partkey") % 10 / 10.0, F.col("p_partkey") % 7 / 7.0).alias("score"))


@query("j14_diversity_union", "SELECT coalesce(b.problem_id, d.problem_id) AS problem_id, coalesce(b.v, 0) AS base_diversity, coalesce(d.v, 0) AS dpo_diversity FROM (SELECT problem_id, count(DISTINCT code)::DOUBLE / count(*) AS v FROM model_evals WHERE model_variant = 'base' GROUP BY ALL) b FULL JOIN (SELECT problem_id, count(DISTINCT code)::DOUBLE / count(*) AS v FROM model_evals WHERE model_variant = 'dpo' GROUP BY ALL) d ON b.problem_id = d.problem_id")
def _(spark, sf):
    e = evals(spark, sf)
    side = lambda v: e.where(F.col("model_variant") == v).groupBy("problem_id").agg((F.count_distinct("code") / F.count("*")).alias(f"{v}_diversity"))
    return side("base").join(side("dpo"), "problem_id", "full_outer").na.fill(0.0)


@query("w8_first_sample", "SELECT model_variant, problem_id, candidate_id, status FROM model_evals WHERE sample_index = 0")
def _(spark, sf):
    first = evals(spark, sf).groupBy("model_variant", "problem_id").agg(F.min_by(F.struct("candidate_id", "status"), "sample_index").alias("f"))
    return first.select("model_variant", "problem_id", "f.*")


@query("u3_common_coverage", "SELECT problem_id FROM per_problem WHERE model_variant = 'base' INTERSECT SELECT problem_id FROM per_problem WHERE model_variant = 'dpo'")
def _(spark, sf):
    p = problems(spark, sf)
    return p.where("model_variant = 'base'").select("problem_id").intersect(p.where("model_variant = 'dpo'").select("problem_id"))


@query("u4_missing_coverage", "SELECT 'missing_from_dpo' AS side, count(*) AS n FROM (SELECT problem_id FROM per_problem WHERE model_variant = 'base' EXCEPT SELECT problem_id FROM per_problem WHERE model_variant = 'dpo') UNION ALL SELECT 'missing_from_base', count(*) FROM (SELECT problem_id FROM per_problem WHERE model_variant = 'dpo' EXCEPT SELECT problem_id FROM per_problem WHERE model_variant = 'base')")
def _(spark, sf):
    p = problems(spark, sf)
    ids = {v: p.where(F.col("model_variant") == v).select("problem_id") for v in ("base", "dpo")}
    n = lambda a, b: ids[a].subtract(ids[b]).agg(F.lit(f"missing_from_{b}").alias("side"), F.count("*").alias("n"))
    return n("base", "dpo").unionByName(n("dpo", "base"))


@query("u12_examples", "SELECT problem_id, kind AS outcome, f.candidate_id FROM outcomes JOIN (SELECT problem_id, candidate_id FROM model_evals WHERE model_variant = 'dpo' AND sample_index = 0) f USING (problem_id) WHERE kind LIKE 'complete%'")
def _(spark, sf):
    f = evals(spark, sf).where("model_variant = 'dpo'").groupBy("problem_id").agg(F.min_by("candidate_id", "sample_index").alias("candidate_id"))
    return outcomes(spark, sf).where("outcome like 'complete%'").join(f, "problem_id").select("problem_id", "outcome", "candidate_id")


@query("u13_example_sets", "SELECT CASE WHEN bs AND ds THEN 'solved_by_both' WHEN ds THEN 'successful' WHEN bs THEN 'regression' ELSE 'hard' END AS kind, count(*) AS n FROM outcomes GROUP BY ALL")
def _(spark, sf):
    b, d = F.col("base_solved"), F.col("dpo_solved")
    return outcomes(spark, sf).groupBy(F.when(b & d, "solved_by_both").when(d, "successful").when(b, "regression").otherwise("hard").alias("kind")).agg(F.count("*").alias("n"))


@query("j11_generation_with_evaluation", "SELECT model_variant, generation_status, count(*) AS n, count(*) FILTER (status = 'passed') AS passed FROM model_evals GROUP BY ALL")
def _(spark, sf):
    e = evals(spark, sf)
    g, v = e.select("model_variant", "problem_id", "sample_index", "generation_status"), e.select("model_variant", "problem_id", "sample_index", "status")
    return g.join(v, ["model_variant", "problem_id", "sample_index"], "left").groupBy("model_variant", "generation_status").agg(F.count("*").alias("n"), F.count_if(F.col("status") == "passed").alias("passed"))


@query("j12_computed_key", "SELECT model_variant, problem_id, sample_index, candidate_id FROM model_evals WHERE status = 'timeout'")
def _(spark, sf):
    e = evals(spark, sf)
    t = e.where("status = 'timeout'").select("model_variant", "problem_id", "candidate_id", (S.candidate_ordinal("candidate_id") - 1).alias("sample_index"))
    return e.select("model_variant", "problem_id", "sample_index").join(t, ["model_variant", "problem_id", "sample_index"])
