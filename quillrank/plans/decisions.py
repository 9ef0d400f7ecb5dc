"""Queries that decide: recommendations, promotions, resumption, reproducibility, retries; and reports that carry decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillrank.functions import scalars as S
from quillrank.operators import analysis, decide, metrics, pairs
from quillrank.plans import candidates, models
from quillrank.plans.models import _at_k
from quillrank.plans.registry import part, query
from quillrank.sources.adapters import table, view

part("difficulty_shares", "SELECT difficulty, coalesce(t.n::DOUBLE / sum(t.n) OVER (), 0) AS ts, coalesce(b.n::DOUBLE / sum(b.n) OVER (), 0) AS bs FROM (SELECT DISTINCT difficulty FROM problems) LEFT JOIN (SELECT difficulty, count(*) AS n FROM problems WHERE difficulty = 'easy' OR ordinal % 9 = 0 GROUP BY ALL) t USING (difficulty) LEFT JOIN (SELECT difficulty, count(*) AS n FROM problems GROUP BY ALL) b USING (difficulty)")
part("gap_verdicts", "SELECT category AS name, CASE WHEN bs = 0 AND ts = 0 THEN 'absent_from_both' WHEN bs = 0 THEN 'not_in_benchmark' WHEN ts / bs < 0.5 THEN 'underrepresented' WHEN ts / bs > 2 THEN 'overrepresented' ELSE 'balanced' END AS verdict FROM (SELECT category, CASE WHEN category LIKE '%1' THEN ts / 9 ELSE ts END AS ts, CASE WHEN category LIKE '%2' THEN 0 ELSE bs END AS bs FROM brand_shares)")
part("difficulty_verdicts", "SELECT difficulty AS name, CASE WHEN bs = 0 AND ts = 0 THEN 'absent_from_both' WHEN bs = 0 THEN 'not_in_benchmark' WHEN ts / bs < 0.5 THEN 'underrepresented' WHEN ts / bs > 2 THEN 'overrepresented' ELSE 'balanced' END AS verdict FROM difficulty_shares")


def gaps(spark, sf):
    """Coverage by category, of which some are little trained on and some not measured."""
    c = models.coverage(spark, sf)
    t = F.when(F.col("category").endswith("1"), F.col("training_share") / 9).otherwise(F.col("training_share"))
    b = F.when(F.col("category").endswith("2"), 0.0).otherwise(F.col("benchmark_share"))
    return c.select(F.col("category").alias("name"), t.alias("training_share"), b.alias("benchmark_share"), F.try_divide(t, b).alias("coverage_ratio"), analysis.verdict(t, b).alias("verdict"))


def difficulties(spark, sf):
    p = view(spark, sf, "problems")
    return analysis.shares(p.where("difficulty = 'easy' or ordinal % 9 = 0"), p, "difficulty", p).withColumnRenamed("difficulty", "name")


_FIRED = """SELECT 'add_data' AS category, least(1, 0.3 + 0.1 * u) AS i, CASE WHEN u > 0 THEN 0.7 ELSE 0.4 END AS s, 0.6 AS c, '{"underrepresented":' || to_json(names) || ',"unsolved":' || to_json(open_) || '}' AS evidence
  FROM (SELECT list(name ORDER BY name) AS names, coalesce(list(name ORDER BY name) FILTER (name IN (SELECT category FROM outcomes JOIN problems USING (problem_id) WHERE NOT ds)), []) AS open_, count(*) FILTER (name IN (SELECT category FROM outcomes JOIN problems USING (problem_id) WHERE NOT ds)) AS u FROM gap_verdicts WHERE verdict = 'underrepresented' HAVING count(*) > 0)
UNION ALL SELECT 'expand_benchmark', 0.6, 0.9, 0.5, '{"absent":' || to_json(list(name ORDER BY name)) || '}' FROM gap_verdicts WHERE verdict = 'not_in_benchmark' HAVING count(*) > 0
UNION ALL SELECT 'investigate_regression', 0.7, 0.8, 0.3, '{"regressions":' || count(*) FILTER (kind LIKE '%regression') || ',"improvements":' || count(*) FILTER (kind LIKE '%improvement') || '}' FROM outcomes HAVING count(*) FILTER (kind LIKE '%regression') > count(*) FILTER (kind LIKE '%improvement')
UNION ALL SELECT 'investigate_mode_collapse', 0.5, 0.6, 0.4, '{"base":0.5,"dpo":0.25}'
UNION ALL SELECT 'increase_problem_difficulty', 0.4, 0.6, 0.7, '{"skewed":' || to_json(coalesce(list(name ORDER BY name) FILTER (verdict = 'overrepresented' AND name = 'easy'), [])) || ',"starved":' || to_json(coalesce(list(name ORDER BY name) FILTER (verdict = 'underrepresented' AND name IN ('medium', 'hard')), [])) || '}'
  FROM difficulty_verdicts HAVING count(*) FILTER (verdict = 'overrepresented' AND name = 'easy' OR verdict = 'underrepresented' AND name IN ('medium', 'hard')) > 0
UNION ALL SELECT 'refine_preference_pairs', 0.6, 0.8, 0.5, '{"trained_pairs":12}' UNION ALL SELECT 'adjust_dpo_hyperparameters', 0.5, 0.5, 0.2, '{"verdict":"undertrained"}'"""


def problem_outcomes(spark, sf):
    o = models.outcomes(spark, sf).select("problem_id", "outcome", "dpo_solved")
    return o.join(view(spark, sf, "problems").select("problem_id", "category"), "problem_id")


@query("d11_recommendations", f"SELECT category, evidence, round(0.5 * i + 0.3 * s + 0.2 * (1 - c), 6)::DOUBLE AS score FROM ({_FIRED})")
def _(spark, sf):
    one = lambda row, schema: spark.createDataFrame([row], schema)
    out = decide.recommendations(problem_outcomes(spark, sf), gaps(spark, sf), difficulties(spark, sf), one((0.5, 0.25, True), "base double, dpo double, warning boolean"), one((12,), "trained_pairs long"), one(("undertrained",), "verdict string"))
    return out.select("category", "evidence", "score")


@query("d11_no_action", "SELECT 'no_action' AS category, 0.29::DOUBLE AS score, '{\"n\":' || count(*) || ',\"improvements\":0}' AS evidence FROM outcomes")
def _(spark, sf):
    one = lambda row, schema: spark.createDataFrame([row], schema)
    calm, none = problem_outcomes(spark, sf).withColumn("outcome", F.lit("unchanged")), gaps(spark, sf).where("verdict = 'balanced'")
    out = decide.recommendations(calm, none, none, one((0.5, 0.5, False), "base double, dpo double, warning boolean"), one((5000,), "trained_pairs long"), one(("healthy",), "verdict string"))
    return out.select("category", "score", "evidence")


_LEGAL = ", ".join(f"('{a}', '{b}')" for a, b in decide.PROMOTIONS)
_STATUSES = ("EXPERIMENTAL", "VALIDATED", "RECOMMENDED", "RETIRED", "REJECTED")


@query("c19_promotion", f"SELECT run_id, CASE WHEN (f, t) NOT IN ({_LEGAL}) THEN 'illegal_transition' WHEN t = 'RECOMMENDED' AND status = 'failed' THEN 'no_evaluation' WHEN t = 'RECOMMENDED' AND status <> 'completed' THEN 'criteria_failed' END AS refused FROM (SELECT run_id, status, {list(_STATUSES)}[(n % 5 + 1)::INT] AS f, {list(_STATUSES)}[(n // 5 % 5 + 1)::INT] AS t FROM (SELECT *, substr(run_id, 5)::BIGINT AS n FROM runs))")
def _(spark, sf):
    n = F.substring("run_id", 5, 99).cast("long")
    names = F.array(*map(F.lit, _STATUSES))
    r = view(spark, sf, "runs").withColumns({"f": F.element_at(names, (n % 5 + 1).cast("int")), "t": F.element_at(names, (F.floor(n / 5) % 5 + 1).cast("int"))})
    evaluation = F.when(F.col("status") != "failed", F.col("run_id"))
    return r.select("run_id", decide.promotion(F.col("f"), F.col("t"), evaluation, F.col("status") == "completed").alias("refused"))


@query("c19_registry", "SELECT model_id, CASE WHEN model_id IN (SELECT upstream_id FROM runs WHERE status = 'completed') THEN 'VALIDATED' ELSE 'EXPERIMENTAL' END AS status FROM (SELECT DISTINCT upstream_id AS model_id FROM runs)")
def _(spark, sf):
    r = view(spark, sf, "runs")
    there = r.where("status = 'completed'").select(F.col("upstream_id").alias("model_id")).distinct().withColumn("status", F.lit("VALIDATED"))
    return decide.registered(there, r.select(F.col("upstream_id").alias("model_id")))


_CONFIG = "'{\"model\":{\"name\":\"m' || s_nationkey || '\",\"revision\":null},\"lora\":{\"r\":' || s_suppkey % {r} || ',\"alpha\":16,\"target_modules\":[\"q\",\"v\"]},\"quantization\":{\"bits\":4' || CASE WHEN s_suppkey % {q} = 0 THEN ',\"quant_type\":\"nf4\"' ELSE '' END || '}}'"


@query("d9_checkpoint_compatibility", "SELECT s_suppkey, changed, CASE WHEN changed <> '' THEN 'incompatible' WHEN s_suppkey % 3 = 0 AND s_suppkey % 2 = 1 THEN 'dataset_changed' WHEN s_suppkey % 3 = 0 THEN 'forced' ELSE 'resume' END AS verdict FROM (SELECT s_suppkey, concat_ws(',', CASE WHEN s_suppkey % 4 <> s_suppkey % 6 THEN 'lora.r' END, CASE WHEN (s_suppkey % 5 = 0) <> (s_suppkey % 7 = 0) THEN 'quantization.quant_type' END) AS changed FROM supplier)")
def _(spark, sf):
    s = table(spark, sf, "supplier")
    stored, now = (F.expr(_CONFIG.replace("{r}", str(r)).replace("{q}", str(q))) for r, q in ((4, 5), (6, 7)))
    out = s.select("s_suppkey", decide.changed_settings(stored, now).alias("c"))
    k = F.col("s_suppkey")
    return out.select("s_suppkey", F.array_join("c", ",").alias("changed"), decide.resumption(F.col("c"), k % 3 != 0, k % 2 == 0).alias("verdict"))


_SETTINGS = "(VALUES ('python_version'), ('cuda_version'), ('os')) k(setting)"


def environment(spark, sf, then: bool):
    """What was recorded of a run's environment (a supplier's), or what it is now."""
    names = F.explode(F.array(*map(F.lit, ("python_version", "cuda_version", "os")))).alias("setting")
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", names)
    lost = (F.col("setting") == "os") & (F.col("s_suppkey") % 5 == (1 if then else 2))
    moved = F.when((F.col("setting") == "cuda_version") & (F.col("s_suppkey") % 4 == 0) & F.lit(not then), "+").otherwise("")
    return rows.where(~lost).select("s_suppkey", "setting", F.concat("setting", F.col("s_nationkey").cast("string"), moved).alias("value"))


part("environments", f"SELECT s_suppkey, setting, CASE WHEN NOT (setting = 'os' AND s_suppkey % 5 = 1) THEN setting || s_nationkey END AS recorded, CASE WHEN NOT (setting = 'os' AND s_suppkey % 5 = 2) THEN setting || s_nationkey || CASE WHEN setting = 'cuda_version' AND s_suppkey % 4 = 0 THEN '+' ELSE '' END END AS current FROM supplier, {_SETTINGS}")


@query("d10_environment_diff", "SELECT * FROM environments WHERE recorded IS DISTINCT FROM current")
def _(spark, sf):
    return decide.environment_diffs(environment(spark, sf, True), environment(spark, sf, False), ["s_suppkey", "setting"])


@query("d10_reproducibility", "SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN NULL ELSE s_suppkey % 3 = 1 END AS config_matches, CASE s_suppkey % 4 WHEN 3 THEN NULL ELSE true END AS dataset_matches, n AS environment_diffs, s_suppkey % 3 <> 2 AND n = 0 AS reproducible FROM (SELECT s_suppkey, count(*) FILTER (recorded IS DISTINCT FROM current) AS n FROM environments GROUP BY s_suppkey)")
def _(spark, sf):
    k = F.col("s_suppkey")
    diffs = decide.environment_diffs(environment(spark, sf, True), environment(spark, sf, False), ["s_suppkey", "setting"]).groupBy("s_suppkey").agg(F.count("*").alias("environment_diffs"))
    runs = table(spark, sf, "supplier").select("s_suppkey", F.when(k % 3 == 0, F.lit(None)).otherwise(k % 3 == 1).cast("boolean").alias("config_matches"), F.when(k % 4 != 3, True).alias("dataset_matches"))
    runs = runs.join(diffs, "s_suppkey", "left").na.fill(0, ["environment_diffs"])
    return runs.withColumn("reproducible", decide.reproducible({"config": F.col("config_matches"), "dataset": F.col("dataset_matches")}, F.col("environment_diffs")))


_TRIES = "SELECT problem_id, generation_index, CASE WHEN has_result THEN NULL WHEN l % 7 = 0 THEN 'code_extraction' ELSE 'timeout' END AS error_type FROM (SELECT *, CAST(substr(problem_id, 2, 8) AS BIGINT) + generation_index AS l FROM evals) JOIN (SELECT unnest(range(1, 5)) AS try) ON try <= CASE WHEN has_result OR l % 7 = 0 THEN 1 ELSE l % 5 END WHERE l % 11 > 0"
part("attempts", _TRIES)


@query("r1_next_attempts", "SELECT problem_id, generation_index, count(t.problem_id) AS attempts, CASE WHEN count(t.problem_id) > 0 AND count(*) FILTER (t.problem_id IS NOT NULL AND error_type IS NULL) > 0 THEN 'settled' WHEN count(*) FILTER (error_type = 'code_extraction') > 0 THEN 'failed' WHEN count(t.problem_id) >= 3 THEN 'exhausted' ELSE 'try' END AS action FROM evals LEFT JOIN attempts t USING (problem_id, generation_index) GROUP BY problem_id, generation_index")
def _(spark, sf):
    e = view(spark, sf, "evals").withColumn("l", F.expr("CAST(substr(problem_id, 2, 8) AS BIGINT)") + F.col("generation_index"))
    tries = F.when(F.col("has_result") | (F.col("l") % 7 == 0), 1).otherwise((F.col("l") % 5).cast("int"))
    error = F.when(~F.col("has_result"), F.when(F.col("l") % 7 == 0, "code_extraction").otherwise("timeout"))
    attempts = e.where((F.col("l") % 11 > 0) & (tries > 0)).withColumn("try", F.explode(F.sequence(F.lit(1), tries))).select("problem_id", "generation_index", error.alias("error_type"))
    return decide.next_attempts(e, attempts, ["problem_id", "generation_index"])


@query("c14_interval_width", "SELECT s_suppkey, CASE WHEN s_suppkey % 4 > 0 THEN round(s_suppkey % 10 / 100.0, 9)::DOUBLE END AS width FROM supplier")
def _(spark, sf):
    k = F.col("s_suppkey")
    stored = F.when(k % 4 > 0, F.to_json(F.struct(F.lit(0.5).alias("lower"), (0.5 + k % 10 / 100.0).alias("upper"))))
    ci = F.from_json(F.coalesce(stored, F.lit("{}")), "lower double, upper double")
    return table(spark, sf, "supplier").select("s_suppkey", F.round(ci["upper"] - ci["lower"], 9).alias("width"))


@query("c16_wide_metrics", f"SELECT {', '.join(f"round(max(p{k}) FILTER (model_variant = '{v}'), 9) AS {v}_pass_at_{k}" for v in ('base', 'dpo') for k in (1, 5, 10))}, {', '.join(f"round(max({m}) FILTER (model_variant = '{v}'), 9) AS {v}_{m}" for v in ('base', 'dpo') for m in ('best', 'solved'))} FROM (SELECT model_variant, {', '.join(f'avg(CASE WHEN n >= {k} THEN {_at_k(k)} END) AS p{k}' for k in (1, 5, 10))}, avg(best) AS best, avg(solved::INT) AS solved FROM per_problem GROUP BY ALL)")
def _(spark, sf):
    at = [F.avg(F.when(F.col("n") >= k, S.pass_at_k("n", "c", k))).alias(f"pass_at_{k}") for k in (1, 5, 10)]
    wide = models.problems(spark, sf).groupBy().pivot("model_variant", ["base", "dpo"]).agg(*at, F.avg("best").alias("best"), F.avg(F.col("solved").cast("int")).alias("solved"))
    return wide.select(*[F.round(c, 9).alias(c) for c in wide.columns])


@query("c17_comparison_document", "SELECT '{\"base\":{\"problems\":' || count(*) || ',\"solved\":' || count(*) FILTER (bs) || '},\"dpo\":{\"problems\":' || count(*) || ',\"solved\":' || count(*) FILTER (ds) || '},\"paired\":{\"win\":' || count(*) FILTER (dc * bn > bc * dn) || ',\"tie\":' || count(*) FILTER (dc * bn = bc * dn) || ',\"loss\":' || count(*) FILTER (dc * bn < bc * dn) || '},\"pairs\":' || (SELECT count(*) FROM decided WHERE reason IS NULL) || '}' AS document FROM paired")
def _(spark, sf):
    p = metrics.paired(models.problems(spark, sf))
    sides = p.agg(*[F.struct(F.count("*").alias("problems"), F.count_if(f"{v}_solved").alias("solved")).alias(v) for v in ("base", "dpo")])
    wtl = metrics.win_tie_loss(p).select(F.struct("win", "tie", "loss").alias("paired"))
    n = pairs.accepted(candidates.decided(spark, sf)).agg(F.count("*").alias("pairs"))
    return sides.join(wtl).join(n).select(F.to_json(F.struct("base", "dpo", "paired", "pairs")).alias("document"))  # one row each
