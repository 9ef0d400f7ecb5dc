"""Queries on records: scalar functions, lookups, joins, sets, splits, validators, lineage, stage graphs."""

from __future__ import annotations

import random

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillrank.functions import scalars as S
from quillrank.operators import order
from quillrank.plans.registry import query
from quillrank.sources import scratch
from quillrank.sources.adapters import table, view

FENCE = "concat('```python', chr(10), code, chr(10), '```')"


@query("f1_sha256", "SELECT candidate_id, sha256(code) AS digest FROM candidates")
def _(spark, sf):
    return view(spark, sf, "candidates").select("candidate_id", S.sha256("code").alias("digest"))


@query("f2_candidate_id", "SELECT l_orderkey, l_linenumber, printf('p%d_c%03d', l_orderkey, l_linenumber) AS id FROM lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", S.candidate_id(F.concat(F.lit("p"), "l_orderkey"), "l_linenumber").alias("id"))


@query("f3_preference_id", "SELECT s_suppkey, 'pref_a' || s_suppkey || '__b' || s_nationkey AS id FROM supplier")
def _(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", S.preference_id(F.concat(F.lit("a"), "s_suppkey"), F.concat(F.lit("b"), "s_nationkey")).alias("id"))


@query("f4_test_case_id", "SELECT DISTINCT problem_id || '_' || test_case_id AS id FROM tests")
def _(spark, sf):
    return view(spark, sf, "tests").select(F.concat_ws("_", "problem_id", "test_case_id").alias("id")).distinct()


@query("f5_sample_index", "SELECT candidate_id, try_cast(nullif(regexp_extract(candidate_id, '_c([0-9]+)$', 1), '') AS BIGINT) - 1 AS sample_index FROM evals")
def _(spark, sf):
    return view(spark, sf, "evals").select("candidate_id", (S.candidate_ordinal("candidate_id") - 1).alias("sample_index"))


@query("f7_looks_like_code", "SELECT candidate_id, regexp_matches(code, '(?m)^[ \\t]*(?:async[ \\t]+def|def|class|import|from)[ \\t]') AS is_code FROM candidates")
def _(spark, sf):
    return view(spark, sf, "candidates").select("candidate_id", S.looks_like_code("code").alias("is_code"))


@query("f8_stripped", "SELECT turn, conv_id, length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS n FROM turns")
def _(spark, sf):
    return view(spark, sf, "turns").select("turn", "conv_id", F.length(S.stripped("text")).cast("long").alias("n"))


@query("f11_prompt", "SELECT problem_id, 'Write a function.' || chr(10) || prompt || chr(10) || 'Category: ' || category AS prompt FROM problems")
def _(spark, sf):
    return view(spark, sf, "problems").select("problem_id", F.concat_ws("\n", F.lit("Write a function."), "prompt", F.concat(F.lit("Category: "), "category")).alias("prompt"))


@query("f12_prompt_lineage", "SELECT problem_id, bool_and(generation_index % 97 <> 0) AS lineage_ok FROM candidates GROUP BY problem_id")
def _(spark, sf):
    c = view(spark, sf, "candidates").withColumn("stored", F.when(F.col("generation_index") % 97 == 0, F.lit("tampered")).otherwise(S.sha256("code")))
    return c.groupBy("problem_id").agg(F.bool_and(F.col("stored") == S.sha256("code")).alias("lineage_ok"))


@query("f13_strategy_cycle", "SELECT candidate_id, ['plain', 'stepwise', 'examples'][((generation_index - 1) % 3 + 1)::INT] AS strategy FROM evals")
def _(spark, sf):
    names = F.array(F.lit("plain"), F.lit("stepwise"), F.lit("examples"))
    return view(spark, sf, "evals").select("candidate_id", F.element_at(names, ((F.col("generation_index") - 1) % 3 + 1).cast("int")).alias("strategy"))


@query("f14_candidate_seed", "SELECT candidate_id, (('0x' || substr(sha256('42:' || problem_id || ':' || generation_index), 1, 16))::UBIGINT % 2147483647)::BIGINT AS seed FROM evals")
def _(spark, sf):
    return view(spark, sf, "evals").select("candidate_id", S.candidate_seed(42, "problem_id", "generation_index").alias("seed"))


@query("f16_line_and_char_count", "SELECT candidate_id, len(string_split(rtrim(code, chr(10)), chr(10))) AS lines, length(code) AS chars FROM evals")
def _(spark, sf):
    return view(spark, sf, "evals").select("candidate_id", S.line_count("code").alias("lines"), F.length("code").cast("long").alias("chars"))


@query("f18_tree_digest", "SELECT problem_id, sha256(string_agg(candidate_id || chr(0) || sha256(code) || chr(10), '' ORDER BY candidate_id)) AS digest FROM evals GROUP BY problem_id")
def _(spark, sf):
    line = F.concat("candidate_id", F.lit("\0"), S.sha256("code"), F.lit("\n"))
    return view(spark, sf, "evals").groupBy("problem_id").agg(S.sha256(F.array_join(F.array_sort(F.collect_list(line)), "")).alias("digest"))


@query("f20_cache_digest", "SELECT DISTINCT sha256(problem_id || '|' || model_variant || '|' || sample_index) AS digest, problem_id, model_variant, sample_index FROM model_evals")
def _(spark, sf):
    return view(spark, sf, "model_evals").select(S.sha256(F.concat_ws("|", "problem_id", "model_variant", "sample_index")).alias("digest"), "problem_id", "model_variant", "sample_index").distinct()


@query("f22_event_lines", "SELECT event_id, (props::JSON ->> 'k')::BIGINT AS k FROM events WHERE props IS NOT NULL")
def _(spark, sf):
    e = table(spark, sf, "events").where("props is not null").select("event_id", F.concat(F.lit("noise\nNONCE "), "props", F.lit("\nmore")).alias("out"))
    line = e.select("event_id", F.explode(F.split("out", r"\R")).alias("l")).where(F.col("l").startswith("NONCE "))
    return line.select("event_id", F.from_json(F.substring("l", 7, 1 << 20), "k long").getField("k").alias("k"))


@query("f24_iso_utc", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS at FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", S.iso_utc("ts").alias("at"))


@query("f25_duration", "SELECT run_id, date_diff('second', TIMESTAMP '1992-01-01', created_at) AS seconds FROM runs")
def _(spark, sf):
    return view(spark, sf, "runs").select("run_id", F.timestamp_diff("SECOND", F.lit("1992-01-01").cast("timestamp"), F.col("created_at")).alias("seconds"))


@query("f26_clamp", "SELECT l_orderkey, l_linenumber, count(*) AS n, min(greatest(0, least(1, l_quantity / 40))) AS v FROM lineitem GROUP BY ALL")
def _(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"), F.min(S.clamp(F.col("l_quantity") / 40)).alias("v"))


@query("f27_relative_change", "SELECT c_custkey, CASE WHEN c_acctbal <> 0 THEN round((c_acctbal + 1 - c_acctbal) / c_acctbal, 6) END AS change FROM customer")
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", F.round(S.relative_change(F.col("c_acctbal") + 1, "c_acctbal"), 6).alias("change"))


@query("f28_json_path", "SELECT event_id, props::JSON ->> '$.k' AS k FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("f29_binomial", "SELECT n, k, round(exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)))::BIGINT AS c FROM (SELECT unnest(range(1, 21)) AS n) JOIN (SELECT unnest(range(0, 21)) AS k) ON k <= n")
def _(spark, sf):
    nk = spark.range(1, 21).withColumnRenamed("id", "n").withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n"))))
    c = F.when(F.col("k") > 0, F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest("k", F.lit(1))), F.lit(1.0), lambda a, i: a * (F.col("n") - F.col("k") + i) / i)).otherwise(1.0)
    return nk.select("n", "k", F.round(c).cast("long").alias("c"))


@query("f30_text_table", "SELECT s_suppkey, rpad(s_name, 20, ' ') || '|' || printf('%10.2f', s_acctbal) AS line FROM supplier")
def _(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", F.concat(F.rpad("s_name", 20, " "), F.lit("|"), F.format_string("%10.2f", "s_acctbal")).alias("line"))


@query("f32_summary_sentence", "SELECT status, printf('%s: %.1f%% of runs', status, 100.0 * count(*) / (SELECT count(*) FROM runs)) AS sentence FROM runs GROUP BY status")
def _(spark, sf):
    n = view(spark, sf, "runs").groupBy("status").agg(F.count("*").alias("n"))
    return n.select("status", F.format_string("%s: %.1f%% of runs", F.col("status"), 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0)))).alias("sentence"))


@query("p1_training_record", "SELECT c_custkey AS problem_id, c_name AS prompt, c_mktsegment AS chosen, c_mktsegment || '!' AS rejected FROM customer")
def _(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("problem_id"), F.col("c_name").alias("prompt"), F.col("c_mktsegment").alias("chosen"), F.concat("c_mktsegment", F.lit("!")).alias("rejected"))


@query("p2_lookup", "SELECT candidate_id, sha256(code) AS digest FROM candidates WHERE problem_id = 'en:src0'")
def _(spark, sf):
    return view(spark, sf, "candidates").where(F.col("problem_id") == "en:src0").select("candidate_id", S.sha256("code").alias("digest"))


@query("p3_predicates", "SELECT candidate_id FROM evals WHERE strategy = 'R' AND problem_id = 'p00000007'")
def _(spark, sf):
    out = view(spark, sf, "evals")
    for column, value in (("strategy", "R"), ("problem_id", "p00000007")):
        out = out.where(F.col(column) == value) if value is not None else out
    return out.select("candidate_id")


@query("p27_decimal_bucket", "SELECT l_quantity, CASE round(l_quantity / 50, 9) WHEN 0.15 THEN '0.1' WHEN 0.25 THEN '0.2' WHEN 0.35 THEN '0.3' WHEN 0.85 THEN '0.8' WHEN 0.95 THEN '0.9' ELSE printf('%.1f', round(l_quantity / 50, 1)) END AS bucket FROM (SELECT DISTINCT l_quantity FROM lineitem)")
def _(spark, sf):
    return table(spark, sf, "lineitem").select("l_quantity").distinct().withColumn("bucket", S.rounded_bucket(F.round(F.col("l_quantity") / 50, 9)))


@query("p29_typed_equality", "SELECT event_id, coalesce(json_type(props::JSON -> 'k') = 'UBIGINT', false) AS is_number FROM events")
def _(spark, sf):
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json("props"), "$.k", "variant"))
    return table(spark, sf, "events").select("event_id", F.coalesce(kind == "BIGINT", F.lit(False)).alias("is_number"))


@query("w5_duplicate_of", "SELECT candidate_id, nullif(first_value(candidate_id) OVER (PARTITION BY problem_id, sha256(code) ORDER BY generation_index), candidate_id) AS duplicate_of FROM candidates")
def duplicate_of(spark, sf):
    first = F.first("candidate_id").over(Window.partitionBy("problem_id", S.sha256("code")).orderBy("generation_index"))
    return view(spark, sf, "candidates").select("candidate_id", F.nullif(first, F.col("candidate_id")).alias("duplicate_of"))


@query("w11_latest_run", "SELECT upstream_id, run_id FROM runs QUALIFY row_number() OVER (PARTITION BY upstream_id ORDER BY created_at DESC, run_id DESC) = 1")
def _(spark, sf):
    return view(spark, sf, "runs").groupBy("upstream_id").agg(F.max_by("run_id", F.struct("created_at", "run_id")).alias("run_id"))


@query("w12_reusable_stage", "SELECT stage, max(run_id) AS run_id FROM runs WHERE status = 'completed' GROUP BY stage")
def _(spark, sf):
    return view(spark, sf, "runs").where("status = 'completed'").groupBy("stage").agg(F.max("run_id").alias("run_id"))


@query("w13_latest_checkpoint", "SELECT c_nationkey, 'checkpoint-' || max(c_custkey) AS path FROM customer GROUP BY c_nationkey")
def _(spark, sf):
    c = table(spark, sf, "customer").select("c_nationkey", F.concat(F.lit("checkpoint-"), "c_custkey").alias("path"))
    return c.groupBy("c_nationkey").agg(F.max_by("path", F.regexp_extract("path", r"-(\d+)$", 1).cast("long")).alias("path"))


@query("o3_first_problems", "SELECT problem_id, prompt FROM problems ORDER BY problem_id LIMIT 25")
def _(spark, sf):
    return view(spark, sf, "problems").select("problem_id", "prompt").orderBy("problem_id").limit(25)


@query("o4_file_order", "SELECT position, problem_id FROM tests ORDER BY position LIMIT 30")
def _(spark, sf):
    return view(spark, sf, "tests").select("position", "problem_id").orderBy("position").limit(30)


@query("o8_smoke_split", "SELECT candidate_id, CASE WHEN r <= 4 THEN 'train' ELSE 'eval' END AS split FROM (SELECT candidate_id, row_number() OVER (ORDER BY candidate_id) AS r FROM evals ORDER BY candidate_id LIMIT 6)")
def _(spark, sf):
    six = view(spark, sf, "evals").select("candidate_id").orderBy("candidate_id").limit(6)
    return six.select("candidate_id", F.when(F.row_number().over(Window.orderBy("candidate_id")) <= 4, "train").otherwise("eval").alias("split"))


@query("j1_result_with_metadata", "SELECT e.candidate_id, e.strategy, e.tests_passed, p.category FROM evals e LEFT JOIN problems p USING (problem_id)")
def _(spark, sf):
    return view(spark, sf, "evals").join(view(spark, sf, "problems").select("problem_id", "category"), "problem_id", "left").select("candidate_id", "strategy", "tests_passed", "category")


@query("j2_candidate_problem_miss", "SELECT CASE WHEN p.problem_id IS NULL THEN 'problem_not_found' ELSE 'found' END AS outcome, count(*) AS n FROM evals e LEFT JOIN problems p USING (problem_id) GROUP BY ALL")
def _(spark, sf):
    p = view(spark, sf, "problems").select("problem_id", F.lit(1).alias("there"))
    return view(spark, sf, "evals").join(p, "problem_id", "left").groupBy(F.when(F.col("there").isNull(), "problem_not_found").otherwise("found").alias("outcome")).agg(F.count("*").alias("n"))


@query("j16_reconcile_tests", "SELECT p.problem_id, t.test_case_id, coalesce(e.status, 'error') AS status FROM (SELECT DISTINCT problem_id FROM tests) p CROSS JOIN (SELECT unnest(['click', 'error', 'view', 'never_sent']) AS test_case_id) t LEFT JOIN (SELECT problem_id, test_case_id, arg_max(status, position) AS status FROM tests GROUP BY ALL) e ON p.problem_id = e.problem_id AND t.test_case_id = e.test_case_id")
def _(spark, sf):
    from quillrank.operators.assess import reconciled

    t = view(spark, sf, "tests")
    names = F.array(*map(F.lit, ("click", "error", "view", "never_sent")))
    expected = t.select("problem_id").distinct().withColumn("test_case_id", F.explode(names))
    return reconciled(expected, t, ["problem_id", "test_case_id"]).select("problem_id", "test_case_id", "status")


@query("j17_completeness_grid", "SELECT problem_id, i AS generation_index FROM (SELECT DISTINCT problem_id FROM evals), (SELECT unnest(range(1, 5)) AS i) EXCEPT SELECT problem_id, generation_index FROM evals")
def missing(spark, sf):
    e = view(spark, sf, "evals").select("problem_id", "generation_index")
    grid = e.select("problem_id").distinct().withColumn("generation_index", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(4).cast("long"))))
    return grid.join(e, ["problem_id", "generation_index"], "left_anti")


@query("j19_prompt_existence", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_anti")


@query("j20_leakage", "SELECT DISTINCT doc_id FROM documents JOIN labels USING (doc_id) WHERE quality = 0")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels").where("quality = 0").select("doc_id"), "doc_id", "left_semi").distinct()


@query("j22_lineage", "SELECT o_orderkey, c_custkey, n_nationkey, r_regionkey FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def _(spark, sf):
    t = lambda n: table(spark, sf, n)
    out = t("orders").select("o_orderkey", "o_custkey")
    for name, left, right in (("customer", "o_custkey", "c_custkey"), ("nation", "c_nationkey", "n_nationkey"), ("region", "n_regionkey", "r_regionkey")):
        out = out.join(t(name), F.col(left) == F.col(right), "left")
    return out.select("o_orderkey", "c_custkey", "n_nationkey", "r_regionkey")


@query("j23_registry_metrics", "SELECT upstream_id AS model_id, run_id, cost FROM runs QUALIFY row_number() OVER (PARTITION BY upstream_id ORDER BY created_at DESC, run_id DESC) = 1")
def _(spark, sf):
    r = view(spark, sf, "runs")
    newest = r.groupBy("upstream_id").agg(F.max_by("run_id", F.struct("created_at", "run_id")).alias("run_id"))
    return newest.join(r.select("run_id", "cost"), "run_id", "left").select(F.col("upstream_id").alias("model_id"), "run_id", "cost")


@query("j26_pair_category", "SELECT category, count(*) AS n FROM evals JOIN problems USING (problem_id) WHERE trim(category) <> '' GROUP BY category")
def _(spark, sf):
    p = view(spark, sf, "problems").where(F.trim("category") != "").select("problem_id", "category")
    return view(spark, sf, "evals").join(p, "problem_id").groupBy("category").agg(F.count("*").alias("n"))


def split_of(n: int, seed: int = 42, ratios: tuple[float, float] = (0.8, 0.1)) -> list[str]:
    """The split of each of n sorted ids: a seeded shuffle, floored sizes, at least one to train on, and the rest to test."""
    order = list(range(n))
    random.Random(seed).shuffle(order)
    train = max(1, int(n * ratios[0])) if n else 0
    validation = int(n * ratios[1])
    out = ["test"] * n
    for place, k in enumerate(order):
        out[k] = "train" if place < train else "validation" if place < train + validation else "test"
    return out


def splits(spark, sf) -> DataFrame:
    """The split of each distinct problem id, as a table that is written. The shuffle is the driver's random numbers, over places in
    the sorted pool; the ids don't come to the driver."""
    pool = order.numbered(view(spark, sf, "problems").select("problem_id").distinct(), "problem_id", name="place", first=0)
    of = split_of(pool.count())
    places = spark.createDataFrame(pa.table({"place": pa.array(range(len(of)), pa.int64()), "split": pa.array(of, pa.string())}))
    pool.join(places, "place").select("problem_id", "split").write.parquet(path := scratch.folder(spark, "d1"))
    return spark.read.schema("problem_id string, split string").parquet(path)


def overlapping(split: DataFrame) -> DataFrame:
    """Problems that are in more than one split."""
    return split.groupBy("problem_id").agg(F.count_distinct("split").alias("n")).where("n > 1").select("problem_id")


@query("j27_split_membership", "SELECT count(*) AS n, count(*) AS with_split FROM problems")
def _(spark, sf):
    return view(spark, sf, "problems").join(splits(spark, sf), "problem_id", "left").agg(F.count("*").alias("n"), F.count("split").alias("with_split"))


@query("d8_truncation_gate", "SELECT round(avg((length(text) > 1000)::INT), 9) AS rate, avg((length(text) > 1000)::INT) <= 0.5 AS passes FROM turns")
def _(spark, sf):
    r = F.avg((F.length("text") > 1000).cast("int"))
    return view(spark, sf, "turns").agg(F.round(r, 9).alias("rate"), (r <= 0.5).alias("passes"))


@query("u1_settled_keys", "SELECT candidate_id FROM evals WHERE has_result UNION SELECT candidate_id FROM evals WHERE infrastructure_error")
def _(spark, sf):
    e = view(spark, sf, "evals")
    return e.where("has_result").select("candidate_id").union(e.where("infrastructure_error").select("candidate_id")).distinct()


@query("u2_resume", "SELECT candidate_id FROM evals EXCEPT SELECT candidate_id FROM evals WHERE has_result")
def _(spark, sf):
    e = view(spark, sf, "evals").select("candidate_id", "has_result")
    return e.select("candidate_id").join(e.where("has_result").select("candidate_id"), "candidate_id", "left_anti")


@query("u5_universe", "SELECT category FROM problems WHERE ordinal % 2 = 0 UNION SELECT category FROM problems WHERE ordinal % 3 = 0")
def _(spark, sf):
    p = view(spark, sf, "problems")
    return p.where("ordinal % 2 = 0").select("category").union(p.where("ordinal % 3 = 0").select("category")).distinct()


@query("u6_problem_pool", "SELECT DISTINCT problem_id FROM evals")
def _(spark, sf):
    return view(spark, sf, "evals").select("problem_id").distinct()


@query("u7_complete", "SELECT NOT EXISTS (SELECT problem_id FROM model_evals EXCEPT SELECT problem_id FROM problems) AS complete")
def _(spark, sf):
    left = view(spark, sf, "model_evals").select("problem_id").subtract(view(spark, sf, "problems").select("problem_id"))
    return left.agg((F.count("*") == 0).alias("complete"))


@query("u14_refined", "SELECT action, count(*) AS n FROM (SELECT CASE WHEN ordinal % 7 = 0 THEN 'remove_benchmark' WHEN l_discount < 0.02 THEN 'remove_low_margin' ELSE 'retain' END AS action FROM (SELECT l_partkey, l_discount FROM lineitem) JOIN problems ON ordinal = l_partkey) GROUP BY action")
def _(spark, sf):
    from quillrank.operators.analysis import refinement

    p = view(spark, sf, "problems")
    rows = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("ordinal"), F.col("l_discount").alias("score_margin")).join(p.select("ordinal", "problem_id"), "ordinal")
    rows = rows.withColumns({"chosen_sha256": F.lit("a"), "rejected_sha256": F.lit("b"), "rejected_correctness": F.lit("incorrect")})
    return refinement(rows, p.where("ordinal % 7 = 0"), 0.02).groupBy("action").agg(F.count("*").alias("n"))


@query("p23_refinement_plan", "SELECT ordinal AS problem, CASE WHEN ordinal % 7 = 0 THEN 'remove_benchmark' ELSE 'retain' END AS action FROM problems")
def _(spark, sf):
    from quillrank.operators.analysis import refinement

    p = view(spark, sf, "problems")
    rows = p.select("ordinal", "problem_id", F.lit(0.5).alias("score_margin"), F.lit("a").alias("chosen_sha256"), F.lit("b").alias("rejected_sha256"), F.lit("incorrect").alias("rejected_correctness"))
    return refinement(rows, p.where("ordinal % 7 = 0")).select(F.col("ordinal").alias("problem"), "action")


@query("a1_run_statistics", "SELECT strategy, count(*) AS n, count(*) FILTER (has_result) AS evaluated, count(*) FILTER (infrastructure_error) AS infrastructure, count(DISTINCT problem_id) AS problems FROM evals GROUP BY strategy")
def _(spark, sf):
    return view(spark, sf, "evals").groupBy("strategy").agg(F.count("*").alias("n"), F.count_if("has_result").alias("evaluated"), F.count_if("infrastructure_error").alias("infrastructure"), F.count_distinct("problem_id").alias("problems"))


@query("a31_training_curve", "SELECT stage, count(DISTINCT created_at) AS steps, arg_min(cost, created_at::VARCHAR || run_id) AS first_loss, arg_max(cost, created_at::VARCHAR || run_id) AS last_loss FROM runs GROUP BY stage")
def _(spark, sf):
    at = F.struct("created_at", "run_id")
    return view(spark, sf, "runs").groupBy("stage").agg(F.count_distinct("created_at").alias("steps"), F.min_by("cost", at).alias("first_loss"), F.max_by("cost", at).alias("last_loss"))


@query("a32_last_and_peak", "SELECT problem_id, arg_max(value, position) FILTER (value IS NOT NULL) AS last_value, max(value) AS peak FROM tests GROUP BY problem_id")
def _(spark, sf):
    last = F.max_by("value", F.when(F.col("value").isNotNull(), F.col("position")))
    return view(spark, sf, "tests").groupBy("problem_id").agg(last.alias("last_value"), F.max("value").alias("peak"))


@query("a33_stage_durations", "SELECT stage, sum(greatest(0, date_diff('second', p, created_at)))::BIGINT AS seconds FROM (SELECT stage, created_at, lag(created_at) OVER (PARTITION BY stage ORDER BY created_at, run_id) AS p FROM runs) GROUP BY stage")
def _(spark, sf):
    before = F.lag("created_at").over(Window.partitionBy("stage").orderBy("created_at", "run_id"))
    r = view(spark, sf, "runs").select("stage", "created_at", before.alias("p"))
    return r.groupBy("stage").agg(F.sum(F.greatest(F.lit(0).cast("long"), F.timestamp_diff("SECOND", F.col("p"), F.col("created_at")))).alias("seconds"))


@query("a38_experiment_metrics", "SELECT status, count(*) AS runs, round(sum(cost), 2) AS cost, count(DISTINCT stage) AS stages FROM runs GROUP BY status")
def _(spark, sf):
    return view(spark, sf, "runs").groupBy("status").agg(F.count("*").alias("runs"), F.round(F.sum("cost"), 2).alias("cost"), F.count_distinct("stage").alias("stages"))


@query("c3_sample_candidate_id", "SELECT DISTINCT problem_id || '_c' || lpad((sample_index + 1)::VARCHAR, 3, '0') AS id FROM model_evals")
def _(spark, sf):
    return view(spark, sf, "model_evals").select(S.candidate_id("problem_id", F.col("sample_index") + 1).alias("id")).distinct()


@query("c15_existing_keys", "SELECT DISTINCT problem_id, generation_index FROM evals")
def _(spark, sf):
    return view(spark, sf, "evals").select("problem_id", "generation_index").distinct()


@query("c18_artifact_reference", "SELECT lang AS path, sum(strlen(text))::BIGINT AS bytes, count(*) AS files FROM documents GROUP BY lang")
def _(spark, sf):
    return table(spark, sf, "documents").groupBy(F.col("lang").alias("path")).agg(F.sum(F.octet_length("text")).cast("long").alias("bytes"), F.count("*").alias("files"))


@query("c22_known_problems", "SELECT DISTINCT problem_id FROM evals WHERE problem_id NOT IN (SELECT problem_id FROM problems)")
def _(spark, sf):
    return view(spark, sf, "evals").select("problem_id").distinct().join(view(spark, sf, "problems").select("problem_id"), "problem_id", "left_anti")


@query("c25_mock_variant", "SELECT candidate_id, ('0x' || substr(sha256(code), 1, 2))::BIGINT % 1000 AS variant, ('0x' || substr(sha256(code), 3, 2))::BIGINT % 4 AS wrapper FROM candidates")
def _(spark, sf):
    byte = lambda at: F.conv(F.substring(S.sha256("code"), at, 2), 16, 10).cast("long")
    return view(spark, sf, "candidates").select("candidate_id", (byte(1) % 1000).alias("variant"), (byte(3) % 4).alias("wrapper"))


@query("c26_stamped_events", "SELECT event_id, 'run_1' AS run_id, event_type FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", F.lit("run_1").alias("run_id"), "event_type")


# Stages of the pipeline and what each needs.
STAGES = {"problems": (), "generation": ("problems",), "evaluation": ("generation",), "ranking": ("evaluation",), "preferences": ("ranking",), "training": ("preferences",), "model_evaluation": ("training",), "analysis": ("model_evaluation", "preferences"), "packaging": ("model_evaluation",)}


def edges(spark) -> DataFrame:
    return spark.createDataFrame([(a, b) for b, needs in STAGES.items() for a in needs], "stage string, dependent string")


_EDGES = "(VALUES " + ", ".join(f"('{a}', '{b}')" for b, needs in STAGES.items() for a in needs) + ") e(stage, dependent)"


@query("g1_topological_order", f"WITH RECURSIVE d AS (SELECT 'problems' AS stage, 0 AS depth UNION SELECT e.dependent, depth + 1 FROM d JOIN {_EDGES} ON d.stage = e.stage) SELECT stage, max(depth)::BIGINT AS level FROM d GROUP BY stage")
def _(spark, sf):
    from quillrank.plans.graph import levels

    return spark.createDataFrame(sorted(levels(STAGES).items()), "stage string, level long")


@query("g2_dependents", f"WITH RECURSIVE d AS (SELECT stage, dependent FROM {_EDGES} UNION SELECT d.stage, e.dependent FROM d JOIN {_EDGES} ON d.dependent = e.stage) SELECT stage, dependent FROM d")
def dependents(spark, sf):
    return spark.sql("WITH RECURSIVE d AS (SELECT stage, dependent FROM {e} UNION ALL SELECT d.stage, e.dependent FROM d JOIN {e} e ON d.dependent = e.stage) SELECT DISTINCT stage, dependent FROM d", e=edges(spark))


@query("g4_invalidated", "SELECT s AS stage FROM (SELECT unnest(['preferences', 'training', 'model_evaluation', 'analysis', 'packaging']) AS s)")
def _(spark, sf):
    return dependents(spark, sf).where("stage = 'preferences'").select(F.col("dependent").alias("stage")).union(spark.createDataFrame([("preferences",)], "stage string"))


@query("g6_blocked", "SELECT s AS stage FROM (SELECT unnest(['training', 'model_evaluation', 'analysis', 'packaging']) AS s)")
def _(spark, sf):
    done = spark.createDataFrame([("preferences",), ("ranking",)], "stage string")
    return dependents(spark, sf).where("stage = 'preferences'").select(F.col("dependent").alias("stage")).join(done, "stage", "left_anti")


@query("g7_work_list", "SELECT problem_id, i AS generation_index FROM (SELECT DISTINCT problem_id FROM evals), (SELECT unnest(range(1, 5)) AS i) EXCEPT SELECT problem_id, generation_index FROM evals")
def _(spark, sf):
    return missing(spark, sf)


@query("g9_status_board", "SELECT s AS stage, coalesce(max(r.status), 'PENDING') AS status FROM (SELECT unnest(['1-URGENT', '2-HIGH', 'never']) AS s) LEFT JOIN (SELECT * FROM runs WHERE status = 'completed') r ON s = r.stage GROUP BY s")
def _(spark, sf):
    names = spark.createDataFrame([("1-URGENT",), ("2-HIGH",), ("never",)], "stage string")
    done = view(spark, sf, "runs").where("status = 'completed'").groupBy("stage").agg(F.max("status").alias("status"))
    return names.join(done, "stage", "left").na.fill("PENDING", ["status"])


@query("g10_wide_lineage", "SELECT upstream_id, max(run_id) FILTER (status = 'completed') AS completed, max(run_id) FILTER (status = 'running') AS running, max(run_id) FILTER (status = 'failed') AS failed FROM runs GROUP BY upstream_id")
def _(spark, sf):
    return view(spark, sf, "runs").groupBy("upstream_id").pivot("status", ["completed", "running", "failed"]).agg(F.max("run_id"))
