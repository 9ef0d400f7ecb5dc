"""Queries on datasets: splits, hashes, benchmarks, catalogs, archives, lengths and reports."""

from __future__ import annotations

import json

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillrank.functions import scalars as S
from quillrank.operators import assess, lengths, order, pairs
from quillrank.plans import candidates, records, validators  # noqa: F401  its tables are reported on
from quillrank.plans.registry import part, query
from quillrank.sources import archive, config, jsonl, scratch
from quillrank.sources.adapters import table, view

FORMS = (
    ("'Sure:' || chr(10) || '```text' || chr(10) || 'no' || chr(10) || '```' || chr(10) || '```python' || chr(10) || code || chr(10) || '```' || chr(10) || 'Done'", "python_fence"), ("'```python3' || chr(10) || code || chr(10) || '```'", "python_fence"),
    ("'x ``` python ' || chr(13) || chr(10) || code || chr(10) || '```'", "python_fence"), ("'```PY' || chr(10) || chr(10) || code || '  ' || chr(10) || '```'", "python_fence"),
    ("'```python' || chr(10) || ' ' || chr(10) || '```' || chr(10) || '```py' || chr(10) || code || '```'", "python_fence"), ("'Here' || chr(10) || '```' || chr(10) || code || chr(10) || '```'", "generic_fence"),
    ("'```' || chr(10) || 'prose' || chr(10) || '```' || chr(10) || '``` ' || chr(10) || code || '```'", "generic_fence"), ("chr(10) || code || '  ' || chr(10)", "plain"), ("'```python' || chr(10) || code", None), ("'```js' || chr(10) || code || chr(10) || '```'", None),
    ("'no code here'", None), ("''", None),
)


@query("f6_extract_code", "SELECT candidate_id, CASE WHEN f <> 'unknown' THEN code END AS extracted, f AS format FROM (SELECT candidate_id, code, CASE (generation_index + l_) % 12 " + " ".join(f"WHEN {i} THEN '{f or 'unknown'}'" for i, (_, f) in enumerate(FORMS)) + " END AS f FROM (SELECT *, CAST(substr(problem_id, 2, 8) AS BIGINT) AS l_ FROM evals))")
def _(spark, sf):
    which = (F.col("generation_index") + F.expr("CAST(substr(problem_id, 2, 8) AS BIGINT)")) % len(FORMS)
    forms = F.array(*[F.expr(sql) for sql, _ in FORMS])
    return view(spark, sf, "evals").select("candidate_id", S.extracted_code(F.get(forms, which.cast("int"))).alias("x")).select("candidate_id", F.col("x.code").alias("extracted"), F.col("x.format").alias("format"))


part("failures", "SELECT candidate_id, CASE CAST(substr(problem_id, 2, 8) AS BIGINT) % 3 WHEN 0 THEN 'model_load' ELSE 'timeout' END AS error_type FROM evals WHERE NOT has_result AND CAST(substr(problem_id, 2, 8) AS BIGINT) % 3 < 2")


@query("p6_missing_evidence", "SELECT candidate_id, correctness, CASE WHEN NOT has_result THEN coalesce(error_type, 'missing_evaluation_result') ELSE indeterminate_reason END AS reason FROM assessed LEFT JOIN failures USING (candidate_id)")
def _(spark, sf):
    e = view(spark, sf, "evals")
    n = F.expr("CAST(substr(problem_id, 2, 8) AS BIGINT)")
    failures = e.where(~F.col("has_result") & (n % 3 < 2)).select("candidate_id", F.when(n % 3 == 0, "model_load").otherwise("timeout").alias("error_type"))
    return assess.assess(e, failures).select("candidate_id", "correctness", F.col("indeterminate_reason").alias("reason"))


# splits

def _letters(n: int) -> str:
    return "".join({"train": "a", "validation": "b", "test": "c"}[s] for s in records.split_of(n))


@query("d1_problem_split", "SELECT problem_id, CASE substr(CASE n " + " ".join(f"WHEN {n} THEN '{_letters(n)}'" for n in (200, 2000)) + " END, place, 1) WHEN 'a' THEN 'train' WHEN 'b' THEN 'validation' WHEN 'c' THEN 'test' END AS split FROM (SELECT problem_id, row_number() OVER (ORDER BY problem_id) AS place, count(*) OVER () AS n FROM (SELECT DISTINCT problem_id FROM problems))")
def _(spark, sf):
    return records.splits(spark, sf)


@query("d1_split_sizes", "SELECT split, CASE split WHEN 'train' THEN greatest(1, floor(n * 0.8)) WHEN 'validation' THEN floor(n * 0.1) ELSE n - greatest(1, floor(n * 0.8)) - floor(n * 0.1) END::BIGINT AS n FROM (SELECT count(DISTINCT problem_id) AS n FROM problems), (SELECT unnest(['train', 'validation', 'test']) AS split)")
def _(spark, sf):
    return records.splits(spark, sf).groupBy("split").agg(F.count("*").alias("n"))


@query("d2_ratio_validation", "SELECT p_partkey, p_size % 5 <> 0 AND 0.8 + (p_size % 4) / 20.0 + 0.1 BETWEEN 1 - 1e-6 AND 1 + 1e-6 AS valid FROM part")
def _(spark, sf):
    size = F.col("p_size")
    names = F.when(size % 5 == 0, F.array(F.lit("train"), F.lit("valid"), F.lit("test"))).otherwise(F.array(F.lit("train"), F.lit("validation"), F.lit("test")))
    ratios = F.map_from_arrays(names, F.array(F.lit(0.8), size % 4 / 20.0, F.lit(0.1)))
    return table(spark, sf, "part").select("p_partkey", S.valid_ratios(ratios).alias("valid"))


@query("j21_leakage_guard", "SELECT count(DISTINCT problem_id) AS leaked FROM decided WHERE reason IS NULL AND problem_id IN (SELECT problem_id FROM problems WHERE ordinal % 7 = 0)")
def _(spark, sf):
    from quillrank.plans.composites import leaked

    return leaked(pairs.accepted(candidates.decided(spark, sf)), view(spark, sf, "problems").where("ordinal % 7 = 0"))


# hashes

_JSON = "'{\"category\": \"' || category || '\", \"difficulty\": \"' || difficulty || '\", \"id\": \"' || problem_id || '\", \"prompt\": \"' || prompt || '\"}'"


def dataset_hash(problems):
    """The digest of the problems' JSON, with sorted keys, in the order of their ids."""
    fields = S.canonical_json({"id": F.col("problem_id"), "prompt": F.col("prompt"), "category": F.col("category"), "difficulty": F.col("difficulty")})
    return order.digest(problems.select("problem_id", fields.alias("j")), "j", "problem_id", "[", ", ", "]", lambda v: json.dumps(json.loads(v), sort_keys=True, ensure_ascii=False), "dataset_hash")


@query("f19_dataset_hash", f"SELECT sha256('[' || string_agg({_JSON}, ', ' ORDER BY problem_id) || ']') AS dataset_hash FROM problems")
def _(spark, sf):
    return dataset_hash(view(spark, sf, "problems"))


@query("d6_benchmark_drift", """SELECT (SELECT count(*) FROM problems WHERE ordinal % 7 = 0) AS n, 1::BIGINT AS unknown, (SELECT count(DISTINCT ordinal % 2) FROM problems WHERE ordinal % 7 = 0) AS versions,
  (SELECT sha256(string_agg(problem_id, ',' ORDER BY problem_id)) FROM problems WHERE ordinal % 7 = 0) AS dataset_hash, true AS drifted""")
def _(spark, sf):
    p = view(spark, sf, "problems").where("ordinal % 7 = 0").withColumn("version", F.col("ordinal") % 2)
    listed = p.select("problem_id").unionByName(spark.createDataFrame([("p_no_such",)], "problem_id string"))
    n = p.agg(F.count("*").alias("n"), F.count_distinct("version").alias("versions"))
    unknown = listed.join(p, "problem_id", "left_anti").agg(F.count("*").alias("unknown"))
    now, before = (order.digest(x, "problem_id", between=",", name=k) for x, k in ((p, "dataset_hash"), (p.where("ordinal <> 7"), "before")))
    return n.join(unknown).join(now).join(before).select("n", "unknown", "versions", "dataset_hash", (F.col("dataset_hash") != F.col("before")).alias("drifted"))  # one row each


@query("f17_canonical_json", "SELECT n_nationkey, sha256('{\"a\":null,\"name\":\"' || n_name || '\",\"region\":' || n_regionkey || '}') AS digest FROM nation")
def _(spark, sf):
    return table(spark, sf, "nation").select("n_nationkey", S.sha256(S.canonical_json({"region": F.col("n_regionkey"), "name": F.col("n_name"), "a": F.lit(None).cast("string")})).alias("digest"))


_KEY = "sha256('{\"code_version\":\"c' || length(stage) || '\",\"configuration_hash\":\"' || sha256(upstream_id) || '\",\"input_hashes\":{\"candidates\":\"' || substr(run_id, 5) || '\",\"problems\":\"' || substr(upstream_id, 4) || '\"},\"model_version\":\"m1\",\"stage\":\"' || stage || '\"}')"


def cache_keys(runs):
    """runs with cache_key: equal work has one key, in whatever order inputs and settings are named."""
    inputs = F.struct(F.substring("run_id", 5, 99).alias("candidates"), F.substring("upstream_id", 4, 99).alias("problems"))
    fields = {"stage": F.col("stage"), "input_hashes": inputs, "configuration_hash": S.sha256("upstream_id"), "code_version": F.concat(F.lit("c"), F.length("stage")), "model_version": F.lit("m1")}
    return runs.withColumn("cache_key", S.sha256(S.canonical_json(fields)))


@query("f21_cache_key", f"SELECT run_id, {_KEY} AS cache_key FROM runs")
def _(spark, sf):
    return cache_keys(view(spark, sf, "runs")).select("run_id", "cache_key")


@query("g5_reusable", "SELECT run_id, status = 'completed' AND substr(run_id, 13, 1) <> '3' AS reusable FROM runs")
def _(spark, sf):
    now = cache_keys(view(spark, sf, "runs"))
    kept = now.select(F.col("run_id").alias("_id"), F.col("status").alias("_status"), F.when(F.substring("run_id", 13, 1) == "3", "stale").otherwise(F.col("cache_key")).alias("_key"))
    reusable = (F.col("_status") == "completed") & (F.col("_key") == F.col("cache_key"))
    return now.join(kept, F.col("run_id") == F.col("_id"), "left").select("run_id", F.coalesce(reusable, F.lit(False)).alias("reusable"))


@query("f23_run_id", "SELECT run_id, 'eval_' || strftime(created_at, '%Y%m%d_%H%M%S') || '_' || substr(sha256(run_id), 1, 4) AS minted FROM runs")
def _(spark, sf):
    return view(spark, sf, "runs").select("run_id", S.minted_id("eval", "created_at", S.sha256("run_id")).alias("minted"))


# catalogs and archives


@query("s11_problem_catalog", "SELECT * FROM (VALUES " + ", ".join(f"('{i}', '{c}', '{d}')" for i, c, d, _ in config.CATALOG) + ") c(problem_id, category, difficulty)")
def _(spark, sf):
    path = scratch.folder(spark, "s11")
    rows = spark.createDataFrame(list(config.CATALOG), "problem_id string, category string, difficulty string, signature string")
    jsonl.replace(rows, path)
    return jsonl.read(spark, path, rows.schema, rows.columns).select("problem_id", "category", "difficulty")


@query("s12_run_catalog", "SELECT run_id, left(created_at::VARCHAR, 10) AS day FROM runs ORDER BY created_at DESC, run_id DESC")
def _(spark, sf):
    path, r = scratch.folder(spark, "s12"), view(spark, sf, "runs").select("run_id", F.col("created_at").cast("string").alias("created_at"), "status")
    jsonl.replace(r, path, ["status"])
    return jsonl.listed(spark.read.schema(r.schema).json(path)).select("run_id", F.substring("created_at", 1, 10).alias("day"))


@query("s13_layered_config", "SELECT 'ranking.margin' AS key, '0.3' AS value UNION ALL SELECT 'ranking.policy', 'strict' UNION ALL SELECT 'smoke', 'true'")
def _(spark, sf):
    layers = config.overridden({"ranking": {"margin": 0.2, "policy": "strict"}, "smoke": False}, ["ranking.margin=0.3", "smoke=true"])
    return spark.createDataFrame([(k, json.dumps(v) if not isinstance(v, str) else v) for k, v in config.flat(layers).items()], "key string, value string")


@query("s19_archive_listing", "SELECT count(*) AS files, true AS digests_agree, count(*) AS listed FROM region")
def _(spark, sf):
    path = scratch.folder(spark, "s19")
    table(spark, sf, "region").repartition("r_regionkey").write.option("maxRecordsPerFile", 1).json(f"{path}/run")
    archive.pack(spark, f"{path}/run", f"{path}/run.tar.gz", "run")
    manifest = archive.inspect(spark, f"{path}/run.tar.gz")
    told = spark.createDataFrame(list(manifest["files"].items()), "file string, sha256 string").where("file like '%.json'")
    there = archive.contents(spark, f"{path}/run").select("file", F.col("sha256").alias("now"))
    return told.join(there, "file", "left").agg(F.count("*").alias("files"), F.bool_and(F.col("sha256").eqNullSafe(F.col("now"))).alias("digests_agree"), F.count("now").alias("listed"))


@query("s21_chat_arrays", "SELECT conv_id, turn, role, sha256(text) AS content, CASE WHEN role = 'user' THEN 1 ELSE 0 END::BIGINT AS prompts FROM turns")
def _(spark, sf):
    chat = S.chat_array("role", "text")
    got = view(spark, sf, "turns").select("conv_id", "turn", chat.alias("c"))
    prompts = F.size(F.filter("c", lambda m: m["role"] == "user")).cast("long")
    return got.select("conv_id", "turn", F.get("c", F.lit(0))["role"].alias("role"), S.sha256(F.get("c", F.lit(0))["content"]).alias("content"), prompts.alias("prompts"))


# order


@query("o2_newest_runs", "SELECT run_id, created_at FROM runs ORDER BY created_at DESC, run_id DESC")
def _(spark, sf):
    return view(spark, sf, "runs").select("run_id", "created_at").orderBy(F.desc("created_at"), F.desc("run_id"))


@query("o7_problem_order", "SELECT problem_id, row_number() OVER (ORDER BY problem_id) AS position FROM problems")
def _(spark, sf):
    return order.numbered(view(spark, sf, "problems").select("problem_id"), "problem_id")


@query("o9_pair_table", "SELECT preference_id, strength FROM decided WHERE reason IS NULL ORDER BY preference_id")
def _(spark, sf):
    return pairs.accepted(candidates.decided(spark, sf)).select("preference_id", "strength").orderBy("preference_id")


@query("w10_problem_seeds", "SELECT DISTINCT problem_id, sample_index, 42 + (dense_rank() OVER (ORDER BY problem_id) - 1) * 1000 + sample_index AS seed FROM model_evals WHERE model_variant = 'base'")
def _(spark, sf):
    e = view(spark, sf, "model_evals").where("model_variant = 'base'").select("problem_id", "sample_index")
    ordinal = order.numbered(e.select("problem_id").distinct(), "problem_id", name="o", first=0)
    return e.join(ordinal, "problem_id").select("problem_id", "sample_index", (42 + F.col("o") * 1000 + F.col("sample_index")).alias("seed"))


# lengths and reports

part("preference_records", "SELECT u.conv_id, u.turn, u.text AS prompt, a.text AS chosen, substr(a.text, 1, length(a.text) // 2) AS rejected FROM turns u JOIN turns a ON u.conv_id = a.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant'")
_TOKENS = "len(regexp_extract_all({c}, '[^ \\t\\n\\r]+'))"
part("record_lengths", "SELECT " + ", ".join(f"{_TOKENS.format(c=c)} AS {c}" for c in ("prompt", "chosen", "rejected")) + " FROM preference_records")
_SERIES = "SELECT 'prompt' AS series, prompt AS v FROM record_lengths UNION ALL SELECT 'chosen', chosen FROM record_lengths UNION ALL SELECT 'rejected', rejected FROM record_lengths UNION ALL SELECT 'prompt_chosen', prompt + chosen FROM record_lengths UNION ALL SELECT 'prompt_rejected', prompt + rejected FROM record_lengths"


def preference_records(spark, sf):
    t = view(spark, sf, "turns")
    a = t.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("chosen"))
    half = F.floor(F.length("chosen") / 2).cast("int")
    return t.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("prompt")).join(a, ["conv_id", "turn"]).withColumn("rejected", F.substring(F.col("chosen"), F.lit(1), half))


@query("a9_lengths", "SELECT series, " + ", ".join(f"max(v) FILTER (r = greatest(1, least(n, round_even({p} * n / 100.0, 0)::BIGINT))) AS p{p}" for p in lengths.PERCENTS) + f", max(v) AS max, round(avg(v), 9) AS mean FROM (SELECT series, v, row_number() OVER (PARTITION BY series ORDER BY v) AS r, count(*) OVER (PARTITION BY series) AS n FROM ({_SERIES})) GROUP BY series")
def _(spark, sf):
    return lengths.distributions(lengths.measured(preference_records(spark, sf))).withColumn("mean", F.round("mean", 9))


@query("a9_truncation", "SELECT count(*) AS examples, count(*) FILTER (prompt + chosen > 150 OR prompt + rejected > 150) AS truncated, count(*) FILTER (prompt > 60) AS prompt_overflow, round(avg((prompt + chosen > 150 OR prompt + rejected > 150)::INT), 9) AS rate FROM record_lengths")
def _(spark, sf):
    return lengths.truncation(lengths.measured(preference_records(spark, sf)), 150, 60).withColumn("rate", F.round("rate", 9))


@query("a9_characters", "SELECT sum(length(prompt))::BIGINT AS prompt, sum(length(chosen))::BIGINT AS chosen, sum(length(rejected))::BIGINT AS rejected FROM preference_records")
def _(spark, sf):
    sizes = lengths.measured(preference_records(spark, sf), lambda t: F.length(t).cast("long"))  # another tokenizer
    return sizes.agg(*[F.sum(f"n_{c}").alias(c) for c in lengths.SERIES[:3]])


@query("a30_dataset_report", "SELECT category, count(*) AS problems, sum(p)::BIGINT AS passed, sum(f)::BIGINT AS failed, count(*) FILTER (f = 0 AND p >= 5) AS valid, row_number() OVER (ORDER BY min(ordinal)) AS place FROM (SELECT problem_id, category, p.ordinal, count(*) FILTER (passed) AS p, count(*) FILTER (NOT passed) AS f FROM problems p JOIN stored_cases USING (problem_id) GROUP BY ALL) GROUP BY category")
def _(spark, sf):
    p = view(spark, sf, "problems")
    o, i = F.col("ordinal"), F.col("i")
    cases = p.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(6)))).where(~((o % 71 == 6) & (i > 4))).withColumn("passed", ~((o % 73 == 5) & (i == 3)))
    per = cases.groupBy("problem_id", "category", "ordinal").agg(F.count_if("passed").alias("p"), F.count_if(~F.col("passed")).alias("f"))
    report = per.groupBy("category").agg(F.count("*").alias("problems"), F.sum("p").alias("passed"), F.sum("f").alias("failed"), F.count_if((F.col("f") == 0) & (F.col("p") >= 5)).alias("valid"), F.min("ordinal").alias("first"))
    return report.withColumn("place", F.row_number().over(Window.orderBy("first")).cast("long")).drop("first")  # a row for each category, in their first appearance's order


@query("t1_test_explosion", "SELECT problem_id, problem_id || '_t' || lpad(i::VARCHAR, 2, '0') AS test_case_id, (ordinal * i)::BIGINT AS input FROM problems, (SELECT unnest(range(1, 4)) AS i)")
def _(spark, sf):
    tests = F.transform(F.sequence(F.lit(1).cast("long"), F.lit(3).cast("long")), lambda i: F.struct(F.format_string("t%02d", i).alias("id"), (F.col("ordinal") * i).alias("input")))
    return view(spark, sf, "problems").select("problem_id", F.inline(tests)).select("problem_id", F.concat_ws("_", "problem_id", "id").alias("test_case_id"), "input")
