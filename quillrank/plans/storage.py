"""Queries on sources, sinks and streams: what is written is read again."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillrank.functions import syntax
from quillrank.plans.registry import query
from quillrank.sources import inference, jsonl, scratch
from quillrank.sources.adapters import table, view
from quillrank.streaming import events


@query("s1_strict_scan", "SELECT 'bad JSON' AS issue, 1::BIGINT AS n UNION ALL SELECT 'not an object', 1 UNION ALL SELECT 'missing field', 1 UNION ALL SELECT 'unknown field', 1 UNION ALL SELECT 'good', (SELECT count(*) FROM nation)")
def _(spark, sf):
    good = table(spark, sf, "nation").select(F.to_json(F.struct("n_nationkey", "n_name")).alias("value"))
    bad = spark.createDataFrame([("{",), ("[1]",), ('{"n_name":"x"}',), ('{"n_nationkey":1,"n_name":"x","z":1}',)], "value string")
    good.unionByName(bad).write.text(path := scratch.folder(spark, "s1"))
    return jsonl.scan(spark, path, ["n_nationkey", "n_name"], ["n_nationkey", "n_name"]).groupBy(F.coalesce("issue", F.lit("good")).alias("issue")).agg(F.count("*").alias("n"))


@query("s2_torn_tail", "SELECT 1::BIGINT AS torn")
def _(spark, sf):
    path = scratch.folder(spark, "s2")
    table(spark, sf, "region").select("r_name").coalesce(1).write.text(path)
    table(spark, sf, "region").select("r_name").coalesce(1).write.mode("append").option("lineSep", "|").text(path)
    return jsonl.torn(spark, path).agg(F.count("*").alias("torn"))


@query("s4_append", "SELECT r_regionkey, r_name, 2::BIGINT AS times FROM region")
def _(spark, sf):
    path, r = scratch.folder(spark, "s4"), table(spark, sf, "region").select("r_regionkey", "r_name")
    jsonl.append(r, path)
    jsonl.append(r, path)
    return jsonl.read(spark, path, r.schema, r.columns).groupBy("r_regionkey", "r_name").agg(F.count("*").alias("times"))


@query("s6_document", "SELECT count(*) AS n FROM region")
def _(spark, sf):
    path = scratch.folder(spark, "s6")
    table(spark, sf, "region").agg(F.to_json(F.struct(F.count("*").alias("n"))).alias("value")).coalesce(1).write.text(path)
    return jsonl.document(spark, path, "n long")


@query("s8_typed_scan", "SELECT problem_id, category, difficulty FROM problems")
def _(spark, sf):
    path, p = scratch.folder(spark, "s8"), view(spark, sf, "problems").select("problem_id", "category", "difficulty")
    jsonl.replace(p, path)
    return jsonl.read(spark, path, p.schema, p.columns)


@query("s9_closed_decode", "SELECT event_id, (props::JSON ->> 'k')::BIGINT AS k, false AS unknown FROM events WHERE props IS NOT NULL")
def _(spark, sf):
    e = table(spark, sf, "events").where("props is not null")
    return e.select("event_id", F.from_json("props", "k long").getField("k").alias("k"), (F.size(F.array_except(F.json_object_keys("props"), F.array(F.lit("k")))) > 0).alias("unknown"))


@query("s15_metric_log", "SELECT stage, count(*) AS n, round(sum(cost), 2) AS cost FROM runs GROUP BY stage")
def _(spark, sf):
    path, r = scratch.folder(spark, "s15"), view(spark, sf, "runs").select("stage", "cost")
    jsonl.append(r, path)
    return spark.read.schema("stage string, cost double").json(path).groupBy("stage").agg(F.count("*").alias("n"), F.round(F.sum("cost"), 2).alias("cost"))


@query("s16_split_files", "SELECT difficulty AS split, count(*) AS n FROM problems GROUP BY difficulty")
def _(spark, sf):
    path = scratch.folder(spark, "s16")
    jsonl.replace(view(spark, sf, "problems").select("problem_id", "prompt", F.col("difficulty").alias("split")), path, ["split"])
    return spark.read.schema("problem_id string, prompt string, split string").json(path).groupBy("split").agg(F.count("*").alias("n"))


@query("s17_migrate", "SELECT strategy AS run_id, count(*) AS n, count(DISTINCT sha256(code)) AS hashes FROM evals GROUP BY strategy")
def _(spark, sf):
    path = scratch.folder(spark, "s17")
    flat = view(spark, sf, "evals").select(F.col("strategy").alias("run_id"), "candidate_id", "code")
    flat.withColumn("code_sha256", F.sha2("code", 256)).write.partitionBy("run_id").parquet(path)
    return spark.read.parquet(path).groupBy("run_id").agg(F.count("*").alias("n"), F.count_distinct("code_sha256").alias("hashes"))


@query("s18_cache", "SELECT digest, max(hit) AS hit FROM (SELECT sha256(code) AS digest, generation_index % 2 = 0 AS hit FROM candidates) GROUP BY digest")
def _(spark, sf):
    c = view(spark, sf, "candidates").select(F.sha2("code", 256).alias("digest"), "generation_index")
    store = c.where("generation_index % 2 = 0").select("digest", F.lit(True).alias("payload"))
    return jsonl.cached(c.select("digest").distinct(), store).select("digest", F.coalesce("payload", F.lit(False)).alias("hit"))


def mock_client():
    """Answers with the prompt's digest; prompts of an odd length fail, and a call with a certain prompt fails as a whole."""
    import hashlib

    def ask(prompts: list[str]) -> list:
        return [RuntimeError("odd") if len(p) % 2 else hashlib.sha256(p.encode()).hexdigest() for p in prompts]

    return ask


@query("s20_batch_inference", "SELECT problem_id, CASE WHEN length(prompt) % 2 = 0 THEN sha256(prompt) END AS output, CASE WHEN length(prompt) % 2 = 1 THEN 'RuntimeError: odd' END AS error FROM problems WHERE ordinal % 3 > 0")
def _(spark, sf):
    path, p = scratch.folder(spark, "s20"), view(spark, sf, "problems")
    jsonl.replace(p.select("problem_id", "prompt"), f"{path}/in")
    prompts = jsonl.read(spark, f"{path}/in", "problem_id string, prompt string")
    inference.generate(prompts, mock_client, "problem_id", done=p.where("ordinal % 3 = 0")).write.json(f"{path}/out")
    return jsonl.read(spark, f"{path}/out", "problem_id string, output string, error string")


@query("f9_check_syntax", "SELECT candidate_id, generation_index % 5 <> 0 AS syntax_valid FROM evals")
def _(spark, sf):
    e = view(spark, sf, "evals")
    return e.select("candidate_id", syntax.syntax_valid(F.when(F.col("generation_index") % 5 == 0, F.concat("code", F.lit(" ("))).otherwise(F.col("code"))).alias("syntax_valid"))


@query("f10_check_function_name", "SELECT candidate_id, generation_index % 2 = 0 AS name_valid FROM evals")
def _(spark, sf):
    e = view(spark, sf, "evals")
    return e.select("candidate_id", syntax.function_name_valid(F.col("code"), F.when(F.col("generation_index") % 2 == 0, "solve").otherwise("other")).alias("name_valid"))


@query("st1_append_resume", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def _(spark, sf):
    path = scratch.folder(spark, "st1")
    events.append(events.source(spark, sf), path)
    return events.append(events.source(spark, sf), path).groupBy("event_type").agg(F.count("*").alias("n"))


@query("st2_hourly_counts", "SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n FROM events GROUP BY ALL")
def _(spark, sf):
    return events.updated(events.hourly(events.source(spark, sf)), scratch.folder(spark, "st2"), ["hour", "event_type"])


@query("st3_first_seen", "SELECT user_id, event_type, event_id, nullif(first_value(event_id) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id), event_id) AS duplicate_of FROM events")
def _(spark, sf):
    found = events.first_seen(events.source(spark, sf), ["user_id", "event_type"], "event_id")
    return events.append(found, scratch.folder(spark, "st3"))
