"""Domain tables over the driver's tables.

The driver's tables hold no candidates or tests, so each domain table is a projection of one of them, in SQL that Spark and DuckDB
both run: the operators and their oracles start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"

#: Candidates of a problem (an order) with their test evidence. Some have no result, some an infrastructure error or a timeout.
EVALS = f"""
SELECT problem_id, concat(problem_id, '_c', lpad(concat('', n), 3, '0')) AS candidate_id, CAST(n AS BIGINT) AS generation_index, strategy, code, has_result,
  CAST(CASE WHEN has_result AND NOT infra THEN 10 ELSE 0 END AS BIGINT) AS tests_total,
  CAST(CASE WHEN has_result AND NOT infra THEN p ELSE 0 END AS BIGINT) AS tests_passed,
  CAST(CASE WHEN has_result AND NOT infra THEN 10 - p - least(10 - p, e) ELSE 0 END AS BIGINT) AS tests_failed,
  CAST(CASE WHEN has_result AND NOT infra THEN least(10 - p, e) ELSE 0 END AS BIGINT) AS tests_error,
  CAST(0 AS BIGINT) AS tests_skipped, has_result AND NOT infra AND late AND p < 10 AS timeout, has_result AND infra AS infrastructure_error, duration_ms
FROM (
  SELECT concat('p', lpad(concat('', l_orderkey), 8, '0')) AS problem_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) AS n,
    l_returnflag AS strategy, concat('def solve():', chr(10), '    return ', mod(l_partkey, 5)) AS code, mod(l_suppkey, 11) <> 0 AS has_result,
    l_tax < 0.005 AS infra, l_tax > 0.075 AS late, CAST(round(l_discount * 100) AS BIGINT) AS p, mod(l_linenumber, 3) AS e, CAST(l_quantity AS BIGINT) * 10 AS duration_ms
  FROM {{lineitem}}
) AS l
"""

#: Samples of two model variants for a problem (a part), evaluated.
MODEL_EVALS = f"""
SELECT problem_id, model_variant, CAST(n - 1 AS BIGINT) AS sample_index, concat(problem_id, '_c', lpad(concat('', n), 3, '0')) AS candidate_id,
  CASE WHEN infra THEN 'infrastructure_error' WHEN late AND p < 5 THEN 'timeout' WHEN p = 5 THEN 'passed' WHEN p = 0 AND e = 0 THEN 'syntax_error' ELSE 'failed' END AS status,
  CAST(CASE WHEN infra THEN 0 ELSE 5 END AS BIGINT) AS tests_total, CAST(CASE WHEN infra THEN 0 ELSE p END AS BIGINT) AS tests_passed,
  CAST(CASE WHEN infra THEN 0 ELSE 5 - p - least(5 - p, e) END AS BIGINT) AS tests_failed, CAST(CASE WHEN infra THEN 0 ELSE least(5 - p, e) END AS BIGINT) AS tests_error,
  CASE WHEN e = 2 THEN 'ImportError' WHEN e = 1 THEN 'TypeError' END AS test_error, duration_ms, generated_tokens, code, syntax_valid,
  CASE WHEN gone THEN 'generation_error' ELSE 'generated' END AS generation_status
FROM (
  SELECT concat('p', lpad(concat('', l_partkey), 8, '0')) AS problem_id, CASE WHEN l_linestatus = 'O' THEN 'base' ELSE 'dpo' END AS model_variant,
    row_number() OVER (PARTITION BY l_partkey, l_linestatus ORDER BY l_orderkey, {_LINE_ORDER}) AS n, l_tax < 0.005 AS infra, l_tax > 0.075 AS late,
    least(5, CAST(round(l_discount * 100) AS BIGINT)) AS p, mod(l_linenumber, 3) AS e, CAST(l_quantity AS BIGINT) * 10 AS duration_ms,
    CAST(20 + mod(l_suppkey, 50) AS BIGINT) AS generated_tokens, concat('def solve():', chr(10), '    return ', mod(l_orderkey, 4)) AS code, mod(l_suppkey, 9) <> 0 AS syntax_valid,
    mod(l_suppkey, 13) = 0 AS gone
  FROM {{lineitem}}
) AS l
"""

#: Outcomes of single tests: a user's events of one type are the runs of a test case.
TESTS = """
SELECT concat('p', lpad(concat('', user_id), 6, '0')) AS problem_id, CASE WHEN mod(event_id, 2) = 0 THEN 'base' ELSE 'dpo' END AS model_variant, event_type AS test_case_id,
  event_id AS position, CASE WHEN event_type = 'error' THEN 'error' WHEN event_type = 'click' OR value > 60 THEN 'failed' ELSE 'passed' END AS status,
  CASE WHEN event_type = 'error' THEN CASE mod(event_id, 5) WHEN 0 THEN 'TypeError' WHEN 1 THEN 'KeyError' WHEN 2 THEN 'Failed' WHEN 3 THEN 'MemoryError' ELSE 'IndexError' END
    WHEN event_type = 'click' OR value > 60 THEN 'AssertionError' END AS error_type, value, props
FROM {events}
"""

#: Candidates with their texts; a problem is a language and a source.
CANDIDATES = """
SELECT concat(lang, ':', source) AS problem_id, concat('d', lpad(concat('', doc_id), 9, '0')) AS candidate_id, doc_id AS generation_index, source AS strategy, text AS code, n_chars
FROM {documents}
"""

#: Categories of problems: a part's brand.
PROBLEMS = """
SELECT concat('p', lpad(concat('', p_partkey), 8, '0')) AS problem_id, p_brand AS category, CASE WHEN p_size < 17 THEN 'easy' WHEN p_size < 34 THEN 'medium' ELSE 'hard' END AS difficulty,
  p_name AS prompt, p_partkey AS ordinal FROM {part}
"""

#: Runs: an order is a run, its customer the run that it came from.
RUNS = """
SELECT concat('run_', lpad(concat('', o_orderkey), 9, '0')) AS run_id, concat('up_', lpad(concat('', o_custkey), 7, '0')) AS upstream_id,
  CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'running' ELSE 'failed' END AS status, o_orderdate AS created_at, o_orderpriority AS stage, o_totalprice AS cost
FROM {orders}
"""

#: Prompt and response records.
TURNS = "SELECT conv_id, turn, role, text FROM {conversations}"

VIEWS = {"evals": (EVALS, "lineitem"), "model_evals": (MODEL_EVALS, "lineitem"), "tests": (TESTS, "events"), "candidates": (CANDIDATES, "documents"), "problems": (PROBLEMS, "part"), "runs": (RUNS, "orders"), "turns": (TURNS, "conversations")}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the domain tables."""
    sql, source = VIEWS[name]
    return spark.sql(sql, **{source: table(spark, sf_dir, source)})
