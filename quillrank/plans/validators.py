"""Queries that validate stored artifacts. What is stored was tampered with, by rules that Spark and the SQL both apply to sound
tables: a validator has something to find, and the SQL finds it in another way."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillrank.functions import scalars as S
from quillrank.operators import pairs, validate
from quillrank.plans import candidates, records
from quillrank.plans.registry import part, query
from quillrank.sources.adapters import table, view

#: A problem's number, and what is done to some of them.
_N = "CAST(substr(problem_id, 2, 8) AS BIGINT)"
ASSESSED = {
    "score": f"CASE WHEN {_N} % 97 = 1 AND generation_index = 1 THEN score + 0.05 ELSE score END",
    "correctness": f"CASE WHEN {_N} % 89 = 2 AND generation_index = 1 AND correctness = 'incorrect' THEN 'correct' ELSE correctness END",
    "tests_failed": f"CASE WHEN {_N} % 83 = 3 AND generation_index = 1 THEN tests_failed + 1 ELSE tests_failed END",
    "candidate_id": f"CASE WHEN {_N} % 79 = 4 AND generation_index = 1 THEN concat(candidate_id, 'x') ELSE candidate_id END",
}
RANKED = {
    "rank": f"CASE WHEN {_N} % 97 = 5 AND generation_index = 1 THEN rank + 1 WHEN {_N} % 61 = 0 AND generation_index = 2 THEN NULL ELSE rank END",
    "tie_group_size": f"CASE WHEN {_N} % 89 = 6 AND generation_index = 1 THEN tie_group_size + 1 ELSE tie_group_size END",
    "score": f"CASE WHEN {_N} % 83 = 7 AND generation_index = 1 THEN score + 0.01 ELSE score END",
}
RANKS_LOST = f"{_N} % 73 = 8 AND generation_index = 1"
#: Pairs that are stored a second time, and the other way round.
TWICE, REVERSED = f"{_N} % 23 = 9", f"{_N} % 17 = 10"
PAIRED = {
    "chosen_sha256": f"CASE WHEN {_N} % 83 = 11 THEN rejected_sha256 ELSE chosen_sha256 END",
    "rejected_id": f"CASE WHEN {_N} % 79 = 12 THEN concat('q', rejected_id) ELSE rejected_id END",
    "preference_id": f"CASE WHEN {_N} % 71 = 13 THEN concat(preference_id, '!') ELSE preference_id END",
}
_COLUMNS = "preference_id, problem_id, chosen_id, rejected_id, chosen_score, rejected_score, chosen_sha256, rejected_sha256"


def _replaced(columns: dict[str, str]) -> str:
    return "* REPLACE (" + ", ".join(f"{sql} AS {c}" for c, sql in columns.items()) + ")"


part("stored_assessments", f"SELECT {_replaced(ASSESSED)} FROM assessed")
part("stored_ranks", f"SELECT {_replaced(RANKED)}, coalesce(tie_group_size > 1, false) AS tied FROM ranks WHERE NOT coalesce({RANKS_LOST}, false)")
part("accepted", "SELECT preference_id, problem_id, chosen_id, rejected_id, greatest(sa, sb) AS chosen_score, least(sa, sb) AS rejected_score, hc AS chosen_sha256, hr AS rejected_sha256 FROM decided WHERE reason IS NULL")
part("stored_pairs", f"""SELECT {_replaced(PAIRED)} FROM (SELECT {_COLUMNS} FROM accepted UNION ALL SELECT {_COLUMNS} FROM accepted WHERE {TWICE}
  UNION ALL SELECT 'pref_' || rejected_id || '__' || chosen_id, problem_id, rejected_id, chosen_id, rejected_score, chosen_score, rejected_sha256, chosen_sha256 FROM accepted WHERE {REVERSED})""")


def _changed(df, columns: dict[str, str]):
    """df with all of columns at once, from the values before."""
    return df.select(*[F.expr(columns[c]).alias(c) if c in columns else F.col(c) for c in df.columns])


def stored_assessments(spark, sf):
    return _changed(candidates.assessed(spark, sf), ASSESSED)


def stored_ranks(spark, sf):
    r = candidates.ranked(spark, sf)
    return _changed(r, RANKED).where(f"not coalesce({RANKS_LOST}, false)")


def stored_pairs(spark, sf):
    p = pairs.accepted(candidates.decided(spark, sf)).selectExpr(*_COLUMNS.split(", "))
    swapped = {a: b for x in ("id", "score", "sha256") for a, b in ((f"chosen_{x}", f"rejected_{x}"), (f"rejected_{x}", f"chosen_{x}"))}
    other = p.where(REVERSED).select(*[F.col(swapped.get(c, c)).alias(c) for c in p.columns]).withColumn("preference_id", S.preference_id("chosen_id", "rejected_id"))
    return _changed(p.unionByName(p.where(TWICE)).unionByName(other), PAIRED)


_J9 = """SELECT 'unknown_candidate' AS check_name, a.candidate_id AS key FROM stored_assessments a WHERE a.candidate_id NOT IN (SELECT candidate_id FROM evals)
UNION ALL SELECT 'score_recompute', a.candidate_id FROM stored_assessments a JOIN evals e USING (candidate_id) WHERE abs(a.score - CASE WHEN e.tests_total > 0 THEN e.tests_passed::DOUBLE / e.tests_total ELSE 0 END) > 1e-9
UNION ALL SELECT 'correctness_recompute', a.candidate_id FROM stored_assessments a JOIN evals e USING (candidate_id) WHERE a.correctness IS DISTINCT FROM CASE WHEN NOT e.has_result OR e.infrastructure_error OR e.tests_total = 0 THEN 'indeterminate' WHEN e.tests_passed = e.tests_total AND e.tests_failed + e.tests_error + e.tests_skipped = 0 AND NOT e.timeout THEN 'correct' ELSE 'incorrect' END"""


@query("j9_assessments_recomputed", _J9)
def _(spark, sf):
    return validate.recomputed(stored_assessments(spark, sf), view(spark, sf, "evals"))


_J10 = """SELECT 'only_assessed' AS check_name, candidate_id AS key FROM (SELECT candidate_id FROM stored_assessments EXCEPT SELECT candidate_id FROM stored_ranks)
UNION ALL SELECT 'only_ranked', candidate_id FROM (SELECT candidate_id FROM stored_ranks EXCEPT SELECT candidate_id FROM stored_assessments)"""


@query("j10_pairing_both_ways", _J10)
def _(spark, sf):
    return validate.one_to_one(stored_assessments(spark, sf), stored_ranks(spark, sf), "candidate_id", ("only_assessed", "only_ranked"))


_W9 = "SELECT 'expected_rank' AS check_name, tie_group AS key FROM (SELECT *, 1 + coalesce(sum(n) OVER (PARTITION BY problem_id ORDER BY tie_group ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS e FROM (SELECT problem_id, tie_group, min(rank) AS low, max(rank) AS high, count(*) AS n FROM stored_ranks WHERE rank IS NOT NULL GROUP BY ALL)) WHERE low <> e OR high <> low"


@query("w9_rank_breaks", _W9.replace("'expected_rank' AS check_name, tie_group AS key", "problem_id, tie_group"))
def _(spark, sf):
    from quillrank.operators import ranking

    return ranking.expected_rank_breaks(stored_ranks(spark, sf)).select("problem_id", "tie_group")


_GROUPS = "(SELECT tie_group, count(DISTINCT rank) AS r, count(DISTINCT round(score, 9)) AS s, count(*) AS n, min(tie_group_size) AS low, max(tie_group_size) AS high FROM stored_ranks WHERE tie_group IS NOT NULL GROUP BY tie_group)"
_C21 = f"SELECT 'tie_rank' AS check_name, tie_group AS key FROM {_GROUPS} WHERE r <> 1 UNION ALL SELECT 'tie_score', tie_group FROM {_GROUPS} WHERE s <> 1 UNION ALL SELECT 'tie_size', tie_group FROM {_GROUPS} WHERE n <> low OR n <> high"


@query("c21_tie_group_guards", _C21)
def _(spark, sf):
    return validate.tie_groups(stored_ranks(spark, sf))


_TIED = "SELECT 'artificial_preference' AS check_name, m.ca AS key FROM matrix m JOIN stored_ranks a ON m.ca = a.candidate_id JOIN stored_ranks b ON m.cb = b.candidate_id WHERE a.tie_group = b.tie_group AND (m.relation <> 'TIE' OR substr(m.problem_id, 9, 1) = '7')"


def stored_comparisons(spark, sf):
    from quillrank.operators import ranking

    m = ranking.pair_matrix(candidates.assessed(spark, sf)).select("problem_id", F.col("candidate_id_a").alias("candidate_a"), F.col("candidate_id_b").alias("candidate_b"), "relation")
    return m.withColumn("relation", F.expr("CASE WHEN relation = 'TIE' AND substr(problem_id, 9, 1) = '7' THEN 'A_BETTER' ELSE relation END"))


@query("v2_tied_winners", _TIED)
def _(spark, sf):
    return validate.tied_winners(stored_ranks(spark, sf), stored_comparisons(spark, sf))


_V2 = f"""SELECT 'counts' AS check_name, candidate_id AS key FROM stored_assessments WHERE tests_passed + tests_failed + tests_error + tests_skipped <> tests_total
UNION ALL SELECT 'rank_null', candidate_id FROM stored_ranks WHERE (correctness <> 'indeterminate') <> (rank IS NOT NULL)
UNION ALL SELECT 'tied', candidate_id FROM stored_ranks WHERE tied <> coalesce(tie_group_size > 1, false)
UNION ALL SELECT 'duplicate_id', candidate_id FROM stored_assessments GROUP BY candidate_id HAVING count(*) > 1
UNION ALL {_J9} UNION ALL {_J10} UNION ALL {_C21} UNION ALL {_W9} UNION ALL {_TIED}"""


@query("v2_ranking_invariants", f"SELECT check_name, count(*) AS violations FROM ({_V2}) GROUP BY check_name")
def _(spark, sf):
    found = validate.ranking_run(stored_assessments(spark, sf), stored_ranks(spark, sf), view(spark, sf, "evals"), stored_comparisons(spark, sf))
    return validate.counted(found)


_J7 = """SELECT 'unknown_candidate' AS check_name, preference_id AS key FROM stored_pairs p LEFT JOIN stored_ranks c ON p.chosen_id = c.candidate_id LEFT JOIN stored_ranks r ON p.rejected_id = r.candidate_id WHERE c.rank IS NULL OR r.rank IS NULL
UNION ALL SELECT 'direction', preference_id FROM stored_pairs p JOIN stored_ranks c ON p.chosen_id = c.candidate_id JOIN stored_ranks r ON p.rejected_id = r.candidate_id WHERE c.rank >= r.rank"""


@query("j7_pairs_against_ranks", _J7)
def _(spark, sf):
    return validate.against_ranks(stored_pairs(spark, sf), stored_ranks(spark, sf))


_SIDES = "(SELECT preference_id, chosen_id AS id, chosen_sha256 AS sha FROM stored_pairs UNION ALL SELECT preference_id, rejected_id, rejected_sha256 FROM stored_pairs)"
_J8 = f"""SELECT 'no_candidate' AS check_name, preference_id AS key FROM {_SIDES} WHERE id NOT IN (SELECT candidate_id FROM assessed)
UNION ALL SELECT 'code_digest', preference_id FROM {_SIDES} s JOIN assessed a ON s.id = a.candidate_id WHERE sha <> code_sha256"""


@query("j8_pair_provenance", _J8)
def _(spark, sf):
    return validate.provenance(stored_pairs(spark, sf), candidates.assessed(spark, sf))


_U8 = "SELECT 'reversed' AS check_name, least(a.chosen_id, a.rejected_id) || '/' || greatest(a.chosen_id, a.rejected_id) AS key FROM (SELECT DISTINCT problem_id, chosen_id, rejected_id FROM stored_pairs) a JOIN (SELECT DISTINCT problem_id, chosen_id, rejected_id FROM stored_pairs) b ON a.problem_id = b.problem_id AND a.chosen_id = b.rejected_id AND a.rejected_id = b.chosen_id WHERE a.chosen_id < a.rejected_id"


@query("u8_reversed_pairs", _U8)
def _(spark, sf):
    return validate.reversed_pairs(stored_pairs(spark, sf))


_V3 = f"""SELECT 'not_better' AS check_name, preference_id AS key FROM stored_pairs WHERE chosen_score <= rejected_score
UNION ALL SELECT 'same_code', preference_id FROM stored_pairs WHERE chosen_sha256 = rejected_sha256
UNION ALL SELECT 'foreign_id', preference_id FROM stored_pairs WHERE NOT (starts_with(chosen_id, problem_id || '_c') AND starts_with(rejected_id, problem_id || '_c'))
UNION ALL SELECT 'wrong_id', preference_id FROM stored_pairs WHERE preference_id <> 'pref_' || chosen_id || '__' || rejected_id
UNION ALL SELECT 'duplicate_id', preference_id FROM stored_pairs GROUP BY preference_id HAVING count(*) > 1
UNION ALL {_J7} UNION ALL {_J8} UNION ALL {_U8}"""


@query("v3_preference_invariants", f"SELECT check_name, count(*) AS violations FROM ({_V3}) GROUP BY check_name")
def _(spark, sf):
    return validate.counted(validate.preference_run(stored_pairs(spark, sf), stored_ranks(spark, sf), candidates.assessed(spark, sf)))


@query("v4_statistics_recomputed", "SELECT 'statistics' AS check_name, reason AS key FROM (SELECT reason, count(*) + CASE WHEN reason = 'tie' THEN 1 ELSE 0 END AS n FROM decided WHERE reason IS NOT NULL AND reason <> 'indeterminate' GROUP BY reason UNION ALL SELECT 'never_seen', 3) s FULL JOIN (SELECT reason, count(*) AS m FROM decided WHERE reason IS NOT NULL GROUP BY reason) r USING (reason) WHERE n IS DISTINCT FROM m")
def _(spark, sf):
    again = pairs.rejected(candidates.decided(spark, sf)).groupBy("reason").agg(F.count("*").alias("n"))
    stored = again.where("reason <> 'indeterminate'").withColumn("n", F.col("n") + F.when(F.col("reason") == "tie", 1).otherwise(0))
    stored = stored.unionByName(spark.createDataFrame([("never_seen", 3)], "reason string, n long"))
    return validate.statistics(stored, again, "reason", "n")


_LINKS = "SELECT candidate_id, sha256(code) AS code_sha256, CASE WHEN generation_index % 97 = 1 THEN 'd_gone' WHEN generation_index % 89 = 2 THEN 'd000000005' ELSE nullif(first_value(candidate_id) OVER (PARTITION BY problem_id, sha256(code) ORDER BY generation_index), candidate_id) END AS duplicate_of FROM candidates"
part("stored_links", _LINKS)
_J18 = """SELECT 'duplicate_unknown' AS check_name, candidate_id AS key FROM stored_links WHERE duplicate_of IS NOT NULL AND duplicate_of NOT IN (SELECT candidate_id FROM stored_links)
UNION ALL SELECT 'duplicate_differs', a.candidate_id FROM stored_links a JOIN stored_links b ON a.duplicate_of = b.candidate_id WHERE a.code_sha256 <> b.code_sha256"""


def stored_links(spark, sf):
    from pyspark.sql import Window

    c = view(spark, sf, "candidates").withColumn("code_sha256", S.sha256("code"))
    first = F.first("candidate_id").over(Window.partitionBy("problem_id", "code_sha256").orderBy("generation_index"))
    c = c.withColumn("duplicate_of", F.nullif(first, F.col("candidate_id")))
    g = F.col("generation_index")
    return c.withColumn("duplicate_of", F.when(g % 97 == 1, "d_gone").when(g % 89 == 2, "d000000005").otherwise(F.col("duplicate_of"))).select("candidate_id", "code_sha256", "duplicate_of")


@query("j18_duplicate_reference", _J18)
def _(spark, sf):
    return validate.duplicate_links(stored_links(spark, sf))


_RUN = """SELECT CASE WHEN n % 97 = 1 AND generation_index = 1 THEN 'bad-' || candidate_id ELSE candidate_id END AS candidate_id, problem_id, CASE WHEN n % 89 = 2 THEN 'run_2' ELSE 'run_1' END AS run_id, n % 83 = 3 AS no_prompt
FROM (SELECT *, substr(problem_id, 2, 8)::BIGINT AS n FROM evals) UNION ALL SELECT candidate_id, problem_id, 'run_1', false FROM evals WHERE substr(problem_id, 2, 8)::BIGINT % 79 = 4 AND generation_index = 1"""
part("stored_run", _RUN)


@query("v1_run_validation", """SELECT check_name, count(*) AS violations FROM (
  SELECT 'malformed_id' AS check_name FROM stored_run WHERE NOT regexp_full_match(candidate_id, 'p\\d+_c\\d{3,}') UNION ALL SELECT 'run_mismatch' FROM stored_run WHERE run_id <> 'run_1'
  UNION ALL SELECT 'duplicate_id' FROM stored_run GROUP BY candidate_id HAVING count(*) > 1 UNION ALL SELECT 'no_prompt' FROM stored_run WHERE no_prompt
  UNION ALL SELECT 'missing_generation' FROM (SELECT problem_id, i FROM (SELECT DISTINCT problem_id FROM evals), (SELECT unnest(range(1, 5)) AS i) EXCEPT SELECT problem_id, generation_index FROM evals)) GROUP BY check_name""")
def _(spark, sf):
    e = view(spark, sf, "evals").withColumn("n", F.expr(_N))
    n = F.col("n")
    first = F.col("generation_index") == 1
    prompt, code = F.concat(F.lit("prompt of "), "problem_id"), S.sha256("code").alias("code_sha256")
    # some rows name a prompt that the run hasn't kept; where such a row is stored twice, the second names the kept one
    named = S.sha256(F.when(n % 83 == 3, F.concat(F.lit("lost "), prompt)).otherwise(prompt)).alias("prompt_sha256")
    c = e.select(F.when((n % 97 == 1) & first, F.concat(F.lit("bad-"), "candidate_id")).otherwise(F.col("candidate_id")).alias("candidate_id"), "problem_id", code, F.when(n % 89 == 2, "run_2").otherwise("run_1").alias("run_id"), named)
    c = c.unionByName(e.where((n % 79 == 4) & first).select("candidate_id", "problem_id", code, F.lit("run_1").alias("run_id"), S.sha256(prompt).alias("prompt_sha256")))
    c = c.withColumns({"duplicate_of": F.lit(None).cast("string"), "manifest_run_id": F.lit("run_1")})
    kept = e.select(S.sha256(prompt).alias("prompt_sha256")).distinct()
    return validate.counted(validate.generation_run(c, kept, records.missing(spark, sf)))


_PROBLEMS = "SELECT problem_id, CASE WHEN ordinal % 97 = 1 THEN '  ' ELSE prompt END AS prompt, CASE WHEN ordinal % 89 = 2 THEN 'brutal' ELSE difficulty END AS difficulty, ordinal FROM problems UNION ALL SELECT problem_id, prompt, difficulty, ordinal FROM problems WHERE ordinal % 83 = 3"
_CASES = "SELECT problem_id, 't' || CASE WHEN ordinal % 79 = 4 AND i = 2 THEN 1 ELSE i END AS test_id, NOT (ordinal % 73 = 5 AND i = 3) AS passed FROM problems, (SELECT unnest(range(1, 7)) AS i) WHERE NOT (ordinal % 71 = 6 AND i > 4)"
part("stored_problems", _PROBLEMS)
part("stored_cases", _CASES)


@query("v5_dataset_validation", """SELECT check_name, count(*) AS violations FROM (
  SELECT 'blank_prompt' AS check_name FROM stored_problems WHERE trim(prompt) = '' UNION ALL SELECT 'unknown_difficulty' FROM stored_problems WHERE difficulty NOT IN ('easy', 'medium', 'hard')
  UNION ALL SELECT 'duplicate_id' FROM stored_problems GROUP BY problem_id HAVING count(*) > 1 UNION ALL SELECT 'few_tests' FROM stored_cases GROUP BY problem_id HAVING count(*) < 5
  UNION ALL SELECT 'duplicate_test_id' FROM stored_cases GROUP BY problem_id HAVING count(DISTINCT test_id) < count(*) UNION ALL SELECT 'reference_fails' FROM stored_cases GROUP BY problem_id HAVING NOT bool_and(passed)
  UNION ALL SELECT 'dataset_size' FROM stored_problems HAVING count(*) <> 10) GROUP BY check_name""")
def _(spark, sf):
    p = view(spark, sf, "problems")
    o = F.col("ordinal")
    bad = p.withColumns({"prompt": F.when(o % 97 == 1, "  ").otherwise(F.col("prompt")), "difficulty": F.when(o % 89 == 2, "brutal").otherwise(F.col("difficulty"))}).unionByName(p.where(o % 83 == 3))
    i = F.col("i")
    cases = p.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(6)))).where(~((o % 71 == 6) & (i > 4)))
    cases = cases.select("problem_id", F.concat(F.lit("t"), F.when((o % 79 == 4) & (i == 2), 1).otherwise(i)).alias("test_id"), (~((o % 73 == 5) & (i == 3))).alias("passed"))
    return validate.counted(validate.dataset(bad, cases, 10))


_SEEDED = "SELECT *, 42 + sample_index + CASE WHEN model_variant = 'dpo' AND substr(problem_id, 2, 8)::BIGINT % 41 = 1 THEN 1 ELSE 0 END AS seed, CASE WHEN substr(problem_id, 2, 8)::BIGINT % 43 = 2 THEN 'v2' ELSE 'v1' END AS dataset_version, tests_failed + CASE WHEN substr(problem_id, 2, 8)::BIGINT % 47 = 3 AND sample_index = 0 THEN 1 ELSE 0 END AS failed_stored FROM model_evals"
part("stored_model_evals", _SEEDED)


@query("v6_model_evaluation_validation", """SELECT check_name, count(*) AS violations FROM (
  SELECT 'counts' AS check_name FROM stored_model_evals WHERE tests_passed + failed_stored + tests_error <> tests_total UNION ALL SELECT 'foreign_dataset_version' FROM stored_model_evals WHERE dataset_version <> 'v1'
  UNION ALL SELECT 'unpaired' FROM stored_model_evals GROUP BY problem_id, sample_index HAVING count(DISTINCT model_variant) < 2
  UNION ALL SELECT 'seeds_differ' FROM stored_model_evals GROUP BY problem_id, sample_index HAVING count(DISTINCT seed) > 1) GROUP BY check_name""")
def _(spark, sf):
    n = F.expr(_N)
    e = view(spark, sf, "model_evals").withColumns({
        "seed": 42 + F.col("sample_index") + F.when((F.col("model_variant") == "dpo") & (n % 41 == 1), 1).otherwise(0), "dataset_version": F.when(n % 43 == 2, "v2").otherwise("v1"),
        "tests_failed": F.col("tests_failed") + F.when((n % 47 == 3) & (F.col("sample_index") == 0), 1).otherwise(0),
    })
    return validate.counted(validate.model_evaluation(e, {"dataset_version": "v1"}))


@query("j28_pairing_check", "SELECT problem_id || '#' || sample_index AS key, CASE WHEN count(DISTINCT model_variant) < 2 THEN 'unpaired' ELSE 'seeds_differ' END AS check_name FROM stored_model_evals GROUP BY problem_id, sample_index HAVING count(DISTINCT model_variant) < 2 OR count(DISTINCT seed) > 1")
def _(spark, sf):
    n = F.expr(_N)
    e = view(spark, sf, "model_evals").withColumn("seed", 42 + F.col("sample_index") + F.when((F.col("model_variant") == "dpo") & (n % 41 == 1), 1).otherwise(0))
    return validate.model_evaluation(e).where("check_name <> 'counts'").select("key", "check_name")


@query("a39_constancy_guard", f"SELECT 'tests_total' AS check_name, problem_id AS key FROM (SELECT problem_id, tests_total + CASE WHEN {_N} % 37 = 1 AND generation_index = 2 AND tests_total > 0 THEN 1 ELSE 0 END AS t FROM evals) WHERE t > 0 GROUP BY problem_id HAVING count(DISTINCT t) > 1")
def _(spark, sf):
    total = F.expr(f"tests_total + CASE WHEN {_N} % 37 = 1 AND generation_index = 2 AND tests_total > 0 THEN 1 ELSE 0 END")
    e = view(spark, sf, "evals").withColumn("t", total)
    return validate.one_value(e, "problem_id", F.when(F.col("t") > 0, F.col("t")), "tests_total")


@query("c20_prompt_pairing", "SELECT problem_id FROM (SELECT problem_id, prompt, CASE WHEN ordinal % 31 = 1 THEN sha256('other' || prompt) ELSE sha256(prompt) END AS stored FROM problems) WHERE stored <> sha256(prompt)")
def _(spark, sf):
    p = view(spark, sf, "problems")
    stored = p.select("problem_id", F.when(F.col("ordinal") % 31 == 1, S.sha256(F.concat(F.lit("other"), "prompt"))).otherwise(S.sha256("prompt")).alias("stored"))
    return p.join(stored, "problem_id").where(S.sha256("prompt") != F.col("stored")).select("problem_id")


@query("u11_split_disjointness", "SELECT problem_id FROM problems WHERE ordinal % 50 = 3")
def _(spark, sf):
    leaked = view(spark, sf, "problems").where("ordinal % 50 = 3").select("problem_id", F.lit("held_back").alias("split"))
    return records.overlapping(records.splits(spark, sf).unionByName(leaked))


@query("g3_graph_problems", "SELECT * FROM (VALUES ('unknown', 'ranking needs ghost'), ('cycle', 'evaluation, generation')) g(check_name, detail)")
def _(spark, sf):
    from quillrank.plans import graph

    broken = dict(records.STAGES) | {"ranking": ("evaluation", "ghost"), "generation": ("problems", "evaluation")}
    return spark.createDataFrame(graph.problems(broken), "check_name string, detail string")


@query("v7_preflight", "SELECT * FROM (VALUES ('tables', true), ('columns', false), ('ratios', true), ('stages', true)) p(check_name, ok)")
def _(spark, sf):
    from quillrank.plans import graph
    from quillrank.sources import config

    needs = {"lineitem": ("l_orderkey", "l_partkey"), "orders": ("o_orderkey", "o_no_such_column")}
    got = {t: set(table(spark, sf, t).columns) for t in needs}
    checks = {"tables": all(got.values()), "columns": all(set(c) <= got[t] for t, c in needs.items()), "ratios": config.valid_ratios({"train": 0.8, "validation": 0.1, "test": 0.1}), "stages": not graph.problems(records.STAGES)}
    return spark.createDataFrame(list(checks.items()), "check_name string, ok boolean")
