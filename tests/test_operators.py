"""The library's operators on worked examples."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from quillrank.functions import scalars as S
from quillrank.functions import syntax
from quillrank.operators import analysis, assess, decide, lengths, metrics, pairs, ranking, validate
from quillrank.plans import graph
from quillrank.plans.records import STAGES, split_of

EVALS = "problem_id string, candidate_id string, code string, has_result boolean, tests_total long, tests_passed long, tests_failed long, tests_error long, tests_skipped long, timeout boolean, infrastructure_error boolean"


def evals(spark, rows):
    """rows: (problem, candidate, passed, code), of 10 tests; passed None has no result."""
    return spark.createDataFrame([(p, c, code, n is not None, 10 if n is not None else 0, n or 0, 10 - n if n is not None else 0, 0, 0, False, False) for p, c, n, code in rows], EVALS)


FIVE = [("p1", f"p1_c00{i + 1}", n, f"code {i}") for i, n in enumerate((10, 8, 10, 5, 0))]


def decided(spark, rows, policy="strict", **more):
    a = assess.assess(evals(spark, rows))
    return pairs.decisions(a, a.select("candidate_id", "code", "code_sha256"), pairs.POLICIES[policy], **more)


def test_ranks_with_ties(spark):
    got = {r.candidate_id[-1]: (r.rank, r.tie_group, r.tied) for r in ranking.ranked(assess.assess(evals(spark, FIVE))).collect()}
    assert [got[k][0] for k in "12345"] == [1, 3, 1, 4, 5]
    assert got["1"][1] == got["3"][1] == "p1_tg001" and got["1"][2] and not got["2"][2]


def test_indeterminate_keeps_its_row(spark):
    got = ranking.ranked(assess.assess(evals(spark, [*FIVE, ("p1", "p1_c006", None, "x")]))).where("rank is null").collect()
    assert [(r.candidate_id, r.indeterminate_reason) for r in got] == [("p1_c006", "missing_evaluation_result")]


def test_strict_pairs(spark):
    d = decided(spark, FIVE)
    got = {(r.chosen_id[-1], r.rejected_id[-1]) for r in pairs.accepted(d).collect()}
    assert got == {("1", "2"), ("1", "4"), ("1", "5"), ("3", "2"), ("3", "4"), ("3", "5")}
    assert d.count() == 10


@pytest.mark.parametrize(("rows", "more", "reason"), [
    ([("p1", "p1_c001", 5, "x"), ("p1", "p1_c002", 5, "x")], {}, "tie"),
    ([("p1", "p1_c001", 10, "x"), ("p1", "p1_c002", 5, "x")], {}, "identical_code"),
    ([("p1", "p1_c001", 10, "x"), ("p1", "p1_c002", None, "y")], {}, "indeterminate"),
    ([("p1", "p1_c001", 8, "x"), ("p1", "p1_c002", 5, "y")], {}, "not_correct_vs_incorrect"),
    ([("p1", "p1_c001", 8, "x"), ("p1", "p1_c002", 7, "y")], {"policy": "margin"}, "insufficient_margin"),
    ([("p1", "p1_c001", 8, "x"), ("p1", "p1_c002", 6, "y")], {"policy": "margin"}, None),
    ([("p1", "p1_c001", 8, "x"), ("p1", "p1_c002", 7, "y")], {"policy": "all_better"}, None),
])
def test_reasons(spark, rows, more, reason):
    assert [r.reason for r in decided(spark, rows, **more).collect()] == [reason]


def test_missing_candidate_and_tampered_prompt(spark):
    a = assess.assess(evals(spark, FIVE[:2]))
    none = pairs.decisions(a, a.where("false").select("candidate_id", "code", "code_sha256"))
    assert [r.reason for r in none.collect()] == ["integrity_failure"]
    ok = spark.createDataFrame([("p1", False)], "problem_id string, lineage_ok boolean")
    assert {r.reason for r in decided(spark, FIVE, prompts_ok=ok).collect()} == {"integrity_failure"}


def test_largest_margins_stay(spark):
    d = decided(spark, FIVE, max_pairs=2)
    assert {r.rejected_id[-1] for r in pairs.accepted(d).collect()} == {"5"}
    assert pairs.rejected(d).where("reason = 'max_pairs_per_problem'").count() == 4


def test_duplicates_are_flagged_and_kept(spark):
    rows = spark.createDataFrame([("b", 1, 2, 3), ("a", 1, 2, 3), ("c", 9, 2, 3)], "preference_id string, prompt int, chosen_code int, rejected_code int")
    got = {r.preference_id: (r.survivor_id, r.is_duplicate) for r in pairs.deduplicated(rows).collect()}
    assert got == {"a": ("a", False), "b": ("a", True), "c": ("c", False)}


def test_codes_ride_along(spark):
    a = assess.assess(evals(spark, FIVE))
    got = pairs.accepted(pairs.decisions(a, more=("code",))).collect()
    assert len(got) == 6 and all((r.chosen_code, r.rejected_code) == (f"code {int(r.chosen_id[-1]) - 1}", f"code {int(r.rejected_id[-1]) - 1}") for r in got)
    plan = pairs.decisions(a)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1  # candidates with themselves, and nothing after


def test_missing_evidence_has_the_failures_reason(spark):
    failures = spark.createDataFrame([("p1_c001", "timeout")], "candidate_id string, error_type string")
    got = {r.candidate_id: r.indeterminate_reason for r in assess.assess(evals(spark, [("p1", "p1_c001", None, "x"), ("p1", "p1_c002", None, "y"), ("p1", "p1_c003", 3, "z")]), failures).collect()}
    assert got == {"p1_c001": "timeout", "p1_c002": "missing_evaluation_result", "p1_c003": None}


def test_empty_problem_table(spark):
    assert decided(spark, []).count() == 0 and ranking.ranked(assess.assess(evals(spark, []))).count() == 0


@pytest.mark.parametrize(("n", "c", "k", "want"), [(10, 10, 1, 1.0), (10, 0, 5, 0.0), (10, 1, 1, 0.1), (10, 6, 5, 1.0), (10, 3, 5, 1 - math.comb(7, 5) / math.comb(10, 5))])
def test_pass_at_k(spark, n, c, k, want):
    assert spark.range(1).select(S.pass_at_k(F.lit(n), F.lit(c), k)).first()[0] == pytest.approx(want, abs=1e-12)


def test_mean_is_over_problems(spark):
    p = spark.createDataFrame([("base", 5, 5), ("base", 15, 0)], "model_variant string, n long, c long")
    assert metrics.mean_pass_at_k(p, 1).first().pass_at_k == 0.5


@pytest.mark.parametrize(("b", "c", "want"), [(1, 5, 14 / 64), (0, 0, 1.0), (3, 3, 1.0), (0, 5, 2 / 32)])
def test_sign_test(spark, b, c, want):
    assert spark.range(1).select(S.sign_test(F.lit(b), F.lit(c))).first()[0] == pytest.approx(want)


def test_nearest_rank(spark):
    v = spark.range(1, 101).select(F.lit("x").alias("k"), F.col("id").alias("v"))
    r = metrics.percentile_at(v, ["k"], "v", [50, 90, 99]).first()
    assert (r.p50, r.p90, r.p99, r.max) == (50, 90, 99, 100)
    assert v.agg(S.nearest_rank(F.collect_list("v"), 90)).first()[0] == 90


@pytest.mark.parametrize(("raw", "code", "kind"), [
    ("a\n```python\nx = 1\n```\n", "x = 1", "python_fence"), ("```\ndef f(): pass\n```", "def f(): pass", "generic_fence"), ("\nimport os\n", "import os", "plain"),
    ("```\nno code\n```", None, "unknown"), ("prose", None, "unknown"), ("", None, "unknown"), ("```\ndef g(): 1\n```\n```python\ny\n```", "y", "python_fence"), ("```python\nx", None, "unknown"),
    ("```python3\nx = 1\n```", "x = 1", "python_fence"), ("``` python\ny\n```", "y", "python_fence"), ("```PY \r\nz```", "z", "python_fence"), ("```python\n\n```\n```py\nw\n```", "w", "python_fence"),
])
def test_extracted_code(spark, raw, code, kind):
    assert tuple(spark.createDataFrame([(raw,)], "r string").select(S.extracted_code("r").alias("x")).select("x.*").first()) == (code, kind)


def test_seed_and_buckets(spark):
    assert spark.range(1).select(S.candidate_seed(42, F.lit("p001"), F.lit(3))).first()[0] == 1765383970
    values = [i / 20 for i in range(21)]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(S.rounded_bucket("v")).collect()]
    assert got == [f"{round(v, 1):.1f}" for v in values]


def test_text_functions(spark):
    texts = ["", "a", "a\n", "a\r\nb\n\n", "  x  "]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(S.line_count("t"), S.stripped("t")).collect()
    assert [r[0] for r in got] == [len(t.splitlines()) for t in texts]
    assert [r[1] for r in got] == [t.strip() for t in texts]


def test_syntax(spark):
    df = spark.createDataFrame([("def f(): pass", "f"), ("def f(:", "f"), (None, "f"), ("x = 1", "f")], "c string, n string")
    assert [tuple(r) for r in df.select(syntax.syntax_valid("c"), syntax.function_name_valid("c", "n")).collect()] == [(True, True), (False, False), (False, False), (True, False)]


def test_split_is_seeded():
    assert sorted(split_of(10)) == ["test"] + ["train"] * 8 + ["validation"]
    assert split_of(1) == ["train"] and split_of(0) == [] and split_of(10) == split_of(10)


def test_percentiles_of_repeated_values(spark):
    v = spark.createDataFrame([("x", n) for n in [5] * 90 + [7] * 9 + [100]] + [("y", 1), ("z", None)], "k string, v long")
    got = {r.k: (r.p50, r.p90, r.p99, r.max, r.mean) for r in metrics.percentile_at(v, ["k"], "v", [50, 90, 99]).collect()}
    assert got == {"x": (5, 5, 7, 100, 6.13), "y": (1, 1, 1, 1, 1.0)}


def test_lengths(spark):
    words = lambda n: "w " * n
    rows = spark.createDataFrame([(words(n), words(5), words(n % 7)) for n in range(1, 101)], "prompt string, chosen string, rejected string")
    sizes = lengths.measured(rows)
    got = {r.series: r for r in lengths.distributions(sizes).collect()}
    assert (got["prompt"].p50, got["prompt"].p90, got["prompt"].p99, got["prompt"].max, got["prompt"].mean) == (50, 90, 99, 100, 50.5) and got["prompt_chosen"].max == 105
    assert lengths.truncation(sizes, 100, 90).first().asDict() == {"examples": 100, "truncated": 5, "prompt_overflow": 10, "rate": 0.05}
    none = lengths.measured(rows.where("false"))
    assert lengths.truncation(none, 1, 1).first().rate == 0.0 and {r["max"] for r in lengths.distributions(none).collect()} == {0}


def test_sound_artifacts_have_no_violations(spark):
    e = evals(spark, [*FIVE, ("p1", "p1_c006", None, "x")])
    a = assess.assess(e)
    r = ranking.ranked(a)
    m = ranking.pair_matrix(a).select(F.col("candidate_id_a").alias("candidate_a"), F.col("candidate_id_b").alias("candidate_b"), "relation")
    assert validate.ranking_run(a, r, e, m).count() == 0
    p = pairs.accepted(pairs.decisions(a))
    assert validate.preference_run(p, r, a).count() == 0
    wrong = r.withColumn("rank", F.when(F.col("candidate_id") == "p1_c002", 2).otherwise(F.col("rank")))
    assert {x.check_name for x in validate.ranking_run(a, wrong, e, m).collect()} == {"expected_rank"}
    assert {x.check_name for x in validate.ranking_run(a.where("candidate_id <> 'p1_c001'"), r, e).collect()} == {"only_ranked"}
    swapped = p.select(*[F.col({"chosen_id": "rejected_id", "rejected_id": "chosen_id"}.get(c, c)).alias(c) for c in p.columns])
    assert {"direction", "wrong_id", "code_digest"} <= {x.check_name for x in validate.preference_run(swapped, r, a).collect()}


def test_each_row_needs_its_own_prompt(spark):
    rows = [("p1_c001", "lost"), ("p1_c001", "kept"), ("p1_c002", "kept"), ("p1_c003", "gone"), ("p1_c003", "gone"), ("p1_c004", None)]
    c = spark.createDataFrame([(i, "p1", "x", None, "r", "r", p) for i, p in rows], "candidate_id string, problem_id string, code_sha256 string, duplicate_of string, run_id string, manifest_run_id string, prompt_sha256 string")
    got = validate.generation_run(c, spark.createDataFrame([("kept",)], "prompt_sha256 string"), c.where("false")).collect()
    assert sorted((r.check_name, r.key) for r in got) == [("duplicate_id", "p1_c001"), ("duplicate_id", "p1_c003"), ("no_prompt", "p1_c001"), ("no_prompt", "p1_c003"), ("no_prompt", "p1_c003")]


def test_registry_and_resumption(spark):
    registry = spark.createDataFrame([("a", "VALIDATED")], "model_id string, status string")
    got = {r.model_id: r.status for r in decide.registered(registry, spark.createDataFrame([("a",), ("b",), ("b",)], "model_id string")).collect()}
    assert got == {"a": "VALIDATED", "b": "EXPERIMENTAL"}
    one = lambda c: spark.range(1).select(c).first()[0]
    go = lambda a, b, e, ok: one(decide.promotion(F.lit(a), F.lit(b), F.lit(e).cast("string"), F.lit(ok)))
    assert go("EXPERIMENTAL", "RECOMMENDED", "e", True) == "illegal_transition" and go("VALIDATED", "RECOMMENDED", None, True) == "no_evaluation"
    assert go("VALIDATED", "RECOMMENDED", "e", False) == "criteria_failed" and go("VALIDATED", "RECOMMENDED", "e", True) is None
    old, new = F.lit('{"model":{"name":"m"},"lora":{"r":8,"target_modules":["q"]}}'), F.lit('{"model":{"name":"m","revision":null},"lora":{"r":16,"target_modules":["q"]}}')
    assert one(decide.changed_settings(old, new)) == ["lora.r"] and one(decide.changed_settings(old, old)) == []
    verdict = lambda changed, same, force: one(decide.resumption(F.array(*map(F.lit, changed)), F.lit(same), F.lit(force)))
    assert [verdict(["x"], True, True), verdict([], False, False), verdict([], False, True), verdict([], True, False)] == ["incompatible", "dataset_changed", "forced", "resume"]


def test_attempts(spark):
    units = spark.createDataFrame([(k,) for k in "abcde"], "k string")
    tries = spark.createDataFrame([("a", "timeout"), ("a", None), ("b", "empty_output"), *[("c", "inference")] * 3, ("d", "timeout")], "k string, error_type string")
    assert {r.k: (r.attempts, r.action) for r in decide.next_attempts(units, tries, ["k"]).collect()} == {"a": (2, "settled"), "b": (1, "failed"), "c": (3, "exhausted"), "d": (1, "try"), "e": (0, "try")}


def test_graph():
    order = graph.topological(STAGES)
    assert all(order.index(n) < order.index(s) for s, needs in STAGES.items() for n in needs)
    assert graph.dependents(STAGES, "training") == ["model_evaluation", "analysis", "packaging"]
    with pytest.raises(ValueError, match="cycle"):
        graph.topological({"a": ("b",), "b": ("a",)})
    with pytest.raises(ValueError, match="unknown"):
        graph.topological({"a": ("b",)})
    assert graph.problems(STAGES) == [] and graph.problems({"a": ("b",), "b": ("a", "z"), "c": ("a",)}) == [("unknown", "b needs z"), ("cycle", "a, b")]
    assert graph.reusable({"status": "COMPLETED", "cache_key": "k"}, "k") and not graph.reusable({"status": "FAILED", "cache_key": "k"}, "k")


@pytest.mark.parametrize(("b", "d", "want"), [(0.0, 1.0, ("complete_improvement", "high")), (1.0, 0.0, ("complete_regression", "high")), (0.5, 0.5, ("unchanged", "none")), (0.5, 0.6, ("partial_improvement", "low")), (0.9, 0.5, ("partial_regression", "medium"))])
def test_outcomes(spark, b, d, want):
    o = analysis.outcome(F.lit(b), F.lit(d))
    assert tuple(spark.range(1).select(o, analysis.severity(o, F.lit(d - b))).first()) == want


@pytest.mark.parametrize(("t", "b", "want"), [(0.05, 0.25, "underrepresented"), (0.2, 0.0, "not_in_benchmark"), (0.0, 0.0, "absent_from_both"), (0.9, 0.2, "overrepresented"), (0.3, 0.3, "balanced")])
def test_verdicts(spark, t, b, want):
    assert spark.range(1).select(analysis.verdict(F.lit(t), F.lit(b))).first()[0] == want


def test_reconciled(spark):
    expected = spark.createDataFrame([("a",), ("b",)], "t string")
    events = spark.createDataFrame([("a", "failed", "X", 1), ("a", "passed", None, 2), ("z", "passed", None, 3)], "t string, status string, error_type string, position int")
    assert {(r.t, r.status, r.error_type) for r in assess.reconciled(expected, events, ["t"]).collect()} == {("a", "passed", None), ("b", "error", "MissingResult")}


def test_sandbox_status(spark):
    def status(started=True, exit_code=0, stderr="", timed_out=False, oom=False, flood=False):
        return spark.range(1).select(assess.sandbox_status(F.lit(started), F.lit(exit_code).cast("int"), F.lit(stderr), F.lit(timed_out), F.lit(oom), F.lit(flood))).first()[0]

    assert status() == "success" and status(started=False) == "infrastructure_error" and status(exit_code=126) == "infrastructure_error"
    assert status(exit_code=1, oom=True) == "resource_exceeded" and status(exit_code=None, timed_out=True) == "timeout" and status(exit_code=None) == "infrastructure_error"
    assert status(exit_code=1, stderr="SyntaxError: x") == "syntax_error" and status(exit_code=1, stderr="Traceback (most recent call last):\nSyntaxError: x") == "runtime_error"
