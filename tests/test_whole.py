"""Queries and operators that work on all rows, where others are held to the first ones by their SQL."""

from __future__ import annotations

import hashlib
import json
import os
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quillrank import catalog
from quillrank.operators import metrics, order
from quillrank.plans import composites, datasets, models, records
from quillrank.sources.adapters import view

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize(("n", "iterations", "at_once"), [(1, 3, 64), (7, 40, 64), (64, 9, 64), (200, 11, 64), (1000, 3, 1 << 20)])
def test_draws_are_the_seeds(spark, monkeypatch, n, iterations, at_once):
    monkeypatch.setattr(metrics, "DRAWS", at_once)
    rng, got = random.Random(42), []
    for row in metrics._starts(n, iterations, 42):  # tasks import DRAWS anew, so the parts are drawn here
        twister, rows = metrics._twister(*row[2:4]), []
        while len(rows) < row[4] + row[1] * n:
            rows += metrics._drawn(twister, n).tolist()
        got += rows[row[4] :][: row[1] * n]
    assert got == [rng.randrange(n) for _ in range(iterations * n)]


def test_draws_in_tasks(spark):
    rng = random.Random(42)
    got = sorted((r.iteration, r.idx) for r in metrics.bootstrap_draws(spark, 3000, 700).collect())
    assert got == sorted((i, rng.randrange(3000)) for i in range(700) for _ in range(3000))
    assert metrics.bootstrap_draws(spark, 0).count() == 0


@tables
@pytest.mark.parametrize(("name", "value"), [("a34_bootstrap", lambda r: r.dpo_c / r.dpo_n), ("a35_paired_bootstrap", lambda r: r.dpo_c / r.dpo_n - r.base_c / r.base_n)])
def test_bootstrap_of_all(spark, name, value):
    values = [value(r) for r in metrics.paired(models.problems(spark, SF)).orderBy("problem_id").collect()]
    n, rng = len(values), random.Random(42)
    means = sorted(sum(values[rng.randrange(n)] for _ in range(n)) / n for _ in range(1000))
    at = lambda q: means[int(q * 999)] + (means[int(q * 999) + 1] - means[int(q * 999)]) * (q * 999 % 1)
    got = catalog.QUERIES[name](spark, SF).first()
    assert n > 40 and (got.lower, got.upper, got.mean) == pytest.approx((at(0.025), at(0.975), sum(means) / 1000), abs=2e-9)


@pytest.mark.parametrize(("n", "iterations"), [(1, 3), (4096, 2), (9000, 130)])
def test_means_of_packed_draws(spark, n, iterations):
    values = spark.range(n).select(F.col("id").cast("int").alias("idx"), (F.pmod(F.col("id") * 7919, F.lit(101)) / 101).alias("value"))
    rng, v = random.Random(42), [k * 7919 % 101 / 101 for k in range(n)]
    want = {i: sum(v[rng.randrange(n)] for _ in range(n)) / n for i in range(iterations)}
    got = {r.iteration: r.m for r in metrics.seeded_means(values.repartition(3), n, iterations).collect()}
    assert got == pytest.approx(want, abs=1e-12)


def test_packed_draws_of_nothing(spark):
    none = spark.createDataFrame([], "idx int, value double")
    assert metrics.interval(none, metrics.seeded_means(none, 0)).first().asDict() == {"lower": 0.0, "upper": 0.0, "mean": 0.0, "point": 0.0}


@tables
@pytest.mark.parametrize("name", ["a34_bootstrap", "a35_paired_bootstrap", None])
def test_draws_are_not_broadcast(spark, name):
    values = spark.range(300).select(F.col("id").cast("int").alias("idx"), (F.col("id") / 300).alias("value"))
    got = catalog.QUERIES[name](spark, SF) if name else metrics.bootstrap(values, metrics.bootstrap_draws(spark, 300))
    joins = [x for x in got._jdf.queryExecution().optimizedPlan().toString().split("\n") if re.search(r"Join Inner, \(idx#", x)]
    assert len(joins) == (name is None) and all("strategy=merge" in x for x in joins)


@tables
def test_bootstrap_without_problems(spark):
    none = spark.createDataFrame([], "idx int, value double")
    assert metrics.bootstrap(none, metrics.bootstrap_draws(spark, 0)).first().asDict() == {"lower": 0.0, "upper": 0.0, "mean": 0.0, "point": 0.0}
    one = spark.createDataFrame([(0, 0.25)], "idx int, value double")
    assert metrics.bootstrap(one, metrics.hashed_draws(spark, 1, 5), statistic=F.max).first().asDict() == {"lower": 0.25, "upper": 0.25, "mean": 0.25, "point": 0.25}


@tables
def test_hash_of_all_problems(spark):
    p = view(spark, SF, "problems")
    kept = [{"id": r.problem_id, "prompt": r.prompt, "category": r.category, "difficulty": r.difficulty} for r in p.orderBy("problem_id").collect()]
    of = lambda x: hashlib.sha256(json.dumps(x, sort_keys=True, ensure_ascii=False).encode()).hexdigest()
    assert len(kept) > 50 and catalog.QUERIES["f19_dataset_hash"](spark, SF).first()[0] == of(kept)
    assert datasets.dataset_hash(p.where(F.col("problem_id") != kept[-1]["id"])).first()[0] == of(kept[:-1]) != of(kept)
    assert datasets.dataset_hash(p.where("false")).first()[0] == of([])


@pytest.mark.parametrize("parts", [1, 7])
def test_places_in_order(spark, parts):
    ids = [f"k{(i * 7919) % 10007:05d}" for i in range(3000)]
    df = spark.createDataFrame([(i, len(i)) for i in ids], "id string, n int").repartition(parts)
    got = order.numbered(df, "id", first=0).collect()
    assert {r.id: r.position for r in got} == {i: k for k, i in enumerate(sorted(ids))} and got[0].n == 6
    assert order.numbered(df.where("false"), "id").count() == 0
    assert order.digest(df, "id", between=",").first()[0] == hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()


@tables
def test_leaks_are_found(spark):
    rows = lambda *ids: spark.createDataFrame([(i,) for i in ids], "problem_id string")
    assert composites.leaked(rows("a", "b", "b", "c"), rows("b", "c", "d")).first()[0] == 2
    assert composites.leaked(rows("a"), rows("b")).first()[0] == 0
    assert catalog.QUERIES["j21_leakage_guard"](spark, SF).first()[0] > 0


@tables
@pytest.mark.parametrize(("name", "rows", "order"), [("o9_pair_table", lambda s: catalog.QUERIES["c12_trained_problems"](s, SF), None), ("o2_newest_runs", lambda s: view(s, SF, "runs"), "created_at"), ("s12_run_catalog", lambda s: view(s, SF, "runs"), "day")])
def test_all_rows_in_order(spark, name, rows, order):
    got = catalog.QUERIES[name](spark, SF).collect()
    assert len(got) >= rows(spark).count()
    key = [(r[order], r.run_id) if order else r.preference_id for r in got]
    assert key == sorted(key, reverse=order is not None)


@tables
def test_split_of_all_problems(spark):
    ids = sorted({r.problem_id for r in view(spark, SF, "problems").select("problem_id").collect()})
    got = catalog.QUERIES["d1_problem_split"](spark, SF).collect()
    assert {r.problem_id: r.split for r in got} == dict(zip(ids, records.split_of(len(ids)), strict=True)) and len(got) == len(ids)


def test_overlap_of_splits(spark):
    rows = [("a", "train"), ("b", "train"), ("b", "train"), ("c", "train"), ("c", "test")]
    assert [r.problem_id for r in records.overlapping(spark.createDataFrame(rows, "problem_id string, split string")).collect()] == ["c"]


@tables
def test_lost_prompt_of_a_row_stored_twice(spark, tmp_path):
    import duckdb

    lines = spark.read.parquet(f"{SF}/lineitem.parquet").limit(3).withColumn("l_orderkey", F.lit(1663).cast("long"))  # 1663 is 3 modulo 83 and 4 modulo 79
    lines.withColumn("l_linenumber", F.row_number().over(Window.orderBy("l_linenumber", "l_partkey"))).write.parquet(f"{tmp_path}/lineitem.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    got = {r.check_name: r.violations for r in catalog.QUERIES["v1_run_validation"](spark, str(tmp_path)).collect()}
    assert got == dict(duck.execute(catalog.ORACLES["v1_run_validation"]).fetchall()) and got["no_prompt"] == 3
