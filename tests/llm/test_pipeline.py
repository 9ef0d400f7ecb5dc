"""The pipeline's stages against plain versions, and the queries against their SQL."""

from __future__ import annotations

import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillrank.llm import pieces, registry
from tests.llm.test_operators import base_measures, components_of, frame, needs_model, repeated_bytes, words

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_stages(spark):
    rng = random.Random(1)
    passage, base = words(rng, 120), words(rng, 100)
    texts = [f"{words(rng, 60)} {passage} {words(rng, 40)}" for _ in range(6)] + [base, base + " more", "too short", "a ### " * 30, *(words(rng, 80) for _ in range(20)), None]
    docs = frame(spark, texts, sources={i: f"s{i % 3}" for i in range(len(texts))})
    kept = corpus_pipeline.quality_rules(spark, docs, "")
    ids = sorted(r.doc_id for r in kept.collect())
    assert ids == [i for i, t in enumerate(texts) if base_measures(t)[0] >= 20 and 100 * base_measures(t)[4] <= 30 * base_measures(t)[0] and base_measures(t)[2] <= base_measures(t)[0]]
    one = corpus_pipeline.near_duplicates(spark, kept, "")
    left = sorted(r.doc_id for r in one.collect())
    assert left == sorted({c for _, _, c in components_of([texts[i] for i in ids], ids)})
    cut = corpus_pipeline.repeated_passages(spark, one, "")
    assert cut.columns == list(corpus_pipeline.COLUMNS)
    got = {r.doc_id: r for r in cut.collect()}
    for i, (_, _, data) in zip(left, repeated_bytes([texts[i] for i in left], corpus_pipeline.PASSAGE), strict=True):
        assert got[i].text == data.decode() and got[i].n_chars == len(data.decode())
    mixed = corpus_pipeline.mixed_sources(spark, cut, "")
    assert mixed.columns == list(corpus_pipeline.COLUMNS) and {r.doc_id for r in mixed.collect()} <= set(left)
    assert corpus_pipeline.encoded_pieces(spark, mixed, "").count() == mixed.count()


def plain_run(rows):
    """The rows of run() from (doc_id, text, source): each stage by another way."""
    kept = [r for r in rows if (m := base_measures(r[1]))[0] >= 20 and 100 * m[4] <= 30 * m[0] and m[2] <= m[0] and 2 * m[3] <= len([x for x in (r[1] or "").split("\n") if x.split()])]
    first = {c for _, _, c in components_of([r[1] for r in kept], [r[0] for r in kept], corpus_pipeline.SHINGLE)}
    kept = [r for r in kept if r[0] in first]
    cut = repeated_bytes([r[1] for r in kept], corpus_pipeline.PASSAGE)
    kept = [(i, data.decode("utf-8", "ignore") if gone else text, source) for (i, text, source), (gone, _, data) in zip(kept, cut, strict=True)]
    kept = [r for r in kept if r[1].split()]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", kept)
    taken = {r[0]: r[4] // r[1] for r in con.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({registry.ORACLES['op8_pareto_mix']})").fetchall()}
    return sorted((r[0], r[2], r[1]) for r in kept for _ in range(taken[r[0]]))


@needs_model
def test_run_against_plain(spark, tmp_path):
    rng = random.Random(7)
    passage, line = words(rng, 52), words(rng, 30)
    texts = [words(rng, rng.randrange(15, 160)) for _ in range(90)]
    texts += [f"{words(rng, 50)} {passage} {words(rng, 50)}" for _ in range(8)]  # a passage of over 50 words
    texts += [" ".join(x if k != 40 else "other" for k, x in enumerate(texts[i].split())) for i in range(20)] + texts[20:30]  # near and exact copies
    texts += [f"{line}\n" * 5, passage, "a ### " * 40, None, "", "é" * 300, f"{words(rng, 60)}\n{line}\n{words(rng, 60)}"]
    rows = [(i, t, f"s{rng.randrange(4)}" if i % 9 else None) for i, t in enumerate(texts)]
    frame(spark, texts, sources={i: s for i, _, s in rows}).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    got = sorted((r.doc_id, r.source, r.decoded) for r in pieces.decoded(out, keep=("doc_id", "source")).collect())
    by = lambda rows: sorted(rows, key=repr)
    want = plain_run(rows)
    assert by(got) == by(want) and len(got) > 60 and not any(passage in t for _, _, t in got)


def test_stages_take_odd_tables(spark):
    """Nulls in every column, repeated rows and more columns, in each stage."""
    rng = random.Random(8)
    text = words(rng, 60)
    docs = frame(spark, [text, text, words(rng, 70), words(rng, 80)], [None, 1, 1, 2]).withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit(None).cast("string")).withColumn("n_chars", F.lit(None).cast("long"))
    docs = docs.unionByName(docs).withColumns({n: F.lit("clash") for n in ("kept", "component_id", "wanted", "mix_size", "ids", "_text")})
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "").cache()
        assert docs.count()
    assert docs.columns == ["doc_id", "source", "n_pieces", "ids"]


def test_near_duplicates_on_five_words(spark):
    base = [f"w{i}" for i in range(90)]
    two, one = base[:], base[:]
    two[30], two[60], one[45] = "x", "y", "z"  # of 90 words two differ: 79 of 95 shingles of four words, 76 of 96 of five
    docs = frame(spark, [" ".join(t) for t in (base, two)])
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == [0, 1]
    docs = frame(spark, [" ".join(t) for t in (base, one)])
    assert [r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()] == [0]


def test_characters_cut_in_two_go(spark):
    base = words(random.Random(2), 200)
    texts = [f"é{base}à", f"ã{base}á"]  # their second bytes differ, their first ones don't
    got = [r.text for r in corpus_pipeline.repeated_passages(spark, frame(spark, texts), "").collect()]
    assert all(base not in t for t in got)


def test_empty(spark):
    docs = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0


def rows(table):
    cut = lambda x: round(x, 6) if isinstance(x, float) else str(x)
    return sorted((tuple(cut(r[k]) for k in sorted(r)) for r in table.to_pylist()), key=repr)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, name):
    got = registry.QUERIES[name](spark, SF).toArrow()
    assert got.num_rows
    if name in registry.ORACLES:
        con = duckdb.connect()
        for t in ("documents", "conversations", "pages"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
        want = con.execute(registry.ORACLES[name]).to_arrow_table()
        assert sorted(got.column_names) == sorted(want.column_names) and rows(got) == rows(want)
