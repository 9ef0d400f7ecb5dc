"""Sources, sinks and streams."""

from __future__ import annotations

import hashlib
import json
import tarfile

import pytest

from quillrank.sources import archive, inference, jsonl, scratch
from quillrank.streaming import events


@pytest.mark.parametrize(("lines", "at", "issue"), [(['{"a":1}', "{"], 2, "bad JSON"), (["[1]"], 1, "not an object"), (['{"a":1}', "", '{"a":2}'], 2, "blank line"), (['{"b":1}'], 1, "missing field"), (['{"a":1,"z":1}'], 1, "unknown field")])
def test_faulty_lines_are_named(spark, tmp_path, lines, at, issue):
    (tmp_path / "x.jsonl").write_text("\n".join(lines) + "\n")
    with pytest.raises(ValueError, match=f"line {at}: {issue}"):
        jsonl.read(spark, f"file://{tmp_path}/x.jsonl", "a long", ["a"])


def test_good_and_missing_files(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a":1}\n{"a":2}\n')
    assert sorted(r.a for r in jsonl.read(spark, f"file://{tmp_path}/x.jsonl", "a long", ["a"]).collect()) == [1, 2]
    assert jsonl.read(spark, f"file://{tmp_path}/none", "a long").count() == 0


def test_torn_tail(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"a":1}\n{"a":')
    assert jsonl.torn(spark, f"file://{path}").count() == 1
    assert jsonl.repair(str(path)) == 5 and path.read_text() == '{"a":1}\n'
    assert jsonl.torn(spark, f"file://{path}").count() == 0


def test_documents_and_catalog(spark, tmp_path):
    for k, at in (("r1", "2024-01-01"), ("r2", "2024-02-01")):
        (tmp_path / k).mkdir()
        jsonl.write_document(str(tmp_path / k / "manifest.json"), {"run_id": k, "created_at": at, "status": "done"})
    assert json.loads((tmp_path / "r1/manifest.json").read_text())["run_id"] == "r1"
    assert [r.run_id for r in jsonl.catalog(spark, f"file://{tmp_path}").collect()] == ["r2", "r1"]


def test_streams_resume_and_agree_with_batches(spark, tmp_path):
    source = f"{tmp_path}/t/e.parquet"
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id long, kind string")
    df.write.parquet(source)
    folder = scratch.folder(spark, "stream")
    stream = lambda: events.source(spark, f"{tmp_path}/t", "e")
    assert events.append(stream(), folder).count() == 3
    df.write.mode("append").parquet(source)
    assert events.append(stream(), folder).count() == 6


def test_first_seen_is_remembered_over_batches(spark, tmp_path):
    source, at = f"{tmp_path}/t/e.parquet", "2024-01-01 00:0{}:00"
    rows = lambda *r: spark.createDataFrame([(i, k, at.format(t)) for i, k, t in r], "id long, kind string, t string").selectExpr("id", "kind", "cast(t as timestamp) as ts")
    folder = scratch.folder(spark, "first")
    run = lambda: {r.id: r.duplicate_of for r in events.append(events.first_seen(events.source(spark, f"{tmp_path}/t", "e"), ["kind"], "id"), folder).collect()}
    rows((2, "a", 1), (1, "a", 2), (3, "b", 3)).write.parquet(source)
    assert run() == {2: None, 1: 2, 3: None}
    rows((7, "a", 4), (8, "c", 5)).write.mode("append").parquet(source)
    assert run() == {2: None, 1: 2, 3: None, 7: 2, 8: None}


def test_archives(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"run/d{k}").mkdir(parents=True)
        (tmp_path / f"run/d{k}/x.json").write_text(f"text {k}")
    archive.pack(spark, f"file://{tmp_path}/run", f"file://{tmp_path}/run.tar.gz", "run")
    got = archive.inspect(spark, f"file://{tmp_path}/run.tar.gz")
    assert got["files"] == {f"d{k}/x.json": hashlib.sha256(f"text {k}".encode()).hexdigest() for k in range(3)} and got["total_bytes"] == 18
    with tarfile.open(tmp_path / "run.tar.gz") as tar:
        assert tar.extractfile("run/d1/x.json").read() == b"text 1"
    (tmp_path / "bad.tar.gz").write_bytes(b"no archive")
    with pytest.raises(ValueError, match="archive"):
        archive.inspect(spark, f"file://{tmp_path}/bad.tar.gz")


@pytest.mark.parametrize(("text", "left"), [("a\n" + "x" * 200_000, 2), ("x" * 200_000, 0), ("a\nb\n", 4), ("", 0)])
def test_repair_reads_from_the_end(tmp_path, text, left):
    path = tmp_path / "x.jsonl"
    path.write_text(text)
    assert jsonl.repair(str(path)) == len(text) - left and path.stat().st_size == left


def test_windows_are_updated_over_batches(spark, tmp_path):
    source = f"{tmp_path}/t/e.parquet"
    rows = lambda *r: spark.createDataFrame([(i, k, f"2024-01-01 0{h}:10:00") for i, k, h in r], "id long, event_type string, t string").selectExpr("id", "event_type", "cast(t as timestamp) as ts")
    folder = scratch.folder(spark, "hours")
    run = lambda: {(r.hour.hour, r.event_type): r.n for r in events.updated(events.hourly(events.source(spark, f"{tmp_path}/t", "e")), folder, ["hour", "event_type"]).collect()}
    rows((1, "a", 1), (2, "a", 1), (3, "b", 2)).write.parquet(source)
    assert run() == {(1, "a"): 2, (2, "b"): 1}
    rows((4, "b", 2), (5, "a", 7)).write.mode("append").parquet(source)
    assert run() == {(1, "a"): 2, (2, "b"): 2, (7, "a"): 1}
    rows((6, "a", 1), (7, "a", 7)).write.mode("append").parquet(source)  # one comes too late
    assert run() == {(1, "a"): 2, (2, "b"): 2, (7, "a"): 2}


def test_inference_goes_on_by_key(spark):
    def client():
        def ask(prompts):
            if "bad" in prompts:
                raise OSError("down")
            return [ValueError("x") if p == "odd" else p.upper() for p in prompts]

        return ask

    df = spark.createDataFrame([(1, "a"), (2, "odd"), (3, "bad"), (4, None), (5, "e")], "id long, prompt string").coalesce(1)
    done = spark.createDataFrame([(5,)], "id long")
    got = {r.id: (r.output, r.error) for r in inference.generate(df, client, done=done, at_once=1).collect()}
    assert got == {1: ("A", None), 2: (None, "ValueError: x"), 3: (None, "OSError: down"), 4: (None, "ValueError: no prompt")}
