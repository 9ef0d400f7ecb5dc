"""Suffix-array dedup: long substrings that occur twice, found in run-length indexes.

A byte is removed if a string of LENGTH bytes, or as many as the caller says, covers it that also begins anywhere else in the corpus. Every
window of so many bytes has an anchor: of the hashes of its GRAM-byte strings the least, and of equal ones the first. Equal windows have
equal anchors, so the windows of one anchor hash can be judged apart from all others. Windows that begin one after another and share
their anchor make a segment; segments of equal content, by a 128-bit digest of their bytes, are counted and one of them stands for all,
as does a run for its characters. Anchors that occur once are done with. The segments of the others are laid out, a megabyte at a time
and an anchor's together, in a run-length index (rindex.py), whose matching statistics, by bytes, give the starts of windows that occur again.

At scale: rows about segments, one for some 170 bytes, are summed by content before anything meets, so that a passage of all
documents is a few rows. An anchor of more than HOT different segments, at the edges of such a passage, is split: its segments
are cut to BLOCK starts, and blocks whose windows have a core in common, which equal windows must have, go to one group. A group of more
than HOT different blocks, around one long core, is no index's: its windows are summed by the digests of their bytes, which deals
them out evenly. So no index gets more than some INDEX_BYTES and one group. Texts are read three times and dealt out by document twice; nothing
is gathered beyond a document or a group. Tables that are done with are deleted.

Defined results: a null text counts as empty; texts under LENGTH bytes lose nothing, and a text of any length is worked through in pieces;
of repeated rows or equal texts of LENGTH bytes or more nothing is kept, since each also begins in the other; rows are told apart by
doc_id and text, and a null doc_id is one like others. An empty table gives an empty result. Columns that clash with the operator's are
replaced by them.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dropped, freed, read, shared_dir, slices, stored, tidy
from .rindex import repeated_starts
from .windows import AnchorHash, anchored_runs, digest128

LENGTH, GRAM = 400, 48
#: Bytes of a text worked on at once; windows that begin in one piece end in it.
PIECE = 1 << 19
#: Different segments of an anchor, or blocks of a group, from which it is split, and starts of a block.
HOT, BLOCK = 1000, 16
#: Bytes of segments in an index, about. Making one takes some 90 bytes for each.
INDEX_BYTES = 1 << 20

#: A run of windows with one anchor: the anchor's hash, the content's digest, the text (doc_id, checksum), and its place: the first
#: start, the number of starts and how far after the first start the anchor is, in one number: (at << 16 | n) << 16 | off.
SEGMENTS = "anchor long, content long, check long, doc long, crc long, place long"
_FIELD = (1 << 16) - 1
KIND = ["anchor", "content", "check"]
_RANGES = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _packs(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bytes]]:
    """Pieces of the texts of length bytes or more, laid end to end: for each piece its text's number, where it begins in that
    text and where in the pack. Every window begins in one piece and lies in it."""
    of, within, begins, held, size = [], [], [], [], 0
    for k, data in enumerate(texts):
        for at in range(0, len(data) - length + 1, PIECE):
            piece = data[at : at + PIECE + length - 1]
            of.append(k)
            within.append(at)
            begins.append(size)
            held.append(piece)
            size += len(piece)
            if size >= PIECE:
                yield np.array(of), np.array(within), np.array(begins), b"".join(held)
                of, within, begins, held, size = [], [], [], [], 0
    if held:
        yield np.array(of), np.array(within), np.array(begins), b"".join(held)


def pack_segments(begins: np.ndarray, data: bytes, hasher: AnchorHash, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """anchor, content (two numbers), piece, start in the pack, number of starts and offset of the anchor, of each segment of a pack."""
    raw = np.frombuffer(data, np.uint8)
    grams = hasher.all(raw, GRAM)
    ends = np.append(begins[1:], len(raw))
    valid = np.repeat(ends, ends - begins) - np.arange(len(raw)) >= length  # windows within their piece
    first, n, place = anchored_runs(grams, length - GRAM + 1, valid)
    piece = np.searchsorted(begins, first, "right") - 1
    content = digest128([data[a:b] for a, b in zip(first.tolist(), (first + n + length - 1).tolist(), strict=True)])
    return grams[place], content, piece, first, n, place - first


def segments(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """SEGMENTS of docs (doc_id, text)."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = AnchorHash(2)
        for batch in (b for whole in batches for b in slices(whole, 1)):
            texts = [_bytes(t) for t in batch.column(1).to_pylist()]
            crcs = np.array([zlib.crc32(t) for t in texts], np.int64)
            for of, within, begins, data in _packs(texts, length):
                anchor, content, piece, first, n, off = pack_segments(begins, data, hasher, length)
                row = of[piece]
                cols = [pa.array(anchor.view(np.int64)), pa.array(content[:, 0]), pa.array(content[:, 1]), batch.column(0).take(pa.array(row)), pa.array(crcs[row])]
                cols += [pa.array((within[piece] + first - begins[piece] << 16 | n) << 16 | off)]
                yield pa.RecordBatch.from_arrays(cols, [*KIND, "doc", "crc", "place"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SEGMENTS)


_PART = pa.schema([("part", pa.int64()), ("key", pa.int64()), ("key2", pa.int64()), ("bytes", pa.binary()), *((k, pa.int64()) for k in KIND), ("begin", pa.int32()), ("hot", pa.bool_())])
PARTS = "part long, key long, key2 long, bytes binary, anchor long, content long, check long, begin int, hot boolean"
CUT = ["part", "key", "key2"]


def _crc() -> F.Column:
    """The checksum by which texts of one doc_id are told apart."""
    return F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("_crc")


def _digest(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def _parted(place: int) -> tuple[int, int, int]:
    return place >> 32, place >> 16 & _FIELD, place & _FIELD


def _blocks(w: dict, data: bytes, length: int) -> Iterator[tuple[int, int, bytes]]:
    """Blocks of a segment, by the distance to the anchor: the group, the first start in the segment, and the bytes."""
    at, n, off = _parted(w["place"])
    anchor_at, begin = at + off, 0
    while begin < n:
        b = (off - begin) // BLOCK
        stop = min(n, off - b * BLOCK + 1)
        core = data[anchor_at - b * BLOCK : anchor_at - (b + 1) * BLOCK + 1 + length]
        yield _digest(b"%d,%d," % (w["anchor"], b) + core), begin, data[at + begin : at + stop + length - 1]
        begin = stop


def parts(docs: DataFrame, kinds: DataFrame, length: int = LENGTH) -> DataFrame:
    """The bytes of the kinds (KIND, doc, crc, place, hot), each with the group in which it is judged."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for whole in batches for b in slices(whole, 0)):
            rows, size = [], 0
            for text, wanted in zip(batch.column(0), batch.column(1), strict=True):
                data = _bytes(text.as_py())
                crc = zlib.crc32(data)
                for w in wanted.as_py():
                    if w["crc"] != crc:
                        continue
                    own = {k: w[k] for k in KIND}
                    if w["hot"]:
                        cut = list(_blocks(w, data, length))
                        for (part, begin, block), (key, key2) in zip(cut, digest128([c[2] for c in cut]).tolist(), strict=True):
                            rows.append({"part": part, "key": key, "key2": key2, "bytes": block, "begin": begin, "hot": True} | own)
                            size += len(block)
                    else:
                        at, n, _ = _parted(w["place"])
                        whole = data[at : at + n + length - 1]
                        rows.append({"part": w["anchor"], "key": w["content"], "key2": w["check"], "bytes": whole, "begin": 0, "hot": False} | own)
                        size += len(whole)
                    if size >= 2 << 20:
                        yield pa.RecordBatch.from_pylist(rows, _PART)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _PART)

    lists = kinds.groupBy("doc", "crc").agg(F.collect_list(F.struct(*KIND, "crc", "place", "hot")).alias("wanted"))
    found = docs.select(F.col("doc_id").cast("long"), "text", _crc()).join(lists, F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("_crc") == F.col("crc")))
    return found.select("text", "wanted").mapInArrow(run, PARTS)


def _ranges(mark: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(mark.astype(np.int8), prepend=0, append=0)).tolist()
    return [{"a": a, "b": b} for a, b in zip(edges[::2], edges[1::2], strict=True)]


FOUND = "part long, key long, key2 long, ranges array<struct<a:int,b:int>>"


def judged(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """FOUND: ranges of starts that begin length bytes found again, from rows (CUT, bytes, times), by indexes."""
    schema = pa.schema([*((k, pa.int64()) for k in CUT), ("ranges", _RANGES)])

    def index(held: list[tuple]) -> pa.RecordBatch:
        out = []
        for (part, key, key2, cut, times), mark in zip(held, repeated_starts([h[3] for h in held], length), strict=True):
            starts = len(cut) - length + 1
            ranges = [{"a": 0, "b": starts}] if times > 1 else _ranges(mark[:starts])
            if ranges:
                out.append({"part": part, "key": key, "key2": key2, "ranges": ranges})
        return pa.RecordBatch.from_pylist(out, schema)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= INDEX_BYTES and row[0] != held[-1][0]:
                    yield index(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield index(held)

    dealt = rows.select(*CUT, "bytes", "times").repartition("part").sortWithinPartitions("part")
    return dealt.mapInArrow(run, FOUND)


def by_windows(rows: DataFrame, folder: str, length: int = LENGTH) -> DataFrame:
    """FOUND, as of judged(), for rows of groups of any size: by the digests of all windows. folder: for a table of those that
    occur again, by which Spark can split the join with a hot one."""
    each = rows.select(*CUT, "times", "bytes", F.explode(F.sequence(F.lit(0), F.length("bytes") - length)).alias("s"))
    each = each.select(*CUT, "times", "s", F.md5(F.substring(F.col("bytes"), F.col("s") + 1, F.lit(length))).alias("window"))
    again = each.groupBy(F.col("window").alias("_w")).agg(F.sum("times").alias("n")).where("n > 1").select("_w")
    again = stored(again, folder)
    starts = each.join(again, F.col("window") == F.col("_w"), "left_semi")
    return starts.groupBy(*CUT).agg(F.collect_list(F.struct(F.col("s").alias("a"), (F.col("s") + 1).alias("b"))).alias("ranges"))


def marks(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc, crc and wanted: for each text with repeats, (crc, at, ranges of starts from at on)."""
    spark = docs.sparkSession
    folder = shared_dir(spark)
    rows = stored(segments(docs, length), f"{folder}/segments", shuffled=False)
    kinds = rows.groupBy(*KIND).agg(F.count("*").alias("times"), F.min(F.struct("doc", "crc", "place")).alias("one"))
    kinds = stored(kinds, f"{folder}/kinds")
    anchors = kinds.groupBy(F.col("anchor").alias("_a")).agg(F.count("*").alias("different")).where("different > 1")
    anchors = stored(anchors, f"{folder}/anchors")
    todo = kinds.join(anchors, F.col("anchor") == F.col("_a")).select(*KIND, "one.*", (F.col("different") > HOT).alias("hot"))
    cut = stored(parts(docs, todo, length), f"{folder}/cut", shuffled=False)
    freed(spark)
    same = cut.where("hot").groupBy(*CUT).agg(F.first("bytes").alias("bytes"), F.count("*").alias("times"))
    same = stored(same, f"{folder}/same")
    large = same.groupBy(F.col("part").alias("_p")).agg(F.count("*").alias("blocks")).where(F.col("blocks") > HOT)
    small = same.join(large, F.col("part") == F.col("_p"), "left_anti").unionByName(cut.where("not hot").select(*CUT, "bytes", F.lit(1).cast("long").alias("times")))
    found = stored(judged(small, length), f"{folder}/found", shuffled=False)
    wide = stored(by_windows(same.join(large, F.col("part") == F.col("_p"), "left_semi"), f"{folder}/again", length), f"{folder}/wide")
    freed(spark)
    shift = F.transform("ranges", lambda r: F.struct((r["a"] + F.col("begin")).alias("a"), (r["b"] + F.col("begin")).alias("b")))
    by_index = cut.drop("bytes").join(found.unionByName(wide), CUT).select(*KIND, shift.alias("ranges")).groupBy(*KIND).agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    count = F.shiftright("one.place", 16).bitwiseAND(F.lit(_FIELD).cast("long")).cast("int")
    again = kinds.where("times > 1").select(*KIND, F.array(F.struct(F.lit(0).alias("a"), count.alias("b"))).alias("ranges"))
    once = by_index.join(again.select(*KIND), KIND, "left_anti")
    out = stored(rows.join(again.unionByName(once), KIND).groupBy("doc", "crc").agg(F.collect_set(F.struct("crc", F.shiftright("place", 32).alias("at"), "ranges")).alias("wanted")), f"{folder}/marks")
    dropped(spark, *(f"{folder}/{x}" for x in ("segments", "kinds", "anchors", "cut", "same", "found", "again", "wide")))
    freed(spark)
    return out


def removed_spans(n_bytes: int, crc: int, wanted: list[dict] | None, length: int = LENGTH) -> np.ndarray:
    """Maximal spans to remove, (count, 2), from the starts of repeats."""
    step = np.zeros(n_bytes + 1, np.int32)
    for w in wanted or ():
        if w["crc"] == crc:
            for r in w["ranges"]:
                step[w["at"] + r["a"]] += 1
                step[w["at"] + r["b"] - 1 + length] -= 1
    edges = np.flatnonzero(np.diff((np.cumsum(step[:-1]) > 0).astype(np.int8), prepend=0, append=0))
    return edges.reshape(-1, 2)


_NEW = [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())]
NEW = "n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"


def without_repeats(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), as_text: bool = False, length: int = LENGTH) -> DataFrame:
    """The columns keep of docs (doc_id, text and others), with NEW: what was removed, in bytes, and the bytes that stay; as_text:
    as a string, without characters of which only some bytes stay."""
    if not GRAM < length <= _FIELD:
        raise ValueError(f"length must be over {GRAM} bytes, and {_FIELD} at most")
    own = [c for c in keep if c not in {n for n, _ in _NEW}]
    found = marks(docs, length)
    both = docs.select(*[F.col(f"`{c}`") for c in own], F.col("text").alias("_text"), F.col("doc_id").cast("long").alias("_id"), _crc())
    both = both.join(found, F.col("_id").eqNullSafe(F.col("doc")) & (F.col("_crc") == F.col("crc")), "left").drop("_id", "_crc", "doc", "crc")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(own)
        for batch in (b for whole in batches for b in slices(whole, k)):
            rows = []
            for text, wanted in zip(batch.column(k), batch.column(k + 1), strict=True):
                data, wanted = _bytes(text.as_py()), wanted.as_py()
                spans = removed_spans(len(data), zlib.crc32(data), wanted, length) if wanted else np.zeros((0, 2), np.int64)
                at = [0, *spans.ravel().tolist(), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(at[::2], at[1::2], strict=True))
                rows.append((len(data), len(data) - len(kept), [{"start": a, "end": b} for a, b in spans.tolist()], kept))
            cols = [batch.column(j) for j in range(k)]
            n_bytes, n_removed, spans_, kept_ = zip(*rows, strict=True)
            last = pa.array([x.decode("utf-8", "ignore") for x in kept_], pa.string()) if as_text else pa.array(kept_, pa.binary())
            cols += [pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans_, _NEW[2][1]), last]
            yield pa.RecordBatch.from_arrays(cols, [*own, *(n for n, _ in _NEW)])

    schema = ", ".join(f"`{c}` {both.schema[c].dataType.simpleString()}" for c in own)
    new = NEW.replace("kept binary", "kept string") if as_text else NEW
    return both.mapInArrow(run, f"{schema}, {new}" if own else new)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), w AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 800)) AS m FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 399)) AS i FROM d WHERE length(h) >= 800)
), r AS (
  SELECT doc_id, i FROM w QUALIFY count(*) OVER (PARTITION BY m) > 1
), s AS (
  SELECT doc_id, i, i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -1000) + 400 AS new FROM r
), g AS (
  SELECT doc_id, i, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM s
), p AS (
  SELECT doc_id, min(i) AS a, max(i) + 400 AS b FROM g GROUP BY doc_id, g
), k AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS was FROM p
), t AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last FROM k GROUP BY doc_id
), kept AS (
  SELECT k.doc_id, string_agg(substr(h, 2 * was + 1, 2 * (a - was)), '' ORDER BY a) AS h FROM k JOIN d USING (doc_id) GROUP BY k.doc_id
)
SELECT d.doc_id, (length(d.h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN t.doc_id IS NULL THEN d.h ELSE kept.h || substr(d.h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
