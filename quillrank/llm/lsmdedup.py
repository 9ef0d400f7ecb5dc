"""Substring dedup with a log-structured fingerprint index.

A word is removed if a window of WINDOW words covers it whose words also begin earlier: in a document of smaller doc_id, or
earlier in the same one. Documents come in batches of rising doc_id. The index holds what is past in immutable runs: tables that
are bucketed and sorted by fingerprint. A batch's fingerprints are merge-joined with each run, bucket by bucket, without a shuffle or a
sort of what is past; what the batch adds becomes another run, and once there are FANOUT runs they are compacted to one before the next batch.

Windows that begin one after another and share an anchor, the least hash of GRAM words in them, are one entry: the anchor's
hash and the 128-bit digest of the words of these windows. Equal windows have equal anchors. So an entry that was there before
repeats as a whole. An anchor with one entry only is kept with the place of it. Once an anchor gets another entry it is shared, and the
windows of its entries, that one's included, are verified one by one, by 128-bit digests of their words, against runs of the windows
of shared anchors; from then on each new entry of that anchor is. So a text of the past is read again only for an anchor that becomes shared.

At scale: an entry stands for some eight windows, and the index keeps one row for each different entry, whatever the number
of its copies; all sums are made before the shuffle, and joins that give back rows of documents are plain joins, of which Spark splits a hot
key's, so a passage of all documents is no task's alone. A batch costs what it holds, and a reading of the runs. Runs live in the folder that
all executors share; a job that lost executors finds them whole.

Defined results: a null or empty text has no words; a text under WINDOW words loses nothing; a long text is worked through in
pieces, and one of over 2 ^ AT_BITS words is an error. Repeated rows (doc_id and text) are one text, and each gets its result. Texts that share a doc_id are one after another in the order of
a checksum. A null doc_id comes before all others. An empty table gives an empty result. Columns that clash with the operator's are replaced by them.
"""

from __future__ import annotations

import contextlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dropped, freed, read, shared_dir, slices, stored, task_files, tidy
from .windows import PolyHash, Words, anchored_runs, pieces

WINDOW, GRAM = 20, 5
#: Runs that are compacted to one, and batches in which the query reads its table: the index compacts before the last.
FANOUT, BATCHES = 2, 3

#: Bits of the first word's number, and of the checksum that tells texts of one doc_id apart.
AT_BITS, TAG_BITS = 27, 20
#: place is, in one number: the checksum, the first word's number, the number of windows (8 bits) and the anchor's distance (8 bits).
ENTRIES = "anchor long, content long, check long, doc long, place long"
KIND = ["anchor", "content", "check"]
_FIRST = -(1 << 63)
_TAG = (1 << TAG_BITS) - 1
_AT = (1 << AT_BITS) - 1


def _id(column: str = "doc_id") -> F.Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(_FIRST))


def _tag() -> F.Column:
    return F.crc32(F.coalesce("text", F.lit("")).cast("binary")).bitwiseAND(F.lit(_TAG).cast("long"))


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def entries(docs: DataFrame) -> DataFrame:
    """ENTRIES of docs (doc_id, text)."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = PolyHash(3)
        for batch in (b for whole in batches for b in slices(whole, 1)):
            ids, data = batch.column(0).to_numpy(), [_bytes(t) for t in batch.column(1).to_pylist()]
            tags = np.array([zlib.crc32(t) & _TAG for t in data], np.int64)
            for of, begins, held in pieces([t.split() for t in data], WINDOW - 1):
                w = Words(hasher, held)
                at = np.arange(len(w.start))
                if len(at) < WINDOW:
                    continue
                grams = w.runs(at[: len(at) - GRAM + 1], GRAM)
                first, n, place = anchored_runs(grams, WINDOW - GRAM + 1, at + WINDOW <= w.last)
                content = w.digests(first, first + n + WINDOW - 2)
                piece = np.searchsorted(w.first, first, "right") - 1
                text = np.array(of)[piece]
                where = np.array(begins)[piece] + first - w.first[piece]
                if len(where) and where.max() > _AT:
                    raise ValueError(f"a text has more than {_AT} words")
                cols = [grams[place].view(np.int64), content[:, 0], content[:, 1], ids[text], ((tags[text] << AT_BITS | where) << 8 | n) << 8 | (place - first)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], [*KIND, "doc", "place"])

    return docs.select(_id().alias("doc_id"), "text").mapInArrow(run, ENTRIES)


#: at is the checksum and the first word's number.
WINDOWS = "w1 long, w2 long, doc long, at long"
PRINT = ["w1", "w2"]


def windows(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """WINDOWS of the entries wanted (doc, place): digests of the words of each."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = PolyHash(3)
        for batch in (b for whole in batches for b in slices(whole, 1)):
            ids, tags = batch.column(0).to_numpy(), batch.column(3).to_numpy()
            texts = [_bytes(t).split() for t in batch.column(1).to_pylist()]
            places = [np.sort(p.values.to_numpy()) for p in batch.column(2)]
            for of, begins, held in pieces(texts, WINDOW - 1):
                starts, rows = [], []
                w = Words(hasher, held)
                for k, begin, first, count in zip(of, begins, w.first.tolist(), w.counts.tolist(), strict=True):
                    at, n = places[k] >> 16 & _AT, places[k] >> 8 & 255
                    mine = (at >= begin) & (at + n + WINDOW - 1 <= begin + count)
                    at, n = at[mine], n[mine]
                    each = np.repeat(at - begin + first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    starts.append(each)
                    rows.append(np.stack([np.full(len(each), ids[k]), tags[k] << AT_BITS | each - first + begin]))
                at, (doc, where) = np.concatenate(starts), np.concatenate(rows, axis=1)
                if len(at):
                    prints = w.digests(at, at + WINDOW - 1)
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (prints[:, 0], prints[:, 1], doc, where)], [*PRINT, "doc", "at"])

    lists = wanted.groupBy("doc", F.shiftright("place", AT_BITS + 16).alias("tag")).agg(F.collect_set("place").alias("places"))
    own = docs.select(_id().alias("_id"), "text", _tag().alias("_tag"))
    found = own.join(lists, (F.col("_id") == F.col("doc")) & (F.col("_tag") == F.col("tag"))).select("doc", "text", "places", "tag")
    return found.mapInArrow(run, WINDOWS)


@contextlib.contextmanager
def _in_order(spark: SparkSession) -> Iterator[None]:
    """Runs have one file a bucket, sorted; within this, plans know it."""
    key = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    was = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, was)


class Runs:
    """Immutable sorted runs of rows by some keys, in a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, folder: str, keys: list[str], buckets: int) -> None:
        self.spark, self.folder, self.keys, self.buckets = spark, folder, keys, buckets
        self.names: list[str] = []
        self._made = 0

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def write(self, rows: DataFrame) -> str:
        """rows, one for each key and dealt out by the keys or by nothing, as a run that isn't the index's yet."""
        name, self._made = f"quillrank_{uuid.uuid4().hex}_{self._made}", self._made + 1
        rows.write.bucketBy(self.buckets, *self.keys).sortBy(*self.keys).format("parquet").option("path", self.path(name)).saveAsTable(name)
        return name

    def plain(self, name: str) -> DataFrame:
        """A run as a table that Spark may deal out anew, for joins with a hot key's rows."""
        return self.spark.read.schema(self.spark.table(name).schema).parquet(self.path(name))

    def joined(self, rows: DataFrame, columns: dict[str, F.Column]) -> DataFrame:
        """rows, merge-joined with each run: with columns, made of the run's, under their name and the run's number; null where
        it has none."""
        for k, name in enumerate(self.names):
            run = self.spark.table(name).where("old = 0")
            rows = rows.join(run.select(*self.keys, *[c.alias(f"{x}_{k}") for x, c in columns.items()]), self.keys, "left")
        return rows

    def any(self, column: str) -> F.Column:
        """Of joined(): the greatest of the runs' values, or null."""
        cols = [F.col(f"{column}_{k}") for k in range(len(self.names))]
        return F.greatest(*cols) if len(cols) > 1 else cols[0] if cols else F.lit(None)

    def compact(self, columns: dict[str, F.Column]) -> None:
        """One run of all, by a merge join of them. The old ones are then deleted."""
        old = self.names
        runs = [self.spark.table(n).where("old = 0").select(*self.keys, *[c.alias(f"{x}_{k}") for x, c in columns.items()]) for k, n in enumerate(old)]
        merged = runs[0]
        for run in runs[1:]:
            merged = merged.join(run, self.keys, "full")
        merged = merged.select(*self.keys, *[F.greatest(*[F.col(f"{x}_{k}") for k in range(len(old))]).alias(x) for x in columns], F.lit(0).alias("old"))
        self.names = [self.write(merged)]
        self.drop(old)

    def drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        dropped(self.spark, *map(self.path, names))


class FingerprintIndex:
    """Runs of entries, of anchors (one: an entry's doc and place; shared: 1 if it is not the only one) and of the windows of
    shared anchors. In all of them rows with old = 1 are in an earlier run, too."""

    def __init__(self, spark: SparkSession, folder: str | None = None, buckets: int | None = None) -> None:
        self.spark, self.folder = spark, folder or shared_dir(spark)
        buckets = buckets or task_files(spark.range(1))
        self.entries, self.anchors, self.windows = (Runs(spark, f"{self.folder}/{k}", keys, buckets) for k, keys in (("entries", KIND), ("anchors", ["anchor"]), ("windows", PRINT)))
        self._made = 0

    @property
    def runs(self) -> list[str]:
        return self.entries.names

    def compact(self) -> None:
        self.entries.compact({})
        self.anchors.compact({"one": F.col("one"), "shared": F.col("shared")})  # an anchor of two runs is shared in the later
        self.windows.compact({})

    def ingest(self, docs: DataFrame, corpus: DataFrame, low: int | None = None) -> DataFrame:
        """doc, at and n: runs of windows, from word at on, that begin earlier too. docs: a batch with doc_ids above low and
        all batches before; corpus: where the texts of all batches, this one included, are read for verification."""
        with _in_order(self.spark):
            return self._ingest(docs, corpus, low)

    def _ingest(self, docs: DataFrame, corpus: DataFrame, low: int | None) -> DataFrame:
        spark, here, self._made = self.spark, f"{self.folder}/batch-{self._made}", self._made + 1
        if len(self.runs) >= FANOUT:
            self.compact()
        rows = stored(entries(docs), f"{here}/rows", shuffled=False)
        place = F.struct("doc", "place")
        # entries: of the batch, once each, and which of them an earlier run has
        kinds = rows.groupBy(*KIND).agg(F.min(place).alias("first"), F.count("*").alias("times"))
        kinds = self.entries.joined(kinds, {"old": F.lit(1)}).select(*KIND, "first", "times", F.coalesce(self.entries.any("old"), F.lit(0)).alias("old"))
        entry_run = self.entries.write(kinds)
        kinds = self.entries.plain(entry_run)
        again = kinds.where("times + old > 1").select(*KIND, "first", "old")
        freed(spark)
        count = F.shiftright("place", 8).bitwiseAND(F.lit(255).cast("long"))
        whole = rows.join(again, KIND).where((F.col("old") == 1) | (place > F.col("first"))).select("doc", F.shiftright("place", 16).alias("at"), count.alias("n"))
        whole = stored(whole, f"{self.folder}/whole-{self._made}")
        dropped(spark, f"{here}/rows")
        freed(spark)
        # anchors: with their new entries, and what earlier runs know of them
        new = kinds.where("old = 0").select("anchor", "first")
        mine = new.groupBy("anchor").agg(F.min("first").alias("one"), F.count("*").alias("n"))
        mine = self.anchors.joined(mine, {"was": F.col("one"), "known": F.col("shared")})
        known, was = self.anchors.any("known").cast("int"), self.anchors.any("was").cast("struct<doc:long,place:long>")
        shared = F.when((F.col("n") > 1) | known.isNotNull(), 1).otherwise(0)
        mine = mine.select("anchor", "one", shared.alias("shared"), F.when(known == 0, was).alias("turned"), F.lit(0).alias("old"))
        anchor_run = self.anchors.write(mine)
        mine = self.anchors.plain(anchor_run)
        freed(spark)
        # windows of new entries of shared anchors, and of entries that were their anchor's only one until now
        fresh = new.join(mine.where("shared = 1").select("anchor"), "anchor", "left_semi").select("first.*")
        turned = mine.where("turned is not null").select("turned.*")
        texts = docs if low is None else corpus
        cut = stored(windows(texts, fresh.unionByName(turned)), f"{here}/cut", shuffled=False)
        freed(spark)
        at = F.struct("doc", "at")
        prints = cut.groupBy(*PRINT).agg(F.min(at).alias("first"), F.count("*").alias("times"))
        prints = self.windows.joined(prints, {"old": F.lit(1)}).select(*PRINT, "first", "times", F.coalesce(self.windows.any("old"), F.lit(0)).alias("old"))
        window_run = self.windows.write(prints)
        repeated = self.windows.plain(window_run).where("times + old > 1").select(*PRINT, "first", "old")
        mine_only = cut if low is None else cut.where(F.col("doc") > low)
        part = mine_only.join(repeated, PRINT).where((F.col("old") == 1) | (at > F.col("first"))).select("doc", "at", F.lit(1).cast("long").alias("n"))
        part = stored(part, f"{self.folder}/part-{self._made}")
        self.entries.names = [*self.entries.names, entry_run]
        self.anchors.names = [*self.anchors.names, anchor_run]
        self.windows.names = [*self.windows.names, window_run]
        dropped(spark, here)
        freed(spark)
        return whole.unionByName(part)

    def close(self) -> None:
        """Deletes the index. What ingest() gave stays."""
        for runs in (self.entries, self.anchors, self.windows):
            runs.drop(runs.names)


def batch_edges(docs: DataFrame, batches: int = BATCHES) -> list[int]:
    """doc_ids that part the table into batches, about even. They change the work's order, not its result."""
    if batches < 2:
        return []
    got = docs.select(F.percentile_approx(_id(), [k / batches for k in range(1, batches)], 1000).alias("q")).first()["q"]
    return sorted(set(got or []))


_NEW = [("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.string())]
NEW = "n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept string"


def without_repeats(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), batches: int = BATCHES) -> DataFrame:
    """The columns keep of docs (doc_id, text and others), with NEW: spans of words that go, and the kept words, one space
    between them."""
    own = [c for c in keep if c not in {n for n, _ in _NEW}]
    edges = batch_edges(docs, batches)
    index, found = FingerprintIndex(docs.sparkSession), None
    for low, high in zip([None, *edges], [*edges, None], strict=True):
        batch = docs
        if low is not None:
            batch = batch.where(_id() > low)
        if high is not None:
            batch = batch.where(_id() <= high)
        got = index.ingest(batch, docs if high is None else docs.where(_id() <= high), low)
        found = got if found is None else found.unionByName(got)
    index.close()
    lists = found.groupBy("doc", F.shiftright("at", AT_BITS).alias("tag")).agg(F.collect_set(F.struct(F.col("at").bitwiseAND(F.lit(_AT).cast("long")).alias("at"), "n")).alias("wanted"))
    both = docs.select(*[F.col(f"`{c}`") for c in own], F.col("text").alias("_text"), _id().alias("_id"), _tag().alias("_tag"))
    both = both.join(lists, (F.col("_id") == F.col("doc")) & (F.col("_tag") == F.col("tag")), "left").drop("_id", "doc", "_tag", "tag")

    @tidy
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(own)
        for batch in (b for whole in parts for b in slices(whole, k)):
            rows = []
            for text, wanted in zip(batch.column(k), batch.column(k + 1), strict=True):
                words, spans = _bytes(text.as_py()).split(), np.zeros((0, 2), np.int64)
                if wanted.is_valid and len(words) >= WINDOW:
                    step = np.zeros(len(words) + 1, np.int32)
                    at, n = (wanted.values.field(j).to_numpy() for j in (0, 1))
                    np.add.at(step, at, 1)
                    np.add.at(step, np.minimum(at + n - 1 + WINDOW, len(words)), -1)
                    spans = np.flatnonzero(np.diff((np.cumsum(step[:-1]) > 0).astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
                cuts = [0, *spans.ravel().tolist(), len(words)]
                kept = [w for a, b in zip(cuts[::2], cuts[1::2], strict=True) for w in words[a:b]] if len(spans) else words
                rows.append((len(words), len(words) - len(kept), [{"start": a, "end": b} for a, b in spans.tolist()], b" ".join(kept).decode("utf-8", "replace")))
            cols = [batch.column(j) for j in range(k)]
            cols += [pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), _NEW, strict=True)]
            yield pa.RecordBatch.from_arrays(cols, [*own, *(n for n, _ in _NEW)])

    schema = ", ".join(f"`{c}` {both.schema[c].dataType.simpleString()}" for c in own)
    return both.mapInArrow(run, f"{schema}, {NEW}" if own else NEW)


def op7_lsm_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), F.size("spans").cast("long").alias("n_spans"))


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), w AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + 19], ' ')) AS m FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM d WHERE len(ws) >= 20)
), r AS (
  SELECT doc_id, i FROM w QUALIFY row_number() OVER (PARTITION BY m ORDER BY doc_id, i) > 1
), g AS (
  SELECT doc_id, i, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS g
  FROM (SELECT doc_id, i, i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -1000) + 20 AS new FROM r)
), p AS (
  SELECT doc_id, min(i) AS a, max(i) + 20 AS b FROM g GROUP BY doc_id, g
), k AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 1) AS was FROM p
), t AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last FROM k GROUP BY doc_id
), kept AS (
  SELECT doc_id, flatten(list(ws[was:a - 1] ORDER BY a)) AS ws FROM k JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(array_to_string(CASE WHEN t.doc_id IS NULL THEN d.ws ELSE list_concat(kept.ws, d.ws[last:]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
