"""Near-duplicate documents by HyperMinHash.

A document is the set of its distinct shingles, runs of SHINGLE words or of as many as the caller says. Its sketch has REGISTERS
registers: the leading bits of a shingle's fingerprint choose one, and it keeps the least of the remaining bits, as the number of
their leading zeros and the MANTISSA bits that follow. Empty registers copy another one, the first that is not empty in a fixed
random order. Bands of compressed registers are compared; candidates are estimated with the expected chance agreements taken off,
and those that may reach the threshold are confirmed on their full sets, of fingerprints modulo a prime of 61 bits (windows.py).

Documents of equal sets are one class, by its smallest doc_id, and only classes go on. Of a band's bucket the class that shares most
with others, by the sizes of all its buckets, is the leader: of a text and its copies that is the text, as a rule. First each class is held
against the best of its buckets' leaders, one pair for each class, which joins most groups of copies whatever their size. What is
confirmed makes components, and a bucket of one component is done with, as is one whose only pair is refuted. The classes of all other
buckets of a leader are a group, whose members meet in a task; it goes through the buckets and confirms or refutes every pair in one,
unless the two are known to be in one component by then: no link is lost, and pairs are never rows. Sets of up to SMALL shingles, for which a
sketch is coarse, also share buckets by their first shingles in the order of the fingerprints (prefix filtering), which finds all
their links for certain. For the others a pair at the threshold shares no band with a probability of (1 - 0.8 ^ 6) ^ 42, 3e-6.

At scale: band rows are summed by bucket before they meet, and joins on a bucket or a leader can be split where it is hot. Full sets are
made again, from the texts, for classes that share a bucket with another, and for no others. A group of more than BLOCK classes
or BLOCK_BYTES of sets is cut into blocks, and a task gets two of them, so that its memory is bounded whatever the group's size; a group of
n blocks costs n copies of its sets, but for the component that has most of it, which meets the rest alone. A document alone may be larger than a block. Tables that are done with are deleted.

Defined results: a null or empty text, or one without words, has no shingles and is linked with nothing. A text of any length is
one set; its words are hashed piece by piece. Rows that share a doc_id are one document; a null doc_id is a document of its own
that is kept. Repeated rows get the same result each. An empty table gives an empty result. Other columns of the input are not kept by
near_duplicates(), and all are by deduplicated().
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dropped, freed, read, shared_dir, slices, stored, tidy
from .graph import components
from .windows import LOWER, PolyHash, word_windows

SHINGLE, THRESHOLD = 4, 80
REGISTER_BITS, MANTISSA, ROWS = 8, 10, 6
REGISTERS = 1 << REGISTER_BITS
BANDS = REGISTERS // ROWS
#: Sets of so many shingles also meet by their first ones.
SMALL = 32
#: Classes of a group that meet in one task, and bytes of their sets: two blocks of so many.
BLOCK, BLOCK_BYTES = 1024, 4 << 20
#: Shingles of a block's members, the most frequent ones, that are compared as bits.
FREQUENT = 1024
#: An estimate is let through from so many standard deviations below the threshold.
SIGMAS = 7
_PROBES = 512


def _probes() -> np.ndarray:
    return np.random.default_rng(7).integers(0, REGISTERS, (REGISTERS, _PROBES))


def compressed(rest: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa of 64-bit numbers, in 16 bits."""
    _, length = np.frexp((rest >> np.uint64(11)).astype(np.float64))
    zeros = (53 - length).astype(np.uint64)
    return (zeros << np.uint64(MANTISSA) | (rest << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)).astype("<u2")


def sketch(hashes: np.ndarray, probes: np.ndarray) -> np.ndarray:
    """The registers of sorted distinct hashes, of which there is one at least."""
    edges = np.arange(REGISTERS + 1, dtype=np.uint64) << np.uint64(64 - REGISTER_BITS)
    at = np.searchsorted(hashes, edges[:-1])
    full = np.diff(at, append=len(hashes)) > 0
    out = np.zeros(REGISTERS, "<u2")
    out[full] = compressed(hashes[at[full]] << np.uint64(REGISTER_BITS))
    if not full.all():
        empty = np.flatnonzero(~full)
        hit = full[probes[empty]]
        first = hit.argmax(axis=1)
        found = hit[np.arange(len(empty)), first]
        out[empty] = np.where(found, out[probes[empty, first]], out[full.argmax()])
    return out


def estimated(x: np.ndarray, others: np.ndarray, n: int, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity of a sketch's set of n shingles with others of m, less the agreements that chance gives: of registers
    of unrelated sets, a share of 0.1699 * 2 ^ -MANTISSA * 4 n m / (n + m) ^ 2 agrees, about."""
    chance = 0.1699 * 2.0**-MANTISSA * 4 * n * m / (n + m) ** 2
    return ((others == x).mean(axis=1) - chance) / (1 - chance)


def prefix_length(n: int) -> int:
    """Sets of n shingles that reach the threshold with another share one of so many that come first in any common order."""
    return n - -(-THRESHOLD * n // 100) + 1


def shingles(texts: list[str | None], hasher: PolyHash, k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct hashes of the shingles of each text."""
    words = [t.encode("utf-8", "surrogatepass").translate(LOWER).split() if t else [] for t in texts]
    return [np.unique(x) for x in word_windows(hasher, words, k, short=True)]


def _key(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


SIGNED = "doc_id long, n_shingles long, set_key binary, sketch binary, firsts array<long>"


def signatures(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """SIGNED for each row of docs (doc_id, text), on shingles of so many words."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, probes = PolyHash(), _probes()
        for whole in batches:
            for batch in slices(whole, 1):
                n, keys, sketches, firsts = [], [], [], []
                for s in shingles(batch.column(1).to_pylist(), hasher, shingle):
                    n.append(len(s))
                    keys.append(_key(s))
                    sketches.append(sketch(s, probes).tobytes() if len(s) else None)
                    firsts.append(s[: prefix_length(len(s))].view(np.int64) if 0 < len(s) <= SMALL else np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(sketches, pa.binary()), pa.array(firsts, pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "set_key", "sketch", "firsts"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SIGNED)


def buckets(classes: DataFrame) -> DataFrame:
    """bucket and cls for each class and each bucket that it is in."""
    band = lambda b: F.xxhash64(b, F.substring(F.col("sketch"), b * (2 * ROWS) + 1, F.lit(2 * ROWS)))
    keys = F.concat(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), band), F.transform("firsts", lambda x: F.xxhash64(F.lit(-1), x)))
    return classes.select("cls", F.explode(keys).alias("bucket"))


def full_sets(docs: DataFrame, ids: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """cls, sketch and full set, made anew from the texts, of the documents ids (cls)."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, probes = PolyHash(), _probes()
        for whole in batches:
            for batch in slices(whole, 1):
                sets = shingles(batch.column(1).to_pylist(), hasher, shingle)
                cols = [pa.array(c, pa.binary()) for c in ([_key(s) for s in sets], [sketch(s, probes).tobytes() if len(s) else None for s in sets], [s.tobytes() for s in sets])]
                yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["cls", "set_key", "sketch", "hashes"])

    wanted = docs.select(F.col("doc_id").cast("long"), "text").join(ids, F.col("doc_id") == F.col("cls"), "left_semi")
    return wanted.mapInArrow(run, "cls long, set_key binary, sketch binary, hashes binary").where("set_key is not null").dropDuplicates(["cls", "set_key"])


def band_keys(sketches: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of buckets and the members in them, one entry for each; equal keys are one bucket."""
    keys, of = [], []
    for b in range(BANDS):
        rows = np.ascontiguousarray(sketches[:, b * ROWS : (b + 1) * ROWS]).view("V%d" % (2 * ROWS)).ravel()
        keys.append(np.unique(rows, return_inverse=True)[1].astype(np.uint64) | np.uint64(b + 1) << np.uint64(40))
        of.append(np.arange(len(sketches)))
    for i, s in enumerate(sets):
        if len(s) <= SMALL:
            keys.append(s[: prefix_length(len(s))] >> np.uint64(1) | np.uint64(1 << 63))
            of.append(np.full(len(keys[-1]), i))
    return np.concatenate(keys), np.concatenate(of)


class Group:
    """Members that are held against each other: their sets, sketches, known components and, for bits, the most frequent shingles
    of all."""

    def __init__(self, sets: list[np.ndarray], sketches: np.ndarray, side: np.ndarray, known: np.ndarray) -> None:
        self.sets, self.sketches, self.side, self.known = sets, sketches, side, known
        self.n = np.array([len(s) for s in sets])
        words, at, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        of = np.repeat(np.arange(len(sets)), self.n)
        common = np.flatnonzero(counts > 1)
        common = common[np.argsort(-counts[common], kind="stable")]
        bit = np.full(len(words), -1)
        bit[common[:FREQUENT]] = np.arange(min(FREQUENT, len(common)))
        bits = np.zeros((len(sets), FREQUENT), bool)
        got = bit[at]
        bits[of[got >= 0], got[got >= 0]] = True
        self.bits = np.packbits(bits, axis=1).view(np.uint64)
        rare = (got < 0) & (counts[at] > 1)
        self.rare = np.bincount(of[rare], minlength=len(sets))  # shared with someone, but not among the bits

    def linked(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those of the others that reach the threshold with i: estimated, then bounded, then counted on the full sets."""
        n, m = self.n[i], self.n[others]
        others = others[100 * np.minimum(n, m) >= THRESHOLD * np.maximum(n, m)]
        m, t = self.n[others], THRESHOLD / 100
        slack = SIGMAS * (t * (1 - t) * (1 / REGISTERS + 1 / np.minimum(n, m))) ** 0.5
        others = others[(np.minimum(n, m) <= SMALL) | (estimated(self.sketches[i], self.sketches[others], n, m) >= t - slack)]
        m = self.n[others]
        least = -(-THRESHOLD * (n + m) // (100 + THRESHOLD))  # the shingles that both must have
        both = np.bitwise_count(self.bits[others] & self.bits[i]).sum(axis=1).astype(np.int64)
        ok = both + np.minimum(self.rare[i], self.rare[others]) >= least
        others, both, least = others[ok], both[ok], least[ok]
        if self.rare[i]:
            for k in np.flatnonzero(self.rare[others]):
                both[k] = n + self.n[others[k]] - len(np.union1d(self.sets[i], self.sets[others[k]]))
        return others[both >= least]

    def forest(self) -> list[tuple[int, int]]:
        """Links enough to connect what all links of pairs in one bucket, and on two sides where there are two, connect."""
        keys, of = band_keys(self.sketches, self.sets)
        order = np.argsort(keys, kind="stable")
        keys, of = keys[order], of[order]
        edges = np.flatnonzero(np.diff(keys, prepend=keys[:1] + np.uint64(1), append=keys[-1:] + np.uint64(1)))
        comp, seen, out = np.unique(self.known, return_inverse=True)[1], np.zeros((len(self.sets),) * 2, bool), []
        two = self.side.any() and not self.side.all()
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if b - a < 2:
                continue
            members = of[a:b]
            if (comp[members] == comp[members[0]]).all():
                continue
            for i in members:
                others = members[(comp[members] != comp[i]) & ~seen[i, members]]
                if two:
                    others = others[self.side[others] != self.side[i]]
                if not len(others):
                    continue
                seen[i, others] = seen[others, i] = True
                for j in self.linked(i, others):
                    if comp[i] != comp[j]:
                        comp[comp == comp[j]] = comp[i]
                        out.append((int(i), int(j)))
        return out


def confirmed(members: DataFrame) -> DataFrame:
    """Links a, b of members (task, side, cls, component, sketch, hashes), found in each task by itself."""

    def links(rows: list[tuple]) -> pa.RecordBatch:
        sets = [np.frombuffer(r[5], np.uint64) for r in rows]
        group = Group(sets, np.stack([np.frombuffer(r[4], "<u2") for r in rows]), np.array([r[1] for r in rows], bool), np.array([r[3] for r in rows]))
        pairs = group.forest()
        return pa.RecordBatch.from_arrays([pa.array([rows[i][2] for i, _ in pairs], pa.int64()), pa.array([rows[j][2] for _, j in pairs], pa.int64())], ["a", "b"])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and row[0] != held[-1][0]:
                    yield links(held)
                    held = []
                held.append(row)
        if held:
            yield links(held)

    dealt = members.select("task", "side", "cls", "component", "sketch", "hashes").repartition("task").sortWithinPartitions("task")
    return dealt.mapInArrow(run, "a long, b long")


def confirmed_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are links. A row has both sets, so the join with a hot a can be split."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(c.as_buffer(), np.uint64) for c in (x, y))
                least = -(-THRESHOLD * (len(x) + len(y)) // (100 + THRESHOLD))
                keep.append(min(len(x), len(y)) >= least and len(np.intersect1d(x, y, assume_unique=True)) >= least)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("cls").alias("b"), F.col("hashes").alias("y"))
    two = sets.select(F.col("cls").alias("a"), F.col("hashes").alias("x"))
    return pairs.join(one, "b").join(two, "a").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def tasks(groups: DataFrame, folder: str) -> DataFrame:
    """task, side, cls and component: where each class of a group (leader, cls, n, component) is to be.

    folder: for a table of the groups' sizes. A component with half of a large group or more is its main one, in small blocks, and needn't be held against itself: each of its
    blocks meets each block of the rest. The rest's n blocks meet two by two, so that each is in n tasks.
    """
    per = groups.groupBy("leader", "component").agg(F.count("*").alias("c"), F.sum(F.col("n") * 8).alias("b"))
    total = per.groupBy(F.col("leader").alias("_l")).agg(F.sum("c").alias("_c"), F.sum("b").alias("_b"), F.max(F.struct("c", "b", "component")).alias("_m"))
    split = (F.col("_c") > BLOCK) & (2 * F.col("_m.c") >= F.col("_c"))
    count = lambda c, b, block: F.ceil(F.greatest(c / block, b / BLOCK_BYTES)).cast("int")
    rest = count(F.col("_c") - F.when(split, F.col("_m.c")).otherwise(0), F.col("_b") - F.when(split, F.col("_m.b")).otherwise(0), BLOCK)
    sizes = total.select("_l", F.when(split, F.col("_m.component")).alias("_main"), F.when(split, count(F.col("_m.c"), F.col("_m.b"), BLOCK // 4)).otherwise(0).alias("mains"), rest.alias("rests"))
    sizes = stored(sizes, folder)  # a join with sums can't be split where a group is hot, one with a table can
    rows = groups.join(sizes, F.col("leader") == F.col("_l")).withColumn("main", F.coalesce(F.col("component") == F.col("_main"), F.lit(False)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("cls"), F.when(F.col("main"), F.col("mains")).otherwise(F.col("rests"))).cast("int"))
    own = F.col("own")
    at = lambda kind, x, y, side: F.struct(F.xxhash64("leader", F.lit(kind), x, y).alias("task"), side.cast("int").alias("side"))
    upto = lambda n, f: F.transform(F.filter(F.sequence(F.lit(0), F.greatest(F.col(n), F.lit(1)) - 1), lambda k: k < F.col(n)), f)
    to_rest = upto("rests", lambda k: at(0, F.least(own, k), F.greatest(own, k), own > k))
    to_main = upto("mains", lambda k: at(1, k, own, F.lit(0)))
    where = F.when(F.col("main"), upto("rests", lambda k: at(1, own, k, F.lit(1)))).otherwise(F.concat(to_rest, to_main))
    return rows.withColumn("w", F.explode(where)).select("w.task", "w.side", "cls", "component")


def led(rows: DataFrame, folder: str) -> DataFrame:
    """bucket, size, cls, leader and score (the leader's) of the classes of each bucket that has two or more; rows: bucket, cls. folder:
    for tables of buckets, by which Spark can split the joins with a hot one."""
    shared = stored(rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), f"{folder}-shared")
    members = stored(rows.join(shared, "bucket"), f"{folder}-sized")
    scores = members.groupBy("cls").agg(F.sum("size").alias("own"))
    scored = members.join(scores, "cls")
    leaders = scored.groupBy("bucket").agg(F.max(F.struct("own", (-F.col("cls")).alias("c"))).alias("l"))
    leaders = stored(leaders.select("bucket", (-F.col("l.c")).alias("leader"), F.col("l.own").alias("score")), f"{folder}-leaders")
    return members.join(leaders, "bucket")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id that it reaches by links, itself included) and kept."""
    spark = docs.sparkSession
    folder = shared_dir(spark)
    signed = stored(signatures(docs, shingle), f"{folder}/signed", shuffled=False)
    full = signed.where("set_key is not null and doc_id is not null")
    classes = full.groupBy("set_key").agg(F.min("doc_id").alias("cls"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"), F.first("firsts").alias("firsts"))
    classes = stored(classes, f"{folder}/classes")
    members = stored(led(buckets(classes), f"{folder}/buckets"), f"{folder}/members")
    dropped(spark, *(f"{folder}/buckets-{x}" for x in ("shared", "sized", "leaders")))
    freed(spark)
    sets = stored(full_sets(docs, members.select("cls").distinct(), shingle), f"{folder}/sets")
    freed(spark)
    # each class with the best of its leaders
    best = members.where("leader <> cls").groupBy("cls").agg(F.max_by("leader", F.struct("score", -F.col("leader"))).alias("best"))
    links = stored(confirmed_pairs(best.select(F.col("best").alias("a"), F.col("cls").alias("b")), sets), f"{folder}/links", shuffled=False)
    near = components(links)
    # what is left: buckets of more than one component
    known = members.join(near, F.col("cls") == F.col("node"), "left").join(best, "cls", "left")
    known = known.select("bucket", "size", "cls", "leader", F.coalesce("component", "cls").alias("component"), ((F.col("leader") == F.col("cls")) | (F.col("leader") == F.col("best"))).alias("told"))
    known = stored(known, f"{folder}/known")
    undone = known.groupBy(F.col("bucket").alias("_b")).agg(F.min("component").alias("low"), F.max("component").alias("high"), F.bool_and("told").alias("told"), F.max("size").alias("size"))
    undone = stored(undone.where("low < high and (size > 2 or not told)").select("_b"), f"{folder}/undone")
    groups = known.join(undone, F.col("bucket") == F.col("_b"), "left_semi").select("leader", "cls", "component").distinct()
    groups = stored(groups.join(classes.select("cls", F.col("n_shingles").alias("n")), "cls"), f"{folder}/groups")
    more = stored(confirmed(tasks(groups, f"{folder}/sizes").join(sets, "cls")), f"{folder}/more", shuffled=False)
    freed(spark)
    # these join components as a whole
    of = known.select(F.col("cls").alias("_n"), F.col("component").alias("_c")).distinct()
    joins = more
    for end in ("a", "b"):
        joins = joins.join(of, F.col(end) == F.col("_n")).withColumn(end, F.col("_c")).drop("_n", "_c")
    merged = components(joins.select("a", "b")).select(F.col("node").alias("_m"), F.col("component").alias("_to"))
    found = of.join(merged, F.col("_c") == F.col("_m"), "left").select(F.col("_n").alias("node"), F.coalesce("_to", "_c").alias("component"))
    named = classes.select(F.col("set_key").alias("_k"), "cls").join(found, F.col("cls") == F.col("node"), "left").select("_k", F.coalesce("component", "cls").alias("_c"))
    named = stored(named, f"{folder}/named")
    dropped(spark, *(f"{folder}/{x}" for x in ("classes", "members", "sets", "links", "known", "undone", "groups", "sizes", "more")))
    freed(spark)
    out = signed.select("doc_id", "n_shingles", "set_key").join(named, F.col("set_key") == F.col("_k"), "left")
    component = F.coalesce("_c", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """docs with one document of each component, the one of the smallest doc_id, in one row."""
    kept = near_duplicates(docs, shingle).where("kept").select(F.col("doc_id").alias("_kept")).distinct()
    one = docs.join(kept, F.col("doc_id") == F.col("_kept"), "left_semi").dropDuplicates(["doc_id"])
    return one.unionByName(docs.where("doc_id is null"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))


OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i + 3], ' ')) AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM w WHERE len(ws) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM p JOIN n x ON p.a = x.doc_id JOIN n y ON p.b = y.doc_id WHERE 100 * common >= 80 * (x.n + y.n - common)
), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r AS (
  SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a
), c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c ON d.doc_id = c.node LEFT JOIN n ON d.doc_id = n.doc_id
"""
