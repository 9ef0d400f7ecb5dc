"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target number of words: its share by weight of all words, at most MAX_COPIES times what it has, and what
that leaves over is shared again by weight. Within a source, bands of documents may be wanted more or less; the same sharing
gives each band its expected copies of a document. The whole part of these copies is certain. For the rest, a document with
the inclusion probability p and the random number u ranks by [u / (1 - u)] / [p / (1 - p)], and the lowest ranks are taken
until the words that the source still lacks are reached, to the nearest document: a sample of fixed size in words, with
unequal probabilities, of which the order does not depend on the partitions.

At scale: the texts are read for their sizes; sums by source and band, then by source and slice of the ranks, are small and
summed before the shuffle. Only the slice in which a source reaches its target is put in order, some SLICE_ROWS rows
whatever the source's size; every other document knows from that slice's cut alone whether it is taken.

Defined results: a null text has no words and is taken with 0 words; a null source is a source of its own, the last; equal
rows rank alike and are taken from in any order, with the same words; a text of any length counts whole; an empty table gives an
empty mix. Own columns start
with "mix_"; other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, stored, words

#: Weights of the sources by code point, repeating.
WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
#: Documents of so many words or more are wanted twice as much as shorter ones of the same source.
LONG_WORDS, LONG_WEIGHT = 50, 2
#: Rows of the slices of a source's ranks, about.
SLICE_ROWS = 10_000
#: Expected copies this near to a whole number are that number.
NEAR = 1e-9


def sized(docs: DataFrame, seed: str = "mix-1") -> DataFrame:
    """docs with mix_size (words), mix_band, mix_u (the row's random number, from doc_id and seed alone) and mix_tie."""
    size = F.size(words(F.col("text"))).cast("long")
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"))), 1, 13), 16, 10).cast("double")
    out = docs.withColumn("mix_size", size)
    return out.withColumns({"mix_band": F.when(F.col("mix_size") < LONG_WORDS, 1).otherwise(LONG_WEIGHT), "mix_u": (draw + 0.5) / float(1 << 52), "mix_tie": F.md5(F.coalesce("text", F.lit("")))})


def filled(rows: DataFrame, within: list[str], weight: str, cap: str, total: str, by: str) -> DataFrame:
    """rows with a column level: the number l for which the sum of least(cap, l * weight) over the rows of a group is total.

    Rows run full in the order of cap / weight. Before row k does, what is left of total goes by weight to it and to those
    after it; the first row that this leaves below its cap sets the level. Null if all run full.
    """
    order = Window.partitionBy(*within).orderBy(F.try_divide(F.col(cap), F.col(weight)), F.col(by).asc_nulls_last())
    full = F.coalesce(F.sum(cap).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_ = F.sum(weight).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = F.try_divide(F.col(total) - full, open_)
    out = rows.withColumns({"_l": level, "_k": F.row_number().over(order)})
    first = F.min(F.when(F.col("_l") <= F.try_divide(F.col(cap), F.col(weight)), F.struct("_k", "_l"))).over(Window.partitionBy(*within))
    return out.withColumn("level", first["_l"]).drop("_l", "_k")


def shares(slim: DataFrame) -> DataFrame:
    """A row for each source and band: source, mix_band, source_size, target, whole (certain copies) and part (the probability
    of one more). One row for each source goes through a single task: sources are few against documents."""
    bands = slim.groupBy("source", "mix_band").agg(F.sum("mix_size").alias("band_size"), F.count("*").alias("n"))
    bands = bands.withColumn("none", F.lit(0))
    sources = bands.groupBy("source", "none").agg(F.sum("band_size").alias("source_size"))
    at = F.row_number().over(Window.partitionBy("none").orderBy(F.col("source").asc_nulls_last())) - 1
    sources = sources.withColumns({
        "weight": F.element_at(F.array(*map(F.lit, WEIGHTS)), (at % len(WEIGHTS)) + 1).cast("long"),
        "cap": MAX_COPIES * F.col("source_size"),
        "total": F.sum("source_size").over(Window.partitionBy("none")),
    })
    sources = filled(sources, ["none"], "weight", "cap", "total", "source")
    target = F.coalesce(F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")), F.col("cap").cast("double"))
    sources = sources.select(F.col("source").alias("_s"), "source_size", target.alias("target"))
    bands = bands.drop("none").join(sources, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    bands = bands.withColumns({"w": F.col("mix_band") * F.col("band_size"), "c": MAX_COPIES * F.col("band_size")})
    empty = bands.where("band_size = 0").withColumn("copies", F.lit(0.0))  # its documents have their source's sizes, too
    bands = filled(bands.where("band_size > 0"), ["source"], "w", "c", "target", "mix_band")
    copies = F.coalesce(F.least(F.lit(float(MAX_COPIES)), F.col("level") * F.col("mix_band")), F.lit(float(MAX_COPIES)))
    bands = bands.withColumn("copies", F.when(F.abs(copies - F.round(copies)) < NEAR, F.round(copies)).otherwise(copies)).drop("level").unionByName(empty)
    return bands.select("source", "mix_band", "n", "band_size", "source_size", "target", F.floor("copies").cast("long").alias("whole"), (F.col("copies") - F.floor("copies")).alias("part"))


def _rank() -> Column:
    """The Pareto rank, times the odds of the source's mean probability and drawn into 0 to 1, over which it spreads evenly."""
    q = F.col("mix_u") / (1 - F.col("mix_u")) * F.try_divide(1 - F.col("part"), F.col("part")) * F.try_divide(F.col("mean"), 1 - F.col("mean"))
    return q / (1 + q)


def cuts(slim: DataFrame, table: DataFrame) -> DataFrame:
    """shares() with mean, slices and cut, the last rank of each source that is taken: struct of rank, doc_id, mix_tie."""
    w = Window.partitionBy("source")
    mean = F.sum(F.when(F.col("part") > 0, F.col("part") * F.col("n"))).over(w) / F.sum(F.when(F.col("part") > 0, F.col("n"))).over(w)
    lack = F.col("target") - F.sum(F.col("whole") * F.col("band_size")).over(w)
    table = table.withColumns({"mean": mean, "lack": lack, "slices": F.ceil(F.sum("n").over(w) / SLICE_ROWS).cast("int")})
    ranked = _with(slim, table).where("part > 0").withColumn("rank", _rank()).withColumn("slice", F.floor(F.col("rank") * F.col("slices")))
    key = F.struct("rank", "doc_id", "mix_tie")
    sums = ranked.groupBy("source", "slice").agg(F.sum("mix_size").alias("size"), F.max("lack").alias("lack"), F.max(key).alias("top"))
    before = F.coalesce(F.sum("size").over(w.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.withColumn("before", before)
    # The slice in which the target is reached is put in order; where there is none, all are taken.
    reached = (F.col("before") < F.col("lack")) & (F.col("before") + F.col("size") >= F.col("lack"))
    edge = sums.where(reached).select(F.col("source").alias("_s"), F.col("slice").alias("_k"), F.col("before").alias("_b"))
    inside = ranked.join(edge, F.col("source").eqNullSafe(F.col("_s")) & (F.col("slice") == F.col("_k")))
    upto = F.col("_b") + F.sum("mix_size").over(w.orderBy("rank", "doc_id", "mix_tie").rowsBetween(Window.unboundedPreceding, 0))
    inside = inside.withColumn("upto", upto).where(F.col("upto") - F.col("mix_size") / 2 <= F.col("lack"))
    whole_slices = sums.where(F.col("before") + F.col("size") < F.col("lack")).select("source", F.col("top").alias("key"))
    cut = whole_slices.unionByName(inside.select("source", key.alias("key"))).groupBy(F.col("source").alias("_s")).agg(F.max("key").alias("cut"))
    return table.join(cut, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")


def _with(docs: DataFrame, table: DataFrame) -> DataFrame:
    """docs with the columns of their source and band. Spark broadcasts the table if it is below its threshold; beyond that
    a sort-merge join splits the hot source's rows, of which the table has one for each band."""
    t = table.withColumnsRenamed({"source": "_src", "mix_band": "_band"})
    return docs.join(t, docs["source"].eqNullSafe(t["_src"]) & (docs["mix_band"] == t["_band"]), "left").drop("_src", "_band")


def mix(docs: DataFrame, seed: str = "mix-1") -> DataFrame:
    """docs with mix_size, mix_source_size, mix_target and mix_copies: how often the mix takes the document."""
    own = [c for c in docs.columns if not c.startswith("mix_")]
    full = sized(docs.select(*[F.col(f"`{c}`") for c in own]), seed)
    slim = stored(full.select("doc_id", "source", "mix_size", "mix_band", "mix_u", "mix_tie"), shuffled=False)
    return _decided(full, slim, own)


def _decided(full: DataFrame, slim: DataFrame, own: list[str]) -> DataFrame:
    table = stored(cuts(slim, shares(slim)).select("source", "mix_band", "source_size", "target", "whole", "part", "mean", "cut"))
    out = _with(full, table.withColumnsRenamed({c: f"mix_{c}" for c in ("source_size", "target")}))
    taken = F.when((F.col("part") > 0) & (F.struct(_rank().alias("rank"), F.col("doc_id"), F.col("mix_tie")) <= F.col("cut")), 1).otherwise(0)
    out = out.withColumn("mix_copies", F.coalesce(F.col("whole") + taken, F.lit(0)).cast("long"))
    sizes = {c: F.coalesce(f"mix_{c}", F.lit(0).cast(t)).alias(f"mix_{c}") for c, t in (("source_size", "long"), ("target", "double"))}
    return out.select(*[F.col(f"`{c}`") for c in own], "mix_size", *sizes.values(), "mix_copies")


def expand(mixed: DataFrame) -> DataFrame:
    """The rows of the mix: each document as often as it is taken, without the columns of mix()."""
    own = [c for c in mixed.columns if not c.startswith("mix_")]
    some = mixed.where("mix_copies > 0").withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int"))))
    return some.select(*[F.col(f"`{c}`") for c in own])


def op8_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    slim = stored(sized(read(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("text"), shuffled=False)
    out = _decided(slim, slim, ["doc_id", "source"])
    return out.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.round("mix_target", 6).alias("target"), (F.col("mix_size") * F.col("mix_copies")).alias("taken"))


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS tie, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    (('0x' || substr(md5('mix-1:' || doc_id::VARCHAR), 1, 13))::UBIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u FROM documents
), e AS (SELECT *, CASE WHEN size < 50 THEN 1 ELSE 2 END AS band FROM d
), s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM e GROUP BY source
), s1 AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w, 3 * source_size AS cap, sum(source_size) OVER () AS total FROM s0
), s2 AS (
  SELECT *, row_number() OVER o AS k,
    (total - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS l
  FROM s1 WINDOW o AS (ORDER BY cap::DOUBLE / w, source NULLS LAST)
), s3 AS (SELECT *, (SELECT min_by(l, k) FROM s2 WHERE l <= cap::DOUBLE / w) AS level FROM s2
), s AS (SELECT source, source_size, coalesce(least(cap::DOUBLE, level * w), cap::DOUBLE) AS target FROM s3
), b1 AS (
  SELECT e.source, band, count(*) AS n, sum(size)::BIGINT AS bs, any_value(source_size) AS source_size, any_value(target) AS target
  FROM e JOIN s ON e.source IS NOT DISTINCT FROM s.source GROUP BY e.source, band HAVING sum(size) > 0
), b2 AS (
  SELECT *, row_number() OVER o AS k,
    (target - coalesce(sum(3 * bs) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE) / sum(band * bs) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS l
  FROM b1 WINDOW o AS (PARTITION BY source ORDER BY (3 * bs)::DOUBLE / (band * bs), band)
), b3 AS (SELECT *, min(CASE WHEN l <= (3 * bs)::DOUBLE / (band * bs) THEN {'k': k, 'l': l} END) OVER (PARTITION BY source) AS f FROM b2
), b4 AS (SELECT *, coalesce(least(3.0::DOUBLE, f.l * band), 3.0::DOUBLE) AS c0 FROM b3
), b5 AS (SELECT *, CASE WHEN abs(c0 - round(c0)) < 1e-9 THEN round(c0) ELSE c0 END AS c FROM b4
), b6 AS (SELECT *, floor(c)::BIGINT AS whole, c - floor(c) AS part FROM b5
), b AS (
  SELECT *, sum(CASE WHEN part > 0 THEN part * n END) OVER p / sum(CASE WHEN part > 0 THEN n END) OVER p AS mean, target - sum(whole * bs) OVER p AS lack
  FROM b6 WINDOW p AS (PARTITION BY source)
), r AS (
  SELECT e.*, b.whole, b.part, b.lack, u / (1 - u) * ((1 - part) / part) * (mean / (1 - mean)) AS q
  FROM e JOIN b ON e.source IS NOT DISTINCT FROM b.source AND e.band = b.band WHERE part > 0
), t AS (
  SELECT doc_id, tie, sum(size) OVER (PARTITION BY source ORDER BY q / (1 + q), doc_id, tie ROWS UNBOUNDED PRECEDING) - size / 2 <= lack AS more FROM r
)
SELECT e.doc_id, e.size, s.source_size, round(s.target, 6) AS target,
  (e.size * (coalesce(b.whole, 0) + CASE WHEN t.more THEN 1 ELSE 0 END))::BIGINT AS taken
FROM e JOIN s ON e.source IS NOT DISTINCT FROM s.source
LEFT JOIN b ON e.source IS NOT DISTINCT FROM b.source AND e.band = b.band
LEFT JOIN t ON e.doc_id = t.doc_id AND e.tie = t.tie
"""
