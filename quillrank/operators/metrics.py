"""Metrics of model variants and their statistics."""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillrank.functions import scalars as S

#: Draws that a task makes at a time.
DRAWS = 1 << 20
#: So many bits of an index are its place in a block; a task holds one block of values at a time. At most 16.
BITS = 12
VALID = "status <> 'infrastructure_error'"


def correct() -> Column:
    return (F.col("status") == "passed") & (F.col("tests_total") > 0) & (F.col("tests_passed") == F.col("tests_total"))


def per_problem(evals: DataFrame) -> DataFrame:
    """n, c, best and solved of each problem and variant, over samples without infrastructure errors."""
    valid = evals.where(VALID)
    return valid.groupBy("model_variant", "problem_id").agg(F.count("*").alias("n"), F.count_if(correct()).alias("c"), F.max(S.ratio("tests_passed", "tests_total")).alias("best"), F.bool_or(correct()).alias("solved"))


def mean_pass_at_k(problems: DataFrame, k: int) -> DataFrame:
    """The mean over problems with k samples or more."""
    return problems.where(F.col("n") >= k).groupBy("model_variant").agg(F.count("*").alias("problems"), F.avg(S.pass_at_k("n", "c", k)).alias("pass_at_k"))


def percentile_at(values: DataFrame, by: list[str], value: str, percents: list[int]) -> DataFrame:
    """Nearest-rank percentiles, max and mean of each group. Values are counted first, so that what is put in order is the group's
    distinct values and no longer its rows."""
    counts = values.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_k"))
    w = Window.partitionBy(*by)
    rows = counts.select(*by, value, "_k", F.sum("_k").over(w.orderBy(value)).alias("_upto"), F.sum("_k").over(w).alias("_n"))
    at = lambda p: F.greatest(F.lit(1), F.least(F.col("_n"), F.bround(F.lit(p / 100) * F.col("_n"), 0).cast("long")))
    return rows.groupBy(*by).agg(*[F.min(F.when(F.col("_upto") >= at(p), F.col(value))).alias(f"p{p}") for p in percents], F.max(value).alias("max"), (F.sum(F.col(value) * F.col("_k")) / F.sum("_k")).alias("mean"))


def paired(problems: DataFrame) -> DataFrame:
    """Problems that both variants have, side by side."""
    side = lambda v: problems.where(F.col("model_variant") == v).select("problem_id", *[F.col(c).alias(f"{v}_{c}") for c in ("n", "c", "best", "solved")])
    return side("base").join(side("dpo"), "problem_id")


def _twister(key: bytes, pos: int) -> np.random.MT19937:
    out = np.random.MT19937()
    out.state = {"bit_generator": "MT19937", "state": {"key": np.frombuffer(key, np.uint32), "pos": pos}}
    return out


def _drawn(twister: np.random.MT19937, n: int) -> np.ndarray:
    """The results of random.Random.randrange(n) from the next DRAWS numbers: as many high bits as n has, drawn again if n or more."""
    got = twister.random_raw(DRAWS) >> np.uint64(32 - n.bit_length())
    return got[got < n]


def _starts(n: int, iterations: int, seed: int) -> Iterator[tuple[int, int, bytes, int, int]]:
    """first and count of the iterations of a task; the generator's state before them, and the draws from there that are others'."""
    *key, pos = random.Random(seed).getstate()[1]
    twister, done, first, each = _twister(np.array(key, np.uint32).tobytes(), pos), 0, 0, max(1, DRAWS // n)
    while first < iterations:
        state = twister.state["state"]
        key, pos, until = state["key"].tobytes(), int(state["pos"]), done + len(_drawn(twister, n))
        while first < iterations and first * n < until:
            yield first, min(each, iterations - first), key, pos, first * n - done
            first += each
        done = until


def _lots(row: dict, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """What a task draws for a row of _starts(), lot by lot, each with its first draw's place among all."""
    twister, skip, at, end = _twister(row["key"], row["pos"]), row["skip"], row["first"] * n, (row["first"] + row["count"]) * n
    while at < end:
        got = _drawn(twister, n)[skip:][: end - at].astype(np.int64)
        skip = 0
        yield at, got
        at += len(got)


def _dealt(spark: SparkSession, n: int, iterations: int, seed: int) -> DataFrame:
    starts = list(_starts(n, iterations, seed)) if n else []
    return spark.createDataFrame(starts, "first long, count long, key binary, pos int, skip long").repartition(max(1, len(starts)))


def bootstrap_draws(spark: SparkSession, n: int, iterations: int = 1000, seed: int = 42) -> DataFrame:
    """iteration and index of seeded resamples of n problems, in the order of random.Random(seed).randrange(n). Tasks make them,
    each from the generator's state where its iterations begin. Spark takes them for as few as their starts, and would broadcast
    them: the hint prevents that."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for at, got in _lots(row, n):
                    iteration = (np.arange(at, at + len(got)) // n).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(iteration), pa.array(got.astype(np.int32))], ["iteration", "idx"])

    return _dealt(spark, n, iterations, seed).mapInArrow(run, "iteration int, idx int").hint("merge")


def seeded_means(values: DataFrame, n: int, iterations: int = 1000, seed: int = 42, value: str = "value") -> DataFrame:
    """iteration and m, the mean of its resample, of those that bootstrap_draws() lists; values has idx, each from 0 to n - 1 once, and
    no nulls. A lot's draws are packed by iteration and block of indices, two bytes each; a block's rows are in one task, its values
    first. Nothing is joined, and neither draws nor values come to the driver."""
    blocks = max(1, (n - 1 >> BITS) + 1)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for at, got in _lots(row, n):
                    places = np.sort((np.arange(at, at + len(got)) // n) * (blocks << BITS) + got)
                    cells = places >> BITS
                    first = np.flatnonzero(np.diff(cells, prepend=-1))
                    offsets = np.append(first, len(places)).astype(np.int32) * 2
                    draws = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer((places & (1 << BITS) - 1).astype(np.uint16))])
                    iteration, block = np.divmod(cells[first], blocks)
                    yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(iteration.astype(np.int32)), draws], ["block", "iteration", "draws"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = np.zeros(0)
        for batch in batches:
            iteration = batch.column("iteration").to_numpy()
            cuts = [0, *np.flatnonzero(iteration < 0).tolist(), len(iteration)]
            for a, b in pairwise(cuts):
                if a < b and iteration[a] < 0:
                    of = batch.column("of")[a].values.to_numpy()
                    a += 1
                if a < b:
                    draws = batch.column("draws").slice(a, b - a).to_pylist()
                    ends = np.cumsum([len(x) for x in draws]) // 2
                    sums = np.add.reduceat(of[np.frombuffer(b"".join(draws), np.uint16)], np.append(0, ends[:-1]))
                    yield pa.RecordBatch.from_arrays([pa.array(iteration[a:b]), pa.array(sums)], ["iteration", "s"])

    block = F.shiftright(F.col("idx").cast("long"), BITS).alias("block")
    of = values.groupBy(block).agg(F.sort_array(F.collect_list(F.struct("idx", F.col(value).cast("double").alias("v"))))["v"].alias("of"))
    packed = _dealt(values.sparkSession, n, iterations, seed).mapInArrow(pack, "block long, iteration int, draws binary").withColumn("of", F.lit(None).cast("array<double>"))
    rows = packed.unionByName(of.select("block", F.lit(-1).alias("iteration"), F.lit(None).cast("binary").alias("draws"), "of"))
    sums = rows.repartition("block").sortWithinPartitions("block", "iteration").mapInArrow(add, "iteration int, s double")
    return sums.groupBy("iteration").agg((F.sum("s") / n).alias("m"))


def hashed_draws(spark: SparkSession, n: int, iterations: int = 1000, seed: int = 42) -> DataFrame:
    """iteration and idx of resamples of n problems, by digests of seed, iteration and draw: SQL alone, any part of it anew."""
    each = spark.range(iterations * n).select((F.col("id") / n).cast("long").alias("iteration"), F.pmod("id", F.lit(max(n, 1))).alias("j"))
    drawn = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("iteration"), F.col("j"))), 1, 12), 16, 10).cast("long")
    return each.select(F.col("iteration").cast("int"), F.pmod(drawn, F.lit(max(n, 1))).cast("int").alias("idx"))


Statistic = Callable[[Column], Column]


def bootstrap(values: DataFrame, draws: DataFrame, value: str = "value", level: float = 0.95, statistic: Statistic = F.avg) -> DataFrame:
    """point (of values themselves), lower, upper and mean of the resampled statistics; values has idx, numbered from 0. Without
    values all are 0."""
    return interval(values, draws.join(values, "idx").groupBy("iteration").agg(statistic(F.col(value)).alias("m")), value, level, statistic)


def interval(values: DataFrame, means: DataFrame, value: str = "value", level: float = 0.95, statistic: Statistic = F.avg) -> DataFrame:
    """bootstrap()'s row, from the statistic m of each resample."""
    tail = (1 - level) / 2
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    out = means.agg(zero(F.percentile("m", F.lit(tail))).alias("lower"), zero(F.percentile("m", F.lit(1 - tail))).alias("upper"), zero(F.avg("m")).alias("mean"))
    return out.join(F.broadcast(values.agg(zero(statistic(F.col(value))).alias("point"))))  # a row beside a row


def win_tie_loss(pairs: DataFrame) -> DataFrame:
    """Problems on which the tuned variant has a higher, equal or lower share of right samples."""
    d = F.col("dpo_c") * F.col("base_n") - F.col("base_c") * F.col("dpo_n")
    out = pairs.agg(F.count_if(d > 0).alias("win"), F.count_if(d == 0).alias("tie"), F.count_if(d < 0).alias("loss"))
    return out.withColumn("win_rate", F.try_divide(F.col("win").cast("double"), F.col("win") + F.col("loss")))


def mcnemar(pairs: DataFrame) -> DataFrame:
    out = pairs.agg(F.count_if(F.col("base_solved") & ~F.col("dpo_solved")).alias("base_only"), F.count_if(~F.col("base_solved") & F.col("dpo_solved")).alias("dpo_only"))
    return out.withColumn("p_value", S.sign_test("base_only", "dpo_only"))
