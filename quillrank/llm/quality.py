"""Quality rules as a bitmask ledger.

Every rule is evaluated once for each document. The ledger keeps the measurements and one bit for each failed rule;
policies are versioned bit masks over it, so that a new policy, or an ablation of a rule, needs no second reading of the
texts. Everything here is DataFrame and SQL functions; no Python runs on the executors, and nothing is shuffled.

Defined results: a null text counts as empty; a text of any length is measured whole, in its own row; an empty text has no words and fails ``few_words``; rows are independent,
so repeated rows give repeated results; an empty table gives an empty ledger. Columns of the input whose names clash
with the ledger's are replaced by the ledger's.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, words

#: Words in a window whose repetition counts.
WINDOW = 8
SYMBOLS = "#*$%&|<>"

#: What the ledger measures, in the order of its columns.
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A rule fails where sql, over MEASURES, is true. The bit never changes once a ledger was written with it."""

    bit: int
    name: str
    sql: str


RULES = (
    Rule(0, "few_words", "n_words < 20"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols", "n_symbols > n_words"),
    Rule(3, "repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule(4, "glued_words", "word_chars > 200 * n_words"),
    Rule(5, "single_letters", "10 * word_chars < 12 * n_words"),
)

#: A policy rejects a document if one of its rules failed. Versions are only ever added.
POLICIES = {
    "base-1": ("few_words", "repeated_windows"),
    "standard-1": ("few_words", "repeated_windows", "symbols", "repeated_lines"),
    "strict-1": tuple(r.name for r in RULES),
}
BASE, STANDARD = "base-1", "standard-1"


def mask(policy: str) -> int:
    bits = {r.name: 1 << r.bit for r in RULES}
    return sum(bits[name] for name in POLICIES[policy])


def _windows(hashes: Column, n: Column) -> Column:
    window = lambda i: F.xxhash64(*[F.get(F.col("_h"), i + k) for k in range(WINDOW)])
    return F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), window)).otherwise(F.array().cast("array<bigint>"))


def _repeated_starts() -> Column:
    """Starts of windows that occur twice or more: neighbours in the order of the hashes, of which the words agree."""

    def same(i: Column, j: Column) -> Column:
        a, b = F.get(F.col("_sorted"), i), F.get(F.col("_sorted"), j)
        at = [F.get(F.col("_w"), a["i"] + k) == F.get(F.col("_w"), b["i"] + k) for k in range(WINDOW)]
        return F.coalesce(reduce(Column.__and__, at, a["h"] == b["h"]), F.lit(False))

    last = F.size("_sorted") - 1
    near = lambda k: ((k > 0) & same(k, k - 1)) | ((k < last) & same(k, k + 1))
    return F.sort_array(F.transform(F.filter(F.sequence(F.lit(0), last), near), lambda k: F.get(F.col("_sorted"), k)["i"]))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the columns MEASURES.

    n_words, word_chars: words and the code points in them. n_symbols: characters of SYMBOLS. n_lines: lines with a
    word; n_dup_lines: those equal to an earlier one. n_repeat_words: words in windows of eight words that occur twice
    or more in the text.
    """
    own = [c for c in docs.columns if c not in MEASURES and c not in ("fail_bits", "kept")]
    t = F.coalesce(F.col("_t"), F.lit(""))
    out = docs.select(*[F.col(f"`{c}`") for c in own], F.col(f"`{text}`").alias("_t"))
    out = out.withColumns({"_w": words(F.col("_t")), "_l": F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))})
    out = out.withColumns({"n_words": F.size("_w").cast("long"), "_h": F.transform("_w", lambda w: F.xxhash64(w))})
    out = out.withColumns({
        "word_chars": F.char_length(F.array_join("_w", "")).cast("long"),
        "n_symbols": F.char_length(F.regexp_replace(t, f"[^{SYMBOLS}]+", "")).cast("long"),
        "n_lines": F.size("_l").cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "_g": _windows(F.col("_h"), F.size("_w")),
    })
    # Few texts repeat a window; only those sort theirs.
    repeats = F.size("_g") > F.size(F.array_distinct("_g"))
    out = out.withColumn("_sorted", F.when(repeats, F.sort_array(F.transform("_g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    out = out.withColumn("_p", F.when(F.col("_sorted").isNotNull(), _repeated_starts()))
    start = F.struct(F.lit(-WINDOW).alias("p"), F.lit(0).alias("n"))
    covered = F.aggregate("_p", start, lambda a, p: F.struct(p.alias("p"), (a["n"] + F.least(F.lit(WINDOW), p - a["p"])).alias("n")))["n"]
    out = out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    # A filter on a measure must stay above: pushed down, it would take each step's expression in, for every word of a text.
    out = out.select(*[F.col(f"`{c}`") for c in own], F.explode(F.array(F.struct(*MEASURES))).alias("_m"))
    return out.select(*[F.col(f"`{c}`") for c in own], "_m.*")


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with MEASURES and fail_bits, in which bit r.bit is set if rule r failed."""
    bits = reduce(Column.bitwiseOR, (F.when(F.expr(r.sql), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long") for r in RULES))
    return measured(docs, text).withColumn("fail_bits", bits)


def fails(policy: str, bits: Column | str = "fail_bits") -> Column:
    bits = F.col(bits) if isinstance(bits, str) else bits
    return bits.bitwiseAND(F.lit(mask(policy)).cast("long")) != 0


def apply_policy(book: DataFrame, policy: str = STANDARD) -> DataFrame:
    """The ledger with a column kept: false where one of the policy's rules failed."""
    return book.withColumn("kept", ~fails(policy))


def ablation(book: DataFrame, policy: str = STANDARD) -> DataFrame:
    """A row for each rule of the policy: rule, n_failed, n_only (documents that this rule alone rejects, so that they
    come back without it) and n_rejected (by the whole policy).

    The ledger is first summed up by its bits, of which there are 2 ^ rules combinations at most; the rest works on those.
    """
    spark, m = book.sparkSession, mask(policy)
    rules = spark.createDataFrame([(r.name, 1 << r.bit) for r in RULES if m >> r.bit & 1], "rule string, bit long")
    sums = book.groupBy(F.col("fail_bits").bitwiseAND(F.lit(m).cast("long")).alias("_b")).agg(F.count("*").alias("_n"))
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("_n"))), F.lit(0))
    # at most 2 ^ rules sums meet a handful of rules
    return rules.join(F.broadcast(sums), F.col("_b") != 0, "left").groupBy("rule").agg(
        total(F.col("_b").bitwiseAND(F.col("bit")) != 0).alias("n_failed"), total(F.col("_b") == F.col("bit")).alias("n_only"), total(F.col("_b") != 0).alias("n_rejected")
    )


def everywhere(book: DataFrame, by: str) -> DataFrame:
    """For each value of by: failed_by_some and failed_by_all, the bits that some and that all of its documents have."""
    return book.groupBy(by).agg(F.bit_or("fail_bits").alias("failed_by_some"), F.bit_and("fail_bits").alias("failed_by_all"), F.count("*").alias("n_docs"))


def op5_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = apply_policy(ledger(read(spark, sf_dir, "documents").select("doc_id", "text")))
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", fails(BASE).alias("base_failed"), (F.col("kept") & ~fails(BASE)).alias("kept"), "fail_bits", "n_lines")


def quality_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the standard policy rejects, and rejects alone."""
    return ablation(ledger(read(spark, sf_dir, "documents").select("doc_id", "text")))


def quality_everywhere(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rules some and which all documents of a source fail."""
    return everywhere(ledger(read(spark, sf_dir, "documents").select("doc_id", "source", "text")), "source")


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d
), g AS (
  SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS g
  FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 6, 1))) AS i FROM w)
), rep AS (
  SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, g) > 1
), cov AS (
  SELECT r, sum(n) AS n FROM (SELECT r, least(8, i - coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), -8)) AS n FROM rep) GROUP BY r
), m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN cov USING (r)
), b AS (
  SELECT *, CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
    + CASE WHEN n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars > 200 * n_words THEN 16 ELSE 0 END + CASE WHEN 10 * word_chars < 12 * n_words THEN 32 ELSE 0 END AS bits
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (bits & 3) <> 0 AS base_failed, (bits & 15) = 0 AS kept,
  bits::BIGINT AS fail_bits, n_lines FROM b
"""

ABLATION_SQL = f"""
SELECT rule, count(*) FILTER (fail_bits & bit <> 0) AS n_failed, count(*) FILTER (fail_bits & {mask(STANDARD)} = bit) AS n_only, count(*) FILTER (fail_bits & {mask(STANDARD)} <> 0) AS n_rejected
FROM ({OP5_SQL}) b, (VALUES {", ".join(f"('{r.name}', {1 << r.bit})" for r in RULES if r.name in POLICIES[STANDARD])}) r(rule, bit) GROUP BY rule
"""
EVERYWHERE_SQL = f"SELECT source, bit_or(fail_bits)::BIGINT AS failed_by_some, bit_and(fail_bits)::BIGINT AS failed_by_all, count(*) AS n_docs FROM ({OP5_SQL}) b JOIN documents d USING (doc_id) GROUP BY source"
