"""Scalar functions as Column builders; all run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Scores that differ by no more than this are equal.
EPSILON = 1e-9
#: Seeds lie below this.
SEED_LIMIT = 2147483647

# Decimal halves of which the binary number lies below, and what one decimal of them is.
ROUNDED_DOWN = {0.15: 0.1, 0.25: 0.2, 0.35: 0.3, 0.85: 0.8, 0.95: 0.9}


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sha256(c: Column | str) -> Column:
    """Hex digest of the UTF-8 text."""
    return F.sha2(col(c), 256)


def candidate_id(problem: Column | str, index: Column | str) -> Column:
    return F.format_string("%s_c%03d", col(problem), col(index))


def candidate_ordinal(candidate: Column | str) -> Column:
    """The number after "_c" at the end of an id, or null; numbers begin with 1."""
    n = F.regexp_extract(col(candidate), r"_c(\d+)$", 1)
    n = F.when(n != "", n.cast("long"))
    return F.when(n >= 1, n)


def preference_id(chosen: Column | str, rejected: Column | str) -> Column:
    return F.concat(F.lit("pref_"), col(chosen), F.lit("__"), col(rejected))


def ratio(part: Column | str, whole: Column | str, empty: float | None = 0.0) -> Column:
    """part / whole, and empty where whole is 0."""
    part, whole = col(part), col(whole)
    return F.when(whole > 0, part / whole).otherwise(F.lit(empty).cast("double"))


def stripped(c: Column | str) -> Column:
    """Without white space of any script at the ends."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def line_count(c: Column | str) -> Column:
    """Lines of a text; a line break at its end begins none."""
    brk = r"(?:\R|[\x1c-\x1e])"
    return F.when(col(c) == "", 0).otherwise(F.size(F.split(F.regexp_replace(col(c), brk + r"\z", ""), brk, -1))).cast("long")


# Fixed value: how a line begins that says that a text is code.
CODE_LINE = r"(?m)^[ \t]*(?:async[ \t]+def|def|class|import|from)[ \t]"


def looks_like_code(c: Column | str) -> Column:
    return F.coalesce(col(c).rlike(CODE_LINE), F.lit(False))


def _block(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"^[\r\n]+|[\r\n]+$", ""), r"(?U)\s+$", "")


def extracted_code(raw: Column | str) -> Column:
    """struct(code, format): the first python fence that holds something; else the first fence that looks like code; else the
    bare text if it has no fence and looks like code; else a null code of unknown format."""
    raw = col(raw)
    python = F.filter(F.transform(F.regexp_extract_all(raw, F.lit(r"(?is)```[ \t]*(?:python3|python|py)[ \t]*\r?\n(.*?)```"), F.lit(1)), _block), lambda x: x != "")
    any_ = F.filter(F.transform(F.regexp_extract_all(raw, F.lit(r"(?s)```[ \t]*\r?\n(.*?)```"), F.lit(1)), _block), lambda x: (x != "") & looks_like_code(x))
    bare = _block(raw)
    first = lambda a: F.get(a, F.lit(0))
    found = lambda code, kind: F.struct(code.alias("code"), F.lit(kind).alias("format"))
    return (
        F.when(F.size(python) > 0, found(first(python), "python_fence"))
        .when(F.size(any_) > 0, found(first(any_), "generic_fence"))
        .when(~raw.contains("```") & (bare != "") & looks_like_code(bare), found(bare, "plain"))
        .otherwise(F.struct(F.lit(None).cast("string").alias("code"), F.lit("unknown").alias("format")))
    )


def candidate_seed(base: int, problem: Column | str, index: Column | str) -> Column:
    """A seed below SEED_LIMIT from the first 16 hex digits of a digest, which are an unsigned 64-bit number."""
    digest = F.sha2(F.concat_ws(":", F.lit(str(base)), col(problem), col(index).cast("string")), 256)
    return (F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)") % F.lit(SEED_LIMIT).cast("decimal(20,0)")).cast("long")


def rounded_bucket(c: Column | str) -> Column:
    """One decimal, half to even on the binary number, as text."""
    c, out = col(c), None
    for at, to in ROUNDED_DOWN.items():
        out = F.when(c == F.lit(at), F.lit(to)) if out is None else out.when(c == F.lit(at), F.lit(to))
    return F.format_string("%.1f", out.otherwise(F.round(c, 1)))


def pass_rate_bucket(rate: Column | str) -> Column:
    """One of PASS_RATE_BUCKETS; right edges belong to a bucket."""
    p = col(rate) * 100
    return F.when(p <= 0, "0%").when(p <= 20, "1-20%").when(p <= 40, "20-40%").when(p <= 60, "40-60%").when(p <= 80, "60-80%").when(p < 100, "80-99%").otherwise("100%")


PASS_RATE_BUCKETS = ("0%", "1-20%", "20-40%", "40-60%", "60-80%", "80-99%", "100%")


def pass_at_k(n: Column | str, c: Column | str, k: int) -> Column:
    """1 - C(n - c, k) / C(n, k): the chance that one of k samples of n, c of them right, is right."""
    n, c = col(n), col(c)
    miss = F.aggregate(F.sequence(F.lit(1), F.lit(k)), F.lit(1.0), lambda a, i: a * (n - c - i + 1) / (n - i + 1))
    return F.when(c == 0, 0.0).when(n - c < k, 1.0).otherwise(1 - miss)


def nearest_rank(values: Column, percent: float) -> Column:
    """The nearest-rank percentile of an array; the rank is rounded half to even."""
    n = F.size(values)
    rank = F.greatest(F.lit(1), F.least(n, F.bround(F.lit(percent / 100) * n, 0).cast("int")))
    return F.when(n > 0, F.element_at(F.sort_array(values), rank))


def sign_test(b: Column | str, c: Column | str) -> Column:
    """Exact two-sided McNemar probability of b against c discordant pairs."""
    b, c = col(b).cast("int"), col(c).cast("int")
    n, low = b + c, F.least(b, c)
    start = F.struct(F.pow(F.lit(0.5), n).alias("term"), F.pow(F.lit(0.5), n).alias("sum"))
    step = lambda a, i: F.struct((a["term"] * (n - i + 1) / i).alias("term"), (a["sum"] + a["term"] * (n - i + 1) / i).alias("sum"))
    tail = F.when(low > 0, F.aggregate(F.sequence(F.lit(1), F.greatest(low, F.lit(1))), start, step)["sum"]).otherwise(F.pow(F.lit(0.5), n))
    return F.when(n == 0, 1.0).otherwise(F.least(F.lit(1.0), 2 * tail))


def clamp(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def relative_change(new: Column | str, old: Column | str) -> Column:
    """(new - old) / old; null where old is 0."""
    return F.try_divide(col(new) - col(old), col(old))


def iso_utc(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def canonical_json(fields: dict[str, Column]) -> Column:
    """A JSON object with its keys in order, without white space; null fields are null."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in sorted(fields.items())]), {"ignoreNullFields": "false"})


def compile_error(stderr: Column | str) -> Column:
    """An error of compiling shows no traceback header."""
    s = F.coalesce(col(stderr), F.lit(""))
    return ~s.contains("Traceback (most recent call last):") & s.rlike("SyntaxError:|IndentationError:|TabError:")


def minted_id(prefix: str, at: Column | str, token: Column | str) -> Column:
    """A run's id: a prefix, when it began, and four characters of a token."""
    return F.concat_ws("_", F.lit(prefix), F.date_format(col(at), "yyyyMMdd_HHmmss"), F.substring(col(token), 1, 4))


def valid_ratios(ratios: Column | str) -> Column:
    """Whether a map has just train, validation and test, none below 0, and 1 in sum."""
    r = col(ratios)
    values = F.map_values(r)
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return (F.array_sort(F.map_keys(r)) == F.array(F.lit("test"), F.lit("train"), F.lit("validation"))) & F.forall(values, lambda x: x >= 0) & (F.abs(total - 1) <= 1e-6)


def chat_array(role: Column | str, content: Column | str) -> Column:
    """A text as an array of one message."""
    return F.array(F.struct(col(role).alias("role"), col(content).alias("content")))
