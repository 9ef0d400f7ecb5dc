"""Lengths of preference records in tokens, and what a limit would cut."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrank.operators import metrics

Tokenizer = Callable[[Column], Column]
SERIES, PERCENTS = ("prompt", "chosen", "rejected", "prompt_chosen", "prompt_rejected"), [50, 90, 95, 99]


def by_space(text: Column) -> Column:
    """Words between white space, as tokens."""
    return F.size(F.regexp_extract_all(text, F.lit(r"[^ \t\n\r]+"), F.lit(0))).cast("long")


def measured(records: DataFrame, tokenizer: Tokenizer = by_space) -> DataFrame:
    """records (prompt, chosen, rejected and others) with n_ and the name of each of SERIES. tokenizer: a column's number of
    tokens, of SQL functions or a pandas UDF."""
    out = records.withColumns({f"n_{c}": tokenizer(F.col(c)) for c in SERIES[:3]})
    return out.withColumns({f"n_prompt_{c}": F.col("n_prompt") + F.col(f"n_{c}") for c in SERIES[1:3]})


def distributions(sizes: DataFrame) -> DataFrame:
    """series, p50, p90, p95, p99, max and mean of each of SERIES; series without rows are 0."""
    long = sizes.select(F.explode(F.array(*[F.struct(F.lit(s).alias("series"), F.col(f"n_{s}").alias("n")) for s in SERIES])).alias("x")).select("x.*")
    got = metrics.percentile_at(long, ["series"], "n", PERCENTS)
    names = sizes.sparkSession.createDataFrame([(s,) for s in SERIES], "series string")
    return names.join(got, "series", "left").na.fill(0)


def truncation(sizes: DataFrame, max_length: int, max_prompt: int) -> DataFrame:
    """examples; truncated, of which prompt and chosen, or prompt and rejected, pass max_length; its rate, 0 without examples; and
    prompt_overflow, whose prompts pass max_prompt."""
    over = (F.col("n_prompt_chosen") > max_length) | (F.col("n_prompt_rejected") > max_length)
    out = sizes.agg(F.count("*").alias("examples"), F.count_if(over).alias("truncated"), F.count_if(F.col("n_prompt") > max_prompt).alias("prompt_overflow"))
    return out.withColumn("rate", F.coalesce(F.try_divide(F.col("truncated").cast("double"), F.col("examples")), F.lit(0.0)))
