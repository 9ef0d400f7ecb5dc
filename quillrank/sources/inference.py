"""Batch inference with a client that the caller brings: prompts in, completions or errors out, in Arrow batches on the executors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Makes, on an executor, what answers a list of prompts with as many texts; one may be an exception, which is that prompt's error.
Client = Callable[[], Callable[[list[str]], list]]


def generate(prompts: DataFrame, client: Client, key: str = "id", done: DataFrame | None = None, at_once: int = 32) -> DataFrame:
    """key, output and error for each row of prompts (key, prompt) whose key done doesn't have, so that a job goes on by key.

    The client is made once for each task and asked for at_once prompts at a time. An exception of a whole call is the error of each
    of its prompts; others go on. A null prompt is an error. Rows come and go one batch after another; nothing is gathered."""
    rows = prompts.select(key, "prompt")
    if done is not None:
        rows = rows.join(done.select(key), key, "left_anti")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask = client()
        for batch in batches:
            texts, out = batch.column(1).to_pylist(), [ValueError("no prompt")] * len(batch)
            real = [i for i, t in enumerate(texts) if t is not None]
            for a in range(0, len(real), at_once):
                some = real[a : a + at_once]
                try:
                    got = ask([texts[i] for i in some])
                except Exception as e:  # noqa: BLE001  a client's failure is the prompts'
                    got = [e] * len(some)
                for i, g in zip(some, got, strict=True):
                    out[i] = g
            failed = [isinstance(o, Exception) for o in out]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([None if f else o for o, f in zip(out, failed, strict=True)], pa.string()), pa.array([f"{type(o).__name__}: {o}" if f else None for o, f in zip(out, failed, strict=True)], pa.string())],
                [key, "output", "error"],
            )

    return rows.mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, output string, error string")
