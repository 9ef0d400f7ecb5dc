"""Media columns: audio features as fixed-shape tensors with time spans.

A payload is stored losslessly as an 8-bit mono WAV file in a binary column. Features are computed from the bytes read back:
the samples are resampled by a polyphase filter, framed with overlap and turned into log-mel energies; energy segments are
found with hysteresis, which opens a segment above one level and closes it below a lower one. The frames come as tensors of
the fixed shape SHAPE, each with its span of time. They are made, and go to Spark, as Arrow's fixed-shape tensors; Spark stores the values as
lists of math.prod(SHAPE) floats and has no type for the shape, so the column's metadata names Arrow's extension type and shape
(TENSOR), and as_tensors() takes a stored column back to it, or fails where a list has another size.

A row depends on nothing but its own text, so nothing is shuffled, equal texts have equal results on any partitioning, and a
lost task is simply run again. Long payloads are worked through in blocks of fixed size.

Defined results: a null text counts as empty; an empty text is one block of 64 zero bytes; repeated rows give repeated
results; an empty table gives an empty result. Columns that clash with the operator's are replaced by them.
"""

from __future__ import annotations

import hashlib
import json
import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import read, tidy

PAD = 64
RATE = 16_000
#: Resampling from RATE to RATE * UP / DOWN with TAPS taps in each of the UP branches.
UP, DOWN, TAPS = 3, 4, 12
FRAME, HOP, MELS = 512, 256, 20
#: Frames and mel bands of a tensor.
SHAPE = (16, MELS)
#: Levels over a text's median frame energy, in dB, at which a segment opens and below which it closes.
OPEN_DB, CLOSE_DB = 1.0, 0.25
#: Input samples worked on at once; a multiple of PAD.
BLOCK = 1 << 18
#: Bytes of media that an output batch holds, about.
BATCH_BYTES = 8 << 20

SCHEMA = (
    "media binary, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, "
    "tensors array<struct<start_s:double,end_s:double,values:array<float>>>, segments array<struct<start_s:double,end_s:double>>, feature string"
)
#: Metadata of the column of tensors, as Arrow names them.
TENSOR = {"ARROW:extension:name": "arrow.fixed_shape_tensor", "ARROW:extension:metadata": json.dumps({"shape": list(SHAPE)})}
_SPAN = [("start_s", pa.float64()), ("end_s", pa.float64())]
_ARROW = [
    ("media", pa.binary()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()),
    ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("tensors", pa.list_(pa.struct([*_SPAN, ("values", pa.list_(pa.float32()))]))),
    ("segments", pa.list_(pa.struct(_SPAN))), ("feature", pa.string()),
]


def padded(data: bytes) -> bytes:
    return data + bytes(-len(data) % PAD or (0 if data else PAD))


def to_wav(payload: bytes, rate: int = RATE) -> bytes:
    """A RIFF WAVE file of 8-bit unsigned mono samples. payload has an even length, so that its chunk needs no padding."""
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload), b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(payload))
    return head + payload


def from_wav(media: bytes) -> tuple[int, bytes]:
    """Rate and sample bytes of to_wav(), by walking the chunks."""
    rate, at = 0, 12
    while at + 8 <= len(media):
        kind, size = struct.unpack_from("<4sI", media, at)
        if kind == b"fmt ":
            rate = struct.unpack_from("<I", media, at + 12)[0]
        elif kind == b"data":
            return rate, media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no data chunk")


def branches(up: int = UP, down: int = DOWN, taps: int = TAPS) -> np.ndarray:
    """The low-pass filter's coefficients by branch: a sinc under a Hann window, of which each branch sums to 1."""
    t = np.arange(up * taps) - (up * taps - 1) / 2
    h = np.sinc(t / max(up, down)) * np.hanning(up * taps + 2)[1:-1]
    h = h.reshape(taps, up).T
    return h / h.sum(axis=1, keepdims=True)


def resampled(x: np.ndarray, history: np.ndarray, h: np.ndarray, up: int = UP, down: int = DOWN) -> np.ndarray:
    """x, of a length divisible by down, after the TAPS - 1 samples of history."""
    taps, whole = h.shape[1], np.concatenate([history, x])
    n = len(x) // down
    out = np.empty(n * up)
    for j in range(up):
        base, phase = divmod(j * down, up)
        sums = np.zeros(n)
        for k in range(taps):
            at = base - k + taps - 1
            sums += h[phase, k] * whole[at : at + down * (n - 1) + 1 : down]
        out[j::up] = sums
    return out


def mel_bank(rate: float, frame: int = FRAME, mels: int = MELS) -> np.ndarray:
    """Triangular filters, evenly spread on the mel scale: (frame // 2 + 1, mels)."""
    top = 2595 * np.log10(1 + rate / 2 / 700)
    edges = 700 * (10 ** (np.linspace(0, top, mels + 2) / 2595) - 1)
    f = np.arange(frame // 2 + 1)[:, None] * rate / frame
    low, mid, high = edges[:-2], edges[1:-1], edges[2:]
    return np.maximum(0, np.minimum((f - low) / (mid - low), (high - f) / (high - mid)))


def hysteresis(level: np.ndarray, open_at: float, close_at: float) -> list[tuple[int, int]]:
    """Spans of frames: from one of open_at or more, to before the next of under close_at."""
    mark = np.where(level >= open_at, 1, np.where(level < close_at, -1, 0))
    at = np.flatnonzero(mark)
    on = mark[at] > 0
    turns = at[np.flatnonzero(np.diff(on, prepend=False))].tolist()
    return list(zip(turns[::2], [*turns[1::2], len(level)], strict=False))


class Features:
    """The features of payloads, with the filters made once."""

    def __init__(self) -> None:
        self.h, self.rate = branches(), RATE * UP / DOWN
        self.bank, self.window = mel_bank(self.rate), np.hanning(FRAME)

    def frames(self, payload: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Log-mel energies (frames, MELS) and energies in dB (frames)."""
        samples, history, rest = np.frombuffer(payload, np.uint8), np.zeros(TAPS - 1), np.zeros(0)
        mels, powers = [], []
        for at in range(0, len(samples), BLOCK):
            x = samples[at : at + BLOCK] / 128.0 - 1
            rest = np.concatenate([rest, resampled(x, history, self.h)])
            history = np.concatenate([history, x])[-(TAPS - 1) :]
            n = (len(rest) - FRAME) // HOP + 1
            if at + BLOCK >= len(samples):  # the last frame is filled with silence
                n = max(1, -(-(len(rest) - FRAME) // HOP) + 1)
                rest = np.concatenate([rest, np.zeros((n - 1) * HOP + FRAME - len(rest))])
            if n < 1:
                continue
            cut = np.lib.stride_tricks.sliding_window_view(rest, FRAME)[: (n - 1) * HOP + 1 : HOP] * self.window
            power = np.abs(np.fft.rfft(cut)) ** 2
            mels.append(np.log10(power @ self.bank + 1e-6))
            powers.append(10 * np.log10((cut * cut).mean(axis=1) + 1e-9))
            rest = rest[n * HOP :]
        return np.concatenate(mels), np.concatenate(powers)

    def of(self, media: bytes) -> dict:
        payload = from_wav(media)[1]
        mel, level = self.frames(payload)
        step, rows = HOP / self.rate, SHAPE[0]
        whole = np.zeros((-(-len(mel) // rows) * rows, MELS), np.float32)
        whole[: len(mel)] = mel
        spans = hysteresis(level - np.median(level), OPEN_DB, CLOSE_DB)
        last = (len(mel) - 1) * step + FRAME / self.rate
        # rounded, so that the last digits of a sum don't show
        digest = zlib.crc32(np.round(mel * 16).astype("<i2").tobytes())
        return {
            "payload_bytes": len(payload), "payload_sha256": hashlib.sha256(payload).hexdigest(), "tail_crc32": zlib.crc32(payload[-PAD:]),
            "spans": [(k * rows * step, min((k * rows + rows - 1) * step + FRAME / self.rate, last)) for k in range(len(whole) // rows)], "values": whole,
            "segments": [{"start_s": a * step, "end_s": b * step} for a, b in spans],
            "feature": f"frames={len(mel)};segments={len(spans)};active={sum(b - a for a, b in spans)};mel={digest:08x}",
        }


def audio_features(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns keep of docs, with the columns of SCHEMA."""
    own = [c for c in keep if c not in {n for n, _ in _ARROW}]
    slim = docs.select(*[f"`{c}`" for c in own], docs[text].alias("_text"))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Features()
        for batch in batches:
            rows, size, begin = [], 0, 0
            for i, t in enumerate(batch.column(len(own))):
                data = (t.as_py() or "").encode("utf-8", "surrogatepass")
                media = to_wav(padded(data))
                rows.append({"media": media, "n_bytes": len(data), "media_bytes": len(media), "media_sha256": hashlib.sha256(media).hexdigest()} | make.of(media))
                size += len(media)
                if size >= BATCH_BYTES or i + 1 == len(batch):
                    cols = [batch.column(k).slice(begin, len(rows)) for k in range(len(own))] + [_tensors(rows) if n == "tensors" else pa.array([r[n] for r in rows], kind) for n, kind in _ARROW]
                    yield pa.RecordBatch.from_arrays(cols, [*own, *(n for n, _ in _ARROW)])
                    rows, size, begin = [], 0, i + 1

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-1])
    out = slim.mapInArrow(run, f"{schema}, {SCHEMA}" if own else SCHEMA)
    return out.withMetadata("tensors", TENSOR)


def fixed_shape(values: np.ndarray) -> pa.FixedShapeTensorArray:
    """Frames, MELS values each and SHAPE[0] to a tensor, as Arrow's fixed-shape tensors."""
    return pa.FixedShapeTensorArray.from_numpy_ndarray(np.ascontiguousarray(values.reshape(-1, *SHAPE), np.float32))


def _tensors(rows: list[dict]) -> pa.ListArray:
    """The column tensors of rows of Features.of()."""
    made = fixed_shape(np.concatenate([r["values"] for r in rows]))
    n = np.cumsum([0, *(len(r["spans"]) for r in rows)])
    start, end = (pa.array([s[j] for r in rows for s in r["spans"]], pa.float64()) for j in (0, 1))
    return pa.ListArray.from_arrays(pa.array(n, pa.int32()), pa.StructArray.from_arrays([start, end, made.storage.cast(pa.list_(pa.float32()))], ["start_s", "end_s", "values"]))


def as_tensors(values: pa.ListArray) -> pa.ExtensionArray:
    """tensors.values, as stored, as Arrow's fixed-shape tensors of SHAPE."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if any(n != math.prod(SHAPE) for n in values.value_lengths().unique().to_pylist()):
        raise ValueError(f"a tensor hasn't the shape {SHAPE}")
    flat = values.flatten().cast(pa.float32()) if len(values) else pa.array([], pa.float32())
    return pa.ExtensionArray.from_storage(pa.fixed_shape_tensor(pa.float32(), SHAPE), pa.FixedSizeListArray.from_arrays(flat, math.prod(SHAPE)))


def op1_audio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = audio_features(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "tensors", "segments")
