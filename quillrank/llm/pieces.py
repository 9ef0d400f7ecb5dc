"""SentencePiece encoding by forward filtering and backward sampling, and its decoding.

A text, with a space before it, is a lattice: an edge for each piece of the vocabulary that stands at a place, and for the bytes of
a character that no piece is. A segmentation's weight is the product of its pieces' probabilities to the power ALPHA. The
forward pass sums the weights of all ways to each place; the backward pass draws the last piece by its share, then the one
before it, and so on, which draws whole segmentations by their weights, exactly. The draws come from a hash of the row's key,
the word and the step: a row is cut the same on any cluster, and differently under another seed.

The vocabulary's ranks stand for probabilities, as Zipf's law has them: a model of merges has ranks and no probabilities. No
piece has a space after its first letter, nor a new line or tab, so the lattice falls into words, whose forward passes are made
once for all of a batch's equal words. Spaces are the pieces' own sign; that sign itself, in a text, goes by its bytes. So decoding
gives back every text.

A row depends on nothing but its own text and key; nothing is shuffled, and a lost task is simply run again.

Defined results: a null text has null ids, an empty one none; a null key counts as 0; rows of equal text and key are cut alike; a text
or word of any length is encoded whole; an empty table gives an empty result. Columns that clash with the operator's are replaced by them.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, tidy, tokenizer_path
from .windows import PolyHash, mixed

MODEL = "piece_bpe_32k.model"
ALPHA, SEED = 1.0, 1
#: Bytes of text that are encoded at once, about.
PACK_BYTES = 1 << 19
#: The longest piece has no more bytes.
LONGEST = 64
_STEP, _WORD = 0x9E3779B97F4A7C15, np.uint64(0xC2B2AE3D27D4EB4F)
_TINY, _UP = 1e-150, 1e150


class Vocabulary:
    """Pieces as bytes, their probabilities, and a trie over them: step[node, byte] is the next node, 0 none; piece[node] an id or -1."""

    def __init__(self, proto: bytes) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        n = model.get_piece_size()
        self.bytes: list[bytes] = [b""] * n
        self.byte_id = np.zeros(256, np.int32)
        rank, words = np.full(n, n, np.float64), []
        for i in range(n):
            if model.is_byte(i):
                b = int(model.id_to_piece(i)[3:-1], 16)
                self.bytes[i], self.byte_id[b] = bytes([b]), i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.bytes[i] = model.id_to_piece(i).replace("▁", " ").encode()
                rank[i] = min(-model.get_score(i), n)
                words.append(i)
        share = 1 / (rank + 2)
        self.share = share / share.sum()
        nodes: dict[tuple[int, int], int] = {}
        piece = {0: -1}
        for i in words:
            node = 0
            for b in self.bytes[i]:
                node = nodes.setdefault((node, b), len(nodes) + 1)
            piece[node] = i
        self.step = np.zeros((len(nodes) + 1, 256), np.int32)
        for (node, b), to in nodes.items():
            self.step[node, b] = to
        self.piece = np.array([piece.get(k, -1) for k in range(len(nodes) + 1)], np.int32)
        self.size = np.array([len(b) for b in self.bytes])
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)


@functools.lru_cache(maxsize=1)
def vocabulary(proto: bytes) -> Vocabulary:
    """The vocabulary of a model, made once in a worker and kept for its later tasks."""
    return Vocabulary(proto)


def read_model(path: str) -> bytes:
    """The driver reads the file, of a megabyte or less; it goes to the executors with the function, which need no such path."""
    with open(path, "rb") as f:
        return f.read()


def _each(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for size[0] numbers, then those from start[1], and so on."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())


class Lattices:
    """Forward passes over words laid end to end. Node k of word w is at first[w] + k: the place before its byte k.

    Edges that end in a node lie together: from edge[node], many[node] of them, with the source, the piece, and the shares of
    the weight summed up.
    """

    def __init__(self, voc: Vocabulary, data: np.ndarray, size: np.ndarray, alpha: float) -> None:
        start = np.cumsum(size) - size
        word = np.repeat(np.arange(len(size)), size)
        self.first, self.last = start + np.arange(len(size)), start + np.arange(len(size)) + size
        src, dst, ids = self._edges(voc, data, (start + size)[word], np.arange(len(data)) + word)
        local = dst - self.first[np.searchsorted(self.first, dst, "right") - 1]
        order = np.lexsort((dst, local))
        src, dst, ids, local = src[order], dst[order], ids[order], local[order]
        head = np.flatnonzero(np.diff(dst, prepend=-1))  # where the edges of a node begin
        node = dst[head]
        n = len(data) + len(size)
        self.edge, self.many = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.edge[node], self.many[node] = head, np.diff(head, append=len(dst))
        chance = voc.share[ids] ** alpha
        total, weight = np.zeros(n), np.zeros(len(dst))
        total[self.first] = 1
        first_node = self.first[np.searchsorted(self.first, node, "right") - 1]
        cuts = np.flatnonzero(np.diff(local[head], prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(head)], strict=True):
            lo, hi = head[a], head[b] if b < len(head) else len(dst)
            weight[lo:hi] = total[src[lo:hi]] * chance[lo:hi]
            sums = np.add.reduceat(weight[lo:hi], head[a:b] - lo)
            total[node[a:b]] = sums
            weight[lo:hi] /= np.repeat(np.where(sums > 0, sums, 1), self.many[node[a:b]])
            small = np.flatnonzero((sums < _TINY) & (sums > 0))
            for k in range(LONGEST) if len(small) else ():  # what later edges start from, scaled alike
                at = node[a:b][small] - k
                total[at[at >= first_node[a:b][small]]] *= _UP
        upto = np.cumsum(weight)
        upto -= np.repeat(upto[head] - weight[head], self.many[node])
        upto[head + self.many[node] - 1] = 2  # a draw always ends
        self.src, self.ids, self.upto = src, ids, upto

    @staticmethod
    def _edges(voc: Vocabulary, data: np.ndarray, end: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, ...]:
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        width = np.where(data[lead] < 0x80, 1, np.where(data[lead] < 0xE0, 2, np.where(data[lead] < 0xF0, 3, 4)))
        char = np.zeros(len(data), np.int64)
        char[lead] = width
        covered = np.zeros(len(data), bool)
        src, dst, ids = [], [], []
        at, state, depth = lead, np.zeros(len(lead), np.int32), 0
        while len(at):
            state = voc.step[state, data[at + depth]]
            depth += 1
            live = state > 0
            at, state = at[live], state[live]
            hit = voc.piece[state] >= 0
            here = at[hit]
            src.append(node[here])
            dst.append(node[here] + depth)
            ids.append(voc.piece[state[hit]])
            covered[here[char[here] == depth]] = True
            live = at + depth < end[at]
            at, state = at[live], state[live]
        bare = lead[~covered[lead]]
        at = _each(bare, np.minimum(char[bare], end[bare] - bare))
        return np.concatenate([*src, node[at]]), np.concatenate([*dst, node[at] + 1]), np.concatenate([*ids, voc.byte_id[data[at]]])

    def sample(self, words: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A segmentation of each of the words: the ids of all, one word after another, and the number of each."""
        live, node, first = np.arange(len(words)), self.last[words], self.first[words]
        n, steps, t = np.zeros(len(words), np.int64), [], 0
        while len(live):
            u = (mixed(seeds[live] + np.uint64((t + 1) * _STEP % 2**64)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
            e = self.edge[node]
            over = np.flatnonzero(u >= self.upto[e])
            while len(over):
                e[over] += 1
                over = over[u[over] >= self.upto[e[over]]]
            steps.append((live, self.ids[e]))
            node = self.src[e]
            n[live] += 1
            t += 1
            more = node > first
            live, node, first = live[more], node[more], first[more]
        stop = np.cumsum(n)
        out = np.empty(stop[-1] if len(stop) else 0, np.int32)
        for k, (who, ids) in enumerate(steps):
            out[stop[who] - 1 - k] = ids
        return out, n


class Encoder:
    def __init__(self, proto: bytes, alpha: float = ALPHA, seed: int = SEED) -> None:
        self.voc, self.alpha, self.hasher = vocabulary(proto), alpha, PolyHash(6)
        self.seed = np.uint64(seed * int(_WORD) % 2**64)

    def encode(self, texts: list[bytes], keys: np.ndarray, exact: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and the number of each; keys: a number for each text.

        exact: words are told apart by their bytes and not by a hash; used where decoding finds a difference.
        """
        size = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
        data = np.frombuffer(b"".join(b" " + t for t in texts if t), np.uint8)
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        begin = np.zeros(len(data) + 1, bool)
        alone = np.flatnonzero((data == 10) | (data == 9))
        begin[alone] = begin[alone + 1] = True
        space = data == 32
        begin[1:-1] |= space[1:] & ~space[:-1]
        begin[(np.cumsum(size) - size)[size > 0]] = True
        start = np.flatnonzero(begin[:-1])
        length = np.diff(start, append=len(data))
        if exact:
            known: dict[bytes, int] = {}
            same = np.array([known.setdefault(data[a : a + n].tobytes(), len(known)) for a, n in zip(start, length, strict=True)])
            one = np.unique(same, return_index=True)[1]
        else:
            _, one, same = np.unique(self.hasher.windows(self.hasher.prefix(data), start, start + length), return_index=True, return_inverse=True)
        lattices = Lattices(self.voc, data[_each(start[one], length[one])], length[one], self.alpha)
        text = np.searchsorted(np.cumsum(size), start, "right")
        nth = np.arange(len(start)) - np.searchsorted(text, np.arange(len(texts)))[text]
        seeds = mixed(mixed(keys.astype(np.int64).view(np.uint64) + self.seed)[text] + nth.astype(np.uint64) * _WORD)
        ids, n = lattices.sample(same, seeds)
        return ids, np.bincount(text, n, len(texts)).astype(np.int64)

    def decode(self, ids: np.ndarray, n: np.ndarray) -> list[bytes]:
        """The texts of encode()."""
        size = self.voc.size[ids]
        data = self.voc.flat[_each(self.voc.start[ids], size)].tobytes()
        stop = np.cumsum(np.append(0, size))[np.cumsum(np.append(0, n))].tolist()
        return [data[a + 1 : b] if b > a else b"" for a, b in zip(stop, stop[1:], strict=False)]

    def lossless(self, texts: list[bytes], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """encode(), checked by decode(). Should two words share a hash, they are told apart by their bytes."""
        ids, n = self.encode(texts, keys)
        if self.decode(ids, n) != texts:
            ids, n = self.encode(texts, keys, exact=True)
            if self.decode(ids, n) != texts:
                raise AssertionError("a text doesn't come back from its pieces")
        return ids, n


def _packs(column: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    texts, size, begin = [], 0, 0
    for i, t in enumerate(column.to_pylist()):
        texts.append(t)
        size += len(t or "")
        if size >= PACK_BYTES or i + 1 == len(column):
            yield begin, texts
            texts, size, begin = [], 0, i + 1


def encoded(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ("doc_id",), model: str | None = None, alpha: float = ALPHA, seed: int = SEED) -> DataFrame:
    """The columns keep of docs, with n_pieces and ids: the pieces of each text, which decoded() gives back."""
    own, proto = [c for c in keep if c not in ("n_pieces", "ids")], read_model(model or tokenizer_path(MODEL))
    slim = docs.select(*[F.col(f"`{c}`") for c in own], F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("_key"), F.col(f"`{text}`").alias("_text"))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, k = Encoder(proto, alpha, seed), len(own)
        for batch in batches:
            for begin, texts in _packs(batch.column(k + 1)):
                data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
                ids, n = encoder.lossless(data, batch.column(k).slice(begin, len(texts)).to_numpy())
                none = np.array([t is None for t in texts])
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum(np.append(0, n)), pa.int32(), mask=np.append(none, False)), pa.array(ids))
                cols = [batch.column(j).slice(begin, len(texts)) for j in range(k)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(n, mask=none), lists], [*own, "n_pieces", "ids"])

    schema = ", ".join(f"`{c}` {slim.schema[c].dataType.simpleString()}" for c in own)
    return slim.mapInArrow(run, f"{schema}, n_pieces long, ids array<int>" if own else "n_pieces long, ids array<int>")


def decoded(rows: DataFrame, keep: tuple[str, ...] = ("doc_id",), model: str | None = None) -> DataFrame:
    """The columns keep of rows (ids and others), with decoded: the text."""
    own, proto = [c for c in keep if c not in ("decoded", "ids")], read_model(model or tokenizer_path(MODEL))
    slim = rows.select(*[F.col(f"`{c}`") for c in own], "ids")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, k = Encoder(proto), len(own)
        for batch in batches:
            lists = batch.column(k)
            n = lists.value_lengths().fill_null(0).to_numpy().astype(np.int64)
            texts = encoder.decode(lists.flatten().to_numpy(), n)
            out = pa.array([t.decode("utf-8", "surrogatepass") if ok else None for t, ok in zip(texts, lists.is_valid().to_pylist(), strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(j) for j in range(k)), out], [*own, "decoded"])

    schema = ", ".join(f"`{c}` {slim.schema[c].dataType.simpleString()}" for c in own)
    return slim.mapInArrow(run, f"{schema}, decoded string" if own else "decoded string")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(read(spark, sf_dir, "documents"))
