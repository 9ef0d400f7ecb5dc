"""Language of words and documents by a linear-chain conditional random field.

A chain is the words of a line. A word's features are its byte n-grams, with the spaces around it, so that those
at its ends are its affixes, and its entry in a lexicon of the words that were frequent in training. Labels are languages; the
weights of features and of transitions between labels are learned together, by the gradient of the chains' likelihood, of
which training chains switch language in the middle. Forward-backward gives each word the probabilities of its labels: runs
of words of one label are what code-switched text is cut to, and a document has the language of the largest sum.

Long chains are stepped through in links of CHAIN words side by side: a link's words make a matrix that carries any message over it, so
that the messages at the cuts come first, and with them the marginals are those of the whole line, as if it had not been cut.

Training takes a bounded sample: up to SAMPLE documents of each language, at random by a hash of doc_id, LIMIT at most. They are drawn
by their ids and languages alone; only their texts are fetched, and are the only thing that the driver gathers. The model, some
MODEL_BYTES, goes to the executors with the function that applies it; all texts are labelled whole, row by row, with no shuffle.

Defined results: a null text, or one without a letter, is "und" with score 0 and no runs; so are all if nothing was learned. Equal
texts have equal results wherever they stand; an empty table gives an empty result. Ties between labels go to the first by name.
Columns that clash with the operator's are replaced by them. A text of any length is labelled whole. A doc_id that stands in many rows has as
many places in the sample's draw.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, tidy
from .windows import PolyHash, mixed

#: Documents to learn from: for each language, and in all.
SAMPLE, LIMIT = 250, 4000
#: Words of a chain's links; n-grams; bits of the table of their weights; words in the lexicon for each language.
CHAIN, NGRAMS, TABLE_BITS, LEXICON = 128, (2, 3, 4), 17, 2000
EPOCHS, CHAINS, RATE, SHRINK = 4, 256, 0.3, 1e-6
#: Training chains: words, and the chance that one goes over to another language midway.
TRAIN_WORDS, SWITCHES = 32, 0.15
MODEL_BYTES = (1 << TABLE_BITS) * 4 * 4
#: Bytes of text that are labelled at once, about.
PACK_BYTES = 2 << 20
UND = "und"
_LETTER = re.compile(r"[^\W\d_]")


class Words:
    """Distinct words of texts, in lower case: which of them each word is, and the places of their n-grams in the table."""

    def __init__(self, hasher: PolyHash, texts: list[str]) -> None:
        raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
        data = np.frombuffer(b" " + b"\n".join(raw) + b"\n ", np.uint8)
        gap = (data == 32) | ((data >= 9) & (data <= 13))
        edge = np.flatnonzero(np.diff(gap.astype(np.int8)))
        start, end = edge[::2] + 1, edge[1::2] + 1
        size = np.array([len(r) + 1 for r in raw], np.int64)
        self.text = np.searchsorted(np.cumsum(size) + 1, start, "right")
        line = np.cumsum(data == 10)[start] if len(start) else start
        self.line = line
        prefix = hasher.prefix(data)
        self.key, one, self.word = np.unique(hasher.windows(prefix, start, end), return_index=True, return_inverse=True)
        # each distinct word with a space on both sides
        n = end[one] - start[one] + 2
        self.first = np.cumsum(n) - n
        at = np.repeat(start[one] - 1 - self.first, n) + np.arange(n.sum())
        flat = np.where(gap[at], 32, data[at]).astype(np.uint8)
        own, last = hasher.prefix(flat), np.repeat(self.first + n, n)
        self.grams, self.of = [], []
        word = np.repeat(np.arange(len(n)), n)
        for k in NGRAMS:
            p = np.flatnonzero(np.arange(len(flat)) + k <= last)
            self.grams.append((hasher.windows(own, p, p + k) >> np.uint64(64 - TABLE_BITS)).astype(np.int64))
            self.of.append(word[p])
        self.letters = np.bincount(word, (flat >= 128) | ((flat >= 97) & (flat <= 122)), len(n)) > 0


@dataclass
class Model:
    """labels, weights of n-grams (table, label) and of lexicon words (their keys, sorted), and of transitions and starts."""

    labels: list[str]
    grams: np.ndarray
    lexicon: np.ndarray
    known: np.ndarray
    moves: np.ndarray
    starts: np.ndarray

    def scores(self, w: Words) -> np.ndarray:
        """Each distinct word's score for each label: the mean of its n-grams' weights, and its lexicon entry's."""
        n, k = len(w.key), len(self.labels)
        out = np.zeros((n, k))
        count = np.zeros(n)
        for grams, of in zip(w.grams, w.of, strict=True):
            count += np.bincount(of, minlength=n)
            for j in range(k):
                out[:, j] += np.bincount(of, self.grams[grams, j], n)
        out /= np.sqrt(np.maximum(count, 1))[:, None]
        at, hit = self.lookup(w)
        out[hit] += self.known[at[hit]]
        return out

    def lookup(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.lexicon):
            return np.zeros(len(w.key), np.int64), np.zeros(len(w.key), bool)
        at = np.minimum(np.searchsorted(self.lexicon, w.key), len(self.lexicon) - 1)
        return at, self.lexicon[at] == w.key


def forward_backward(
    scores: np.ndarray, first: np.ndarray, size: np.ndarray, moves: np.ndarray, starts: np.ndarray, pairs: bool = False, into: np.ndarray | None = None, onward: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray | None, np.ndarray | None]:
    """Marginals (word, label) of chains of words that lie together, from first on and size long; and where pairs is true,
    the expected transitions and starts. All chains are stepped through side by side, the longest first. into and onward: for
    each chain the weights of its first label, in place of starts, and of its last, in place of ones."""
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    e = np.exp(scores - scores.max(axis=1, keepdims=True)) if len(scores) else scores
    m = np.exp(moves)
    s = np.broadcast_to(np.exp(starts), (len(first), len(starts))) if into is None else into[order]
    fore, back = np.empty_like(e), np.empty_like(e)
    live = [int(np.searchsorted(-size, -t, "left")) for t in range(int(size[0]) if len(size) else 0)]  # chains longer than t
    for t, k in enumerate(live):
        at = first[:k] + t
        a = (fore[at - 1] @ m if t else s) * e[at]
        fore[at] = a / a.sum(axis=1, keepdims=True)
    back[first + size - 1] = 1 if onward is None else onward[order]
    counts = np.zeros_like(m) if pairs else None
    for t in range(len(live) - 2, -1, -1):
        on = first[: live[t + 1]] + t
        ahead = e[on + 1] * back[on + 1]
        b = ahead @ m.T
        if pairs:
            both = fore[on][:, :, None] * m * ahead[:, None, :]
            counts += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        back[on] = b / b.sum(axis=1, keepdims=True)
    out = fore * back
    out /= out.sum(axis=1, keepdims=True) if len(out) else 1
    return out, counts, out[first].sum(axis=0) if pairs else None


def _carried(scores: np.ndarray, first: np.ndarray, size: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """For each link a matrix, up to a factor: from the weights of its first label to what they and its words give its last."""
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    e, m, k = np.exp(scores - scores.max(axis=1, keepdims=True)), np.exp(moves), len(moves)
    out = np.eye(k) * e[first][:, None, :]
    for t in range(1, int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -t, "left"))
        on = (out[:n] @ m) * e[first[:n] + t][:, None, :]
        out[:n] = on / on.sum(axis=(1, 2), keepdims=True)
    back = np.empty_like(out)
    back[order] = out
    return back


def marginals(scores: np.ndarray, first: np.ndarray, size: np.ndarray, moves: np.ndarray, starts: np.ndarray, link: int = CHAIN) -> np.ndarray:
    """forward_backward()'s marginals of chains of any length, stepped through in links of so many words."""
    parts = -(-size // link)
    if not len(size) or parts.max() == 1:
        return forward_backward(scores, first, size, moves, starts)[0]
    stop = np.cumsum(parts)
    head = stop - parts
    nth = np.arange(stop[-1]) - np.repeat(head, parts)
    at = np.repeat(first, parts) + nth * link
    length = np.minimum(link, np.repeat(first + size, parts) - at)
    m = np.exp(moves)
    into, onward = np.tile(np.exp(starts), (len(at), 1)), np.ones((len(at), len(moves)))
    many = np.flatnonzero(np.repeat(parts, parts) > 1)
    carry = np.zeros((len(at), len(moves), len(moves)))
    carry[many] = _carried(scores, at[many], length[many], moves)
    for t in range(1, int(parts.max())):
        on = head[parts > t] + t
        a = np.einsum("ni,nij->nj", into[on - 1], carry[on - 1]) @ m
        into[on] = a / a.sum(axis=1, keepdims=True)
    for t in range(int(parts.max()) - 2, -1, -1):
        on = head[parts > t + 1] + t
        b = np.einsum("nij,nj->ni", carry[on + 1], onward[on + 1]) @ m.T
        onward[on] = b / b.sum(axis=1, keepdims=True)
    return forward_backward(scores, at, length, moves, starts, into=into, onward=onward)[0]


def train(texts: list[str], langs: list[str], seed: int = 1) -> Model:
    """The model of texts of known languages."""
    labels = sorted(set(langs))
    k, hasher, rng = len(labels), PolyHash(7), np.random.default_rng(seed)
    w = Words(hasher, texts)
    gold = np.array([labels.index(x) for x in langs], np.int64)[w.text]
    keys = []
    for j in range(k):
        count = np.bincount(w.word[gold == j], minlength=len(w.key))
        top = np.argsort(-count, kind="stable")[:LEXICON]
        keys.append(w.key[top[count[top] > 1]])
    lexicon = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)
    model = Model(labels, np.zeros((1 << TABLE_BITS, k)), lexicon, np.zeros((len(lexicon), k)), np.zeros((k, k)), np.zeros(k))
    # chains: runs of words of a line; some are one half of a chain and one half of another
    new = np.flatnonzero(np.diff(w.line, prepend=-1))
    size = np.diff(new, append=len(w.line))
    cut = np.repeat(new, -(-size // TRAIN_WORDS))
    nth = np.arange(len(cut)) - np.searchsorted(cut, cut)
    begin = cut + nth * TRAIN_WORDS
    end = np.minimum(begin + TRAIN_WORDS, np.repeat(new + size, -(-size // TRAIN_WORDS)))
    at, hit = model.lookup(w)
    grams, of = np.concatenate(w.grams), np.concatenate(w.of)
    order = np.argsort(of, kind="stable")
    grams, edges = grams[order], np.searchsorted(of[order], np.arange(len(w.key) + 1))
    squares = [np.full_like(x, 1e-2) for x in (model.grams, model.known, model.moves, model.starts)]
    for _ in range(EPOCHS):
        turn = rng.permutation(len(begin))
        for a in range(0, len(turn), CHAINS):
            chains = []
            for c in turn[a : a + CHAINS].tolist():
                words = np.arange(begin[c], end[c])
                if rng.random() < SWITCHES:
                    d = int(rng.integers(len(begin)))
                    other = np.arange(begin[d], end[d])
                    words = np.concatenate([words[: len(words) // 2 + 1], other[len(other) // 2 :]])
                chains.append(words)
            n = np.array([len(c) for c in chains])
            words, first = np.concatenate(chains), np.cumsum(n) - n
            kinds, same = np.unique(w.word[words], return_inverse=True)
            many = edges[kinds + 1] - edges[kinds]
            own = grams[np.repeat(edges[kinds] - np.cumsum(many) + many, many) + np.arange(many.sum())]
            row, scale = np.repeat(np.arange(len(kinds)), many), 1 / np.sqrt(np.maximum(many, 1))
            scores = np.stack([np.bincount(row, model.grams[own, j], len(kinds)) for j in range(k)], axis=1) * scale[:, None]
            in_lexicon = hit[kinds]
            scores[in_lexicon] += model.known[at[kinds[in_lexicon]]]
            marginal, pairs, starts = forward_backward(scores[same], first, n, model.moves, model.starts, pairs=True)
            y = gold[words]
            marginal[np.arange(len(y)), y] -= 1
            inside = np.ones(len(y), bool)
            inside[first] = False
            step = np.flatnonzero(inside)
            np.subtract.at(pairs, (y[step - 1], y[step]), 1)
            starts = starts - np.bincount(y[first], minlength=k)
            by_kind = np.stack([np.bincount(same, marginal[:, j], len(kinds)) for j in range(k)], axis=1)
            touched, where = np.unique(own, return_inverse=True)
            per_gram = np.stack([np.bincount(where, (by_kind[:, j] * scale)[row], len(touched)) for j in range(k)], axis=1)
            rows = at[kinds[in_lexicon]]
            for weights, square, index, slope in ((model.grams, squares[0], touched, per_gram), (model.known, squares[1], rows, by_kind[in_lexicon]), (model.moves, squares[2], slice(None), pairs), (model.starts, squares[3], slice(None), starts)):
                slope = slope / len(chains) + SHRINK * weights[index]
                square[index] += slope * slope
                weights[index] -= RATE * slope / np.sqrt(square[index])
    model.grams, model.known = model.grams.astype(np.float32), model.known.astype(np.float32)
    return model


class Labeller:
    def __init__(self, model: Model) -> None:
        self.model, self.hasher = model, PolyHash(7)

    def label(self, texts: list[str]) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
        """For each text its language, the mean probability of it over the words with letters, and the runs of words of one
        label: first word, word after the last, label. A text without a letter has none."""
        labels, out = self.model.labels, [(UND, 0.0, [])] * len(texts)
        real = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
        if not real or not labels:
            return out
        w = Words(self.hasher, [texts[i] for i in real])
        new = np.flatnonzero(np.diff(w.line, prepend=-1))
        size = np.diff(new, append=len(w.line))
        marginal = marginals(self.model.scores(w)[w.word], new, size, self.model.moves, self.model.starts)
        weigh = w.letters[w.word].astype(np.float64)
        count = np.bincount(w.text, weigh, len(real))
        weigh[(count == 0)[w.text]] = 1  # letters of other scripts only
        count = np.bincount(w.text, weigh, len(real))
        sums = np.stack([np.bincount(w.text, marginal[:, j] * weigh, len(real)) for j in range(len(labels))], axis=1)
        # rounded: the last digits of a sum depend on how it was added up
        sums = np.round(sums / np.maximum(count, 1)[:, None], 9)
        best = sums.argmax(axis=1)
        tag = marginal.argmax(axis=1)
        begin = np.searchsorted(w.text, np.arange(len(real) + 1))
        change = np.flatnonzero((np.diff(tag, prepend=-1) != 0) | (np.diff(w.text, prepend=-1) != 0))
        where, stop = w.text[change], np.append(change[1:], len(tag))
        runs: list[list[tuple[int, int, str]]] = [[] for _ in real]
        for t, a, b in zip(where.tolist(), change.tolist(), stop.tolist(), strict=True):
            runs[t].append((a - int(begin[t]), b - int(begin[t]), labels[tag[a]]))
        for k, i in enumerate(real):
            out[i] = (labels[best[k]], float(min(1, max(0, sums[k, best[k]]))), runs[k])
        return out


def held_out(key: Column) -> Column:
    """Documents whose crc32(doc_id as text) mod 4 is 2, which are never learned from. A null doc_id is not one."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, sample: int = SAMPLE, limit: int = LIMIT) -> Model:
    """The model of a bounded sample of docs (doc_id, text, lang) that are not held out."""
    known = docs.where(~held_out(F.col("doc_id")) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    slim = known.select("doc_id", F.col("lang").alias("_l"), F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.lit("langid")).alias("_u"))
    # of each language the first in the order of the hash; Spark takes them in every task before they meet
    nth = F.row_number().over(Window.partitionBy("_l").orderBy("_u", "doc_id"))
    drawn = slim.withColumn("_n", nth).where(F.col("_n") <= sample).orderBy("_u", "doc_id", "_l").limit(limit)
    drawn = drawn.select(F.col("doc_id").alias("_id"), "_l", "_u").distinct()
    # limit rows at most are broadcast
    rows = known.select("doc_id", "text", "lang").join(F.broadcast(drawn), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("lang") == F.col("_l")))
    got = rows.orderBy("_u", "doc_id", "lang", "text").select("text", "lang").limit(limit).collect()  # bounded by limit
    return train([r["text"] for r in got], [r["lang"] for r in got])


LABELLED = "lang_pred string, score double, runs array<struct<first:int,end:int,lang:string>>"
_RUN = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))


def labelled(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns keep of docs, with LABELLED."""
    own = [c for c in keep if c not in ("lang_pred", "score", "runs")]
    slim = docs.select(*[F.col(f"`{c}`") for c in own], F.col(f"`{text}`").alias("_text"))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller, k = Labeller(model), len(own)

        def labels(batch: pa.RecordBatch, begin: int, texts: list[str]) -> pa.RecordBatch:
            got = labeller.label(texts)
            cols = [batch.column(j).slice(begin, len(texts)) for j in range(k)]
            runs = pa.array([[{"first": a, "end": b, "lang": x} for a, b, x in g[2]] for g in got], _RUN)
            return pa.RecordBatch.from_arrays([*cols, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()), runs], [*own, "lang_pred", "score", "runs"])

        for batch in batches:
            texts, size, begin = [], 0, 0
            for i, t in enumerate(batch.column(k).to_pylist()):
                texts.append(t or "")
                size += len(t or "")
                if size >= PACK_BYTES or i + 1 == len(batch):
                    yield labels(batch, begin, texts)
                    texts, size, begin = [], 0, i + 1

    schema = ", ".join(f"`{c}` {slim.schema[c].dataType.simpleString()}" for c in own)
    return slim.mapInArrow(run, f"{schema}, {LABELLED}" if own else LABELLED)


def op4_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = labelled(docs.select("doc_id", "text"), fit(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", F.size("runs").cast("long").alias("n_runs"))
