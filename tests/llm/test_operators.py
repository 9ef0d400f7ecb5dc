"""The corpus operators against plain versions, and on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import html
import itertools
import math
import os
import random
import re
import time
import zlib
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillrank.llm import audio, chat, htmltext, langid, lsmdedup, mixing, neardup, pieces, quality, rindex, suffixdedup, windows
from quillrank.llm.common import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts, ids=None, langs=None, sources=None):
    rows = [(i if ids is None else ids[i], t, (langs or {}).get(i, "en"), (sources or {}).get(i, "s"), len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def words(rng, n, vocabulary=2000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


EDGES = [None, "", " \n\t", "a", "one two three", "same text here", "same text here", "long " * 30_000, "é日本\x0b🙂  x"]


def clash(df, *names):
    return df.withColumns({n: F.lit("clash") for n in names})


# 1 media columns


def test_media_round_trip(spark):
    df = clash(frame(spark, EDGES), "media", "feature")
    got = {(r.doc_id): r for r in audio.audio_features(df).collect()}
    for i, t in enumerate(EDGES):
        data = (t or "").encode()
        payload = data + bytes(-len(data) % 64 or (0 if data else 64))
        r = got[i]
        assert audio.from_wav(bytes(r.media))[1] == payload and r.n_bytes == len(data) and r.payload_bytes == len(payload) and len(payload) % 64 == 0
        assert (r.payload_sha256, r.tail_crc32, r.media_sha256) == (hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), hashlib.sha256(bytes(r.media)).hexdigest())
        assert all(len(x["values"]) == math.prod(audio.SHAPE) for x in r.tensors) and r.tensors[0]["end_s"] > r.tensors[0]["start_s"]
    assert got[5].feature == got[6].feature
    assert audio.audio_features(frame(spark, [])).count() == 0


def test_features_by_blocks_and_plain():
    rng = np.random.default_rng(1)
    payload = rng.integers(0, 256, 64 * 9000, dtype=np.uint8).tobytes()
    f = audio.Features()
    mel, level = f.frames(payload)
    block, audio.BLOCK = audio.BLOCK, 64 * 10_000
    try:
        whole, whole_level = audio.Features().frames(payload)
    finally:
        audio.BLOCK = block
    assert np.allclose(mel, whole) and np.allclose(level, whole_level)
    x = np.concatenate([np.zeros(audio.TAPS - 1), np.frombuffer(payload, np.uint8)[:64] / 128 - 1])
    y = audio.resampled(x[audio.TAPS - 1 :], x[: audio.TAPS - 1], f.h)
    plain = [sum(f.h[m * audio.DOWN % audio.UP, k] * x[m * audio.DOWN // audio.UP - k + audio.TAPS - 1] for k in range(audio.TAPS)) for m in range(48)]
    assert np.allclose(y, plain)


def test_mel_energies_plain():
    rng = np.random.default_rng(5)
    payload = rng.integers(0, 256, 64 * 60, dtype=np.uint8).tobytes()
    f = audio.Features()
    mel, level = f.frames(payload)
    x = audio.resampled(np.frombuffer(payload, np.uint8) / 128.0 - 1, np.zeros(audio.TAPS - 1), f.h)
    x = np.concatenate([x, np.zeros(audio.FRAME)])
    hertz = lambda m: 700 * (10 ** (m / 2595) - 1)
    top = 2595 * math.log10(1 + f.rate / 2 / 700)
    edges = [hertz(top * k / (audio.MELS + 1)) for k in range(audio.MELS + 2)]
    for t in range(len(mel) - 1):
        cut = x[t * audio.HOP : t * audio.HOP + audio.FRAME] * np.hanning(audio.FRAME)
        power = [abs(sum(cut * np.exp(-2j * np.pi * k * np.arange(audio.FRAME) / audio.FRAME))) ** 2 for k in range(audio.FRAME // 2 + 1)]
        for m in range(audio.MELS):
            low, mid, high = edges[m : m + 3]
            total = sum(p * max(0, min((k * f.rate / audio.FRAME - low) / (mid - low), (high - k * f.rate / audio.FRAME) / (high - mid))) for k, p in enumerate(power))
            assert mel[t, m] == pytest.approx(math.log10(total + 1e-6))
        assert level[t] == pytest.approx(10 * math.log10((cut * cut).mean() + 1e-9))


def test_tensors_are_stored_with_spans(spark, tmp_path):
    texts = ["x" * 100, "y" * 40_000, None]
    audio.audio_features(frame(spark, texts)).select("doc_id", "tensors").write.parquet(f"{tmp_path}/t")
    back = spark.read.parquet(f"{tmp_path}/t")
    assert back.schema["tensors"].metadata == audio.TENSOR
    f, step = audio.Features(), audio.HOP / (audio.RATE * audio.UP / audio.DOWN)
    for r in back.collect():
        mel = f.frames(audio.padded((texts[r.doc_id] or "").encode()))[0]
        got = audio.as_tensors(pa.array([x["values"] for x in r.tensors], pa.list_(pa.float32())))
        assert got.type == pa.fixed_shape_tensor(pa.float32(), audio.SHAPE)
        flat = got.to_numpy_ndarray().reshape(-1, audio.MELS)
        assert np.allclose(flat[: len(mel)], mel, atol=1e-5) and not flat[len(mel) :].any()
        assert [x["start_s"] for x in r.tensors] == pytest.approx([k * audio.SHAPE[0] * step for k in range(len(r.tensors))])
    with pytest.raises(ValueError, match="shape"):
        audio.as_tensors(pa.array([[0.0] * 7], pa.list_(pa.float32())))


def test_hysteresis_and_tensors():
    assert audio.hysteresis(np.array([0, 3, 2, 2, 0, 3, 0.5, 1]), 3, 1) == [(1, 4), (5, 6)]
    assert audio.hysteresis(np.array([2.0, 2]), 3, 1) == []
    t = audio.as_tensors(pa.array([[0.0] * math.prod(audio.SHAPE)], pa.list_(pa.float32())))
    assert t.type.shape == list(audio.SHAPE)


# 2 near-duplicates


def components_of(texts, ids, k=4):
    def sets(t):
        w = WORD.findall((t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()

    s = [sets(t) for t in texts]
    comp = list(range(len(ids)))
    for a, b in itertools.combinations(range(len(ids)), 2):
        both = len(s[a] & s[b])
        if ids[a] == ids[b] or both and 100 * both >= 80 * (len(s[a]) + len(s[b]) - both):
            comp = [comp[a] if c == comp[b] else c for c in comp]
    least = {c: min(i for i, d in zip(ids, comp) if d == c) for c in set(comp)}
    return {(i, len(x), least[c]) for i, x, c in zip(ids, s, comp)}


def near(spark, texts, ids=None):
    ids = ids or list(range(len(texts)))
    got = neardup.near_duplicates(clash(frame(spark, texts, ids), "component_id", "bucket")).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == components_of(texts, ids)
    assert len(got) == len(texts) and all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates(spark):
    rng, texts = random.Random(3), []
    for n in (5, 9, 16, 30, 60, 200):  # copies with more and more words exchanged, at and around the threshold
        base = words(rng, n).split()
        for k in range(12):
            copy = base[:]
            for _ in range(k * n // 60 + k % 3):
                copy[rng.randrange(n)] = f"x{rng.randrange(9999)}"
            texts.append(" ".join(copy).upper() if k == 1 else " ".join(copy))
    passage = words(rng, 60)
    texts += [f"{words(rng, 150)} {passage} {words(rng, 20)}" for _ in range(25)]
    rng.shuffle(texts)
    near(spark, [*texts, *EDGES])


@pytest.mark.parametrize("limit", [("BLOCK", 5), ("BLOCK_BYTES", 2000)])
def test_near_duplicates_by_blocks(spark, monkeypatch, limit):
    monkeypatch.setattr(neardup, *limit)
    rng = random.Random(5)
    base = words(rng, 80).split()
    texts = []
    for _ in range(40):
        copy = base[:]
        for _ in range(rng.randrange(6)):
            copy[rng.randrange(80)] = f"y{rng.randrange(99)}"
        texts.append(" ".join(copy))
    near(spark, texts)


def thue_morse(n, a, b):
    """Words that every polynomial modulo a power of two takes for those with a and b exchanged."""
    return " ".join(b if bin(i).count("1") & 1 else a for i in range(n))


def test_near_duplicates_that_a_polynomial_confuses(spark):
    head, tail = words(random.Random(1), 7), words(random.Random(2), 7)
    near(spark, [f"{head} {thue_morse(1024, a, b)} {tail}" for a, b in ("ab", "ba")])


def test_near_duplicates_recall(spark):
    """Pairs at and above the threshold, of sets too large for prefix filtering: all are found."""
    rng, texts, linked = random.Random(11), [], 0
    while len(texts) < 2400:
        base = [f"v{rng.randrange(10**6)}" for _ in range(rng.randrange(40, 150))]
        copy = base[:]
        for _ in range(max(1, len(base) // 40)):
            copy[rng.randrange(len(base))] = f"u{rng.randrange(10**6)}"
        texts += [" ".join(base), " ".join(copy)]
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(frame(spark, texts)).collect()}
    grams = [{tuple(w[i : i + 4]) for i in range(len(w) - 3)} for w in (t.split() for t in texts)]
    for i in range(0, len(texts), 2):
        both = len(grams[i] & grams[i + 1])
        want = 100 * both >= 80 * (len(grams[i]) + len(grams[i + 1]) - both)
        linked += want
        assert (got[i + 1] == i) == want and got[i] == i
    assert linked > 500


def test_near_duplicates_long_text(spark):
    text = words(random.Random(1), 200_000, 10**6)
    near_ = {r.doc_id: r.component_id for r in neardup.near_duplicates(frame(spark, [text, f"{text} more", text[: len(text) // 2]])).collect()}
    assert near_ == {0: 0, 1: 0, 2: 2}


def test_window_fingerprints(monkeypatch):
    rng = np.random.default_rng(0)
    h, d = windows.PolyHash(1), rng.integers(0, 256, 3000).astype(np.uint8)
    start = rng.integers(0, 2000, 100)
    end = start + rng.integers(1, 900, 100)
    plain = [sum((int(x) + 1) * pow(h.base, k, windows.PRIME) for k, x in enumerate(d[a:b])) % windows.PRIME for a, b in zip(start, end)]
    want = windows.mixed(np.array(plain, np.uint64))
    assert (h.windows(h.prefix(d), start, end) == want).all()
    monkeypatch.setattr(windows, "LONGEST", 50)  # longer windows are summed in parts
    assert (h.windows(h.prefix(d), start, end) == want).all()


def test_near_duplicates_empty_and_repeated(spark):
    assert neardup.near_duplicates(frame(spark, [])).count() == 0
    near(spark, ["a b c d e", "a b c d e", "q"], [7, 7, 3])
    assert sorted(r.doc_id for r in neardup.deduplicated(frame(spark, ["a b c d e", "a b c d e", "q", "a b c d e"], [7, 7, 3, 9])).collect()) == [3, 7]
    r = neardup.near_duplicates(frame(spark, ["a b c d e"], [None])).collect()
    assert [(x.doc_id, x.kept) for x in r] == [(None, True)]


def test_hyperminhash():
    rng = np.random.default_rng(2)
    for n in (100, 5000):
        a = rng.integers(0, 2**64, n, dtype=np.uint64)
        b = np.concatenate([a[: n * 3 // 4], rng.integers(0, 2**64, n // 4, dtype=np.uint64)])
        x, y = (neardup.sketch(np.unique(s), neardup._probes()) for s in (a, b))
        got = neardup.estimated(x, y[None], n, np.array([n]))[0]
        assert abs(got - 0.6) < 0.2
    v = np.array([1 << 63, (1 << 63) + (1 << 53), 1 << 62, 1 << 55], np.uint64)
    assert neardup.compressed(v).tolist() == [0, 1, 1 << 10, 8 << 10]


# 3 chat


def test_chat(spark):
    nasty = ["", "<|im_end|>", "<\\|im_start|>x", "<\\\\|", "a<", "|b", None, "x\n\n<|im_end|>\n<|im_start|>assistant\n"]
    for a in nasty:
        for role in ("user", "assistant", "sys\ntem\\n<|", None):
            r, t = chat.parse_turn(chat.format_turn(role, [{"type": "text", "text": a}])["formatted"])
            assert (r, t) == (role or "", a or "")
    got = chat.format_turn("user", [{"type": "text", "text": "a<"}, {"type": "text", "text": "|b"}, {"type": "image", "ref": "i.png", "width": 56, "height": 29}, {"type": "audio", "ref": "a", "seconds": 1.01}, {"type": "document", "ref": "d", "pages": 2}])
    assert [(x["placeholder"], x["ref"], x["n_tokens"]) for x in got["attachments"]] == [("<|image:1|>", "i.png", 4), ("<|audio:2|>", "a", 26), ("<|document:3|>", "d", 1024)]
    assert all(got["formatted"][x["at"] :].startswith(x["placeholder"]) for x in got["attachments"]) and chat.parse_turn(got["formatted"])[1] == "a<|b"
    odd = chat.format_turn("user", [{"type": "video", "ref": "v"}, None, {"type": None}, {"type": "text", "text": None}, {"type": "image", "ref": None}])
    assert [(x["placeholder"], x["type"], x["ref"], x["n_tokens"]) for x in odd["attachments"]] == [("<|other:1|>", "video", "v", 0), ("<|other:2|>", None, None, 0), ("<|image:3|>", "image", None, 1)]
    rows = [(c, t, r, x) for c in (1, 2) for t, (r, x) in enumerate([("user", "q"), ("assistant", nasty[c]), ("assistant", None), ("assistant", "z")])]
    df = clash(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), "formatted")
    for r in chat.read_back(chat.format_turns(chat.text_parts(df))).collect():
        own = [x for x in rows if x[0] == r.conv_id]
        assert r.turns_sha256 == hashlib.sha256("".join(f"{x[2]}\n{x[3] or ''}\n" for x in own).encode()).hexdigest() and r.n_turns == 4
        said = "".join(x[3] or "" for x in own if x[2] == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    assert chat.read_back(chat.format_turns(chat.text_parts(df.where("false")))).count() == 0


def test_chat_parts_by_spark(spark):
    part = lambda kind, text=None, ref=None, **more: (kind, text, ref, more.get("width"), more.get("height"), more.get("seconds"), more.get("pages"))
    long = "<|x " * 200_000
    rows = [
        (1, 0, "user", [part("text", "see"), part("image", ref="a.png", width=57, height=28), part("text", "and <|hear"), part("audio", ref="b.wav", seconds=2.5), part("document", ref="c.pdf", pages=3)]),
        (1, 1, "assistant", [part("text", "ok <|image:1|>"), part("audio", ref="d")]),
        (None, None, None, None), (2, None, "assistant", [None, part("text", long), part("sound")]), (2, 0, "user", []),
    ]
    turns = chat.format_turns(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat.PARTS}"))
    got = {(r.conv_id, r.turn): r for r in turns.collect()}
    assert [(a.placeholder, a.type, a.ref, a.n_tokens) for a in got[1, 0].attachments] == [("<|image:1|>", "image", "a.png", 3), ("<|audio:2|>", "audio", "b.wav", 63), ("<|document:3|>", "document", "c.pdf", 1536)]
    assert got[1, 0].n_tokens == 3 + 3 + 63 + 1536 and chat.parse_turn(got[1, 0].formatted) == ("user", "seeand <|hear")
    assert all(got[1, 0].formatted[a["at"] :].startswith(a.placeholder) for a in got[1, 0].attachments)
    back = {r.conv_id: r for r in chat.read_back(turns).collect()}
    assert (back[1].n_attachments, back[1].n_turns, back[1].n_tokens) == (4, 2, 1605 + 2)
    assert back[1].loss_sha256 == hashlib.sha256(b"ok <|image:1|>").hexdigest() and back[2].loss_chars == len(long)
    assert (back[None].n_turns, back[None].turns_sha256) == (1, hashlib.sha256(b"\n\n").hexdigest()) and back[2].n_attachments == 1


# 4 languages


def test_forward_backward():
    rng = np.random.default_rng(0)
    sizes = np.array([3, 1, 4])
    first, scores, moves, starts = np.cumsum(sizes) - sizes, rng.normal(size=(8, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    got, pairs, _ = langid.forward_backward(scores, first, sizes, moves, starts, pairs=True)
    expected = np.zeros((3, 3))
    for f, n in zip(first, sizes):
        total, p, q = 0.0, np.zeros((n, 3)), np.zeros((3, 3))
        for y in itertools.product(range(3), repeat=int(n)):
            w = math.exp(starts[y[0]] + sum(scores[f + i, y[i]] for i in range(n)) + sum(moves[y[i], y[i + 1]] for i in range(n - 1)))
            total += w
            for i in range(n):
                p[i, y[i]] += w
            for i in range(n - 1):
                q[y[i], y[i + 1]] += w
        assert np.allclose(p / total, got[f : f + n])
        expected += q / total
    assert np.allclose(pairs, expected)


def test_marginals_do_not_depend_on_links():
    rng = np.random.default_rng(3)
    size = np.array([1, 700, 5, 64, 65, 128, 2000])
    first = np.cumsum(size) - size
    scores, moves, starts = rng.normal(size=(size.sum(), 4)) * 3, rng.normal(size=(4, 4)) * 2, rng.normal(size=4)
    want = langid.forward_backward(scores, first, size, moves, starts)[0]
    for link in (1, 2, 7, 64, 128, 3000):
        assert np.allclose(langid.marginals(scores, first, size, moves, starts, link), want, atol=1e-9)


def test_gradient_is_that_of_the_likelihood():
    """Expected less observed transitions and labels are the slope of minus the log-likelihood, by small differences."""
    rng = np.random.default_rng(4)
    n, k = 6, 3
    scores, moves, starts, gold = rng.normal(size=(n, k)), rng.normal(size=(k, k)), rng.normal(size=k), rng.integers(0, k, n)

    def loss(e, m, s):
        path = lambda y: s[y[0]] + sum(e[i, y[i]] for i in range(n)) + sum(m[y[i], y[i + 1]] for i in range(n - 1))
        return math.log(sum(math.exp(path(y)) for y in itertools.product(range(k), repeat=n))) - path(gold)

    marginal, pairs, begun = langid.forward_backward(scores, np.array([0]), np.array([n]), moves, starts, pairs=True)
    marginal = marginal - np.eye(k)[gold]
    np.subtract.at(pairs, (gold[:-1], gold[1:]), 1)
    begun = begun - np.eye(k)[gold[0]]
    h = 1e-5
    for which, slope in ((0, marginal), (1, pairs), (2, begun)):
        for at in np.ndindex(slope.shape):
            up, down = [scores.copy(), moves.copy(), starts.copy()], [scores.copy(), moves.copy(), starts.copy()]
            up[which][at] += h
            down[which][at] -= h
            assert slope[at] == pytest.approx((loss(*up) - loss(*down)) / (2 * h), abs=1e-6)


def test_sample_is_bounded(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(langid, "train", lambda texts, langs: seen.append(Counter(langs)))
    df = frame(spark, [f"text {i}" for i in range(400)], langs={i: "ab"[i % 2] for i in range(400)})
    langid.fit(df, sample=20)
    langid.fit(df, sample=20, limit=7)
    langid.fit(frame(spark, ["x"] * 50, [None] * 50), sample=20, limit=30)
    assert seen[0] == {"a": 20, "b": 20} and sum(seen[1].values()) == 7 and sum(seen[2].values()) == 30


def test_languages(spark):
    rng = random.Random(1)
    syllables = {"xx": ["ka", "zu", "mo"], "yy": ["len", "tir", "ess"], "zz": ["oui", "eau", "qué"]}
    make = lambda k, n: " ".join("".join(rng.choice(syllables[k]) for _ in range(rng.randint(1, 3))) for _ in range(n))
    kinds = [rng.choice(list(syllables)) for _ in range(300)]
    texts = [make(k, 20) for k in kinds]
    df = frame(spark, [*texts, None, "", "123 !!"], langs={i: k for i, k in enumerate(kinds)} | {300: "xx"})
    model = langid.fit(df)
    got = {r.doc_id: r for r in langid.labelled(clash(df, "runs"), model).collect()}
    assert [got[i].lang_pred for i in (300, 301, 302)] == ["und"] * 3 and got[300].score == 0
    out = [i for i in range(300) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(got[i].lang_pred == kinds[i] for i in out) / len(out) > 0.95
    assert {r.doc_id for r in df.where(langid.held_out(F.col("doc_id"))).collect()} == set(out) | ({300, 301, 302} & {i for i in (300, 301, 302) if zlib.crc32(str(i).encode()) % 4 == 2})
    mixed = langid.Labeller(model).label([make("xx", 12) + " " + make("yy", 12)])[0]
    assert [r[2] for r in mixed[2]][:1] == ["xx"] and mixed[2][-1][2] == "yy" and abs(mixed[2][0][1] - 12) <= 2
    assert langid.labelled(frame(spark, ["text"]), langid.fit(frame(spark, []))).first().lang_pred == "und"
    assert langid.labelled(frame(spark, []), model).count() == 0


# 5 quality


def base_measures(t):
    t = t or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def test_quality(spark):
    rng = random.Random(4)
    part = words(rng, 12)
    texts = [*EDGES, f"{part} {words(rng, 30)} {part}", f"{part} {part} {part}", "x ### | <>\nx ### | <>\n\n \nx", words(rng, 40), " ".join("ab" for _ in range(25))]
    got = {r.doc_id: r for r in quality.apply_policy(quality.ledger(clash(frame(spark, texts), "n_words", "kept"))).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base_measures(t)
        assert r.kept == (r.fail_bits & quality.mask(quality.STANDARD) == 0)
    assert quality.ledger(frame(spark, [])).count() == 0


def test_quality_of_a_long_text(spark):
    text = words(random.Random(1), 150_000, 100_000)
    r = quality.ledger(frame(spark, [text])).first()
    assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base_measures(text)


def test_ablation(spark):
    book = spark.createDataFrame([(0, "a"), (1, "a"), (3, "b"), (4, "b"), (32, "b")], "fail_bits long, source string")
    got = {r.rule: (r.n_failed, r.n_only, r.n_rejected) for r in quality.ablation(book).collect()}
    assert got == {"few_words": (2, 1, 3), "repeated_windows": (1, 0, 3), "symbols": (1, 1, 3), "repeated_lines": (0, 0, 3)}
    assert {(r.source, r.failed_by_some, r.failed_by_all) for r in quality.everywhere(book, "source").collect()} == {("a", 1, 0), ("b", 39, 0)}
    assert all(r.n_failed == 0 for r in quality.ablation(book.where("false")).collect())


def test_a_filter_on_the_ledger_stays_quick(spark):
    df = frame(spark, [words(random.Random(i), 500) for i in range(200)])
    assert quality.apply_policy(quality.ledger(df)).where("kept").count() == 200


# 6 repeated bytes


def repeated_bytes(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        out.append((sum(gone), len(re.findall(rb"\x01+", bytes(gone))), bytes(b for b, g in zip(d, gone) if not g)))
    return out


@pytest.mark.parametrize("hot", [1000, 2])
def test_repeated_bytes(spark, monkeypatch, hot):
    monkeypatch.setattr(suffixdedup, "HOT", hot)
    rng = random.Random(6)
    passage, base = words(rng, 120), words(rng, 300)
    texts = [f"{words(rng, rng.randrange(80))} {passage[rng.randrange(200) :]} {words(rng, rng.randrange(80))}" for _ in range(15)]
    texts += [base, base[:900] + "é" + base[901:], base, base[:380], base[:399], base[:400], "a" * 1500, "ab" * 700, "日本語" * 250, *EDGES[:7]]
    got = {r.doc_id: (r.n_removed, len(r.spans), bytes(r.kept)) for r in suffixdedup.without_repeats(clash(frame(spark, texts), "spans", "n")).collect()}
    assert [got[i] for i in range(len(texts))] == repeated_bytes(texts, 400)


def test_repeated_bytes_across_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffixdedup, "PIECE", 1000)
    monkeypatch.setattr(suffixdedup, "INDEX_BYTES", 500)
    rng = random.Random(7)
    part = words(rng, 400)
    texts = [words(rng, 500) + part + words(rng, 300), part, words(rng, 50) + part[300:1500]]
    got = {r.doc_id: (r.n_removed, len(r.spans), bytes(r.kept)) for r in suffixdedup.without_repeats(frame(spark, texts)).collect()}
    assert [got[i] for i in range(3)] == repeated_bytes(texts, 400)


def test_repeated_bytes_of_another_length(spark):
    rng = random.Random(12)
    part = words(rng, 51)
    texts = [f"{words(rng, 30)} {part} {words(rng, 30)}" for _ in range(5)] + [words(rng, 90), part[:249], "x" + part[-250:]]
    got = {r.doc_id: (r.n_removed, len(r.spans), bytes(r.kept)) for r in suffixdedup.without_repeats(frame(spark, texts), length=250).collect()}
    assert [got[i] for i in range(len(texts))] == repeated_bytes(texts, 250)
    with pytest.raises(ValueError, match="over"):
        suffixdedup.without_repeats(frame(spark, texts), length=48)


def test_repeated_bytes_around_one_core(spark, monkeypatch):
    """A passage just too short, in many surroundings, and one just long enough: one group of many different blocks."""
    rng = random.Random(13)
    monkeypatch.setattr(suffixdedup, "HOT", 5)
    core = "".join(rng.choice("abcdefgh ") for _ in range(392))
    texts = [f"{words(rng, 9)}{a}{core}{b}{words(rng, 9)}" for a in "uvwx" for b in ("1234", "5678", "1299", "qrst", "12qr")]
    got = {r.doc_id: (r.n_removed, len(r.spans), bytes(r.kept)) for r in suffixdedup.without_repeats(frame(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == repeated_bytes(texts, 400)


def test_repeated_bytes_that_a_polynomial_confuses(spark):
    texts = [f"{thue_morse(1024, a, b)} end" for a, b in ("ab", "ba")] + [thue_morse(1024, "p", "q").replace(" ", ""), thue_morse(1024, "q", "p").replace(" ", "")]
    got = {r.doc_id: (r.n_removed, len(r.spans), bytes(r.kept)) for r in suffixdedup.without_repeats(frame(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == repeated_bytes(texts, 400)


def test_repeated_bytes_of_one_id(spark):
    """Texts of one doc_id, or of none, are told apart."""
    part, rng = words(random.Random(1), 100), random.Random(2)
    texts = [f"{part} {words(rng, 40)}", f"{words(rng, 40)} {part}", words(rng, 150), words(rng, 150)]
    got = suffixdedup.without_repeats(frame(spark, texts, [None, None, 3, 3]), keep=("doc_id", "text")).collect()
    want = dict(zip(texts, repeated_bytes(texts, 400)))
    assert {r.text: (r.n_removed, len(r.spans), bytes(r.kept)) for r in got} == want


def test_repeated_bytes_empty(spark):
    assert suffixdedup.without_repeats(frame(spark, [])).count() == 0
    text = words(random.Random(1), 200)
    got = suffixdedup.without_repeats(frame(spark, [text, text], [5, 5])).collect()
    assert [(r.doc_id, r.n_removed) for r in got] == [(5, len(text))] * 2
    assert suffixdedup.without_repeats(frame(spark, [None], [None])).first().n_bytes == 0


def test_run_length_index():
    rng = random.Random(1)
    for t in range(60):
        letters = b"ab" if t % 2 else b"abcdefgh"
        base = bytes(rng.choice(letters) for _ in range(60))
        segs = [base[a : a + rng.randint(0, 40)] + bytes(rng.choice(letters) for _ in range(rng.randint(0, 20))) for a in (rng.randint(0, 50) for _ in range(rng.randint(1, 8)))]
        n = rng.choice([3, 8, 9, 12, 17])
        seen = Counter(s[i : i + n] for s in segs for i in range(len(s) - n + 1))
        for s, mark in zip(segs, rindex.repeated_starts(segs, n)):
            assert list(map(bool, mark)) == [i + n <= len(s) and seen[s[i : i + n]] > 1 for i in range(len(s))]
        index = rindex.RunLengthIndex(segs)
        for p in {s[k : k + m] for s in segs for k in (0, 5) for m in (1, 3)} | {b"x", b"abc", b"ba"}:
            assert not p or index.count(p) == sum(s[i : i + len(p)] == p for s in segs for i in range(len(s)))
        assert len(index.heads) == len(index.starts) == len(index.start_at) == len(index.end_at) <= len(index.text)


# 7 repeated words


def repeated_words(texts):
    seen, out = set(), []
    for t in texts:
        w = WORD.findall(t or "")
        gone = set()
        for i in range(len(w) - 19):
            k = tuple(w[i : i + 20])
            if k in seen:
                gone.update(range(i, i + 20))
            seen.add(k)
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize("batches", [1, 4])
def test_repeated_words(spark, batches):
    rng = random.Random(8)
    passage, base = words(rng, 60).split(), words(rng, 150)
    texts = [" ".join([words(rng, rng.randrange(30)), *passage[rng.randrange(20) :], words(rng, rng.randrange(30))]) for _ in range(12)]
    texts += [base, base.replace(" ", "\n\t"), base[:700], base[:80], "x y " * 40, *EDGES]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in lsmdedup.without_repeats(clash(frame(spark, texts), "kept", "place"), batches=batches).collect()}
    assert [got[i] for i in range(len(texts))] == repeated_words(texts)


def test_repeated_words_empty_and_pieces(spark, monkeypatch):
    assert lsmdedup.without_repeats(frame(spark, [])).count() == 0
    monkeypatch.setattr(windows, "PIECE_WORDS", 50)
    text = words(random.Random(2), 300)
    got = {r.doc_id: r.n_removed for r in lsmdedup.without_repeats(frame(spark, [text, f"z {text}", text[500:]], [4, 5, 6])).collect()}
    assert got == {4: 0, 5: 300, 6: repeated_words([text, f"z {text}", text[500:]])[2][1]}
    same = lsmdedup.without_repeats(frame(spark, [text, text], [4, 4])).collect()
    assert [r.n_removed for r in same] == [0, 0]


def test_repeated_words_that_a_polynomial_confuses(spark):
    rng = random.Random(3)
    texts = [f"{words(rng, 10)} {thue_morse(1024, a, b)} {words(rng, 10)}" for a, b in ("pq", "qp", "pq")]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in lsmdedup.without_repeats(frame(spark, texts)).collect()}
    assert [got[i] for i in range(3)] == repeated_words(texts)


def test_repeated_words_without_ids(spark):
    """A null doc_id is before all others; texts that share a doc_id are in the order of their checksums."""
    rng = random.Random(4)
    part = words(rng, 40)
    texts = {(None, f"{words(rng, 30)} {part}"), (-5, f"{part} {words(rng, 9)}"), (7, f"{words(rng, 25)} {part}"), (7, f"{part} {words(rng, 25)} a"), (8, f"b {part}")}
    order = sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0, zlib.crc32(x[1].encode()) & 0xFFFFF))
    got = lsmdedup.without_repeats(frame(spark, [t for _, t in texts], [i for i, _ in texts]), keep=("doc_id", "text")).collect()
    want = dict(zip([t for _, t in order], repeated_words([t for _, t in order])))
    assert {r.text: (r.n_words, r.n_removed, r.kept) for r in got} == want


def test_index_compacts(spark, tmp_path):
    rng = random.Random(3)
    text, texts, removed = words(rng, 100), [], []
    index = lsmdedup.FingerprintIndex(spark, f"file://{tmp_path}/index")
    for k in range(5):
        # what comes again comes whole, or as a part with other words around it
        texts.append(" ".join([words(rng, 30), *text.split()[k * 7 : k * 7 + 60]]) if k % 2 else text)
        batch, all_ = frame(spark, [texts[k]], [k]), frame(spark, texts)
        got = index.ingest(batch, all_, k - 1 if k else None)
        at = {r.at & lsmdedup._AT: r.n for r in got.collect()}
        gone = {w for a, n in at.items() for w in range(a, a + n + 19)}
        removed.append(len(gone))
        assert len(index.runs) <= lsmdedup.FANOUT
    assert removed == [r[1] for r in repeated_words(texts)]
    for runs in (index.entries, index.anchors, index.windows):
        for name in runs.names:
            run = spark.table(name)
            assert run.where("old = 0").groupBy(*runs.keys).count().where("count > 1").isEmpty()
    index.close()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("quillrank")]


def test_runs_are_joined_without_a_shuffle(spark, tmp_path):
    index = lsmdedup.FingerprintIndex(spark, f"file://{tmp_path}/index")
    docs = frame(spark, [words(random.Random(5), 200)])
    index.ingest(docs, docs)
    rows = spark.createDataFrame([(1, 2, 3)], "anchor long, content long, check long")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with lsmdedup._in_order(spark):
            kinds = rows.groupBy(*lsmdedup.KIND).agg(F.count("*").alias("times"))
            plan = index.entries.joined(kinds, {"old": F.lit(1)})._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 1
    index.close()


# 8 mixing


def fill(sizes):
    target, weights, left = {s: 0.0 for s in sizes}, dict(zip(sizes, itertools.cycle((5, 2, 1)))), float(sum(sizes.values()))
    open_ = set(sizes)
    while left > 1e-9 and open_:
        total = sum(weights[s] for s in open_)
        give, left = left, 0.0
        for s in list(open_):
            target[s] += give * weights[s] / total
        for s in list(open_):
            if target[s] >= 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                open_.discard(s)
    return target


@pytest.mark.parametrize("rows", [10_000, 20])
def test_mix(spark, monkeypatch, rows):
    monkeypatch.setattr(mixing, "SLICE_ROWS", rows)
    rng = random.Random(9)
    texts = [words(rng, rng.randrange(1, 120)) for _ in range(600)] + [None, ""]
    sources = {i: rng.choice("aaaaabbccd") for i in range(600)} | {0: None, 1: None}
    df = clash(frame(spark, texts, sources=sources), "whole_name")
    got = mixing.mix(df).collect()
    sizes = Counter()
    for i, t in enumerate(texts):
        sizes[sources.get(i, "s")] += len(WORD.findall(t or ""))
    target = fill(dict(sorted(sizes.items(), key=lambda x: (x[0] is None, x[0] or ""))))
    taken = Counter()
    for r in got:
        taken[r.source] += r.mix_size * r.mix_copies
        assert r.mix_copies <= 3 and r.mix_source_size == sizes[r.source] and r.mix_target == pytest.approx(target[r.source])
    assert all(abs(taken[s] - t) <= 120 for s, t in target.items())
    assert sorted((r.doc_id, r.mix_copies) for r in mixing.mix(df.repartition(7)).collect()) == sorted((r.doc_id, r.mix_copies) for r in got)
    assert mixing.expand(mixing.mix(df)).count() == sum(r.mix_copies for r in got)
    assert mixing.mix(frame(spark, [])).count() == 0
    assert [r.mix_copies for r in mixing.mix(frame(spark, ["a b", "a b"], [1, 1])).collect()] == [1, 1]


def test_mix_band_without_words(spark):
    texts = [None, "", " ", "a " * 80, "b " * 100, "c " * 60, ""]
    got = mixing.mix(frame(spark, texts, sources={5: "t", 6: "u"})).collect()
    long = next(r for r in got if r.doc_id == 3)
    assert long.mix_source_size == 180 and long.mix_target > 0
    for r in got:
        if r.source == "s":
            assert (r.mix_source_size, r.mix_target) == (180, long.mix_target)
        assert r.mix_size or r.mix_copies == 0
    assert [(r.mix_source_size, r.mix_target) for r in got if r.source == "u"] == [(0, 0.0)]


# 9 pages


def lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in itertools.product(range(len(a)), range(len(b))):
        best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_common_subsequence():
    rng = random.Random(1)
    for _ in range(500):
        a, b = ([rng.choice("abc") for _ in range(rng.randint(0, 9))] for _ in range(2))
        got = htmltext.common(a, b)
        rest = iter(b)
        assert len(got) == lcs(a, b) and got == sorted(set(got)) and all(a[i] in rest for i in got)


@pytest.mark.parametrize(("page", "want"), [
    (None, ""), ("", ""), ("plain  &amp;\ntext", "plain & text"), ("<p>a<p>b<br>c", "a\nb c"),
    ("<nav>n</nav><article><h1>T</h1><p><b>x &lt;y</p><aside>no</aside><form>f</form></article><footer>f</footer>", "T\nx <y"),
    ("<main><h2>T</h2>body<div class='comments'>c</div></main><div class=ad>buy</div>", "T\nbody"),
    ("<article>one</article><div class='cookieNotice'>ok</div><article class=comment>c</article><article>two</article>", "one\ntwo"),
    ("<script>if (a<b) '<p>'</script><style>p{}</style><!-- x --><ul><li>a<li>b</ul><p hidden>z", "a\nb"),
    ("<article><header><h1>T</h1></header>x</article><header>top</header>", "T\nx"), ("<article>a &copy; &am &#233;", "a © &am é"), ("<ARTICLE>q</ARTICLE", "q"),
])
def test_page_text(spark, page, want):
    df = clash(spark.createDataFrame([(1, "http://h/a", page)], "page_id long, url string, html string"), "text", "lines")
    r = htmltext.main_text(df).first()
    assert (r.text, r.n_chars) == (want, len(want))


@pytest.mark.parametrize(("page", "want"), [
    ("<article>a <svg class='icon'/>b<p>c</article>", "a b\nc"), ("<article>a <math/>b <svg><path d=''/><text>no</text></svg>c</article>", "a b c"),
    ("<article>a <svg />b <svg>no</svg>c</article>", "a b c"), ("<article>a <iframe src=x>b<p>c</article>", "a b\nc"), ("<article>a <svg>b</article>", "a b"),
    ("<article>a<script>no <p>no</article>", "a"), ("<article>a<style/>no</style>b</article>", "ab"),
])
def test_elements_without_end_tag(page, want):
    assert "\n".join(htmltext.chosen(page)[0]) == want


@pytest.mark.parametrize(("page", "want"), [
    ("<div class='no-sidebar'><article>body</article></div>", "body"), ("<div id='content-with-sidebar'><article>b</article></div>", "b"),
    ("<div class='page has-banner'><main>m</main></div>", "m"), ("<div class='overlay'><article>only</article></div>", "only"), ("<div class=modal><section class=widget><main>m</main></section></div>x", "m"),
    ("<article>a<p class='related-work'>b</p><p class='share-price'>c</p></article>", "a\nb\nc"), ("<article>a<div class='cookieNotice'>no</div><div id=share_buttons>no</div></article>", "a"),
    ("<article>real</article><div class=comments><article>c1</article></div>", "real"), ("<div class=sidebar>s</div><article>a<aside>b</aside></article>", "a"),
])
def test_whole_names_only(page, want):
    assert "\n".join(htmltext.chosen(page)[0]) == want


@pytest.mark.parametrize("page", ["<b>" * 200_000 + "</i>" * 200_000 + "x", "<div>" * 100_000 + "<p>" * 200_000 + "x", "<iframe>" * 150_000 + "x", "<li>" * 200_000 + "x", "<a '" * 100_000 + "x"])
def test_deep_pages_take_time_in_proportion(page):
    began = time.process_time()
    htmltext.chosen(page)
    assert time.process_time() - began < 20


class Plain(HTMLParser):
    """The blocks of a page's articles, by the standard library's parser."""

    BLOCKS = frozenset("article aside blockquote div footer form h1 h2 h3 h4 li nav ol p pre section table tr ul".split())

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.depth, self.text, self.out, self.gone = 0, [], [], 0
        self.feed(page)
        self.close()
        self.flush()

    def flush(self):
        block = " ".join("".join(self.text).split())
        self.out += [block] if block else []
        self.text = []

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        self.gone += tag in ("script", "style", "nav", "aside", "form", "footer")
        if tag in self.BLOCKS:
            self.flush()
        elif tag == "br":
            self.text.append(" ")

    def handle_endtag(self, tag):
        if tag in self.BLOCKS:
            self.flush()
        self.depth -= tag == "article"
        self.gone -= tag in ("script", "style", "nav", "aside", "form", "footer")

    def handle_data(self, data):
        if self.depth and not self.gone:
            self.text.append(data)


PAGES = os.path.join(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"), "pages.parquet")


@pytest.mark.skipif(not os.path.exists(PAGES), reason="no test tables")
def test_pages_against_plain_reader(spark):
    pages = spark.read.parquet(PAGES)
    got = {r.page_id: r.text for r in htmltext.main_text(pages).collect()}
    assert got == {r.page_id: "\n".join(Plain(r.html).out) for r in pages.collect()} and all(got.values())


def test_page_differencing(spark):
    page = lambda own: f"<div>Site</div><div>{own}</div><div>Terms</div>"
    rows = [(1, "http://h/a/1", page("first")), (2, "http://h/a/2?x=1", page("second")), (3, "http://other/a/1", page("alone")), (4, None, page("none")), (5, "http://h/b/1", page("third")), (6, "http://same/1", page("x")), (7, "http://same/1", page("x"))]
    got = {r.page_id: r.text for r in htmltext.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "first", 2: "second", 3: "Site\nalone\nTerms", 4: "Site\nnone\nTerms", 5: "third", 6: "Site\nx\nTerms", 7: "Site\nx\nTerms"}
    assert htmltext.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# 10 pieces

needs_model = pytest.mark.skipif(not os.path.exists(tokenizer_path(pieces.MODEL)), reason="no vocabulary")


@needs_model
def test_pieces_round_trip(spark):
    texts = [*EDGES, "▁▁a ▁ b\n\n\t c  ", "<s></s><unk><0x41>", "\x00\x01�", "ééé" * 300, html.unescape("&nbsp;x"), "🙂" * 50]
    df = clash(frame(spark, texts), "ids", "decoded")
    rows = pieces.encoded(df)
    got = {r.doc_id: r for r in pieces.decoded(rows).collect()}
    assert [got[i].decoded for i in range(len(texts))] == texts
    assert sorted((r.doc_id, r.ids) for r in pieces.encoded(df.repartition(3)).collect()) == sorted((r.doc_id, r.ids) for r in rows.collect())
    assert pieces.encoded(frame(spark, [])).count() == 0
    other = {r.doc_id: r.ids for r in pieces.encoded(df, seed=2).collect()}
    assert other[7] != {r.doc_id: r.ids for r in rows.collect()}[7]


@needs_model
def test_pieces_of_rows_without_key_and_of_a_long_word(spark):
    long = "abcdefghij" * 100_000
    df = frame(spark, ["one text", "one text", long], [None, 0, 3])
    rows = pieces.encoded(df)
    got = {r.doc_id: r.decoded for r in pieces.decoded(rows).collect()}
    assert got == {None: "one text", 0: "one text", 3: long}
    ids = {r.doc_id: r.ids for r in rows.collect()}
    assert ids[None] == ids[0]  # a null key counts as 0


@needs_model
def test_pieces_are_drawn_by_weight():
    e = pieces.Encoder(pieces.read_model(tokenizer_path(pieces.MODEL)))
    voc = e.voc
    byte = set(voc.byte_id.tolist())
    ids = {b: i for i, b in enumerate(voc.bytes) if b and i not in byte}

    def ways(b):
        if not b:
            yield ()
        for k in range(1, len(b) + 1):
            if b[:k] in ids:
                yield from ((ids[b[:k]], *rest) for rest in ways(b[k:]))

    weight = {s: math.prod(voc.share[list(s)]) for s in ways(b" hello")}
    n = 20_000
    got, size = e.encode([b"hello"] * n, np.arange(n))
    stop = np.cumsum(size)
    count = Counter(tuple(got[b - k : b]) for b, k in zip(stop, size))
    assert sum(abs(count[s] / n - w / sum(weight.values())) for s, w in weight.items()) / 2 < 0.01
