"""Language model: gradient, probabilities, whole-document scores, counts against brute force."""
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from lodestone.llm import gated_lm as G
from lodestone.llm.queries import op11_gated_language_model

COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def brute_base(rows):
    """(doc_id, text) -> per row (held_out, n_tokens, n_known, N, base_score)."""
    def tokens(text):
        return [w for w in (text or "").encode().lower().split()] + [b""]

    def held(d):
        return d is not None and zlib.crc32(str(d).encode()) % 10 == 0

    counts = Counter()
    for d, text in rows:
        if d is not None and not held(d):
            counts.update(tokens(text))
    n, v = sum(counts.values()), len(counts)
    return [(d, held(d), len(t := tokens(text)), sum(w in counts for w in t), n,
             sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)) for d, text in rows]


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)


def test_words_are_those_of_the_pattern():
    import re

    import pyarrow as pa
    texts = ["", None, " ", "A b\tC\nd\x0be\x0cf\rg", "  É İ ẞ a\u00a0b \u2003x\x1cy ", "\x85q", "one", "ONE  one\n", "é" * 3000]
    text, place, distinct = G.words_of(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"]).slice(1))
    got = [[] for _ in texts[1:]]
    for t, p in zip(text, place):
        got[t].append(distinct[int(p)].as_py().decode())
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    assert got == [re.findall("[^\x20\x09-\x0D]+", lower(t or "")) for t in texts[1:]]


def test_gradient_by_differences():
    rng = np.random.default_rng(0)
    m = G.GatedModel.from_counts(rng.integers(1, 50, 700).astype(float))
    m.classes[:-1], m.members[:, :-1] = rng.normal(0, 0.3, m.classes[:-1].shape), rng.normal(0, 0.3, m.members[:, :-1].shape)
    previous, target = (rng.integers(0, 700, (6, 5)) for _ in range(2))
    previous[rng.random(previous.shape) < 0.2] = G.END
    weight, h = (rng.random((6, 5)) < 0.8).astype(np.float32), rng.normal(0, 0.5, (5, G.HIDDEN)).astype(np.float32)
    g, _ = m.gradient(previous, target, weight, h)
    for name in ("embed", "input", "state", "classes", "members"):  # every part by itself
        part = G.GatedModel(np.zeros_like(m.flat))
        getattr(part, name)[:] = getattr(G.GatedModel(g), name)
        slope = float(g @ part.flat)
        scale = np.float32(0.05 / max(1e-6, math.sqrt(slope)))
        up, down = (G.loss_of(G.GatedModel(m.flat + s * part.flat), previous, target, weight, h.copy()) for s in (scale, -scale))
        assert (up - down) / (2 * float(scale)) == pytest.approx(slope, rel=0.05), name


def test_probabilities_sum_to_one_and_start_as_counts():
    counts = np.random.default_rng(1).integers(0, 90, 1000).astype(float)
    m = G.GatedModel.from_counts(counts)
    every = np.arange(len(counts))
    p = np.exp(m.log_probabilities(np.zeros((len(counts), G.HIDDEN), dtype=np.float32), every))
    assert p.sum() == pytest.approx(1, abs=1e-4)
    assert np.allclose(p, (counts + G.ADD) / (counts + G.ADD).sum(), rtol=1e-3)


def test_scores_carry_the_state_through_whole_documents():
    """Lanes, windows and batches do not matter: the same as one document after another."""
    rng = np.random.default_rng(2)
    m = G.GatedModel.from_counts(rng.integers(1, 50, 500).astype(float))
    m.flat += rng.normal(0, 0.05, m.flat.shape).astype(np.float32)
    docs = [np.append(rng.integers(1, 500, n), G.END).astype(np.uint16) for n in (0, 1, 5, 63, 64, 65, 700, 0, 130)]
    want = []
    for d in docs:
        h, total = np.zeros(G.HIDDEN, dtype=np.float32), 0.0
        for before, token in zip([G.END, *d[:-1]], d):
            x = m.embed[before] @ m.input[:-1] + m.input[-1]
            u = h @ m.state
            z, r = (1 / (1 + np.exp(-(x[i * 16:i * 16 + 16] + u[i * 16:i * 16 + 16]))) for i in (0, 1))
            n = np.tanh(x[32:] + r * u[32:])
            h = n + z * (h - n)
            one = np.append(h, 1)
            c, w = one @ m.classes, one @ m.members[token >> 6]
            total += c[token >> 6] - np.logaddexp.reduce(c) + w[token & 63] - np.logaddexp.reduce(w)
        want.append(total / math.log(10))
    for lanes, steps in ((1, 64), (3, 7), (256, 64)):
        assert np.allclose(G.document_scores(m, docs, lanes, steps), want, rtol=1e-4)
    assert len(G.document_scores(m, [])) == 0


def test_training_learns_an_order():
    """Words that follow each other in a cycle: far better than their equal counts."""
    cycle = np.arange(2, 22)
    docs = [np.append(np.roll(np.tile(cycle, 10), -i), G.END).astype(np.uint16) for i in range(60)]
    counts = np.bincount(np.concatenate(docs), minlength=22).astype(float)
    m = G.GatedModel.from_counts(counts)
    before = G.document_scores(m, docs).sum()
    for _ in range(6):
        G.train_on(m, [docs], 0.03)
    assert G.document_scores(m, docs).sum() > 0.5 * before


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, sf):
    got = [tuple(r[c] for c in COLUMNS) for r in op11_gated_language_model(spark, f"/root/testdata/{sf}").collect()]
    rows = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").collect()
    same(got, brute_base(rows))
    held = [r for r in got if r[1]]
    assert all(r[6] < 0 for r in got) and held
    if sf == "sf0.01":  # texts not learned from: better than the counts alone
        assert sum(r[6] for r in held) > sum(r[5] for r in held)


@pytest.mark.parametrize("head", [0, 5])
def test_small_head_leaves_results_alone(spark, monkeypatch, head):
    """All or nearly all words through the join."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    monkeypatch.setattr(G, "HEAD", head)
    got = [tuple(r[c] for c in COLUMNS) for r in G.language_scores(docs, rounds=1).collect()]
    same(got, brute_base(rows))


def test_odd_rows(spark, odd_documents, no_documents):
    extra = odd_documents.selectExpr("*", "1 as part", "2 as row", "'x' as word", "3 as ids", "4 as held_out", "5 as rare")
    got = [tuple(r[c] for c in COLUMNS) for r in G.language_scores(extra).collect()]
    same(got, brute_base([(r["doc_id"], r["text"]) for r in odd_documents.collect()]))
    assert all(math.isfinite(r[6]) and r[6] <= 0 for r in got)
    alone = odd_documents.where("doc_id is null")
    got = [tuple(r[c] for c in COLUMNS) for r in G.language_scores(alone).collect()]
    same(got, brute_base([(None, r["text"]) for r in alone.collect()]))
    assert G.language_scores(no_documents).count() == 0
