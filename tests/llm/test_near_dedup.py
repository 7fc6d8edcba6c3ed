import itertools
import random

import numpy as np

from lodestone.llm.components import connected_components
from lodestone.llm.near_dedup import near_duplicates
from lodestone.llm.sketch import Sketcher


def brute(rows):
    """doc_id -> (set size, smallest reachable id) by comparing all pairs."""
    def words(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        for c in "\t\n\x0b\x0c\r":
            low = low.replace(c, " ")
        return [w for w in low.split(" ") if w]

    sets = {}
    for d, t in rows:
        w = words(t)
        sets[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        i = len(sets[a] & sets[b])
        if i and 100 * i >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: (len(sets[d]), find(d)) for d in sets}


def planted(seed=4):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocab) for _ in range(60)]
    rows, n = [], 0
    for _ in range(25):
        base = [rng.choice(vocab) for _ in range(rng.randint(3, 120))]
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            rows.append((n, " ".join(copy)))
            n += 1
    for _ in range(60):  # one passage, own words around it: alike, but under the threshold or near it
        own = [rng.choice(vocab) for _ in range(rng.randint(2, 40))]
        rows.append((n, " ".join(own + passage)))
        n += 1
    return rows


def test_against_all_pairs(spark):
    rows = planted()
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=20).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_sketch_estimates_similarity_and_fills():
    rng = np.random.default_rng(1)
    with np.errstate(over="ignore"):
        s = Sketcher(64, 5)
        for n in (1, 2, 7, 200, 5000):
            a = rng.integers(0, 1 << 63, n).astype(np.uint64)
            k = s.sketch(a)
            assert (k != np.iinfo(np.uint64).max).all() and (k == s.sketch(a[::-1])).all()
        a = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
        b = np.concatenate([a[:800], rng.integers(0, 1 << 63, 200).astype(np.uint64)])
        assert abs((s.sketch(a) == s.sketch(b)).mean() - 800 / 1200) < 0.12


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3)]
    got = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    comp = {r["node"]: r["component"] for r in got}
    assert len(got) == len(comp) and set(comp.values()) == {1, 100} and comp[40] == 1 and comp[139] == 100


def test_odd_rows(spark, odd_documents, no_documents):
    got = near_duplicates(odd_documents).collect()
    assert len(got) == odd_documents.count()
    comp = {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None}
    assert comp == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 6, 8: 8, 9: 8, 10: 10, 11: 11}
    assert all(r["component_id"] is None and r["kept"] for r in got if r["doc_id"] is None)
    assert near_duplicates(no_documents).count() == 0
