"""Passages that many items and documents share; windows around fingerprints; the bitmap."""
import random
import time

import numpy as np

from lodestone.llm.decontam import BITS, contamination, fingerprint_bitmap, joined_spans
from .test_filters import brute_contamination


def rows_of(df):
    return {(r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in df.collect()}


def test_shared_prompts_against_brute_force(spark):
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(60)}"
    prompts = [" ".join(f"p{j}x{i}" for i in range(n)) for j, n in enumerate((5, 12, 13, 14, 30))]
    items = [(f"i{n}", f"{rng.choice(prompts)} {' '.join(word() for _ in range(rng.randrange(0, 25)))}") for n in range(60)]
    items += [("short", "w1 w2"), ("twin", items[0][1]), ("one", "W3"), ("a,b", items[1][1]), ("none", "..."), (None, items[2][1])]
    docs = []
    for d in range(80):
        parts = [" ".join(word() for _ in range(rng.randrange(0, 40)))]
        parts += [rng.choice(prompts) if rng.random() < 0.6 else rng.choice(items)[1] for _ in range(rng.randrange(0, 3))]
        rng.shuffle(parts)
        docs.append((d, " ".join(parts)))
    docs += [docs[0], (100, None), (101, ""), (102, docs[1][1])]
    got = contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                        spark.createDataFrame(items, "item_id string, text string"))
    want = {(d, n, h, tuple(i), c) for d, n, h, i, c in brute_contamination(docs, items)}
    assert rows_of(got) == want and got.count() == len(docs)


def test_one_prompt_in_all_items_and_documents(spark):
    """500 documents and 2,000 items with the same prompt: no pair of them is compared."""
    prompt = " ".join(f"prompt{i}" for i in range(40))
    items = spark.createDataFrame([(f"{i:04d}", f"{prompt} question{i} " + " ".join(f"q{i}z{j}" for j in range(20)))
                                   for i in range(2_000)], "item_id string, text string")
    docs = spark.createDataFrame([(d, " ".join(f"d{d}y{j}" for j in range(30)) + " " + prompt + f" tail{d}") for d in range(500)],
                                 "doc_id long, text string")
    start = time.time()
    got = contamination(docs, items).collect()
    assert time.time() - start < 60
    assert len(got) == 500 and all(r["n_hit"] == 40 and len(r["items"]) == 2_000 and r["contaminated"] for r in got)
    assert all([(s["start"], s["stop"]) for s in r["spans"]] == [(30, 70)] for r in got)


def test_joined_spans():
    assert joined_spans([]) == []
    assert joined_spans([(20, 13), (0, 13), (1, 13), (14, 2), (40, 1)]) == [(0, 16), (20, 33), (40, 41)]


def test_bitmap_has_the_slots_and_no_others(spark):
    values = [0, 1, 7, 8, BITS - 1, BITS, -1, -BITS, 32_767, 32_768, 123_456_789_012]
    bits = np.unpackbits(np.frombuffer(fingerprint_bitmap(
        spark.createDataFrame([(v,) for v in values], "fp long")), dtype=np.uint8), bitorder="little")
    assert len(bits) == BITS and set(np.flatnonzero(bits).tolist()) == {v % BITS for v in values}
