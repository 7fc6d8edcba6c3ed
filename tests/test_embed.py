"""Embedding job: default hashing encoder and a pluggable model encoder (K1)."""

import numpy as np
from pyspark.sql import functions as F

from lodestone.operators import embed as EMB


def fake_model():
    """Stand-in for a sentence model: character-count features, deterministic."""
    def encode(texts):
        out = np.zeros((len(texts), 16), dtype=np.float32)
        for i, t in enumerate(texts):
            for ch in t:
                out[i, ord(ch) % 16] += 1.0
        return out
    return encode


def test_hashing_encoder_shape_norm_determinism(spark):
    df = spark.createDataFrame([(1, "Great white shark hunts seals"), (2, ""), (3, None),
                                (4, "Great white shark hunts seals")], "id int, text string")
    rows = {r.id: r.embedding for r in EMB.embed(df).collect()}
    assert all(len(v) == 384 for v in rows.values())
    assert abs(np.linalg.norm(rows[1]) - 1.0) < 1e-5
    assert np.linalg.norm(rows[2]) == 0 and np.linalg.norm(rows[3]) == 0
    assert rows[1] == rows[4]


def test_model_encoder(spark):
    df = spark.createDataFrame([(i, "abc" * i) for i in range(1, 40)] + [(0, "")],
                               "id int, text string").repartition(3)
    enc = EMB.model_encoder(fake_model, dim=16, batch_size=7)
    out = EMB.embed(df, encoder=enc).select("id", "embedding",
                                           EMB.vector_norm(F.col("embedding")).alias("n"))
    rows = {r.id: r for r in out.collect()}
    assert len(rows) == 40 and all(len(r.embedding) == 16 for r in rows.values())
    assert all(abs(r.n - 1.0) < 1e-5 for k, r in rows.items() if k)
    assert rows[0].n == 0.0
    assert rows[1].embedding == rows[2].embedding  # same character proportions
