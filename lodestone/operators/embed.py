"""Batch embedding of chunk texts (text -> unit-length float32 vector).

The default encoder is JVM-side Spark ML (tokenize -> feature hashing ->
L2 normalise), so it stays in the executors' JVMs with no Python round trip.
A model encoder is pluggable: ``model_encoder(factory)`` wraps any
``texts -> 2-D array`` callable in an iterator pandas UDF that loads the model
once per Python worker and encodes Arrow batches.  Model weights are not
shipped with this package; the hashing encoder is not semantically equivalent
to a transformer model, only shape-, norm- and determinism-compatible.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package

DEFAULT_DIM = 384  # fixed value: dimension of the reference's sentence vectors


def hashing_encoder(dim: int = DEFAULT_DIM, count_col: str | None = None) -> Callable[[DataFrame, str, str], DataFrame]:
    """Deterministic bag-of-words encoder: lower-cased ``\\W+`` tokens hashed into
    ``dim`` buckets, L2-normalised (all-zero vector when the text has no token).
    ``count_col`` takes the number of tokens, so a text is split once for both."""
    def encode(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
        tok = RegexTokenizer(inputCol=text_col, outputCol="_tok", pattern="\\W+",
                             toLowercase=True, minTokenLength=1)
        tf = HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=dim)
        norm = Normalizer(inputCol="_tf", outputCol="_vec", p=2.0)
        staged = norm.transform(tf.transform(tok.transform(
            df.withColumn(text_col, F.coalesce(F.col(text_col), F.lit(""))))))
        if count_col:
            staged = staged.withColumn(count_col, F.size("_tok"))
        return (staged.withColumn(out_col, vector_to_array("_vec", "float32"))
                .drop("_tok", "_tf", "_vec"))
    return encode


_MODELS: dict[str, object] = {}


def model_encoder(factory: Callable[[], Callable[[list[str]], np.ndarray]], dim: int,
                  batch_size: int = 256) -> Callable[[DataFrame, str, str], DataFrame]:
    """Encoder backed by a model: ``factory()`` returns ``texts -> (n, dim)`` and is
    called once per Python worker process; vectors are L2-normalised float32."""
    key = uuid.uuid4().hex  # of this encoder, also on workers that served others before

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def _encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = _MODELS.get(key)
        if model is None:
            model = _MODELS[key] = factory()
        for texts in batches:
            out = []
            vals = texts.fillna("").tolist()
            for i in range(0, len(vals), batch_size):
                m = np.asarray(model(vals[i:i + batch_size]), dtype=np.float32).reshape(-1, dim)
                nrm = np.linalg.norm(m, axis=1, keepdims=True)
                out.extend(list(np.where(nrm > 0, m / np.maximum(nrm, 1e-12), m)))
            yield pd.Series(out)

    def encode(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
        ship_package(df.sparkSession)
        return df.withColumn(out_col, _encode(F.col(text_col)))
    return encode


def embed(df: DataFrame, text_col: str = "text", out_col: str = "embedding",
          encoder: Callable[[DataFrame, str, str], DataFrame] | None = None) -> DataFrame:
    """Add ``out_col`` (``array<float>``) computed from ``text_col``."""
    return (encoder or hashing_encoder())(df, text_col, out_col)


def vector_norm(c: Column) -> Column:
    return F.sqrt(F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x))
