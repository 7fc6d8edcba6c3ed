"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other; each link is a logistic regression over word and
word-beginning features and the probabilities of all earlier categories.  In training those
probabilities are out-of-fold (a row's come from models that have not seen its fold), so later
links learn from what earlier ones really know; the models that score are fitted on all
training rows.

The models are fitted on at most about ``MAX_ROWS`` labelled rows, taken by a hash of the
doc_id, and see ``FEATURES`` features chosen on them; this is the only sample, and everything
that touches all documents (features, scores) runs over whole texts in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, ship_package
from .decontam import item_words
from .text import WordHash, bounded_batches, texts_of

MAX_ROWS, FEATURES, FOLDS, LEAST_DF, PREFIX = 20_000, 256, 3, 4, 5
L2 = 0.1


def features_of(text: bytes | None, cache: WordHash) -> np.ndarray:
    """Distinct hashes of the text's words and of the first bytes of longer words."""
    words = set(item_words(text))
    words |= {b"^" + w[:PREFIX] for w in words if len(w) > PREFIX}
    return cache.of(list(words))


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = L2, steps: int = 25) -> np.ndarray:
    """Weights and intercept (last) by Newton steps; one class alone gives the smoothed prior."""
    n, d = x.shape
    w = np.zeros(d + 1)
    prior = (y.sum() + 0.5) / (n + 1)
    w[-1] = np.log(prior / (1 - prior))
    if not 0 < y.sum() < n:
        return w
    x1 = np.hstack([x, np.ones((n, 1), dtype=x.dtype)])
    ridge = np.full(d + 1, l2)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        grad = x1.T @ (p - y) + ridge * w
        h = (x1 * (p * (1 - p))[:, None]).T @ x1
        h[np.diag_indices(d + 1)] += ridge
        step = np.linalg.solve(h.astype(np.float64), grad)
        w = w - step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-4:
            break
    return w


def _probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


@dataclass
class Chain:
    """Fitted chain: ``features`` (sorted hashes) and one weight vector per category."""

    categories: list[str]
    features: np.ndarray
    weights: list[np.ndarray] = field(default_factory=list)

    def fit(self, x: np.ndarray, labels: dict[str, np.ndarray], fold: np.ndarray) -> Chain:
        earlier = np.empty((len(x), 0))
        for name in self.categories:
            y, out = labels[name].astype(np.float64), np.zeros(len(x))
            full = np.hstack([x, earlier])
            for f in np.unique(fold):
                inside = fold == f
                train = ~inside if not inside.all() else inside
                out[inside] = _probability(full[inside], fit_logistic(full[train], y[train]))
            self.weights.append(fit_logistic(full, y))
            earlier = np.hstack([earlier, out[:, None]])
        return self

    def design(self, rows: list[np.ndarray]) -> np.ndarray:
        """0/1 matrix of the chain's features in each row's hashes."""
        x = np.zeros((len(rows), len(self.features)))
        if len(self.features):
            for i, h in enumerate(rows):
                at = np.minimum(np.searchsorted(self.features, h), len(self.features) - 1)
                x[i, at[self.features[at] == h]] = 1
        return x

    def predict(self, x: np.ndarray) -> np.ndarray:
        """(rows, categories) probabilities, each link fed by those before it."""
        for w in self.weights:
            x = np.hstack([x, _probability(x, w)[:, None]])
        return x[:, len(self.features):]


def _with_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = WordHash()
    for batch in batches:
        rows = [features_of(t, cache).view(np.int64) for t in texts_of(batch)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("fold"), batch.column("y"), pa.array(rows, pa.list_(pa.int64()))],
            ["fold", "y", "feats"])


def fit_chain(docs: DataFrame, labels: DataFrame, categories: dict[str, Column],
              max_rows: int = MAX_ROWS, n_features: int = FEATURES) -> Chain:
    """Fit on the labelled rows.  ``categories``: name -> boolean column over ``docs`` joined
    with ``labels``, in chain order; the features are chosen for the last one."""
    labels = labels.where("doc_id is not null").dropDuplicates(["doc_id"])
    share = min(1.0, max_rows / max(1, labels.count()))
    rank = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 20))
    chosen = labels.where(rank < share * (1 << 20))
    y = F.array(*[F.coalesce(c, F.lit(False)).cast("double") for c in categories.values()])
    rows = (docs.join(F.broadcast(chosen), "doc_id")  # at most about max_rows small rows
            .select(F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int").alias("fold"),
                    y.alias("y"), "text"))
    ship_package(docs.sparkSession)
    train = cut_lineage(rows.mapInArrow(_with_features, "fold int, y array<double>, feats array<long>"))
    last = F.element_at("y", -1)
    total = train.agg(F.count("*").alias("n"), F.sum(last).alias("pos")).first()
    n, pos = total["n"], total["pos"] or 0.0
    chain = Chain(list(categories), np.empty(0, dtype=np.uint64))
    if n:
        a, df = F.col("a"), F.col("df")
        # chi-square of the feature against the last category, signed towards it
        chi = (a * n - df * pos) * F.abs(a * n - df * pos) / (df * (n - df) + 1.0)
        best = (train.select(last.alias("last"), F.explode("feats").alias("feat"))
                .groupBy("feat").agg(F.sum("last").alias("a"), F.count("*").alias("df"))
                .where(df >= LEAST_DF).orderBy(chi.desc(), "feat").limit(n_features).select("feat"))
        feats = np.array([r["feat"] for r in best.collect()], dtype=np.int64).view(np.uint64)
        chain.features = np.sort(feats)
        keep = F.array(*[F.lit(int(f)) for f in chain.features.view(np.int64)]) if len(feats) else F.array().cast("array<long>")
        got = train.select("fold", "y", F.array_intersect("feats", keep).alias("feats")).toPandas()
        x = chain.design([np.asarray(v, dtype=np.int64).view(np.uint64) for v in got["feats"]])
        ys = np.stack(got["y"].to_numpy())
        chain.fit(x, {c: ys[:, i] for i, c in enumerate(categories)}, got["fold"].to_numpy())
    else:  # nothing labelled: every document scores one half
        chain.weights = [np.zeros(i + 1) for i in range(len(categories))]
    return chain


def score_chain(docs: DataFrame, chain: Chain) -> DataFrame:
    """(doc_id, one probability per category) over whole texts."""
    names = chain.categories

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHash()
        for batch in batches:
            p = chain.predict(chain.design([features_of(t, cache) for t in texts_of(batch)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(p[:, i]) for i in range(len(names)))],
                ["doc_id", *names])

    ship_package(docs.sparkSession)
    return (bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, ", ".join(["doc_id long", *(f"`{c}` double" for c in names)])))


LANGUAGES = ("en", "de", "fr", "es")


def language_chain(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Chain:
    """The chain of abuse by language and, last, any abuse."""
    named = docs.select("doc_id", "text", "lang")
    marked = labels.select("doc_id", "toxic").where("toxic is not null")
    categories = {f"toxic_{c}": (F.col("toxic") == 1) & (F.col("lang") == c) for c in LANGUAGES}
    categories["toxicity"] = F.col("toxic") == 1
    return fit_chain(bounded_batches(named), marked, categories, max_rows)


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5,
                  max_rows: int = MAX_ROWS) -> DataFrame:
    """The rows of ``docs`` that ``toxicity`` does not call toxic, all their columns, in one pass:
    each row is judged by its own text, whatever its doc_id."""
    chain = language_chain(docs, labels, max_rows)
    known = bool(len(chain.features))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHash()
        for batch in batches:
            p = chain.predict(chain.design([features_of(t, cache) for t in texts_of(batch)]))[:, -1]
            yield batch.filter(pa.array(p < threshold)) if known else batch

    return bounded_batches(docs).mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5,
             max_rows: int = MAX_ROWS, row: str = "doc_id") -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang; other columns are ignored): doc_id (the
    column ``row``, where rows have a key besides the doc_id that the labels know), the
    chain's probabilities toxic_en, toxic_de, toxic_fr, toxic_es and toxicity, and ``toxic``
    (toxicity at or over the threshold).

    The labels know one mark, so the categories are abuse by language and, last, any abuse; a
    text's language is used for training labels alone, never for a score.  Null and empty
    texts have no features and get the prior; rows without a doc_id are scored but not trained
    on; repeated rows are scored each; several labels of one doc_id count as one of them.
    Without labels every score is one half less than nothing known: 0.5, and nothing is toxic.
    An empty table gives no rows."""
    chain = language_chain(docs, labels, max_rows)
    known = bool(len(chain.features))
    return score_chain(docs.select(F.col(row).alias("doc_id"), "text"), chain).withColumn(
        "toxic", (F.col("toxicity") >= threshold) if known else F.lit(False))
