"""Gated recurrent language model with a class-factored output, trained and applied on Spark.

Words are counted over the whole corpus.  The ``CLASSES * MEMBERS`` most frequent tokens are the
model's vocabulary, in classes by frequency: the output is a softmax over classes and one over the
members of a class.  Any other word is the token *unknown* times its share among such words, so a
text's score is a probability over all texts.

Training: the documents are dealt by a hash into ``ROUNDS`` parts, so each is learned from once.
In a round every task starts from the same weights, goes over its documents by truncated
back-propagation (windows of ``WINDOW`` tokens, the state carried from window to window) and gives
its weights; their mean by tokens starts the next round.  Scoring carries the state through the
whole document.

Counts of the ``HEAD`` or fewer most frequent words go to every task, as 64-bit hashes; all other
words are joined with the counts on Spark.
"""

from __future__ import annotations

import ctypes
import heapq
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir, cut_lineage, ship_package

CLASSES = MEMBERS = 64
SIZE = HIDDEN = 16
WINDOW, LANES, ROUNDS, RATE = 16, 512, 4, 0.04
#: Windows that a lane of training has at least.
LEAST_WINDOWS = 8
HEAD = 1 << 18
END, UNKNOWN = 0, 1
ADD = 0.1
BITS = MEMBERS.bit_length() - 1  # a token's class is id >> BITS
_NEVER = -1e4
_LN10 = math.log(10)
_END_HASH = xxhash.xxh64_intdigest(b"", seed=42)  # Spark's xxhash64 of the empty word


def _steady_heap() -> None:
    """Let the C library keep freed memory of up to 64 MB for the next step's arrays (on others
    than glibc nothing happens): handing it back and fetching it anew doubles a step's time."""
    mallopt = getattr(ctypes.CDLL(None), "mallopt", None)
    if mallopt is not None:
        for option in (-1, -3):  # fixed values: trim and mmap thresholds
            mallopt(option, 64 << 20)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


_ONES = np.ones((CLASSES + MEMBERS, 1), dtype=np.float32)
#: Weights whose logits can spread wider than this are not bounded by their sums.
_SPREAD = 40.0


def _bounded(weights: np.ndarray) -> tuple[np.ndarray, bool]:
    """Output weights (.., HIDDEN + 1, n), the last row the bias, with biases lowered so that no
    logit is over 0: states are within [-1, 1].  False if logits could then be too small."""
    reach = np.abs(weights[..., :-1, :]).sum(axis=-2)
    lowered = weights.copy()
    lowered[..., -1, :] -= (weights[..., -1, :] + reach).max(axis=-1, keepdims=True)
    return lowered, bool(reach.max() < _SPREAD / 2)


def _softmax(x: np.ndarray, bounded: bool) -> tuple[np.ndarray, np.ndarray]:
    """(``x`` made exponentials, their sums) of logits."""
    if not bounded:
        x -= x.max(axis=-1, keepdims=True)
    np.exp(x, out=x)
    return x, x @ _ONES[:x.shape[1]]


class GatedModel:
    """The network; all its weights are views into one vector ``flat``."""

    SHAPES = {"embed": (CLASSES * MEMBERS, SIZE), "input": (SIZE + 1, 3 * HIDDEN), "state": (HIDDEN, 3 * HIDDEN),
              "classes": (HIDDEN + 1, CLASSES), "members": (CLASSES, HIDDEN + 1, MEMBERS)}
    LENGTH = sum(int(np.prod(s)) for s in SHAPES.values())

    def __init__(self, flat: np.ndarray):
        self.flat, at = flat, 0
        for name, shape in self.SHAPES.items():
            setattr(self, name, flat[at:at + int(np.prod(shape))].reshape(shape))
            at += int(np.prod(shape))

    @classmethod
    def from_counts(cls, counts: np.ndarray) -> GatedModel:
        """Untrained: the probabilities of the ``counts`` of the vocabulary, whatever went before."""
        rng = np.random.default_rng(11)
        m = cls(np.zeros(cls.LENGTH, dtype=np.float32))
        m.embed[:] = rng.normal(0, 0.3, m.embed.shape)
        m.input[:-1] = rng.normal(0, SIZE ** -0.5, m.input[:-1].shape)
        m.state[:] = rng.normal(0, HIDDEN ** -0.5, m.state.shape)
        mass = np.zeros(CLASSES * MEMBERS)
        mass[:len(counts)] = counts + ADD
        mass = mass.reshape(CLASSES, MEMBERS)
        with np.errstate(divide="ignore"):
            m.members[:, -1] = np.maximum(np.log(mass), _NEVER)
            m.classes[-1] = np.maximum(np.log(mass.sum(axis=1)), _NEVER)
        return m

    def run(self, x: np.ndarray, h: np.ndarray, fresh: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """States after each step: ``x`` (steps, lanes, 3 * HIDDEN) inputs to the gates, ``h`` the
        states before, ``fresh`` where a document begins.  ``keep`` takes what training needs."""
        steps, lanes, _ = x.shape
        out = np.empty((steps, lanes, HIDDEN), dtype=np.float32)
        two = 2 * HIDDEN
        if keep is not None:
            keep.update({k: np.empty((steps, lanes, w), dtype=np.float32) for k, w in
                         (("h", HIDDEN), ("gates", two), ("n", HIDDEN), ("u", HIDDEN))})
        for t in range(steps):
            h = h * ~fresh[t][:, None]
            u = h @ self.state
            gates, u = u[:, :two], u[:, two:]
            gates += x[t, :, :two]
            _sigmoid(gates)
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            n = r * u
            n += x[t, :, two:]
            np.tanh(n, out=n)
            if keep is not None:
                for k, v in (("h", h), ("gates", gates), ("n", n), ("u", u)):
                    keep[k][t] = v
            h -= n
            h *= z
            h += n
            out[t] = h
        return out

    def _output(self, states: np.ndarray, target: np.ndarray, output=None):
        """(order of the tokens by class, bounds of the classes) and, in that order, the tokens'
        members, states with a constant, and exponentials with their sums of classes and of
        members."""
        of = (target >> BITS).astype(np.uint8)
        order = np.argsort(of, kind="stable")
        s = np.empty((len(target), HIDDEN + 1), dtype=np.float32)
        s[:, :-1], s[:, -1] = states[order], 1
        bounds = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=CLASSES))])
        members = np.empty((len(target), MEMBERS), dtype=np.float32)
        if output is None:
            output = self.output()
        (to_classes, c_bounded), (to_members, m_bounded) = output
        for c in np.flatnonzero(np.diff(bounds)):
            np.dot(s[bounds[c]:bounds[c + 1]], to_members[c], out=members[bounds[c]:bounds[c + 1]])
        return (order, bounds, target[order] & (MEMBERS - 1), s, _softmax(s @ to_classes, c_bounded),
                _softmax(members, m_bounded))

    def output(self):
        """The output weights as ``_output`` uses them."""
        return _bounded(self.classes), _bounded(self.members)

    def log_probabilities(self, states: np.ndarray, target: np.ndarray, output=None) -> np.ndarray:
        """Natural log-probability of every token, given the state before it."""
        order, bounds, member, _, (classes, c_sum), (members, m_sum) = self._output(states, target, output)
        at = np.arange(len(target))
        of = np.repeat(np.arange(CLASSES), np.diff(bounds))
        least = np.float32(1e-37)
        out = np.empty(len(target))
        out[order] = (np.log(np.maximum(classes[at, of], least)) - np.log(c_sum[:, 0])
                      + np.log(np.maximum(members[at, member], least)) - np.log(m_sum[:, 0]))
        return out

    def gradient(self, previous: np.ndarray, target: np.ndarray, weight: np.ndarray, h: np.ndarray):
        """One window (steps, lanes): (gradient of the mean loss of its tokens, states after it)."""
        steps, lanes = target.shape
        g = GatedModel(np.zeros(self.LENGTH, dtype=np.float32))
        e = np.ones((steps * lanes, SIZE + 1), dtype=np.float32)
        before = previous.ravel()
        e[:, :-1] = self.embed[before]
        fresh, keep = previous == END, {}
        out = self.run((e @ self.input).reshape(steps, lanes, -1), h, fresh, keep)
        order, bounds, member, s, (dc, c_sum), (dm, m_sum) = self._output(out.reshape(-1, HIDDEN), target.ravel())
        w = weight.ravel()[order][:, None] / max(1.0, float(weight.sum()))
        dc *= w / c_sum
        dm *= w / m_sum
        at = np.arange(len(order))
        dm[at, member] -= w[:, 0]
        present = np.flatnonzero(np.diff(bounds))
        for c in present:
            dc[bounds[c]:bounds[c + 1], c] -= w[bounds[c]:bounds[c + 1], 0]
        np.dot(s.T, dc, out=g.classes)
        ds = dc @ self.classes[:-1].T
        for c in present:
            own = slice(bounds[c], bounds[c + 1])
            np.dot(s[own].T, dm[own], out=g.members[c])
            ds[own] += dm[own] @ self.members[c, :-1].T
        dout = np.empty((steps * lanes, HIDDEN), dtype=np.float32)
        dout[order] = ds
        dout = dout.reshape(steps, lanes, HIDDEN)
        # all steps at once: the factors that the way back multiplies
        two = 2 * HIDDEN
        z, r, n = keep["gates"][:, :, :HIDDEN], keep["gates"][:, :, HIDDEN:], keep["n"]
        to_n = (1 - z) * (1 - n * n)
        to_gates = np.concatenate([(keep["h"] - n) * z * (1 - z), to_n * keep["u"] * r * (1 - r)], axis=2)
        du = np.empty((steps, lanes, 3 * HIDDEN), dtype=np.float32)
        dn = np.empty((steps, lanes, HIDDEN), dtype=np.float32)
        carry, back = np.zeros((lanes, HIDDEN), dtype=np.float32), np.ascontiguousarray(self.state.T)
        for k in range(steps - 1, -1, -1):
            carry += dout[k]
            np.multiply(carry, to_n[k], out=dn[k])
            np.multiply(np.tile(carry, 2), to_gates[k], out=du[k, :, :two])
            np.multiply(dn[k], r[k], out=du[k, :, two:])
            carry *= z[k]
            carry += du[k] @ back
            carry *= ~fresh[k][:, None]
        flat = du.reshape(-1, 3 * HIDDEN)
        np.dot(keep["h"].reshape(-1, HIDDEN).T, flat, out=g.state)
        du[:, :, two:] = dn  # the inputs reach the candidate past the reset gate
        np.dot(e.T, flat, out=g.input)
        de = flat @ self.input[:-1].T
        by = np.argsort(before.astype(np.uint16), kind="stable")
        ids = before[by]
        first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        g.embed[ids[first]] = np.add.reduceat(de[by], first)
        return g.flat, out[-1]


def loss_of(model: GatedModel, previous: np.ndarray, target: np.ndarray, weight: np.ndarray, h: np.ndarray) -> float:
    """The mean loss that ``GatedModel.gradient`` descends."""
    x = model.embed[previous] @ model.input[:-1] + model.input[-1]
    states = model.run(x, h, previous == END)
    lp = model.log_probabilities(states.reshape(-1, HIDDEN), target.ravel())
    return -float((lp * weight.ravel()).sum()) / max(1.0, float(weight.sum()))


class Lanes:
    """Whole documents (uint16 ids, each closed by END) dealt to lanes, the fullest lane first."""

    def __init__(self, documents: list[np.ndarray], lanes: int):
        lanes = max(1, min(lanes, len(documents)))
        heap = [(0, i) for i in range(lanes)]
        dealt: list[list[int]] = [[] for _ in range(lanes)]
        for d in sorted(range(len(documents)), key=lambda d: -len(documents[d])):
            size, lane = heapq.heappop(heap)
            dealt[lane].append(d)
            heapq.heappush(heap, (size + len(documents[d]), lane))
        sizes = {lane: size for size, lane in heap}
        order = sorted(range(lanes), key=lambda i: -sizes[i])
        self.documents = [dealt[i] for i in order]
        self.size = np.array([sizes[i] for i in order])
        self.ids = np.zeros((int(self.size[0]), lanes), dtype=np.uint16)
        for j, own in enumerate(self.documents):
            self.ids[:self.size[j], j] = np.concatenate([documents[d] for d in own])

    def windows(self, steps: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first step, tokens before, tokens) of the lanes that still have any."""
        for t in range(0, len(self.ids), steps):
            active = int((self.size > t).sum())
            target = self.ids[t:t + steps, :active].astype(np.int64)
            previous = np.empty_like(target)
            previous[1:] = target[:-1]
            previous[0] = self.ids[t - 1, :active] if t else END
            yield t, previous, target


def _documents(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(b, dtype=np.uint16) for b in batch.column("ids").to_pylist()]


def train_on(model: GatedModel, batches: Iterator[list[np.ndarray]], rate: float) -> int:
    """Adam steps over all documents; returns the number of tokens.  A batch is one stream of
    tokens, cut into lanes of equal length."""
    first, second, step, tokens = np.zeros_like(model.flat), np.zeros_like(model.flat), 0, 0
    for documents in batches:
        if not documents:
            continue
        stream = np.concatenate(documents)
        lanes = max(1, min(LANES, len(stream) // (WINDOW * LEAST_WINDOWS)))
        size = -(-len(stream) // lanes)
        ids = np.full(lanes * size, END, dtype=np.int64)
        ids[:len(stream)] = stream
        ids = np.ascontiguousarray(ids.reshape(lanes, size).T)
        weight = (np.arange(lanes * size).reshape(lanes, size).T < len(stream)).astype(np.float32)
        before = np.concatenate([np.concatenate([[END], ids[-1, :-1]])[None], ids[:-1]])
        h = np.zeros((lanes, HIDDEN), dtype=np.float32)
        for t in range(0, size, WINDOW):
            g, h = model.gradient(before[t:t + WINDOW], ids[t:t + WINDOW], weight[t:t + WINDOW], h)
            norm = float(np.sqrt(g @ g))
            if norm > 1:
                g /= norm
            step += 1
            g2 = g * g
            g2 -= second
            g2 *= 0.01
            second += g2
            g -= first
            g *= 0.1
            first += g
            np.sqrt(second, out=g)
            g += 1e-7
            np.divide(first, g, out=g)
            g *= rate * math.sqrt(1 - 0.99 ** step) / (1 - 0.9 ** step)
            model.flat -= g
        tokens += len(stream)
    return tokens


def document_scores(model: GatedModel, documents: list[np.ndarray], lanes: int = 512, steps: int = WINDOW) -> np.ndarray:
    """log10 probability of every document; the state is carried through all of it."""
    out = np.zeros(len(documents))
    if not documents:
        return out
    dealt = Lanes(documents, lanes)
    to_gates = model.embed @ model.input[:-1] + model.input[-1]
    h = np.zeros((len(dealt.size), HIDDEN), dtype=np.float32)
    known, output = np.empty(dealt.ids.shape, dtype=np.float32), model.output()
    for t, previous, target in dealt.windows(steps):
        states = model.run(to_gates[previous], h[:target.shape[1]], previous == END)
        known[t:t + len(target), :target.shape[1]] = model.log_probabilities(
            states.reshape(-1, HIDDEN), target.ravel(), output).reshape(target.shape)
        h = states[-1]
    for j, own in enumerate(dealt.documents):
        begins = np.cumsum([0] + [len(documents[d]) for d in own])[:-1]
        out[own] = np.add.reduceat(known[:dealt.size[j], j].astype(np.float64), begins)
    return out / _LN10


# --- on Spark ---------------------------------------------------------------------------


def words_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(text of each word, its place among the distinct words, the distinct words) of a batch of
    texts: words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, in order; null texts have none."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(batch.column("text"), "")))
    flat = lists.flatten()
    text = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    real = pc.not_equal(flat, "")  # white space at either end makes empty words
    words = flat.filter(real).dictionary_encode()
    return text[real.to_numpy(zero_copy_only=False)], words.indices.to_numpy(), words.dictionary.cast(pa.binary())


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts -> (word, count); the end of a text is the empty word."""
    for batch in batches:
        _, place, distinct = words_of(batch)
        counts = np.append(np.bincount(place, minlength=len(distinct)), batch.num_rows)
        yield pa.RecordBatch.from_arrays(
            [pa.concat_arrays([distinct, pa.array([b""], pa.binary())]), pa.array(counts, pa.int64())], ["word", "n"])


class Vocabulary:
    """Hashes and counts of the head words, their ids in the model, and the corpus totals."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, n: int, v: int):
        self.n, self.v = n, v
        order = np.lexsort((hashes, -counts))
        hashes, counts = hashes[order], counts[order]
        ends = hashes == np.uint64(_END_HASH)
        self.hashes, self.counts = hashes, counts
        self.ids = np.full(len(hashes), UNKNOWN, dtype=np.uint16)
        words = np.flatnonzero(~ends)[:CLASSES * MEMBERS - 2]
        self.ids[words] = np.arange(2, len(words) + 2)
        self.ids[ends] = END
        inside = self.ids != UNKNOWN
        own = np.concatenate([[counts[ends].sum()], [0], counts[words]]).astype(np.float64)
        own[UNKNOWN] = n - counts[inside].sum()
        self.model_counts = own
        self.unknown_n, self.unknown_v = n - int(counts[inside].sum()), v - int(inside.sum())

    @property
    def base_total(self) -> float:
        return self.n + ADD * (self.v + 1)

    @property
    def unknown_total(self) -> float:
        return self.unknown_n + ADD * (self.unknown_v + 1)


ENCODED = ("doc_id long, held_out boolean, part int, n_tokens long, head_known long, head_base double, "
           "head_unknown double, ids binary, rare array<struct<word: binary, tf: long>>")


def _encoder(shared):
    """Texts -> ids in the model's vocabulary, sums over the head words, and the other words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = shared.value
        place_of = dict(zip(v.hashes.tolist(), range(len(v.hashes))))
        base = np.log10((v.counts + ADD) / v.base_total)
        share = np.where(v.ids == UNKNOWN, np.log10((v.counts + ADD) / v.unknown_total), 0.0)
        end = place_of.get(_END_HASH, -1)
        for batch in batches:
            rows = batch.num_rows
            text, place, distinct = words_of(batch)
            head = np.fromiter((place_of.get(xxhash.xxh64_intdigest(w, seed=42), -1) for w in distinct.to_pylist()),
                               dtype=np.int64, count=len(distinct))
            at = head[place]
            known = at >= 0
            of, inside = text[known], at[known]
            n_words = np.bincount(text, minlength=rows)
            sums = [np.bincount(of, weights=w, minlength=rows) for w in (None, base[inside], share[inside])]
            if end >= 0:
                sums[0], sums[1] = sums[0] + 1, sums[1] + base[end]
            # the ids of all texts one after the other, each closed by the end
            ids = np.full(len(text) + rows, END, dtype=np.uint16)
            of_word = np.full(len(text), UNKNOWN, dtype=np.uint16)
            of_word[known] = v.ids[inside]
            ids[np.arange(len(text)) + text] = of_word
            starts = np.concatenate([[0], np.cumsum(n_words + 1)])
            # other words: one entry a text and word, with its number
            pairs, tf = np.unique(text[~known] * max(1, len(distinct)) + place[~known], return_counts=True)
            of_pair, word = np.divmod(pairs, max(1, len(distinct)))
            entries = np.bincount(of_pair, minlength=rows)
            words, number = distinct.take(pa.array(word)), tf
            if end < 0:  # the end is a word like others, the last of its text
                after = np.cumsum(entries)
                words = pa.concat_arrays([words, pa.array([b""], pa.binary())]).take(
                    pa.array(np.insert(np.arange(len(word)), after, len(word))))
                number, entries = np.insert(tf, after, 1), entries + 1
            rare = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(entries)]), pa.int32()),
                pa.StructArray.from_arrays([words, pa.array(number, pa.int64())], ["word", "tf"]))
            packed = pa.Array.from_buffers(pa.binary(), rows, [
                None, pa.py_buffer((2 * starts).astype(np.int32)), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), batch.column("part"), pa.array(n_words + 1, pa.int64()),
                 pa.array(sums[0], pa.int64()), pa.array(sums[1], pa.float64()), pa.array(sums[2], pa.float64()), packed, rare],
                ["doc_id", "held_out", "part", "n_tokens", "head_known", "head_base", "head_unknown", "ids", "rare"])

    return run


SLICES = 64


def _mean_weights(documents: DataFrame, model: GatedModel, rate: float) -> GatedModel:
    """Every task trains its own copy; their mean, weighted by tokens, is summed by slices in
    streams, so no task holds more than a few vectors."""
    start = documents.sparkSession.sparkContext.broadcast(model.flat)
    bounds = np.linspace(0, GatedModel.LENGTH, SLICES + 1).astype(int)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _steady_heap()
        own = GatedModel(start.value.copy())
        tokens = train_on(own, map(_documents, batches), rate)
        if tokens:
            parts = [own.flat[bounds[i]:bounds[i + 1]].astype(np.float64) * tokens for i in range(SLICES)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(SLICES), pa.int32()), pa.array([float(tokens)] * SLICES),
                 pa.array(parts, pa.list_(pa.float64()))], ["i", "tokens", "w"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for i, n, w in zip(batch.column("i").to_pylist(), batch.column("tokens").to_pylist(), batch.column("w")):
                w = w.values.to_numpy()
                if i in sums:
                    sums[i][0] += n
                    sums[i][1] += w
                else:
                    sums[i] = [n, w.copy()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([s[0] for s in sums.values()], pa.float64()),
             pa.array([s[1] for s in sums.values()], pa.list_(pa.float64()))], ["i", "tokens", "w"])

    schema = "i int, tokens double, w array<double>"
    rows = documents.select("ids").mapInArrow(train, schema).repartition("i").mapInArrow(add, schema).collect()
    start.unpersist()
    out = GatedModel(model.flat.copy())
    for r in rows:
        out.flat[bounds[r["i"]]:bounds[r["i"] + 1]] = np.asarray(r["w"]) / r["tokens"]
    return out


def language_scores(docs: DataFrame, held_out: Column | None = None, rounds: int = ROUNDS) -> DataFrame:
    """Score every row of ``docs`` (doc_id, text; other columns are ignored) by a model of those
    that are not ``held_out`` (by default crc32 of the doc_id as text a multiple of 10).

    One row per row: doc_id, held_out, n_tokens (words and the end), n_known (tokens that the
    training texts have), train_tokens, base_score (add-0.1 unigram log10 probability) and score
    (the model's).  Null and empty texts have the end alone; rows without a doc_id are scored,
    not held out and not learned from; repeated rows count and are scored each.  Without
    training rows every word is unknown.  An empty table gives no rows."""
    spark = docs.sparkSession
    ship_package(spark)
    if held_out is None:
        held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    learned = F.col("doc_id").isNotNull() & ~F.col("held_out")
    counts = cut_lineage(given.where(learned).select("text").mapInArrow(_counted, "word binary, n long")
                         .groupBy("word").agg(F.sum("n").alias("n")))
    # the head: whole bins of counts, as many as fit
    level = F.floor(F.log2("n") * 8).cast("int")
    bins = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n")).collect()
    total, least = 0, 1 << 30
    for b in sorted(bins, key=lambda b: -b["level"]):
        total += b["words"]
        if total > HEAD:
            break
        least = b["level"]
    head = counts.where((level >= least) | (F.col("word") == b"")).select(F.xxhash64("word").alias("h"), "n").toArrow()
    vocabulary = Vocabulary(head.column("h").to_numpy().view(np.uint64), head.column("n").to_numpy(),
                            sum(b["n"] for b in bins), sum(b["words"] for b in bins))
    shared = spark.sparkContext.broadcast(vocabulary)
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    part = F.when(learned, F.pmod(F.xxhash64(F.lit("round"), "doc_id"), F.lit(rounds))).otherwise(rounds).cast("int")
    (given.select("doc_id", "held_out", part.alias("part"), "text").mapInArrow(_encoder(shared), ENCODED)
     .withColumn("row", F.monotonically_increasing_id()).write.partitionBy("part").parquet(path))
    encoded = spark.read.schema(f"row long, {ENCODED}").parquet(path)
    model = GatedModel.from_counts(vocabulary.model_counts)
    for r in range(rounds):
        model = _mean_weights(encoded.where(F.col("part") == r), model, RATE / (1 + r))
    trained = spark.sparkContext.broadcast(model.flat)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _steady_heap()
        own = GatedModel(trained.value)
        for batch in batches:
            scores = document_scores(own, _documents(batch))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores)], [*batch.schema.names[:-1], "model"])

    scored = encoded.select("row", "doc_id", "held_out", "n_tokens", "head_known", "head_base", "head_unknown", "ids") \
        .mapInArrow(score, "row long, doc_id long, held_out boolean, n_tokens long, head_known long, "
                           "head_base double, head_unknown double, model double")
    n = F.coalesce("n", F.lit(0))
    rare = (encoded.select("row", F.explode("rare").alias("r")).select("row", F.col("r.word").alias("word"), F.col("r.tf").alias("tf"))
            .join(counts, "word", "left").groupBy("row").agg(
                F.sum(F.when(n > 0, F.col("tf")).otherwise(0)).alias("rare_known"),
                F.sum(F.col("tf") * F.log10((n + ADD) / vocabulary.base_total)).alias("rare_base"),
                F.sum(F.col("tf") * F.when(F.col("word") != b"", F.log10((n + ADD) / vocabulary.unknown_total))
                      .otherwise(0.0)).alias("rare_unknown")))
    zero = F.lit(0)
    return scored.join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("head_known") + F.coalesce("rare_known", zero)).cast("long").alias("n_known"),
        F.lit(vocabulary.n).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("rare_base", zero)).alias("base_score"),
        (F.col("model") + F.col("head_unknown") + F.coalesce("rare_unknown", zero)).alias("score"))
