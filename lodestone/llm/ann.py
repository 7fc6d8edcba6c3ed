"""Approximate nearest neighbours by inner product over balanced posting lists.

Vectors are put on a sphere by one more coordinate, so that the largest inner product is the
smallest distance.  Centroids come from a bounded sample: equal splits, then k-means in which a
crowded list weighs its distances more.  Every vector is indexed in its list and, near a boundary,
in further lists whose centroids are almost as near and lie in other directions.  A query walks an
in-memory neighbour graph of the centroids, best first, and takes every list whose distance is
within a ratio of the nearest one's.  The ratio is measured, not fixed: the true neighbours of a
bounded number of queries are found by one scan, and the smallest ratio is taken under which the
walk reaches the lists of nearly all of them.  Lists are cut into blocks of bounded size, each
list's queries too; Spark joins the blocks on the list and a task multiplies one pair at a time.

Equal vectors are one class: only its smallest ids can be among a query's nearest.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, ship_package
from .text import bounded_batches

K = 20
SAMPLE, PER_LIST, LIST_SIZE = 200_000, 8, 400  # at most SAMPLE // PER_LIST lists
BOUNDARY, REPLICAS, NEAR = 0.1, 3, 16
TRIALS, RECALL = 256, 0.95  # queries that the ratio is measured on, and what it must reach
QUERY_BLOCK, LIST_BLOCK, HELD = 128, 512, 20_000
FIRST = 2  # lists searched before the others
CELLS = 1 << 22  # distances held at once


def lift(x: np.ndarray, largest: float) -> np.ndarray:
    """Rows with a last coordinate that gives all the norm ``largest``."""
    rest = np.sqrt(np.maximum(largest * largest - (x * x).sum(axis=1), 0.0))
    return np.hstack([x, rest[:, None]])


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = (x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None, :] - 2 * (x @ c.T)
    return np.sqrt(np.maximum(d, 0.0))


def _parts(rows: int, width: int) -> Iterator[slice]:
    """Slices of rows whose distances to ``width`` centroids fit in memory."""
    step = max(1, CELLS // max(1, width))
    return (slice(at, at + step) for at in range(0, rows, step))


def _equal_splits(x: np.ndarray, lists: int, rng: np.random.Generator) -> np.ndarray:
    """Means of about ``lists`` parts of ``x``, halved along the line between two means."""
    means, stack = [], [(np.arange(len(x)), lists)]
    while stack:
        rows, share = stack.pop()
        if share <= 1 or len(rows) < 2:
            means.append(x[rows].mean(axis=0))
            continue
        here, half = x[rows], share // 2
        cut = len(rows) * half // share or 1
        low, high = here[rng.integers(len(rows))], here[rng.integers(len(rows))]
        for _ in range(6):
            order = np.argsort(here @ (high - low), kind="stable")
            low, high = here[order[:cut]].mean(axis=0), here[order[cut:]].mean(axis=0)
        stack += [(rows[order[:cut]], half), (rows[order[cut:]], share - half)]
    return np.array(means)


def _joined(x: np.ndarray, c: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(list of smallest weighted distance, squared distance to it) of each row."""
    mine, near = np.empty(len(x), dtype=np.int64), np.empty(len(x))
    for part in _parts(len(x), len(c)):
        d = _distances(x[part], c) ** 2
        mine[part] = (d * weight).argmin(axis=1)
        near[part] = d[np.arange(len(d)), mine[part]]
    return mine, near


def balanced_centroids(sample: np.ndarray, lists: int, rounds: int = 12, splits: int = 6,
                       seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(centroids, weights): k-means in which a list over its share weighs its squared distances
    more; empty lists restart at rows far from their centroid.  Lists that still hold over twice
    their share are then split, so there may be some more than ``lists``."""
    rng = np.random.default_rng(seed)
    c = _equal_splits(sample, lists, rng)
    weight, share = np.ones(len(c)), len(sample) / len(c)
    for _ in range(rounds):
        mine, near = _joined(sample, c, weight)
        count = np.bincount(mine, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, mine, sample)
        c = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], c)
        weight *= np.clip(count / share, 0.25, 4.0) ** 0.03
        empty = np.flatnonzero(count == 0)
        if len(empty):
            c[empty] = sample[np.argsort(-near, kind="stable")[:len(empty)]]
            weight[empty] = np.median(weight)
    for _ in range(splits):
        mine, _ = _joined(sample, c, weight)
        count = np.bincount(mine, minlength=len(c))
        full = np.flatnonzero(count > 2 * share)
        if not len(full):
            break
        halves = [_equal_splits(sample[mine == i], int(np.ceil(count[i] / share)), rng) for i in full]
        keep = count <= 2 * share
        c = np.vstack([c[keep], *halves])
        weight = np.concatenate([weight[keep], *(np.full(len(h), weight[i]) for h, i in zip(halves, full))])
    return c, weight


class CentroidGraph:
    """Centroids with their ``degree`` nearest as neighbours (both ways) and a best-first walk."""

    def __init__(self, c: np.ndarray, degree: int = 16):
        self.c = c
        links: list[set[int]] = [set() for _ in c]
        for part in _parts(len(c), len(c)):
            near = np.argsort(_distances(c[part], c), axis=1, kind="stable")[:, :degree + 1]
            for i, row in enumerate(near.tolist(), part.start):
                for j in {*row, (i + 1) % len(c)} - {i}:  # the ring joins all parts of the graph
                    links[i].add(j), links[j].add(i)
        self.links = [np.array(sorted(s), dtype=np.int64) for s in links]
        self.entry = sorted({0, len(c) // 3, 2 * len(c) // 3})

    def within(self, q: np.ndarray, ratio: float, sizes: np.ndarray, need: int, least: int = 64) -> list[int]:
        """Lists whose centroids are within ``1 + ratio`` times the nearest one's distance, and
        the next ones until they hold ``need`` entries.  The walk goes on a little beyond
        (``least`` nodes, and a tenth of the ratio) before it gives up."""
        seen = np.zeros(len(self.c), dtype=bool)
        heap: list[tuple[float, int]] = []

        def push(nodes: np.ndarray) -> None:
            nodes = nodes[~seen[nodes]]
            seen[nodes] = True
            if len(nodes):
                diff = self.c[nodes] - q
                for d, i in zip(np.sqrt((diff * diff).sum(axis=1)).tolist(), nodes.tolist()):
                    heapq.heappush(heap, (d, i))

        push(np.array(self.entry))
        taken: list[tuple[float, int]] = []
        best, held = np.inf, 0
        while heap:
            d, i = heapq.heappop(heap)
            if len(taken) >= least and held >= need and d > best * (1 + 1.1 * ratio) + 1e-12:
                break
            best, held = min(best, d), held + int(sizes[i])
            taken.append((d, i))
            push(self.links[i])
        out, held = [], 0
        for d, i in sorted(taken):
            if held >= need and d > best * (1 + ratio) + 1e-12:
                break
            out.append(i)
            held += int(sizes[i])
        return out


def lists_of(x: np.ndarray, c: np.ndarray, weight: np.ndarray, boundary: float = BOUNDARY,
             replicas: int = REPLICAS) -> list[list[int]]:
    """Each row's own list (smallest weighted distance), and up to ``replicas - 1`` more within
    the boundary ratio of the nearest, first those whose centroids lie across from the own one's:
    a query that misses a row's list does so along its offset from that centroid."""
    out = []
    for part in _parts(len(x), max(len(c), NEAR * c.shape[1])):
        here = x[part]
        d = _distances(here, c)
        own = (d * d * weight).argmin(axis=1)
        near = np.argsort(d, axis=1, kind="stable")[:, :NEAR]
        dist = np.take_along_axis(d, near, axis=1)
        offset = here - c[own]
        offset /= np.maximum(np.sqrt((offset * offset).sum(axis=1)), 1e-300)[:, None]
        along = np.einsum("rnk,rk->rn", here[:, None, :] - c[near], offset)
        cost = np.where((dist <= (1 + boundary) * dist[:, :1]) & (near != own[:, None]), dist ** 2 + along ** 2, np.inf)
        for i, order in enumerate(np.argsort(cost, axis=1, kind="stable")[:, :replicas - 1]):
            out.append([int(own[i]), *(int(near[i, j]) for j in order if cost[i, j] < np.inf)])
    return out


def asked(x: np.ndarray, largest: float) -> np.ndarray:
    """Queries among lifted vectors: last coordinate 0, norm ``largest``."""
    q = np.hstack([x, np.zeros((len(x), 1))])
    return q * (largest / np.sqrt((q * q).sum(axis=1)))[:, None]


def measured_ratio(graph: CentroidGraph, queries: np.ndarray, true_lists: list[list[list[int]]], sizes: np.ndarray,
                   need: int, recall: float = RECALL) -> float:
    """The smallest of some ratios under which the walks of ``queries`` reach a list of at least
    ``recall`` of their true neighbours (``true_lists``: lists of each neighbour of each query);
    infinite, so that all lists are taken, if none of them does."""
    off = []
    for q, neighbours in zip(queries, true_lists):
        d = np.sqrt(((graph.c - q) ** 2).sum(axis=1))
        off += [d[own].min() / max(d.min(), 1e-300) - 1 for own in neighbours]
    if not off:
        return float("inf")
    for share in (recall, (1 + recall) / 2, (3 + recall) / 4, 1.0):
        ratio = float(np.quantile(off, share)) + 1e-9
        found = 0
        for q, neighbours in zip(queries, true_lists):
            taken = set(graph.within(q, ratio, sizes, need))
            found += sum(not taken.isdisjoint(own) for own in neighbours)
        if found >= recall * len(off):
            return ratio
    return float("inf")


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _block(scalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, vectors and bounds of a list of (id, embedding, bound)."""
    v = scalar.values
    return (v.field("id").to_numpy(zero_copy_only=False), _vectors(v.field("embedding")),
            v.field("bound").to_numpy(zero_copy_only=False))


def usable(vectors: DataFrame, is_query) -> DataFrame:
    """(vec_id, embedding as doubles, asks) of the rows that take part: id and vector not null,
    every component finite, not all zero, and as many components as most rows have."""
    e = F.col("embedding")
    good = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.cast("array<double>").alias("embedding"),
                          F.coalesce(is_query, F.lit(False)).alias("asks")).where(
        F.col("vec_id").isNotNull() & (F.size(e) > 0)
        & F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists(e, lambda v: v != 0))
    sizes = good.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n"))
    top = sizes.orderBy(F.desc("n"), "d").first()
    return good.where(F.size("embedding") == (top["d"] if top else 0))


def true_neighbours(classes: DataFrame, trials: list[tuple[int, int]], x: np.ndarray, k: int) -> DataFrame:
    """(trial, id): the ``k`` vectors of ``classes`` with the largest inner products with each of
    the few rows of ``x``, without the trial's own class; one scan, each task keeps its best."""
    own = np.array([o for _, o in trials], dtype=np.int64)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, score = np.empty((len(x), 0), dtype=np.int64), np.empty((len(x), 0))
        for batch in batches:
            if batch.num_rows:
                v_ids = batch.column("id").to_numpy(zero_copy_only=False)
                s = x @ _vectors(batch.column("embedding")).T
                s[own[:, None] == v_ids[None, :]] = -np.inf
                ids = np.hstack([ids, np.broadcast_to(v_ids, s.shape)])
                score = np.hstack([score, s])
                best = np.argsort(-score, axis=1, kind="stable")[:, :k]
                ids, score = np.take_along_axis(ids, best, axis=1), np.take_along_axis(score, best, axis=1)
        good = np.isfinite(score)
        yield pa.RecordBatch.from_arrays([pa.array(np.nonzero(good)[0].astype(np.int32)), pa.array(ids[good]),
                                          pa.array(score[good])], ["trial", "id", "score"])

    best = Window.partitionBy("trial").orderBy(F.desc("score"), "id")
    return (classes.select("id", "embedding").mapInArrow(scan, "trial int, id long, score double")
            .withColumn("place", F.row_number().over(best)).where(F.col("place") <= k).select("trial", "id"))


def nearest(vectors: DataFrame, is_query, k: int = K, sample: int = SAMPLE, list_size: int = LIST_SIZE,
            recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): for every usable row of ``vectors`` (vec_id, embedding;
    other columns are ignored) for which ``is_query`` (a column over ``vectors``) holds, its ``k`` nearest others found, by
    largest inner product in double precision, ties to the smaller vec_id.

    Every usable row is indexed; the sample of at most about ``sample`` vectors only places the
    centroids (a list for every ``list_size`` vectors, but at most one for 8 of the sample), and
    at most 256 queries are compared with all vectors to choose how far the others must look
    for ``recall``.  Rows that are not usable neither ask nor answer; repeated rows count once;
    one vec_id with several vectors is several candidates under one id, none of them for itself;
    an empty table gives no rows."""
    spark = vectors.sparkSession
    ship_package(spark)
    bounded_batches(vectors, 64)  # a row of the search is a pair of blocks
    key = [F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(7), "embedding").alias("h2")]
    good = usable(vectors, is_query)
    asks = good.where("asks").select("vec_id").distinct().withColumn("asks", F.lit(True))
    rows = cut_lineage(good.drop("asks").dropDuplicates(["vec_id", "embedding"]).join(asks, "vec_id", "left")
                       .select("vec_id", "embedding", F.coalesce("asks", F.lit(False)).alias("asks"), *key))
    first = Window.partitionBy("h1", "h2").orderBy("vec_id")
    members = cut_lineage(rows.select("vec_id", "h1", "h2").withColumn("place", F.row_number().over(first))
                          .where(F.col("place") <= k + 1))
    lead = members.where("place = 1").select("h1", "h2", F.col("vec_id").alias("id"))
    classes = cut_lineage(rows.join(lead, (rows.vec_id == lead.id) & (rows.h1 == lead.h1) & (rows.h2 == lead.h2))
                          .select("id", rows.h1, rows.h2, "embedding"))
    n = classes.count()
    empty = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], empty)
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v * v))
    largest = classes.agg(F.max(norm)).first()[0] * (1 + 1e-9)
    share = min(1.0, sample / n)
    picked = classes.where(F.pmod(F.xxhash64(F.lit("sample"), "h1"), F.lit(1 << 20)) < share * (1 << 20))
    points = _vectors(picked.select("embedding").toArrow().column("embedding").combine_chunks())
    if not len(points):
        points = np.array([classes.first()["embedding"]], dtype=np.float64)
    slack = 8 * points.shape[1] * np.finfo(float).eps * largest * largest  # of a sum in another order
    lists = max(1, min(n // list_size, len(points) // PER_LIST))
    centroids, weight = balanced_centroids(lift(points, largest), lists)
    graph = CentroidGraph(centroids)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = lists_of(lift(_vectors(batch.column("embedding")), largest), centroids, weight)
                at = np.repeat(np.arange(len(own)), [len(o) for o in own])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([j for o in own for j in o], pa.int32()), batch.column("id").take(pa.array(at)),
                     batch.column("embedding").take(pa.array(at))], ["list", "id", "embedding"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = [graph.within(q, ratio, counts, need) for q in asked(_vectors(batch.column("embedding")), largest)]
                at = pa.array(np.repeat(np.arange(len(own)), [len(o) for o in own]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([j for o in own for j in o], pa.int32()), batch.column("id").take(at),
                     batch.column("embedding").take(at), pa.array([i for o in own for i in range(len(o))], pa.int32())],
                    ["list", "id", "embedding", "place"])

    entry = "list int, id long, embedding array<double>"
    posted = cut_lineage(classes.select("id", "embedding").mapInArrow(index, entry))
    sizes = posted.groupBy("list").agg(F.count("*").alias("n"))  # a row a list
    counts = np.zeros(len(centroids), dtype=np.int64)
    for r in sizes.collect():
        counts[r["list"]] = r["n"]
    need = REPLICAS * (k + 2)
    trial_rows = (rows.where("asks").orderBy(F.xxhash64(F.lit("trial"), "vec_id"), "h1").limit(TRIALS)
                  .join(lead, ["h1", "h2"]).select("vec_id", "id", "embedding").collect())
    ratio = float("inf")
    if trial_rows:
        x = np.array([r["embedding"] for r in trial_rows], dtype=np.float64)
        homes: dict[tuple[int, int], list[int]] = {}
        true = true_neighbours(classes, [(r["vec_id"], r["id"]) for r in trial_rows], x, k)
        for r in posted.select("id", "list").join(F.broadcast(true), "id").collect():  # TRIALS * k * REPLICAS at most
            homes.setdefault((r["trial"], r["id"]), []).append(r["list"])
        near_lists: list[list[list[int]]] = [[] for _ in trial_rows]
        for (trial, _), own in homes.items():
            near_lists[trial].append(own)
        ratio = measured_ratio(graph, asked(x, largest), near_lists, counts, need, recall)
    pack = F.collect_list(F.struct("id", "embedding", "bound"))
    blocks = (posted.join(F.broadcast(sizes), "list").withColumn("bound", F.lit(0.0))
              .withColumn("part", F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / LIST_BLOCK)))
              .groupBy("list", "part").agg(pack.alias("vectors")))
    queries = cut_lineage(rows.where("asks").select(F.col("vec_id").alias("id"), "embedding")
                          .mapInArrow(ask, entry + ", place int"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, float], list[np.ndarray]] = {}

        def out() -> pa.RecordBatch:
            q = np.repeat([key[0] for key in held], [len(v[0]) for v in held.values()])
            ids = np.concatenate([v[0] for v in held.values()]) if held else np.empty(0)
            s = np.concatenate([v[1] for v in held.values()]) if held else np.empty(0)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(q.astype(np.int64)), pa.array(ids.astype(np.int64)), pa.array(s.astype(np.float64))],
                ["query_id", "id", "score"])

        for batch in batches:
            for i in range(batch.num_rows):
                q_ids, q, bound = _block(batch.column("queries")[i])
                v_ids, v, _ = _block(batch.column("vectors")[i])
                rough = q @ v.T
                for j, q_id in enumerate(q_ids.tolist()):
                    good = np.flatnonzero(rough[j] >= bound[j])
                    if len(good) > 2 * k + 2:
                        cut = np.partition(rough[j][good], len(good) - k - 1)[len(good) - k - 1]
                        good = good[rough[j][good] >= cut - slack]
                    if not len(good):
                        continue
                    score = (v[good] * q[j]).sum(axis=1)  # the same sum whatever the block
                    mark = (q_id, float(q[j].sum()))
                    ids = v_ids[good]
                    if mark in held:
                        ids, score = np.concatenate([held[mark][0], ids]), np.concatenate([held[mark][1], score])
                        ids, at = np.unique(ids, return_index=True)
                        score = score[at]
                    if len(ids) > k + 1:
                        best = np.lexsort((ids, -score))[:k + 1]
                        ids, score = ids[best], score[best]
                    held[mark] = [ids, score]
                if len(held) > HELD:
                    yield out()
        if held:
            yield out()

    def hits_of(some: DataFrame) -> DataFrame:
        askers = some.groupBy("list").agg(F.ceil(F.count("*") / QUERY_BLOCK).alias("parts"))  # a row a list
        blocked = (some.join(F.broadcast(askers), "list")
                   .withColumn("q_part", F.pmod(F.xxhash64(F.lit(1), "id"), F.col("parts")))
                   .groupBy("list", "q_part").agg(pack.alias("queries")))
        return blocked.join(blocks, "list").select("queries", "vectors").mapInArrow(
            search, "query_id long, id long, score double")

    # the nearest lists first; what they hold bounds what the others must reach
    near = cut_lineage(hits_of(queries.where(F.col("place") < FIRST).withColumn("bound", F.lit(float("-inf")))))
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    kth = (near.dropDuplicates(["query_id", "id"]).withColumn("place", F.row_number().over(by_score))
           .where(F.col("place") == k + 1).select(F.col("query_id").alias("id"), (F.col("score") - slack).alias("bound")))
    rest = (queries.where(F.col("place") >= FIRST).join(kth, "id", "left")
            .withColumn("bound", F.coalesce("bound", F.lit(float("-inf")))))
    hits = near.unionByName(hits_of(rest))
    hits = (hits.groupBy("query_id", "id").agg(F.max("score").alias("score"))
            .withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= k + 1).drop("place"))
    answers = members.join(lead, ["h1", "h2"]).select("id", "vec_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (hits.join(answers, "id").where("vec_id != query_id").select("query_id", "vec_id", "score").distinct()
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
