"""Nearest-neighbour search over a vector table, with parent dedupe and filters.

Exact search (no cross join, no limit on the number of queries):

1. the query vectors are written once and dealt, row by row, into blocks of at most
   ``BLOCK_BYTES``; one block at a time is sent to the executors;
2. for a block the vector table is scanned once in ``mapInArrow``: every partition keeps only
   its own top-n per query (BLAS pre-filter on ``|x|^2 + |q|^2 - 2 q.x`` in tiles of bounded
   size, then exact distances for the few candidates);
3. a windowed top-n over those candidates gives the global answer.

A partition-local top-n is enough: an element of the global top-n is also in the top-n of its
own partition.  With ``per_parent=True`` the unit is the parent (best vector per parent); the
same argument holds for parents.

Approximate search (``hash_buckets`` and ``knn_hashed``): bucket numbers are stored with the
vectors, candidates come from an equi-join on (table, bucket).

Distances are squared L2 (smaller is better); the exact value is summed in dimension order in
float64, so it is reproducible by any engine.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, ship_package

BLOCK_BYTES = 64 * 1024 * 1024  # query vectors sent to the executors at a time
TILE = (128, 4096)              # queries and vectors whose distances a task estimates at a time
_MARGIN = 1e-12  # relative to |x|^2 + |q|^2: the rounding error of the estimated distance


def _arrow_batches(batches: Iterator[pa.RecordBatch], id_col: str, parent_col: str | None,
                   vec_col: str, dim: int):
    """(vectors, ids, parents) per Arrow batch; the list column is flattened straight into a
    ``rows x dim`` matrix (no per-row Python objects).  Rows were filtered to non-null
    vectors of the query dimension in the JVM before this stage."""
    for rb in batches:
        if rb.num_rows == 0:
            continue
        flat = rb.column(vec_col).flatten().to_numpy(zero_copy_only=False)
        x = flat.astype(np.float64, copy=False).reshape(rb.num_rows, dim)
        ids = rb.column(id_col).to_numpy(zero_copy_only=False)
        parents = rb.column(parent_col).to_numpy(zero_copy_only=False) if parent_col else ids
        yield x, ids, parents


def _exact(xs: np.ndarray, qs: np.ndarray) -> np.ndarray:
    """Row-wise squared L2 of paired rows, summed sequentially over dimensions."""
    diff = xs - qs
    return np.cumsum(diff * diff, axis=1)[:, -1] if diff.shape[1] else np.zeros(len(diff))


def _select(q_idx, ids, parents, dist, n, per_parent):
    """Keep the top-n (by distance, id) per query - per parent first when asked."""
    if len(q_idx) == 0:
        return q_idx, ids, parents, dist
    order = np.lexsort((ids, dist, q_idx))
    q_idx, ids, parents, dist = q_idx[order], ids[order], parents[order], dist[order]
    if per_parent:
        # first (= best) row of every (query, parent); parents may be strings -> int codes
        _, codes = np.unique(parents, return_inverse=True)
        pair = q_idx.astype(np.int64) * (int(codes.max()) + 1) + codes
        _, first = np.unique(pair, return_index=True)
        keep = np.sort(first)
        q_idx, ids, parents, dist = q_idx[keep], ids[keep], parents[keep], dist[keep]
    # rank inside each query block (rows are sorted by query already)
    starts = np.r_[0, np.flatnonzero(np.diff(q_idx)) + 1]
    rank = np.arange(len(q_idx)) - np.repeat(starts, np.diff(np.r_[starts, len(q_idx)]))
    keep = rank < n
    return q_idx[keep], ids[keep], parents[keep], dist[keep]


def _parent_threshold(approx: np.ndarray, parents: np.ndarray, n: int) -> np.ndarray:
    """Per query: the n-th smallest of the best (estimated) distance of each parent."""
    perm = np.argsort(parents, kind="stable")
    ps = parents[perm]
    bounds = np.r_[0, np.flatnonzero(ps[1:] != ps[:-1]) + 1]
    best = np.minimum.reduceat(approx[:, perm], bounds, axis=1)
    m = min(n, best.shape[1])
    return np.partition(best, m - 1, axis=1)[:, m - 1]


def _partition_topn(batches, qmat: np.ndarray, n: int, per_parent: bool) -> tuple:
    """Top-n per query over one partition; ``batches`` yields (vectors, ids, parents)."""
    qn = (qmat * qmat).sum(axis=1)
    best: dict[int, tuple] = {}  # of every slice of the queries
    for xs, all_ids, all_parents in batches:
        for at in range(0, len(xs), TILE[1]):
            x, ids, parents = (a[at:at + TILE[1]] for a in (xs, all_ids, all_parents))
            xn = (x * x).sum(axis=1)
            for lo in range(0, len(qmat), TILE[0]):
                q, norms = qmat[lo:lo + TILE[0]], xn[None, :] + qn[lo:lo + TILE[0], None]
                approx = norms - 2.0 * (q @ x.T)
                if per_parent:
                    thr = _parent_threshold(approx, parents, n)
                else:
                    m = min(n, x.shape[0])
                    thr = np.partition(approx, m - 1, axis=1)[:, m - 1]
                # both the threshold and the row may be off by the rounding error of their norms
                slack = _MARGIN * x.shape[1] * (norms + norms.max(axis=1)[:, None])
                qi, xi = np.nonzero(approx <= thr[:, None] + slack)
                cand = (qi + lo, ids[xi], parents[xi], _exact(x[xi], q[qi]))
                if lo in best:
                    cand = tuple(np.concatenate([a, c]) for a, c in zip(best[lo], cand))
                best[lo] = _select(*cand, n=n, per_parent=per_parent)
    return tuple(np.concatenate(c) for c in zip(*best.values())) if best else None


def knn(vectors: DataFrame, queries: DataFrame, n: int, *, id_col: str = "chunk_id",
        vec_col: str = "embedding", parent_col: str | None = None, per_parent: bool = False,
        query_id: str = "query_id", query_vec: str = "query_vec",
        block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Top-``n`` nearest vectors (or parents, ``per_parent=True``) for every query.

    Query rows are numbered and cut into blocks of at most ``block_bytes``, whatever their ids
    (several rows may share one); each block is one scan of the vectors, and the results are
    unioned.  Queries of different lengths are answered each among the vectors of its length;
    those without a vector get nothing.

    Returns ``query_id, id_col, [parent_col], distance, rank`` (rank 1 = nearest; ties broken by
    id)."""
    spark = vectors.sparkSession
    asked = cut_lineage(queries.where(F.col(query_vec).isNotNull()).select(query_id, query_vec))
    sizes = asked.groupBy(F.size(query_vec).alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy("dim").collect()
    fields = [T.StructField(query_id, queries.schema[query_id].dataType),
              T.StructField(id_col, vectors.schema[id_col].dataType)]
    if parent_col:
        fields.append(T.StructField(parent_col, vectors.schema[parent_col].dataType))
    fields.append(T.StructField("distance", T.DoubleType()))
    if not sizes or n <= 0:
        return spark.createDataFrame([], T.StructType(fields + [T.StructField("rank", T.IntegerType())]))
    if len(sizes) > 1:  # one search a length
        parts = [knn(vectors, asked.where(F.size(query_vec) == s["dim"]), n, id_col=id_col, vec_col=vec_col,
                     parent_col=parent_col, per_parent=per_parent, query_id=query_id, query_vec=query_vec,
                     block_bytes=block_bytes) for s in sizes]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out
    dim, count = sizes[0]["dim"], sizes[0]["n"]
    blocks = max(1, -(-count * dim * 8 // (block_bytes // 2)))  # the mean is half the bound
    block = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks))
    numbered = asked.withColumn("_block", block)
    ship_package(spark)  # the scoring stage runs this module's functions on the executors
    scored = vectors.select(*[id_col] + ([parent_col] if parent_col else []) + [vec_col]).where(
        F.col(vec_col).isNotNull() & (F.size(vec_col) == dim))
    schema = T.StructType([T.StructField("_q", T.IntegerType()), *fields[1:]])
    arrow_schema = pa.schema([pa.field("_q", pa.int32())] + [_arrow_field(f) for f in schema.fields[1:]])
    out = None
    for b in range(blocks):
        rows = numbered.where(F.col("_block") == b).collect()
        if not rows:
            continue
        sent = spark.sparkContext.broadcast(np.array([r[query_vec] for r in rows], dtype=np.float64))

        def per_partition(it, sent=sent):
            res = _partition_topn(_arrow_batches(it, id_col, parent_col, vec_col, dim), sent.value, n,
                                  per_parent)
            if res is None:
                return
            qi, ids, parents, dist = res
            arrays = [pa.array(qi.astype(np.int32)), pa.array(ids)]
            if parent_col:
                arrays.append(pa.array(parents))
            arrays.append(pa.array(dist, type=pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [a.cast(f.type) for a, f in zip(arrays, arrow_schema)], schema=arrow_schema)

        cand = scored.mapInArrow(per_partition, schema)
        if per_parent:
            w1 = Window.partitionBy("_q", parent_col).orderBy("distance", id_col)
            cand = cand.withColumn("_r", F.row_number().over(w1)).where("_r = 1").drop("_r")
        w = Window.partitionBy("_q").orderBy("distance", id_col)
        top = cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
        names = spark.createDataFrame([(i, r[query_id]) for i, r in enumerate(rows)],
                                      T.StructType([T.StructField("_q", T.IntegerType()), fields[0]]))
        part = top.join(names, "_q").select(query_id, *[c for c in schema.names if c != "_q"], "rank")
        out = part if out is None else out.unionByName(part)
    return out


# --- approximate search over stored buckets -------------------------------------------

def plane_sign(table: int, bit: int, position: int) -> int:
    """+1 or -1: the component of a hash table's plane at a position, from integer arithmetic
    that any engine repeats (bit 16 of a multiplicative hash)."""
    h = (position + 1) * (table * 31 + bit * 17 + 7) * 2654435761 % (1 << 32)
    return 1 if h >> 16 & 1 else -1


def hash_buckets(vectors: DataFrame, dim: int, tables: int = 16, bits: int = 3,
                 vec_col: str = "embedding") -> DataFrame:
    """``vectors`` with ``buckets``: per hash table the sign bits of ``bits`` projections.
    Written once with the vectors, it makes a search an equi-join."""
    planes = np.array([[[plane_sign(t, b, p) for p in range(dim)] for b in range(bits)]
                       for t in range(tables)], dtype=np.float64)
    fields = T.StructType([f for f in vectors.schema.fields] + [T.StructField("buckets", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            if rb.num_rows:
                x = rb.column(vec_col).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
                codes = ((np.einsum("nd,tbd->ntb", x, planes) >= 0) * (1 << np.arange(bits))).sum(axis=2)
                yield pa.RecordBatch.from_arrays(
                    [*rb.columns, pa.array(list(codes.astype(np.int32)), pa.list_(pa.int32()))],
                    [*rb.schema.names, "buckets"])

    ship_package(vectors.sparkSession)
    return vectors.where(F.col(vec_col).isNotNull() & (F.size(vec_col) == dim)).mapInArrow(run, fields)


def knn_hashed(bucketed: DataFrame, queries: DataFrame, n: int, *, id_col: str = "vec_id",
               vec_col: str = "embedding", parent_col: str | None = None, query_id: str = "query_id",
               query_vec: str = "query_vec") -> DataFrame:
    """Top-``n`` among the vectors that share a bucket with the query in any hash table; both
    sides carry ``buckets``.  Candidates come from an equi-join on (table, bucket), whose heavy
    buckets adaptive execution splits; a pair met in several tables is scored once."""
    cols = [id_col] + ([parent_col] if parent_col else []) + [vec_col]
    q = queries.select(query_id, query_vec, F.col("buckets").alias("_qb"),
                       F.posexplode("buckets").alias("_t", "_b"))
    # a pair is kept in the first table it shares: needs the vector's own buckets
    v = bucketed.select(*cols, F.col("buckets").alias("_vb"), F.posexplode("buckets").alias("_t", "_b"))
    same = F.transform(F.arrays_zip("_vb", "_qb"), lambda z: z["_vb"] == z["_qb"])
    pairs = v.join(q, ["_t", "_b"]).where(F.array_position(same, True) == F.col("_t") + 1)
    dist = squared_l2(F.col(vec_col), F.col(query_vec)).alias("distance")
    w = Window.partitionBy(query_id).orderBy("distance", id_col)
    return (pairs.select(query_id, *cols[:-1], dist).withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= n))


def _arrow_field(f: T.StructField) -> pa.Field:
    kinds = {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.StringType: pa.string(),
             T.DoubleType: pa.float64(), T.ShortType: pa.int16()}
    for k, v in kinds.items():
        if isinstance(f.dataType, k):
            return pa.field(f.name, v)
    raise TypeError(f"unsupported id / parent type {f.dataType}")


def squared_l2(a: Column, b: Column) -> Column:
    """Built-in expression for the squared L2 distance of two array columns (same order of
    summation as the vectorised path); for small ad-hoc checks."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double"))
                                  * (x.cast("double") - y.cast("double"))),
                       F.lit(0.0), lambda acc, v: acc + v)


# --- filters and end-to-end search ------------------------------------------------

def metadata_filter(meta: DataFrame, equals: dict | None = None, category: str | None = None,
                    country: str | None = None, years: tuple[int, int] | None = None,
                    category_col: str = "iucn_red_list_category", countries_col: str = "paises",
                    year_min_col: str = "anio_min", year_max_col: str = "anio_max") -> DataFrame:
    """AND of: column equality for every ``equals`` item (an unknown column can never
    equal a value, so it matches nothing), category equality, country membership and
    year-range overlap.  ``None`` / empty filters are off."""
    out = meta
    for k, v in (equals or {}).items():
        out = out.where(F.col(k).eqNullSafe(F.lit(v))) if k in meta.columns else out.where(F.lit(False))
    if category:
        out = out.where(F.col(category_col) == F.lit(category))
    if country:
        out = out.where(F.array_contains(F.coalesce(F.col(countries_col),
                                                    F.array().cast("array<string>")), country))
    if years:
        lo, hi = years
        out = out.where((F.col(year_max_col) >= lo) & (F.col(year_min_col) <= hi))
    return out


def search(vectors: DataFrame, queries: DataFrame, metadata: DataFrame, top_k: int = 5, *,
           mode: str = "pre", oversample: int = 5, id_col: str = "chunk_id",
           parent_col: str = "species_key", vec_col: str = "embedding", text_col: str = "text",
           title_col: str = "wikipedia_title", metadata_fields: Sequence[str] = (),
           query_id: str = "query_id", query_vec: str = "query_vec", **filters) -> DataFrame:
    """Top-``top_k`` parents per query: best chunk per parent, parent metadata attached.

    ``mode='pre'`` (default) filters parents first and searches only their chunks: every
    match is found.  ``mode='post'`` reproduces the reference: take the ``oversample * top_k``
    nearest chunks, dedupe by parent, drop hits without a parent, filter, keep ``top_k`` -
    fewer rows can come back although more parents match."""
    meta = metadata_filter(metadata, **filters)
    meta_cols = [parent_col, title_col] + [c for c in metadata_fields]
    meta = meta.select(*meta_cols)
    if mode == "pre":
        vecs = vectors.join(meta.select(parent_col).distinct(), parent_col, "left_semi")
        hits = knn(vecs, queries, top_k, id_col=id_col, vec_col=vec_col, parent_col=parent_col,
                   per_parent=True, query_id=query_id, query_vec=query_vec)
    elif mode == "post":
        raw = knn(vectors, queries, oversample * top_k, id_col=id_col, vec_col=vec_col,
                  parent_col=parent_col, query_id=query_id, query_vec=query_vec)
        w1 = Window.partitionBy(query_id, parent_col).orderBy("distance", id_col)
        hits = raw.withColumn("_r", F.row_number().over(w1)).where("_r = 1").drop("_r", "rank")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    joined = hits.drop("rank").join(meta, parent_col)
    w = Window.partitionBy(query_id).orderBy("distance", id_col)
    top = joined.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_k)
    out = top.join(vectors.select(id_col, text_col), id_col)  # texts last, for the top rows only
    meta_struct = F.struct(*[F.col(c) for c in metadata_fields]) if metadata_fields else F.lit(None)
    return out.select(query_id, "rank", parent_col, title_col, F.col(text_col).alias("chunk_text"),
                      F.col("distance").alias("score"), id_col, meta_struct.alias("metadata"))
