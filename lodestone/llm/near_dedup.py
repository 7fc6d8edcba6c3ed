"""Near-duplicate groups: fast similarity sketches, banding, exact verification.

1. One pass over the texts gives each document's set size, set digest and band hashes.
2. Documents with the same set are one class (a partial aggregate: a group of exact copies of
   any size becomes one row); only classes go on.
3. Classes that agree in a band fall into one bucket.  In each bucket every member is held
   against the bucket's smallest member on the full sets; the links found give components.
   This is linear in the members and joins up large groups of near copies.
4. Buckets that still hold more than one component are searched completely: blocks of at most
   ``block`` members get exact intersection sizes of all their members at once (a 0/1 matrix
   product inside the task), and only links that join two components leave the task.  Larger
   buckets are cut into pairs of blocks, so no task holds an unbounded group.
5. Links of both kinds give the final components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, ship_package
from .components import connected_components
from .sketch import Sketcher
from .text import WordHash, bounded_batches, mix64, odd_multipliers, rolling, shingle_words, texts_of

WORDS = 5
BANDS, ROWS = 64, 5        # a pair of similarity 0.75 misses every band once in 3e7
BLOCK, SHINGLES = 1500, 1000  # members of a block, and their mean set size, at most
_MULT = odd_multipliers(WORDS, 3)


def shingle_set(text: bytes | None, words: WordHash) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles of five words; fewer words make
    one shingle of the whole sequence, no words an empty set."""
    w = words.of(shingle_words(text))
    if not len(w):
        return w
    width = min(WORDS, len(w))
    if width < WORDS:  # told apart from a five-word shingle by its length
        return mix64(rolling(w, width, _MULT) + np.uint64(width))
    return np.unique(rolling(w, width, _MULT))


def _digest(s: np.ndarray) -> tuple[int, int]:
    import xxhash
    d = xxhash.xxh3_128_intdigest(s.tobytes())
    return (d >> 64) - (1 << 63), (d & (1 << 64) - 1) - (1 << 63)


def sketch_documents(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, bands): set size, digest of the set, band hashes (an empty
    list for an empty set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, sketcher = WordHash(), Sketcher(bands, rows)
        with np.errstate(over="ignore"):
            for batch in batches:
                n, d1, d2, hashes = [], [], [], []
                for text in texts_of(batch):
                    s = shingle_set(text, words)
                    a, b = _digest(s)
                    n.append(len(s)), d1.append(a), d2.append(b)
                    hashes.append(sketcher.band_hashes(sketcher.sketch(s)).view(np.int64)
                                  if len(s) else [])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()),
                     pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                     pa.array(hashes, pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "d1", "d2", "bands"])

    ship_package(docs.sparkSession)
    return bounded_batches(docs).select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(cid, set) of documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHash()
        with np.errstate(over="ignore"):
            for batch in batches:
                sets = [shingle_set(t, words).view(np.int64) for t in texts_of(batch)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").cast(pa.int64()), pa.array(sets, pa.list_(pa.int64()))],
                    ["cid", "set"])

    return docs.select("doc_id", "text").mapInArrow(run, "cid long, set array<long>")


def _sized(inter, n1, n2):
    return 100 * inter >= 75 * (n1 + n2 - inter)


def block_links(ids: np.ndarray, comps: np.ndarray, side: np.ndarray,
                sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that join different components, among all pairs of the members (of different
    sides where the task holds two blocks): exact intersection sizes by a 0/1 product over
    the shingles that more than one member has; of links that join the same two components
    only the first is given."""
    n = np.array([len(s) for s in sets], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), n)
    values, index, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[index] > 1
    column = np.cumsum(count > 1) - 1
    owner, index = owner[shared], column[index[shared]]
    width = int((count > 1).sum())
    inter = np.zeros((len(sets), len(sets)), dtype=np.float32)
    order = np.argsort(index, kind="stable")
    owner, index = owner[order], index[order]
    for lo in range(0, width, 4096):  # a slice of the shingles at a time: bounded memory
        a, b = np.searchsorted(index, (lo, lo + 4096))
        m = np.zeros((len(sets), min(4096, width - lo)), dtype=np.float32)
        m[owner[a:b], index[a:b] - lo] = 1
        inter += m @ m.T
    inter = inter.astype(np.int64)
    good = _sized(inter, n[:, None], n[None, :]) & (comps[:, None] != comps[None, :])
    if side.any():
        good &= side[:, None] != side[None, :]
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    links = []
    for i, j in zip(*np.nonzero(np.triu(good, 1))):
        a, b = find(int(comps[i])), find(int(comps[j]))
        if a != b:
            root[max(a, b)] = min(a, b)
            links.append((int(ids[i]), int(ids[j])))
    return links


def _search_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by task key; each run of equal keys is one (pair of) block(s)."""
    key, rows = None, []

    def flush():
        links = block_links(np.array([r[1] for r in rows]), np.array([r[2] for r in rows]),
                            np.array([r[3] for r in rows]), [r[4] for r in rows])
        return pa.RecordBatch.from_arrays(
            [pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())],
            ["a", "b"])

    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("h", "bi", "bj", "cid", "comp", "side")]
        sets = batch.column("set")
        for i, (h, bi, bj, cid, comp, side) in enumerate(zip(*cols)):
            if (h, bi, bj) != key:
                if len(rows) > 1:
                    yield flush()
                key, rows = (h, bi, bj), []
            rows.append((key, cid, comp, side, sets[i].values.to_numpy(zero_copy_only=False)))
    if len(rows) > 1:
        yield flush()


def near_links(docs: DataFrame, sketched: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(classes, links): the classes (d1, d2, cid, n) of equal sets, cid their smallest
    doc_id, and links (a, b) between class ids that connect all that is connected."""
    classes = cut_lineage(sketched.where("n_shingles > 0 and doc_id is not null")
                          .groupBy("d1", "d2")
                          .agg(F.min("doc_id").alias("cid"), F.min("n_shingles").alias("n"),
                               F.first("bands").alias("bands")))
    banded = classes.select("cid", "n", F.explode("bands").alias("h"))
    heads = (banded.groupBy("h").agg(F.count("*").alias("m"), F.min(F.struct("cid", "n")).alias("lead"))
             .where("m > 1"))
    members = cut_lineage(banded.join(heads, "h").select("h", "cid", "n", "m",
                          F.col("lead.cid").alias("lead"), F.col("lead.n").alias("lead_n")))
    wanted = members.select(F.col("cid").alias("doc_id")).distinct()
    sets = cut_lineage(shingle_sets(docs.join(wanted, "doc_id", "left_semi")
                                    .dropDuplicates(["doc_id", "text"])))
    star = (members.where("cid != lead and 100 * least(n, lead_n) >= 75 * greatest(n, lead_n)")
            .select("cid", "n", "lead", "lead_n").distinct())
    inter = F.size(F.array_intersect("set", "lead_set"))
    first = cut_lineage(star.join(sets, "cid")
                        .join(sets.select(F.col("cid").alias("lead"), F.col("set").alias("lead_set")), "lead")
                        .where(_sized(inter, F.size("set"), F.size("lead_set")))
                        .select(F.col("cid").alias("a"), F.col("lead").alias("b")))
    comp = connected_components(first)
    labelled = members.join(comp.withColumnRenamed("node", "cid"), "cid", "left").select(
        "h", "cid", "n", F.coalesce("component", "cid").alias("comp"))
    open_buckets = (labelled.groupBy("h")
                    .agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m"),
                         F.sum("n").alias("size"), F.sum(F.xxhash64("cid").cast("decimal(38,0)")).alias("s"))
                    .where("lo != hi")
                    # buckets of several bands with the same members are searched once
                    .groupBy("m", "size", "s", "lo", "hi").agg(F.min("h").alias("h"))
                    .select("h", F.ceil(F.greatest(F.col("m") / block,
                                                   F.col("size") / (block * SHINGLES)))
                            .cast("int").alias("parts")))
    parts = F.col("parts")
    mine = F.pmod(F.xxhash64("cid"), parts).cast("int")
    tasks = (labelled.join(open_buckets, "h").join(sets, "cid")
             .withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
             .select("h", F.least("mine", "other").alias("bi"), F.greatest("mine", "other").alias("bj"),
                     "cid", "comp", (F.col("mine") > F.col("other")).cast("int").alias("side"), "set"))
    second = cut_lineage(tasks.repartition("h", "bi", "bj").sortWithinPartitions("h", "bi", "bj")
                         .mapInArrow(_search_blocks, "a long, b long"))
    return classes.select("d1", "d2", "cid"), first.unionByName(second)


def near_duplicates(docs: DataFrame, bands: int = BANDS, rows: int = ROWS,
                    block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text; other
    columns are ignored).

    Documents are linked when their sets of distinct five-word shingles (words are runs of
    non-space ASCII-lower-cased characters; fewer than five words: the whole sequence) have a
    Jaccard similarity of 0.75 or more; ``component_id`` is the smallest doc_id reachable over
    links, ``kept`` tells whether that is the document itself.  Texts that are null, empty or
    only spaces have an empty set and stay alone.  Rows without a doc_id link with nothing,
    get a null component and are kept.  Repeated rows of one doc_id get equal rows; several
    texts under one doc_id are linked each on its own but read back under one id.  An empty
    table gives no rows."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketched = cut_lineage(sketch_documents(docs, bands, rows))
    classes, links = near_links(docs, sketched, block)
    comp = connected_components(links).withColumnRenamed("node", "cid")
    of_set = classes.join(comp, "cid", "left").select(
        "d1", "d2", F.coalesce("component", "cid").alias("component_id"))
    return (sketched.drop("bands").join(of_set, ["d1", "d2"], "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
                    .otherwise(F.col("doc_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
