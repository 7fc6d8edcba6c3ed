"""Versioned Parquet tables for keyed upserts and full rebuilds.

Plain Parquet has no MERGE and cannot be overwritten while it is being read, so every write goes
to a new data folder ``<root>/<table>/v=<n>`` and becomes current by a **commit record**
``<root>/<table>/_log/<n>.json``, which names the folder of every part of the table.  A record is
written aside and renamed into place only if no record of that number exists: a version appears
whole or not at all, and of two writers that started from the same version one gets
``ConcurrentCommit``.  A part that a commit leaves empty is not in its record, so nothing of it
comes back.  Files go through the Hadoop FileSystem API, so the root may be any shared storage.

A table is *plain* (one part), *partitioned* (a part per batch, replaced whole) or *bucketed* by
key, for large targets.  Buckets grow by **linear hashing**: ``modulus`` buckets, of which the
first ``split`` are split in two; the address of a key is its hash modulo ``modulus``, or modulo
twice that where the former is below ``split``.  A table that outgrows ``rows_per_bucket`` gets as
many buckets more as it needs, one after the other, and only those are rewritten besides the
buckets a batch touches.  Files are written as Spark buckets (``2 * modulus`` of them, so every
store bucket holds one or two), and an upsert reads its target through a temporary bucketed table
over the record's folders: the target is joined where it lies, without an exchange.  Rows reach
the writing tasks by the same hash, in a number of tasks that divides the Spark buckets or is a
multiple of them: a file is one task's, so the files grow with the rows and not with tasks times
buckets, and its Bloom filter is as large as its keys need.  A target of more Spark buckets than
a join should have tasks is read as it is and dealt to the writing tasks.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import upsert as U
from ..session import Scratch, cut_lineage

BUCKET = "key_bucket"  # no leading underscore: Spark hides such paths
PARTITION = "batch_id"
ROWS_PER_BUCKET = 500_000
ROWS_PER_TASK = (20_000, 1_000_000)  # rows a writing task has at least and at most, where the buckets allow it
LOG = "_log"
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


class ConcurrentCommit(RuntimeError):
    """Another writer committed first; nothing of this write is visible."""


@dataclass(frozen=True)
class Part:
    """One part of a table: its folder under the table's, its rows, and the number of Spark
    buckets its files are named by (0: none)."""

    path: str
    rows: int
    files: int = 0


@dataclass(frozen=True)
class Commit:
    version: int
    kind: str  # plain, partitioned or bucketed
    schema: T.StructType
    parts: dict[str, Part] = field(default_factory=dict)
    key: str | None = None
    modulus: int = 1
    split: int = 0
    data: int = 0  # number of the newest data folder
    applied: tuple[str, ...] = ()  # deltas merged into the table

    @property
    def rows(self) -> int:
        return sum(p.rows for p in self.parts.values())

    @property
    def buckets(self) -> int:
        return self.modulus + self.split

    def address(self, key: Column) -> Column:
        """The bucket of a key (of the key column's type)."""
        coarse, fine = (F.pmod(F.hash(key), F.lit(m)) for m in (self.modulus, 2 * self.modulus))
        return F.when(coarse < self.split, fine).otherwise(coarse)

    def resolution(self, bucket: int) -> int:
        """What the hash is taken modulo for the keys of a bucket."""
        return 2 * self.modulus if bucket % self.modulus < self.split else self.modulus

    def grown(self, buckets: int) -> Commit:
        """The same table with at least so many buckets."""
        modulus, split = self.modulus, self.split
        while modulus + split < buckets:
            split += 1
            if split == modulus:
                modulus, split = 2 * modulus, 0
        return replace(self, modulus=modulus, split=split)

    def to_json(self) -> str:
        return json.dumps({"version": self.version, "kind": self.kind, "schema": self.schema.jsonValue(), "key": self.key,
                           "modulus": self.modulus, "split": self.split, "data": self.data,
                           "applied": list(self.applied),
                           "parts": {n: [p.path, p.rows, p.files] for n, p in self.parts.items()}})

    @staticmethod
    def from_json(text: str) -> Commit:
        d = json.loads(text)
        return Commit(d["version"], d["kind"], T.StructType.fromJson(d["schema"]),
                      {n: Part(*p) for n, p in d["parts"].items()}, d["key"], d["modulus"], d["split"], d["data"],
                      tuple(d["applied"]))


class TableStore:
    def __init__(self, spark: SparkSession, root: str, rows_per_bucket: int = ROWS_PER_BUCKET):
        self.spark, self.root, self.rows_per_bucket = spark, root.rstrip("/"), rows_per_bucket
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._Path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(self._conf)

    # --- files and commit records --------------------------------------------------------

    def _names(self, folder: str) -> list[str]:
        p = self._Path(folder)
        return [st.getPath().getName() for st in self._fs.listStatus(p)] if self._fs.exists(p) else []

    def _write_text(self, path: str, text: str) -> None:
        out = self._fs.create(self._Path(path), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def _read_text(self, path: str) -> str:
        stream = self._fs.open(self._Path(path))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def _versions(self, table: str) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names(f"{self.root}/{table}/{LOG}")
                      if n.endswith(".json") and n[:-5].isdigit())

    def current(self, table: str) -> Commit | None:
        """The newest commit record, None for a table without one."""
        versions = self._versions(table)
        return Commit.from_json(self._read_text(f"{self.root}/{table}/{LOG}/{versions[-1]:06d}.json")) if versions else None

    def _claim(self, table: str) -> int:
        """The number of a data folder that is this write's alone."""
        log = f"{self.root}/{table}/{LOG}"
        taken = [int(n[6:]) for n in self._names(log) if n.startswith("claim-")]
        n = max(taken, default=0) + 1
        while True:
            try:
                self._write_text(f"{log}/claim-{n:06d}", "")
                return n
            except Py4JJavaError as e:
                if "AlreadyExists" not in e.java_exception.getClass().getName():
                    raise
                n += 1

    def commit(self, table: str, new: Commit) -> None:
        """Make ``new`` current if its predecessor still is."""
        log = f"{self.root}/{table}/{LOG}"
        aside = f"{log}/aside-{uuid.uuid4().hex}"
        self._write_text(aside, new.to_json())
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._Path(log).toUri(), self._conf)
        none = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        absolute = self._fs.makeQualified(self._Path(f"{log}/{new.version:06d}.json"))
        try:
            context.rename(self._fs.makeQualified(self._Path(aside)), absolute, none)
        except Py4JJavaError as e:
            self._fs.delete(self._Path(aside), False)
            if "AlreadyExists" in e.java_exception.getClass().getName():
                raise ConcurrentCommit(f"version {new.version} of {table!r} was committed by another writer") from e
            raise

    def path(self, table: str, version: int) -> str:
        """The data folder of a number."""
        return f"{self.root}/{table}/v={version:06d}"

    # --- reading ---------------------------------------------------------------------------

    def _shuffle(self) -> int:
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    @contextmanager
    def _listing(self) -> Iterator[None]:
        """Folders are listed by as many tasks as a shuffle has, not by a task a folder: each
        task's result goes to the driver."""
        old = self.spark.conf.get(LISTING)
        self.spark.conf.set(LISTING, str(min(int(old), self._shuffle())))
        try:
            yield
        finally:
            self.spark.conf.set(LISTING, old)

    def version(self, table: str) -> int | None:
        now = self.current(table)
        return now.version if now else None

    def exists(self, table: str) -> bool:
        return bool(self._versions(table))

    def is_bucketed(self, table: str) -> bool:
        now = self.current(table)
        return now is not None and now.kind == "bucketed"

    def _read_parts(self, table: str, now: Commit, parts: Iterable[str]) -> DataFrame:
        paths = [f"{self.root}/{table}/{now.parts[p].path}" for p in parts]
        if not paths:
            return self.spark.createDataFrame([], now.schema)
        if now.kind != "partitioned":
            with self._listing():
                return self.spark.read.schema(now.schema).parquet(*paths)
        fields = [f for f in now.schema.fields if f.name != PARTITION]
        whole = T.StructType([*fields, T.StructField(PARTITION, T.StringType()), T.StructField("v", T.IntegerType())])
        with self._listing():
            return (self.spark.read.option("basePath", f"{self.root}/{table}").schema(whole).parquet(*paths)
                    .select(*now.schema.names))

    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame:
        """Current rows; an absent table reads as empty with ``schema`` (create-if-absent)."""
        now = self.current(table)
        if now is None:
            if schema is None:
                raise FileNotFoundError(f"table {table!r} has no committed version")
            return self.spark.createDataFrame([], schema)
        return self._read_parts(table, now, now.parts)

    def read_bucketed(self, table: str, schema: T.StructType | None = None,
                      buckets: Sequence[int] | None = None) -> DataFrame:
        """Current rows of a bucketed table (optionally of some buckets only)."""
        now = self.current(table)
        if now is None:
            return self.read(table, schema)
        wanted = now.parts if buckets is None else [str(b) for b in sorted(set(buckets)) if str(b) in now.parts]
        return self._read_parts(table, now, wanted)

    def counts(self, tables: Sequence[str]) -> DataFrame:
        """``(tabla, count)`` for the current version of each table, from the commit records (A7)."""
        rows = [(t, now.rows if (now := self.current(t)) else 0) for t in tables]
        return self.spark.createDataFrame(rows, "tabla string, count long")

    def tables(self) -> list[str]:
        """Tables with a committed version (L4)."""
        return sorted(n for n in self._names(self.root) if self._versions(n))

    def describe(self, table: str) -> DataFrame:
        """``(column, type)`` of the current version (L4)."""
        fields = self.read(table).schema.fields
        return self.spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in fields],
                                          "column string, type string")

    def bucket_rows(self, table: str) -> dict[int, int]:
        """Rows of every bucket that has any."""
        now = self.current(table)
        return {int(n): p.rows for n, p in now.parts.items()}

    def lookup(self, table: str, key: str, value) -> DataFrame:
        """Rows of one key; the equality filter is pushed down to the Parquet scan (V6).  Of a
        bucketed table only the key's bucket is read; its files are sorted by key and hold a
        Bloom filter, so row groups without the key are skipped."""
        now = self.current(table)
        if now is not None and now.kind == "bucketed":
            literal = F.lit(value).cast(now.schema[key].dataType)
            spot = self.spark.range(1).select(now.address(literal)).first()[0]
            return self.read_bucketed(table, buckets=[spot]).where(F.col(key) == literal)
        return self.read(table).where(F.col(key) == F.lit(value))

    def vacuum(self, table: str) -> int:
        """Remove data folders, or parts of them, that hold nothing current, and their records.
        Folders newer than the current version's (a write under way) stay.  Returns how many
        whole data folders went."""
        now = self.current(table)
        if now is None:
            return 0
        base, used, gone = f"{self.root}/{table}", {p.path for p in now.parts.values()}, 0
        for name in self._names(base):
            if not name.startswith("v=") or int(name[2:]) > now.data:
                continue
            if not any(u == name or u.startswith(f"{name}/") for u in used):
                self._fs.delete(self._Path(f"{base}/{name}"), True)
                gone += int(name[2:]) < now.data
            elif name not in used:
                for part in self._names(f"{base}/{name}"):
                    if "=" in part and f"{name}/{part}" not in used:
                        self._fs.delete(self._Path(f"{base}/{name}/{part}"), True)
        for v in self._versions(table)[:-1]:
            self._fs.delete(self._Path(f"{base}/{LOG}/{v:06d}.json"), False)
        return gone

    # --- plain and partitioned tables --------------------------------------------------------

    def _next(self, table: str, kind: str, schema: T.StructType) -> Commit:
        now = self.current(table)
        if now is None:
            return Commit(1, kind, schema)
        if now.kind != kind:
            raise ValueError(f"table {table!r} was created {'without buckets' if kind == 'bucketed' else now.kind}; "
                             "its layout cannot change in place")
        return replace(now, version=now.version + 1)

    def write(self, table: str, df: DataFrame) -> DataFrame:
        """Write ``df`` as the next version of a plain table and return it read back."""
        new, n = self._next(table, "plain", df.schema), self._claim(table)
        df.write.mode("errorifexists").parquet(self.path(table, n))
        out = self.spark.read.parquet(self.path(table, n))
        self.commit(table, replace(new, schema=df.schema, data=n, parts={"": Part(f"v={n:06d}", out.count())}))
        return out

    def write_partition(self, table: str, rows: DataFrame, batch_id: str) -> None:
        """Make ``rows`` all there is of the batch, none included."""
        schema = T.StructType([*rows.drop(PARTITION).schema.fields, T.StructField(PARTITION, T.StringType())])
        new, n = self._next(table, "partitioned", schema), self._claim(table)
        part = f"v={n:06d}/{PARTITION}={batch_id}"
        rows.drop(PARTITION).write.mode("errorifexists").parquet(f"{self.root}/{table}/{part}")
        count = self.spark.read.parquet(f"{self.root}/{table}/{part}").count()  # from the footers
        self.commit(table, replace(new, data=n, parts={**new.parts, f"{PARTITION}={batch_id}": Part(part, count)}))

    def upsert(self, table: str, batch: DataFrame, key: str, order: str,
               columns: Sequence[str], insert_only: Sequence[str] = (),
               schema: T.StructType | None = None, buckets: int | None = None) -> DataFrame:
        """Keyed upsert into a new version; returns the one-row evidence DataFrame.
        A bucketed table (or ``buckets`` given for a new one) rewrites touched buckets only."""
        if buckets or self.is_bucketed(table):
            return self.upsert_bucketed(table, batch, key, order, columns, insert_only, buckets=buckets)
        target = self.read(table, schema or batch.select(*columns).schema)
        merged = U.merge_plan(target, batch, key, order, columns, insert_only)
        _, counts = U.observed_write(merged, lambda df: self.write(table, df))
        return U.evidence_row(self.spark, table, *counts)

    # --- bucketed tables ---------------------------------------------------------------------

    def _bucketed_scan(self, table: str, now: Commit, parts: Sequence[str], made: list[str]) -> DataFrame:
        """Parts whose files share one number of Spark buckets, as a temporary bucketed table of
        the session: a join on the key needs no exchange of it.  ``made`` takes its name."""
        name, files = f"lodestone_{uuid.uuid4().hex}", now.parts[parts[0]].files
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in now.schema.fields)
        self.spark.sql(f"CREATE TABLE {name} ({columns}, {BUCKET} int) USING parquet PARTITIONED BY ({BUCKET}) "
                       f"CLUSTERED BY (`{now.key}`) SORTED BY (`{now.key}`) INTO {files} BUCKETS "
                       f"LOCATION '{self.root}/{table}/{LOG}/none'")
        made.append(name)
        for i in range(0, len(parts), 500):
            spots = " ".join(f"PARTITION ({BUCKET}={p}) LOCATION '{self.root}/{table}/{now.parts[p].path}'"
                             for p in parts[i:i + 500])
            self.spark.sql(f"ALTER TABLE {name} ADD {spots}")
        return self.spark.table(name).drop(BUCKET)

    def _tasks(self, files: int, rows: int) -> int:
        """How many tasks write ``files`` Spark buckets: a divisor or a multiple of them."""
        shuffle = self._shuffle()
        few, most = min(shuffle, rows // ROWS_PER_TASK[0]), max(shuffle, rows // ROWS_PER_TASK[1])
        tasks = files
        while tasks % 2 == 0 and tasks // 2 >= most:
            tasks //= 2
        while 2 * tasks <= few:
            tasks *= 2
        return tasks

    def _target(self, table: str, now: Commit, parts: Sequence[str], tasks: int, made: list[str]) -> tuple[DataFrame, int]:
        """(rows of parts whose files share one number of Spark buckets, dealt by key to how many
        tasks): the Spark buckets as they lie, if they are about as many as the tasks are to be."""
        files, shuffle = now.parts[parts[0]].files, self._shuffle()
        if min(tasks, shuffle) <= files <= 4 * shuffle:
            return self._bucketed_scan(table, now, parts, made), files
        return self._read_parts(table, now, parts).repartition(tasks, now.key), tasks

    def _rewrite(self, table: str, now: Commit, new: Commit, keys: DataFrame, tasks: int, joined, made: list[str]):
        """Rewrite the buckets that ``keys`` touch and those that split.  ``joined(target, own,
        tasks)`` gives the new rows of a part of the table (None: of no part), which is dealt by
        key to so many tasks and stays so; ``own`` is a filter for the keys that belong to it.
        Returns the rows and the names of the parts they replace."""
        key = F.col(now.key)
        touched = {str(r[0]) for r in keys.select(now.address(key)).distinct().collect()}  # at most one a bucket
        split = {b for b in now.parts if new.resolution(int(b)) != now.resolution(int(b))}
        old = sorted((touched & set(now.parts)) | split, key=int)
        groups: dict[int, list[str]] = {}
        for b in old:
            groups.setdefault(now.parts[b].files, []).append(b)
        out, absent = None, F.lit(True)
        for parts in groups.values():
            own = now.address(key).isin([int(b) for b in parts])
            absent = absent & ~own
            target, dealt = self._target(table, now, parts, tasks, made)
            rows = joined(target, own, dealt)
            out = rows if out is None else out.unionByName(rows)
        if out is None or touched - set(now.parts):
            rows = joined(None, absent, tasks)
            out = rows if out is None else out.unionByName(rows)
        return out, old

    def _write_buckets(self, table: str, rows: DataFrame, new: Commit, n: int, keys: int, tasks: int) -> dict[str, Part]:
        """Write rows as Spark buckets in store buckets; the parts written.  ``keys`` is about how
        many a file holds: without it every file's Bloom filter takes a megabyte.  There are as
        many Spark buckets as tasks where those are more: as many files, and the next upsert joins
        them where they lie."""
        name = f"lodestone_{uuid.uuid4().hex}"
        files = max(2 * new.modulus, tasks)
        with self._listing():
            try:
                (rows.withColumn(BUCKET, new.address(F.col(new.key))).write.mode("errorifexists")
                 .option("path", self.path(table, n)).option("compression", "zstd").option(f"parquet.bloom.filter.enabled#{new.key}", "true")
                 .option(f"parquet.bloom.filter.expected.ndv#{new.key}", str(keys))
                 .partitionBy(BUCKET).bucketBy(files, new.key).sortBy(new.key).format("parquet").saveAsTable(name))
            finally:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            written = [x for x in self._names(self.path(table, n)) if x.startswith(f"{BUCKET}=")]
            if not written:
                return {}
            whole = T.StructType([*new.schema.fields, T.StructField(BUCKET, T.IntegerType())])
            sizes = (self.spark.read.schema(whole).parquet(self.path(table, n)).groupBy(BUCKET)
                     .agg(F.count(F.lit(1)).alias("n")).collect())  # one row a bucket
        return {str(r[BUCKET]): Part(f"v={n:06d}/{BUCKET}={r[BUCKET]}", r["n"], files) for r in sizes}

    @staticmethod
    def _keys_a_file(new: Commit, rows: int, tasks: int) -> int:
        """Keys of a file at most, about: an unsplit bucket has two files of the mean's size, and
        a table that has few Spark buckets a file of each task."""
        return max(1, -(-2 * rows // max(new.buckets, tasks)))

    def _bucketed(self, table: str, key: str, schema: T.StructType, buckets: int | None) -> tuple[Commit, bool]:
        """(the current state, whether it is committed)."""
        known = self.exists(table)
        state = self._next(table, "bucketed", schema)
        if not known:
            state = replace(state, version=0, key=key, modulus=buckets or 1)
        else:
            state = replace(state, version=state.version - 1)
        return state, known

    def _finish(self, table: str, now: Commit, new: Commit, n: int, gone: Sequence[str], made: dict[str, Part]) -> None:
        kept = {b: p for b, p in now.parts.items() if b not in set(gone)}
        self.commit(table, replace(new, version=now.version + 1, data=n, parts={**kept, **made}))

    def upsert_bucketed(self, table: str, batch: DataFrame, key: str, order: str,
                        columns: Sequence[str], insert_only: Sequence[str] = (),
                        buckets: int | None = None, wide: DataFrame | None = None) -> DataFrame:
        """Keyed upsert that rewrites only the buckets touched by the batch, and those that split
        because the table outgrows ``rows_per_bucket``; returns the evidence row.  ``buckets``
        is the number a new table begins with (1).  An empty first batch creates the table
        without rows.  A null key is an error, as it would be another row in every rerun.
        ``wide`` has the key and the columns that the batch has not, one row a key at most (long
        texts, say): they join the batch where it is written, and are dealt only there."""
        given = {f.name: f for f in (*(wide.schema.fields if wide is not None else ()), *batch.schema.fields)}
        now, known = self._bucketed(table, key, T.StructType([given[c] for c in columns]), buckets)
        kind = now.schema[key].dataType
        present = [c for c in columns if c != key and c in batch.columns]
        batch = batch.withColumn(key, F.col(key).cast(kind))
        with Scratch(self.spark) as scratch:
            # one row a key, written: the batch's plan runs once
            one = U.collapse_batch(batch, key, order, [c for c in present if c not in insert_only],
                                   [c for c in present if c in insert_only])
            one = scratch.keep(one)
            size = one.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(key).isNull()).alias("nulls")).first()
            if size["nulls"]:
                raise ValueError(f"a record for table {table!r} has no {key}")
            if known and not size["n"]:
                return U.evidence_row(self.spark, table, now.rows, now.rows, 0)
            total = now.rows + size["n"]
            new = now.grown(-(-total // self.rows_per_bucket))
            tasks, n, made = self._tasks(2 * new.modulus, total), self._claim(table), []

            def joined(target: DataFrame | None, own: Column, dealt: int) -> DataFrame:
                mine = one.where(own).repartition(dealt, key) if wide is None else U.dealt_with(
                    one.where(own), wide.withColumn(key, F.col(key).cast(kind)).where(own), key, dealt)
                return U.new_rows(mine, key, columns) if target is None else U.merge_collapsed(
                    target, mine, key, columns, insert_only)

            try:
                rows, gone = self._rewrite(table, now, new, one, tasks, joined, made)
                parts, (before, after, records) = U.observed_write(rows, lambda df: self._write_buckets(
                    table, df, new, n, self._keys_a_file(new, total, tasks), tasks))
            finally:
                for name in made:
                    self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._finish(table, now, new, n, gone, parts)
        return U.evidence_row(self.spark, table, now.rows, now.rows + after - before, records)

    def merge_delta(self, table: str, delta: DataFrame, key: str, name: str,
                    merge: Callable[[Sequence[DataFrame], str], DataFrame]) -> bool:
        """Merge a delta into a table of mergeable state: ``merge([now, delta], key)`` gives the
        new rows of the delta's keys, and only their buckets are rewritten.  The delta's ``name``
        is committed with the rows, so a delta that is applied again changes nothing (False)."""
        now = self.current(table)
        if now is not None and name in now.applied:
            return False
        delta = cut_lineage(delta)
        old = self.read(table, delta.schema)
        if now is not None:
            keys = delta.select(key).distinct()
            spots = [r[0] for r in keys.select(now.address(F.col(key).cast(now.schema[key].dataType))).distinct().collect()]
            old = self.read_bucketed(table, buckets=spots).join(keys, key, "left_semi")
        self.replace_keys(table, merge([old, delta], key).select(*delta.columns), key, applied=name, base=now)
        return True

    def replace_keys(self, table: str, rows: DataFrame, key: str, gone: DataFrame | None = None,
                     applied: str | None = None, base: Commit | None = None) -> None:
        """Replace all rows of the keys in ``rows`` (and of ``gone``) of a bucketed table that
        holds any number of rows per key; only touched and split buckets are rewritten.
        ``applied`` is a name to commit with them; ``base`` the version they derive from."""
        now, _ = self._bucketed(table, key, rows.schema, None)
        if base is not None and base.version != now.version:
            raise ConcurrentCommit(f"{table!r} is no longer at version {base.version}")
        if applied is not None:
            now = replace(now, applied=(*now.applied, applied))
        with Scratch(self.spark) as scratch:
            rows = scratch.keep(rows.select(*now.schema.names))
            keys = rows.select(key) if gone is None else rows.select(key).unionByName(gone.select(key))
            keys = scratch.keep(keys.select(F.col(key).cast(now.schema[key].dataType).alias(key)).distinct())
            if keys.where(F.col(key).isNull()).limit(1).count():
                raise ValueError(f"a record for table {table!r} has no {key}")
            total = now.rows + rows.count()
            new = now.grown(-(-total // self.rows_per_bucket))
            tasks, n, made = self._tasks(2 * new.modulus, total), self._claim(table), []

            def joined(target: DataFrame | None, own: Column, dealt: int) -> DataFrame:
                fresh = rows.where(own).repartition(dealt, key)  # a bucket's rows meet in one task
                return fresh if target is None else target.join(keys, key, "left_anti").select(
                    *now.schema.names).unionByName(fresh)

            try:
                out, old = self._rewrite(table, now, new, keys, tasks, joined, made)
                parts = self._write_buckets(table, out, new, n, self._keys_a_file(new, total, tasks), tasks)
            finally:
                for name in made:
                    self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._finish(table, now, new, n, old, parts)
