"""Session construction and cluster-aware helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on.  UTC keeps timestamps comparable with naive
# timestamps of other engines; AQE re-plans joins and coalesces partitions at
# run time; dynamic partition overwrite makes partitioned rewrites idempotent.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "lodestone",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # Runtime SQL confs also apply when the session already existed.
    for k, v in conf.items():
        if k.startswith("spark.sql.") and k != "spark.sql.warehouse.dir":
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf of an existing session
                pass
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local-mode session without one (tests) gets a fresh scratch folder; on a
    cluster the setting is required and the configured shared folder is used.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder on shared storage "
                           "(a machine-local folder does not survive executor loss)")
    local = tempfile.mkdtemp(prefix="lodestone-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def cut_lineage(df, eager: bool = True):
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder and read it
    back: one job (``Dataset.checkpoint`` would compute the plan twice unless cached),
    columnar and compressed, and it survives the loss of any executor."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SPLIT = "spark.sql.files.maxPartitionBytes"
SPLIT_MB = 32


def _megabytes(size: str) -> float:
    number, unit = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)b?\s*", size.lower()).groups()
    return int(number) * 1024.0 ** ("kmgtp".find(unit) - 1 if unit else -2)


class Scratch:
    """Intermediate tables of one piece of work: ``keep`` writes one into the shared checkpoint
    folder and reads it back, ``drop`` deletes those that nothing reads any more, and the end of
    the ``with`` block deletes the rest, also after an error.  In the block a query's shuffle
    files go when it ends, not when the driver collects its garbage, so the work holds on disk
    what it still needs and not all that it ever wrote.  The tables are compressed more closely
    than ``cut_lineage``'s, so a task reads ``SPLIT_MB`` of files at most: what that unpacks to
    is sorted in memory."""

    def __init__(self, spark: SparkSession):
        self.spark, self._made, self._before = spark, [], {}

    def __enter__(self) -> Scratch:
        conf = self.spark.conf
        self._before = {c: conf.get(c, None) for c in (SHUFFLE_CLEANUP, SPLIT)}
        conf.set(SHUFFLE_CLEANUP, "true")
        if _megabytes(conf.get(SPLIT)) > SPLIT_MB:
            conf.set(SPLIT, f"{SPLIT_MB}m")
        return self

    def __exit__(self, *_) -> None:
        for c, value in self._before.items():
            if value is None:
                self.spark.conf.unset(c)
            else:
                self.spark.conf.set(c, value)
        self.drop(*(df for df, _ in self._made))

    def keep(self, df: DataFrame) -> DataFrame:
        path = f"{checkpoint_dir(self.spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
        out = None
        try:
            df.write.option("compression", "zstd").parquet(path)
            out = self.spark.read.parquet(path)
        finally:
            if out is None:
                delete_folder(self.spark, path)
        self._made.append((out, path))
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that ``keep`` returned."""
        gone = [(df, path) for df, path in self._made if any(df is t for t in tables)]
        self._made = [m for m in self._made if not any(m[0] is t for t in tables)]
        for _, path in gone:
            delete_folder(self.spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage, if it is there."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers (as ``--py-files``
    would): zip its modules once per application and ``addPyFile`` the archive.
    Called before every stage that runs Python code on executors."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(pkg_dir)
    archive = os.path.join(tempfile.mkdtemp(prefix="lodestone-pkg-"), "lodestone.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, base))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)
