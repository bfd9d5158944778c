"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_LOCAL_SCRATCH: list[str] = []

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Long texts travel to Python workers in Arrow batches: bound them by bytes.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Stream state on local disk with its changes in the checkpoint, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # A repeated key in a JSON payload is legal there; the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build_session(master: str | None = None, app: str = "signpost", **extra: str) -> SparkSession:
    """A session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application.

    Not needed where the package is installed on the executors or submitted
    with the job, and harmless there.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="signpost-"), "signpost-package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes made here remove their shuffle files when they end.

    Else these stay until the driver happens to collect its garbage.
    """
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_DROP_SHUFFLES, before) if before is not None else spark.conf.unset(_DROP_SHUFFLES)


def materialize(rows: DataFrame, label: str) -> DataFrame:
    """Write `rows` as a table in the shared scratch folder and read that.

    For results used more than once: later steps read files instead of computing
    again, and a lost executor costs only a re-read.
    """
    return _written(rows, scratch_dir(rows.sparkSession, label))


def _written(rows: DataFrame, path: str) -> DataFrame:
    with shuffles_dropped(rows.sparkSession):
        rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


class Scratch:
    """Tables that are removed as soon as what was made of them is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def folder(self, label: str) -> str:
        self.paths.append(scratch_dir(self.spark, label))
        return self.paths[-1]

    def materialize(self, rows: DataFrame, label: str) -> DataFrame:
        return _written(rows, self.folder(label))

    def drop(self) -> None:
        """Remove them; no frame that reads them may be used later."""
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in self.paths:
            where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)
        self.paths = []


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder.

    Only a local session without that setting (tests) gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        if not _LOCAL_SCRATCH:
            _LOCAL_SCRATCH.append(tempfile.mkdtemp(prefix="signpost-"))
        base = _LOCAL_SCRATCH[0]
    return f"{base.rstrip('/')}/signpost/{label}-{uuid.uuid4().hex}"
