"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import reviewlab

# Settings a cluster job should start with; the caller may override any of them.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def session(app: str = "reviewlab", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a cluster a
    machine-local folder would be lost with its executor, so the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", "") or None
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="reviewlab-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


# The paths that each application was given below its shared folder, in order.
_given: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; who writes there removes it, or a ``scratch`` block."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _given.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on any file system that Spark can write to; none there is no error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    given = _given.get(spark.sparkContext.applicationId, [])
    if path in given:
        given.remove(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove at its end what is written to scratch paths inside the block, also after an error.

    Tables between steps are read by the results that were made from them, so these have to be
    written or collected before the block ends.
    """
    application = spark.sparkContext.applicationId
    before = set(_given.get(application, []))
    try:
        yield
    finally:
        for path in [p for p in _given.get(application, []) if p not in before]:
            remove(spark, path)


# -- code that tasks import -------------------------------------------------------------------

_shipped: set[str] = set()

# Arrow batches hold at most about this many bytes, as two or more copies of one are in memory.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def shipped(df: DataFrame) -> DataFrame:
    """Give the executors this package's code, which the functions sent to them import.

    Larger Arrow batches than ``BATCH_BYTES`` are made smaller; a lower setting stays.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if _bytes(spark.conf.get(BATCH)) > BATCH_BYTES:
        spark.conf.set(BATCH, str(BATCH_BYTES))
    if context.applicationId not in _shipped:
        root = Path(reviewlab.__file__).parent
        archive = Path(tempfile.mkdtemp()) / "reviewlab.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for file in sorted(root.rglob("*.py")):
                z.write(file, file.relative_to(root.parent))
        context.addPyFile(str(archive))  # served by the driver; no executor reads this folder
        _shipped.add(context.applicationId)
    return df


def _bytes(setting: str) -> int:
    """A size as Spark writes it, in bytes: 67108864, 67108864b, 64m, 64MB."""
    number = setting.strip().lower().rstrip("b")
    unit = "kmgt".find(number[-1]) + 1
    return int(number[:-1] if unit else number) << (10 * unit)
