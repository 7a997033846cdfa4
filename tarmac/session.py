"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators are written for.  Widths are left to AQE: the
# initial partition count only has to be high enough, AQE merges what is small
# and splits what is skewed.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # lets AQE drop the sort of the big side when every partition of the small
    # side fits; a plan without the hint falls back to sort-merge and spills
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HotSpot never compiles a method of more bytes; Spark cuts such a stage into small methods instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


PARTITION_BYTES = 192 * 1024**2


def shuffle_width(input_bytes: int, cores: int) -> int:
    """Shuffle partitions to start with for an input of this size.

    About 192 MB per partition, so one fits in a task's memory; at least two
    waves of cores.  AQE merges what turns out smaller.
    """
    return max(2 * cores, -(-input_bytes // PARTITION_BYTES))


def build_session(
    app_name: str = "tarmac",
    master: str | None = None,
    input_bytes: int | None = None,
    cores: int = 1,
    **conf: str,
) -> SparkSession:
    """A session with ``SETTINGS``; ``conf`` overrides them key by key.

    ``input_bytes`` is the largest table a job shuffles; it sets the width AQE
    starts from.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    sized = {}
    if input_bytes is not None:
        sized["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(shuffle_width(input_bytes, cores))
    for key, value in {**SETTINGS, **sized, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def wide(rows: DataFrame) -> DataFrame:
    """``rows``, in a session that gives up generated methods HotSpot would only interpret.

    Expressions over some dozen columns make one such method, which runs several
    times slower.  A runtime setting, for sessions that were not built here.
    """
    limit = "spark.sql.codegen.hugeMethodLimit"
    conf = rows.sparkSession.conf
    if int(conf.get(limit)) > int(SETTINGS[limit]):
        conf.set(limit, SETTINGS[limit])
    return rows


@contextmanager
def settings(spark: SparkSession, wanted: Mapping[str, str]) -> Iterator[None]:
    """Runtime settings for what runs inside, and the former ones after it."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a ``local`` master may go without the setting; it then gets a folder of
    its own, since driver and executors share one machine, and that folder goes
    when the process ends.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tarmac-")
        atexit.register(shutil.rmtree, _local_folders[app], ignore_errors=True)
    return _local_folders[app]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable; a named folder is left as it is."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete what a load needs no longer, in whatever store Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
