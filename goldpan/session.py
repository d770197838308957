"""Session settings and the scratch folder that jobs share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_TARGET_PARTITION_BYTES = 128 * 1024 * 1024
_MANY_PARTITIONS, _MOST_PARTITIONS = 5_000, 20_000
_local_scratch: str | None = None


def build_session(
    app: str = "goldpan", input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with the settings the jobs are written for.

    ``input_bytes`` sizes the shuffle, see :func:`shuffle_partitions`; AQE merges
    small partitions, so a small input does not run thousands of empty tasks.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if input_bytes is not None:
        partitions = shuffle_partitions(input_bytes)
        # the first for what sizes itself by it without AQE, as ranges of token files do
        for key in (
            "spark.sql.shuffle.partitions",
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
        ):
            builder = builder.config(key, str(partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions(input_bytes: int) -> int:
    """About one partition per 128 MB, and fewer, larger ones for very large inputs.

    A shuffle has as many blocks as map tasks times partitions, and the driver keeps
    a size for each: beyond some thousands, partitions grow with the input's square
    root, up to a bound, and what does not fit into memory is sorted on disk.
    """
    wanted = -(-input_bytes // _TARGET_PARTITION_BYTES)
    if wanted > _MANY_PARTITIONS:
        wanted = int((wanted * _MANY_PARTITIONS) ** 0.5)
    return max(8, min(wanted, _MOST_PARTITIONS))


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, empty path under the shared folder named by ``spark.checkpoint.dir``.

    Paths are grouped by application, so that a finished one's can be removed.
    Only a local master, where driver and executors share one disk, may fall
    back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that all executors can reach"
            )
        base = _local_base()
    application = spark.sparkContext.applicationId
    return f"{base.rstrip('/')}/goldpan/{application}/{purpose}-{uuid.uuid4().hex}"


def _local_base() -> str:
    global _local_scratch
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="goldpan-")
        atexit.register(shutil.rmtree, _local_scratch, ignore_errors=True)
    return _local_scratch
