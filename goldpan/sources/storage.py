"""Versions of output folders, published by a manifest and never by a rename.

A write adds part files to the dataset's own folder, all with the name of their write job.
Then one small file, the manifest, lists them: from that moment on readers take these files
and no others. Its name rises with time and its last line tells that it is complete, so a
manifest that is cut short counts for nothing, on file systems and object stores alike. At
last what the manifest does not list is deleted. Whatever step fails, readers find the old
version or the new one; what a dead write leaves behind is deleted by the next one.

Readers of this package resolve manifests (:func:`reading_options`). Others see the folder's
part files, which are those of one version but for the time between write and cleaning.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

_MANIFEST = "_goldpan-manifest-"
_COMPLETE = "complete"
# Fixed value: how Spark names the files of a write job
_JOB = re.compile(r"part-\d+-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})")


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _resolve(spark, path)
    return fs.exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.delete(target, True)


def list_children(spark: SparkSession, path: str) -> list[str]:
    fs, target = _resolve(spark, path)
    if not fs.exists(target):
        return []
    return [status.getPath().toString() for status in fs.listStatus(target)]


def read_text(spark: SparkSession, path: str) -> str:
    fs, source = _resolve(spark, path)
    stream = fs.open(source)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new_text(spark: SparkSession, path: str, text: str) -> None:
    """Make a file that must not be there yet."""
    fs, target = _resolve(spark, path)
    stream = fs.create(target, False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()


def part_files(spark: SparkSession, folder: str) -> set[str]:
    """Names of the part files in ``folder``: listed by Spark and handed over as one text."""
    if not path_exists(spark, folder):
        return set()
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    join = spark.sparkContext._jvm.org.apache.hadoop.util.StringUtils.join
    paths = join("\n", listed._jdf.inputFiles())
    return {path.rpartition("/")[2] for path in paths.split("\n") if path}


def write_job(name: str) -> str | None:
    """The write job that a part file's name tells."""
    match = _JOB.match(name)
    return match and match[1]


def _manifests(spark: SparkSession, folder: str) -> list[str]:
    """Names of a folder's manifests, the latest first."""
    fs, pattern = _resolve(spark, f"{folder.rstrip('/')}/{_MANIFEST}*")
    found = fs.globStatus(pattern) or []
    return sorted((status.getPath().getName() for status in found), reverse=True)


def current_version(spark: SparkSession, folder: str) -> list[str] | None:
    """Part files of the folder's published version; None for a folder without a manifest."""
    for name in _manifests(spark, folder):
        text = read_text(spark, f"{folder.rstrip('/')}/{name}")
        listed, _, end = text.rpartition("\n")
        if end == _COMPLETE:
            return json.loads(listed)["files"]
    return None


def reading_options(spark: SparkSession, path: str) -> dict[str, str]:
    """What a reader of ``path`` needs to see one whole version and nothing else."""
    if re.search(r"[*?{\[]", path):
        return {}
    files = current_version(spark, path)
    if files is None:
        return {}
    missing = set(files) - part_files(spark, path)
    if missing:
        raise OSError(f"{path} lacks {len(missing)} of {len(files)} files, such as {min(missing)}")
    jobs = {job for job in map(write_job, files) if job}
    return {"pathGlobFilter": f"part-*{{{','.join(sorted(jobs))}}}*"} if jobs else {}


def publish(
    spark: SparkSession, target: str, write: Callable[[str], None], add: bool = False
) -> None:
    """Run ``write``, which appends part files to ``target``, and make them its version.

    An earlier version stays readable until the manifest is there, and for good when
    ``write`` fails. A job may replace the folder that it reads from. With ``add`` the new
    version holds the earlier one's files as well, which are not written again.
    """
    fs, path = _resolve(spark, target)
    target = path.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString().rstrip("/")
    there = path_exists(spark, target)
    before = part_files(spark, target)
    try:
        write(target)
    except BaseException:
        if there:
            _delete(spark, target, part_files(spark, target) - before)
        else:
            delete_path(spark, target)
        raise
    files = part_files(spark, target) - before
    if add and there:
        earlier = current_version(spark, target)
        files |= before if earlier is None else set(earlier)
    files = sorted(files)
    name = f"{_MANIFEST}{time.time_ns():020d}-{uuid.uuid4().hex}"
    text = json.dumps({"files": files})
    write_new_text(spark, f"{target}/{name}", f"{text}\n{_COMPLETE}")
    # the latest manifest stands alone before the files of others go
    _delete(spark, target, {old for old in _manifests(spark, target) if old < name})
    _delete(spark, target, part_files(spark, target) - set(files))


def _delete(spark: SparkSession, folder: str, names: set[str]) -> None:
    for name in names:
        delete_path(spark, f"{folder}/{name}")
