"""Steps of a run that are done stay done.

A step's entry holds a fingerprint of its inputs and parameters, taken before it began, and
one of what it has left. A later run skips the step while both still hold. A step that is
redone leaves new files, so the steps that read them are redone as well, and no others.
Fingerprints come from file listings; no contents are read. After a change of the code that
a step runs, start with a new ledger.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from goldpan.sources.storage import delete_path, path_exists, read_text, write_new_text


def fingerprint(spark: SparkSession, path: str) -> list | None:
    """Number, bytes and a hash of the files below a path; None if there is nothing."""
    if not path_exists(spark, path):
        return None
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    code = F.xxhash64("path", "length", "modificationTime").cast("decimal(28,0)")
    found = files.agg(F.count("*"), F.sum("length"), F.sum(code).cast("string")).first()
    return list(found)


class Ledger:
    """Entries of finished steps in a folder that all runs share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def step(
        self,
        name: str,
        work: Callable[[], object],
        inputs: Callable[[], Sequence[str]],
        output: Callable[[], str | None],
        *parameters: object,
    ) -> Callable[[], None]:
        """``work`` as a step that runs unless its entry says that nothing has changed.

        ``inputs`` and ``output`` are asked when the step starts and ends. Inputs that are
        not there leave the decision to ``work``.
        """

        def run() -> None:
            before = [fingerprint(self.spark, path) for path in inputs()]
            key = json.loads(json.dumps([before, list(inputs()), repr(parameters)]))
            if None not in before and self._holds(name, key, output()):
                return
            delete_path(self.spark, self._path(name))
            work()
            entry = {"key": key, "output": self._state(output())}
            write_new_text(self.spark, self._path(name), json.dumps(entry) + "\n")

        return run

    def _path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def _state(self, output: str | None) -> list | None:
        return output and [output, fingerprint(self.spark, output)]

    def _holds(self, name: str, key: list, output: str | None) -> bool:
        if output is None or not path_exists(self.spark, self._path(name)):
            return False
        text = read_text(self.spark, self._path(name))
        if not text.endswith("\n"):
            return False  # the run died while it wrote the entry
        entry = json.loads(text)
        state = self._state(output)
        return state[1] is not None and entry == {"key": key, "output": state}
