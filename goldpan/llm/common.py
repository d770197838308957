"""Helpers that the operators share: slices of Arrow batches, word codes, scratch tables."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.session import scratch_dir

SLICE_BYTES = 2 << 20
CACHE_ENTRIES = 80_000


def slices(
    batches: Iterable[pa.RecordBatch], by: str, size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that column ``by`` has about ``size`` bytes, one row at least.

    A column of numbers gives each row's bytes itself.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(by)
        lengths = column if pa.types.is_integer(column.type) else pc.binary_length(column)
        lengths = pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64))
        first = 0
        while first < batch.num_rows:
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + size, side="right")))
            yield batch.slice(first, last - first)
            first = last


def whole(batch: pa.RecordBatch, column: str) -> pa.Array:
    """A text column with null read as empty."""
    return pc.fill_null(batch.column(column), "")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (the finaliser of splitmix64)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Cache(dict):
    """A dictionary of bounded size, in two generations: a worker's memory stays bounded.

    When it is full, it becomes the old generation and starts anew; what is asked for
    again comes back from there.
    """

    def __init__(self) -> None:
        super().__init__()
        self.old: dict = {}

    def missing(self, keys: list, entries: int = CACHE_ENTRIES) -> list:
        """Makes room, brings old entries of ``keys`` back, returns the keys without one."""
        if len(self) > entries:
            self.old = dict(self)
            self.clear()
        unknown = set(keys).difference(self)
        back = unknown.intersection(self.old)
        for key in back:
            self[key] = self.old[key]
        return list(unknown - back)


def task(*caches: Cache) -> Callable:
    """Makes a function over a task's batches leave nothing behind in its worker.

    Python workers outlive their tasks and wait beside other stages' workers. At the end of
    a task its caches are emptied, and Arrow's pool and the allocator give their free memory
    back to the system.
    """

    def wrap(function):
        @functools.wraps(function)
        def run(batches):
            try:
                yield from function(batches)
            finally:
                for cache in caches:
                    cache.clear()
                    cache.old = {}
                gc.collect()
                pa.default_memory_pool().release_unused()
                trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
                if trim is not None:
                    trim(0)

        return run

    return wrap


known_words = Cache()


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text, one after the other, and where each text's begin.

    Words are runs without white space, in lower case, without the characters at
    their ends and inside that are neither letters nor digits; what is then empty is no word.
    """
    lists = pc.utf8_split_whitespace(pc.utf8_lower(texts))
    coded = pc.dictionary_encode(lists.flatten())
    distinct = coded.dictionary.to_pylist()
    for word in known_words.missing(distinct):
        known_words[word] = _word_hash(word)
    known = list(map(known_words.__getitem__, distinct))
    hashes = np.array(known, dtype=np.uint64)[coded.indices.to_numpy(zero_copy_only=False)]
    counts = np.diff(lists.offsets.to_numpy(zero_copy_only=False)).astype(np.int64)
    kept = hashes != 0
    owner = np.repeat(np.arange(len(counts)), counts)[kept]
    return hashes[kept], np.searchsorted(owner, np.arange(len(counts) + 1))


def _word_hash(word: str) -> int:
    """0 for a string without letters and digits."""
    core = word if word.isalnum() else "".join(filter(str.isalnum, word))
    return (xxhash.xxh3_64_intdigest(core) or 1) if core else 0


def hash_share(place: Column, share: float) -> Column:
    """Whether the 64-bit hash ``place`` lies in the least ``share`` of its whole range.

    Compared as a 64-bit number: a share of one in many billions is still more than none.
    """
    last = min((1 << 63) - 1, int(share * 2.0**64) - (1 << 63))
    return place <= F.lit(last).cast("long")


def saved(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written below the shared folder and read back: later steps start from files."""
    path = scratch_dir(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")
