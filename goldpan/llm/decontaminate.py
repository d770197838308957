"""Operator 3, benchmark decontamination by q-gram lemma filtering.

Texts and items are read as their letters and digits, in lower case. An item is cut
into overlapping segments of ``SEGMENT`` characters (a shorter item is one segment). By
the q-gram lemma a region within ``k`` edits of a segment of ``n`` characters shares at
least ``n - q + 1 - k q`` q-grams with it, on diagonals that differ by at most ``k``.
Shared q-grams are counted in diagonal bands of width ``2 k + 2`` that overlap by half, so
that such a region lies in one band as a whole. Bands that reach the bound are verified
by banded alignment: a segment found within its edit budget is a leak.

The benchmark is a stated query set. It is held against all documents in blocks of at
most ``BLOCK_CHARS`` characters, whose index is broadcast; an item lies in one block.

Defined results: null and empty texts and items hold nothing; an item of fewer than
``q`` letters and digits is too short to tell a leak by and is not looked for; repeated documents and items are all reported;
nulls in other columns and clashing names have no effect; with an empty benchmark nothing
is found.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_type

from goldpan.llm.bpe import _once
from goldpan.llm.common import slices, whole

Q = 8
SEGMENT = 96
STEP = 48
EDIT_RATE = 0.08
BLOCK_CHARS = 4_000_000
_BITS = 22
_MATCHES = 1_000_000
_SHIFT = 1 << 20  # keeps diagonals positive
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For each code up to U+FFFF: whether it is a letter or digit, and its lower case."""
    letter = np.zeros(1 << 16, bool)
    lower = np.arange(1 << 16, dtype=np.uint32)
    for code in range(1 << 16):
        char = chr(code)
        letter[code] = char.isalnum()
        small = char.lower()
        if len(small) == 1:
            lower[code] = ord(small)
    return letter, lower


def normal_form(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case letters and digits of all texts, their places there, text bounds of both.

    Codes above U+FFFF are kept as they are.
    """
    letter, lower = _once(("tables",), _tables)
    bounds = np.cumsum([0, *map(len, texts)])
    joined = "".join(texts).encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(joined, np.uint32)
    low = np.minimum(codes, 0xFFFF)
    places = np.flatnonzero(letter[low] | (codes > 0xFFFF))
    codes = codes[places]
    if codes.max(initial=0) > 0xFFFF:
        codes = np.where(codes > 0xFFFF, codes, lower[np.minimum(codes, 0xFFFF)])
    else:
        codes = lower[codes]
    return codes, places, np.searchsorted(places, bounds), bounds


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """A hash for each place at which a q-gram begins, by doubling."""
    if len(codes) < q:
        return np.empty(0, np.uint64)
    powers: dict[int, np.ndarray] = {1: codes.astype(np.uint64)}
    size = 1
    while 2 * size <= q:
        half = powers[size]
        powers[2 * size] = half[:-size] * (_FACTOR + np.uint64(4 * size)) + half[size:]
        size *= 2
    result, done = powers[size], size
    for part in sorted((p for p in powers if p < size), reverse=True):
        if done + part <= q:
            n = len(codes) - done - part + 1
            result = result[:n] * (_FACTOR + np.uint64(2 * part)) + powers[part][done : done + n]
            done += part
    return result * _FACTOR


@dataclass
class Segment:
    item: int
    codes: np.ndarray
    edits: int
    bound: int


class Index:
    """The q-grams of a block of items."""

    def __init__(self, items: list[str], q: int, segment: int, step: int, rate: float):
        self.q, self.segments = q, []
        for number, text in enumerate(items):
            codes = normal_form([text])[0]
            starts = list(range(0, max(len(codes) - segment, 0) + 1, step))
            if starts[-1] + segment < len(codes):
                starts.append(len(codes) - segment)
            for start in starts if len(codes) >= q else []:
                own = codes[start : start + segment]
                edits = int(rate * len(own))
                self.segments.append(Segment(number, own, edits, len(own) - q + 1 - edits * q))
        hashes, owners, offsets = [], [], []
        for number, each in enumerate(self.segments):
            own = gram_hashes(each.codes, q)
            hashes.append(own)
            owners.append(np.full(len(own), number))
            offsets.append(np.arange(len(own)))
        empty = [np.empty(0, np.uint64)]
        flat = np.concatenate(empty + hashes)
        order = np.argsort(flat, kind="stable")
        self.hashes = flat[order]
        self.owners = np.concatenate([np.empty(0, np.int64), *owners])[order]
        self.offsets = np.concatenate([np.empty(0, np.int64), *offsets])[order]
        self.first = np.zeros(1 << _BITS, bool)
        self.first[(self.hashes >> np.uint64(64 - _BITS)).astype(np.int64)] = True
        self.edits = np.array([s.edits for s in self.segments], np.int64)
        self.bounds = np.array([max(1, s.bound) for s in self.segments], np.int64)
        # the fewest shared q-grams of any segment, within its length and edits
        self.least = int(self.bounds.min(initial=1 << 30))
        self.reach = segment + int(rate * segment)

    def candidates(self, codes: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int]]:
        """``(text, segment, first, last)`` of bands that reach the bound."""
        hashes = gram_hashes(codes, self.q)
        if not len(hashes) or not len(self.hashes):
            return []
        hit = np.flatnonzero(self.first[(hashes >> np.uint64(64 - _BITS)).astype(np.int64)])
        low = np.searchsorted(self.hashes, hashes[hit], side="left")
        found = low < len(self.hashes)
        found[found] = self.hashes[low[found]] == hashes[hit[found]]
        hit = hit[found]
        text = np.searchsorted(bounds, hit, side="right") - 1
        inside = hit + self.q <= bounds[text + 1]
        hit, text = hit[inside], text[inside]
        # a region has at least `least` of these places within `reach` characters
        if len(hit) < self.least:
            return []
        n = self.least - 1
        close = (hit[n:] - hit[: len(hit) - n]) <= self.reach
        mark = np.zeros(len(hit) + 1, np.int64)
        np.add.at(mark, np.flatnonzero(close), 1)
        np.add.at(mark, np.flatnonzero(close) + n + 1, -1)
        dense = np.cumsum(mark[:-1]) > 0
        hit, text = hit[dense], text[dense]
        if not len(hit):
            return []
        result = []
        for begin, end in self._pieces(hashes[hit], hit):
            result += self._bands(hashes[hit[begin:end]], hit[begin:end], text[begin:end], bounds)
        return result

    def _pieces(self, hashes: np.ndarray, hit: np.ndarray):
        """Runs of places with a bounded number of matches; runs overlap by a region's reach."""
        times = np.searchsorted(self.hashes, hashes, "right") - np.searchsorted(self.hashes, hashes)
        total, begin = np.cumsum(times), 0
        while begin < len(hit):
            done = total[begin - 1] if begin else 0
            end = int(np.searchsorted(total, done + _MATCHES, side="right"))
            end = max(end, int(np.searchsorted(hit, hit[begin] + 2 * self.reach)), begin + 1)
            yield begin, end
            if end >= len(hit):
                return
            begin = max(begin + 1, int(np.searchsorted(hit, hit[end - 1] - self.reach)))

    def _bands(self, hashes, hit, text, bounds) -> list[tuple[int, int, int, int]]:
        low = np.searchsorted(self.hashes, hashes, side="left")
        times = np.searchsorted(self.hashes, hashes, side="right") - low
        each = np.repeat(np.arange(len(hit)), times)
        entry = np.arange(len(each)) - np.repeat(np.cumsum(times) - times - low, times)
        segment, place = self.owners[entry], hit[each]
        width = self.edits[segment] + 1
        diagonal = place - self.offsets[entry] + _SHIFT
        # a band covers two cells of this width, so that a q-gram lies in two bands
        cell = diagonal // width
        key = np.concatenate([cell, cell - 1]) * len(self.segments) + np.tile(segment, 2)
        key = key * len(bounds) + np.tile(text[each], 2)
        key.sort()
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        count = np.diff(np.concatenate([starts, [len(key)]]))
        key, text = np.divmod(key[starts], len(bounds))
        band, segment = np.divmod(key, len(self.segments))
        result = []
        for k in np.flatnonzero(count >= self.bounds[segment]).tolist():
            own, edits = int(segment[k]), int(self.edits[segment[k]])
            offset = int(band[k]) * (edits + 1) - _SHIFT
            last = offset + 2 * (edits + 1) + len(self.segments[own].codes) + edits
            first = max(offset - edits, int(bounds[text[k]]))
            result.append((int(text[k]), own, first, min(last, int(bounds[text[k] + 1]))))
        return result


def align(pattern: np.ndarray, region: np.ndarray, budget: int) -> tuple[int, int, int] | None:
    """Fewest edits of the whole pattern against any part of the region: edits, start, end.

    The region is the band, so its columns are the band's diagonals and the segment's
    length; a row of the table is one vectorised step.
    """
    n = len(region)
    big = len(pattern) + n + 1
    row, source = np.zeros(n + 1, np.int64), np.arange(n + 1)
    steps = np.arange(n + 1)
    for code in pattern:
        diagonal = row[:-1] + (region != code)
        below = row + 1
        best = below.copy()
        take = diagonal < below[1:]
        best[1:][take] = diagonal[take]
        origin = source.copy()
        origin[1:][take] = source[:-1][take]
        # insertions: a running minimum of best - column
        shifted = (best - steps) * (n + 1) + (n - steps)
        least = np.minimum.accumulate(shifted)
        at = n - least % (n + 1)
        row = best[at] + steps - at
        source = origin[at]
        if row.min() > budget:
            return None
    end = int(row.argmin())
    return (int(row[end]), int(source[end]), end) if row[end] <= min(budget, big) else None


def find_leaks(
    spark: SparkSession,
    docs: DataFrame,
    benchmark: DataFrame,
    q: int = Q,
    segment: int = SEGMENT,
    step: int = STEP,
    rate: float = EDIT_RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``doc_id, item_id, start, end, edits``: one row for each document and item in it.

    ``start`` and ``end`` are code points of the document; of several regions the one with
    the fewest edits, then the first, is given.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, item_id {item_type}, start long, end long, edits int"
    options = (q, segment, step, rate)
    result = spark.createDataFrame([], schema)
    for block in _blocks(benchmark, block_chars):
        shared, key = spark.sparkContext.broadcast(block), ("benchmark", uuid.uuid4().hex)
        item_kind = to_arrow_type(benchmark.schema["item_id"].dataType)

        def find(batches, shared=shared, key=key):
            for batch in slices(batches, "text"):
                index = _once(key, lambda: Index([t for _, t in shared.value], *options))
                rows = _leaks(index, whole(batch, "text").to_pylist())
                columns = [
                    batch.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64())),
                    pa.array([shared.value[r[1]][0] for r in rows], item_kind),
                ]
                for k, kind in ((2, pa.int64()), (3, pa.int64()), (4, pa.int32())):
                    columns.append(pa.array([r[k] for r in rows], kind))
                yield pa.RecordBatch.from_arrays(
                    columns, ["doc_id", "item_id", "start", "end", "edits"]
                )

        result = result.unionAll(docs.select("doc_id", "text").mapInArrow(find, schema))
    return result


def drop_leaks(
    spark: SparkSession,
    docs: DataFrame,
    benchmark: DataFrame,
    q: int = Q,
    segment: int = SEGMENT,
    step: int = STEP,
    rate: float = EDIT_RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows of ``docs`` whose text holds no leak, with all their columns."""
    options = (q, segment, step, rate)
    for block in _blocks(benchmark, block_chars):
        shared, key = spark.sparkContext.broadcast(block), ("benchmark", uuid.uuid4().hex)

        def keep(batches, shared=shared, key=key):
            for batch in slices(batches, "text"):
                index = _once(key, lambda: Index([t for _, t in shared.value], *options))
                clean = np.ones(batch.num_rows, bool)
                clean[[r[0] for r in _leaks(index, whole(batch, "text").to_pylist())]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs


def _blocks(benchmark: DataFrame, size: int):
    """Items in blocks of at most ``size`` characters (one item at least), streamed one by one."""
    block, total = [], 0
    items = benchmark.select("item_id", "text").filter("text <> ''").orderBy("item_id", "text")
    for row in items.toLocalIterator():
        if block and total + len(row.text) > size:
            yield block
            block, total = [], 0
        block.append((row.item_id, row.text))
        total += len(row.text)
    if block:
        yield block


def _leaks(index: Index, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
    codes, places, bounds, starts = normal_form(texts)
    found = {}

    def add(text, own, first, last, edits):
        key = (text, index.segments[own].item)
        found[key] = min(found.get(key, (1 << 30,)), (edits, first, last))

    for text, own, first, last in index.candidates(codes, bounds):
        each = index.segments[own]
        if found.get((text, each.item), (1,))[0] == 0:
            continue
        hit = align(each.codes, codes[first:last], each.edits)
        if hit:
            add(text, own, first + hit[1], first + hit[2], hit[0])
    return [
        (t, i, int(places[a] - starts[t]), int(places[max(b, a + 1) - 1] - starts[t]) + 1, edits)
        for (t, i), (edits, a, b) in found.items()
    ]
