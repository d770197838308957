"""Operator 12, fill-in-the-middle texts by secondary sort.

A text is cut into units (a run of ASCII letters, or any other character). Two places,
drawn from a hash of the document's id, divide the units into prefix, middle and suffix,
which are put out in another order behind marks. A text is never put together in memory:
it leaves its task as pieces of ``CHUNK_UNITS`` units at most, keyed by row and output
position. Rows are dealt out by row and their pieces sorted by position
(``repartition`` and ``sortWithinPartitions``, the DataFrame form of
``repartitionAndSortWithinPartitions``, which sorts on disk when memory is short), and the
sorted stream feeds an incremental digest. The marks in that stream tell which part a piece
belongs to; sorted again by place in the text, inside the partition and without another
shuffle, the pieces feed a second digest: the restored text's.

A row's key is unique, so rows that share an id do not meet, and no group is larger than
one text. Row keys are given in the tasks that read ``docs``, so ``docs`` has to be a table
or file, or a plan over one that keeps its order, for a task that runs again to give the
same keys.

Defined results: a null text is read as empty; an empty text, and one that holds a mark, is
``plain``, with null ``prefix_chars`` and ``middle_chars``; a null id is hashed as an empty
one; repeated rows give repeated results; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldpan.llm.common import slices, task, whole

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
PLAIN_PERCENT, SPM_PERCENT = 10, 20
CHUNK_UNITS = 8192
_BATCH_ROWS, _BATCH_CHARS = 4096, 4 << 20
# a piece's position: its part's place among the parts, then its number in the part
_PART = 1 << 40
_SOURCE_ORDER = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}

_PIECES = (
    "row long, place long, doc_id {id}, n long, form string, prefix_chars long, "
    "middle_chars long, piece string"
)


def unit_starts(text: str) -> np.ndarray:
    """Where each unit of ``text`` begins, in code points, and the text's end."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    folded = codes | 32
    letter = (folded >= ord("a")) & (folded <= ord("z")) & (codes < 128)
    begins = ~letter
    begins[1:] |= ~letter[:-1]
    begins[:1] = True
    return np.append(np.flatnonzero(begins), len(codes))


def draws(doc_id: object) -> list[int]:
    """The first four groups of eight digits of the hash of ``1:`` and the id."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).digest()
    return np.frombuffer(digest, ">u4", 4).tolist()


def plan(doc_id: object, text: str) -> tuple[int, str, list[tuple[str, np.ndarray]]]:
    """Number of units, form, and the parts in output order: mark and unit starts."""
    starts = unit_starts(text)
    n = len(starts) - 1
    h1, h2, h3, h4 = draws(doc_id)
    if not text or h3 % 100 >= 100 - PLAIN_PERCENT or any(mark in text for mark in MARKS):
        return n, "plain", [("", starts)]
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    part = {
        PREFIX: starts[: first + 1],
        MIDDLE: starts[first : second + 1],
        SUFFIX: starts[second:],
    }
    spm = h4 % 100 < SPM_PERCENT
    order = (SUFFIX, PREFIX, MIDDLE) if spm else (PREFIX, SUFFIX, MIDDLE)
    return n, "spm" if spm else "psm", [(mark, part[mark]) for mark in order]


def _chunks(text: str, starts: np.ndarray, units: int) -> Iterator[str]:
    """A part's text in pieces of whole units; an empty part is one empty piece."""
    for first in range(0, max(1, len(starts) - 1), units):
        last = min(first + units, len(starts) - 1)
        yield text[starts[first] : starts[last]]


def pieces(docs: DataFrame, units: int = CHUNK_UNITS) -> DataFrame:
    """``row, place, doc_id, n, form, prefix_chars, middle_chars, piece``, in no order.

    A part's mark stands at the head of its first piece. What is known of the whole row is
    given with each piece.
    """
    id_type = docs.schema["doc_id"].dataType
    schema = _PIECES.format(id=id_type.simpleString())

    @task()
    def cut(batches):
        for batch in slices(batches, "text"):
            out = _Batch(schema, batch.schema.field("doc_id").type)
            rows, ids = batch.column("row").to_pylist(), batch.column("doc_id").to_pylist()
            for row, doc_id, text in zip(rows, ids, whole(batch, "text").to_pylist()):
                n, form, parts = plan(doc_id, text)
                chars = {mark: int(starts[-1] - starts[0]) for mark, starts in parts}
                known = (doc_id, n, form, chars.get(PREFIX), chars.get(MIDDLE))
                for number, (mark, starts) in enumerate(parts):
                    for k, piece in enumerate(_chunks(text, starts, units)):
                        head = mark if k == 0 else ""
                        yield from out.add(row, number * _PART + k, *known, head + piece)
            yield from out.rest()

    chosen = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return chosen.mapInArrow(cut, schema)


class _Batch:
    """Rows gathered to Arrow batches that are bounded in rows and characters."""

    def __init__(self, schema: str, id_type: pa.DataType):
        names = [column.strip().split(" ")[0] for column in schema.split(",")]
        kinds = {"doc_id": id_type, "piece": pa.string(), "form": pa.string()}
        kinds |= {name: pa.string() for name in names if name.endswith("sha256")}
        self.names, self.kinds = names, [kinds.get(name, pa.int64()) for name in names]
        self.rows, self.chars = [], 0

    def add(self, *values: object) -> Iterator[pa.RecordBatch]:
        self.rows.append(values)
        self.chars += len(values[-1] or "")
        if len(self.rows) >= _BATCH_ROWS or self.chars >= _BATCH_CHARS:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            arrays = [pa.array(v, kind) for v, kind in zip(zip(*self.rows), self.kinds)]
            self.rows, self.chars = [], 0
            yield pa.RecordBatch.from_arrays(arrays, self.names)


def in_output_order(cut: DataFrame) -> DataFrame:
    """Pieces dealt out by row, each row's in the order in which they are put out."""
    return cut.repartition("row").sortWithinPartitions("row", "place")


def _streamed(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _parted(mark: str, piece: str, marked: bool) -> tuple[str, str]:
    """The part that an output piece belongs to, and the piece without its mark."""
    if marked and piece[:3] in MARKS:
        return piece[:3], piece[3:]
    return mark, piece


def digests(docs: DataFrame, units: int = CHUNK_UNITS) -> DataFrame:
    """Per row: ``doc_id, n, form, prefix_chars, middle_chars``, SHA-256 of output and of the
    text restored from it."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = _PIECES.format(id=id_type)
    between = schema.replace("piece string", "output_sha256 string, piece string")
    result = schema.replace("row long, place long, ", "").replace(
        "piece string", "output_sha256 string, restored_sha256 string"
    )

    @task()
    def put_out(batches):
        """Digest of the output; pieces pass on with their place in the source text."""
        out = None
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        out = _Batch(between, first.schema.field("doc_id").type)
        stream = _streamed(_chain(first, batches))
        for row, own in groupby(stream, key=lambda values: values[0]):
            digest, mark, number, known = hashlib.sha256(), "", 0, ()
            for _, _, *known, piece in own:
                digest.update(piece.encode())
                before, (mark, piece) = mark, _parted(mark, piece, known[2] != "plain")
                number = number + 1 if mark == before else 0
                place = _SOURCE_ORDER.get(mark, 0) * _PART + number
                yield from out.add(row, place, *known, None, piece)
            # the row's digest follows its pieces, behind all places
            yield from out.add(row, 3 * _PART, *known, digest.hexdigest(), None)
        yield from out.rest()

    @task()
    def restore(batches):
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        out = _Batch(result, first.schema.field("doc_id").type)
        stream = _streamed(_chain(first, batches))
        for _, own in groupby(stream, key=lambda values: values[0]):
            digest = hashlib.sha256()
            for _, _, *known, output, piece in own:
                if piece is not None:
                    digest.update(piece.encode())
            yield from out.add(*known, output, digest.hexdigest())
        yield from out.rest()

    ordered = in_output_order(pieces(docs, units)).mapInArrow(put_out, between)
    # a row's pieces are together already: sorted where they are
    return ordered.sortWithinPartitions("row", "place").mapInArrow(restore, result)


def _chain(first: pa.RecordBatch, others: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from others


def outputs(docs: DataFrame) -> DataFrame:
    """``doc_id, form, output``: the transformed texts themselves, for a training set."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, form string, output string"

    @task()
    def join(batches):
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        out = _Batch(schema.replace("output", "piece"), first.schema.field("doc_id").type)
        stream = _streamed(_chain(first, batches))
        for _, own in groupby(stream, key=lambda values: values[0]):
            texts = []
            for _, _, doc_id, _, form, _, _, piece in own:
                texts.append(piece)
            for batch in out.add(doc_id, form, "".join(texts)):
                yield batch.rename_columns(["doc_id", "form", "output"])
        for batch in out.rest():
            yield batch.rename_columns(["doc_id", "form", "output"])

    return in_output_order(pieces(docs)).mapInArrow(join, schema)


def restored(transformed: DataFrame) -> DataFrame:
    """The table with a column ``text``: the source text of each ``output`` by its ``form``."""
    output = F.col("output")

    def between(start: str, end: str):
        part = F.substring_index(output, start, -1)
        return F.substring_index(part, end, 1) if end else part

    middle = between(MIDDLE, "")
    text = F.when(
        F.col("form") == "psm", F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    ).when(
        F.col("form") == "spm", F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    )
    return transformed.withColumn("text", F.coalesce(text, output))


def oracle(table: str = "documents") -> str:
    """The same columns in SQL."""
    part = "array_to_string(list_slice(units, {}, {}), '')"
    prefix, middle, suffix = (
        part.format(*bounds) for bounds in ((1, "a"), ("a + 1", "b"), ("b + 1", "n"))
    )
    group = "cast('0x' || substr(digest, {}, 8) as ubigint)"
    return f"""
        with cut as (
          select doc_id, coalesce(text, '') as whole,
                 regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as units,
                 sha256('1:' || coalesce(cast(doc_id as varchar), '')) as digest
          from {table}
        ), drawn as (
          select *, cast(len(units) as bigint) as n, {group.format(1)} as h1,
                 {group.format(9)} as h2, {group.format(17)} as h3, {group.format(25)} as h4
          from cut
        ), placed as (
          select *, least(h1 % (n + 1), h2 % (n + 1)) as a,
                 greatest(h1 % (n + 1), h2 % (n + 1)) as b,
                 case when whole = '' or contains(whole, '{PREFIX}') or contains(whole, '{SUFFIX}')
                           or contains(whole, '{MIDDLE}') or h3 % 100 >= {100 - PLAIN_PERCENT}
                      then 'plain' when h4 % 100 < {SPM_PERCENT} then 'spm' else 'psm' end as form
          from drawn
        ), parts as (
          select *, {prefix} as prefix, {middle} as middle, {suffix} as suffix from placed
        )
        select doc_id, n, form,
               case when form <> 'plain' then cast(length(prefix) as bigint) end as prefix_chars,
               case when form <> 'plain' then cast(length(middle) as bigint) end as middle_chars,
               sha256(case form when 'plain' then whole
                      when 'psm' then '{PREFIX}' || prefix || '{SUFFIX}' || suffix
                                      || '{MIDDLE}' || middle
                      else '{SUFFIX}' || suffix || '{PREFIX}' || prefix
                           || '{MIDDLE}' || middle end) as output_sha256,
               sha256(whole) as restored_sha256
        from parts
    """
