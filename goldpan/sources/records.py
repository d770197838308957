"""CSV records with line breaks inside quoted fields, from files of any size.

Spark reads such a file in one task. Here files are read as lines in ordinary splits.
As for the CSV reader, a quote opens a field only at the field's start, and a quoted field
ends at a quote that is not doubled. So a line maps the state before it (inside a quoted
field or not) to the state after it. A first pass moves one small code for each line to the
task's fold and one row for each split to the driver, which holds a task for each split
anyway; the prefix of these maps tells in which state every split begins. Where no line
leaves a field open, lines are records and the CSV reader takes them as they are. Elsewhere
a second pass puts records together inside each split, in the order of its lines. A record
that crosses a border between splits gets its end from the first pass, if that is short and
lies in the next split; only the pieces of others are read once more and shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

# Possessive, so that long fields take no stack. A field is quoted up to a quote that is not
# doubled, or does not begin with a quote.
_INSIDE = '(?:[^"]++|"")*+"'
_FIELD = f'(?:"{_INSIDE}|(?!"))[^,]*+'
_CLOSED = f"^{_FIELD}(?:,{_FIELD})*+$"
_CLOSED_IF_OPEN = f"^{_INSIDE}[^,]*+(?:,{_FIELD})*+$"

# A line's code: the states after it, if none was open and if one was, as bits; or blank.
_IDENTITY, _BLANK, _CODE, _ODD = 1, 4, 7, 8
_PEEKED_LINES = 1_000
# The lines of a task that the first pass looks at for the end of a record that another split
# begins, and the longest such end that it hands on.
_HEAD_LINES, _HEAD_CHARS = 1_000, 16 << 10
_MOST_NAMED_SPLITS = 10_000
_LONE_RETURN = "carriage return outside quotes in a CSV record; such files take layout='files'"


def _after(line: Column) -> Column:
    """1 if a quoted field is open after a line that starts outside one."""
    return (~line.rlike(_CLOSED)).cast("int")


def _after_open(line: Column) -> Column:
    """1 if a quoted field is open after a line that starts inside one."""
    return (~line.rlike(_CLOSED_IF_OPEN)).cast("int")


def _coded_lines(spark: SparkSession, path: str | list[str], options: dict[str, str]) -> DataFrame:
    """Every line with its split and its code; odd ones are not for the CSV reader's lines."""
    line = F.col("value")
    blanks = "".join(map(chr, range(0x21)))
    code = (
        F.when(line.isin("", "\r"), _BLANK)
        .when(line.contains('"'), 2 * _after(line) + _after_open(line))
        .otherwise(_IDENTITY)
    )
    # most lines begin with more than a blank, which is told without a look at the rest
    alone = (line < "!") & (F.rtrim(line, F.lit(blanks)) == "") & ~line.isin("", "\r")
    returns = line.contains("\r") & (F.instr(line, "\r") < F.length(line))
    odd = F.when(alone | returns, _ODD).otherwise(0)
    return (
        spark.read.options(**options, lineSep="\n")
        .text(path)
        .select(
            "value",
            F.xxhash64("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            (code + odd).cast("tinyint").alias("code"),
        )
    )


# --- first pass: the states in which splits begin -------------------------------


@dataclass
class FileSplits:
    """A file's splits that have lines, by place: their starts and what is known of them."""

    blocks: np.ndarray
    opens: np.ndarray  # whether a quoted field is open where the split begins
    owners: np.ndarray  # where the record begins that goes on into the split
    ends: np.ndarray  # whether a record goes on into the next split
    direct: np.ndarray  # whether that record has its end in the next split's head
    heads: list[str | None]  # these ends, where they lie
    header: int  # the split with the first record
    keys: np.ndarray  # the splits' own hashes

    def in_pieces(self) -> np.ndarray:
        """Whether a split has pieces of records that no split puts together."""
        taken = np.concatenate([[False], self.direct[:-1]])
        return (self.opens & ~taken) | (self.ends & ~self.direct)

    def place(self, block: int) -> int:
        at = int(np.searchsorted(self.blocks, block))
        if at == len(self.blocks) or self.blocks[at] != block:
            raise RuntimeError("the splits differ from those that were scanned; read the files again")
        return at


@dataclass
class Scan:
    """What the first pass knows of all files, by the hash of their path."""

    files: dict[int, FileSplits]
    lines_are_records: bool


def _runs(file: np.ndarray, block: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where the rows of one split begin and end."""
    cuts = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
    bounds = [0, *cuts.tolist(), len(file)]
    return zip(bounds[:-1], bounds[1:])


def _states(codes: np.ndarray, state: int) -> np.ndarray:
    """The state after each line of a run that begins in ``state``."""
    # a line that closes or opens whatever was before it, and those that turn the state round
    fixes = (codes == 0) | (codes == 3)
    turns = np.cumsum(codes == 2)
    last = np.maximum.accumulate(np.where(fixes, np.arange(len(codes)), -1))
    since = np.where(last < 0, state, codes[last] & 1)
    return since ^ ((turns - np.where(last < 0, 0, turns[last])) & 1)


def _longer_head(head: str, lines: pa.Array, if_open: np.ndarray | None) -> str | None:
    """``head`` and what follows of it up to the line that closes it; None if that is too long."""
    if if_open is not None and not if_open.all():
        lines = lines.slice(0, int(np.argmin(if_open)) + 1)
    if len(lines) > _HEAD_LINES or lines.null_count:
        return None
    head += "".join(f"{line}\n" for line in lines.to_pylist())
    return head if len(head) <= _HEAD_CHARS else None


def _fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each split: the map of all its lines, and what else matters of it."""
    names = ["file", "block", "if_closed", "if_open", "closes", "solid", "plain", "head"]
    found: dict[tuple[int, int], list] = {}
    for batch in batches:
        file, block, code = (batch.column(n).to_numpy(zero_copy_only=False) for n in range(3))
        if not len(file):
            continue
        for first, last in _runs(file, block):
            own = code[first:last]
            key = (int(file[first]), int(block[first]))
            state = found.setdefault(key, [0, 1, False, False, True, ""])
            lines = own & _CODE
            state[3] |= bool((lines != _BLANK).any())
            state[4] &= not (own & (_ODD | 2)).any()
            if_open = None
            if not ((lines == _IDENTITY) | (lines == _BLANK)).all():
                if_open = _states(lines, state[1])
            if not state[2] and state[5] is not None:
                state[5] = _longer_head(state[5], batch.column(3).slice(first, last - first), if_open)
            if if_open is not None:
                state[0], state[1] = int(_states(lines, state[0])[-1]), int(if_open[-1])
                state[2] |= not if_open.all()
    # every line of a head has a line break behind it by now
    rows = [(*key, *state[:5], state[2] and state[5] and state[5][:-1]) for key, state in found.items()]
    rows = [(*row[:7], row[7] or None) for row in rows]
    kinds = [pa.int64()] * 4 + [pa.bool_()] * 3 + [pa.string()]
    columns = zip(*rows) if rows else [[]] * len(names)
    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds)], names)


def _key() -> Column:
    return F.xxhash64("file", "block")


def _if_all_plain(lines: DataFrame) -> list[Row] | None:
    """What the fold tells of every split, if no line of any leaves a field open."""
    code = F.col("code")
    splits = lines.groupBy("file", "block").agg(
        F.lit(0).alias("if_closed"),
        F.lit(1).alias("if_open"),
        F.lit(False).alias("closes"),
        F.max(code.bitwiseAND(_CODE) != _BLANK).alias("solid"),
        (F.max(code.bitwiseAND(_ODD | 2)) == 0).alias("plain"),
        F.lit(None).cast("string").alias("head"),
    )
    splits = splits.withColumn("key", _key()).collect()
    return splits if all(row.plain for row in splits) else None


def scan(
    spark: SparkSession, path: str | list[str], header: bool = True, options: dict[str, str] | None = None
) -> Scan:
    """Read all lines once for the states of their quotes. A field that is never closed is
    an error that names its file and place. ``options`` are the reader's own.

    Where the first lines leave no field open, a plain aggregation sees first whether any
    line does; if not, that is all there is to know, and no line leaves the JVM.
    """
    lines = _coded_lines(spark, path, options or {})
    splits = None
    if not any(row.code & (_ODD | 2) for row in lines.select("code").take(_PEEKED_LINES)):
        splits = _if_all_plain(lines)
    if splits is None:
        number = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)  # in the task
        text = F.when(number < _HEAD_LINES, F.col("value")).alias("text")
        folded = lines.select("file", "block", "code", text).mapInArrow(
            _fold,
            "file long, block long, if_closed long, if_open long, closes boolean, solid boolean, "
            "plain boolean, head string",
        )
        splits = folded.withColumn("key", _key()).collect()
    by_file: dict[int, list] = {}
    for row in splits:
        by_file.setdefault(row.file, []).append(row)
    files, plain = {}, True
    for file, rows in by_file.items():
        rows.sort(key=lambda row: row.block)
        state, owner, opens, owners, ends = 0, rows[0].block, [], [], []
        for row in rows:
            opens.append(state)
            owners.append(owner)
            if not state or row.closes:
                owner = row.block  # a record that is open behind this split begins in it
            state = row.if_open if state else row.if_closed
            ends.append(state)
        if state:
            raise _never_closed(spark, path, file, owner)
        head = next((i for i, row in enumerate(rows) if row.solid), 0)
        plain &= all(row.plain for row in rows) and not any(opens)
        plain &= not header or rows[head].block == 0
        blocks = np.array([row.block for row in rows], np.int64)
        states = np.array(opens, bool), np.array(owners, np.int64), np.array(ends, bool)
        keys = np.array([row.key for row in rows], np.int64)
        known = np.array([row.head is not None for row in rows], bool)
        direct = np.zeros(len(rows), bool)
        direct[:-1] = states[2][:-1] & (states[1][1:] == blocks[:-1]) & known[1:]
        heads = [row.head if i and direct[i - 1] else None for i, row in enumerate(rows)]
        files[file] = FileSplits(blocks, *states, direct, heads, int(blocks[head]), keys)
    return Scan(files, plain)


def _never_closed(spark: SparkSession, path: str | list[str], file: int, block: int) -> PySparkException:
    names = spark.read.text(path).select(F.col("_metadata.file_path").alias("name")).distinct()
    name = names.filter(F.xxhash64("name") == file).first().name
    return PySparkException(
        f"a quoted field is never closed in {name}; its record begins at or after byte {block}"
    )


# --- second pass: records -------------------------------------------------------


class _Records:
    """Puts the lines of a task's splits together; pieces of split records come out marked."""

    _NAMES = ["record", "file", "start", "place"]

    def __init__(self, files: dict[int, FileSplits], header: bool):
        self.files, self.header = files, header
        self.key: tuple[int, int] | None = None
        self.open, self.skips, self.lines, self.start = False, False, [], 0
        self.begun_here = True
        self.pieces: list[tuple[str, int, int, int]] = []

    def begin(self, key: tuple[int, int]) -> None:
        file, block = key
        known = self.files.get(file)
        if known is None:
            raise RuntimeError("the files differ from those that were scanned; read them again")
        at = known.place(block)
        self.direct, self.taken = bool(known.direct[at]), bool(at and known.direct[at - 1])
        self.next_head = known.heads[at + 1] if self.direct else None
        self.key, self.open = key, bool(known.opens[at])
        self.start = int(known.owners[at]) if self.open else block
        self.begun_here = not self.open
        self.skips = self.header and block == known.header

    def end_split(self) -> Iterator[pa.Array]:
        if self.open and self.begun_here and self.direct:
            self.lines.append(self.next_head)
            yield from self._end_record()
        elif self.open:
            self._piece()
        self.open, self.lines = False, []

    def _piece(self) -> None:
        if self.taken and not self.begun_here:
            return  # the end of a record that the split before has put together
        file, block = self.key
        # a split's own record begins behind the end of the one it takes over
        place = 2 * block + self.begun_here
        marked = [None] if self.skips and self.begun_here else []
        self.pieces += [("\n".join(self.lines), file, self.start, place)]
        self.pieces += [(m, file, self.start, place) for m in marked]
        self.lines = []

    def add(self, values: pa.Array, codes: np.ndarray) -> Iterator[pa.Array]:
        """Takes lines of the current split; records that both begin and end in them come back."""
        values = values.cast(pa.string())
        if not self.open and not ((codes & 2) | (codes & _BLANK)).any():
            yield from self._whole(values)
            return
        after = _states(codes, int(self.open))
        before = np.concatenate([[int(self.open)], after[:-1]])
        kept = (before == 1) | (codes != _BLANK)
        values, after = values.filter(pa.array(kept)), after[kept]
        ends = np.flatnonzero(after == 0) + 1
        first = 0
        if self.open:
            first = int(ends[0]) if len(ends) else len(values)
            self.lines += values.slice(0, first).to_pylist()
            if not len(ends):
                return
            yield from self._end_record()
            ends = ends[1:]
        if len(ends):
            begin, last = first, int(ends[-1])
            offsets = pa.array(np.concatenate([[begin], ends]) - begin, pa.int32())
            lines = pa.ListArray.from_arrays(offsets, values.slice(begin, last - begin))
            yield from self._whole(pc.binary_join(lines, "\n"))
            first = last
        if first < len(values):
            self.open, self.begun_here, self.start = True, True, self.key[1]
            self.lines = values.slice(first).to_pylist()

    def _end_record(self) -> Iterator[pa.Array]:
        """The open record has ended: a piece if it began in another split."""
        self.open = False
        if not self.begun_here:
            self._piece()
        else:
            yield from self._whole(pa.array(["\n".join(self.lines)], pa.string()))
        self.lines, self.begun_here = [], True

    def _whole(self, records: pa.Array) -> Iterator[pa.Array]:
        if self.skips and len(records):
            self._skip(records[0].as_py())
            records = records.slice(1)
        if len(records):
            yield records

    def _skip(self, header: str) -> None:
        """A header that holds a file of lines that end in carriage returns is none."""
        if "\r" in re.sub('"[^"]*"', "", header.removesuffix("\r")):
            raise ValueError(_LONE_RETURN)
        self.skips = False

    def take_pieces(self) -> pa.RecordBatch:
        rows, self.pieces = self.pieces, []
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
        columns = zip(*rows) if rows else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds)], self._NAMES)

    def straight(self, values: pa.Array) -> pa.RecordBatch:
        file = pa.array(np.full(len(values), self.key[0], np.int64))
        nothing = pa.nulls(len(values), pa.int64())
        columns = [values, file, nothing, nothing]
        return pa.RecordBatch.from_arrays(columns, self._NAMES)


def _put_together(lines: DataFrame, found: Scan, header: bool, pieces: bool) -> DataFrame:
    """``record, file, start, place``: whole records without the last two, or ``pieces`` of
    split ones."""
    shared = lines.sparkSession.sparkContext.broadcast(found.files)

    def whole(records, arrays):
        for array in arrays:
            if not pieces:
                yield records.straight(array)

    def build(batches):
        records = _Records(shared.value, header)
        for batch in batches:
            if not batch.num_rows:
                continue
            file, block, code = (batch.column(n).to_numpy(zero_copy_only=False) for n in (1, 2, 3))
            code = code & _CODE
            for first, last in _runs(file, block):
                key = (int(file[first]), int(block[first]))
                if key != records.key:
                    yield from whole(records, records.end_split())
                    records.begin(key)
                lines = batch.column(0).slice(first, last - first)
                yield from whole(records, records.add(lines, code[first:last]))
            if pieces and records.pieces:
                yield records.take_pieces()
            records.pieces = []
        yield from whole(records, records.end_split())
        if pieces:
            yield records.take_pieces()

    return lines.mapInArrow(build, "record string, file long, start long, place long")


def read_quoted_records(
    spark: SparkSession,
    path: str | list[str],
    header: bool = True,
    options: dict[str, str] | None = None,
    found: Scan | None = None,
    with_file: bool = False,
) -> DataFrame:
    """One row per CSV record, as text in column ``record``; no order between rows.

    ``with_file`` adds ``file``, the hash (xxhash64) of its file's path.
    """
    kept = ["file"] if with_file else []
    found = found or scan(spark, path, header, options)
    lines = _coded_lines(spark, path, options or {})
    records = _put_together(lines, found, header, pieces=False).select("record", *kept)
    keys = [key for splits in found.files.values() for key in splits.keys[splits.in_pieces()].tolist()]
    if keys:
        if len(keys) <= _MOST_NAMED_SPLITS:
            # others are read in vain, not wrongly
            lines = lines.filter(_key().isin(keys))
        pieces = _put_together(lines, found, header, pieces=True)
        joined = pieces.groupBy("file", "start").agg(
            F.sort_array(F.collect_list(F.struct("place", "record"))).alias("pieces"),
            F.max(F.col("record").isNull()).alias("header"),
        )
        text = F.array_join("pieces.record", "\n").alias("record")
        records = records.unionAll(joined.filter("not header").select(text, *kept))
    record = F.col("record")
    without_return = F.when(record.endswith("\r"), record.substr(F.lit(1), F.length(record) - 1))
    records = records.select(F.coalesce(without_return, record).alias("record"), *kept)
    return records.select(_refuse_lone_returns(F.col("record")).alias("record"), *kept)


def _refuse_lone_returns(record: Column) -> Column:
    """Lines that end in carriage returns alone would make one record of the file."""
    outside_quotes = F.regexp_replace(record, '"[^"]*"', "")
    return F.when(
        record.contains("\r") & outside_quotes.contains("\r"), F.raise_error(F.lit(_LONE_RETURN))
    ).otherwise(record)
