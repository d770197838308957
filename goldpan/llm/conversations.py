"""Operator 11, repair of conversation structure by a run-length dynamic programme.

Rows of a conversation go by turn (nulls first), those of one turn by role and MD5 of the
text. A row that is blank or repeats an earlier role and text has to be deleted; the edits
Keep, Rerole, Delete and Insert lead to roles whose initials are ``(s?(ua)+)?`` at least
cost, and of equally cheap ways the one whose initials come first in ASCII is taken.

What the costs need of a row is one of nine symbols: to be deleted, or one of four kinds of
role, truncated or not. Equal consecutive symbols are one run. The four states of the
pattern and the edits make a 4 x 4 min-plus matrix of each symbol; a run of length n is
passed in log n products by the cached binary powers of its matrix. The choices are unrolled
from the costs that are left at every run's end, in halves, so that memory stays small.

Rows are dealt out by ranges of conversation and turn, so that a conversation of any size
lies in as many tasks as it needs. A conversation that may go on in another task leaves its
matrix, whose product over all its segments gives every segment the costs behind it; each
segment is unrolled from all four states, and the chain of states picks one way for each.
Only these matrices and states of one conversation meet in one group, one for each of its
tasks. The audit is one value of the result, so it is put together at last. A repaired
conversation's digest is one stream by nature: its rows are sorted (on disk, when memory is
short), pass by its audit, and are not held.

Defined results: a null role or text is read as one space; rows with a null conversation
are one conversation; roles count by their first character, and any but ``s``, ``u``,
``a`` is rerolled or deleted; an empty table gives an empty result; other columns are not
read. Turns are whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.llm.common import saved, task

RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
# The characters that count as white space, the ends of a whole sentence
_SPACES, _ENDS = " \t\n\x0b\x0c\r", (".", "!", "?")
_KEEP, _REROLE, _DELETE, _INSERT, _TRUNCATED = 0, 2, 3, 2, 1
_LEGAL = {"su", "ua", "au"}

# States: nothing yet, after s, after u, after a. A user's row leads from one of them to
# the next, and so on; what is not listed is not allowed.
_NEXT = {"u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "s": {0: 1}, "": {}}
_KINDS = ("u", "a", "s", "")
# the state after a row whose role is set, or that is put in, to user or assistant
_SET = {0: 2, 1: 2, 2: 3, 3: 2}
_STATES = range(4)
_FAR = 1 << 60
# costs to be paid, and rows to be put in, when no row is left
_END = (0, 4, 2, 0)
_TAIL = ("", "II", "I", "")
_BATCH_ROWS, _BATCH_CHARS = 4096, 4 << 20


# --- min-plus -------------------------------------------------------------------


def symbol(role: str, truncated: bool) -> int:
    """1 to 8 for a row that may stay; 0 is a row that has to go."""
    initial = role[:1]
    kind = _KINDS.index(initial) if initial in _NEXT and initial else 3
    return 1 + 2 * kind + truncated


def _row_edges(code: int, state: int) -> list[tuple[str, int, int]]:
    """The edits of one row: initial, next state, cost; in ASCII order."""
    edges = [("D", state, _DELETE)]
    if code:
        kind, truncated = _KINDS[(code - 1) // 2], (code - 1) % 2 * _TRUNCATED
        if state in _NEXT[kind]:
            edges.append(("K", _NEXT[kind][state], _KEEP + truncated))
        edges.append(("R", _SET[state], _REROLE + truncated))
    return edges


def _product(a: tuple, b: tuple) -> tuple:
    return tuple(
        tuple(min(a[i][k] + b[k][j] for k in _STATES) for j in _STATES) for i in _STATES
    )


_UNIT = tuple(tuple(0 if i == j else _FAR for j in _STATES) for i in _STATES)


@lru_cache(maxsize=1024)
def _power(code: int, k: int) -> tuple:
    """The matrix of ``2 ** k`` rows of one symbol, each with what is put in before it."""
    if k:
        half = _power(code, k - 1)
        return _product(half, half)
    put_in = [[_FAR] * 4 for _ in _STATES]
    for start in _STATES:
        state, cost = start, 0
        while cost < put_in[start][state]:
            put_in[start][state] = cost
            state, cost = _SET[state], cost + _INSERT
    row = [[_FAR] * 4 for _ in _STATES]
    for state in _STATES:
        for _, after, cost in _row_edges(code, state):
            row[state][after] = min(row[state][after], cost)
    return _product(put_in, row)


def before_run(code: int, length: int, costs: tuple) -> tuple:
    """Least costs to the end before a run, by state, from those after it."""
    k = 0
    while length:
        if length & 1:
            m = _power(code, k)
            a, b, c, d = costs
            costs = tuple(min(r[0] + a, r[1] + b, r[2] + c, r[3] + d) for r in m)
        length >>= 1
        k += 1
    return costs


def matrix(runs: list[tuple[int, int]]) -> tuple:
    """The min-plus product of all runs."""
    columns = [tuple(column) for column in zip(*_UNIT)]
    for code, length in reversed(runs):
        columns = [before_run(code, length, column) for column in columns]
    return tuple(zip(*columns))


@lru_cache(maxsize=1 << 14)
def _step(code: int, state: int, costs: tuple) -> tuple[str, int]:
    """The edits at one row and the state after it; ``costs`` are those behind the row."""
    here = before_run(code, 1, costs)
    edits = ""
    while True:
        edges = _row_edges(code, state)
        edges.insert(1, ("I", _SET[state], _INSERT))
        for initial, after, cost in edges:
            if cost + (here if initial == "I" else costs)[after] == here[state]:
                break
        edits, state = edits + initial, after
        if initial != "I":
            return edits, state


def _unroll_run(code: int, length: int, state: int, costs: tuple, out: list) -> int:
    if length == 1:
        least = min(costs)
        edits, state = _step(code, state, tuple(cost - least for cost in costs))
        out.append(edits)
        return state
    half = length // 2
    state = _unroll_run(code, half, state, before_run(code, length - half, costs), out)
    return _unroll_run(code, length - half, state, costs, out)


def unroll(runs: list[tuple[int, int]], state: int, costs: tuple) -> tuple[str, int]:
    """Initials of the cheapest edits from ``state`` on, and the state they end in."""
    behind = [costs]
    for code, length in reversed(runs):
        behind.append(before_run(code, length, behind[-1]))
    out: list[str] = []
    for (code, length), costs in zip(runs, behind[-2::-1]):
        state = _unroll_run(code, length, state, costs, out)
    return "".join(out), state


# --- segments -------------------------------------------------------------------


def prepared(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies``: how often a row stands there, 0 for a row that
    only tells that its conversation exists. The column is optional."""
    copies = F.col("copies") if "copies" in conversations.columns else F.lit(1)
    return conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        copies.cast("long").alias("copies"),
    ).withColumn("place", F.md5("text"))


def faults(rows: DataFrame) -> DataFrame:
    """Each distinct ``conv_id, turn, role, place`` with its number ``n`` and its faults.

    No text is moved: repeats are found by their MD5.
    """
    trimmed = F.rtrim("text", F.lit(_SPACES))
    marked = rows.select(
        "conv_id",
        "turn",
        "role",
        "place",
        "copies",
        (trimmed == "").alias("blank"),
        (~F.substring(trimmed, -1, 1).isin(*_ENDS)).alias("truncated"),
    )
    each = marked.groupBy("conv_id", "turn", "role", "place").agg(
        F.sum("copies").alias("n"),
        F.any_value("blank").alias("blank"),
        F.any_value("truncated").alias("truncated"),
    )
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = marked.filter("copies > 0").groupBy("conv_id", "role", "place")
    first = first.agg(F.min(turn).alias("least")).select(
        F.col("conv_id").alias("c"),
        F.col("least.turn").alias("t"),
        F.col("role").alias("r"),
        F.col("place").alias("p"),
    )
    same = (
        F.col("conv_id").eqNullSafe(F.col("c"))
        & F.col("turn").eqNullSafe(F.col("t"))
        & (F.col("role") == F.col("r"))
        & (F.col("place") == F.col("p"))
    )
    joined = each.join(first, same, "left")
    return joined.withColumn("first", F.col("p").isNotNull()).drop("c", "t", "r", "p")


_COUNTS = ("least", "most", "turns", "blank", "duplicate", "truncated", "illegal")


class _Segment:
    """What one task sees of a conversation."""

    def __init__(self, conv_id: object):
        self.conv_id = conv_id
        self.runs: list[list[int]] = []
        self.least = self.most = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.initials = ["", ""]
        self.rows = 0

    def add(self, turn, role: str, n: int, blank: bool, truncated: bool, first: bool) -> None:
        if not n:
            return
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.turns += turn != self.most
            self.most = turn
        initial = role[:1]
        if self.rows:
            self.illegal += self.initials[1] + initial not in _LEGAL
        else:
            self.initials[0] = initial
        self.illegal += n - 1  # a row beside its copy
        self.initials[1] = initial
        self.rows += n
        stays = not blank and first
        self.blank += n if blank else 0
        self.duplicate += 0 if blank else n - first
        self.truncated += stays and truncated
        if stays:
            self._run(symbol(role, truncated), 1)
        self._run(0, n - stays)

    def _run(self, code: int, length: int) -> None:
        if length and self.runs and self.runs[-1][0] == code:
            self.runs[-1][1] += length
        elif length:
            self.runs.append([code, length])

    def counts(self) -> tuple:
        return tuple(getattr(self, name) for name in _COUNTS)


def _gaps(least, most, turns) -> int:
    return 0 if least is None else most - least + 1 - turns


def _segment_schema(id_type: str) -> str:
    counts = ", ".join(f"{name} long" for name in _COUNTS)
    return (
        f"conv_id {id_type}, closed boolean, part long, {counts}, first_role string, "
        "last_role string, cost long, audit string, runs array<long>, matrix array<long>"
    )


def segments(rows: DataFrame) -> DataFrame:
    """Conversations that lie in one task, solved, and the segments of all others.

    Rows are dealt out by ranges of the whole order, so that no conversation is too large.
    """
    order = ["conv_id", "turn", "role", "place"]
    schema = _segment_schema(rows.schema["conv_id"].dataType.simpleString())

    @task()
    def solve(batches):
        part = TaskContext.get().partitionId()
        waiting, number, id_type = None, 0, pa.null()
        out: list[tuple] = []

        def closed(segment: _Segment) -> tuple:
            audit, state = unroll(segment.runs, 0, _END)
            cost = _END
            for code, length in reversed(segment.runs):
                cost = before_run(code, length, cost)
            solved = (cost[0], audit + _TAIL[state], None, None)
            return (segment.conv_id, True, part, *segment.counts(), *segment.initials, *solved)

        def open_(segment: _Segment) -> tuple:
            runs = [value for run in segment.runs for value in run]
            costs = [value for line in matrix(segment.runs) for value in line]
            known = (*segment.counts(), *segment.initials, None, None, runs, costs)
            return (segment.conv_id, False, part, *known)

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            columns = (batch.column(name).to_pylist() for name in batch.schema.names)
            for conv_id, turn, role, n, blank, truncated, first in zip(*columns):
                if waiting is None or conv_id != waiting.conv_id:
                    if waiting is not None:
                        # the task's first conversation may have begun in another one
                        out.append((open_ if number == 0 else closed)(waiting))
                        number += 1
                    waiting = _Segment(conv_id)
                waiting.add(turn, role, n, blank, truncated, first)
            if len(out) >= _BATCH_ROWS:
                yield _segment_batch(out, id_type)
                out = []
        if waiting is not None:
            out.append(open_(waiting))
        if out:
            yield _segment_batch(out, id_type)

    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    chosen = ranged.select("conv_id", "turn", "role", "n", "blank", "truncated", "first")
    return chosen.mapInArrow(solve, schema)


def _segment_batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    longs, text, many = pa.int64(), pa.string(), pa.list_(pa.int64())
    kinds = [id_type, pa.bool_(), longs, *[longs] * len(_COUNTS), text, text, longs, text, many, many]
    names = ["conv_id", "closed", "part", *_COUNTS, "first_role", "last_role", "cost", "audit"]
    arrays = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(arrays, [*names, "runs", "matrix"])


# --- conversations over several tasks -------------------------------------------


def _costs_behind(table: pa.Table) -> pa.Table:
    """One conversation's segments: its counts, and the costs behind each segment."""
    rows = sorted(table.to_pylist(), key=lambda row: row["part"])
    costs, behind = _END, []
    for row in reversed(rows):
        behind.append(list(costs))
        lines = [row["matrix"][4 * i : 4 * i + 4] for i in _STATES]
        costs = tuple(min(x + y for x, y in zip(line, costs)) for line in lines)
    seen = [row for row in rows if row["first_role"] is not None and row["has_rows"]]
    turned = [row for row in rows if row["least"] is not None]
    turns = sum(row["turns"] for row in turned)
    turns -= sum(a["most"] == b["least"] for a, b in zip(turned, turned[1:]))
    illegal = sum(row["illegal"] for row in rows)
    illegal += sum(a["last_role"] + b["first_role"] not in _LEGAL for a, b in zip(seen, seen[1:]))
    gaps = _gaps(turned[0]["least"], turned[-1]["most"], turns) if turned else 0
    total = {name: sum(row[name] for row in rows) for name in ("blank", "duplicate", "truncated")}
    n = len(rows)
    known = {"gaps": gaps, **total, "illegal": illegal, "cost": costs[0]}
    return pa.table(
        {
            "conv_id": table.column("conv_id"),
            "part": pa.array([row["part"] for row in rows], pa.int64()),
            "last": pa.array([i == n - 1 for i in range(n)]),
            "behind": pa.array(behind[::-1], pa.list_(pa.int64())),
            **{name: pa.array([value] * n, pa.int64()) for name, value in known.items()},
        }
    )


def _chain(table: pa.Table) -> pa.Table:
    """One conversation's segments: the state in which each begins."""
    ends: dict[int, dict[int, int]] = {}
    for row in table.to_pylist():
        ends.setdefault(row["part"], {})[row["start"]] = row["end"]
    state, starts = 0, []
    for part in sorted(ends):
        starts.append(state)
        state = ends[part][state]
    return pa.table(
        {
            "conv_id": table.column("conv_id").slice(0, len(starts)),
            "part": pa.array(sorted(ends), pa.int64()),
            "start": pa.array(starts, pa.int64()),
        }
    )


def _spread(spark: SparkSession, found: DataFrame, id_type: str) -> DataFrame:
    """The reports of conversations that lie, or may lie, in several tasks."""
    counts = ", ".join(f"{name} long" for name in RESULT[:-1])
    opened = found.filter("not closed").withColumn("has_rows", F.size("runs") > 0)
    behind = opened.drop("runs", "closed", "cost", "audit").groupBy("conv_id")
    behind = behind.applyInArrow(
        _costs_behind,
        f"conv_id {id_type}, part long, last boolean, behind array<long>, {counts}",
    )
    behind = saved(spark, behind, "costs-behind")

    @task()
    def every_way(batches):
        for batch in batches:
            for row in batch.to_pylist():
                runs = list(zip(row["runs"][::2], row["runs"][1::2]))
                ways = [unroll(runs, state, tuple(row["behind"])) for state in _STATES]
                audits = [a + (_TAIL[end] if row["last"] else "") for a, end in ways]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["conv_id"]] * 4, batch.schema.field("conv_id").type),
                        pa.array([row["part"]] * 4, pa.int64()),
                        pa.array(_STATES, pa.int64()),
                        pa.array([end for _, end in ways], pa.int64()),
                        pa.array(audits, pa.string()),
                    ],
                    ["conv_id", "part", "start", "end", "audit"],
                )

    def beside(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
        renamed = right.withColumnsRenamed({key: f"other_{key}" for key in keys})
        same = [F.col(key).eqNullSafe(F.col(f"other_{key}")) for key in keys]
        return left.join(renamed, same).drop(*(f"other_{key}" for key in keys))

    ways = beside(
        opened.select("conv_id", "part", "runs"),
        behind.select("conv_id", "part", "last", "behind"),
        "conv_id",
        "part",
    ).mapInArrow(every_way, f"conv_id {id_type}, part long, start long, end long, audit string")
    ways = saved(spark, ways, "ways")
    starts = ways.select("conv_id", "part", "start", "end").groupBy("conv_id")
    starts = starts.applyInArrow(_chain, f"conv_id {id_type}, part long, start long")
    taken = beside(ways, starts, "conv_id", "part", "start").groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("part", "audit"))).alias("audits")
    )
    taken = taken.select("conv_id", F.array_join("audits.audit", "").alias("audit"))
    whole = behind.filter("last").drop("part", "last", "behind")
    return beside(whole, taken, "conv_id").select("conv_id", *RESULT)


def report(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """Per conversation: ``gaps, blank, duplicate, truncated, illegal, cost, audit``."""
    id_type = conversations.schema["conv_id"].dataType.simpleString()
    rows = saved(spark, faults(prepared(conversations)), "faults")
    found = saved(spark, segments(rows), "segments")
    gaps = F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0))
    alone = found.filter("closed").withColumn("gaps", gaps).select("conv_id", *RESULT)
    return saved(spark, alone.unionAll(_spread(spark, found, id_type)), "report")


# --- repaired rows --------------------------------------------------------------


def _edited(audit: str, rows: Iterator[tuple[str, str, int]]) -> Iterator[tuple[str, str, str]]:
    """Edit, role and text of every row that is left or put in, in order."""
    state, at = 0, 0

    def put_in():
        nonlocal state, at
        while at < len(audit) and audit[at] == "I":
            at, state = at + 1, _SET[state]
            yield "I", _ROLES[state], ""

    for role, text, copies in rows:
        for _ in range(copies):
            yield from put_in()
            edit = audit[at]
            at += 1
            if edit == "K":
                state = _NEXT[role[:1]][state]
                yield edit, role, text
            elif edit == "R":
                state = _SET[state]
                yield edit, _ROLES[state], text
    yield from put_in()


_ROLES = {2: "user", 3: "assistant"}


def _streams(batches) -> Iterator[tuple[object, dict, Iterator[tuple[str, str, int]]]]:
    """Each conversation's report and its rows, which have to be read before the next one."""

    def stream():
        for batch in batches:
            yield from batch.to_pylist()

    for conv_id, own in groupby(stream(), key=lambda row: row["conv_id"]):
        known = next(own)
        yield conv_id, known, ((row["role"], row["text"], row["copies"]) for row in own)


def _with_reports(conversations: DataFrame, reports: DataFrame) -> DataFrame:
    """Reports and rows together: each conversation's report, then its rows in order."""
    rows = prepared(conversations).filter("copies > 0")
    kinds = {field.name: field.dataType for field in reports.schema.fields}
    nothing = [F.lit(None).cast(kinds[name]).alias(name) for name in RESULT]
    rows = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "place", "text", "copies", *nothing)
    heads = reports.select(
        "conv_id",
        F.lit(0).alias("kind"),
        F.lit(None).cast("long").alias("turn"),
        *(F.lit(None).cast("string").alias(name) for name in ("role", "place", "text")),
        F.lit(None).cast("long").alias("copies"),
        *RESULT,
    )
    both = heads.unionAll(rows).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", "kind", "turn", "role", "place").drop(
        "turn", "place", "kind"
    )


def repaired(conversations: DataFrame, reports: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: ``conv_id, number, edit, role, text``."""
    id_type = conversations.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "number", "edit", "role", "text"]

    @task()
    def edit(batches):
        kind, out, chars = pa.null(), [], 0

        def batch():
            kinds = [kind, pa.int64(), pa.string(), pa.string(), pa.string()]
            arrays = [pa.array(v, k) for v, k in zip(zip(*out), kinds)]
            return pa.RecordBatch.from_arrays(arrays, names)

        def typed():
            nonlocal kind
            for each in batches:
                kind = each.schema.field("conv_id").type
                yield each

        for conv_id, known, rows in _streams(typed()):
            for number, made in enumerate(_edited(known["audit"], rows)):
                out.append((conv_id, number, *made))
                chars += len(made[2])
                if len(out) >= _BATCH_ROWS or chars >= _BATCH_CHARS:
                    yield batch()
                    out, chars = [], 0
        if out:
            yield batch()

    schema = f"conv_id {id_type}, number long, edit string, role string, text string"
    return _with_reports(conversations, reports).mapInArrow(edit, schema)


def digests(conversations: DataFrame, reports: DataFrame) -> DataFrame:
    """The reports with ``repaired_sha256``, of ``role:text`` lines joined by newlines."""
    id_type = conversations.schema["conv_id"].dataType.simpleString()

    @task()
    def digest(batches):
        kind, out = pa.null(), []

        def batch():
            kinds = [kind, *[pa.int64()] * (len(RESULT) - 1), pa.string(), pa.string()]
            arrays = [pa.array(v, k) for v, k in zip(zip(*out), kinds)]
            return pa.RecordBatch.from_arrays(arrays, ["conv_id", *RESULT, "repaired_sha256"])

        def typed():
            nonlocal kind
            for each in batches:
                kind = each.schema.field("conv_id").type
                yield each

        for conv_id, known, rows in _streams(typed()):
            sha, line_end = hashlib.sha256(), ""
            for _, role, text in _edited(known["audit"], rows):
                sha.update(f"{line_end}{role}:{text}".encode())
                line_end = "\n"
            out.append((conv_id, *(known[name] for name in RESULT), sha.hexdigest()))
            if len(out) >= _BATCH_ROWS:
                yield batch()
                out = []
        if out:
            yield batch()

    counts = ", ".join(f"{name} long" for name in RESULT[:-1])
    schema = f"conv_id {id_type}, {counts}, audit string, repaired_sha256 string"
    return _with_reports(conversations, reports).mapInArrow(digest, schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """Faults set by a hash of conversation and turn, one row in four, for trying a repair."""
    space = F.lit(" ")
    key = F.concat_ws(
        ":",
        F.coalesce(F.col("conv_id").cast("string"), space),
        F.coalesce(F.col("turn").cast("string"), space),
    )
    fault = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return conversations.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "")
        .when(fault == 2, F.translate(text, "".join(_ENDS), ""))
        .otherwise(text)
        .alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"),
    )


def repair_damaged(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """Damage every conversation, repair it and digest the repaired rows."""
    rows = damaged(conversations)
    return digests(rows, report(spark, rows))
