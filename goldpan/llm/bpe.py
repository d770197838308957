"""Operator 6, BPE encoding and decoding through a minimal acyclic transducer.

The corpus' frequent words are compiled, with their ids, into an automaton whose
equal suffixes are shared. An arc carries a number; the numbers along a word's
path add up to the word's place in the table of ids, which makes the automaton a
transducer. Tasks memory-map the compiled form. Words outside it are merged exactly
by the ranks of the vocabulary file.

Texts are cut at white space and each distinct piece of a slice is encoded once.
Texts with characters whose normal form or class depends on a Unicode version, or
with the text of a special token, go to the tokenizers library as they are.

Defined results: a null text is read as empty and gives no ids; other columns are
ignored, so clashing names and nulls in them do no harm; repeated rows give repeated
results; an empty table gives an empty result (and an empty lexicon).
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import os

import tempfile
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.llm.common import saved, slices, task, whole

VOCABULARY = "word_bpe_49k.json"
LEXICON_WORDS = 200_000
_COUNTED_PIECES = 300_000
_KNOWN_WORDS = 300_000
_GATHERED_IDS = 1 << 18
_SLICE_BYTES = 4 << 20
_MATRIX_WIDTH = 48
_LEXICON_CHARS = 64
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# Latin text, for which all Unicode versions agree; everything else is the library's
_UNUSUAL = "[^\t-\r -~¡-įı-ɏ‐-‧€]|<\\|(?:start|end)oftext\\|>"


# --- the automaton --------------------------------------------------------------


def compile_lexicon(entries: dict[str, list[int]]) -> bytes:
    """The transducer of ``word -> ids`` as one block of bytes.

    Words go in by byte order; a state is closed when no later word can extend it,
    and replaced by an equal one that is already registered.
    """
    words = sorted(word.encode() for word in entries)
    register: dict[tuple, int] = {}
    arcs: list[tuple[int, int, int]] = []  # (state << 8 | byte, target, number)
    reach: list[int] = []  # words that a closed state leads to

    def close(final: bool, edges: list[tuple[int, int]]) -> int:
        key = (final, *edges)
        state = register.get(key)
        if state is None:
            state = register[key] = len(reach)
            number = int(final)
            for byte, target in edges:
                arcs.append((state << 8 | byte, target, number))
                number += reach[target]
            reach.append(number)
        return state

    finals: list[int] = []
    path: list[list] = [[False, []]]  # open states: final, edges so far
    labels: list[int] = []
    for word in words:
        shared = len(os.path.commonprefix([bytes(labels), word]))
        _close_below(path, labels, shared, close)
        for byte in word[shared:]:
            labels.append(byte)
            path.append([False, []])
        path[-1][0] = True
    _close_below(path, labels, 0, close)
    root = close(path[0][0], path[0][1])
    finals = sorted(state for key, state in register.items() if key[0])

    arcs.sort()
    ids = [entries[word.decode()] for word in words]
    return _pack(
        np.array([a[0] for a in arcs], np.int64),
        np.array([a[1] for a in arcs], np.int32),
        np.array([a[2] for a in arcs], np.int32),
        np.isin(np.arange(len(reach)), finals).astype(np.uint8),
        np.cumsum([0, *map(len, ids)]).astype(np.int64),
        np.array([i for each in ids for i in each], np.int32),
        np.array([root], np.int32),
    )


def _close_below(path, labels, depth, close):
    while len(path) > depth + 1:
        state = close(*path.pop())
        path[-1][1].append((labels.pop(), state))


def _pack(*arrays: np.ndarray) -> bytes:
    head = json.dumps([[a.dtype.str, len(a)] for a in arrays]).encode()
    head = len(head).to_bytes(8, "little") + head
    head += bytes(-len(head) % 8)
    return head + b"".join(a.tobytes() + bytes(-a.nbytes % 8) for a in arrays)


class Lexicon:
    """A compiled lexicon, mapped from a file that has no name any more."""

    def __init__(self, block: bytes):
        with tempfile.TemporaryFile() as file:
            file.write(block)
            file.flush()
            mapped = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        size = int.from_bytes(mapped[:8], "little")
        at = 8 + size + -(8 + size) % 8
        arrays = []
        for kind, length in json.loads(mapped[8 : 8 + size]):
            array = np.frombuffer(mapped, np.dtype(kind), length, at)
            arrays.append(array)
            at += array.nbytes + -array.nbytes % 8
        self.keys, self.targets, self.numbers, self.final, self.bounds, self.ids, root = arrays
        self.root = int(root[0])

    def places(self, words: list[bytes]) -> np.ndarray:
        """Each word's place in the table of ids, -1 for a word that is not in it."""
        lengths = np.array([len(w) for w in words], np.int64)
        state = np.full(len(words), self.root, np.int64)
        place = np.zeros(len(words), np.int64)
        if not len(self.keys):
            return np.full(len(words), -1)
        data = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(lengths) - lengths
        alive = np.flatnonzero(lengths)
        step = 0
        while len(alive):
            key = state[alive] << 8 | data[starts[alive] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[arc] == key
            state[alive[~hit]] = -1
            alive, arc = alive[hit], arc[hit]
            place[alive] += self.numbers[arc]
            state[alive] = self.targets[arc]
            step += 1
            alive = alive[lengths[alive] > step]
        good = (state >= 0) & (self.final[np.maximum(state, 0)] == 1)
        return np.where(good, place, -1)

    def entry(self, place: int) -> np.ndarray:
        return self.ids[self.bounds[place] : self.bounds[place + 1]]


# --- merging --------------------------------------------------------------------


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself, or one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Merges:
    """The merges of a vocabulary whose words end in a mark."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            self.model = json.load(file)["model"]
        vocabulary, end = self.model["vocab"], self.model["end_of_word_suffix"]
        self.inner = np.array([vocabulary[c] for c in byte_alphabet()], np.int64)
        self.last = np.array([vocabulary[c + end] for c in byte_alphabet()], np.int64)
        pairs = {}
        for rank, pair in enumerate(self.model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            pairs.setdefault(vocabulary[left] << 20 | vocabulary[right], (rank, left + right))
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[int(k)][0] for k in self.keys], np.int64)
        self.results = np.array([vocabulary[pairs[int(k)][1]] for k in self.keys], np.int64)
        self.none = len(pairs) + 1

    def _find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = np.where((left < 0) | (right < 0), -1, left << 20 | right)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.none), self.results[at]

    def encode(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word: always the lowest rank first, of equal ones the leftmost."""
        out: list = [None] * len(words)
        short = [i for i, w in enumerate(words) if 0 < len(w) <= _MATRIX_WIDTH]
        short.sort(key=lambda i: len(words[i]))
        for first in range(0, len(short), 20_000):
            self._merge_matrix(words, short[first : first + 20_000], out)
        for i, word in enumerate(words):
            if out[i] is None:
                out[i] = self._merge_long(word)
        return out

    def _merge_matrix(self, words, chosen, out) -> None:
        lengths = np.array([len(words[i]) for i in chosen])
        n, width = len(chosen), int(lengths.max())
        columns = np.arange(width)
        inside = columns < lengths[:, None]
        symbols = np.full((n, width + 1), -1, np.int64)
        data = np.frombuffer(b"".join(words[i] for i in chosen), np.uint8)
        symbols[:, :-1][inside] = self.inner[data]
        symbols[np.arange(n), lengths - 1] = self.last[data[np.cumsum(lengths) - 1]]
        ranks, _ = self._find(symbols[:, :-1], symbols[:, 1:])
        rows = np.array(chosen)
        while len(rows):
            at = ranks.argmin(axis=1)
            each = np.arange(len(rows))
            busy = ranks[each, at] < self.none
            for r in np.flatnonzero(~busy):
                line = symbols[r]
                out[rows[r]] = line[line >= 0].astype(np.int32)
            rows, symbols, ranks, at = rows[busy], symbols[busy], ranks[busy], at[busy]
            if not len(rows):
                break
            each = np.arange(len(rows))
            _, merged = self._find(symbols[each, at], symbols[each, at + 1])
            later = columns > at[:, None]
            moved = np.concatenate([symbols[:, 1:], np.full((len(rows), 1), -1)], axis=1)
            symbols[:, :-1] = np.where(later, moved[:, :-1], symbols[:, :-1])
            symbols[each, at] = merged
            moved = np.concatenate([ranks[:, 1:], np.full((len(rows), 1), self.none)], axis=1)
            ranks = np.where(later, moved, ranks)
            before = np.maximum(at - 1, 0)
            ranks[each, before], _ = self._find(symbols[each, before], symbols[each, before + 1])
            ranks[each, at], _ = self._find(symbols[each, at], symbols[each, at + 1])

    def _merge_long(self, word: bytes) -> np.ndarray:
        """One long word, by a heap of its pairs over a linked list."""
        if not word:
            return np.empty(0, np.int32)
        data = np.frombuffer(word, np.uint8)
        symbols = self.inner[data]
        symbols[-1] = self.last[data[-1]]
        ranks, _ = self._find(symbols[:-1], symbols[1:])
        symbols = symbols.tolist()
        heap = [
            (rank, i, symbols[i], symbols[i + 1])
            for i, rank in enumerate(ranks.tolist())
            if rank < self.none
        ]
        heapq.heapify(heap)
        following = [*range(1, len(symbols)), -1]
        previous = list(range(-1, len(symbols) - 1))
        known = dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.results.tolist())))
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = following[i]
            if symbols[i] != left or j < 0 or symbols[j] != right:
                continue
            symbols[i] = known[left << 20 | right][1]
            symbols[j] = -1
            following[i] = following[j]
            if following[j] >= 0:
                previous[following[j]] = i
            for a in (previous[i], i):
                b = following[a] if a >= 0 else -1
                if b >= 0 and (pair := known.get(symbols[a] << 20 | symbols[b])):
                    heapq.heappush(heap, (pair[0], a, symbols[a], symbols[b]))
        return np.array([s for s in symbols if s >= 0], np.int32)


# --- tasks ----------------------------------------------------------------------

_loaded: dict = {}


def _once(key, build):
    """One object per worker; another vocabulary or lexicon replaces it."""
    kind = key[0]
    if _loaded.get(kind, (None,))[0] != key:
        _loaded[kind] = (key, build())
    return _loaded[kind][1]


def _library(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def _pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct pieces between white space, the number of each place's piece, text bounds."""
    lists = pc.utf8_split_whitespace(texts)
    coded = pc.dictionary_encode(lists.flatten())
    offsets = lists.offsets.to_numpy(zero_copy_only=False)
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), offsets - offsets[0]


def _lower(piece: str) -> str:
    return piece.lower()


def word_counts(texts: DataFrame, column: str = "text") -> DataFrame:
    """How often each word of the vocabulary's alphabet occurs, over all texts."""

    @task()
    def count(batches):
        counts: Counter = Counter()
        for batch in slices(batches, column):
            ordinary = whole(batch, column)
            ordinary = ordinary.filter(pc.invert(pc.match_substring_regex(ordinary, _UNUSUAL)))
            distinct, codes, _ = _pieces(ordinary)
            times = np.bincount(codes, minlength=len(distinct)).tolist()
            for piece, n in zip(distinct.to_pylist(), times):
                counts[piece] += n
            if len(counts) > _COUNTED_PIECES:
                yield _counted(counts)
                counts.clear()
        yield _counted(counts)

    counted = texts.select(column).mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _counted(pieces: Counter) -> pa.RecordBatch:
    counts: Counter = Counter()
    for piece, n in pieces.items():
        piece = _lower(piece)
        if piece.isalpha():
            counts[piece] += n
        else:
            for word in _PIECES.findall(piece):
                counts[word] += n
    return pa.RecordBatch.from_pydict(
        {"word": pa.array(counts.keys(), pa.string()), "n": pa.array(counts.values(), pa.int64())}
    )


def build_lexicon(
    spark: SparkSession,
    texts: DataFrame,
    path: str,
    column: str = "text",
    words: int = LEXICON_WORDS,
) -> bytes:
    """The compiled lexicon of the corpus' frequent words, ``words`` of them at most.

    Frequent is a word that occurs ``2 ** c`` times or more, with the least ``c`` that
    keeps within ``words``: a count for each power of two decides it, so that no more
    than the lexicon reaches the driver. The lexicon is also all that is broadcast. Words of
    more than ``_LEXICON_CHARS`` characters are left to the merges, which bounds its bytes.
    """
    counts = word_counts(texts, column).filter(F.length("word") <= _LEXICON_CHARS)
    counts = saved(spark, counts, "word-counts")
    power = F.floor(F.log2("n")).cast("int").alias("power")
    at_least, least = 0, 64
    for row in counts.groupBy(power).agg(F.count("*").alias("words")).orderBy(F.desc("power")).collect():
        at_least += row.words
        if at_least > words:
            break
        least = row.power
    frequent = [row.word for row in counts.filter(F.floor(F.log2("n")) >= least).collect()]
    encoded = Merges(path).encode([word.encode() for word in frequent])
    return compile_lexicon({w: ids.tolist() for w, ids in zip(frequent, encoded)})


def gathered(flat: np.ndarray, bounds: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of ``rows`` of a ragged table, one row after the other, and their bounds."""
    lengths = bounds[rows + 1] - bounds[rows]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    place = np.repeat(bounds[rows] - (ends - lengths), lengths) + np.arange(total)
    return flat[place], np.append(0, ends)


class Words:
    """Ids of the words met so far, as a ragged table; emptied when it is full."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}
        self.parts: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []

    def add(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        self.rows.update(zip(words, range(len(self.rows), len(self.rows) + len(words))))
        self.parts.append(ids)
        self.lengths.append(lengths)

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.parts) != 1:
            self.parts = [np.concatenate([*self.parts, np.empty(0, np.int32)])]
            self.lengths = [np.concatenate([*self.lengths, np.empty(0, np.int64)])]
        return self.parts[0], np.append(0, np.cumsum(self.lengths[0]))


class Encoder:
    """Encodes and decodes texts in a task.

    Python works on the distinct pieces of a slice only; ids of pieces and texts, and the
    bytes they decode to, are gathered from ragged arrays.
    """

    def __init__(self, lexicon: bytes, path: str):
        self.lexicon = Lexicon(lexicon)
        self.merges = Merges(path)
        self.library = _library(path)
        tokens = {i: t for t, i in self.merges.model["vocab"].items()}
        coded = [f"{tokens.get(i, '')} ".encode() for i in range(max(tokens) + 1)]
        # each token's bytes and the blank behind it
        self.token_bytes = np.frombuffer(b"".join(coded), np.uint8)
        self.token_bounds = np.cumsum([0, *map(len, coded)])
        self.words = Words()

    def _learn(self, words: list[str]) -> None:
        """Ids of new words, from the lexicon or by merging."""
        coded = [word.encode() for word in words]
        places = self.lexicon.places(coded)
        seen, unseen = np.flatnonzero(places >= 0), np.flatnonzero(places < 0).tolist()
        ids, bounds = gathered(self.lexicon.ids, self.lexicon.bounds, places[seen])
        self.words.add([words[i] for i in seen.tolist()], ids, np.diff(bounds))
        merged = self.merges.encode([coded[i] for i in unseen])
        flat = np.concatenate([*merged, np.empty(0, np.int32)]).astype(np.int32)
        lengths = np.array([len(each) for each in merged], np.int64)
        self.words.add([words[i] for i in unseen], flat, lengths)

    def of_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each piece, as a ragged table."""
        split: list[str] = []
        counts = []
        for piece in pieces:
            lowered = _lower(piece)
            if lowered.isalpha():
                split.append(lowered)
                counts.append(1)
            else:
                found = _PIECES.findall(lowered)
                split += found
                counts.append(len(found))
        new = set(split).difference(self.words.rows)
        if len(new) + len(self.words.rows) > _KNOWN_WORDS:
            self.words, new = Words(), set(split)
        if new:
            self._learn(list(new))
        rows = np.fromiter(map(self.words.rows.__getitem__, split), np.int64, len(split))
        ids, ends = gathered(*self.words.table(), rows)
        return ids, ends[np.append(0, np.cumsum(np.array(counts, np.int64)))]

    def decoded(self, ids: np.ndarray) -> bytes:
        """The text of some ids, their tokens with blanks between."""
        parts = [
            gathered(self.token_bytes, self.token_bounds, ids[first : first + _GATHERED_IDS])[0].tobytes()
            for first in range(0, len(ids), _GATHERED_IDS)
        ]
        return b"".join(parts)[:-1]

    def coded(self, texts: pa.Array) -> Iterator[tuple[bytes, bytes]]:
        """Ids, and the text they decode to, of each text, as bytes."""
        unusual = pc.match_substring_regex(texts, _UNUSUAL).to_numpy(zero_copy_only=False)
        ordinary = pc.if_else(pa.array(~unusual), texts, "")
        distinct, codes, bounds = _pieces(ordinary)
        table = self.of_pieces(distinct.to_pylist())
        for row, other in enumerate(unusual.tolist()):
            if other:
                ids = self.library.encode(texts[row].as_py(), add_special_tokens=False).ids
                decoded = self.library.decode(ids, skip_special_tokens=False)
                yield np.array(ids, "<u4").tobytes(), decoded.encode()
            else:
                own = codes[bounds[row] : bounds[row + 1]]
                ids = gathered(*table, own)[0]
                yield ids.astype("<u4").tobytes(), self.decoded(ids)

    def of_texts(self, texts: pa.Array) -> Iterator[tuple[bytes, str]]:
        """Ids as bytes and decoded text of each text."""
        for ids, decoded in self.coded(texts):
            yield ids, decoded.decode()


def encode_texts(
    spark: SparkSession,
    texts: DataFrame,
    path: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    lexicon_words: int = LEXICON_WORDS,
    digest: bool = False,
) -> DataFrame:
    """Ids of every whole text and the text they decode to.

    Columns: the id, ``n_tokens`` and either ``ids`` (little-endian unsigned 32-bit
    integers, as bytes) and ``decoded``, or with ``digest`` the SHA-256 of both.
    ``path`` is the vocabulary file, on every executor.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    block = build_lexicon(spark, texts, path, text_column, lexicon_words)
    key = ("encoder", path, hashlib.sha256(block).hexdigest())
    shared = spark.sparkContext.broadcast(block)
    id_type = texts.schema[id_column].dataType.simpleString()
    names = ("ids_sha256", "decoded_sha256") if digest else ("ids", "decoded")
    kinds = (pa.string(), pa.string()) if digest else (pa.binary(), pa.string())

    @task()
    def encode(batches):
        for batch in slices(batches, "text", _SLICE_BYTES):
            encoder = _once(key, lambda: Encoder(shared.value, path))
            counts, first, second = [], [], []
            for ids, decoded in encoder.coded(whole(batch, "text")):
                counts.append(len(ids) // 4)
                first.append(hashlib.sha256(ids).hexdigest() if digest else ids)
                second.append(hashlib.sha256(decoded).hexdigest() if digest else decoded.decode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(counts, pa.int64()),
                    pa.array(first, kinds[0]),
                    pa.array(second, kinds[1]),
                ],
                ["id", "n_tokens", *names],
            )

    sql_kinds = ("string", "string") if digest else ("binary", "string")
    schema = f"id {id_type}, n_tokens long, {names[0]} {sql_kinds[0]}, {names[1]} {sql_kinds[1]}"
    chosen = texts.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return chosen.mapInArrow(encode, schema).withColumnRenamed("id", id_column)


def decode_ids(tokens: DataFrame, path: str | None = None, column: str = "ids") -> DataFrame:
    """The table with a column ``decoded`` for a column of ids as bytes; null stays null."""
    path = path or public_tokenizers.path(VOCABULARY)

    @F.pandas_udf("string")
    def decode(ids):
        library = _once(("library", path), lambda: _library(path))
        return ids.map(
            lambda each: None
            if each is None
            else library.decode(np.frombuffer(each, "<u4").tolist(), skip_special_tokens=False)
        )

    return tokens.withColumn("decoded", decode(F.col(column)))
