"""Operator 9, token ids in binary blocks.

Ids are numbered anew by their frequency in the corpus and written in byte-aligned
variable-length code: one to four data bytes for each id, and two bits of a separate
control byte for its length, so that a block is decoded by numpy table lookups. A block
carries everything needed to read it: document ids, document lengths, control and data
bytes. Blocks are rows of Parquet files, so Spark's committer makes their writing atomic
and a lost task is just run again.

Documents are dealt out by ranges of their id first, as compressed texts, and encoded in
that order; no later step moves them again. The order of equal ids is that of their
compressed texts.

Defined results: a null text is read as empty and gives the end id alone; null document
ids come first; repeated rows are all kept; an empty table gives no blocks; columns other
than the id and the text are not read. Ids are 64-bit integers (others are cast, and fail if
they can't be); the least of them, -2^63, stands for null and comes back as null.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from goldpan.llm.bpe import Words, _library, _once, gathered
from goldpan.llm.common import saved, slices, whole
from goldpan.session import scratch_dir

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
BLOCK_TOKENS = 1 << 20
MAGIC = b"GPTK"
_NULL_ID = -(1 << 63)
_SLICE_BYTES = 4 << 20
_KNOWN_WORDS = 700_000

# white space as the vocabulary's own pattern has it; words always end at it
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PIECES = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
# begins with one blank and does not end with white space
_WORD = re.compile(f" [^{_SPACE}](?:.*[^{_SPACE}])?", re.DOTALL).fullmatch
_LATIN_END = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]$"
_MARKS = ".,;:!?"
_JOINED = 256
# runs of white space: only without them a text may be cut at its blanks
_RUNS = f"[{_SPACE}][{_SPACE}]|<\\|endoftext\\|>"


# --- variable-length code -------------------------------------------------------


def code_lengths(values: np.ndarray) -> np.ndarray:
    return 1 + (values > 0xFF) + (values > 0xFFFF) + (values > 0xFFFFFF)


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes, of four lengths each, and data bytes, little end first."""
    values = values.astype("<u4")
    lengths = code_lengths(values)
    padded = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    padded[: len(values)] = lengths - 1
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1)
    kept = np.arange(4) < lengths[:, None]
    data = values.view(np.uint8).reshape(-1, 4)[kept]
    return control.astype(np.uint8).tobytes(), data.tobytes()


_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def decode_values(control: bytes, data: bytes, count: int) -> np.ndarray:
    """Four lengths from a table for each control byte, then one masked load for each value."""
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count].astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    raw = np.frombuffer(data + bytes(3), np.uint8)
    values = raw[starts].astype(np.uint32)
    for byte in (1, 2, 3):
        values |= raw[starts + byte].astype(np.uint32) << np.uint32(8 * byte)
    return values & _MASKS[lengths]


@dataclass
class Block:
    doc_ids: np.ndarray
    lengths: np.ndarray
    ranks: np.ndarray

    def to_bytes(self) -> bytes:
        control, data = encode_values(self.ranks)
        head = np.array([len(self.lengths), len(self.ranks), len(control), len(data)], "<i8")
        parts = (head, self.doc_ids.astype("<i8"), self.lengths.astype("<i8"))
        return MAGIC + b"".join(part.tobytes() for part in parts) + control + data

    @staticmethod
    def from_bytes(block: bytes) -> Block:
        if block[:4] != MAGIC:
            raise ValueError("not a block of token ids")
        docs, tokens, controls, size = np.frombuffer(block, "<i8", 4, 4).tolist()
        at = 36
        doc_ids = np.frombuffer(block, "<i8", docs, at)
        lengths = np.frombuffer(block, "<i8", docs, at + 8 * docs)
        at += 16 * docs
        if len(block) != at + controls + size:
            raise ValueError("a block of token ids is cut short")
        ranks = decode_values(block[at : at + controls], block[at + controls :], tokens)
        return Block(doc_ids, lengths, ranks)


# --- encoding -------------------------------------------------------------------


def _strings(array: pa.Array) -> list[str]:
    return array.to_numpy(zero_copy_only=False).tolist()


class PieceEncoder:
    """Ids of texts by the library, each distinct word once while there is room.

    Unseen words are joined to longer texts, which the library cuts at the same blanks, and
    the ids are told apart by the bytes they stand for. Marks behind a Latin letter are
    words of their own, so a word is met once whatever follows it.
    """

    def __init__(self, path: str):
        self.library = _library(path)
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        tokens = map(self.library.id_to_token, range(self.library.get_vocab_size()))
        # one character of the byte alphabet for each byte
        self.sizes = np.array([len(token or "") for token in tokens], np.int64)
        self.words = Words()

    def _rows(self, words: list[str]) -> np.ndarray:
        """Rows of distinct words in the table; what has none yet is encoded."""
        known = self.words.rows
        new = [word for word in words if word not in known]
        if len(known) + len(new) > _KNOWN_WORDS:
            self.words, new = Words(), words
        joined = [word for word in new if _WORD(word)]
        self._learn_joined(joined)
        self._learn([word for word in new if word not in self.words.rows])
        return np.fromiter(map(self.words.rows.__getitem__, words), np.int64, len(words))

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(each.ids, np.int32) for each in found]

    def _learn(self, words: list[str]) -> None:
        if words:
            ids = self._encode(words)
            self.words.add(words, np.concatenate(ids), np.array(list(map(len, ids)), np.int64))

    def _learn_joined(self, words: list[str]) -> None:
        """Ids of words that begin with a blank; none are kept if ids and bytes don't agree."""
        if not words:
            return
        starts = range(0, len(words), _JOINED)
        ids = np.concatenate(self._encode(["".join(words[s : s + _JOINED]) for s in starts]))
        ends = np.cumsum(self.sizes[ids])
        word_ends = np.cumsum([len(word.encode()) for word in words])
        counts = np.searchsorted(ends, word_ends) + 1
        if counts[-1] == len(ids) and (ends[counts - 1] == word_ends).all():
            self.words.add(words, ids, np.diff(counts, prepend=0))

    def _cut_anywhere(self, text: str) -> bytes:
        if any(special in text for special in self.specials):
            return self._encode([text])[0].tobytes()
        pieces = _PIECES.findall(text)
        distinct = list(dict.fromkeys(pieces))
        place = dict(zip(distinct, self._rows(distinct).tolist()))
        rows = np.array([place[piece] for piece in pieces], np.int64)
        return gathered(*self.words.table(), rows)[0].tobytes()

    def _of_pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each piece, as a ragged table."""
        cores = pc.utf8_rtrim(pieces, _MARKS)
        sizes = pc.subtract(pc.binary_length(pieces), pc.binary_length(cores))
        cut = pc.and_(pc.greater(sizes, 0), pc.match_substring_regex(cores, _LATIN_END))
        sizes = sizes.filter(cut).to_numpy().tolist()
        tails = [piece[-size:] for piece, size in zip(_strings(pieces.filter(cut)), sizes)]
        cores = pc.if_else(cut, cores, pieces)
        units = pc.dictionary_encode(pa.concat_arrays([cores, pa.array(tails, pa.string())]))
        rows = self._rows(_strings(units.dictionary))
        rows = rows[units.indices.to_numpy(zero_copy_only=False)]
        cut = cut.to_numpy(zero_copy_only=False)
        ends = np.cumsum(1 + cut)
        both = np.empty(len(rows), np.int64)
        both[ends - 1 - cut] = rows[: len(pieces)]
        both[ends[cut] - 1] = rows[len(pieces) :]
        ids, bounds = gathered(*self.words.table(), both)
        return ids, bounds[np.append(0, ends)]

    def of_texts(self, texts: pa.Array) -> list[bytes]:
        """Texts with single white space only are cut at blanks, all at once."""
        if not len(texts):
            return []
        other = pc.match_substring_regex(texts, _RUNS).to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(pc.if_else(pa.array(~other), texts, ""), " ")
        coded = pc.dictionary_encode(lists.flatten())
        offsets = lists.offsets.to_numpy(zero_copy_only=False)
        offsets = offsets - offsets[0]
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        # a text's first piece has no blank before it
        first = coded.dictionary.take(pa.array(codes[offsets[:-1]]))
        codes[offsets[:-1]] = len(coded.dictionary) + np.arange(len(first))
        behind = pc.binary_join_element_wise("", coded.dictionary, " ")
        ids, bounds = gathered(*self._of_pieces(pa.concat_arrays([behind, first])), codes)
        bounds = bounds[offsets].tolist()
        return [
            self._cut_anywhere(texts[row].as_py())
            if other[row]
            else ids[bounds[row] : bounds[row + 1]].tobytes()
            for row in range(len(texts))
        ]


def in_order(texts: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``part, id, size, packed``: texts, compressed, dealt out and sorted by ascending id.

    The ranges' ends are approximate quantiles of the ids, so the texts are read once.
    """
    chosen = texts.select(
        F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text")
    )
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(1, parts)]
    ends = chosen.approxQuantile("id", shares, 0.1 / parts) if shares else []
    ends = np.unique(np.array(ends, np.float64))

    def pack(batches):
        for batch in slices(batches, "text"):
            ids = pc.fill_null(batch.column("id"), _NULL_ID).to_numpy(zero_copy_only=False)
            squeeze = zstandard.ZstdCompressor(level=1).compress
            packed = [squeeze(t.encode()) for t in whole(batch, "text").to_pylist()]
            part = np.searchsorted(ends, ids.astype(np.float64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part, pa.int32()),
                    batch.column("id"),
                    pc.fill_null(pc.binary_length(batch.column("text")), 0).cast(pa.int64()),
                    pa.array(packed, pa.binary()),
                ],
                ["part", "id", "size", "packed"],
            )

    packed = chosen.mapInArrow(pack, "part int, id long, size long, packed binary")
    return packed.repartitionById(parts, "part").sortWithinPartitions("id", "packed")


def encode_in_order(
    texts: DataFrame, path: str, id_column: str, text_column: str, end_id: int
) -> DataFrame:
    """Runs of documents in ascending id order: ``part``, ``seq``, ids, lengths, token ids."""
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches):
        seq, unpack = 0, zstandard.ZstdDecompressor().decompress
        for batch in slices(batches, "size", _SLICE_BYTES):
            encoder = _once(("pieces", path), lambda: PieceEncoder(path))
            own = pa.array([unpack(p) for p in batch.column("packed").to_pylist()], pa.binary())
            found = [ids + end for ids in encoder.of_texts(own.cast(pa.string()))]
            ids = pc.fill_null(batch.column("id"), _NULL_ID).to_numpy(zero_copy_only=False)
            lengths = np.array([len(f) // 4 for f in found], "<i8")
            tokens = np.frombuffer(b"".join(found), "<u4")
            kind = "<u2" if tokens.max(initial=0) < 1 << 16 else "<u4"
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("part").slice(0, 1).cast(pa.int64()),
                    pa.array([seq], pa.int64()),
                    pa.array([ids.astype("<i8").tobytes()], pa.binary()),
                    pa.array([lengths.tobytes()], pa.binary()),
                    pa.array([int(kind[2])], pa.int32()),
                    pa.array([tokens.astype(kind).tobytes()], pa.binary()),
                ],
                ["part", "seq", "doc_ids", "lengths", "width", "tokens"],
            )
            seq += 1

    return in_order(texts, id_column, text_column).mapInArrow(
        encode, "part long, seq long, doc_ids binary, lengths binary, width int, tokens binary"
    )


def token_frequencies(runs: DataFrame) -> DataFrame:
    """How often each id occurs over all runs; one row for each id and task is moved."""

    def count(batches):
        totals = np.zeros(0, np.int64)
        for batch in batches:
            for width, tokens in zip(batch.column("width"), batch.column("tokens")):
                counts = np.bincount(np.frombuffer(tokens.as_py(), f"<u{width.as_py()}"))
                if len(counts) > len(totals):
                    totals = np.pad(totals, (0, len(counts) - len(totals)))
                totals[: len(counts)] += counts
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(totals[used], pa.int64())], ["token", "n"]
        )

    counted = runs.select("width", "tokens").mapInArrow(count, "token long, n long")
    return counted.groupBy("token").agg(F.sum("n").alias("n"))


@dataclass
class TokenFiles:
    """Written blocks: their folder and the token of each rank (as many as the vocabulary)."""

    path: str
    tokens: np.ndarray


def write_token_files(
    spark: SparkSession,
    texts: DataFrame,
    target: str,
    path: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int = END_ID,
) -> TokenFiles:
    """Encode every whole text, append ``end_id``, write blocks in ascending id order."""
    path = path or public_tokenizers.path(VOCABULARY)
    runs = encode_in_order(texts, path, id_column, text_column, end_id)
    runs = saved(spark, runs, "token-runs")
    ranked = token_frequencies(runs).orderBy(F.desc("n"), "token").collect()
    tokens = np.array([row.token for row in ranked], np.int64)
    ranks = np.zeros(int(tokens.max(initial=0)) + 1, np.int64)
    ranks[tokens] = np.arange(len(tokens))
    shared = spark.sparkContext.broadcast(ranks)

    def pack(batches):
        for batch in batches:
            for row in batch.to_pylist():
                values = shared.value[np.frombuffer(row["tokens"], f"<u{row['width']}")]
                ids = np.frombuffer(row["doc_ids"], "<i8")
                lengths = np.frombuffer(row["lengths"], "<i8")
                ends = np.cumsum(lengths)
                first = piece = 0
                while first < len(ids):
                    done = ends[first - 1] if first else 0
                    last = int(np.searchsorted(ends, done + BLOCK_TOKENS, side="right"))
                    last = max(first + 1, last)
                    own = values[done : ends[last - 1]]
                    block = Block(ids[first:last], lengths[first:last], own).to_bytes()
                    yield pa.RecordBatch.from_pydict(
                        {
                            "part": pa.array([row["part"]], pa.int64()),
                            "seq": pa.array([row["seq"]], pa.int64()),
                            "piece": pa.array([piece], pa.int64()),
                            "n_tokens": pa.array([len(own)], pa.int64()),
                            "block": pa.array([block], pa.binary()),
                        }
                    )
                    first, piece = last, piece + 1

    packed = runs.mapInArrow(pack, BLOCK_SCHEMA)
    packed.write.option("compression", "zstd").parquet(target)
    return TokenFiles(target, tokens)


BLOCK_SCHEMA = "part long, seq long, piece long, n_tokens long, block binary"


def read_token_files(spark: SparkSession, files: TokenFiles, digest: bool = False) -> DataFrame:
    """Documents from their blocks: ``doc_id``, ``start``, ``n_tokens`` and ``ids`` or a CRC-32.

    ``start`` counts the ids of all documents before. It is summed over parts first
    and inside each part then, so that no task sees all blocks.
    """
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(files.path)
    places = blocks.select("part", "seq", "piece", "n_tokens")
    parts = places.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    parts = parts.select("part", before.alias("part_start"))
    inside = Window.partitionBy("part").orderBy("seq", "piece")
    within = F.sum("n_tokens").over(inside) - F.col("n_tokens")
    starts = places.withColumn("within", within).join(parts, "part")
    starts = starts.select(
        "part", "seq", "piece", (F.col("part_start") + F.col("within")).alias("block_start")
    )
    shared = spark.sparkContext.broadcast(files.tokens)
    result, kind = ("ids_crc32 long", pa.int64()) if digest else ("ids binary", pa.binary())

    def unpack(batches):
        for batch in batches:
            for start, data in zip(batch.column("block_start"), batch.column("block")):
                block = Block.from_bytes(data.as_py())
                ids = shared.value[block.ranks].astype("<u4").tobytes()
                ends = np.cumsum(block.lengths)
                begins = ends - block.lengths
                each = [ids[4 * a : 4 * b] for a, b in zip(begins.tolist(), ends.tolist())]
                named = pa.array(block.doc_ids, mask=block.doc_ids == _NULL_ID)
                yield pa.RecordBatch.from_arrays(
                    [
                        named,
                        pa.array(begins + start.as_py(), pa.int64()),
                        pa.array(block.lengths, pa.int64()),
                        pa.array([zlib.crc32(e) for e in each] if digest else each, kind),
                    ],
                    ["doc_id", "start", "n_tokens", result.split()[0]],
                )

    read = blocks.join(starts, ["part", "seq", "piece"]).select("block_start", "block")
    return read.mapInArrow(unpack, f"doc_id long, start long, n_tokens long, {result}")


def token_digests(spark: SparkSession, texts: DataFrame, path: str | None = None) -> DataFrame:
    """Write the texts' ids to new files in the shared folder and read them back."""
    files = write_token_files(spark, texts, scratch_dir(spark, "token-files"), path)
    return read_token_files(spark, files, digest=True)
