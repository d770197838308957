"""Operator 4, language identification by compression.

For each language, raw text in it is the dictionary of a zstandard compressor. A text is
cut into pieces, so that it does not become its own dictionary; each piece is compressed
with every dictionary, and the language that makes the whole text smallest is chosen. The
score is the softmax of the saved bits (a quarter of them, as bits of neighbouring words
are not independent); a text whose margin is below ``MIN_MARGIN`` is marked as rejected.

Dictionaries come from at most ``FIT_ROWS`` rows per language, chosen by a 64-bit hash of
id and text (the row of the least hash is always among them), and have at most
``DICTIONARY_BYTES`` each, so that what is collected and broadcast is bounded by the number
of languages. Of each row ``PIECES`` pieces of ``PIECE_CHARS`` characters are taken, one
from each part of the text; every row gives one piece before any gives its next. So a
common header is not all that is learned of long texts.

Defined results: null texts and texts without a letter are ``und`` with score 0 (and
rejected); of equal sizes the language with more rows to learn from is chosen, then the
first by name; rows with a null or empty language or without a letter are not learned
from, and a language none of whose pieces has a letter is left out with a warning; without any row
to learn from everything is ``und``; repeated rows get equal results; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import warnings
from collections import defaultdict

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.llm.bpe import _once
from goldpan.llm.common import hash_share, slices, whole

FIT_ROWS = 400
DICTIONARY_BYTES = 96 << 10
PIECES = 8
PIECE_CHARS = 250
PIECE_BYTES = 1_000
MIN_MARGIN = 0.02
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_HAS_LETTER = r"[\p{L}\p{Nl}\p{No}]"  # what _LETTER finds
_OTHERS = re.compile(r"[\W\d_]+")
# short matches are what tells languages apart; levels of the library start at longer ones
_COMPRESSION = zstandard.ZstdCompressionParameters(
    window_log=18,
    hash_log=17,
    chain_log=17,
    search_log=3,
    min_match=4,
    strategy=zstandard.STRATEGY_LAZY,
    write_content_size=0,
    write_dict_id=0,
)


def normal(text: str) -> bytes:
    """Lower-case letters with single blanks: what dictionaries and pieces are made of."""
    return _OTHERS.sub(" ", text.lower()).encode("utf-8", "replace")


def _pieces(text: Column, place: Column) -> Column:
    """The pieces of a text to learn from: one at a hashed place in each of its parts."""
    part = F.greatest(F.ceil(F.length(text) / PIECES), F.lit(PIECE_CHARS))

    def piece(i: Column) -> Column:
        room = part - PIECE_CHARS + 1
        start = i * part + F.pmod(F.xxhash64(place, i), room)
        return F.substring(text, start.cast("int") + 1, F.lit(PIECE_CHARS))

    return F.transform(F.sequence(F.lit(0), F.lit(PIECES - 1)), piece)


def fit(docs: DataFrame, rows: int = FIT_ROWS) -> dict[str, bytes]:
    """The dictionary of each language of ``docs(doc_id, text, lang)``, larger ones first."""
    known = docs.filter("lang <> '' and text is not null").filter(F.col("text").rlike(_HAS_LETTER))
    known = known.select("lang", "text", F.xxhash64(F.col("doc_id").cast("string"), "text").alias("place"))
    sizes = known.groupBy("lang").agg(F.count("*").alias("n"), F.min("place").alias("least"))
    sizes = sizes.collect()
    if not sizes:
        return {}
    chosen = F.lit(False)
    for size in sizes:
        among = hash_share(F.col("place"), min(1.0, 0.9 * rows / size.n))
        chosen = chosen | ((F.col("lang") == size.lang) & (among | (F.col("place") == size.least)))
    sample = known.filter(chosen).select("lang", "place", _pieces(F.col("text"), F.col("place")).alias("pieces"))
    # repeated rows have one place, so none of them crowds out others
    sample = sample.groupBy("lang", "place").agg(F.min("pieces").alias("pieces"))
    texts = defaultdict(list)
    for row in sorted(sample.collect(), key=lambda row: row.place):
        if len(texts[row.lang]) < rows:
            first = row.place % PIECES
            texts[row.lang].append(row.pieces[first:] + row.pieces[:first])
    found = {}
    for size in sorted(sizes, key=lambda s: (-s.n, s.lang)):
        pieces = dict.fromkeys(p for turn in zip(*texts[size.lang]) for p in turn if _LETTER.search(p))
        if pieces:
            found[size.lang] = b" ".join(dict.fromkeys(map(normal, pieces)))[:DICTIONARY_BYTES]
        else:
            warnings.warn(f"no letters in the pieces of language {size.lang!r}: it is never predicted", stacklevel=2)
    return found


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.languages = list(dictionaries)
        self.compressors = [self._compressor(data) for data in dictionaries.values()]

    @staticmethod
    def _compressor(data: bytes):
        own = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        own.precompute_compress(compression_params=_COMPRESSION)
        return zstandard.ZstdCompressor(compression_params=_COMPRESSION, dict_data=own)

    def sizes(self, text: str) -> np.ndarray:
        """Compressed bytes of the whole text with each language's dictionary."""
        data = normal(text)
        pieces = [data[i : i + PIECE_BYTES] for i in range(0, len(data), PIECE_BYTES)]
        return np.array([sum(len(c.compress(p)) for p in pieces) for c in self.compressors])

    def predict(self, text: str) -> tuple[str, float, float]:
        """Language, score and margin: the share of its size by which the next is larger."""
        if not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0, 0.0
        sizes = self.sizes(text)
        best = int(sizes.argmin())
        others = np.delete(sizes, best)
        margin = float(others.min() / sizes[best] - 1) if len(others) else 1.0
        score = float(1 / np.exp2(np.maximum(-50, (sizes[best] - sizes) * 8 / 4)).sum())
        return self.languages[best], score, margin


def held_out(column: Column) -> Column:
    """Whether a row is kept from learning: CRC-32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(spark: SparkSession, docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """``doc_id, lang_pred, score, margin, rejected`` of every row."""
    shared = spark.sparkContext.broadcast(dictionaries)
    key = ("languages", hash(tuple(dictionaries.items())))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def predict(batches):
        classifier = _once(key, lambda: Classifier(shared.value))
        for batch in slices(batches, "text"):
            found = [classifier.predict(t) for t in whole(batch, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                    pa.array([f[2] for f in found], pa.float64()),
                    pa.array([f[2] < MIN_MARGIN for f in found], pa.bool_()),
                ],
                ["doc_id", "lang_pred", "score", "margin", "rejected"],
            )

    schema = f"doc_id {id_type}, lang_pred string, score double, margin double, rejected boolean"
    return docs.select("doc_id", "text").mapInArrow(predict, schema)


def predict(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Languages of every row by dictionaries from the rows that are not held out."""
    out = held_out(F.col("doc_id"))
    found = identify(spark, docs, fit(docs.filter(~out)))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score", "margin", "rejected")
