"""Operator 8, toxicity by FTRL-proximal logistic regression.

A text's features are hashed: its words, the beginnings of its words (so that forms of
one stem share a weight), pairs of neighbouring words, and pairs of words with one or two
others between them. A feature counts once in a text. Each coordinate has a learning rate
of its own, and L1 leaves only the weights that pay, so the model is a short list of
places and weights that can be broadcast.

Learning goes over at most ``FIT_ROWS`` labelled rows, chosen by a hash of the id. They
are few enough for one task, which makes ``EPOCHS`` passes in the order of that hash and
returns the weights that L1 has left.

Defined results: null and empty texts have no feature and get the score of the intercept
alone; rows without a label, or with a null label, are not learned from; with no labelled
row every score is 0.5; repeated rows get equal scores; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.llm.common import Cache, hash_share, mix64, slices, task, whole

FIT_ROWS = 10_000
EPOCHS = 3
BITS = 22
ALPHA, BETA, L1, L2 = 1.0, 1.0, 6.0, 0.1
STEM_CHARS = (4, 5)
GAPS = (1, 2, 3)
_MAX_ROWS = 60_000
_INTERCEPT = 1 << BITS

_hashes = Cache()


def _word_codes(word: str) -> tuple[int, ...]:
    """Hashes of a word and of its beginnings; zeros for what is no word."""
    core = word if word.isalnum() else "".join(filter(str.isalnum, word))
    if not core:
        return (0,) * (1 + len(STEM_CHARS))
    parts = [core, *(f"{core[:n]}-{n}" if len(core) > n else "" for n in STEM_CHARS)]
    return tuple((xxhash.xxh3_64_intdigest(p) or 1) if p else 0 for p in parts)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Places of the features of all texts and the text of each, not yet distinct."""
    lists = pc.utf8_split_whitespace(pc.utf8_lower(texts))
    coded = pc.dictionary_encode(lists.flatten())
    distinct = coded.dictionary.to_pylist()
    for word in _hashes.missing(distinct):
        _hashes[word] = np.array(_word_codes(word), np.uint64).tobytes()
    table = np.frombuffer(b"".join(map(_hashes.__getitem__, distinct)), np.uint64)
    table = table.reshape(-1, 1 + len(STEM_CHARS))
    codes = coded.indices.to_numpy(zero_copy_only=False)
    counts = np.diff(lists.offsets.to_numpy(zero_copy_only=False))
    owner = np.repeat(np.arange(len(counts)), counts)
    kept = table[codes, 0] != 0
    codes, owner = codes[kept], owner[kept]
    words = table[codes, 0]
    parts, owners = [words], [owner]
    for k in range(len(STEM_CHARS)):
        stems = table[codes, 1 + k]
        parts.append(stems[stems != 0])
        owners.append(owner[stems != 0])
    for gap in GAPS:
        same = owner[gap:] == owner[:-gap]
        pairs = mix64(words[:-gap] * np.uint64(2 * gap + 1) + mix64(words[gap:]))
        parts.append(pairs[same])
        owners.append(owner[gap:][same])
    places = (np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int64)
    return places, np.concatenate(owners)


# --- learning -------------------------------------------------------------------


@dataclass
class Model:
    """Places and weights of the features that have one, and the intercept."""

    places: np.ndarray
    weights: np.ndarray
    intercept: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        dense = self.dense()
        places, owners = features(texts)
        hit = dense[places] != 0
        places, owners = places[hit], owners[hit]
        key = np.unique(owners << BITS | places)
        sums = np.bincount(key >> BITS, dense[key & (_INTERCEPT - 1)], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(sums[: len(texts)] + self.intercept, -30, 30)))

    def dense(self) -> np.ndarray:
        if not hasattr(self, "_dense"):
            self._dense = np.zeros(_INTERCEPT, np.float32)
            self._dense[self.places] = self.weights
        return self._dense


def _weights(z: np.ndarray, n: np.ndarray, l1: float) -> np.ndarray:
    """The closed form of the proximal step: zero unless ``z`` exceeds the L1 penalty."""
    shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0)
    return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)


def _epoch(rows: list[tuple[np.ndarray, int]], z: np.ndarray, n: np.ndarray) -> None:
    """One pass in place; the last coordinate is the intercept, which L1 leaves alone."""
    for places, label in rows:
        w = _weights(z[places], n[places], L1)
        w[-1] = _weights(z[places[-1:]], n[places[-1:]], 0.0)[0]
        p = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30)))
        g = p - label
        rate = (np.sqrt(n[places] + g * g) - np.sqrt(n[places])) / ALPHA
        z[places] += g - rate * w
        n[places] += g * g


def fit(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS
) -> Model:
    """Learn from ``labels(doc_id, toxic)`` and the texts of the same ids."""
    known = labels.filter("toxic is not null").select("doc_id", "toxic")
    total = known.count()
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1_000_000))
    share = min(1.0, 0.95 * rows / max(total, 1))
    chosen = known.filter(hash_share(F.xxhash64(F.col("doc_id").cast("string")), share))
    chosen = chosen.withColumn("place", place)
    examples = docs.select("doc_id", "text").join(chosen, "doc_id").limit(rows)
    examples = examples.select("text", F.col("toxic").cast("int").alias("toxic"), "place")

    @task(_hashes)
    def prepare(batches):
        for batch in _parts(batches):
            places, owners = features(whole(batch, "text"))
            key = np.unique(owners << BITS | places)
            ends = np.searchsorted(key, np.arange(batch.num_rows + 1) << BITS)
            own = (key & (_INTERCEPT - 1)).astype(np.int32)
            last = np.array([_INTERCEPT], np.int32).tobytes()
            rows = [own[a:b].tobytes() + last for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.binary()), batch.column("toxic"), batch.column("place")],
                ["features", "toxic", "place"],
            )

    def learn(table: pa.Table) -> pa.Table:
        z, n = np.zeros(_INTERCEPT + 1), np.zeros(_INTERCEPT + 1)
        order = pc.sort_indices(table, [("place", "ascending"), ("features", "ascending")])
        # views of the table's own memory
        features, toxic = table["features"], table["toxic"].to_pylist()
        rows = [
            (np.frombuffer(features[i].as_buffer(), np.int32), toxic[i]) for i in order.to_pylist()
        ]
        for _ in range(EPOCHS):
            _epoch(rows, z, n)
        w = _weights(z, n, L1)
        w[-1] = _weights(z[-1:], n[-1:], 0.0)[0]
        used = np.append(np.flatnonzero(w[:-1]), _INTERCEPT)
        return pa.table({"place": pa.array(used), "weight": pa.array(w[used])})

    examples = examples.mapInArrow(prepare, "features binary, toxic int, place long")
    learned = examples.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(learn, "place long, weight double")
    weights = {row.place: row.weight for row in learned.collect()}
    intercept = weights.pop(_INTERCEPT, 0.0)
    places = np.array(sorted(weights), np.int64)
    return Model(places, np.array([weights[p] for p in places.tolist()], np.float32), intercept)


def _parts(batches):
    for batch in slices(batches, "text"):
        for first in range(0, batch.num_rows, _MAX_ROWS):
            yield batch.slice(first, _MAX_ROWS)


def held_out(column: Column) -> Column:
    """Whether a row's label is kept from learning: CRC-32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def scored(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row."""
    shared = spark.sparkContext.broadcast(model)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    @task(_hashes)
    def score(batches):
        for batch in _parts(batches):
            scores = shared.value.scores(whole(batch, "text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"]
            )

    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {id_type}, score double")


def keep_clean(
    spark: SparkSession, docs: DataFrame, model: Model, threshold: float = 0.5
) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    shared = spark.sparkContext.broadcast(model)

    @task(_hashes)
    def keep(batches):
        for batch in _parts(batches):
            yield batch.filter(pa.array(shared.value.scores(whole(batch, "text")) < threshold))

    return docs.mapInArrow(keep, docs.schema)


def predict(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of every row by a model that has not seen the held-out labels."""
    model = fit(spark, docs, labels.filter(~held_out(F.col("doc_id"))))
    result = scored(spark, docs, model)
    return result.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
