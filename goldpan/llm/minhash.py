"""Operator 1, near-duplicate classes by ProbMinHash.

A text is the bag of its runs of five words (a shorter text is one run of all its
words). The similarity of two bags is the probability Jaccard
``sum_i 1 / sum_j max(x_j / x_i, y_j / y_i)`` over common runs ``i``, which is the
Jaccard similarity when no run repeats. A signature has a register for each part of a
band: every run lets a Poisson process of arrivals go whose rate is its weight, each
arrival falls into a random register, and a register keeps the run that arrived first.
Arrivals later than a limit, by which every register is filled, are never made.

Bands of registers give buckets. In each bucket all texts are compared with the one
that comes first in a fixed random order; pairs are verified by their exact
similarity and joined to components. In buckets that then still hold several components
all members of different ones are compared in blocks of bounded size, by signatures;
components that may belong together make clusters, and in these all members of different
components are compared exactly, in blocks again. A block returns which components it
has joined and no pairs, so no link that shares a band is lost, and a group of copies
never becomes all its pairs.

With 24 bands of 5 a pair of similarity 0.8 shares no band with probability 7e-5.

Defined results: equal texts (as word sequences) are one class from the start; texts
without words are one class if their characters are equal; a null text is alone in its
class, whose id is the row's own id; null ids are allowed and never the least; repeated rows are all returned; an empty table gives an
empty result; other columns are ignored, so clashing names do no harm.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.llm.common import known_words, mix64, saved, slices, task, whole, word_hashes
from goldpan.llm.components import connected_components

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS = 24
BAND_ROWS = 5
# standard deviations of an estimate below the threshold at which a pair is still verified
_MARGIN = 4.0
_CHUNK, _SLICE = 512, 4096
_CHUNK_BYTES, _SLICE_BYTES = 1 << 20, 8 << 20
_MAX_ROWS = 60_000  # of a slice, whose text numbers take 16 bits of a sort key
_MAX_REGISTERS = 1 << 21  # of all texts of a slice, 16 bytes each
_HEAVY = 0xFFFF  # a weight in a bag's own 16 bits; greater ones follow the bag


# --- shingles and signatures ----------------------------------------------------


def shingles(
    words: np.ndarray, bounds: np.ndarray, size: int = SHINGLE_WORDS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles (48 bits), their text's number and their weight, by text and hash."""
    counts = np.diff(bounds)
    texts = np.flatnonzero(counts)
    lengths = np.minimum(counts[texts], size)
    # a shingle begins at each word of a text but its last few; a short text has one
    number = counts[texts] - lengths + 1
    owner = np.repeat(texts, number)
    first = np.cumsum(number) - number
    begin = np.arange(len(owner)) - np.repeat(first - bounds[texts], number)
    value = np.zeros(len(owner), np.uint64)
    width = np.repeat(lengths, number)
    last = max(len(words) - 1, 0)
    for k in range(size):
        term = words[np.minimum(begin + k, last)] if len(words) else value
        value = value * np.uint64(0x9E3779B97F4A7C15) + np.where(width > k, term, np.uint64(k))
    key = np.sort(owner.astype(np.uint64) << np.uint64(48) | mix64(value) >> np.uint64(16))
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else key
    starts = starts.astype(np.int64)
    weights = np.diff(np.concatenate([starts, [len(key)]]))
    key = key[starts]
    return key & np.uint64((1 << 48) - 1), (key >> np.uint64(48)).astype(np.int64), weights


def signatures(
    hashes: np.ndarray, owners: np.ndarray, weights: np.ndarray, texts: int, registers: int
) -> np.ndarray:
    """For each text and register, the shingle whose arrival there is first; 0 without any."""
    first = np.full(texts * registers, np.inf)
    chosen = np.zeros(texts * registers, np.uint64)
    total = np.bincount(owners, weights, minlength=texts)
    with np.errstate(divide="ignore"):
        limit = registers / total * (np.log(registers) + 2.5)
    todo = total > 0
    while todo.any():
        active = np.flatnonzero(todo[owners])
        at = np.zeros(len(active))
        turn = 0
        while len(active):
            bits = mix64(hashes[active] + np.uint64((turn * 0xD1B54A32D192ED03) & (1 << 64) - 1))
            # the high half gives the time, the low half the register
            uniform = ((bits >> np.uint64(32)).astype(np.float64) + 0.5) * 2.0**-32
            at -= np.log(uniform) / weights[active]
            kept = at <= limit[owners[active]]
            active, at, bits = active[kept], at[kept], bits[kept]
            low = (bits & np.uint64(0xFFFFFFFF)) * np.uint64(registers) >> np.uint64(32)
            place = owners[active] * registers + low.astype(np.int64)
            np.minimum.at(first, place, at)
            won = first[place] == at
            chosen[place[won]] = hashes[active[won]]
            turn += 1
        filled = np.isfinite(first.reshape(texts, registers)).all(axis=1)
        todo &= ~filled
        limit[todo] *= 2
    return chosen.reshape(texts, registers)


def _sketch(texts: pa.Array, bands: int, rows: int, size: int):
    """Class keys, one-byte signatures, band keys and which texts have words, of a slice.

    A text without words has the key of its own characters, a null text none.
    """
    words, bounds = word_hashes(pc.fill_null(texts, ""))
    keys = [
        xxhash.xxh3_128_digest(words[a:b].tobytes()) if b > a else None
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())
    ]
    counted = np.diff(bounds) > 0
    for row in np.flatnonzero(~counted).tolist():
        if (text := texts[row].as_py()) is not None:
            keys[row] = xxhash.xxh3_128_digest(b"no words:" + text.encode())
    hashes, owners, weights = shingles(words, bounds, size)
    registers = signatures(hashes, owners, weights, len(keys), bands * rows)
    short = (mix64(registers) >> np.uint64(56)).astype(np.uint8)
    value = np.zeros((len(keys), bands), np.uint64)
    for part in registers.reshape(len(keys), bands, rows).transpose(2, 0, 1):
        value = mix64(value ^ part + np.uint64(0x9E3779B97F4A7C15))
    value = mix64(value + np.arange(bands, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
    return keys, short, value.view(np.int64), counted


def sketches(docs: DataFrame, bands: int, rows: int, size: int) -> DataFrame:
    """``doc_id, text_key, key, signature, bands`` of every row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    chosen = docs.select("doc_id", F.md5("text").alias("text_key"), "text")

    step = max(1, min(_MAX_ROWS, _MAX_REGISTERS // (bands * rows)))

    @task(known_words)
    def sketch(batches):
        for batch in slices(batches, "text"):
            for first in range(0, batch.num_rows, step):
                part = batch.slice(first, step)
                keys, short, values, counted = _sketch(part.column("text"), bands, rows, size)
                offsets = np.cumsum(np.append(0, counted * bands)).astype(np.int32)
                values = values[counted]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text_key"),
                        pa.array(keys, pa.binary()),
                        pa.array([s.tobytes() for s in short], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1))),
                    ],
                    ["doc_id", "text_key", "key", "signature", "bands"],
                )

    return chosen.mapInArrow(
        sketch,
        f"doc_id {id_type}, text_key string, key binary, signature binary, bands array<long>",
    )


# --- similarity -----------------------------------------------------------------


def probability_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Of two bags, as sorted hashes and weights."""
    common, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    if wa.max() == 1 and wb.max() == 1:
        return len(common) / (len(a) + len(b) - len(common))
    x, y = wa[ia].astype(float), wb[ib].astype(float)
    only_a, only_b = wa.sum() - x.sum(), wb.sum() - y.sum()
    # runs with a larger ratio x / y than i count by x, the others by y
    ratio = x / y
    order = np.argsort(ratio)
    sums_x = np.concatenate([[0], np.cumsum(x[order])])
    sums_y = np.concatenate([[0], np.cumsum(y[order])])
    below = np.searchsorted(ratio[order], ratio, side="left")
    above = only_a + sums_x[-1] - sums_x[below]
    return float((1 / (above / x + (only_b + sums_y[below]) / y)).sum())


def _bags(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``key, signature, bag`` of the wanted classes, from the text of one member each."""
    texts = docs.select("doc_id", "text", F.md5("text").alias("text_key"))
    wanted = wanted.withColumnsRenamed({"doc_id": "id", "text_key": "same"})
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("same") == F.col("text_key"))
    found = wanted.join(texts, same).groupBy("key")
    found = found.agg(F.any_value("signature").alias("signature"), F.any_value("text").alias("text"))

    @task(known_words)
    def build(batches):
        for batch in slices(batches, "text"):
            for first in range(0, batch.num_rows, _MAX_ROWS):
                part = batch.slice(first, _MAX_ROWS)
                words, bounds = word_hashes(whole(part, "text"))
                hashes, owners, weights = shingles(words, bounds, size)
                ends = np.searchsorted(owners, np.arange(part.num_rows + 1))
                bags = [_pack(hashes[i:j], weights[i:j]) for i, j in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("signature"), pa.array(bags, pa.binary())],
                    ["key", "signature", "bag"],
                )

    return found.mapInArrow(build, "key binary, signature binary, bag binary")


def _alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity of one-byte signatures, chance matches taken off."""
    return ((a == b).mean(axis=-1) - 1 / 256) / (1 - 1 / 256)


def _least_estimate(similarity: float, registers: int) -> float:
    return similarity - _MARGIN * (similarity * (1 - similarity) / registers) ** 0.5


def verified(pairs: DataFrame, bags: DataFrame, similarity: float, registers: int) -> DataFrame:
    """The pairs ``a, b`` whose exact similarity is at least ``similarity``."""
    least = _least_estimate(similarity, registers)
    left = bags.select(F.col("key").alias("a"), F.col("signature").alias("sa"), F.col("bag").alias("ba"))
    right = bags.select(F.col("key").alias("b"), F.col("signature").alias("sb"), F.col("bag").alias("bb"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb", "ba", "bb")

    def verify(batches):
        for batch in batches:
            a, b, sa, sb, ba, bb = batch.columns
            signs = [
                np.frombuffer(b"".join(s.to_pylist()), np.uint8).reshape(-1, registers)
                for s in (sa, sb)
            ]
            kept = np.zeros(batch.num_rows, bool)
            for i in np.flatnonzero(_alike(*signs) >= least).tolist():
                kept[i] = (
                    probability_jaccard(*_unpack(ba[i].as_py()), *_unpack(bb[i].as_py()))
                    >= similarity
                )
            yield pa.RecordBatch.from_arrays([a, b], ["a", "b"]).filter(pa.array(kept))

    return joined.mapInArrow(verify, "a binary, b binary")


# --- candidates -----------------------------------------------------------------


def _star_pairs(buckets: DataFrame) -> DataFrame:
    """Each text of a bucket with the bucket's first in the order of the keys' hashes."""
    order = F.struct(F.xxhash64("key").alias("place"), F.col("key").alias("centre"))
    centres = buckets.groupBy("band").agg(F.min(order).alias("first"), F.count("*").alias("n"))
    centres = centres.filter("n > 1").select("band", "first.centre")
    pairs = buckets.join(centres, "band").filter("key <> centre")
    return pairs.select(F.col("key").alias("a"), F.col("centre").alias("b")).distinct()


def _blocks(members: DataFrame, group: str, weight: Column, chunk: int, part: int) -> DataFrame:
    """Members of groups that still hold several components, dealt to blocks.

    Members outside a group's largest component (``rare``) are cut into chunks, all
    members into slices, both by ``weight``; a block has one chunk and one slice, so that
    together the blocks hold every pair that has a rare member.
    """
    sized = members.withColumn("weight", weight)
    per = sized.groupBy(group, "label").agg(F.sum("weight").alias("weight"))
    open_ = per.groupBy(group).agg(
        F.count("*").alias("labels"),
        F.sum("weight").alias("all"),
        F.max(F.struct("weight", "label")).alias("most"),
    )
    open_ = open_.filter("labels > 1").select(
        group,
        F.col("most.label").alias("largest"),
        F.ceil(F.col("all") / part).cast("int").alias("slices"),
        F.ceil((F.col("all") - F.col("most.weight")) / chunk).cast("int").alias("chunks"),
    )
    place = F.xxhash64("key")
    dealt = members.join(open_, group).withColumns(
        {"slice": F.pmod(place, F.col("slices")), "chunk": F.pmod(place, F.col("chunks"))}
    )
    # every member goes to all chunks with its slice, a rare one to all slices as well
    kept = [F.col(name) for name in members.columns]
    one = F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice")
    rare = dealt.filter("label <> largest").select(*kept, "chunk", one, F.lit(True).alias("rare"))
    one = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")
    every = dealt.select(*kept, one, "slice", F.lit(False).alias("rare"))
    return rare.unionAll(every)


def _label_links(table: pa.Table, alike) -> pa.Table:
    """Which labels of a block belong together: each with the least of its component.

    ``alike(one, two)`` gives a function from a rare member's number to the numbers of
    the members like it; it is told which components are the member's own already.
    """
    rare = pa.array(table.column("rare").to_numpy())
    one, two = table.filter(rare), table.filter(pc.invert(rare))
    names = sorted({*one.column("label").to_pylist(), *two.column("label").to_pylist()})
    number = {name: i for i, name in enumerate(names)}
    own = [number[name] for name in one.column("label").to_pylist()]
    theirs = np.array([number[name] for name in two.column("label").to_pylist()], np.int64)
    root = np.arange(len(names))
    if one.num_rows and two.num_rows:
        near = alike(one, two)
        for i, label in enumerate(own):
            found = near(i, root[theirs] != root[label])
            if len(found):
                joined = np.unique(np.append(root[theirs[found]], root[label]))
                root[np.isin(root, joined)] = joined[0]
    moved = np.flatnonzero(root != np.arange(len(names)))
    return pa.table(
        {
            "a": pa.array([names[i] for i in moved], pa.binary()),
            "b": pa.array([names[root[i]] for i in moved], pa.binary()),
        }
    )


def _signs(table: pa.Table, registers: int) -> np.ndarray:
    data = b"".join(table.column("signature").to_pylist())
    return np.frombuffer(data, np.uint8).reshape(-1, registers)


def _pack(hashes: np.ndarray, weights: np.ndarray) -> bytes:
    """The number of heavy weights, a word for each shingle, then the heavy weights."""
    heavy = weights[weights >= _HEAVY].astype(np.uint64)
    words = hashes << np.uint64(16) | np.minimum(weights, _HEAVY).astype(np.uint64)
    return np.concatenate([[np.uint64(len(heavy))], words, heavy]).astype(np.uint64).tobytes()


def _unpack(bag: bytes) -> tuple[np.ndarray, np.ndarray]:
    packed = np.frombuffer(bag, np.uint64)
    heavy = int(packed[0])
    words = packed[1 : len(packed) - heavy]
    weights = (words & np.uint64(_HEAVY)).astype(np.int64)
    if heavy:
        weights[weights == _HEAVY] = packed[len(packed) - heavy :]
    return words >> np.uint64(16), weights


def _possible_links(
    buckets: DataFrame, bags: DataFrame, labels: DataFrame, similarity: float, registers: int
) -> DataFrame:
    """Components whose members share a bucket and have signatures close enough."""
    least = _least_estimate(similarity, registers)
    members = buckets.join(labels, F.col("key") == F.col("node"), "left")
    members = members.join(bags.select("key", "signature"), "key")
    members = members.select("band", "key", F.coalesce("label", "key").alias("label"), "signature")

    def alike(one, two):
        rare, every = _signs(one, registers), _signs(two, registers)
        return lambda i, other: np.flatnonzero(other & (_alike(rare[i], every) >= least))

    blocks = _blocks(members, "band", F.lit(1), _CHUNK, _SLICE)
    groups = blocks.groupBy("band", "chunk", "slice")
    return groups.applyInArrow(lambda t: _label_links(t, alike), "a binary, b binary").distinct()


def _exact_links(
    bags: DataFrame, labels: DataFrame, clusters: DataFrame, similarity: float, registers: int
) -> DataFrame:
    """Components of a cluster that some pair of members links, by exact similarity."""
    least = _least_estimate(similarity, registers)
    members = bags.join(labels, F.col("key") == F.col("node"), "left")
    members = members.withColumn("label", F.coalesce("label", "key")).drop("node")
    clusters = clusters.select(F.col("label").alias("cluster"), F.col("node").alias("label"))
    members = members.join(clusters, "label").select("cluster", "key", "label", "signature", "bag")

    def alike(one, two):
        signs, every = _signs(one, registers), _signs(two, registers)
        mine = [_unpack(bag) for bag in one.column("bag").to_pylist()]
        theirs = [_unpack(bag) for bag in two.column("bag").to_pylist()]
        sizes = np.array([len(h) for h, _ in theirs])
        distinct, codes = np.unique(np.concatenate([h for h, _ in theirs]), return_inverse=True)
        starts = np.cumsum(sizes) - sizes
        heavy = np.array([w.max() > 1 for _, w in theirs])

        def near(i, other):
            hashes, weights = mine[i]
            at = np.minimum(np.searchsorted(distinct, hashes), len(distinct) - 1)
            mark = np.zeros(len(distinct), np.int32)
            mark[at[distinct[at] == hashes]] = 1
            common = np.add.reduceat(mark[codes], starts)
            plain = common / (len(hashes) + sizes - common) >= similarity
            weighted = heavy | (weights.max() > 1)
            found = other & plain & ~weighted
            for j in np.flatnonzero(other & weighted & (_alike(signs[i], every) >= least)):
                found[j] = probability_jaccard(*mine[i], *theirs[j]) >= similarity
            return np.flatnonzero(found)

        return near

    blocks = _blocks(members, "cluster", F.length("bag"), _CHUNK_BYTES, _SLICE_BYTES)
    groups = blocks.groupBy("cluster", "chunk", "slice")
    return groups.applyInArrow(lambda t: _label_links(t, alike), "a binary, b binary").distinct()


def near_duplicates(
    spark: SparkSession,
    docs: DataFrame,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = BAND_ROWS,
    size: int = SHINGLE_WORDS,
) -> DataFrame:
    """``doc_id, text_key, class_id, class_key`` for every row of ``docs(doc_id, text)``.

    ``class_id`` is the least document id of the class; ``text_key`` is the MD5 of the text.
    ``class_key`` names the class whatever its ids are; it is null for a null text.
    """
    registers = bands * rows
    sketched = saved(spark, sketches(docs, bands, rows, size), "sketches")
    keyed = sketched.filter("key is not null")
    classes = keyed.groupBy("key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("m"),
        F.any_value("signature").alias("signature"),
        F.any_value("bands").alias("bands"),
    )
    classes = classes.select("key", "m.doc_id", "m.text_key", "signature", "bands")
    classes = saved(spark, classes, "classes")
    buckets = classes.select(F.explode("bands").alias("band"), "key")

    # every text that shares a bucket is in a pair, so these are all bags that are needed
    pairs = saved(spark, _star_pairs(buckets), "pairs")
    used = pairs.select(F.col("a").alias("key")).unionAll(pairs.select("b")).distinct()
    wanted = classes.join(used, "key").select("key", "doc_id", "text_key", "signature")
    bags = saved(spark, _bags(docs, wanted, size), "bags")
    links = saved(spark, verified(pairs, bags, similarity, registers), "links")
    labels = connected_components(spark, links)

    possible = _possible_links(buckets, bags, labels, similarity, registers)
    possible = saved(spark, possible, "possible")
    if not possible.isEmpty():
        clusters = connected_components(spark, possible)
        more = _exact_links(bags, labels, clusters, similarity, registers)
        labels = connected_components(spark, links.unionAll(saved(spark, more, "more-links")))

    named = classes.join(labels, F.col("key") == F.col("node"), "left")
    named = named.select("key", "doc_id", F.coalesce("label", "key").alias("label"))
    least = named.groupBy("label").agg(F.min("doc_id").alias("class_id"))
    named = named.join(least, "label").select("key", "class_id", F.col("label").alias("class_key"))
    result = sketched.select("doc_id", "text_key", "key").join(named, "key", "left")
    own = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    return result.select("doc_id", "text_key", own.alias("class_id"), "class_key")


def keep_one(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """One document of each class, whole rows: the one with the least id, then text key.

    Null ids come last. Rows that repeat both id and text are one document; a null text is
    alone with its id.
    """
    classes = near_duplicates(spark, docs, **options)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    first = classes.filter("class_key is not null").groupBy("class_key")
    first = first.agg(F.min(order).alias("first"))
    kept = first.select("first.doc_id", "first.text_key")
    kept = kept.unionAll(classes.filter("class_key is null").select("doc_id", "text_key"))
    kept = kept.toDF("kept_id", "kept_key").distinct()
    key = F.md5(docs["text"])
    same = docs["doc_id"].eqNullSafe(F.col("kept_id")) & key.eqNullSafe(F.col("kept_key"))
    columns = [docs[f"`{name}`"] for name in docs.columns]
    return docs.join(kept, same).dropDuplicates(["kept_id", "kept_key"]).select(columns)
