"""Near-duplicate classes against brute force."""

from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from goldpan.llm import minhash
from goldpan.llm.components import connected_components
from tests.llm.helpers import clashing, frame, odd


def bag(text):
    words = ["".join(filter(str.isalnum, w)) for w in (text or "").lower().split()]
    words = [w for w in words if w]
    n = min(5, len(words))
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if n else Counter()


def similarity(x, y):
    common, both = x.keys() & y.keys(), x.keys() | y.keys()
    if all(x[i] == 1 for i in x) and all(y[i] == 1 for i in y):
        return len(common) / max(1, len(both))
    return sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in both) for i in x.keys() & y.keys())


def classes(rows, least=0.8):
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    bags = {i: bag(t) for i, t in rows}
    for i, j in combinations(bags, 2):
        if similarity(bags[i], bags[j]) >= least:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return {i: find(i) for i in root}


def texts(seed, groups, copies, edits):
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(40, 120))]
        base += base[:20] if rng.random() < 0.4 else []
        for _ in range(rng.randint(1, copies)):
            own = list(base)
            for _ in range(rng.randint(0, edits)):
                own[rng.randrange(len(own))] = f"w{rng.randrange(5000)}"
            rows.append((len(rows), " ".join(own)))
    return rows


def hot_group(count, first):
    """Copies differ from each other by more than from their source: links are partial."""
    source = texts(3, groups=1, copies=1, edits=0)[0][1].split()
    rng, rows = random.Random(5), []
    for i in range(count):
        own = list(source)
        for _ in range(2):
            own[rng.randrange(len(own))] = f"v{rng.randrange(10**6)}"
        rows.append((first + i, " ".join(own)))
    return rows


def test_classes_equal_brute_force(spark):
    rows = texts(1, groups=8, copies=5, edits=4)
    rows = [(100 + i, t) for i, t in rows] + hot_group(30, 1000)
    docs = clashing(frame(spark, rows).unionByName(odd(spark)))
    found = minhash.near_duplicates(spark, docs).collect()
    assert len(found) == docs.count()
    by_id = {r.doc_id: r.class_id for r in found}
    assert {i: by_id[i] for i, _ in rows} == classes(rows)
    # texts without words are alone, equal words are one class, a null id is never the least
    assert by_id[1] == 1 and by_id[2] == 2 and by_id[3] == 3
    assert by_id[4] == by_id[5] == 4
    assert by_id[None] is None


def test_keep_one(spark):
    docs = clashing(odd(spark))
    kept = minhash.keep_one(spark, docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id or 0 for r in kept.select("doc_id").collect())
    assert ids == [0, 1, 2, 3, 4, 6, 7, 8, 9]


def test_empty(spark):
    assert minhash.keep_one(spark, frame(spark, [])).collect() == []


def test_signatures_estimate_probability_jaccard():
    words = [f"w{i}" for i in range(60)]
    x = " ".join(words + words[:30])
    y = " ".join(words[10:] + [f"v{i}" for i in range(15)] + words[:30])
    hashes, bounds = minhash.word_hashes(pa.array([x, y]))
    bags = minhash.shingles(hashes, bounds)
    registers = minhash.signatures(*bags, 2, 20_000)
    expected = similarity(bag(x), bag(y))
    assert abs((registers[0] == registers[1]).mean() - expected) < 0.02
    one, two = (tuple(p[bags[1] == i] for p in (bags[0], bags[2])) for i in (0, 1))
    assert np.isclose(minhash.probability_jaccard(*one, *two), expected)


def test_components_of_a_chain(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101)]
    found = connected_components(spark, spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.label for r in found} == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def test_more_registers_than_a_hash_has_spare_bits():
    hashes, bounds = minhash.word_hashes(pa.array(["a b c d e f g", "x y"]))
    bags = minhash.shingles(hashes, bounds)
    registers = minhash.signatures(*bags, 2, 4096)
    assert registers.shape == (2, 4096) and (registers != 0).all()


def test_runs_repeated_very_often_count_fully(spark):
    # two heavy runs whose shares are 1:1 and 2:5: similarity 0.79, or 1 if weights were cut
    rows = [(1, "a " * 70_004 + "b " * 70_004), (2, "a " * 70_004 + "b " * 175_004)]
    assert 0.78 < similarity(bag(rows[0][1]), bag(rows[1][1])) < 0.79
    found = minhash.near_duplicates(spark, frame(spark, rows)).collect()
    assert {r.doc_id: r.class_id for r in found} == {1: 1, 2: 2}
    hashes, weights = np.array([3, 5], np.uint64), np.array([70_000, 2])
    assert minhash._unpack(minhash._pack(hashes, weights))[1].tolist() == [70_000, 2]


def test_one_row_stays_whatever_the_ids(spark):
    base = [f"w{i}" for i in range(60)]
    near = " ".join(base[:30] + ["x"] + base[31:])
    rows = [(5, " ".join(base)), (5, near), (8, "!!!"), (9, "!!!"), (10, ""), (11, "")]
    rows += [(None, " ".join(base[::-1])), (None, " ".join(base[::-1][:-1] + ["y"]))]
    kept = minhash.keep_one(spark, frame(spark, rows + [(12, None), (13, None)]))
    ids = sorted((r.doc_id or 0) for r in kept.collect())
    assert ids == [0, 5, 8, 10, 12, 13]
