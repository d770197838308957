"""Templates that stand as plain blocks in articles, and passages that only look like them."""

from __future__ import annotations

import random

from goldpan.llm import pages


def words(seed, n=30):
    rng = random.Random(repr(seed))
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


def article(blocks):
    return f"<body><article>{''.join(blocks)}</article></body>"


def texts(spark, rows):
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in pages.extract_text(spark, table).collect()}


def test_plain_blocks_of_a_template_are_removed_from_articles(spark):
    rows = []
    for i in range(60):
        own = [f"<p>{words((i, k))}</p>" for k in range(5 + i % 4)]
        blocks = [f"<h1>{words(i, 4)}</h1>", "<p>We use biscuits here.</p>", *own, "<h2>Read on</h2>"]
        # a related line on few pages of the host: less than 20% of them
        if i % 8 == 0:
            blocks.append("<p>Related: our best stories</p>")
        rows.append((i, f"http://a.org/{i}", article(blocks)))
    found = texts(spark, rows)
    assert not any("biscuits" in t or "Related" in t for t in found.values())
    assert "Read on" not in found[1] and words((1, 0)) in found[1] and words(1, 4) in found[1]


def test_quoted_passages_stay(spark):
    rng, rows = random.Random(5), []
    for i in range(120):
        blocks = [f"<p>{words((i, k))}</p>" for k in range(8)]
        # on one host anywhere in the text; on all hosts always first
        if i % 2:
            blocks.insert(rng.randrange(9), "<p>a quoted passage</p>")
        if i % 3 == 0:
            blocks.insert(0, "<p>a common opening</p>")
        rows.append((i, f"http://h{i % 4}.org/{i}", article(blocks)))
    found = texts(spark, rows)
    assert all("a quoted passage" in found[i] for i in range(120) if i % 2)
    assert all("a common opening" in found[i] for i in range(0, 120, 3))


def test_versions_of_one_article_stay(spark):
    same = [f"<p>{words(k)}</p>" for k in range(8)]
    rows = [(i, f"http://a.org/{i}", article([*same, f"<p>version {i}</p>"])) for i in range(12)]
    rows += [(100 + i, f"http://a.org/x{i}", article([f"<p>{words((i, k))}</p>" for k in range(8)])) for i in range(12)]
    found = texts(spark, rows)
    assert all(words(k) in found[i] for i in range(12) for k in range(8))


def test_last_lines_of_several_hosts_stay(spark):
    rows = []
    for i in range(240):
        # five of 24 pages of one host, a few of the others
        last = i < 5 or (i >= 24 and i % 14 == 0)
        blocks = [f"<p>{words((i, k))}</p>" for k in range(6)] + ["<p>Free to copy.</p>"] * last
        rows.append((i, f"http://h{i // 24}.org/{i}", article(blocks)))
    found = texts(spark, rows)
    assert all(found[i].endswith("Free to copy.") for i in range(5))
