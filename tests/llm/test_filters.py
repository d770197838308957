"""Personal data, quality, toxicity, language, hosts, pages, leaks: brute force and odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from goldpan.llm import decontaminate, hosts, language, pages, pii, quality, toxicity
from goldpan.llm.common import documents
from tests.llm.helpers import SMALL, clashing, frame, odd

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PERSONAL = [
    (1, "a@b.c_d@e.f x@y.z.@q.r @a.b a..b@-.-.- 🙂 é u+1@x.yy.z-- 1.2.3.4.5.6.7.8 256.1.1.1"),
    (2, "0255.1.1.1 4111 1111 1111 1111 x 4111-1111-1111-1111 +1 (415) 555-2671 +12 +1+1234567890"),
    (3, "1 " * 20000),
    (4, "a" * 50000),
    (5, "a@b" + ".c" * 20000),
    (6, "1.1.1.1 " * 3000 + "x@y.z"),
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def personal_spans(text):
    found = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), k, kind, m.end()))
    return sorted(found)


def test_personal_data(spark):
    docs = frame(spark, PERSONAL).unionByName(odd(spark)).unionByName(documents(spark, SMALL))
    docs = docs.withColumn("doc_id", docs.doc_id)
    text_of = Counter()
    for row in docs.collect():
        spans = ",".join(f"{k}:{a}:{b}" for a, _, k, b in personal_spans(row.text or ""))
        text_of[row.doc_id, hashlib.sha256(spans.encode()).hexdigest()] += 1
    found = pii.span_digests(spark, clashing(docs)).collect()
    assert Counter((r.doc_id, r.base_sha256) for r in found) == text_of


def test_words_that_disclose_an_entity_are_spans(spark):
    rows = [(i, f"word{i} Zaphod{i} called Beeblebrox at zb@heart.org, place{i}.") for i in range(5)]
    rows += [(10 + i, f"they called number{i}") for i in range(40)]
    found = {r.doc_id: r for r in pii.span_digests(spark, frame(spark, rows)).collect()}
    assert all(found[i].n_term == 1 for i in range(5))
    assert not any(found[10 + i].n_term for i in range(40))
    text = rows[0][1]
    start = text.index("Beeblebrox")
    assert f"term:{start}:{start + 10}" in found[0].spans


def test_redaction(spark):
    docs = clashing(frame(spark, PERSONAL[:2] + [(9, None), (10, "clean")]))
    found = {r.doc_id: r for r in pii.redact(spark, docs).collect()}
    assert pii.redact(spark, docs).columns == docs.columns
    for doc_id, text in PERSONAL[:2]:
        out, cut = "", 0
        for start, _, kind, end in personal_spans(text):
            if start >= cut:
                out += text[cut:start] + f"[{kind.upper()}]"
            cut = max(cut, end)
        assert found[doc_id].text == out + text[cut:]
        assert found[doc_id].n_chars == len(found[doc_id].text)
    assert found[9].text is None and found[10].text == "clean"
    assert pii.redact(spark, frame(spark, [])).collect() == []


def test_quality_counts(spark):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    docs = documents(spark, SMALL).unionByName(odd(spark))
    expected = Counter()
    for row in docs.collect():
        text = row.text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        times = Counter(windows)
        covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        counts = (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered),
        )
        expected[row.doc_id, *counts, len(words) < 10 or 5 * len(covered) > len(words)] += 1
    judged = quality.judge(spark, clashing(docs), labels).collect()
    assert Counter(tuple(r)[:7] for r in judged) == expected
    assert not any(r.kept and r.base_failed for r in judged)
    empty = quality.judge(spark, frame(spark, []), labels.limit(0))
    assert empty.collect() == []


def test_rules_are_found_and_clean_rows_stay():
    rng = np.random.default_rng(0)
    rows = {"a": rng.random(3000), "b": rng.random(3000), "c": rng.random(3000)}
    bad = (rows["a"] > 0.8) | ((rows["b"] < 0.1) & (rows["c"] > 0.5))
    rules = quality.learn_rules(rows, bad, np.arange(3000) % 3 == 0)
    rejected = np.zeros(3000, bool)
    for rule in rules:
        rejected |= quality._holds(rule, rows)
    assert (rejected == bad).mean() > 0.98


def labelled(n):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(800)]
    rows = []
    for i in range(n):
        own = [rng.choice(words) for _ in range(60)]
        toxic = i % 5 == 0
        if toxic:
            own[rng.randrange(60)] = f"vile{rng.choice('abcdefgh')}{rng.randrange(99)}"
            own[rng.randrange(60)] = rng.choice(["scum", "Trash!"])
        rows.append((i, " ".join(own), int(toxic)))
    return rows


def test_toxicity_held_out(spark):
    rows = labelled(1500)
    docs = frame(spark, [r[:2] for r in rows] + [(9000, None), (9001, ""), (9001, "")])
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(3, None)], "doc_id long, toxic int")
    found = toxicity.predict(spark, clashing(docs), labels).collect()
    truth = {r[0]: r[2] for r in rows}
    own = [r for r in found if r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert np.mean([r.predicted == truth[r.doc_id] for r in own if r.held_out]) > 0.95
    assert len(found) == len(rows) + 3
    assert all(0 <= r.score <= 1 for r in found)


def test_toxicity_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.predict(spark, odd(spark), labels).collect()} == {0.5}


def test_language_held_out(spark):
    docs = documents(spark, "/root/testdata/sf0.01").unionByName(
        frame(spark, [(9000000, None), (9000001, "12 !"), (9000002, "")])
    )
    found = language.predict(spark, clashing(docs)).collect()
    truth = {r.doc_id: (r.lang, len(r.text or "")) for r in docs.collect()}
    own = [r for r in found if r.held_out and truth[r.doc_id][1] > 40]
    assert np.mean([r.lang_pred == truth[r.doc_id][0] for r in own]) > 0.98
    assert all(r.lang_pred == "und" and r.score == 0 for r in found if r.doc_id >= 9000000)
    assert {r.lang_pred for r in language.predict(spark, docs.filter("lang is null")).collect()} == set()


def test_hosts_equal_sql(spark):
    from goldpan.llm import queries

    folder = "/root/testdata/sf0.01"
    connection = duckdb.connect()
    for name in ("pages", "labels"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    expected = connection.sql(hosts.oracle()).fetchall()
    found = [tuple(r) for r in queries.op5_hosts(spark, folder).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_reputation_decides_where_no_rule_does(spark):
    urls = [(i, f"http://bad{i % 4}.spam.org/x") for i in range(400)]
    urls += [(1000 + i, f"http://h{i % 40}.fine.org/x") for i in range(400)]
    urls += [(5000, "http://new.spam.org/"), (5001, None), (5002, "no scheme"), (5003, "http://new.fine.org")]
    page = spark.createDataFrame(urls, "page_id long, url string")
    labels = [(i, int(i >= 1000 or i % 10 == 0), 0) for i, _ in urls if i < 5000]
    labels = spark.createDataFrame(labels + [(1, None, None)], "doc_id long, quality int, toxic int")
    found = {r.page_id: r for r in hosts.judge_urls(page, labels).collect()}
    assert found[1].verdict == "block" and found[5000].verdict == "block"
    assert found[1001].verdict == "allow" and found[5003].verdict == "allow"
    assert found[5001].host == found[5001].path == found[5002].host == ""
    assert hosts.judge_urls(page.limit(0), labels.limit(0)).collect() == []


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("<p>a<p>b<ul><li>x<li>y</ul>tail", "a\nb\nx\ny\ntail"),
        ("<div class='sidebar'>s</div><div id=main><p>x <b>y</b>\n z</p><div class='comments'>no</div></div>", "x y z"),
        ("<script>if(a<b){}</script>x<style>p{}", "x"),
        ("<article><h1>T &amp; U</h1><p>k<br>l</p><div class='cookie-notice'>c</div></article><footer>f", "T & U\nk l"),
        ("<div>" * 5000 + "deep", "deep"),
        ("<a b=\"" * 3000, None),
    ],
)
def test_main_text(page, text):
    found = pages.main_text(pages.parse(page or ""))
    assert text is None or found == text


def test_templates_of_a_host_are_removed(spark):
    frame_of = "<div><p>Our site</p><p>All about it</p></div><div><p>Story {0}</p><p>{0} told</p></div><div>Imprint</div>"
    rows = [(i, f"http://a.org/{i}", frame_of.format(i)) for i in range(8)]
    rows += [(100 + i, "http://b.org/", "<p>copied text</p><p>and more</p>") for i in range(20)]
    rows += [(200, None, None), (201, "http://a.org/x", "")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r for r in pages.extract_text(spark, clashing(table)).collect()}
    assert found[3].text == "Story 3\n3 told"
    assert found[100].text == "copied text\nand more"
    assert found[200].text == found[201].text == "" and len(found) == len(rows)
    assert pages.extract_text(spark, table.limit(0)).collect() == []


def test_alignment_is_exact():
    rng = random.Random(1)
    for _ in range(200):
        pattern = [rng.randrange(3) for _ in range(rng.randint(1, 10))]
        region = [rng.randrange(3) for _ in range(rng.randint(0, 16))]
        row = [0] * (len(region) + 1)
        for a in pattern:
            last, row = row, [row[0] + 1]
            for j, b in enumerate(region):
                row.append(min(last[j] + (a != b), last[j + 1] + 1, row[j] + 1))
        codes = [np.array(x, np.uint32) for x in (pattern, region)]
        assert decontaminate.align(*codes, 50)[0] == min(row)


def test_planted_passages_are_found_and_clean_documents_stay(spark):
    items = pq.read_table("/root/testdata/sf0.01/benchmark.parquet").to_pylist()[:20]
    clean = [r.text for r in documents(spark, SMALL).filter("length(text) > 400").limit(40).collect()]
    rng, rows = random.Random(2), []
    index = decontaminate.Index([r["text"] for r in items], 8, 96, 48, 0.08)
    clean = [t for t in clean if not decontaminate._leaks(index, [t])]
    for i, text in enumerate(clean):
        rows.append((i, text))
        item = list(items[i % 20]["text"])
        for _ in range(len(item) // 25):
            item[rng.randrange(len(item))] = rng.choice("abc")
        cut = rng.randrange(len(text))
        rows.append((1000 + i, text[:cut] + "".join(item).upper() + text[cut:]))
    benchmark = spark.createDataFrame([(r["item_id"], r["text"]) for r in items] + [(None, None), (77, "ab")], "item_id long, text string")
    docs = clashing(frame(spark, rows).unionByName(odd(spark)))
    for block in (4_000_000, 500):
        found = decontaminate.find_leaks(spark, docs, benchmark, block_chars=block).collect()
        assert {r.doc_id for r in found} == {1000 + i for i in range(len(clean))}
    kept = decontaminate.drop_leaks(spark, docs, benchmark)
    assert kept.columns == docs.columns
    assert kept.count() == len(clean) + odd(spark).count()
    assert decontaminate.find_leaks(spark, docs, benchmark.limit(0)).collect() == []


def test_pipeline_stages(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "drop_toxic", "drop_duplicates", "drop_leaked", "redact", "encode",
    ]
    docs = documents(spark, SMALL)
    result = corpus_pipeline.run(spark, SMALL).collect()
    ids = [r.doc_id for r in result]
    assert len(ids) == len(set(ids)) and set(ids) <= {r.doc_id for r in docs.select("doc_id").collect()}
    assert 100 < len(ids) < docs.count()


def test_word_hashes_drop_what_is_no_word():
    from goldpan.llm.common import word_hashes

    hashes, bounds = word_hashes(pa.array(["A b, -- c", "", "a B c"]))
    assert bounds.tolist() == [0, 3, 3, 6] and hashes[:3].tolist() == hashes[3:].tolist()



def test_levels_of_hosts(spark):
    hosts_seen = {
        "10.0.0.5": ("10.0.0.5", "10.0.0.5"),
        "10.0.0.5:80": ("10.0.0.5", "10.0.0.5"),
        "[::1]:8080": ("[::1]", "[::1]"),
        "a.example.com:8080": ("example.com", "com"),
        "me@a.example.co.uk": ("example.co.uk", "co.uk"),
        "a.b.co.nz": ("b.co.nz", "co.nz"),
        "x.y.city.of.jp": ("y.city.of.jp", "city.of.jp"),
        "a.b.any.ck": ("b.any.ck", "any.ck"),
        "localhost": ("localhost", "localhost"),
        "": ("", ""),
    }
    listed = (*hosts.SUFFIXES, "co.nz", "of.jp", "city.of.jp", "*.ck")
    seen = spark.createDataFrame([(host,) for host in hosts_seen], "host string")
    found = hosts._with_levels(seen, listed).collect()
    assert {row.host: (row.domain, row.suffix) for row in found} == hosts_seen


def test_a_bad_host_is_blocked_and_shares_its_record_with_its_domain(spark):
    urls = [(i, f"http://bad.site{i % 40}.org/{i}") for i in range(400)]
    urls += [(1000, "http://new.site0.org:81/"), (1001, "http://new.site1.org/")]
    pages_seen = spark.createDataFrame(urls, "page_id long, url string").withColumns(
        {"host": F.lit("other"), "rate": F.lit(9), "n": F.lit(9)}
    )
    marks = [(i, 1, int(i % 40 == 0)) for i in range(400)] * 2
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    found = {row.page_id: row for row in hosts.judge_urls(pages_seen, labels, rules=()).collect()}
    blocked = {page for page, row in found.items() if row.verdict == "block"}
    assert blocked == {i for i in range(400) if i % 40 == 0} | {1000}
    assert all(row.bound <= row.rate for row in found.values())
