"""Fill-in-the-middle texts against a plain rendering of the contract."""

from __future__ import annotations

import hashlib
import re

import pytest

from goldpan.llm import infill
from goldpan.llm.common import documents
from tests.llm.helpers import SMALL, clashing, frame, odd


def plain_fim(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def expected(rows):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    full = [(i, *plain_fim(i, t), t or "") for i, t in rows]
    return sorted(((*row[:5], sha(row[5]), sha(row[6])) for row in full), key=repr)


@pytest.mark.parametrize("chunk", [infill.CHUNK_UNITS, 3])
def test_digests_equal_the_contract(spark, chunk):
    docs = clashing(odd(spark))
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rows += [(100 + i, f"a<{c}>b {i}") for i, c in enumerate("PSMpsm")]
    rows += [(200 + i, "It's 5<S or <P >M> word. " * (i % 7)) for i in range(60)]
    result = infill.digests(frame(spark, rows), chunk)
    assert result.columns == [
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"
    ]
    found = sorted(map(tuple, result.collect()), key=repr)
    assert found == expected(rows)
    assert {row[2] for row in found} == {"plain", "psm", "spm"}


def test_whole_table(spark):
    docs = documents(spark, SMALL)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, infill.digests(docs).collect()), key=repr) == expected(rows)


def test_outputs_go_back_to_texts(spark):
    docs = documents(spark, SMALL)
    rows = {r.doc_id: r.text or "" for r in docs.collect()}
    back = infill.restored(infill.outputs(docs)).collect()
    assert {r.doc_id: r.text for r in back} == rows
    assert {r.doc_id: r.output for r in back} == {i: plain_fim(i, t)[4] for i, t in rows.items()}


def test_one_id_for_all_rows_and_empty_tables(spark):
    rows = [(7, f"same id, text {i % 3}") for i in range(200)]
    found = sorted(map(tuple, infill.digests(frame(spark, rows)).collect()), key=repr)
    assert found == expected(rows)
    assert infill.digests(frame(spark, [])).collect() == []
    assert infill.outputs(frame(spark, [])).collect() == []


def test_a_row_is_sorted_where_it_is(spark):
    plan = infill.digests(documents(spark, SMALL))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(row") == 1
