"""The schema of XML documents that differ from row to row."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from goldpan.functions.xml import infer_xml_schema, parse_xml
from goldpan.plans import silver


def _docs(spark, *documents):
    return spark.createDataFrame(list(enumerate(documents)), "id_review long, log string")


@pytest.mark.parametrize(
    "documents, expected",
    [
        (["<log><a>1</a></log>"], "a bigint"),
        (["<log><a>1</a></log>", "<log><a>2.5</a></log>"], "a double"),
        (["<log><a>1</a></log>", "<log><a>2.5</a></log>", "<log><a>x</a></log>"], "a string"),
        (["<log><a/></log>"], "a string"),
        (["<log><a/></log>", "<log><a>7</a></log>"], "a bigint"),
        (["<log><a>1</a><a>2</a></log>", "<log><a>3</a></log>"], "a array<bigint>"),
        (["<log><a>1</a><a>x</a></log>", "<log><a>3</a></log>"], "a array<string>"),
        (["<log><a><b>1</b></a></log>", "<log><a><c>x</c></a></log>"], "a struct<b:bigint,c:string>"),
        (["<log><a k='1'>t</a></log>", "<log><a>u</a></log>"], "a struct<_k:bigint,_VALUE:string>"),
        (
            ["<log><a><b>1</b><b>2</b></a></log>", "<log><a><b>x</b></a></log>"],
            "a struct<b:array<string>>",
        ),
        ([None, "", "  ", "no xml", "<log><a>1</log>", "<log><a>1</a></log>"], "a bigint"),
    ],
)
def test_types_are_merged(spark, documents, expected):
    found = infer_xml_schema(_docs(spark, *documents), "log", "log")
    assert ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found) == expected


@pytest.mark.parametrize("documents", [[], [None, ""], ["<log/>"], ["<broken"]])
def test_nothing_to_learn_from(spark, documents):
    docs = _docs(spark, *documents) if documents else _docs(spark, None).limit(0)
    assert infer_xml_schema(docs, "log", "log").fields == []
    found = silver.review_logs(docs, payload=None)
    assert found.columns == ["id_review"] and found.count() == len(documents)


def test_a_field_of_one_row_among_many_is_found(spark):
    rare = F.when(F.col("id") == 4711, F.lit("<rare>x</rare>")).otherwise("")
    docs = spark.range(5_000).select(
        F.col("id").alias("id_review"),
        F.concat(F.lit("<log><userId>"), "id", F.lit("</userId>"), rare, F.lit("</log>")).alias("log"),
    )
    found = silver.review_logs(docs, payload=None)
    assert found.columns == ["id_review", "rare", "user_id"]
    assert [tuple(r) for r in found.filter("rare is not null").collect()] == [(4711, "x", 4711)]


def test_inferred_schemas_parse_what_they_came_from(spark):
    docs = _docs(spark, "<log><a>1</a><a>2</a></log>", "<log><a>3</a><b><c>x</c></b></log>")
    schema = infer_xml_schema(docs, "log", "log")
    rows = docs.select(parse_xml(F.col("log"), schema, "log").alias("v")).collect()
    assert [row.v.asDict(recursive=True) for row in rows] == [
        {"a": [1, 2], "b": None},
        {"a": [3], "b": {"c": "x"}},
    ]


def test_documents_are_read_once_however_many_fields_are_mixed(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    texts = ["<log><a>1</a><b>1</b></log>", "<log><a>x</a><b>1</b><b>y</b></log>", "<log><c><d>1</d></c></log>"]
    docs = spark.createDataFrame([(text,) for text in texts], "log string")
    schema = infer_xml_schema(docs.mapInArrow(count, "log string"), "log", "log")
    assert schema.simpleString() == "struct<a:string,b:array<string>,c:struct<d:bigint>>"
    assert seen.value == len(texts)
