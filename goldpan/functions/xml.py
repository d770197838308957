"""XML documents held in a column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldpan.session import scratch_dir
from goldpan.sources.storage import delete_path


def parse_xml(
    document: Column, schema: T.StructType, row_tag: str, mode: str = "PERMISSIVE"
) -> Column:
    """The document as a struct. In ``PERMISSIVE`` mode a malformed document gives
    a struct of nulls and a null one gives null; ``FAILFAST`` raises instead."""
    return F.from_xml(document, schema, {"rowTag": row_tag, "mode": mode})


def build_xml(fields: Column, row_tag: str) -> Column:
    return F.to_xml(fields, {"rowTag": row_tag})


# Fixed value: the field that Spark gives to the text of an element with attributes
TEXT_FIELD = "_VALUE"
_BAD = "goldpan_bad_document"


def infer_xml_schema(docs: DataFrame, column: str, row_tag: str) -> T.StructType:
    """The schema of all documents of a column, for :func:`parse_xml`.

    Every document counts, so a field of a single row is found. Types of rows are merged
    inside tasks and then across them: nothing < long < double < text, structs by the union
    of their fields, and an element that is repeated anywhere is an array everywhere. An
    element with text alone in one row and with fields in another is a struct whose
    ``_VALUE`` is the text. Null, blank and malformed documents add nothing; without any
    other the schema is empty. Each field of mixed kinds costs two further passes, over
    values that are parsed once and kept in the shared folder.
    """
    document = F.col(column)
    options = {"rowTag": row_tag, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    bad = F.from_xml(document, f"{_BAD} string", options).getField(_BAD)
    value = F.from_xml(document, "variant", {"rowTag": row_tag})
    whole = F.when(F.trim(document) != "", F.when(bad.isNull(), value))
    path = scratch_dir(docs.sparkSession, "xml-values")
    docs.select(whole.alias("value")).write.parquet(path)
    try:
        found = _merged(docs.sparkSession.read.schema("value variant").parquet(path))
    finally:
        delete_path(docs.sparkSession, path)
    return found if isinstance(found, T.StructType) else T.StructType([])


def _merged(values: DataFrame) -> T.DataType:
    text = values.agg(F.schema_of_variant_agg("value")).first()[0]
    return _settled(values, T.DataType.fromDDL(text.replace("OBJECT<", "STRUCT<")))


def _settled(values: DataFrame, kind: T.DataType) -> T.DataType:
    """``kind``, the values' merged type, without the places where they only agree on nothing."""
    if isinstance(kind, T.StructType):
        fields = []
        for field in kind.fields:
            own = F.try_variant_get("value", f"$['{field.name}']", "variant").alias("value")
            fields.append(T.StructField(field.name, _settled(values.select(own), field.dataType)))
        return T.StructType(fields)
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_settled(_elements(values), kind.elementType))
    if isinstance(kind, T.VariantType):
        return _mixed(values)
    if isinstance(kind, T.NullType):
        return T.StringType()
    return T.DoubleType() if isinstance(kind, T.DecimalType) else kind


def _mixed(values: DataFrame) -> T.DataType:
    own = F.schema_of_variant("value")
    seen = values.agg(
        F.bool_or(own.startswith("ARRAY<")).alias("repeated"),
        F.bool_or(own.startswith("OBJECT<")).alias("nested"),
    ).first()
    if seen.repeated:
        return T.ArrayType(_merged(_elements(values)))
    if not seen.nested:
        return T.StringType()
    fields = _merged(values.filter(own.startswith("OBJECT<"))).fields
    text = T.StructField(TEXT_FIELD, T.StringType())
    return T.StructType([field for field in fields if field.name != TEXT_FIELD] + [text])


def _elements(values: DataFrame) -> DataFrame:
    """The elements of arrays, and what stands alone."""
    several = F.try_variant_get("value", "$", "array<variant>")
    return values.select(F.explode(F.coalesce(several, F.array("value"))).alias("value"))
