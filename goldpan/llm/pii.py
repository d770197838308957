"""Operator 2, personal data: spans by pattern, and terms that disclose what they surround.

Base kinds (email, ip, card, phone) are found by pattern and checked (parts of an
address, Luhn's sum, number of digits). On top of that comes information-theoretic
sanitisation: each distinct value found is an entity to protect. Over the whole corpus,
words near an entity are counted with it, and a word discloses the entity when

    PMI(entity; word) >= DISCLOSURE * IC(entity),

which is information about the entity given away by the word, as a share of all there is.
Copies of a passage prove nothing, so a word must stand near the entity in ``MIN_SUPPORT``
different surroundings. Disclosing words are spans of kind ``term`` in the documents that
hold the entity; ``redact`` puts each kind's general name in place of every span.

Everything is DataFrame functions: matches come from ``regexp_extract_all``, the text
between them from ``split``, and places from running sums over both (by doubling, so
that a text with very many matches takes no quadratic time). Patterns use possessive
repetition, which Java runs in constant stack, and begin at run starts, which keeps them
linear on very long texts.

Defined results: a null text is read as empty and has no spans (redacted, it stays null);
repeated rows have the same spans; null ids are kept; an empty table gives an empty
result; other columns are not read, and ``redact`` returns them as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.llm.common import saved

KINDS = ("email", "ip", "card", "phone", "term")
DISCLOSURE = 0.9
MIN_SUPPORT = 3
CONTEXT_CHARS = 60
MIN_TERM_CHARS = 3

# an address may begin where the last match ended (\G) or where its run of characters begins
_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_MUST_HOLD = {"email": "@", "ip": ".", "phone": "+"}


def _valid(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        def small(part: Column) -> Column:
            stripped = F.concat(F.lit("0"), F.regexp_replace(part, "^0+", ""))
            return F.coalesce(stripped.try_cast("int") <= 255, F.lit(False))

        return F.forall(F.split(match, r"\."), small)
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "phone":
        return F.length(digits).between(10, 15)

    def add(total: Column, k: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - k + 1, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(k % 2 == 0, twice).otherwise(digit)

    luhn = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)
    return F.when(F.length(digits).between(14, 19), luhn % 10 == 0).otherwise(False)


def _checked(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda span: _valid(kind, span["value"]))


def _running(values: Column, merge) -> Column:
    """Inclusive running totals of an array in log2(n) passes over it."""

    def double(done: Column, power: Column) -> Column:
        gap = F.pow(F.lit(2), power).cast("int")
        passed = F.transform(
            done, lambda x, i: F.when(i >= gap, merge(x, F.get(done, i - gap))).otherwise(x)
        )
        return F.when(F.size(done) > gap, passed).otherwise(done)

    return F.aggregate(F.sequence(F.lit(0), F.lit(30)), values, double)


def _spans(text: Column, matches: Column, pattern: Column, kind: str) -> Column:
    """``start, kind, end, value`` of matches that ``pattern`` finds in ``text``."""
    pieces = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
    lengths = F.zip_with(pieces, matches, lambda a, b: F.length(a) + F.length(b))
    ends = _running(lengths, lambda a, b: a + b)
    return F.zip_with(
        ends,
        matches,
        lambda end, match: F.struct(
            (end - F.length(match)).alias("start"),
            F.lit(KINDS.index(kind)).alias("kind"),
            end.alias("end"),
            match.alias("value"),
        ),
    )


_SPAN_TYPE = "array<struct<start:int,kind:int,end:int,value:string>>"


def with_base_spans(docs: DataFrame, text: str = "text", out: str = "base") -> DataFrame:
    """Adds the array of valid base spans by start, then kind."""
    none = F.array().cast(_SPAN_TYPE)
    whole = F.coalesce(F.col(text), F.lit(""))
    kinds = list(_PATTERNS)
    names = {kind: f"__{out}_{kind}" for kind in kinds}
    found = {}
    for kind, pattern in _PATTERNS.items():
        matches = F.regexp_extract_all(whole, F.lit(pattern), F.lit(0))
        if kind in _MUST_HOLD:
            held = F.contains(whole, F.lit(_MUST_HOLD[kind]))
            matches = F.when(held, matches).otherwise(F.array().cast("array<string>"))
        found[names[kind]] = matches
    docs = docs.withColumns(found)
    spans = []
    for kind in kinds:
        matches = F.col(names[kind])
        each = _spans(whole, matches, F.lit(_PATTERNS[kind]), kind)
        spans.append(F.when(F.size(matches) > 0, _checked(each, kind)).otherwise(none))
    docs = docs.withColumn(out, F.array_sort(F.concat(*spans)))
    return docs.drop(*names.values())


def disclosing_terms(
    spark: SparkSession,
    docs: DataFrame,
    disclosure: float = DISCLOSURE,
    min_support: int = MIN_SUPPORT,
) -> DataFrame:
    """``doc_id, text_key, terms``: disclosing words of documents, from counts over all texts.

    ``text_key`` is a hash of the text. Only documents with entities are expanded; words
    are counted before they are shuffled.
    """
    chosen = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    held = with_base_spans(chosen).filter(F.size("base") > 0)
    before = F.greatest(F.col("span.start") - CONTEXT_CHARS, F.lit(0))
    left = F.substring(F.col("text"), before + 1, F.col("span.start") - before)
    right = F.substring(F.col("text"), F.col("span.end") + 1, F.lit(CONTEXT_CHARS))
    # words cut by the window's ends don't count; inside a line only
    left = F.regexp_replace(F.substring_index(left, "\n", -1), r"^\S+", "")
    right = F.regexp_replace(F.substring_index(right, "\n", 1), r"\S+$", "")
    window = held.select("doc_id", "text_key", F.explode("base").alias("span"), "text").select(
        "doc_id",
        "text_key",
        F.xxhash64("span.kind", F.lower("span.value")).alias("entity"),
        F.concat(left, F.lit(" "), right).alias("window"),
    )
    near = window.select(
        "doc_id",
        "text_key",
        "entity",
        F.xxhash64("window").alias("window"),
        F.explode(F.array_distinct(words(F.col("window")))).alias("term"),
    ).filter(F.length("term") >= MIN_TERM_CHARS)
    near = saved(spark, near.filter(~F.col("term").rlike("^[0-9]+$")), "near")
    per_window = near.groupBy("entity", "term", "window").agg(F.count("*").alias("n"))
    joint = per_window.groupBy("entity", "term").agg(
        F.sum("n").alias("joint"), F.count("*").alias("support")
    )
    joint = saved(spark, joint.filter(F.col("support") >= min_support), "joint")
    empty = near.limit(0).groupBy("doc_id", "text_key").agg(F.collect_set("term").alias("terms"))
    if joint.isEmpty():
        return empty
    entities = window.select("doc_id", "text_key", "entity").distinct().groupBy("entity")
    entities = entities.agg(F.count("*").alias("entity_docs"))
    total = docs.count()
    spread = docs.select(F.explode(F.array_distinct(words(F.col("text")))).alias("term"))
    spread = spread.groupBy("term").agg(F.count("*").alias("term_docs"))
    scored = joint.join(spread, "term").join(entities, "entity")
    information = -F.log2(F.col("entity_docs") / total)
    shared = F.least("joint", "term_docs", "entity_docs")
    pmi = F.log2(shared * F.lit(float(total)) / (F.col("entity_docs") * F.col("term_docs")))
    disclosed = scored.filter((information > 0) & (pmi >= disclosure * information))
    marked = near.join(disclosed.select("entity", "term"), ["entity", "term"])
    terms = marked.groupBy("doc_id", "text_key").agg(F.collect_set("term").alias("terms"))
    return saved(spark, terms, "terms")


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", -1)
    return F.filter(parts, lambda part: part != "")


def with_spans(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """Adds ``base``, the base spans, and ``spans``, those with the terms' spans."""
    terms = disclosing_terms(spark, docs, **options)
    terms = terms.select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("terms").alias("__terms")
    )
    same = docs["doc_id"].eqNullSafe(F.col("__id")) & (F.xxhash64(docs["text"]) == F.col("__key"))
    joined = docs.join(terms, same, "left").drop("__id", "__key")
    joined = with_base_spans(joined)
    edge = r"[\p{L}\p{N}]"
    either = F.array_join(F.col("__terms"), "|")
    pattern = F.concat(F.lit(f"(?iu)(?<!{edge})(?:"), either, F.lit(f")(?!{edge})"))
    matches = F.regexp_extract_all(F.col("text"), pattern, F.lit(0))
    spans = _spans(F.col("text"), matches, pattern, "term")
    spans = F.when(F.col("__terms").isNotNull() & (F.size(matches) > 0), spans)
    spans = F.coalesce(spans, F.array().cast(_SPAN_TYPE))
    return joined.withColumn("spans", F.array_sort(F.concat("base", spans))).drop("__terms")


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def span_digests(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Numbers of spans of each kind, a digest of the base spans, and all spans as text."""
    found = with_spans(spark, docs.select("doc_id", "text"))

    def count(k: int) -> Column:
        return F.size(F.filter("spans", lambda span: span["kind"] == k)).cast("long")

    counts = [count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    digest = F.sha2(_written(F.col("base")), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, _written(F.col("spans")).alias("spans"))


def redact(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; other columns stay.

    Overlapping spans are replaced together, by the kind of the first.
    """
    row = docs.select("doc_id", "text", F.struct("*").alias("__row"))
    found = with_spans(spark, row)
    spans, text = F.col("spans"), F.col("text")
    ends = _running(F.transform(spans, lambda s: s["end"]), F.greatest)
    found = found.withColumn("__cuts", F.when(F.size(spans) > 0, ends))
    cuts = F.col("__cuts")
    names = F.array(*(F.lit(f"[{kind.upper()}]") for kind in KINDS))

    def replace(span: Column, i: Column) -> Column:
        cut = F.coalesce(F.get(cuts, i - 1), F.lit(0))
        kept = F.substring(text, cut + 1, span["start"] - cut)
        return F.when(span["start"] >= cut, F.concat(kept, F.get(names, span["kind"]))).otherwise("")

    tail = F.substring(text, F.element_at(cuts, -1) + 1, F.length(text))
    changed = F.concat(F.array_join(F.transform(spans, replace), ""), tail)
    changed = F.when(F.size(spans) > 0, changed).otherwise(text)
    found = found.select("__row", changed.alias("text"), (F.size(spans) > 0).alias("__found"))

    def column(name: str) -> Column:
        own = F.col("__row").getField(name)
        if name == "text":
            own = F.col("text")
        elif name == "n_chars":
            length = F.length("text").cast(docs.schema[name].dataType)
            own = F.when(F.col("__found"), length).otherwise(own)
        return own.alias(name)

    return found.select(*map(column, docs.columns))
