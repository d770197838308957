
from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.functions.stopwords import ENGLISH_STOP_WORDS
from goldpan.functions.xml import build_xml
from goldpan.operators import tables
from goldpan.operators.changes import CHANGE, as_changes
from goldpan.plans import classifier as trained
from goldpan.plans import bayes, colocated, gold, gold_state, jobs, silver, workflows
from goldpan.plans import star_inputs as star
from goldpan.schemas import LOG_ROW_TAG, MOVIE_REVIEW, USER_PURCHASE
from goldpan.session import scratch_dir
from goldpan.sources.delimited import read_csv, write_csv
from goldpan.sources.formats import BUILT_IN_FORMATS, read_dataset, show_table, write_dataset
from goldpan.streaming.arrivals import ingest_arrivals, load_arrivals

try:  # the package works without its training-data operators
    import corpus_pipeline
    from goldpan.llm import queries as llm
except ImportError:
    llm = None

# The test text is invented: these two words split it into sensible classes.
LEXICON = ("worthless", "ble")
SHOWN_ROWS = 100
ARRIVAL_FORMATS = ("parquet", "json", "csv")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: spending and reviews per customer."""
    return gold_movie_analytics(spark, "/root/testdata/sf0.001")


# --- load, export, tables -----------------------------------------------------


def csv_load_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Export all purchases, read them back typed."""
    path = scratch_dir(spark, "roundtrip")
    write_csv(star.purchases(spark, folder), path)
    return read_csv(spark, path, USER_PURCHASE)


def csv_positional_binding(spark: SparkSession, folder: str) -> DataFrame:
    """A file whose header names say something else loads by position."""
    path = scratch_dir(spark, "positional")
    purchases = star.purchases(spark, folder)
    write_csv(purchases.toDF(*(f"c{i}" for i in range(len(purchases.columns)))), path)
    return read_csv(spark, path, USER_PURCHASE)


def csv_records_across_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with line breaks, read in splits instead of file by file."""
    path = scratch_dir(spark, "records")
    write_csv(star.movie_reviews(spark, folder), path)
    return read_csv(spark, path, MOVIE_REVIEW, layout="records")


def csv_layouts_agree(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with line breaks by the default, in splits, and file by file."""
    path = scratch_dir(spark, "layouts")
    write_csv(star.movie_reviews(spark, folder), path)
    copies = [
        read_csv(spark, path, MOVIE_REVIEW, layout=layout).withColumn("layout", F.lit(layout))
        for layout in ("records", "files")
    ]
    return reduce(DataFrame.unionAll, copies)


def typed_table(spark: SparkSession, folder: str) -> DataFrame:
    """Create the table, append a file to it, select everything."""
    name = _new_table(spark)
    tables.load_csv(spark, _purchases_csv(spark, folder), name)
    return spark.table(name).select("*")


def total_rows(spark: SparkSession, folder: str) -> DataFrame:
    """A1."""
    return tables.total_rows(star.table(spark, folder, "lineitem"))


def reload_twice(spark: SparkSession, folder: str) -> DataFrame:
    """T4: loading the same file again leaves the same table."""
    name, path = _new_table(spark), _purchases_csv(spark, folder)
    tables.reload_csv(spark, path, name)
    tables.reload_csv(spark, path, name)
    return spark.table(name)


def reload_changes(spark: SparkSession, folder: str) -> DataFrame:
    """T4: rows that a second load adds (some are copies) and removes, with signed counts."""
    name = _new_table(spark)
    purchases = star.purchases(spark, folder)
    tables.reload_table(purchases, name)
    tables.reload_table(purchases.filter("quantity >= 5").unionAll(purchases.filter("quantity > 48")), name)
    return tables.reload_changes(spark, name)


def load_report(spark: SparkSession, folder: str) -> DataFrame:
    """Everything a load refuses in a file with planted bad values."""
    base, name = scratch_dir(spark, "bad"), _new_table(spark)
    rows = star.purchases(spark, folder)
    bad = {
        "quantity": (F.col("quantity") == 7, F.lit("many")),
        "unit_price": (F.col("quantity") % 10 == 3, F.lit("999999.999")),
        "detail": (F.col("quantity") == 9, F.repeat(F.lit("x"), 1001)),
        "invoice_date": (F.col("quantity") == 13, F.lit("yesterday")),
    }
    planted = rows.select(
        *(
            F.when(bad[name][0], bad[name][1]).otherwise(F.col(name).cast("string")).alias(name)
            if name in bad
            else name
            for name in rows.columns
        )
    )
    write_csv(planted, f"{base}/whole")
    write_csv(rows.filter("quantity = 15").select("invoice_number", "stock_code"), f"{base}/short")
    report = tables.report_csv(spark, [f"{base}/whole", f"{base}/short"], name)
    return report.select("column_name", "reason", "n_rows", F.length("example").alias("n_shown"))


def table_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of a table as its write has counted them, beside a scan's."""
    name = _new_table(spark)
    tables.reload_table(star.purchases(spark, folder), name)
    tables.verify_table(spark, name)
    recorded = tables.table_rows(spark, name).withColumn("counted_by", F.lit("write"))
    scanned = tables.total_rows(spark.table(name)).withColumn("counted_by", F.lit("scan"))
    return recorded.unionAll(scanned)


def clear_table(spark: SparkSession, folder: str) -> DataFrame:
    """A loaded table's rows before and after it is cleared."""
    name = _new_table(spark)
    tables.reload_table(star.purchases(spark, folder), name)
    before = tables.total_rows(spark.table(name)).first().total_rows
    tables.clear_table(spark, name)
    return _before_and_after(spark, before, name)


def drop_recreate(spark: SparkSession, folder: str) -> DataFrame:
    """A dropped table comes back empty in the same folder; dropping twice is fine."""
    root = scratch_dir(spark, "table")
    name = _new_table(spark, root=root)
    tables.reload_table(star.purchases(spark, folder), name)
    before = tables.total_rows(spark.table(name)).first().total_rows
    tables.drop_table(spark, name)
    tables.drop_table(spark, name)
    _new_table(spark, name, root)
    return _before_and_after(spark, before, name)


def export_if_nonempty(spark: SparkSession, folder: str) -> DataFrame:
    """The export of a filled table survives the export of an emptied one."""
    name, path = _new_table(spark), scratch_dir(spark, "export")
    tables.reload_table(star.purchases(spark, folder), name)
    tables.export_if_nonempty(spark.table(name), path)
    tables.clear_table(spark, name)
    tables.export_if_nonempty(spark.table(name), path)
    return read_csv(spark, path, USER_PURCHASE)


# --- silver and gold ----------------------------------------------------------


def silver_user_purchase(spark: SparkSession, folder: str) -> DataFrame:
    """J3 S7 S8."""
    target = scratch_dir(spark, "silver")
    return jobs.transform_user_purchase(spark, _purchases_csv(spark, folder), target)


def silver_formats(spark: SparkSession, folder: str) -> DataFrame:
    """The purchases through every built-in format."""
    base = scratch_dir(spark, "formats")
    source = f"{base}/source"
    write_dataset(star.purchases(spark, folder), source)
    copies = []
    for fmt in BUILT_IN_FORMATS:
        write_dataset(read_dataset(spark, source), f"{base}/{fmt}", fmt)
        copy = read_dataset(spark, f"{base}/{fmt}", fmt, USER_PURCHASE)
        copies.append(copy.withColumn("fmt", F.lit(fmt)))
    return reduce(DataFrame.unionAll, copies)


def show_first_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The limit is the feature."""
    path = scratch_dir(spark, "show")
    write_dataset(star.purchases(spark, folder), path)
    return show_table(spark, path, n=SHOWN_ROWS, order_by=USER_PURCHASE.names)


def silver_review_logs(spark: SparkSession, folder: str) -> DataFrame:
    """J1 S6 S10."""
    source = scratch_dir(spark, "logs")
    write_csv(star.log_reviews(spark, folder), source)
    return jobs.transform_review_logs(spark, source, scratch_dir(spark, "silver"))


def silver_inferred_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Logs with fields that few rows have, by the schema of all rows together."""
    rare = F.col("event_id") % 89
    payload = F.struct(
        F.col("user_id").alias("userId"),
        F.col("event_type").alias("device"),
        F.when(rare == 0, F.concat(F.lit("note "), "event_id")).alias("note"),
        F.when(rare == 5, F.concat(F.lit("c"), "event_id"))
        .otherwise(F.col("event_id").cast("string"))
        .alias("code"),
        F.when(rare == 7, F.array(F.lit("many"), "event_type"))
        .when(rare == 8, F.array(F.lit("one")))
        .alias("tag"),
        F.when(rare == 9, F.struct(F.col("event_id").alias("at"))).alias("place"),
    )
    logs = star.table(spark, folder, "events").select(
        F.col("event_id").alias("id_review"), build_xml(payload, LOG_ROW_TAG).alias("log")
    )
    parsed = silver.review_logs(logs, payload=None)
    tags = F.array_join("tag", ",").alias("tags")
    return parsed.select(
        "id_review", "user_id", "device", "note", "code", tags, F.col("place.at").alias("place_at")
    )


def silver_classified(spark: SparkSession, folder: str) -> DataFrame:
    """J2 S5."""
    source, target = scratch_dir(spark, "reviews"), scratch_dir(spark, "silver")
    write_csv(star.movie_reviews(spark, folder), source)
    return jobs.transform_classified_movie_review(spark, source, target, lexicon=LEXICON)


def amount_spent(spark: SparkSession, folder: str) -> DataFrame:
    """J4, purchase half."""
    return gold.amount_spent(star.purchases(spark, folder))


def gold_movie_analytics(spark: SparkSession, folder: str) -> DataFrame:
    """J4 over the silver transforms, as one lazy plan."""
    return gold.movie_analytics(
        silver.user_purchase(star.purchases(spark, folder)),
        silver.classified_reviews(star.movie_reviews(spark, folder), LEXICON),
        silver.review_logs(star.log_reviews(spark, folder)),
    )


def gold_colocated(spark: SparkSession, folder: str) -> DataFrame:
    """Gold from log lines and labels that lie side by side in buckets."""
    name = f"colocated_{uuid.uuid4().hex}"
    colocated.write_colocated(
        silver.classified_reviews(star.movie_reviews(spark, folder), LEXICON),
        silver.review_logs(star.log_reviews(spark, folder)),
        name,
        scratch_dir(spark, "colocated"),
    )
    purchases = silver.user_purchase(star.purchases(spark, folder))
    return gold.with_reviews(purchases, colocated.reviews_by_customer(spark, name))


def gold_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Gold after two increments and one removal, by sums that follow the changes."""
    base = scratch_dir(spark, "gold-state")
    purchases = silver.user_purchase(star.purchases(spark, folder))
    classified = silver.classified_reviews(star.movie_reviews(spark, folder), LEXICON)
    logs = silver.review_logs(star.log_reviews(spark, folder))
    few = F.coalesce(F.col("quantity") < 20, F.lit(True))
    even, third = F.col("id_review") % 2 == 0, F.col("id_review") % 3 == 0
    gone = F.col("id_review") % 10 == 0

    def less(rows: DataFrame) -> DataFrame:
        return rows.withColumn(CHANGE, F.lit(-1).cast("long"))

    def step(number: int, **changed: DataFrame) -> DataFrame:
        following = gold_state.apply_changes(state, **changed)
        write_dataset(following, f"{base}/{number}")
        return read_dataset(spark, f"{base}/{number}")

    none = as_changes(classified.filter(F.lit(False)))
    state = gold_state.purchase_deltas(as_changes(purchases.filter(F.lit(False))))
    state = step(
        1,
        purchases=as_changes(purchases.filter(few)),
        classified=as_changes(classified.filter(even)),
        logs=as_changes(logs.filter(third)),
        classified_before=none,
        logs_after=as_changes(logs.filter(third)),
    )
    state = step(
        2,
        purchases=as_changes(purchases.filter(~few)),
        classified=as_changes(classified.filter(~even)),
        logs=as_changes(logs.filter(~third)),
        classified_before=as_changes(classified.filter(even)),
        logs_after=as_changes(logs),
    )
    state = step(
        3,
        purchases=less(purchases.filter("quantity > 40")),
        classified=less(classified.filter(gone)),
        logs_after=as_changes(logs),
    )
    return gold_state.gold_of(state)


def classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Fit on the labelled reviews, label all reviews. No SQL counterpart."""
    reviews = star.movie_reviews(spark, folder)
    model = trained.fit_classifier(reviews, star.review_labels(spark, folder))
    return trained.classify(model, reviews)


def classifier_bayes(spark: SparkSession, folder: str) -> DataFrame:
    """Naive Bayes over the labelled reviews, labels of all reviews."""
    reviews = star.movie_reviews(spark, folder)
    weights, prior = bayes.fit(reviews, star.review_labels(spark, folder))
    return bayes.classify(weights, prior, reviews).select("id_review", "positive_review")


# --- jobs and streams ---------------------------------------------------------


def job_smoke(spark: SparkSession, folder: str) -> DataFrame:
    """J6 over a given table."""
    return jobs.run_job(spark, "test", f"{folder}/lineitem.parquet")


def job_registry(spark: SparkSession, folder: str) -> DataFrame:
    """Every job by name, with the number of rows it leaves."""
    base = scratch_dir(spark, "jobs")
    purchases, reviews, logs = _bronze(spark, folder, base)
    results = {
        "up": jobs.run_job(spark, "up", purchases, f"{base}/{jobs.SILVER_PURCHASE}"),
        "crm": jobs.run_job(
            spark, "crm", reviews, f"{base}/{jobs.SILVER_CLASSIFIED}", lexicon=LEXICON
        ),
        "rl": jobs.run_job(spark, "rl", logs, f"{base}/{jobs.SILVER_REVIEW_LOGS}"),
        "ma": jobs.run_job(spark, "ma", base),
        "show": jobs.run_job(spark, "show", f"{base}/{jobs.SILVER_PURCHASE}", n=SHOWN_ROWS),
    }
    counts = [
        tables.total_rows(result).select(F.lit(name).alias("job"), "total_rows")
        for name, result in results.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def jobs_only(spark: SparkSession, folder: str) -> DataFrame:
    """J1-J4 on files, through ORC: the jobs without load and export."""
    base = scratch_dir(spark, "jobs")
    return workflows.run_jobs(spark, *_bronze(spark, folder, base), base, "orc", lexicon=LEXICON)


def bronze_to_gold(spark: SparkSession, folder: str) -> DataFrame:
    """Files in, gold out."""
    base = scratch_dir(spark, "run")
    purchases, reviews, logs = _bronze(spark, folder, base)
    name = f"user_purchase_{uuid.uuid4().hex}"
    return workflows.bronze_to_gold(spark, purchases, reviews, logs, base, name, lexicon=LEXICON)


def resumed_run(spark: SparkSession, folder: str) -> DataFrame:
    """A run over some purchases, then one over all that redoes what depends on them.

    The purchases of the first run are not written again; the others are added to them.
    """
    base = scratch_dir(spark, "resumed")
    rows, name = star.purchases(spark, folder), f"user_purchase_{uuid.uuid4().hex}"
    small = F.coalesce(F.col("quantity") < 20, F.lit(False))
    purchases, reviews, logs = _bronze(spark, folder, base, rows.filter(small))
    for later in (None, rows.filter(~small)):
        if later is not None:
            write_csv(later, purchases, add=True)
        result = workflows.bronze_to_gold(
            spark, purchases, reviews, logs, base, name, lexicon=LEXICON, resume=True
        )
    return result


def arrival_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Two arrivals and a run without one; every row is loaded once."""
    base = scratch_dir(spark, "arrivals")
    purchases = star.purchases(spark, folder)
    landing, target = f"{base}/landing", f"{base}/loaded"
    small = F.coalesce(F.col("quantity") < 25, F.lit(False))
    for number, part in enumerate((small, ~small)):
        write_csv(purchases.filter(part), f"{landing}/arrival-{number}")
        ingest_arrivals(spark, landing, target, f"{base}/checkpoint", USER_PURCHASE)
    ingest_arrivals(spark, landing, target, f"{base}/checkpoint", USER_PURCHASE)
    return spark.read.schema(USER_PURCHASE).parquet(target)


def arrival_formats(spark: SparkSession, folder: str) -> DataFrame:
    """The same arrivals into sinks of three formats."""
    base = scratch_dir(spark, "arrival-formats")
    landing = f"{base}/landing"
    write_csv(star.purchases(spark, folder), f"{landing}/arrival")
    copies = []
    for fmt in ARRIVAL_FORMATS:
        target = f"{base}/{fmt}"
        ingest_arrivals(spark, landing, target, f"{base}/checkpoint-{fmt}", USER_PURCHASE, fmt)
        copy = read_dataset(spark, target, fmt, USER_PURCHASE)
        copies.append(copy.withColumn("fmt", F.lit(fmt)))
    return reduce(DataFrame.unionAll, copies)


def arrival_table(spark: SparkSession, folder: str) -> DataFrame:
    """Two arrivals and a run without one into a typed table."""
    base, name = scratch_dir(spark, "arrival-table"), _new_table(spark)
    purchases = star.purchases(spark, folder)
    small = F.coalesce(F.col("quantity") < 25, F.lit(False))
    for number, part in enumerate((small, ~small)):
        write_csv(purchases.filter(part), f"{base}/landing/arrival-{number}")
        load_arrivals(spark, f"{base}/landing", name, f"{base}/checkpoint")
    load_arrivals(spark, f"{base}/landing", name, f"{base}/checkpoint")
    return spark.table(name)


def _new_table(spark: SparkSession, name: str | None = None, root: str | None = None) -> str:
    name = name or f"user_purchase_{uuid.uuid4().hex}"
    tables.create_table(spark, name, root or scratch_dir(spark, "table"))
    return name


def _before_and_after(spark: SparkSession, before: int, name: str) -> DataFrame:
    after = tables.total_rows(spark.table(name))
    return after.select(
        F.lit(before).cast("long").alias("rows_before"), F.col("total_rows").alias("rows_after")
    )


def _purchases_csv(spark: SparkSession, folder: str) -> str:
    path = scratch_dir(spark, "purchases")
    write_csv(star.purchases(spark, folder), path)
    return path


def _bronze(
    spark: SparkSession, folder: str, base: str, purchases: DataFrame | None = None
) -> tuple[str, str, str]:
    """The raw files; of all purchases unless others are given."""
    paths = tuple(
        f"{base}/bronze/{name}" for name in ("user_purchase", "movie_review", "log_reviews")
    )
    rows = (
        star.purchases(spark, folder) if purchases is None else purchases,
        star.movie_reviews(spark, folder),
        star.log_reviews(spark, folder),
    )
    for written, path in zip(rows, paths):
        write_csv(written, path)
    return paths


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {
        query.__name__: query
        for query in (
            csv_load_roundtrip,
            csv_positional_binding,
            csv_records_across_lines,
            csv_layouts_agree,
            typed_table,
            total_rows,
            reload_twice,
            reload_changes,
            load_report,
            table_counts,
            clear_table,
            drop_recreate,
            export_if_nonempty,
            silver_user_purchase,
            silver_formats,
            show_first_rows,
            silver_review_logs,
            silver_inferred_logs,
            silver_classified,
            amount_spent,
            gold_movie_analytics,
            gold_colocated,
            gold_incremental,
            classifier,
            classifier_bayes,
            job_smoke,
            job_registry,
            jobs_only,
            bronze_to_gold,
            resumed_run,
            arrival_ingest,
            arrival_formats,
            arrival_table,
        )
    }
    return own if llm is None else own | llm.queries() | {"pipeline": corpus_pipeline.run}


PURCHASES_SQL = """
select cast(l_orderkey as varchar) as invoice_number, cast(l_partkey as varchar) as stock_code,
       p_name as detail, cast(l_quantity as int) as quantity, o_orderdate as invoice_date,
       cast(p_retailprice as decimal(8,3)) as unit_price, cast(o_custkey as int) as customer_id,
       n_name as country
from lineitem
join orders on l_orderkey = o_orderkey
join part on l_partkey = p_partkey
join customer on o_custkey = c_custkey
join nation on c_nationkey = n_nationkey
"""


def _sql_list(words: tuple[str, ...]) -> str:
    return ", ".join("'" + word.replace("'", "''") + "'" for word in words)


CLASSIFIED_SQL = f"""
select id_review, cast(len(words) as bigint) as n_words,
       cast(list_has_any(words, [{_sql_list(LEXICON)}]) as int) as positive_review
from (
  select doc_id as id_review,
         list_filter(regexp_split_to_array(lower(text), '[^a-z]+'),
                     lambda word: word <> ''
                     and not list_contains([{_sql_list(ENGLISH_STOP_WORDS)}], word)) as words
  from documents
)
"""

AMOUNT_SPENT_SQL = f"""
select customer_id, cast(sum(quantity * unit_price) as decimal(18,3)) as amount_spent
from ({PURCHASES_SQL}) group by customer_id
"""


def _gold_sql(reviews: str = "true", purchases: str = "true") -> str:
    return f"""
with reviewed as (
  select cast(user_id as int) as customer_id, count(*) as review_count,
         cast(sum(positive_review) as bigint) as review_score
  from ({CLASSIFIED_SQL}) join events on id_review = event_id
  where {reviews}
  group by 1
), spent as (
  select customer_id, cast(sum(quantity * unit_price) as decimal(18,3)) as amount_spent
  from ({PURCHASES_SQL}) where {purchases} group by customer_id
)
select customer_id, amount_spent, coalesce(review_count, 0) as review_count,
       coalesce(review_score, 0) as review_score
from spent left join reviewed using (customer_id)
"""


GOLD_SQL = _gold_sql()

CHANGES_SQL = f"""
with before as ({PURCHASES_SQL}), after as (
  select * from before where quantity >= 5 union all select * from before where quantity > 48
)
select *, count(*) as change from (select * from after except all select * from before)
group by all
union all
select *, -count(*) from (select * from before except all select * from after) group by all
"""

BAYES_SQL = f"""
with reviews as (
  select doc_id as id_review, unnest(list_filter(
    regexp_split_to_array(lower(text), '[^a-z]+'),
    lambda word: word <> ''
    and not list_contains([{_sql_list(ENGLISH_STOP_WORDS)}], word))) as word
  from documents
), known as (
  select doc_id as id_review, quality as label from labels where quality in (0, 1)
), prior as (
  select ln(count(*) filter (where label = 1) + 1.0) - ln(count(*) filter (where label = 0) + 1.0)
         as prior
  from known join documents on id_review = doc_id
), by_word as (
  select word, count(*) filter (where label = 1) as in1, count(*) filter (where label = 0) as in0
  from reviews join known using (id_review) group by word
), totals as (
  select sum(in1) as all1, sum(in0) as all0, count(*) as vocabulary from by_word
), weights as (
  select word, ln((in1 + 1.0) / (all1 + vocabulary)) - ln((in0 + 1.0) / (all0 + vocabulary))
         as weight
  from by_word, totals
), scored as (
  select id_review, sum(weight) as score from reviews join weights using (word) group by id_review
)
select doc_id as id_review,
       cast(round(prior + coalesce(score, 0.0), 9) >= 0 as int) as positive_review
from documents left join scored on doc_id = id_review, prior
"""

REPORT_SQL = f"""
with purchases as ({PURCHASES_SQL}), problems as (
  select 'quantity' as column_name, 'not a int' as reason, 4 as n_shown
  from purchases where quantity = 7
  union all select 'unit_price', 'not a decimal(8,3)', 10 from purchases where quantity % 10 = 3
  union all select 'detail', 'longer than 1000', 100 from purchases where quantity = 9
  union all select 'invoice_date', 'not a timestamp_ntz', 9 from purchases where quantity = 13
  union all select null, 'wrong number of fields',
                   (select length(min(invoice_number || ',' || stock_code))
                    from purchases where quantity = 15)
  from purchases where quantity = 15
)
select column_name, reason, count(*) as n_rows, n_shown from problems group by all
"""

COUNTS_SQL = f"""
select count(*) as total_rows, counted_by
from ({PURCHASES_SQL}), (values ('write'), ('scan')) as ways(counted_by) group by counted_by
"""

EMPTIED_SQL = f"""
select count(*) as rows_before, cast(0 as bigint) as rows_after from ({PURCHASES_SQL})
"""


def oracle_sql() -> dict[str, str]:
    return _own_sql() if llm is None else _own_sql() | llm.oracle_sql()


def _own_sql() -> dict[str, str]:
    formats = [f"select *, '{fmt}' as fmt from ({PURCHASES_SQL})" for fmt in BUILT_IN_FORMATS]
    return {
        "csv_load_roundtrip": PURCHASES_SQL,
        "csv_positional_binding": PURCHASES_SQL,
        "csv_records_across_lines": (
            "select doc_id as id_review, text as review_str from documents"
        ),
        "csv_layouts_agree": (
            "select doc_id as id_review, text as review_str, layout "
            "from documents, (values ('records'), ('files')) as layouts(layout)"
        ),
        "typed_table": PURCHASES_SQL,
        "reload_changes": CHANGES_SQL,
        "load_report": REPORT_SQL,
        "table_counts": COUNTS_SQL,
        "total_rows": "select count(*) as total_rows from lineitem",
        "reload_twice": PURCHASES_SQL,
        "clear_table": EMPTIED_SQL,
        "drop_recreate": EMPTIED_SQL,
        "export_if_nonempty": PURCHASES_SQL,
        "silver_user_purchase": PURCHASES_SQL,
        "silver_formats": " union all ".join(formats),
        "show_first_rows": (
            f"select * from ({PURCHASES_SQL}) "
            f"order by {', '.join(USER_PURCHASE.names)} limit {SHOWN_ROWS}"
        ),
        "silver_review_logs": (
            "select event_id as id_review, user_id, event_type as device, value as score "
            "from events"
        ),
        "silver_inferred_logs": """
            select event_id as id_review, user_id, event_type as device,
                   case when event_id % 89 = 0 then 'note ' || event_id end as note,
                   case when event_id % 89 = 5 then 'c' else '' end || event_id as code,
                   case event_id % 89 when 7 then 'many,' || event_type when 8 then 'one' end as tags,
                   case when event_id % 89 = 9 then event_id end as place_at
            from events
        """,
        "silver_classified": CLASSIFIED_SQL,
        "amount_spent": AMOUNT_SPENT_SQL,
        "gold_movie_analytics": GOLD_SQL,
        "gold_colocated": GOLD_SQL,
        "gold_incremental": _gold_sql("id_review % 10 <> 0", "not quantity > 40"),
        "classifier_bayes": BAYES_SQL,
        "job_smoke": "select count(*) as total_rows from lineitem",
        "job_registry": f"""
            with purchases as ({PURCHASES_SQL})
            select 'up' as job, count(*) as total_rows from purchases
            union all select 'crm', count(*) from documents
            union all select 'rl', count(*) from events
            union all select 'ma', count(*) from (select distinct customer_id from purchases)
            union all select 'show', least(count(*), {SHOWN_ROWS}) from purchases
        """,
        "jobs_only": GOLD_SQL,
        "bronze_to_gold": GOLD_SQL,
        "resumed_run": GOLD_SQL,
        "arrival_ingest": PURCHASES_SQL,
        "arrival_formats": " union all ".join(
            f"select *, '{fmt}' as fmt from ({PURCHASES_SQL})" for fmt in ARRIVAL_FORMATS
        ),
        "arrival_table": PURCHASES_SQL,
    }
