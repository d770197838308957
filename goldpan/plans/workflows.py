"""Runs of several steps: load, export, the jobs alone, and bronze to gold.

In every run the first failure is raised as it happens: steps beside it are interrupted
and nothing after it starts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from goldpan.operators import tables
from goldpan.plans import gold, jobs, silver
from goldpan.plans.ledger import Ledger
from goldpan.sources.delimited import DEFAULT_LAYOUT
from goldpan.sources.formats import DEFAULT_FORMAT, read_dataset, write_dataset

# the folder of a resumable run's ledger, below its base; hidden from readers
LEDGER = "_goldpan-ledger"


def load_purchases(
    spark: SparkSession,
    source: str,
    table: str,
    root: str,
    timestamp_format: str | None = None,
    layout: str = DEFAULT_LAYOUT,
) -> DataFrame:
    """Create the table if absent and make it equal to the CSV file."""
    tables.create_table(spark, table, root)
    tables.reload_csv(spark, source, table, timestamp_format=timestamp_format, layout=layout)
    return tables.table_rows(spark, table)


def export_purchases(
    spark: SparkSession, table: str, target: str, compression: str | None = None
) -> bool:
    """Export a non-empty table to CSV (T5, S2); tells whether it did."""
    return tables.export_if_nonempty(spark.table(table), target, compression=compression)


def run_jobs(
    spark: SparkSession,
    purchases_csv: str,
    reviews_csv: str,
    logs_csv: str,
    base: str,
    fmt: str = DEFAULT_FORMAT,
    lexicon: Iterable[str] = silver.DEFAULT_LEXICON,
    log_payload: T.StructType = silver.LOG_PAYLOAD,
    timestamp_format: str | None = None,
    layout: str = DEFAULT_LAYOUT,
) -> DataFrame:
    """The silver jobs on files that are there already, then gold."""
    purchases = f"{base}/{jobs.SILVER_PURCHASE}"
    _side_by_side(
        spark,
        lambda: jobs.transform_user_purchase(
            spark, purchases_csv, purchases, fmt, timestamp_format, layout
        ),
        *_review_jobs(spark, reviews_csv, logs_csv, base, fmt, lexicon, log_payload, layout),
    )
    return jobs.transform_movie_analytics(spark, base, fmt)


def bronze_to_gold(
    spark: SparkSession,
    purchases_csv: str,
    reviews_csv: str,
    logs_csv: str,
    base: str,
    table: str,
    fmt: str = DEFAULT_FORMAT,
    lexicon: Iterable[str] = silver.DEFAULT_LEXICON,
    log_payload: T.StructType = silver.LOG_PAYLOAD,
    timestamp_format: str | None = None,
    layout: str = DEFAULT_LAYOUT,
    resume: bool = False,
    export_compression: str | None = "gzip",
) -> DataFrame:
    """Load, export, the silver jobs, then gold.

    Purchases go from the table to silver without the detour over the exported
    file, which an empty load would leave out of date; such a load stops the run.
    The export is compressed, as purchases in plain text are a large part of what a run
    writes; ``export_compression=None`` leaves them so.

    With ``resume``, a ledger below ``base`` skips the steps that an earlier run has
    finished, as long as their inputs, parameters and results are what they were.
    """
    root = f"{base}/tables/{table}"
    lexicon = tuple(lexicon)
    ledger = Ledger(spark, f"{base}/{LEDGER}") if resume else None

    def step(name, work, inputs, output, *parameters):
        return ledger.step(name, work, inputs, output, fmt, *parameters) if ledger else work

    def table_folder() -> str | None:
        return tables.location(spark, table) if spark.catalog.tableExists(table) else None

    def target(name: str) -> Callable[[], str]:
        return lambda: f"{base}/{name}"

    step(
        "load",
        lambda: load_purchases(spark, purchases_csv, table, root, timestamp_format, layout),
        lambda: [purchases_csv],
        table_folder,
        timestamp_format,
        layout,
    )()
    purchases = spark.table(table)
    if not tables.is_nonempty(purchases):
        raise ValueError(f"{table} is empty after loading {purchases_csv}; nothing to transform")
    classify, parse = _review_jobs(
        spark, reviews_csv, logs_csv, base, fmt, lexicon, log_payload, layout
    )
    silver_sets = (jobs.SILVER_PURCHASE, jobs.SILVER_CLASSIFIED, jobs.SILVER_REVIEW_LOGS)
    exported = f"export/{table}_csv"
    _side_by_side(
        spark,
        step(
            "export",
            lambda: export_purchases(spark, table, f"{base}/{exported}", export_compression),
            lambda: [table_folder()],
            target(exported),
            export_compression,
        ),
        step(
            "up",
            lambda: write_dataset(
                silver.user_purchase(purchases), f"{base}/{jobs.SILVER_PURCHASE}", fmt
            ),
            lambda: [table_folder()],
            target(jobs.SILVER_PURCHASE),
        ),
        step(
            "crm",
            classify,
            lambda: [reviews_csv],
            target(jobs.SILVER_CLASSIFIED),
            sorted(lexicon),
            layout,
        ),
        step(
            "rl",
            parse,
            lambda: [logs_csv],
            target(jobs.SILVER_REVIEW_LOGS),
            log_payload and log_payload.json(),
            layout,
        ),
    )
    step(
        "ma",
        lambda: jobs.transform_movie_analytics(spark, base, fmt),
        lambda: [f"{base}/{name}" for name in silver_sets],
        target(jobs.GOLD_ANALYTICS),
    )()
    return read_dataset(spark, f"{base}/{jobs.GOLD_ANALYTICS}", fmt, gold.SCHEMA)


def _review_jobs(
    spark: SparkSession,
    reviews_csv: str,
    logs_csv: str,
    base: str,
    fmt: str,
    lexicon: Iterable[str],
    log_payload: T.StructType,
    layout: str,
) -> list[Callable[[], object]]:
    return [
        lambda: jobs.transform_classified_movie_review(
            spark, reviews_csv, f"{base}/{jobs.SILVER_CLASSIFIED}", fmt, layout, lexicon=lexicon
        ),
        lambda: jobs.transform_review_logs(
            spark, logs_csv, f"{base}/{jobs.SILVER_REVIEW_LOGS}", fmt, layout, payload=log_payload
        ),
    ]


def _side_by_side(spark: SparkSession, *steps: Callable[[], object]) -> None:
    """Independent steps at once, so one step's last tasks leave no executor idle."""
    tag = f"goldpan-{uuid.uuid4().hex}"

    def tagged(step: Callable[[], object]) -> object:
        spark.addTag(tag)
        return step()

    with ThreadPoolExecutor(len(steps)) as pool:
        run = inheritable_thread_target(spark)
        started = [pool.submit(run(lambda step=step: tagged(step))) for step in steps]
        done, running = wait(started, return_when=FIRST_EXCEPTION)
        failed = next((step for step in done if step.exception()), None)
        if failed and running:
            spark.interruptTag(tag)
    for step in [failed] if failed else started:
        step.result()
