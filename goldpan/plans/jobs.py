"""Single jobs and their names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.plans import gold, silver
from goldpan.schemas import (
    CLASSIFIED_REVIEW,
    LOG_REVIEWS,
    MOVIE_REVIEW,
    REVIEW_LOGS,
    USER_PURCHASE,
)
from goldpan.sources.delimited import DEFAULT_LAYOUT, read_csv
from goldpan.sources.formats import DEFAULT_FORMAT, read_dataset, show_table, write_dataset

# Dataset names below the silver and gold folders; silver names are E.
SILVER_REVIEW_LOGS = "silver/review_logs"
SILVER_CLASSIFIED = "silver/classified_movie_review"
SILVER_PURCHASE = "silver/user_purchase"
GOLD_ANALYTICS = "gold/movie_analytics"


def smoke(spark: SparkSession, path: str | None = None, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """Does the session run jobs (J6)? Counts a dataset, or a generated range without one."""
    rows = spark.range(1_000) if path is None else read_dataset(spark, path, fmt)
    return rows.agg(F.count("*").alias("total_rows"))


def transform_review_logs(
    spark: SparkSession,
    source: str,
    target: str,
    fmt: str = DEFAULT_FORMAT,
    layout: str = DEFAULT_LAYOUT,
    **options: object,
) -> DataFrame:
    logs = silver.review_logs(read_csv(spark, source, LOG_REVIEWS, layout=layout), **options)
    write_dataset(logs, target, fmt)
    return read_dataset(spark, target, fmt, logs.schema)


def transform_classified_movie_review(
    spark: SparkSession,
    source: str,
    target: str,
    fmt: str = DEFAULT_FORMAT,
    layout: str = DEFAULT_LAYOUT,
    **options: object,
) -> DataFrame:
    reviews = read_csv(spark, source, MOVIE_REVIEW, layout=layout)
    classified = silver.classified_reviews(reviews, **options)
    write_dataset(classified, target, fmt)
    return read_dataset(spark, target, fmt, CLASSIFIED_REVIEW)


def transform_user_purchase(
    spark: SparkSession,
    source: str,
    target: str,
    fmt: str = DEFAULT_FORMAT,
    timestamp_format: str | None = None,
    layout: str = DEFAULT_LAYOUT,
) -> DataFrame:
    purchases = read_csv(
        spark, source, USER_PURCHASE, layout=layout, timestamp_format=timestamp_format
    )
    write_dataset(silver.user_purchase(purchases), target, fmt)
    return read_dataset(spark, target, fmt, USER_PURCHASE)


def transform_movie_analytics(
    spark: SparkSession, base: str, fmt: str = DEFAULT_FORMAT, target: str | None = None
) -> DataFrame:
    """Gold from the silver sets below ``base``."""
    target = target or f"{base}/{GOLD_ANALYTICS}"
    analytics = gold.movie_analytics(
        read_dataset(spark, f"{base}/{SILVER_PURCHASE}", fmt, USER_PURCHASE),
        read_dataset(spark, f"{base}/{SILVER_CLASSIFIED}", fmt, CLASSIFIED_REVIEW),
        read_dataset(spark, f"{base}/{SILVER_REVIEW_LOGS}", fmt, REVIEW_LOGS),
    )
    write_dataset(analytics, target, fmt)
    return read_dataset(spark, target, fmt, analytics.schema)


# Job names (E), with ``cmr`` as a second name of ``crm``.
JOBS: dict[str, Callable[..., DataFrame]] = {
    "test": smoke,
    "show": show_table,
    "rl": transform_review_logs,
    "crm": transform_classified_movie_review,
    "cmr": transform_classified_movie_review,
    "up": transform_user_purchase,
    "ma": transform_movie_analytics,
}


def run_job(spark: SparkSession, name: str, *args: object, **kwargs: object) -> DataFrame:
    """Run one job by name; its result is read back from what it wrote."""
    if name not in JOBS:
        raise ValueError(f"no job {name!r}; the jobs are {', '.join(JOBS)}")
    return JOBS[name](spark, *args, **kwargs)
