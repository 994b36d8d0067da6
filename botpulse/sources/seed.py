"""Seed load of the AIGC bot → workflow list from a CSV file (job D1)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from botpulse.sources import schemas

# The tokens pandas' CSV reader treats as missing by default
# (the seed file was originally loaded with pandas, then rows with a missing
# id or workflow dropped).
PANDAS_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _missing_to_null(name: str):
    c = F.col(name)
    return F.when(c.isin(*PANDAS_NA_TOKENS), F.lit(None).cast("string")).otherwise(c).alias(name)


# pandas' dialect: quotes are doubled inside quoted fields, which may hold line breaks.
CSV_OPTIONS = {"quote": '"', "escape": '"'}


def clean_seed(raw: DataFrame, stamp: dt.date | str) -> DataFrame:
    """``(id, workflow)`` as read → ``aigc_tag`` rows; rows with a missing id or workflow are dropped."""
    stamp = dt.date.fromisoformat(str(stamp)) if not isinstance(stamp, dt.date) else stamp
    return (
        raw.select(_missing_to_null("id"), _missing_to_null("workflow"))
        .withColumnsRenamed({"id": "prompt_id", "workflow": "tag"})
        .dropna(subset=["prompt_id", "tag"])
        .withColumn("event_date", F.lit(stamp))
    )


def seed_tags(spark: SparkSession, path: str, stamp: dt.date | str) -> DataFrame:
    """``id,workflow`` CSV → ``aigc_tag`` rows ``(prompt_id, tag, event_date)``.

    Header row, any line ending, quoted fields as pandas reads them. Rows with a missing id or
    workflow are dropped; other odd ids (e.g. spreadsheet error strings) are kept as they are.
    """
    raw = (spark.read.schema(schemas.SEED_CSV).options(header=True, multiLine=True, **CSV_OPTIONS).csv(path))
    return clean_seed(raw, stamp)


def through_csv(df: DataFrame) -> DataFrame:
    """``(prompt_id, tag)`` rows written as CSV records and parsed again, as one lazy expression."""
    record = F.to_csv(F.struct(F.col("prompt_id").alias("id"), F.col("tag").alias("workflow")), CSV_OPTIONS)
    schema = "id string, workflow string"
    return df.select(F.from_csv(record, schema, CSV_OPTIONS).alias("seed")).select("seed.id", "seed.workflow")
