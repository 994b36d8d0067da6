"""The table registry handed to every job.

The inputs are plain DataFrames; where they come from (Parquet paths,
catalog tables, JDBC, the test fixture adapter) does not matter downstream.
Optional derived tables let a caller pass a stored dimension instead of
having a job recompute it.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from botpulse.functions.dates import DayRange
from botpulse.sources import schemas


@dataclass(frozen=True)
class Tables:
    show_prompt_card: DataFrame
    bot_view: DataFrame
    chat_send: DataFrame
    event_version_count: DataFrame
    prompt_tag_link: DataFrame
    prompt_tag: DataFrame
    prompt_tag_path: DataFrame
    # Derived dimensions; None means "derive from the inputs".
    aigc_tag: DataFrame | None = None
    aigc_tag_v5: DataFrame | None = None
    tags_exploded: DataFrame | None = None
    # Per (day, user, bot) event summaries; None means "summarize the event tables".
    chat_summary: DataFrame | None = None
    view_summary: DataFrame | None = None
    show_summary: DataFrame | None = None

    def with_(self, **changes: DataFrame | None) -> Tables:
        return dataclasses.replace(self, **changes)

    @property
    def spark(self) -> SparkSession:
        return self.show_prompt_card.sparkSession

    @classmethod
    def from_parquet(cls, spark: SparkSession, base: str, **paths: str) -> Tables:
        """Read every input from ``{base}/{name}`` (Parquet) with its declared schema.

        ``paths`` overrides single locations, e.g. ``chat_send="s3://.../chat"``.
        Event tables stored partitioned by ``event_date`` get partition pruning
        from the jobs' day filters.
        """
        frames = {}
        for name, schema in schemas.INPUTS.items():
            path = paths.get(name, f"{base.rstrip('/')}/{name}")
            frames[name] = _read_parquet(spark, path, schema)
        for name in ("aigc_tag", "aigc_tag_v5", "tags_exploded"):
            if name in paths:
                frames[name] = _read_parquet(spark, paths[name], schemas.OUTPUTS[name])
        return cls(**frames)

    @classmethod
    def from_catalog(cls, spark: SparkSession, **names: str) -> Tables:
        """Read every input from a metastore table: ``names[input] = "db.table"``
        (default: the input's own name). Mirror-style quoted camel-case columns are renamed."""
        frames = {}
        for name in schemas.INPUTS:
            frames[name] = _conform(normalize_mirror_columns(spark.table(names.get(name, name))),
                                    schemas.INPUTS[name])
        return cls(**frames)

    @classmethod
    def from_jdbc(cls, spark: SparkSession, url: str, properties: dict[str, str], tables: dict[str, str],
                  partitioning: dict[str, dict[str, str]] | None = None, days: DayRange | None = None,
                  day_columns: dict[str, str] | None = None, splits: dict[str, tuple[str, int]] | None = None) -> Tables:
        """Read every input over JDBC (e.g. from a MySQL-protocol warehouse).

        ``tables[input]`` is the remote table or a parenthesised query. With ``days`` the event tables are read day by
        day: a predicate per day (:func:`day_predicates`) splits the read over tasks and is the source's own filter, so
        other days never leave it. ``day_columns[input]`` names the day column as the source spells it (default
        ``event_date``), ``splits[input] = (integer column, n)`` cuts each day further. For other tables, and without ``days``, pass
        ``partitioning[input] = {"partitionColumn": ..., "lowerBound": ..., "upperBound": ..., "numPartitions": ...}``.
        Only a driver on the classpath is needed; nothing else changes downstream.
        """
        frames = {}
        for name, schema in schemas.INPUTS.items():
            if days is not None and "event_date" in schema.fieldNames():
                where = day_predicates(days, (day_columns or {}).get(name, "event_date"), *(splits or {}).get(name, (None, 1)))
                read = spark.read.jdbc(url, tables[name], predicates=where, properties=properties)
                frames[name] = _conform(normalize_mirror_columns(read), schema)
                continue
            reader = spark.read.format("jdbc").option("url", url).option("dbtable", tables[name])
            for key, value in {**properties, **(partitioning or {}).get(name, {})}.items():
                reader = reader.option(key, value)
            frames[name] = _conform(normalize_mirror_columns(reader.load()), schemas.INPUTS[name])
        return cls(**frames)


def day_predicates(days: DayRange, column: str = "event_date", split_by: str | None = None, n: int = 1) -> list[str]:
    """One SQL predicate per day (and split) of the range, which no row meets twice.

    A half-open interval rather than an equality, so that a date and a time stamp column are both met whole
    and an index on the column serves. Splits are the remainders of an integer column; rows where it is null are in the first.
    """
    if n < 1 or (n > 1 and split_by is None):
        raise ValueError("splits need a column and a number of 1 or more")
    out = []
    for day in days.days():
        span = f"{column} >= DATE '{day}' AND {column} < DATE '{day + dt.timedelta(days=1)}'"
        out += [span] if n == 1 else [f"{span} AND MOD(ABS(COALESCE({split_by}, 0)), {n}) = {i}" for i in range(n)]
    return out


def _read_parquet(spark: SparkSession, path: str, schema) -> DataFrame:
    """Parquet with the file's own column types conformed to ``schema``; an empty
    folder (nothing to infer from) is read with ``schema`` directly."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return spark.read.schema(schema).parquet(path)
    return _conform(df, schema)


def _conform(df: DataFrame, schema) -> DataFrame:
    """The declared columns, cast to the declared types (no-ops where they already match;
    e.g. a TIMESTAMP ``created_at`` becomes TIMESTAMP_NTZ in the session time zone).

    Ids keep the type they are delivered in (they are only compared and counted), and a day
    delivered as text stays text until the range filter has been applied to it (``within``)."""
    def conformed(f):
        c = F.col(f.name)
        as_delivered = f.name in schemas.IDS or (
            f.name == "event_date" and df.schema[f.name].dataType.typeName() == "string")
        return c if as_delivered else c.cast(f.dataType).alias(f.name)

    return df.select(*[conformed(f) for f in schema.fields])


_QUOTED = re.compile(r'^"(.*)"$')
_CAMEL = re.compile(r"(?<=[a-z0-9])([A-Z])")

# Mirror-table column names (quoted camel case) → names used by the jobs.
_RENAMES = {"prompt_tag_id": "tag_id"}


def normalize_mirror_columns(df: DataFrame) -> DataFrame:
    """Rename mirror columns such as ``"PromptId"`` / ``"pathId"`` to ``prompt_id`` / ``path_id``."""
    out = []
    for name in df.columns:
        bare = _QUOTED.sub(r"\1", name)
        snake = _CAMEL.sub(r"_\1", bare).lower()
        snake = _RENAMES.get(snake, snake)
        out.append(F.col(f"`{name}`").alias(snake))
    return df.select(*out)
