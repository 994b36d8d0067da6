"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from botpulse.session import ensure_checkpoint_dir

# Words everywhere in this package: maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\x0c\r"


def read_documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a Parquet table in the shared checkpoint folder and read back.

    Cuts the lineage (a lost executor re-reads files, not the whole history) and
    lets several consumers share one computation.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(docs: DataFrame, text_col: str = "text") -> Column:
    """The text column as a string, null as the empty text."""
    return F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit(""))


def content_key(text: Column) -> list[Column]:
    """Two independently seeded 64-bit hashes of a text: the identity of its content."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(0x5EED), text).alias("k2")]


class Numbered:
    """``docs`` with its columns renamed by position, so that no name of theirs can clash with a
    column an operator makes; ``restore`` gives the names back."""

    def __init__(self, docs: DataFrame):
        self.names = docs.columns
        self.frame = docs.toDF(*[f"__c{i}" for i in range(len(self.names))])

    def __call__(self, name: str) -> str:
        return f"__c{self.names.index(name)}"

    def restore(self, df: DataFrame, *added: str) -> DataFrame:
        """The columns of ``docs`` but those named like ``added``, then ``added``."""
        return df.select(*[F.col(f"__c{i}").alias(n) for i, n in enumerate(self.names) if n not in added], *added)


def once(column: Column) -> Column:
    """``column`` as an expression that the optimiser neither copies into a consumer nor pushes a
    filter through (it holds the task's partition number, which is not deterministic to the
    optimiser): costly array expressions that several consumers use are then computed once a row."""
    return F.when(F.spark_partition_id() >= 0, column)
