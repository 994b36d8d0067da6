"""Results stay exact when one bot and one user hold a third of all events.

The jobs aggregate events before any join, so the event side of every join
holds one row per key even for the hot bot and user; AQE's skew-join split
(thresholds forced low here, broadcasts off so every join is a shuffle join)
finds nothing to split in these runs.
These runs check that the hot key goes through the partial aggregations and
shuffle joins with exact results."""

from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import functions as F

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(REPO, "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracles import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.01"
NAMES = ["chat_start_daily", "workflow_click_rate", "tag_chat_depth", "chat_start_compare", "chat_depth_by_tag",
         "bot_tags_daily", "chat_depth_total_compare", "click_total_compare"]

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture(scope="module")
def skewed_dir(spark, tmp_path_factory):
    """Copy of the test data where every third event belongs to bot p7 and user 7."""
    out = tmp_path_factory.mktemp("skewed")
    events = spark.read.parquet(f"{SF}/events.parquet")
    hot = (F.col("event_id") % 3) == 0
    (events.withColumn("props", F.when(hot, F.lit('{"k": 7}')).otherwise(F.col("props")))
     .withColumn("user_id", F.when(hot, F.lit(7).cast("long")).otherwise(F.col("user_id")))
     .coalesce(1).write.parquet(str(out / "events.parquet")))
    spark.read.parquet(f"{SF}/part.parquet").coalesce(1).write.parquet(str(out / "part.parquet"))
    for name in ("region nation customer supplier orders lineitem documents embeddings pages benchmark labels "
                 "conversations").split():
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(out / f"{name}.parquet"))
    return str(out)


@pytest.fixture(scope="module")
def skew_session(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", NAMES)
def test_exact_under_skew(skew_session, skewed_dir, name):
    con = duck(skewed_dir)
    sdf = entry.queries()[name](skew_session, skewed_dir)
    assert compare(sdf, con.sql(entry.oracle_sql()[name])) == "OK"
