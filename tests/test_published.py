"""Tables published by a switch: a write that dies leaves the old table; appends are taken in once; races keep both changes."""

from __future__ import annotations

import datetime as dt

import pytest

from botpulse.functions.dates import DayRange
from botpulse.sources import published
from botpulse.sources.sinks import Superseded, read_table, write_table
from helpers import rows

DAYS = "prompt_id string, tag string, event_date date"
D1, D2, D3 = (dt.date(2024, 1, i) for i in (1, 2, 3))


def tags(spark, *given):
    return spark.createDataFrame(list(given), DAYS)


def table(spark, path, name="aigc_tag"):
    return rows(read_table(spark, name, path))


class Crash(Exception):
    pass


@pytest.fixture
def crash_before_publishing(monkeypatch):
    def arm():
        def die(*_args, **_kwargs):
            raise Crash

        monkeypatch.setattr(published.Store, "create", die)

    yield arm


@pytest.mark.parametrize("mode", ["overwrite", "append"])
def test_a_crash_between_write_and_switch_keeps_the_whole_old_table(spark, tmp_path, crash_before_publishing, monkeypatch, mode):
    path = str(tmp_path / "t")
    write_table(tags(spark, ("a", "x", D1), ("b", "x", D2), ("c", "x", D3)), path, days=DayRange(D1, D3))
    before = table(spark, path)
    crash_before_publishing()
    with pytest.raises(Crash):  # D2 is replaced and D3 emptied, or rows added
        write_table(tags(spark, ("n", "y", D2)), path, mode=mode, days=DayRange(D2, D3))
    monkeypatch.undo()
    assert table(spark, path) == before
    write_table(tags(spark, ("n", "y", D2)), path, mode=mode, days=DayRange(D2, D3))
    left = [("a", "x", D1), ("n", "y", D2)]
    assert table(spark, path) == (left if mode == "overwrite" else sorted(before + [("n", "y", D2)]))


def test_a_crash_keeps_the_undated_table(spark, tmp_path, crash_before_publishing, monkeypatch):
    path = str(tmp_path / "t")
    schema = "prompt_id string, tag string"
    write_table(spark.createDataFrame([("a", "x")], schema), path, partitioned=False)
    crash_before_publishing()
    with pytest.raises(Crash):
        write_table(spark.createDataFrame([("b", "y")], schema), path, partitioned=False)
    monkeypatch.undo()
    assert table(spark, path, "tags_exploded") == [("a", "x")]
    write_table(spark.createDataFrame([], schema), path, partitioned=False)
    assert table(spark, path, "tags_exploded") == []


def test_a_publication_cut_off_in_the_middle_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(tags(spark, ("a", "x", D1)), path)
    whole = (tmp_path / "t" / "_published" / f"{1:012d}.json").read_text()
    (tmp_path / "t" / "_published" / f"{2:012d}.json").write_text(whole[:len(whole) // 2])
    assert table(spark, path) == [("a", "x", D1)]
    write_table(tags(spark, ("b", "x", D2)), path, mode="append")
    assert table(spark, path) == [("a", "x", D1), ("b", "x", D2)]
    assert published.current(spark, path).number == 3


def test_a_change_on_an_outdated_table_is_made_on_top_of_the_other(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(tags(spark, ("a", "x", D1)), path)
    raced = []

    def change(now):
        if not raced:  # another writer publishes after this one has read the table
            raced.append(1)
            write_table(tags(spark, ("b", "x", D2)), path, mode="append")
        return published.replace(now, notes={"seen": "1"})

    published.publish(spark, path, change)
    assert table(spark, path) == [("a", "x", D1), ("b", "x", D2)]
    assert published.current(spark, path).notes == {"seen": "1"}


def test_run_ids_are_taken_in_once(spark, tmp_path):
    path = str(tmp_path / "t")
    more = tags(spark, ("a", "x", D1), ("a", "x", D1))
    assert [write_table(more, path, mode="append", run_id="r1") for _ in range(3)] == [2, 2, 2]
    assert write_table(more, path, mode="append") == 2  # without an id rows accumulate
    assert write_table(more, path, mode="append", run_id=["r2", "r3"]) == 2
    assert write_table(more, path, mode="append", run_id=["r2", "r3"]) == 2
    assert len(table(spark, path)) == 6
    with pytest.raises(Superseded):
        write_table(more, path, mode="append", run_id=["r3", "r4"])
    with pytest.raises(Superseded):
        write_table(more, path, guard=lambda now: False)
    assert len(table(spark, path)) == 6


def test_vacuum_keeps_what_the_last_publications_hold(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(5):
        write_table(tags(spark, (f"v{i}", "x", D1)), path)
    assert published.vacuum(spark, path, keep=2) == 0  # all too young
    assert published.vacuum(spark, path, keep=2, older_than=0) == 3
    assert table(spark, path) == [("v4", "x", D1)]
    write_table(tags(spark, ("w", "x", D2)), path, mode="append")
    assert table(spark, path) == [("v4", "x", D1), ("w", "x", D2)]


def test_plain_folders_are_read_and_never_hidden(spark, tmp_path):
    path = str(tmp_path / "t")
    tags(spark, ("a", "x", D1)).write.partitionBy("event_date").parquet(path)
    assert table(spark, path) == [("a", "x", D1)]
    with pytest.raises(ValueError):
        write_table(tags(spark, ("b", "x", D2)), path)
