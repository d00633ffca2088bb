"""Loads of the stored table: records, compaction, repeated loads, and which files a read opens."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from flowtide.operators.encode import preprocess_flows
from flowtide.plans import dashboard
from flowtide.sources import files, manifest
from tests.helpers import NOON, plan, raw_flows, rows

DAYS = 4


def labelled(spark, first, count=8, **row):
    """Flows of ``DAYS`` days, numbered by ``TotPkts``."""
    every = [{"StartTime": NOON + dt.timedelta(days=i % DAYS, seconds=first + i), "TotPkts": first + i, **row}
             for i in range(count)]
    flows = raw_flows(spark, *every).withColumn("prediction", F.lit(1))
    return preprocess_flows(flows, 0.0, keep=["prediction"])


def numbers(df):
    return sorted(r.TotPkts for r in df.select("TotPkts").collect())


def of_table(spark, path):
    return numbers(files.read_labelled(spark, path))


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def fill(spark, path, loads=3):
    for i in range(loads):
        files.write_labelled(labelled(spark, 10 * i), path, load=f"l{i}")
    return sorted(10 * i + j for i in range(loads) for j in range(8))


def test_each_row_once_before_during_and_after_a_compaction(spark, path, monkeypatch):
    wanted = fill(spark, path)
    before = files.read_labelled(spark, path)
    during, put = [], manifest.put_record
    monkeypatch.setattr(manifest, "put_record", lambda *a: (during.append(of_table(spark, path)), put(*a)))
    assert files.compact_labelled(spark, path) == 3 * DAYS
    assert during == [wanted]
    assert numbers(before) == of_table(spark, path) == wanted
    assert len(files.read_labelled(spark, path).inputFiles()) == DAYS
    assert files.compact_labelled(spark, path) == 0


def test_parts_that_are_large_enough_stay(spark, path):
    files.write_labelled(labelled(spark, 0, 80), path)
    wanted = list(range(80))
    for first in (100, 110):
        files.write_labelled(labelled(spark, first), path)
        wanted += range(first, first + 8)
    assert files.compact_labelled(spark, path, target_rows=20) == 2 * DAYS
    assert of_table(spark, path) == wanted
    assert len(files.read_labelled(spark, path).inputFiles()) == 2 * DAYS


def test_a_load_that_nobody_recorded_is_not_seen(spark, path):
    wanted = fill(spark, path, 2)
    lost = files.with_day(files.to_table_row(labelled(spark, 500))).withColumn("version", F.lit(None).cast("string"))
    manifest.write_parts(lost, path, manifest.new_commit())
    assert of_table(spark, path) == wanted
    assert files.tidy_labelled(spark, path, keep_hours=1) == 0
    assert files.tidy_labelled(spark, path, keep_hours=0) == DAYS
    assert of_table(spark, path) == wanted


@pytest.mark.parametrize("compacted", [False, True])
def test_a_repeated_load_replaces_itself_even_in_merged_files(spark, path, compacted):
    fill(spark, path, 3)
    if compacted:
        files.compact_labelled(spark, path)
        files.tidy_labelled(spark, path, keep_hours=0)
    files.write_labelled(labelled(spark, 900, 2), path, load="l1")
    wanted = [*range(8), *range(20, 28), 900, 901]
    assert of_table(spark, path) == wanted
    newest = files.newest_labelled(spark, path, 100)
    assert numbers(newest) == wanted
    files.compact_labelled(spark, path)
    files.write_labelled(labelled(spark, 0, 1).where("false"), path, load="l1")
    assert of_table(spark, path) == [*range(8), *range(20, 28)]
    files.tidy_labelled(spark, path, keep_hours=0)
    files.write_labelled(labelled(spark, 700, 1), path, load="l1")
    assert of_table(spark, path) == [*range(8), *range(20, 28), 700]


def test_tidy_removes_what_was_replaced_and_gathers_records(spark, path):
    wanted = fill(spark, path)
    files.compact_labelled(spark, path)
    assert files.tidy_labelled(spark, path) == 0
    assert len(manifest.names_in(spark, f"{path}/_manifest")) == 4
    assert files.tidy_labelled(spark, path, keep_hours=0) == 3 * DAYS
    assert len(manifest.names_in(spark, f"{path}/_manifest")) == 1
    assert of_table(spark, path) == wanted
    files.write_labelled(labelled(spark, 300), path)
    assert files.compact_labelled(spark, path) == 2 * DAYS
    files.tidy_labelled(spark, path, keep_hours=0)
    assert of_table(spark, path) == [*wanted, *range(300, 308)]
    assert len(files.read_labelled(spark, path).inputFiles()) == DAYS


def opened(df):
    return {f.split("dt=")[1].split("/")[0] for f in df.inputFiles()}


@pytest.mark.parametrize("n", [1, 13, 24, 1000])
def test_newest_opens_files_of_needed_days_only(spark, path, n):
    wanted = fill(spark, path)
    table = files.read_labelled(spark, path)
    newest = files.newest_labelled(spark, path, n)
    direct = [r.TotPkts for r in table.orderBy(F.desc("StartTime")).limit(n).collect()]
    assert [r.TotPkts for r in newest.collect()] == direct
    rows_a_day = len(wanted) // DAYS
    assert len(opened(newest)) == min(DAYS, -(-n // rows_a_day))
    if n == 1:
        assert len(newest.inputFiles()) == 1


def test_a_time_range_opens_files_that_may_hold_it(spark, path):
    fill(spark, path, 3)
    start = NOON + dt.timedelta(days=1)
    found = files.read_labelled(spark, path, start, start + dt.timedelta(seconds=9))
    assert opened(found) == {"2011-08-13"} and len(found.inputFiles()) == 1
    assert opened(files.read_labelled(spark, path, start=start)) == {"2011-08-13", "2011-08-14", "2011-08-15"}


def test_flows_without_a_time_are_kept_and_come_last(spark, path):
    timed, untimed = labelled(spark, 0, 4), labelled(spark, 50, 3).withColumn("StartTime", F.lit(None).cast("timestamp_ntz"))
    files.write_labelled(timed, path)
    files.write_labelled(untimed.limit(1), path)
    files.write_labelled(untimed, path)
    assert files.compact_labelled(spark, path) == 2
    assert numbers(files.newest_labelled(spark, path, 4)) == [0, 1, 2, 3]
    assert numbers(files.newest_labelled(spark, path, 6).where("StartTime is not null")) == [0, 1, 2, 3]
    assert files.newest_labelled(spark, path, 100).count() == files.read_labelled(spark, path).count() == 8


def test_metrics_come_from_the_records(spark, path, monkeypatch):
    for i in range(2):
        files.write_labelled(labelled(spark, 10 * i, SrcAddr=f"10.0.0.{i}"), path, load=f"l{i}")
    files.write_labelled(labelled(spark, 30, SrcAddr=None), path)
    for merged in (False, True):
        if merged:
            files.compact_labelled(spark, path)
        with monkeypatch.context() as patch:
            patch.setattr(manifest, "open_parts", None)
            assert tuple(files.labelled_metrics(spark, path).first()) == (24, 2, 24)
    files.write_labelled(labelled(spark, 50, 2, SrcAddr="10.0.0.9"), path, load="l1")
    assert tuple(files.labelled_metrics(spark, path).first()) == (18, 2, 18)


def test_ranges_come_from_the_records(spark, path):
    files.write_labelled(labelled(spark, 0, Dur=float("inf")), path)
    files.write_labelled(labelled(spark, 20, 4, Dur=2.5), path, load="a")
    files.write_labelled(labelled(spark, 40, 4, Dur=0.5).withColumn("StartTime", F.lit(None).cast("timestamp_ntz")), path)
    table, bounds = files.read_labelled(spark, path), files.labelled_bounds(spark, path)
    assert bounds["Dur"] == (0.5, 2.5) and bounds["TotPkts"] == (0, 43)
    assert bounds["StartTime"] == tuple(table.agg(F.min("StartTime"), F.max("StartTime")).first())
    found, plain = dashboard.panels(table, bounds), dashboard.panels(table)
    for name in ("duration_histogram", "totpkts_histogram", "protocol_over_time"):
        assert rows(found[name]) == rows(plain[name])
        assert plan(found[name]).split("Physical Plan")[1].split("Initial Plan")[0].count("FileScan") == 1
    files.compact_labelled(spark, path)
    assert files.labelled_bounds(spark, path) == bounds
    files.write_labelled(labelled(spark, 20, 4, Dur=1.5), path, load="a")
    assert files.labelled_bounds(spark, path) is None


def test_a_table_without_loads_is_empty(spark, path):
    assert files.read_labelled(spark, path).count() == 0
    assert files.newest_labelled(spark, path, 5).count() == 0
    assert tuple(files.labelled_metrics(spark, path).first()) == (0, 0, 0)
    assert files.compact_labelled(spark, path) == 0 and files.tidy_labelled(spark, path) == 0
