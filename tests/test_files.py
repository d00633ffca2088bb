from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from flowtide.operators.encode import preprocess_flows
from flowtide.schema import LABELLED_TABLE, RAW_FLOW, TRAINING_FLOW
from flowtide.session import scratch_path, shared_dir
from flowtide.sources import files
from tests.helpers import NOON, raw_flows, rows


def test_raw_log_with_other_column_order_and_notations(spark, tmp_path):
    path = tmp_path / "log.csv"
    path.write_text(
        "Proto,StartTime,Dur,SrcAddr,Sport,Dir,DstAddr,Dport,State,sTos,dTos,TotPkts,TotBytes,"
        "SrcBytes,Label\n"
        "tcp,2011/08/12 15:25:56.021112,1.5,10.0.0.1,52475,   ->,10.0.0.2,80,SR_SA,0,0,3.0,180,60,a\n"
        "arp,2011-08-12 15:25:57,0,00:15:17:2c:e5:2d,,  who,10.0.0.3,0x0105,CON,NaN,,1,1585303458,60,\n"
    )
    first, second = files.read_raw_flows(spark, str(path)).orderBy("StartTime").collect()
    assert first.__fields__ == [f.name for f in RAW_FLOW]
    assert first.StartTime == dt.datetime(2011, 8, 12, 15, 25, 56, 21112)
    assert (first.Dir, first.TotPkts) == ("   ->", 3)
    assert (second.Sport, second.Dport, second.sTos, second.dTos, second.Label) == (
        None, "0x0105", None, None, None
    )
    assert second.TotBytes == 1585303458


def test_cells_that_do_not_fit_are_quarantined(spark, tmp_path):
    path = tmp_path / "log.csv"
    path.write_text(
        "Proto,StartTime,Dur,SrcAddr,Sport,Dir,DstAddr,Dport,State,sTos,dTos,TotPkts,TotBytes,"
        "SrcBytes,Label\n"
        "tcp,noon,1.5,10.0.0.1,52475,   ->,10.0.0.2,80,SR_SA,NaN,nan,3.0,12 kB,60,a\n"
        "arp,2011-08-12 15:25:57,,00:15:17:2c:e5:2d,,  who,10.0.0.3,0x0105,CON,NaN,,1, ,60,\n"
    )
    bad = files.read_quarantined(spark, str(path))
    assert sorted((r.column, r.cell) for r in bad.collect()) == [("StartTime", "noon"), ("TotBytes", "12 kB")]
    row = bad.first()
    assert row.file.endswith("log.csv") and row.row_text.startswith("noon,1.5,tcp,10.0.0.1")


def test_files_with_unlike_headers_are_refused(spark, tmp_path):
    encoded = preprocess_flows(raw_flows(spark, {}), 0.0, layout="training")
    files.write_flows(encoded, str(tmp_path / "in" / "a"))
    files.write_flows(encoded.select(*reversed(encoded.columns)), str(tmp_path / "in" / "b"))
    with pytest.raises(Exception, match="CSV header"):
        files.read_training_flows(spark, str(tmp_path / "in" / "*")).collect()


def test_training_file_round_trip(spark, tmp_path):
    encoded = preprocess_flows(raw_flows(spark, {}, {"Sport": None}), 0.0, layout="training")
    files.write_training_flows(encoded, str(tmp_path / "out"))
    back = files.read_training_flows(spark, str(tmp_path / "out"))
    assert [(f.name, f.dataType) for f in back.schema] == [
        (f.name, f.dataType) for f in TRAINING_FLOW
    ]
    assert rows(back) == rows(encoded)


def test_table_layout(spark, tmp_path):
    flows = raw_flows(
        spark, {"Sport": "0x0105", "Dport": "443.0"},
        {"StartTime": NOON + dt.timedelta(days=1), "Sport": None},
    ).withColumn("prediction", F.lit(2))
    path = str(tmp_path / "table")
    files.write_labelled(preprocess_flows(flows, 0.0, keep=["prediction"]), path)
    table = files.read_labelled(spark, path)
    assert table.columns == [f.name for f in LABELLED_TABLE] + ["dt"]
    assert "Label" not in table.columns and len(LABELLED_TABLE) == 21
    first = table.orderBy("StartTime").first()
    assert (first.Sport, first.Dport, first.sTos, first.dt) == (261, 443, "0.0", NOON.date())
    assert sorted(d for d in os.listdir(path) if d.startswith("dt=")) == [
        "dt=2011-08-12", "dt=2011-08-13"
    ]


def test_scratch_lies_in_the_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == named
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one.startswith(named) and one != two


class UnnamedConf:
    def get(self, name, default):
        return default


class Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, master):
        self.conf, self.sparkContext = UnnamedConf(), Context(master)


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        shared_dir(Session("spark://host:7077"))


def test_a_local_session_without_a_named_folder_gets_one(tmp_path, monkeypatch):
    monkeypatch.setattr("tempfile.tempdir", str(tmp_path))
    session = Session("local[2]")
    assert shared_dir(session).startswith(str(tmp_path))
    assert shared_dir(session) == shared_dir(session)
