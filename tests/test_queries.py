"""Every registered query runs on the smallest test tables and matches its SQL twin."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    from oracle_check import duck as make
    return make(SF)


def test_entry_runs(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:3] == ["RiskGroup", "Count", "Sum_Osbal_Resignation"]


def test_every_core_query_has_a_twin():
    from scorewatch.registry import QUERIES, TWINS
    assert set(QUERIES) == set(TWINS)


@pytest.mark.parametrize("name", sorted(set(queries()) & set(oracle_sql())))
def test_query_matches_twin(spark, duck, name):
    from oracle_check import check
    assert check(spark, duck, name, queries()[name], oracle_sql()[name], SF, verbose=True)


def test_a_report_that_stages_nothing_needs_no_checkpoint_folder(spark, monkeypatch, tmp_path):
    import datetime

    from scorewatch import session

    def refuse(spark):
        raise RuntimeError("no shared folder")

    rows = [(1000.0, 0.1, "O", datetime.datetime(1998, 1, 5)), (500.0, 0.0, "F", datetime.datetime(1998, 1, 9))]
    (spark.createDataFrame(rows, "l_extendedprice double, l_discount double, l_linestatus string, l_shipdate timestamp_ntz")
     .write.parquet(f"{tmp_path}/lineitem.parquet"))
    monkeypatch.setattr(session, "ensure_checkpoint_dir", refuse)
    out = queries()["r11_utilisation"](spark, str(tmp_path)).collect()
    assert [(r.ReportMonth, r.CreditLimit, r.UnpaidPrincipal) for r in out] == [("1998-01", 1500.0, 900.0)]


def test_a_named_checkpoint_folder_is_used_as_is():
    from types import SimpleNamespace

    from scorewatch.session import ensure_checkpoint_dir

    named = []
    for path in ("file:///mnt/shared/kept", "hdfs://store/kept"):
        context = SimpleNamespace(master="spark://head:7077", getCheckpointDir=lambda: None, setCheckpointDir=named.append)
        session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, other=None: path if key == "spark.checkpoint.dir" else other))
        assert ensure_checkpoint_dir(session) == path
    assert named == ["file:///mnt/shared/kept", "hdfs://store/kept"]
