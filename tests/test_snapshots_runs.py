"""Snapshots switched by a manifest (A4, A9), resumable page runs (A8), append form of the table load."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from scorewatch.plans.runs import Masters, Page, finished, run_pages
from scorewatch.sources import sinks, snapshots


def rows(df):
    return sorted(tuple(r) for r in df.drop("run_date").collect())


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="scorewatch-snapshots-")


def test_dates_are_switched_one_by_one(spark, root):
    a = spark.createDataFrame([("x", 1), ("x", 1), (None, None)], "k string, v int")
    b = spark.createDataFrame([("y", 2)], "k string, v int")
    assert snapshots.publish(a, root, "2026-03-01")["rows"] == 3
    snapshots.publish(b, root, "2026-04-01")
    assert snapshots.dates(spark, root) == ["2026-03-01", "2026-04-01"]
    assert snapshots.read(spark, root, "2026-03-01").where("k = 'x'").count() == 2
    assert rows(snapshots.read(spark, root)) == [("y", 2)]
    snapshots.publish(b, root, "2026-03-01")
    assert rows(snapshots.read(spark, root, "2026-03-01")) == [("y", 2)]
    with pytest.raises(KeyError):
        snapshots.read(spark, root, "2026-05-01")


def test_a_writer_that_fails_half_way_leaves_the_old_date(spark, root):
    old = spark.createDataFrame([("x", 1)], "k string, v int")
    snapshots.publish(old, root, "2026-03-01")
    broken = spark.range(0, 1000, 1, 8).select(F.col("id").cast("string").alias("k"), F.when(
        F.col("id") == 999, F.raise_error(F.lit("stopped"))).otherwise(F.lit(1)).cast("int").alias("v"))
    with pytest.raises(Exception, match="stopped"):
        snapshots.publish(broken, root, "2026-03-01")
    assert rows(snapshots.read(spark, root, "2026-03-01")) == [("x", 1)]
    assert len(snapshots.expire(spark, root)) <= 1              # what the failed writer left
    assert rows(snapshots.read(spark, root, "2026-03-01")) == [("x", 1)]


def test_other_rows_than_asked_for_are_not_switched_in(spark, root):
    snapshots.publish(spark.createDataFrame([(1,)], "v int"), root, "2026-03-01")
    draw = F.udf(lambda: int.from_bytes(os.urandom(6), "big"), "long").asNondeterministic()      # other values in every job
    shifting = spark.range(50).select(draw().alias("v"))
    with pytest.raises(snapshots.SnapshotMismatch):
        snapshots.publish(shifting, root, "2026-03-01")
    assert rows(snapshots.read(spark, root, "2026-03-01")) == [(1,)]


def test_a_version_taken_by_another_publisher_is_not_lost(spark, root, monkeypatch):
    df = spark.createDataFrame([(1,)], "v int")
    snapshots.publish(df, root, "2026-03-01")
    real, raced = snapshots.manifest, []

    def stale(s, r):
        found = real(s, r)
        if not raced:                                           # another publisher switches after this one has read
            raced.append(True)
            snapshots._switch(s, r, lambda e: {**e, "2026-01-01": e["2026-03-01"]})
        return found

    monkeypatch.setattr(snapshots, "manifest", stale)
    snapshots._switch(spark, root, lambda e: {**e, "2026-04-01": e["2026-03-01"]})
    assert sorted(real(spark, root)[1]) == ["2026-01-01", "2026-03-01", "2026-04-01"]


def test_empty_frames_odd_columns_and_expiry(spark, root):
    odd = spark.createDataFrame([], "`a.b` int, node string")
    assert snapshots.publish(odd, root, "2026-01-01")["rows"] == 0
    assert snapshots.read(spark, root).columns == ["a.b", "node", "run_date"]
    for d in ("2026-02-01", "2026-03-01"):
        snapshots.publish(spark.createDataFrame([(d,)], "d string"), root, d)
    assert len(snapshots.expire(spark, root, keep=2)) == 1
    assert snapshots.dates(spark, root) == ["2026-02-01", "2026-03-01"]
    assert rows(snapshots.read(spark, root, "2026-02-01")) == [("2026-02-01",)]


def test_a_run_stops_and_resumes(spark, root):
    counts, fail = {}, {"on": True}

    def master(name, make):
        def build(held):
            counts[name] = counts.get(name, 0) + 1
            return make(held)
        return build

    def page(n, source):
        def build(held):
            if n == 5 and fail["on"]:
                raise RuntimeError("stopped")
            counts[n] = counts.get(n, 0) + 1
            return held[source].select(F.lit(n).alias("page"), "v")
        return build

    def masters():
        return Masters(spark, {"base": ((), master("base", lambda _: spark.range(5).select(F.col("id").alias("v")))),
                               "derived": (("base",), master("derived", lambda m: m["base"].where("v > 1")))})

    pages = [Page(f"page{n}", page(n, "base" if n < 4 else "derived"), ("base",) if n < 4 else ("derived",), ("v",), n == 7)
             for n in range(1, 8)]
    first = masters()
    with pytest.raises(RuntimeError, match="stopped"):
        run_pages(spark, pages, first, root)
    assert sorted(finished(spark, root)) == [f"page{n}" for n in range(1, 5)] and first.held == {}
    fail["on"] = False
    second = masters()
    entries = run_pages(spark, pages, second, root)
    assert [entries[p.name]["rows"] for p in pages] == [5, 5, 5, 3, 3, 3, 3]
    assert counts == {"base": 2, "derived": 2, **{n: 1 for n in range(1, 8)}} and second.held == {}
    assert run_pages(spark, pages, masters(), root) == entries and counts["base"] == 2      # nothing left: no master is built
    assert spark.read.parquet(f"{root}/pages/page7").count() == 3
    assert [r.v for r in spark.read.option("header", True).csv(f"{root}/pages/page1").collect()] == list("01234")


def test_an_entry_cut_off_while_written_counts_as_unfinished(spark, root):
    pages = [Page("only", lambda _: spark.range(2))]
    os.makedirs(f"{root}/done")
    with open(f"{root}/done/only.json", "w") as f:
        f.write('{"page": "on')
    assert finished(spark, root) == {}
    assert run_pages(spark, pages, Masters(spark, {}), root)["only"]["rows"] == 2


def test_table_load_appends(spark):
    name = "scorewatch_append_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df = spark.createDataFrame([(1,)], "v int")
    sinks.save_table(df, name)
    sinks.save_table(df.withColumn("v", F.lit(2)), name, append=True)
    assert sorted(r.v for r in spark.table(name).collect()) == [1, 2]
    sinks.save_table(df, name)
    assert [r.v for r in spark.table(name).collect()] == [1]
    spark.sql(f"DROP TABLE {name}")


COMPARED = {"page07_unit_bad_rate_mom": "r7_from_resolved_dates", "page09_cl_change_exposure": "r9_cl_change_exposure",
            "page11_utilization_trend": "r11_utilisation", "resignation_resolution": "r17_resignation_resolution",
            "date_quality": "r23_date_quality", "repayment_duplicates": "r20_duplicate_audit"}


def test_the_monthly_run_resumes_and_equals_the_registered_queries(spark, root):
    from scorewatch.plans.monthly import monthly_plan, publish_resolved
    from scorewatch.plans.params import TESTDATA
    from scorewatch.registry import EVENT_KEY, LOAN_ORDER, QUERIES, RUN_KEY, logical
    sf = "/root/testdata/sf0.001"

    def plan():
        return monthly_plan(spark, logical(spark, sf), TESTDATA, RUN_KEY, EVENT_KEY, LOAN_ORDER, only=set(COMPARED))

    pages, masters = plan()

    def stop(_):
        raise RuntimeError("stopped")

    with pytest.raises(RuntimeError, match="stopped"):
        run_pages(spark, [*pages[:3], Page(pages[3].name, stop), *pages[4:]], masters, root)
    assert len(finished(spark, root)) == 3
    pages, masters = plan()
    entries = run_pages(spark, pages, masters, root)
    assert set(entries) == set(COMPARED)
    for page in pages:
        expected = QUERIES[COMPARED[page.name]](spark, sf)
        path = entries[page.name]["path"]
        got = spark.read.parquet(path) if page.large else spark.read.schema(page_schema(expected, path, spark)).option("header", True).csv(path)
        assert sorted(map(str, got.select(*expected.columns).collect())) == sorted(map(str, expected.collect())), page.name
    publish_resolved(spark, entries, root, TESTDATA)
    assert snapshots.read(spark, f"{root}/snapshots/resignation", TESTDATA.as_of).count() == entries["resignation_resolution"]["rows"]


def page_schema(expected, path, spark):
    """The query's types in the order of the page's header."""
    from pyspark.sql.types import StructType
    return StructType([expected.schema[c] for c in spark.read.option("header", True).csv(path).columns])
