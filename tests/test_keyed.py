import pytest
from pyspark.sql import functions as F

from scorewatch.functions.core import key_of
from scorewatch.operators.keys import one_row_per_key, pick_first
from scorewatch.plans import portfolio as pf
from scorewatch.registry import P, keyed_monitoring, monitoring
from scorewatch.sources.keyed import publish_keyed, within_buckets

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def no_broadcast(spark):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_keyed_table_keeps_its_rows_and_canonical_ids(spark):
    df = spark.createDataFrame([(" a ", 1), ("nan", 2), (None, 3), ("b", 4), ("b", 4)], "ee_customer_id string, v int")
    held = publish_keyed(df, "ee_customer_id", 3)
    assert sorted((r[0] or "", r[1]) for r in held.collect()) == [("", 2), ("", 3), ("a", 1), ("b", 4), ("b", 4)]
    assert held.select(key_of(held, "ee_customer_id").alias("k")).collect() and "nan" not in str(held.collect())
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("keyed_")]


def test_a_named_table_is_replaced(spark, tmp_path):
    for v in (1, 2):
        held = publish_keyed(spark.createDataFrame([("a", v)], "k string, v int"), "k", 2, table="keyed_test", path=str(tmp_path / f"t{v}"))
        assert [tuple(r) for r in held.collect()] == [("a", v)] and spark.table("keyed_test").count() == 1
    spark.sql("DROP TABLE keyed_test")


def test_picks_and_joins_by_key_need_no_exchange(spark, no_broadcast):
    within_buckets(spark)
    rows = [(f"c{i % 40}", i % 7, i) for i in range(400)]
    a = publish_keyed(spark.createDataFrame(rows, "id string, month int, v int"), "id", 4)
    b = publish_keyed(spark.createDataFrame([(k, m, -v) for k, m, v in rows], "id string, month int, w int"), "id", 4)
    lookup = one_row_per_key(b, ["id", "month"])
    joined = a.join(lookup, ["id", "month"], "left")
    assert exchanges(joined) == 0 and exchanges(pick_first(a, ["id"], ["v"])) == 0
    plain = spark.createDataFrame(rows, "id string, month int, v int").join(
        one_row_per_key(spark.createDataFrame([(k, m, -v) for k, m, v in rows], "id string, month int, w int"), ["id", "month"]), ["id", "month"], "left")
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, plain.collect()))


def test_master_frames_need_no_exchange_below_their_joins(spark, no_broadcast):
    """R1 and R4-R8 read these frames; over plain tables every one of them shuffles."""
    keyed, plain = keyed_monitoring(spark, SF, buckets=4), monitoring(spark, SF)
    for name in ("oop_new", "oop_existing", "attr_prod_new", "attr_prod_existing", "attr_bs_new", "attr_bs_existing"):
        assert exchanges(getattr(keyed, name)) == 0, name
        assert exchanges(getattr(plain, name)) > 0, name
    for frame in keyed._outcome_sources():
        assert exchanges(frame) == 0
    assert exchanges(pf.outcome_base(keyed.oop_new, keyed.t["resignation"], P)) == 0
    for name in ("oop_existing", "attr_bs_new"):
        a, b = getattr(keyed, name), getattr(plain, name)
        digest = lambda d: d.select(F.xxhash64(*sorted(d.columns)).alias("h")).agg(F.count(F.lit(1)), F.bit_xor("h")).first()
        assert digest(a) == digest(b)
