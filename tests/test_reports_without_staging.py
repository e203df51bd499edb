"""Reports that stage nothing run where no checkpoint folder may be asked for, and match their SQL twins."""

import datetime as dt

import pytest

from __spark_entry__ import oracle_sql, queries

#: Findings F3, F5 to F17, F19, F22 and F24 of round 3.
REPORTS = ("closest_run_per_customer", "latest_batch_snapshot", "credit_limit_first_last", "lookup_duplicate_audit",
           "matured_target_left_join", "period_membership", "period_membership_merged", "page_orders", "points_scores",
           "r10_cohort_exposure", "r12_unit_funnel", "r11_utilisation", "r13_money_funnel", "r14_points_unit_funnel",
           "r15_points_money_funnel", "r19_employee_profile", "r20_duplicate_audit")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Forty customers, keys far apart, with four orders, eight lines and three events each."""
    root, day = tmp_path_factory.mktemp("tables"), dt.datetime(1995, 1, 1)
    keys = [1 + 22_501 * i for i in range(40)]
    segments = ("BUILDING", "AUTOMOBILE", "MACHINERY", "HOUSEHOLD", "FURNITURE")
    orders = [(4 * i + j + 1, k, "FOP"[(i + j) % 3], 20_000.25 * (1 + (i + 3 * j) % 20), day + dt.timedelta((k * 7919) % 2400 + 45 * j),
               "5-LOW" if i % 4 == 0 else "1-URGENT") for i, k in enumerate(keys) for j in range(4)]
    held = {
        "customer": ([(k, i % 25, -500.0 + 270.25 * i, segments[i % 5]) for i, k in enumerate(keys)],
                     "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": ([(o[0], o[0] * 7 % 50, o[0] * 3 % 45, n, 1000.0 + o[0], 0.25, 0.5, "RAN"[o[0] % 3], "OF"[o[0] % 2], o[4] + dt.timedelta(30 * n))
                      for o in orders for n in (1, 2)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_discount double, "
                     "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        "events": ([(3 * i + j, dt.datetime(2000, 1, 1) + dt.timedelta(5 * j, 60 * i), k, ("error", "signup", "purchase")[j], 20.0 * j)
                    for i, k in enumerate(keys) for j in range(3)],
                   "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"),
        "nation": ([(n, f"N{n}") for n in range(25)], "n_nationkey int, n_name string"),
    }
    for name, (rows, schema) in held.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return str(root)


@pytest.mark.parametrize("name", REPORTS)
def test_report_asks_for_no_checkpoint_folder(spark, monkeypatch, tables, name):
    import duckdb
    from oracle_check import check

    from scorewatch import session
    from scorewatch.plans import staging

    def refuse(spark):
        raise RuntimeError("no shared folder")

    monkeypatch.setattr(session, "ensure_checkpoint_dir", refuse)
    monkeypatch.setattr(staging, "ensure_checkpoint_dir", refuse)
    duck = duckdb.connect()
    for t in ("customer", "orders", "lineitem", "events", "nation"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tables}/{t}.parquet/*.parquet')")
    assert check(spark, duck, name, queries()[name], oracle_sql()[name], tables)
