"""Reports that stage nothing run under a cluster's own master, whatever checkpoint folder it names, or none."""

import pytest
from test_reports_without_staging import REPORTS, tables  # noqa: F401

from __spark_entry__ import queries


@pytest.mark.parametrize("name", REPORTS)
def test_report_runs_under_a_cluster_master(spark, monkeypatch, tables, name):  # noqa: F811
    monkeypatch.setattr(spark.sparkContext, "master", "spark://cluster:7077")
    queries()[name](spark, tables).write.format("noop").mode("overwrite").save()
