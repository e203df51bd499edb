"""Staging: how many tasks write a table of known size, and what the driver gives back."""

from types import SimpleNamespace

import pytest
from py4j.protocol import Py4JError

from scorewatch.plans import staging


@pytest.mark.parametrize(("rows", "files"), [(None, 6), (staging.ROWS_A_TASK - 1, 1), (2 * staging.ROWS_A_TASK, 3), (10 ** 9, 6)])
def test_a_bound_on_the_rows_bounds_the_files_and_no_row_is_lost(spark, rows, files):
    held = staging.Scope()
    with held.begin(spark):
        staged = staging.stage(spark.range(0, 600, 1, 6), "few", rows=rows)
    assert len(staged.inputFiles()) == files
    assert sorted(r["id"] for r in staged.collect()) == list(range(600))
    held.drop(spark)


def test_driver_memory_is_given_back_once_per_staged_table(spark, monkeypatch):
    asked, held = [], staging.Scope()
    monkeypatch.setattr(staging, "release_driver_memory", asked.append)
    with held.begin(spark):
        staging.stage(spark.range(3), "one")
        staging.stage(spark.range(3), "two")
    assert asked == [spark, spark]
    held.drop(spark)


def test_a_jvm_without_the_command_goes_on(spark):
    def refuse(name):
        raise Py4JError("no such command")

    jvm = SimpleNamespace(javax=SimpleNamespace(management=SimpleNamespace(ObjectName=refuse)))
    staging.release_driver_memory(SimpleNamespace(_jvm=jvm))
    staging.release_driver_memory(spark)
