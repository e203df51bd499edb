"""Gini per period (E8, E7), for many score series and weightings at once.

Input is a *stacked* frame, one row per observation::

    series (string), cid, obs_date, score (double), target (0/1), and weight columns

so every model and user type is computed in one job; weighting variants are
columns of the same rows.

Rules (reference parity):

* rows with a null target are dropped; periods match dates with both ends
  inclusive and may overlap;
* ``Sample_Size`` counts distinct customers; an empty period gives size 0
  and null metrics;
* ``Bad_Rate_Pct`` = 100 * (1 - customers with any good outcome / size),
  rounded half-even to 2;
* AUC counts rows (ties count one half, weights multiply);
  ``Gini = round(2 * AUC - 1, 4)``; one class only, or any null score or
  weight in the period, gives a null Gini.

Plan: one pass over the sources assigns elementary intervals of the periods
and aggregates to two levels, per customer and per distinct score (grouping
sets, combined map-side); this result is staged, and only it is merged into
the periods, so a row is never copied for periods that overlap. A prefix sum over distinct scores that is
split into equal-frequency score buckets gives the AUC, so a period with
very many distinct scores is not sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.core import valid_number
from ..plans.ordered import bucketed_exclusive_prefix
from ..plans.staging import stage
from .periods import assign_intervals, assign_periods

GROUP = ["series", "Period"]


def gini_by_period(stacked: DataFrame, series: list[str], periods, weights: dict[str, str] | None = None,
                   rows_per_bucket: int = 100_000, low_is_good: tuple[str, ...] = ()) -> DataFrame:
    """Return series, Period, Start_Date, End_Date, Sample_Size, Bad_Rate_Pct, Weighting, Gini.

    ``series`` lists every series id expected in the output (a period with no
    rows still yields a row); ``periods`` is [(name, start, end)]; ``weights``
    maps a weighting's name to its column in ``stacked`` (default: unit weights);
    of the series ``low_is_good`` a low score goes with target 1, so their Gini
    counts the pairs the other way round.
    """
    spark = stacked.sparkSession
    names = list(weights or {"Unweighted": None})
    w = [F.lit(1.0) if c is None else F.col(c).cast("double") for c in (weights or {"Unweighted": None}).values()]
    rows = assign_intervals(stacked.where(F.col("target").isNotNull()), "obs_date", periods)
    bad = [~valid_number("score") | ~valid_number(x) for x in w]

    aggs = [F.max("target").alias("good"), F.min("target").alias("low")]
    for i, (x, b) in enumerate(zip(w, bad, strict=True)):
        aggs += [F.sum(F.when(b, 1).otherwise(0)).alias(f"bad{i}"),
                 F.sum(F.when(~b, x * F.col("target"))).alias(f"pos{i}"),
                 F.sum(F.when(~b, x * (1 - F.col("target")))).alias(f"neg{i}")]
    split, n = ["series", "_interval"], len(w)
    levels = stage(rows.groupingSets([[*split, "cid"], [*split, "score"]], *split, "cid", "score")
                   .agg(F.grouping("cid").alias("_by_score"), *aggs), "gini-levels")

    merged = lambda level: assign_periods(levels.where(F.col("_by_score") == level), "_interval", periods)
    customers = merged(0).groupBy(*GROUP, "cid").agg(F.max("good").alias("good"), F.min("low").alias("low"),
                                                     *[F.sum(f"bad{i}").alias(f"bad{i}") for i in range(n)])
    sizes = customers.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("Sample_Size"), F.sum("good").alias("_goods"),
        ((F.max("good") == 1) & (F.min("low") == 0)).alias("_two_classes"),
        *[F.sum(f"bad{i}").alias(f"_bad{i}") for i in range(n)])
    by_score = stage(merged(1).where(valid_number("score")).groupBy(*GROUP, "score").agg(
        *[F.coalesce(F.sum(f"{k}{i}"), F.lit(0.0)).alias(f"{k}{i}") for i in range(n) for k in ("pos", "neg")]), "gini-scores")
    prefixed = bucketed_exclusive_prefix(by_score, GROUP, "score", [f"neg{i}" for i in range(len(w))], rows_per_bucket)
    auc = prefixed.groupBy(*GROUP).agg(*[a for i in range(len(w)) for a in (
        F.sum(F.col(f"pos{i}") * (F.col(f"neg{i}_before") + F.col(f"neg{i}") / 2)).alias(f"_num{i}"),
        (F.sum(f"pos{i}") * F.sum(f"neg{i}")).alias(f"_den{i}"))])

    grid = spark.createDataFrame([(s, n, st, en) for s in series for (n, st, en) in periods],
                                 "series string, Period string, Start_Date string, End_Date string") \
        .select("series", "Period", F.to_date("Start_Date").alias("Start_Date"),
                F.to_date("End_Date").alias("End_Date"))

    def gini(i):
        ok = F.col("_two_classes") & (F.col(f"_bad{i}") == 0)
        forward = 2 * F.try_divide(f"_num{i}", f"_den{i}") - 1
        return F.when(ok, F.bround(F.when(F.col("series").isin(*low_is_good), -forward).otherwise(forward) if low_is_good else forward, 4))

    each = F.explode(F.array(*[F.struct(F.lit(n).alias("Weighting"), gini(i).alias("Gini")) for i, n in enumerate(names)]))
    return (grid.join(sizes, GROUP, "left").join(auc, GROUP, "left")
            .select("series", "Period", "Start_Date", "End_Date",
                    F.coalesce(F.col("Sample_Size"), F.lit(0)).alias("Sample_Size"),
                    F.bround(100 * (1 - F.col("_goods") / F.col("Sample_Size")), 2).alias("Bad_Rate_Pct"),
                    each.alias("_e"))
            .select("*", "_e.Weighting", "_e.Gini").drop("_e"))


def explode_series(df: DataFrame, specs, cid: str = "ee_customer_id", carry: list[str] | None = None) -> DataFrame:
    """Many series from one frame in one pass.

    ``specs``: (series id, date column, score column, target column, keep
    Column). Each input row yields one row per spec whose ``keep`` holds; the
    frame is read once for all series. ``carry`` columns (weights) come along.
    """
    items = []
    for sid, date, score, target, keep in specs:
        items.append(F.struct(F.lit(sid).alias("series"), F.to_date(F.col(date)).alias("obs_date"),
                              F.col(score).cast("double").alias("score"),
                              F.col(target).cast("int").alias("target"), keep.alias("_keep")))
    picked = F.filter(F.array(*items), lambda s: s["_keep"])
    return (df.select(F.col(cid).alias("cid"), *(carry or []), F.explode(picked).alias("_s"))
            .select("_s.series", "cid", "_s.obs_date", "_s.score", "_s.target", *(carry or [])))
