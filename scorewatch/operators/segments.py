"""Cut points from observed segment ranges (E18), binning (B26), cutoff table.

Given scores labelled with production segments A..F (A best, highest
score), re-derive the bin edges and cut another score into the same
segments:

1. min and max score per segment, reindexed to A..F, clamped to [0, 1];
2. missing segments filled by linear interpolation by position, the ends
   with the nearest known value;
3. cut(h/l) = (min(h) + max(l)) / 2 for A/B .. E/F, then a running minimum
   in that order;
4. bins are left-closed: [0, EF) -> F, ..., [AB, nextafter(1)) -> A; a score
   outside [0, 1] or null gets no segment. Equal cuts leave a bin empty.

The per-segment aggregate has at most six rows per group; everything after
it is column arithmetic on a single row, applied back as a scalar subquery.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bands import SEGMENTS
from ..functions.core import clamp01, valid_number

TOP_EDGE = math.nextafter(1.0, 2.0)
CUT_NAMES = ["AB", "BC", "CD", "DE", "EF"]


def _filled(value: str, pos: str, w_all) -> Column:
    """Linear interpolation by position; ends take the nearest value."""
    known_pos = F.when(F.col(value).isNotNull(), F.col(pos))
    before = w_all.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = w_all.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    pv, pp = F.last(value, True).over(before), F.last(known_pos, True).over(before)
    nv, np_ = F.first(value, True).over(after), F.first(known_pos, True).over(after)
    interp = pv + (nv - pv) * (F.col(pos) - pp) / (np_ - pp)
    return (F.when(F.col(value).isNotNull(), F.col(value))
            .when(pv.isNotNull() & nv.isNotNull(), interp)
            .otherwise(F.coalesce(pv, nv)))


def segment_ranges(df: DataFrame, score: str, segment: str) -> DataFrame:
    """Six rows (segment, pos, min, max) with steps 1-2 applied."""
    spark = df.sparkSession
    # Only the six letters matter, so the aggregate is at most six rows.
    valid = df.where(F.col(segment).cast("string").isin(SEGMENTS) & valid_number(score))
    agg = valid.groupBy(F.col(segment).cast("string").alias("segment")).agg(
        F.min(score).alias("mn"), F.max(score).alias("mx"))
    letters = spark.createDataFrame([(s, i + 1) for i, s in enumerate(SEGMENTS)], "segment string, pos int")
    six = letters.join(F.broadcast(agg), "segment", "left") \
        .select("segment", "pos", clamp01("mn").alias("mn"), clamp01("mx").alias("mx")) \
        .withColumn("_g", F.lit(0))
    w_all = Window.partitionBy("_g").orderBy("pos")
    return six.select("segment", "pos", _filled("mn", "pos", w_all).alias("min_score"),
                      _filled("mx", "pos", w_all).alias("max_score"))


def derive_cuts(df: DataFrame, score: str, segment: str) -> DataFrame:
    """One row: AB, BC, CD, DE, EF cut points after the running minimum."""
    six = segment_ranges(df, score, segment)
    wide = six.agg(*[F.max(F.when(F.col("segment") == s, F.col("min_score"))).alias(f"{s}_min") for s in SEGMENTS],
                   *[F.max(F.when(F.col("segment") == s, F.col("max_score"))).alias(f"{s}_max") for s in SEGMENTS])
    raw = [(F.col(f"{h}_min") + F.col(f"{l}_max")) / 2 for h, l in zip(SEGMENTS[:-1], SEGMENTS[1:])]
    running, cols = None, []
    for name, c in zip(CUT_NAMES, raw):
        running = c if running is None else F.least(running, c)
        cols.append(running.alias(name))
    return wide.select(*cols)


def assign_segment(score: Column, cuts: dict[str, Column]) -> Column:
    """Left-closed bins [0, EF) F ... [AB, nextafter(1)) A."""
    s = score
    out = F.when(s.isNull() | F.isnan(s) | (s < 0) | (s >= F.lit(TOP_EDGE)), F.lit(None).cast("string"))
    for label, edge in zip(["F", "E", "D", "C", "B"], ["EF", "DE", "CD", "BC", "AB"]):
        out = out.when(s < cuts[edge], F.lit(label))
    return out.otherwise(F.lit("A"))


def with_derived_segment(df: DataFrame, score: str, segment: str, out: str,
                         edge_score: str | None = None, edge_filter: Column | None = None) -> DataFrame:
    """Label ``score`` with segments whose edges come from ``edge_score``
    (default: ``score``) grouped by ``segment`` on the rows of ``edge_filter``.

    The one-row cut frame enters the plan once, as a single scalar subquery
    bound to a struct column, and is evaluated once per query.
    """
    source = df if edge_filter is None else df.where(edge_filter)
    cuts = derive_cuts(source, edge_score or score, segment)
    packed = cuts.select(F.struct(*CUT_NAMES).alias("c")).scalar()
    with_cuts = df.withColumn("_cuts", packed)
    edges = {n: F.col("_cuts")[n] for n in CUT_NAMES}
    return with_cuts.withColumn(out, assign_segment(F.col(score), edges)).drop("_cuts")


def cutoff_table(cuts: DataFrame) -> DataFrame:
    """Segment, min_inclusive, max_exclusive (A's upper edge shown as 1.0)."""
    bounds = [("A", "AB", None), ("B", "BC", "AB"), ("C", "CD", "BC"),
              ("D", "DE", "CD"), ("E", "EF", "DE"), ("F", None, "EF")]
    rows = [F.struct(F.lit(seg).alias("segment"),
                     (F.col(lo) if lo else F.lit(0.0)).alias("min_inclusive"),
                     (F.col(hi) if hi else F.lit(1.0)).alias("max_exclusive"))
            for seg, lo, hi in bounds]
    return cuts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
