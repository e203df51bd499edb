import math

from pyspark.sql import functions as F

from scorewatch.operators.segments import TOP_EDGE, assign_segment, cutoff_table, derive_cuts, segment_ranges


def test_interpolation_running_min_and_binning(spark):
    # D missing (interpolated), F missing at the end (nearest), C overlaps B.
    rows = [("A", 0.9), ("A", 1.2), ("B", 0.6), ("B", 0.8), ("C", 0.7), ("C", 0.75), ("E", 0.2), ("E", 0.3),
            ("X", 0.5), (None, 0.1)]
    df = spark.createDataFrame(rows, "seg string, score double")
    six = {r.segment: r for r in segment_ranges(df, "score", "seg").collect()}
    assert six["A"].max_score == 1.0                              # clamped
    assert abs(six["D"].min_score - (0.7 + 0.2) / 2) < 1e-12      # interpolated by position
    assert six["F"].min_score == 0.2 and six["F"].max_score == 0.3
    c = derive_cuts(df, "score", "seg").collect()[0]
    ab = (0.9 + 0.8) / 2
    bc = min(ab, (0.6 + 0.75) / 2)
    assert abs(c.AB - ab) < 1e-12 and abs(c.BC - bc) < 1e-12
    assert c.CD <= c.BC and c.DE <= c.CD and c.EF <= c.DE           # running minimum
    cuts = {k: F.lit(getattr(c, k)) for k in ["AB", "BC", "CD", "DE", "EF"]}
    probe = spark.createDataFrame([(0.0,), (1.0,), (c.AB,), (c.AB - 1e-9,), (-0.1,), (TOP_EDGE,), (None,)], "s double")
    out = [r.g for r in probe.select(assign_segment(F.col("s"), cuts).alias("g")).collect()]
    assert out[1] == "A" and out[2] == "A" and out[3] != "A"
    assert out[4] is None and out[5] is None and out[6] is None
    assert out[0] in ("F", "E")
    t = {r.segment: r for r in cutoff_table(derive_cuts(df, "score", "seg")).collect()}
    assert t["A"].max_exclusive == 1.0 and t["F"].min_inclusive == 0.0
    assert math.isclose(t["B"].max_exclusive, t["A"].min_inclusive)
