"""Model-performance and rank-order reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.core import valid_number
from ..operators.gini import explode_series, gini_by_period
from ..operators.rank_order import attrition_rank_order, month_range, repay_rank_order
from ..operators.segments import cutoff_table, derive_cuts, with_derived_segment
from . import frames as fr
from .params import Params
from .staging import stage

NEW, EXISTING = "New users (< 3MOB)", "Existing users (>= 3MOB)"
OOP, ATTR = "OOP Repay", "Attrition"
V1, V2 = "v1.0 Prod", "v2.0 BS"
METRIC_NAME = {OOP: "Gini", ATTR: "C-Index"}

# The eight series of page 2 (series id, model, version, user type).
SERIES = [("oop_v1_new", OOP, V1, NEW), ("oop_v2_new", OOP, V2, NEW), ("oop_v1_ex", OOP, V1, EXISTING), ("oop_v2_ex", OOP, V2, EXISTING),
          ("attr_v1_new", ATTR, V1, NEW), ("attr_v2_new", ATTR, V2, NEW), ("attr_v1_ex", ATTR, V1, EXISTING),
          ("attr_v2_ex", ATTR, V2, EXISTING)]


class Monitoring:
    """Master frames of one monthly run, built lazily from logical tables.

    ``tables`` maps logical names (scores_api, scores_batch, onboarding,
    targets, backscore_oop_new, backscore_oop_existing, backscore_attrition,
    resignation) to DataFrames.
    """

    def __init__(self, tables, params: Params, materialize: bool = True, tie_break: tuple[str, ...] = ()):
        self.t = tables
        self.p = params
        self.tie_break = tuple(tie_break)
        self.materialize = materialize
        self._memo: dict[str, DataFrame] = {}

    def _get(self, name, build, shared: bool = False):
        """Build a frame once per run. ``shared`` frames feed several
        branches of one report (e.g. cut points and both pivots); they are
        staged once under the checkpoint directory so their joins run once
        and a lost executor does not replay them."""
        if name not in self._memo:
            df = build()
            if shared and self.materialize:
                df = stage(df, name)
            self._memo[name] = df
        return self._memo[name]

    @property
    def api_base(self):
        return self._get("api", lambda: fr.prod_api_base(self.t["scores_api"], self.t["onboarding"], self.tie_break))

    @property
    def batch_base(self):
        return self._get("batch", lambda: fr.prod_batch_base(self.t["scores_batch"], self.t["onboarding"], self.tie_break))

    @property
    def oop_new(self):
        return self._get("oop_new", lambda: fr.oop_new_calc(self.api_base, self.t["targets"],
                                                            self.t["backscore_oop_new"], self.tie_break))

    @property
    def oop_existing(self):
        return self._get("oop_ex", lambda: fr.oop_existing_calc(
            self.batch_base, self.t["targets"], self.t["backscore_oop_new"], self.t["backscore_oop_existing"]))

    def staged(self, name: str) -> DataFrame:
        """A master frame that one report reads more than once (cut points
        and pivots), staged under the checkpoint directory."""
        return self._get(f"staged:{name}", lambda: getattr(self, name), shared=True)

    @property
    def attr_prod_new(self):
        return self._get("apn", lambda: fr.attr_prod_api_calc(self.api_base, self.t["resignation"],
                                                              self.t["backscore_attrition"], self.tie_break))

    @property
    def attr_prod_existing(self):
        return self._get("ape", lambda: fr.attr_prod_batch_calc(self.batch_base, self.t["resignation"],
                                                                self.t["backscore_attrition"]))

    @property
    def attr_bs_new(self):
        return self._get("abn", lambda: fr.attr_bs_calc(self.t["backscore_attrition"], self.t["resignation"], True))

    @property
    def attr_bs_existing(self):
        return self._get("abe", lambda: fr.attr_bs_calc(self.t["backscore_attrition"], self.t["resignation"], False))

    # ------------------------------------------------------------ page 2

    # ------------------------------------------------ stacked series, one pass per source

    def _outcome_sources(self):
        return (self._get("new_out", lambda: fr.new_user_outcomes(
                    self.api_base, self.t["targets"], self.t["backscore_oop_new"], self.t["resignation"],
                    self.t["backscore_attrition"], self.tie_break)),
                self._get("ex_out", lambda: fr.existing_user_outcomes(
                    self.batch_base, self.t["targets"], self.t["backscore_oop_new"],
                    self.t["backscore_oop_existing"], self.t["resignation"], self.t["backscore_attrition"])),
                self._get("bs_out", lambda: fr.rescored_attrition_outcomes(
                    self.t["backscore_attrition"], self.t["resignation"])))

    def repay_stack(self, carry: list[str] | None = None) -> list[DataFrame]:
        """Rows (series, cid, obs_date, score, target, *carry) of the four repay series, one pass per source."""
        new, ex, _ = self._outcome_sources()
        has_t, v2 = F.col("oop_target").isNotNull(), valid_number("score_oop")
        return [explode_series(new, [("oop_v1_new", "ee_onboarding_date", "oop_score_prod", "oop_target", has_t),
                                     ("oop_v2_new", "ee_onboarding_date", "score_oop", "oop_target", has_t & v2)], carry=carry),
                explode_series(ex, [("oop_v1_ex", "run_date", "oop_score_prod", "oop_target", has_t),
                                    ("oop_v2_ex", "run_date", "score_oop", "oop_target", has_t & v2)], carry=carry)]

    def stacked_series(self) -> DataFrame:
        """Rows of all eight page-2 series; each source frame is read once and exploded into its series."""
        new, ex, bs = self._outcome_sources()
        has_t, v2 = F.col("oop_target").isNotNull(), valid_number("score_oop")
        attr_prod, attr_bs = valid_number("attrition_score_prod"), valid_number("score_attr_corrected")
        parts = [
            explode_series(new, [("oop_v1_new", "ee_onboarding_date", "oop_score_prod", "oop_target", has_t),
                                 ("oop_v2_new", "ee_onboarding_date", "score_oop", "oop_target", has_t & v2),
                                 ("attr_v1_new", "run_date", "attrition_score_prod", "attrition_event", attr_prod)]),
            explode_series(ex, [("oop_v1_ex", "run_date", "oop_score_prod", "oop_target", has_t),
                                ("oop_v2_ex", "run_date", "score_oop", "oop_target", has_t & v2),
                                ("attr_v1_ex", "run_date", "attrition_score_prod", "attrition_event", attr_prod)]),
            explode_series(bs, [("attr_v2_new", "calc_date_correct", "score_attr_corrected", "attrition_event",
                                 attr_bs & (F.col("is_new_customer_flag_1m") == 1)),
                                ("attr_v2_ex", "calc_date_correct", "score_attr_corrected", "attrition_event",
                                 attr_bs & (F.col("is_new_customer_flag_3m") == 0))])]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])

    def model_performance(self) -> DataFrame:
        """Gini / C-Index per period for the eight series, plus fixed dev rows."""
        stacked = self.stacked_series()
        g = gini_by_period(stacked, [s[0] for s in SERIES], self.p.gini_periods)
        spark = stacked.sparkSession
        labels = spark.createDataFrame(SERIES, "series string, Model string, ModelVersion string, UserType string")
        body = g.join(F.broadcast(labels), "series").drop("series", "Weighting")
        dev = spark.createDataFrame([(u, m, v, "Dev", float(gv)) for u, m, v, gv in self.p.dev_gini],
                                    "UserType string, Model string, ModelVersion string, Period string, Gini double")
        out = body.unionByName(dev, allowMissingColumns=True)
        metric = F.when(F.col("Model") == OOP, F.lit(METRIC_NAME[OOP])).when(F.col("Model") == ATTR,
                                                                             F.lit(METRIC_NAME[ATTR]))
        return out.select("Period", "Start_Date", "End_Date", "Sample_Size", "Bad_Rate_Pct", "Gini",
                          "Model", "ModelVersion", "UserType", metric.alias("MetricName"),
                          F.lit(self.p.run_month).alias("RunMonth"))

    def weighted_gini_grid(self) -> DataFrame:
        """R2: repay Gini for {v1, v2} x {new, existing} x {unit, balance, log balance}; weights are columns."""
        weights = {"Unweighted": None, "Balance": "osbal_as_of_oop_eligible_date",
                   "LogBalance": "osbal_as_of_oop_eligible_date_log"}
        new, ex = self.repay_stack([c for c in weights.values() if c])
        repay = [s for s in SERIES if s[1] == OOP]
        g = gini_by_period(new.unionByName(ex), [s[0] for s in repay], self.p.gini_periods, weights)
        lab = new.sparkSession.createDataFrame([(sid, v, u) for sid, _, v, u in repay],
                                               "series string, ModelVersion string, UserType string")
        return g.join(F.broadcast(lab), "series").select(
            "ModelVersion", "UserType", "Weighting", "Period", "Start_Date", "End_Date",
            "Sample_Size", "Bad_Rate_Pct", "Gini")

    def headline(self, performance: DataFrame | None = None) -> DataFrame:
        """Mean Gini over the chosen periods beside the fixed dev value, in one aggregate of page 2."""
        perf = performance if performance is not None else self.model_performance()
        chosen = F.col("Period").isin(list(self.p.headline_periods))
        return (perf.groupBy("UserType", "Model", "ModelVersion")
                .agg(F.count(F.when(chosen, 1)).alias("_rows"),
                     F.bround(F.avg(F.when(chosen, F.col("Gini"))), 6).alias("Avg_Gini"),
                     F.count(F.when(chosen, F.col("Gini"))).alias("Periods_Used"),
                     F.max(F.when(F.col("Period") == "Dev", F.col("Gini"))).alias("Dev_Gini"))
                .where("_rows > 0").drop("_rows"))

    # ------------------------------------------------------------ pages 3-6

    def _new_window(self, col: str):
        lo, hi = self.p.new_user_months
        return month_range(col, lo, hi)

    def repay_rank_order_new(self) -> DataFrame:
        """v1 by production segment, v2 by segments re-derived from the production edges."""
        base = with_derived_segment(self.staged("oop_new"), "score_oop", "oop_risk_segment_prod",
                                    "oop_risk_segment_bs")
        return self._repay_versions(base.where(self._new_window("onboarding_date_ym")), self.p.new_user_period_label)

    def _repay_versions(self, base: DataFrame, period_label: str) -> DataFrame:
        """v1 (production segment) and v2 (re-derived segment, re-scored rows
        only) in one aggregate: each row is listed under both versions."""
        versions = F.array(
            F.struct(F.lit("OOP v1.0 Prod").alias("version"), F.col("oop_risk_segment_prod").alias("segment")),
            F.struct(F.lit("OOP v2.0 BS").alias("version"),
                     F.when(valid_number("score_oop"), F.col("oop_risk_segment_bs")).alias("segment")))
        both = base.withColumn("_v", F.explode(versions)).select("*", "_v.version", "_v.segment").drop("_v")
        return repay_rank_order(both, "segment", None, F.col("version"), period_label, self.p.run_month,
                                by=["version"])

    def repay_rank_order_existing(self) -> DataFrame:
        """As R3 on the existing-user snapshot month."""
        base = with_derived_segment(self.staged("oop_existing"), "score_oop", "oop_risk_segment_prod",
                                    "oop_risk_segment_bs")
        return self._repay_versions(base.where(F.col("run_date_ym") == self.p.snapshot_ym), self.p.snapshot_label)

    def attrition_rank_order_new(self) -> DataFrame:
        """Production bands vs re-scored bands, new users."""
        lab = self.p.new_user_period_label
        v1 = attrition_rank_order(self.attr_prod_new, "attrition_risk_segment_prod",
                                  self._new_window("onboarding_date_ym"), "Attrition v1.0 Prod", lab,
                                  self.p.run_month)
        v2 = attrition_rank_order(self.attr_bs_new, "score_attr_segment",
                                  self._new_window("ee_onboarding_month"), "Attrition v2.0 BS", lab,
                                  self.p.run_month)
        return v1.unionByName(v2)

    def attrition_rank_order_existing(self) -> DataFrame:
        """Snapshot month, existing users."""
        lab = self.p.snapshot_label
        v1 = attrition_rank_order(self.attr_prod_existing, "attrition_risk_segment_prod",
                                  F.col("run_date_ym") == self.p.snapshot_ym, "Attrition v1.0 Prod", lab,
                                  self.p.run_month)
        v2 = attrition_rank_order(self.attr_bs_existing, "score_attr_segment",
                                  F.col("calc_date_ym") == self.p.snapshot_ym, "Attrition v2.0 BS", lab,
                                  self.p.run_month)
        return v1.unionByName(v2)

    def segment_cutoffs(self, existing: bool = False) -> DataFrame:
        """Re-derived cut points as a segment table."""
        base = self.oop_existing if existing else self.oop_new
        return cutoff_table(derive_cuts(base, "score_oop", "oop_risk_segment_prod"))

    def production_cutoffs(self, existing: bool = False) -> DataFrame:
        """R22, original rule: edges of the production score on runs from ``cut_runs_from`` on."""
        base = self.batch_base if existing else self.api_base
        recent = base.where(F.to_date("run_date") >= F.lit(self.p.cut_runs_from).cast("date"))
        return cutoff_table(derive_cuts(recent, "oop_score_prod", "oop_risk_segment_prod"))
