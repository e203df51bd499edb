"""One monthly run: every report page, written one directory per page.

    python -m scorewatch.plans.monthly <data_dir> <out_dir> [reference|testdata]

``data_dir`` holds the shared test tables; the logical monitoring tables are
derived from them by ``sources.adapters``. Resignation dates are resolved
first (R17), published as a dated snapshot (A9) and feed every outcome
report. Each page is its own Spark job reading the tables in full; nothing is
collected to the driver. Run again with the same ``out_dir``, a stopped run
goes on with its unfinished pages (``plans.runs``); a new month takes a new one.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame

from ..functions.bands import ATTRITION_ORDER, SEGMENTS
from ..operators.rank_order import with_all_labels
from ..session import build_session
from ..sources import snapshots
from ..sources.adapters import Logical
from ..sources.tables import TableSet
from . import funnels as fn
from . import lineage as ln
from . import portfolio as pf
from .params import REFERENCE, TESTDATA, Params
from .performance import Monitoring
from .runs import Masters, Page, run_pages
from .staging import drop_staged, stage


class Wired:
    """Logical tables with the resignation dates replaced by the resolved ones (R17 feeds the reports)."""

    def __init__(self, tables, resolved: DataFrame):
        self.tables, self.resolved = tables, resolved

    def __getitem__(self, name: str) -> DataFrame:
        return self.resolved if name == "resignation" else self.tables[name]


def wired(lg, p: Params, run_key=(), event_key=(), loan_order=("ee_onboarding_date", "ln_loan_id")) -> Monitoring:
    """Master frames whose outcomes use the resignation dates resolved from HR, freeze and repayment records."""
    resolved = ln.resolve_resignation(lg["features"], lg["repayments"], p, tie_break=event_key, loan_order=loan_order)
    return Monitoring(Wired(lg, stage(resolved, "resolved")), p, tie_break=run_key)


# G1: report order of the pages.
PAGE_ORDER = {
    "page02_model_performance_gini_cindex": ["Model", "ModelVersion", "UserType", "Start_Date", "Period"],
    "page03_oop_rank_order_new_users": ["ModelVersion", "Segment_Order"],
    "page04_oop_rank_order_existing_users": ["ModelVersion", "Segment_Order"],
    "page05_attrition_rank_order_new_users": ["ModelVersion", "Segment_Order"],
    "page06_attrition_rank_order_existing_users": ["ModelVersion", "Segment_Order"],
    "page07_unit_bad_rate_mom": ["Scorecard", "OnboardingMonth"],
    "page08_peso_bad_rate_mom": ["Scorecard", "OnboardingMonth"],
    "page09_cl_plus_exposure": ["CLCategory"],
    "page10_new_borrower_exposure": ["TableType", "CohortOrder", "UserType"],      # G3: earliest onboarding first
    "page07_unit_bad_rate_onboarded": ["Scorecard", "OnboardingMonth"],
    "page08_peso_bad_rate_onboarded": ["Scorecard", "OnboardingMonth"],
    "page09_cl_change_exposure": ["CLCategory"],
    "page01_headline": ["UserType", "Model", "ModelVersion"],
    "segment_cutoffs": ["segment"],
    "segment_cutoffs_existing": ["segment"],
    "page11_utilization_trend": ["ReportMonth"],
}


# Customer- or event-level outputs: written in parallel, not as a single page file.
LARGE_OUTPUTS = frozenset({"resignation_resolution", "repayment_duplicates", "balance_ledger", "employee_profile",
                           "tag_date_disagreement"})


def monthly_plan(spark, lg, p: Params, run_key=(), event_key=(), loan_order=("ee_onboarding_date", "ln_loan_id"),
                 only: set[str] | None = None) -> tuple[list[Page], Masters]:
    """Pages of the run and the masters they share, for ``runs.run_pages``; ``only`` names the pages wanted (all by default)."""
    memo: list[tuple[DataFrame, Monitoring]] = []

    def monitor(held) -> Monitoring:
        """The master frames over the resolved dates at hand, one for as long as these are held."""
        if not memo or memo[0][0] is not held["resolved"]:
            memo[:] = [(held["resolved"], Monitoring(Wired(lg, held["resolved"]), p, tie_break=run_key))]
        return memo[0][1]

    masters = Masters(spark, {
        "resolved": ((), lambda m: ln.resolve_resignation(lg["features"], lg["repayments"], p, tie_break=event_key, loan_order=loan_order)),
        "outcomes": (("resolved",), lambda m: pf.outcome_base(monitor(m).oop_new, m["resolved"], p)),
        "scores": ((), lambda m: pf.scorecard_master(lg["scores_api"], lg["onboarding"], run_key)),
        "onboarded": (("scores", "resolved"), lambda m: pf.onboarded_base(
            m["scores"], m["resolved"], lg["backscore_oop_new"], lg["targets"], p, run_key)),
        "profile": ((), lambda m: fn.employee_profile(lg["users"], lg["income_info"], lg["user_timelines"], lg["employers"],
                                                      lg["user_tag"], lg["credit_info"])),
        "cohort": ((), lambda m: fn.onboarding_cohort(lg["scores_api"], lg["user_timelines"], p, run_key)),
        "points": ((), lambda m: fn.points_cohort(lg["payment_responses"], lg["users"], lg["income_info"], lg["user_timelines"], p)),
        "performance": (("resolved",), lambda m: monitor(m).model_performance()),
    })
    repay, attrition = ["RiskGroup", SEGMENTS], ["AttritionGroup", list(ATTRITION_ORDER)]
    full = lambda page, labels: with_all_labels(page, labels[0], labels[1], keys=["ModelVersion"])  # noqa: E731  G4
    pages = {
        "page01_headline": (("resolved", "performance"), lambda m: monitor(m).headline(m["performance"])),
        "page02_model_performance_gini_cindex": (("performance",), lambda m: m["performance"]),
        "page03_oop_rank_order_new_users": (("resolved",), lambda m: full(monitor(m).repay_rank_order_new(), repay)),
        "page04_oop_rank_order_existing_users": (("resolved",), lambda m: full(monitor(m).repay_rank_order_existing(), repay)),
        "page05_attrition_rank_order_new_users": (("resolved",), lambda m: full(monitor(m).attrition_rank_order_new(), attrition)),
        "page06_attrition_rank_order_existing_users": (("resolved",), lambda m: full(monitor(m).attrition_rank_order_existing(), attrition)),
        "page07_unit_bad_rate_mom": (("outcomes",), lambda m: pf.unit_bad_rate(m["outcomes"], p.run_month)),
        "page08_peso_bad_rate_mom": (("outcomes",), lambda m: pf.peso_bad_rate(m["outcomes"], p.run_month)),
        "page07_unit_bad_rate_onboarded": (("onboarded",), lambda m: pf.onboarded_unit_bad_rate(m["onboarded"], p.run_month)),
        "page08_peso_bad_rate_onboarded": (("onboarded",), lambda m: pf.onboarded_peso_bad_rate(m["onboarded"], p.run_month)),
        "page09_cl_plus_exposure": (("scores",), lambda m: pf.cl_exposure(m["scores"], p, run_key)),
        "page09_cl_change_exposure": ((), lambda m: pf.cl_change_exposure(lg["cl_changes"], p)),
        "page10_new_borrower_exposure": (("scores",), lambda m: pf.cohort_exposure(m["scores"], lg["cl_summary"], p, run_key)),
        "page11_utilization_trend": ((), lambda m: pf.utilisation(lg["portfolio_snapshot"], p)),
        "weighted_gini_grid": (("resolved",), lambda m: monitor(m).weighted_gini_grid()),
        "segment_cutoffs": (("resolved",), lambda m: monitor(m).segment_cutoffs()),
        "segment_cutoffs_existing": (("resolved",), lambda m: monitor(m).segment_cutoffs(existing=True)),
        "unit_funnel": (("cohort",), lambda m: fn.unit_funnel(m["cohort"], lg["targets"], p)),
        "money_funnel": (("cohort", "profile"), lambda m: fn.money_funnel(m["cohort"], m["profile"], lg["targets"], lg["backscore_oop_new"], p)),
        "points_unit_funnel": (("points",), lambda m: fn.points_unit_funnel(m["points"], lg["targets"], p)),
        "points_money_funnel": (("points",), lambda m: fn.points_money_funnel(
            m["points"], lg["credit_info"], lg["targets"], lg["backscore_oop_new"], p)),
        "resignation_resolution": (("resolved",), lambda m: m["resolved"]),
        "balance_ledger": ((), lambda m: ln.balance_ledger(lg["repayments"], lg["features"], tie_break=event_key)),
        "employee_profile": (("profile",), lambda m: m["profile"]),
        "tag_date_disagreement": (("resolved",), lambda m: ln.tag_date_disagreement(lg["user_tag"], m["resolved"])),
        "date_quality": ((), lambda m: ln.date_quality(ln.customer_dates(ln.employer_loans(lg["features"]), p, loan_order))),
        "repayment_duplicates": ((), lambda m: ln.repayment_duplicates(lg["repayments"])),
    }
    return [Page(name, build, needs, tuple(PAGE_ORDER.get(name, ())), name in LARGE_OUTPUTS)
            for name, (needs, build) in pages.items() if only is None or name in only], masters


def publish_resolved(spark, entries: dict[str, dict], out_dir: str, p: Params) -> None:
    """The resolved dates of a finished run as the snapshot of its date."""
    dates = spark.read.parquet(entries["resignation_resolution"]["path"]).select("ee_customer_id", "ee_resignation_date_correct")
    snapshots.publish(dates, f"{out_dir}/snapshots/resignation", p.as_of)


def main(argv) -> None:
    data_dir, out_dir = argv[1], argv[2]
    p = REFERENCE if len(argv) > 3 and argv[3] == "reference" else TESTDATA
    spark = build_session()
    lg = Logical(spark, TableSet(spark, data_dir))
    pages, masters = monthly_plan(spark, lg, p, run_key=("run_key",), event_key=("part_key", "supp_key"), loan_order=("ln_seq",))
    entries = run_pages(spark, pages, masters, out_dir)
    publish_resolved(spark, entries, out_dir, p)
    for name, entry in entries.items():
        print(name, entry["rows"], entry["path"])
    drop_staged(spark)


if __name__ == "__main__":
    main(sys.argv)
