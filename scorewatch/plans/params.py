"""Report parameters.

Every date, cutoff and label a report depends on is a parameter; nothing
reads the clock. ``REFERENCE`` holds the values of the monthly run the
reference's checked-in outputs come from; ``TESTDATA`` re-targets the same
reports to the date range of the shared test tables (1995-2001).
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Params:
    run_month: str
    # Gini periods (name, first day, last day); may overlap.
    gini_periods: tuple
    # Onboarding month window of the new-user rank orders (YYYYMM, inclusive).
    new_user_months: tuple
    new_user_period_label: str
    # Snapshot month of the existing-user rank orders.
    snapshot_ym: int
    snapshot_label: str
    # Unit/money bad rates: scorecard 2.0 go-live month, resignation cutoff.
    sc2_live_ym: int
    left_job_cutoff: str
    # Credit-limit programme start (existing users = onboarded before).
    cl_launch_ym: int
    # Cohort report: quarter boundaries and the first day of "before".
    cohort_before: str
    cohorts: tuple
    cohort_rest: str
    # Utilisation trend window.
    utilisation_from: str
    as_of: str
    # Funnels: onboarding window [from, to) and resignation cutoff.
    funnel_from: str
    funnel_to: str
    funnel_left_before: str
    # Points scorecard funnel: onboarding window (inclusive) and cutoff.
    points_from: str
    points_to: str
    points_left_by: str
    # Dirty-date normaliser: upper bound of a plausible date.
    max_valid_date: str
    # Headline summary: periods averaged.
    headline_periods: tuple
    # Original cut rule: first run date whose production scores set the edges.
    cut_runs_from: str
    # Onboarding window of the bad-rate pages over all onboarded customers (inclusive).
    bad_rate_from: str
    bad_rate_to: str
    dev_gini: tuple = field(default=(
        # Development-sample Gini / C-Index of the production models.
        ("New users (< 3MOB)", "OOP Repay", "v1.0 Prod", 0.30),
        ("Existing users (>= 3MOB)", "OOP Repay", "v1.0 Prod", 0.32),
        ("New users (< 3MOB)", "Attrition", "v1.0 Prod", 0.66),
        ("Existing users (>= 3MOB)", "Attrition", "v1.0 Prod", 0.64),
    ))


REFERENCE = Params(
    run_month="2026-03",
    gini_periods=(("Jul 2025", "2025-07-01", "2025-07-31"), ("Aug 2025", "2025-08-01", "2025-08-31"),
                  ("Sep 2025", "2025-09-01", "2025-09-30"), ("Jul-Sep 2025", "2025-07-01", "2025-09-30")),
    new_user_months=(202507, 202509), new_user_period_label="Jul-Sep 2025",
    snapshot_ym=202507, snapshot_label="Jul 2025",
    sc2_live_ym=202511, left_job_cutoff="2026-01-31",
    cl_launch_ym=202506,
    cohort_before="2025-01-01",
    cohorts=(("Onboarded Q1 2025", "2025-01-01", "2025-03-31"), ("Onboarded Q2 2025", "2025-04-01", "2025-06-30"),
             ("Onboarded Q3 2025", "2025-07-01", "2025-09-30"), ("Onboarded Q4 2025", "2025-10-01", "2025-12-31")),
    cohort_rest="Onboarded 2026",
    utilisation_from="2025-07-01", as_of="2026-03-25",
    funnel_from="2025-06-01", funnel_to="2026-01-01", funnel_left_before="2026-02-01",
    points_from="2025-06-01", points_to="2025-12-31", points_left_by="2026-03-01",
    max_valid_date="2026-03-23",
    headline_periods=("Jul 2025", "Aug 2025", "Sep 2025"),
    cut_runs_from="2025-10-15",
    bad_rate_from="2025-06-01", bad_rate_to="2025-12-31",
)

TESTDATA = Params(
    run_month="2026-03",
    gini_periods=(("1996", "1996-01-01", "1996-12-31"), ("1997", "1997-01-01", "1997-12-31"),
                  ("1996-1997", "1996-01-01", "1997-12-31"), ("2010", "2010-01-01", "2010-12-31")),
    new_user_months=(199601, 199712), new_user_period_label="1996-1997",
    snapshot_ym=199707, snapshot_label="Jul 1997",
    sc2_live_ym=199901, left_job_cutoff="2000-12-31",
    cl_launch_ym=199806,
    cohort_before="1996-01-01",
    cohorts=(("Onboarded 1996", "1996-01-01", "1996-12-31"), ("Onboarded 1997", "1997-01-01", "1997-12-31"),
             ("Onboarded 1998", "1998-01-01", "1998-12-31"), ("Onboarded 1999", "1999-01-01", "1999-12-31")),
    cohort_rest="Onboarded 2000+",
    utilisation_from="1996-07-01", as_of="2001-06-30",
    funnel_from="1996-01-01", funnel_to="1999-01-01", funnel_left_before="2000-02-01",
    points_from="2022-06-01", points_to="2023-12-31", points_left_by="2001-03-01",
    max_valid_date="2001-06-30",
    headline_periods=("1996", "1997"),
    cut_runs_from="1998-01-15",
    bad_rate_from="1996-06-01", bad_rate_to="1999-12-31",
)
