"""Parameters of a report run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timezone

from arrears.functions.dates import balance_date_of

FRAUD_MODES = ("exclude", "only")

# The loan statuses that close a loan.
CLOSED_STATUSES = ("Written Off", "Completed", "Settled")


@dataclass(frozen=True)
class ReportConfig:
    """What a report measures.

    ``run_date`` is the day the job runs (default: today, UTC, read once when
    the config is made, so that a run past midnight keeps its month) and
    ``months_back`` the month offsets to report, one row each.
    ``fraud_mode`` says whether the fraud segment leaves the listed loans out
    or takes them alone. ``strict_loan_numbers`` makes a loan number that is
    not an integer an error when it is looked up in the fraud list; otherwise
    such a loan counts as not listed.
    """

    run_date: date | None = None
    months_back: tuple[int, ...] = (0,)
    cohort_year: int = 2022
    dpd_threshold: int = 90
    closed_statuses: tuple[str, ...] = CLOSED_STATUSES
    fraud_mode: str = "exclude"
    strict_loan_numbers: bool = True

    def __post_init__(self) -> None:
        if self.run_date is None:
            object.__setattr__(self, "run_date", today())
        if self.fraud_mode not in FRAUD_MODES:
            raise ValueError(f"fraud_mode must be one of {FRAUD_MODES}, got {self.fraud_mode!r}")
        if not self.months_back:
            raise ValueError("months_back needs at least one offset")

    @property
    def balance_dates(self) -> list[date]:
        """The distinct as-of dates, oldest first."""
        return sorted({balance_date_of(self.run_date, k) for k in self.months_back})


def today() -> date:
    return datetime.now(timezone.utc).date()
