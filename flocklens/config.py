"""Run parameters.

"Now" is never read from the wall clock inside an operator: every job takes an
explicit ``as_of`` date so that a rebuild is deterministic.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values that must equal the modelled warehouse for identical results.
# ---------------------------------------------------------------------------
WORSHIP_TYPE = "Worship Service"
SECOND_SERVICE_TIME = "11:30 AM"
IN_PERSON = "In-Person"
ONLINE = "Online"
NOT_APPLICABLE = "Not Applicable"
HIGH, MEDIUM, LOW = "High", "Medium", "Low"
MEMBER_ROLES = ("Homer", "Elder", "Ecclesia", "Deacon")
PLACEHOLDER_EMAILS = ("info requested", "", "n/a", "none")
IN_PERSON_STATUSES = ("Attended", "Attendeed")
ONLINE_STATUSES = ("Attended Online", "Attended (Online)", "Attended  (Online)")
BUCKET_LABELS = (
    "a. Months 0 - 3",
    "b. Months 4 - 6",
    "c. Months 7 - 12",
    "d. Months 13 - 24",
    "e. Months 25+",
)
BUCKET_EDGES = (3, 6, 12, 24)  # upper bound of each bucket, in periods
SPINE_START = _dt.date(2020, 1, 1)
SPINE_DAYS = 18251  # 2020-01-01 .. 2069-12-19
FIRST_CRM_EVENT_NAME = "Worship"
TICKET_ID_PREFIX = "eb_"
TICKET_SOURCE = "Eventbrite"  # value of event_source in the ticketing staging model
# event classifier: (substring of the lowered name, type), first match wins
EVENT_CLASSES = (
    (("worship",), "Worship Service"),
    (("prayer",), "Prayer"),
    (("bible", "study"), "Bible Study"),
)
DEFAULT_EVENT_CLASS = "Event"
# risk rules
RECENT_PERIODS = 3
BASELINE_PERIODS = 6
ELIGIBLE_FLOOR = 0.20
# name-similarity confidence thresholds
SIMILARITY_MEDIUM = 0.6
SIMILARITY_LOW = 0.4


@dataclass(frozen=True)
class Settings:
    """Parameters of one build.

    ``risk_period_days`` is the length of one "month" in the attendance-rate
    windows (recent = up to 3 periods back, baseline = 3 to 6 periods back);
    ``bucket_period_days`` the same for the recency buckets of ``dim_dates``.
    Both are 30 in production.
    """

    as_of: _dt.date
    risk_period_days: int = 30
    bucket_period_days: int = 30
    member_roles: tuple = MEMBER_ROLES
    placeholder_emails: tuple = PLACEHOLDER_EMAILS
    similarity_medium: float = SIMILARITY_MEDIUM
    similarity_low: float = SIMILARITY_LOW
    # thresholds of the similarity search before the low one (results do not depend on them)
    similarity_rounds: tuple = (0.6,)
    # similarity join: rows of one side of a join key that meet in one task
    rows_per_cell: int = 2000

    @staticmethod
    def today_est() -> _dt.date:
        """Production default for ``as_of``: today's date at fixed UTC-5."""
        now = _dt.datetime.now(_dt.timezone(_dt.timedelta(hours=-5)))
        return now.date()

    @property
    def recent_days(self) -> int:
        return RECENT_PERIODS * self.risk_period_days

    @property
    def baseline_days(self) -> int:
        return BASELINE_PERIODS * self.risk_period_days


# Parameters of the driver-table fixture (see FIXTURES.md): the synthetic
# events cover 2024-01-01..30, so the windows are shrunk to days.
FIXTURE_SETTINGS = Settings(
    as_of=_dt.date(2024, 1, 31), risk_period_days=3, bucket_period_days=1
)
FIXTURE_CALENDAR_SETTINGS = Settings(as_of=_dt.date(2024, 1, 31))
