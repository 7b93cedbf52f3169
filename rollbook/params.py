"""Run parameters.  Every date or year an extract depends on comes from here;
no query reads the wall clock."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

# school years of the behaviour window (behaviorIncident.sql, behaviorResolution.sql)
BEHAVIOR_YEARS = 8


@dataclass(frozen=True)
class ExtractParams:
    # the day the run pretends to be "today" (replaces SYSDATE)
    as_of_date: _dt.date = _dt.date(1998, 10, 15)
    # school year asked for, by its end year; falls back to the newest year in the data
    active_end_year: int = 1999
    # optional single-school restriction (documented parameter)
    school_id: int | None = None
    # fixed windows that the scripts hard-code
    window_start: _dt.date = _dt.date(1997, 7, 1)
    window_end: _dt.date = _dt.date(1999, 7, 1)
    # one school year's start window (schedules, roster)
    year_window_start: _dt.date = _dt.date(1998, 7, 1)
    year_window_end: _dt.date = _dt.date(1999, 7, 1)
    # incidents' window (closed, inclusive), as behaviorIncident.sql states it
    incident_start: _dt.date = _dt.date(2019, 7, 1)
    incident_end: _dt.date = _dt.date(2027, 6, 30)
    # resolutions outside this window (closed, inclusive) are marked
    behavior_start: _dt.date = _dt.date(2024, 1, 3)
    behavior_end: _dt.date = _dt.date(2024, 1, 24)
    # special-education: number of end-years to include
    years_of_data: int = 3
    # transcript: the school-year end written on every transcript row
    transcript_end_year: int = 1999
    extra: dict = field(default_factory=dict)

    @classmethod
    def for_run(cls, as_of: _dt.date, end_year: int, school_id: int | None = None, **windows) -> ExtractParams:
        """Parameters of a production run: every window follows from the date and the school
        year, unless ``windows`` names another.  A school year runs from 1 July to 1 July.
        The behaviour window is as long as the scripts' own: BEHAVIOR_YEARS school years, the
        last of them ``end_year`` (2019-07-01 to 2027-06-30 for 2027); incidents have the same
        window, unless it is named apart."""
        start, end = _dt.date(end_year - 1, 7, 1), _dt.date(end_year, 7, 1)
        derived = {
            "window_start": _dt.date(end_year - 2, 7, 1), "window_end": end,
            "year_window_start": start, "year_window_end": end,
            "behavior_start": _dt.date(end_year - BEHAVIOR_YEARS, 7, 1), "behavior_end": end - _dt.timedelta(days=1),
            "transcript_end_year": end_year,
        }
        derived |= windows
        incidents = {"incident_start": derived["behavior_start"], "incident_end": derived["behavior_end"]}
        return cls(as_of_date=as_of, active_end_year=end_year, school_id=school_id, **{**incidents, **derived})

    @property
    def requested_yearid(self) -> int:
        return yearid_of(self.active_end_year)


# yearid numbering: end year of the school year minus 1990
YEARID_BASE = 1990


def yearid_of(end_year: int) -> int:
    return end_year - YEARID_BASE
