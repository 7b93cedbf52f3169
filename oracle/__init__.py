"""DuckDB oracle SQL, one text per ``queries()`` key.

Written independently of the Spark plans, directly from the extract rules, over
the same SIS-shaped views (prepended as CTEs by ``with_views``).  Runs on DuckDB
with the driver tables registered as views.
"""

from __future__ import annotations

from rollbook.sources.views import with_views

SQL: dict[str, str] = {}


def register(name: str, sql: str) -> None:
    SQL[name] = sql


def all_sql() -> dict[str, str]:
    from oracle import extracts_a, extracts_b, extracts_c, operators  # noqa: F401
    if "quality_summary_enrollment" not in SQL:
        operators._later()
        operators._render_later()
        operators._files_later()
        operators._integrity_later()
    return {k: with_views(v) for k, v in SQL.items()}
