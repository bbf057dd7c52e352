"""All check statements by query name."""

from __future__ import annotations

from oracles import dashboard, features, models, quality, reports, streams


def oracle_sql() -> dict[str, str]:
    return {**reports.STATEMENTS, **dashboard.STATEMENTS, **features.STATEMENTS,
            **quality.STATEMENTS, **models.STATEMENTS,
            **streams.STATEMENTS}
