"""DuckDB SQL for every registered query, written apart from the operators.

Each text is ``WITH <canonical tables>, <steps> <final SELECT>``; a query names the steps it
builds on.
"""

from __future__ import annotations

from oracles.steps import CANONICAL, FINAL, STEPS


def _needed(names: list[str], seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _needed(STEPS[name][0], seen)
            seen.append(name)
    return seen


def _compose(steps: list[str], select: str) -> str:
    parts = [CANONICAL, *(f"{name} AS ({STEPS[name][1]})" for name in _needed(steps, []))]
    return "WITH " + ",\n".join(part.strip() for part in parts) + "\n" + select.strip()


ORACLE_SQL: dict[str, str] = {
    query: _compose(steps, select) for query, (steps, select) in FINAL.items()
}


def _each_day(name: str) -> str:
    """The query of one day for every day of the range, one below the other."""
    days = [f"2024-01-{day:02d}" for day in range(2, 32)]
    return "\nUNION ALL\n".join(
        f"SELECT DATE '{day}' AS report_date, * FROM ({ORACLE_SQL[name].replace('2024-01-04', day)})" for day in days
    )


ORACLE_SQL |= {
    f"{name}_range": _each_day(name)
    for name in ("top_spenders", "returning_payers", "top_box_openers", "box_mix", "observations")
}
