"""Ready-made SQL templates for any lake file; {table} stands for the file."""

from __future__ import annotations

ROW_COUNT = "SELECT COUNT(*) AS total_rows FROM {table}"
COUNT_RECORDS = "SELECT COUNT(*) AS total_records FROM {table}"


def selection(n: int = 100, order: str | None = None) -> str:
    ordered = f" ORDER BY {order}" if order else ""
    return f"SELECT * FROM {{table}}{ordered} LIMIT {n}"


def group_by(column: str) -> str:
    return f"SELECT {column}, COUNT(*) AS count FROM {{table}} GROUP BY {column}"
