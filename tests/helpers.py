"""Small helpers shared by the tests."""

from collections import Counter
from datetime import datetime


def bag(df, *cols):
    """Rows as a multiset of plain tuples."""
    rows = df.select(*cols).collect() if cols else df.collect()
    return Counter(tuple(r) for r in rows)


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def executed_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
