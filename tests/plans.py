"""What an adaptive query really ran."""

from __future__ import annotations


def executed_plan(df) -> list[str]:
    """Lines of the final plan, with those of its subqueries, after running it."""
    df.collect()
    lines, initial_at = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :"))
        if initial_at is not None and depth < initial_at:
            initial_at = None
        if "== Initial Plan ==" in line and initial_at is None:
            initial_at = depth
        if initial_at is None:
            lines.append(line)
    return lines
