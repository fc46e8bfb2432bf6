"""Calendar windows against a loop over them, for last dates on and off the grid."""

import calendar
import datetime

import pytest

from orbitlake.operators import composite


def later(d, months):
    y, m = divmod(d.year * 12 + d.month - 1 + months, 12)
    return datetime.date(y, m + 1, min(d.day, calendar.monthrange(y, m + 1)[1]))


def loop(start, end, months, step, mode):
    """Starts of the windows, one after the other."""
    out, at = [], start
    while True:
        stop = later(at, months)
        if mode == "whole" and stop > end:
            return out
        out.append(at)
        if mode == "until" and stop >= end or mode == "inclusive" and stop >= later(end, months):
            return out
        at = later(at, step)


@pytest.mark.parametrize("mode", ["whole", "until", "inclusive"])
@pytest.mark.parametrize("months,step", [(6, 6), (4, 2), (3, 3), (1, 1)])
@pytest.mark.parametrize("end", ["2001-01-01", "2001-11-04", "2001-03-31", "1995-02-20"])
def test_windows_of_a_daily_series(spark, mode, months, step, end):
    last = datetime.date.fromisoformat(end)
    days = spark.sql(f"SELECT explode(sequence(DATE '1995-01-01', DATE '{end}')) AS date")
    got = {r["window_start"] for r in composite.windows(days, "1995-01-01", end, months, step, mode).select("window_start").distinct().collect()}
    # a window that begins after the last date holds no day
    assert got == {d for d in loop(datetime.date(1995, 1, 1), last, months, step, mode) if d <= last}
