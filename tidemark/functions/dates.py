"""Plain dates: weekdays around a date, and training windows of whole blocks."""

from __future__ import annotations

import datetime as dt

DAY = dt.timedelta(days=1)


def sunday_before(day: dt.date) -> dt.date:
    """The last Sunday that is not after the day."""
    return day - day.isoweekday() % 7 * DAY


def sunday_after(day: dt.date) -> dt.date:
    """The first Sunday that is not before the day."""
    return day + -day.isoweekday() % 7 * DAY


def monday_after(day: dt.date) -> dt.date:
    """The first Monday that is not before the day."""
    return day + (1 - day.isoweekday()) % 7 * DAY


def train_window(first: dt.date, last: dt.date, block: int = 28) -> tuple[dt.date, dt.date]:
    """First and last day of the whole blocks from the first Monday on; up to `last` if there is no whole block."""
    if block <= 0:
        raise ValueError("a block has at least a day")
    start = monday_after(first)
    blocks = ((last - start).days + 1) // block
    return (start, start + (blocks * block - 1) * DAY) if blocks >= 1 else (start, last)


def block_start(first_monday: dt.date, wanted: dt.date, block: int = 28) -> dt.date:
    """The first start of a block, counted from a Monday, that is not before the wanted day's Monday."""
    blocks = -(-max(0, (monday_after(wanted) - first_monday).days) // block)
    return first_monday + blocks * block * DAY
