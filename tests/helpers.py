"""Helpers that the tests import by this name, which no other folder's module has."""

import datetime as dt


def day(number: int) -> dt.date:
    """The n-th day of January 2024 and on."""
    return dt.date(2024, 1, 1) + dt.timedelta(days=number - 1)


def rows(df, *order):
    """Collected rows as tuples, sorted by the given columns (default: all)."""
    collected = [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]
    return collected


def by_date(df, *columns, date="date"):
    """Rows as ``{date: tuple of columns}``; dates must be unique."""
    found = {r[date]: tuple(r[c] for c in columns) for r in df.collect()}
    assert len(found) == df.count()
    return found
