"""Small helpers for literal fixtures."""

import datetime as dt


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def rows(df, *order):
    """Collected rows as dicts, sorted by some columns."""
    out = [r.asDict(recursive=True) for r in df.collect()]
    return sorted(out, key=lambda r: [(r[c] is None, r[c]) for c in order]) if order else out


def one(df):
    found = rows(df)
    assert len(found) == 1
    return found[0]
