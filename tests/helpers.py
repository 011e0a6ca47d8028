"""What the tests share. It is no part of ``conftest``, a name that every folder of tests has."""

from __future__ import annotations

from datetime import datetime


def rows(df, *columns):
    """Rows as sorted tuples, so that tests compare content and not order."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)
