"""Rows with odd values and a comparable form of results."""

from __future__ import annotations

ODD = [(1, None), (2, ""), (3, " \t\n"), (None, "no id here at all"), (4, "twice the same row"), (4, "twice the same row"), (5, "é 日本 😀 \0 end")]


def by_id(frame, *columns):
    rows = [tuple(r) for r in frame.select(*columns).collect()]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))
