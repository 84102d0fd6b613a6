"""Marks of a poll, of any type that orders, as JSON can hold them."""

from __future__ import annotations

import datetime as dt
import decimal
from typing import Any

_KINDS = {
    "int": (int, str, int),
    "float": (float, repr, float),
    "text": (str, str, str),
    "decimal": (decimal.Decimal, str, decimal.Decimal),
    "time": (dt.datetime, dt.datetime.isoformat, dt.datetime.fromisoformat),
    "day": (dt.date, dt.date.isoformat, dt.date.fromisoformat),
}


def packed_mark(mark: Any) -> dict[str, str]:
    """A mark as JSON can hold it, with the name of its type."""
    for kind, (type_, to_text, _) in _KINDS.items():
        if isinstance(mark, type_) and not isinstance(mark, bool):
            return {"kind": kind, "mark": to_text(mark)}
    if mark is None:
        return {"kind": "none"}
    raise TypeError(f"no mark: {mark!r}")


def unpacked_mark(packed: dict[str, str]) -> Any:
    return None if packed["kind"] == "none" else _KINDS[packed["kind"]][2](packed["mark"])
