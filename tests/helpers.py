from __future__ import annotations

from datetime import date


def day(text: str | None) -> date | None:
    return date.fromisoformat(text) if text else None


def text_schema(*columns: str) -> str:
    return ", ".join(f"`{c}` string" for c in columns)


def as_dicts(df) -> list[dict]:
    return [r.asDict() for r in df.collect()]
