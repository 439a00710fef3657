"""Audit ranges: `MM-DD-YYYY` for whole days, `MM-DD-YYYY HH:MM` for minutes. All UTC."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

_DAY = re.compile(r"\d{2}-\d{2}-\d{4}")
_MINUTE = re.compile(r"\d{2}-\d{2}-\d{4} \d{2}:\d{2}")
_LOG_PATH = re.compile(r"\d{2}-\d{2}-\d{4}(/\d{2}(/\d{2})?)?")


@dataclass(frozen=True)
class AuditRange:
    first_day: date
    last_day: date
    # Inclusive commit-time bounds; None when whole days are meant.
    first_ms: int | None = None
    last_ms: int | None = None

    @property
    def days(self) -> list[str]:
        """Log folders of the range."""
        count = (self.last_day - self.first_day).days + 1
        return [f"{self.first_day + timedelta(n):%m-%d-%Y}" for n in range(max(count, 0))]

    @property
    def folders(self) -> list[str]:
        """Log folders of the range: hours for minutes, else days."""
        if self.first_ms is None:
            return self.days
        first = self.first_ms // 3_600_000
        hours = range(first, self.last_ms // 3_600_000 + 1)
        return [f"{datetime.fromtimestamp(hour * 3600, timezone.utc):%m-%d-%Y/%H}" for hour in hours]


def parse_range(start: str, end: str) -> AuditRange:
    """Both ends inclusive; an end minute counts whole."""
    if _DAY.fullmatch(start) and _DAY.fullmatch(end):
        first, last = (datetime.strptime(text, "%m-%d-%Y").date() for text in (start, end))
        return AuditRange(first, last)
    if _MINUTE.fullmatch(start) and _MINUTE.fullmatch(end):
        first, last = (
            datetime.strptime(text, "%m-%d-%Y %H:%M").replace(tzinfo=timezone.utc) for text in (start, end)
        )
        last_ms = (int(last.timestamp()) + 60) * 1000 - 1
        return AuditRange(first.date(), last.date(), int(first.timestamp()) * 1000, last_ms)
    raise ValueError(
        f"range {start!r} to {end!r}: give both ends as MM-DD-YYYY or both as MM-DD-YYYY HH:MM"
    )


def parse_paths(paths: list[str]) -> list[str]:
    """Log folders `MM-DD-YYYY[/HH[/mm]]`, without trailing slashes."""
    cleaned = [path.strip("/") for path in paths]
    if not cleaned:
        raise ValueError("give at least one path")
    for path in cleaned:
        if not _LOG_PATH.fullmatch(path):
            raise ValueError(f"path {path!r}: expected MM-DD-YYYY, MM-DD-YYYY/HH or MM-DD-YYYY/HH/mm")
    return cleaned
