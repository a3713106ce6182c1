"""Helpers that work on plain Python values: flags, paging, file names, progress."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass


@dataclass(frozen=True)
class CrawlSpec:
    """Which crawls to work on: the newest ``latest``, or these ids; neither means the default."""

    latest: int | None = None
    ids: tuple[str, ...] | None = None


def parse_crawl_spec(args: list[str], flag: str = "--crawl") -> CrawlSpec:
    """From command-line arguments; the last flag wins, unknown ones are ignored."""
    out = CrawlSpec()
    for name, value in zip(args, args[1:], strict=False):
        if name != flag or not value:
            continue
        if re.fullmatch(r"\d+", value):
            out = CrawlSpec(latest=int(value))
        else:
            out = CrawlSpec(ids=tuple(x for x in (p.strip() for p in value.split(",")) if x))
    return out


def manifest_name(type: str = "", topic: str = "", lang: str = "", prefix: str = "corpus") -> str:
    """The file name of a filtered manifest; the least confidence isn't part of it."""
    return "-".join(x for x in (prefix, type, topic, lang, "manifest.txt") if x)


def page_bounds(page: str | int = 1, limit: str | int = 25, most: int = 100) -> tuple[int, int, int]:
    """(page, limit, offset) with page >= 1 and 1 <= limit <= most; no number is an error."""
    p, n = max(1, int(page)), min(most, max(1, int(limit)))
    return p, n, (p - 1) * n


def page_count(total: int, limit: int) -> int:
    return math.ceil(total / limit)


def least_confidence(value: str | float | None) -> float | None:
    """The bound to filter by, or None: only numbers above 0 filter."""
    try:
        x = float(value) if value is not None else math.nan
    except ValueError:
        return None
    return x if x > 0 else None


def duration(ms: float) -> str:
    minutes, seconds = divmod(int(ms // 1000), 60)
    return f"{minutes}m {seconds}s" if minutes else f"{seconds}s"


def progress_bar(done: int, total: int, width: int = 20) -> str:
    share = min(done / total, 1) if total > 0 else 0
    full = math.floor(share * width + 0.5)
    return "━" * full + "░" * (width - full)
