"""Size bounds that decide how the library joins."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Limits:
    """What may be broadcast, and which keys count as hot.

    A frame is broadcast only after its rows and bytes were counted and both
    stay under these bounds. ``hot_share`` bounds the hot-key list: a key is
    hot when it holds more than one ``hot_share``-th of the rows, so there are
    never more than ``hot_share`` of them.
    """

    rows: int = 2_000_000
    bytes: int = 64 * 1024 * 1024
    hot_share: int = 1_000

    def allow(self, rows: int, size: int) -> bool:
        return rows <= self.rows and size <= self.bytes


DEFAULT_LIMITS = Limits()
