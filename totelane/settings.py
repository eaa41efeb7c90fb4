"""Job arguments of one routing run."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

SINGLE = "SINGLE"
PUTAWAY = "PUTAWAY"


@dataclass(frozen=True)
class SkewSettings:
    """When a join key counts as hot, and how large a broadcast may be.

    A key is hot when it holds more than ``max(min_rows, fair_shares * rows / shuffle
    partitions)`` rows. The two ``broadcast_*`` numbers bound a lookup table that is sent to every
    executor; a larger one is joined by shuffle.
    """

    min_rows: int = 10_000
    fair_shares: float = 1.0
    broadcast_rows: int = 500_000
    broadcast_bytes: int = 64 * 1024 * 1024


@dataclass(frozen=True)
class RouterSettings:
    """``as_of`` is the run's "now"; every time rule of the run uses it."""

    as_of: datetime
    states: tuple[str, ...] = (SINGLE,)
    random_mode: str = "spread"
    skew: SkewSettings = field(default_factory=SkewSettings)

    def __post_init__(self) -> None:
        unknown = set(self.states) - {SINGLE, PUTAWAY}
        if unknown or not self.states:
            raise ValueError(f"states must be drawn from SINGLE and PUTAWAY, got {self.states}")
        if self.random_mode not in ("spread", "legacy"):
            raise ValueError(f"random_mode must be 'spread' or 'legacy', got {self.random_mode!r}")
