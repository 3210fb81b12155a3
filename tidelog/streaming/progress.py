"""Positions of a stream: what was received, what the sink has taken, what the source was told."""

from __future__ import annotations

import time
from collections.abc import Callable


class Regressed(ValueError):
    """A position that lies before one already processed."""


class Progress:
    """received and server_end follow the frames, processed the sink; confirmed follows processed, by a timer or on demand."""

    def __init__(self, start: int = 0, interval: float = 10.0, send: Callable[[int], None] = lambda _: None, clock: Callable[[], float] = time.monotonic):
        self.received, self.server_end, self.processed, self.confirmed = 0, 0, start, start
        self.interval, self._send, self._clock = interval, send, clock
        self._next = clock() + interval

    def saw(self, received: int | None, server_end: int | None) -> None:
        self.received, self.server_end = received or self.received, max(server_end or 0, self.server_end)

    def advance(self, lsn: int) -> None:
        """The sink has taken all up to lsn; the same position again is fine."""
        if lsn < self.processed:
            raise Regressed(f"position {lsn} lies before {self.processed}")
        self.processed = lsn

    def due(self) -> bool:
        return self._clock() >= self._next

    def confirm(self) -> None:
        """Tells the source what was processed; what was only received isn't confirmed."""
        self._send(self.processed)
        self.confirmed, self._next = self.processed, self._clock() + self.interval
