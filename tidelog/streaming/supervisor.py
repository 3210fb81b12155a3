"""Keeping a stream alive: delays between attempts, readiness, and the loop around both."""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger("tidelog.supervisor")


@dataclass(frozen=True)
class Retry:
    """initial doubles with each attempt up to most; attempts 0: for ever. Seconds."""

    initial: float = 1.0
    most: float = 30.0
    attempts: int = 0

    def __post_init__(self) -> None:
        if self.initial <= 0 or self.most < self.initial or self.attempts < 0:
            raise ValueError("delays must be positive, the longest not below the first, attempts not negative")

    def delay(self, attempt: int) -> float:
        return min(self.initial * 2.0 ** min(attempt - 1, 62), self.most)


def schedule(spark: SparkSession, retry: Retry, attempts: int) -> DataFrame:
    """attempt and delay in milliseconds of the first attempts."""
    ms = F.least(retry.initial * 1000 * F.pow(F.lit(2.0), F.least(F.col("id") - 1, F.lit(62))), F.lit(retry.most * 1000))
    return spark.range(1, attempts + 1).select(F.col("id").alias("attempt"), ms.cast("long").alias("delay_ms"))


class Readiness:
    """Whether the stream runs, and the last error if not."""

    def __init__(self) -> None:
        self._lock, self._ready, self._error = threading.Lock(), False, ""

    def set_ready(self) -> None:
        with self._lock:
            self._ready, self._error = True, ""

    def set_not_ready(self, error: object = None) -> None:
        with self._lock:
            self._ready, self._error = False, str(error) if error is not None else self._error

    def snapshot(self) -> tuple[bool, str]:
        with self._lock:
            return self._ready, self._error


def serve(ready: Readiness, metrics: Callable[[], str], prometheus: Callable[[], str], address: str = "127.0.0.1:0"):
    """An HTTP server thread: /livez, /readyz, /metrics (JSON), /metrics/prometheus. Returns the server.

    address: host:port; without a host, all addresses of this machine.
    """
    from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self) -> None:  # noqa: N802
            ok, error = ready.snapshot()
            status, body, kind = {
                "/livez": lambda: (200, "ok", "text/plain"),
                "/readyz": lambda: (200, "ready", "text/plain") if ok else (503, f"not ready: {error}", "text/plain"),
                "/metrics": lambda: (200, metrics(), "application/json"),
                "/metrics/prometheus": lambda: (200, prometheus(), "text/plain; version=0.0.4"),
            }.get(self.path, lambda: (404, "not found", "text/plain"))()
            self.send_response(status)
            self.send_header("Content-Type", kind)
            self.end_headers()
            self.wfile.write(body.encode())

        def log_message(self, *_: object) -> None:
            pass

    server = ThreadingHTTPServer((address.rpartition(":")[0], int(address.rpartition(":")[2])), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    return server


def supervise(start: Callable[[], object], retry: Retry, ready: Readiness, sleep: Callable[[float], None] = time.sleep, reconnected: Callable[[], None] = lambda: None) -> int:
    """Starts the stream (an object with awaitTermination) again after each failure; attempts it took.

    start opens what it needs anew, so nothing that an attempt knew of the destination outlives it; reconnected is called
    before each new attempt. The count of attempts isn't reset by a success. Raises the last error when attempts run out.
    """
    attempt = 0
    while True:
        try:
            query = start()
            ready.set_ready()
            query.awaitTermination()
            return attempt
        except Exception as e:
            attempt += 1
            ready.set_not_ready(e)
            if retry.attempts and attempt >= retry.attempts:
                raise
            log.warning("event=reconnect attempt=%d delay=%.3f error=%s", attempt, retry.delay(attempt), e)
            sleep(retry.delay(attempt))
            reconnected()
