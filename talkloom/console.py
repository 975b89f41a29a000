"""What the job says while it runs: log lines with the step's tag."""

from __future__ import annotations

import logging
import time
from collections.abc import Iterator
from contextlib import contextmanager

log = logging.getLogger("talkloom")


def say(tag: str, message: str) -> None:
    log.info("[%s] %s", tag, message)


@contextmanager
def step(tag: str) -> Iterator[None]:
    """A step's beginning, and its end with the seconds that it took or with the error that ended it."""
    began = time.perf_counter()
    say(tag, "begins")
    try:
        yield
    except BaseException as e:
        log.error("[%s] failed after %.1f s: %s", tag, time.perf_counter() - began, type(e).__name__)
        raise
    say(tag, f"done in {time.perf_counter() - began:.1f} s")


def progress(tag: str, done: int, of: int) -> None:
    say(tag, f"{done} of {of}")
