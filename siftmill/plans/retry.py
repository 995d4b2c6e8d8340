"""Retries of file operations that fail for a while, as on mounted object stores."""

from __future__ import annotations

import errno
import time
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from .files import LOCAL, Files

T = TypeVar("T")

#: Attempts, seconds of waiting for each attempt made, and errors that may pass.
ATTEMPTS, WAIT_S = 5, 2.0
PASSING = frozenset({errno.EIO, errno.ESTALE, errno.EAGAIN})


def retried(run: Callable[[], T], attempts: int = ATTEMPTS, wait_s: float = WAIT_S, sleep: Callable[[float], None] = time.sleep) -> T:
    """The result of run; a missing file or a passing error is tried again after a wait that grows, other errors aren't.

    After the last attempt a RuntimeError is raised from the last error.
    """
    if attempts < 1:
        raise ValueError("there must be an attempt")
    last: OSError | None = None
    for attempt in range(1, attempts + 1):
        try:
            return run()
        except OSError as e:
            if not isinstance(e, FileNotFoundError) and e.errno not in PASSING:
                raise
            last = e
            if attempt < attempts:
                sleep(wait_s * attempt)
    raise RuntimeError(f"gave up after {attempts} attempts") from last


def copied(pairs: Iterable[tuple[str, str]], files: Files = LOCAL, workers: int = 8, sleep: Callable[[float], None] = time.sleep) -> int:
    """Copies files (from, to), several at once and each with retries; how many. A target is whole or not there; the first failure is raised.

    A file goes through the driver's memory, so this is for manifests, models and structures, not for tables.
    """

    def copy(pair: tuple[str, str]) -> None:
        retried(lambda: files.write(pair[1], files.read(pair[0])), sleep=sleep)

    with ThreadPoolExecutor(workers) as pool:
        return sum(1 for _ in pool.map(copy, pairs))
