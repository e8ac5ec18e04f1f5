"""Array helpers that run inside Python workers.

A rate limit is a chain: which alert is kept decides when the next one may come. These
helpers follow that chain on sorted arrays of microsecond times.
"""

from __future__ import annotations

import numpy as np


def kept_positions(times: np.ndarray, cooldown: int, last_kept: int | None) -> list[int]:
    """Positions of the times that survive the rate limit, given the last one kept before."""
    position = 0 if last_kept is None else int(np.searchsorted(times, last_kept + cooldown, "right"))
    kept = []
    while position < len(times):
        kept.append(position)
        position = int(np.searchsorted(times, times[position] + cooldown, "right"))
    return kept


class SpanFollower:
    """How a span of the time line maps the alert before it to the last alert inside it.

    An alert before the span blocks at most the first ``cooldown`` of it, so the first alert
    inside is one of the times in that stretch or the first time after it. Each of these
    starts a chain; chains that meet go on as one. Times are fed in order, and only those that a
    chain may still step to are kept, so memory depends on how many times fall within one
    cooldown and not on the length of the span.
    """

    BLOCK = 65536

    def __init__(self, start: int, cooldown: int):
        self._cooldown = cooldown
        self._stretch_end = start + cooldown
        self._stretch_over = False
        self._first_upto = np.empty(0, np.int64)
        self._last = np.empty(0, np.int64)
        self._reachable = np.empty(0, np.int64)
        self._waiting: list[np.ndarray] = []

    def feed(self, times: np.ndarray) -> None:
        # A step costs about one pass over the chains, so it waits for as many new times.
        self._waiting.append(times)
        if sum(map(len, self._waiting)) >= max(self.BLOCK, len(self._last)):
            self._step()

    def exits(self) -> tuple[np.ndarray, np.ndarray]:
        """For each run of chains with one last alert: the latest first alert, and the last."""
        self._step()
        return self._first_upto, self._last

    def _step(self) -> None:
        times = np.concatenate([np.empty(0, np.int64), *self._waiting])
        self._waiting = []
        if not len(times):
            return
        first_upto, last = self._first_upto, self._last
        if not self._stretch_over:
            entries = int(np.searchsorted(times, self._stretch_end, "left")) + 1
            self._stretch_over = entries <= len(times)
            first_upto = np.concatenate([first_upto, times[:entries]])
            last = np.concatenate([last, times[:entries]])
        line = np.concatenate([self._reachable, times])
        while True:
            following = np.searchsorted(line, last + self._cooldown, "right")
            moves = following < len(line)
            if not moves.any():
                break
            last = np.where(moves, line[np.minimum(following, len(line) - 1)], last)
        ends_run = np.append(last[1:] != last[:-1], True)
        self._first_upto, self._last = first_upto[ends_run], last[ends_run]
        self._reachable = line[np.searchsorted(line, self._last.min(), "right") :]


class Steps:
    """How a stretch of the time line that begins at ``start`` maps the alert before it to the last alert inside it.

    Row i holds for alerts before it that end their cooldown before ``first_upto[i]`` and not before the row above; an
    alert whose cooldown outlasts all rows stays the last one. Later stretches are put behind by ``then``.
    """

    def __init__(self, start: int, cooldown: int):
        self._cooldown = cooldown
        self._stretch_end = start + cooldown
        self.first_upto = np.empty(0, np.int64)
        self.last = np.empty(0, np.int64)

    def then(self, first_upto: np.ndarray, last: np.ndarray) -> None:
        """Composes with the rows of a later stretch."""
        if not len(last):
            return
        following = np.searchsorted(first_upto, self.last + self._cooldown, "right")
        moves = following < len(last)
        own = np.where(moves, last[np.minimum(following, len(last) - 1)], self.last)
        # An alert before ``start`` blocks nothing from here on, so rows behind the first of these are never asked.
        if not len(self.first_upto) or self.first_upto[-1] < self._stretch_end:
            asked = int(np.searchsorted(first_upto, self._stretch_end, "left")) + 1
            self.first_upto = np.concatenate([self.first_upto, first_upto[:asked]])
            own = np.concatenate([own, last[:asked]])
        ends_run = np.append(own[1:] != own[:-1], True)
        self.first_upto, self.last = self.first_upto[ends_run], own[ends_run]


def rolling_sums(
    times: np.ndarray, amounts: np.ndarray, at: np.ndarray, length: int
) -> np.ndarray:
    """Sum of the amounts whose time lies within ``length`` before each ``at``, edges included."""
    running = np.concatenate(([0], np.cumsum(amounts)))
    upper = np.searchsorted(times, at, "right")
    lower = np.searchsorted(times, at - length, "left")
    return running[upper] - running[lower]
