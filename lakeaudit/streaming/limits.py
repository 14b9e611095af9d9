"""The request limiter's rules, one client at a time in time order."""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass, field

import numpy as np

SECOND = 1_000_000  # times are whole microseconds


@dataclass(frozen=True)
class Limits:
    """Window and breaker in seconds, requests per window, violations to trip."""

    window: int = 60
    max_requests: int = 240
    breaker: int = 60
    violations: int = 3

    def __post_init__(self):
        if min(self.window, self.max_requests, self.breaker, self.violations) <= 0:
            raise ValueError("all limits must be above zero")

    @property
    def window_us(self) -> int:
        return self.window * SECOND

    @property
    def breaker_us(self) -> int:
        return self.breaker * SECOND

    @property
    def quiet_us(self) -> int:
        """After a longer pause only the violation count is left of a client's state."""
        return self.window_us + self.breaker_us


@dataclass
class Client:
    """What is remembered: accepted times of the window, violations, end of a block."""

    times: deque = field(default_factory=deque)
    violations: int = 0
    blocked_until: int = 0

    def check(self, now: int, limits: Limits) -> tuple[bool, int | None]:
        """Accept or deny one request; a denied one also gets the seconds to wait."""
        if self.blocked_until > now:
            return False, max(1, (self.blocked_until - now) // SECOND)
        self.forget(now, limits)
        if len(self.times) < limits.max_requests:
            self.times.append(now)
            if self.violations and len(self.times) < limits.max_requests // 2:
                self.violations -= 1
            return True, None
        self.violations += 1
        if self.violations >= limits.violations:
            self.blocked_until = now + limits.breaker_us
            return False, limits.breaker
        return False, max(1, (self.times[0] + limits.window_us - now) // SECOND)

    def forget(self, now: int, limits: Limits) -> None:
        while self.times and self.times[0] < now - limits.window_us:
            self.times.popleft()

    def run(self, times: np.ndarray, limits: Limits) -> tuple[np.ndarray, np.ndarray]:
        """Check many requests in time order; a blocked stretch is denied in one step."""
        allowed = np.zeros(len(times), dtype=bool)
        retry = np.zeros(len(times), dtype=np.int64)
        i = 0
        while i < len(times):
            if self.blocked_until > times[i]:
                end = int(np.searchsorted(times, self.blocked_until, side="left"))
                retry[i:end] = np.maximum(1, (self.blocked_until - times[i:end]) // SECOND)
                i = end
                continue
            ok, wait = self.check(int(times[i]), limits)
            allowed[i], retry[i] = ok, wait or 0
            i += 1
        return allowed, retry


@dataclass
class _Track:
    """Starting violation counts under which all decisions so far are the same.

    ``pieces`` are (low, high, count, shift): for starts from low to high the count now is
    ``count``, or start + ``shift`` when ``count`` is None; a high of None is open.
    """

    client: Client
    pieces: list


class Effect:
    """How a busy period changes the violation count, for every count it may start with.

    A period's requests are checked once for all starts together: starts part ways only
    where one of them trips the breaker and another does not.
    """

    def __init__(self):
        self.tracks = [_Track(Client(), [(0, None, None, 0)])]

    def begin(self, times: list[int]) -> None:
        """Requests accepted before the period."""
        for track in self.tracks:
            track.client.times.extend(times)

    def check(self, now: int, limits: Limits) -> None:
        forked = []
        for track in self.tracks:
            client = track.client
            if client.blocked_until > now:
                continue
            client.forget(now, limits)
            if len(client.times) < limits.max_requests:
                client.times.append(now)
                if len(client.times) < limits.max_requests // 2:
                    track.pieces = _lowered(track.pieces)
                continue
            raised = [(lo, hi, None if n is None else n + 1, shift + 1) for lo, hi, n, shift in track.pieces]
            open_, tripped = _split(raised, limits.violations)
            track.pieces = open_ or tripped
            if tripped and open_:
                forked.append(_Track(Client(deque(client.times), 0, now + limits.breaker_us), tripped))
            elif tripped:
                client.blocked_until = now + limits.breaker_us
        self.tracks += forked

    def rows(self) -> list[tuple]:
        """(low, high, count, shift) for all starts; together they cover every start once."""
        return sorted((p for t in self.tracks for p in t.pieces), key=lambda p: p[0])


def _lowered(pieces: list) -> list:
    """Counts one lower, zero staying zero."""
    out: list = []
    for lo, hi, n, shift in pieces:
        if n is not None:
            out.append((lo, hi, max(0, n - 1), 0))
        elif lo + shift > 0:
            out.append((lo, hi, None, shift - 1))
        else:
            out.append((lo, lo, 0, 0))
            if hi is None or hi > lo:
                out.append((lo + 1, hi, None, shift - 1))
    merged: list = []
    for piece in out:
        last = merged[-1] if merged else None
        if last and piece[2] is not None and last[2] == piece[2] and last[1] is not None and last[1] + 1 == piece[0]:
            merged[-1] = (last[0], piece[1], piece[2], 0)
        else:
            merged.append(piece)
    return merged


def _split(pieces: list, limit: int) -> tuple[list, list]:
    """Pieces with a count below the limit, and those at or above it."""
    below, reached = [], []
    for lo, hi, n, shift in pieces:
        if n is not None:
            (below if n < limit else reached).append((lo, hi, n, shift))
            continue
        edge = limit - shift  # first start that reaches the limit
        if edge > lo:
            below.append((lo, edge - 1 if hi is None else min(hi, edge - 1), None, shift))
        if hi is None or hi >= edge:
            reached.append((max(lo, edge), hi, None, shift))
    return below, reached
