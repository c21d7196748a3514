"""Sparse suffix arrays of texts, and the logarithmic family of them.

Every window of ``WINDOW`` bytes is owned by one suffix: the one that starts at the
least of the window's ``GRAM``-byte strings by hash, the leftmost of equal ones. Equal
windows are owned at the same offset, so comparing owned windows of suffixes that
start with the same bytes finds all equal windows. A suffix stands with its
surroundings: the bytes of all windows it owns.

A ``Family`` holds suffix arrays of growing size. New suffixes are sorted into an
array of their own; as long as the last level is not larger, the two are merged, and
in the merged order suffixes with the same start lie together and are compared. Every
two suffixes with one start so meet in exactly one merge, and a suffix takes part in
as many as there are levels, the logarithm of their number.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WINDOW = 50
GRAM = 16

#: Bytes before a suffix that a window it owns may begin with.
BEFORE = WINDOW - GRAM

#: A record: the surroundings, bytes outside owned windows as zero, then the offset of
#: the first owned window's start before the suffix, and the number of owned windows.
SPAN = BEFORE + WINDOW
RECORD = SPAN + 4

#: Windows whose owners are found in one go; a few arrays of eight bytes for each.
CHUNK = 1 << 18

#: Windows that are compared in one go, about; some 150 bytes for each.
PORTION = 200_000

_MIX = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)]


def mixed(values: np.ndarray) -> np.ndarray:
    """A well-spread hash of 64-bit numbers."""
    values = values * _MIX[0]
    values ^= values >> np.uint64(32)
    values *= _MIX[1]
    values ^= values >> np.uint64(29)
    return values


def hashed(words: np.ndarray) -> np.ndarray:
    """A hash of each row of 64-bit words."""
    out = np.zeros(len(words), np.uint64)
    for column in words.T:
        out = mixed(out ^ column)
    return out


@dataclass
class Owners:
    """Suffixes that own windows, in the order of the bytes they start at."""

    start: np.ndarray  # where the suffix starts
    window: np.ndarray  # where its first window starts
    count: np.ndarray  # how many windows it owns
    gram: np.ndarray  # hash of its first GRAM bytes


def owners(data: np.ndarray, ends: np.ndarray) -> Owners:
    """Owning suffixes of texts that lie one after the other, ending at ``ends``."""
    starts = np.concatenate([[0], ends[:-1]])
    long = ends - starts >= WINDOW
    step = np.zeros(len(data) + 1, np.int8)
    step[starts[long]] += 1
    step[ends[long] - WINDOW + 1] -= 1
    inside = np.cumsum(step, dtype=np.int8).astype(bool)
    parts = [_owners(data, inside, at) for at in range(0, len(data) - WINDOW + 1, CHUNK)]
    if not parts:
        none = np.zeros(0, np.int64)
        return Owners(none, none, none, none.astype(np.uint64))
    owner, window, count, gram = (np.concatenate(p) for p in zip(*parts))
    # A suffix that owns windows on both sides of a chunk's edge is one suffix.
    first = np.flatnonzero(np.diff(owner, prepend=-1) != 0)
    count = np.add.reduceat(count, first) if len(first) else count
    return Owners(owner[first], window[first], count, gram[first])


def _owners(data: np.ndarray, inside: np.ndarray, at: int) -> tuple[np.ndarray, ...]:
    """Of the windows that start in a chunk: owners, their first windows, counts, hashes."""
    words = data[at : at + CHUNK + WINDOW - 1].astype(np.uint64)
    for width in (1, 2, 4):
        words = (words[:-width] << np.uint64(8 * width)) | words[width:]
    gram = mixed(words[:-8] ^ mixed(words[8:]))
    low = np.uint64(0xFFFFFFFF)
    least = (gram & ~low) | np.arange(len(gram), dtype=np.uint64)
    span, grams = 1, BEFORE + 1
    while 2 * span <= grams:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < grams:
        least = np.minimum(least[: span - grams], least[grams - span :])
    windows = np.flatnonzero(inside[at : at + len(least)])
    owner = (least[windows] & low).astype(np.int64)
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    count = np.diff(np.append(first, len(owner)))
    return owner[first] + at, windows[first] + at, count, gram[owner[first]]


def records(data: np.ndarray, found: Owners, chosen: np.ndarray) -> np.ndarray:
    """Records of the chosen suffixes, one row of bytes each."""
    start, count = found.start[chosen], found.count[chosen]
    offset = start - found.window[chosen]
    out = np.zeros((len(start), RECORD), np.uint8)
    padded = np.concatenate([np.zeros(BEFORE, np.uint8), data, np.zeros(WINDOW, np.uint8)])
    around = np.lib.stride_tricks.sliding_window_view(padded, SPAN)
    column = np.arange(SPAN, dtype=np.int16)
    begin = (BEFORE - offset).astype(np.int16)[:, None]
    end = begin + (count + WINDOW - 1).astype(np.int16)[:, None]
    np.multiply(around[start], (column >= begin) & (column < end), out=out[:, :SPAN])
    out[:, SPAN] = offset
    out[:, SPAN + 1] = count
    return out


def alike(rows: np.ndarray, keys: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Whether each row of the order equals the one before it.

    ``keys`` are hashes by which ``order`` sorts. Different rows with one hash are put
    in the order of their bytes, in place, so that equal ones always lie together.
    """
    ordered, hashes = rows[order], keys[order]
    same = np.zeros(len(order), bool)
    same[1:] = (ordered[1:] == ordered[:-1]).all(axis=1)
    clash = np.zeros(len(order), bool)
    clash[1:] = (hashes[1:] == hashes[:-1]) & ~same[1:]
    for value in np.unique(hashes[clash]):
        run = np.flatnonzero(hashes == value)
        by_bytes = sorted(order[run].tolist(), key=lambda i: rows[i].tobytes())
        order[run] = by_bytes
        same[run[1:]] = (rows[order[run[1:]]] == rows[order[run[:-1]]]).all(axis=1)
    return same


@dataclass
class Suffixes:
    """Suffixes with the smallest document that has each record, and a tag of the caller's."""

    rows: np.ndarray
    document: np.ndarray
    tag: np.ndarray

    def __len__(self) -> int:
        return len(self.document)


def joined(parts: list[Suffixes]) -> Suffixes:
    return Suffixes(
        np.concatenate([p.rows for p in parts]),
        np.concatenate([p.document for p in parts]),
        np.concatenate([p.tag for p in parts]),
    )


def _group_min(values: np.ndarray, same: np.ndarray) -> np.ndarray:
    """For each place, the least value of its run; a run goes on where ``same``."""
    first = np.flatnonzero(~same)
    least = np.minimum.reduceat(values, first)
    return np.repeat(least, np.diff(np.append(first, len(values))))


class Family:
    """Levels of suffix arrays; ``found`` collects ``(tag, first window, windows)``."""

    def __init__(self, batch: int = 4096) -> None:
        self._batch = batch
        self._waiting: list[Suffixes] = []
        self._levels: list[Suffixes] = []
        self.found: list[np.ndarray] = []

    def add(self, new: Suffixes) -> None:
        """Take in suffixes; small additions wait until there are enough for an array."""
        self._waiting.append(new)
        if sum(map(len, self._waiting)) >= self._batch:
            self._settle_waiting()

    def _settle_waiting(self) -> None:
        if not self._waiting:
            return
        level = self._merged(self._waiting, fresh=True)
        self._waiting = []
        while self._levels and len(self._levels[-1]) <= len(level):
            level = self._merged([self._levels.pop(), level])
        self._levels.append(level)

    def matches(self) -> np.ndarray:
        """Merge what is left, and give all windows that a smaller document has."""
        self._settle_waiting()
        while len(self._levels) > 1:
            level = self._merged([self._levels.pop(), self._levels.pop()])
            self._levels.append(level)
        return np.concatenate([np.zeros((0, 3), np.int64), *self.found])

    def _merged(self, parts: list[Suffixes], fresh: bool = False) -> Suffixes:
        """One array of several, whose suffixes are compared across parts.

        Of ``fresh`` parts all suffixes are compared, as none have been before.
        """
        both = joined(parts)
        side = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        if fresh:
            side = np.arange(len(both))
        start = np.ascontiguousarray(both.rows[:, BEFORE : BEFORE + GRAM]).view(">u8")
        start = start.astype(np.uint64)
        key = hashed(both.rows.view("<u8"))
        # The smallest document that has a record comes first among equal ones.
        order = np.lexsort((both.document, key, start[:, 1], start[:, 0]))
        same = alike(both.rows, key, order)
        document, count = both.document[order], both.rows[order, SPAN + 1].astype(np.int64)

        # Records that another document has as a whole.
        least = _group_min(document, same)
        later = document > least
        self._report(both.tag[order][later], np.zeros(int(later.sum()), np.int64), count[later])

        # Windows of records that differ, where suffixes of several parts start alike.
        starts, side = start[order], side[order]
        begun = np.ones(len(order), bool)
        begun[1:] = (starts[1:] != starts[:-1]).any(axis=1)
        group = np.cumsum(begun) - 1
        first = np.flatnonzero(begun)
        mixed_sides = np.minimum.reduceat(side, first) != np.maximum.reduceat(side, first)
        several = np.maximum.reduceat(~same & ~begun, first)
        met = (mixed_sides & several)[group] & ~same
        # In portions of whole groups, each of a bounded number of windows or one group.
        which, ends = order[met], np.cumsum(np.where(met, count, 0))
        portion = (ends[np.append(first[1:], len(order)) - 1] // PORTION)[group][met]
        for part in np.split(which, np.flatnonzero(np.diff(portion)) + 1):
            if len(part):
                self._windows(both, part)
        kept = order[~later]
        return Suffixes(both.rows[kept], both.document[kept], both.tag[kept])

    def _windows(self, both: Suffixes, which: np.ndarray) -> None:
        rows, document, tag = both.rows[which], both.document[which], both.tag[which]
        offset, count = rows[:, SPAN].astype(np.int64), rows[:, SPAN + 1].astype(np.int64)
        entry = np.repeat(np.arange(len(which)), count)
        window = np.arange(len(entry)) - np.repeat(np.cumsum(count) - count, count)
        width = 56
        text = np.zeros((len(entry), width), np.uint8)
        begin = BEFORE - offset[entry] + window
        flat = np.lib.stride_tricks.sliding_window_view(rows.reshape(-1), WINDOW)
        text[:, :WINDOW] = flat[entry * RECORD + begin]
        text[:, WINDOW] = begin
        key = hashed(text.view("<u8"))
        order = np.argsort(key, kind="stable")
        same = alike(text, key, order)
        owner = document[entry][order]
        later = np.zeros(len(order), bool)
        later[order] = owner > _group_min(owner, same)
        # Runs of windows that follow each other in one record.
        hit = np.flatnonzero(later)
        if not len(hit):
            return
        broken = np.ones(len(hit), bool)
        broken[1:] = (np.diff(hit) != 1) | (entry[hit[1:]] != entry[hit[:-1]])
        first = np.flatnonzero(broken)
        self._report(
            tag[entry[hit[first]]], window[hit[first]], np.diff(np.append(first, len(hit)))
        )

    def _report(self, tag: np.ndarray, window: np.ndarray, count: np.ndarray) -> None:
        if len(tag):
            self.found.append(np.stack([tag, window, count], axis=1).astype(np.int64))
