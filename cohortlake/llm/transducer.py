"""Counts of UTF-8 texts by one pass of a table-driven byte transducer.

The table has a row for each state (in a gap, in a word) and a column for each
byte; its entry is the state that follows and what the byte emits: a word's start
or end, a capital, a symbol, a code point. Word breaks are ASCII bytes, which UTF-8
never uses inside a longer character, so no text has to be decoded. The entry's
state depends on the byte alone, so the states of a whole buffer are known at once
and the table is applied to all bytes by one indexed look-up.

Word spans go into an open-addressing hash table, all texts of a buffer together.
A span that meets a holder counts as a repeat only if text, length, hash and finally
every byte agree; otherwise it probes the next slot, so hash collisions cost time and
never a word. Temporary arrays cover at most ``CHUNK`` bytes at a time.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from cohortlake.llm.shingles import mixed

#: The bytes that separate words.
BREAKS = b" \t\n\x0b\x0c\r"
IN_WORD, STARTS, ENDS, CAPITAL, SYMBOL, POINT = 1, 2, 4, 8, 16, 32
CHUNK = 1 << 20


def step_table(symbols: bytes) -> np.ndarray:
    """The transducer: (state, byte) -> following state and emissions."""
    table = np.zeros((2, 256), np.uint8)
    for state in (0, 1):
        for byte in range(256):
            word = byte not in BREAKS
            table[state, byte] = (
                IN_WORD * word + STARTS * (word and not state) + ENDS * (not word and state)
                + CAPITAL * (65 <= byte <= 90) + SYMBOL * (byte in symbols) + POINT * (byte & 0xC0 != 0x80)
            )
    return table


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
UP, DOWN = _powers(BASE, CHUNK), _powers(pow(BASE, -1, 1 << 64), CHUNK)


class Counts(NamedTuple):
    words: np.ndarray
    distinct: np.ndarray
    capitals: np.ndarray
    points: np.ndarray
    symbols: np.ndarray


def _groups(sizes: np.ndarray, most: int):
    """Ranges of consecutive items whose sizes add up to at most ``most``, or of one item."""
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield at, to
        at = to


def _hashes(buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Polynomial hashes of the spans' first CHUNK bytes, from running sums."""
    out, taken = np.empty(len(starts), np.uint64), np.minimum(lengths, CHUNK)
    reach = np.diff(starts, append=starts[-1] + taken[-1]) if len(starts) else taken
    for at, to in _groups(np.maximum(reach, taken), CHUNK):
        first = starts[at]
        part = buffer[first : min(starts[to - 1] + taken[to - 1], first + CHUNK)]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * UP[: len(part)], out=sums[1:])
        own = starts[at:to] - first
        out[at:to] = (sums[np.minimum(own + taken[at:to], len(part))] - sums[own]) * DOWN[own]
    return out


def _same_bytes(buffer: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the spans that start at ``a`` and ``b`` hold the same bytes."""
    out = np.empty(len(a), bool)
    for at, to in _groups(lengths, CHUNK):
        if to == at + 1:
            out[at] = np.array_equal(buffer[a[at] : a[at] + lengths[at]], buffer[b[at] : b[at] + lengths[at]])
            continue
        n = lengths[at:to]
        first = np.concatenate(([0], np.cumsum(n)[:-1]))
        within = np.arange(first[-1] + n[-1]) - np.repeat(first, n)
        equal = buffer[np.repeat(a[at:to], n) + within] == buffer[np.repeat(b[at:to], n) + within]
        out[at:to] = np.logical_and.reduceat(equal, first)
    return out


def _distinct(buffer: np.ndarray, text: np.ndarray, starts: np.ndarray, lengths: np.ndarray, texts: int) -> np.ndarray:
    """How many different spans each text has."""
    key = mixed(_hashes(buffer, starts, lengths) ^ mixed(text.astype(np.uint64) + np.uint64(1)))
    mask = (1 << max(4, (2 * len(starts)).bit_length())) - 1
    table, slot = np.full(mask + 1, -1, np.int64), (key & np.uint64(mask)).astype(np.int64)
    new, pending = np.zeros(len(starts), bool), np.arange(len(starts))
    while pending.size:
        s = slot[pending]
        free = table[s] < 0
        table[s[free]] = pending[free]  # of several spans that want a slot, one stays
        holder = table[s]
        own = holder == pending
        new[pending[own]] = True
        alike = np.flatnonzero(~own & (key[holder] == key[pending]) & (text[holder] == text[pending]) & (lengths[holder] == lengths[pending]))
        done = own
        done[alike] = _same_bytes(buffer, starts[holder[alike]], starts[pending[alike]], lengths[pending[alike]])
        pending = pending[~done]
        slot[pending] = (slot[pending] + 1) & mask
    return np.bincount(text[new], minlength=texts)


def counts(buffer: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> Counts:
    """Counts of the texts ``buffer[bounds[i]:bounds[i + 1]]`` (bytes); ``bounds`` rise from 0 to the buffer's end."""
    state = np.zeros(len(buffer), np.uint8)
    state[1:] = table[0, buffer[:-1]] & IN_WORD
    full = bounds[:-1][np.diff(bounds) > 0]
    state[full] = 0
    out = table[state, buffer]
    starts = np.flatnonzero(out & STARTS)
    last = bounds[1:][np.diff(bounds) > 0]
    ends = np.sort(np.concatenate((np.flatnonzero(out & ENDS), last[(out[last - 1] & IN_WORD) > 0])))
    each = lambda emitted: np.diff(np.searchsorted(np.flatnonzero(emitted), bounds))
    n = len(bounds) - 1
    text = np.repeat(np.arange(n), words := each(out & STARTS))
    return Counts(words, _distinct(buffer, text, starts, ends - starts, n), each(out & CAPITAL), np.diff(bounds) - each((out & POINT) == 0), each(out & SYMBOL))
