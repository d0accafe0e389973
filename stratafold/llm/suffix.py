"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

Suffixes are classed as S (smaller than the next suffix) or L. Leftmost S suffixes are sorted by
inducing, named, and sorted recursively as a string of names; two inducing scans then fill the array.

An inducing scan reads the array in order and writes further on, so plain loops are the usual form.
Here a scan takes a block at a time: all entries ahead of the nearest slot that the block itself will write
are final, so their predecessors can be placed together. The work stays linear and the numpy calls
are few, since blocks grow as long as nothing is written into them. A long run of one byte writes each entry just ahead of the scan and takes a
call for each; whoever has such runs should cut them into equal pieces first, as substrings.py does.
"""

from __future__ import annotations

import numpy as np

_LEAST, _MOST = 32, 1 << 16


def _scan(sa: np.ndarray, before: np.ndarray, head: np.ndarray, narrow: type) -> None:
    """Places the predecessors of entries in order. sa: -1 where empty; before[i]: the first letter of the
    predecessor of suffix i if that is of the class in question, else -1 (so at before[-1]); head: the next free
    slot for each first letter; narrow: a type that holds all letters, for sorting."""
    n, at, width = len(sa), 0, 1024
    count = np.arange(_MOST)
    while at < n:
        block = sa[at : at + width]
        letter = before[block]
        which = (letter >= 0).nonzero()[0]
        if not len(which):
            at += len(block)
            width = min(2 * width, _MOST)
            continue
        letter = letter[which]
        order = letter.astype(narrow).argsort(kind="stable")
        letter = letter[order]
        ends = (letter[1:] != letter[:-1]).nonzero()[0]
        edges = np.empty(len(ends) + 2, np.int64)
        edges[0], edges[-1] = 0, len(letter)
        np.add(ends, 1, out=edges[1:-1])
        starts = edges[:-1]
        runs = edges[1:] - starts
        free = head[letter[starts]]
        slot = (free - starts).repeat(runs)
        slot += count[: len(letter)]
        from_ = which[order]
        final = int(free.min()) - at
        if final < len(block):
            stay = from_ < final
            slot, letter, from_ = slot[stay], letter[stay], from_[stay]
            sa[slot] = block[from_] - 1
            head[letter] = slot + 1  # the last of a letter holds
            at += final
            width = max(_LEAST, min(2 * final, _MOST))
        else:
            sa[slot] = block[from_] - 1
            head[letter[starts]] = free + runs
            at += len(block)
            width = min(2 * width, _MOST)


def _induce(text: np.ndarray, small: np.ndarray, counts: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """All suffixes, induced from leftmost S suffixes, which seeds holds in their order within each letter."""
    n = len(text)
    ends = np.cumsum(counts)
    sa = np.full(n, -1, np.int32)
    first = text[seeds]
    own = np.bincount(first, minlength=len(counts))
    sa[ends[first] - np.cumsum(own)[first] + np.arange(len(seeds))] = seeds
    narrow = np.uint8 if len(counts) <= 256 else np.uint16 if len(counts) <= 65536 else np.int32
    before = np.full(n + 1, -1, np.int16 if len(counts) < 32768 else np.int32)
    before[1:n] = np.where(small[:-1], -1, text[:-1])
    _scan(sa, before, ends - counts, narrow)
    filled = np.flatnonzero(sa >= 0)
    sa[filled[small[sa[filled]]]] = -1
    sa[0] = n - 1
    before[1:n] = np.where(small[:-1], text[:-1], -1)
    _scan(sa[::-1], before, n - ends, narrow)
    sa[0] = n - 1
    return sa


def _sorted(text: np.ndarray, letters: int) -> np.ndarray:
    """The suffix array of a text over 0..letters-1 that ends in its only 0."""
    n = len(text)
    if n <= 2:
        return np.arange(n - 1, -1, -1, dtype=np.int32)
    step = np.flatnonzero(text[1:] != text[:-1])
    runs = np.diff(step, prepend=-1)
    small = np.ones(n, bool)
    small[:-1] = np.repeat(text[step + 1] > text[step], runs)
    left = np.flatnonzero(small[1:] & ~small[:-1]).astype(np.int32) + 1
    counts = np.bincount(text, minlength=letters)
    sa = _induce(text, small, counts, left[np.argsort(text[left], kind="stable")])
    is_left = np.zeros(n, bool)
    is_left[left] = True
    ranked = sa[is_left[sa]]
    del sa
    # Equal neighbours among the sorted substrings, each up to and with the next leftmost S letter
    size = np.zeros(n, np.int32)
    size[left[:-1]] = np.diff(left) + 1
    a, b = ranked[:-1], ranked[1:]
    alike = size[a] == size[b]
    pending, depth = np.flatnonzero(alike), 0
    while len(pending):
        same = text[a[pending] + depth] == text[b[pending] + depth]
        alike[pending[~same]] = False
        depth += 1
        pending = pending[same]
        pending = pending[size[a[pending]] > depth]
    names = np.zeros(len(ranked), np.int32)
    np.cumsum(~alike, out=names[1:])
    place = np.empty(n, np.int32)
    place[left] = np.arange(len(left), dtype=np.int32)
    reduced = np.empty(len(left), np.int32)
    reduced[place[ranked]] = names
    del place, size, is_left
    if names[-1] + 1 < len(names):
        ranked = left[_sorted(reduced, int(names[-1]) + 1)]
    return _induce(text, small, counts, ranked)


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of data (bytes) in order; a shorter suffix comes before those that it begins."""
    used = np.bincount(data, minlength=256) > 0
    dense = np.cumsum(used).astype(np.int16)
    text = np.zeros(len(data) + 1, np.int16)
    text[:-1] = dense[data]
    return _sorted(text, int(dense[-1]) + 1)[1:]


def prefixes(data: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Permuted common prefixes: for each place of data, how many bytes its suffix shares with the one before it in order, the whole suffix array.

    A place is reducible if the byte before it is also the one before that other suffix: the pair of a place earlier then
    shares one byte more, so the value carries over, less one. Only the other places are compared, eight bytes at a time."""
    n = len(data)
    other = np.full(n, -1, np.int32)
    other[order[1:]] = order[:-1]
    alone = np.ones(n, bool)
    alone[1:] = (other[1:] <= 0) | (data[:-1] != data[other[1:] - 1])
    held = np.zeros(n + 16, np.uint8)
    held[:n] = data
    # Eight bytes at any place: words read through eight shifted views
    word = np.empty(n + 8, np.uint64)
    for s in range(8):
        part = word[s::8]
        part[:] = held[s : s + 8 * len(part)].view("<u8")
    here = np.flatnonzero(alone & (other >= 0))
    there = other[here].astype(np.int64)
    found = np.zeros(n, np.int32)
    pending, depth = np.arange(len(here)), 0
    while len(pending):
        a, b = here[pending] + depth, there[pending] + depth
        room = np.maximum(a, b) < n
        pending, a, b = pending[room], a[room], b[room]
        differ = word[a] ^ word[b]
        same = np.bitwise_count((differ & -differ) - np.uint64(1)) >> 3  # bytes before the first that differs; 8 for none
        found[here[pending]] += same
        pending = pending[same == 8]
        depth += 8
    found[here] = np.minimum(found[here], n - np.maximum(here, there))
    place = np.arange(n, dtype=np.int32)
    last = np.maximum.accumulate(np.where(alone, place, 0))
    return found[last] - (place - last)
