"""Suffix arrays by induced sorting, and common prefixes in text order, with numpy.

The array is induced bucket by bucket; inside a bucket all suffixes that are known at one time are
taken together (a wave), which keeps the order of a scan one by one. The string of names of the
leftmost-smaller substrings has too large an alphabet for buckets, so it is ordered by naming pairs
of names again and again, each time twice as far.
"""

from __future__ import annotations

import numpy as np

from riskloom.llm.arrays import FIRST


def _smaller(text):
    """Which suffixes are smaller than the next one (S type); the last isn't."""
    n = len(text)
    step = np.zeros(n, dtype=np.int8)
    step[:-1] = (text[:-1] < text[1:]).astype(np.int8) - (text[:-1] > text[1:]).astype(np.int8)
    step[-1] = -1
    decides = np.where(step != 0, np.arange(n), n - 1)
    return step[np.minimum.accumulate(decides[::-1])[::-1]] > 0


class _Buckets:
    """Suffixes dealt to the bucket of their first symbol, in order of arrival."""

    def __init__(self):
        self.parts = [[] for _ in range(256)]

    def deal(self, suffixes, symbols):
        if not len(suffixes):
            return
        order = np.argsort(symbols, kind="stable")
        suffixes, symbols = suffixes[order], symbols[order]
        cut = np.flatnonzero(np.diff(symbols)) + 1
        for part, symbol in zip(np.split(suffixes, cut), symbols[np.concatenate([[0], cut])]):
            self.parts[symbol].append(part)

    def take(self, symbol):
        parts = self.parts[symbol]
        return np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)


def _induce(text, small, leftmost):
    """All suffixes in order, from the leftmost-smaller ones in order."""
    begin, large = _Buckets(), _Buckets()
    begin.deal(leftmost, text[leftmost])
    large.deal(np.array([len(text) - 1]), text[-1:])
    ups = [None] * 256
    for symbol in range(256):
        wave = large.take(symbol)
        done = []
        while len(wave):
            done.append(wave)
            before = wave[wave > 0] - 1
            before = before[~small[before]]
            symbols = text[before]
            same = symbols == symbol
            large.deal(before[~same], symbols[~same])
            wave = before[same]
        ups[symbol] = np.concatenate(done) if done else np.empty(0, dtype=np.int64)
        before = begin.take(symbol)
        before = before[before > 0] - 1
        large.deal(before, text[before])  # what stands before a leftmost-smaller suffix is larger
    down, out = _Buckets(), []
    for symbol in range(255, -1, -1):
        wave = down.take(symbol)
        done = []
        while len(wave):
            done.append(wave)
            before = wave[wave > 0] - 1
            before = before[small[before]]
            symbols = text[before]
            same = symbols == symbol
            down.deal(before[~same], symbols[~same])
            wave = before[same]
        out += done + [ups[symbol][::-1]]
        before = ups[symbol][::-1]
        before = before[before > 0] - 1
        before = before[small[before]]
        down.deal(before, text[before])
    return np.concatenate(out)[::-1]


def _order_names(names):
    """Ranks of the suffixes of a string of names: how many are smaller.

    Only those that others equal so far are sorted again, by what follows them twice as far on.
    """
    n, step = len(names), 1
    rank = np.zeros(n, dtype=np.int64)
    open_, key, base = np.arange(n), np.asarray(names, dtype=np.int64), np.zeros(n, dtype=np.int64)
    while len(open_):
        by = np.argsort(key, kind="stable")
        open_, key, base = open_[by], key[by], base[by]
        at, fresh, group = np.arange(len(open_)), np.ones(len(open_), dtype=bool), np.ones(len(open_), dtype=bool)
        fresh[1:], group[1:] = key[1:] != key[:-1], base[1:] != base[:-1]
        # a rank and how far behind the first of the same old rank
        rank[open_] = base + np.maximum.accumulate(np.where(fresh, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        open_ = open_[~(fresh & np.append(fresh[1:], True))]
        ahead, inside = np.zeros(len(open_), dtype=np.int64), open_ + step < n
        ahead[inside] = rank[open_[inside] + step] + 1
        base = rank[open_]
        key = base * (n + 1) + ahead
        step *= 2
    return rank


def suffix_array(text):
    """Starts of the suffixes of a byte array, in order."""
    n = len(text)
    if n == 0:
        return np.empty(0, dtype=np.int64)
    small = _smaller(text)
    leftmost = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(leftmost):
        # sorted substrings: induce once from the leftmost ones in any order
        rough = _induce(text, small, leftmost)
        place = np.zeros(n, dtype=bool)
        place[leftmost] = True
        ordered = rough[place[rough]]
        index = np.zeros(n, dtype=np.int64)
        index[leftmost] = np.arange(len(leftmost))
        end = np.minimum(np.append(leftmost[1:] + 1, n), n)  # a substring holds the next one's first symbol
        which = index[ordered]
        hashes = FIRST.span(FIRST.sums(FIRST.bytes[text]), leftmost, end)[which]
        size = (end - leftmost)[which]
        last = which == len(leftmost) - 1  # runs to the end of the text, so it is like no other
        fresh = np.ones(len(ordered), dtype=np.int64)
        fresh[1:] = (hashes[1:] != hashes[:-1]) | (size[1:] != size[:-1]) | last[1:] | last[:-1]
        names = np.empty(len(leftmost), dtype=np.int64)
        names[which] = np.cumsum(fresh) - 1
        leftmost = leftmost[np.argsort(_order_names(names), kind="stable")]
    return _induce(text, small, leftmost)


def common_prefixes(text, array):
    """For each suffix, in text order, how long a prefix it shares with the one before it in ``array``.

    A suffix whose left neighbour extends the match has one less than that neighbour; only the others
    are compared, eight bytes at a time.
    """
    n = len(text)
    before = np.full(n, -1, dtype=np.int64)
    before[array[1:]] = array[:-1]
    follows = np.zeros(n, dtype=bool)
    inner = np.flatnonzero(before > 0)
    inner = inner[inner > 0]
    follows[inner] = text[inner - 1] == text[before[inner] - 1]
    heads = np.flatnonzero(~follows)
    shared = np.zeros(len(heads), dtype=np.int64)
    padded = np.concatenate([text, np.zeros(8, dtype=np.uint8)])
    eights = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (n + 1,), (1,))
    live = np.flatnonzero(before[heads] >= 0)
    while len(live):
        a, b = heads[live] + shared[live], before[heads[live]] + shared[live]
        room = np.minimum(n - np.maximum(a, b), 8)
        differ = eights[np.minimum(a, n)] ^ eights[np.minimum(b, n)]
        # the lowest differing byte comes first in memory
        same = np.full(len(live), 8, dtype=np.int64)
        odd = differ != 0
        lowest = differ[odd] & (~differ[odd] + np.uint64(1))
        same[odd] = np.log2(lowest.astype(np.float64)).astype(np.int64) // 8
        same = np.minimum(same, room)
        shared[live] += same
        live = live[same == 8]
    at = np.maximum.accumulate(np.where(~follows, np.arange(n), 0))
    out = np.zeros(n, dtype=np.int64)
    out[heads] = shared
    return out[at] - (np.arange(n) - at)
