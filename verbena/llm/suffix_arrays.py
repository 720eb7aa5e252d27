"""Suffix arrays by induced sorting, for the byte strings of one shard (numpy).

Suffixes are classified (smaller or larger than their right neighbour), the
substrings between leftmost-smaller positions are sorted by induction and
named, the shorter string of names is sorted, and its order induces the whole
array: one pass over the buckets for the larger suffixes, one backwards for
the smaller.  A bucket is handled as a few arrays, not suffix by suffix.

Only the order of the first ``depth`` characters is needed (equal prefixes must
be neighbours), so names are sorted to that depth.
"""

from __future__ import annotations

import numpy as np

from .common import mix64, powers

#: Up to this many names the string of names is sorted by induction again, beyond it by doubling ranks.
INDUCED_NAMES = 512


def smaller_types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its right neighbour; the last character must be the one smallest."""
    n = len(s)
    differs = np.append(s[:-1] != s[1:], True)
    following = np.minimum.accumulate(np.where(differs, np.arange(n), n)[::-1])[::-1]  # end of the run of equals
    out = np.ones(n, dtype=bool)
    inner = following < n - 1
    out[inner] = s[following[inner]] < s[following[inner] + 1]
    return out


def _deal(pending: list[list[np.ndarray]], s: np.ndarray, p: np.ndarray) -> None:
    """Append positions to the buckets of their characters, in order."""
    if not len(p):
        return
    c = s[p]
    order = np.argsort(c, kind="stable")
    c, p = c[order], p[order]
    cuts = np.flatnonzero(c[1:] != c[:-1]) + 1
    for part, first in zip(np.split(p, cuts), c[np.append(0, cuts)].tolist(), strict=True):
        pending[first].append(part)


def induce(s: np.ndarray, small: np.ndarray, leftmost: np.ndarray, size: int) -> np.ndarray:
    """All suffixes in order, given the leftmost-smaller ones in order (``size``: number of characters)."""
    starts: list[list[np.ndarray]] = [[] for _ in range(size)]
    _deal(starts, s, leftmost)
    large: list[list[np.ndarray]] = [[] for _ in range(size)]
    for c in range(size):  # larger suffixes, left to right
        done, wave = [], large[c]
        wave = np.concatenate(wave) if wave else None
        while wave is not None and len(wave):
            done.append(wave)
            p = wave[wave > 0] - 1
            p = p[~small[p]]
            here = s[p] == c
            _deal(large, s, p[~here])
            wave = p[here]
        if starts[c]:
            p = np.concatenate(starts[c])
            p = p[p > 0] - 1
            _deal(large, s, p[~small[p]])
        large[c] = done
    less: list[list[np.ndarray]] = [[] for _ in range(size)]
    for c in range(size - 1, -1, -1):  # smaller suffixes, right to left
        done, wave = [], less[c]
        wave = np.concatenate(wave) if wave else None
        while wave is not None and len(wave):
            done.append(wave)
            p = wave[wave > 0] - 1
            p = p[small[p]]
            here = s[p] == c
            _deal(less, s, p[~here])
            wave = p[here]
        if large[c]:
            p = np.concatenate(large[c])[::-1]
            p = p[p > 0] - 1
            p = p[small[p]]
            _deal(less, s, p[s[p] < c])
        less[c] = done
    out = [np.array([len(s) - 1])]
    for c in range(size):
        out += large[c]
        if less[c]:
            out.append(np.concatenate(less[c])[::-1])
    return np.concatenate(out)


def sorted_names(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of ``names`` by their first ``depth`` names, by doubling ranks among those still tied."""
    n, rank, h = len(names), names.astype(np.int64), 1
    while h < depth:
        _, at, size = np.unique(rank, return_inverse=True, return_counts=True)
        tied = np.flatnonzero(size[at] > 1)
        if not len(tied):
            break
        first = np.cumsum(size) - size  # ranks count the smaller suffixes, so that ties can be split in place
        rank = first[at]
        nxt = np.append(rank[h:] + 1, np.zeros(min(h, n), dtype=np.int64))[:n]
        order = tied[np.lexsort((nxt[tied], rank[tied]))]
        r, x = rank[order], nxt[order]
        new = np.append(True, (r[1:] != r[:-1]) | (x[1:] != x[:-1]))
        place = np.arange(len(order))
        group = np.append(True, r[1:] != r[:-1])
        begin = np.maximum.accumulate(np.where(group, place, 0))
        start = np.maximum.accumulate(np.where(new, place, 0))
        rank = rank.copy()
        rank[order] = r + (start - begin)
        h *= 2
    return np.argsort(rank, kind="stable")


def suffix_array(s: np.ndarray, size: int, depth: int, hashes) -> np.ndarray:
    """Suffixes of ``s`` in the order of their first ``depth`` characters.

    ``s`` ends with its one smallest character 0; characters are under ``size``.  ``hashes(a, b)`` hashes the
    ranges [a, b)."""
    small = smaller_types(s)
    leftmost = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(leftmost) < 2:
        return induce(s, small, leftmost, size)
    order = induce(s, small, leftmost, size)
    is_left = np.zeros(len(s), dtype=bool)
    is_left[leftmost] = True
    order = order[is_left[order]]
    number = np.zeros(len(s), dtype=np.int64)
    number[leftmost] = np.arange(len(leftmost))
    end = np.append(leftmost[1:] + 1, len(s))
    begin = order
    h = hashes(begin, end[number[order]])
    names = np.zeros(len(leftmost), dtype=np.int64)
    names[number[order]] = np.cumsum(np.append(0, (h[1:] != h[:-1]).astype(np.int64)))
    distinct = int(names.max()) + 1
    if distinct < len(names):
        if distinct <= INDUCED_NAMES:
            reduced = np.append(names + 1, 0)
            inner = suffix_array(reduced, distinct + 1, depth, _name_hashes(reduced))
            order = leftmost[inner[inner < len(names)]]
        else:
            order = leftmost[sorted_names(names, depth // 2 + 2)]
    return induce(s, small, order, size)


def _name_hashes(s: np.ndarray):
    p, q = powers(len(s))
    total = np.append(np.uint64(0), np.cumsum(mix64(s.astype(np.uint64) + np.uint64(1)) * p[: len(s)], dtype=np.uint64))

    def of(a, b):
        return mix64((total[b] - total[a]) * q[a] ^ (b - a).astype(np.uint64))

    return of


def repeated_starts(parts: list[bytes], length: int) -> list[np.ndarray]:
    """For each part, the starts of its ``length``-byte strings that also start elsewhere in the parts.

    The parts form one string with a separator after each; permuted common prefixes (of each suffix and its
    predecessor in the array, by place in the text, cut at ``length``) tell which neighbours agree."""
    text = np.frombuffer(b"\0".join(parts) + b"\0", dtype=np.uint8)
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    ends = np.cumsum(sizes + 1) - 1
    s = text.astype(np.int16) + 2
    s[ends] = 1
    s = np.append(s, 0).astype(np.int16)
    hashes = _name_hashes(s)
    array = suffix_array(s, 258, length, hashes)
    left = np.repeat(ends, sizes + 1) - np.arange(len(text))  # bytes up to the end of the part
    valid = np.append(left >= length, False)
    array = array[valid[array]]
    prefix = np.zeros(len(s), dtype=np.int64)  # permuted common prefixes, for the starts with a whole window
    if len(array) > 1:
        h = hashes(array, array + length)
        same = h[1:] == h[:-1]
        prefix[array[1:][same]] = length
        prefix[array[:-1][same]] = length
    hit = prefix >= length
    begin = ends - sizes
    return [np.flatnonzero(hit[a:b]) for a, b in zip(begin.tolist(), ends.tolist(), strict=True)]
