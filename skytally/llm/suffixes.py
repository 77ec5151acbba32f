"""Suffix sorting by Lyndon groups, in linear time and without renaming."""

from __future__ import annotations

import numpy as np


def suffix_array(codes: np.ndarray) -> list[int]:
    """Places of the suffixes of ``codes`` (non-negative integers) in ascending order.

    First part: suffixes start in groups by their first symbol and end in groups by their longest Lyndon
    prefix. Groups are taken from the highest down; for every member the nearest earlier suffix of a lower
    group is found along the pointers found before. Such a suffix is extended by the group's prefix once
    per member that points at it, so those pointed at most often move first behind their own group.
    Second part: from the smallest suffix on, the suffix before each one, and along the pointers those
    before it, take the next place of their group.
    """
    n = len(codes) + 1  # with an end that is smaller than every symbol
    s = np.concatenate([np.asarray(codes, np.int64) + 1, [0]])
    order = np.argsort(s, kind="stable")
    inverse = np.empty(n, np.int64)
    inverse[order] = np.arange(n)
    symbols, first, size = np.unique(s[order], return_index=True, return_counts=True)
    group_of = first[np.searchsorted(symbols, s)].tolist()   # first place of the suffix's group
    sizes = np.zeros(n, np.int64)
    sizes[first] = size
    sizes, order, inverse = sizes.tolist(), order.tolist(), inverse.tolist()
    before = [-1] * n

    high = n - 1
    while high >= 0:
        i = order[high]
        low = group_of[i]
        if low == high:
            p = i - 1
            while p >= 0 and group_of[p] >= low:
                p = before[p]
            before[i] = p
            if p >= 0:
                g = group_of[p]
                rest = sizes[g] - 1
                if rest:
                    sizes[g] = rest
                    to, at = g + rest, inverse[p]
                    if to != at:
                        other = order[to]
                        order[at], inverse[other] = other, at
                        order[to], inverse[p] = p, to
                    group_of[p] = to
                    sizes[to] = 1
        else:
            pointed: dict[int, int] = {}
            for i in sorted(order[low:high + 1]):
                p = i - 1
                while p >= 0 and group_of[p] >= low:
                    p = before[p]
                before[i] = p
                if p >= 0:
                    pointed[p] = pointed.get(p, 0) + 1
            most = max(pointed.values(), default=0)
            for times in range(most, 0, -1):
                moving = list(pointed) if most == 1 else [p for p, k in pointed.items() if k == times]
                for p in moving:
                    g = group_of[p]
                    sizes[g] -= 1
                    to, at = g + sizes[g], inverse[p]
                    if to != at:
                        other = order[to]
                        order[at], inverse[other] = other, at
                        order[to], inverse[p] = p, to
                for p, g in [(p, group_of[p] + sizes[group_of[p]]) for p in moving]:
                    group_of[p] = g
                    sizes[g] += 1
        high = low - 1

    free = list(range(n))
    out = [-1] * n
    out[0] = n - 1
    placed = bytearray(n)
    placed[n - 1] = 1
    for i in range(n):
        p = out[i] - 1
        while p >= 0 and not placed[p]:
            g = group_of[p]
            out[free[g]] = p
            free[g] += 1
            placed[p] = 1
            p = before[p]
    return out[1:]


def repeated_starts(units: list[tuple[bytes, bytes, int]], length: int) -> list[list[int]]:
    """For each unit (left, right, starts): which of its first ``starts`` places begin a string of ``length``
    symbols that also begins at another unit's or another of its own starts.

    A unit reads left + one symbol for what all units share there + right.
    """
    shared, end = 257, 256
    parts, at, offset = [], 0, []
    for left, right, _ in units:
        parts += [np.frombuffer(left, np.uint8), np.array([shared]), np.frombuffer(right, np.uint8), np.array([end])]
        offset.append(at)
        at += len(left) + len(right) + 2
    codes = np.concatenate(parts).astype(np.int64)
    owner = np.full(len(codes), -1)
    for u, (o, unit) in enumerate(zip(offset, units, strict=True)):
        owner[o:o + unit[2]] = u
    owner = owner.tolist()
    text = codes.astype("<u2").tobytes()
    found: list[list[int]] = [[] for _ in units]
    last, last_text, told = -1, b"", False
    for i in suffix_array(codes):
        if owner[i] < 0:
            continue
        own = text[2 * i:2 * (i + length)]
        if own == last_text:
            if not told:
                found[owner[last]].append(last - offset[owner[last]])
            found[owner[i]].append(i - offset[owner[i]])
            told = True
        else:
            told = False
        last, last_text = i, own
    return [sorted(x) for x in found]
