"""Suffix arrays by linear grouping.

First every suffix joins the group of its first symbol. Groups are then taken
in descending order: each member points to the last place before it whose
suffix is in a lower group (its previous smaller one), and the places pointed
to leave their group for new ones right above it, apart by how many pointers
they got. In the end a group holds the suffixes of one Lyndon prefix, in order
of these prefixes. The second phase reads the array as it fills: whoever a
placed suffix follows, and that one's chain of pointers, takes the next slot of
its group. No name is given twice and nothing is sorted by comparison; both
phases handle each suffix once.
"""

from __future__ import annotations

import numpy as np


def lyndon_groups(text: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """``group, prev, order``: each suffix's group, its previous smaller place
    (-1: none), and the groups in descending order of their Lyndon prefixes."""
    n = len(text)
    by_symbol = np.argsort(text, kind="stable")
    cuts = np.flatnonzero(np.diff(text[by_symbol])) + 1
    members = [part.tolist() for part in np.split(by_symbol, cuts)]
    group = np.empty(n, dtype=np.int64)
    group[by_symbol] = np.repeat(np.arange(len(members)), [len(m) for m in members])
    group = group.tolist()
    size = [len(m) for m in members]
    lower, higher = list(range(-1, len(members) - 1)), [*range(1, len(members)), -1]
    prev, done, order = [-1] * n, bytearray(n), []
    g = len(members) - 1
    while g >= 0:
        if size[g]:
            order.append(g)
            pointed: dict[int, int] = {}
            for s in members[g]:
                if group[s] != g:
                    continue
                done[s] = 1
                p = s - 1
                # What is done lies in this group or a higher one; so does all up to its own pointer.
                while p >= 0 and done[p]:
                    p = prev[p]
                prev[s] = p
                if p >= 0:
                    pointed[p] = pointed.get(p, 0) + 1
            parts: dict[tuple[int, int], list[int]] = {}
            for p, times in pointed.items():
                parts.setdefault((-times, group[p]), []).append(p)
            for _, old in sorted(parts) if len(parts) > 1 else list(parts):
                moved = parts[_, old]
                if len(moved) == size[old]:
                    continue          # the whole group would move: no order changes
                new, above = len(members), higher[old]
                members.append(moved)
                size.append(len(moved))
                size[old] -= len(moved)
                for p in moved:
                    group[p] = new
                lower.append(old)
                higher.append(above)
                higher[old] = new
                if above >= 0:
                    lower[above] = new
        members[g] = []
        g = lower[g]
    return group, prev, order


def suffix_array(text: np.ndarray) -> list[int]:
    """The start places of all suffixes of ``text`` (integers), in ascending order of the suffixes."""
    n = len(text)
    if not n:
        return []
    group, prev, order = lyndon_groups(text)
    counts = np.bincount(group)
    ascending = np.array(order[::-1], dtype=np.int64)
    starts = np.zeros(len(counts), dtype=np.int64)
    starts[ascending] = np.cumsum(counts[ascending]) - counts[ascending]
    free = starts.tolist()
    out, placed = [0] * n, bytearray(n)
    at, s = -1, n - 1
    while True:
        while s >= 0 and not placed[s]:
            g = group[s]
            out[free[g]] = s
            free[g] += 1
            placed[s] = 1
            s = prev[s]
        at += 1
        if at == n:
            return out
        s = out[at] - 1
