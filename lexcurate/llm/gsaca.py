"""Suffix array by linear grouping.

Phase one sorts suffixes into groups by their longest Lyndon prefix. Groups
start as single symbols and are processed from the highest down: each suffix
of the group finds its previous smaller one (the nearest to the left in a
lower group); that one's prefix grows by the group's, as often as the group
repeats there, and moves to a new group just above its old one. Phase two goes
through the finished order from below: the suffixes whose Lyndon prefix ends
where the suffix at hand begins, found along the previous-smaller pointers,
take the next place of their groups. Nothing is renamed or solved recursively.
"""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """Starts of the suffixes of ``text`` in order. Symbols are integers of 1 or more."""
    s = [*text, 0]
    n = len(s)
    symbols = sorted(set(s))
    number = {c: g for g, c in enumerate(symbols)}
    group = [number[c] for c in s]
    members: list[list[int]] = [[] for _ in symbols]
    for i, g in enumerate(group):
        members[g].append(i)
    length = [1] * len(symbols)
    above = [*range(1, len(symbols)), -1]
    below = [*range(-1, len(symbols) - 1)]
    # done[i]: i if the suffix isn't processed, else some place to the left from which to look on
    done = list(range(n))
    smaller = [-1] * n

    at = len(symbols) - 1
    while at >= 0:
        here = [i for i in members[at] if group[i] == at]
        members[at] = here
        for i in here:
            done[i] = i - 1
        grown: dict[int, int] = {}
        for i in here:
            p = i - 1
            while p >= 0 and done[p] != p:
                p = done[p]
            q = i
            while q > p and q >= 0:  # shorten the way for later looks
                done[q], q = p, done[q]
            smaller[i] = p
            if p >= 0:
                grown[p] = grown.get(p, 0) + 1
        if grown:
            moved: dict[tuple[int, int], list[int]] = {}
            for p, times in grown.items():
                moved.setdefault((times, group[p]), []).append(p)
            for times, old in sorted(moved, reverse=True):  # more repeats: higher
                new = len(members)
                members.append(moved[times, old])
                length.append(length[old] + times * length[at])
                after = above[old]
                above.append(after)
                below.append(old)
                above[old] = new
                if after >= 0:
                    below[after] = new
                for p in members[new]:
                    group[p] = new
        at = below[at]

    place, at = [0] * len(members), 0
    start, g = 0, 0
    while g >= 0:  # group 0 is the end mark's, the lowest
        place[g] = start
        start += len(members[g])
        g = above[g]
    order = [0] * n
    order[0] = n - 1
    for at in range(n):
        end = order[at]
        j = end - 1
        while j >= 0 and j + length[group[j]] == end:
            order[place[group[j]]] = j
            place[group[j]] += 1
            j = smaller[j]
    return order[1:]


def common_prefixes(text: list[int], order: list[int]) -> list[int]:
    """At k: how many symbols the suffixes order[k - 1] and order[k] share from their start (0 at 0)."""
    n = len(text)
    rank = [0] * n
    for k, i in enumerate(order):
        rank[i] = k
    out, h = [0] * n, 0
    for i in range(n):
        if rank[i]:
            j = order[rank[i] - 1]
            most = n - max(i, j)
            while h < most and text[i + h] == text[j + h]:
                h += 1
            out[rank[i]] = h
            if h:
                h -= 1
        else:
            h = 0
    return out
