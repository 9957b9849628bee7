"""Suffix array by linear grouping: suffixes are grouped by their Lyndon prefix, then put in order.

Phase one holds groups as ranges of one array, lowest first, and visits them from the highest down.
For every suffix of a group it finds the previous suffix of a lower group; such a suffix begins with
what lies between, so it ranks above the others of its own group and moves to a new group above
them, the higher the more suffixes of the visited group point to it. Once all groups are visited,
suffixes share a group exactly if they share their Lyndon prefix. Phase two goes up the array: a
suffix that is in place puts those that it follows, found by the same pointers, in the next free
place of their groups. No names are recomputed and nothing recurses.
"""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """Order of the suffixes of ``text``, whose last symbol has to be smaller than all others."""
    n = len(text)
    if n < 2:
        return list(range(n))
    order = sorted(range(n), key=text.__getitem__)
    place = [0] * n  # of each suffix in order
    group = [0] * n  # first place of each suffix's group
    last = [0] * n  # last place of the group that begins at a place
    start = 0
    for i, suffix in enumerate(order):
        place[suffix] = i
        if text[suffix] != text[order[start]]:
            last[start] = i - 1
            start = i
        group[suffix] = start
    last[start] = n - 1

    previous = [-1] * n  # the nearest suffix before, of a lower group
    high = n - 1
    while high >= 0:
        low = group[order[high]]
        if low == high:
            own = order[low]
            at = own - 1
            while at >= 0 and group[at] >= low:
                at = previous[at]
            previous[own] = at
            if at >= 0:
                first = group[at]
                end = last[first]
                if end != first:
                    # Split off one suffix to the top of its group.
                    other, where = order[end], place[at]
                    order[where], order[end] = other, at
                    place[other], place[at] = where, end
                    last[first] = end - 1
                    group[at] = last[end] = end
        else:
            pointed: dict[int, int] = {}
            for own in sorted(order[low : high + 1]):
                at = own - 1
                while at >= 0 and group[at] >= low:
                    at = previous[at]
                previous[own] = at
                if at >= 0:
                    pointed[at] = pointed.get(at, 0) + 1
            level = list(pointed)
            count = 0
            while level:
                count += 1
                moved: dict[int, int] = {}  # by old group: the place its new group begins at
                for at in level:
                    first = group[at]
                    end = moved.get(first, last[first] + 1) - 1
                    other, where = order[end], place[at]
                    order[where], order[end] = other, at
                    place[other], place[at] = where, end
                    moved[first] = end
                for first, begin in moved.items():
                    if begin != first:
                        last[begin] = last[first]
                        last[first] = begin - 1
                        for i in range(begin, last[begin] + 1):
                            group[order[i]] = begin
                level = [at for at in level if pointed[at] > count]
        high = low - 1

    result, filled = [-1] * n, [0] * n  # filled: suffixes in place of the group that begins at a place
    taken = bytearray(n)
    result[0] = n - 1
    taken[n - 1] = 1
    for i in range(n):
        at = result[i] - 1
        while at >= 0 and not taken[at]:
            first = group[at]
            result[first + filled[first]] = at
            filled[first] += 1
            taken[at] = 1
            at = previous[at]
    return result
