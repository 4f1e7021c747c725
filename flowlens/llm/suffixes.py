"""Suffix arrays by the linear grouping construction.

Suffixes start out in groups by their first symbol.  Groups are taken in descending
order.  For each suffix of a group, its previous-smaller pointer names the nearest
suffix to the left that lies in a lower group; all that lies between has been taken
already and belongs to the longest Lyndon prefix of what the pointer names.  Suffixes
named most often by the group move behind their own group first, then those named
once less, so every group comes to hold the suffixes of one Lyndon prefix.  A second
pass over the growing suffix array then puts the suffixes of each group in order: who
precedes a placed suffix is the next of its own group, and the pointers lead on from
there.  Nothing is renamed and nothing recurses; every pointer is followed once.
"""

from __future__ import annotations

from collections import Counter

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in ascending order.

    ``symbols`` are non-negative integers.  The last must be smaller than all others;
    an empty array has an empty result.
    """
    count = len(symbols)
    if count == 0:
        return np.zeros(0, np.int64)
    order = np.argsort(symbols, kind="stable")
    ranked = symbols[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    if len(first) > 1 and first[1] != 1 or order[0] != count - 1:
        raise ValueError("the last symbol must be the only smallest one")
    group_of = np.repeat(first, np.diff(np.append(first, count)))
    place = np.empty(count, np.int64)
    place[order] = np.arange(count)
    group = group_of[place].tolist()  # of each suffix, the place where its group begins
    size = [0] * count  # of each group, by that place
    for begin, length in zip(first.tolist(), np.diff(np.append(first, count)).tolist()):
        size[begin] = length
    place = place.tolist()
    slots = order.tolist()  # the suffixes, group after group
    before = [-1] * count
    _group_by_lyndon_prefix(slots, place, group, size, before)
    return np.array(_in_order(count, group, before), dtype=np.int64)


def _group_by_lyndon_prefix(slots: list, place: list, group: list, size: list, before: list) -> None:
    end = len(slots)
    while end > 0:
        begin = end - 1
        suffix = slots[begin]
        if group[suffix] == begin:
            # A group of one names one suffix.
            left = suffix - 1
            while left >= 0 and group[left] > begin:
                left = before[left]
            before[suffix] = left
            end = begin
            if left >= 0:
                own = group[left]
                length = size[own]
                if length > 1:
                    tail = own + length - 1
                    other = slots[tail]
                    if other != left:
                        at = place[left]
                        slots[at], place[other] = other, at
                        slots[tail], place[left] = left, tail
                    group[left] = tail
                    size[own], size[tail] = length - 1, 1
            continue
        begin = group[suffix]
        # Pointers of one group are set from left to right, so that a suffix of the
        # same group on the way has its pointer already.
        members = slots[begin:end]
        members.sort()
        named: list[int] = []
        for suffix in members:
            left = suffix - 1
            while left >= 0 and group[left] >= begin:
                left = before[left]
            before[suffix] = left
            if left >= 0:
                named.append(left)
        end = begin
        if len(set(named)) == len(named):
            levels = [named]
        else:
            by_times: dict[int, list] = {}
            for left, times in Counter(named).items():
                by_times.setdefault(times, []).append(left)
            levels = [by_times[times] for times in sorted(by_times, reverse=True)]
        for chosen in levels:
            moved: dict[int, list] = {}
            for left in chosen:
                own = group[left]
                if own in moved:
                    moved[own].append(left)
                else:
                    moved[own] = [left]
            for own, suffixes in moved.items():
                length, count = size[own], len(suffixes)
                if count == length:
                    continue  # the whole group moves behind itself
                # The chosen ones change places with the others at the group's end.
                tail = own + length
                fresh = tail - count
                for suffix in suffixes:
                    tail -= 1
                    other = slots[tail]
                    if other != suffix:
                        at = place[suffix]
                        slots[at], place[other] = other, at
                        slots[tail], place[suffix] = suffix, tail
                    group[suffix] = fresh
                size[own], size[fresh] = length - count, count


def _in_order(count: int, group: list, before: list) -> list:
    found = [-1] * count
    found[0] = count - 1
    follows = list(range(count))  # of each group, the next free place
    follows[0] = 1
    placed = bytearray(count)
    placed[count - 1] = 1
    for rank in range(count):
        suffix = found[rank] - 1
        while suffix >= 0 and not placed[suffix]:
            own = group[suffix]
            at = follows[own]
            found[at] = suffix
            follows[own] = at + 1
            placed[suffix] = 1
            suffix = before[suffix]
    return found
