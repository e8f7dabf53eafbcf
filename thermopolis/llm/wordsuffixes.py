"""Suffix arrays over the words of several texts, by prefix doubling in whole-array operations."""

from __future__ import annotations

import numpy as np

#: Suffixes that share fewer words with every other one are left out.
BLOCK = 8


def groups(keys: np.ndarray, where: np.ndarray):
    """``where`` by ascending key, the first index of each one's group, and whether it has others."""
    by = np.argsort(keys, kind="stable")
    keys, where = keys[by], where[by]
    new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(new, len(keys)))
    return where, np.repeat(new, sizes), np.repeat(sizes, sizes) > 1


def _halves(rank: np.ndarray, ends: np.ndarray, where: np.ndarray, length: int) -> np.ndarray:
    """A key for the first ``2 * length`` words of each suffix; one whose text ends before is alone."""
    n = len(rank)
    fits = ends[where] - where >= 2 * length
    return rank[where] * (2 * n) + np.where(fits, rank[np.minimum(where + length, n - 1)], where + n)


def shared_suffixes(words: np.ndarray, ends: np.ndarray, scope: np.ndarray):
    """(array, first, rank): the suffixes that share BLOCK words with another one of their scope, equal
    beginnings side by side, the index in the array where each one's group begins, and for every word
    that index, or a number of its own if its suffix is not in the array.

    ``ends`` holds for each word where its text ends, ``scope`` a whole number of 0 or more.
    """
    n, length = len(words), 1
    active = np.arange(n, dtype=np.int64)
    array, first, shared = groups(scope.astype(np.int64) * (int(words.max(initial=0)) + 1) + words, active)
    while True:
        active = array[shared]
        rank = np.arange(n, 2 * n, dtype=np.int64)
        rank[active] = first[shared]
        if length == BLOCK:
            break
        array, first, shared = groups(_halves(rank, ends, active, length), active)
        length *= 2
    array, first, _ = groups(rank[active], active)
    rank[array] = first
    return array, first, rank


def suffix_array(words: np.ndarray, ends: np.ndarray, scope: np.ndarray):
    """(array, levels): the array of ``shared_suffixes`` in full order, suffixes with equal beginnings of
    any dyadic length side by side; and for each such length with repeats (length, starts, left, right):
    its aligned blocks that occur again in their scope and the interval of the array where they stand.

    A suffix that has become unique is not sorted again.
    """
    array, _, rank = shared_suffixes(words, ends, scope)
    length, slots, levels = BLOCK, np.arange(len(array)), []
    while len(slots):
        starts = array[slots]
        aligned = starts % length == 0
        left = rank[starts]
        right = left + np.bincount(left, minlength=len(array))[left]
        levels.append((length, starts[aligned], left[aligned], right[aligned]))
        # The slots of a group stay its own, so its suffixes are put in order where they stand.
        where, first, shared = groups(_halves(rank, ends, starts, length), starts)
        array[slots], length = where, 2 * length
        rank[where] = slots[first]
        slots = slots[shared]
    return array, levels
