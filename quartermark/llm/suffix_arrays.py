"""Suffix arrays of a shard of separate strings, in numpy.

Every string ends in a sentinel of its own, smaller than all symbols, so no
two suffixes are equal and no common prefix runs over the end of a string.
"""

from __future__ import annotations

import numpy as np

# Places that are walked one after another; many of these stretches are walked at once.
STRETCH = 32


def with_sentinels(symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Strings that lie one after another, with 0 after each: text, first place of each, place of each 0.

    ``symbols`` are at least 1.
    """
    first = np.cumsum(sizes + 1) - (sizes + 1)
    text = np.zeros(len(symbols) + len(sizes), np.int64)
    ends = first + sizes
    inside = np.ones(len(text), bool)
    inside[ends] = False
    text[inside] = symbols
    return text, first, ends


def packed(text: np.ndarray, first: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, int, int, np.ndarray]:
    """The next few symbols of each place in one number, 0 from the sentinel on.

    With it come how many symbols that are, the bits of each, and how many lie before the sentinel.
    """
    n = len(text)
    bits = max(1, int(text.max()).bit_length()) if n else 1
    depth = max(1, 62 // bits)
    rest = np.repeat(ends, ends - first + 1) - np.arange(n)
    key = np.zeros(n, np.int64)
    padded = np.concatenate([text, np.zeros(depth, np.int64)])
    for k in range(depth):
        key <<= bits
        key |= padded[k : k + n]
    over = np.flatnonzero(rest < depth)
    unused = bits * (depth - rest[over])
    key[over] = (key[over] >> unused) << unused
    return key, depth, bits, rest


def suffix_array(text: np.ndarray, first: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Larsson-Sadakane: the suffix array and the rank of every place.

    Suffixes are sorted by their first few symbols. Then only places in groups
    of equal rank are sorted again, each by the rank of the place that lies as
    far ahead as is sorted already, and that distance doubles with every round.
    """
    n = len(text)
    key, depth, _, rest = packed(text, first, ends)
    end_of = rest + np.arange(n)
    order = np.argsort(key)
    order[: len(ends)] = ends  # the sentinels come first, in the order of their strings
    ordered = key[order]
    new = np.ones(n, bool)
    new[1:] = ordered[1:] != ordered[:-1]
    new[: len(ends)] = True
    slots = np.arange(n)
    rank = np.empty(n, np.int64)
    start = np.maximum.accumulate(np.where(new, slots, 0))
    rank[order] = start
    alone = new & np.append(new[1:], True)
    open_slots = slots[~alone]
    width = n.bit_length()
    while len(open_slots):
        places = order[open_slots]
        ahead = rank[np.minimum(places + depth, end_of[places])]
        # Groups lie one after another, so sorting by group and the rank ahead keeps them in their slots.
        both = (rank[places] << width) | ahead
        if 3 * width <= 63:  # with the number of the row in the same value, which sorts faster than an order of rows
            both = (both << width) | slots[: len(both)]
            both.sort()
            by = both & ((1 << width) - 1)
            both >>= width
        else:
            by = np.argsort(both)
            both = both[by]
        places = places[by]
        order[open_slots] = places
        new = np.ones(len(places), bool)
        new[1:] = both[1:] != both[:-1]
        rank[places] = open_slots[np.maximum.accumulate(np.where(new, slots[: len(places)], 0))]
        alone = new & np.append(new[1:], True)
        open_slots = open_slots[~alone]
        depth *= 2
    return order, rank


def common_prefixes(text: np.ndarray, first: np.ndarray, ends: np.ndarray, order: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Kasai: for each place, how many symbols it shares with the suffix sorted before it.

    What a place shares is at least one less than what the place before it
    shared. Stretches of all strings are walked at once, one step for each
    place of a stretch, and symbols are compared several at a time.
    """
    out = np.zeros(len(text), np.int32)
    key, depth, bits, rest = packed(text, first, ends)
    parts = -(-(ends - first) // STRETCH)
    begin = np.repeat(first, parts) + STRETCH * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    size = np.minimum(rest[begin], STRETCH)
    longest = np.argsort(-size, kind="stable")
    size, begin = size[longest], begin[longest]
    shared = np.zeros(len(begin), np.int64)
    for step in range(STRETCH):
        live = int(np.searchsorted(-size, -step, "left"))  # stretches with more than ``step`` symbols
        if not live:
            break
        place, h = begin[:live] + step, shared[:live]
        before = order[rank[place] - 1]  # never the first slot, which a sentinel holds
        most = np.minimum(rest[place], rest[before])  # a sentinel never agrees with another
        grow = np.flatnonzero(h < most)
        while len(grow):
            grow = grow[key[place[grow] + h[grow]] == key[before[grow] + h[grow]]]
            h[grow] += depth
            grow = grow[h[grow] < most[grow]]
        last = np.flatnonzero(h < most)
        differ = key[place[last] + h[last]] ^ key[before[last] + h[last]]
        equal = np.zeros(len(last), np.int64)
        for k in range(1, depth):
            equal += differ < 1 << (bits * k)
        h[last] += equal
        np.minimum(h, most, out=h)
        out[place] = h
        np.maximum(h - 1, 0, out=h)
    return out
