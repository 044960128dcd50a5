"""Suffix arrays by induced sorting, and permuted longest common prefixes, over byte strings in numpy.

Suffixes are classified as smaller (S) or larger (L) than their right neighbour; the leftmost S of each run (LMS)
cuts the text into substrings.  One induced pass sorts these; equal ones get equal names, and the string of names is
sorted recursively: by pairs of names, pairs of pairs and so on, as long as equal ones are left.  A second pass
induces all suffixes from the sorted LMS suffixes.  Both passes go through the byte buckets in order and move whole
stretches at a time, so the Python work is per bucket and run, not per byte.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm.wordhash import BYTE_BITS, running, window_hash


def _smaller_types(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than its right neighbour; the last suffix is larger than the empty one."""
    size = len(text)
    step = np.zeros(size, np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1].astype(np.int16))
    step[-1] = -1
    decided = np.where(step != 0, np.arange(size), size)
    following = np.minimum.accumulate(decided[::-1])[::-1]
    return step[following] > 0


def _append(target: np.ndarray, heads: np.ndarray, text: np.ndarray, items: np.ndarray, down: bool) -> None:
    """Put items into their byte's bucket in order, upwards from the heads or downwards from the tails."""
    keys = text[items]
    order = np.argsort(keys, kind="stable")
    counts = np.bincount(keys, minlength=256)
    within = np.arange(len(items)) - np.repeat(np.cumsum(counts) - counts, counts)
    base = np.repeat(heads, counts)
    target[base - 1 - within if down else base + within] = items[order]
    heads += -counts if down else counts


def _induce(text: np.ndarray, small: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """All suffixes in order, given the LMS suffixes in order (or their substrings, given any order)."""
    size = len(text)
    counts = np.bincount(text, minlength=256)
    starts = np.concatenate([[0], np.cumsum(counts)])
    result = np.zeros(size, np.int32)
    keys = text[lms]
    by_byte = lms[np.argsort(keys, kind="stable")]
    cuts = np.concatenate([[0], np.cumsum(np.bincount(keys, minlength=256))])
    heads = starts[:-1].copy()
    _append(result, heads, text, np.array([size - 1], np.int32), False)  # the last suffix follows the empty one
    present = np.flatnonzero(counts).tolist()
    for byte in present:
        done = int(starts[byte])
        while done < heads[byte]:
            front = result[done:heads[byte]]
            done = int(heads[byte])
            before = front[front > 0] - 1
            before = before[~small[before]]
            if len(before):
                _append(result, heads, text, before, False)
        before = by_byte[cuts[byte]:cuts[byte + 1]]
        before = before[before > 0] - 1
        if len(before):
            _append(result, heads, text, before, False)
    larger_end = heads
    tails = starts[1:].copy()
    for byte in reversed(present):
        done = int(starts[byte + 1])
        while done > tails[byte]:
            front = result[tails[byte]:done][::-1]
            done = int(tails[byte])
            before = front[front > 0] - 1
            before = before[small[before]]
            if len(before):
                _append(result, tails, text, before, True)
        front = result[starts[byte]:larger_end[byte]][::-1]
        before = front[front > 0] - 1
        before = before[small[before]]
        if len(before):
            _append(result, tails, text, before, True)
    return result


def _sort_names(names: np.ndarray) -> np.ndarray:
    """Suffix array of the string of names: names of pairs, of pairs of pairs, ..., for those not yet told apart."""
    size = len(names)
    order = np.argsort(names, kind="stable")
    rank = np.zeros(size, np.int64)
    places = np.arange(size)
    first = np.ones(size, bool)
    first[1:] = names[order][1:] != names[order][:-1]
    rank[order] = np.maximum.accumulate(np.where(first, places, 0))
    ends = np.append(first[1:], True)
    open_places = np.flatnonzero(~(first & ends))
    step = 1
    while len(open_places):
        items = order[open_places]
        beyond = items + step
        second = np.where(beyond < size, rank[np.minimum(beyond, size - 1)] + 1, 0)
        key = rank[items] * (size + 1) + second
        by_key = np.argsort(key, kind="stable")
        items, key = items[by_key], key[by_key]
        order[open_places] = items
        first = np.ones(len(items), bool)
        first[1:] = key[1:] != key[:-1]
        rank[items] = np.maximum.accumulate(np.where(first, open_places, 0))
        ends = np.append(first[1:], True)
        open_places = open_places[~(first & ends)]
        step *= 2
    return order


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of a byte string in lexicographic order; a prefix comes before its extensions."""
    size = len(text)
    if size < 2:
        return np.arange(size, dtype=np.int32)
    small = _smaller_types(text)
    is_lms = small.copy()
    is_lms[0] = False
    is_lms[1:] &= ~small[:-1]
    lms = np.flatnonzero(is_lms).astype(np.int32)
    if len(lms) < 2:
        return _induce(text, small, lms)
    rough = _induce(text, small, lms)
    rough = rough[is_lms[rough]]
    # An LMS substring reaches to the next LMS position, that one included; the last one to the end.
    stop = np.zeros(size, np.int32)
    stop[lms] = np.append(lms[1:] + 1, size)
    sums = running(BYTE_BITS[text])
    content, length = window_hash(sums, rough, stop[rough]), stop[rough] - rough
    differs = np.ones(len(rough), bool)
    differs[1:] = (content[1:] != content[:-1]) | (length[1:] != length[:-1])
    last = rough == lms[-1]  # it ends in the empty suffix, which no other does
    differs |= last
    differs[1:] |= last[:-1]
    if differs.all():
        return _induce(text, small, rough)
    name = np.zeros(size, np.int64)
    name[rough] = np.cumsum(differs)
    return _induce(text, small, lms[_sort_names(name[lms])])


def permuted_common_prefixes(text: np.ndarray, order: np.ndarray, least: int = 0) -> np.ndarray:
    """For each position the length it shares with the suffix before its own in the suffix array.

    Where the bytes before both suffixes agree, the length is one less than that of the position before; all other
    positions are compared directly, eight bytes at a time.  Lengths under ``least`` may come out smaller: positions
    whose next ``least`` bytes have another hash than their neighbour's are not compared.
    """
    size = len(text)
    if size == 0:
        return np.zeros(0, np.int64)
    before = np.full(size, -1, np.int64)
    before[order[1:]] = order[:-1]
    places = np.arange(size)
    reducible = (before > 0) & (places > 0)
    reducible[1:] &= text[:-1] == text[np.maximum(before[1:] - 1, 0)]
    direct = np.flatnonzero(~reducible & (before >= 0))
    if least:
        direct = direct[np.maximum(direct, before[direct]) <= size - least]
        sums = running(BYTE_BITS[text])
        direct = direct[window_hash(sums, direct, direct + least)
                        == window_hash(sums, before[direct], before[direct] + least)]
    padded = np.concatenate([text, np.zeros(16, np.uint8)])
    words = np.zeros(size + 8, np.uint64)
    for k in range(8):
        words |= padded[k:k + size + 8].astype(np.uint64) << np.uint64(8 * k)
    length = np.zeros(size, np.int64)
    one, other = direct, before[direct]
    most = size - np.maximum(one, other)
    active, offset = np.arange(len(direct)), 0
    found = np.zeros(len(direct), np.int64)
    while len(active):
        differ = words[one[active] + offset] ^ words[other[active] + offset]
        ended = differ != 0
        if ended.any():
            lowest = differ[ended] & (~differ[ended] + np.uint64(1))
            found[active[ended]] = offset + np.bitwise_count(lowest - np.uint64(1)).astype(np.int64) // 8
        offset += 8
        at_end = ~ended & (offset >= most[active])
        found[active[at_end]] = offset
        active = active[~ended & ~at_end]
    length[direct] = np.minimum(found, most)
    anchor = np.maximum.accumulate(np.where(reducible, 0, places))
    return np.maximum(length[anchor] - (places - anchor), 0)


def repeated_starts(text: np.ndarray, width: int) -> np.ndarray:
    """Positions whose next ``width`` bytes also start at another position."""
    order = suffix_array(text)
    common = permuted_common_prefixes(text, order, width)
    repeated = common >= width
    follows = order[1:]
    repeated[order[:-1][common[follows] >= width]] = True
    return repeated
