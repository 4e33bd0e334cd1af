"""What operator 12 does inside a task: cells of texts, and suffix sorting by a difference cover."""

from __future__ import annotations

import functools

import numpy as np

#: Texts are read in pieces of so many window starts.
PIECE = 1 << 18
PLACE_BITS = 20
#: Parameters of the two rolling hashes: odd multipliers, and the seed of the bytes' random values.
BASES, SEED = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F), 12


@functools.cache
def _tables(size: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each base: random values of the bytes, its powers and their inverses modulo 2^64."""
    rnd, out = np.random.default_rng(SEED), []
    for base in BASES:
        values = rnd.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        out.append((values, *both))
    return out


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _window_minima(v: np.ndarray, w: int) -> np.ndarray:
    """The least of each w neighbours."""
    x, size = v, 1
    while size * 2 <= w:
        x, size = np.minimum(x[:-size], x[size:]), size * 2
    return x if size == w else np.minimum(x[:len(v) - w + 1], x[w - size:])


def cells(text: bytes, window: int, gram: int):
    """(gram hash, cell hash, start, n) arrays of a text's cells, piece by piece.

    Every window start belongs to the gram in its window that has the least hash (the first of equal ones);
    a cell is a run of n starts that belong to one gram, and its text spans all their windows. Equal
    windows hold the same gram at the same distance, so they lie in cells of one gram hash.
    """
    b = np.frombuffer(text, np.uint8)
    w = window - gram + 1
    (values, power, inverse), (values2, power2, inverse2) = _tables(PIECE + window)
    low = np.uint64((1 << PLACE_BITS) - 1)
    for at in range(0, max(0, len(b) - window + 1), PIECE):
        x = b[at:at + PIECE + window - 1]
        sums, sums2 = np.zeros(len(x) + 1, np.uint64), np.zeros(len(x) + 1, np.uint64)
        np.cumsum(values[x] * power[:len(x)], out=sums[1:])
        np.cumsum(values2[x] * power2[:len(x)], out=sums2[1:])
        h = _mixed((sums[gram:] - sums[:-gram]) * inverse[:len(x) - gram + 1])
        places = (_window_minima((h & ~low) | np.arange(len(h), dtype=np.uint64), w) & low).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
        n = np.diff(np.append(first, len(places)))
        f = _mixed((sums2[first + n - 1 + window] - sums2[first]) * inverse2[first] + n.astype(np.uint64))
        yield h[places[first]].view(np.int64), f.view(np.int64), first + at, n


def suffix_ranks(s: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of all suffixes of ``s`` (values from 1) by their first ``depth`` symbols or more.

    The suffixes at places 1 and 2 modulo 3, a difference cover, are named by their triples; names that
    aren't unique are ranked by recursion. The others follow from one symbol and the rank after it, and are merged in.
    Suffixes that agree in ``depth`` symbols are neighbours in the order of ranks. Up to 2^21 - 4 symbols.
    """
    n = len(s)
    if n == 0:
        return np.zeros(0, np.int64)
    s = np.concatenate([s.astype(np.int64), np.zeros(5, np.int64)])
    k = int(s.max()) + 1
    ones, twos, zeros = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3), np.arange(0, n, 3)
    sample = np.concatenate([ones, twos])
    triples = (s[sample] * k + s[sample + 1]) * k + s[sample + 2]
    order = np.argsort(triples)
    names = np.empty(len(sample), np.int64)
    names[order] = np.cumsum(np.concatenate([[1], triples[order][1:] != triples[order][:-1]]))[:len(sample)]
    if depth > 3 and len(sample) and names[order[-1]] < len(sample):
        names = suffix_ranks(names, -(-depth // 3)) + 1
    rank = np.zeros(n + 5, np.int64)
    rank[sample] = names
    m = int(names.max(initial=0)) + 1
    near = s[zeros] * m + rank[zeros + 1]  # against places 1
    by_near = np.argsort(near)
    zeros, near = zeros[by_near], near[by_near]
    far = (s[zeros] * k + s[zeros + 1]) * m + rank[zeros + 2]  # against places 2; in order as well, but for ties
    ones = ones[ones < n]
    near1, far2 = s[ones] * m + rank[ones + 1], (s[twos] * k + s[twos + 1]) * m + rank[twos + 2]
    by_near1, by_far2 = np.argsort(near1), np.argsort(far2)
    fewer = np.cumsum(np.concatenate([[0], np.bincount(np.concatenate([rank[ones], rank[twos]]), minlength=m)]))
    out = np.empty(n, np.int64)
    out[zeros] = np.arange(len(zeros)) + np.searchsorted(near1[by_near1], near) + np.searchsorted(far2[by_far2], far)
    out[ones[by_near1]] = fewer[rank[ones[by_near1]]] + np.searchsorted(near, near1[by_near1])
    out[twos[by_far2]] = fewer[rank[twos[by_far2]]] + np.searchsorted(np.sort(far), far2[by_far2])
    return out


def repeated_starts(bodies: list[bytes], sizes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cell, place, group) of window starts whose windows occur more than once among the cells' texts.

    Cell i has the window starts 0 to sizes[i] - 1. Starts of one group have equal windows.
    """
    text = np.frombuffer(b"\0".join(bodies) + b"\0", np.uint8)
    length = np.fromiter(map(len, bodies), np.int64, len(bodies)) + 1
    begin = np.concatenate([[0], np.cumsum(length)[:-1]])
    symbols = text.astype(np.int64) + 2
    symbols[begin + length - 1] = 1
    cell = np.repeat(np.arange(len(bodies)), sizes)
    place = np.arange(len(cell)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = begin[cell] + place
    order = np.argsort(suffix_ranks(symbols, window)[at])
    at = at[order]
    same = np.zeros(len(at) + 1, bool)
    for lo in range(0, len(at) - 1, 1 << 16):  # neighbours whose first bytes are equal
        x = np.lib.stride_tricks.sliding_window_view(text, window)[at[lo:lo + (1 << 16) + 1]]
        same[lo + 1:lo + len(x)] = (x[1:] == x[:-1]).all(axis=1)
    keep = same[:-1] | same[1:]
    return cell[order][keep], place[order][keep], np.cumsum(~same[:-1])[keep]
