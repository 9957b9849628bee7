"""Context-tree weighting over bytes: the arithmetic of one sorted range of grams.

A gram is the ``depth`` bytes before a position and the byte at it, as one integer: the latest byte
first, then older ones, the predicted byte last. Sorted, the contexts that share their latest bytes
lie together. The predicted byte is cut to eight binary decisions; a decision is a node (the bits
decided so far, with a leading one) and has a context tree of its own, whose tree nodes hold the
counts of zeros and ones. Only decisions of one bit number are held at a time.

Every tree node weighs its own Krichevsky-Trofimov estimate against its children:
``P_w = (P_kt + product of the children's P_w) / 2``. After training the weight ``w`` of the own
estimate, ``P_kt / (P_kt + product)``, is fixed, and the probability of a bit is
``w * kt + (1 - w) * (that of the child on the path)``. At the full depth, and where the child on the
path has no counts, ``w`` counts as one: a context never seen takes the estimate of its parent.

Contexts at either end of a range may go on in the next one. Their counts and the sums of their
finished children are handed out (``edges``), merged (``merge``) and handed back to ``code_lengths``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BITS = 8
LOG_PI, LOG_2 = float(np.log(np.pi)), float(np.log(2.0))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log-gamma for x > 0: Stirling's series after a shift by eight."""
    z = x + 8
    product = x.copy()
    for k in range(1, 8):
        product *= x + k
    inverse = 1 / z
    square = inverse * inverse
    tail = inverse * (1 / 12 - square * (1 / 360 - square * (1 / 1260 - square / 1680)))
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + tail - np.log(product)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural logarithm of the Krichevsky-Trofimov probability of any sequence with these counts."""
    z, o = zeros.astype(float), ones.astype(float)
    return log_gamma(z + 0.5) + log_gamma(o + 0.5) - log_gamma(z + o + 1) - LOG_PI


def grams(pieces: list[tuple[bytes, bytes]], depth: int) -> np.ndarray:
    """The gram at every byte of every piece; a piece comes with the ``depth`` bytes before it."""
    data = np.frombuffer(b"".join([x for piece in pieces for x in piece]), np.uint8)
    code = data.astype(np.int64)
    for j in range(1, depth + 1):
        code[j:] |= data[:-j].astype(np.int64) << (8 * (depth - j + 1))
    lengths = np.fromiter((len(p[1]) + depth for p in pieces), np.int64, len(pieces))
    starts = np.cumsum(lengths) - lengths
    inside = np.ones(len(data), bool)
    inside[(starts[:, None] + np.arange(depth)).ravel()] = False
    return code[inside]


@dataclass
class Level:
    """Tree nodes of one depth and bit: ``key`` is the context, then the decided bits with a leading one."""

    key: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    parent: np.ndarray | None = None  # index in the next shallower level
    below: np.ndarray | None = None  # sum of the children's log P_w
    own: np.ndarray | None = None  # weight of the own estimate


def _sums(key: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the sum of values of each, and the place of every row's key."""
    distinct, place = np.unique(key, return_inverse=True)
    return distinct, np.bincount(place, values, len(distinct)), place


class Range:
    """The grams of one range (sorted, distinct) with their training counts, which may be zero."""

    def __init__(self, gram: np.ndarray, count: np.ndarray, depth: int):
        self.gram, self.depth = gram, depth
        #: For each depth the distinct (context, byte) codes with their counts.
        self.symbols = {depth: (gram, count.astype(float))}
        for d in range(depth - 1, -1, -1):
            code, n = self.symbols[d + 1]
            distinct, total, _ = _sums(code >> 16 << 8 | code & 255, n)
            self.symbols[d] = (distinct, total)
        first, last = int(gram[0]) >> 8, int(gram[-1]) >> 8
        self.ends = [{first >> 8 * (depth - d), last >> 8 * (depth - d)} for d in range(depth + 1)]

    def levels(self, bit: int) -> list[Level]:
        """Counts of every tree node for decisions of this bit number, shallow first."""
        out = []
        for d in range(self.depth + 1):
            code, n = self.symbols[d]
            symbol = code & 255
            key = code >> 8 << 8 | symbol >> (8 - bit) | 1 << bit
            one = (symbol >> (7 - bit) & 1).astype(bool)
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])  # sorted by context and byte
            zeros = np.add.reduceat(np.where(one, 0.0, n), starts)
            ones = np.add.reduceat(np.where(one, n, 0.0), starts)
            out.append(Level(key[starts], zeros, ones))
        for upper, lower in zip(out, out[1:]):
            lower.parent = np.searchsorted(upper.key, lower.key >> 16 << 8 | lower.key & 255)
        return out

    def _at_end(self, level: Level, d: int) -> np.ndarray:
        return np.isin(level.key >> 8, list(self.ends[d]))

    def _weigh(self, levels: list[Level], known: list[dict[str, np.ndarray]] | None) -> None:
        """Fill ``below`` and ``own``, deep first. Nodes at the ends take merged values, or none if not yet merged."""
        value = None
        for d in range(self.depth, -1, -1):
            level = levels[d]
            if d == self.depth:
                level.below = np.zeros(len(level.key))
            else:
                level.below = np.bincount(levels[d + 1].parent, value, len(level.key))
            edge = self._at_end(level, d)
            if known is not None and edge.any():
                place = np.searchsorted(known[d]["key"], level.key[edge])
                for name in ("zeros", "ones", "below"):
                    getattr(level, name)[edge] = known[d][name][place]
            value, level.own = weigh(level.zeros, level.ones, level.below, d == self.depth)
            if known is None:
                value = np.where(edge, 0.0, value)  # a parent at the end gets it after the merge

    def edges(self) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Per depth and bit, nodes that other ranges may share: (depth, key, zeros, ones, sum below)."""
        out = []
        for bit in range(BITS):
            levels = self.levels(bit)
            self._weigh(levels, None)
            for d, level in enumerate(levels):
                chosen = self._at_end(level, d) & (level.zeros + level.ones > 0)
                out.append((d, level.key[chosen], level.zeros[chosen], level.ones[chosen], level.below[chosen]))
        return out

    def code_lengths(self, known: list[list[dict[str, np.ndarray]]]) -> np.ndarray:
        """log10 of the probability of each gram's last byte after its context."""
        total = np.zeros(len(self.gram))
        symbol = self.gram & 255
        for bit in range(BITS):
            levels = self.levels(bit)
            self._weigh(levels, self._with_all(levels, known[bit]))
            # so_far: what shallower levels gave; rest: the weight left; final: the probability if none is deeper.
            so_far, rest, final = np.zeros(1), np.ones(1), np.full(1, 0.5)
            for d, level in enumerate(levels):
                parent = level.parent if d else np.zeros(len(level.key), np.int64)
                seen = level.zeros + level.ones > 0
                kt = (level.ones + 0.5) / (level.zeros + level.ones + 1)
                final = np.where(seen, so_far[parent] + rest[parent] * kt, final[parent])
                so_far = so_far[parent] + rest[parent] * level.own * kt
                rest = rest[parent] * (1 - level.own)
            deepest = levels[-1]
            place = np.searchsorted(deepest.key, self.gram >> 8 << 8 | symbol >> (8 - bit) | 1 << bit)
            p = final[place]
            total += np.log10(np.where(symbol >> (7 - bit) & 1, p, 1 - p))
        return total

    def _with_all(self, levels: list[Level], known: list[dict[str, np.ndarray]]) -> list[dict[str, np.ndarray]]:
        """Merged nodes at the ends of this range, with empty ones for nodes that training never saw."""
        out = []
        for d, level in enumerate(levels):
            mine = level.key[self._at_end(level, d)]
            table = known[d]
            place = np.minimum(np.searchsorted(table["key"], mine), max(len(table["key"]) - 1, 0))
            found = table["key"][place] == mine if len(table["key"]) else np.zeros(len(mine), bool)
            own = {"key": mine}
            for name in ("zeros", "ones", "below"):
                own[name] = np.where(found, table[name][place], 0.0) if len(table["key"]) else np.zeros(len(mine))
            out.append(own)
        return out


def weigh(zeros: np.ndarray, ones: np.ndarray, below: np.ndarray, deepest: bool) -> tuple[np.ndarray, np.ndarray]:
    """log P_w of nodes and the weight of their own estimate."""
    own = log_kt(zeros, ones)
    if deepest:
        return own, np.ones(len(own))
    value = np.logaddexp(own, below) - LOG_2
    value = np.where(zeros + ones > 0, value, 0.0)
    return value, np.exp(np.minimum(own - value - LOG_2, 0.0))


def merge(pieces: list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]], depth: int) -> list[list[dict[str, np.ndarray]]]:
    """Tables of the shared nodes, by bit and depth, from the pieces of all ranges.

    From the deepest level up, a merged node's value goes to its parent, which is shared as well: a
    context that reaches the end of a range does so with all its shorter forms.
    """
    whole: list[dict[str, np.ndarray]] = []
    carried: tuple[np.ndarray, np.ndarray] | None = None
    for d in range(depth, -1, -1):
        own = [p for p in pieces if p[0] == d]
        columns = [np.concatenate([p[i] for p in own]) if own else np.zeros(0, np.int64 if i == 1 else float) for i in range(1, 5)]
        key, place = np.unique(columns[0], return_inverse=True)
        zeros, ones, below = (np.bincount(place, c, len(key)) for c in columns[1:])
        if carried is not None:
            below = below + np.bincount(np.searchsorted(key, carried[0]), carried[1], len(key))
        value, _ = weigh(zeros, ones, below, d == depth)
        whole.append({"key": key, "zeros": zeros, "ones": ones, "below": below})
        carried = (key >> 16 << 8 | key & 255, value)
    whole.reverse()
    by_bit = []
    for bit in range(BITS):
        chosen = [(t["key"] & 255) >> bit == 1 for t in whole]
        by_bit.append([{n: v[c] for n, v in t.items()} for t, c in zip(whole, chosen)])
    return by_bit
