"""A compressed FM-index over one shard of word sequences, in numpy.

The index holds the Burrows-Wheeler transform of the shard as a wavelet tree laid out
level by level (a wavelet matrix), one bit vector a level. The tree is shaped by a prefix code: a frequent word
has a short code and lies on few levels, so index and searches take about the entropy of the words. The text itself
and the suffix order are not kept. Suffixes are sorted to ``depth`` words, which is enough
for patterns up to that length. All searches advance together, one word a step.
"""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)
LONG = 8  # words of a stretch from which what lies before it is searched from the right too
_BITS = _ONE << np.arange(64, dtype=np.uint64)
_BELOW = _BITS - _ONE


class _Bits:
    """A compressed bit vector with constant-time rank.

    Only 64-bit blocks with both zeros and ones are stored, each with the ones in the stored blocks before it. All other
    blocks are runs of equal bits, of which the transform of repetitive text has many; they cost two bits each, which tell
    for a group of 64 blocks which are stored and which are full of ones. Where over three quarters of the blocks hold both,
    leaving out the others saves little: all are stored, and rank takes half the steps.
    """

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.packbits(bits, bitorder="little")
        blocks = np.zeros(-(-(n + 1) // 4096) * 64, np.uint64)  # whole groups
        blocks.view(np.uint8)[: len(packed)] = packed
        ones = np.bitwise_count(blocks)
        self.zeros = n - int(ones.sum(dtype=np.int64))
        mixed, full = (ones > 0) & (ones < 64), ones == 64
        used = n // 64 + 1
        self.dense = 4 * int(mixed.sum()) > 3 * used
        if self.dense:
            self.stored = blocks[:used].copy()
            self.ones_before = np.concatenate([[0], np.cumsum(ones[:used - 1], dtype=np.int64)]).astype(np.int32)
            return
        self.stored = np.append(blocks[mixed], np.uint64(0))
        self.ones_before = np.concatenate([[0], np.cumsum(ones[mixed], dtype=np.int64)]).astype(np.int32)
        self.mixed, self.mixed_before = _groups(mixed)
        self.full, self.full_before = _groups(full)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position, in an array of any shape."""
        block = at >> 6
        if self.dense:
            return self.ones_before.take(block) + np.bitwise_count(self.stored.take(block) & _BELOW.take(at & 63))
        group = block >> 6
        place = (block & 63).astype(np.uint64)
        bit, behind = _BITS.take(place), _BELOW.take(place)
        mixed, full = self.mixed.take(group), self.full.take(group)
        slot = self.mixed_before.take(group) + np.bitwise_count(mixed & behind)
        runs = self.full_before.take(group) + np.bitwise_count(full & behind)
        offset = at & 63
        part = np.bitwise_count(self.stored.take(slot) & _BELOW.take(offset))
        part[(mixed & bit) == 0] = 0
        np.copyto(part, offset, where=(full & bit) != 0, casting="unsafe")
        return self.ones_before.take(slot) + (runs << 6) + part

    @property
    def nbytes(self) -> int:
        groups = () if self.dense else (self.mixed, self.mixed_before, self.full, self.full_before)
        return sum(x.nbytes for x in (self.stored, self.ones_before, *groups))


def _groups(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The marks as one word per group of 64 blocks, and the marks before each group."""
    words = np.packbits(marks, bitorder="little").view(np.uint64)
    counts = np.bitwise_count(words)
    return words, (np.cumsum(counts, dtype=np.int64) - counts).astype(np.int32)


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffix starts sorted by their first ``depth`` symbols or more (prefix doubling, only of suffixes still tied)."""
    n = len(symbols)
    rank = symbols.astype(np.int64) + 1
    order, tied, width = np.arange(n), np.arange(n), 0
    second = np.zeros(n, np.int64)  # by the first symbol
    while True:
        at = order[tied]
        key = rank[at] * np.int64(max(n, int(rank.max())) + 2) + second
        by = np.argsort(key)
        at, key = at[by], key[by]
        order[tied] = at
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[at] = tied[np.flatnonzero(new)[np.cumsum(new) - 1]]  # the first place of the suffix's group
        width = 2 * width or 1
        tied = tied[~(new & np.append(new[1:], True))]
        if width >= depth or not len(tied):
            return order
        at = order[tied] + width
        second = np.where(at < n, rank[np.minimum(at, n - 1)] + 1, 0)


def code_lengths(counts: np.ndarray) -> np.ndarray:
    """Lengths of the words of a prefix code for symbols that occur so often: Shannon's, cut as far as Kraft's inequality allows."""
    bits = np.log2(counts.sum() / counts)
    for cut in np.arange(15, -1, -1) / 16:
        lengths = np.maximum(1, np.ceil(bits - cut)).astype(np.uint8)
        if np.exp2(-lengths.astype(float)).sum() <= 1:
            return lengths
    raise AssertionError("Shannon's lengths always fit")


def prefix_code(lengths: np.ndarray) -> np.ndarray:
    """The code words, at the upper end of 32 bits. On each level of a wavelet matrix the symbols that end there come last,
    so they are cut off and the places of the others stay."""
    codes = np.zeros(len(lengths), np.uint32)
    nodes = np.zeros(1, np.uint32)  # open nodes in the matrix's order
    for level in range(1, int(lengths.max()) + 1):
        nodes = np.concatenate([nodes << 1, nodes << 1 | 1])
        here = np.flatnonzero(lengths == level)
        inner = len(nodes) - len(here)
        codes[here] = nodes[inner:] << (32 - level)
        needed = int(np.ceil(np.exp2(level - lengths[lengths > level].astype(float)).sum()))
        nodes = nodes[:min(inner, needed)]
    return codes


class FMIndex:
    """Finds stretches of words that occur twice or more in ``sequences`` (arrays of 64-bit word hashes).

    ``copied`` marks the sequences that stand for two or more equal ones: each place in them counts twice. ``depth`` is the
    greatest length of a stretch that is asked for.
    """

    def __init__(self, sequences: list[np.ndarray], depth: int, copied: np.ndarray | None = None):
        lengths = np.array([len(s) for s in sequences], np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]  # each is followed by a separator
        self.alphabet, ids = np.unique(np.concatenate(sequences), return_inverse=True)
        text = np.zeros(int(lengths.sum() + len(lengths)), np.int64)  # 0 separates
        inside = np.ones(len(text), bool)
        inside[starts + lengths] = False
        text[inside] = ids + 1
        self.size = len(text)
        sigma = len(self.alphabet) + 1
        order = suffix_order(text, depth)
        twice = np.zeros(len(lengths), np.uint8) if copied is None else np.asarray(copied).astype(np.uint8)
        self.twice = _Bits(np.repeat(twice, lengths + 1)[order])
        bwt = text[order - 1]  # the word before each suffix; before the first comes the last separator
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        counts = np.bincount(text, minlength=sigma)
        self.lengths = code_lengths(counts)
        self.codes = prefix_code(self.lengths)
        self.levels: list[_Bits] = []
        rest = self.codes[bwt]
        for level in range(int(self.lengths.max())):
            bit = (rest >> (31 - level) & 1).astype(bool)
            self.levels.append(_Bits(bit))
            rest = np.concatenate([rest[~bit], rest[bit]])[:counts[self.lengths > level + 1].sum()]
        self.first = self._descend(np.arange(sigma), np.zeros((sigma, 1), np.int64))[:, 0]

    @property
    def nbytes(self) -> int:
        """Bytes of the bit vectors."""
        return self.twice.nbytes + sum(b.nbytes for b in self.levels)

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Each symbol's places in its leaf of the tree, for a row of places ``at``."""
        lengths = self.lengths[symbol]
        order = np.argsort(~lengths, kind="stable")  # long codes first: those that end are behind the others
        open_ = len(order) - np.cumsum(np.bincount(lengths))
        code, at = self.codes[symbol[order]], at[order]
        for level, live in enumerate(open_[:-1]):
            part, bits = at[:live], self.levels[level]
            ones = bits.rank(part)
            one = (code[:live] >> (31 - level) & 1).astype(bool)
            at[:live] = np.where(one[:, None], ones + bits.zeros, part - ones)
        out = np.empty_like(at)
        out[order] = at
        return out

    def encode(self, words: np.ndarray) -> np.ndarray:
        """The words' symbols; 0 for a word that the shard lacks."""
        at = np.minimum(np.searchsorted(self.alphabet, words), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == words, at + 1, 0)

    def extend_left(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search for each interval [low, high); empty for symbol 0."""
        at = self._descend(symbol, np.stack([low, high], axis=1))
        base = self.smaller[symbol] - self.first[symbol]
        return base + at[:, 0], base + np.where(symbol > 0, at[:, 1], at[:, 0])

    def longest(self, symbols: np.ndarray, end: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """For each position ``end`` the length of the longest stretch that ends there, starts at ``limit`` or
        later and occurs twice or more in the shard: the matching statistic, cut at ``limit``."""
        length = np.zeros(len(end), np.int64)
        live, at = np.arange(len(end)), np.asarray(end, np.int64)
        low, high = np.zeros(len(end), np.int64), np.full(len(end), self.size, np.int64)
        while len(live):
            low, high = self.extend_left(symbols[at], low, high)
            few = np.flatnonzero(high - low < 2)  # these occur twice only in a copied sequence
            again = np.ones(len(live), bool)
            if len(few):
                ends = self.twice.rank(np.concatenate([low[few], high[few]]))
                again[few] = high[few] - low[few] + ends[len(few):] - ends[:len(few)] >= 2
            length[live[again]] += 1
            more = again & (at > limit[live])
            live, at, low, high = live[more], at[more] - 1, low[more], high[more]
        return length

    def matching_statistics(self, document: np.ndarray) -> np.ndarray:
        """For each word of a document the length of the longest stretch that ends there and occurs twice or more."""
        symbols = self.encode(document)
        return self.longest(symbols, np.arange(len(symbols)), np.zeros(len(symbols), np.int64))

    def repeated_windows(self, documents: list[np.ndarray], window: int) -> list[tuple[int, int, int]]:
        """Runs ``(document, first window, end window)`` of windows that occur twice or more in the shard.

        These are the intervals whose matching statistics reach ``window``. Only the ends that decide are searched. An interval of
        open windows is first searched from its right end back to its first window: all windows within the stretch found are
        in. Where it breaks off at a word ``f``, the windows left of ``f`` and those that hold it are open intervals still. These are
        searched from the left, by the end of their first window: if it breaks off at a word ``g``, every window that
        holds ``[g, end]`` is out, and the interval starts behind ``g``; else the rest is searched from the right again.
        """
        lengths = np.array([len(d) for d in documents], np.int64)
        of = np.flatnonzero(lengths >= window)
        if not len(of):
            return []
        symbols = self.encode(np.concatenate(documents))
        first = np.cumsum(lengths) - lengths
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # document, first window, end window
        low, high = first[of], first[of] + lengths[of] - window  # open windows, by their first word
        right = np.ones(len(of), bool)
        while len(of):
            end = np.where(right, high, low) + window - 1
            begin = end - self.longest(symbols, end, low) + 1
            last = end - window + 1
            hit = begin <= last
            found.append((of[hit], begin[hit], last[hit] + 1))
            f = begin - 1  # from the right: the word at which the stretch breaks off, or that before the interval
            long = end - f >= LONG
            parts = [(right, low, f - window, long),
                     (right & (begin > low), np.maximum(low, f - window + 1), np.minimum(high - 1, f), np.zeros(len(of), bool)),
                     (~right, np.where(hit, low + 1, begin), high, hit)]
            keep = [on & (a <= b) for on, a, b, _ in parts]
            of, low, high, right = (np.concatenate(x) for x in zip(*[
                (of[k], a[k], b[k], r[k]) for k, (_, a, b, r) in zip(keep, parts)]))
        of, at, to = (np.concatenate(x) for x in zip(*found))
        at, to = at - first[of], to - first[of]
        if not len(of):
            return []
        order = np.lexsort((at, of))
        of, at, to = of[order], at[order], to[order]
        new = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (at[1:] != to[:-1])]))
        ends = np.concatenate([new[1:], [len(of)]]) - 1
        return [(int(of[a]), int(at[a]), int(to[b])) for a, b in zip(new, ends)]
