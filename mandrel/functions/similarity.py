"""String similarity over whole Arrow batches: Spark has none but edit distance.

Scores run from 0 to 100 (Jaro-Winkler from 0 to 1); an empty side scores 0. Each distinct pair of a batch
is computed once, and no step goes pair by pair: strings lie end to end in one array of code points, of which a string, a stretch of it or
a sorted list of its words is a start and a size; longest common subsequences and matches are bit vectors of 64
characters a lane, one lane or more for each pair, and move by one character of all pairs at a time.

What can't change a score isn't computed: a ratio is at most what the lengths allow, and a stretch of a text has
no more in common than the prefix that ends with it and the suffix that begins with it. These bounds are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import cached_property
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Masks of 64 bits that are held at a time, and pairs whose stretches are looked at together.
CELLS, TOGETHER = 1 << 22, 2048
_ONE, _FULL = np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF)


class Texts(NamedTuple):
    """Strings as stretches of one array of code points."""

    codes: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    def at(self, rows: np.ndarray) -> Texts:
        return Texts(self.codes, self.starts[rows], self.sizes[rows])

    def backwards(self) -> Texts:
        return Texts(self.codes[::-1], len(self.codes) - self.starts - self.sizes, self.sizes)

    def grid(self) -> tuple[np.ndarray, np.ndarray]:
        """One row for each string: code points, and where they are."""
        k = np.arange(int(self.sizes.max(initial=0)))
        there = k < self.sizes[:, None]
        if not len(self.codes):
            return np.zeros(there.shape, dtype=np.int64), there
        return self.codes[np.where(there, self.starts[:, None] + k, 0)], there


def texts(strings: Sequence[str]) -> Texts:
    sizes = np.fromiter(map(len, strings), dtype=np.int64, count=len(strings))
    codes = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    return Texts(codes, np.cumsum(sizes) - sizes, sizes)


def _stretches(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of stretches, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def _bits(n: np.ndarray) -> np.ndarray:
    """Words with the lowest n bits set, n from 0 to 64 and clipped to it."""
    n = np.clip(n, 0, 64)
    return np.where(n == 64, _FULL, (_ONE << (n % 64).astype(np.uint64)) - _ONE)


def _masks(pattern: Texts, other: Texts) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of pairs: which, masks (words by pairs times symbols) of the places of each symbol in the pattern, where a pair's
    masks begin, and the other side's symbols; 0 is any that the pattern lacks. Patterns of a call need as many words."""
    work = [slice(0, len(pattern.sizes))]
    while work:
        cut = work.pop()
        n = cut.stop - cut.start
        a, a_there = Texts(*(pattern.codes, pattern.starts[cut], pattern.sizes[cut])).grid()
        b, b_there = Texts(*(other.codes, other.starts[cut], other.sizes[cut])).grid()
        top = max(int(a.max(initial=0)), int(b.max(initial=0)))
        known = np.zeros(top + 1, dtype=bool)
        known[a[a_there]] = True
        number = np.where(known, np.cumsum(known), 0)
        symbols, words = int(known.sum()) + 1, max(1, -(-a.shape[1] // 64))
        if n > 1 and n * symbols * words > CELLS:
            half = cut.start + n // 2
            work += [slice(half, cut.stop), slice(cut.start, half)]
            continue
        base = np.arange(n) * symbols
        masks = np.zeros((words, n * symbols), dtype=np.uint64)
        of_a = np.where(a_there, number[a], 0)
        for i in range(a.shape[1]):
            masks[i // 64, base + of_a[:, i]] |= _ONE << np.uint64(i % 64)
        masks[:, base] = 0  # what lies behind the end of a pattern
        yield cut, masks, base, np.where(b_there, number[b], 0)


def _by_words(pattern: Texts, other: Texts) -> Iterator[np.ndarray]:
    """Rows whose patterns need as many words, those of the longest other sides first."""
    words = np.maximum(1, -(-pattern.sizes // 64))
    for w in np.unique(words):
        rows = np.flatnonzero(words == w)
        yield rows[np.argsort(-other.sizes[rows], kind="stable")]


def _common_of(pattern: Texts, other: Texts, every: bool) -> np.ndarray:
    n, longest = len(pattern.sizes), int(other.sizes.max(initial=0))
    out = np.zeros((n, longest + 1) if every else n, dtype=np.int64)
    for rows in _by_words(pattern, other):
        p, o = pattern.at(rows), other.at(rows)
        for cut, masks, base, symbols in _masks(p, o):
            sizes, ends = p.sizes[cut], o.sizes[cut]
            full = np.stack([_bits(sizes - 64 * w) for w in range(len(masks))])
            state = full.copy()
            steps = np.ascontiguousarray(symbols.T)
            active = np.searchsorted(-ends, -np.arange(len(steps)), side="left")  # pairs with a character there: ends fall
            for j, symbol in enumerate(steps):
                c = active[j]
                at = base[:c] + symbol[:c]
                carry = np.zeros(c, dtype=bool)
                for w in range(len(masks)):
                    was = state[w, :c]
                    hit = was & masks[w][at]
                    total = was + hit
                    over = total < was
                    if w or len(masks) > 1:
                        more = total + carry
                        over |= more < total
                        total = more
                    state[w, :c] = total | (was ^ hit)
                    carry = over
                if every:
                    out[rows[cut][:c], j + 1] = sizes[:c] - np.bitwise_count(state[:, :c] & full[:, :c]).sum(axis=0, dtype=np.int64)
            if not every:
                out[rows[cut]] = sizes - np.bitwise_count(state & full).sum(axis=0, dtype=np.int64)
    return out


def common(a: Texts, b: Texts) -> np.ndarray:
    """Length of the longest common subsequence of every pair."""
    swap = a.sizes > b.sizes
    if not swap.any():
        return _common_of(a, b, False)
    codes = np.concatenate([a.codes, b.codes])
    behind = b.starts + len(a.codes)
    less = Texts(codes, np.where(swap, behind, a.starts), np.where(swap, b.sizes, a.sizes))
    more = Texts(codes, np.where(swap, a.starts, behind), np.where(swap, a.sizes, b.sizes))
    return _common_of(less, more, False)


class Pairs:
    """Distinct pairs of a batch, with what their strings have in words."""

    def __init__(self, a: Sequence[str], b: Sequence[str]):
        codes, names = pd.factorize(np.array([*a, *b, ""], dtype=object)[:-1])
        self.names = list(names)
        key, self.back = np.unique(codes[: len(a)] * max(len(names), 1) + codes[len(a) :], return_inverse=True)
        self.left, self.right = key // max(len(names), 1), key % max(len(names), 1)
        self.n = len(key)
        self.texts = texts(self.names)

    @property
    def a(self) -> Texts:
        return self.texts.at(self.left)

    @property
    def b(self) -> Texts:
        return self.texts.at(self.right)

    @cached_property
    def _words(self) -> tuple[Texts, np.ndarray, np.ndarray, int]:
        """The words, each with a space behind it; sorted word numbers of every string, the string of each."""
        lists = [s.split() for s in self.names]
        names = sorted(set(chain.from_iterable(lists)))
        number = {w: k for k, w in enumerate(names)}
        ids = np.fromiter((number[w] for w in chain.from_iterable(lists)), dtype=np.int64)
        rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        key = np.sort(rows * max(len(names), 1) + ids)
        return texts([w + " " for w in names]), key % max(len(names), 1), key // max(len(names), 1), len(names)

    def _joined(self, ids: np.ndarray, rows: np.ndarray, n: int) -> Texts:
        """Words as strings again, joined by a space."""
        table = self._words[0]
        sizes = table.sizes[ids]
        whole = np.bincount(rows, weights=sizes, minlength=n).astype(np.int64)
        return Texts(table.codes[_stretches(table.starts[ids], sizes)], np.cumsum(whole) - whole, np.maximum(whole - 1, 0))

    @cached_property
    def in_order(self) -> Texts:
        """Every string with its words sorted."""
        _, ids, rows, _ = self._words
        return self._joined(ids, rows, len(self.names))

    @cached_property
    def sets(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct words of every string, and the string of each."""
        _, ids, rows, _ = self._words
        new = np.ones(len(ids), dtype=bool)
        new[1:] = (ids[1:] != ids[:-1]) | (rows[1:] != rows[:-1])
        return ids[new], rows[new]

    @cached_property
    def once(self) -> Texts:
        """Every string with its distinct words sorted."""
        return self._joined(*self.sets, len(self.names))

    @cached_property
    def parts(self) -> tuple[np.ndarray, np.ndarray, Texts, Texts, np.ndarray]:
        """Of every pair: how many words both have, their characters joined, each side's others joined, whether either side has no word."""
        table, _, _, many = self._words
        ids, rows = self.sets
        counts = np.bincount(rows, minlength=len(self.names))
        starts = np.cumsum(counts) - counts
        key, own = [], []
        for side in (self.left, self.right):
            at = _stretches(starts[side], counts[side])
            pair = np.repeat(np.arange(self.n), counts[side])
            key.append(pair * max(many, 1) + ids[at])
            own.append((pair, ids[at]))
        shared = [_within(key[0], key[1]), _within(key[1], key[0])]
        pair, words = own[0][0][shared[0]], own[0][1][shared[0]]
        both = np.bincount(pair, minlength=self.n)
        core = np.bincount(pair, weights=table.sizes[words], minlength=self.n).astype(np.int64)
        rest = [self._joined(w[~s], p[~s], self.n) for (p, w), s in zip(own, shared, strict=True)]
        return both, np.maximum(core - 1, 0), *rest, (counts[self.left] == 0) | (counts[self.right] == 0)

    def some(self, rows: np.ndarray) -> Pairs:
        """Some of the pairs, over the same strings."""
        out = object.__new__(Pairs)
        out.__dict__.update(names=self.names, texts=self.texts, left=self.left[rows], right=self.right[rows], n=len(rows), back=np.arange(len(rows)))
        for known in ("_words", "in_order", "sets", "once"):
            if known in self.__dict__:
                out.__dict__[known] = self.__dict__[known]
        return out


def _within(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of a are in b; both sorted."""
    if not len(b):
        return np.zeros(len(a), dtype=bool)
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return b[at] == a


def _ratio(a: Texts, b: Texts) -> np.ndarray:
    total = a.sizes + b.sizes
    return np.where(total > 0, 200.0 * common(a, b) / np.maximum(total, 1), 100.0)


def ratio(p: Pairs) -> np.ndarray:
    """Normalised insert-delete similarity."""
    return _ratio(p.a, p.b)


def _stretch(a: Texts, b: Texts, need: np.ndarray) -> np.ndarray:
    """Best ratio of a with any stretch of b, which is no shorter, of at most a's length; exact where it is over `need`."""
    n, m = a.sizes, b.sizes
    from_left, from_right = _common_of(a, b, True), _common_of(a.backwards(), b.backwards(), True)
    k = np.arange(from_left.shape[1])
    ratios = 200.0 * np.maximum(from_left, from_right) / np.maximum(n[:, None] + k, 1)
    best = np.where((k >= 1) & (k <= n[:, None]), ratios, 0.0).max(axis=1)
    # A stretch in between has no more in common than the prefix up to its end, or the suffix from its start.
    upto = np.take_along_axis(from_left, np.minimum(k + n[:, None], m[:, None]), axis=1)
    onward = np.take_along_axis(from_right, np.maximum(m[:, None] - k, 0), axis=1)
    bound = 200.0 * np.minimum(upto, onward) / np.maximum(2 * n[:, None], 1)
    rows, at = np.nonzero((k >= 1) & (k < m[:, None] - n[:, None]) & (bound > np.maximum(best, need)[:, None]))
    if len(rows):
        found = 200.0 * _common_of(a.at(rows), Texts(b.codes, b.starts[rows] + at, n[rows]), False) / np.maximum(2 * n[rows], 1)
        np.maximum.at(best, rows, found)
    return np.where(n == 0, np.where(m == 0, 100.0, 0.0), best)


def _partial(a: Texts, b: Texts, need: np.ndarray | None = None) -> np.ndarray:
    """Best ratio of the shorter string with any stretch of the longer one of at most its length; where lengths are equal either
    side may be the shorter one. Exact where it is over `need`."""
    need = np.full(len(a.sizes), -1.0) if need is None else need
    codes = np.concatenate([a.codes, b.codes])
    b = Texts(codes, b.starts + len(a.codes), b.sizes)
    a = Texts(codes, a.starts, a.sizes)
    swap = a.sizes > b.sizes
    less = Texts(codes, np.where(swap, b.starts, a.starts), np.where(swap, b.sizes, a.sizes))
    more = Texts(codes, np.where(swap, a.starts, b.starts), np.where(swap, a.sizes, b.sizes))
    out = np.zeros(len(need))
    order = np.argsort(more.sizes, kind="stable")  # strings of like length share a grid
    for low in range(0, len(order), TOGETHER):
        rows = order[low : low + TOGETHER]
        out[rows] = _stretch(less.at(rows), more.at(rows), need[rows])
        rows = rows[(a.sizes[rows] == b.sizes[rows]) & (out[rows] < 100)]
        if len(rows):
            out[rows] = np.maximum(out[rows], _stretch(more.at(rows), less.at(rows), np.maximum(need, out)[rows]))
    return out


def partial_ratio(p: Pairs) -> np.ndarray:
    return _partial(p.a, p.b)


def token_sort_ratio(p: Pairs) -> np.ndarray:
    return _ratio(p.in_order.at(p.left), p.in_order.at(p.right))


def token_set_ratio(p: Pairs) -> np.ndarray:
    """Best of: shared words against each side, and the sides with their shared words first. 100 if one side has all words of the other."""
    both, core, left, right, empty = p.parts
    gap = (core > 0).astype(np.int64)
    one, two = core + gap + left.sizes, core + gap + right.sizes
    out = np.zeros(p.n)
    some = core > 0
    for rest, whole in ((left.sizes, one), (right.sizes, two)):
        out[some] = np.maximum(out[some], 100.0 * (1 - (gap + rest)[some] / (core + whole)[some]))
    total = np.maximum(one + two, 1)
    # Both sides begin with the shared words, so only the rests differ; they have no more in common than the shorter one has characters.
    bound = 100.0 * (1 - np.abs(left.sizes - right.sizes) / total)
    rows = np.flatnonzero((bound > out) | ~some)
    found = common(left.at(rows), right.at(rows))
    out[rows] = np.maximum(out[rows], 100.0 * (1 - (left.sizes[rows] + right.sizes[rows] - 2 * found) / total[rows]))
    out[(both > 0) & ((left.sizes == 0) | (right.sizes == 0))] = 100.0
    out[empty] = 0.0
    return out


def token_ratio(p: Pairs) -> np.ndarray:
    return np.maximum(token_sort_ratio(p), token_set_ratio(p))


def partial_token_ratio(p: Pairs, need: np.ndarray | None = None) -> np.ndarray:
    """100 if a word is shared, else the best partial ratio of sorted words, with and without repeats."""
    both = p.parts[0]
    out = np.full(p.n, 100.0)
    rows = np.flatnonzero(both == 0)
    if len(rows):
        need = np.full(p.n, -1.0) if need is None else need
        x, y = p.left[rows], p.right[rows]
        out[rows] = _partial(p.in_order.at(x), p.in_order.at(y), need[rows])
        again = (p.in_order.sizes != p.once.sizes)[x] | (p.in_order.sizes != p.once.sizes)[y]
        if again.any():
            rows, x, y = rows[again], x[again], y[again]
            out[rows] = np.maximum(out[rows], _partial(p.once.at(x), p.once.at(y), np.maximum(need, out)[rows]))
    return out


def weighted_ratio(p: Pairs) -> np.ndarray:
    """The weighted choice among the ratios above that is usual for names: partial ones count where lengths differ much."""
    a, b = p.a.sizes, p.b.sizes
    less, more = np.minimum(a, b), np.maximum(a, b)
    out = np.where(less > 0, ratio(p), 0.0)
    longer = more / np.maximum(less, 1)
    near = np.flatnonzero((less > 0) & (longer < 1.5))
    if len(near):
        out[near] = np.maximum(out[near], 0.95 * token_ratio(p.some(near)))
    far = np.flatnonzero((less > 0) & (longer >= 1.5))
    if len(far):
        q = p.some(far)
        scale = np.where(longer[far] < 8, 0.9, 0.6)
        best = out[far]
        # A shared word says 100 at once, which leaves little for stretches to add.
        best = np.where(q.parts[0] > 0, np.maximum(best, 0.95 * scale * 100.0), best)
        over = lambda weight: np.nextafter(best / weight, 0) - 1e-9
        best = np.maximum(best, scale * _partial(q.a, q.b, over(scale)))
        rest = np.flatnonzero(q.parts[0] == 0)
        if len(rest):
            weight = (0.95 * scale)[rest]
            best[rest] = np.maximum(best[rest], weight * partial_token_ratio(q.some(rest), over(0.95 * scale)[rest]))
        out[far] = best
    return out


def jaro_winkler(p: Pairs) -> np.ndarray:
    """From 0 to 1: the share of characters that match within reach, less half of those out of order; a common beginning counts more."""
    out = np.where((p.left == p.right) & (p.a.sizes > 0), 1.0, 0.0)
    todo = np.flatnonzero((p.left != p.right) & (p.a.sizes > 0) & (p.b.sizes > 0))
    a, b = p.a.at(todo), p.b.at(todo)
    reach = np.maximum(a.sizes, b.sizes) // 2 - 1
    for group in _by_words(b, a):
        bs, as_ = b.at(group), a.at(group)
        for cut, masks, base, symbols in _masks(bs, as_):
            rows = group[cut]
            la, lb, near = a.sizes[rows], b.sizes[rows], reach[rows]
            taken = np.zeros((len(masks), len(rows)), dtype=np.uint64)
            matched = np.zeros(symbols.shape, dtype=bool)
            for i in range(symbols.shape[1]):
                low, high = np.maximum(i - near, 0), np.minimum(i + near + 1, lb)
                there = (i < la) & (high > low)
                open_ = there.copy()
                for w in range(len(masks)):
                    inside = _bits(high - 64 * w) & ~_bits(low - 64 * w)
                    free = np.where(open_, masks[w][base + symbols[:, i]] & inside & ~taken[w], np.uint64(0))
                    taken[w] |= free & (~free + _ONE)
                    open_ &= free == 0
                matched[:, i] = there & ~open_
            x, _ = a.at(rows).grid()
            y, _ = b.at(rows).grid()
            j = np.arange(y.shape[1])
            used = (taken[j // 64, :].T >> (j % 64).astype(np.uint64)) & _ONE > 0 if len(j) else np.zeros(y.shape, dtype=bool)
            m = matched.sum(axis=1)
            differ = x[matched] != y[used]
            swaps = np.bincount(np.nonzero(matched)[0], weights=differ, minlength=len(rows)).astype(np.int64) // 2
            count = np.maximum(m, 1)
            jaro = np.where(m > 0, (m / la + m / lb + (m - swaps) / count) / 3, 0.0)
            four = min(4, x.shape[1], y.shape[1])
            k = np.arange(four)
            same = (x[:, :four] == y[:, :four]) & (k < la[:, None]) & (k < lb[:, None])
            prefix = np.cumprod(same, axis=1).sum(axis=1) if four else np.zeros(len(rows), dtype=np.int64)
            out[todo[rows]] = np.where(jaro > 0.7, jaro + 0.1 * prefix * (1 - jaro), jaro)
    return out


def scores(score: Callable[[Pairs], np.ndarray], a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """A score for every pair of two lists of strings."""
    pairs = Pairs(a, b)
    return score(pairs)[pairs.back] if len(a) else np.zeros(0)


def vectorised(score: Callable[[Pairs], np.ndarray]):
    """A Column function over two text columns; null counts as empty."""

    @F.pandas_udf(T.DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(scores(score, a.fillna("").tolist(), b.fillna("").tolist()), dtype=float)

    return run


SCORERS = {"token_set_ratio": vectorised(token_set_ratio), "WRatio": vectorised(weighted_ratio)}
JARO_WINKLER = vectorised(jaro_winkler)
