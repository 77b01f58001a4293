"""The scorers pair by pair, as a brute force for the batched ones."""

from functools import lru_cache


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit vectors."""
    if len(a) > len(b):
        a, b = b, a
    spots: dict[str, int] = {}
    for k, ch in enumerate(a):
        spots[ch] = spots.get(ch, 0) | 1 << k
    full = (1 << len(a)) - 1
    rows = full
    for ch in b:
        hit = rows & spots.get(ch, 0)
        rows = ((rows + hit) | (rows - hit)) & full
    return len(a) - rows.bit_count()


def ratio(a: str, b: str) -> float:
    """Normalised insert-delete similarity."""
    total = len(a) + len(b)
    return 200.0 * _common(a, b) / total if total else 100.0


def _partial(a: str, b: str) -> float:
    """Best ratio of the shorter string with any stretch of the longer one of at most its length."""
    if len(a) > len(b):
        a, b = b, a
    n = len(a)
    if not n:
        return 100.0 if not b else 0.0
    chars = set(a)
    best = 0.0
    for k in range(1, n):
        if b[k - 1] in chars:
            best = max(best, ratio(a, b[:k]))
    for k in range(len(b) - n):
        if b[k + n - 1] in chars:
            best = max(best, ratio(a, b[k : k + n]))
    for k in range(len(b) - n, len(b)):
        if b[k] in chars:
            best = max(best, ratio(a, b[k:]))
    return best


def partial_ratio(a: str, b: str) -> float:
    """Where lengths are equal either side may be the shorter one."""
    best = _partial(a, b)
    return max(best, _partial(b, a)) if len(a) == len(b) and best < 100 else best


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    """Best of: shared words against each side, and the sides with their shared words first. 100 if one side has all words of the other."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = sorted(x & y), sorted(x - y), sorted(y - x)
    if both and (not left or not right):
        return 100.0
    core, p, q = len(" ".join(both)), " ".join(left), " ".join(right)
    gap = bool(core)
    one, two = core + gap + len(p), core + gap + len(q)
    # Both sides begin with the shared words, so only the rests differ.
    out = 100.0 * (1 - (len(p) + len(q) - 2 * _common(p, q)) / (one + two)) if one + two else 100.0
    if core:
        out = max(out, 100.0 * (1 - (gap + len(p)) / (core + one)), 100.0 * (1 - (gap + len(q)) / (core + two)))
    return out


def token_ratio(a: str, b: str) -> float:
    return max(token_sort_ratio(a, b), token_set_ratio(a, b))


def partial_token_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if x & y:
        return 100.0
    left, right = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    p, q = " ".join(sorted(x)), " ".join(sorted(y))
    out = partial_ratio(left, right)
    return out if (p, q) == (left, right) else max(out, partial_ratio(p, q))


@lru_cache(maxsize=1 << 16)
def weighted_ratio(a: str, b: str) -> float:
    """The weighted choice among the ratios above that is usual for names: partial ones count where lengths differ much."""
    if not a or not b:
        return 0.0
    longer = max(len(a), len(b)) / min(len(a), len(b))
    plain = ratio(a, b)
    if longer < 1.5:
        return max(plain, 0.95 * token_ratio(a, b))
    scale = 0.9 if longer < 8 else 0.6
    return max(plain, scale * partial_ratio(a, b), 0.95 * scale * partial_token_ratio(a, b))


def jaro_winkler(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(len(a), len(b)) // 2 - 1
    taken = [False] * len(b)
    first = []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == ch:
                taken[j] = True
                first.append(ch)
                break
    m = len(first)
    if not m:
        return 0.0
    second = [ch for ch, t in zip(b, taken, strict=True) if t]
    swaps = sum(x != y for x, y in zip(first, second, strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        prefix += 1
    return jaro + 0.1 * prefix * (1 - jaro) if jaro > 0.7 else jaro
