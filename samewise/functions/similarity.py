"""String similarities. Arrow functions hold the kernels Spark lacks; the rest are expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence by the bit-parallel recurrence on one integer."""
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & masks.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def indel(a: str, b: str) -> float:
    """2 LCS / (len + len), times 100; two empty strings are alike."""
    if a == b:
        return 100.0
    return 200.0 * lcs_length(a, b) / (len(a) + len(b))


def token_sort(a: str, b: str) -> float:
    return indel(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    if both and (x <= y or y <= x):
        return 100.0
    left, right = (" ".join(filter(None, [both, " ".join(sorted(d))])) for d in (x - y, y - x))
    best = indel(left, right)
    return max(best, indel(both, left), indel(both, right)) if both else best


def jaro_winkler_one(a: str, b: str) -> float:
    """Jaro similarity, raised by 0.1 for each of up to four equal first characters where it is over 0.7."""
    if not a or not b:
        return float(a == b)
    reach = max(len(a), len(b)) // 2 - 1
    taken, mine = [False] * len(b), []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == ch:
                taken[j] = True
                mine.append(ch)
                break
    m = len(mine)
    if not m:
        return 0.0
    theirs = [ch for ch, t in zip(b, taken, strict=True) if t]
    swaps = sum(x != y for x, y in zip(mine, theirs, strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    same = 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        same += 1
    return jaro + 0.1 * same * (1 - jaro) if jaro > 0.7 else jaro


def _pairwise(kernel):
    """A Column function that applies ``kernel`` once to each distinct pair of an Arrow batch."""

    def of(a, b):
        import pandas as pd

        done: dict[tuple[str, str], float] = {}
        out = []
        for p in zip(a, b, strict=True):
            if p not in done:
                done[p] = kernel(p[0] or "", p[1] or "")
            out.append(done[p])
        return pd.Series(out, dtype=float)

    return lambda a, b: F.pandas_udf(of, "double")(a, b)


indel_ratio, token_sort_ratio, token_set_ratio, jaro_winkler = map(_pairwise, (indel, token_sort, token_set, jaro_winkler_one))


def tokens(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(c, "\\s+"), lambda w: w != ""))


def levenshtein_similarity(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    # Equal texts, the most in blocks, need no lengths.
    return F.when(a == b, F.lit(1.0)).when(longest == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(a, b) / longest)


def token_jaccard(a: Column, b: Column) -> Column:
    both, either = F.size(F.array_intersect(tokens(a), tokens(b))), F.size(F.array_union(tokens(a), tokens(b)))
    none = (F.size(tokens(a)) == 0) | (F.size(tokens(b)) == 0)
    return F.when(none, F.lit(0.0)).otherwise(both / either)


def jaccard_of(a: Column, b: Column) -> Column:
    """``token_jaccard`` of texts whose ``tokens`` are given."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def signature(words: Column) -> Column:
    """64 bits, of which each word sets one."""
    return F.aggregate(words, F.lit(0).cast("long"), lambda s, w: s.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.hash(w), F.lit(64)))))


def jaccard_is_half(a: Column, b: Column, bits_a: Column, bits_b: Column) -> Column:
    """Whether ``jaccard_of`` is at least 0.5, without division.

    A bit that only one side has stands for a word that the other lacks, which bounds the shared words; pairs below need no more.
    """
    m, n = F.size(a), F.size(b)
    most = F.least(m - F.bit_count(bits_a.bitwiseAND(F.bitwise_not(bits_b))), n - F.bit_count(bits_b.bitwiseAND(F.bitwise_not(bits_a))))
    return (m > 0) & (n > 0) & (3 * most >= m + n) & (3 * F.size(F.array_intersect(a, b)) >= m + n)


def length_difference(a: Column, b: Column) -> Column:
    return F.abs(F.length(a) - F.length(b)).cast("double")
