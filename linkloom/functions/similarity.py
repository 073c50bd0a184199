"""String similarities that Spark has no function for, as functions over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.functions.phonetic import metaphone


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence; bit-parallel, a bit for each character of a."""
    if not a or not b:
        return 0
    at: dict[str, int] = {}
    for i, ch in enumerate(a):
        at[ch] = at.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full  # a zero bit marks a step of the row
    for ch in b:
        hit = row & at.get(ch, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def indel_ratio(a: str, b: str) -> float:
    """2 LCS / (len a + len b); 1 for two empty strings."""
    total = len(a) + len(b)
    return 2 * common_subsequence(a, b) / total if total else 1.0


def token_sort_ratio(a: str, b: str) -> float:
    return indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    """Largest ratio among the common tokens and the common tokens with either side's own; 0 if a side has no token."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, only_x, only_y = x & y, x - y, y - x
    if both and not (only_x and only_y):
        return 1.0
    base = " ".join(sorted(both))
    with_x = " ".join(filter(None, [base, " ".join(sorted(only_x))]))
    with_y = " ".join(filter(None, [base, " ".join(sorted(only_y))]))
    best = indel_ratio(with_x, with_y)
    return max(best, indel_ratio(base, with_x), indel_ratio(base, with_y)) if base else best


def jaro_winkler(a: str, b: str) -> float:
    """Jaro similarity, raised by 0.1 a common leading character (four at most) where it exceeds 0.7; 0 for empty strings."""
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used = [False] * len(b)
    mine = []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == ch:
                used[j] = True
                mine.append(ch)
                break
    m = len(mine)
    if not m:
        return 0.0
    theirs = [ch for ch, u in zip(b, used) if u]
    swaps = sum(x != y for x, y in zip(mine, theirs)) // 2
    score = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    if score > 0.7:
        lead = 0
        while lead < min(4, len(a), len(b)) and a[lead] == b[lead]:
            lead += 1
        score += 0.1 * lead * (1 - score)
    return score


def same_sound(a: str, b: str) -> float:
    """1 if the first words have the same, not empty, Metaphone code."""
    x, y = (a.split() or [""])[0], (b.split() or [""])[0]
    code = metaphone(x) if x and y else ""
    return 1.0 if code and code == metaphone(y) else 0.0


def _kernel(compare: Callable[[str, str], float]):
    """A similarity over Arrow batches; each different pair of strings of a batch is compared once, nulls as ''."""

    @F.arrow_udf(T.DoubleType())
    def kernel(a: pa.Array, b: pa.Array) -> pa.Array:
        seen: dict[tuple[str, str], float] = {}
        out = []
        for pair in zip(a.to_pylist(), b.to_pylist()):
            got = seen.get(pair)
            if got is None:
                got = seen[pair] = compare(pair[0] or "", pair[1] or "")
            out.append(got)
        return pa.array(out, pa.float64())

    return kernel


#: Features by name: the attribute they compare, and how; only those asked for are computed.
KERNELS = {
    "name_fuzz": ("name", _kernel(indel_ratio)), "name_token_sort": ("name", _kernel(token_sort_ratio)), "name_token_set": ("name", _kernel(token_set_ratio)),
    "name_metaphone": ("name", _kernel(same_sound)), "name_jaro_winkler": ("name", _kernel(jaro_winkler)),
    "addr_fuzz": ("addr", _kernel(indel_ratio)), "addr_token_set": ("addr", _kernel(token_set_ratio)), "addr_jaro_winkler": ("addr", _kernel(jaro_winkler)),
}
