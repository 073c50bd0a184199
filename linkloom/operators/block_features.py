"""The 24 similarities of all pairs of the capped blocks, computed in the blocks' tasks.

They are those of ``features.build_features``, bit for bit, over columns of many pairs at a time: similarities of strings step
through the characters of all pairs together, with a bit for each character of the other string.  Texts are clean ones.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.functions.phonetic import metaphone
from linkloom.functions.similarity import token_set_ratio
from linkloom.operators.block_scores import ROWS, _regrouped, _score, block_keys
from linkloom.operators.decide import explode_ids
from linkloom.operators.features import FEATURES

#: Characters of a clean text; the last stands for the end.
ALPHABET = b" 0123456789_abcdefghijklmnopqrstuvwxyz"
END = len(ALPHABET)
CODE = np.full(256, END, np.uint8)
CODE[list(ALPHABET)] = np.arange(END)
#: Bits of a column, one a character, and different words of a text that are compared by columns; texts of more are compared singly.
BITS, WORDS = 64, 32
ONE, ZERO = np.uint64(1), np.uint64(0)
PAIR_WORDS = (END * END + 63) // 64


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start, as many as its size."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes) + np.repeat(starts, sizes)


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all characters, and each text's start and length."""
    texts = pa.concat_arrays([texts])
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    return CODE[np.frombuffer(data, np.uint8)] if data else np.zeros(0, np.uint8), offsets[:-1], np.diff(offsets)


class _Strings:
    """Strings with a row of ``chars`` for each place."""

    def __init__(self, flat: np.ndarray, starts: np.ndarray, length: np.ndarray, read: Callable[[int], str]):
        self.length, self.read = length, read
        self.chars = np.full((int(length.max(initial=0)) + 1, len(length)), END, np.uint8)
        owner = np.repeat(np.arange(len(length)), length)
        self.chars[_spans(np.zeros(len(length), np.int64), length), owner] = flat[_spans(starts, length)]

    def masks(self, which: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """A bit for each place of each character, in as many columns as the longest of those strings takes; and where each string's begin."""
        seen = np.zeros(len(self.length), bool)
        seen[which] = True
        found = np.flatnonzero(seen)
        at = np.zeros(len(self.length), np.int64)
        at[found] = np.arange(len(found)) * (END + 1)
        longest = int(self.length[found].max(initial=1))
        out = [np.zeros(len(found) * (END + 1), np.uint64) for _ in range(-(-longest // BITS))]
        for j in range(longest):
            out[j // BITS][at[found] + self.chars[j][found]] |= ONE << np.uint64(j % BITS)
        for mask in out:
            mask[END :: END + 1] = 0
        return out, at[which]


def _bits(columns: list[np.ndarray], j: int, n: int) -> np.ndarray:
    """Bit j of the first n rows."""
    return columns[j // BITS][:n] >> np.uint64(j % BITS) & ONE


def _subsequence(a: _Strings, x: np.ndarray, b: _Strings, y: np.ndarray, keep_a: list[np.ndarray] | None = None, keep_b: list[np.ndarray] | None = None) -> np.ndarray:
    """Lengths of longest common subsequences; keep_a, keep_b: columns of bits of the characters that count."""
    out = np.zeros(len(x), np.int64)
    if not len(x):
        return out
    short = a.length[x] <= BITS
    if not short.all() and (short | (b.length[y] <= BITS)).any():
        part = lambda columns, some: columns and [c[some] for c in columns]
        turned = ~short & (b.length[y] <= BITS)
        for some in np.flatnonzero(short), np.flatnonzero(~short & ~turned):
            out[some] = _subsequence(a, x[some], b, y[some], part(keep_a, some), part(keep_b, some))
        some = np.flatnonzero(turned)
        out[some] = _subsequence(b, y[some], a, x[some], part(keep_b, some), part(keep_a, some))
        return out
    order = np.argsort(-b.length[y], kind="stable")
    x, y = x[order], y[order]
    masks, at = a.masks(x)
    length = b.length[y]
    rows = [np.full(len(x), ~ZERO) for _ in masks]
    if keep_a is not None:
        keep_a, keep_b = [k[order] for k in keep_a], [k[order] for k in keep_b]
    for j in range(int(length[0])):
        n = int(np.searchsorted(-length, -j, side="left"))  # those with a character here
        place = at[:n] + b.chars[j][y[:n]]
        counts = _bits(keep_b, j, n) if keep_a is not None else None
        carry = None
        for k, mask in enumerate(masks):
            now, hit = rows[k][:n], mask[place]
            if keep_a is not None:
                hit &= keep_a[k][:n]
                hit *= counts
            hit &= now
            total = now + hit
            if len(masks) > 1:
                over = total < now
                if carry is not None:
                    total += carry
                    over |= total < carry
                carry = over.astype(np.uint64)
            rows[k][:n] = total | (now - hit)
    out[order] = sum(BITS - np.bitwise_count(row).astype(np.int64) for row in rows)
    return out


def _ratio(common: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.where(total > 0, 2 * common / np.maximum(total, 1), 1.0)


def _share(part: np.ndarray, whole: np.ndarray, empty: float = 0.0) -> np.ndarray:
    return np.where(whole > 0, part / np.maximum(whole, 1), empty)


def _below(n: np.ndarray) -> np.ndarray:
    """The lowest n bits; none for n below 0."""
    return np.where(n >= BITS, ~ZERO, (ONE << np.clip(n, 0, BITS - 1).astype(np.uint64)) - ONE)


def _jaro_winkler(a: _Strings, x: np.ndarray, b: _Strings, y: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x))
    la, lb = a.length[x], b.length[y]
    long = (la > BITS) | (lb > BITS)
    if long.any() and not long.all():
        for some in np.flatnonzero(~long), np.flatnonzero(long):
            out[some] = _jaro_winkler(a, x[some], b, y[some])
        return out
    some = np.flatnonzero((la > 0) & (lb > 0))
    some = some[np.argsort(-la[some], kind="stable")]
    if not len(some):
        return out
    x, y, la, lb = x[some], y[some], la[some], lb[some]
    masks, at = b.masks(y)
    reach = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    counts = [int(np.searchsorted(-la, -i, side="left")) for i in range(int(la[0]))]
    used, mine = [np.zeros(len(x), np.uint64) for _ in masks], [np.zeros(len(x), np.uint64) for _ in range(-(-len(counts) // BITS))]
    r, window = reach.astype(np.uint64), (ONE << np.minimum(2 * reach + 1, BITS - 1).astype(np.uint64)) - ONE
    for i, n in enumerate(counts):
        place = at[:n] + a.chars[i][x[:n]]
        taken = np.zeros(n, bool)
        for k, mask in enumerate(masks):
            if long.any():
                near = _below(i + reach[:n] + 1 - k * BITS) & ~_below(i - reach[:n] - k * BITS)
            else:
                u = np.uint64(i)
                near = np.where(r[:n] <= u, window[:n] << (u - np.minimum(r[:n], u)), window[:n] >> (np.maximum(r[:n], u) - u))
            free = mask[place] & ~used[k][:n] & near
            free &= ~free + ONE
            free *= ~taken
            used[k][:n] |= free
            taken |= free != 0
        mine[i // BITS][:n] |= taken.astype(np.uint64) << np.uint64(i % BITS)
    m = sum(np.bitwise_count(u).astype(np.int64) for u in used)
    swaps = np.zeros(len(x), np.int64)
    for i, n in enumerate(counts):
        place = at[:n] + a.chars[i][x[:n]]
        waits = _bits(mine, i, n) != 0
        for k, mask in enumerate(masks):
            low = used[k][:n] & (~used[k][:n] + ONE)
            low *= waits
            used[k][:n] ^= low
            swaps[:n] += (low != 0) & (mask[place] & low == 0)
            waits &= low == 0
    swaps //= 2
    safe = np.maximum(m, 1)
    score = (m / la + m / lb + (m - swaps) / safe) / 3
    lead, going = np.zeros(len(x), np.int64), np.ones(len(x), bool)
    for i in range(min(4, len(a.chars), len(b.chars))):
        c = a.chars[i][x]
        going &= (c == b.chars[i][y]) & (c != END)
        lead += going
    score = np.where(score > 0.7, score + 0.1 * lead * (1 - score), score)
    out[some] = np.where(m > 0, score, 0.0)
    return out


class _Texts:
    """The different texts of a task's records: their characters, and their words in order of their bytes."""

    def __init__(self, texts: pa.Array):
        coded = pc.dictionary_encode(texts)
        self.of = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.texts, n = coded.dictionary, len(coded.dictionary)
        self.read = lambda k: self.texts[int(k)].as_py()
        self.raw = _Strings(*_bytes(self.texts), self.read)
        split = pc.split_pattern(self.texts, " ")
        owner, flat = pc.list_parent_indices(split).to_numpy().astype(np.int64), pc.list_flatten(split)
        filled = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
        words = pc.dictionary_encode(flat.filter(pa.array(filled)))
        order = pc.sort_indices(words.dictionary).to_numpy().astype(np.int64)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        owner, word = owner[filled], rank[words.indices.to_numpy(zero_copy_only=False)]
        self.words = words.dictionary.take(pa.array(order))
        self.count = np.bincount(owner, minlength=n)
        first = np.cumsum(self.count) - self.count
        self.first = np.full(n, -1)
        self.first[self.count > 0] = word[first[self.count > 0]]
        by = np.sort(owner * (len(order) + 1) + word)
        chars = _bytes(self.words)
        self.sorted = self._joined(*np.divmod(by, len(order) + 1), chars, lambda k: " ".join(sorted(self.read(k).split())))[0]
        owner, word = np.divmod(by[np.diff(by, prepend=-1) != 0], len(order) + 1)
        self.set, places, sizes = self._joined(owner, word, chars, lambda k: " ".join(sorted(set(self.read(k).split()))))
        self.size = np.bincount(owner, minlength=n)
        self.wide = self.size > WORDS
        slot = np.arange(len(owner)) - (np.cumsum(self.size) - self.size)[owner]
        self.columns = np.full((min(WORDS, int(self.size.max(initial=0))), n), -1, np.int32)
        kept = ~self.wide[owner]
        slot, owner, word, low, high = slot[kept], owner[kept], word[kept], places[kept], (places + sizes)[kept]
        self.columns[slot, owner] = word
        self.long = self.set.length > BITS
        longest = int(self.set.length[~self.wide].max(initial=1))
        self.bits = [np.zeros(self.columns.shape, np.uint64) for _ in range(-(-longest // BITS))]
        for k, bits in enumerate(self.bits):
            bits[slot, owner] = _below(high - k * BITS) & ~_below(low - k * BITS)

    def _joined(self, owner, word, chars, read) -> tuple[_Strings, np.ndarray, np.ndarray]:
        """The words joined by spaces, with one at the end; each word's place in its string and its size with its space."""
        flat, starts, length = chars
        size = length[word] + 1
        at = np.cumsum(size) - size
        out = np.full(int(size.sum()), CODE[ord(" ")], np.uint8)
        out[_spans(at, length[word])] = flat[_spans(starts[word], length[word])]
        whole = np.bincount(owner, weights=size, minlength=len(self.texts)).astype(np.int64)
        begin = np.cumsum(whole) - whole
        return _Strings(out, begin, whole, lambda k: read(k) + " " if whole[k] else ""), at - begin[owner], size

    def coded(self, key: Callable[[str], str]) -> np.ndarray:
        """Numbers of a key of the first words, -1 for an empty one, and at the end -1 for no word."""
        got: dict[str, int] = {"": -1}
        first = np.unique(self.first[self.first >= 0])
        out = np.full(len(self.words) + 1, -1)
        out[first] = [got.setdefault(key(w), len(got)) for w in self.words.take(pa.array(first)).to_pylist()]
        return out

    def compared(self, x: np.ndarray, y: np.ndarray, texts: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of equal different words, and ``token_set_ratio`` if asked for."""
        both, ratio = np.zeros(len(x), np.int64), np.zeros(len(x))
        wide, long = self.wide[x] | self.wide[y], self.long[x] | self.long[y]
        for k in np.flatnonzero(wide):
            a, b = self.read(x[k]), self.read(y[k])
            both[k] = len(set(a.split()) & set(b.split()))
            ratio[k] = token_set_ratio(a, b) if texts else 0.0
        for some in np.flatnonzero(~wide & ~long), np.flatnonzero(~wide & long):
            if len(some):
                both[some], ratio[some] = self._by_columns(x[some], y[some], texts)
        return both, ratio

    def _by_columns(self, x: np.ndarray, y: np.ndarray, texts: bool) -> tuple[np.ndarray, np.ndarray]:
        nx, ny = self.size[x], self.size[y]
        both = np.zeros(len(x), np.int16)
        right = [self.columns[j][y] for j in range(int(ny.max()))]
        met = [np.zeros(len(x), bool) for _ in right]
        bits = self.bits[: -(-int(max(1, self.set.length[x].max(), self.set.length[y].max())) // BITS)]
        own, rest = ([np.zeros(len(x), np.uint64) for _ in bits] for _ in range(2))
        for i in range(int(nx.max())):
            left = self.columns[i][x]
            left[left < 0] = -2
            here = np.zeros(len(x), bool)
            for j, column in enumerate(right):
                equal = left == column
                both += equal
                if texts:
                    here |= equal
                    met[j] |= equal
            if texts:
                for o, bit in zip(own, bits):
                    o |= bit[i][x] * ~here
        both = both.astype(np.int64)
        if not texts:
            return both, np.zeros(len(x))
        for j, m in enumerate(met):
            for o, bit in zip(rest, bits):
                o |= bit[j][y] * ~m
        return both, self._set_ratio(x, y, both, own, rest)

    def _set_ratio(self, x: np.ndarray, y: np.ndarray, both: np.ndarray, own: list[np.ndarray], rest: list[np.ndarray]) -> np.ndarray:
        """A common beginning and a common last space add to a longest subsequence; own, rest: bits of the words of one side only."""
        nx, ny = self.size[x], self.size[y]
        out = np.where((nx > 0) & (ny > 0), 1.0, 0.0)
        some = np.flatnonzero((nx > 0) & (ny > 0) & ~((both > 0) & ((both == nx) | (both == ny))))
        x, y, own, rest, shared = x[some], y[some], [o[some] for o in own], [r[some] for r in rest], both[some] > 0
        common = _subsequence(self.set, x, self.set, y, own, rest) - 1
        mine, theirs = (sum(np.bitwise_count(o).astype(np.int64) for o in side) - 1 for side in (own, rest))
        base = np.where(shared, self.set.length[x] - mine - 2, 0)  # without its last space
        lead = np.where(shared, base + 1, 0)
        best = _ratio(lead + common, 2 * lead + mine + theirs)
        with_base = np.maximum(_ratio(base, base + lead + mine), _ratio(base, base + lead + theirs))
        out[some] = np.where(shared, np.maximum(best, with_base), best)
        return out


class PairFeatures:
    """Similarities of pairs of a task's records, given as numbers of two rows each."""

    def __init__(self, col: dict[str, pa.Array]):
        self.name, self.addr = _Texts(col["clean_name"]), _Texts(col["clean_addr"])
        postal = pc.dictionary_encode(col["postal"])
        self.postal = postal.indices.to_numpy(zero_copy_only=False)
        self.blank = pc.equal(col["postal"], "").to_numpy(zero_copy_only=False)
        self.country, self.soundex = (pc.dictionary_encode(col[c]).indices.to_numpy(zero_copy_only=False) for c in ("country_lc", "soundex"))
        self.sound = self.name.coded(metaphone)
        digits = [" ".join(re.findall("[0-9]+", t)) for t in self.addr.texts.to_pylist()]
        self.digits = _Texts(pa.array(digits, pa.string()))
        # Two characters of a name are a bit of a row.
        n = len(self.name.texts)
        self.twos = np.zeros((PAIR_WORDS, n), np.uint64)
        chars, length = self.name.raw.chars, self.name.raw.length
        for j in range(len(chars) - 1):
            there = np.flatnonzero(length > j + 1)
            two = chars[j][there].astype(np.int64) * END + chars[j + 1][there]
            self.twos[two >> 6, there] |= ONE << (two & 63).astype(np.uint64)
        self.n_twos = np.bitwise_count(self.twos).sum(axis=0, dtype=np.int64)
        self.twos = np.ascontiguousarray(self.twos.T)

    def _names(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        t = self.name
        both, token_set = t.compared(x, y)
        nx, ny, lx, ly = t.size[x], t.size[y], t.raw.length[x], t.raw.length[y]
        longest, shortest, least = np.maximum(lx, ly), np.minimum(lx, ly), np.minimum(nx, ny)
        lead, going = np.zeros(len(x), np.int64), np.ones(len(x), bool)
        for row in t.raw.chars:
            c = row[x]
            going &= (c == row[y]) & (c != END)
            if not going.any():
                break
            lead += going
        shared = np.zeros(len(x), np.int64)
        for k in range(0, len(x), 4096):
            shared[k : k + 4096] = np.bitwise_count(self.twos[x[k : k + 4096]] & self.twos[y[k : k + 4096]]).sum(axis=1, dtype=np.int64)
        first = t.first[x]
        filled = least > 0
        letters = np.maximum(t.sorted.length - 1, 0)  # without the last space, which is common
        return {
            "name_jaccard": _share(both, nx + ny - both),
            "name_first_word": ((first >= 0) & (first == t.first[y])).astype(float),
            "name_fuzz": _ratio(_subsequence(t.raw, x, t.raw, y), lx + ly),
            "name_token_sort": _ratio(np.maximum(_subsequence(t.sorted, x, t.sorted, y) - 1, 0), letters[x] + letters[y]),
            "name_token_set": token_set,
            "name_len_diff": _share(np.abs(lx - ly), longest),
            "name_metaphone": ((self.sound[first] >= 0) & (self.sound[first] == self.sound[t.first[y]])).astype(float),
            "name_jaro_winkler": _jaro_winkler(t.raw, x, t.raw, y),
            "name_contains": (filled & (both == least)).astype(float),
            "name_sorted_tokens_exact": (filled & (both == nx) & (both == ny)).astype(float),
            "name_prefix_match": _share(lead, longest),
            "name_char_jaccard": _share(shared, self.n_twos[x] + self.n_twos[y] - shared),
            "name_token_overlap_ratio": _share(both, least),
            "name_length_ratio": _share(shortest, longest),
            "num_token_diff": _share(np.abs(t.count[x] - t.count[y]), np.maximum(t.count[x], t.count[y])),
        }

    def _addresses(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        t, d = self.addr, self.digits
        both, token_set = t.compared(x, y)
        dx, dy = d.of[x], d.of[y]
        same, nx, ny = d.compared(dx, dy, texts=False)[0], d.size[dx], d.size[dy]
        return {
            "addr_jaccard": _share(both, t.size[x] + t.size[y] - both),
            "digit_jaccard": _share(same, nx + ny - same, 1.0),
            "addr_fuzz": _ratio(_subsequence(t.raw, x, t.raw, y), t.raw.length[x] + t.raw.length[y]),
            "addr_token_set": token_set,
            "addr_jaro_winkler": _jaro_winkler(t.raw, x, t.raw, y),
            "addr_digit_exact": ((same == nx) & (same == ny)).astype(float),
        }

    def __call__(self, a: np.ndarray, b: np.ndarray) -> dict[str, np.ndarray]:
        out = {
            "postal_match": np.where(self.blank[a] | self.blank[b], 0.5, (self.postal[a] == self.postal[b]).astype(float)),
            "country_match": (self.country[a] == self.country[b]).astype(float),
            "name_soundex": ((self.name.first[self.name.of[a]] >= 0) & (self.soundex[a] == self.soundex[b])).astype(float),
        }
        for texts, compare in ((self.name, self._names), (self.addr, self._addresses)):
            # Equal texts recur at many records.
            pairs, back = np.unique(texts.of[a] * len(texts.texts) + texts.of[b], return_inverse=True)
            out |= {k: v[back] for k, v in compare(*np.divmod(pairs, len(texts.texts))).items()}
        return out


def _labels(rows: pa.Table) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Whether the second record's id is in the first one's list ``true``."""
    ids = pc.dictionary_encode(rows.column("entity_id").combine_chunks())
    of, n = ids.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(ids.dictionary)
    lists = rows.column("true").combine_chunks()
    at = pc.index_in(pc.list_flatten(lists), ids.dictionary).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    owner = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    true = np.append(np.unique((owner * n + at)[at >= 0]), -1)

    def label(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * n + of[b]
        return (true[np.searchsorted(true[:-1], key)] == key).astype(np.int32)

    return label


def block_features(left: DataFrame, right: DataFrame, cap: int | None, truth: DataFrame) -> DataFrame:
    """``source1_entity_id, candidate_entity_id, label`` and FEATURES of the pairs of ``exact_blocks``, each once, labelled as ``label_pairs`` does.

    left, right: normalized, deduplicated records.  True ids travel with their records, so that no pairs are joined or shuffled.
    """
    one, two, over = block_keys(left, right, cap)
    lists = explode_ids(truth).groupBy("source1_entity_id").agg(F.collect_list("candidate_entity_id").alias("true")).withColumnRenamed("source1_entity_id", "entity_id")
    schema = T.StructType(list(ROWS.fields)).add("true", T.ArrayType(T.StringType()))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        rows = pa.Table.from_batches(held)
        # Most records of the second side meet none of the first.
        met = np.unique(rows.filter(rows.column("one")).column("by").to_numpy())
        rows = rows.filter(pc.is_in(rows.column("by"), pa.array(met)))
        if not rows.num_rows:
            return
        del held
        similar, label = PairFeatures({c: rows.column(c).combine_chunks() for c in rows.column_names}), _labels(rows)
        yield from _score(rows, 0.0, None, more=lambda a, b: {"label": label(a, b)} | similar(a, b), names=["label", *FEATURES])
        # The worker's memory is the trees' next.
        del similar, label, rows
        pa.default_memory_pool().release_unused()

    rows = _regrouped(one.join(lists, "entity_id", "left"), two.withColumn("true", F.lit(None).cast("array<string>")), over, schema)
    return rows.mapInArrow(compare, "source1_entity_id string, candidate_entity_id string, label int, " + ", ".join(f"{f} double" for f in FEATURES))
