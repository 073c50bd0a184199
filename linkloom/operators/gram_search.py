"""The exact neighbour search: records meet in tasks as sets of numbered grams; no posting or pair is written.

Candidates are written once, in blocks of a country.  Each task takes a share of the source-1 records through all blocks of
their countries.  Scores are summed up over the rarer grams of a record; what the frequent ones can add is bounded by norms
(Cauchy-Schwarz), and only candidates whose bound reaches the k-th best score so far are compared in full.
"""

from __future__ import annotations

import math
import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame

#: Candidates of a block, about; a worker holds one.
BLOCK = 32_768
#: Numbers of most frequent grams that may be bounded instead of summed up, and the bound up to which that is done at first.
LEVELS, LOOSE = (0, 64, 128, 256, 384, 512, 768, 1024, 2048), 0.17
#: Candidates that are compared in full at a time; beyond, the frequent grams are summed up too.
FEW = 4_000
#: Postings from which a gram is added by itself.
LONG = 2_000
#: More than the error of sums of single precision.
SLACK = 1e-5


@cache
def _digits() -> dict[int, int]:
    """Digits beyond the first 65,536 characters, the only such ones in normalized texts, as numbers that no character has."""
    wide = [c for c in range(0x10000, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Nd"]
    return {c: 0xD800 + i for i, c in enumerate(wide)}


def _chars(text: str) -> np.ndarray:
    chars = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    if chars.max(initial=0) <= 0xFFFF:
        return chars.astype(np.uint64)
    try:
        return np.array([c if c <= 0xFFFF else _digits()[c] for c in chars.tolist()], np.uint64)
    except KeyError as e:
        raise ValueError(f"character {e} in a normalized text") from None


def _gram(key: int) -> str:
    back = None
    out = []
    for shift in (48, 32, 16, 0):
        c = key >> shift & 0xFFFF
        if 0xD800 <= c < 0xE000:
            back = back or {v: k for k, v in _digits().items()}
            c = back[c]
        if c:
            out.append(chr(c))
    return "".join(out)


def _key(gram: str) -> int:
    key = 0
    for c in _chars(gram).tolist():
        key = key << 16 | c
    return key


def gram_counts_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of texts, numbers of their different ``word_grams`` and how often they are there; words are parted by single spaces."""
    chars = _chars("".join([f" {x} " for x in texts.to_pylist()]))
    sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False) + 2
    owner, gap = np.repeat(np.arange(len(texts), dtype=np.int64), sizes), chars == 32
    keys, at, key = [], [], chars
    for n in (2, 3, 4):
        key = key[:-1] << np.uint64(16) | chars[n - 1 :]
        # Only at its ends a gram has a space, and at one of them if it is of two characters; so none reaches into the next word or text.
        whole = ~(gap[:-1] & gap[1:]) if n == 2 else ~gap[1:-1] if n == 3 else ~(gap[1:-2] | gap[2:-1])
        keys.append(key[whole])
        at.append(owner[: len(key)][whole])
    coded = pa.array(np.concatenate(keys).view(np.int64)).dictionary_encode()
    different = coded.dictionary.to_numpy()
    pairs = np.sort(np.concatenate(at) * max(len(different), 1) + coded.indices.to_numpy())
    first = np.flatnonzero(np.diff(pairs, prepend=-1))
    place, code = np.divmod(pairs[first], max(len(different), 1))
    return place, different[code], np.diff(np.append(first, len(pairs)))


def _summed(key: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=key[0] - 1 if len(key) else 0))
    return [key[first], *[np.add.reduceat(v[order], first) if len(first) else v for v in values]]


def _by(batch: pa.RecordBatch | pa.Table, column: str) -> Iterator[tuple[object, pa.Table]]:
    rows = pa.Table.from_batches([batch]) if isinstance(batch, pa.RecordBatch) else batch
    for x in pc.unique(rows.column(column)).to_pylist():
        yield x, rows.filter(pc.equal(rows.column(column), x)).combine_chunks()


def _texts(rows: pa.Table) -> pa.Array:
    return rows.column("text").chunk(0) if rows.column("text").num_chunks == 1 else rows.column("text").combine_chunks()


def gram_stats(texts: DataFrame) -> DataFrame:
    """``country, gram, df, ctf`` of ``country, text``, several rows a gram: sums of the parts of a task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[list[np.ndarray]]] = {}
        for batch in batches:
            for country, rows in _by(batch, "country"):
                _, key, tf = gram_counts_of(_texts(rows))
                parts = held.setdefault(country, [])
                parts.append(_summed(key, np.ones(len(key), np.int64), tf))
                if len(parts) > 20:
                    held[country] = [_summed(*[np.concatenate(x) for x in zip(*parts)])]
        for country, parts in held.items():
            key, df, ctf = _summed(*[np.concatenate(x) for x in zip(*parts)])
            grams = [_gram(k) for k in key.view(np.uint64).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([country] * len(key), pa.string()), pa.array(grams, pa.string()), pa.array(df), pa.array(ctf)], ["country", "gram", "df", "ctf"])

    return texts.mapInArrow(count, "country string, gram string, df long, ctf long")


class _Folder:
    """Tables of the shared folder, read in a task."""

    def __init__(self, uri: str):
        self.files, self.base = pa.fs.FileSystem.from_uri(uri)

    def read(self, path: str) -> pa.Table:
        return pq.read_table(f"{self.base}/{path}", filesystem=self.files, partitioning=None)

    def has(self, path: str) -> bool:
        return self.files.get_file_info(f"{self.base}/{path}").type == pa.fs.FileType.Directory


class _Vocabulary:
    """A country's grams, numbered from the most frequent."""

    def __init__(self, rows: pa.Table):
        grams, df = rows.column("gram").to_pylist(), rows.column("df").to_numpy()
        keys = np.array([_key(g) for g in grams], np.uint64).view(np.int64)
        order = np.lexsort((keys, -df))
        number = np.empty(len(keys), np.int64)
        number[order] = np.arange(len(keys))
        self.idf = rows.column("idf").to_numpy()[order]
        by_key = np.argsort(keys)
        self.keys, self.numbers = keys[by_key], number[by_key]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of texts, numbers of grams and how often they are there, in order of both; grams outside are left out."""
        place, key, tf = gram_counts_of(texts)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = self.keys[at] == key
        place, number, tf = place[known], self.numbers[at[known]], tf[known]
        order = np.argsort(place * len(self.keys) + number)
        return place[order], number[order], tf[order]

    def weights(self, place: np.ndarray, number: np.ndarray, tf: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Weights of grams, not yet divided by the norms, and these."""
        x = (1 + np.log(tf, dtype=np.float64)) * self.idf[number]
        return x, np.sqrt(np.bincount(place, weights=x * x, minlength=n))


def _binary(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64) * values.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])


def _values(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    x = column.combine_chunks()
    x = x.chunk(0) if isinstance(x, pa.ChunkedArray) else x
    ends = np.frombuffer(x.buffers()[1], np.int64 if pa.types.is_large_binary(x.type) else np.int32)[x.offset : x.offset + len(x) + 1]
    return np.frombuffer(x.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(kind)


def encoded(texts: DataFrame, uri: str, wide: bool, apart: tuple[str, ...]) -> DataFrame:
    """``c, b, entity_id, n, grams, tfs`` and the columns of apart, of ``c, b, entity_id, text``; records without a known gram are left out."""
    kind = np.uint32 if wide else np.uint16

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder, known = _Folder(uri), {}
        for batch in batches:
            for c, rows in _by(batch, "c"):
                if c not in known:
                    known[c] = _Vocabulary(folder.read(f"vocabulary/c={c}"))
                place, number, tf = known[c].encode(_texts(rows))
                sizes = np.bincount(place, minlength=len(rows))
                kept = pa.array(np.flatnonzero(sizes))
                sizes = sizes[sizes > 0]
                # The same number of bytes for each: differences compress better than numbers.
                grams = np.diff(number, prepend=0)
                starts = np.cumsum(sizes) - sizes
                grams[starts] = number[starts]
                out = [rows.column(x).take(kept).combine_chunks() for x in ("c", "b", "entity_id")]
                out = [x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in out]
                columns = [*out, pa.array(sizes.astype(np.int32)), _binary(grams.astype(kind), sizes).cast(pa.binary()), _binary(tf.astype(np.uint16), sizes).cast(pa.binary())]
                for x in apart:
                    y = rows.column(x).take(kept).combine_chunks()
                    columns.append(y.chunk(0) if isinstance(y, pa.ChunkedArray) else y)
                yield pa.RecordBatch.from_arrays(columns, ["c", "b", "entity_id", "n", "grams", "tfs", *apart])

    return texts.mapInArrow(encode, "c int, b int, entity_id string, n int, grams binary, tfs binary" + "".join(f", {x} long" for x in apart))


def _keys_of(rows: pa.Table, apart: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Values of columns and whether they are there, a row a column."""
    keys, valid = np.zeros((len(apart), len(rows)), np.int64), np.zeros((len(apart), len(rows)), bool)
    for i, x in enumerate(apart):
        keys[i], valid[i] = rows.column(x).fill_null(0).to_numpy(), rows.column(x).is_valid().to_numpy()
    return keys, valid


class _Block:
    def __init__(self, rows: pa.Table, words: _Vocabulary, wide: bool, apart: tuple[str, ...]):
        rows = rows.combine_chunks()
        self.ids = rows.column("entity_id").combine_chunks()
        self.size = rows.column("n").to_numpy().astype(np.int64)
        self.n = n = len(self.size)
        self.starts = np.cumsum(self.size) - self.size
        owner = np.repeat(np.arange(n), self.size)
        summed = np.cumsum(_values(rows.column("grams"), np.uint32 if wide else np.uint16), dtype=np.int64)
        summed -= np.repeat(summed[self.starts] - _values(rows.column("grams"), np.uint32 if wide else np.uint16)[self.starts], self.size)
        self.grams = summed.astype(np.uint32 if wide else np.uint16)
        self.tf = _values(rows.column("tfs"), np.uint16)
        del summed
        x, self.norm = words.weights(owner, self.grams, self.tf, n)
        w = (x / self.norm[owner]).astype(np.float32)
        del x
        self.lead = [np.zeros(n, np.float32) if not level else np.sqrt(np.bincount(owner, weights=np.where(self.grams < level, w * w, 0), minlength=n)).astype(np.float32) for level in LEVELS]
        self.usual = [float(h.mean()) for h in self.lead]
        order = np.argsort(self.grams, kind="stable")
        self.posts = owner[order]
        del owner
        self.w = w[order]
        del order, w
        self.at = np.concatenate([[0], np.cumsum(np.bincount(self.grams, minlength=len(words.idf)))])
        self.place = np.empty(n, np.int64)
        self.place[pc.sort_indices(self.ids).to_numpy()] = np.arange(n)
        self.keys, self.valid = _keys_of(rows, apart)
        self.sums = np.zeros(n, np.float32)

    def add(self, grams: np.ndarray, weights: np.ndarray) -> None:
        begin, end = self.at[grams], self.at[grams + 1]
        size = end - begin
        for s, e, x in zip(*[v[size > LONG].tolist() for v in (begin, end)], weights[size > LONG]):
            self.sums[self.posts[s:e]] += self.w[s:e] * x  # a candidate has a gram once
        short = size <= LONG
        begin, size = begin[short], size[short]
        at = np.arange(size.sum()) + np.repeat(begin - np.cumsum(size) + size, size)
        np.add.at(self.sums, self.posts[at], self.w[at] * np.repeat(weights[short], size))

    def cosines(self, rows: np.ndarray, scaled: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows))
        for i in range(0, len(rows), FEW):
            some = rows[i : i + FEW]
            size = self.size[some]
            ends = np.cumsum(size)
            at = np.arange(ends[-1]) + np.repeat(self.starts[some] - ends + size, size)
            x, tf = scaled[self.grams[at]], self.tf[at]
            more = np.flatnonzero(tf > 1)
            x[more] *= 1 + np.log(tf[more], dtype=np.float64)
            out[i : i + FEW] = np.add.reduceat(x, ends - size) / self.norm[some]
        return out

    def best(self, grams: np.ndarray, w: np.ndarray, idf: np.ndarray, scaled: np.ndarray, k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows of at most k candidates that reach ``least``, the best first, and their rounded similarities."""
        lead = np.searchsorted(grams, LEVELS)
        norms = [math.sqrt(float(w[:j] @ w[:j])) for j in lead]
        loose = max(LOOSE, 0.5 * least)
        level = max(i for i, x in enumerate(norms) if x * self.usual[i] <= loose)
        j = lead[level]
        single = w.astype(np.float32)
        self.sums.fill(0)
        self.add(grams[j:], single[j:])
        if not least and self.n > k:
            # The best of parts of the block are good enough to start from.
            step = max(1, self.n // (4 * k))
            parts = self.sums[: self.n // step * step].reshape(-1, step)
            some = parts.argmax(1) + np.arange(len(parts)) * step
            some = some[np.argpartition(self.sums[some], -k)[-k:]]
            least = max(0.0, float(np.round(self.cosines(some, scaled).min(), 6)))
        bound = self.sums + self.lead[level] * np.float32(norms[level]) if j else self.sums
        rows = np.flatnonzero((bound >= least - SLACK) & (bound > 0))
        if len(rows) > FEW and j:
            self.add(grams[:j], single[:j])
            rows = np.flatnonzero((self.sums >= least - SLACK) & (self.sums > 0))
        sims = np.round(self.cosines(rows, scaled), 6)
        kept = (sims > 0) & (sims >= least)
        rows, sims = rows[kept], sims[kept]
        order = np.lexsort((self.place[rows], -sims))[:k]
        return rows[order], sims[order]


def nearest(texts: DataFrame, uri: str, blocks: dict[int, int], k: int, wide: bool, apart: tuple[str, ...]) -> DataFrame:
    """``source1_entity_id, candidate_entity_id, sim``, for ``c, entity_id, text``: the k best of all blocks of the country, without those that share a value of a column of apart."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        folder = _Folder(uri)
        for c, rows in _by(pa.Table.from_batches(held), "c"):
            words = _Vocabulary(folder.read(f"vocabulary/c={c}"))
            place, number, tf = words.encode(_texts(rows))
            x, norm = words.weights(place, number, tf, len(rows))
            ends = np.searchsorted(place, np.arange(len(rows) + 1))
            keys, valid = _keys_of(rows, apart)
            found: list[list[tuple[float, str, bool]]] = [[] for _ in range(len(rows))]
            scaled = np.zeros(len(words.idf))
            for b in range(blocks[c]):
                if not folder.has(f"candidates/c={c}/b={b}"):
                    continue
                block = _Block(folder.read(f"candidates/c={c}/b={b}"), words, wide, apart)
                for i in range(len(rows)):
                    grams, w = number[ends[i] : ends[i + 1]], x[ends[i] : ends[i + 1]] / norm[i]
                    if not len(grams):
                        continue
                    scaled[grams] = w * words.idf[grams]
                    best = found[i]
                    at, sims = block.best(grams, w, words.idf, scaled, k, -best[-1][0] if len(best) == k else 0.0)
                    scaled[grams] = 0
                    if len(at):
                        shared = ((block.keys[:, at] == keys[:, i, None]) & block.valid[:, at] & valid[:, i, None]).any(0) if apart else np.zeros(len(at), bool)
                        best += zip((-sims).tolist(), block.ids.take(pa.array(at)).to_pylist(), shared.tolist())
                        if b:
                            best.sort()
                            del best[k:]
                del block
                pa.default_memory_pool().release_unused()
            ids = rows.column("entity_id").to_pylist()
            out = [(ids[i], other, -sim) for i, best in enumerate(found) for sim, other, shared in best if not shared]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in zip(*out)], ["source1_entity_id", "candidate_entity_id", "sim"])

    return texts.mapInArrow(search, "source1_entity_id string, candidate_entity_id string, sim double")
