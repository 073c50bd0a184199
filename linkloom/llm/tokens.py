"""Byte-pair encoding of a whole corpus by backtracking over longest matches.

A greedy merge loop is quadratic in the piece.  This encoder walks a piece once: an Aho-Corasick
automaton reports all vocabulary tokens by their ends, the longest token at the current place is
tried first, and a pair of neighbours is kept only if merging their concatenation would give just
those two tokens again (``compatible``).  Where no token fits, the last one is taken back and the
next shorter one is tried; a bitmap of dead places makes each place fail at most once.  The result
is the one the merges define.  Ids must be in order of the merges, as in rank files.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator, Sequence
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: the public pattern that splits text before the merges of byte-level vocabularies.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Pieces of which a worker keeps the ids; beyond that the piece is encoded anew each time.
CACHE_PIECES = 400_000
TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"


class Vocabulary:
    """A rank file: one token in base 64 and its rank a line, ranks in order of the merges."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.tokens = [b""] * len(pairs)
        for token, rank in pairs:
            self.tokens[int(rank)] = base64.b64decode(token)
        self.ids = {t: i for i, t in enumerate(self.tokens)}
        # Decoding: token i is data[offsets[i]:offsets[i + 1]].
        self.data = np.frombuffer(b"".join(self.tokens), dtype=np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in self.tokens])]).astype(np.int64)
        self._learn_splits()
        self.automaton = ahocorasick.Automaton()
        for i, t in enumerate(self.tokens):
            self.automaton.add_word(t.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.splitter = regex.compile(SPLIT)
        self.known: dict[str, tuple[int, ...]] = {}

    def _learn_splits(self) -> None:
        """left, right: the two tokens whose merge makes a token (itself, for a single byte); merged: the pair's token."""
        n = len(self.tokens)
        self.left, self.right = list(range(n)), list(range(n))
        self.born = [-1 if len(t) == 1 else i for i, t in enumerate(self.tokens)]  # the merge that makes a token
        self.merged: dict[int, int] = {}
        ids = self.ids
        for i, t in enumerate(self.tokens):
            for k in range(1, len(t)):
                a, b = ids.get(t[:k], n), ids.get(t[k:], n)
                if a < i and b < i and self.compatible(a, b):
                    self.left[i], self.right[i] = a, b
                    self.merged[a << 32 | b] = i
                    break

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merges of a's bytes followed by b's give exactly a, b.

        They do unless some merge crosses the border.  At any time one token x of those that end in a's last byte and one
        token y of those that begin with b's first byte meet at the border: x from the merge that makes it until the
        merge that takes it into a longer one, and y likewise.  The merge of x with y crosses if its turn comes before both
        are taken in; of equal merges the left one is first.  The pairs that meet are visited from the end of the merges back.
        """
        merged, born = self.merged, self.born
        x, y = a, b
        x_until = y_until = len(self.tokens)
        while True:
            crossing = merged.get(x << 32 | y)
            if crossing is not None and crossing < x_until and crossing <= y_until:
                return False
            if born[x] > born[y]:
                x_until, x = x, self.right[x]
            elif born[y] >= 0:
                y_until, y = y, self.left[y]
            else:
                return True

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        n = len(piece)
        starts: list[list[int]] = [[] for _ in range(n)]  # tokens by their start, shortest first
        sizes = self.offsets
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            starts[end + 1 - int(sizes[token + 1] - sizes[token])].append(token)
        alive = [True] * (n + 1)
        out: list[int] = []
        rank: list[int] = []  # which of starts[place] each kept token was
        place, k = 0, len(starts[0]) - 1
        while place < n:
            here = starts[place]
            while k >= 0:
                token = here[k]
                end = place + int(sizes[token + 1] - sizes[token])
                if alive[end] and (not out or self.compatible(out[-1], token)):
                    break
                k -= 1
            if k >= 0:
                out.append(token)
                rank.append(k)
                place = end
                k = len(starts[place]) - 1 if place < n else -1
            else:
                alive[place] = False
                token = out.pop()
                place -= int(sizes[token + 1] - sizes[token])
                k = rank.pop() - 1
        return out

    def piece_ids(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode("utf-8", "surrogatepass")
        whole = self.ids.get(raw)
        return (whole,) if whole is not None else tuple(self.encode_piece(raw))

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; a null or empty text has none."""
        out: list[int] = []
        if text:
            known = self.known
            for piece in self.splitter.findall(text):
                ids = known.get(piece)
                if ids is None:
                    ids = self.piece_ids(piece)
                    if len(known) < CACHE_PIECES:
                        known[piece] = ids
                out += ids
        return out

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """Bytes of ids, gathered through the offset table."""
        ids = np.asarray(ids, dtype=np.int64)
        if not len(ids):
            return b""
        size = self.offsets[ids + 1] - self.offsets[ids]
        ends = np.cumsum(size)
        take = np.arange(ends[-1]) + np.repeat(self.offsets[ids] - (ends - size), size)
        return self.data[take].tobytes()


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary a worker process."""
    return Vocabulary(path)


def encode_documents(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = f"{TOKENIZERS}/{VOCABULARY}", count_only: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """``id_col``, the columns of ``keep``, and ``ids`` (array of integers; with count_only ``n_tokens`` instead) of each document.

    Null and empty texts have the empty list (0 tokens); blank ones have the ids of their white space.
    Strings of special tokens are ordinary text.  One row per row: nothing is shuffled, repeated ids stay
    repeated, other columns are not read.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            others = [batch.column(i) for i in range(1, batch.num_columns)]
            if count_only:
                counts = pa.array([len(v.encode(t)) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([*others, counts], [id_col, *keep, "n_tokens"])
                continue
            flat, ends = [], [0]
            for t in texts:
                flat.append(np.array(v.encode(t), dtype=np.int32))
                ends.append(ends[-1] + len(flat[-1]))
            values = pa.array(np.concatenate(flat) if flat else np.zeros(0, np.int32))
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            yield pa.RecordBatch.from_arrays([*others, ids], [id_col, *keep, "ids"])

    kept = documents.select(F.col(f"`{text_col}`").cast("string").alias("__text"), *[F.col(f"`{c}`") for c in (id_col, *keep)])
    field = T.StructField("n_tokens", T.LongType()) if count_only else T.StructField("ids", T.ArrayType(T.IntegerType(), False))
    return kept.mapInArrow(encode, T.StructType([*kept.schema.fields[1:], field]))


def decode_documents(encoded: DataFrame, id_col: str = "doc_id", path: str = f"{TOKENIZERS}/{VOCABULARY}") -> DataFrame:
    """``id_col``, ``text`` of encoded documents; the empty or null list gives the empty text."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            texts = [v.decode_bytes(np.array(x or [], dtype=np.int64)).decode("utf-8", "replace") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    kept = encoded.select(F.col(f"`{id_col}`"), F.col("ids"))
    return kept.mapInArrow(decode, T.StructType([kept.schema[0], T.StructField("text", T.StringType())]))


def default_path(spark: SparkSession | None = None) -> str:
    """The vocabulary file, on every executor: of the folder that the session names in ``spark.linkloom.tokenizers``, else of TOKENIZERS."""
    spark = spark or SparkSession.getActiveSession()
    folder = spark.conf.get("spark.linkloom.tokenizers", None) if spark else None
    return os.path.join(folder or TOKENIZERS, VOCABULARY)
