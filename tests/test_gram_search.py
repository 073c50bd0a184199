"""The neighbour search: equal to comparing all pairs, without their rows on disk."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linkloom.operators import gram_search as G
from linkloom.operators import neighbors as N

SCHEMA = "entity_id string, country string, clean_name string, clean_addr string, postal string"


def made(seed, prefix, n):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcde") for _ in range(r.randint(1, 4)))
    for i in range(n):
        name = r.choice(["", "aa aa aa aa", "acme", " ".join(word() for _ in range(4))])
        yield f"{prefix}-{i:08d}", r.choice(["US", "US", "US", " us", "", None, "FR" if prefix == "S1" else "CA"]), name, r.choice(["", f"{r.randint(1, 30)} main road", word()]), r.choice(["", "12345", "٣٣٣٣٣", "𝟏𝟐𝟑𝟒𝟓"])


def grams(text):
    return Counter(g for w in text.split() for n in (2, 3, 4) if n <= len(w) + 2 for g in [f" {w} "[i : i + n] for i in range(len(w) + 3 - n)])


def all_pairs(left, right, k, vocabulary):
    of = lambda rows: {i: (c, grams(f"{a} {b} {p}")) for i, c, a, b, p in rows if c}
    left, right = of(left), of(right)
    stats, n = defaultdict(lambda: [0, 0]), Counter(c for c, _ in right.values())
    for c, g in right.values():
        for x, tf in g.items():
            stats[c, x][0] += 1
            stats[c, x][1] += tf
    known = {}
    for c in n:
        best = sorted((-ctf, x.encode()) for (d, x), (_, ctf) in stats.items() if d == c)[:vocabulary]
        known[c] = {x.decode(): math.log((1 + n[c]) / (1 + stats[c, x.decode()][0])) + 1 for _, x in best}

    def unit(c, g):
        v = {x: (1 + math.log(tf)) * known[c][x] for x, tf in g.items() if x in known.get(c, ())}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {x: y / norm for x, y in v.items()}

    others = {i: (c, unit(c, g)) for i, (c, g) in right.items()}
    out = {}
    for i, (c, g) in left.items():
        a = unit(c, g)
        sims = sorted((-round(sum(x * b.get(y, 0) for y, x in a.items()), 6), j) for j, (d, b) in others.items() if d == c)
        out |= {(i, j): -s for s, j in sims[:k] if s < 0}
    return out


@pytest.mark.parametrize("vocabulary", [None, 150, 30_000])
def test_neighbours_equal_those_of_all_pairs(spark, monkeypatch, vocabulary):
    monkeypatch.setattr(N, "BLOCK", 40)
    left, right = list(made(1, "S1", 60)), list(made(2, "S2", 200))
    got = {(r[0], r[1]): r[2] for r in N.tfidf_topk(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), 7, vocabulary).collect()}
    want = all_pairs(left, right, 7, vocabulary)
    assert set(got) == set(want)
    assert all(abs(got[p] - want[p]) < 1.1e-6 for p in want)


def test_no_candidates(spark):
    left = spark.createDataFrame(list(made(1, "S1", 5)), SCHEMA)
    assert N.tfidf_topk(left, left.where("false"), 7).count() == 0


@pytest.mark.parametrize("loose", [0.0, 0.2, 2.0])
def test_bounds_leave_no_neighbour_out(monkeypatch, loose):
    monkeypatch.setattr(G, "LOOSE", loose)
    monkeypatch.setattr(G, "LEVELS", (0, 5, 20, 60))
    monkeypatch.setattr(G, "FEW", 9)
    monkeypatch.setattr(G, "LONG", 30)
    right = [x for x in made(3, "S2", 300) if x[2] or x[3] or x[4]]
    texts = pa.array([f"{a} {b} {p}" for _, _, a, b, p in right])
    key, df, _ = G._summed((c := G.gram_counts_of(texts))[1], np.ones(len(c[1]), np.int64), c[2])
    words = G._Vocabulary(pa.table({"gram": [G._gram(k) for k in key.view(np.uint64).tolist()], "df": df, "idf": np.log(301 / (1 + df)) + 1}))
    place, number, tf = words.encode(texts)
    n = np.bincount(place, minlength=len(texts))
    steps = np.where(np.diff(place, prepend=-1) != 0, number, np.diff(number, prepend=0))
    rows = pa.table({"entity_id": [x[0] for x in right], "n": n.astype(np.int32), "grams": G._binary(steps.astype(np.uint16), n).cast(pa.binary()), "tfs": G._binary(tf.astype(np.uint16), n).cast(pa.binary())})
    block = G._Block(rows, words, False, ())
    x, norm = words.weights(place, number, tf, len(texts))
    every = np.zeros((len(texts), len(words.idf)))
    every[place, number] = x / norm[place]
    sims = np.round(every @ every.T, 6)
    for i in range(0, len(texts), 3):
        g = np.flatnonzero(every[i])
        at, got = block.best(g, every[i, g], words.idf, every[i] * words.idf, 10, 0.0)
        want = sorted((-sims[i, j], right[j][0]) for j in range(len(texts)) if sims[i, j] > 0)[:10]
        assert [right[j][0] for j in at] == [j for _, j in want]
        assert np.allclose(got, [-s for s, _ in want], atol=1.1e-6)


def shuffled(spark):
    gateway = spark.sparkContext._gateway
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_search_shuffles_no_grams_or_pairs(spark):
    # every gram of a record and every pair with a common one went through the shuffle.
    rows = lambda prefix, n: spark.range(n).select(F.format_string(f"{prefix}-%08d", "id").alias("entity_id"), F.lit("US").alias("country"), F.concat(F.lit("acme "), F.md5(F.col("id").cast("string"))).alias("clean_name"), F.lit("main road").alias("clean_addr"), F.lit("").alias("postal"))
    left, right = rows("S1", 300), rows("S2", 400)
    before = shuffled(spark)
    assert N.tfidf_topk(left, right, 5).count() == 1500
    # 4,469,668 bytes before, 471,409 now, most of them counts of grams.
    assert shuffled(spark) - before < 1_000_000
