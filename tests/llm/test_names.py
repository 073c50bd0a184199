"""The trie search against plain distances; names of one organisation."""

import random
from itertools import permutations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from linkloom.llm.names import Words, ends_of, errors, frequent_words, lowest_reached, name_pairs, piece_keys, read_name, shards, trie_links
from linkloom.llm.tries import few_errors, near, spanning
from linkloom.runtime import Scratch


def plain(a, b):
    d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            if not i or not j:
                d[i][j] = i + j
                continue
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


TEXT = st.text("abc", max_size=9)


@settings(max_examples=500, deadline=None)
@given(TEXT, TEXT)
def test_distances(a, b):
    for k in (1, 2):
        assert errors(a, b, k) == (plain(a, b) <= k)
        assert few_errors(a, b, k) == (plain(a, b) if plain(a, b) <= k else None)


def test_tries_find_what_comparison_finds():
    r = random.Random(3)
    texts = ["".join(r.choice("abcd") for _ in range(r.randint(0, 8))) for _ in range(300)] + ["日本abc", "日木abc", "日本", ""]
    texts += ["a" * k for k in (60, 61, 62, 63, 64, 65, 66)] + ["b" + "a" * 63]
    group = np.array([r.randrange(5) for _ in texts[:-8]] + [2] * 8)
    home = np.array([r.random() < 0.6 for _ in texts[:-8]] + [True] * 8)
    once = lambda x, y: (x, y) if not home[x] or x < y else (y, x)
    got = [(*once(x, y), z) for a, b, wrong in near(pa.array(texts), group, home) for x, y, z in zip(a.tolist(), b.tolist(), wrong.tolist())]
    n = range(len(texts))
    want = {(*once(i, j), plain(texts[i], texts[j])) for i in n for j in n if i != j and home[j] and group[i] == group[j] and abs(len(texts[i]) - len(texts[j])) < 3 and plain(texts[i], texts[j]) <= 2}
    assert len(got) == len(set(got)) and set(got) == want


def test_spanning_links_connect_the_same():
    r = random.Random(9)
    a, b = (np.array([r.randrange(80) for _ in range(60)]) for _ in range(2))
    low = dict(zip(*reversed(spanning(a, b))))
    find = lambda v: low.get(v, v)
    assert all(find(x) == find(y) <= min(x, y) for x, y in zip(a, b))


def linked(spark, cores, cap=20_000):
    """Pairs of cores linked directly or through others."""
    df = spark.createDataFrame([(c, i) for i, c in enumerate(cores)], "core string, id long")
    scratch = Scratch(spark, "test")
    low = {r.id: r.low for r in lowest_reached(trie_links(shards(df), scratch, cap), scratch).collect()}
    return {cores[i]: cores[low.get(i, i)] for i in {*low, *low.values()}}


def groups(cores, near):
    """The smallest core by place of each group of cores that are near each other, of groups of two or more."""
    low = list(range(len(cores)))
    moved = True
    pairs = [(i, j) for i in range(len(cores)) for j in range(i) if near(cores[i], cores[j])]
    while moved:
        moved = False
        for i, j in pairs:
            if low[i] != low[j]:
                low[i] = low[j] = min(low[i], low[j])
                moved = True
    return {cores[i]: cores[low[i]] for i in {k for p in pairs for k in p}}


def near_cores(a, b):
    if min(len(a.replace(" ", "")), len(b.replace(" ", ""))) < 4:
        return False
    most = 2 if min(len(a.replace(" ", "")), len(b.replace(" ", ""))) >= 6 else 1
    return any(errors(x, y, most) for x in {"".join(o) for o in permutations(a.split())} for y in {"".join(o) for o in permutations(b.split())})


def test_splitting_a_hot_shard_loses_nothing(spark):
    r = random.Random(5)
    cores = sorted({"commonhead" + "".join(r.choice("ab") for _ in range(8)) for _ in range(40)} | {"commonhead" + "".join(r.choice("cdefgh") for _ in range(8)) for _ in range(40)} | {"commonheadcdefghcd", "cmmonheadcdefghcde"})
    want = groups(cores, near_cores)
    for cap in (20_000, 30, 3):
        assert linked(spark, cores, cap) == want


@settings(max_examples=3000, deadline=None)
@given(st.text("abcdefgh", min_size=4, max_size=30), st.lists(st.tuples(st.sampled_from("irds"), st.integers(0, 40), st.sampled_from("abz")), max_size=2))
def test_texts_within_the_bound_share_a_shard(a, edits):
    b = a
    for kind, at, ch in edits:
        at %= len(b) + (kind == "i")
        b = {"i": b[:at] + ch + b[at:], "r": b[:at] + ch + b[at + 1 :], "d": b[:at] + b[at + 1 :], "s": b[:at] + b[at : at + 2][::-1] + b[at + 2 :]}[kind]
    if plain(a, b) <= 2:
        assert piece_keys(a) & piece_keys(b)
    if min(len(a), len(b)) >= 4 and plain(a, b) <= (2 if min(len(a), len(b)) >= 6 else 1):
        x, y = ({k for k, _ in ends_of(t)} for t in (a, b))
        short = lambda k: {k[:i] + k[i + 1 :] for i in range(1, len(k))}
        assert x & y or any(len(p) == len(q) and short(p) & short(q) for p in x for q in y if p[0] == q[0] == "<")


def test_shards_find_what_comparison_finds(spark):
    r = random.Random(7)
    plainly = ["pelmorisk", "plemorisk", "dormikmik lorzorju", "lrozorjudormikmik", "hobgnesvik zoryarful", "zoryarfulhobgevik", "kitgar relpon", "kizgar rexpon", "abcd", "abce"]
    plainly += ["grisonber pelmorisk tavjordov", "grisonbex pelmorisk tavjordov", "kovid", "kovit", "pelko tavko", "pelmo tavjo", "sebrukvas", "zebrukvas"]
    syllables = ["pel", "mor", "isk", "tav", "jor"]
    cores = set(plainly)
    for _ in range(170):
        ws = ["".join(r.choice(syllables) for _ in range(r.randint(1, 3))) for _ in range(r.randint(1, 3))]
        for _ in range(r.randrange(3)):
            w = r.randrange(len(ws))
            at = r.randrange(len(ws[w]))
            ws[w] = ws[w][:at] + r.choice(["x", "y", "z", "", "qq"]) + ws[w][at + 1 :]
        cores.add(" ".join(sorted(ws)))
    cores = sorted(cores)
    got = linked(spark, cores)
    assert got == groups(cores, near_cores)
    assert all(got[a] == got[b] for a, b in zip(plainly[::2], plainly[1::2]))


def test_a_long_chain_is_one_organisation(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(150)], "a long, b long")
    for one_task in (0, 1000):
        got = lowest_reached(links, Scratch(spark, "chain"), one_task).collect()
        assert sorted(r.id for r in got) == list(range(1, 151)) and {r.low for r in got} == {0}


def test_reading():
    words = Words(["summit", "vikvoville"])
    assert read_name("summit pelmorisk tavjordov pharmacy", words)[0][0] == ["pelmorisk", "tavjordov"]
    assert read_name("pharmacy of summit tavjordov pelmorisk and", words)[0][0] == ["tavjordov", "pelmorisk"]
    assert read_name("summit pelmorisk tavjordov t a pelmorisk", words)[0][0] == ["pelmorisk", "tavjordov"]
    assert read_name("pelmorisk tavjordov bakery morixton branch", words)[0][0] == ["pelmorisk", "tavjordov"]
    assert read_name("charlie masberjor kemvikges constr", words)[1:] == ("charles", "", "", ["construction"])
    assert read_name("", words)[0] == read_name(None, words)[0] == read_name("the bakery and sons", words)[0] == []


ORGS = {
    "a": ["summit pelmorisk tavjordov pharmacy", "tavjordov pelmorisk phcy", "summit pelmorsk tavjordov", "summit pe1morisk tavjordov pharmacy", "pelmorisktavjordov pharmacy", "summit pelmor isk tavjordov"],
    "b": ["robert humlatvik grisonber bakery", "bob humlatvik grisonber bakery", "robert humlatvik grisonbre bakery"],
    "c": ["susan humlatvik grisonber hardware", "s humlatvik grisonber hardware"],
    "d": ["zebrukvas dorlynpel motors"],
}


def test_words_of_a_large_organisation_are_its_own(spark):
    r = random.Random(11)
    word = lambda: "".join(r.choice("bdfgklmnprstvz") + r.choice("aeiou") for _ in range(4)) + r.choice("kmnrt")
    towns = [word() for _ in range(60)]
    slip = lambda w: (lambda i: w[:i] + r.choice("aeiou") + w[i + 1 :])(r.randrange(len(w)))
    exact = sorted({f"pelmorisk tavjordov {t} {town} branch" for town in towns for t in ("pharmacy", "bakery")} | {"pelmorisk tavjordov", "tavjordov pelmorisk hospital"})
    slips = [f"{slip('pelmorisk')} tavjordov" for _ in range(40)] + [f"pelmorisk {slip('tavjordov')} clinic" for _ in range(40)]
    others = [f"heritage {word()} {word()}" for _ in range(300)]
    df = spark.createDataFrame([(n,) for n in sorted({*exact, *slips, *others})], "clean_name string")
    shared = frequent_words(df)
    assert "heritage" in shared and "pelmorisk" not in shared and "tavjordov" not in shared
    got = {tuple(x) for x in name_pairs(df).collect()}
    assert all((a, b) in got for a in exact for b in exact if a < b)
    assert not any("heritage" in a or "heritage" in b for a, b in got)


def test_long_names(spark):
    r = random.Random(13)
    word = "".join(r.choice("abcdefgh") for _ in range(90))
    other = word[:30] + "xyz" + word[33:]
    rows = [(word,), (word[:40] + word[41:],), (other,), (word[:30] + "q" + word[30:80] + word[81:],)]
    got = {tuple(x) for x in name_pairs(spark.createDataFrame(rows, "clean_name string")).collect()}
    assert got == {tuple(sorted((rows[i][0], rows[j][0]))) for i, j in ((0, 1), (0, 3), (1, 3))}


def test_a_name_of_counted_words_only_keeps_them():
    words = Words(["pelmorisk", "tavjordov"])
    assert read_name("pelmorisk tavjordov bakery", words)[0] == [["pelmorisk", "tavjordov"]]
    assert read_name("pelmorisk tavjordov humlatvik grisonber", words)[0][0] == ["humlatvik", "grisonber"]


def test_pairs(spark):
    rows = [(n, "x") for names in ORGS.values() for n in names] * 2 + [(None, "x"), ("", "x"), ("bakery and sons", "x"), ("q" * 4000, "x")]
    got = {tuple(r) for r in name_pairs(spark.createDataFrame(rows, "clean_name string, core string")).collect()}
    assert got == {(a, b) for names in ORGS.values() for a in names for b in names if a < b}
    assert name_pairs(spark.createDataFrame([], "clean_name string")).count() == 0
