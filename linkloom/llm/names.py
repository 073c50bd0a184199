"""Variant spellings of organisation names.

A name is reduced to its core: the words that are its own, without legal forms, trades, given names and
other words that very many names share (found by counting), mended and in any order.  Cores are
joined by tries: the joined letters of each core, in the orders of its words, go into shards by their beginning and
their end, a shard's texts make a trie, and automata that accept all words within the distance
bound walk it, so a whole shard is searched without comparing its members one by one.  What is linked
directly or through others is one organisation, named by its most frequent core.

No link is lost.  Of two texts within two errors, the shorter of s letters, take the first s // 2 and the last (s - 1) // 2
letters (HALF at most): no error, not even a swap, touches both ends.  If both errors touch the beginnings, the ends are equal and a
shard of an end holds both texts.  If one at most does, the beginnings are equal, or leaving out one letter of each makes them
equal; then the texts of the rarer beginning visit the shard of the other.  Shards beyond a cap are split by pieces
of the rest (see ``piece_keys``), which lose nothing either.
"""

from __future__ import annotations

from collections.abc import Iterator

from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm.tries import MOST, near, spanning, whole_groups
from linkloom.runtime import Scratch, in_order, regroup

# Legal forms, honorifics, connectives, trades, and given names with their short forms.
NAME_FILLERS = (
    "and et of the de la le les du des und cie co company corp inc ltd limited pvt private llc llp plc sa sas sarl gmbh ag regd registered "
    "ms messrs mr mrs dr shri shree sri smt m s l p c a r branch group enterprise enterprises services service solutions"
).split()
ALIAS_MARKS = ("dba", "d b a", "t a", "aka", "a k a", "trading as", "fka", "f k a")
TRADES = (
    "hardware construction engineering pharmacy brothers hospital bakery dental agency auto clinic plumbing repair electric catering realty "
    "landscaping logistics works furniture motors veterinary medical insurance manufacturing steel sweets center store caterers associates medicals textiles sons "
    "agencies traders exports jewellers general industries electronics menuiserie pharmacie boulangerie conseil batiment fils plomberie freres distribution "
    "electricite restaurant transports trading export import electrical consulting cleaning salon spa cafe hotel foods food motor garage tailors school academy "
    "printing press paints tools supply supplies studio design travel travels tours security systems fashion boutique opticians optical laundry couriers transport "
    "builders contractors developers properties farm farms dairy nursery books stationers stationery mobile mobiles computers diagnostics laboratory labs "
    "boucherie coiffure fleuriste garage librairie traiteur immobilier peinture maconnerie charpente jardinage nettoyage"
).split()
SHORT_TRADES = {
    "bros": "brothers", "bro": "brothers", "frs": "freres", "engg": "engineering", "engrg": "engineering", "engr": "engineering", "constr": "construction",
    "const": "construction", "phcy": "pharmacy", "pharm": "pharmacy", "hosp": "hospital", "hsptl": "hospital", "vet": "veterinary", "med": "medical",
    "furn": "furniture", "furnitures": "furniture", "insur": "insurance", "ins": "insurance", "manuf": "manufacturing", "mfg": "manufacturing",
    "elec": "electric", "electro": "electronics", "assoc": "associates", "assocs": "associates", "ctr": "center", "centre": "center", "gen": "general",
    "genl": "general", "jewelers": "jewellers", "jwlrs": "jewellers", "trdrs": "traders", "agcy": "agency", "agencys": "agencies", "inds": "industries",
    "indus": "industries", "exp": "exports", "distrib": "distribution", "resto": "restaurant", "rest": "restaurant", "bat": "batiment", "transp": "transports",
    "trpts": "transports", "diffusion": "distribution",
}
GIVEN_NAMES = {
    "charles": "chuck charlie charley", "alexander": "alex sandy", "robert": "bob rob bobby", "william": "bill will billy", "richard": "rick dick rich",
    "elizabeth": "elisabeth liz beth betty lisbeth babette", "margaret": "maggie peggy meg", "virginia": "ginny", "katherine": "catherine kathy kate katie", "james": "jim jimmy jamie",
    "john": "jack johnny jon", "theodore": "ted teddy", "anthony": "tony", "dorothy": "dot dottie dolly", "edward": "ed eddie ned", "leonard": "len lenny leo",
    "francis": "frank fran", "susan": "sue susie", "henry": "hank harry", "patricia": "pat patty trish", "michael": "mike mick", "thomas": "tom tommy",
    "joseph": "joe joey", "david": "dave", "daniel": "dan danny", "andrew": "andy drew", "mohammed": "mohd muhammad mohammad md", "venkatesh": "venkat venky", "gurpreet": "guri",
    "dinesh": "dinu deenesh", "sunil": "sunny", "sumit": "", "rajesh": "raju raj rajeev", "lakshmi": "laxmi", "krishna": "kishan krish gopi", "narayan": "narain", "bhaskar": "bhasker",
    "anand": "", "pushpa": "pushpaben", "antoine": "toine", "francois": "fanfan", "jean": "jeannot", "guillaume": "guigui guy", "dominique": "domi doume", "nicolas": "nico", "margaux": "margot",
    "bharat": "bharath", "jennifer": "jenny jen", "samuel": "sam sammy", "benjamin": "ben benny", "pierre": "", "jacques": "", "suresh": "", "ramesh": "", "amit": "",
}

GIVEN_OF = {v: k for k, vs in GIVEN_NAMES.items() for v in (k, *vs.split())}
TRADE_SET = set(TRADES)
KNOWN = set(NAME_FILLERS) | set(TRADES) | set(SHORT_TRADES)
_LOOKALIKE = str.maketrans("01", "ol")
SHARD_CAP = 20_000  #: texts of a shard beyond which it is split by pieces of the rest, and into blocks if that does not help
TASK_LINKS = 2_000_000  #: links that one task can follow, some 300 MB; more pass through joins
DISTANCE = 2  #: errors between two spellings of a core
LEAST = 4  #: letters of a core that can have errors; one error in less could make any core any other
SURE = 6  #: letters from which a core can have two errors
HALF = 7  #: letters of the beginning and end that make a shard, at most
SHORT = 10  #: letters up to which a text has no pieces of two letters or more


_SOUNDING: dict[str, str] = {}
_SOUNDS = (("rn", "m"), ("oo", "u"), ("ph", "f"), ("ck", "k"), ("c", "k"), ("q", "k"), ("y", "i"), ("z", "s"))


def sound(w: str) -> str:
    """The word with spellings of one sound (or look) made one, and double letters single."""
    got = _SOUNDING.get(w)
    if got is None:
        got = w
        for x, y in _SOUNDS:
            got = got.replace(x, y)
        got = "".join(ch for i, ch in enumerate(got) if i == 0 or ch != got[i - 1])
        if len(_SOUNDING) < 500_000:
            _SOUNDING[w] = got
    return got


class Words:
    """Words that belong to very many names, and their misspellings by one error (two in long words)."""

    def __init__(self, frequent: list[str]):
        exact = set(frequent) | KNOWN | set(GIVEN_OF)
        self.exact = exact
        self.known = {w: w for w in sorted(exact)}
        for w in sorted(exact, key=lambda x: (x not in KNOWN, x)):
            self.known.setdefault(sound(w), w)
            if len(w) >= 7:
                for k in range(4, len(w)):
                    self.known.setdefault(w[:k], w)
        self.near: dict[str, list[str]] = {}
        for w in sorted(exact):
            if len(w) >= 4:
                for v in _shortened(w):
                    self.near.setdefault(v, []).append(w)
        self.seen: dict[str, str | None] = {}
        self.about: dict[str, tuple[str | None, str]] = {}

    def look(self, t: str) -> tuple[str | None, str]:
        """What a token is meant to be (itself, for one letter), and its kind: g given name, t trade, o other shared word, n no word, '' own word."""
        got = self.about.get(t)
        if got is None:
            word = self.meant(t) if len(t) > 1 else t
            if not t.isalpha():
                kind = "n"
            elif word is None:
                kind = ""
            elif word in GIVEN_OF:
                kind = "g"
            else:
                kind = "t" if word in SHORT_TRADES or word in TRADE_SET else "o"
            got = word, kind
            if len(self.about) < 500_000:
                self.about[t] = got
        return got

    def meant(self, t: str) -> str | None:
        """The shared word that t is, starts, sounds like, or misspells; None for a word of the name's own."""
        got = self.known.get(t)
        if got is not None or len(t) < 3:
            return got
        if t in self.seen:
            return self.seen[t]
        got = self.known.get(sound(t))
        if got is None:
            for v in sorted(_shortened(t)):
                for w in self.near.get(v, ()):
                    if abs(len(w) - len(t)) <= 2 and errors(t, w, 2 if min(len(w), len(t)) >= 8 else 1):
                        got = w
                        break
                if got:
                    break
        if len(self.seen) < 500_000:
            self.seen[t] = got
        return got


@lru_cache(maxsize=2)
def known_words(frequent: tuple[str, ...]) -> Words:
    """One vocabulary a worker process."""
    return Words(list(frequent))


def _shortened(w: str) -> set[str]:
    """The word and all words one letter shorter."""
    return {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}


def errors(a: str, b: str, most: int) -> bool:
    """Whether a and b are within ``most`` errors: letters put in, left out, replaced, or two neighbours swapped."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > most:
        return False
    before: list[int] = []
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            best = min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, before[j - 2] + 1)
            row.append(best)
        if min(row) > most:
            return False
        before, last = last, row
    return last[-1] <= most


def read_name(clean: str | None, words: Words) -> tuple[list[list[str]], str, str, str, list[str]]:
    """Plausible cores of a name, the likeliest first, its owner's given name, the same if written in full, an initial, and trades.

    A core is the name's own words by their sound.  What follows a mark such as 'dba' repeats the name, and a word of its own
    behind a trade or legal form, or before 'branch', names a town, if two words of its own come before.  Short rests of
    broken words go with their neighbour, or are left out; of three words or more each two neighbours, and the first
    and third, may be the core.
    """
    if not clean:
        return [], "", "", "", []
    padded = f" {clean} "
    for mark in ALIAS_MARKS:
        at = padded.find(f" {mark} ")
        if at > 0:
            padded = padded[: at + 1]
    ts = [t.translate(_LOOKALIKE) if not t.isalpha() and any(c.isalpha() for c in t) else t for t in padded.split()]
    own: list[str] = []
    doubtful: list[tuple[int, str]] = []  # misspellings or beginnings of shared words, by the number of own words before
    given = full = initial = ""
    trades: list[str] = []
    gap = over = False
    for i, t in enumerate(ts):
        word, kind = words.look(t)
        if kind:
            gap = bool(own)
            if len(t) > 3 and kind != "n" and t not in words.exact and not over:
                doubtful.append((len(own), t))
            if kind == "g":
                given = given or GIVEN_OF[word]
                full = full or (t if t in GIVEN_NAMES else "")
            elif kind == "t":
                trades.append(SHORT_TRADES.get(word, word))
            elif len(t) == 1 and kind == "o" and (t not in "lpsc" or i == 0):
                initial = initial or t
            continue
        if over or (sum(len(x) > 3 for x in own) >= 2 or any(len(x) >= 13 for x in own)) and (gap or "branch" in ts[i + 1 :]):
            over = True
            continue
        own.append(t)
        gap = False
    everything = list(own)
    for at, t in reversed(doubtful):
        everything.insert(at, t)
    if sum(len(t) > 3 for t in own) < 2:
        own = everything
    if not own:
        # Nothing but shared words: those that were only counted as such, not listed, are the name.
        own = everything = [t for t in ts if len(t) > 3 and t.isalpha() and t in words.exact and t not in KNOWN and t not in GIVEN_OF]
    if not own:
        return [], given, full, initial, trades
    joined: list[str] = []
    for t in own:
        if joined and len(own) > 2 and (len(t) <= 3 or len(joined[-1]) <= 3):
            joined[-1] += t
        else:
            joined.append(t)
    out = [joined]
    long = [t for t in own if len(t) > 3]
    if 2 <= len(long) < len(own):
        out.append(long)
    if len(long) > 2:
        out += [[long[i], long[i + 1]] for i in range(len(long) - 1)] + [[long[0], long[2]]]
    if own is not everything and any(len(t) <= 5 for _, t in doubtful) and len(everything) > 2:
        out.append(everything)
    return [[sound(t) for t in core] for core in out], given, full, initial, sorted(set(trades))


def frequent_words(names: DataFrame, share: float = 0.001, least: int = 30) -> list[str]:
    """Words of at least ``share`` of the distinct names (and ``least`` of them), if most of these names have other words of their own.

    A word is no shared one where half of its names would be left with nothing: so the words of an organisation with
    very many spellings or branches stay its own.  At most (words a name) / share words qualify, some thousands,
    whatever the size of the table.
    """
    n = names.count()
    most = max(least, int(n * share))
    words = names.select(F.explode(F.array_distinct(F.split("clean_name", " "))).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    frequent = sorted(r.w for r in words.where((F.col("n") >= most) & (F.col("w") != "")).select("w").toLocalIterator())
    counted = {w for w in frequent if len(w) > 3 and w.isalpha() and w not in KNOWN and w not in GIVEN_OF}
    if not counted:
        return frequent

    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, listed = known_words(tuple(frequent)), known_words(())
        tally: dict[str, list[int]] = {}
        for batch in batches:
            for name in batch.column(0).to_pylist():
                theirs = counted.intersection(name.split())
                if theirs:
                    core = () if _own_word(name, known, listed) else (read_name(name, listed)[0] or [[]])[0]
                    # The likeliest core if no word were counted: towns of branches are not in it.
                    bare = bool(core) and all(len(t) <= 3 or known.look(t)[1] for t in core)
                    for t in theirs:
                        both = tally.setdefault(t, [0, 0])
                        both[0] += 1
                        both[1] += bare and sound(t) in core
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(tally), pa.string()), pa.array([x for x, _ in tally.values()], pa.int64()), pa.array([x for _, x in tally.values()], pa.int64())], ["w", "names", "bare"]
        )

    tallies = names.select("clean_name").mapInArrow(left, "w string, names long, bare long").groupBy("w").agg(F.sum("names").alias("names"), F.sum("bare").alias("bare"))
    own = {r.w for r in tallies.where("bare * 2 >= names").toLocalIterator()}
    return [w for w in frequent if w not in own]


def _own_word(name: str, known: Words, listed: Words) -> bool:
    """Whether one of the first two words that are not listed is no counted word either: these two are always in the core."""
    left = 2
    for t in name.split():
        if not listed.look(t)[1]:
            if len(t) > 3 and not known.look(t)[1]:
                return True
            left -= 1
            if not left or len(t) >= 13:
                return False
    return False


def cores(names: DataFrame, frequent: list[str]) -> DataFrame:
    """``clean_name, core, first, several, given, full, initial, trades``: each plausible core of each name.

    core: its words in the order of their letters, joined by a space; first marks the likeliest; several: the name has
    more than one.
    """
    schema = pa.schema(
        [("clean_name", pa.string()), ("core", pa.string()), ("first", pa.bool_()), ("several", pa.bool_()), ("given", pa.string()), ("full", pa.string()), ("initial", pa.string()), ("trades", pa.list_(pa.string()))]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = known_words(tuple(frequent))
        for batch in batches:
            rows = []
            for name in batch.column(0).to_pylist():
                plausible, given, full, initial, trades = read_name(name, known)
                by_core: dict[str, list[str]] = {}
                for own in plausible or [[]]:
                    by_core.setdefault(" ".join(sorted(own)), own)
                for k, core in enumerate(by_core):
                    rows.append((name, core, k == 0, len(by_core) > 1, given, full, initial, trades))
            columns = zip(*rows) if rows else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    out = "clean_name string, core string, first boolean, several boolean, given string, full string, initial string, trades array<string>"
    return names.select("clean_name").mapInArrow(read, out)


def piece_keys(text: str) -> set[str]:
    """Keys of a text: two texts within DISTANCE errors have a key in common.

    Of up to SHORT letters, the keys are what is left without one or two of the letters.  A longer
    text has four pieces of m letters, two from each end, with a letter or more between neighbours, so that no error, not
    even a swap, touches two pieces.  Two errors leave two pieces whole, and there is a key for every two pieces.  A piece
    moves only by the errors on its outer side: the longer text gives its letters at each place the piece can have moved to,
    under the piece lengths of texts up to two letters shorter.
    """
    n = len(text)
    keys: set[str] = set()
    if n <= SHORT + DISTANCE:
        # Of a longer one only what can be left of a text of SHORT letters.
        left = {text}
        for gone in range(DISTANCE + 1):
            if n - gone <= SHORT:
                keys.update(left)
            left = {w[:i] + w[i + 1 :] for w in left for i in range(len(w))}
    for shorter in range(min(DISTANCE, n - SHORT - 1) + 1):
        m = (n - shorter - 3) // 4
        head, tail = text[:m], text[n - m :]
        keys |= {f"12|{m}|{text[: 2 * m + 1]}", f"34|{m}|{text[n - 2 * m - 1 :]}", f"14|{head}|{tail}"}
        for move in (-1, 0, 1):
            second, third = m + 1 + move, n - 2 * m - 1 + move
            keys |= {f"13|{head}|{text[third : third + m]}", f"24|{text[second : second + m]}|{tail}"}
            if abs(shorter - move) <= 1:
                keys.add(f"23|{m}|{text[second : n - shorter - m - 1 + move]}")
    return keys


def texts_of(core: str) -> set[str]:
    """The joined letters of a core in the orders of its words: all orders of up to four words, all turns of more.

    Cores of more than MOST letters are taken in one order, that of the letters.
    """
    words = core.split(" ")
    if len(core) - len(words) + 1 > MOST:
        return {"".join(words)}
    orders = permutations(words) if len(words) <= 4 else (words[i:] + words[:i] for i in range(len(words)))
    return {"".join(o) for o in orders}


def ends_of(text: str) -> set[tuple[str, str]]:
    """Shards of a text, by its beginning and, read backwards, by its end, each with the text read that way."""
    n = len(text)
    back = text[::-1]
    shorter = [s for s in (n, n - 1, n - 2) if s >= LEAST]
    return {("<" + text[:m], text) for m in {min(HALF, s // 2) for s in shorter}} | {(">" + back[:m], back) for m in {min(HALF, (s - 1) // 2) for s in shorter}}


def shards(unique: DataFrame) -> DataFrame:
    """``key, text, id``: every text of a core (``core, id``) in its shards."""
    schema = pa.schema([("key", pa.string()), ("text", pa.string()), ("id", pa.int64())])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                rows = batch.slice(at, 2000)
                out = [(key, read, i) for core, i in zip(*(c.to_pylist() for c in rows.columns)) for text in texts_of(core) for key, read in ends_of(text)]
                columns = zip(*out) if out else [()] * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return unique.select("core", "id").mapInArrow(spread, "key string, text string, id long")


def without_a_letter(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of texts and hashes of what is left of them without one of their letters, each different rest of a text once."""
    sizes = np.array([len(t) for t in texts], np.int64)
    for m in np.unique(sizes):
        rows = np.flatnonzero(sizes == m)
        codes = np.array([texts[i] for i in rows]).view(np.uint32).reshape(len(rows), m).astype(np.uint64)
        for gone in range(m):
            # Of equal neighbours only the last is left out.
            kept = np.flatnonzero(codes[:, gone] != codes[:, gone + 1]) if gone + 1 < m else np.arange(len(rows))
            h = np.full(len(kept), int(m), np.uint64)
            for at in range(m):
                if at != gone:
                    h = (h ^ codes[kept, at]) * np.uint64(0x9E3779B97F4A7C15)
                    h ^= h >> np.uint64(29)
            yield rows[kept], h.astype(np.int64)


def with_visits(homes: DataFrame, halves: DataFrame) -> DataFrame:
    """``shard, half, text, id``: the texts of each shard, and visits of those whose beginning becomes equal to the shard's by
    leaving out a letter of each.

    halves: ``key, n``, the shards and their sizes.  Of two beginnings the texts of the rarer one visit.  A shard is
    known by a hash: two that share it are searched together, which changes nothing.  Visitors have the id -1 - id; half
    is the number of letters in the key.
    """

    def shorten(table: pa.Table) -> pa.Table:
        shard, n = table.column("shard").to_numpy(), table.column("n").to_numpy()
        rests = [(shard[:0], n[:0], np.zeros(0, np.int64)), *((shard[rows], n[rows], h) for rows, h in without_a_letter(table.column("key").to_pylist()))]
        return pa.table([pa.array(np.concatenate(x)) for x in zip(*rests)], ["shard", "n", "h"])

    left = halves.where("key LIKE '<%'").select(F.substring("key", 2, HALF).alias("key"), F.xxhash64("key").alias("shard"), F.col("n").cast("int"))
    rests = T.StructType([T.StructField("shard", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("h", T.LongType())])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        shard, n, h = (table.column(c).to_numpy() for c in ("shard", "n", "h"))
        order = np.argsort(h)
        shard, n, h = shard[order], n[order], h[order]
        starts = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        members = np.diff(np.append(starts, len(h)))
        size, first = np.repeat(members, members), np.repeat(starts, members)
        ends = np.cumsum(size)
        cuts = np.flatnonzero(np.append(True, ends[1:] // 1_000_000 != ends[:-1] // 1_000_000))
        for lo, hi in zip(cuts, [*cuts[1:], len(h)]):
            many = size[lo:hi]
            a = np.repeat(np.arange(lo, hi), many)
            b = np.arange(len(a)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first[lo:hi], many)
            visits = (n[a] < n[b]) | (n[a] == n[b]) & (shard[a] < shard[b])
            yield pa.RecordBatch.from_arrays([pa.array(shard[a[visits]]), pa.array(shard[b[visits]])], ["shard", "to"])

    # Equal hashes of different letters only cause a visit that finds nothing; two beginnings with several letters to leave
    # out are few, so their pairs are not made distinct.
    pairs = regroup(left, "h", shorten, rests, meet, "shard long, to long")
    # Small files become many rows here, so neither side is broadcast.
    rows = homes.select(F.xxhash64("key").alias("shard"), (F.length("key") - 1).alias("half"), "text", "id")
    visits = homes.where("key LIKE '<%'").select(F.xxhash64("key").alias("shard"), (F.length("key") - 1).alias("half"), "text", "id").join(pairs.hint("merge"), "shard")
    return rows.unionByName(visits.select(F.col("to").alias("shard"), "half", "text", (-1 - F.col("id")).alias("id")))


def split_hot(rows: DataFrame, cap: int, scratch: Scratch) -> DataFrame:
    """``shard, text, id``: the rows in smaller shards, so that no two texts within the bound are parted.

    A shard is split by pieces of its texts' rests; what is still beyond ``cap`` is cut into blocks, and every text
    searches every block of its shard.
    """
    schema = pa.schema([("piece", pa.string()), ("shard", pa.int64()), ("text", pa.string()), ("id", pa.int64())])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = [(piece, shard, text, i) for shard, half, text, i in zip(*(c.to_pylist() for c in batch.slice(at, 500).columns)) for piece in piece_keys(text[half:])]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    finer = rows.select("shard", "half", "text", "id").mapInArrow(pieces, "piece string, shard long, text string, id long")
    finer = scratch.cut(finer.select(F.xxhash64("shard", "piece").alias("shard"), "text", "id"))
    size = finer.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cap)
    sized = finer.join(size, "shard", "left").withColumn("blocks", F.coalesce(F.ceil(F.col("n") / F.lit(cap)), F.lit(1)).cast("int"))
    sized = sized.withColumn("mine", F.pmod(F.xxhash64("id", "text"), F.col("blocks")).cast("int"))
    met = sized.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # A text is at home in one block and visits the others.
    visiting = F.when(F.col("block") == F.col("mine"), F.col("id")).otherwise(F.least("id", -1 - F.col("id")))
    return met.select(F.when(F.col("blocks") > 1, F.xxhash64("shard", "block")).otherwise(F.col("shard")).alias("shard"), "text", visiting.alias("id"))


def trie_links(homes: DataFrame, scratch: Scratch, cap: int = SHARD_CAP) -> DataFrame:
    """``a < b``: ids linked by texts within the bound; of the links of a group of ids in a task only those that span it.

    homes: what ``shards`` gives.  The bound is DISTANCE errors, one in texts of less than SURE letters.
    """
    homes = scratch.cut(homes)
    halves = scratch.cut(homes.groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    rows = with_visits(homes, halves)
    hot = halves.where(F.col("n") > cap).select(F.xxhash64("key").alias("shard")).distinct()
    if hot.isEmpty():
        rows = rows.drop("half")
    else:
        rows = rows.join(hot, "shard", "left_anti").drop("half").unionByName(split_hot(rows.join(hot, "shard", "left_semi"), cap, scratch))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(in_order(batches, "shard")):
            n = table.num_rows
            members = np.diff(np.append(starts, n))
            # A text alone in its shard meets nothing.
            kept = np.flatnonzero(np.repeat(members > 1, members))
            group = np.repeat(np.cumsum(members > 1) - 1, members)[kept]
            table = table.take(pa.array(kept)) if len(kept) < n else table
            text = table.column("text").combine_chunks()
            ids = table.column("id").to_numpy()
            home = ids >= 0
            ids = np.where(home, ids, -1 - ids)
            size = pa.compute.utf8_length(text).to_numpy()
            low, high = [], []
            for a, b, wrong in near(text, group, home):
                x, y = ids[a], ids[b]
                linked = (x != y) & ((wrong < 2) | (np.minimum(size[a], size[b]) >= SURE))
                low.append(x[linked])
                high.append(y[linked])
            if low:
                a, b = spanning(np.concatenate(low), np.concatenate(high))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    found = regroup(rows.select("shard", "text", "id"), "shard", then=search, out="a long, b long").distinct()
    found = scratch.cut(found)
    scratch.drop(homes, halves)
    return found


def lowest_reached(links: DataFrame, scratch: Scratch, one_task: int = TASK_LINKS) -> DataFrame:
    """``id, low``: the smallest id reachable over links ``a, b``, for each linked id that has a smaller one.

    Up to ``one_task`` links are a task's work.  Of more, labels pass along the links until none changes; after the first round only changed labels are passed on.  An id also
    takes the label that the id it is named by has got, so the rounds grow with the logarithm of a chain of links.
    """
    if links.count() <= one_task:

        def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(batches, pa.schema([("a", pa.int64()), ("b", pa.int64())]))
            low, numbers = spanning(table.column("a").to_numpy(), table.column("b").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(low)], ["id", "low"])

        return links.select("a", "b").coalesce(1).mapInArrow(solve, "id long, low long")
    arc = lambda x, y: F.struct(F.col(x).alias("a"), F.col(y).alias("b"))
    both = scratch.cut(links.select(F.explode(F.array(arc("a", "b"), arc("b", "a"))).alias("e")).select("e.*"))
    first = scratch.cut(both.groupBy("a").agg(F.min(F.least("a", "b")).alias("l")))
    known = [first]

    def labels() -> DataFrame:
        """A linked id stands in ``first`` once and in a later table where its label improved."""
        out = known[0]
        for later in known[1:]:
            out = out.unionByName(later)
        return out.groupBy("a").agg(F.min("l").alias("l")) if len(known) > 1 else out

    passing = first.where("l <> a")
    while True:
        now = labels()
        heard = both.join(passing.select(F.col("a").alias("b"), F.col("l").alias("m")), "b").select("a", "m")
        named = now.join(passing.select(F.col("a").alias("l"), F.col("l").alias("m")), "l").select("a", "m")
        mine = now.join(heard.unionByName(named).groupBy("a").agg(F.min("m").alias("m")), "a")
        better = scratch.cut(mine.where("m < l").select("a", F.col("m").alias("l")))
        if better.isEmpty():
            break
        known.append(better)
        passing = better
        if len(known) > 8:
            known = [scratch.cut(labels())]
    return labels().where("l < a").select(F.col("a").alias("id"), F.col("l").alias("low"))


def organisations(names: DataFrame, scratch: Scratch) -> DataFrame:
    """``clean_name, core, org, trades`` of distinct names; null core and org where a name has no word of its own.

    Of a name's plausible cores, the one whose organisation has the most other names counts.  Where the same
    core comes with different given names in full, each is an owner with an organisation of its own; a name with a short
    form or none goes to the owner it is short for, else with its initial, else with its trade, else with the most names.
    """
    names = scratch.cut(names)
    read = scratch.cut(cores(names, frequent_words(names)))
    scratch.drop(names)
    # Ids in the order of frequency: the smallest id of an organisation is its most frequent core.
    counted = read.where("core <> ''").groupBy("core").agg(F.count_if("first").alias("n")).orderBy(F.desc("n"), "core")
    counted = scratch.cut(counted.withColumn("id", F.monotonically_increasing_id()))
    reached = scratch.cut(lowest_reached(trie_links(shards(counted), scratch), scratch))
    best = reached.join(counted.select(F.col("id").alias("low"), F.col("n").alias("n_low")), "low")
    weighted = counted.join(best, "id", "left").select("core", "id", F.coalesce("low", "id").alias("org"), F.coalesce("n_low", "n").alias("n"))
    weighted = scratch.cut(weighted)
    scratch.drop(counted, reached)
    rows = read.join(weighted, "core", "left")
    # A core that only the name itself has is no support for it.
    support = F.coalesce("n", F.lit(0)) - F.when((F.col("org") == F.col("id")) & F.col("first"), 1).otherwise(0)
    best = F.max_by(F.struct("core", "org", "given", "full", "initial", "trades"), F.struct(support, "first", "core"))
    kept = ("clean_name", "core", "org", "given", "full", "initial", "trades")
    picked = rows.where("several").groupBy("clean_name").agg(best.alias("x")).select("clean_name", "x.*")
    chosen = scratch.cut(rows.where("NOT several").select(*kept).unionByName(picked))
    scratch.drop(read, weighted)
    owners = chosen.where("full <> '' AND core <> ''").groupBy("org", "full").agg(F.count(F.lit(1)).alias("names"), F.flatten(F.collect_set("trades")).alias("their_trades"))
    # Few organisations have several owners: only their names are joined, the others pass.
    several = scratch.cut(owners.groupBy("org").agg(F.count(F.lit(1)).alias("owners")).where("owners > 1").select("org"))
    owners = owners.join(several, "org", "left_semi").withColumnRenamed("full", "owner")
    asked = chosen.join(several, "org", "left_semi").join(owners, "org").withColumn("given", F.when(F.col("full") != "", F.col("full")).otherwise(F.col("given")))
    fit = F.struct(
        F.col("owner") == F.col("given"), (F.col("initial") != "") & F.col("owner").startswith(F.col("initial")), F.size(F.array_intersect("trades", "their_trades")), F.col("names"), F.col("owner")
    )
    placed = asked.groupBy("clean_name").agg(F.max_by(F.struct("core", "org", "trades", "owner"), fit).alias("x")).select("clean_name", "x.*")
    rest = chosen.join(several, "org", "left_anti").select("clean_name", "core", "org", "trades", F.lit(None).cast("string").alias("owner"))
    return rest.unionByName(placed).select(
        "clean_name", F.nullif(F.col("core"), F.lit("")).alias("core"), F.when(F.col("core") != "", F.concat_ws("|", "org", "owner")).alias("org"), "trades"
    )


def distinct_names(records: DataFrame) -> DataFrame:
    return records.where("clean_name <> ''").select("clean_name").distinct()


def name_pairs(records: DataFrame) -> DataFrame:
    """``name_a < name_b``: different spellings of one organisation.

    records: ``clean_name``; null and empty names, and names of shared words only, match nothing.  Extra columns
    are ignored; a name that occurs often is one name.
    """
    scratch = Scratch(records.sparkSession, "names")
    found = scratch.cut(organisations(distinct_names(records), scratch).where("org IS NOT NULL").select("clean_name", "org"))
    a = found.select("org", F.col("clean_name").alias("name_a"))
    b = found.select("org", F.col("clean_name").alias("name_b"))
    return a.join(b, "org").where("name_a < name_b").select("name_a", "name_b")
