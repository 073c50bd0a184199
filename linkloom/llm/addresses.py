"""Records at the same building, however their addresses are written.

Each address is expanded into its plausible readings: which number is the house number, where the
street's name starts and ends, whether a street type is glued to it, which tokens name the
place.  Every combination of a house number, an end of the street's name and one token of the place
(postal code, town, district, state) is hashed; readings that share any hash are candidates.
They are kept if their street names are the same up to typing errors and nothing contradicts: house numbers,
directions and street types may not differ.
Of an address all readings take part, but two that are both unlikely prove nothing.  A street name of more than six
letters with errors at both its ends is not found.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.runtime import Scratch, distinct_rows, meetings, regroup

# Words of addresses in English, Indian English and French.
STREET_TYPES = {
    "road": "rd raod rode roa", "street": "st str strt streat", "avenue": "ave av avn aven", "boulevard": "blvd boul bvd bd blv bld",
    "highway": "hwy hway hiway", "lane": "ln la", "drive": "dr drv", "court": "ct crt", "parkway": "pkwy pky parkwy", "bazar": "bzr bazaar",
    "marg": "mg marga", "cross": "crs cr x", "rue": "r", "chemin": "chem ch", "allee": "all", "place": "pl", "impasse": "imp",
    "way": "", "terrace": "ter", "square": "sq", "quai": "", "route": "rte", "gali": "", "path": "",
}
TYPE_BEFORE = {"rue", "chemin", "allee", "place", "impasse", "avenue", "boulevard", "quai", "route"}
DIRECTIONS = {"north": "n nth", "south": "s sth", "east": "e est", "west": "w wst"}
UNITS = set("apartment apt suite floor flat shop office building unit room appt app appartement bat batiment etage esc escalier bp ste fl bldg door block wing level g".split())
PARTICLES = set("de du des la le les l d".split())
NUMBER_WORDS = set("number plot h n near house door holding no nos num premises".split())
DISTRICT_WORDS = set("vihar nagar ngr colony coly col enclave encl layout sector sec phase ph extension extn block main".split())
LANDMARK_WORDS = set("near opposite opp next beside behind b nr adjacent facing".split())
LANDMARKS = set("old water tank petrol pump bank atm vegetable mkt market clock tower cinema hall post office railway crossing bus stand to temple town park school station".split())
PLACE_FILLERS = set("pin code saint".split())
NO_ADDRESS = set("n a na none null nil unknown not available tbd nan".split())
ORDINALS = "first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth".split()
CARDINALS = "one two three four five six seven eight nine ten eleven twelve".split()
ROMAN = "i ii iii iv v vi vii viii ix x xi xii".split()

TYPE_OF = {v: k for k, vs in STREET_TYPES.items() for v in (k, *vs.split())}
DIRECTION_OF = {v: k for k, vs in DIRECTIONS.items() for v in (k, *vs.split())}
GLUED = sorted([v for v in TYPE_OF if len(v) > 1 and v not in ("la", "ch")] + ["main", "mn", "la"], key=len, reverse=True)
ORDINAL_OF = {w: w for w in ORDINALS} | dict(zip(CARDINALS, ORDINALS))
for _i, _w in enumerate(ORDINALS, 1):
    for _s in ("st", "nd", "rd", "th"):
        ORDINAL_OF[f"{_i}{_s}"] = ORDINAL_OF[f"{ROMAN[_i - 1]}{_s}"] = _w

WIDE, WIDE_CODES, WIDE_OTHERS = 0.02, 10, 3  #: share and least number of postal codes, and least number of companions, of a wide place token
_LOOKALIKE = str.maketrans("01", "ol")
_GLUED_ORDINAL = re.compile(r"\b(\d{1,2}(?:st|nd|rd|th)|[ivx]{1,4}(?:st|nd|rd|th))([a-z]{2,})\b")
_UNIT_VALUE = re.compile(r"[a-z]?\d{1,5}[a-z]?$")


def _word(t: str) -> str:
    """A token that is a word with digits typed for letters, mended; other tokens as they are."""
    return t.translate(_LOOKALIKE) if not t.isalpha() and sum(c.isalpha() for c in t) > len(t) / 2 and t not in ORDINAL_OF and len(t) > 4 else t


def read_address(clean: str | None, postal: str | None) -> tuple | None:
    """The likeliest of ``read_all``, without its last part; None where no house number with a street can be read."""
    found = read_all(clean, postal)
    return found[0][:-1] if found else None


def read_all(clean: str | None, postal: str | None) -> list[tuple]:
    """All plausible readings of a cleaned address, the likeliest first: house number, spellings of the street's name,
    direction, street type, place tokens, postal code, and whether none is surer but for the order of the parts."""
    if not clean:
        return []
    ts = [_word(t) for t in _GLUED_ORDINAL.sub(r"\1 \2", clean).split()]
    n = len(ts)
    if all(t in NO_ADDRESS for t in ts):
        return []
    used = [False] * n
    code = ""
    # Postal code: the last token of five or six digits that is no unit's number, or one broken in two.
    for i, t in enumerate(ts):
        if t.isdigit() and len(t) in (5, 6) and not (i and (ts[i - 1] in UNITS or ts[i - 1] == "number" and i > 1 and ts[i - 2] in UNITS)):
            code = t
            used[i] = True
    if not code:
        for i in range(n - 1):
            if ts[i].isdigit() and ts[i + 1].isdigit() and len(ts[i]) == 3 and len(ts[i + 1]) in (2, 3):
                code = ts[i] + ts[i + 1]
                used[i] = used[i + 1] = True
                break
    if not code and postal and postal.isdigit() and len(postal) in (5, 6):
        code = postal
    # Units and landmarks.
    i = 0
    while i < n:
        t = ts[i]
        if not used[i] and t in UNITS:
            j = i + 1
            if j < n and ts[j] == "number":
                j += 1
            # "36 floor 8548 ..." has its value before, "floor 36 8548 ..." after.
            before = t == "floor" and i and not used[i - 1] and len(ts[i - 1]) != 4 and _UNIT_VALUE.match(ts[i - 1])
            if j < n and not used[j] and _UNIT_VALUE.match(ts[j]) and not before:
                for k in range(i, j + 1):
                    used[k] = True
                i = j + 1
                continue
            if i and not used[i - 1] and _UNIT_VALUE.match(ts[i - 1]):
                used[i - 1] = used[i] = True
            elif t != "g":
                used[i] = True
        elif t in ("sector", "sec", "phase", "ph") and i + 1 < n and (ts[i + 1].isdigit() or ts[i + 1] in ROMAN):
            used[i] = used[i + 1] = True
        elif t in LANDMARK_WORDS and i + 1 < n and not ts[i + 1].isdigit() and (t != "b" or ts[i + 1] == "h") and not (t == "near" and ts[i + 1] in NUMBER_WORDS):
            j = i + 1 + (t == "b")
            k = j
            while k < n and k < j + 3 and ts[k] in LANDMARKS:
                k += 1
            for m in range(i, k):
                used[m] = True
            i = max(k, i + 1)
            continue
        i += 1
    # Four digits behind a code of five extend it where another number is left for the house.
    for i in range(1, n):
        if ts[i].isdigit() and len(ts[i]) == 4 and len(ts[i - 1]) == 5 and ts[i - 1] == code and not used[i]:
            used[i] = any(x.isdigit() and not used[j] and j != i and j + 1 < n and ts[j + 1].isalpha() for j, x in enumerate(ts))
    found = []
    for i, t in enumerate(ts):
        if used[i] or not (t.isdigit() and len(t) <= 4 or len(t) <= 5 and t[:-1].isdigit() and t[-1] in "abc"):
            continue
        j = i + 1
        direction = kind = ""
        while j < n and not used[j] and (ts[j] in DIRECTION_OF or ts[j] in PARTICLES or (ts[j] in TYPE_OF and not kind)):
            if ts[j] in PARTICLES:
                pass
            elif ts[j] in DIRECTION_OF and not (kind and ts[j] in ("e", "n", "s", "w")):
                direction = direction or DIRECTION_OF[ts[j]]
            elif ts[j] in TYPE_OF:
                kind = TYPE_OF[ts[j]]
            j += 1
        if j >= n or used[j] or not (ts[j].isalpha() or ts[j] in ORDINAL_OF):
            continue
        name = ORDINAL_OF.get(ts[j], ts[j])
        if len(name) < 3:
            continue
        names = [name]
        last = j
        if not kind:
            k = j + 1
            if k < n and ts[k] in ("main", "mn", "m") and k + 1 < n and TYPE_OF.get(ts[k + 1]) == "road":
                k += 1
            if k < n and not used[k] and ts[k] in TYPE_OF:
                kind, last = TYPE_OF[ts[k]], k
            elif k + 1 < n and not used[k] and ts[k].isalpha() and ts[k + 1] in TYPE_OF and ts[k] not in DIRECTION_OF and len(ts[k]) > 1:
                # A name of two words, or broken in two.
                name += ts[k]
                names = [name]
                kind, last = TYPE_OF[ts[k + 1]], k + 1
            for g in GLUED:
                if name.endswith(g) and len(name) - len(g) >= 4:
                    names.append(name[: -len(g)])
                    if not kind and len(g) >= 4:
                        kind = TYPE_OF.get(g, "")
                    break
            k = last + 1
            if not direction and k < n and ts[k] in DIRECTION_OF and not used[k]:
                direction, last = DIRECTION_OF[ts[k]], k
        sure = 2 * bool(kind) + bool(i and ts[i - 1] in NUMBER_WORDS) - (ts[j] in DISTRICT_WORDS or ts[j] in PLACE_FILLERS)
        found.append((sure + (i == 0), -i, t, names, direction, kind, i, last, sure))
    found.sort(reverse=True)
    surest = max((r[8] for r in found), default=0)
    out = []
    for _, _, house, names, direction, kind, first, last, sure in found:
        # A number before a word of districts is a reading only where there is none better.
        if sure < 0 and out:
            continue
        inside = set(range(first, last + 1))
        places = {code} if code else set()
        for k, t in enumerate(ts):
            if k in inside or used[k] or not t.isalpha() or len(t) < 4 or t in TYPE_OF or t in DISTRICT_WORDS or t in PLACE_FILLERS or t in NUMBER_WORDS or t in DIRECTION_OF:
                continue
            places.add(t)
        # A state's code places an address that has nothing else.
        if len(places) < 2:
            places.update(t for k, t in enumerate(ts) if k not in inside and not used[k] and len(t) == 2 and t.isalpha() and t not in TYPE_OF and t not in PARTICLES and t not in ROMAN)
        out.append((house, list(dict.fromkeys(names)), direction, kind, sorted(places), code, sure == surest or not out))
    return out


def _packed(readings: list[tuple]) -> str:
    """Readings as one text; no token holds the signs between them, which are white space."""
    return "\x1d".join("\x1e".join((h, "\x1f".join(streets), d, k, "\x1f".join(places), code, "1" if sure else "")) for h, streets, d, k, places, code, sure in readings)


def _unpacked(text: str) -> list[tuple]:
    parts = (r.split("\x1e") for r in text.split("\x1d"))
    return [(h, streets.split("\x1f"), d, k, places.split("\x1f") if places else [], code, sure == "1") for h, streets, d, k, places, code, sure in parts]


def same_street(a: Column, b: Column) -> Column:
    """Equal up to one typing error, two in names of six letters or more."""
    most = F.when(F.least(F.length(a), F.length(b)) >= 6, 2).otherwise(1)
    return (a == b) | (F.levenshtein(a, b) <= most)


def no_conflict(a: str, b: str) -> Column:
    return (F.col(a) == "") | (F.col(b) == "") | (F.col(a) == F.col(b))


def distinct_readings(records: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``records`` with ``sig``, the number of the address's readings (null without any), instead of ``clean_addr, postal``; and the
    readings of each number, with numbers ``rid`` of their own, the likeliest marked ``first``.

    The number is a hash of the readings, so that no join is needed to find it; should two share one, another hash is taken.
    Copies of an address collapse to one set of readings before anything is compared.
    """
    salt = 0
    while True:
        read = scratch.cut(_read(records, salt))
        each = scratch.cut(_each(read.where("r IS NOT NULL").select("sig", "r")))
        if each.where("clash").isEmpty():
            break
        scratch.drop(read, each)
        salt += 1
    distinct = scratch.cut(with_towns(each.drop("clash"), scratch).withColumn("rid", F.monotonically_increasing_id()))
    scratch.drop(each)
    numbered = read.drop("r")
    numbered.scratch_path = read.scratch_path
    return numbered, distinct


def _number(text: str, salt: int) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8, salt=salt.to_bytes(8, "little")).digest(), "little") >> 1


def _read(records: DataFrame, salt: int) -> DataFrame:
    """Records with ``sig`` and, once at least for each number, the readings ``r`` as a text."""
    kept = [c for c in records.columns if c not in ("clean_addr", "postal")]
    most = 200_000  # addresses that a task remembers

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        about: dict[tuple, int | None] = {}
        for batch in batches:
            sigs, texts = [], []
            for address in zip(batch.column("clean_addr").to_pylist(), batch.column("postal").to_pylist()):
                text = None
                if address not in about:
                    if len(about) >= most:
                        about.clear()
                    found = read_all(*address)
                    text = _packed(found) if found else None
                    about[address] = _number(text, salt) if found else None
                sigs.append(about[address])
                texts.append(text)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(sigs, pa.int64()), pa.array(texts, pa.string())], [*kept, "sig", "r"])

    schema = T.StructType([*(records.schema[c] for c in kept), T.StructField("sig", T.LongType()), T.StructField("r", T.StringType())])
    return records.mapInArrow(read, schema)


def _each(read: DataFrame) -> DataFrame:
    """``sig``, the parts of a reading, ``first``, ``clash``: each reading of each number once; clash: the number has other readings too."""
    schema = pa.schema(
        [("sig", pa.int64()), ("house", pa.string()), ("streets", pa.list_(pa.string())), ("direction", pa.string()), ("kind", pa.string()), ("places", pa.list_(pa.string())), ("code", pa.string()), ("sure", pa.bool_()),
         ("first", pa.bool_()), ("clash", pa.bool_())]
    )

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: dict[int, str] = {}
        clashing: set[int] = set()
        for batch in batches:
            for sig, text in zip(batch.column("sig").to_pylist(), batch.column("r").to_pylist()):
                if texts.setdefault(sig, text) != text:
                    clashing.add(sig)
        told = list(texts.items())
        for at in range(0, len(told), 20_000):
            rows = [(sig, *r, k == 0, sig in clashing) for sig, text in told[at : at + 20_000] for k, r in enumerate(_unpacked(text))]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    out = "sig long, house string, streets array<string>, direction string, kind string, places array<string>, code string, sure boolean, first boolean, clash boolean"
    return regroup(read, "sig", then=tell, out=out)


def with_towns(readings: DataFrame, scratch: Scratch, least: int = 2) -> DataFrame:
    """Readings whose places are without wide tokens, if they have others, and with the town of their postal code.

    The town of a code is the place token most readings with the code have; so an address with nothing but a code meets one
    with nothing but the town, and a mistyped town its right form.  A code needs ``least`` readings, half of them with the
    token; of equals the more frequent token anywhere counts.  A wide token is a usual one (of half the readings) in a
    WIDE part of all codes, beside various other usual ones, such as a second word of many towns' names: it tells no
    town.  There are 2 / WIDE of them at most for each token an address has.
    """
    likeliest = readings.where("first AND code <> ''")
    pairs = likeliest.select("code", F.explode("places").alias("place")).where("place <> code")
    n = likeliest.groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    counts = pairs.groupBy("code", "place").agg(F.count(F.lit(1)).alias("k"))
    usual = scratch.cut(counts.join(n, "code").where((F.col("k") >= least) & (F.col("k") * 2 >= F.col("n"))).select("code", "place", "k"))
    codes = usual.select("code").distinct().count()
    spread = usual.groupBy("place").agg(F.count(F.lit(1)).alias("codes"), F.sum("k").alias("all"))
    often = spread.where(F.col("codes") >= max(WIDE_CODES, codes * WIDE)).select("place")
    beside = usual.join(often, "place").join(usual.select("code", F.col("place").alias("other")), "code").where("place <> other")
    wide = [r.place for r in beside.groupBy("place").agg(F.count_distinct("other").alias("n")).where(F.col("n") >= WIDE_OTHERS).select("place").toLocalIterator()]
    best = F.max(F.struct("k", "all", "place"))
    towns = usual.join(spread, "place").where(~F.col("place").isin(wide)).groupBy("code").agg(best.alias("b")).select("code", F.col("b.place").alias("town"))
    kept = F.array_except("places", F.array(*[F.lit(w) for w in sorted(wide)]).cast("array<string>"))
    out = readings.join(towns, "code", "left").withColumn("places", F.when(F.size(kept) > 0, kept).otherwise(F.col("places")))
    return out.withColumn("places", F.when(F.col("town").isNull(), F.col("places")).otherwise(F.array_union("places", F.array("town")))).drop("town")


def hashes(readings: DataFrame) -> DataFrame:
    """One row for each combination of a house number, a part of a street name and a place token.

    Parts are both ends and, for short names, the letters in order, which two swapped letters leave as they are, and the
    name without one of its letters.
    """
    rows = readings.select("rid", "house", F.explode("streets").alias("street"), "places")
    letters = F.array_join(F.array_sort(F.split("street", "")), "")
    ends = F.array_compact(
        F.array(F.concat(F.lit("<"), F.substring("street", 1, 3)), F.concat(F.lit(">"), F.expr("right(street, 3)")), F.when(F.length("street") <= 8, letters))
    )
    # Names of up to six letters: one error in the middle can change both ends.
    without = F.expr("transform(sequence(1, length(street)), i -> concat('-', left(street, i - 1), substr(street, i + 1)))")
    short = F.when(F.length("street") <= 6, F.array_distinct(F.concat(F.array(F.concat(F.lit("-"), "street")), without))).otherwise(F.array().cast("array<string>"))
    rows = rows.select("rid", "house", F.explode("places").alias("place"), F.concat(ends, short).alias("ends"))
    return rows.select("rid", F.explode(F.transform("ends", lambda e: F.xxhash64("house", e, "place"))).alias("h"))


def same_building(readings: DataFrame) -> DataFrame:
    """``a < b``: numbers of readings of the same building: any two that agree, one of them at least a sure one.

    Readings meet by any equal hash, as numbers; each two that meet are compared once: those with other house numbers,
    directions or street types, or without street names the same up to typing errors, are rejected.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        rows = pa.Table.from_batches(held)
        rid, h = (rows.column(c).to_numpy() for c in ("rid", "h"))
        every = np.ones(len(h), bool)
        for a, b in meetings(h, every, every):
            ordered = rid[a] < rid[b]
            pairs = distinct_rows(rid[a[ordered]], rid[b[ordered]])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in pairs], ["rid", "rid2"])

    met = regroup(hashes(readings), "h", then=meet, out="rid long, rid2 long").distinct()
    cols = ("rid", "sig", "sure", "direction", "kind", "house", "streets")
    one = readings.select(*cols)
    met = met.join(one, "rid").join(one.withColumnsRenamed({c: f"{c}2" for c in cols}), "rid2").where("sig <> sig2 AND (sure OR sure2)")
    alike = F.exists("streets", lambda x: F.exists("streets2", lambda y: same_street(x, y)))
    kept = met.where((F.col("house") == F.col("house2")) & no_conflict("direction", "direction2") & no_conflict("kind", "kind2") & alike)
    return kept.select(F.least("sig", "sig2").alias("a"), F.greatest("sig", "sig2").alias("b")).distinct()


def ordered(a: Column, b: Column) -> tuple[Column, Column]:
    return F.least(a, b), F.greatest(a, b)


def address_pairs(records: DataFrame) -> DataFrame:
    """``entity_id_a < entity_id_b``: records at the same house number of the same street of the same town.

    records: ``entity_id, clean_addr, postal``.  Null or empty ids and addresses, and addresses without house number and
    street, match nothing.  A record delivered more than once has all its addresses.  Extra columns are ignored.
    """
    scratch = Scratch(records.sparkSession, "addresses")
    rows = records.select(F.col("entity_id"), F.col("clean_addr"), F.coalesce("postal", F.lit("")).alias("postal")).where("entity_id <> '' AND clean_addr <> ''")
    numbered, readings = distinct_readings(rows, scratch)
    members = scratch.cut(numbered.where("sig IS NOT NULL").distinct())
    scratch.drop(numbered)
    links = scratch.cut(same_building(readings))
    one = members.select(F.col("entity_id").alias("x"), F.col("sig").alias("a"))
    two = members.select(F.col("entity_id").alias("y"), F.col("sig").alias("b"))
    across = one.join(links, "a").join(two, "b").select("x", "y")
    within = one.join(two, F.col("a") == F.col("b")).where("x < y").select("x", "y")
    low, high = ordered(F.col("x"), F.col("y"))
    return across.unionByName(within).where("x <> y").select(low.alias("entity_id_a"), high.alias("entity_id_b")).distinct()

