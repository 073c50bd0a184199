"""Matching records of several sources without a common key, with a confidence for each match.

Candidate pairs come from equal organisations at a shared place and from equal buildings.  Each pair has
log-odds of being a match from its attributes, by a logistic model fitted on labelled records.  Pairs then
compete, by loopy belief propagation: a record of the other sources belongs to one business at most, and a business
is at one place, so candidates at different places exclude each other.  Messages between pairs and these
factors are sums over groups, exchanged through joins until they no longer change; a pair's marginal
probability is its confidence.
"""

from __future__ import annotations

import hashlib
import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm.addresses import distinct_readings, same_building
from linkloom.llm.groups import clean_id, list_ids
from linkloom.llm.names import distinct_names, organisations
from linkloom.runtime import Scratch, distinct_rows, meetings, regroup

TRAIN_PAIRS = 20_000  #: labelled pairs the model is fitted on, at most
CONFIDENCE = 0.5  #: least confidence of a match
BRANCHES = 20  #: businesses of an organisation up to which a record without address meets each of them singly; see ``crowded``
SENT = 10_000  #: organisations that are sent to all tasks, some 0.2 MB; more are joined
ROUNDS = 100  #: a bound for circles that never settle; reached, it is reported
CHANGE = 0.002  #: largest change of a probability at which the messages have converged
KEEP = 0.2  #: share of the old message that is kept, which calms circles of competitors
FAINT = -12.0  #: log-odds below which a pair hears no messages; its competition, summed up with that of all others of its kind, counts
CLIP = 30.0

FEATURES = (
    "same_org", "close_name", "shared_word", "no_name", "same_trade", "other_trade", "same_building", "same_house", "other_house",
    "no_address", "same_code", "other_code", "shared_place", "org_and_building", "org_no_address", "building_no_name",
)
#: Log-odds used where no labels are given: plausible values in the order of FEATURES, and the constant.
PRIOR = (3.0, 2.0, 1.5, 0.0, 0.5, -0.5, 2.0, 1.0, -3.0, 0.0, 0.5, -0.3, 0.5, 3.0, 2.0, 3.0, -5.0)


#: An entity's records that differ in name or address are versions of it: ``ent`` is the entity's number, ``row`` the version's.
#: branches: businesses of the organisation if there are more than BRANCHES, else 0.
COLUMNS = ("row", "ent", "own", "core", "org", "branches", "trades", "sig", "site", "house", "places", "code")


def described(records: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records with what is read from name and address (COLUMNS), ``ent, entity_id``, and the links between readings of one building."""
    rows = records.where("entity_id <> ''").select(
        "entity_id", F.coalesce("clean_name", F.lit("")).alias("clean_name"), F.coalesce("clean_addr", F.lit("")).alias("clean_addr"), F.coalesce("postal", F.lit("")).alias("postal")
    )
    # From here on a record is its name and the number of its address's readings.
    numbered, readings = distinct_readings(rows, scratch)
    slim = numbered.select("entity_id", "clean_name", "sig").repartition("entity_id").distinct()
    slim = slim.withColumn("row", F.monotonically_increasing_id()).withColumn("ent", F.min("row").over(W.partitionBy("entity_id")))
    slim = scratch.cut(slim)
    scratch.drop(numbered)
    links = scratch.cut(same_building(readings))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.min("b").alias("low"))
    sites = readings.where("first").join(lowest, F.col("sig") == F.col("a"), "left").select("sig", F.least("sig", F.coalesce("low", "sig")).alias("site"), "house", "places", "code")
    orgs = organisations(distinct_names(slim), scratch)
    # What is long, the places, is joined last, and ids not at all.
    out = slim.select("row", "ent", F.col("entity_id").startswith("S1-").alias("own"), "sig", "clean_name").join(orgs, "clean_name", "left").drop("clean_name").join(sites, "sig", "left")
    out = scratch.cut(out)
    scratch.drop(readings)
    branches = out.where("own AND org IS NOT NULL").groupBy("org").agg(F.count_distinct("ent").alias("branches"))
    many = scratch.cut(branches.where(F.col("branches") > BRANCHES))
    # A few such organisations go along wherever the rows are read; more are joined once.
    few = many.count() <= SENT
    described = out.join(F.broadcast(many) if few else many, "org", "left").withColumn("branches", F.coalesce("branches", F.lit(0))).select(*COLUMNS)
    if not few:
        described = scratch.cut(described)
        scratch.drop(out)
    return described, slim.where("row = ent").select("ent", "entity_id"), links


def words(core: Column) -> Column:
    return F.split(core, " ")


def _mixed(kind: int, *parts: np.ndarray) -> np.ndarray:
    """A hash of numbers, row by row, other for each kind of key."""
    h = np.uint64(kind * 0x9E3779B97F4A7C15 % 2**64)
    for part in parts:
        h = (h ^ part.astype(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xC4CEB9FE1A85EC53)
        h = h ^ (h >> np.uint64(29))
    return h.astype(np.int64)


def _ends(cores: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``cores``, and numbers of the beginnings and ends (four letters at most) of their words; each of a row once."""
    seen = cores.dictionary_encode()
    row, end = [], []
    for i, core in enumerate(seen.dictionary.to_pylist()):
        ends = {e for w in core.split(" ") for e in (w[:4], w[-4:])}
        row += [i] * len(ends)
        end += ends
    letters = np.array(end, "U4").view(np.uint32).reshape(len(end), 4)
    number = _mixed(0, *letters.T)
    # The ends of a core lie together.
    many = np.bincount(np.array(row, np.int64), minlength=len(seen.dictionary))
    first = np.cumsum(many) - many
    at = np.flatnonzero(np.asarray(cores.is_valid()))
    core = seen.indices.drop_null().to_numpy().astype(np.int64)
    n = many[core]
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(at, n), number[np.repeat(first[core], n) + within]


def candidates(rows: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """``ra, rb, built``: rows of source 1 and of other sources that share an organisation and a place, or (built) a building.

    Both sides list keys, and equal keys meet.  Of an organisation: its number with the house number, and with each place; without an
    address only the name speaks, and organisations of more than BRANCHES businesses are left to ``crowded``.  At a
    building: the beginning and end of a word of the name, or no name on a side, not all pairs of the building.
    Keys are listed and met in tasks; a row of source 1 goes there once more for each building near by.
    """
    c = F.col
    null = lambda kind: F.lit(None).cast(kind)
    near_by = links.unionByName(links.select(c("b").alias("a"), c("a").alias("b"))).select(c("a").alias("sig"), c("b").alias("at"))
    few = (c("branches") <= BRANCHES).alias("few")
    whole = rows.select("row", "own", "core", F.when(c("org").isNotNull(), F.xxhash64("org")).alias("org"), few, c("sig").alias("at"), F.xxhash64("house").alias("house"), "places", F.lit(False).alias("near"))
    around = rows.where("own AND sig IS NOT NULL").select("row", "sig", "core").join(near_by, "sig")
    around = around.select("row", F.lit(True).alias("own"), "core", null("long").alias("org"), null("boolean").alias("few"), "at", null("long").alias("house"), null("array<string>").alias("places"), F.lit(True).alias("near"))

    def spread(table: pa.Table) -> pa.Table:
        column = {name: table.column(name).combine_chunks() for name in table.column_names}
        filled = lambda name, value: pa.compute.fill_null(column[name], value).to_numpy(zero_copy_only=False)
        valid = lambda name: np.asarray(column[name].is_valid())
        row, own, near = (column[k].to_numpy(zero_copy_only=False) for k in ("row", "own", "near"))
        named, placed, cored = valid("org") & ~near, valid("at"), valid("core")
        org, house, at, few = filled("org", 0), filled("house", 0), filled("at", -1), filled("few", False)
        keys = []

        def put(which: np.ndarray, key: np.ndarray, at: np.ndarray | None = None) -> None:
            keys.append((key, row[which], np.full(len(which), -1) if at is None else at, own[which]))

        both = np.flatnonzero(named & placed)
        put(both, _mixed(1, org[both], house[both]))
        words = pa.compute.list_flatten(column["places"]).dictionary_encode()
        town = np.array([int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little") for w in words.dictionary.to_pylist()], np.uint64)
        of = pa.compute.list_parent_indices(column["places"]).to_numpy()
        kept = (named & placed)[of]
        of, place = of[kept], words.indices.to_numpy()[kept]
        put(of, _mixed(2, org[of], town[place]))
        # Alone: the other side is known by its name only.  Every: so is the row of source 1, and meets all of its organisation.
        alone = np.flatnonzero(named & np.where(own, few, ~placed))
        put(alone, _mixed(3, org[alone]))
        every = np.flatnonzero(named & ~(own & placed))
        put(every, _mixed(4, org[every]))
        which, end = _ends(column["core"])
        kept = placed[which]
        which, end = which[kept], end[kept]
        put(which, _mixed(5, at[which], end), at[which])
        # Where a side has no name: nameless rows of other sources, and those of source 1.
        for kind, some in ((6, placed & np.where(own, cored, ~cored)), (7, placed & np.where(own, ~cored, cored))):
            some = np.flatnonzero(some)
            put(some, _mixed(kind, at[some]), at[some])
        return pa.table([pa.array(np.concatenate(x)) for x in zip(*keys)], ["key", "row", "at", "own"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        key, row, at, own = (c.to_numpy() for c in pa.Table.from_batches(held).columns)
        for a, b in meetings(key, own, ~own):
            same = at[a] == at[b]
            a, b = a[same], b[same]
            found = distinct_rows(row[a], row[b], (at[a] >= 0).astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["ra", "rb", "built"])

    keyed = T.StructType([T.StructField("key", T.LongType()), T.StructField("row", T.LongType()), T.StructField("at", T.LongType()), T.StructField("own", T.BooleanType())])
    met = regroup(whole.unionByName(around), "key", spread, keyed, meet, "ra long, rb long, built int")
    return met.groupBy("ra", "rb").agg(F.max("built").alias("built"))


def crowded(rows: DataFrame, weights: tuple[float, ...], scratch: Scratch) -> DataFrame | None:
    """``a, c, site, logit`` of records without address whose organisation has more than BRANCHES businesses; None if there is none.

    Their odds depend on core and trades alone, so these states are weighed once for all their records.  The best states
    with up to BRANCHES businesses together are joined back; all others count with their number, as one competitor of
    a number of its own: each of them has as many rivals at least as likely, so none is above a confidence of 1 / (BRANCHES + 1).
    """
    state = ["org", "core", "trades"]
    other = scratch.cut(rows.where(f"NOT own AND sig IS NULL AND branches > {BRANCHES}"))
    if other.isEmpty():
        return None
    # A record of source 1 without address meets all others of its organisation already.
    one = rows.where(f"own AND sig IS NOT NULL AND branches > {BRANCHES}").join(other.select("org").distinct(), "org", "left_semi")
    mine = scratch.cut(one.groupBy(*state).agg(F.min("row").alias("ra"), F.count_distinct("ent").alias("n")))
    theirs = scratch.cut(other.groupBy(*state).agg(F.min("row").alias("rb")))
    pairs = mine.select("org", "ra").join(theirs.select("org", "rb"), "org").select("ra", "rb", F.lit(0).alias("built"))
    weighed = features(pairs, rows).select("ra", "rb", log_odds(weights).alias("logit")).join(mine.select("ra", "n"), "ra")
    ranked = scratch.cut(weighed.withColumn("upto", F.sum("n").over(W.partitionBy("rb").orderBy(F.desc("logit")).rangeBetween(W.unboundedPreceding, 0))))
    a = one.join(mine, state).select("ra", F.col("ent").alias("a")).distinct()
    c = other.join(theirs, state).select("rb", F.col("ent").alias("c")).distinct()
    best = ranked.where(F.col("upto") <= BRANCHES).select("ra", "rb", "logit").join(a, "ra").join(c, "rb")
    rest = ranked.where(F.col("upto") > BRANCHES).groupBy("rb").agg(F.log(F.sum(F.col("n") * F.exp("logit"))).alias("logit")).join(c, "rb")
    site = F.lit(None).cast("long").alias("site")
    return best.select("a", "c", site, "logit").unionByName(rest.select((-1 - F.col("c")).alias("a"), "c", site, "logit"))


def log_odds(weights: tuple[float, ...]) -> Column:
    """Of ``flags``: bit i is feature i."""
    return sum((F.when(F.col("flags").bitwiseAND(F.lit(1 << i)) != 0, w).otherwise(0.0) for i, w in enumerate(weights[:-1])), F.lit(weights[-1]))


def features(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """``ra, rb, a, c, site, flags``: the entities of a pair, the building of the other record, and FEATURES as bits."""
    cols = ("ent", "core", "org", "trades", "sig", "site", "house", "places", "code")
    # What is only compared travels as numbers.
    number = lambda k: F.when(F.col(k).isNotNull(), F.xxhash64(k))
    short = {k: number(k) for k in ("org", "house")} | {k: F.transform(k, lambda x: F.xxhash64(x)) for k in ("trades", "places")}
    # One side is of source 1, the other never is.
    side = lambda s: rows.where("own" if s == "a" else "NOT own").select(F.col("row").alias(f"r{s}"), *[short.get(c, F.col(c)).alias(f"{c}_{s}") for c in cols])
    p = pairs.join(side("a"), "ra").join(side("b"), "rb")
    c = F.col
    named = c("core_a").isNotNull() & c("core_b").isNotNull()
    placed = c("sig_a").isNotNull() & c("sig_b").isNotNull()
    same_org = c("org_a") == c("org_b")
    trades = (F.size("trades_a") > 0) & (F.size("trades_b") > 0)
    codes = (c("code_a") != "") & (c("code_b") != "")
    most = F.floor(F.greatest(F.length("core_a"), F.length("core_b")) / 4)
    close = F.levenshtein("core_a", "core_b") <= most
    no_name, no_address, built = ~named, ~placed, c("built") == 1
    f = {
        "same_org": same_org, "close_name": ~F.coalesce(same_org, F.lit(False)) & close, "shared_word": F.arrays_overlap(words(c("core_a")), words(c("core_b"))), "no_name": no_name,
        "same_trade": trades & F.arrays_overlap("trades_a", "trades_b"), "other_trade": trades & ~F.arrays_overlap("trades_a", "trades_b"),
        "same_building": built, "same_house": c("house_a") == c("house_b"), "other_house": c("house_a") != c("house_b"), "no_address": no_address,
        "same_code": codes & (c("code_a") == c("code_b")), "other_code": codes & (c("code_a") != c("code_b")), "shared_place": F.arrays_overlap("places_a", "places_b"),
        "org_and_building": same_org & built, "org_no_address": same_org & no_address, "building_no_name": built & no_name,
    }
    flags = sum((F.when(f[k], 1 << i).otherwise(0) for i, k in enumerate(FEATURES)), F.lit(0))
    return p.select("ra", "rb", c("ent_a").alias("a"), c("ent_b").alias("c"), c("site_b").alias("site"), flags.alias("flags"))


def fit(labelled: DataFrame, most: int = TRAIN_PAIRS, ridge: float = 1.0, steps: int = 30) -> tuple[float, ...]:
    """Weights of FEATURES and a constant, by Newton's method on ``most`` labelled pairs at most, the first in hash order."""
    sample = labelled.orderBy(F.xxhash64("a", "c")).limit(most).select("flags", "label").toPandas()
    y = sample["label"].to_numpy(float)
    if len(y) == 0 or y.min() == y.max():
        return PRIOR
    bits = sample["flags"].to_numpy(np.int64)[:, None] >> np.arange(len(FEATURES)) & 1
    x = np.hstack([bits.astype(float), np.ones((len(y), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -CLIP, CLIP)))
        g = x.T @ (y - p) - ridge * w
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(map(float, w))


def log1pexp(x: Column) -> Column:
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.least(x, F.lit(CLIP)), F.lit(-CLIP))))


def propagate(pairs: DataFrame, scratch: Scratch, rounds: int = ROUNDS, change: float = CHANGE) -> DataFrame:
    """``a, c, confidence`` from ``a, c, site, logit``.

    Factors: of the pairs of a ``c`` one at most is true; the true pairs of an ``a`` are all at one ``site`` (pairs
    without a site fit any).  Messages pass between pairs with a competitor.  The others, and pairs below FAINT, keep their own
    odds, but the odds of faint pairs are summed up, for each ``c`` and for the other sites of each ``a``, and count against all pairs there.
    """
    odds_of = F.sum(F.exp("logit"))
    faint = pairs.where(F.col("logit") < FAINT)
    strong = pairs.where(F.col("logit") >= FAINT)
    of_c = pairs.groupBy("c").agg(F.count_if(F.col("logit") >= FAINT).alias("rivals"), F.sum(F.when(F.col("logit") < FAINT, F.exp("logit")).otherwise(0.0)).alias("faint_c"))
    here = F.when(F.col("logit") >= FAINT, F.col("site"))
    of_a = pairs.where("site IS NOT NULL").groupBy("a").agg((F.min(here) != F.max(here)).alias("spread"), F.sum(F.when(F.col("logit") < FAINT, F.exp("logit")).otherwise(0.0)).alias("faint_a"))
    of_site = faint.where("site IS NOT NULL").groupBy("a", "site").agg(odds_of.alias("faint_here"))
    marked = strong.join(of_c, "c").join(of_a, "a", "left").join(of_site, ["a", "site"], "left")
    elsewhere = F.greatest(F.coalesce("faint_a", F.lit(0.0)) - F.coalesce("faint_here", F.lit(0.0)), F.lit(0.0))
    elsewhere = F.when(F.col("site").isNull(), 0.0).otherwise(elsewhere)
    marked = marked.select("a", "c", "site", "logit", "faint_c", elsewhere.alias("faint_a"), ((F.col("rivals") > 1) | F.coalesce("spread", F.lit(False))).alias("live"))
    marked = scratch.cut(marked)
    live = marked.where("live").select("a", "c", "site", "logit", "faint_c", "faint_a", F.lit(0.0).alias("from_c"), F.lit(0.0).alias("from_a"))
    for _ in range(rounds):
        # One owner of c: the message is -log(1 + odds of all other pairs of c).
        x = live.withColumn("x", F.exp(F.least(F.col("logit") + F.col("from_a"), F.lit(CLIP))))
        sums = x.groupBy("c").agg(F.sum("x").alias("all"))
        step = x.join(sums, "c").withColumn("to", -F.log1p(F.greatest(F.col("all") - F.col("x"), F.lit(0.0)) + F.col("faint_c")))
        step = step.withColumn("new_c", F.col("to") * (1 - KEEP) + F.col("from_c") * KEEP).drop("x", "all", "to")
        # One site of a: A weighs the pair's own site without it, B all other sites.
        y = step.withColumn("g", log1pexp(F.col("logit") + F.col("new_c")))
        odds = lambda g: F.expm1(F.least(g, F.lit(2 * CLIP)))
        own = y.where("site IS NOT NULL").groupBy("a", "site").agg(F.sum("g").alias("own"))
        whole = own.groupBy("a").agg(F.sum(odds(F.col("own"))).alias("whole"))
        z = y.join(own.join(whole, "a"), ["a", "site"], "left")
        others = F.greatest(F.col("whole") - odds(F.col("own")), F.lit(0.0)) + F.col("faint_a")
        to = F.when(F.col("site").isNull(), 0.0).otherwise(-F.log1p(others * F.exp(-F.least(F.col("own") - F.col("g"), F.lit(2 * CLIP)))))
        new = z.withColumn("new_a", to * (1 - KEEP) + F.col("from_a") * KEEP)
        moved = F.abs(sigmoid(F.col("logit") + F.col("new_a") + F.col("new_c")) - sigmoid(F.col("logit") + F.col("from_a") + F.col("from_c")))
        new = scratch.cut(new.select("a", "c", "site", "logit", "faint_c", "faint_a", F.col("new_c").alias("from_c"), F.col("new_a").alias("from_a"), moved.alias("moved")))
        scratch.drop(live)
        live = new
        top = live.agg(F.max("moved")).first()[0]
        if top is None or top < change:
            break
    else:
        warnings.warn(f"beliefs still move by {top:.4f} after {rounds} rounds", RuntimeWarning, stacklevel=2)
    total = live.select("a", "c", (F.col("logit") + F.col("from_a") + F.col("from_c")).alias("logit"))
    alone = F.col("logit") - F.log1p("faint_c") - F.log1p("faint_a")
    settled = marked.where("NOT live").select("a", "c", alone.alias("logit")).unionByName(faint.select("a", "c", "logit"))
    return settled.unionByName(total).select("a", "c", sigmoid(F.col("logit")).alias("confidence"))


def match_records(records: DataFrame, labels: DataFrame) -> DataFrame:
    """``source1_entity_id, candidate_entity_id, confidence`` of all candidate pairs, except those ``crowded`` sums up.

    records: ``entity_id, clean_name, clean_addr, postal``, ids of source 1 beginning with S1-; labels: ``source1_entity_id,
    matched_entity_ids``, the true matches of some records (may be empty: then the weights of PRIOR hold).  Null and
    empty names and addresses leave the decision to what is given; a record with neither has no candidate.  A record
    delivered more than once counts with its best version.  Extra columns are ignored.
    """
    scratch = Scratch(records.sparkSession, "matching")
    rows, entities, links = described(records, scratch)
    # Written by itself, so that the shuffles of keys are gone when those of features come.
    met = scratch.cut(candidates(rows, links, scratch))
    scratch.drop(links)
    pairs = scratch.cut(features(met, rows).drop("ra", "rb"))
    scratch.drop(met)
    known = labels.select(clean_id(F.col("source1_entity_id")).alias("entity_id"), list_ids(F.col("matched_entity_ids")).alias("ids")).where("entity_id <> ''")
    known = known.join(entities, "entity_id").select(F.col("ent").alias("a"), "ids")
    true = known.select("a", F.explode("ids").alias("c")).select("a", clean_id(F.col("c")).alias("entity_id")).join(entities, "entity_id")
    true = true.select("a", F.col("ent").alias("c"), F.lit(1).alias("label")).distinct()
    labelled = pairs.join(known.select("a").distinct(), "a", "left_semi").join(true, ["a", "c"], "left").withColumn("label", F.coalesce("label", F.lit(0)))
    weights = fit(labelled)
    scored = pairs.select("a", "c", "site", log_odds(weights).alias("logit"))
    more = crowded(rows, weights, scratch)
    scored = scored if more is None else scored.unionByName(more)
    scored = scratch.cut(scored.groupBy("a", "c").agg(F.max_by("site", "logit").alias("site"), F.max("logit").alias("logit")))
    scratch.drop(pairs)
    beliefs = propagate(scored, scratch).where("a >= 0")
    one, other = (entities.select(F.col("ent").alias(k), F.col("entity_id").alias(name)) for k, name in (("a", "source1_entity_id"), ("c", "candidate_entity_id")))
    return beliefs.join(one, "a").join(other, "c").select("source1_entity_id", "candidate_entity_id", "confidence")
