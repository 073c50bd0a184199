"""p2_found: numbers of readings come without joins, keys are listed and met in tasks."""

import random

from linkloom.llm.addresses import _each, _packed, _unpacked, distinct_readings, read_all
from linkloom.llm.matching import candidates
from linkloom.runtime import Scratch


def written(spark):
    store, gateway = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway
    stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_readings_are_numbered_with_few_shuffled_bytes(spark):
    r = random.Random(3)
    word = lambda n: "".join(r.choice("abcdeilnorst") for _ in range(n))
    rows = [(f"S1-{i:08d}", f"{r.randrange(1, 9999)} {word(7)} road {word(8)} {word(6)} {10000 + i % 300}", "") for i in range(4000)]
    rows += [(f"S2-{i:08d}", a, p) for i, (_, a, p) in enumerate(rows[:1000])] + [("S3-1", "n a", ""), ("S3-2", "", "")]
    df = spark.createDataFrame(rows, "entity_id string, clean_addr string, postal string").repartition(3).localCheckpoint()
    before = written(spark)
    numbered, readings = distinct_readings(df, Scratch(spark, "test"))
    # 540,659 bytes with distinct addresses and readings joined, 316,337 without.
    assert written(spark) - before < 420_000
    sig = {x.entity_id: x.sig for x in numbered.collect()}
    assert len(sig) == len(rows) and sig["S3-1"] is None and sig["S3-2"] is None
    assert all(sig[f"S1-{i:08d}"] == sig[f"S2-{i:08d}"] for i in range(1000)) and min(v for v in sig.values() if v is not None) >= 0
    likeliest = {x.sig: (x.house, x.streets) for x in readings.where("first").collect()}
    assert readings.where("first").count() == len(likeliest) == len({tuple(map(str, read_all(a, p))) for _, a, p in rows if read_all(a, p)})
    assert all(likeliest[sig[i]] == read_all(a, p)[0][:2] for i, a, p in rows if sig[i] is not None)


def test_readings_that_share_a_number_are_seen(spark):
    texts = [_packed(read_all(a, "")) for a in ("12 mill road relpon 21213", "13 mill road relpon 21213", "8 hill 39 lane 8258 temple thonyville")]
    assert [_unpacked(t) for t in texts] == [[(h, s, d, k, p, c, x) for h, s, d, k, p, c, x in read_all(a, "")] for a in ("12 mill road relpon 21213", "13 mill road relpon 21213", "8 hill 39 lane 8258 temple thonyville")]
    read = lambda *rows: {(x.sig, x.clash) for x in _each(spark.createDataFrame(rows, "sig long, r string")).collect()}
    assert read((5, texts[0]), (5, texts[0]), (6, texts[1])) == {(5, False), (6, False)}
    assert read((5, texts[0]), (5, texts[1]), (6, texts[2])) == {(5, True), (6, False)}


def test_candidates_are_those_of_all_pairs(spark):
    r = random.Random(7)
    some = lambda *xs: r.choice([None, *xs])
    rows = []
    for i in range(300):
        org = some("o1", "o2", "o3", "o4")
        core = r.choice(["acme zed", "acmes", "oslo fish", "née garçon"]) if org else None
        sig = some(1, 2, 3, 4, 5)
        rows.append((i, i % 3 == 0, core, org, 30 if org == "o4" else 3, sig, *((str(sig % 2), r.sample(["oslo", "rome", "nice", "bonn", "kyiv", "bern"], sig % 3)) if sig else (None, None))))
    links = {(1, 3), (2, 5)}
    ends = lambda core: {e for w in core.split(" ") for e in (w[:4], w[-4:])}
    want = {}
    for a, own, core_a, org_a, branches, sig_a, house_a, places_a in rows:
        for b, other, core_b, org_b, _, sig_b, house_b, places_b in rows:
            if not own or other:
                continue
            named = org_a is not None and org_a == org_b
            placed = sig_a is not None and sig_b is not None
            met = named and (placed and (house_a == house_b or bool(set(places_a) & set(places_b))) or sig_b is None and branches <= 20 or sig_a is None)
            built = placed and (sig_a == sig_b or (sig_a, sig_b) in links or (sig_b, sig_a) in links)
            built = built and (core_a is None) + (core_b is None) < 2 and (core_a is None or core_b is None or bool(ends(core_a) & ends(core_b)))
            if met or built:
                want[a, b] = int(built)
    df = spark.createDataFrame(rows, "row long, own boolean, core string, org string, branches long, sig long, house string, places array<string>")
    found = candidates(df, spark.createDataFrame(sorted(links), "a long, b long"), Scratch(spark, "test"))
    got = found.collect()
    assert {(x.ra, x.rb): x.built for x in got} == want and len(got) == len(want)
    # Rows become keys where they are packed, and keys pairs where they are unpacked; before, three steps and an explode of keys.
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("MapInArrow") == 2 and "Generate" not in plan
