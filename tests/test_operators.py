"""Operators on small tables: edge cases, decisions, metrics, files, model and stream."""

import pytest
from pyspark.sql import functions as F

from linkloom.config import Options
from linkloom.operators import blocking as B
from linkloom.operators import check as C
from linkloom.operators import decide as D
from linkloom.operators import evaluate as V
from linkloom.operators import sampling as P
from linkloom.operators.eager import eager_join_aggregate, heavy_keys
from linkloom.operators.features import FEATURES, build_features
from linkloom.operators.model import Classifier, train
from linkloom.operators.neighbors import tfidf_topk
from linkloom.plans.pipeline import candidate_pairs, exact_blocks, run_inference, run_training
from linkloom.sources import records as R
from linkloom.streaming.incremental import stream_candidates

REC = "entity_id string, business_name string, business_address string, country string"


def people(spark, prefix, rows):
    return spark.createDataFrame([(f"{prefix}-{i:08d}", *r) for i, r in enumerate(rows)], REC).select("*", F.lit(None).cast("timestamp").alias("seen_at"), F.lit(None).cast("timestamp").alias("loaded_at"))


@pytest.fixture(scope="module")
def sides(spark):
    one = people(spark, "S1", [("Acme Bakery Ltd", "12 Main Rd 12345", "US"), ("Zed Motors", "7 Hill St", " us"), ("", "", "")])
    two = people(spark, "S2", [("ACME bakery", "12 Main Road 12345", "US"), ("Zed Motor", "7 Hill Street", "US"), ("Other", "1 X", "FR"), (None, None, None)])
    return R.normalize(R.first_rows(one)), R.normalize(R.first_rows(two.na.fill("")))


def test_heavy_join_equals_plain_join(spark):
    l = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("a", None, "y"), (None, 5, "z"), ("b", 7, "x"), ("", 1, "w")], "k string, v int, id string")
    r = spark.createDataFrame([("a", 10), ("a", 20), ("c", 5), (None, 1), ("", 3)], "k string, v int")
    got = {x.k: (x.pairs, x.left_sum_v, x.right_sum_v) for x in eager_join_aggregate(l, r, ["k"], left_sums=["v"], right_sums=["v"]).collect()}
    want = l.alias("l").join(r.alias("r"), "k").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("l.v").alias("a"), F.sum("r.v").alias("b"))
    assert got == {x.k: (x.n, x.a or 0, x.b or 0) for x in want.collect()}
    left = {x.k: x.pairs for x in eager_join_aggregate(l, r, ["k"], how="left").collect()}
    assert left == {"a": 6, "b": 0, "": 1}
    assert eager_join_aggregate(l.limit(0), r, ["k"]).count() == 0
    with pytest.raises(ValueError):
        eager_join_aggregate(l, r, ["k"], how="outer")


def test_heavy_keys(spark):
    rows = [("us", "a", f"i{i}", "extra") for i in range(30)] + [("us", "a", "i1", "again")] * 50 + [("us", "", "e1", ""), (None, "a", "e2", ""), ("us", "b", None, ""), ("us", "b", "z", "")]
    df = spark.createDataFrame(rows, "c string, w string, id string, n string")
    got = [tuple(r) for r in heavy_keys(df, ["c", "w"], "id", 0.1).collect()]
    assert got == [("us", "a", 30, 33)]
    assert heavy_keys(df.limit(0), ["c", "w"], "id", 0.1).count() == 0


def test_dedupe_keeps_first_arrival(spark):
    df = spark.createDataFrame([("S2-1", "late", "2024-01-02"), ("S2-1", "early", "2024-01-01"), ("S2-1", "early", "2024-01-01")], "entity_id string, business_name string, t string")
    df = df.select("entity_id", "business_name", F.lit("").alias("business_address"), F.lit("").alias("country"), F.to_timestamp("t").alias("loaded_at"), F.to_timestamp("t").alias("seen_at"))
    assert [r.business_name for r in R.first_rows(df).collect()] == ["early"]


def test_blocks_and_cap(sides):
    left, right = sides
    pairs = {tuple(r) for r in exact_blocks(left, right, 800).collect()}
    assert {("S1-00000000", "S2-00000000"), ("S1-00000001", "S2-00000001")} <= pairs
    assert not any(c == "S2-00000003" for _, c in pairs)
    counts = B.gram_counts(right)
    keys = B.long_keys(B.with_keys(right, counts))
    assert B.capped_block_join(B.long_keys(B.with_keys(left, counts)), keys, 0).count() == 0
    assert exact_blocks(left.limit(0), right, 800).count() == 0


def test_collapse_lists_every_record(sides, spark):
    left, _ = sides
    every = left.selectExpr("entity_id AS source1_entity_id")
    pairs = spark.createDataFrame([("S1-00000000", "S2-9"), ("S1-00000000", "S2-10"), ("S1-00000000", "S2-10")], "source1_entity_id string, candidate_entity_id string")
    got = {r[0]: r[1] for r in B.collapse_ids(pairs, every).collect()}
    assert got == {"S1-00000000": "S2-10,S2-9", "S1-00000001": "", "S1-00000002": ""}


def test_neighbours_equal_brute_force(sides):
    import math

    left, right = sides
    got = {(r[0], r[1]): r[2] for r in tfidf_topk(left, right, 2).collect()}
    from collections import Counter

    def grams(t):
        return Counter(g for w in t.lower().split() for n in (2, 3, 4) if n <= len(w) + 2 for g in [f" {w} "[i : i + n] for i in range(len(w) + 3 - n)])

    docs = {r.entity_id: (r.country, grams(f"{r.clean_name} {r.clean_addr} {r.postal}")) for r in [*left.collect(), *right.collect()] if r.country}
    us = [d for i, d in docs.items() if i[:2] == "S2" and d[0] == "US"]
    df = Counter(g for _, d in us for g in d)

    def vector(d):
        v = {g: (1 + math.log(n)) * (math.log((1 + len(us)) / (1 + df[g])) + 1) for g, n in d.items() if g in df}
        s = math.sqrt(sum(x * x for x in v.values()))
        return {g: x / s for g, x in v.items()}

    a = vector(docs["S1-00000000"][1])
    for c in ("S2-00000000", "S2-00000001"):
        b = vector(docs[c][1])
        want = round(sum(x * b.get(g, 0) for g, x in a.items()), 6)
        assert want == 0 or abs(got[("S1-00000000", c)] - want) < 2e-6


ATT = "source1_entity_id string, candidate_entity_id string, name1 string, addr1 string, postal1 string, country1 string, name2 string, addr2 string, postal2 string, country2 string"


def test_feature_edges(spark):
    rows = [
        ("a", "1", "", "", "12345", "", "", "", "", ""),
        ("b", "1", "a b", "x", "", " US", "b a a", "y", "", "us"),
        ("c", "1", "acme corp x", "1 2", "12345", "us", "acme", "2 1", "54321", "fr"),
    ]
    f = {r.source1_entity_id: r for r in build_features(spark.createDataFrame(rows, ATT)).collect()}
    a, b, c = f["a"], f["b"], f["c"]
    assert (a.name_jaccard, a.name_len_diff, a.name_length_ratio, a.name_contains, a.name_prefix_match, a.num_token_diff, a.postal_match, a.country_match) == (0, 0, 0, 0, 0, 0, 0.5, 1)
    assert (b.name_jaccard, b.name_sorted_tokens_exact, b.name_contains, b.name_token_overlap_ratio, b.name_first_word) == (1, 1, 1, 1, 0)
    assert abs(b.num_token_diff - 1 / 3) < 1e-9 and (b.digit_jaccard, b.addr_digit_exact, b.country_match, b.postal_match) == (1, 1, 1, 0.5)
    assert abs(c.name_jaccard - 1 / 3) < 1e-9 and abs(c.name_prefix_match - 4 / 11) < 1e-9 and abs(c.num_token_diff - 2 / 3) < 1e-9
    assert (c.name_contains, c.name_first_word, c.postal_match, c.addr_digit_exact) == (1, 1, 0, 1)
    assert len(FEATURES) == 24


def scored(spark, scores):
    return spark.createDataFrame([("s", f"c{i}", p) for i, p in enumerate(scores)], "source1_entity_id string, candidate_entity_id string, prob double")


@pytest.mark.parametrize("scores,kept", [((0.96, 0.95), 2), ((0.92, 0.85), 0), ((0.92, 0.80), 1), ((0.96, 0.89), 1), ((0.91,), 1), ((0.89, 0.10), 0)])
def test_decision(spark, scores, kept):
    assert D.accept(scored(spark, scores), 0.90, 0.10).count() == kept


@pytest.mark.parametrize(
    "pred,true,p,r,f",
    [("S2-00047,S2-00193,S3-00812", "S2-00047,S3-00812", 2 / 3, 1, 0.714286), ("", "", 1, 1, 1), ("", "a", 1, 0, 0), ("a", "", 0, 1, 0), ("a", "b", 0, 0, 0), (" a , a,", "a", 1, 1, 1), ("nan", "", 1, 1, 1)],
)
def test_metric(spark, pred, true, p, r, f):
    mk = lambda x: spark.createDataFrame([("s", x)], "source1_entity_id string, matched_entity_ids string")
    got = V.entity_scores(mk(pred), mk(true)).first()
    assert abs(got.p - p) < 1e-6 and abs(got.r - r) < 1e-6 and abs(got.f - f) < 1e-6


def test_sweep_equals_single_points(spark):
    s = spark.createDataFrame([("s", "a", 0.7), ("s", "b", 0.66), ("t", "a", 0.9), ("u", "z", 0.61), ("u", "y", 0.6)], "source1_entity_id string, candidate_entity_id string, prob double")
    truth = spark.createDataFrame([("s", "a"), ("t", ""), ("u", "z"), ("v", "q")], "source1_entity_id string, matched_entity_ids string")
    sweep = {(round(r.threshold, 2), round(r.margin_min, 2)): r.macro_f05 for r in V.threshold_sweep(s, truth, V.sweep_grid(spark)).collect()}
    assert len(sweep) == 125
    for cell in ((0.6, 0.0), (0.6, 0.1), (0.66, 0.05)):
        one = V.macro(V.entity_scores(D.decide_matches(s, truth.select("source1_entity_id"), *cell), truth)).first()
        assert abs(one.macro_f05 - sweep[cell]) < 1e-9


def test_split_keeps_entities_whole(spark):
    rows = spark.createDataFrame([(f"S1-{i % 200:08d}",) for i in range(400)], "source1_entity_id string")
    out = P.entity_split(rows, 0.2)
    assert out.distinct().count() == 200
    assert 20 <= out.where("held_out").distinct().count() <= 60


def test_pool_holds_all_positives(spark):
    c = spark.createDataFrame([(f"S2-{i}", "US" if i % 2 else "FR") for i in range(40)], "entity_id string, country string")
    pos = c.where("entity_id IN ('S2-1', 'S2-3')").select("entity_id")
    out = P.candidate_pool(c, pos, 5).groupBy("country").agg(F.count(F.lit(1)).alias("n"), F.count_if("positive").alias("p")).collect()
    assert {r.country: (r.n, r.p) for r in out} == {"US": (5, 2), "FR": (5, 0)}


def test_tsv_round_trip(spark, tmp_path):
    src = tmp_path / "in.tsv"
    src.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"say ""hi"""\t"two\nlines"\t\nS1-2\tplain, with comma\t\tUS\n', encoding="utf-8")
    df = R.read_tsv(spark, str(src), R.RECORD)
    rows = {r.entity_id: tuple(r)[1:] for r in df.collect()}
    assert rows == {"S1-1": ('say "hi"', "two\nlines", ""), "S1-2": ("plain, with comma", "", "US")}
    out = spark.createDataFrame([("S1-1", ""), ("S1-2", "S2-1,S2-2")], "source1_entity_id string, matched_entity_ids string")
    R.write_tsv(out, str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("part-*")).read_text()
    assert text.splitlines() == ["source1_entity_id\tmatched_entity_ids", "S1-1\t", "S1-2\tS2-1,S2-2"]
    (tmp_path / "ids.tsv").write_text("id\tx\na\t1\n\nb\t2\na\t3\n")
    assert {r[0] for r in R.read_ids(spark, str(tmp_path / "ids.tsv")).collect()} == {"a", "b"}


def test_results_in_several_files_and_in_order(spark, tmp_path):
    ids = [f"S1-{i:02d}" for i in (5, 3, 9, 1, 7)]
    every = spark.createDataFrame([(x, i) for i, x in enumerate(ids)] + [("S1-03", 9)], "source1_entity_id string, at long")
    lists = spark.createDataFrame([(x, "") for x in sorted(ids)], "source1_entity_id string, matched_entity_ids string")
    ordered = B.in_order(lists, every, "at")
    assert [r[0] for r in ordered.collect()] == ids
    R.write_tsv(ordered, str(tmp_path / "out"), files=None)
    texts = [p.read_text().splitlines()[1:] for p in sorted((tmp_path / "out").glob("part-*"))]
    assert [line.split("\t")[0] for t in texts for line in t] == ids


def test_lines_are_numbered_across_parts(spark, tmp_path):
    path = tmp_path / "lines.txt"
    path.write_text("\n".join(f"line {i}" for i in range(1, 4001)) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = R.read_lines(spark, str(path))
        assert lines.select(F.spark_partition_id()).distinct().count() > 1
        assert {r.line_no: r.value for r in lines.collect()} == {i: f"line {i}" for i in range(1, 4001)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_country_sample(spark):
    c = spark.createDataFrame([(f"S2-{i:04d}", None if i % 5 == 0 else "US" if i % 2 else "FR") for i in range(900)], "entity_id string, country string")
    got = P.country_sample(c, 100).collect()
    by = {}
    for r in got:
        by.setdefault(r.country, []).append(r.entity_id)
    assert {k: len(v) for k, v in by.items()} == {None: 100, "US": 100, "FR": 100}
    order = {r.entity_id: r.h for r in c.select("entity_id", P.hash_order("entity_id").alias("h")).collect()}
    for k, v in by.items():
        every = sorted((r.entity_id for r in c.collect() if r.country == k), key=lambda x: (order[x], x))
        assert set(v) == set(every[:100])
    assert P.country_sample(c, None).count() == 900 and P.country_sample(c.limit(0), 5).count() == 0


def test_scores_at_a_threshold(spark):
    scored = spark.createDataFrame([("a", "x", 0.9), ("a", "y", 0.88), ("b", "z", 0.72), ("b", "w", 0.7), ("c", "v", 0.2)], "source1_entity_id string, candidate_entity_id string, prob double")
    truth = spark.createDataFrame([("a", "x"), ("b", "z"), ("c", ""), ("d", "u")], "source1_entity_id string, matched_entity_ids string")
    r = V.score_at_threshold(scored, truth, 0.71).first()
    assert (r.n_entities, r.n_singletons, r.n_with_matches) == (4, 1, 3)
    assert abs(r.macro_precision - (0.5 + 1 + 1 + 1) / 4) < 1e-9 and abs(r.macro_recall - 3 / 4) < 1e-9
    assert V.score_at_threshold(scored, truth, 0.71, 0.1).first().macro_recall == 0.5  # b's sole match is ambiguous
    assert V.score_at_threshold(scored.limit(0), truth, 0.5).first().macro_recall == 0.25
    assert V.threshold_sweep(scored, truth.limit(0), V.sweep_grid(spark)).count() == 0


HEAD = "source1_entity_id\tmatched_entity_ids\n"


@pytest.mark.parametrize(
    "text,word",
    [
        (HEAD + "S1-1\tS2-1\nS1-2\t\n", None),
        ("source1_entity_id,matched_entity_ids\nS1-1,S2-1\n", "commas"),
        ("id\tlist\nS1-1\t\n", "header"),
        (HEAD + "S1-1\tS2-1\nS1-2\t\nS1-1\t\n", "more than one row"),
        (HEAD + "S1-1\tS2-1,S2-1\nS1-2\t\n", "repeated id"),
        (HEAD + "S1-1\tS1-2\nS1-2\t\n", "source-1 ids"),
        (HEAD + "S1-1\tS2-1, S2-2\nS1-2\t\n", "another form"),
        (HEAD + "S1-1\tS2-1\n", "without a row"),
        (HEAD + "S1-1\tS2-1\nS1-2\t\nS1-3\t\n", "unknown records"),
        (HEAD + "S1-1\tS2-77\nS1-2\t\n", "unknown ids"),
        (HEAD + "S1-1 S2-1\nS1-1\t\nS1-2\t\n", "line 2: no tab"),
        (HEAD + "S1-1\tS2-1\n\nS1-2\t\n\n", None),
        (HEAD + " S1-1\tS2-1\nS1-2\t\n", "unknown records"),
        (HEAD + "S1-1 \tS2-1\nS1-2\t\n", "unknown records"),
        (HEAD + "S1-1\t S2-1\nS1-2\t\n", "another form"),
        (HEAD + "S1-1\tS2-1 \nS1-2\t\n", "unknown ids"),
        (HEAD + "S1-1\t  \nS1-2\t\n", None),
        ("", "empty"),
    ],
)
def test_validator(spark, tmp_path, text, word):
    path = tmp_path / "m.tsv"
    path.write_text(text)
    required = spark.createDataFrame([("S1-1",), ("S1-2",)], "source1_entity_id string")
    known = spark.createDataFrame([("S2-1",), ("S2-2",)], "entity_id string")
    errors, _ = C.validate_file(spark, str(path), R.MATCHES, required, known)
    assert (not errors) if word is None else any(word in e for e in errors), errors


def test_validator_warns_about_matches_outside_candidates(spark, tmp_path):
    (tmp_path / "m.tsv").write_text(HEAD + "S1-1\tS2-1\n")
    (tmp_path / "c.tsv").write_text("source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-2\n")
    required = spark.createDataFrame([("S1-1",)], "source1_entity_id string")
    errors, warnings = C.validate(spark, str(tmp_path / "m.tsv"), str(tmp_path / "c.tsv"), required)
    assert not errors and len(warnings) == 1
    assert C.validate(spark, str(tmp_path / "m.tsv"), None, required)[1]
    assert C.validate_file(spark, str(tmp_path / "none.tsv"), R.MATCHES, required)[0]


def test_validator_reads_bytes_and_folders(spark, tmp_path):
    (tmp_path / "m.tsv").write_bytes(HEAD.encode() + "S1-1\tS2-1é\n".encode("latin-1"))
    required = spark.createDataFrame([("S1-1",)], "source1_entity_id string")
    errors, rows = C.validate_file(spark, str(tmp_path / "m.tsv"), R.MATCHES, required)
    assert rows is None and "line 2 is no UTF-8" in errors[0]
    (tmp_path / "m.tsv").write_text(HEAD + "S1-1\tS2-1\nS1-2\t\n")
    assert "no such file" in C.validate_folder(spark, str(tmp_path / "m.tsv"), None, str(tmp_path))[0][0]
    (tmp_path / "test_source1.tsv").write_text("entity_id\tbusiness_name\nS1-1\tx\nS1-2\ty\n")
    errors, warnings = C.validate_folder(spark, str(tmp_path / "m.tsv"), None, str(tmp_path), check_ids=True)
    assert not errors and len(warnings) == 3 and "test_source2" in warnings[0]
    for i in (2, 3):
        (tmp_path / f"test_source{i}.tsv").write_text(f"entity_id\nS{i}-9\n")
    assert "unknown ids" in C.validate_folder(spark, str(tmp_path / "m.tsv"), None, str(tmp_path), check_ids=True)[0][0]
    counts = {}
    C.validate_file(spark, str(tmp_path / "m.tsv"), R.MATCHES, required, counts=counts)
    assert counts == {"rows": 2, "empty": 1}


def test_command(spark, data, tmp_path, capsys):
    from linkloom.__main__ import main

    for i in (1, 2, 3):
        rows = R.records(spark, data, (i,)).select(*R.RECORD).toPandas().drop_duplicates("entity_id")
        for part in ("train", "test"):
            rows.to_csv(tmp_path / f"{part}_source{i}.tsv", sep="\t", index=False)
    from linkloom.sources.tables import table

    table(spark, data, "train_matches").toPandas().to_csv(tmp_path / "train_ground_truth.tsv", sep="\t", index=False)
    paths = ["--data", str(tmp_path), "--model", str(tmp_path / "model"), "--output", str(tmp_path / "out"), "--rounds", "3", "--threshold", "0.5"]
    for mode in ("all", "validate", "sweep"):
        assert main(["--mode", mode, *paths], spark) == 0
    said = capsys.readouterr().out
    assert "held-out: precision" in said and "macro_f05" in said and "best: threshold" in said
    assert main(["--mode", "check", "--check-ids", *paths], spark) == 0 and "passed" in capsys.readouterr().out
    first = next((tmp_path / "out" / "matching_results.tsv").glob("part-*")).read_text().splitlines()
    one = (tmp_path / "test_source1.tsv").read_text().splitlines()
    assert [line.split("\t")[0] for line in first[1:]] == [line.split("\t")[0] for line in one[1:]]


SMALL = Options(rounds=5, depth=3, threshold=0.5, top_k=3)


def test_train_and_infer(spark, data, tmp_path):
    from linkloom.sources.tables import table

    one, rest = R.records(spark, data, (1,)), R.records(spark, data, (2, 3))
    truth = table(spark, data, "train_matches")
    model, scores = run_training(one, rest, truth, str(tmp_path / "model"), SMALL)
    assert 0 <= scores.first().macro_f05 <= 1
    again = Classifier.load(str(tmp_path / "model"))
    assert again.names == model.names == FEATURES
    out = run_inference(one, rest, again, SMALL)
    n = one.select("entity_id").distinct().count()
    assert out.matches.count() == out.candidates.count() == n
    assert C.outside_candidates(out.matches, out.candidates).count() == 0


def test_training_needs_pairs(spark):
    empty = spark.createDataFrame([], "source1_entity_id string, candidate_entity_id string, name_jaccard double")
    truth = spark.createDataFrame([("a", "")], "source1_entity_id string, matched_entity_ids string")
    with pytest.raises(ValueError):
        train(empty, truth)


def test_stream_gives_the_batch_lists(spark, sides, tmp_path):
    left, right = sides
    raw = left.select(*R.RECORD, "seen_at", "loaded_at").coalesce(1)
    raw.write.parquet(str(tmp_path / "in"))
    got = {}
    stream = spark.readStream.schema(raw.schema).parquet(str(tmp_path / "in"))
    q = stream_candidates(stream, right, lambda df, _: got.update({r[0]: r[1] for r in df.collect()}), str(tmp_path / "cp"))
    q.awaitTermination(120)
    want = {r[0]: r[1] for r in B.collapse_ids(exact_blocks(left, right, 800), left.selectExpr("entity_id AS source1_entity_id"), "x").collect()}
    assert got == want


def test_no_pair_is_dropped_unasked(sides):
    left, right = sides
    assert Options().pair_cap is None
    every = candidate_pairs(left, right, Options(top_k=1)).count()
    assert every > 1 and candidate_pairs(left, right, Options(top_k=1, pair_cap=1)).count() == 1
