"""Queries of the subpackage on the test tables."""

import math

import pytest

from linkloom.llm import queries as Q


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_equals_sql(name, spark, data, duck):
    got, want = Q.queries()[name](spark, data).toPandas(), duck.sql(Q.oracle_sql()[name]).df()
    value = lambda x: "" if x is None or isinstance(x, float) and math.isnan(x) else str(x)
    rows = lambda df: sorted(tuple(map(value, r)) for r in df[sorted(df.columns)].itertuples(index=False))
    assert rows(got) == rows(want)


COLUMNS = {
    "p1_found": ["entity_id_a", "entity_id_b"], "p2_found": ["source1_entity_id", "candidate_entity_id"], "p4_found": ["name_a", "name_b"],
    "p5_found": ["entity_id", "group_id"], "p6_ids": ["doc_id", "ids"], "p8_found": ["doc_id", "sent_end"],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_keys(name, spark, data):
    df = Q.queries()[name](spark, data)
    assert df.columns == COLUMNS[name]
    rows = [tuple(map(str, r)) for r in df.collect()]
    assert rows and len(rows) == len(set(rows))
    if name in ("p1_found", "p4_found"):
        assert all(a < b for a, b in rows)


def test_recall_of_addresses_and_names(spark, data):
    """Labelled matches are at one building and of one organisation, where both sides say so."""
    from pyspark.sql import functions as F

    d = "/root/testdata/sf0.01"
    labels = Q.table(spark, d, "train_matches").select("source1_entity_id", F.explode(F.split("matched_entity_ids", ",")).alias("b")).where("b <> ''").collect()
    recs = {}
    for r in Q.business_records(spark, d).collect():
        recs.setdefault(r.entity_id, []).append(r)
    near = {tuple(r) for r in Q.p1_found(spark, d).collect()}
    same = {tuple(r) for r in Q.p4_found(spark, d).collect()}
    placed = [(a, b) for a, b in labels if all(any(r.clean_addr not in (None, "", "n a") for r in recs[x]) for x in (a, b))]
    assert sum(tuple(sorted(p)) in near for p in placed) >= 0.97 * len(placed)
    names = [(x.clean_name, y.clean_name) for a, b in labels for x in recs[a][:1] for y in recs[b][:1] if x.clean_name and y.clean_name and x.clean_name != y.clean_name]
    assert sum(tuple(sorted(p)) in same for p in names) >= 0.93 * len(names)
