"""Readings of addresses, and pairs at one building against all pairs."""

import pytest

from linkloom.llm.addresses import address_pairs, read_address

READ = {
    "apartment b7 5630 east fisherman court rasmasfield pe 28427": ("5630", "fisherman", "east", "court"),
    "5678 vikvo street 20011 3605": ("5678", "vikvo", "", "street"),
    "24221 8107 fullatlat ln suite 17": ("8107", "fullatlat", "", "lane"),
    "36 floor 8548 railway ln morixton": ("8548", "railway", "", "lane"),
    "9032 r de la pimelmor 60249 ixrel sur ombre": ("9032", "pimelmor", "", "rue"),
    "number 2238 3rd av grivenfield": ("2238", "third", "", "avenue"),
    "9263 twelfth ct": ("9263", "twelfth", "", "court"),
    "9263 12thcrt vikvoville": ("9263", "twelfth", "", "court"),
    "321 garden la 1 relpon falls 21219": ("321", "garden", "", "lane"),
    "4964 nype1dak crt": ("4964", "nypeldak", "", "court"),
}


@pytest.mark.parametrize("text", READ)
def test_readings(text):
    number, streets, direction, kind, _, _ = read_address(text, "")
    house, street, d, k = READ[text]
    assert house == number and street in streets and (direction, kind) == (d, k)


@pytest.mark.parametrize("text", ["", None, "n a", "falls", "12345", "suite 5", "x" * 5000, "1 " * 3000])
def test_no_address(text):
    assert read_address(text, None) is None


ROWS = [
    ("S1-1", "12 mill road relpon falls ni 21213", "21213", 1), ("S2-2", "relpon falls 21213 12 mill rd", "21213", 1), ("S2-3", "suite 4 12 mil road relpon falls", "", 1),
    ("S3-4", "14 mill road relpon falls ni 21213", "21213", 2), ("S3-5", "12 mill lane relpon falls ni 21213", "21213", 3), ("S3-6", "12 mill road vikvoville 20011", "20011", 4),
    ("S1-7", "12 millroad relpon falls 212 13", "", 1), ("S2-8", None, None, None), ("S2-9", "", "", None), ("S2-10", "n a", "", None), (None, "12 mill road relpon falls ni 21213", "21213", None),
    ("S2-2", "relpon falls 21213 12 mill rd", "21213", 1), ("S1-11", "12 east mill road relpon falls 21213", "21213", 1), ("S1-12", "12 west mill road relpon falls 21213", "21213", 5),
]


def test_pairs(spark):
    df = spark.createDataFrame([(*r[:3], "x") for r in ROWS], "entity_id string, clean_addr string, postal string, sig string")
    got = {tuple(r) for r in address_pairs(df.drop("sig").withColumnRenamed("entity_id", "entity_id")).collect()}
    ids = {}
    for e, _, _, k in ROWS:
        if e and k:
            ids[e] = k
    want = {(a, b) for a in ids for b in ids if a < b and ids[a] == ids[b]}
    # Without a direction an address may be on either; with two different ones it is not.
    either = {tuple(sorted(p)) for p in [("S1-12", x) for x, k in ids.items() if k == 1 and x != "S1-11"]}
    assert got - either == want
    assert ("S1-11", "S1-12") not in got
    assert {tuple(r) for r in address_pairs(df).collect()} == got  # columns with clashing names
    assert address_pairs(df.limit(0)).count() == 0


def test_long_text(spark):
    df = spark.createDataFrame([("a", "12 mill road relpon " + "word " * 20000, ""), ("b", "12 mill road relpon", "")], "entity_id string, clean_addr string, postal string")
    assert [tuple(r) for r in address_pairs(df).collect()] == [("a", "b")]


def test_every_plausible_reading_is_used(spark):
    rows = [
        ("a", "8258 temple thonyville 21213"), ("b", "39 lemwenfield 8258 temple thonyville 21213"), ("c", "5 hill street 12 park road relpon 21213"),
        ("d", "12 park road 5 hill street relpon 21213"), ("e", "12 park hill road morixton 20011"), ("f", "12 park view road morixton 20011"),
        ("g", "7 hill road morixton 20011"), ("h", "7 hull road morixton 20011"),
    ]
    df = spark.createDataFrame([(i, a, "") for i, a in rows], "entity_id string, clean_addr string, postal string")
    assert {tuple(r) for r in address_pairs(df).collect()} == {("a", "b"), ("c", "d"), ("g", "h")}
