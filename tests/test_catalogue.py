"""Every catalogue query against its SQL on the smallest tables, and scalar expectations of the text functions."""

import math
import re

import duckdb
import pytest

from sievework.functions import vocab
from sievework.functions.dialect import Spark, dimension, dimension_kind, first_match, map_type, snake
from sievework.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
D = Spark()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return float(v) if type(v).__name__ == "Decimal" else v


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_matches_sql(spark, engine, name):
    df = catalogue.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = engine.sql(f"select {', '.join(chr(34) + c + chr(34) for c in columns)} from ({catalogue.ORACLES[name]})").fetchall()
    got = [tuple(r) for r in df.select(*columns).collect()]
    rows = lambda x: sorted((tuple(map(plain, r)) for r in x), key=repr)
    assert rows(got) == rows(want)


def value(spark, expression, text):
    df = spark.createDataFrame([(text,)], "x string")
    return spark.sql(f"SELECT {expression} AS v FROM {{t}}", t=df).first().v


@pytest.mark.parametrize(
    ("text", "kind", "want"),
    [
        ("400x40x15mm", "box", {"length_mm": 400, "width_mm": 40, "height_mm": 15}),
        ("85.5 × 40mm", "plate", {"length_mm": 85.5, "width_mm": 40}),
        ("m3x12mm", "thread_length", {"length_mm": 12}),
        ("25mm dia", "diameter", {"diameter_mm": 25}),
        ("5mm diameter x 80mm length", "cylinder", {"diameter_mm": 5, "length_mm": 80}),
        ("300mm length, 1.5mm diameter", "cylinder_reversed", {"length_mm": 300, "diameter_mm": 1.5}),
        ("6mm ID x 9mm OD x 5m L", "tube", {"id_mm": 6, "od_mm": 9, "length_mm": 5000}),
        ("~0.8m length", "length", {"length_mm": 800}),
        ("palm sized", "unparsed", {}),
    ],
)
def test_dimensions(spark, text, kind, want):
    assert value(spark, dimension_kind(D, "x"), text) == kind
    for f in ("length_mm", "width_mm", "height_mm", "diameter_mm", "id_mm", "od_mm"):
        assert value(spark, dimension(D, "x", f), text) == want.get(f)


@pytest.mark.parametrize(
    ("text", "want"),
    [("servo horn", "rotates_on"), ("cable routed", "routed_around"), ("press-fit", "attached_to"), ("M3 bolts", "fastens_into"), ("secures", "secured_by"), ("rests on", "supported_by"), ("", "attached_to")],
)
def test_relations(spark, text, want):
    e = first_match(D, "x", vocab.RELATIONS, "'attached_to'").replace("{", "{{").replace("}", "}}")
    assert value(spark, e, text) == want


@pytest.mark.parametrize(("text", "want"), [("Servo Horn (left)", "servo_horn_left"), ("3.5mm Jack", "3_5mm_jack"), ("Ünit-2", "nit_2"), ("--", "unknown")])
def test_snake(spark, text, want):
    assert value(spark, snake(D, "x"), text) == want


def test_types(spark):
    assert value(spark, map_type(D, "'misc'", "x"), "M3 Screw") == "fastener"
    assert value(spark, map_type(D, "'sensor'", "x"), "X") == "electronic"
    assert value(spark, map_type(D, "'machined'", "x"), "Plate") == "misc"


@pytest.mark.parametrize("text", ["os loraíja", "éimu", "a pir", "pİr", "İlora", "x lora_ y lora", "wi-fi.", None])
def test_keywords_end_at_letters_beyond_ascii(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    con = duckdb.connect()
    con.execute("create table documents as select 1::bigint as doc_id, ?::varchar as text", [text])
    got = spark.sql(catalogue._keywords(D), documents=df).collect()
    want = con.sql(catalogue.ORACLES["keyword_audit"]).fetchall()
    assert sorted(map(tuple, got)) == sorted(want)


def test_jaccard_over_buckets_and_many_copies(spark):
    base = ["steel arm long blue", "steel arm long red", "steel arm", "arm steel", "the of", "", None, "steel arm long", "ring"]
    rows = [(i * 37 - 70000, base[i % len(base)]) for i in range(6000)] + [(None, "steel arm")]
    df = spark.createDataFrame(rows, "p_partkey long, p_name string")
    con = duckdb.connect()
    con.register("part", df.toArrow())
    want = con.sql(f"select a, n_similar, best from ({catalogue.ORACLES['jaccard_pairs']})").fetchall()
    out = spark.sql(catalogue.jaccard_pairs(catalogue._S), part=df)
    assert sorted((r.a, r.n_similar, r.best) for r in out.collect()) == sorted(want) and len(want) > 3000
    assert not re.search(r"id#\d+L < id#", out._jdf.queryExecution().optimizedPlan().toString())  # parts never meet one by one
