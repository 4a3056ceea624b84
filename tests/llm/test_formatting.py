import json
import re

from colophon.llm import formatting as M


def canon(text):
    return "".join(ch for ch in text.casefold() if ch.isalnum())


def test_records_against_brute_force(spark):
    rows = [
        ("1", "Small rings: a study", "10.1234/a.b", 7), ("2", "SMALL RINGS — A STUDY", "doi:10.1234/A-B", 7), ("3", "small rings a study", "https://resolver.example/10.1234/a_b", 7),
        ("4", "Small rings: another", "<10.1234/a.b>", 7), ("5", None, "10.1234/a.b", 7), ("6", "Small rings: a study", None, 7), ("7", "", "", 7), ("8", "!", "?", 7), ("9", "x" * 50_000, "10.1/x", 7), ("A", "X" * 50_000, "DOI: 10.1/x", 7),
    ]
    df = spark.createDataFrame(rows, "record_id string, title string, doi string, pos int")
    groups, members = M.formatting_duplicates(M.record_values(df))
    assert {tuple(r) for r in members.select("first_id", "copy_id").collect()} == {("1", "2"), ("1", "3"), ("7", "8"), ("9", "A")}
    assert sum(r["copies"] for r in groups.collect()) == 8


def test_bodies(spark):
    a = {"title": "T one", "authors": ["Ann B.", "Cy D"], "publication_year": 2019}
    bodies = [
        json.dumps(a), "TITLE: t  ONE.\nAuthors:\n- ANN B\n  -  cy d\nPublication_Year: '2019'", json.dumps({k.upper(): v for k, v in reversed(a.items())}, indent=1),
        json.dumps(a | {"authors": ["Cy D", "Ann B."]}), json.dumps(a | {"authors": ["Ann B.", "Cy D", "E"]}), json.dumps(a | {"publication_year": 2020}), json.dumps(a | {"doi": None}), "", None, "no fields", json.dumps(a),
    ]
    df = spark.createDataFrame([(f"R{i:02d}", b) for i, b in enumerate(bodies)], "raw_id string, body string")
    _, members = M.formatting_duplicates(M.body_values(df))
    assert {(r["first_id"], r["copy_id"]) for r in members.collect()} == {("R00", "R01"), ("R00", "R02"), ("R00", "R06"), ("R00", "R10")}


def test_hot_group_and_empty(spark):
    df = spark.range(3000).selectExpr("lpad(cast(id as string), 6, '0') record_id", "if(id % 3 = 0, concat('Same ', repeat(' ', cast(id % 5 as int)), 'title'), concat('t', id)) title", "if(id % 3 = 0, '10.1/x', concat('10.1/', id)) doi")
    _, members = M.formatting_duplicates(M.record_values(df))
    assert members.count() == 999 and members.where("first_id = '000000'").count() == 999
    groups, members = M.formatting_duplicates(M.record_values(df.limit(0)))
    assert groups.count() == members.count() == 0


def test_canonical(spark):
    df = spark.createDataFrame([("Ω-x ’Y",), ("ß",), (None,)], "v string")
    from pyspark.sql import functions as F

    assert [r[0] for r in df.select(M.canonical(F.col("v"))).collect()] == ["ωxy", "ss", None]
    assert re.sub(r"\W", "", canon("Ω-x ’Y")) == "ωxy"
