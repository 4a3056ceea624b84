import random

from colophon.llm import canonical_list as M

ENTRIES = [(1, "Journal of Groove Chemistry", "J. Groo. Chem."), (2, "Annals of Groove Chemistry", "Ann. Groo. Chem."), (3, "Duplexology Reports", None), (4, "International Review of Viral Repeats", "Int. Rev. Viral Repea.")]


def grams(text):
    p = f" {text} "
    return {p[i : i + 3] for i in range(len(p) - 2)}


def test_forms(spark):
    values = ["J Groo Chem", "journal of groove chemsitry", "The Annals of Groove Chemistry (Online)", "DUPLEXOLOGY  REPTS.", "Intl Rev of Viral Repeats, vol. 9", "Weather Almanac", "", "-", None, "Jnl Groove Chemistry"]
    df = spark.createDataFrame([(v, 5) for v in values], "journal string, n int")
    entries = spark.createDataFrame(ENTRIES, "journal_id int, title string, abbreviation string")
    got = {r["value"]: r["entry"] for r in M.map_to_list(df, "journal", entries, "journal_id", ["title", "abbreviation"]).collect()}
    assert got == {"J Groo Chem": 1, "journal of groove chemsitry": 1, "The Annals of Groove Chemistry (Online)": 2, "DUPLEXOLOGY  REPTS.": 3, "Intl Rev of Viral Repeats, vol. 9": 4, "Weather Almanac": None, "": None, "-": None, "Jnl Groove Chemistry": 1}
    assert all(r["entry"] is None for r in M.map_to_list(df, "journal", entries.limit(0), "journal_id", ["title", "abbreviation"]).collect())
    assert M.map_to_list(df.limit(0), "journal", entries, "journal_id", ["title"]).count() == 0


def test_join_against_brute_force(spark):
    random.seed(4)
    def word():
        return "".join(random.choice("abcd") for _ in range(random.randint(3, 9)))
    left, right = sorted({word() for _ in range(120)}), sorted({word() for _ in range(120)})
    want = {(a, b) for a in left for b in right if len(grams(a) & grams(b)) / len(grams(a) | grams(b)) >= 0.5}
    tables = [spark.createDataFrame([(x, sorted(grams(x))) for x in side], "key string, grams array<string>") for side in (left, right)]
    got = M.similarity_join(*tables, 0.5).collect()
    assert {(r["left_key"], r["right_key"]) for r in got} == want and len(got) == len(want) > 20


def test_hot_value(spark):
    df = spark.range(2000).selectExpr("id", "if(id % 3 = 0, 'J Groo Chem', concat('x', id % 40)) journal")
    entries = spark.createDataFrame(ENTRIES, "journal_id int, title string, abbreviation string")
    mapped = M.map_to_list(df, "journal", entries, "journal_id", ["title", "abbreviation"])
    rows = M.match_rows(df, "journal", mapped)
    assert rows.count() == 2000 and rows.where("entry = 1").count() == 667
