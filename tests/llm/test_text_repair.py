import random
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from colophon.llm import mojibake as M
from colophon.llm import unify as U

CLEAN = ["Étude de la liaison", "Jürgen Sørensen", "Ångström maps à côté", "José García", "Małgorzata Łuk", "α-linked 5′-end – x", "Renée Bîlo", "Zoë Pëtru", "João Ñandú"]


def garble(text, encoding, times=1):
    table = M._chars(encoding)
    for _ in range(times):
        text = "".join(table[b] for b in text.encode())
    return text


def entries(spark, texts):
    return spark.createDataFrame([(str(i), t, "clash") for i, t in enumerate(texts)], "record_id string, text string, clean string").drop("clean")


def test_learned_from_twins_and_applied_to_the_rest(spark):
    encodings = ["cp1252", "mac_roman", "cp437", "cp1251", "cp1250"]
    twins = CLEAN + [garble(t, e) for t in CLEAN[:4] for e in encodings]
    rest = [garble("Übermäßig schön", e) for e in encodings] + [garble("Ligação à região", "cp1252", 2)]
    plain = ["plain text", "", None, "Ligação à região", "саленга", "“über – été”", "x" * 40_000 + "é"]
    fields = entries(spark, twins + rest + plain + ["Jos� Garc�a", "lost�"])
    learned, _ = M.learn(fields)
    assert set(encodings) <= set(learned)
    got = {r["text"]: r["restored"] for r in M.garbled_fields(fields).collect()}
    assert not set(got) & set(CLEAN + plain)
    assert all(got[g] == c for c in CLEAN[:4] for g in [garble(c, e) for e in encodings])
    assert all(got[g] == "Übermäßig schön" for g in rest[:5]) and got[rest[5]] == "Ligação à região"
    assert got["Jos� Garc�a"] == "José García" and got["lost�"] is None


@pytest.mark.parametrize("encoding", ["cp1252", "latin-1"])
@pytest.mark.parametrize("text", ["مرحبا في العالم", "שלום עולם", "नमस्ते दुनिया", "great 😀 work 👍🏽", "Привет мир", "สวัสดี", "中文 標題", "Գիտություն", "naïve café"])
def test_round_trip_of_scripts(text, encoding):
    # damaged twice, a byte of a Han character reads as a soft hyphen, which is left alone
    for times in (1, 2, 5) if "中" not in text else (1,):
        assert M.undo(garble(text, encoding, times), ["cp1252", "latin-1"]) == text
    assert M.undo(text, ["cp1252", "latin-1"]) == text


def test_nothing_to_learn(spark):
    assert M.garbled_fields(entries(spark, ["a", None])).count() == 0
    assert M.garbled_fields(entries(spark, ["a"]).limit(0)).count() == 0
    assert M.undo("ÃƒÂ©", ["cp1252"]) == "é" and M.undo("Ângela", ["cp1252"]) == "Ângela"


def test_fields(spark):
    df = spark.createDataFrame([("1", "T", [("A", None), (None, None)]), ("2", None, None)], "record_id string, title string, authors array<struct<name string, canonical_name string>>")
    assert {tuple(r) for r in M.fields_of(df).collect()} == {("1", "title", 0, "T"), ("1", "name", 1, "A")}


def test_normal_form_against_the_library():
    random.seed(2)
    special = set(map(chr, U.INVISIBLE + U.SPACES + U.HYPHENS + U.KEPT))
    pool = [chr(c) for b in ((0x20, 0x250), (0x300, 0x345), (0x1E00, 0x1F00), (0x1100, 0x1200), (0xAC00, 0xAC40), (0xFF01, 0xFF60), (0x900, 0x980)) for c in range(*b) if chr(c) not in special]
    texts = ["".join(random.choices(pool, k=random.randint(0, 14))) for _ in range(4000)]
    t = U._tables()
    codes, offsets = U.code_points(pa.array(texts))
    codes, offsets = U._expand(codes, offsets, t)
    import numpy as np

    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    codes, row = U._compose(U._order_marks(codes, row, t), row, t)
    ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(texts)))]).astype(np.int64)
    assert U.to_strings(codes.astype(np.uint32), ends).to_pylist() == [unicodedata.normalize("NFKC", x) for x in texts]


CASES = {
    "Ｇ－ｒｉｃｈ": "G-rich", "étude": "étude", "a​b": "ab", "a b c": "a b c", "Mei‑Lan": "Mei-Lan", "Seаrch": "Search", "WΗL25": "WHL25", "ﬁrst": "first",
    "α-linked 5′ – “x”": "α-linked 5′ – “x”", "саленга": "саленга", "cаленга": "саленга", "tab\tline\n": "tab\tline\n", "": "", "é" * 30_000: "é" * 30_000,
}


def test_unified(spark):
    df = spark.createDataFrame([(t,) for t in [*CASES, None]], "text string")
    got = {r["text"]: r["u"] for r in df.withColumn("u", U.unified(F.col("text"))).collect()}
    assert got == {**CASES, None: None}
    assert U.unify_array(pa.array([], pa.string())).to_pylist() == []
    assert U.unify_array(pa.array(list(CASES.values()))).to_pylist() == list(CASES.values())
    assert U.mixed_words(pa.array(["Seаrch me", "plain", "α-x", None])).tolist() == [True, False, False, False]
