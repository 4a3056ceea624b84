import random

from colophon.llm import leakage as M

random.seed(5)
VOCAB = [f"w{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]


def passage(n):
    return " ".join(random.choice(VOCAB) for _ in range(n))


def test_stretches():
    a, b = passage(60), passage(60)
    index = M.Index([(1, M.words(a)), (2, M.words(b))])
    w = a.split()
    def found(text):
        return {s[0] for s in M.stretches(text, index)}
    assert found(passage(50) + " " + a.upper() + ". " + passage(50)) == {1}
    assert found(" ".join(w[10:36])) == {1} and found(" ".join(w[10:33])) == set()
    changed = w[10:40]
    changed[12] = "other"
    assert found(" ".join(changed)) == {1}
    marked = w[10:40]
    marked[8] += " [12]"
    marked[17] += "(ref. 3)"
    marked[20] = f"<i>{marked[20]}</i>"
    assert found("<p>" + ",\n ".join(marked)) == {1}
    half = " ".join(w[10:40])
    assert found(half[:60] + "-\n" + half[60:]) == {1} or half[60] == " " or half[59] == " "
    assert found(" ".join(w[0:14]) + " " + " ".join(b.split()[:14])) == set()
    assert found("") == set() and M.words("") == []


def test_instruction_is_not_part_of_an_item():
    items = [(1, "Read this text with care. " + passage(30)), (2, "Read this text with care. " + passage(30)), (3, "Own opening words. " + passage(30)), (4, None)]
    cut = dict(M.without_instruction(items))
    assert len(cut[1]) == 30 and len(cut[3]) == 33 and cut[4] == []


def test_leaks(spark):
    items = [(i, passage(40)) for i in range(6)] + [(6, passage(10)), (7, None)]
    docs = [(0, passage(300)), (1, passage(100) + " " + items[2][1]), (2, items[3][1] + " x " + items[4][1]), (3, None), (4, ""), (5, items[6][1]), (6, passage(40_000) + " " + items[5][1]), (1, items[2][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as item_id")
    e = spark.createDataFrame(items, "item_id long, text string")
    got = M.leaks(d, e)
    assert sorted((r["doc_id"], r["item_id"]) for r in got.collect()) == [(1, 2), (1, 2), (2, 3), (2, 4), (6, 5)]
    assert {r[0] for r in M.without_leaks(d, got).select("doc_id").collect()} == {0, 3, 4, 5}
    assert M.leaks(d.limit(0), e).count() == 0 and M.leaks(d, e.limit(0)).count() == 0
    keep, M.BLOCK = M.BLOCK, 90
    try:
        assert M.leaks(d, e).count() == 5
    finally:
        M.BLOCK = keep


def test_equal_items_keep_their_first_sentence(spark):
    """Copies of one item share no instruction: a quoted item of 29 words is found for each of them."""
    text = "These few words open it. " + passage(24)
    items = spark.createDataFrame([(1, text), (2, text), (3, passage(30))], "item_id long, text string")
    docs = spark.createDataFrame([(1, passage(9) + " " + text)], "doc_id long, text string")
    assert sorted(r["item_id"] for r in M.leaks(docs, items).collect()) == [1, 2]


def test_scripts_without_spaces(spark):
    random.seed(11)
    chinese, thai = "".join(chr(random.randrange(0x4E00, 0x9000)) for _ in range(40)), "".join(chr(random.randrange(0x0E01, 0x0E2E)) for _ in range(40))
    items = spark.createDataFrame([(1, chinese), (2, thai)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "前文。" + chinese[5:35] + "。后文"), (2, "abc " + thai + " def"), (3, chinese[:20] + "然" + "而" * 9)], "doc_id long, text string")
    assert sorted((r["doc_id"], r["item_id"]) for r in M.leaks(docs, items).collect()) == [(1, 1), (2, 2)]
    assert M.words("DNA結合 test") == ["dna", "結", "合", "test"]
