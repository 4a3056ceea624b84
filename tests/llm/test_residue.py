import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from colophon.llm import residue as M

REAL = "We measured the binding of three ligands to hairpin RNA in yeast. The set {a, b} was drawn anew for each run."
BAD = [
    "Published in {{ record.journal }}.", "Real text. [[KEYWORDS]] More real text of the paper.", "<%= title %> Why it works is taken up in section 3.", "Type your doi in this space.", "Lorem ipsum dolor sit amet.", REAL + "\nThis is sample text and will be replaced.",
    "404 Not Found - Go back to the start page", "Zugriff verweigert", "Please enable JavaScript and reload the page.", "ERREUR INTERNE DU SERVEUR", "Keywords: abstract: undefined.", "Error 503: try the mirror.", "Home | Help | Page not found", "Your volume here (max. 9 words).",
]
GOOD = [
    REAL, "The export step replaces the mark {{title}} by the record's title.", "We wrote the model as \\frac{a}{b+52} with ${k}$ fitted freely.", "As filler we used short runs of lorem words in 39 mock records.",
    "Access to the beam line was denied twice in 60 weeks.", "A page saying that JavaScript is required was the most frequent reason for an empty harvest.", 'Settings were kept as {"gain": 45, "mode": "slow"} throughout.', "During the crawl 12 of the links answered with error 404, so we asked.", "", None, "x " * 20_000,
]


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)], "doc_id long, text string, norm string")


def test_documents(spark):
    got = {r[0] for r in M.residue_documents(documents(spark, BAD + GOOD + BAD[:1])).collect()}
    assert got == set(range(len(BAD))) | {len(BAD) + len(GOOD)}
    assert M.residue_documents(documents(spark, GOOD)).count() == 0
    assert M.residue_documents(documents(spark, GOOD).limit(0)).count() == 0


def test_labels_spread_to_near_duplicates(spark):
    trusted = "please enable javascript and reload the page to read the whole article of the journal"
    chain = [trusted, "p1ease enable javascript and reload the page to read the whole article of the journal", "p1ease enable javascrlpt and reload the page to read the whole article of the joumal"]
    rows = M.residue_segments(documents(spark, chain + [REAL])).collect()
    assert {(r["doc_id"], r["reason"]) for r in rows} == {(0, "message"), (1, "near-duplicate"), (2, "near-duplicate")}


def test_filler_words(spark):
    words = "velta momen calor albe dorim lanor".split()
    known = ["Lorem ipsum " + " ".join(words[i:] + words[:i]) + "." for i in range(6)]
    got = {r[0] for r in M.residue_documents(documents(spark, known + ["Calor velta albe momen lanor.", REAL])).collect()}
    assert got == set(range(7))


def test_simhash():
    texts = ["abc def ghi", "abc def ghj", "", None, "zz", "the quick brown fox", "the quick brown fix", "é" * 300_000]
    got = M.simhash_array(pa.array(texts)).to_pylist()

    def one(t):
        b = np.frombuffer((t or "").encode(), np.uint8)
        if len(b) < 3:
            return 0
        bits = np.unpackbits(M._feature_hashes(b).view(np.uint8).reshape(-1, 8), axis=1).astype(np.int64).sum(0)
        return int(np.packbits(2 * bits > len(b) - 2).view(np.int64)[0])

    assert got == [one(t) for t in texts]
    assert M.simhash_array(pa.array(texts).slice(5, 2)).to_pylist() == got[5:7]


def test_placeholders(spark):
    rows = ["{{x}}", "[Insert title here]", "<abstract goes here>", "(TODO: add x)", "XXX Year XXX", "__doi__", "%%body%%", "#{Title}", "{doi|default}", "&lt;year&gt;", "<!-- notes -->", "a [12] b", "{1, 2}", "<i>x</i>", "the mark {{x}} is replaced"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, s string")
    assert [r[0] for r in df.where(M.has_placeholder(F.col("s"))).select("i").orderBy("i").collect()] == list(range(11))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def reworded(n):
    """Notices of 8 to 12 words and copies of them with one or two words exchanged."""
    rng = random.Random(7)
    words = "please enable the reader page browser script support before you open this article again later because our server needs more time to show it".split()
    notices = [" ".join(rng.choices(words, k=rng.randint(8, 12))) for _ in range(12)]
    copies = []
    for i in range(n):
        w = notices[i % 12].split()
        for _ in range(rng.randint(1, 2)):
            w[rng.randrange(len(w))] = rng.choice(["nimbus", "ÿ", "turn", "vortakel", "ok", "catalogue"])
        copies.append(" ".join(w))
    return notices, copies


def sketched(spark, norms):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(norms)], "key long, norm string")
    return df.withColumn("sketch", M.sketch(F.col("norm")))


def test_tables_lose_no_pair_within_the_distance(spark):
    """All pairs within HAMMING bits and the similarity are found; of those that are only similar, more than half are."""
    notices, copies = reworded(240)
    texts = notices + sorted(set(copies))
    rows = sketched(spark, texts)
    bits = dict(rows.select("norm", "sketch").collect())
    similar = {(c, n) for c in texts for n in notices if c != n and distance(c, n) * 5 <= max(len(c), len(n))}
    within = {c for c, n in similar if bin((bits[c] ^ bits[n]) & (1 << 64) - 1).count("1") <= M.HAMMING}
    got = {texts[r[0]] for r in M.near(rows, rows.where(F.col("key") < len(notices))).collect()}
    assert got == within
    assert len(within) > 0.5 * len({c for c, _ in similar})


def test_flips():
    assert len(M._flips()) == 1 + 16 + 120 and M.HAMMING == 11


def test_companions(spark):
    """What unrelated documents repeat beside messages belongs to them, wherever it stands; a repeated sentence of real text doesn't."""
    pages = [f"{code} Not Found\nThe shelf is being moved tonight\nTicket number {code}x" for code in (404, 405, 406, 407)]
    real = [f"{REAL} Result {'abcdefgh'[i]} was as foretold. Errors are given as usual in the tables below." for i in range(8)]
    alone = ["The shelf is being moved tonight", f"{REAL}\nThe shelf is being moved tonight\nIt was cold."]
    mixed = [real[0] + "\n503 Service Unavailable\n" + real[1]]
    texts = pages + real + alone + mixed
    got = {(r["doc_id"], r["reason"]) for r in M.residue_segments(documents(spark, texts)).collect()}
    assert {d for d, _ in got} == {0, 1, 2, 3, 12, 13, 14} and {(12, "companion"), (13, "companion")} <= got
    copies = [f"404 Not Found\nOnly copies of one page say this" for _ in range(5)] + ["Only copies of one page say this"]
    assert {r["doc_id"] for r in M.residue_segments(documents(spark, copies)).collect()} == {0, 1, 2, 3, 4}


def test_templates_spread(spark):
    """Template sentences hand on their label to copies with delimiters that no pattern knows; real text with one field doesn't."""
    real = "{{ligand}} binding to hairpin RNA was measured in three series of yeast at 25 degrees."
    texts = ["Published in {{ record.journal }}.", "Published in «record.journal».", "Publlshed in §record journal§", real, real.replace("{{ligand}}", "ligands")]
    rows = M.residue_segments(documents(spark, texts)).collect()
    assert {(r["doc_id"], r["reason"]) for r in rows} == {(0, "placeholder"), (1, "near-duplicate"), (2, "near-duplicate"), (3, "placeholder")}


def test_long_segments(spark):
    """A long access page on one line hands on its label; real text that stands behind a notice on one line gets none."""
    page = "Please enable JavaScript " + " ".join(f"and gate{chr(97 + i)} keeper{chr(97 + i)} must open the door of hall {chr(97 + i)}" for i in range(12))
    tail = " ".join(f"ligand {chr(97 + i)} binds hairpin {chr(98 + i)} in yeast" for i in range(14))
    texts = [page, page.replace("Please enable JavaScript", "Please enabIe Java Script"), "Page not found go back to start " + tail, tail]
    assert {(r["doc_id"], r["reason"]) for r in M.residue_segments(documents(spark, texts)).collect()} == {(0, "message"), (1, "near-duplicate"), (2, "message")}


def test_long_chains(spark):
    """A chain whose ends have nothing in common is followed as far as its links lead, found here by trying all pairs."""
    text = "please enable javascript and reload the page to read the whole article of the journal"
    rng = random.Random(3)
    chain = [text]
    for i in rng.sample(range(len(text)), len(text)):
        last = chain[-1]
        chain.append(last[:i] + (rng.choice("bcdfghjklmnpqrstvwxz") if last[i] != " " else " ") + last[i + 1 :])
    chain = list(dict.fromkeys(chain))
    bits = [r[0] for r in sketched(spark, chain).orderBy("key").select("sketch").collect()]
    reached, front = {0}, [0]
    while front:
        i = front.pop()
        near = {j for j in range(len(chain)) if j not in reached and bin((bits[i] ^ bits[j]) & (1 << 64) - 1).count("1") <= M.HAMMING and distance(chain[i], chain[j]) * 5 <= len(text)}
        reached |= near
        front += near
    rows = M.residue_segments(documents(spark, chain)).collect()
    assert {r["doc_id"] for r in rows} == reached
    assert distance(chain[0], chain[max(reached)]) > 0.5 * len(text)


def test_hot_segment(spark):
    """A notice that a third of all documents hold makes no pairs of its copies."""
    texts = ["Please enable JavaScript and reload the page."] * 400 + [f"Work {i} on ligand {i}. {REAL}" for i in range(800)]
    assert M.residue_documents(documents(spark, texts)).count() == 400
