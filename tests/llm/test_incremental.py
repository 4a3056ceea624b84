import random

from pyspark.sql import functions as F

from colophon.llm import incremental as M

COLS = "title string, authors array<struct<name string, canonical_name string>>, doi string, publication_year int, key string"


def row(i, title, authors, doi=None, year=2001):
    return (i, title, [(a, None) for a in authors] if authors is not None else None, doi, year, "clash")


RECORDS = [
    row("000000001", "Selective binding of wexolidine to hairpin RNA in yeast", ["Ann Kovalek", "Bo Tremis"], "10.1234/x-2001-aaaa"),
    row("000000002", "Editorial", ["Cy Dorvan"], "10.1234/e-2001-bbbb"),
    row("000000003", None, None, None, None),
]
BATCHES = [
    (1, row("N1", "Selective bindnig of wexolidine to hairpin RNA in yeast", ["Tremis, Bo", "A. Kovalek"])),
    (1, row("N2", "Correction to: Selective binding of wexolidine to hairpin RNA in yeast", ["Ann Kovalek", "Bo Tremis"], "10.1234/c-2009-cccc")),
    (1, row("N3", "Selective binding of wexolidine to hairpin RNA in yeast. Part II", ["Ann Kovalek", "Bo Tremis"], "10.1234/p-2009-dddd")),
    (1, row("N4", "Editorial", ["Di Other"], "10.1234/e-2005-eeee", 2005)),
    (1, row("N5", "A new work on umbotazine", ["Eva Fuhr"], "10.1234/n-2003-ffff", 2003)),
    (1, row("N6", "A new work on umbo...", ["Eva Fuhr"], "doi:10.1234/N-2003-FFFF", 2003)),
    (2, row("N7", "A new work on umbotazine", ["E. Fuhr"], None, 2004)),
    (2, row("N8", "Selective binding of", ["Ann Kovalek"], "10.1234/x-2001-aaab")),
    (None, row("N9", None, None, None, None)),
]


def run(spark, records, batches):
    rec = spark.createDataFrame(records, "record_id string, " + COLS)
    inc = spark.createDataFrame([(r[0], b, *r[1:]) for b, r in batches], "incoming_id string, batch_no int, " + COLS)
    return {(r["incoming_id"], r["accepted_id"]) for r in M.deduplicate_batches(rec, "record_id", inc, "incoming_id", "batch_no").collect()}


def test_batches(spark):
    assert run(spark, RECORDS, BATCHES) == {("N1", "000000001"), ("N6", "N5"), ("N7", "N5"), ("N8", "000000001")}


def test_hot_token(spark):
    """An author on a third of the rows is no candidate by that alone, yet duplicates of that author's works are found."""
    records = [row(f"{i:09d}", f"Work number{i} on compound{i}ine", ["Hot Person"] if i % 3 == 0 else [f"Writer{i} Name{i}"], f"10.1234/h-{i:05d}") for i in range(900)]
    batches = [(1, row("N1", "Work number300 on compound300ine", ["H. Person"])), (1, row("N2", "Work number301 on compound301ine", ["W. Name301"]))]
    assert run(spark, records, batches) == {("N1", f"{300:09d}"), ("N2", f"{301:09d}")}


def test_empty(spark):
    rec = spark.createDataFrame(RECORDS, "record_id string, " + COLS)
    inc = spark.createDataFrame([(r[0], b, *r[1:]) for b, r in BATCHES], "incoming_id string, batch_no int, " + COLS)
    assert M.deduplicate_batches(rec, "record_id", inc.limit(0), "incoming_id", "batch_no").count() == 0
    got = M.deduplicate_batches(rec.limit(0), "record_id", inc, "incoming_id", "batch_no").collect()
    assert ("N5", "N6") in {(r["accepted_id"], r["incoming_id"]) for r in got}


def test_hot_group_of_copies(spark):
    """A work that holds most of history and batch makes no pairs of its copies."""
    records = [row(f"{i:09d}", "Selective binding of wexolidine to hairpin RNA in yeast", ["Ann Kovalek"], "10.1234/x-2001-aaaa") for i in range(1500)]
    batches = [(1, row(f"N{i:05d}", "Selective binding of wexolidine to hairpin RNA in yeast", ["Ann Kovalek"], "10.1234/x-2001-aaaa")) for i in range(700)]
    batches += [(2, row(f"P{i:05d}", "Another long work on umbotazine", ["Eva Fuhr"], None)) for i in range(700)] + [(2, row(f"Q{i}", "Editorial", None, None)) for i in range(3)]
    got = run(spark, records, batches)
    assert got == {(f"N{i:05d}", "000000000") for i in range(700)} | {(f"P{i:05d}", "P00000") for i in range(1, 700)}


def test_titles_of_common_words(spark):
    """Rows that share nothing but common words of their titles are found, whatever the size of the collection."""
    filler = "kinetics structure binding transport analysis stability".split()
    records = [row(f"{i:09d}", f"The {filler[i % 6]} {filler[i // 6 % 6]} {filler[i // 36 % 6]} report{i}", [f"Writer{i} Name{i}"], f"10.1234/h-{i:05d}") for i in range(1400)]
    records += [row("200000001", "The kinetics structure binding transport", None), row("200000002", "The transport analysis stability structure", ["Ann Kovalek"])]
    batches = [(1, row("N1", "The kinetics structure binding transport", None)), (1, row("N2", "The transport analysis stability structure", None)), (1, row("N3", "The transport anaylsis stability structure", ["Ann Kovakel"]))]
    got = run(spark, records, batches)
    assert got == {("N1", "200000001"), ("N2", "200000002"), ("N3", "200000002")}


def frame(spark, rows, id_col="record_id"):
    return spark.createDataFrame(rows, f"{id_col} string, " + COLS)


def test_a_new_word_makes_no_long_list(spark):
    """A word that is new to history and on all rows of a batch is posted under no key of its own, so their pairs stay few."""
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(9))
    index = M.Index(spark, frame(spark, RECORDS), "record_id")
    batch = frame(spark, [row(f"N{i:04d}", f"{word()} {word()} sharedneword {word()} {word()}", [f"A {word()}"]) for i in range(1000)])
    rows, _ = index._read(batch, "record_id")
    postings = index._postings(rows)
    assert postings.groupBy("key").count().agg(F.max("count")).first()[0] <= 2
    index.close()


def test_small_batches_name_their_keys(spark):
    """The keys of a small batch reach the scan of the postings; frequencies are counted on with each batch."""
    index = M.Index(spark, frame(spark, RECORDS), "record_id")
    probes = spark.createDataFrame([(7, "N1", 2001)], "key long, id string, year int")
    plan = index._held(probes)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(key), EqualTo(key,7)]" in plan or "In(key" in plan
    many = spark.range(2000).selectExpr("id as key", "'N' as id", "2001 as year")
    assert "PushedFilters: []" in index._held(many)._jdf.queryExecution().executedPlan().toString()
    before = spark.read.parquet(index.path + "/frequency").selectExpr("sum(n)").first()[0]
    index.add_batch(frame(spark, [row("N1", "Three rare words", ["Ann Nobody"])]), "record_id")
    assert spark.read.parquet(index.path + "/frequency").selectExpr("sum(n)").first()[0] == before + 3
    index.close()


def test_against_brute_force(spark):
    """All pairs that the test of a pair accepts are found: mistyped, shortened, without author, with a lost space."""
    rng = random.Random(4)
    stems = "binding kinetics structure transport analysis stability folding repair release uptake imaging assembly".split()
    people = [f"{a} {b}ovic" for a in ("Ann", "Bo", "Cy") for b in ("Kal", "Tre", "Dor", "Fuh", "Mil")]
    records = []
    for i in range(120):
        title = " ".join(rng.sample(stems, rng.randint(3, 8))) + (f" of compound{i}ine" if i % 3 else "")
        records.append(row(f"{i:09d}", title, rng.sample(people, rng.randint(0, 4)), f"10.1234/b-{i:05d}" if i % 4 else None, 2000 + i % 4))
    batch = []
    for i in range(120):
        _, title, authors, _, year, _ = records[i]
        words = title.split()
        at = rng.randrange(len(words))
        kind = i % 5
        words[at] = words[at][:2] + words[at][3:] if kind < 2 else words[at]
        words = words[:4] if kind == 2 else words
        text = " ".join(words)
        batch.append(row(f"N{i:05d}", text.replace(" ", "", 1) if kind == 3 else text, [a for a, _ in authors] if kind != 4 else [], None, year))
    inc = frame(spark, batch)
    got = {r["incoming_id"] for r in M.deduplicate_batches(frame(spark, records), "record_id", inc.selectExpr("record_id as incoming_id", "1 as batch_no", *[c.split()[0] for c in ("title", "authors", "doi", "publication_year", "key")]), "incoming_id", "batch_no").collect()}
    new, old = M.normal_form(inc, "record_id"), M.normal_form(frame(spark, records).unionByName(inc), "record_id")
    pairs = new.crossJoin(old.select(*[F.col(c).alias(f"o_{c}") for c in old.columns])).where((F.col("id") > F.col("o_id")) & M.same_work()).select("id").distinct()
    want = {r["id"] for r in pairs.collect()}
    assert want <= got and len(want) > 60


def test_common_words_mistyped_at_the_beginning(spark):
    """Words that are common in a larger collection take no pair away: authors shared, an author mistyped, no author, no year."""
    filler = "kinetics structure binding transport analysis stability folding repair release".split()
    title, wrong = " ".join(filler), "kinetcs structre binding transprt analysis stability foldng repair release"
    records = [row(f"{i:09d}", " ".join(filler[(i + k) % 9] for k in range(5)) + f" report{i}", [f"Writer{i} Qu{i:04d}"], f"10.1234/h-{i:05d}") for i in range(500)]
    records += [row("200000001", title, ["Ann Kovalek", "Bo Tremis", "Cy Dorvan"], year=1990), row("200000002", title, ["Eva Fuhrmann"], year=1980), row("200000003", title, None, "10.1234/c-1970-aaaa", 1970)]
    batch = [row("N1", wrong, ["Ann Kovalek", "Di Milovic", "Bo Tremis"], year=1991), row("N2", wrong, ["E. Fuhrmna"], year=1980), row("N3", wrong, ["Flo Zarkowski"], year=1969)]
    batch += [row("N4", title, ["Gil Onlyone", "Hal Tworin", "Ida Trevik"], "10.1234/z-1950-zzzz", None), row("N5", wrong, ["G. Onlyone", "H. Tworin", "I. Trevik"], year=1950)]
    assert run(spark, records, [(1, r) for r in batch]) == {("N1", "200000001"), ("N2", "200000002"), ("N3", "200000003"), ("N5", "N4")}


def test_surnames_two_edits_away(spark):
    """All pairs of surnames that are two edits apart at most have a stem in common, short and long ones."""
    rng = random.Random(2)
    names = ["".join(rng.choice("abc") for _ in range(rng.randint(3, 9))) for _ in range(250)] + ["kovalek-" * 9 + x for x in ("a", "ab", "bc", "abcd")]
    rows = spark.createDataFrame([(names,)], "surnames array<string>")
    want = rows.select(F.explode("surnames").alias("a")).distinct().crossJoin(rows.select(F.explode("surnames").alias("b")).distinct())
    want = want.where("a <> b and greatest(length(a), length(b)) > 4 and levenshtein(a, b) <= 2")
    assert {tuple(r) for r in M.near_surnames(rows, rows.limit(0)).collect()} == {tuple(r) for r in want.collect()}
