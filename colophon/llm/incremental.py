"""New batches against all history: an inverted index of rare-token prefixes that grows with every batch.

A row is posted under keys, and a row of a batch probes keys; rows that meet under a key are candidates, which the words,
authors, DOIs and years of both then confirm or not. The keys are

* the DOI;
* each word of the title that is rare: the prefix of the title in the order of rarity, up to the first word with more than HOT
  rows. Postings of a word therefore never hold more than HOT rows, and all words are probed;
* each surname with the year, whatever the title. Two rows that are the same work by anything but the DOI share a surname, or
  one has a surname mistyped, or one has none. A row therefore also asks for all known surnames that are two edits away from its
  own, and rows without a surname are compared with all rows of their years. No pair that same_work accepts is left out, however
  common its words.

Postings are kept in tables bucketed by key, which a batch joins without shuffling history; a batch of few keys reads only their
buckets and, within these, the row groups that may hold them. Attributes are read for the candidates only. How many rows
have a word is counted on with each batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.llm.formatting import canonical_doi
from colophon.operators.components import connected_components
from colophon.operators.skew import SMALL_BYTES, lookup_join
from colophon.session import materialize, scratch_path

#: A word with more rows is not posted on its own.
HOT = 200
#: Titles up to so many letters are headings that many works have.
HEADING = 16
#: Letters of a surname from which up to two are left out to find those two edits away.
STEM = 6
#: A row with more surnames has to share one with any row that has more as well.
FEW_NAMES = 2
#: A batch with so many keys at most names them to the scan of the postings.
NAMED = 1000
#: Columns that tell most pairs apart before the titles are read.
NARROW = ("doi", "year", "about", "surnames")
#: Years that stand for a missing year, and for any year.
NO_YEAR, ANY_YEAR = -1, -2

# Openings of titles about another work, and the words for a part.
ABOUT = r"(?iu)^\W*(?:correction|corrigendum|corrigenda|erratum|addendum|retraction|comment|reply|response|author correction|publisher correction)s?\b.{0,12}?\b(?:to|on|of|for)\b"
PART = r"(?iu)(?:[\s,.(\[]+(?:part|pt\.?|teil|partie|parte)\s+|\s[(\[])(\d+|[ivx]+)(?![\p{L}\p{N}])"


def surname(name: Column) -> Column:
    """The surname of a written name in lower case: before a comma, else the last word that is no initials."""
    flat = F.regexp_replace(F.lower(name), r"[.]", " ")
    inverted = F.regexp_extract(flat, r"([\p{L}\p{M}'-]+)\s*,", 1)
    bare = F.regexp_replace(F.rtrim(name), r"\s+\p{Lu}{1,3}$", "")
    last = F.lower(F.regexp_extract(F.rtrim(F.regexp_replace(bare, "[.]", " ")), r"([\p{L}\p{M}'-]+)\s*$", 1))
    return F.when(name.contains(","), inverted).otherwise(last)


def _hashed(words: Column, kind: str) -> Column:
    return F.transform(words, lambda w: F.struct(F.xxhash64(F.lit(kind), w).alias("h"), F.lit(kind).alias("kind")))


NAMES = "array<struct<name:string,canonical_name:string>>"
KEYS = "array<bigint>"


def normal_form(rows: DataFrame, id_col: str) -> DataFrame:
    """``(id, title, about, part, doi, surnames, year, words)``; words and surnames are in order and distinct. Nulls give empty parts."""
    text = F.coalesce(F.lower("title"), F.lit(""))
    plain = F.regexp_replace(F.regexp_replace(text, ABOUT, ""), r"[^\p{L}\p{M}\p{N}]+", "")
    words = F.filter(F.split(F.regexp_replace(text, r"[^\p{L}\p{M}\p{N}]+", " "), " "), lambda w: F.length(w) > 2)
    names = F.filter(F.transform(F.coalesce("authors", F.array().cast(NAMES)), lambda a: surname(a["name"])), lambda s: s.isNotNull() & (F.length(s) > 1) & (s != "al"))
    doi = canonical_doi(F.col("doi"))
    return rows.select(
        F.col(id_col).alias("id"),
        plain.alias("title"),
        text.rlike(ABOUT).alias("about"),
        F.array_join(F.regexp_extract_all(text, F.lit(PART), F.lit(1)), ".").alias("part"),
        F.when(doi != "", doi).alias("doi"),
        F.array_distinct(names).alias("surnames"),
        F.col("publication_year").alias("year"),
        F.array_distinct(words).alias("words"),
    )


def collapsed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of equal content once, under their least id, and ``(id, first)`` of all rows.

    A work that holds a third of all rows then has one row for each way it is written, and no pairs are made of its copies.
    Rows that say too little to be the same work (neither DOI nor a title of its own) stay apart.
    """
    telling = F.col("doi").isNotNull() | (F.length("title") > HEADING)
    content = F.sha2(F.to_json(F.struct("title", "about", "part", "doi", "surnames", "year", "words")), 256)
    marked = materialize(rows.withColumn("content", F.when(telling, content).otherwise(F.concat(F.lit("id "), "id"))), "all")
    # copies differ in their ids only, so the first of them is a minimum, which is taken before anything is shuffled
    rest = [c for c in rows.columns if c != "id"]
    firsts = marked.groupBy("content").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in rest])
    firsts = materialize(firsts, "contents")
    repeated = firsts.where("copies > 1").select("content", F.col("id").alias("first"), "copies")
    copies = lookup_join(marked.select("id", "content"), repeated, ["content"], "copies").select("id", "first")
    members = firsts.where("copies = 1").select("id", F.col("id").alias("first")).unionByName(copies)
    return firsts.select(*rows.columns), members


def _key(kind: str, *parts: Column) -> Column:
    return F.xxhash64(F.lit(kind), *parts)


def _if(condition: Column, keys: Column) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), keys).otherwise(F.array().cast(KEYS))


def _word_keys(words: Column) -> Column:
    return F.transform(words, lambda w: _key("word", w))


def _post_marks(year: Column) -> Column:
    """The years under which a row is found."""
    return F.array(F.coalesce(year, F.lit(NO_YEAR)), F.lit(ANY_YEAR))


def _probe_marks(year: Column) -> Column:
    """The years under which a row looks for others: a year apart at most, or unknown."""
    return F.when(year.isNull(), F.array(F.lit(ANY_YEAR))).otherwise(F.array(year - 1, year, year + 1, F.lit(NO_YEAR)))


def _author_keys(surnames: Column, marks: Column) -> Column:
    """Each surname with each year."""
    return F.flatten(F.transform(surnames, lambda s: F.transform(marks, lambda y: _key("author", s, y))))


def with_keys(rows: DataFrame) -> DataFrame:
    """Rows of normal form with ``post`` and ``probe``, the keys under which they are found and look for others, but for rare words."""
    doi, year = _if(F.col("doi").isNotNull(), F.array(_key("doi", F.col("doi")))), F.col("year")
    post = F.concat(doi, _author_keys(F.col("surnames"), _post_marks(year)))
    probe = F.concat(doi, _word_keys(F.col("words")), _author_keys(F.col("surnames"), _probe_marks(year)))
    return rows.withColumn("post", F.array_distinct(post)).withColumn("probe", F.array_distinct(probe))


def _stems(name: Column) -> Column:
    """The first STEM letters with up to two left out. Names two edits apart at most have one of these in common, since what
    both keep is in both, and of what one keeps beyond the other no more has to go than the other has lost."""
    less = lambda x: F.transform(F.sequence(F.lit(0), F.length(x)), lambda i: F.concat(F.left(x, i), F.substring(x, i + 2, F.lit(STEM))))
    return F.array_distinct(F.flatten(F.transform(less(F.left(name, F.lit(STEM))), less)))


def near_surnames(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``(surname, near)``: surnames of the rows with the other surnames of rows or known rows that may be a mistyped form of them."""
    own = rows.select(F.explode("surnames").alias("surname")).where(F.length("surname") > 2).distinct()
    every = known.select(F.explode("surnames").alias("surname")).where(F.length("surname") > 2).unionByName(own).distinct()
    stems, other = own.select("surname", F.explode(_stems(F.col("surname"))).alias("stem")), every.select(F.col("surname").alias("near"), F.explode(_stems(F.col("surname"))).alias("stem"))
    long = F.greatest(F.length("surname"), F.length("near")) > 4
    return stems.join(other, "stem").where(long & (F.col("surname") != F.col("near")) & (F.levenshtein("surname", "near", 2) >= 0)).select("surname", "near").distinct()


def without_authors(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``(id, other)`` of rows and known rows of which one has no surname, a year apart at most, with titles alike."""
    bare = F.size("surnames") == 0
    cols = ["id", "title", "words", "year"]
    marked = [
        lambda t: t.select(*cols, F.explode(_probe_marks(F.col("year"))).alias("mark")),
        lambda t: t.select(*[F.col(c).alias(f"o_{c}") for c in cols], F.explode(_post_marks(F.col("year"))).alias("mark")),
    ]
    out = None
    # rows without authors are few as a rule and then sent to the others; both sides are shuffled by year if they are many
    for few, many, at in ((rows.where(bare), known, 0), (known.where(bare), rows.where(~bare), 1)):
        few = materialize(few.where(F.length("title") > 0).select(*cols), "bare")
        size = few.agg(F.sum(F.octet_length("title") * 6 + 256)).first()[0]
        if size is None:
            continue
        sides = [marked[at](few), marked[1 - at](many)]
        both = sides[1].join(F.broadcast(sides[0]) if size <= SMALL_BYTES else sides[0], "mark")
        told = (F.greatest(F.length("title"), F.length("o_title")) > HEADING) & (F.col("id") != F.col("o_id"))
        found = both.where(told & _alike()).select("id", F.col("o_id").alias("other"))
        out = found if out is None else out.unionByName(found)
    return out if out is not None else rows.select("id", F.col("id").alias("other")).limit(0)


def _years_meet(a: str, b: str) -> Column:
    return F.coalesce(F.abs(F.col(a) - F.col(b)) <= 1, F.lit(True))


class Index:
    """Postings and rows of all that was accepted, as tables in the shared folder that are bucketed by key and by id."""

    def __init__(self, spark: SparkSession, history: DataFrame, id_col: str):
        self.spark, self.path = spark, scratch_path(spark, "index")
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.tables: dict[str, str] = {}
        rows, _ = self._read(history, id_col)
        self._append(rows, self._postings(rows))

    def _read(self, source: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
        """Rows of different content, and which row stands for which; the words of the rows are counted on."""
        rows, members = collapsed(normal_form(source, id_col))
        rows = rows.withColumn("root", F.col("id"))
        counted = rows.select(F.explode(_word_keys(F.col("words"))).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        counted.write.mode("append").parquet(f"{self.path}/frequency")
        return rows, members

    def _postings(self, rows: DataFrame) -> DataFrame:
        """``(key, id, year)``; a key that joins whatever the years has none."""
        any_year = F.col("key") == _key("doi", F.col("doi"))
        keyed = with_keys(rows).select("id", "year", "doi", F.explode("post").alias("key")).select("key", "id", F.when(~F.coalesce(any_year, F.lit(False)), F.col("year")).alias("year"))
        words = rows.select(F.explode(_word_keys(F.col("words"))).alias("key"), "id", "year")
        counts = self.spark.read.schema("key long, n long").parquet(f"{self.path}/frequency").groupBy("key").agg(F.sum("n").alias("n"))
        # words that are hot are at most one in HOT of all; where their list is short, it is sent to the rows
        hot = materialize(counts.where(F.col("n") > HOT).select("key"), "hot")
        small = hot.count() * 16 <= SMALL_BYTES
        return keyed.unionByName(words.join(F.broadcast(hot) if small else hot, "key", "left_anti"))

    def _append(self, rows: DataFrame, postings: DataFrame) -> None:
        self._write("postings", postings.repartition(self.buckets, "key"), "key")
        self._write("rows", rows, "id")

    def _write(self, name: str, part: DataFrame, by: str) -> None:
        table = self.tables.setdefault(name, "colophon_" + self.path.rsplit("-", 1)[1] + "_" + name)
        part.write.bucketBy(self.buckets, by).sortBy(by).option("path", f"{self.path}/{name}").mode("append").format("parquet").saveAsTable(table)

    def _held(self, probes: DataFrame) -> DataFrame:
        """Postings that a batch may meet: all of them if it has many keys, else those of its keys, which then prune buckets and row groups."""
        held = self.spark.table(self.tables["postings"])
        some = [r[0] for r in probes.select("key").distinct().limit(NAMED + 1).collect()]
        return held.where(F.col("key").isin(some)) if len(some) <= NAMED else held

    def close(self) -> None:
        """Takes the tables out of the catalog; their files are left to whoever cleans the shared folder."""
        for table in self.tables.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")

    def add_batch(self, batch: DataFrame, id_col: str) -> DataFrame:
        """``(accepted_id, id)`` of the rows of the batch whose work is held by an accepted or an earlier row of the batch."""
        rows, members = self._read(batch, id_col)
        postings = materialize(self._postings(rows), "postings")
        any_year = F.col("key") == _key("doi", F.col("doi"))
        probes = with_keys(rows).select("id", "year", "doi", F.explode("probe").alias("key")).select("key", "id", F.when(~F.coalesce(any_year, F.lit(False)), F.col("year")).alias("year"))
        history = self.spark.table(self.tables["rows"])
        mistyped = rows.select("id", "year", F.explode("surnames").alias("surname")).join(near_surnames(rows, history), "surname")
        mistyped = mistyped.select(F.explode(_author_keys(F.array("near"), _probe_marks(F.col("year")))).alias("key"), "id", "year")
        probes = materialize(probes.unionByName(mistyped).distinct(), "probes")
        pairs = []
        for held, known in ((self._held(probes), history), (postings, rows)):
            other = held.select("key", F.col("id").alias("other"), F.col("year").alias("o_year"))
            met = probes.join(other, "key").where((F.col("id") != F.col("other")) & _years_meet("year", "o_year")).select("id", "other")
            pairs.append(met.unionByName(without_authors(rows, known)))
        pairs[1] = pairs[1].select(F.greatest("id", "other").alias("id"), F.least("id", "other").alias("other"))
        # most pairs fail on DOI or year: these are told from narrow columns, only the others get titles and authors
        close = []
        for found, known in zip(pairs, (history, rows)):
            narrow, o_narrow = rows.select("id", *NARROW), known.select(*[F.col(c).alias(f"o_{c}") for c in ("id", *NARROW)])
            close.append(found.distinct().join(narrow, "id").join(o_narrow, F.col("other") == F.col("o_id")).where(may_be_same()).select("id", "other"))
        same = []
        for found, known, tag in zip(close, (history, rows), ("held", "own")):
            known = known.select(*[F.col(c).alias(f"o_{c}") for c in rows.columns])
            both = materialize(found, f"close-{tag}").join(rows.drop("root"), "id").join(known, F.col("other") == F.col("o_id"))
            same.append(both.where(same_work()).select(F.col("id").alias("a"), F.col("o_root").alias("b")))
        found = connected_components(materialize(same[0].unionByName(same[1]).distinct(), "same"))
        firsts = rows.select("id").join(found, F.col("id") == F.col("node")).where("component <> id").select(F.col("component").alias("root"), F.col("id").alias("first"))
        firsts = materialize(firsts, "firsts")
        # a copy goes where the first of its content goes, or to the first itself
        copies = members.join(firsts, "first", "left").withColumn("accepted_id", F.coalesce("root", "first")).where("accepted_id <> id")
        result = materialize(copies.select("accepted_id", "id"), "found")
        rooted = rows.drop("root").join(firsts.select(F.col("first").alias("id"), "root"), "id", "left").withColumn("root", F.coalesce("root", "id"))
        self._append(rooted.select(*rows.columns), postings)
        return result


def _within(a: Column, b: Column, edits: Column) -> Column:
    """Whether two texts are so many edits apart at most; the search ends where they are not."""
    return F.call_function("levenshtein", a, b, F.floor(edits).cast("int")) >= 0


def _equal_dois() -> Column:
    return F.coalesce(F.col("doi") == F.col("o_doi"), F.lit(False))


def _fewest() -> Column:
    return F.least(F.size("surnames"), F.size("o_surnames"))


def _shared() -> Column:
    return F.size(F.array_intersect("surnames", "o_surnames"))


def _authors_agree() -> Column:
    return (_shared() * 2 >= _fewest()) & ((_shared() > 0) | (_fewest() == 0))


def _authors_mistyped() -> Column:
    return (_fewest() <= FEW_NAMES) & F.exists("surnames", lambda x: F.exists("o_surnames", lambda y: (F.length(x) > 4) & (F.levenshtein(x, y, 2) >= 0)))


def _alike() -> Column:
    """Whether two titles have most words in common or are a quarter of their letters apart at most."""
    n, m = F.least(F.length("title"), F.length("o_title")), F.greatest(F.length("title"), F.length("o_title"))
    most = F.greatest(F.size("words"), F.size("o_words"))
    near = (m - n <= m * 0.25) & (m <= 2000) & _within(F.col("title"), F.col("o_title"), m * 0.25)
    return ((most > 3) & (F.size(F.array_intersect("words", "o_words")) >= most * 0.65)) | near


def may_be_same() -> Column:
    """Whether DOI, year, kind and authors allow a row and a known row to be the same work; implied by same_work."""
    c = F.col
    years = F.coalesce(F.abs(c("year") - c("o_year")) <= 1, F.lit(True))
    near = c("doi").isNull() | c("o_doi").isNull() | F.coalesce(F.levenshtein(c("doi"), c("o_doi"), 2) >= 0, F.lit(False))
    return _equal_dois() | (years & (c("about") == c("o_about")) & near & (_authors_agree() | _authors_mistyped()))


def _same_word(w: Column, x: Column) -> Column:
    slack = F.when(F.length(w) < 5, 1).otherwise(F.greatest(F.lit(2), F.floor(F.length(w) * 0.25)))
    return (w == x) | (F.levenshtein(w, x) <= slack) | (F.levenshtein(w, F.left(x, F.length(w))) <= F.least(slack, F.lit(2)))


def _numbered(words: str, others: str) -> Column:
    """The numbers of the words that the other title lacks."""
    return F.transform(F.filter(F.array_except(words, others), lambda w: w.rlike(r"\d")), lambda w: F.regexp_replace(w, r"\D+", ""))


def _other_numbers() -> Column:
    """Whether two words or more hold other numbers: one may be a typing error, two tell works of a series apart."""
    a, b = _numbered("words", "o_words"), _numbered("o_words", "words")
    lacking = lambda x, y: F.size(F.filter(x, lambda d: ~F.array_contains(y, d)))
    return (lacking(a, b) >= 2) & (lacking(b, a) >= 2)


def same_work() -> Column:
    """Whether a row and a known row (columns ``o_…``) are the same work.

    Equal DOIs decide for, two different ones against; a DOI a typing error away or missing leaves it to the rest: the
    title alike or shortened (beyond 2,000 letters its words are compared), no other part and no notice about the work, authors in common, years a year apart at most, no two other numbers.
    """
    c = F.col
    a_len, b_len = F.length("title"), F.length("o_title")
    short, long = F.when(a_len <= b_len, c("title")).otherwise(c("o_title")), F.when(a_len <= b_len, c("o_title")).otherwise(c("title"))
    n, m = F.least(a_len, b_len), F.greatest(a_len, b_len)
    fewest, alike = _fewest(), _alike()
    shortened = (n >= 10) & (n <= 2000) & _within(short, F.substring(long, F.lit(1), n), n * 0.2)
    stem = F.length(F.regexp_extract(long, r"^(.*?)(?:part|teil|partie|parte)?(?:\d+|[ivx]+)?$", 1))
    part = (c("part") == c("o_part")) | (((c("part") == "") | (c("o_part") == "")) & (n < stem - 3) & shortened)
    authors = _authors_agree() | (alike & _authors_mistyped())
    # a common heading: everything else must agree
    strict = (_shared() >= fewest) & (fewest > 0) & (c("year") == c("o_year")) & (F.size("surnames") == F.size("o_surnames"))
    heading = (m > HEADING) | F.coalesce(strict, F.lit(False))
    fewer, more = F.when(F.size("words") <= F.size("o_words"), c("words")).otherwise(c("o_words")), F.when(F.size("words") <= F.size("o_words"), c("o_words")).otherwise(c("words"))
    # titles made alike by a common pattern still differ in the words that count: each word must be found again, mistyped or cut off at most
    typed = (m <= 2000) & _within(short, long, m * 0.13)
    found_again = typed | F.forall(fewer, lambda w: F.exists(more, lambda x: _same_word(w, x)))
    single = (fewest > 0) | alike  # without any author the whole title is needed
    # what costs least comes first
    return _equal_dois() | (may_be_same() & heading & part & (alike | shortened) & authors & single & found_again & ~_other_numbers())


def deduplicate_batches(history: DataFrame, history_id: str, incoming: DataFrame, incoming_id: str, batch_col: str) -> DataFrame:
    """``(accepted_id, incoming_id)`` over all batches in order of ``batch_col``; each row that repeats an accepted work, once.

    accepted_id is the least id of the work among history and earlier rows. Rows with nothing to compare (no DOI, title and
    author) repeat nothing. Rows of an unknown batch (null) come last. An empty history or batch is fine.
    """
    spark = history.sparkSession
    index = Index(spark, history, history_id)
    numbers = [r[0] for r in incoming.select(batch_col).distinct().collect()]
    result = None
    for number in sorted(numbers, key=lambda x: (x is None, x)):
        found = index.add_batch(incoming.where(F.col(batch_col).eqNullSafe(F.lit(number))), incoming_id)
        result = found if result is None else result.unionByName(found)
    index.close()
    if result is None:
        return incoming.limit(0).select(F.lit("").alias("accepted_id"), F.col(incoming_id).alias("incoming_id"))
    return result.select("accepted_id", F.col("id").alias("incoming_id"))
