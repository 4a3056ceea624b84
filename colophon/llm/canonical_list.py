"""Free-entered values mapped to a canonical list by a prefix-filtered set-similarity join.

Distinct values and the list's forms become sets of character trigrams. Trigrams are ordered by their frequency over both
sides, rarest first; two sets whose Jaccard similarity reaches the threshold share a trigram within their prefixes, so
only prefixes are joined, length and position rule out most pairs, and the rest are verified exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.operators.skew import lookup_join
from colophon.session import materialize

# Short forms of title words, words without weight, and what may be added to a title.
SHORT_FORMS = {
    "j": "journal", "jnl": "journal", "jrnl": "journal", "ann": "annals", "annls": "annals", "arch": "archives",
    "int": "international", "intl": "international", "rev": "review", "bull": "bulletin", "bltn": "bulletin",
    "rep": "reports", "rept": "reports", "repts": "reports", "proc": "proceedings", "trans": "transactions",
}
STOP_WORDS = ["the", "of", "and", "in", "on", "for", "a", "an"]
ADDITIONS = [
    r"\([^)]*\)\s*$",
    r"\[[^\]]*\]\s*$",
    r"[,;]?\s*\bvol(?:\.|ume)?\s*\d+.*$",
    r"\s-\s*suppl(?:\.|ement)?.*$",
]

THRESHOLD = 0.55


def plain_title(value: Column) -> Column:
    """Lower case words without additions, punctuation and stop words, short forms written out."""
    x = F.lower(value)
    for pattern in ADDITIONS:
        x = F.regexp_replace(x, pattern, "")
    words = F.filter(F.split(F.regexp_replace(x, r"[^\p{L}\p{M}\p{N}]+", " "), " "), lambda w: (w != "") & ~w.isin(STOP_WORDS))
    table = F.create_map(*[F.lit(x) for pair in SHORT_FORMS.items() for x in pair])
    return F.array_join(F.transform(words, lambda w: F.coalesce(F.element_at(table, w), w)), " ")


def trigrams(text: Column) -> Column:
    """The set of trigrams of the text with a space at either end; none for an empty text."""
    padded = F.concat(F.lit(" "), text, F.lit(" "))
    grams = F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: padded.substr(i, F.lit(3)))
    return F.when(F.length(text) > 0, F.array_distinct(grams)).otherwise(F.array().cast("array<string>"))


def _ordered(sets: DataFrame, frequency: DataFrame) -> DataFrame:
    """Replaces grams by (rank, gram) structs in order of rarity."""
    one = sets.select("key", F.explode("grams").alias("gram")).join(frequency, "gram")
    return one.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("toks"))


def _prefixes(sets: DataFrame, threshold: float) -> DataFrame:
    n = F.size("toks")
    keep = n - F.ceil(n * F.lit(threshold)).cast("int") + 1
    return sets.select("key", n.alias("n"), F.posexplode(F.slice("toks", 1, keep)).alias("pos", "tok"), F.transform("toks", lambda t: t["gram"]).alias("grams"))


def similarity_join(left: DataFrame, right: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(left_key, right_key, jaccard)`` of all pairs of two ``(key, grams)`` tables with at least ``threshold``.

    Keys are unique; rows with an empty set have no partner.
    """
    both = left.select("grams").unionByName(right.select("grams"))
    frequency = materialize(both.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("df")), "grams")
    a = _prefixes(_ordered(left, frequency), threshold).select(F.col("key").alias("left_key"), F.col("n").alias("an"), F.col("pos").alias("ap"), "tok", F.col("grams").alias("ag"))
    b = _prefixes(_ordered(right, frequency), threshold).select(F.col("key").alias("right_key"), F.col("n").alias("bn"), F.col("pos").alias("bp"), "tok", F.col("grams").alias("bg"))
    need = F.lit(threshold) / (1 + F.lit(threshold)) * (F.col("an") + F.col("bn"))
    length_ok = (F.col("an") >= F.col("bn") * threshold) & (F.col("bn") >= F.col("an") * threshold)
    # what can still be shared from this position on, plus what may have been shared before it
    reach = F.least("ap", "bp") + 1 + F.least(F.col("an") - F.col("ap") - 1, F.col("bn") - F.col("bp") - 1)
    pairs = a.join(b, "tok").where(length_ok & (reach >= need - 1e-9)).dropDuplicates(["left_key", "right_key"])
    shared = F.size(F.array_intersect("ag", "bg"))
    scored = pairs.withColumn("jaccard", shared / (F.col("an") + F.col("bn") - shared))
    return scored.where(F.col("jaccard") >= threshold).select("left_key", "right_key", "jaccard")


def map_to_list(values: DataFrame, value: str, entries: DataFrame, entry_id: str, forms: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """``(value, n, entry)`` for each distinct non-null value: the closest entry or null, and the value's number of rows.

    Each entry is known by all its ``forms``; null forms are skipped. The best pair has the highest Jaccard similarity, then the
    least edit distance, then the smallest entry. Values without letters or digits match nothing. Two equal entries tie
    to the smaller id; an empty list maps nothing.
    """
    distinct = values.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    distinct = materialize(distinct.withColumn("plain", plain_title(F.col("value"))), "values")
    left = distinct.select(F.col("plain").alias("key")).distinct().withColumn("grams", trigrams(F.col("key")))
    known = entries.select(F.col(entry_id).alias("entry"), F.explode(F.array(*[F.col(f) for f in forms])).alias("form")).where("form is not null")
    known = known.select("entry", plain_title(F.col("form")).alias("plain")).where("plain <> ''").groupBy("plain").agg(F.min("entry").alias("entry"))
    right = known.select(F.col("plain").alias("key"), trigrams(F.col("plain")).alias("grams"))
    pairs = similarity_join(left, right, threshold).join(known.withColumnRenamed("plain", "right_key"), "right_key")
    order = F.struct((-F.col("jaccard")).alias("j"), F.levenshtein("left_key", "right_key").alias("d"), "entry")
    best = pairs.groupBy(F.col("left_key").alias("plain")).agg(F.min(order)["entry"].alias("entry"))
    return distinct.join(best, "plain", "left").select("value", "n", "entry")


def match_rows(rows: DataFrame, value: str, mapped: DataFrame) -> DataFrame:
    """Each row with a non-null value and the entry its value is mapped to; a value that many rows share is spread."""
    return lookup_join(rows.withColumn("value", F.col(value)), materialize(mapped, "mapped"), ["value"], "n").drop("n")
