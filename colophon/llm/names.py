"""Variant spellings of names: canonical rewritings, joined where they meet and scored by how rare they are.

A name is read as given name, middle initials and surname, or as the words of a group. From that follow its rewritings:
nicknames written out, order of parts undone, initials, the name without its middle initial, legal forms of groups dropped,
and every form with one character left out (two spellings one typing error apart share such a form). Equal rewritings are
joined; a rewriting that several authors share says nothing and links nothing.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.operators.components import connected_components
from colophon.session import materialize

# Everyday forms of given names, particles of surnames, legal forms of groups, words around group names.
NICKNAMES = {
    "al": "albert", "alex": "alexander", "andy": "andrew", "bea": "beatrice", "becky": "rebecca", "ben": "benjamin",
    "beppe": "giuseppe", "bert": "albert", "beth": "elizabeth", "betty": "elizabeth", "bill": "william", "bob": "robert",
    "bobby": "robert", "cathy": "katherine", "charlie": "charles", "chris": "christopher", "chuck": "charles",
    "dan": "daniel", "danny": "daniel", "dave": "david", "dick": "richard", "dima": "dmitri", "don": "donald", "ed": "edward",
    "eddie": "edward", "fran": "francisco", "fritz": "friedrich", "gosia": "malgorzata", "greg": "gregory", "hans": "johannes",
    "harry": "henry", "jack": "john", "jim": "james", "jimmy": "james", "joe": "joseph", "jon": "jonathan", "kate": "katherine",
    "kathy": "katherine", "katie": "katherine", "katya": "ekaterina", "ken": "kenneth", "larry": "lawrence", "liz": "elizabeth",
    "lizzie": "elizabeth", "maggie": "margaret", "matt": "matthew", "meg": "margaret", "mike": "michael", "misha": "mikhail",
    "nick": "nicholas", "paco": "francisco", "pancho": "francisco", "pat": "patricia", "patty": "patricia", "peggy": "margaret",
    "pepe": "jose", "pino": "giuseppe", "pete": "peter", "rich": "richard", "rick": "richard", "rob": "robert", "ron": "ronald",
    "sam": "samuel", "sasha": "alexander", "steve": "steven", "sue": "susan", "susie": "susan", "ted": "edward", "tim": "timothy",
    "tom": "thomas", "tommy": "thomas", "tony": "anthony", "tricia": "patricia", "vicky": "victoria", "volodya": "vladimir",
    "will": "william", "zeke": "ezekiel",
}
PARTICLES = {"de", "la", "van", "der", "von", "ter", "den", "del", "della", "di", "da", "le", "du", "dos", "zu", "zur", "ten", "el", "al", "bin", "ibn"}
LEGAL_FORMS = {
    "consortium": "consortium", "consort": "consortium", "cons": "consortium", "group": "group", "grp": "group",
    "collaboration": "collaboration", "collab": "collaboration", "network": "network", "netw": "network", "initiative": "initiative",
    "team": "team", "committee": "committee", "society": "society", "soc": "society", "association": "association",
    "assoc": "association", "inc": "company", "ltd": "company", "gmbh": "company", "corp": "company", "company": "company",
}
AROUND_GROUPS = {"the", "of", "for", "and", "on", "behalf", "a"}
FILLERS = ["et al.", "et al", "and others", "others", "anonymous", "n/a"]
NO_DECOMPOSITION = {"ø": "o", "ł": "l", "đ": "d", "ı": "i", "ħ": "h", "ŧ": "t", "æ": "ae", "œ": "oe", "ð": "d", "þ": "th", "ß": "ss"}

#: From this length on, names are compared for typing errors by their two ends.
LONG = 100

#: Shorter surnames written with initials aren't compared for typing errors.
LEAST_LETTERS = 5

PARSED = "kind string, given string, middle string, surname string, initials boolean"


def fold(text: str) -> str:
    """Lower case without diacritics."""
    flat = "".join(ch for ch in unicodedata.normalize("NFKD", text.casefold()) if not unicodedata.combining(ch))
    return "".join(NO_DECOMPOSITION.get(ch, ch) for ch in flat)


def _group(words: list[str]) -> tuple[str, str, str, str, bool]:
    kept = [LEGAL_FORMS.get(w, w) for w in words if w not in AROUND_GROUPS]
    return "G", "", "", " ".join(sorted(kept)), False


def parse(name: str) -> tuple[str, str, str, str, bool]:
    """Kind P or G, given name (one letter if only initials are written), middle initials, surname without spaces, initials only."""
    flat = fold(name)
    words = re.findall(r"\w+", flat)
    if any(w in LEGAL_FORMS for w in words) and len(words) > 2:
        return _group(words)
    parts = re.findall(r"[^\s,]+|,", flat)
    if "," in parts:
        cut = parts.index(",")
        surname, given, tail = parts[:cut], [p for p in parts[cut + 1 :] if p != ","], []
        while given and given[-1] in PARTICLES:
            tail.insert(0, given.pop())
        surname = tail + surname
    else:
        last = name.split()[-1] if name.split() else ""
        if len(parts) > 1 and len(parts[0]) > 1 and "." not in parts[0] and last.isalpha() and last.isupper() and len(last) <= 3 and not name.isupper():
            surname, given = parts[:-1], [ch + "." for ch in parts[-1]]
        else:
            cut = max(len(parts) - 1, 0)
            while cut > 1 and parts[cut - 1] in PARTICLES:
                cut -= 1
            given, surname = parts[:cut], parts[cut:]
    bare = "".join(re.findall(r"\w+", "".join(surname)))
    initial = [g for g in given if "." in g or len(g) == 1]
    full = [g for g in given if g not in initial]
    letters = [x for g in initial for x in re.findall(r"\w", g)[:1]]
    if full:
        first = "".join(re.findall(r"\w+", "".join(full)))
        return "P", NICKNAMES.get(first, first), "".join(letters), bare, False
    return "P", letters[0] if letters else "", "".join(letters[1:]), bare, bool(letters)


def _parse_all(names: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([parse(n) for n in names], columns=["kind", "given", "middle", "surname", "initials"])


def _one_error_forms(text: str) -> Column:
    """Forms of which two texts one typing error apart share one."""
    drops = F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text))))
    # in a long text one error leaves the beginning or the end as it is, which takes two forms instead of one a character
    none = F.array().cast("array<string>")
    short = F.when(F.length(text) <= LONG + 1, F.concat(F.array(text), drops)).otherwise(none)
    long = F.when(F.length(text) >= LONG - 1, F.array(F.concat(F.lit("<"), F.left(F.col(text), F.lit(LONG // 2 - 5))), F.concat(F.lit(">"), F.right(F.col(text), F.lit(LONG // 2 - 5))))).otherwise(none)
    return F.array_distinct(F.concat(short, long))


def _one_error(a: str, b: str) -> Column:
    distance = F.levenshtein(a, b, 2)
    swapped = (distance == 2) & (F.length(a) == F.length(b)) & (F.array_sort(F.split(a, "")) == F.array_sort(F.split(b, "")))
    return (distance == 1) | swapped


def _typing_errors(identities: DataFrame) -> DataFrame:
    """Pairs of identities one typing error apart: a character more, less, other or two swapped.

    A pair is left out if both given names, or both surnames, are well established: then they are two names.
    """
    givens = identities.where("given <> ''").groupBy("given").agg(F.count_distinct("surname").alias("uses"))
    families = identities.where("kind = 'P'").groupBy("surname").agg(F.count_distinct("given").alias("uses"))
    text = F.concat_ws("|", "given", "middle", "surname")
    one = identities.select("key", "kind", "given", "middle", "surname", text.alias("text"))
    # only hashes and keys meet; the pairs, which are few, then get the rest and are verified
    met = one.select("key", F.explode(_one_error_forms("text")).alias("form"), "kind", "middle").select("key", F.xxhash64("kind", "middle", "form").alias("h"))
    met = met.select("h", F.col("key").alias("a_key")).join(met.select("h", F.col("key").alias("b_key")), "h").where("a_key < b_key").select("a_key", "b_key").distinct()
    a, b = [one.select(*[F.col(c).alias(f"{x}_{c}") for c in ("key", "kind", "given", "middle", "surname", "text")]) for x in "ab"]
    pairs = met.join(a, "a_key").join(b, "b_key").where("a_kind = b_kind and a_middle = b_middle")
    pairs = pairs.where(_one_error("a_text", "b_text"))
    for col, uses in (("given", givens), ("surname", families)):
        for x in "ab":
            pairs = pairs.join(uses.select(F.col(col).alias(f"{x}_{col}"), F.col("uses").alias(f"{x}_{col}_uses")), f"{x}_{col}", "left")
    two_givens = (F.col("a_given") != F.col("b_given")) & (F.least("a_given_uses", "b_given_uses") * 5 > F.greatest("a_given_uses", "b_given_uses")) & (F.least("a_given_uses", "b_given_uses") > 2)
    two_families = (F.col("a_surname") != F.col("b_surname")) & (F.least("a_surname_uses", "b_surname_uses") > 2)
    return pairs.where(~F.coalesce(two_givens, F.lit(False)) & ~F.coalesce(two_families, F.lit(False))).select(F.col("a_key").alias("a"), F.col("b_key").alias("b"))


def _without_middle(identities: DataFrame) -> DataFrame:
    """Ties a name without middle initial to the one name that has it; if several initials occur, nothing can be told."""
    g = identities.where("kind = 'P' and not initials").groupBy("given", "surname").agg(F.collect_set("middle").alias("middles"))
    one = g.where(F.array_contains("middles", "") & (F.size("middles") == 2)).withColumn("middle", F.array_max("middles"))
    return one.select(F.concat_ws("|", F.lit("P"), "given", F.lit(""), "surname").alias("a"), F.concat_ws("|", F.lit("P"), "given", "middle", "surname").alias("b"))


def _mistyped_initials(short: DataFrame, forms: DataFrame) -> DataFrame:
    """``(key, author, stated)`` for spellings with initials whose surname is one typing error from the author's; stated tells
    whether the middle initials agree or are missing in the spelling. Initials say little, so both surnames are LEAST_LETTERS long
    at least; a pair is left out if both surnames are established with several given names: then they are two families.
    """
    sides = []
    for side, x in ((short.select("key", "given", "middle", "surname"), "a"), (forms, "b")):
        side = side.where(F.length("surname") >= LEAST_LETTERS)
        sides.append(side.select(*[F.col(c).alias(c if c in ("key", "author", "given") else f"{x}_{c}") for c in side.columns], F.explode(_one_error_forms("surname")).alias("form")))
    met = sides[0].join(sides[1], ["given", "form"]).drop("form").distinct().where(_one_error("a_surname", "b_surname"))
    met = met.where((F.col("a_middle") == F.col("b_middle")) | (F.col("a_middle") == ""))
    uses = forms.groupBy("surname").agg(F.count_distinct("author").alias("uses"))
    for x in "ab":
        met = met.join(uses.select(F.col("surname").alias(f"{x}_surname"), F.col("uses").alias(f"{x}_uses")), f"{x}_surname", "left")
    met = met.where(~F.coalesce(F.least("a_uses", "b_uses") > 2, F.lit(False)) | F.col("a_uses").isNull())
    return met.select("key", "author", (F.col("a_middle") == F.col("b_middle")).alias("stated"))


def link_names(entries: DataFrame, strings: DataFrame | None = None) -> DataFrame:
    """``(name, author)`` for each spelling; spellings with one author are linked. author is a key without further meaning.

    ``entries`` has ``name`` and ``canonical_name`` (either may be null); where both are given the entry itself ties the two.
    Fillers such as "et al." and empty strings are left out. Repeated rows change nothing.
    """
    names = entries.select(F.explode(F.array("name", "canonical_name")).alias("name")).where("name is not null and trim(name) <> ''")
    names = names.where(~F.lower(F.trim("name")).isin(FILLERS)).distinct()
    read = names.withColumn("p", F.pandas_udf(_parse_all, PARSED)("name")).select("name", "p.*")
    kind = F.when(F.col("initials"), F.lit("I")).otherwise(F.col("kind"))
    read = materialize(read.withColumn("key", F.concat_ws("|", kind, "given", "middle", "surname")), "names")
    identities = read.select("key", "kind", "given", "middle", "surname", "initials").distinct()
    whole = identities.where("not initials")

    pairs = entries.where("name is not null and canonical_name is not null and name <> canonical_name").select("name", "canonical_name").distinct()
    stated = pairs.join(read.select("name", F.col("key").alias("a"), F.col("initials").alias("short")), "name")
    stated = stated.join(read.where("not initials").select(F.col("name").alias("canonical_name"), F.col("key").alias("b")), "canonical_name").select("a", "b", "short").distinct()
    stated = materialize(stated, "stated")

    edges = _typing_errors(whole).unionByName(_without_middle(whole)).unionByName(stated.where("not short").select("a", "b"))
    found = connected_components(edges)
    authors = whole.join(found.withColumnRenamed("node", "key"), "key", "left").withColumn("author", F.coalesce("component", "key"))
    authors = materialize(authors.select("key", "kind", "given", "middle", "surname", "author"), "authors")

    # a spelling with initials goes to the only author that is stated for it, else to the only one whose rewriting it is,
    # else to the only one that is one typing error away from it
    short = identities.where("initials")
    said = stated.where("short").join(authors.select(F.col("key").alias("b"), "author"), "b").select(F.col("a").alias("key"), "author")
    first = F.substring("given", 1, 1)
    forms = authors.where("kind = 'P'").select(first.alias("given"), "middle", "surname", "author").distinct()
    exact = short.join(forms, ["given", "middle", "surname"]).select("key", "author")
    loose = short.where("middle = ''").join(forms.drop("middle").distinct(), ["given", "surname"]).select("key", "author")
    mistyped = _mistyped_initials(short, forms)
    ranked = said.withColumn("rank", F.lit(0)).unionByName(exact.withColumn("rank", F.lit(1))).unionByName(loose.withColumn("rank", F.lit(2))).unionByName(mistyped.select("key", "author", F.when(F.col("stated"), 3).otherwise(4).alias("rank")))
    tied = ranked.groupBy("key", "rank").agg(F.count_distinct("author").alias("shared"), F.min("author").alias("author"))
    best = tied.groupBy("key").agg(F.min(F.struct("rank", "shared", "author")).alias("best")).where("best.shared = 1").select("key", F.col("best.author").alias("author"))

    full = read.join(authors.select("key", "author").unionByName(best), "key", "left")
    return full.select("name", F.coalesce("author", "key").alias("author"))


def name_pairs(linked: DataFrame) -> DataFrame:
    """All pairs of different spellings of one author, ``name_a < name_b``."""
    a, b = [linked.select(F.col("name").alias(f"name_{x}"), "author") for x in "ab"]
    return a.join(b, "author").where("name_a < name_b").select("name_a", "name_b")
