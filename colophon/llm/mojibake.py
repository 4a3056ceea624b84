"""Text decoded under a wrong character encoding: learned from clean near-twins, applied everywhere.

Texts that agree once non-ASCII characters are left out are near-twins. Where one twin has several characters in the place
of another's few, the characters are aligned with the UTF-8 bytes of the clean ones; the single-byte encodings that explain
the alignments are the learned transformations. They are then undone in all other texts, whether or not these have a twin.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.session import materialize

# Single-byte encodings known to Python among which the transformations are looked for.
ENCODINGS = [
    "cp1252", "latin-1", "cp1250", "cp1251", "mac_roman", "cp437", "cp850", "cp1254", "cp1253", "cp1257", "cp1255", "cp1256",
    "cp1258", "cp852", "cp866", "koi8_r", "koi8_u", "iso8859_2", "iso8859_5", "iso8859_7", "iso8859_9", "iso8859_15",
    "mac_latin2", "mac_cyrillic", "mac_greek", "cp737", "cp775", "cp855", "cp857", "cp865",
]
#: Shorter ASCII skeletons say too little to call two texts twins.
LEAST_SKELETON = 4
REPLACEMENT = "�"


def skeleton(text: Column) -> Column:
    """ASCII letters and digits of the text in lower case."""
    return F.lower(F.regexp_replace(text, "[^A-Za-z0-9]+", ""))


def non_ascii(text: Column) -> Column:
    return text.rlike(r"[^\x00-\x7F]")


def fields_of(records: DataFrame) -> DataFrame:
    """``(record_id, field_name, author_pos, text)`` of all titles and author names that are not null."""
    titles = records.select("record_id", F.lit("title").alias("field_name"), F.lit(0).alias("author_pos"), F.col("title").alias("text"))
    names = records.select("record_id", F.posexplode("authors")).select("record_id", F.lit("name").alias("field_name"), (F.col("pos") + 1).alias("author_pos"), F.col("col.name").alias("text"))
    return titles.unionByName(names).where("text is not null")


@lru_cache(maxsize=None)
def _chars(encoding: str) -> tuple[str, ...]:
    """The character of each byte; bytes without one stand for the control character of that number."""
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(encoding))
        except UnicodeDecodeError:
            out.append(chr(b))
    return tuple(out)


@lru_cache(maxsize=None)
def _bytes(encoding: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for b, ch in enumerate(_chars(encoding)):
        out.setdefault(ch, b)
    return out


def _explained(garbled: str, clean: str) -> list[str]:
    """Encodings under which the UTF-8 bytes of ``clean`` read as ``garbled``."""
    raw = clean.encode("utf-8", "surrogatepass")
    if len(raw) != len(garbled):
        return []
    return [e for e in ENCODINGS if all(_chars(e)[b] == ch for b, ch in zip(raw, garbled))]


_RUN = re.compile(r"[^\x00-\x7f]+")


def _alignments(garbled: str, clean: str) -> list[str]:
    """For each run of characters that differs, the encodings that explain it, joined by commas."""
    a, b = _RUN.findall(garbled), _RUN.findall(clean)
    if len(a) != len(b):
        return []
    return [",".join(e) for x, y in zip(a, b) if x != y and len(x) > len(y) and (e := _explained(x, y))]


def _votes(pairs: pd.DataFrame) -> pd.Series:
    return pd.Series([_alignments(g, c) for g, c in zip(pairs["text"], pairs["clean"])])


def twins(texts: DataFrame) -> DataFrame:
    """``(skeleton, clean)``: of the texts with one skeleton the one with the fewest non-ASCII characters, the most used first.

    One row a skeleton, found by a partial aggregate: no pairs within a group are made. ``texts`` has text and n.
    """
    odd = F.length(F.regexp_replace("text", r"[\x00-\x7F]", ""))
    good = texts.where(non_ascii(F.col("text")) & ~F.col("text").contains(REPLACEMENT) & ~F.col("text").rlike(r"[\x{80}-\x{9f}]"))
    rank = F.struct(odd.alias("odd"), (-F.col("n")).alias("rare"), F.col("text").alias("text"))
    return good.groupBy(skeleton(F.col("text")).alias("skeleton")).agg(F.min(rank)["text"].alias("clean")).where(F.length("skeleton") >= LEAST_SKELETON)


def learn(fields: DataFrame) -> tuple[list[str], DataFrame]:
    """The encodings learned from all twins of ``fields``, the best supported first, and the twins ``(skeleton, clean)``.

    What reaches the driver are counts by set of encodings that explain an alignment. An encoding is taken if it explains
    alignments that no better supported one explains.
    """
    texts = materialize(fields.where(non_ascii(F.col("text"))).groupBy("text").agg(F.count(F.lit(1)).alias("n")), "texts")
    clean = materialize(twins(texts), "twins")
    pairs = texts.withColumn("skeleton", skeleton(F.col("text"))).join(clean, "skeleton").where("text <> clean and length(text) > length(clean)")
    votes = F.pandas_udf(_votes, "array<string>")(F.struct("text", "clean"))
    counted = pairs.select(F.explode(votes).alias("which")).groupBy("which").agg(F.count(F.lit(1)).alias("n")).collect()
    left = Counter({tuple(r["which"].split(",")): r["n"] for r in counted})
    learned: list[str] = []
    while left:
        score: Counter = Counter()
        for which, n in left.items():
            for e in which:
                score[e] += n
        best = max(score, key=lambda e: (score[e], -ENCODINGS.index(e)))
        learned.append(best)
        left = Counter({k: n for k, n in left.items() if best not in k})
    return learned, clean


@lru_cache(maxsize=None)
def _pattern(encoding: str) -> re.Pattern:
    def cls(lo: int, hi: int) -> str:
        return "[" + "".join(re.escape(ch) for ch in _chars(encoding)[lo : hi + 1]) + "]"

    tail = cls(0x80, 0xBF)
    return re.compile(f"(?:{cls(0xC2, 0xDF)}{tail}|{cls(0xE0, 0xEF)}{tail}{{2}}|{cls(0xF0, 0xF4)}{tail}{{3}})+")


# Scripts that are told apart, and the characters that a restored text may gain.
SCRIPTS = ("LATIN", "GREEK", "CYRILLIC", "ARABIC", "HEBREW", "ARMENIAN", "GEORGIAN", "DEVANAGARI", "BENGALI", "GURMUKHI", "GUJARATI", "TAMIL", "TELUGU", "KANNADA", "MALAYALAM", "SINHALA", "THAI", "LAO", "ETHIOPIC", "SYRIAC")
ORDINARY = [(0xA0, 0x17F), (0x192, 0x192), (0x218, 0x21B), (0x2C6, 0x2C6), (0x2DC, 0x2DC), (0x370, 0x45F), (0x490, 0x491), (0x1E00, 0x1EFF), (0x2000, 0x206F), (0x20A0, 0x23FF), (0x2500, 0x25FF), (0x3000, 0x9FFF), (0xAC00, 0xD7A3), (0xFB00, 0xFB06), (0xFF00, 0xFFEF)]


#: So many letters of a script beyond ORDINARY in one sequence don't come about by chance.
ESTABLISHED = 3


def _is_ordinary(ch: str) -> bool:
    return any(a <= ord(ch) <= b for a, b in ORDINARY)


def _of_script(ch: str) -> str:
    """The script a letter, mark or digit is named after; '' if it is none that is told apart."""
    name = unicodedata.name(ch, "").split(" ")[0]
    return name if name in SCRIPTS else ""


def _is_symbol(ch: str) -> bool:
    """Emoji and what joins or varies them: four bytes that fit, or a joiner between such."""
    return ord(ch) >= 0x1F000 and unicodedata.category(ch) in ("So", "Sk") or ch in "\u200d\ufe0f"


def _established(parts: list[str]) -> set[str]:
    """Scripts beyond ORDINARY that the decoded sequences of a text speak for: ESTABLISHED letters of one in a sequence."""
    counts = [Counter(_of_script(ch) for ch in part if ch.isalpha() and not _is_ordinary(ch)) for part in parts]
    return {script for c in counts for script, n in c.items() if script and n >= ESTABLISHED and len(c) == 1}


@lru_cache(maxsize=65536)
def _script(ch: str) -> str:
    name = unicodedata.name(ch, "").split(" ")[0] if ch.isalpha() else ""
    return name if name in SCRIPTS else ""


def _plausible(text: str, start: int, end: int, established: set[str]) -> bool:
    """Whether the part of the text holds ordinary characters, symbols and established scripts only, and the words it touches are of one script each."""
    for at in range(start, end):
        ch = text[at]
        if ch == "\xad" and (at == 0 or not text[at - 1].isalpha()):
            return False  # a soft hyphen doesn't open a word
        mark = 0x300 <= ord(ch) < 0x370 and at > 0 and text[at - 1].isalpha()
        known = mark or 0x80 <= ord(ch) < 0xA0 or _is_ordinary(ch) or _is_symbol(ch) or _of_script(ch) in established
        if not known or unicodedata.category(ch) in ("Cn", "Co"):
            return False
    while start > 0 and text[start - 1].isalpha():
        start -= 1
    while end < len(text) and text[end].isalpha():
        end += 1
    return all(len({_script(ch) for ch in word} - {""}) < 2 for word in re.findall(r"[^\W\d_]+", text[start:end]))


def _undo_one(text: str, encoding: str) -> str:
    """All sequences of one encoding decoded, but for those that leave a word in two scripts once the others are decoded."""
    table, found = _bytes(encoding), []
    for m in _pattern(encoding).finditer(text):
        try:
            good = bytes(table[ch] for ch in m.group()).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            continue
        # letters inside a word don't stand for anything but letters
        word = m.group().isalpha() and (text[m.start() - 1 : m.start()].isalpha() or text[m.end() : m.end() + 1].isalpha())
        if not word or good.isalpha():
            found.append((m.start(), m.end(), good))
    established = _established([good for _, _, good in found])
    while found:
        out, at, places = "", 0, []
        for start, end, good in found:
            out += text[at:start]
            places.append(len(out))
            out += good
            at = end
        out += text[at:]
        kept = [f for f, p in zip(found, places) if _plausible(out, p, p + len(f[2]), established)]
        if len(kept) == len(found):
            return out
        found = kept
    return text


def _odd(text: str) -> int:
    return sum(map(len, _RUN.findall(text)))


def undo(text: str, encodings: list[str]) -> str:
    """The text with all sequences decoded that are UTF-8 read under one of the encodings.

    Each encoding is undone again and again (text may have been damaged more than once, and each time makes it shorter); the
    encoding that leaves the fewest non-ASCII characters wins, the better supported one at a tie; what is left is tried with the others.
    """
    while True:
        best, least = text, _odd(text)
        for e in encodings:
            before, trial = None, text
            while trial != before:
                before, trial = trial, _undo_one(trial, e)
            if _odd(trial) < least:
                best, least = trial, _odd(trial)
        if best == text:
            return text
        text = best


_C1 = re.compile("[\x80-\x9f]")


def restored(text: Column, encodings: list[str]) -> Column:
    """struct(garbled boolean, text string): whether wrongly decoded characters are found, and the text with what can be undone.

    U+FFFD and control characters of the upper range are always a sign of damage.
    """
    known = tuple(encodings)

    def run(texts: pd.Series) -> pd.DataFrame:
        fixed = [undo(t, known) if t is not None else None for t in texts]
        bad = [t is not None and (t != f or REPLACEMENT in t or bool(_C1.search(t))) for t, f in zip(texts, fixed)]
        return pd.DataFrame({"garbled": bad, "text": fixed})

    return F.pandas_udf(run, "garbled boolean, text string")(text)


def garbled_fields(fields: DataFrame, learned: tuple[list[str], DataFrame] | None = None) -> DataFrame:
    """The rows of ``fields`` with damage, as ``(…, text, restored)``; restored is null where the original can't be told.

    ``fields`` has a column text and any others. Characters lost for good (U+FFFD) are taken from the twin with the same
    skeleton if there is one. Null and ASCII texts are no cases; an empty table gives an empty result.
    """
    encodings, clean = learned or learn(fields)
    some = fields.where(non_ascii(F.col("text"))).withColumn("_fix", restored(F.col("text"), encodings)).where("_fix.garbled")
    some = some.withColumn("_key", skeleton(F.col("_fix.text")))
    lost = F.col("_fix.text").contains(REPLACEMENT) | F.col("_fix.text").rlike(r"[\x{80}-\x{9f}]")
    joined = some.join(clean.withColumnRenamed("skeleton", "_key"), "_key", "left")
    return joined.withColumn("restored", F.when(lost, F.col("clean")).otherwise(F.col("_fix.text"))).drop("_key", "_fix", "clean")
