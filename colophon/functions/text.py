"""Text functions: native expressions where Spark has them, Arrow functions for Unicode normal forms."""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Shapes of keys.
DOI_SHAPE = r"(?U)^10\.[0-9]{4,9}/\S+$"
RECORD_ID_SHAPE = r"^[0-9]{9}$"
RECORD_FILE_SHAPE = r"^[0-9]{5}\.yaml$"
LISTED_FILE_SHAPE = r"(?i)^[0-9]{5}\.ya?ml$"
VOCABULARY_CODE_SHAPE = r"^[a-z][a-z0-9_]*$"
MISSING = "__missing__"


def _beyond_ascii(text: Column) -> Column:
    """The text if it has a character beyond ASCII, else null: a UDF sees every row, whatever the condition around it."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), text)


def _fold(texts: pa.Array) -> pa.Array:
    apart = pc.utf8_normalize(texts, form="NFKD")
    return pc.utf8_lower(pc.replace_substring_regex(apart, pattern="[\\x{0300}-\\x{036F}]", replacement=""))


def fold(text: Column) -> Column:
    """For searching: compatibility decomposed, without the marks U+0300 to U+036F, in lower case. Null stays null.

    Only texts with a character beyond ASCII are handed to the Arrow step; the others reach it as nulls.
    """
    return F.coalesce(F.arrow_udf(_fold, "string")(_beyond_ascii(text)), F.lower(text))


def _compatible_casefold(texts: pa.Array) -> pa.Array:
    # Arrow's own NFKC leaves marks apart
    return pa.array([None if t is None else unicodedata.normalize("NFKC", t).casefold() for t in texts.to_pylist()], pa.string())


def _casefolded(text: Column) -> Column:
    return F.coalesce(F.arrow_udf(_compatible_casefold, "string")(_beyond_ascii(text)), F.lower(text))


def _casefold_lists(lists: pa.Array) -> pa.Array:
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    folded = pa.ListArray.from_arrays(pa.array(offsets), _compatible_casefold(lists.flatten()))
    return pc.if_else(lists.is_valid(), folded, pa.scalar(None, folded.type))


def _squeezed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)[\s\x1C-\x1F]+", " "))


def norm_texts(texts: Column) -> Column:
    """norm_text of each member of an array; only arrays with a character beyond ASCII are handed to the Arrow step."""
    odd = F.exists(texts, lambda t: F.coalesce(t.rlike(r"[^\x00-\x7F]"), F.lit(False)))
    folded = F.coalesce(F.arrow_udf(_casefold_lists, "array<string>")(F.when(odd, texts)), F.transform(texts, F.lower))
    return F.transform(folded, _squeezed)


def strip(text: Column) -> Column:
    """Without white space of any kind at the ends (a trim would take off spaces only)."""
    return F.regexp_replace(text, r"(?U)^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+$", "")


def norm_text(text: Column) -> Column:
    """NFKC, case folded, runs of white space as one space, none at the ends."""
    return _squeezed(_casefolded(text))


def norm_title(text: Column) -> Column:
    """norm_text without anything but letters and digits; a title of symbols gives ''."""
    return F.regexp_replace(norm_text(text), r"[^\p{L}\p{N}]", "")


def norm_doi(text: Column) -> Column:
    """NFKC, stripped, case folded."""
    return _casefolded(strip(text))


def humanize(code: Column) -> Column:
    """A code as words, each with a capital: 'research_article' is 'Research Article'; nothing is 'Not specified'."""
    words = F.regexp_replace(code, "[_-]+", " ")
    spelled = F.array_join(F.transform(F.split(words, " "), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, F.lit(2), F.length(w)))), " ")
    return F.when(code.isNull() | (code == ""), F.lit("Not specified")).otherwise(spelled)


def is_blank(text: Column) -> Column:
    return strip(text) == ""


def is_padded(text: Column) -> Column:
    return (strip(text) != text) & (strip(text) != "")


def is_multiline(text: Column) -> Column:
    return text.rlike(r"[\r\n]")


def doi_url(doi: Column) -> Column:
    """Resolver address with each of the two parts percent-encoded; null if a part is missing."""
    prefix, suffix = F.substring_index(doi, "/", 1), F.regexp_replace(doi, "^[^/]*/", "")
    whole = doi.contains("/") & (prefix != "") & (suffix != "")
    return F.when(whole, F.concat(F.lit("https://doi.org/"), percent_encode(prefix), F.lit("/"), percent_encode(suffix)))


def percent_encode(text: Column) -> Column:
    """As a component of an address: letters, digits and - _ . ! ~ * ' ( ) stay."""
    out = F.url_encode(text)
    for code, ch in (("+", "%20"), ("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        out = F.replace(out, F.lit(code), F.lit(ch))
    return out


def markdown_cell(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))


def grouped(number: Column) -> Column:
    """A whole number with commas between thousands."""
    return F.format_number(number, 0)


def counted(number: Column, singular: str) -> Column:
    """A number with its noun: '1 record', '1,200 records'."""
    return F.concat(grouped(number), F.when(number == 1, F.lit(f" {singular}")).otherwise(F.lit(f" {singular}s")))


def trim_slashes(text: Column) -> Column:
    return F.regexp_replace(text, "^/+|/+$", "")


def as_number(text: Column) -> Column:
    """The number a text stands for, 0 if it is none."""
    return F.coalesce(text.try_cast("double"), F.lit(0.0))


def fold_text(text: str) -> str:
    """The same folding for a search word on the driver."""
    return "".join(ch for ch in unicodedata.normalize("NFKD", text) if not "̀" <= ch <= "ͯ").lower()
