"""Duplicates hidden by formatting: dictionary-encoded records, grouped as integer tuples.

Every distinct value is brought to its canonical form once and gets an integer identifier; a record becomes the sorted
list of its (position, identifier) numbers, and equal lists are copies of one record.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.operators.skew import lookup_join
from colophon.session import materialize

# What may stand before a DOI and belongs to its notation.
DOI_LABEL = r"^[\s<\[(\"']*(?:(?:https?://)?[a-z0-9.-]*\b(?:doi|resolver)[a-z0-9.-]*/\s*|doi\s*[:=]?\s*|https?://[^/\s]+/\s*|info:doi/\s*){1,4}"

ENTRY = "array<struct<field string, pos int, value string>>"


def canonical(value: Column) -> Column:
    """Letters, marks and digits of the value without their case; null stays null, a value without any becomes ''."""
    bare = F.regexp_replace(value, r"[^\p{L}\p{M}\p{N}]+", "")
    # the optimizer takes lower(upper(x)) for lower(x), so what capitals don't tell apart is said here
    return F.replace(F.replace(F.lower(bare), F.lit("ß"), F.lit("ss")), F.lit("ς"), F.lit("σ"))


def canonical_doi(value: Column) -> Column:
    """As canonical, and without a label or resolver address in front."""
    return canonical(F.regexp_replace(F.lower(value), DOI_LABEL, ""))


def _plain(body: str) -> list[tuple[str, int, str]]:
    """Entries of lines ``key: value``; lines that open with a hyphen belong to the list named last."""
    out, key, pos = [], None, 0
    for line in body.splitlines():
        item = re.match(r"\s*-\s*(.*)$", line)
        if item and key is not None:
            pos += 1
            out.append((key, pos, item.group(1)))
            continue
        pair = re.match(r"\s*[\"']?([^:\"']+?)[\"']?\s*:\s*(.*)$", line)
        if pair:
            key, pos = pair.group(1).strip().lower(), 0
            if pair.group(2).strip():
                out.append((key, 0, pair.group(2)))
    return out


def _entries(body: str | None) -> list[tuple[str, int, str]]:
    if not body:
        return []
    try:
        doc = json.loads(body)
    except (ValueError, RecursionError):
        return _plain(body)
    if not isinstance(doc, dict):
        return _plain(body)
    out = []
    for k, v in doc.items():
        key = str(k).strip().lower()
        if isinstance(v, list):
            out += [(key, i, x if isinstance(x, str) else json.dumps(x, sort_keys=True)) for i, x in enumerate(v, 1) if x is not None]
        elif v is not None:
            out.append((key, 0, v if isinstance(v, str) else json.dumps(v, sort_keys=True)))
    return out


def _entries_of(body: pd.Series) -> pd.Series:
    return body.map(_entries)


def body_entries(body: Column) -> Column:
    """Fields of a record text: a JSON object or lines ``key: value`` with lists; list items are counted from 1."""
    return F.pandas_udf(_entries_of, ENTRY)(body)


def dictionary(long: DataFrame, canon: Column) -> DataFrame:
    """``(field, value, vid, n)`` for each distinct value: the identifier of its canonical form, and its number of uses.

    ``canon`` is an expression over the columns field and value; it is evaluated once for each distinct value.
    """
    values = materialize(long.groupBy("field", "value").agg(F.count(F.lit(1)).alias("n")).withColumn("canon", canon), "values")
    ids = materialize(values.select("field", "canon").distinct().withColumn("vid", F.monotonically_increasing_id()), "ids")
    return materialize(values.join(ids, ["field", "canon"]).select("field", "value", "vid", "n"), "dict")


def encode(long: DataFrame, id_col: str, canon: Column) -> DataFrame:
    """``(id, code)``: each record as its sorted (position, identifier) numbers. ``long`` has id, field, pos, value.

    Identifiers are given for fields and values together, so that an identifier says which field it belongs to.
    """
    words = dictionary(long, canon)
    coded = lookup_join(long, words, ["field", "value"], "n")
    return coded.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("pos", "vid"))).alias("code"))


def copies(encoded: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """Groups ``(code, first_id, copies)`` and members ``(first_id, copy_id)``, the first member left out of the latter.

    Counting is pre-aggregated, and the members find their group by a join that spreads the rows of a hot group.
    """
    encoded = materialize(encoded, "codes")
    groups = materialize(encoded.groupBy("code").agg(F.min(id_col).alias("first_id"), F.count(F.lit(1)).alias("copies")), "groups")
    repeated = groups.where("copies > 1")
    members = lookup_join(encoded, repeated, ["code"], "copies").where(F.col(id_col) != F.col("first_id"))
    return groups, members.select("first_id", F.col(id_col).alias("copy_id"))


def record_values(records: DataFrame, id_col: str = "record_id", title: str = "title", doi: str = "doi") -> DataFrame:
    """Long form of the records that have both title and DOI; the others take no part."""
    long = records.where(F.col(title).isNotNull() & F.col(doi).isNotNull())
    pair = F.array(F.struct(F.lit("title").alias("field"), F.col(title).alias("value")), F.struct(F.lit("doi").alias("field"), F.col(doi).alias("value")))
    return long.select(F.col(id_col).alias("id"), F.inline(pair)).select("id", "field", F.lit(0).alias("pos"), "value")


def body_values(raw: DataFrame, id_col: str = "raw_id", body: str = "body") -> DataFrame:
    """Long form of record texts; a text that is null, empty or without any field takes no part."""
    return raw.select(F.col(id_col).alias("id"), F.inline(body_entries(F.col(body))))


def field_canon() -> Column:
    return F.when(F.col("field") == "doi", canonical_doi(F.col("value"))).otherwise(canonical(F.col("value")))


def formatting_duplicates(long: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups and members of records that agree apart from formatting, from their long form (id, field, pos, value).

    Nulls are absent values; values of punctuation only are equal to each other; repeated rows with one id count once a
    row; an empty table gives empty results.
    """
    return copies(encode(long, "id", field_canon()), "id")
