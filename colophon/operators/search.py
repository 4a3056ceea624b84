"""Faceted search over a collection of records: filters, facets, sorting and the projections of a result."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.functions import text as T

FACETS = ["document_type", "publication_stage", "language_status", "record_status"]
SORTS = ("year-desc", "year-asc", "title-asc", "id-asc")
# Columns that have a place of their own; what else a record carries is its residual.
KNOWN = ["record_id", "document_type", "publication_stage", "title", "authors", "doi", "publication_year", "journal", "language_status", "record_status", "related", "record_notes"]


@dataclass(frozen=True)
class SearchSpec:
    """What is asked for; an empty part is no condition. status may be MISSING."""

    document_type: str = ""
    publication_stage: str = ""
    status: str = ""
    year_from: float | None = None
    year_to: float | None = None
    query: str = ""
    sort: str = "year-desc"

    def __post_init__(self):
        if self.sort not in SORTS:
            raise ValueError(f"unknown sort {self.sort!r}")


def year_bounds(records: DataFrame) -> tuple[int, int] | None:
    """Least and greatest year of the collection, in one pass; None without any."""
    row = records.agg(F.min("publication_year"), F.max("publication_year")).first()
    return None if row[0] is None else (row[0], row[1])


def clamp_years(low: float | None, high: float | None, bounds: tuple[int, int], edited: str = "low", stops: bool = False) -> tuple[int, int]:
    """The range that is meant: rounded and inside the bounds. The edge that was edited pushes the other one, or with ``stops``,
    as on a slider, is stopped by it."""
    a, b = (min(max(round(x if x is not None else d), bounds[0]), bounds[1]) for x, d in ((low, bounds[0]), (high, bounds[1])))
    if a > b:
        kept = a if (edited == "low") != stops else b
        a = b = kept
    return a, b


def search_text(columns: list[str] | None = None) -> Column:
    """All searchable parts of a record, folded, with single spaces between; missing and empty parts leave no trace."""
    names = F.flatten(F.transform("authors", lambda a: F.array(a["name"], a["canonical_name"])))
    plain = ["record_id", "title", "journal", "doi", "publication_year", "document_type", "publication_stage", "language_status", "record_status", "record_notes"]
    parts = F.concat(F.array(*[F.col(c).cast("string") for c in columns or plain]), F.coalesce(names, F.array().cast("array<string>")))
    return T.fold(F.array_join(F.filter(parts, lambda p: p.isNotNull() & (p != "")), " "))


def search(records: DataFrame, spec: SearchSpec, bounds: tuple[int, int] | None = None) -> DataFrame:
    """The records that meet all parts of the spec, unsorted.

    A year range counts only if it is narrower than the collection's years; then records without a year drop out. Equality
    conditions reach the scan; the text condition comes last.
    """
    out = records
    if spec.document_type:
        out = out.where(F.col("document_type") == spec.document_type)
    if spec.publication_stage:
        out = out.where(F.col("publication_stage") == spec.publication_stage)
    if spec.status:
        status = F.col("record_status")
        out = out.where(status.isNull() | (status == "") if spec.status == T.MISSING else status == spec.status)
    if spec.year_from is not None or spec.year_to is not None:
        bounds = bounds or year_bounds(records)
        if bounds:
            low, high = clamp_years(spec.year_from, spec.year_to, bounds)
            if (low, high) != bounds:
                out = out.where(F.col("publication_year").between(low, high))
    if spec.query:
        out = out.where(search_text().contains(T.fold_text(spec.query)))
    return out


def sort_columns(sort: str) -> list[Column]:
    """Sort keys; each ends with the id, so the order is total. A missing year counts as 0."""
    year = F.coalesce("publication_year", F.lit(0))
    return {
        "year-desc": [year.desc(), F.col("record_id").asc()],
        "year-asc": [year.asc(), F.col("record_id").asc()],
        "title-asc": [F.collate("title", "UNICODE").asc_nulls_first(), F.col("record_id").asc()],
        "id-asc": [F.col("record_id").asc()],
    }[sort]


def top(records: DataFrame, sort: str, n: int) -> DataFrame:
    """The first ``n`` records in an order: a top-k, no full sort."""
    return records.orderBy(*sort_columns(sort)).limit(n)


def facet_values(records: DataFrame, facets: list[str] = FACETS) -> DataFrame:
    """``(facet, value, n)`` of all facets in one pass; missing and empty values count as MISSING."""
    pairs = [F.struct(F.lit(f).alias("facet"), F.coalesce(F.nullif(F.col(f), F.lit("")), F.lit(T.MISSING)).alias("value")) for f in facets]
    return records.select(F.inline(F.array(*pairs))).groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"))


def facet_options(records: DataFrame, labels: DataFrame, facet: str) -> DataFrame:
    """``(value, label, n)`` of one facet in the order of the labels: the vocabulary's, else the value as words; MISSING is not specified.

    Values of a facet are few, so the sort is of a few rows.
    """
    found = facet_values(records, [facet])
    known = F.broadcast(label(labels, facet).select(F.col("code").alias("value"), "label"))
    spoken = F.coalesce("label", F.when(F.col("value") == T.MISSING, T.humanize(F.lit(""))).otherwise(T.humanize(F.col("value"))))
    return found.join(known, "value", "left").select("value", spoken.alias("label"), "n").orderBy(F.collate("label", "UNICODE"), "value")


def result_line(records: DataFrame, visible: Column) -> DataFrame:
    """``line``: how many of how many records are shown."""
    row = counts(records, visible)
    return row.select(F.concat(T.grouped(F.col("visible")), F.lit(" of "), T.counted(F.col("total"), "record")).alias("line"))


def counts(records: DataFrame, visible: Column) -> DataFrame:
    """Visible and all records, in one pass."""
    return records.agg(F.count_if(visible).alias("visible"), F.count(F.lit(1)).alias("total"))


def author_line(authors: Column, nothing: str = "Authors not specified") -> Column:
    names = F.filter(F.transform(authors, lambda a: a["name"]), lambda n: n.isNotNull() & (n != ""))
    return F.when(F.coalesce(F.size(names), F.lit(0)) > 0, F.array_join(names, ", ")).otherwise(F.lit(nothing))


def label(labels: DataFrame, vocabulary: str) -> DataFrame:
    return labels.where(F.col("vocabulary") == vocabulary).select(F.col("code"), F.col("label"))


def with_label(records: DataFrame, labels: DataFrame, vocabulary: str, code: str, out: str) -> DataFrame:
    """Adds the label of a code: from the vocabulary, else the code as words, '' for no code. Vocabularies are short fixed lists."""
    table = F.broadcast(label(labels, vocabulary).select(F.col("code").alias(code), F.col("label").alias("_label")))
    value = F.when(F.col(code).isNull() | (F.col(code) == ""), F.lit("")).otherwise(F.coalesce("_label", T.humanize(F.col(code))))
    return records.join(table, code, "left").withColumn(out, value).drop("_label")


def cards(records: DataFrame, labels: DataFrame) -> DataFrame:
    """What a result list shows of each record."""
    out = with_label(records, labels, "document_type", "document_type", "type_label")
    out = with_label(out, labels, "publication_stage", "publication_stage", "stage_label")
    return out.select(
        "record_id",
        F.coalesce(F.nullif("title", F.lit("")), F.lit("Untitled")).alias("title"),
        author_line(F.col("authors")).alias("authors"),
        F.coalesce(F.col("publication_year").cast("string"), F.lit("Year not specified")).alias("year"),
        F.coalesce(F.nullif("journal", F.lit("")), F.lit("Journal not specified")).alias("journal"),
        T.doi_url(F.col("doi")).alias("doi_url"),
        "type_label",
        "stage_label",
        F.greatest(F.coalesce(F.size("related"), F.lit(0)), F.lit(0)).cast("long").alias("related_count"),
    )


def edges(records: DataFrame) -> DataFrame:
    """``(src, idx, dst, type)``: the relations of all records."""
    return records.select(F.col("record_id").alias("src"), F.posexplode("related").alias("idx", "r")).select("src", "idx", F.col("r.record_id").alias("dst"), F.col("r.relationship_type").alias("type"))


def related_details(records: DataFrame, labels: DataFrame) -> DataFrame:
    """Each relation with its label and the title of its target, or 'Record not loaded'."""
    named = with_label(edges(records), labels, "relationship_type", "type", "type_label")
    titles = records.select(F.col("record_id").alias("dst"), F.col("title").alias("dst_title"))
    return named.join(titles, "dst", "left").withColumn("dst_title", F.coalesce("dst_title", F.lit("Record not loaded"))).select("src", "idx", "dst", "type", "type_label", "dst_title")


def author_details(records: DataFrame) -> DataFrame:
    """``(record_id, position, name, canonical)``; the canonical name only where it differs."""
    one = records.select("record_id", F.posexplode("authors").alias("position", "a"))
    canonical = F.when(F.col("a.canonical_name") != F.coalesce("a.name", F.lit("")), F.col("a.canonical_name"))
    return one.select("record_id", (F.col("position") + 1).cast("long").alias("position"), F.col("a.name").alias("name"), canonical.alias("canonical"))


def residual(records: DataFrame, known: list[str] = KNOWN) -> DataFrame:
    """``(record_id, key, value)`` of the columns without a place of their own, values as JSON; missing values have no row."""
    extra = [c for c in records.columns if c not in known]
    def shown(c: str) -> Column:
        return F.to_json(F.col(c)) if dict(records.dtypes)[c].startswith(("struct", "array", "map")) else F.col(c).cast("string")
    pairs = F.array(*[F.struct(F.lit(c).alias("key"), shown(c).alias("value")) for c in extra])
    return records.select("record_id", F.inline(pairs)).where("value is not null")
