"""Constraints within and between records, each as a table of its violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colophon.functions import text as T
from colophon.operators.search import edges
from colophon.operators.skew import lookup_join
from colophon.session import materialize

# Fields whose codes come from a vocabulary, and fields that hold one line.
CODED = {"document_type": "document_type", "publication_stage": "publication_stage", "language_status": "language_status", "record_status": "record_status"}
FILES = ["main_pdf", "supplementary_material", "full_text_html"]
LINES = ["document_type", "publication_stage", "title", "doi", "journal", "language_status", "record_status"]


def codes(vocab: DataFrame, vocabulary: str) -> DataFrame:
    return vocab.where(F.col("vocabulary") == vocabulary).select("code").distinct()


def coded_values(records: DataFrame) -> DataFrame:
    """``(record_id, path, vocabulary, code)`` of all values that a vocabulary governs; missing values have no row."""
    pairs = [F.struct(F.lit(f"$.{c}").alias("path"), F.lit(v).alias("vocabulary"), F.col(c).alias("code")) for c, v in CODED.items()]
    pairs += [F.struct(F.lit(f"$.file_status.{c}").alias("path"), F.lit("file_status").alias("vocabulary"), F.col(f"file_status.{c}").alias("code")) for c in FILES]
    related = F.transform(F.coalesce("related", F.array().cast("array<struct<record_id:string,relationship_type:string>>")), lambda r, i: F.struct(F.concat(F.lit("$.related["), i.cast("string"), F.lit("].relationship_type")).alias("path"), F.lit("relationship_type").alias("vocabulary"), r["relationship_type"].alias("code")))
    return records.select("record_id", F.inline(F.concat(F.array(*pairs), related))).where("code is not null")


def unknown_codes(records: DataFrame, vocab: DataFrame) -> DataFrame:
    """Coded values that their vocabulary lacks: one anti join for all fields. Vocabularies are short fixed lists."""
    known = F.broadcast(vocab.select("vocabulary", "code").distinct())
    return coded_values(records).join(known, ["vocabulary", "code"], "left_anti").select("record_id", "path", "vocabulary", "code")


def vocabulary_inverses(vocab: DataFrame) -> DataFrame:
    """``(code, inverse, problem)``: inverses that are missing or don't lead back."""
    types = vocab.where("vocabulary = 'relationship_type'").select("code", "inverse")
    back = types.select(F.col("code").alias("inverse"), F.col("inverse").alias("back"), F.lit(True).alias("there"))
    checked = types.join(back, "inverse", "left")
    problem = F.when(F.col("there").isNull(), F.lit("inverse_missing")).when(~F.col("back").eqNullSafe(F.col("code")), F.lit("inverse_not_reciprocal"))
    return checked.select("code", "inverse", problem.alias("problem")).where("problem is not null")


def duplicate_labels(vocab: DataFrame) -> DataFrame:
    """Labels used twice in a vocabulary, after normalisation; each later use with the first code."""
    keyed = vocab.withColumn("key", T.norm_text(F.col("label")))
    first = keyed.groupBy("vocabulary", "key").agg(F.min("code").alias("first_code"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return keyed.join(first, ["vocabulary", "key"]).where("code <> first_code").select("vocabulary", "code", "label", "first_code")


def target_missing(records: DataFrame) -> DataFrame:
    """Relations to records that don't exist."""
    e = edges(records)
    return e.join(records.select(F.col("record_id").alias("dst")).distinct(), "dst", "left_anti").select("src", "idx", "dst", "type")


def reciprocity(records: DataFrame, vocab: DataFrame) -> DataFrame:
    """``(src, idx, dst, type, inverse, found)``: relations whose target does not hold exactly one inverse relation.

    Relations to oneself, of unknown type or to missing records are other checks' business.
    """
    e = edges(records)
    types = F.broadcast(vocab.where("vocabulary = 'relationship_type' and inverse is not null").select(F.col("code").alias("type"), "inverse"))
    there = records.select(F.col("record_id").alias("dst")).distinct()
    asked = e.where("src <> dst").join(types, "type").join(there, "dst", "left_semi")
    held = e.groupBy(F.col("src").alias("dst"), F.col("dst").alias("src"), F.col("type").alias("inverse")).agg(F.count(F.lit(1)).alias("found"))
    return asked.join(held, ["src", "dst", "inverse"], "left").withColumn("found", F.coalesce("found", F.lit(0).cast("long"))).where("found <> 1").select("src", "idx", "dst", "type", "inverse", "found")


def self_relations(records: DataFrame) -> DataFrame:
    return edges(records).where("src = dst")


def duplicate_relations(records: DataFrame) -> DataFrame:
    """Relations stated more than once within a record, with how often."""
    return edges(records).groupBy("src", "dst", "type").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def removed_keys(records: DataFrame, removed: DataFrame) -> DataFrame:
    """Active records whose normalised DOI is on the removed list: a semi join, whose build side the planner picks by size."""
    gone = removed.where("doi is not null").select(T.norm_doi(F.col("doi")).alias("key")).distinct()
    return records.where("doi is not null").withColumn("key", T.norm_doi(F.col("doi"))).join(gone, "key", "left_semi").select("record_id", "doi")


def removed_list_problems(removed: DataFrame) -> DataFrame:
    """``(idx, problem)`` of the removed list: entries that are null, no DOI, or repeat an earlier one."""
    keyed = removed.select("idx", "doi", T.norm_doi(F.col("doi")).alias("key"))
    first = keyed.where("key is not null").groupBy("key").agg(F.min("idx").alias("first_idx"))
    joined = keyed.join(first, "key", "left")
    bad = F.array_compact(F.array(
        F.when(F.col("doi").isNull(), F.lit("entry")),
        F.when(~F.col("doi").rlike(T.DOI_SHAPE), F.lit("syntax")),
        F.when(F.col("first_idx") < F.col("idx"), F.lit("duplicate")),
    ))
    return joined.select("idx", F.explode(bad).alias("problem"))


def shared_key(records: DataFrame, key: Column | list[Column], id_col: str = "record_id") -> DataFrame:
    """``(id, key…, members)``: the rows whose key others have too, with how many have it; rows with a null in the key are left out.

    Keys are made once and written; groups are counted from them, and the rows then find their group by a join that spreads
    the rows of a hot key.
    """
    keys = key if isinstance(key, list) else [key]
    names = [f"key{i}" for i in range(len(keys))]
    keyed = records.select(F.col(id_col), *[k.alias(n) for k, n in zip(keys, names)]).where(" and ".join(f"{n} is not null" for n in names))
    keyed = materialize(keyed, "keyed")
    groups = keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("members"), F.min(id_col).alias("first_id")).where("members > 1")
    return lookup_join(keyed, materialize(groups, "groups"), names, "members")


def duplicate_ids(records: DataFrame) -> DataFrame:
    """Ids that several records have, with how many; null ids are another check's business."""
    return records.where("record_id is not null").groupBy("record_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def duplicate_dois(records: DataFrame) -> DataFrame:
    found = shared_key(records, T.norm_doi(F.col("doi")))
    return found.select("record_id", F.col("key0").alias("doi_key"), "members", "first_id")


def possible_duplicates(records: DataFrame) -> DataFrame:
    found = shared_key(records, [T.norm_title(F.col("title")), F.col("publication_year")])
    return found.select("record_id", F.col("key0").alias("title_key"), F.col("key1").alias("publication_year"), "members", "first_id")


def duplicate_authors(records: DataFrame) -> DataFrame:
    """``(record_id, position, first_position)``: authors that a record names twice, by normalised canonical name or name."""
    one = records.select("record_id", F.posexplode("authors").alias("position", "a")).select("record_id", "position", T.norm_text(F.coalesce("a.canonical_name", "a.name")).alias("key"))
    one = one.where("key is not null and key <> ''")
    first = one.groupBy("record_id", "key").agg(F.min("position").alias("first_position"))
    return one.join(first, ["record_id", "key"]).where("position > first_position").select("record_id", "position", "first_position")


def redundant_canonical(records: DataFrame) -> DataFrame:
    one = records.select("record_id", F.posexplode("authors").alias("position", "a"))
    return one.where("a.canonical_name = a.name").select("record_id", "position")


def line_pairs() -> Column:
    """Array of ``struct(path, value)`` of all fields that hold one line."""
    def pair(path: str, value: Column) -> Column:
        return F.struct(F.lit(path).alias("path"), value.alias("value"))
    fixed = [pair(f"$.{c}", F.col(c)) for c in LINES] + [pair(f"$.file_status.{c}", F.col(f"file_status.{c}")) for c in FILES]
    none = F.array().cast("array<struct<path:string,value:string>>")
    def listed(column: str, member: str) -> Column:
        return F.coalesce(F.transform(column, lambda x, i: F.struct(F.concat(F.lit(f"$.{column}["), i.cast("string"), F.lit(f"].{member}")).alias("path"), x[member].alias("value"))), none)
    lists = [listed("authors", "name"), listed("authors", "canonical_name"), listed("related", "record_id"), listed("related", "relationship_type")]
    return F.concat(F.array(*fixed), *lists)


def line_values(records: DataFrame) -> DataFrame:
    """``(record_id, path, value)`` of all fields that hold one line."""
    return records.select("record_id", F.inline(line_pairs())).where("value is not null")


def line_problems(records: DataFrame) -> DataFrame:
    """``(record_id, path, problem)``: blank, padded and multi-line values."""
    v = F.col("value")
    bad = F.array_compact(F.array(F.when(T.is_blank(v), F.lit("blank_string")), F.when(T.is_padded(v), F.lit("whitespace")), F.when(T.is_multiline(v), F.lit("multiline_value"))))
    return line_values(records).select("record_id", "path", F.explode(bad).alias("problem"))


def id_ranges(ids: DataFrame, column: str) -> DataFrame:
    """``(lo, hi, n)``: runs of consecutive numbers.

    Numbers are cut into blocks of equal range, so that runs are found block by block; runs that meet at the borders are then
    joined, over as many rows as there are borders in runs.
    """
    n = ids.select(F.col(column).cast("long").alias("v")).where("v is not null").distinct()
    block = 1_000_000
    inner = Window.partitionBy("b").orderBy("v")
    part = n.withColumn("b", F.floor(F.col("v") / block)).withColumn("g", F.col("v") - F.row_number().over(inner))
    runs = part.groupBy("b", "g").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    inside = runs.where((F.col("lo") % block != 0) & (F.col("hi") % block != block - 1))
    border = runs.where((F.col("lo") % block == 0) | (F.col("hi") % block == block - 1))
    order = Window.orderBy("lo")
    starts = border.withColumn("s", (F.col("lo") != F.coalesce(F.lag("hi").over(order) + 1, F.lit(-1))).cast("int")).withColumn("run", F.sum("s").over(order))
    joined = starts.groupBy("run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    both = inside.select("lo", "hi").unionByName(joined.select("lo", "hi"))
    return both.withColumn("n", F.col("hi") - F.col("lo") + 1)


def compressed_ids(ranges: DataFrame, width: int = 5) -> str:
    """Runs as text, '00001–00003, 00005'; 'None' without any. For a report: collects one row a run."""
    shown = [f"{r['lo']:0{width}d}" if r["lo"] == r["hi"] else f"{r['lo']:0{width}d}–{r['hi']:0{width}d}" for r in ranges.orderBy("lo").collect()]
    return ", ".join(shown) or "None"


def numbered(rows: DataFrame, order_col: str, partition: str | None = None) -> DataFrame:
    """Rows with ``number``, counted from 0 in the order of ``order_col`` within ``partition``.

    Rows are cut into ranges of (partition, order), ranges are counted, and each row is numbered within its range from where the
    range begins, so that a partition with a third of all rows, or the whole table, is never ordered by one task. The offsets
    have a row for each partition and range. Rows of equal order are numbered in any order; nulls of ``partition`` are one partition.
    """
    keys = [partition] if partition else []
    ranged = rows.repartitionByRange(*keys, order_col).withColumn("_range", F.spark_partition_id())
    ranged = materialize(ranged, "ranged")
    counts = ranged.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_range").alias("_at"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    same = F.col("_range") == F.col("_at")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    inside = F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(order_col))
    placed = ranged.join(offsets, same).withColumn("number", (F.col("_offset") + inside - 1).cast("long"))
    return placed.select(*rows.columns, "number")


def grid(rows: DataFrame, order_col: str, per_sheet: int, columns: int, partition: str | None = None) -> DataFrame:
    """Places rows on sheets: ``(…, number, sheet, grid_row, grid_column)``, counted in the order of ``order_col`` within ``partition``."""
    n = numbered(rows, order_col, partition)
    on_sheet = F.col("number") % per_sheet
    return n.withColumn("sheet", F.floor(F.col("number") / per_sheet) + 1).withColumn("grid_row", F.floor(on_sheet / columns)).withColumn("grid_column", on_sheet % columns)
