"""Validation of a whole collection: all rules as one table of findings, with summary and report."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.functions import text as T
from colophon.functions import urls as U
from colophon.operators import constraints as C
from colophon.operators import schema_rules as S
from colophon.sources.yaml_records import line_of

SHOWN = 100
#: Columns of a record that say where it comes from, not what it is.
NOT_CHECKED = ("origin", "added_at", "updated_at")
FINDING = ["severity", "code", "message", "path", "line", "record_id"]


@dataclass(frozen=True)
class Rules:
    """What a collection is checked against; may come from another place than the collection."""

    vocab: DataFrame
    removed: DataFrame
    schema: dict
    latest_year: int
    id_pattern: str = T.RECORD_ID_SHAPE


PROBLEMS = "array<struct<severity:string,code:string,message:string,path:string>>"


def finding(df: DataFrame, severity: str, code: str | Column, message: Column, path: Column) -> DataFrame:
    code = F.lit(code) if isinstance(code, str) else code
    return df.select(F.lit(severity).alias("severity"), code.alias("code"), message.alias("message"), path.alias("path"), F.lit(None).cast("int").alias("line"), "record_id")


def _problem(severity: str, code: str | Column, message: Column, path: Column) -> Column:
    code = F.lit(code) if isinstance(code, str) else code
    return F.struct(F.lit(severity).alias("severity"), code.alias("code"), message.alias("message"), path.alias("path"))


def _when(bad: Column, *problem) -> Column:
    """An array with the problem, or without any."""
    return F.when(F.coalesce(bad, F.lit(False)), F.array(_problem(*problem))).otherwise(F.array().cast(PROBLEMS))


def _each(found: Column, problem) -> Column:
    """A problem for each member of an array; a null array has none."""
    return F.coalesce(F.transform(found, problem), F.array().cast(PROBLEMS))


def _at(field: str, position: Column) -> Column:
    return F.concat(F.lit(f"$.{field}["), position.cast("string"), F.lit("]"))


def _later(keys: Column) -> Column:
    """Members of an array of struct(key, at) that repeat the key of another one before them; sorted, so the cost stays low."""
    ordered = F.array_sort(keys)
    return F.filter(ordered, lambda x, i: (i > 0) & (x["key"] == F.get(ordered, i - 1)["key"]))


def _author_problems() -> Column:
    """Authors whose canonical name equals the name, and authors named twice (column _author_keys)."""
    text = F.lit
    redundant = F.filter(F.transform("authors", lambda a, i: F.struct((a["canonical_name"] == a["name"]).alias("bad"), i.alias("at"))), lambda x: x["bad"])
    keyed = F.filter(F.transform("_author_keys", lambda k, i: F.struct(k.alias("key"), i.alias("at"))), lambda x: x["key"] != "")
    repeated = _later(keyed)
    first = lambda x: (F.array_position(F.col("_author_keys"), x["key"]) - 1).cast("string")
    return F.concat(
        _each(redundant, lambda x: _problem("error", "record.redundant_canonical_name", text("canonical name equals name"), _at("authors", x["at"]))),
        _each(repeated, lambda x: _problem("error", "record.duplicate_author", F.concat(text("author also at "), first(x)), _at("authors", x["at"]))),
    )


def _relation_problems() -> Column:
    """Relations to oneself, and relations that were stated before."""
    text = F.lit
    placed = F.transform("related", lambda r, i: F.struct(r["record_id"].alias("dst"), r["relationship_type"].alias("type"), i.alias("at")))
    own = F.filter(placed, lambda x: x["dst"] == F.col("record_id"))
    whole = F.filter(placed, lambda x: x["dst"].isNotNull() & x["type"].isNotNull())
    repeated = _later(F.transform(whole, lambda x: F.struct(F.struct(x["dst"].alias("dst"), x["type"].alias("type")).alias("key"), x["at"].alias("at"))))
    return F.concat(
        _each(own, lambda x: _problem("error", "record.self_relationship", text("a relation of a record to itself"), _at("related", x["at"]))),
        _each(repeated, lambda x: _problem("error", "record.duplicate_relationship", F.concat(x["key"]["type"], text(" to "), x["key"]["dst"], text(" is stated before")), _at("related", x["at"]))),
    )


def _line_problems() -> Column:
    """Blank, padded and multi-line values of the fields that hold one line."""
    def about(code: str, bad) -> Column:
        return F.transform(F.filter(C.line_pairs(), lambda x: F.coalesce(bad(x["value"]), F.lit(False))), lambda x: _problem("error", f"record.{code}", F.concat(F.lit(f"{code} at "), x["path"]), x["path"]))
    return F.concat(about("blank_string", T.is_blank), about("whitespace", T.is_padded), about("multiline_value", T.is_multiline))


def _note_problems() -> Column:
    """Blank notes, addresses that aren't public, and references to private places in what is left of a note (column _scanned).

    One error a note for private references, whatever their number; the warning comes only without one.
    """
    path, text = F.lit("$.record_notes"), F.col("_scanned.text")
    says = lambda code: F.concat(code, F.lit(" in the notes"))
    codes = F.transform(F.array_distinct("_scanned.codes"), lambda c: F.concat(F.lit("record."), c))
    return F.concat(
        _each(codes, lambda c: _problem("error", c, says(c), path)),
        *[_when(bad, severity, code, says(F.lit(code)), path) for severity, code, bad in (
            ("error", "record.blank_string", T.is_blank(F.col("record_notes"))),
            ("error", "record.private_reference", F.col("_private").isNotNull()),
            ("warning", "record.possible_private_reference", F.col("_private").isNull() & text.rlike(U.POSSIBLE_DRIVE_PATH)),
        )],
    )


def row_findings(records: DataFrame, rules: Rules) -> DataFrame:
    """Rules that one record settles alone: schema, future years, lines, authors and relations within, notes.

    All of them are expressions of one projection over one scan. Records read from files are those that could be read as a
    mapping; their findings have lines.
    """
    text = F.lit
    read = "is_mapping" in records.columns
    rows = records.where("is_mapping") if read else records
    names = F.transform("authors", lambda a: F.coalesce(a["canonical_name"], a["name"]))
    rows = rows.withColumn("_author_keys", T.norm_texts(names)).withColumn("_scanned", U.scanned(F.col("record_notes")))
    rows = rows.withColumn("_private", U.private_reference(F.col("_scanned.text")))
    schema = F.col("broken") if read else S.violations_column(records, rules.schema, {"record_id", *NOT_CHECKED})
    year = F.col("publication_year")
    found = F.concat(
        _each(schema, lambda v: _problem("error", v["code"], F.concat(v["code"], text(" at "), v["path"]), v["path"])),
        _when(year > rules.latest_year, "error", "record.publication_year_future", F.concat(text("publication year "), year.cast("string")), text("$.publication_year")),
        _when(~F.col("record_id").rlike(rules.id_pattern), "error", "record.filename", F.concat(text("no record id: "), F.col("record_id")), text("$")),
        _line_problems(), _author_problems(), _relation_problems(), _note_problems(),
    )
    each = rows.select("record_id", *(["lines"] if read else []), F.inline(found))
    line = line_of(F.col("lines"), F.col("path")) if read else F.lit(None).cast("int")
    return each.select("severity", "code", "message", "path", line.alias("line"), "record_id")


def with_lines(found: DataFrame, records: DataFrame) -> DataFrame:
    """Findings about records with the lines of what they are about, where the records were read from files."""
    if "lines" not in records.columns:
        return found
    placed = found.join(records.where("is_mapping").select("record_id", "lines"), "record_id", "left")
    return placed.select("severity", "code", "message", "path", F.when(F.col("lines").isNotNull(), line_of(F.col("lines"), F.col("path"))).alias("line"), "record_id")


def set_findings(records: DataFrame, rules: Rules) -> DataFrame:
    """Rules between records, and between records and lists."""
    text = lambda s: F.lit(s)
    source = records
    records = records.where("is_mapping") if "is_mapping" in records.columns else records
    parts = [
        finding(C.unknown_codes(records, rules.vocab), "error", F.when(F.col("vocabulary") == "relationship_type", text("record.unknown_relationship_type")).otherwise(text("record.unknown_vocabulary_value")), F.concat(F.col("code"), text(" is not in "), F.col("vocabulary")), F.col("path")),
        finding(C.duplicate_ids(records), "error", "record.duplicate_id", F.concat(F.col("n"), text(" records have this id")), text("$")),
        finding(C.removed_keys(records, rules.removed), "error", "database.removed_doi", F.concat(F.col("doi"), text(" was removed")), text("$.doi")),
        finding(C.duplicate_dois(records), "error", "database.duplicate_doi", F.concat(F.col("members"), text(" records have "), F.col("doi_key")), text("$.doi")),
        finding(C.possible_duplicates(records), "warning", "database.possible_duplicate", F.concat(F.col("members"), text(" records share title and year")), text("$.title")),
        finding(C.target_missing(records).withColumnRenamed("src", "record_id"), "error", "relationship.target_missing", F.concat(F.col("dst"), text(" does not exist")), F.concat(text("$.related["), F.col("idx"), text("]"))),
        finding(C.reciprocity(records, rules.vocab).withColumnRenamed("src", "record_id"), "error", "relationship.inverse_count", F.concat(F.col("dst"), text(" states "), F.col("inverse"), text(" "), F.col("found"), text(" times")), F.concat(text("$.related["), F.col("idx"), text("]"))),
    ]
    return with_lines(reduce(DataFrame.unionByName, parts), source)


def rule_findings(rules: Rules) -> DataFrame:
    """What is wrong with the lists themselves; lists that were read from files bring the lines of their entries (column line)."""
    none = F.lit(None).cast("string")
    inverses = C.vocabulary_inverses(rules.vocab).withColumn("vocabulary", F.lit("relationship_type")).withColumn("record_id", none)
    removed = C.removed_list_problems(rules.removed).withColumn("record_id", none)
    labels = C.duplicate_labels(rules.vocab).withColumn("record_id", none)
    parts = [
        _lined(inverses, rules.vocab, ["vocabulary", "code"], F.concat(F.lit("relationship."), F.col("problem")), F.col("code"), F.col("vocabulary")),
        _lined(removed, rules.removed, ["idx"], F.concat(F.lit("removed_doi."), F.col("problem")), F.concat(F.lit("entry "), F.col("idx")), F.concat(F.lit("$["), F.col("idx"), F.lit("]"))),
        _lined(labels, rules.vocab, ["vocabulary", "code"], F.lit("vocabulary.duplicate_label"), F.col("label"), F.col("vocabulary")),
    ]
    if "line" not in rules.vocab.columns:  # the reader of files has looked at the codes
        odd = rules.vocab.where(~F.col("code").rlike(T.VOCABULARY_CODE_SHAPE)).withColumn("record_id", none)
        parts.append(finding(odd, "error", "vocabulary.key", F.col("code"), F.col("vocabulary")))
    return reduce(DataFrame.unionByName, parts)


def _lined(found: DataFrame, source: DataFrame, keys: list[str], code: Column, message: Column, path: Column) -> DataFrame:
    if "line" not in source.columns:
        return finding(found, "error", code, message, path)
    placed = found.join(source.select(*keys, F.col("line").cast("int").alias("line")), keys, "left")
    return placed.select(F.lit("error").alias("severity"), code.alias("code"), message.alias("message"), path.alias("path"), "line", "record_id")


def findings(records: DataFrame, rules: Rules) -> DataFrame:
    """All findings; no order."""
    return rule_findings(rules).unionByName(row_findings(records, rules)).unionByName(set_findings(records, rules))


def order(found: DataFrame) -> list[Column]:
    """Order of a report: path of the record, line, errors before warnings, code, message."""
    return [F.coalesce("record_id", F.lit("")), F.coalesce("path", F.lit("")), F.coalesce("line", F.lit(0)), F.when(F.col("severity") == "error", 0).otherwise(1), F.col("code"), F.col("message")]


def summary(found: DataFrame) -> DataFrame:
    """``(errors, warnings, passed)``."""
    row = found.agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    return row.withColumn("passed", F.col("errors") == 0)


def by_code(found: DataFrame) -> DataFrame:
    return found.groupBy("severity", "code").agg(F.count(F.lit(1)).alias("n"))


def passed(found: DataFrame) -> bool:
    return found.where("severity = 'error'").isEmpty()


def annotation(text: str, is_property: bool = False) -> str:
    """Text escaped for a line of annotations; properties also lose colon and comma."""
    for ch in "%\r\n" + (":," if is_property else ""):
        text = text.replace(ch, f"%{ord(ch):02X}")
    return text


def markdown(found: DataFrame, record_count: int, title: str = "Validation") -> str:
    """A report: counts, and the first SHOWN findings in order with the number of those left out."""
    row = summary(found).first()
    lines = [f"# {title}", "", f"{record_count} records, {row['errors']} errors, {row['warnings']} warnings: {'passed' if row['passed'] else 'failed'}", "", "| severity | code | record | path | message |", "| --- | --- | --- | --- | --- |"]
    for r in found.orderBy(*order(found)).limit(SHOWN).collect():
        cells = [str(r[c] or "").replace("|", "\\|").replace("\n", " ") for c in ("severity", "code", "record_id", "path", "message")]
        lines.append("| " + " | ".join(cells) + " |")
    rest = row["errors"] + row["warnings"] - SHOWN
    return "\n".join(lines + ([f"", f"{rest} additional findings omitted."] if rest > 0 else [])) + "\n"
