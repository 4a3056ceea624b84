"""Validation of a collection kept as files: everything from the folder's entries to rules between records, as one table of findings."""

from __future__ import annotations

import datetime
import os
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.operators import schema_rules as S
from colophon.operators import validate as V
from colophon.session import materialize
from colophon.sources import yaml_records as Y

#: A finding, and the file it is about, named from the root of the collection.
COLUMNS = "severity string, code string, message string, path string, line int, record_id string, file string"


@dataclass(frozen=True)
class Layout:
    """Where the parts of a collection are, seen from its root, and how its files call what we call otherwise."""

    records: str = "records"
    vocabularies: str = "vocabularies"
    removed: str = "removed-dois.yaml"
    schema: str = "schema/record.schema.json"
    names: dict[str, str] = field(default_factory=dict)
    id_pattern: str = "^[0-9]{5}$"
    first_id: str = "00001"


def _absent(root: str, part: str, kind: str) -> list[tuple[str, str]]:
    """``(code, file)`` if a file that has to be there is not, or is reached through a link."""
    if Y.linked(root, part):
        return [(f"{kind}.symlink", part)]
    return [] if os.path.isfile(os.path.join(root, part)) else [(f"{kind}.missing", part)]


def load_schema_file(root: str, part: str) -> tuple[dict | None, list[tuple[str, str]]]:
    """The schema, or None and what is wrong with the file."""
    wrong = _absent(root, part, "schema")
    if wrong:
        return None, wrong
    try:
        with open(os.path.join(root, part), "rb") as f:
            return S.compiled(S.load_schema(f.read())), []
    except S.SchemaError as e:
        return None, [(f"schema.{e.code}", part)]


def _about_files(found: DataFrame, message: Column, path: Column, folder: str) -> DataFrame:
    file = F.concat(F.lit(folder + "/"), F.element_at(F.split("path", "/"), -1)) if folder else F.element_at(F.split("path", "/"), -1)
    return found.select(F.lit("error").alias("severity"), "code", message.alias("message"), path.alias("path"), "line", F.lit(None).cast("string").alias("record_id"), file.alias("file"))


def validate_folder(spark: SparkSession, root: str, layout: Layout = Layout(), rules_root: str | None = None, latest_year: int | None = None, artifacts: tuple[str, ...] = ()) -> DataFrame:
    """All findings of the collection under ``root``; schema, vocabularies and removed list may come from another ``rules_root``.

    Files that can't be read have their own findings and take no part in the other rules; without a schema
    it isn't checked, and a vocabulary that can't be read knows no code. A missing folder is a finding, an empty one has none. ``latest_year`` is the current year plus two.
    """
    rules_root = rules_root or root
    latest_year = latest_year or datetime.date.today().year + 2
    schema, early = load_schema_file(rules_root, layout.schema)
    early += Y.artifact_findings(root, list(artifacts))
    there = os.path.isdir(os.path.join(rules_root, layout.vocabularies)) and not Y.linked(rules_root, layout.vocabularies)
    files = [f"{layout.vocabularies}/{f}" for f in Y.VOCABULARIES]
    early += [x for f in files for x in _absent(rules_root, f, "vocabulary")] if there else [("vocabulary.directory_missing", layout.vocabularies)]
    gone = _absent(rules_root, layout.removed, "removed_doi")
    early += gone
    folder = os.path.join(root, layout.records)
    odd = Y.folder_findings(folder, layout.id_pattern.rstrip("$") + r"\.yaml$", layout.first_id)
    early += [(code, name if name == folder else f"{layout.records}/{name}") for code, name in odd]
    links = [name.split(".")[0] for code, name in odd if code == "record.symlink"]
    parts = [spark.createDataFrame([("error", code, code.split(".")[1].replace("_", " "), None, None, None, file) for code, file in early], COLUMNS)]

    vocab = spark.createDataFrame([], "vocabulary string, code string, label string, description string, inverse string, line int")
    if there:
        where = os.path.join(rules_root, layout.vocabularies)
        vocab = materialize(Y.load_vocabularies(spark, where), "vocabularies")
        unread = Y.parse_findings(Y.read_yaml(spark, where).where(F.element_at(F.split("path", "/"), -1).isin(list(Y.VOCABULARIES))), "vocabulary")
        parts.append(_about_files(unread, F.col("message"), F.lit(None).cast("string"), layout.vocabularies))
        parts.append(_about_files(Y.vocabulary_findings(spark, where), F.concat_ws(" ", "code", "detail"), F.col("detail"), layout.vocabularies))
    removed = spark.createDataFrame([], "idx int, doi string, line int")
    if not gone:
        file = os.path.join(rules_root, layout.removed)
        read = Y.read_removed(spark, file)
        parts.append(_about_files(Y.parse_findings(read, "removed_doi"), F.col("message"), F.lit(None).cast("string"), ""))
        no_list = read.where("document is not null and document not like '[%'").select("path", F.lit("removed_doi.root").alias("code"), F.lit(1).alias("line"))
        parts.append(_about_files(no_list, F.lit("no list"), F.lit("$"), ""))
        removed = materialize(Y.load_removed(spark, file), "removed")
    rules = V.Rules(vocab, removed, schema or {}, latest_year, layout.id_pattern)
    parts.append(V.rule_findings(rules).withColumn("file", F.when(F.col("code").startswith("removed_doi."), F.lit(layout.removed)).otherwise(F.lit(layout.vocabularies))))
    if os.path.isdir(folder) and not os.path.islink(folder):
        records = Y.load_records(spark, folder, extra=layout.names, schema=schema).where(F.col("record_id").rlike(layout.id_pattern))
        records = materialize(records.where(~F.col("record_id").isin(links)) if links else records, "records")
        parts.append(_about_files(Y.parse_findings(records), F.col("message"), F.lit(None).cast("string"), layout.records))
        about = V.row_findings(records, rules).unionByName(V.set_findings(records, rules))
        parts.append(about.withColumn("file", F.concat(F.lit(layout.records + "/"), "record_id", F.lit(".yaml"))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def annotations(found: DataFrame) -> DataFrame:
    """``annotation``: one line for each finding, as build services read them, with line and file where they are known."""
    def escaped(text: Column, is_property: bool) -> Column:
        for ch in "%\r\n" + (":," if is_property else ""):
            text = F.replace(text, F.lit(ch), F.lit(f"%{ord(ch):02X}"))
        return text

    where = F.concat_ws(",", F.concat(F.lit("file="), escaped(F.col("file"), True)), F.concat(F.lit("line="), F.col("line")), F.concat(F.lit("title="), escaped(F.col("code"), True)))
    return found.select(F.concat(F.lit("::"), "severity", F.lit(" "), where, F.lit("::"), escaped(F.col("message"), False)).alias("annotation"))


def console(found: DataFrame, record_count: int, shown: int = V.SHOWN) -> str:
    """The report for a terminal: the first findings in order, how many more there are, and the sums."""
    row = V.summary(found).first()
    first = found.orderBy(F.coalesce("file", F.lit("")), F.coalesce("line", F.lit(0)), "severity", "code", "message").limit(shown)
    lines = [f"{r['severity'].upper()} {r['code']} {r['file'] or ''}{':' + str(r['line']) if r['line'] else ''} {r['message']}" for r in first.collect()]
    rest = row["errors"] + row["warnings"] - len(lines)
    lines += [f"{rest} additional findings omitted."] if rest > 0 else []
    return "\n".join([*lines, f"{record_count} records, {row['errors']} errors, {row['warnings']} warnings: {'passed' if row['passed'] else 'failed'}"])
