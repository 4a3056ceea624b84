"""One-document-per-file collections: strict reading of YAML files into typed rows with line numbers and issues."""

from __future__ import annotations

import json
import math
import os
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from colophon.functions import text as T
from colophon.operators.schema_rules import violations_of

MAX_DEPTH = 100
PARSED = "path string, document string, fields string, lines map<string,int>, issues array<struct<code string, message string, line int>>, is_mapping boolean, broken array<struct<code string, path string>>"
#: What reading adds to the fields of a record.
PARSE_COLUMNS = ["lines", "path", "issues", "is_mapping", "broken"]
# The vocabulary files and the fields of their entries.
VOCABULARIES = {
    "document-types.yaml": ("document_type", ["label", "description"]),
    "file-statuses.yaml": ("file_status", ["label", "description"]),
    "language-statuses.yaml": ("language_status", ["label", "description"]),
    "publication-stages.yaml": ("publication_stage", ["label", "description"]),
    "record-statuses.yaml": ("record_status", ["label", "description"]),
    "relationship-types.yaml": ("relationship_type", ["label", "description", "inverse"]),
}
RECORD = (
    "document_type string, publication_stage string, title string, authors array<struct<name:string,canonical_name:string>>, doi string, "
    "publication_year double, journal string, language_status string, file_status struct<main_pdf:string,supplementary_material:string,full_text_html:string>, "
    "record_status string, related array<struct<record_id:string,relationship_type:string>>, record_notes string"
)


def _struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def path_text(parts: tuple) -> str:
    """A value path as text: $.authors[0].name."""
    return "$" + "".join(f"[{p}]" if isinstance(p, int) else f".{p}" for p in parts)


def _loader():
    import yaml

    return getattr(yaml, "CSafeLoader", yaml.SafeLoader)


class _Reader:
    """Plain values from the events of one document, without building its node graph.

    ``lines`` has the line of each value path, ``issues`` repeated and odd keys and bad scalars, ``anomaly`` the first thing that
    makes the document as a whole unusable: an alias that leads into itself, nesting beyond MAX_DEPTH, or any alias.
    """

    PLAIN = ("tag:yaml.org,2002:map", "tag:yaml.org,2002:seq", "tag:yaml.org,2002:set", "tag:yaml.org,2002:omap", "!")

    def __init__(self):
        import yaml

        self.yaml, self.resolver = yaml, yaml.SafeLoader("")
        self.lines: dict[str, int] = {}
        self.issues: list[tuple[str, str, int]] = []
        self.anomaly: tuple[str, int] | None = None
        self.anchors: dict[str, int] = {}
        self.open: list[dict] = []
        self.root = None

    def _place(self) -> tuple | None:
        """Path of the value that comes next; None for a key and for what belongs to a key that is left out."""
        if not self.open:
            return ()
        frame = self.open[-1]
        if frame["path"] is None:
            return None
        if frame["keyed"]:
            return (*frame["path"], frame["key"]) if frame["key"] is not None else None
        return None if frame["mapping"] else (*frame["path"], len(frame["values"]))

    def _key_expected(self) -> bool:
        return bool(self.open) and self.open[-1]["mapping"] and not self.open[-1]["keyed"]

    def _put(self, value) -> None:
        if not self.open:
            self.root = value
            return
        frame = self.open[-1]
        if not frame["mapping"]:
            frame["values"].append(value)
        else:
            if frame["key"] is not None:
                frame["values"][frame["key"]] = value
            frame["keyed"] = False

    def _put_key(self, node, line: int) -> None:
        frame = self.open[-1]
        frame["keyed"], frame["key"] = True, None
        if frame["path"] is None:
            return
        try:
            key = None if node is None else (self.resolver.construct_object(node, deep=True),)
        except Exception:  # a scalar that isn't what its tag says; there is no common class for that
            key = None
        if key is None:
            self.issues.append(("yaml", "a key that is no plain value", line))
            return
        name = key[0]
        if not isinstance(name, str):
            self.issues.append(("non_string_key", f"key {name!r} is no text", line))
            name = str(name)
        if name in frame["values"]:
            self.issues.append(("yaml", f"key {name!r} is repeated", line))
        frame["key"] = name
        self.lines[path_text((*frame["path"], name))] = line

    def _scalar(self, event):
        tag = event.tag
        if tag is None or tag == "!":
            tag = self.resolver.resolve(self.yaml.ScalarNode, event.value, event.implicit)
        return self.yaml.ScalarNode(tag, event.value, event.start_mark, event.end_mark)

    def take(self, event) -> None:
        yaml, line = self.yaml, event.start_mark.line + 1
        if isinstance(event, yaml.CollectionEndEvent):
            done = self.open.pop()
            if done["of_key"]:
                self.open[-1]["keyed"] = True  # its value is left out as well
            else:
                self._put(done["values"])
            return
        if not isinstance(event, yaml.NodeEvent):
            return
        if isinstance(event, yaml.AliasEvent):
            if event.anchor not in self.anchors:
                self.issues.append(("yaml", f"alias {event.anchor!r} leads nowhere", line))
            elif self.anomaly is None or self.anomaly[0] == "alias":
                inside = any(frame["anchor"] == event.anchor for frame in self.open)
                self.anomaly = ("recursive_alias", self.anchors[event.anchor]) if inside else self.anomaly or ("alias", self.anchors[event.anchor])
            self._put_key(None, line) if self._key_expected() else self._put(None)
            return
        if event.anchor:
            self.anchors[event.anchor] = line
        if len(self.open) >= MAX_DEPTH and (self.anomaly is None or self.anomaly[0] == "alias"):
            self.anomaly = ("nesting_depth", line)
        key, path = self._key_expected(), self._place()
        if path is not None:
            self.lines[path_text(path)] = line
        if isinstance(event, yaml.ScalarEvent):
            self._put_key(self._scalar(event), line) if key else self._put(self._value(event, path, line))
            return
        if event.tag is not None and event.tag not in self.PLAIN:
            self.issues.append(("yaml", f"unknown tag {event.tag}", line))
        if key:
            self._put_key(None, line)
            self.open[-1]["keyed"] = False  # what the key holds comes first
        mapping = isinstance(event, yaml.MappingStartEvent)
        self.open.append({"mapping": mapping, "values": {} if mapping else [], "path": path, "anchor": event.anchor, "keyed": False, "key": None, "of_key": key})

    def _value(self, event, path: tuple | None, line: int):
        if path is None:
            return None
        try:
            value = self.resolver.construct_object(self._scalar(event), deep=True)
        except Exception as e:
            self.issues.append(("yaml", f"bad scalar: {e}".split("\n")[0], line))
            return None
        return value


def read_document(data: bytes) -> tuple[object, dict[str, int], list[tuple[str, str, int]]]:
    """The one document in the data as plain values, lines by path, and issues as (code, message, line); with a fatal issue the value is None."""
    import yaml

    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError as e:
        return None, {}, [("encoding", str(e), 1)]
    documents, reader = 0, _Reader()
    try:
        for event in yaml.parse(text, _loader()):
            documents += isinstance(event, yaml.DocumentStartEvent)
            if documents == 1:
                reader.take(event)
    except yaml.YAMLError as e:
        mark = getattr(e, "problem_mark", None)
        return None, {}, [("yaml", str(e).split("\n")[0], mark.line + 1 if mark else 1)]
    except RecursionError:
        return None, {}, [("nesting_depth", "nested too deeply", 1)]
    if documents != 1:
        return None, {}, [("document_count", f"{documents} documents", 1)]
    if reader.anomaly and reader.anomaly[0] != "alias":
        return None, {}, [(reader.anomaly[0], reader.anomaly[0].replace("_", " "), reader.anomaly[1])]
    fatal = [i for i in reader.issues if i[0] == "yaml"]
    if fatal or reader.anomaly:
        return None, reader.lines, fatal or [("alias", "alias", reader.anomaly[1])]
    return reader.root, reader.lines, reader.issues


def fit(value: object, kind: DataType) -> object:
    """The value without what isn't of its kind: such parts become null, and so do members that the kind lacks."""
    if isinstance(kind, StructType):
        return {f.name: fit(value.get(f.name), f.dataType) for f in kind.fields} if isinstance(value, dict) else None
    if isinstance(kind, ArrayType):
        return [fit(v, kind.elementType) for v in value] if isinstance(value, list) else None
    if isinstance(kind, StringType):
        return value if isinstance(value, str) else None
    return value if isinstance(value, (int, float)) and not isinstance(value, bool) and math.isfinite(value) else None


def file_parser(kind: StructType | None = None, schema: dict | None = None, names: dict[str, str] | None = None):
    """A function for mapInPandas that reads files as PARSED; ``names`` gives our names of the keys of the files."""
    names = names or {}

    def one(content: bytes) -> tuple:
        value, lines, issues = read_document(content)
        mapping = isinstance(value, dict)
        broken = []
        if schema is not None and mapping and not any(code == "non_string_key" for code, _, _ in issues):
            broken = sorted(set(violations_of(schema, value)), key=lambda v: (v[1], v[0]))
        if mapping and names:
            for theirs, ours in names.items():
                lines |= {f"$.{ours}" + p[len(theirs) + 2 :]: n for p, n in lines.items() if re.match(rf"\$\.{re.escape(theirs)}(?![^.\[])", p)}
            value = {names.get(k, k): v for k, v in value.items()}
        fatal = value is None and bool(issues)
        document = None if fatal else json.dumps(value, ensure_ascii=False, default=str)
        fields = json.dumps(fit(value, kind), ensure_ascii=False) if kind is not None and mapping else None
        shown = [{"code": c, "message": m, "line": n} for c, m, n in issues]
        return document, fields, lines, shown, mapping, [{"code": c, "path": p} for c, p in broken]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(path, *one(bytes(content))) for path, content in zip(batch["path"], batch["content"])]
            yield pd.DataFrame(rows, columns=["path", "document", "fields", "lines", "issues", "is_mapping", "broken"])

    return run


def read_yaml(spark: SparkSession, folder: str, pattern: str = "*.yaml", **how) -> DataFrame:
    """One row a file with PARSED columns; a file that can't be read has a null document and an issue."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "content")
    return files.mapInPandas(file_parser(**how), PARSED)


def line_of(lines: Column, path: Column) -> Column:
    """Line of a value path: its own, else that of the nearest value around it, else 1."""
    steps = F.regexp_extract_all(path, F.lit(r"^\$|\.[^.\[\]]*|\[\d+\]"), F.lit(0))
    outwards = F.transform(F.sequence(F.size(steps), F.lit(1), F.lit(-1)), lambda n: F.element_at(lines, F.array_join(F.slice(steps, F.lit(1), n), "")))
    around = F.when(F.size(steps) > 0, F.get(F.filter(outwards, lambda x: x.isNotNull()), F.lit(0)))
    return F.coalesce(F.element_at(lines, path), around, F.lit(1))


def load_records(spark: SparkSession, folder: str, mode: str = "PERMISSIVE", extra: dict[str, str] | None = None, schema: dict | None = None) -> DataFrame:
    """Records of a folder: ``record_id``, the typed fields, raw (VARIANT), lines, path, issues, is_mapping and broken (what breaks the schema).

    A value that isn't of its field's type is null in the field and stays in raw. ``extra`` renames keys of the files to ours.
    PERMISSIVE keeps files that can't be read with null fields; FAILFAST raises.
    """
    parsed = read_yaml(spark, folder, kind=_struct(RECORD), schema=schema, names=extra)
    if mode == "FAILFAST":
        parsed = parsed.withColumn("fields", F.when(F.col("is_mapping"), F.col("fields")).otherwise(F.raise_error(F.concat(F.lit("can't read "), F.col("path")))))
    typed = parsed.withColumn("r", F.from_json("fields", RECORD))
    return typed.select(F.regexp_extract("path", r"([0-9]+)\.yaml$", 1).alias("record_id"), "r.*", F.try_parse_json("document").alias("raw"), *PARSE_COLUMNS)


def parse_findings(parsed: DataFrame, kind: str = "record") -> DataFrame:
    """``(severity, code, message, path, line)`` of files that couldn't be read as one mapping; path is the file's."""
    issue = parsed.select("path", F.explode("issues").alias("i")).select(F.lit("error").alias("severity"), F.concat(F.lit(f"{kind}."), F.col("i.code")).alias("code"), F.col("i.message").alias("message"), "path", F.col("i.line").alias("line"))
    if kind != "record":
        return issue
    unread = F.exists("issues", lambda i: i["code"] != "non_string_key")
    root = parsed.where(~F.col("is_mapping") & ~unread).select(F.lit("error").alias("severity"), F.lit("record.root").alias("code"), F.lit("no mapping").alias("message"), "path", F.lit(1).alias("line"))
    return issue.unionByName(root)


def load_vocabularies(spark: SparkSession, folder: str) -> DataFrame:
    """``(vocabulary, code, label, description, inverse, line)`` of the vocabulary files that can be read."""
    names = {file: name for file, (name, _) in VOCABULARIES.items()}
    parsed = read_yaml(spark, folder).withColumn("file", F.element_at(F.split("path", "/"), -1)).where(F.col("file").isin(list(names)))
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    entries = parsed.where("is_mapping").select(F.element_at(table, F.col("file")).alias("vocabulary"), "lines", F.explode(F.from_json("document", "map<string,variant>")).alias("code", "e"))
    entries = entries.where(F.schema_of_variant("e").startswith("OBJECT<"))
    fields = [text_of(F.try_variant_get("e", f"$.{f}", "variant")).alias(f) for f in ("label", "description", "inverse")]
    return entries.select("vocabulary", "code", *fields, F.element_at("lines", F.concat(F.lit("$."), F.col("code"))).alias("line"))


def text_of(value: Column) -> Column:
    """The text of a VARIANT that is one; null for numbers and the like."""
    return F.when(F.schema_of_variant(value) == "STRING", value.cast("string"))


def vocabulary_findings(spark: SparkSession, folder: str) -> DataFrame:
    """``(code, path, detail, line)``: files without entries, keys, fields and values of entries that break the rules.

    Only the files of VOCABULARIES are read; one that can't be read has findings of its own (parse_findings).
    """
    parsed = read_yaml(spark, folder).withColumn("file", F.element_at(F.split("path", "/"), -1)).where(F.col("file").isin(list(VOCABULARIES)))
    needs = F.create_map(*[x for file, (_, f) in VOCABULARIES.items() for x in (F.lit(file), F.array(*map(F.lit, f)))])
    root = parsed.where("document is not null").where(~F.col("is_mapping") | (F.size(F.json_object_keys("document")) == 0)).select(F.lit("vocabulary.root").alias("code"), "path", F.lit("").alias("detail"), F.lit(1).alias("line"))
    entry = parsed.where("is_mapping").select("path", "file", "lines", F.explode(F.from_json("document", "map<string,variant>")).alias("key", "value"))
    is_entry = F.schema_of_variant("value").startswith("OBJECT<")
    entry = entry.withColumn("fields", F.when(is_entry, F.from_json(F.to_json("value"), "map<string,variant>"))).withColumn("need", F.element_at(needs, F.col("file")))
    have = F.map_keys("fields")

    def problem(code: str, bad: Column, detail: Column = F.col("key")) -> Column:
        return F.when(F.coalesce(bad, F.lit(False)), F.struct(F.lit(f"vocabulary.{code}").alias("code"), detail.alias("detail")))

    missing, extra = F.array_except("need", have), F.array_except(have, F.col("need"))
    named = F.map_values(F.map_filter("fields", lambda k, _: F.array_contains("need", k)))
    rows = F.array_compact(F.array(
        problem("key", ~F.col("key").rlike(T.VOCABULARY_CODE_SHAPE)),
        problem("entry", F.col("fields").isNull()),
        problem("required", F.size(missing) > 0, F.concat_ws(",", missing)),
        problem("additional_property", F.size(extra) > 0, F.concat_ws(",", extra)),
        problem("value", F.exists(named, lambda v: text_of(v).isNull() | T.is_blank(text_of(v)))),
        problem("whitespace", F.exists(named, lambda v: F.coalesce(T.is_padded(text_of(v)), F.lit(False)))),
    ))
    line = line_of(F.col("lines"), F.concat(F.lit("$."), F.col("key")))
    return root.unionByName(entry.select("path", line.alias("line"), F.inline(rows)).select("code", "path", "detail", "line"))


def read_removed(spark: SparkSession, file: str) -> DataFrame:
    """The removed list as read: one row with PARSED columns."""
    return spark.read.format("binaryFile").load(file).select("path", "content").mapInPandas(file_parser(), PARSED)


def load_removed(spark: SparkSession, file: str) -> DataFrame:
    """``(idx, doi, line)`` of the removed list; entries that are no text have a null doi. A file that is no list has none."""
    listed = read_removed(spark, file).where("document like '[%'")
    entries = listed.select("lines", F.posexplode(F.from_json("document", "array<variant>")).alias("idx", "v"))
    return entries.select("idx", text_of(F.col("v")).alias("doi"), F.element_at("lines", F.concat(F.lit("$["), F.col("idx"), F.lit("]"))).alias("line"))


def folder_findings(folder: str, id_pattern: str = T.RECORD_FILE_SHAPE, first: str = "00001") -> list[tuple[str, str]]:
    """``(code, name)`` of entries that don't belong into a record folder: links, other files, odd names, number 0, no first record.

    Looks at the listing only, in the order of names without case.
    """
    if os.path.islink(folder):
        return [("record.symlink", folder)]
    if not os.path.isdir(folder):
        return [("record.directory_missing", folder)]
    out, ids = [], []
    for name in sorted(os.listdir(folder), key=str.casefold):
        path = os.path.join(folder, name)
        if os.path.islink(path):
            out.append(("record.symlink", name))
        elif name == ".gitkeep":
            continue
        elif not os.path.isfile(path):
            out.append(("record.unexpected_entry", name))
        elif not re.fullmatch(id_pattern.strip("^$"), name):
            out.append(("record.filename", name))
        else:
            ids.append(name.split(".")[0])
            if not int(ids[-1]):
                out.append(("record.id_range", name))
    if ids and first not in ids:
        out.append(("record.first_id", first))
    return out


def linked(root: str, part: str) -> bool:
    """Whether any step from ``root`` down to ``part`` is a link."""
    steps = part.split("/")
    return any(os.path.islink(os.path.join(root, *steps[: i + 1])) for i in range(len(steps)))


def artifact_findings(root: str, artifacts: list[str]) -> list[tuple[str, str]]:
    """``(code, path)`` of required files that aren't inside ``root``, are missing, or are reached through a link."""
    out = []
    for a in artifacts:
        part = a.replace("\\", "/")
        if os.path.isabs(a) or ".." in part.split("/") or re.match(r"^[A-Za-z]:", a):
            out.append(("artifact.path", a))
        elif linked(root, part):
            out.append(("artifact.symlink", a))
        elif not os.path.isfile(os.path.join(root, part)):
            out.append(("artifact.missing", a))
    return out
