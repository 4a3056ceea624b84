import json

import pytest

from colophon.operators import collection as K
from colophon.operators import schema_rules as R
from colophon.sources import yaml_records as Y

RECORD = """document_type: research_article
publication_stage: publication
title: A title
authors:
  - name: Ann Author
doi: 10.1234/a
publication_year: 2020
journal: Journal of X
language_status: english
file_status:
  main_pdf: present
  supplementary_material: present
  full_text_html: present
"""
TERMS = {
    "document-types.yaml": "research_article", "file-statuses.yaml": "present", "language-statuses.yaml": "english",
    "publication-stages.yaml": "publication", "record-statuses.yaml": "verified", "relationship-types.yaml": "is_version_of",
}


def build(root, records=None, **files):
    """A sound collection, with some of its files replaced; None leaves a file out."""
    all_files = {f"vocabularies/{f}": f"{c}:\n  label: L {c}\n  description: d\n" + (f"  inverse: {c}\n" if "relation" in f else "") for f, c in TERMS.items()}
    all_files |= {"removed-dois.yaml": "- 10.1234/gone\n", "schema/record.schema.json": json.dumps(R.record_schema("^[0-9]{5}$"))}
    all_files |= {f"records/{k}.yaml": v for k, v in (records or {"00001": RECORD}).items()} | files
    for name, text in all_files.items():
        if text is not None:
            path = root / name
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(root)


def found(spark, root, **how):
    return K.validate_folder(spark, root, latest_year=2028, **how).collect()


def codes(spark, root, **how):
    return {r["code"] for r in found(spark, root, **how)}


def test_a_sound_collection_has_no_findings(spark, tmp_path):
    assert found(spark, build(tmp_path)) == []


# One fault a record, so that one run tells about all of them; codes may come in pairs.
FAULTS = {
    "publication_year: 2020": [("publication_year: '2024'", "schema.type", 7), ("publication_year: [2024]", "schema.type", 7), ("publication_year: 1799", "schema.minimum", 7), ("publication_year: 2029.0", "record.publication_year_future", 7), ("publication_year: 2020.5", "schema.type", 7), ("publication_year: 2020\nurl: http://e.org/", "schema.additionalProperties", 1)],
    "doi: 10.1234/a\n": [("", "schema.required", 1), ("doi: https://doi.org/10.1234/a\n", "schema.pattern", 6)],
    "  - name: Ann Author": [("  - name: ' padded'", "record.whitespace", 5), ("  - canonical_name: X", "schema.required", 5), ("  - name: Ann Author\n  - name: ANN  author", "record.duplicate_author", 6), ("  - name: A\n    canonical_name: A", "record.redundant_canonical_name", 5), ("  - name: 5", "schema.type", 5), ("  - name: A\n    canonical_name: [b]", "schema.type", 6)],
    "  main_pdf: present": [("  main_pdf: lost", "record.unknown_vocabulary_value", 11), ("  other: x", "schema.additionalProperties", 11)],
    "title: A title": [("1: A title\ntitle: A title", "record.non_string_key", 3), ("title: |\n  two\n  lines", "record.multiline_value", 3), ("title: '  '", "record.blank_string", 3), ("title: 2024-01-01", "schema.type", 3), ("title: a\ntitle: b", "record.yaml", 4), ("title: &x a\njournal2: *x", "record.alias", 3)],
    "journal: Journal of X": [("journal: Journal of X\nrecord_notes: see C:\\data\\x", "record.private_reference", 9), ("journal: Journal of X\nrelated:\n  - {record_id: '99999', relationship_type: is_version_of}", "relationship.target_missing", 10)],
}


@pytest.fixture(scope="module")
def faults(spark, tmp_path_factory):
    cases = [(old, new, code, line) for old, group in FAULTS.items() for new, code, line in group]
    records = {f"{i + 1:05d}": RECORD.replace("10.1234/a", f"10.1234/a{i}").replace("A title", f"A title {i}") for i in range(len(cases) + 2)}
    for i, (old, new, _, _) in enumerate(cases):
        own = RECORD.replace(old, new)
        records[f"{i + 1:05d}"] = own.replace("10.1234/a\n", f"10.1234/a{i}\n").replace("A title\n", f"A title {i}\n")
    records[f"{len(cases) + 1:05d}"] = "- no mapping\n"
    root = build(tmp_path_factory.mktemp("faults"), records)
    return cases, {(r["file"], r["code"]): r["line"] for r in found(spark, root)}


@pytest.mark.parametrize("i", range(sum(len(g) for g in FAULTS.values())))
def test_faults_of_one_record(faults, i):
    cases, got = faults
    assert got.get((f"records/{i + 1:05d}.yaml", cases[i][2])) == cases[i][3], {k: v for k, v in got.items() if f"{i + 1:05d}" in k[0]}


def test_other_findings_do_not_follow(faults):
    cases, got = faults
    own = {f"records/{i + 1:05d}.yaml": set() for i in range(len(cases) + 2)}
    for file, code in got:
        own[file].add(code)
    assert own[f"records/{len(cases) + 1:05d}.yaml"] == {"record.root"} and own[f"records/{len(cases) + 2:05d}.yaml"] == set()
    at = next(i for i, c in enumerate(cases) if c[2] == "record.non_string_key")
    assert own[f"records/{at + 1:05d}.yaml"] == {"record.non_string_key"}  # no schema check of such a record
    at = next(i for i, c in enumerate(cases) if c[1].endswith("'2024'"))
    assert own[f"records/{at + 1:05d}.yaml"] == {"schema.type"}


def test_lists_and_rules(spark, tmp_path):
    root = build(
        tmp_path, None, **{
            "vocabularies/document-types.yaml": "research_article:\n  label: Same\n  description: d\nreview:\n  label: same\n  description: 5\nBad:\n  label: ' x'\n  extra: y\nbook: text\n",
            "vocabularies/relationship-types.yaml": "corrects:\n  label: C\n  description: d\n  inverse: is_corrected_by\n", "vocabularies/file-statuses.yaml": None, "vocabularies/record-statuses.yaml": "[]\n",
            "vocabularies/language-statuses.yaml": "english: {label: a\n", "removed-dois.yaml": "- 10.1234/x\n- 7\n- letter\n- 10.1234/X\n- 10.1234/A\n",
        })
    got = {(r["code"], r["file"], r["line"]) for r in found(spark, root)}
    words = "vocabularies/document-types.yaml"
    assert {("vocabulary.key", words, 8), ("vocabulary.required", words, 8), ("vocabulary.additional_property", words, 8), ("vocabulary.whitespace", words, 8), ("vocabulary.entry", words, 10), ("vocabulary.value", words, 5)} <= got
    assert {("removed_doi.entry", "removed-dois.yaml", 2), ("removed_doi.syntax", "removed-dois.yaml", 3), ("removed_doi.duplicate", "removed-dois.yaml", 4)} <= got
    assert {("vocabulary.missing", "vocabularies/file-statuses.yaml", None), ("vocabulary.root", "vocabularies/record-statuses.yaml", 1), ("relationship.inverse_missing", "vocabularies", 2)} <= got
    assert {"vocabulary.yaml", "vocabulary.duplicate_label", "database.removed_doi"} <= {c for c, _, _ in got}


def test_folders_and_links(spark, tmp_path):
    root = build(tmp_path / "a", {"00002": RECORD, "00000": RECORD.replace("10.1234/a", "10.1234/b").replace("A title", "B"), "x": RECORD}, **{"schema/record.schema.json": None, "removed-dois.yaml": "a: 1\n"})
    (tmp_path / "a" / "records" / "00003.yaml").symlink_to(tmp_path / "a" / "records" / "00002.yaml")
    assert codes(spark, root, artifacts=("none.txt",)) == {"schema.missing", "removed_doi.root", "record.filename", "record.id_range", "record.symlink", "record.first_id", "artifact.missing"}
    (tmp_path / "b").mkdir()
    assert codes(spark, str(tmp_path / "b")) == {"schema.missing", "vocabulary.directory_missing", "removed_doi.missing", "record.directory_missing"}
    bad = build(tmp_path / "c", None, **{"schema/record.schema.json": '{"type": "object", "minLength": -1}'})
    assert codes(spark, bad) == {"schema.invalid"}
    assert codes(spark, bad, rules_root=build(tmp_path / "d")) == set()


def test_report(spark, tmp_path):
    root = build(tmp_path, {"00001": RECORD.replace("doi: 10.1234/a\n", "")})
    out = K.validate_folder(spark, root, latest_year=2028)
    assert [r[0] for r in K.annotations(out).collect()] == ["::error file=records/00001.yaml,line=1,title=schema.required::schema.required at $.doi"]
    assert K.console(out, 1) == "ERROR schema.required records/00001.yaml:1 schema.required at $.doi\n1 records, 1 errors, 0 warnings: failed"


def test_names_of_the_files(spark, tmp_path):
    root = build(tmp_path, {"00001": RECORD + "x_status: wrong\n"}, **{"schema/record.schema.json": '{"type": "object"}'})
    got = found(spark, root, layout=K.Layout(names={"x_status": "record_status"}))
    assert [(r["code"], r["path"], r["line"]) for r in got] == [("record.unknown_vocabulary_value", "$.record_status", 14)]


@pytest.mark.parametrize("lines, path, want", [({"$": 1, "$.a": 3}, "$.a.b[0].c.d.e[5].f", 3), ({"$": 2}, "$.x", 2), ({}, "$", 1), ({"$": 1}, "odd", 1)])
def test_lines_of_what_is_missing(spark, lines, path, want):
    df = spark.createDataFrame([(lines, path)], "lines map<string,int>, path string")
    assert df.select(Y.line_of(df["lines"], df["path"])).first()[0] == want
