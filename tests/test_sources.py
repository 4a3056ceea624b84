import struct
import zipfile

import pytest

from colophon.sources import files as A
from colophon.sources import yaml_records as Y

GOOD = """document_type: research_article
title: A title
authors:
  - name: Ann
publication_year: 2024
file_status: {main_pdf: present, supplementary_material: present, full_text_html: present}
"""


@pytest.mark.parametrize(
    "text, code",
    [("a: 1\na: 2\n", "yaml"), ("a: 1\n---\nb: 2\n", "document_count"), ("", "document_count"), ("a: [1\n", "yaml"), ("a: &x [*x]\n", "recursive_alias"), ("a: &x 1\nb: *x\n", "alias"),
     ("[" * 150 + "]" * 150, "nesting_depth"), ("1: x\n", "non_string_key"), ("a: 2024-99-99\n", "yaml"), ("a: !!int x\n", "yaml"), ("<<: {a: 1}\n", "yaml")],
)
def test_strict_yaml(text, code):
    assert code in {c for c, _, _ in Y.read_document(text.encode())[2]}


def test_bytes_and_lines():
    assert Y.read_document(b"\xff\xfe\x00")[2][0][0] == "encoding"
    document, lines, issues = Y.read_document(GOOD.encode())
    assert not issues and lines["$.title"] == 2 and lines["$.authors[0].name"] == 4 and document["title"] == "A title"
    assert Y.read_document(b"- a\n")[0] == ["a"] and Y.read_document(b"? [a]\n: {b: 1}\nc: d\n")[2][0][0] == "yaml"


def test_folder(spark, tmp_path):
    (tmp_path / "00001.yaml").write_text(GOOD)
    (tmp_path / "00003.yaml").write_text("a: 1\na: 2\n")
    (tmp_path / "00000.yaml").write_text(GOOD)
    (tmp_path / "x.yml").write_text(GOOD)
    (tmp_path / "link.yaml").symlink_to(tmp_path / "00001.yaml")
    (tmp_path / "sub").mkdir()
    rows = {r["record_id"]: r for r in Y.load_records(spark, str(tmp_path)).collect() if r["record_id"]}
    assert rows["00001"]["title"] == "A title" and rows["00001"]["authors"][0]["name"] == "Ann" and rows["00003"]["title"] is None
    assert {(r["code"]) for r in Y.parse_findings(Y.read_yaml(spark, str(tmp_path))).collect()} == {"record.yaml"}
    with pytest.raises(Exception):
        Y.load_records(spark, str(tmp_path), "FAILFAST").collect()
    assert {c for c, _ in Y.folder_findings(str(tmp_path))} == {"record.id_range", "record.symlink", "record.unexpected_entry", "record.filename"}
    assert Y.folder_findings(str(tmp_path / "none"))[0][0] == "record.directory_missing"
    assert [c for c, _ in Y.artifact_findings(str(tmp_path), ["00001.yaml", "../x", "none.txt", "link.yaml"])] == ["artifact.path", "artifact.missing", "artifact.symlink"]


def test_vocabularies(spark, tmp_path):
    (tmp_path / "document-types.yaml").write_text("book:\n  label: Book\n  description: d\nBad-Key:\n  label: ' x'\n  extra: y\n")
    (tmp_path / "relationship-types.yaml").write_text("corrects:\n  label: C\n  description: d\n  inverse: is_corrected_by\n")
    rows = {(r["vocabulary"], r["code"]): r for r in Y.load_vocabularies(spark, str(tmp_path)).collect()}
    assert rows[("document_type", "book")]["label"] == "Book" and rows[("relationship_type", "corrects")]["inverse"] == "is_corrected_by"
    assert {r["code"] for r in Y.vocabulary_findings(spark, str(tmp_path)).collect()} == {"vocabulary.key", "vocabulary.required", "vocabulary.additional_property", "vocabulary.whitespace"}
    (tmp_path / "removed.yaml").write_text("- 10.1234/a\n- 10.1234/b\n")
    assert [(r["idx"], r["doi"], r["line"]) for r in Y.load_removed(spark, str(tmp_path / "removed.yaml")).orderBy("idx").collect()] == [(0, "10.1234/a", 1), (1, "10.1234/b", 2)]


def test_inventory(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sII5x", 13, b"IHDR", 30, 20) + b"\0" * 4)
    (tmp_path / "b.gif").write_bytes(b"GIF89a" + struct.pack("<HH", 3, 4))
    (tmp_path / "c.txt").write_text("x")
    with zipfile.ZipFile(tmp_path / "d.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", '<workbook xmlns="http://m"><sheets><sheet name="One"/><sheet name="Two"/></sheets></workbook>')
    rows = {r["name"]: r for r in A.inventory(spark, str(tmp_path)).collect()}
    assert (rows["a.png"]["width"], rows["a.png"]["height"], rows["a.png"]["kind"]) == (30, 20, "image")
    assert rows["b.gif"]["format"] == "GIF" and rows["c.txt"]["kind"] == "unhandled" and rows["d.xlsx"]["sheets"] == ["One", "Two"]
    assert A.image_header(b"junk") is None and A.sheet_names(b"PKx") is None
    A.write_inventory(A.inventory(spark, str(tmp_path)), str(tmp_path / "out"))


def test_plain_webp():
    lossy = b"RIFF\0\0\0\0WEBPVP8 " + b"\0" * 7 + b"\x9d\x01\x2a" + struct.pack("<HH", 30 | 1 << 14, 20)
    lossless = b"RIFF\0\0\0\0WEBPVP8L\0\0\0\0\x2f" + (29 | 19 << 14).to_bytes(4, "little")
    assert A.image_header(lossy) == A.image_header(lossless) == ("WEBP", 30, 20, 1)


def test_snapshots(spark, tmp_path):
    from colophon.operators import diff as D
    from colophon.sources import snapshots as N

    root = str(tmp_path)
    rows = [(f"00000000{i}", f"Title {i}", f"J{i}", [f"a{i}{k}" for k in range(8)]) for i in range(1, 5)]
    schema = "record_id string, title string, journal string, authors array<string>"
    old = spark.createDataFrame(rows, schema)
    N.save(old, root, "records", "1")
    N.save(old.where("record_id <> '000000001'"), root, "records", "2")
    N.save(old.where("record_id <> '000000002'"), root, "records", "3")
    assert N.versions(spark, root, "records") == ["1", "2", "3"] and N.load(spark, root, "records").count() == 3
    direct = {(r["kind"], r["old_id"] or r["new_id"]) for r in N.changes(spark, root, "records", "2", "3").collect()}
    assert direct == {("added", "000000001"), ("removed", "000000002")}
    forked = N.changes(spark, root, "records", "2", "3", "merge-base", "1")
    assert {(r["kind"], r["old_id"]) for r in forked.collect()} == {("removed", "000000002")}
    assert "1 removed" in D.markdown(forked) and "00002" in D.markdown(forked)
    seen = {r["record_id"]: (r["first_seen"], r["last_seen"]) for r in N.history(spark, root, "records").collect()}
    assert seen["000000001"] == ("1", "3") and seen["000000002"] == ("1", "2")
    back = N.changes(spark, root, "records", "2", "3")
    assert [r["new_id"] for r in D.reused_ids(back, N.history(spark, root, "records", "2")).collect()] == ["000000001"]
    for args, code in (((root, "records", "2", "3", "odd"), "comparison"), ((root, "records", "2", "3", "merge-base"), "merge_base"), ((root, "records", "2", "9"), "invalid_revision")):
        with pytest.raises(N.SnapshotError) as e:
            N.changes(spark, *args)
        assert e.value.code == code


def test_snapshots_that_cannot_be_compared(spark, tmp_path):
    from colophon.sources import snapshots as N

    df = spark.createDataFrame([("1", "a")], "record_id string, title string")
    N.save(df, str(tmp_path), "r", "1")
    N.save(df.drop("record_id"), str(tmp_path), "r", "2")
    (tmp_path / "r" / "version=3").mkdir()
    for call, code in (
        (lambda: N.changes(spark, str(tmp_path), "r", "1", "2"), "parse"),
        (lambda: N.changes(spark, str(tmp_path), "r", "1", "3"), "failed"),
        (lambda: N.history(spark, str(tmp_path), "r", "0"), "history_failed"),
        (lambda: N.load(spark, str(tmp_path), "none"), "invalid_revision"),
    ):
        with pytest.raises(N.SnapshotError) as e:
            call()
        assert e.value.code == code


def test_places_of_a_collection(spark, tmp_path):
    from colophon.sources import open as O
    from colophon.sources import snapshots as N

    folder = tmp_path / "records"
    folder.mkdir()
    for i in (1, 2, 3):
        (folder / f"0000{i}.yaml").write_text(GOOD)
    (folder / "index.html").write_text("<a href='../'>up</a><a href='/records/00002.yaml?x'>b</a><a href='00001.yaml'>a</a><a href='00001.yaml#l'>a</a><a href='x.txt'>x</a>")
    assert O.listed_files((folder / "index.html").read_text()) == ["00001.yaml", "00002.yaml"]
    assert O.record_files(["records/00002.YML", "README.md", "records/00001.yaml"]) == ["records/00001.yaml", "records/00002.YML"]
    ids = lambda df: sorted(r["record_id"] for r in df.select("record_id").collect())
    assert ids(O.open_collection(spark, str(folder))) == ["00001", "00002", "00003"]
    assert ids(O.open_collection(spark, str(folder / "index.html"))) == ["00001", "00002"]
    df = spark.createDataFrame([("00007",), ("00008",)], "record_id string")
    N.save(df, str(tmp_path), "records2", "1")
    N.save(df.limit(1), str(tmp_path), "records2", "2")
    assert len(ids(O.open_collection(spark, str(tmp_path), "records2"))) == 1 and len(ids(O.open_collection(spark, str(tmp_path), "records2", "1"))) == 2
    df.write.parquet(str(tmp_path / "t"))
    assert len(ids(O.open_collection(spark, str(tmp_path / "t")))) == 2
