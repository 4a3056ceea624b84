import datetime
import os

import pytest
from pyspark.sql import functions as F

from colophon.operators import constraints as C
from colophon.operators import diff as D
from colophon.operators import html_clean as H
from colophon.operators import images as I
from colophon.operators import schema_rules as R
from colophon.operators import search as S
from colophon.operators import validate as V
from colophon.operators.components import connected_components
from colophon.operators.skew import lookup_join

SCHEMA = (
    "record_id string, document_type string, publication_stage string, title string, authors array<struct<name string, canonical_name string>>, doi string, publication_year int, "
    "journal string, language_status string, file_status struct<main_pdf string, supplementary_material string, full_text_html string>, record_status string, "
    "related array<struct<record_id string, relationship_type string>>, record_notes string"
)
BASE = {
    "record_id": "000000001", "document_type": "research_article", "publication_stage": "publication", "title": "A title", "authors": [("Ann Author", None)], "doi": "10.1234/a",
    "publication_year": 2020, "journal": "Journal of X", "language_status": "english", "file_status": ("present", "present", "present"), "record_status": None, "related": None, "record_notes": None,
}
VOCAB = [
    ("document_type", "research_article", "Original study", None), ("document_type", "review", "Survey", None), ("publication_stage", "publication", "Issued", None),
    ("language_status", "english", "In English", None), ("file_status", "present", "Held", None), ("record_status", "verified", "Read", None),
    ("relationship_type", "corrects", "Corrects", "is_corrected_by"), ("relationship_type", "is_corrected_by", "Corrected by", "corrects"), ("relationship_type", "is_version_of", "Version of", "is_version_of"),
]


def records(spark, *rows):
    full = [BASE | r for r in rows]
    names = [x.strip().split(" ")[0] for x in BASE]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in full], SCHEMA)


def vocab(spark):
    return spark.createDataFrame([(v, c, lab, "", i) for v, c, lab, i in VOCAB], "vocabulary string, code string, label string, description string, inverse string")


def rules(spark, removed=()):
    gone = spark.createDataFrame([(i, d) for i, d in enumerate(removed)], "idx int, doi string")
    return V.Rules(vocab(spark), gone, R.record_schema(), 2028)


def codes(spark, *rows, removed=()):
    found = V.row_findings(records(spark, *rows), rules(spark, removed)).unionByName(V.set_findings(records(spark, *rows), rules(spark, removed)))
    return {r["code"] for r in found.collect()}


def test_a_sound_record_has_no_findings(spark):
    assert codes(spark, {}) == set()


CHANGES = [
    ({"document_type": "poem"}, "record.unknown_vocabulary_value"),
    ({"doi": None}, "schema.required"),
    ({"doi": "https://doi.org/10.1234/a"}, "schema.pattern"),
    ({"publication_year": 1799}, "schema.minimum"),
    ({"publication_year": 2029}, "record.publication_year_future"),
    ({"authors": []}, "schema.minItems"),
    ({"authors": [(None, None)]}, "schema.required"),
    ({"file_status": ("present", None, "present")}, "schema.required"),
    ({"title": " padded"}, "record.whitespace"),
    ({"title": "two\nlines"}, "record.multiline_value"),
    ({"journal": "  "}, "record.blank_string"),
    ({"authors": [("Ann Author", "Ann Author")]}, "record.redundant_canonical_name"),
    ({"authors": [("Ann Author", None), ("ANN  author", None)]}, "record.duplicate_author"),
    ({"authors": [("A. Author", "Ann Author"), ("Ann Author", None)]}, "record.duplicate_author"),
    ({"related": [("000000001", "is_version_of")]}, "record.self_relationship"),
    ({"related": [("000000009", "corrects")]}, "relationship.target_missing"),
    ({"related": [("000000009", "likes")]}, "record.unknown_relationship_type"),
    ({"related": [("000000009", "corrects"), ("000000009", "corrects")]}, "record.duplicate_relationship"),
    ({"record_notes": "see C:\\data\\x"}, "record.private_reference"),
    ({"record_notes": "on D:x"}, "record.possible_private_reference"),
    ({"record_notes": "http://a.local/"}, "record.notes_url_private_host"),
    ({"record_notes": " "}, "record.blank_string"),
    ({"record_id": "17"}, "record.filename"),
]


@pytest.fixture(scope="module")
def changed(spark):
    """Findings of one collection in which each record has one fault."""
    rows = [{"record_id": f"1000000{i:02d}", "doi": f"10.1234/x{i}", "title": f"Title {i}"} | {k: (v if k != "related" else [(f"1000000{i:02d}" if d == "000000001" else d, t) for d, t in v]) for k, v in change.items()} for i, (change, _) in enumerate(CHANGES)]
    df = records(spark, *rows)
    return {(r["record_id"], r["code"]) for r in V.row_findings(df, rules(spark)).unionByName(V.set_findings(df, rules(spark))).collect()}


@pytest.mark.parametrize("i", range(len(CHANGES)))
def test_findings_of_one_record(changed, i):
    change, code = CHANGES[i]
    assert (change.get("record_id", f"1000000{i:02d}"), code) in changed


def test_years_up_to_the_bound_are_fine(spark):
    assert codes(spark, {"publication_year": 2028}) == set()


def test_findings_between_records(spark):
    other = {"record_id": "000000002", "doi": "10.1234/A", "title": "Other"}
    assert "database.duplicate_doi" in codes(spark, {}, other)
    assert "database.possible_duplicate" in codes(spark, {}, {"record_id": "000000002", "doi": "10.1234/b", "title": "a TITLE!"})
    assert "database.removed_doi" in codes(spark, {}, removed=["10.1234/A "])
    one_way = [{"related": [("000000002", "corrects")]}, {"record_id": "000000002", "doi": "10.1234/b", "title": "x"}]
    assert "relationship.inverse_count" in codes(spark, *one_way)
    both = [one_way[0], one_way[1] | {"related": [("000000001", "is_corrected_by")]}]
    assert codes(spark, *both) == set()
    twice = [one_way[0], one_way[1] | {"related": [("000000001", "is_corrected_by"), ("000000001", "is_corrected_by")]}]
    assert "relationship.inverse_count" in codes(spark, *twice)


def test_empty_collection(spark):
    empty = records(spark, {}).limit(0)
    assert V.findings(empty, rules(spark)).count() == 0
    assert S.facet_values(empty).count() == 0
    assert D.compare(empty, empty).count() == 0


def test_summary_and_report(spark):
    found = V.row_findings(records(spark, {"doi": None}), rules(spark))
    row = V.summary(found).first()
    assert (row["errors"], row["warnings"], row["passed"]) == (1, 0, False)
    assert not V.passed(found) and V.passed(found.limit(0))
    assert "schema.required" in V.markdown(found, 1)
    assert V.annotation("a%b\n:c", True) == "a%25b%0A%3Ac"


def test_rules_on_lists(spark):
    removed = spark.createDataFrame([(0, "10.1234/a"), (1, " 10.1234/A"), (2, "letter"), (3, None)], "idx int, doi string")
    assert {tuple(r) for r in C.removed_list_problems(removed).collect()} == {(1, "syntax"), (1, "duplicate"), (2, "syntax"), (3, "entry")}
    broken = vocab(spark).where("code <> 'is_corrected_by'")
    assert [tuple(r) for r in C.vocabulary_inverses(broken).collect()] == [("corrects", "is_corrected_by", "inverse_missing")]


@pytest.mark.parametrize(
    "data, code",
    [(b"[1]", "root"), (b'{"a": NaN}', "json"), (b'{"a": 1, "a": 2}', "duplicate_key"), (b"\xff", "encoding"), (b'{"type": "poem"}', "invalid"), (b'{"$ref": "http://x/y"}', "reference"),
     (b'{"$ref": "#/$defs/a", "$defs": {"a": {"$ref": "#/$defs/a"}}}', "reference_cycle"), (b'{"$ref": "#/$defs/b"}', "reference"), (b"[" * 150 + b"]" * 150, "root"), (b'{"a":' * 150 + b"1" + b"}" * 150, "nesting_depth")],
)
def test_bad_schemas(data, code):
    with pytest.raises(R.SchemaError) as e:
        R.load_schema(data)
    assert e.value.code == code


def test_search(spark):
    df = records(
        spark,
        {},
        {"record_id": "000000002", "title": "Étude", "publication_year": 1990, "record_status": "verified", "document_type": "review"},
        {"record_id": "000000003", "title": None, "publication_year": None, "authors": [("Søren Ø", "Sören")], "record_status": ""},
    )
    ids = lambda spec: sorted(r[0][-1] for r in S.search(df, spec).select("record_id").collect())
    assert ids(S.SearchSpec()) == ["1", "2", "3"]
    assert ids(S.SearchSpec(query="etude")) == ["2"]
    assert ids(S.SearchSpec(query="SOREN")) == ["3"]
    assert ids(S.SearchSpec(status="__missing__")) == ["1", "3"]
    assert ids(S.SearchSpec(year_from=1900, year_to=2100)) == ["1", "2", "3"]
    assert ids(S.SearchSpec(year_from=2000)) == ["1"]
    assert ids(S.SearchSpec(document_type="review", status="verified")) == ["2"]
    order = lambda sort: [r["record_id"][-1] for r in S.top(df, sort, 9).collect()]
    assert order("year-desc") == ["1", "2", "3"] and order("year-asc") == ["3", "2", "1"] and order("title-asc") == ["3", "1", "2"]
    assert S.clamp_years(2050, 1980, (1990, 2020), "low") == (2020, 2020) and S.clamp_years(None, 1980, (1990, 2020), "high") == (1990, 1990)
    assert S.clamp_years(2010, 2000, (1990, 2020), "low") == (2010, 2010) and S.clamp_years(2010, 2000, (1990, 2020), "low", stops=True) == (2000, 2000)
    assert S.clamp_years(2010, 2000, (1990, 2020), "high", stops=True) == (2010, 2010)
    with pytest.raises(ValueError):
        S.SearchSpec(sort="odd")
    card = {r["record_id"][-1]: r for r in S.cards(df, vocab(spark)).collect()}
    assert card["3"]["title"] == "Untitled" and card["3"]["year"] == "Year not specified" and card["1"]["type_label"] == "Original study"


def test_id_ranges_and_grid(spark):
    ids = spark.createDataFrame([(x,) for x in [1, 2, 3, 5, 999_999, 1_000_000, 1_000_001, 5]], "v long")
    ranges = C.id_ranges(ids, "v")
    assert sorted((r["lo"], r["hi"], r["n"]) for r in ranges.collect()) == [(1, 3, 3), (5, 5, 1), (999_999, 1_000_001, 3)]
    assert C.compressed_ids(ranges) == "00001–00003, 00005, 999999–1000001"
    assert C.compressed_ids(ranges.limit(0)) == "None"
    last = C.grid(spark.range(14), "id", 12, 4).where("id = 13").first()
    assert (last["sheet"], last["grid_row"], last["grid_column"]) == (2, 0, 1)


def test_numbers_of_a_hot_partition(spark):
    """Rows are numbered within each source over several ranges, one source and the missing one included."""
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("s"))
    got = C.numbered(df, "id", "s").collect()
    seen = {}
    for r in sorted(got, key=lambda r: r["id"]):
        assert r["number"] == seen.get(r["s"], 0)
        seen[r["s"]] = r["number"] + 1
    assert len(got) == 5000


def test_diff(spark):
    base = records(spark, *[{"record_id": f"00000000{i}", "doi": f"10.1234/{i}", "title": f"Title {i}", "journal": f"J{i}", "authors": [(f"Author {i}{k}", None) for k in range(9)]} for i in range(1, 6)])
    head = base.where("record_id <> '000000002'").withColumn("title", F.when(F.col("record_id") == "000000003", "Changed").otherwise(F.col("title")))
    moved = base.where("record_id = '000000002'").withColumn("record_id", F.lit("000000008"))
    copy = base.where("record_id = '000000004'").withColumn("record_id", F.lit("000000009"))
    got = {(r["kind"], r["old_id"], r["new_id"], tuple(r["changed_fields"])) for r in D.detect(base, head.unionByName(moved).unionByName(copy)).collect()}
    assert got == {("modified", "000000003", "000000003", ("title",)), ("renamed", "000000002", "000000008", ()), ("copied", "000000004", "000000009", ())}
    plain = D.compare(base, head)
    assert {(r["code"], r["detail"]) for r in D.warnings(plain).collect()} == {("change.record_removed", ""), ("change.identity_modified", "title")}
    assert D.kind_counts(plain).first()["modified"] == 1


def test_change_log(spark):
    t = datetime.datetime(2024, 1, 1)
    rows = [(1, "added", t, t), (1, "added", t, t + datetime.timedelta(days=3)), (2, "removed", t, t + datetime.timedelta(days=2))]
    log = spark.createDataFrame(rows, "change_id long, kind string, changed_at timestamp, arrived_at timestamp")
    once = D.first_sent(log)
    assert sorted((r["change_id"], r["arrived_at"]) for r in once.collect()) == [(1, t), (2, t + datetime.timedelta(days=2))]
    assert [r["change_id"] for r in D.late(once).collect()] == [2]


@pytest.mark.parametrize("small", [0, 16 << 20])
def test_lookup_join_spreads_hot_keys(spark, monkeypatch, small):
    monkeypatch.setattr("colophon.operators.skew.SMALL_BYTES", small)
    facts = spark.range(1000).withColumn("k", F.when(F.col("id") < 600, 0).otherwise(F.col("id") % 50 + 1).cast("long"))
    dim = facts.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    out = lookup_join(facts, dim, ["k"], "n")
    assert out.count() == 1000 and out.where("k = 0 and first = 0").count() == 600


def test_components(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("c", "a"), ("q", "q"), (None, "a")] + [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)], "a string, b string")
    got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert got["c"] == "a" and got["y"] == "x" and got["n060"] == "n000" and "q" not in got
    assert connected_components(edges.limit(0)).count() == 0


PAGE = "<!DOCTYPE html><html><head></head><body><nav>menu</nav><article><h1 class='x' onclick='f()'>T</h1>before<script>bad()</script>after<noscript><p>kept</p></noscript><a href='javascript:x()'>l</a></article></body></html>"


def test_html_cleaning(spark):
    out = H.clean(PAGE)
    assert out["problems"] == [] and "menu" not in out["html"] and "beforeafter" in out["html"] and "kept" in out["html"] and "javascript" not in out["html"] and "onclick" not in out["html"]
    assert H.clean("<body><p>a</p></body>")["html"] == H.clean("<p>a</p>")["html"] == "<body>\n<p>a</p>\n</body>"
    assert H.problems("<body><form></form></body>") == ["forbidden:form"] and "doctype" in H.problems(PAGE)
    shell = "<div id='shell'>site<article><div id='abstracts'>a</div><div id='body'>long text</div></article></div>"
    assert "site" not in H.clean(shell)["html"]
    df = spark.createDataFrame([(PAGE,), (None,), ("",)], "p string")
    rows = df.select(H.cleaned(F.col("p")).alias("c"), H.forbidden_count(F.col("p")).alias("n"), H.broken_promises(F.col("p")).alias("b")).collect()
    assert rows[0]["n"] == 2 and rows[0]["b"] == ["doctype", "document", "forbidden"] and rows[1]["c"]["html"] is None


def asset(url, content=b"x", **more):
    return {"kind": "image", "url": url, "path": url.rsplit("/", 1)[-1], "content": content, "content_type": "image/png"} | more


def test_embedded_images():
    """Each image is told by its address, its key or its number, shown once, and else replaced by its description."""
    base = "https://e.org/p/"

    def run(page, *rows):
        return H.clean(page, base, I.Manifest(list(rows)))

    a, b = asset("https://e.org/p/a.png", b"A"), asset("https://e.org/p/b.png", b"B")
    out = run("<img src='a.png'><img src='c.png' alt='Gone'><img src='a.png' alt='Fig 1'>", a, b)
    assert out["html"].count("data:image/png;base64,QQ==") == 1 and 'alt="Fig 1"' in out["html"] and "[Image omitted: Gone]" in out["html"]
    counters = ("embedded_images", "unique_embedded_assets", "omitted_images", "duplicate_images_removed", "embedded_large_figures")
    assert [out[c] for c in counters] == [1, 1, 1, 1, 0]
    same = run("<img src='a.png' alt='x'><img src='b.png' alt='y'><img src='none.png' alt='x'>", a, asset("https://e.org/p/b.png", b"A"))
    assert [same[c] for c in counters] == [1, 1, 0, 2, 0] and "omitted" not in same["html"]
    assert run("<img src='https://E.org/p/a.png?w=9'>", a)["embedded_images"] == 1
    assert run("<img src='https://e.org/p/a.png?w=9'>", asset("https://e.org/p/a.png?1"), asset("https://e.org/p/a.png?2"))["omitted_images"] == 1
    assert run("<figure><img src='t.png'><a href='b.png'>large</a></figure>", b)["embedded_images"] == 1
    assert run("<picture><source srcset='b.png 2x, c.png 3x'><img src='t.png'></picture>", b)["embedded_images"] == 1
    large = {"figure": 3, "path": "l3.png", "content": b"L", "content_type": ""}
    for page in ("<img src='a.png' alt='Figure 3. Maps'>", "<figure><a href='x?size=original&id=j.g003'>o</a><img src='t.png'></figure>", "<div id='fig3'><img src='t.png'></div>", "<img src='https://x.silverchair-cdn.com/m_f03.jpeg?s'>", "<div data-id='F3'><img src='t'></div>"):
        got = run(page, a, large)
        assert got["embedded_large_figures"] == 1 and "application/octet-stream;base64,TA==" in got["html"], page
    proxied = [asset(f"https://www.frontiersin.org/api/ipx/w={w}/https://www.frontiersin.org/files/Articles/1/f.jpg", bytes([w]), path=f"w{w}", width=w, height=1) for w in (10, 90, 50)]
    assert "base64,Wg==" in run("<img src='https://www.frontiersin.org/files/Articles/1/f.jpg'>", *proxied)["html"]
    with pytest.raises(ValueError):
        run("<img src='a.png'>", asset("https://e.org/p/a.png", b""))
    assert run("<p>no image</p>", a)["problems"] == []


def test_pages_with_manifests(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"assets": [{"kind": "image", "url": "https://e.org/a.png", "path": "a", "width": 3, "height": 2, "bytes": 1, "contentType": "image/png"}, {"figure": 2, "path": "b", "contentType": "image/png"}]}')
    manifest = H.read_manifest(spark, str(tmp_path / "m.json")).withColumn("page_id", F.lit(1).cast("long"))
    assert sorted((r["kind"], r["figure"], r["pos"]) for r in manifest.collect()) == [("image", None, 0), ("large", 2, 1)]
    contents = spark.createDataFrame([("a", b"A"), ("b", b"B"), ("c", b"C")], "path string, content binary")
    pages = spark.createDataFrame([(1, "https://e.org/", "<img src='a.png'><img alt='Figure 2' src='q.png'>"), (2, "https://e.org/", "<img src='a.png' alt='kept'>"), (3, "", None)], "page_id long, base_url string, html string")
    rows = {r["page_id"]: r["c"] for r in H.clean_pages(pages, manifest, contents).collect()}
    assert rows[1]["embedded_images"] == 2 and rows[1]["embedded_large_figures"] == 1 and "[Image omitted: kept]" in rows[2]["html"] and rows[3]["html"] is None
    H.write_fragments(H.clean_pages(pages, manifest, contents), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out" / "counts")).first()["embedded_images"] == 2


def test_article_roots_and_figures():
    viewer = "<header>chrome</header><div class='doi-isbn'>doi</div><div class='pdfView'><p id='articleAbstractView'>abstract</p></div><footer>end</footer>"
    assert H.clean(viewer)["html"] == '<body>\n<div><div>doi</div><div><p id="articleAbstractView">abstract</p></div></div>\n</body>'
    shell = "<nav>x</nav><div class='col-md-18'><h1 class='global-article-title'>T</h1></div><p>ads</p><div id='article-overiew-abstract-wrap'>text</div>"
    assert "ads" not in H.clean(shell)["html"] and "T" in H.clean(shell)["html"]
    column = "<p>site</p><div id='ContentColumn'><h1>T</h1><h2>References</h2></div>"
    assert "site" not in H.clean(column)["html"]
    pages = {
        "<div class='figure'><a href='https://x/info:doi/10.1/j.g003'>l</a><img src='a.png'></div>": 'figure id="figure-3"',
        "<div class='figure'><a href='https://x/j.t002'>l</a><img src='a.png'></div>": 'figure id="table-2"',
        "<figure><img src='m-toc-1.png'></figure>": 'figure id="visual-abstract"',
        "<figure><a href='/x-fig-0002a-m'>l</a><img src='a.png'></figure>": 'figure id="figure-2a"',
        "<figure><img src='a.png'><b id='Fig7'>c</b></figure>": 'figure id="figure-7"',
        "<p><img data-alt='Figure 4' src='a.png'></p>": 'figure id="figure-4"',
        "<div id='f5-or-1'><img src='a.png'></div>": 'figure id="figure-5"',
        "<div class='fig'><img src='ms_f06.jpeg?x'></div>": 'figure id="figure-6"',
        "<div id='author-group'><button>Ann Author</button><button> </button></div>": "<span>Ann Author</span>",
    }
    for page, want in pages.items():
        assert want in H.clean(page)["html"], page
    assert "icon" not in H.clean("<p>a</p><img class='license-icon' alt='icon'><nav><a href='#metrics'>m</a></nav>")["html"]


def test_figure_numbers(spark):
    df = spark.createDataFrame([("Figure 12 shows", ""), ("", "fig03.jpg"), ("", "x-fig-7-html"), ("none", "x")], "alt string, src string")
    assert [r[0] for r in df.select(H.figure_number(F.col("alt"), F.col("src"))).collect()] == [12, 3, 7, None]


def test_assets(spark):
    manifest = spark.createDataFrame([("image", "https://A.org/x.png#1", "p1", 10, 10, 5, "image/png", 0), ("image", "https://A.org/x.png", "p2", 20, 10, 5, "image/png", 1), ("other", "https://A.org/y.png", "p3", 1, 1, 1, "x", 2)], "kind string, url string, path string, width int, height int, bytes long, content_type string, pos int")
    best = H.best_renditions(manifest)
    assert [(r["url"], r["path"]) for r in best.collect()] == [("https://A.org/x.png", "p2")]
    asked = spark.createDataFrame([(1, 0, 0, "https://z.org/q"), (1, 0, 1, "https://a.org/x.png?w=9"), (1, 1, 0, "https://z.org/q")], "page_id int, image int, pos int, url string")
    assert sorted((r["image"], r["pos"], r["path"]) for r in H.resolve_assets(asked, best).collect()) == [(0, 1, "p2"), (1, None, None)]
    images = spark.createDataFrame([(1, "p", 0, ""), (1, "p", 1, "alt"), (2, "p", 0, None)], "page_id int, path string, image int, alt string")
    assert sorted((r["page_id"], r["image"], r["alt"]) for r in H.keep_first(images).collect()) == [(1, 0, "alt"), (2, 0, None)]
    assert spark.range(1).select(H.data_url(F.lit(b"ab"), F.lit("t"))).first()[0] == "data:t;base64,YWI="
    assert os.path.exists(os.path.dirname(H.__file__))
