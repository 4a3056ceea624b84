import pytest

from colophon.llm import names as M


@pytest.mark.parametrize(
    "name, want",
    [
        ("Ann B. de la Motte", ("P", "ann", "b", "delamotte", False)), ("de la Motte, Ann B.", ("P", "ann", "b", "delamotte", False)), ("Motte, A. B. de la", ("P", "a", "b", "delamotte", True)),
        ("MOTTE AB", ("P", "motte", "", "ab", False)), ("Motte AB", ("P", "a", "b", "motte", True)), ("Becky Motte", ("P", "rebecca", "", "motte", False)), ("Mei Lan Su", ("P", "meilan", "", "su", False)),
        ("J.-H. Ko", ("P", "j", "", "ko", True)), ("The X Gene Consortium", ("G", "", "", "consortium gene x", False)), ("Consortium, X Gene", ("G", "", "", "consortium gene x", False)), ("on behalf of the X Gene Cons.", ("G", "", "", "consortium gene x", False)),
    ],
)
def test_parse(name, want):
    assert M.parse(name) == want


def linked(spark, rows):
    df = spark.createDataFrame(rows, "name string, canonical_name string")
    return {(r["name_a"], r["name_b"]) for r in M.name_pairs(M.link_names(df)).collect()}


def test_variants(spark):
    rows = [(n, None) for n in ["Søren Lodefik", "Soren Lodefik", "Lodefik, Søren", "S. Lodefik", "Søren LODEFIK", "Søren Loedfik", "Anna Lodefik", "Kofi Homat", "Karim Homat", "K. Homat", "Martin G. Shoto", "Martin Shoto", "Rui A. Pavel", "Rui B. Pavel", "Rui Pavel", "et al.", "", None]]
    got = linked(spark, rows + rows)
    group = sorted(["Søren Lodefik", "Soren Lodefik", "Lodefik, Søren", "S. Lodefik", "Søren LODEFIK", "Søren Loedfik"][i] for i in (0, 1, 2, 4, 5))
    assert {(a, b) for i, a in enumerate(group) for b in group[i + 1 :]} <= got
    assert ("Martin G. Shoto", "Martin Shoto") in got
    names = {x for p in got for x in p}
    assert not names & {"K. Homat", "Karim Homat", "Kofi Homat", "Rui A. Pavel", "Rui Pavel", "et al.", "Anna Lodefik"}


def test_initials_and_stated_names(spark):
    got = linked(spark, [("K. Homat", "Kofi Homat"), ("Kofi Homat", None), ("Karim Homat", None), ("T. Solo", None), ("Tom Solo", None), ("Bob Quill", "Robert E. Quill"), ("Zed Other", "Quite Different")])
    assert got == {("K. Homat", "Kofi Homat"), ("T. Solo", "Tom Solo"), ("Bob Quill", "Robert E. Quill"), ("Quite Different", "Zed Other")}


def test_established_names_are_no_typing_errors(spark):
    surnames = "Abgot Ferulik Gimnec Hotravol Jusper Kolmanin Lidovic Mepsatu Norbex Quindal Sturvohel Tazmir".split()
    rows = [(f"{g} {s}", None) for g in ("Marta", "Maria") for s in surnames]
    assert linked(spark, rows) == set()
    assert linked(spark, []) == set()


def test_long_names(spark):
    long = "Anna " + "abcdefghij" * 3000
    rows = [(long, None), (long[:-9] + "x" + long[-9:], None), (long[:9] + "y" + long[9:], None)] + [("Bea " + "k" * n + "lmnop" * 18, None) for n in (5, 6)]
    got = linked(spark, rows)
    assert len(got) == 4 and all(a[:3] == b[:3] for a, b in got)


def test_mistyped_surname_with_initials(spark):
    """It goes to the only author one typing error away; two such authors, another initial or a short surname say nothing."""
    names = ["Zora W. Pavjaukek", "Pavajukek, Z. W.", "Jon Latnurinag", "Lathurinag J", "Rui Kolmanin", "Roy Kolmarin", "R. Kolmavin", "Q. Latnurinay", "Tom Lu", "T. Su"]
    assert linked(spark, [(n, None) for n in names]) == {("Pavajukek, Z. W.", "Zora W. Pavjaukek"), ("Jon Latnurinag", "Lathurinag J")}
