import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from colophon.functions import text as T
from colophon.functions import urls as U

SAMPLES = ["", "abc", "Étude", "ＡＢＣ  x", "  Straße \t", "naïve Søren Ł", "ﬁne", "e\u0301", "\u00a0pad\u00a0", None, "Σίσυφος", "١٢"]


def run(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in df.select("i", function(F.col("v"))).orderBy("i").collect()]


def test_fold(spark):
    want = [None if s is None else "".join(ch for ch in unicodedata.normalize("NFKD", s) if not "\u0300" <= ch <= "\u036f").lower() for s in SAMPLES]
    assert run(spark, T.fold, SAMPLES) == want
    assert [None if s is None else T.fold_text(s) for s in SAMPLES] == want


def test_norm_text_and_title(spark):
    want = [None if s is None else " ".join(unicodedata.normalize("NFKC", s).casefold().split()) for s in SAMPLES]
    assert run(spark, T.norm_text, SAMPLES) == want
    assert run(spark, T.norm_title, ["A-b c!", "***", None]) == ["abc", "", None]


def test_strip_and_lines(spark):
    assert run(spark, T.strip, [" a\u2003", "\n", None]) == ["a", "", None]
    assert run(spark, T.is_padded, [" a", "a", "  "]) == [True, False, False]
    assert run(spark, T.is_blank, [" \u00a0", "a", ""]) == [True, False, True]
    assert run(spark, T.is_multiline, ["a\rb", "a b"]) == [True, False]


def test_codes_and_addresses(spark):
    assert run(spark, T.humanize, ["research_article", "non-english_x", "", None]) == ["Research Article", "Non English X", "Not specified", "Not specified"]
    assert run(spark, T.doi_url, ["10.1/a b", "10.1", "/x", "10.1/", "10.1/a/b(c)~"]) == ["https://doi.org/10.1/a%20b", None, None, None, "https://doi.org/10.1/a%2Fb(c)~"]
    assert run(spark, lambda c: c.rlike(T.DOI_SHAPE), ["10.1234/x", "10.123/x", "10.1234/x\u00a0y", "https://doi.org/10.1234/x"]) == [True, False, False, False]
    assert run(spark, U.path_key, ["HTTP://A.org/P/q?x#y", "https://b.org", None]) == ["http://a.org/P/q", "https://b.org", None]
    assert run(spark, lambda c: U.joined(F.lit("https://e.org/a/b"), c), ["c.png", "/d", "https://f.org/x"]) == ["https://e.org/a/c.png", "https://e.org/d", "https://f.org/x"]


@pytest.mark.parametrize("host", ["localhost", "a.local", "10.0.0.1", "0x7f.1", "::1", "name", "a.example", "x" * 64 + ".org", "224.0.0.1", "b\u3002internal"])
def test_private_hosts(host):
    assert U.host_is_private(host)


@pytest.mark.parametrize("host", ["example.com", "münchen.de", "8.8.8.8", "a-b.org.", "sub.example.org"])
def test_public_hosts(host):
    assert not U.host_is_private(host)


def test_punctuation_of_addresses():
    assert U.split_punctuation("https://e.org/a_(b).") == ("https://e.org/a_(b)", ".")
    assert U.split_punctuation("https://e.org/a)'") == ("https://e.org/a", ")'")


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab.,;:!')](", max_size=12))
def test_punctuation_keeps_everything(tail):
    address, rest = U.split_punctuation("https://e.org/" + tail)
    assert address + rest == "https://e.org/" + tail


def test_addresses_in_notes():
    assert U.scan_note("see https://e.org/x, then") == ("see , then", [])
    assert U.scan_note("ftp://e.org/x")[1] == ["notes_url_private_scheme"]
    assert U.scan_note("http://u:p@a.test/")[1] == ["notes_url_credentials", "notes_url_private_host"]
    assert U.scan_note("http://[::1")[1] == ["notes_url_format"]


PRIVATE = ["papers (private)/x", "file:///tmp/a", "smb://host/x", "%APPDATA%\\x", "$HOME is", "${HOME:-x}", "!CD!", "C:\\data\\x", "\\\\host\\share", "//host/path", "~/x", "./a", "/etc/passwd", "folder/file.txt"]
HARMLESS = ["ratio 1/2", "$A/B$", "~1/2 of it", "and/or", "50 % of x", "C: minor", "a note"]


def test_private_references(spark):
    found = run(spark, U.private_reference, PRIVATE + HARMLESS)
    assert all(x is not None for x in found[: len(PRIVATE)])
    assert found[len(PRIVATE) :] == [None] * len(HARMLESS)


def test_numbers_and_words(spark):
    n = lambda c: c.cast("long")
    assert run(spark, lambda c: T.counted(n(c), "record"), ["1", "1200", "0"]) == ["1 record", "1,200 records", "0 records"]
    assert run(spark, T.trim_slashes, ["//a/b/", "a", "/"]) == ["a/b", "a", ""]
    assert run(spark, T.as_number, ["2020", "x", "", None, "1e2"]) == [2020.0, 0.0, 0.0, 0.0, 100.0]
