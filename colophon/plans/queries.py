"""Registry of the core queries: each runs over whole tables; where SQL can say the same, ORACLES has it."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.functions import text as T
from colophon.functions import urls as U
from colophon.operators import constraints as C
from colophon.operators import diff as D
from colophon.operators import html_clean as H
from colophon.operators import schema_rules as R
from colophon.operators import search as S
from colophon.operators import validate as V
from colophon.session import materialize, scratch_path, ship_package
from colophon.tables import table

LATEST_YEAR = 2028
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its name, with SQL for the same result."""

    def add(f):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship_package(spark)
            return f(spark, folder)

        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = sql
        return run

    return add


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "records")


def _rules(spark: SparkSession, folder: str) -> V.Rules:
    return V.Rules(table(spark, folder, "vocab"), table(spark, folder, "removed_dois"), R.record_schema(), LATEST_YEAR)


def _one_to_one() -> tuple[str, str]:
    """Characters with a compatibility form of one character, and these forms, for the SQL side."""
    pairs = [(chr(c), unicodedata.normalize("NFKC", chr(c))) for block in ((0xA0, 0x180), (0x2000, 0x2070), (0x3000, 0x3001), (0xFF01, 0xFFEF)) for c in range(*block)]
    pairs = [(a, b) for a, b in pairs if a != b and len(b) == 1 and b != "'"]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def _sql_norm(x: str) -> str:
    """NFKC and case folding in SQL, for the characters that occur."""
    a, b = _one_to_one()
    out = f"nfc_normalize(translate({x}, '{a}', '{b}'))"
    for ch in "ﬁﬂ¼½¾™…´¨¯¸˘˙˚˛˜˝":
        out = f"replace({out}, '{ch}', '{unicodedata.normalize('NFKC', ch)}')"
    return f"replace(replace(lower({out}), 'ß', 'ss'), 'ς', 'σ')"


SPACE = r"[\s\x{85}\x{1c}-\x{1f}\p{Z}]"


def _sql_strip(x: str) -> str:
    return rf"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


SQL_DOI = f"lower({_sql_strip('doi')})"
EDGES = "e AS (SELECT record_id AS src, CAST(generate_subscripts(related, 1) - 1 AS INTEGER) AS idx, unnest(related).record_id AS dst, unnest(related).relationship_type AS type FROM records)"
AUTHORS = "a AS (SELECT record_id, CAST(generate_subscripts(authors, 1) - 1 AS INTEGER) AS position, unnest(authors) AS a FROM records)"

# Search.


@query("SELECT record_id, title, publication_year FROM records WHERE document_type = 'review' AND publication_stage = 'publication'")
def facet_filter(spark, folder):
    return S.search(_records(spark, folder), S.SearchSpec(document_type="review", publication_stage="publication")).select("record_id", "title", "publication_year")


@query("SELECT record_id, publication_year FROM records WHERE publication_year BETWEEN 1995 AND 2010")
def year_range_active(spark, folder):
    return S.search(_records(spark, folder), S.SearchSpec(year_from=1995, year_to=2010)).select("record_id", "publication_year")


@query("SELECT record_id, publication_year FROM records")
def year_range_inactive(spark, folder):
    """The range that covers all years is no condition: records without a year stay."""
    return S.search(_records(spark, folder), S.SearchSpec(year_from=0, year_to=9999)).select("record_id", "publication_year")


@query("SELECT CAST(min(publication_year) AS INTEGER) AS low, CAST(max(publication_year) AS INTEGER) AS high FROM records")
def year_bounds(spark, folder):
    return _records(spark, folder).agg(F.min("publication_year").alias("low"), F.max("publication_year").alias("high"))


@query("SELECT record_id FROM records WHERE record_status IS NULL OR record_status = ''")
def status_missing_filter(spark, folder):
    return S.search(_records(spark, folder), S.SearchSpec(status=T.MISSING)).select("record_id")


HAY = "concat_ws(' ', record_id, title, journal, doi, CAST(publication_year AS VARCHAR), document_type, publication_stage, language_status, record_status, record_notes, array_to_string(list_filter(flatten([list_transform(authors, lambda x: x.name), list_transform(authors, lambda x: x.canonical_name)]), lambda x: x IS NOT NULL AND x <> ''), ' '))"


@query(f"SELECT record_id FROM records WHERE contains(strip_accents({_sql_norm(HAY)}), lower(strip_accents('Étude par TITRAGE')))")
def search_folded(spark, folder):
    return S.search(_records(spark, folder), S.SearchSpec(query="Étude par TITRAGE")).select("record_id")


@query(f"SELECT record_id FROM records WHERE document_type = 'research_article' AND coalesce(record_status, '') = '' AND publication_year BETWEEN 1990 AND 2022 AND contains(lower(strip_accents({HAY})), 'synthese')")
def search_combined(spark, folder):
    return S.search(_records(spark, folder), S.SearchSpec(document_type="research_article", status=T.MISSING, year_from=1990, year_to=2022, query="SYNTHÈSE")).select("record_id")


@query("SELECT CAST(count(*) FILTER (document_type = 'review') AS BIGINT) AS visible, CAST(count(*) AS BIGINT) AS total FROM records")
def visible_counts(spark, folder):
    return S.counts(_records(spark, folder), F.col("document_type") == "review")


@query(" UNION ALL ".join(f"SELECT '{f}' AS facet, coalesce(nullif({f}, ''), '__missing__') AS value, CAST(count(*) AS BIGINT) AS n FROM records GROUP BY 2" for f in S.FACETS))
def facet_domains(spark, folder):
    return S.facet_values(_records(spark, folder))


@query("""WITH f AS (SELECT coalesce(nullif(document_type, ''), '__missing__') AS value, CAST(count(*) AS BIGINT) AS n FROM records GROUP BY 1)
  SELECT f.value, coalesce(v.label, CASE WHEN f.value = '__missing__' THEN 'Not specified' ELSE f.value END) AS label, f.n FROM f LEFT JOIN vocab v ON v.vocabulary = 'document_type' AND v.code = f.value""")
def facet_options(spark, folder):
    """The options of a facet with their labels, in the order of these."""
    return S.facet_options(_records(spark, folder), table(spark, folder, "vocab"), "document_type")


@query("SELECT format('{:,}', count(*) FILTER (document_type = 'review')) || ' of ' || format('{:,}', count(*)) || CASE WHEN count(*) = 1 THEN ' record' ELSE ' records' END AS line FROM records")
def result_line(spark, folder):
    return S.result_line(_records(spark, folder), F.col("document_type") == "review")


def _top(name: str, sort: str, sql_order: str | None):
    def run(spark, folder):
        return S.top(_records(spark, folder), sort, 100).select("record_id", "title", "publication_year")

    run.__name__ = name
    query(f"SELECT record_id, title, publication_year FROM records ORDER BY {sql_order} LIMIT 100" if sql_order else None)(run)


_top("sort_year_desc_top", "year-desc", "coalesce(publication_year, 0) DESC, record_id")
_top("sort_year_asc_top", "year-asc", "coalesce(publication_year, 0), record_id")
_top("sort_id_top", "id-asc", "record_id")
_top("sort_title_top", "title-asc", 'title COLLATE "en_us" NULLS FIRST, record_id')

SQL_URL = "replace(replace(replace(replace(replace(replace(url_encode({0}), '%21', '!'), '%27', ''''), '%28', '('), '%29', ')'), '%2A', '*'), '%7E', '~')"
_PREFIX, _SUFFIX = "split_part(doi, '/', 1)", "regexp_replace(doi, '^[^/]*/', '')"
SQL_DOI_URL = f"CASE WHEN contains(doi, '/') AND {_PREFIX} <> '' AND {_SUFFIX} <> '' THEN 'https://doi.org/' || {SQL_URL.format(_PREFIX)} || '/' || {SQL_URL.format(_SUFFIX)} END"


@query(f"SELECT record_id, {SQL_DOI_URL} AS doi_url FROM records")
def doi_urls(spark, folder):
    return _records(spark, folder).select("record_id", T.doi_url(F.col("doi")).alias("doi_url"))


@query(f"""SELECT record_id, coalesce(nullif(title, ''), 'Untitled') AS title,
  coalesce(nullif(array_to_string(list_filter(list_transform(authors, lambda x: x.name), lambda x: x IS NOT NULL AND x <> ''), ', '), ''), 'Authors not specified') AS authors,
  coalesce(CAST(publication_year AS VARCHAR), 'Year not specified') AS year, coalesce(nullif(journal, ''), 'Journal not specified') AS journal,
  {SQL_DOI_URL} AS doi_url, coalesce(t.label, '') AS type_label, coalesce(s.label, '') AS stage_label, CAST(coalesce(len(related), 0) AS BIGINT) AS related_count
  FROM records LEFT JOIN vocab t ON t.vocabulary = 'document_type' AND t.code = document_type LEFT JOIN vocab s ON s.vocabulary = 'publication_stage' AND s.code = publication_stage""")
def card_projection(spark, folder):
    return S.cards(_records(spark, folder), table(spark, folder, "vocab"))


@query(f"WITH {EDGES} SELECT e.src, e.idx, e.dst, e.type, coalesce(v.label, '') AS type_label, coalesce(r.title, 'Record not loaded') AS dst_title FROM e LEFT JOIN vocab v ON v.vocabulary = 'relationship_type' AND v.code = e.type LEFT JOIN records r ON r.record_id = e.dst")
def detail_related(spark, folder):
    return S.related_details(_records(spark, folder), table(spark, folder, "vocab"))


@query(f"WITH {AUTHORS} SELECT record_id, CAST(position + 1 AS BIGINT) AS position, a.name AS name, CASE WHEN a.canonical_name <> coalesce(a.name, '') THEN a.canonical_name END AS canonical FROM a")
def detail_authors(spark, folder):
    return S.author_details(_records(spark, folder))


@query("SELECT record_id, title, doi FROM records WHERE record_id = '000000001'")
def point_lookup(spark, folder):
    return _records(spark, folder).where("record_id = '000000001'").select("record_id", "title", "doi")


@query("""SELECT record_id, 'file_status' AS key, CAST(to_json(file_status) AS VARCHAR) AS value FROM records WHERE file_status IS NOT NULL
  UNION ALL SELECT record_id, 'origin', origin FROM records WHERE origin IS NOT NULL
  UNION ALL SELECT record_id, 'added_at', CAST(added_at AS VARCHAR) FROM records WHERE added_at IS NOT NULL
  UNION ALL SELECT record_id, 'updated_at', CAST(updated_at AS VARCHAR) FROM records WHERE updated_at IS NOT NULL""")
def open_schema_residual(spark, folder):
    return S.residual(_records(spark, folder))


@query("SELECT vocabulary, code, array_to_string(list_transform(string_split(regexp_replace(code, '[_-]+', ' ', 'g'), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS words FROM vocab")
def humanize_labels(spark, folder):
    return table(spark, folder, "vocab").select("vocabulary", "code", T.humanize(F.col("code")).alias("words"))


# Constraints. The collection breaks few of them, so some are asked of a copy in which each fiftieth record or so is damaged in a known way.


def _damaged(spark: SparkSession, folder: str) -> DataFrame:
    """All records; some relate to themselves, to one record twice or to none there is, or name an author twice or a name twice."""
    n = F.col("record_id").cast("long") % 50
    no_edges, no_authors = F.array().cast("array<struct<record_id:string,relationship_type:string>>"), F.array().cast("array<struct<name:string,canonical_name:string>>")

    def edge(to, kind: str):
        return F.struct(to.alias("record_id"), F.lit(kind).alias("relationship_type"))

    more = F.when(n == 1, F.array(edge(F.col("record_id"), "is_version_of"))).when(n == 2, F.array(edge(F.lit("000000001"), "corrects"), edge(F.lit("000000001"), "corrects"))).when(n == 3, F.array(edge(F.concat(F.lit("9"), F.substring("record_id", 2, 8)), "corrects"))).otherwise(no_edges)
    first = F.get("authors", F.lit(0))["name"]
    others = F.when(n == 4, F.array(F.struct(F.upper(first).alias("name"), F.lit(None).cast("string").alias("canonical_name")))).when(n == 5, F.array(F.struct(first.alias("name"), first.alias("canonical_name")))).otherwise(no_authors)
    return _records(spark, folder).withColumn("related", F.concat(F.coalesce("related", no_edges), more)).withColumn("authors", F.concat(F.coalesce("authors", no_authors), others))


_N = "CAST(record_id AS BIGINT) % 50"
DAMAGED = f"""damaged AS (SELECT record_id, list_concat(coalesce(related, []), CASE {_N} WHEN 1 THEN [{{'record_id': record_id, 'relationship_type': 'is_version_of'}}]
  WHEN 2 THEN [{{'record_id': '000000001', 'relationship_type': 'corrects'}}, {{'record_id': '000000001', 'relationship_type': 'corrects'}}] WHEN 3 THEN [{{'record_id': '9' || substr(record_id, 2, 8), 'relationship_type': 'corrects'}}] ELSE [] END) AS related,
  list_concat(coalesce(authors, []), CASE {_N} WHEN 4 THEN [{{'name': upper(authors[1].name), 'canonical_name': NULL::VARCHAR}}] WHEN 5 THEN [{{'name': authors[1].name, 'canonical_name': authors[1].name}}] ELSE [] END) AS authors FROM records)"""
DAMAGED_EDGES, DAMAGED_AUTHORS = DAMAGED + ", " + EDGES.replace("FROM records", "FROM damaged"), DAMAGED + ", " + AUTHORS.replace("FROM records", "FROM damaged")


@query("""WITH c AS (SELECT record_id, '$.document_type' AS path, 'document_type' AS vocabulary, document_type AS code FROM records
  UNION ALL SELECT record_id, '$.publication_stage', 'publication_stage', publication_stage FROM records UNION ALL SELECT record_id, '$.language_status', 'language_status', language_status FROM records
  UNION ALL SELECT record_id, '$.record_status', 'record_status', record_status FROM records
  UNION ALL SELECT record_id, '$.file_status.main_pdf', 'file_status', file_status.main_pdf FROM records UNION ALL SELECT record_id, '$.file_status.supplementary_material', 'file_status', file_status.supplementary_material FROM records
  UNION ALL SELECT record_id, '$.file_status.full_text_html', 'file_status', file_status.full_text_html FROM records)
  SELECT vocabulary, code, CAST(count(*) AS BIGINT) AS n, count(*) FILTER (NOT EXISTS (SELECT 1 FROM vocab v WHERE v.vocabulary = c.vocabulary AND v.code = c.code)) > 0 AS unknown FROM c WHERE code IS NOT NULL GROUP BY ALL""")
def coded_value_counts(spark, folder):
    """Use of each code, and whether its vocabulary lacks it."""
    values = C.coded_values(_records(spark, folder)).where("vocabulary <> 'relationship_type'").groupBy("vocabulary", "code").agg(F.count(F.lit(1)).alias("n"))
    known = F.broadcast(table(spark, folder, "vocab").select("vocabulary", "code", F.lit(False).alias("u")))
    return values.join(known, ["vocabulary", "code"], "left").select("vocabulary", "code", "n", F.coalesce("u", F.lit(True)).alias("unknown"))


@query(f"""WITH {EDGES}, c AS (SELECT record_id, '$.document_type' AS path, 'document_type' AS vocabulary, document_type AS code FROM records
  UNION ALL SELECT record_id, '$.publication_stage', 'publication_stage', publication_stage FROM records UNION ALL SELECT record_id, '$.language_status', 'language_status', language_status FROM records
  UNION ALL SELECT record_id, '$.record_status', 'record_status', record_status FROM records
  UNION ALL SELECT record_id, '$.file_status.main_pdf', 'file_status', file_status.main_pdf FROM records UNION ALL SELECT record_id, '$.file_status.supplementary_material', 'file_status', file_status.supplementary_material FROM records
  UNION ALL SELECT record_id, '$.file_status.full_text_html', 'file_status', file_status.full_text_html FROM records
  UNION ALL SELECT src, '$.related[' || idx || '].relationship_type', 'relationship_type', type FROM e)
  SELECT record_id, path, vocabulary, code FROM c WHERE code IS NOT NULL AND NOT EXISTS (SELECT 1 FROM vocab v WHERE v.vocabulary = c.vocabulary AND v.code = c.code AND v.code <> 'on_hold' AND v.code <> 'book')""")
def vocab_anti_join(spark, folder):
    """Values that a vocabulary without 'on_hold' and 'book' lacks."""
    vocab = table(spark, folder, "vocab").where(~F.col("code").isin("on_hold", "book"))
    return C.unknown_codes(_records(spark, folder), vocab)


@query("WITH t AS (SELECT code, inverse FROM vocab WHERE vocabulary = 'relationship_type' AND code <> 'is_corrected_by') SELECT t.code, t.inverse, CASE WHEN b.code IS NULL THEN 'inverse_missing' ELSE 'inverse_not_reciprocal' END AS problem FROM t LEFT JOIN t b ON b.code = t.inverse WHERE b.code IS NULL OR b.inverse IS DISTINCT FROM t.code")
def vocab_inverse_check(spark, folder):
    """The relationship types without one of them."""
    return C.vocabulary_inverses(table(spark, folder, "vocab").where("code <> 'is_corrected_by'"))


@query("WITH k AS (SELECT vocabulary, code, split_part(label, ' ', 1) AS label, lower(split_part(label, ' ', 1)) AS key FROM vocab), f AS (SELECT vocabulary, key, min(code) AS first_code FROM k GROUP BY 1, 2 HAVING count(*) > 1) SELECT k.vocabulary, k.code, k.label, f.first_code FROM k JOIN f USING (vocabulary, key) WHERE k.code <> f.first_code")
def vocab_duplicate_labels(spark, folder):
    """Labels used twice if only their first words are taken."""
    return C.duplicate_labels(table(spark, folder, "vocab").withColumn("label", F.split("label", " ")[0]))


@query(f"WITH {DAMAGED_EDGES} SELECT src, idx, dst, type FROM e WHERE NOT EXISTS (SELECT 1 FROM records r WHERE r.record_id = e.dst)")
def edge_target_missing(spark, folder):
    return C.target_missing(_damaged(spark, folder))


@query(f"""WITH {EDGES}, v AS (SELECT code AS type, inverse FROM vocab WHERE vocabulary = 'relationship_type' AND inverse IS NOT NULL)
  SELECT e.src, e.idx, e.dst, e.type, v.inverse, CAST((SELECT count(*) FROM e b WHERE b.src = e.dst AND b.dst = e.src AND b.type = v.inverse) AS BIGINT) AS found
  FROM e JOIN v USING (type) WHERE e.src <> e.dst AND EXISTS (SELECT 1 FROM records r WHERE r.record_id = e.dst) AND (SELECT count(*) FROM e b WHERE b.src = e.dst AND b.dst = e.src AND b.type = v.inverse) <> 1""")
def edge_reciprocity(spark, folder):
    return C.reciprocity(_records(spark, folder), table(spark, folder, "vocab"))


@query(f"WITH {DAMAGED_EDGES} SELECT src, dst, type, CAST(count(*) AS BIGINT) AS n FROM e GROUP BY ALL HAVING count(*) > 1")
def dup_edge(spark, folder):
    return C.duplicate_relations(_damaged(spark, folder))


@query(f"WITH {DAMAGED_EDGES} SELECT src, idx, dst, type FROM e WHERE src = dst")
def self_edge(spark, folder):
    return C.self_relations(_damaged(spark, folder))


@query(f"SELECT record_id, doi FROM records WHERE doi IS NOT NULL AND {SQL_DOI} IN (SELECT {SQL_DOI} FROM (SELECT doi FROM removed_dois UNION ALL SELECT doi FROM incoming) WHERE doi IS NOT NULL)")
def removed_key_semi(spark, folder):
    """Records whose key is on the removed list, or among those of the incoming rows, taken for a longer list."""
    keys = table(spark, folder, "removed_dois").select("doi").unionByName(table(spark, folder, "incoming").select("doi"))
    return C.removed_keys(_records(spark, folder), keys)


@query(rf"""WITH k AS (SELECT idx, doi, {SQL_DOI} AS key FROM removed_dois), f AS (SELECT key, min(idx) AS first_idx FROM k WHERE key IS NOT NULL GROUP BY 1)
  SELECT idx, 'entry' AS problem FROM k WHERE doi IS NULL UNION ALL SELECT idx, 'syntax' FROM k WHERE NOT regexp_matches(doi, '^10\.[0-9]{{4,9}}/[^\s\x{{85}}\p{{Z}}]+$')
  UNION ALL SELECT k.idx, 'duplicate' FROM k JOIN f USING (key) WHERE f.first_idx < k.idx""")
def removed_list_check(spark, folder):
    return C.removed_list_problems(table(spark, folder, "removed_dois"))


@query(f"WITH k AS (SELECT record_id, {SQL_DOI} AS doi_key FROM records WHERE doi IS NOT NULL), g AS (SELECT doi_key, CAST(count(*) AS BIGINT) AS members, min(record_id) AS first_id FROM k GROUP BY 1 HAVING count(*) > 1) SELECT record_id, doi_key, members, first_id FROM k JOIN g USING (doi_key)")
def duplicate_key_members(spark, folder):
    return C.duplicate_dois(_records(spark, folder))


@query(rf"WITH k AS (SELECT record_id, regexp_replace({_sql_norm('title')}, '[^\p{{L}}\p{{N}}]', '', 'g') AS k, publication_year AS y FROM records WHERE title IS NOT NULL AND publication_year IS NOT NULL), g AS (SELECT k, y, CAST(count(*) AS BIGINT) AS members, min(record_id) AS first_id FROM k GROUP BY 1, 2 HAVING count(*) > 1) SELECT record_id, y AS publication_year, members, first_id FROM k JOIN g USING (k, y)")
def possible_duplicate_title_year(spark, folder):
    return C.possible_duplicates(_records(spark, folder)).drop("title_key")


@query(f"WITH {DAMAGED_AUTHORS}, k AS (SELECT record_id, position, trim(regexp_replace({_sql_norm('coalesce(a.canonical_name, a.name)')}, '{SPACE}+', ' ', 'g')) AS key FROM a), f AS (SELECT record_id, key, min(position) AS first_position FROM k WHERE key <> '' GROUP BY 1, 2) SELECT record_id, position, first_position FROM k JOIN f USING (record_id, key) WHERE position > first_position")
def dup_in_array(spark, folder):
    return C.duplicate_authors(_damaged(spark, folder))


@query(f"WITH {DAMAGED_AUTHORS} SELECT record_id, position FROM a WHERE a.canonical_name = a.name")
def redundant_canonical(spark, folder):
    return C.redundant_canonical(_damaged(spark, folder))


_LINES = " UNION ALL ".join(
    [f"SELECT record_id, '$.{c}' AS path, {c} AS value FROM records" for c in C.LINES]
    + [f"SELECT record_id, '$.file_status.{c}', file_status.{c} FROM records" for c in C.FILES]
    + ["SELECT record_id, '$.authors[' || position || '].name', a.name FROM a", "SELECT record_id, '$.authors[' || position || '].canonical_name', a.canonical_name FROM a"]
    + ["SELECT src, '$.related[' || idx || '].record_id', dst FROM e", "SELECT src, '$.related[' || idx || '].relationship_type', type FROM e"]
)


@query(f"""WITH {AUTHORS}, {EDGES}, v AS (SELECT *, {_sql_strip('value')} AS s FROM ({_LINES}) WHERE value IS NOT NULL)
  SELECT record_id, path, 'blank_string' AS problem FROM v WHERE s = '' UNION ALL SELECT record_id, path, 'whitespace' FROM v WHERE s <> value AND s <> ''
  UNION ALL SELECT record_id, path, 'multiline_value' FROM v WHERE regexp_matches(value, '[\\r\\n]')""")
def blank_padded_multiline(spark, folder):
    return C.line_problems(_records(spark, folder))


@query(r"SELECT record_id, doi FROM records WHERE NOT regexp_matches(doi, '^10\.[0-9]{4,9}/[^\s\x{85}\p{Z}]+$') OR NOT regexp_matches(record_id, '^[0-9]{9}$')")
def key_syntax(spark, folder):
    return _records(spark, folder).where(~F.col("doi").rlike(T.DOI_SHAPE) | ~F.col("record_id").rlike(T.RECORD_ID_SHAPE)).select("record_id", "doi")


@query(r"""WITH u AS (SELECT record_id, doi AS url FROM records WHERE contains(doi, '://'))
  SELECT record_id, url, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) IN ('http', 'https') AS web, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1)) AS host,
  lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*')) || substr(regexp_replace(url, '[?#].*$', ''), len(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*')) + 1) AS key,
  regexp_matches(url, '^[a-z]+://[^/]*\.(alt|example|home|home\.arpa|internal|invalid|lan|local|localdomain|localhost|onion|test)(/|$)') AS private FROM u""")
def url_parts(spark, folder):
    """Addresses among the DOIs: host, key, and whether the host is public."""
    u = _records(spark, folder).where(F.col("doi").contains("://")).select("record_id", F.col("doi").alias("url"))
    private = F.array_contains(U.scanned(F.col("url"))["codes"], "notes_url_private_host")
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1))
    return u.select("record_id", "url", U.is_web_address(F.col("url")).alias("web"), host.alias("host"), U.path_key(F.col("url")).alias("key"), private.alias("private"))


def _sql_pattern(p: str) -> str:
    """A pattern of a private place for an engine without look-around: what must not stand beside the match is matched instead."""
    p = re.sub(r"\(\?<!\[([^\]]*(?:\\\][^\]]*)*)\]\)", lambda m: f"(?:^|[^{m.group(1)}])", p).replace(r"(?<!\$)", r"(?:^|[^$])").replace(r"(?<![:/])", "(?:^|[^:/])")
    p = p.replace(r"(?!/)[^/\s]", r"[^/\s]").replace(r"(?=[^\s]*[\\/])[^\s]*", r"[^\s]*[\\/]").replace(r"(?![^\s]*\$)[^\s]*", r"[^\s$]*(?:\s|$)")
    return re.sub(r"\(\?!\[([^\]]*)\]\)", lambda m: f"(?:$|[^{m.group(1)}])", p)


SQL_PRIVATE = [_sql_pattern(p) for p in U.PRIVATE_REFERENCES]
_PRIVATE_CASE = "CASE " + " ".join(f"WHEN regexp_matches(t, '{p}') THEN {i}" for i, p in enumerate(SQL_PRIVATE, 1)) + " END"


@query(f"SELECT doc_id, CAST({_PRIVATE_CASE} AS INTEGER) AS pattern, '' AS codes FROM (SELECT doc_id, regexp_replace(text, 'https?://[^ \\r\\n<>\"]+', '', 'g') AS t FROM documents WHERE text IS NOT NULL) WHERE {_PRIVATE_CASE} IS NOT NULL")
def private_reference_scan(spark, folder):
    """Documents that give away a private place, read as notes: the first pattern, after public addresses are taken out."""
    notes = table(spark, folder, "documents").where("text is not null").select("doc_id", U.scanned(F.col("text")).alias("s"))
    return notes.select("doc_id", U.private_reference(F.col("s.text")).alias("pattern"), F.array_join("s.codes", ",").alias("codes")).where("pattern is not null or codes <> ''")


_REQUIRED = ["document_type", "publication_stage", "title", "authors", "doi", "publication_year", "journal", "language_status", "file_status"]
_TEXTS = ["document_type", "publication_stage", "title", "journal", "language_status", "record_status", "record_notes", "doi"]


@query(
    " UNION ALL ".join(
        [f"SELECT record_id, 'schema.required' AS code, '$.{c}' AS path FROM records WHERE {c} IS NULL" for c in _REQUIRED]
        + [f"SELECT record_id, 'schema.minLength', '$.{c}' FROM records WHERE {c} = ''" for c in _TEXTS]
        + [r"SELECT record_id, 'schema.pattern', '$.doi' FROM records WHERE NOT regexp_matches(doi, '^10\.[0-9]{4,9}/[^\s\x{85}\p{Z}]+$')"]
        + ["SELECT record_id, 'schema.minimum', '$.publication_year' FROM records WHERE publication_year < 1800", "SELECT record_id, 'schema.minItems', '$.authors' FROM records WHERE len(authors) < 1"]
        + ["SELECT record_id, 'schema.uniqueItems', '$.related' FROM records WHERE len(list_distinct(related)) < len(related)"]
        + ["SELECT record_id, 'schema.required', '$.authors[' || position || '].name' FROM (SELECT record_id, generate_subscripts(authors, 1) - 1 AS position, unnest(authors) AS a FROM records) WHERE a.name IS NULL"]
        + ["SELECT record_id, 'schema.minLength', '$.authors[' || position || '].name' FROM (SELECT record_id, generate_subscripts(authors, 1) - 1 AS position, unnest(authors) AS a FROM records) WHERE a.name = ''"]
        + ["SELECT record_id, 'schema.minLength', '$.authors[' || position || '].canonical_name' FROM (SELECT record_id, generate_subscripts(authors, 1) - 1 AS position, unnest(authors) AS a FROM records) WHERE a.canonical_name = ''"]
    )
)
def schema_rule_findings(spark, folder):
    return R.check(_records(spark, folder).drop("origin", "added_at", "updated_at"), R.record_schema(), "record_id").select("record_id", "code", "path")


@query("SELECT record_id FROM records WHERE publication_year > 2015")
def future_years(spark, folder):
    """Years beyond a bound that is passed in."""
    return _records(spark, folder).where(F.col("publication_year") > 2015).select("record_id")


def _all_findings_sql() -> str:
    """Severity and code of every finding, put together from the SQL of the single rules."""
    whole = ORACLES["vocab_anti_join"].replace(" AND v.code <> 'on_hold' AND v.code <> 'book'", "")
    notes = "(SELECT record_notes AS t FROM records WHERE record_notes IS NOT NULL AND NOT contains(record_notes, '://'))"
    private = " OR ".join(f"regexp_matches(t, '{p}')" for p in SQL_PRIVATE)
    parts = [
        ("error", "code", f"({ORACLES['schema_rule_findings']})"),
        ("error", "'record.' || problem", f"({ORACLES['blank_padded_multiline']})"),
        ("error", "CASE WHEN vocabulary = 'relationship_type' THEN 'record.unknown_relationship_type' ELSE 'record.unknown_vocabulary_value' END", f"({whole})"),
        ("error", "'record.publication_year_future'", f"(SELECT 1 FROM records WHERE publication_year > {LATEST_YEAR})"),
        ("error", "'record.filename'", "(SELECT 1 FROM records WHERE NOT regexp_matches(record_id, '^[0-9]{9}$'))"),
        ("error", "'record.redundant_canonical_name'", f"({ORACLES['redundant_canonical'].replace(DAMAGED_AUTHORS, AUTHORS)})"),
        ("error", "'record.duplicate_author'", f"({ORACLES['dup_in_array'].replace(DAMAGED_AUTHORS, AUTHORS)})"),
        ("error", "'record.self_relationship'", f"({ORACLES['self_edge'].replace(DAMAGED_EDGES, EDGES)})"),
        ("error", "'record.duplicate_relationship'", f"(WITH {EDGES} SELECT unnest(range(count(*) - 1)) FROM e GROUP BY src, dst, type HAVING count(*) > 1)"),
        ("error", "'record.blank_string'", f"(SELECT 1 FROM {notes} WHERE {_sql_strip('t')} = '')"),
        ("error", "'record.private_reference'", f"(SELECT 1 FROM {notes} WHERE {private})"),
        ("error", "'record.duplicate_id'", "(SELECT 1 FROM records GROUP BY record_id HAVING count(*) > 1)"),
        ("error", "'database.removed_doi'", f"(SELECT 1 FROM records WHERE {SQL_DOI} IN (SELECT {SQL_DOI} FROM removed_dois WHERE doi IS NOT NULL))"),
        ("error", "'database.duplicate_doi'", f"({ORACLES['duplicate_key_members']})"),
        ("warning", "'database.possible_duplicate'", f"({ORACLES['possible_duplicate_title_year']})"),
        ("error", "'relationship.target_missing'", f"({ORACLES['edge_target_missing'].replace(DAMAGED_EDGES, EDGES)})"),
        ("error", "'relationship.inverse_count'", f"({ORACLES['edge_reciprocity']})"),
        ("error", "'relationship.' || problem", f"({ORACLES['vocab_inverse_check'].replace(chr(32) + 'AND code <> ' + chr(39) + 'is_corrected_by' + chr(39), '')})"),
        ("error", "'removed_doi.' || problem", f"({ORACLES['removed_list_check']})"),
        ("error", "'vocabulary.duplicate_label'", f"({ORACLES['vocab_duplicate_labels'].replace('split_part(label, ' + chr(39) + ' ' + chr(39) + ', 1)', 'label').replace('label AS label', 'label')})"),
        ("error", "'vocabulary.key'", "(SELECT 1 FROM vocab WHERE NOT regexp_matches(code, '^[a-z][a-z0-9_]*$'))"),
    ]
    return " UNION ALL ".join(f"SELECT '{severity}' AS severity, {code} AS code FROM {rows} AS r{i}" for i, (severity, code, rows) in enumerate(parts))


@query(f"SELECT severity, code, CAST(count(*) AS BIGINT) AS n FROM ({_all_findings_sql()}) GROUP BY 1, 2")
def findings_by_code(spark, folder):
    """All rules over the whole collection, counted by severity and code."""
    return V.by_code(V.findings(_records(spark, folder), _rules(spark, folder)))


@query()
def findings_top(spark, folder):
    """The first findings of the report in order."""
    found = V.findings(_records(spark, folder), _rules(spark, folder))
    return found.orderBy(*V.order(found)).limit(V.SHOWN)


@query(f"""SELECT CAST(count(*) FILTER (sev = 'error') AS BIGINT) AS errors, CAST(count(*) FILTER (sev = 'warning') AS BIGINT) AS warnings, count(*) FILTER (sev = 'error') = 0 AS passed FROM (
  SELECT 'error' AS sev FROM (SELECT count(*) OVER (PARTITION BY {SQL_DOI}) AS n FROM records WHERE doi IS NOT NULL) WHERE n > 1
  UNION ALL SELECT 'error' FROM records WHERE doi IS NOT NULL AND {SQL_DOI} IN (SELECT {SQL_DOI} FROM removed_dois WHERE doi IS NOT NULL)
  UNION ALL SELECT 'warning' FROM (SELECT count(*) OVER (PARTITION BY regexp_replace({_sql_norm('title')}, '[^\\p{{L}}\\p{{N}}]', '', 'g'), publication_year) AS n FROM records WHERE title IS NOT NULL AND publication_year IS NOT NULL) WHERE n > 1)""")
def key_findings_summary(spark, folder):
    """Errors and warnings of the rules on keys only, as far as SQL can follow; collection_summary counts all rules."""
    records, none = _records(spark, folder), F.lit("")
    parts = [
        V.finding(C.duplicate_dois(records), "error", "database.duplicate_doi", none, none),
        V.finding(C.removed_keys(records, table(spark, folder, "removed_dois")), "error", "database.removed_doi", none, none),
        V.finding(C.possible_duplicates(records), "warning", "database.possible_duplicate", none, none),
    ]
    return V.summary(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query(f"SELECT CAST(count(*) FILTER (severity = 'error') AS BIGINT) AS errors, CAST(count(*) FILTER (severity = 'warning') AS BIGINT) AS warnings, count(*) FILTER (severity = 'error') = 0 AS passed FROM ({_all_findings_sql()})")
def collection_summary(spark, folder):
    """Errors and warnings of all rules over the whole collection, and whether it passed."""
    return V.summary(V.findings(_records(spark, folder), _rules(spark, folder)))


@query("WITH r AS (SELECT DISTINCT CAST(record_id AS BIGINT) AS v FROM match_groups), g AS (SELECT v, v - row_number() OVER (ORDER BY v) AS g FROM r) SELECT CAST(min(v) AS BIGINT) AS lo, CAST(max(v) AS BIGINT) AS hi, CAST(count(*) AS BIGINT) AS n FROM g GROUP BY g")
def id_ranges(spark, folder):
    return C.id_ranges(table(spark, folder, "match_groups"), "record_id")


@query("WITH n AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS number FROM documents) SELECT doc_id, source, CAST(number AS BIGINT) AS number, CAST(number // 12 + 1 AS BIGINT) AS sheet, CAST(number % 12 // 4 AS BIGINT) AS grid_row, CAST(number % 12 % 4 AS BIGINT) AS grid_column FROM n")
def chunk_grid(spark, folder):
    return C.grid(table(spark, folder, "documents").select("doc_id", "source"), "doc_id", 12, 4, "source")


@query("SELECT doc_id, sha256(text) AS sha256, CAST(octet_length(encode(text)) AS BIGINT) AS bytes FROM documents")
def payload_hash(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("long").alias("bytes"))


# Changes.


def _head(records: DataFrame) -> DataFrame:
    """A later snapshot made from the collection: some records removed, some changed, some under a new id."""
    n = F.col("record_id").cast("long")
    edited = records.where(n % 11 != 3).withColumn("title", F.when(n % 7 == 0, F.concat("title", F.lit(" (rev.)"))).otherwise(F.col("title")))
    edited = edited.withColumn("publication_year", F.when(n % 21 == 0, F.col("publication_year") + 1).otherwise(F.col("publication_year")))
    new = records.where(n % 33 == 3).withColumn("record_id", F.concat(F.lit("9"), F.substring("record_id", 2, 8)))
    return edited.unionByName(new)


_COMPARED = ["title", "publication_year", "doi", "journal"]
_SNAPSHOT = """h AS (SELECT record_id, CASE WHEN CAST(record_id AS BIGINT) % 7 = 0 THEN title || ' (rev.)' ELSE title END AS title, CASE WHEN CAST(record_id AS BIGINT) % 21 = 0 THEN publication_year + 1 ELSE publication_year END AS publication_year, doi, journal FROM records WHERE CAST(record_id AS BIGINT) % 11 <> 3
  UNION ALL SELECT '9' || substr(record_id, 2, 8), title, publication_year, doi, journal FROM records WHERE CAST(record_id AS BIGINT) % 33 = 3),
  c AS (SELECT CASE WHEN b.record_id IS NULL THEN 'added' WHEN h.record_id IS NULL THEN 'removed' ELSE 'modified' END AS kind, b.record_id AS old_id, h.record_id AS new_id,
  CASE WHEN b.record_id IS NULL OR h.record_id IS NULL THEN '' ELSE concat_ws(',', CASE WHEN b.doi IS DISTINCT FROM h.doi THEN 'doi' END, CASE WHEN b.journal IS DISTINCT FROM h.journal THEN 'journal' END, CASE WHEN b.publication_year IS DISTINCT FROM h.publication_year THEN 'publication_year' END, CASE WHEN b.title IS DISTINCT FROM h.title THEN 'title' END) END AS fields
  FROM records b FULL JOIN h ON b.record_id = h.record_id)"""


@query(f"WITH {_SNAPSHOT} SELECT kind, 'records/' || old_id || '.yaml' AS old_path, 'records/' || new_id || '.yaml' AS new_path, old_id, new_id, fields AS changed_fields FROM c WHERE kind <> 'modified' OR fields <> ''")
def snapshot_diff(spark, folder):
    base = _records(spark, folder).select("record_id", *_COMPARED)
    return D.compare(base, _head(base)).withColumn("changed_fields", F.array_join("changed_fields", ","))


@query(f"WITH {_SNAPSHOT} SELECT CAST(count(*) FILTER (kind = 'added') AS BIGINT) AS added, CAST(count(*) FILTER (kind = 'removed') AS BIGINT) AS removed, CAST(count(*) FILTER (kind = 'modified') AS BIGINT) AS modified, CAST(0 AS BIGINT) AS renamed, CAST(0 AS BIGINT) AS copied FROM c WHERE kind <> 'modified' OR fields <> ''")
def snapshot_counts(spark, folder):
    base = _records(spark, folder).select("record_id", *_COMPARED)
    return D.kind_counts(D.compare(base, _head(base)))


@query()
def rename_similarity(spark, folder):
    """Changes of a snapshot whose removed records come back under another id."""
    base = materialize(_records(spark, folder).drop("added_at", "updated_at"), "base")
    return D.detect(base, materialize(_head(base), "head")).withColumn("changed_fields", F.array_join("changed_fields", ","))


_LOG = "l AS (SELECT change_id, min(arrived_at) AS arrived_at, any_value(kind) AS kind, any_value(old_id) AS old_id, any_value(new_id) AS new_id, any_value(changed_fields) AS changed_fields, any_value(changed_at) AS changed_at FROM record_changes GROUP BY 1)"


@query(f"WITH {_LOG} SELECT " + ", ".join(f"CAST(count(*) FILTER (kind = '{k}') AS BIGINT) AS {k}" for k in D.KINDS) + " FROM l")
def change_kind_counts(spark, folder):
    return D.kind_counts(D.first_sent(table(spark, folder, "record_changes")))


@query(f"WITH {_LOG} SELECT change_id, kind, arrived_at FROM l")
def change_first_sent(spark, folder):
    return D.first_sent(table(spark, folder, "record_changes")).select("change_id", "kind", "arrived_at")


@query(f"WITH {_LOG} SELECT change_id, changed_at, arrived_at FROM l WHERE arrived_at > changed_at + INTERVAL 1 DAY")
def change_late(spark, folder):
    return D.late(D.first_sent(table(spark, folder, "record_changes"))).select("change_id", "changed_at", "arrived_at")


@query(f"WITH {_LOG} SELECT change_id, new_id FROM l WHERE kind IN ('added', 'copied', 'renamed') AND new_id IN (SELECT old_id FROM l WHERE kind = 'removed')")
def change_id_reuse(spark, folder):
    """New ids that a removed record had."""
    log = D.first_sent(table(spark, folder, "record_changes"))
    return D.reused_ids(log, log.where("kind = 'removed'").select("old_id"), "old_id").select("change_id", "new_id")


@query(f"""WITH {_LOG}, t AS (SELECT *, array_to_string(list_sort(list_filter(list_distinct(changed_fields), lambda x: x IN ('title', 'authors', 'doi'))), ',') AS touched FROM l)
  SELECT code, detail, CAST(count(*) AS BIGINT) AS n FROM (SELECT 'change.record_removed' AS code, '' AS detail FROM t WHERE kind = 'removed' UNION ALL SELECT 'change.id_changed', '' FROM t WHERE kind = 'renamed' AND old_id <> new_id
  UNION ALL SELECT 'change.identity_modified', touched FROM t WHERE kind IN ('modified', 'renamed') AND touched <> '') GROUP BY ALL""")
def change_warnings(spark, folder):
    return D.warnings(D.first_sent(table(spark, folder, "record_changes"))).groupBy("code", "detail").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT old_id AS record_id, CAST(count(DISTINCT change_id) AS BIGINT) AS changes, max(changed_at) AS last_changed FROM record_changes WHERE old_id IS NOT NULL GROUP BY 1")
def change_history(spark, folder):
    """Changes of each record, each counted once; the record with a tenth of the rows is counted by partial aggregates."""
    log = D.first_sent(table(spark, folder, "record_changes")).where("old_id is not null")
    return log.groupBy(F.col("old_id").alias("record_id")).agg(F.count(F.lit(1)).alias("changes"), F.max("changed_at").alias("last_changed"))


@query("SELECT change_id, any_value(kind) AS kind FROM record_changes GROUP BY 1")
def stream_distinct_changes(spark, folder):
    """The change log read as a stream, each change once: state holds the ids of 30 days of arrival, and what is repeated later than
    that would be told by the table of changes taken before (there are none yet)."""
    from colophon.streaming import changes

    path = f"{folder}/record_changes.parquet"
    schema = spark.read.parquet(path).schema
    # as a pattern, the table may be a folder or a single file
    source = spark.readStream.schema(schema).parquet(f"{folder}/record_changes.parque[t]")
    out = scratch_path(spark, "stream")
    history = spark.createDataFrame([], "change_id long")
    stream = changes.new_changes(source, history).select("change_id", "kind")
    done = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "-state").trigger(availableNow=True).start()
    done.awaitTermination()
    return spark.read.schema("change_id long, kind string").parquet(out)


# Pages and assets.

_TAGS = "|".join(H.FORBIDDEN)


@query(rf"SELECT doc_id, CAST(len(regexp_extract_all(text, '(?i)<({_TAGS})\b')) AS BIGINT) AS n FROM documents")
def html_forbidden_tags(spark, folder):
    return table(spark, folder, "documents").select("doc_id", H.forbidden_count(F.col("text")).alias("n"))


@query(r"""SELECT doc_id, md5(regexp_replace(text, '(?i)\s(class|style|srcset|sizes|loading|decoding|data-[\w-]+|on[a-z]+)\s*=\s*("[^"]*"|''[^'']*'')', '', 'g')) AS stripped,
  CAST(len(regexp_extract_all(text, '(?i)\s(class|style|srcset|sizes|loading|decoding|data-[\w-]+|on[a-z]+)\s*=\s*("[^"]*"|''[^'']*'')')) AS BIGINT) AS n FROM documents""")
def html_attr_strip(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.md5(H.without_attributes(F.col("text"))).alias("stripped"), H.attribute_count(F.col("text")).alias("n"))


@query(rf"""SELECT doc_id, concat_ws(',', CASE WHEN regexp_matches(text, '(?i)<!doctype') THEN 'doctype' END, CASE WHEN regexp_matches(text, '(?i)<(html|head)\b') THEN 'document' END,
  CASE WHEN len(regexp_extract_all(text, '(?i)<body\b')) <> 1 THEN 'body' END, CASE WHEN len(regexp_extract_all(text, '(?i)<({_TAGS})\b')) > 0 THEN 'forbidden' END) AS broken FROM documents""")
def html_postconditions(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.array_join(H.broken_promises(F.col("text")), ",").alias("broken"))


@query()
def html_clean_full(spark, folder):
    """All documents as archival fragments with counts."""
    pages = table(spark, folder, "documents").select("doc_id", H.cleaned(F.col("text")).alias("c"))
    return pages.select("doc_id", "c.html", "c.source_bytes", "c.output_bytes", "c.removed_elements", "c.removed_attributes", F.array_join("c.problems", ",").alias("problems"))


@query()
def html_stats(spark, folder):
    rows = html_clean_full(spark, folder)
    return rows.agg(F.count(F.lit(1)).alias("pages"), F.sum("source_bytes").alias("source_bytes"), F.sum("output_bytes").alias("output_bytes"), F.sum("removed_elements").alias("removed_elements"))


def _manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Two renditions of a portrait for each author name of the records, as an asset manifest."""
    names = _records(spark, folder).select(F.explode("authors").alias("a")).select(F.col("a.name").alias("name")).where("name is not null").distinct()
    h = F.conv(F.substring(F.md5("name"), 1, 6), 16, 10).cast("long")
    one = names.select("name", h.alias("h")).withColumn("pos", F.explode(F.array(F.lit(0), F.lit(1))))
    return one.select(F.lit("image").alias("kind"), F.concat(F.lit("https://Img.example.org/"), F.md5("name"), F.lit(".png#v"), F.col("pos")).alias("url"), F.concat(F.lit("assets/"), F.md5("name"), F.lit("-"), F.col("pos"), F.lit(".png")).alias("path"), (F.col("h") % (100 + F.col("pos"))).cast("int").alias("width"), F.lit(50).alias("height"), F.col("h").alias("bytes"), F.lit("image/png").alias("content_type"), "pos")


_MANIFEST = "m AS (SELECT 'https://Img.example.org/' || md5(name) || '.png' AS url, 'assets/' || md5(name) || '-' || pos || '.png' AS path, CAST(('0x' || substr(md5(name), 1, 6)) AS BIGINT) AS h, pos FROM (SELECT DISTINCT unnest(authors).name AS name FROM records), (VALUES (0), (1)) p(pos) WHERE name IS NOT NULL)"


@query(f"WITH {_MANIFEST} SELECT url, arg_max(path, (h % (100 + pos)) * 50 * 10000 - pos) AS path FROM m GROUP BY url")
def asset_argmax(spark, folder):
    return H.best_renditions(_manifest(spark, folder)).select("url", "path")


@query(f"""WITH {_MANIFEST}, b AS (SELECT url, arg_max(path, (h % (100 + pos)) * 50 * 10000 - pos) AS path FROM m GROUP BY url),
  c AS (SELECT record_id AS page_id, CAST(generate_subscripts(authors, 1) - 1 AS INTEGER) AS image, md5(unnest(authors).name) AS k FROM records)
  SELECT c.page_id, c.image, CASE WHEN b.path IS NOT NULL THEN CASE WHEN c.image % 2 = 0 THEN 0 ELSE 1 END END AS pos, b.path FROM c LEFT JOIN b ON b.url = 'https://Img.example.org/' || c.k || '.png'""")
def asset_lookup_fallback(spark, folder):
    """Portraits of each record's authors: even places by the address itself, odd ones by its key only."""
    one = _records(spark, folder).select(F.col("record_id").alias("page_id"), F.posexplode("authors").alias("image", "a")).select("page_id", "image", F.md5("a.name").alias("k"))
    even = F.col("image") % 2 == 0
    urls = F.array(F.when(even, F.concat(F.lit("https://Img.example.org/"), "k", F.lit(".png"))).otherwise(F.lit("https://img.example.org/none.png")), F.concat(F.lit("HTTPS://img.EXAMPLE.org/"), F.col("k"), F.lit(".png?w=1")))
    return H.resolve_assets(one.select("page_id", "image", F.posexplode(urls).alias("pos", "url")), H.best_renditions(_manifest(spark, folder)))


@query("""WITH i AS (SELECT source AS page_id, sha256(text) AS path, doc_id AS image, CASE WHEN lang = 'en' THEN '' ELSE lang END AS alt FROM documents)
  SELECT page_id, path, min(image) AS image, arg_min(alt, image) FILTER (alt IS NOT NULL AND alt <> '') AS alt FROM i GROUP BY 1, 2""")
def asset_dedup_keep_first(spark, folder):
    """Equal texts of a source once, with the language of the first copy that tells it."""
    images = table(spark, folder, "documents").select(F.col("source").alias("page_id"), F.sha2("text", 256).alias("path"), F.col("doc_id").alias("image"), F.when(F.col("lang") == "en", "").otherwise(F.col("lang")).alias("alt"))
    return H.keep_first(images).select("page_id", "path", "image", "alt")


# Functions on whole tables, each with the SQL for the same values; long values are compared by their hash.


@query("SELECT doc_id, md5('data:text/plain;base64,' || base64(encode(text))) AS url FROM documents")
def data_urls(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.md5(H.data_url(F.encode("text", "UTF-8"), F.lit("text/plain"))).alias("url"))


@query("SELECT doc_id, md5(replace(replace(text, '|', '\\|'), chr(10), ' ')) AS cell FROM documents")
def markdown_cells(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.md5(T.markdown_cell(F.col("text"))).alias("cell"))


@query("SELECT source, arg_max(doc_id, n_chars * 1000000000 - doc_id) AS doc_id, max(n_chars) AS n_chars FROM documents GROUP BY 1")
def longest_text(spark, folder):
    """The longest text of each source, the first of equal ones."""
    order = F.struct("n_chars", (-F.col("doc_id")).alias("first"))
    return table(spark, folder, "documents").groupBy("source").agg(F.max_by("doc_id", order).alias("doc_id"), F.max("n_chars").alias("n_chars"))


_FIGURE = "coalesce(" + ", ".join(f"nullif(regexp_extract(text, '{p}', 1), '')" for p in H.FIGURE_NUMBER) + ")"


@query(f"SELECT doc_id, CAST({_FIGURE} AS INTEGER) AS number FROM documents WHERE {_FIGURE} IS NOT NULL")
def figure_numbers(spark, folder):
    """The first figure that each text names, as a description would be read."""
    return table(spark, folder, "documents").select("doc_id", H.figure_number(F.col("text")).alias("number")).where("number is not null")


@query(r"SELECT doc_id, md5(regexp_replace(regexp_replace(text, '(?s)<!--.*?-->', '', 'g'), '(?i)</?noscript\b[^>]*>', '', 'g')) AS page FROM documents")
def html_without_noscript(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.md5(H.without_noscript(F.col("text"))).alias("page"))


def _sql_without_forbidden() -> str:
    out = "text"
    for tag in H.FORBIDDEN:
        out = rf"regexp_replace({out}, '(?is)<{tag}\b[^>]*>.*?</{tag}\s*>', '', 'g')"
    return rf"regexp_replace({out}, '(?is)<(?:link|embed|input)\b[^>]*>', '', 'g')"


@query(f"SELECT doc_id, md5({_sql_without_forbidden()}) AS page FROM documents")
def html_without_forbidden(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.md5(H.without_forbidden(F.col("text"))).alias("page"))


@query(f"SELECT record_id, trim(regexp_replace({_sql_norm('title')}, '{SPACE}+', ' ', 'g')) AS title FROM records")
def normal_titles(spark, folder):
    return _records(spark, folder).select("record_id", T.norm_text(F.col("title")).alias("title"))


@query("SELECT record_id, title FROM records ORDER BY coalesce(publication_year, 0) DESC, record_id LIMIT 50")
def reset_search(spark, folder):
    """What is shown when nothing is asked for: all records, the latest first."""
    spec = S.SearchSpec()
    return S.top(S.search(_records(spark, folder), spec), spec.sort, 50).select("record_id", "title")


@query("SELECT record_id, split_part(doi, '#', 1) AS bare, regexp_replace(doi, '^/+|/+$', '', 'g') AS trimmed FROM records")
def addresses_trimmed(spark, folder):
    return _records(spark, folder).select("record_id", U.without_fragment(F.col("doi")).alias("bare"), T.trim_slashes(F.col("doi")).alias("trimmed"))


@query("SELECT new_id AS record_id, CAST(count(*) AS BIGINT) AS n FROM record_changes WHERE new_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def duplicate_ids(spark, folder):
    """Ids that several rows of the change log give to a record, taken for a collection in which ids repeat."""
    return C.duplicate_ids(table(spark, folder, "record_changes").select(F.col("new_id").alias("record_id")))


@query("SELECT incoming_id, coalesce(TRY_CAST(regexp_extract(doi, '[0-9]{4}') AS DOUBLE), 0) AS number FROM incoming")
def numbers_in_keys(spark, folder):
    """The first four digits of a key as a number, 0 without any."""
    return table(spark, folder, "incoming").select("incoming_id", T.as_number(F.regexp_extract("doi", "[0-9]{4}", 0)).alias("number"))
