"""Queries of the training-data operators for the driver's registry."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.llm import canonical_list, formatting, fusion, incremental, leakage, mojibake, names, packing, residue, unify
from colophon.session import materialize, ship_package
from colophon.tables import table

#: The vocabulary file by which the queries measure texts.
VOCABULARY = os.environ.get("COLOPHON_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    _, rec = formatting.formatting_duplicates(formatting.record_values(table(spark, folder, "records")))
    _, raw = formatting.formatting_duplicates(formatting.body_values(table(spark, folder, "raw_records")))
    return rec.select(F.lit("records").alias("table_name"), "first_id", "copy_id").unionByName(raw.select(F.lit("raw_records").alias("table_name"), "first_id", "copy_id"))


def p1_copy_counts(spark: SparkSession, folder: str) -> DataFrame:
    """One row per distinct record with its number of copies."""
    ship_package(spark)
    rec, _ = formatting.formatting_duplicates(formatting.record_values(table(spark, folder, "records")))
    raw, _ = formatting.formatting_duplicates(formatting.body_values(table(spark, folder, "raw_records")))
    return rec.select(F.lit("records").alias("table_name"), "first_id", "copies").unionByName(raw.select(F.lit("raw_records").alias("table_name"), "first_id", "copies"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    journals = table(spark, folder, "journals")
    records = table(spark, folder, "records").select("record_id", "journal")
    free = records.join(journals.select(F.col("title").alias("journal")), "journal", "left_anti").where("journal is not null")
    mapped = canonical_list.map_to_list(free, "journal", journals, "journal_id", ["title", "abbreviation"])
    return canonical_list.match_rows(free, "journal", mapped).select("record_id", F.coalesce("entry", F.lit(0)).cast("int").alias("journal_id"))


def p4_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    """Report of the values for which no entry is close enough, with their number of rows."""
    journals = table(spark, folder, "journals")
    mapped = canonical_list.map_to_list(table(spark, folder, "records"), "journal", journals, "journal_id", ["title", "abbreviation"])
    return mapped.where("entry is null").select(F.col("value").alias("journal"), "n")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return p5_restored(spark, folder).select("record_id", "field_name", "author_pos")


def p5_restored(spark: SparkSession, folder: str) -> DataFrame:
    """The damaged fields with the original text where it can be told."""
    ship_package(spark)
    return mojibake.garbled_fields(mojibake.fields_of(table(spark, folder, "records")))


def p6_unified(spark: SparkSession, folder: str) -> DataFrame:
    """The fields that are not in their consistent form, with that form; fields under a wrong encoding are left to problem 5."""
    ship_package(spark)
    fields = mojibake.fields_of(table(spark, folder, "records"))
    encodings, _ = mojibake.learn(fields)
    some = fields.where(mojibake.non_ascii(F.col("text")))
    changed = some.withColumn("unified", unify.unified(F.col("text"))).where("unified <> text")
    return changed.withColumn("_fix", mojibake.restored(F.col("text"), encodings)).where("not _fix.garbled").drop("_fix")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return p6_unified(spark, folder).select("record_id", "field_name", "author_pos")


def _sound_entries(spark: SparkSession, folder: str) -> DataFrame:
    """Author entries ``(name, canonical_name)``; a name under a wrong encoding or not in its consistent form is left out."""
    records = table(spark, folder, "records")
    encodings, _ = mojibake.learn(mojibake.fields_of(records))
    entries = records.select(F.explode("authors").alias("a")).select("a.name", "a.canonical_name").distinct()
    odd = entries.where(mojibake.non_ascii(F.col("name")))
    odd = odd.withColumn("_fix", mojibake.restored(F.col("name"), encodings)).withColumn("_form", unify.unified(F.col("name")))
    odd = odd.withColumn("name", F.when(~F.col("_fix.garbled") & (F.col("_form") == F.col("name")), F.col("name"))).drop("_fix", "_form")
    return odd.unionByName(entries.where(F.col("name").isNull() | ~mojibake.non_ascii(F.col("name"))))


def p7_authors(spark: SparkSession, folder: str) -> DataFrame:
    """Each spelling with the author it denotes."""
    ship_package(spark)
    return names.link_names(materialize(_sound_entries(spark, folder), "entries"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return names.name_pairs(materialize(p7_authors(spark, folder), "linked"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return p9_stretches(spark, folder).select("doc_id", "item_id")


def p9_stretches(spark: SparkSession, folder: str) -> DataFrame:
    """Leaked items with the words of the document they cover."""
    ship_package(spark)
    return leakage.leaks(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


def p9_kept(spark: SparkSession, folder: str) -> DataFrame:
    """The documents without a leaked passage."""
    documents = table(spark, folder, "documents").select("doc_id", "source", "n_chars")
    return leakage.without_leaks(documents, p9_found(spark, folder))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    return residue.residue_documents(table(spark, folder, "documents"))


def p10_segments(spark: SparkSession, folder: str) -> DataFrame:
    """The segments that were found, with the reason."""
    ship_package(spark)
    return residue.residue_segments(table(spark, folder, "documents")).select("doc_id", "segment", "reason")


def _group_tables(spark: SparkSession, folder: str) -> list[DataFrame]:
    return [table(spark, folder, name) for name in ("match_groups", "records", "origins")]


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """The record whose value survives by the stated order, which is total; no posteriors are needed."""
    return fusion.survivors(fusion.sized_claims(*_group_tables(spark, folder)))


def p2_posterior(spark: SparkSession, folder: str) -> DataFrame:
    """The record whose value has the highest posterior after copied votes are discounted."""
    return fusion.survivors(fusion.fuse(*_group_tables(spark, folder)), by="posterior")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return incremental.deduplicate_batches(table(spark, folder, "records"), "record_id", table(spark, folder, "incoming"), "incoming_id", "batch_no")


def p8_containers(spark: SparkSession, folder: str) -> DataFrame:
    """The container of each document, or of each piece of a document that is longer than a container."""
    ship_package(spark)
    documents = table(spark, folder, "documents").select("doc_id", "text")
    sized = documents.select("doc_id", packing.token_count(F.col("text"), spark, VOCABULARY).alias("size"))
    return packing.pack(sized, "doc_id", "size").withColumnRenamed("id", "doc_id")


def p8_fill(spark: SparkSession, folder: str) -> DataFrame:
    """How full the containers are."""
    loads = p8_containers(spark, folder).groupBy("container_id").agg(F.sum("tokens").alias("load"))
    total = loads.agg(F.count(F.lit(1)).alias("containers"), F.sum("load").alias("tokens"), F.max("load").alias("fullest"))
    return total.withColumn("filled", F.round(F.col("tokens") / (F.col("containers") * packing.CAPACITY), 6))


def p8_cover(spark: SparkSession, folder: str) -> DataFrame:
    """What a packing must keep to: every text with a token has its container, none is over its capacity, and only texts that are
    longer than one are split. The number of texts, of overfull containers and of texts split without need."""
    placed = materialize(p8_containers(spark, folder), "placed")
    over = placed.groupBy("container_id").agg(F.sum("tokens").alias("load")).where(F.col("load") > packing.CAPACITY)
    split = placed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("pieces"), F.sum("tokens").alias("size")).where((F.col("pieces") > 1) & (F.col("size") <= packing.CAPACITY))
    parts = [placed.where("tokens > 0").agg(F.count_distinct("doc_id")), over.agg(F.count(F.lit(1))), split.agg(F.count(F.lit(1)))]
    rows = [p.toDF("n").select(*[(F.col("n") if i == k else F.lit(0).cast("long")).alias(c) for k, c in enumerate(("texts", "overfull", "split_without_need"))]) for i, p in enumerate(parts)]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).agg(*[F.sum(c).alias(c) for c in ("texts", "overfull", "split_without_need")])


def p1_record_copies(spark: SparkSession, folder: str) -> DataFrame:
    """The copies among the records only."""
    return formatting.formatting_duplicates(formatting.record_values(table(spark, folder, "records")))[1].select("first_id", "copy_id")


QUERIES = {
    "p1_found": p1_found,
    "p1_copy_counts": p1_copy_counts,
    "p1_record_copies": p1_record_copies,
    "p2_found": p2_found,
    "p2_posterior": p2_posterior,
    "p3_found": p3_found,
    "p4_found": p4_found,
    "p4_unmatched": p4_unmatched,
    "p5_found": p5_found,
    "p5_restored": p5_restored,
    "p6_found": p6_found,
    "p6_unified": p6_unified,
    "p7_authors": p7_authors,
    "p7_found": p7_found,
    "p8_containers": p8_containers,
    "p8_fill": p8_fill,
    "p8_cover": p8_cover,
    "p9_found": p9_found,
    "p9_kept": p9_kept,
    "p9_stretches": p9_stretches,
    "p10_found": p10_found,
    "p10_segments": p10_segments,
}

_DOI = r"""regexp_replace(lower(doi), '^[\s<\[("'']*((https?://)?[a-z0-9.-]*\b(doi|resolver)[a-z0-9.-]*/\s*|doi\s*[:=]?\s*|https?://[^/\s]+/\s*|info:doi/\s*){1,4}', '')"""
_CANON = r"replace(replace(lower(regexp_replace({0}, '[^\p{{L}}\p{{M}}\p{{N}}]+', '', 'g')), 'ß', 'ss'), 'ς', 'σ')"



def _sql_plain(x: str) -> str:
    """plain_title in SQL."""
    x = f"lower({x})"
    for pattern in canonical_list.ADDITIONS:
        x = f"regexp_replace({x}, '{pattern}', '', 'g')"
    words = rf"string_split(regexp_replace({x}, '[^\p{{L}}\p{{M}}\p{{N}}]+', ' ', 'g'), ' ')"
    stop = ", ".join(f"'{w}'" for w in canonical_list.STOP_WORDS)
    forms = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in canonical_list.SHORT_FORMS.items())
    return f"array_to_string(list_transform(list_filter({words}, lambda w: w <> '' AND w NOT IN ({stop})), lambda w: CASE w {forms} ELSE w END), ' ')"


_GRAMS = "CASE WHEN p = '' THEN [] ELSE list_distinct(list_transform(range(1, length(p) + 1), lambda i: substr(' ' || p || ' ', i, 3))) END"
_MAPPED = f"""v AS (SELECT journal, {_sql_plain('journal')} AS p FROM records WHERE journal IS NOT NULL GROUP BY 1),
f AS (SELECT p, min(journal_id) AS entry FROM (SELECT journal_id, {_sql_plain('form')} AS p FROM (SELECT journal_id, unnest([title, abbreviation]) AS form FROM journals) WHERE form IS NOT NULL) WHERE p <> '' GROUP BY 1),
a AS (SELECT p, {_GRAMS} AS g FROM (SELECT DISTINCT p FROM v)), b AS (SELECT p, entry, {_GRAMS} AS g FROM f),
j AS (SELECT a.p, b.p AS q, b.entry, len(list_intersect(a.g, b.g)) AS k, len(a.g) AS m, len(b.g) AS n FROM a, b WHERE len(a.g) > 0),
best AS (SELECT p, min(struct_pack(j := -(k / (m + n - k)), d := levenshtein(p, q), e := entry)).e AS entry FROM j WHERE k / (m + n - k) >= {canonical_list.THRESHOLD} GROUP BY 1),
mapped AS (SELECT v.journal, best.entry FROM v LEFT JOIN best USING (p))"""

ORACLES: dict[str, str] = {
    "p4_found": f"WITH {_MAPPED} SELECT record_id, CAST(coalesce(m.entry, 0) AS INTEGER) AS journal_id FROM records r JOIN mapped m USING (journal) WHERE r.journal NOT IN (SELECT title FROM journals)",
    "p4_unmatched": f"WITH {_MAPPED} SELECT journal, CAST(count(*) AS BIGINT) AS n FROM records JOIN mapped USING (journal) WHERE entry IS NULL GROUP BY 1",
    "p8_cover": "SELECT CAST(count(*) AS BIGINT) AS texts, CAST(0 AS BIGINT) AS overfull, CAST(0 AS BIGINT) AS split_without_need FROM documents WHERE text <> ''",
    "p1_record_copies": f"""
WITH k AS (SELECT record_id, {_CANON.format('title')} AS t, {_CANON.format(_DOI)} AS d FROM records WHERE title IS NOT NULL AND doi IS NOT NULL),
g AS (SELECT t, d, min(record_id) AS first_id, count(*) AS n FROM k GROUP BY 1, 2 HAVING count(*) > 1)
SELECT first_id, record_id AS copy_id FROM k JOIN g USING (t, d) WHERE record_id <> first_id""",
    "p2_found": """
WITH m AS (
  SELECT DISTINCT g.group_id, r.record_id, lower(regexp_replace(r.title, '[^A-Za-z0-9]+', '', 'g')) AS k, r.publication_year AS y, coalesce(o.trust, 0) AS t, coalesce(r.updated_at, TIMESTAMP '0001-01-01') AS u,
    len(list_filter(r.authors, lambda a: trim(a.name) <> '' AND lower(trim(a.name)) NOT IN ('et al.', 'et al', 'and others', 'others', '...'))) AS na
  FROM match_groups g JOIN records r USING (record_id) LEFT JOIN origins o ON o.origin = r.origin),
x AS (SELECT group_id, max(struct_pack(n := len(k), k := k)) AS top FROM m WHERE k <> '' GROUP BY 1),
c AS (
  SELECT m.group_id, 'title' AS field_name, record_id, t, u, CASE WHEN len(m.k) < x.top.n AND (starts_with(x.top.k, m.k) OR len(m.k) < 0.85 * x.top.n) THEN 0 ELSE 1 END AS complete FROM m JOIN x USING (group_id) WHERE m.k <> ''
  UNION ALL SELECT group_id, 'authors', record_id, t, u, na FROM m WHERE na > 0
  UNION ALL SELECT group_id, 'publication_year', record_id, t, u, 1 FROM m WHERE y IS NOT NULL)
SELECT group_id, field_name, record_id FROM c QUALIFY row_number() OVER (PARTITION BY group_id, field_name ORDER BY complete DESC, t DESC, u DESC, record_id) = 1""",
}
