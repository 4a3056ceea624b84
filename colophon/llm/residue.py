"""Template residue, filler, error and access pages, and notices asking for scripts, in or beside real text.

Texts are cut into segments. A few segments carry a trusted label: template syntax that was never filled in, messages that
servers, browsers and interpreters give everywhere, and filler text. From them labels spread along two kinds of links, until
the connected components that hold a trusted segment are exhausted:

* near-duplicates: partitioned SimHash tables give the pairs within HAMMING bits, all of them, and the edit similarity of the
  texts confirms or refuses each pair;
* companions: a segment that unrelated documents repeat, and that stands beside labelled segments in a good part of them, belongs
  to the same pages. That is how the wordings of a site are learned that no list knows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.operators.skew import SMALL_BYTES
from colophon.session import materialize

SIMILARITY = 0.8
#: The sketch is cut into BLOCKS parts; each is a table, which is asked for its own value and all values within FLIPS bits.
BLOCKS, BITS, FLIPS = 4, 16, 2
#: Of so many differing bits, one block at least has no more than FLIPS: the tables find all pairs within this distance.
HAMMING = BLOCKS * (FLIPS + 1) - 1
#: Shorter segments say too little for a near-duplicate; they count if they carry a label themselves.
LEAST_WORDS = 4
#: A segment of more words than LONG hands on its label only to those whose first OPENING words are alike too: the rest may be real text.
LONG, OPENING = 40, 10
#: A companion is repeated in so many unrelated documents at least, and stands beside labels in so many and in such a share of them.
REPEATED, BESIDE, SHARE = 3, 2, 0.2
#: A word is filler if so many of the known filler segments have it; a segment is filler if most of its words are.
FILLER_SHARE = 0.05
MOSTLY = 0.8

# How templates mark what is still to be filled in. FIELD stands for the name of a field.
FIELD = r"[A-Za-z][A-Za-z_. ]{0,40}"
PLACEHOLDERS = [
    r"\{\{\s*FIELD\s*(?:\|[^{}]*)?\}\}",
    r"<%=?\s*FIELD\s*%>",
    r"\{%-?\s*[a-z]+ FIELD\s*-?%\}",
    r"[$#@]!?\{FIELD\}(?!\$)",
    r"\[\[\s*FIELD\s*\]\]",
    r"\{FIELD\|[^{}]*\}",
    r"<\s*FIELD goes here\s*>",
    r"\[(?i:insert|enter|add|your) FIELD\]",
    r"\[FIELD (?:TBD|TBA|TODO)\]",
    r"<!--\s*FIELD\s*-->",
    r"~~FIELD~~",
    r"%%FIELD%%",
    r"@@FIELD@@",
    r"__[A-Za-z][A-Za-z_]*[A-Za-z]__",
    r"\((?:TODO|FIXME)\b[^()]*\)",
    r"\bXXX FIELD XXX\b",
    r"&lt;\s*FIELD\s*&gt;",
    r"\b(?i:enter) FIELD in this box\b",
    r"\b(?i:type your) FIELD in this space\b",
    r"\b(?i:your) FIELD here \((?i:max)\b",
    r"\b[A-Za-z][A-Za-z_]*(?: [A-Za-z]+)?: (?:undefined|null|NaN|\[object Object\])",
    r"\[object Object\]",
]
# How messages begin that servers, browsers, interpreters and templates give everywhere, in the normal form below.
SEEDS = [
    r"lorem ipsum\b",
    r"(?:this is )?(?:an? |some )?(?:dummy|sample|placeholder|filler) (?:text|paragraph|copy)\b",
    r"(?:please |you (?:need|have) to |bitte |veuillez |por favor )?(?:enable|activate|allow|turn on|switch on|aktivieren sie|activer|activez|active|ative|habilite|habilitar) (?:el |o |le |la )?(?:javascript|js|scripts?|cookies)\b",
    r"(?:it (?:looks|seems) (?:as if |like |that )?|we detected that )?(?:javascript|js|scripting|cookies)(?: support)? (?:is|are|must be|has been|have been) (?:disabled|switched off|turned off|blocked|required|enabled|allowed)\b",
    r"without (?:javascript|js|scripts|(?:active )?scripting)\b",
    r"(?:http )?(?:error|status)(?: code)? 000\b",
    r"000 (?:not found|forbidden|bad gateway|bad request|gone|unauthori[sz]ed|service unavailable|gateway time ?out|internal server error|too many requests)\b",
    r"(?:internal server error|(?:page|file|document) not found|access denied|service unavailable|too many requests|session expired|application error)\b",
    r"(?:erreur interne du serveur|page introuvable|accès refusé|interner serverfehler|seite nicht gefunden|zugriff verweigert|página no encontrada|acceso denegado|página não encontrada|acesso negado)\b",
    r"traceback most recent call last\b",
    r"java lang \w+(?:exception|error)\b",
    r"sqlstate\b",
    r"err [a-z0-9]{4,}$",
]

SENTENCE = r"(?<=[.!?])[\"”’)]*\s+|\s*\n\s*|\s+[|]\s+|\s+-\s+(?=[A-Z0-9<])|</?(?:html|body|h\d|p|div|title|head)[^<>]*>"
ANY_PLACEHOLDER = "(?:" + "|".join(p.replace("FIELD", FIELD) for p in PLACEHOLDERS) + ")"
#: A placeholder that a running sentence speaks about: plain words in lower case on both sides.
SPOKEN_OF = r"\p{Ll}[\p{L}'-]*,?\s" + ANY_PLACEHOLDER + r",?\s\p{Ll}"
ANY_SEED = "^(?:" + "|".join(SEEDS) + ")"


def segments(documents: DataFrame) -> DataFrame:
    """``(doc_id, unit, segment, norm, key, before, after)`` of all texts: sentences, lines and cells that hold something.

    ``unit`` is the same for documents of equal text, ``key`` stands for the norm, ``before`` and ``after`` for those of the
    neighbours. Null and empty texts have no segments.
    """
    cut = documents.select("doc_id", F.filter(F.split("text", SENTENCE), lambda s: F.trim(s) != "").alias("cut"))
    cut = cut.select("doc_id", "cut", F.transform("cut", normal).alias("norms"))
    keyed = cut.select("doc_id", "cut", "norms", F.transform("norms", lambda n: F.xxhash64(n)).alias("keys"), F.xxhash64("cut").alias("unit"))
    placed = F.transform("cut", lambda s, i: F.struct(s.alias("segment"), F.get("norms", i).alias("norm"), F.get("keys", i).alias("key"), F.get("keys", i - 1).alias("before"), F.get("keys", i + 1).alias("after")))
    return keyed.select("doc_id", "unit", F.inline(placed))


def normal(segment: Column) -> Column:
    """Words in lower case with 0 for each digit."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(segment), r"\p{N}", "0"), r"[^\p{L}\p{N}]+", " "))


# Every placeholder has one of these; the patterns are tried on such segments only.
HINTS = ["{", "<", "[", "%%", "~~", "@@", "__", "(TODO", "(FIXME", "XXX", "&lt;", "in this box", "in this space", " here (", ": undefined", ": null", ": NaN"]


def has_placeholder(segment: Column) -> Column:
    hint = F.lit(False)
    for h in HINTS:
        hint = hint | segment.contains(h)
    return F.when(hint, _placeholder(segment)).otherwise(False)


def _placeholder(segment: Column) -> Column:
    return F.regexp_replace(segment, SPOKEN_OF, " ").rlike(ANY_PLACEHOLDER)


def mostly_template(segment: Column, norm: Column) -> Column:
    """Whether placeholders make up half of a segment at least; what they are filled in with then leaves no near-duplicate."""
    return F.length(normal(F.regexp_replace(segment, ANY_PLACEHOLDER, " "))) * 2 <= F.length(norm)


def has_seed(norm: Column) -> Column:
    return norm.rlike(ANY_SEED)


def word_count(norm: Column) -> Column:
    return F.length(norm) - F.length(F.replace(norm, F.lit(" "), F.lit(""))) + 1


def filler_words(marked: DataFrame) -> list[str]:
    """Words of the filler text in use: those in at least FILLER_SHARE of the segments that open as filler is known to open.

    There are at most 1/FILLER_SHARE times as many as such a segment has words on average.
    """
    known = marked.where(F.col("norm").startswith("lorem ipsum")).select(F.array_distinct(F.split("norm", " ")).alias("words"))
    total = known.count()
    counted = known.select(F.explode("words").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= FILLER_SHARE * total)
    return [r["w"] for r in counted.collect()]


def _feature_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit number for each three bytes in a row."""
    h = data[:-2].astype(np.uint64) << np.uint64(16) | data[1:-1].astype(np.uint64) << np.uint64(8) | data[2:].astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(factor)
        h ^= h >> np.uint64(shift)
    return h * np.uint64(0xD6E8FEB86659FD93)


#: For each byte its bits, the highest first, in the eight bytes of a number, so that one sum counts eight bits.
_LANES = sum((np.arange(256, dtype=np.uint64) >> np.uint64(7 - j) & np.uint64(1)) << np.uint64(8 * j) for j in range(8))
#: So many bits can be counted in a byte.
_PIECE = 255


def _bit_counts(hashes: np.ndarray, first: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """For each row, given by its first hash and their number, how many of the hashes have each bit."""
    pieces = -(-grams // _PIECE)
    owner = np.repeat(np.arange(len(grams)), pieces)
    within = (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * _PIECE
    starts = first[owner] + within
    ends = starts + np.minimum(grams[owner] - within, _PIECE)
    # what lies between the rows is summed apart
    edges = np.stack([starts, ends], 1).ravel()
    lanes = _LANES[hashes.view(np.uint8).reshape(-1, 8)]
    sums = np.add.reduceat(np.concatenate([lanes, np.zeros((1, 8), np.uint64)]), edges, axis=0)[::2]
    return np.add.reduceat(sums.view(np.uint8).reshape(-1, 64), np.cumsum(pieces) - pieces, axis=0, dtype=np.int32)


def simhash_array(texts: pa.Array) -> pa.Array:
    """SimHash of each text over its three-byte grams: the sign of the sum of their hashes' bits. Short texts and nulls give 0."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    grams = np.maximum(np.diff(offsets) - 2, 0)
    out = np.zeros(len(grams), np.int64)
    ends = np.cumsum(grams)
    at = 0
    while at < len(grams):  # blocks keep the table of lanes small whatever the length of the texts
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 200_000, "right")))
        some = np.flatnonzero(grams[at:end]) + at
        if len(some):
            low, high = offsets[at], offsets[end]
            counts = _bit_counts(_feature_hashes(data[low:high]), offsets[some] - low, grams[some])
            out[some] = np.packbits(2 * counts > grams[some][:, None], axis=1).view(np.int64)[:, 0]
        at = end
    return pa.array(out, pa.int64())


def sketch(norm: Column) -> Column:
    return F.arrow_udf(simhash_array, "bigint")(norm)


def is_near(norm: Column, other: Column) -> Column:
    """Whether the edit similarity of two segments is SIMILARITY at least."""
    edits = F.floor(F.greatest(F.length(norm), F.length(other)) * (1 - SIMILARITY) + 1e-6).cast("int")
    return F.call_function("levenshtein", norm, other, edits) >= 0


def hands_on(seed: Column, norm: Column) -> Column:
    """Whether a labelled segment hands on its label to another one: they are near, and so are their openings if it is long."""
    opening = is_near(F.substring_index(seed, " ", OPENING), F.substring_index(norm, " ", OPENING))
    return is_near(seed, norm) & ((F.size(F.split(seed, " ")) <= LONG) | opening)


def _flips() -> list[int]:
    """All numbers of BITS bits of which FLIPS at most are set."""
    out = {0}
    for _ in range(FLIPS):
        out |= {x | 1 << b for x in out for b in range(BITS)}
    return sorted(out)


def _tables(of: Column) -> list[Column]:
    """The blocks of a sketch, each marked with its number, so that one column holds the rows of all tables."""
    return [F.shiftrightunsigned(of, BITS * i).bitwiseAND(F.lit((1 << BITS) - 1)).bitwiseOR(F.lit(i << BITS)).cast("int") for i in range(BLOCKS)]


def _sized(df: DataFrame, row_bytes: int) -> DataFrame:
    """A table to be broadcast if it is small, and to be shuffled with the other side if it isn't."""
    return F.broadcast(df) if df.count() * row_bytes <= SMALL_BYTES else df


def near(sketched: DataFrame, frontier: DataFrame) -> DataFrame:
    """``key`` of the sketched segments that near-duplicates in the frontier hand their label to; both have key, norm and sketch.

    A segment has one row a table, a frontier row one for each value within FLIPS bits of its block: the large side stays
    small, and no pair within HAMMING bits is lost.
    """
    seeds = frontier.select(F.col("key").alias("seed"), F.col("sketch").alias("seed_sketch"), F.col("norm").alias("seed_norm"))
    flips = F.array(*[F.lit(x) for x in _flips()])
    asked = seeds.select("seed", "seed_sketch", F.explode(F.array(*_tables(F.col("seed_sketch")))).alias("b")).select("seed", "seed_sketch", F.explode(F.transform(flips, lambda x: F.col("b").bitwiseXOR(x))).alias("block"))
    asked = F.broadcast(asked) if frontier.count() * len(_flips()) * BLOCKS * 48 <= 2 * SMALL_BYTES else asked
    held = sketched.select("key", "norm", "sketch", F.explode(F.array(*_tables(F.col("sketch")))).alias("block"))
    close = held.join(asked, "block").where((F.bit_count(F.col("sketch").bitwiseXOR(F.col("seed_sketch"))) <= HAMMING) & (F.col("key") != F.col("seed")))
    pairs = close.select("key", "norm", "seed").distinct().join(seeds.select("seed", "seed_norm"), "seed")
    return pairs.where(hands_on(F.col("seed_norm"), F.col("norm"))).select("key").distinct()


def beside(marked: DataFrame, fresh: DataFrame) -> DataFrame:
    """``(key, unit)`` of the segments that stand beside one of the freshly labelled ones."""
    neighbours = marked.select("key", "unit", F.explode(F.array_compact(F.array("before", "after"))).alias("neighbour")).where("neighbour <> key")
    return neighbours.join(_sized(fresh.select(F.col("key").alias("neighbour")).distinct(), 16), "neighbour", "left_semi").select("key", "unit").distinct()


def companions(touched: DataFrame, repeated: DataFrame) -> DataFrame:
    """``key`` of the repeated segments that stand beside labels often enough; ``repeated`` has the number of unrelated documents."""
    counted = touched.groupBy("key").agg(F.count_distinct("unit").alias("beside")).where(F.col("beside") >= BESIDE)
    return repeated.join(counted, "key").where(F.col("beside") >= F.col("units") * SHARE).select("key")


def spread(marked: DataFrame, sketched: DataFrame, labels: DataFrame) -> DataFrame:
    """``(key, reason)`` of all segments that a trusted label reaches. ``labels`` has key and reason of the trusted ones.

    Each round follows the links of what was labelled in the round before, until there is nothing new.
    """
    counted = marked.select("key", "unit").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("units"))
    repeated = materialize(counted.where(F.col("units") >= REPEATED), "repeated")
    fresh = labels
    touched = None
    while not fresh.isEmpty():
        frontier = materialize(sketched.join(_sized(fresh.select("key"), 16), "key", "left_semi"), "frontier")
        hits = materialize(beside(marked, fresh), "beside")
        touched = hits if touched is None else touched.unionByName(hits)
        found = near(sketched, frontier).withColumn("reason", F.lit("near-duplicate")).unionByName(companions(touched, repeated).withColumn("reason", F.lit("companion")))
        found = found.groupBy("key").agg(F.max("reason").alias("reason"))
        fresh = materialize(found.join(labels.select("key"), "key", "left_anti"), "fresh")
        labels = labels.unionByName(fresh)
    return labels


def residue_segments(documents: DataFrame) -> DataFrame:
    """``(doc_id, segment, norm, reason)`` of all segments that are residue: placeholder, message, filler, near-duplicate or companion."""
    # each test in a column of its own, so that the optimizer doesn't repeat it where its result is used
    tested = segments(documents).withColumn("placeholder", has_placeholder(F.col("segment"))).withColumn("message", has_seed(F.col("norm")))
    # template syntax is trusted where it is most of a segment; what else such a segment says may stand in any text
    template = F.when(F.col("placeholder"), mostly_template(F.col("segment"), F.col("norm")) & (word_count(F.col("norm")) >= LEAST_WORDS)).otherwise(False)
    reason = F.when(F.col("placeholder"), F.lit("placeholder")).when(F.col("message"), F.lit("message"))
    marked = tested.select("doc_id", "unit", "key", "before", "after", "segment", "norm", reason.alias("reason"), (F.col("message") & ~F.col("placeholder") | template).alias("trusted"))
    marked = materialize(marked, "marked")
    words = filler_words(marked)
    if words:
        share = F.size(F.filter(F.split("norm", " "), lambda w: w.isin(words))) / word_count(F.col("norm"))
        filler = marked.where("reason is null").where((word_count(F.col("norm")) >= LEAST_WORDS) & (share >= MOSTLY))
    else:
        filler = marked.limit(0)
    trusted = marked.where("trusted").select("key", "reason").unionByName(filler.select("key", F.lit("filler").alias("reason")))
    labels = materialize(trusted.groupBy("key").agg(F.max("reason").alias("reason")), "labels")
    if labels.isEmpty():
        return marked.where("reason is not null").select("doc_id", "segment", "norm", "reason")
    distinct = marked.where(word_count(F.col("norm")) >= LEAST_WORDS).groupBy("key").agg(F.first("norm").alias("norm"))
    sketched = materialize(distinct.withColumn("sketch", sketch(F.col("norm"))), "sketched")
    reached = materialize(spread(marked, sketched, labels), "spread")
    by_label = marked.where("reason is not null").select("doc_id", "segment", "norm", "reason")
    # an exact copy of a trusted segment is its nearest duplicate
    told = F.when(F.col("found").isin("message", "placeholder"), F.lit("near-duplicate")).otherwise(F.col("found"))
    by_link = marked.where("reason is null").join(reached.withColumnRenamed("reason", "found"), "key").select("doc_id", "segment", "norm", told.alias("reason"))
    return by_label.unionByName(by_link)


def residue_documents(documents: DataFrame) -> DataFrame:
    """``doc_id`` of the documents with residue, alone or beside real text. A text that merely speaks about such things,
    a null and an empty text are no cases; documents with equal texts are all reported; an empty table gives an empty result."""
    return residue_segments(documents).select("doc_id").distinct()
