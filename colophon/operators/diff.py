"""Changes between two snapshots of a collection, and the change log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IDENTITY = ["title", "authors", "doi"]
KINDS = ["added", "removed", "modified", "renamed", "copied"]
#: Share of equal content from which a removed and an added record are one that was renamed.
SIMILAR = 0.9
CHANGE = "kind string, old_path string, new_path string, old_id string, new_id string, changed_fields array<string>"


def changed_fields(fields: list[str], old: str = "b", new: str = "h") -> Column:
    """Sorted names of the fields whose values differ; a missing value equals null."""
    return F.array_sort(F.array_compact(F.array(*[F.when(~F.col(f"{old}.{c}").eqNullSafe(F.col(f"{new}.{c}")), F.lit(c)) for c in fields])))


def path_of(record_id: Column) -> Column:
    return F.concat(F.lit("records/"), record_id, F.lit(".yaml"))


def compare(base: DataFrame, head: DataFrame, id_col: str = "record_id") -> DataFrame:
    """Changes with similarity left aside: ``(kind, old_path, new_path, old_id, new_id, changed_fields)``, one row a changed id.

    A full outer join on the id; columns that only one snapshot has count as missing in the other.
    """
    fields = sorted((set(base.columns) | set(head.columns)) - {id_col})
    both = [df.select(id_col, *[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in fields], F.lit(True).alias("_there")) for df in (base, head)]
    j = both[0].alias("b").join(both[1].alias("h"), F.col(f"b.{id_col}") == F.col(f"h.{id_col}"), "full_outer")
    kind = F.when(F.col("b._there").isNull(), "added").when(F.col("h._there").isNull(), "removed").otherwise("modified")
    changed = F.when(kind == "modified", changed_fields(fields)).otherwise(F.array().cast("array<string>"))
    out = j.select(kind.alias("kind"), path_of(F.col(f"b.{id_col}")).alias("old_path"), path_of(F.col(f"h.{id_col}")).alias("new_path"), F.col(f"b.{id_col}").alias("old_id"), F.col(f"h.{id_col}").alias("new_id"), changed.alias("changed_fields"))
    return out.where("kind <> 'modified' or size(changed_fields) > 0")


def _features(df: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """``(id, f)``: a hash of each field's value, list items one by one, with their number if they repeat."""
    kinds = dict(df.dtypes)
    def texts(c: str) -> Column:
        if kinds[c].startswith("array"):
            return F.coalesce(F.transform(c, lambda x: F.concat(F.lit(c + "="), F.to_json(F.struct(x.alias("x"))))), F.array().cast("array<string>"))
        return F.array(F.concat(F.lit(c + "="), F.col(c).cast("string") if not kinds[c].startswith("struct") else F.to_json(c)))
    all_of = F.array_compact(F.concat(*[texts(c) for c in fields]))
    one = df.select(F.col(id_col).alias("id"), F.explode(all_of).alias("t")).groupBy("id", "t").agg(F.count(F.lit(1)).alias("n"))
    return one.select("id", F.xxhash64("t", "n").alias("f"))


def similar(old: DataFrame, new: DataFrame, id_col: str = "record_id", fields: list[str] | None = None, threshold: float = SIMILAR) -> DataFrame:
    """``(old_id, new_id, similarity)``: for each new record the old one that shares most of its content, if enough.

    Content is the multiset of field values. Only values that few records share bring a pair together: a record can't reach
    the threshold without sharing one of its ceil((1 - threshold) n) + 1 rarest values, so common values are never joined.
    """
    fields = fields or [c for c in old.columns if c != id_col]
    a, b = _features(old, id_col, fields), _features(new, id_col, fields)
    rarity = a.unionByName(b).groupBy("f").agg(F.count(F.lit(1)).alias("df"))
    def sets(x: DataFrame) -> DataFrame:
        return x.join(rarity, "f").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("df", "f"))).alias("fs"))
    def prefix(x: DataFrame, name: str) -> DataFrame:
        n = F.size("fs")
        keep = n - F.ceil(n * F.lit(threshold)).cast("int") + 1
        return x.select(F.col("id").alias(f"{name}_id"), F.transform("fs", lambda t: t["f"]).alias(f"{name}_fs"), F.explode(F.transform(F.slice("fs", 1, keep), lambda t: t["f"])).alias("f"))
    pairs = prefix(sets(a), "old").join(prefix(sets(b), "new"), "f").drop("f").distinct()
    score = F.size(F.array_intersect("old_fs", "new_fs")) / F.greatest(F.size("old_fs"), F.size("new_fs"))
    good = pairs.where("old_id <> new_id").withColumn("similarity", F.round(score, 6)).where(F.col("similarity") >= threshold)
    best = good.groupBy("new_id").agg(F.max(F.struct("similarity", "old_id")).alias("m"))
    return best.select(F.col("m.old_id").alias("old_id"), "new_id", F.col("m.similarity").alias("similarity"))


def detect(base: DataFrame, head: DataFrame, id_col: str = "record_id", threshold: float = SIMILAR) -> DataFrame:
    """All changes, with renamed (removed here, added there, alike) and copied (added, like a record of the base that stays)."""
    plain = compare(base, head, id_col)
    added = head.join(plain.where("kind = 'added'").select(F.col("new_id").alias(id_col)), id_col, "left_semi")
    gone = plain.where("kind = 'removed'").select("old_id")
    like = similar(base, added, id_col, threshold=threshold)
    renamed = like.join(gone, "old_id").groupBy("old_id").agg(F.max(F.struct("similarity", "new_id")).alias("m")).select("old_id", F.col("m.new_id").alias("new_id"), F.lit("renamed").alias("k"))
    copied = like.join(renamed.select("new_id"), "new_id", "left_anti").join(gone, "old_id", "left_anti").select("old_id", "new_id", F.lit("copied").alias("k"))
    moves = renamed.unionByName(copied)
    fields = sorted((set(base.columns) | set(head.columns)) - {id_col})
    old, new = [df.select(F.col(id_col).alias(f"{x}_id"), F.struct(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in fields]).alias(y)) for df, x, y in ((base, "old", "b"), (head, "new", "h"))]
    moved = moves.join(old, "old_id").join(new, "new_id")
    rows = moved.select(F.col("k").alias("kind"), path_of(F.col("old_id")).alias("old_path"), path_of(F.col("new_id")).alias("new_path"), "old_id", "new_id", changed_fields(fields).alias("changed_fields"))
    rest = plain.join(moves.select(F.col("new_id").alias("_n")), F.col("new_id") == F.col("_n"), "left_anti").join(renamed.select(F.col("old_id").alias("_o")), (F.col("old_id") == F.col("_o")) & (F.col("kind") == "removed"), "left_anti")
    return rest.unionByName(rows)


def reused_ids(changes: DataFrame, history: DataFrame, history_id: str = "record_id") -> DataFrame:
    """New ids that some record had before."""
    new = changes.where(F.col("kind").isin("added", "copied", "renamed")).where("new_id is not null")
    return new.join(history.select(F.col(history_id).alias("new_id")).distinct(), "new_id", "left_semi")


def warnings(changes: DataFrame) -> DataFrame:
    """``(code, old_id, new_id, detail)``: removed records, changed ids, changes of what identifies a work."""
    touched = F.array_intersect("changed_fields", F.array(*[F.lit(c) for c in IDENTITY]))
    found = F.array_compact(F.array(
        F.when(F.col("kind") == "removed", F.struct(F.lit("change.record_removed").alias("code"), F.lit("").alias("detail"))),
        F.when((F.col("kind") == "renamed") & (F.col("old_id") != F.col("new_id")), F.struct(F.lit("change.id_changed").alias("code"), F.lit("").alias("detail"))),
        F.when(F.col("kind").isin("modified", "renamed") & (F.size(touched) > 0), F.struct(F.lit("change.identity_modified").alias("code"), F.array_join(F.array_sort(touched), ",").alias("detail"))),
    ))
    return changes.select("old_id", "new_id", F.inline(found))


def kind_counts(changes: DataFrame) -> DataFrame:
    """One row with the number of changes of each kind."""
    return changes.agg(*[F.count_if(F.col("kind") == k).alias(k) for k in KINDS])


def first_sent(log: DataFrame) -> DataFrame:
    """The change log with each change once: a change that was sent again keeps its first arrival."""
    rest = [c for c in log.columns if c not in ("change_id", "arrived_at")]
    return log.groupBy("change_id").agg(F.min("arrived_at").alias("arrived_at"), *[F.min_by(c, "arrived_at").alias(c) for c in rest]).select(*log.columns)


def late(log: DataFrame, allowed: str = "1 day") -> DataFrame:
    """Changes that arrived more than ``allowed`` after they were made."""
    return log.where(F.col("arrived_at") > F.col("changed_at") + F.expr(f"interval {allowed}"))


def markdown(changes: DataFrame, title: str = "Changes", shown: int = 100) -> str:
    """A report: counts by kind, the ids of each kind, and the first ``shown`` changes in order with the number of those left out."""
    from colophon.operators.constraints import compressed_ids, id_ranges

    counts = kind_counts(changes).first()
    lines = [f"# {title}", "", ", ".join(f"{counts[k]} {k}" for k in KINDS), ""]
    for k in KINDS:
        if counts[k]:
            ids = changes.where(F.col("kind") == k).select(F.coalesce("new_id", "old_id").alias("id"))
            lines.append(f"- {k.capitalize()}: {compressed_ids(id_ranges(ids, 'id'))}")
    lines += ["", "| kind | old | new | fields |", "| --- | --- | --- | --- |"]
    for r in changes.orderBy(F.coalesce("new_path", "old_path"), "kind").limit(shown).collect():
        lines.append(f"| {r['kind']} | {r['old_path'] or ''} | {r['new_path'] or ''} | {', '.join(r['changed_fields'] or [])} |")
    rest = sum(counts[k] for k in KINDS) - shown
    return "\n".join(lines + (["", f"{rest} additional changes omitted."] if rest > 0 else [])) + "\n"
