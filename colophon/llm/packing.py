"""Filling containers of fixed token capacity: optimal length buckets, token-budget batches, room left filled from smaller buckets.

The lengths of all items give one histogram of at most ``capacity`` bars. Dynamic programming over it finds the bucket
boundaries with the least padding. Batches with a budget of ``capacity`` tokens form inside each bucket, and the room a
batch leaves is given to items of smaller buckets. The plan is made of counts only; each item then finds its container from
its rank in its bucket, so nothing but the histogram is ever gathered.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.session import materialize

CAPACITY = 2048
BUCKETS = 96
#: Items of a bucket that are ranked by one task.
RANKED = 200_000
# Fixed value: the pattern that splits text before the merges of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def _encoding(ranks: bytes):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def token_count(text: Column, spark, vocabulary: str) -> Column:
    """Tokens of the text under a public vocabulary; the driver reads the file ``vocabulary`` once and sends it to the executors. Null gives null."""
    with open(vocabulary, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())

    def run(texts: pd.Series) -> pd.Series:
        encode = _encoding(shared.value).encode_ordinary
        return texts.map(lambda t: None if t is None else len(encode(t))).astype("Int64")

    return F.pandas_udf(run, "long")(text)


def boundaries(histogram: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of the at most ``buckets`` length ranges with the least padding; histogram[n] items have length n."""
    size = len(histogram)
    if not histogram[1:].any():
        return []
    lengths = np.flatnonzero(histogram)
    lengths = lengths[lengths > 0]
    count = np.concatenate([[0], np.cumsum(histogram[lengths])]).astype(np.float64)
    total = np.concatenate([[0], np.cumsum(histogram[lengths] * lengths)]).astype(np.float64)
    n = len(lengths)
    # cost[i, j]: padding if the lengths i..j-1 share the bucket bounded by the longest of them
    cost = np.full((n + 1, n + 1), np.inf)
    for j in range(1, n + 1):
        cost[:j, j] = lengths[j - 1] * (count[j] - count[:j]) - (total[j] - total[:j])
    best = np.full(n + 1, np.inf)
    best[0] = 0
    steps = []
    for _ in range(min(buckets, n)):
        through = best[:, None] + cost
        step = np.argmin(through, 0)
        new = through[step, np.arange(n + 1)]
        new[0] = 0
        steps.append(step)
        if new[n] >= best[n]:
            steps.pop()
            break
        best = new
    bounds, j = [], n
    for step in reversed(steps):
        if j == 0:
            break
        bounds.append(int(lengths[j - 1]))
        j = int(step[j])
    assert j == 0 and size > bounds[0]
    return sorted(bounds)


def plan(bounds: list[int], counts: list[int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Rows ``(bucket, rank_from, rank_to, per, first)``: the items of these ranks go ``per`` to a container from ``first`` on.

    Containers of one kind are made as long as all their buckets last, so the rows are few whatever the number of items.
    """
    left, used, rows, container = list(counts), [0] * len(counts), [], 0
    for b in range(len(bounds) - 1, -1, -1):
        while left[b]:
            room, kind = capacity, []
            for s in range(b, -1, -1):
                if left[s] and bounds[s] <= room:
                    per = min(room // bounds[s], left[s])
                    kind.append((s, per))
                    room -= per * bounds[s]
            times = min(left[s] // per for s, per in kind)
            for s, per in kind:
                rows.append((s, used[s], used[s] + per * times, per, container))
                used[s] += per * times
                left[s] -= per * times
            container += times
    return rows


def pack(items: DataFrame, id_col: str, size_col: str, capacity: int = CAPACITY, buckets: int = BUCKETS) -> DataFrame:
    """``(id, piece, first_token, tokens, container_id)`` for each item, or each piece of an item longer than the capacity.

    Only longer items are split: into full pieces and a rest, which is packed like an item. No container holds more than
    ``capacity`` tokens. Items of null or no size need no container and are left out; repeated rows are packed each.
    """
    spark = items.sparkSession
    whole = items.select(F.col(id_col).alias("id"), F.col(size_col).cast("long").alias("size")).where("size > 0")
    cuts = F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / capacity).cast("long"))
    parts = whole.select("id", "size", F.explode(cuts).alias("piece"))
    parts = parts.select("id", "piece", (F.col("piece") * capacity).alias("first_token"), F.least(F.lit(capacity), F.col("size") - F.col("piece") * capacity).alias("tokens"))
    parts = materialize(parts, "pieces")
    bars = parts.groupBy("tokens").agg(F.count(F.lit(1)).alias("n")).collect()
    histogram = np.zeros(capacity + 1, np.int64)
    for r in bars:
        histogram[r["tokens"]] = r["n"]
    bounds = boundaries(histogram, buckets)
    if not bounds:
        return parts.withColumn("container_id", F.lit(None).cast("long"))
    of_length = np.searchsorted(bounds, np.arange(capacity + 1))
    counts = np.bincount(of_length[1:], histogram[1:], len(bounds)).astype(np.int64).tolist()
    rows = plan(bounds, counts, capacity)

    bucket = F.element_at(F.array(*[F.lit(int(b)) for b in of_length[1:]]), F.col("tokens").cast("int"))
    salts = max(1, max(counts) // RANKED)
    salted = parts.withColumn("bucket", bucket).withColumn("salt", F.pmod(F.xxhash64("id", "piece"), F.lit(salts)))
    from pyspark.sql import Window

    sizes = salted.groupBy("bucket", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.withColumn("offset", F.sum("n").over(Window.partitionBy("bucket").orderBy("salt")) - F.col("n")).drop("n")
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy("bucket", "salt").orderBy("id", "piece")) - 1)
    ranked = ranked.join(before, ["bucket", "salt"]).withColumn("rank", F.col("rank") + F.col("offset"))
    table = spark.createDataFrame(rows, "bucket int, rank_from long, rank_to long, per long, first long")
    placed = ranked.join(F.broadcast(table), "bucket").where("rank >= rank_from and rank < rank_to")
    return placed.select("id", "piece", "first_token", "tokens", (F.col("first") + F.floor((F.col("rank") - F.col("rank_from")) / F.col("per"))).cast("long").alias("container_id"))
