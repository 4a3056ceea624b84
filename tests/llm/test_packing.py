import itertools
import random

import numpy as np

from colophon.llm import packing as M
from colophon.llm.queries import VOCABULARY


def padding(bounds, lengths):
    return sum(min(b for b in bounds if b >= n) - n for n in lengths)


def test_boundaries_are_optimal():
    random.seed(1)
    for _ in range(20):
        lengths = [random.randint(1, 9) for _ in range(12)]
        k = random.randint(1, 4)
        got = M.boundaries(np.bincount(lengths, minlength=11), k)
        values = sorted(set(lengths))
        best = min(padding(c, lengths) for r in range(1, k + 1) for c in itertools.combinations(values, min(r, len(values))) if c[-1] == values[-1])
        assert len(got) <= k and padding(got, lengths) == best
    assert M.boundaries(np.zeros(5, int), 3) == []


def test_plan_places_each_item_once():
    bounds, counts = [3, 5, 8, 10], [17, 4, 6, 3]
    rows = M.plan(bounds, counts, 10)
    load: dict[int, int] = {}
    for b, low, high, per, first in rows:
        for r in range(low, high):
            load[first + (r - low) // per] = load.get(first + (r - low) // per, 0) + bounds[b]
    assert max(load.values()) <= 10
    assert [sum(high - low for b, low, high, _, _ in rows if b == i) for i in range(4)] == counts


def test_pack(spark):
    random.seed(3)
    sizes = [random.randint(1, 700) for _ in range(4000)] + [0, None, 2048, 2049, 10_000] + [100] * 2000
    df = spark.createDataFrame([(i, s, "x") for i, s in enumerate(sizes)], "doc_id long, size long, bucket string")
    rows = M.pack(df, "doc_id", "size").toPandas()
    loads = rows.groupby("container_id").tokens.sum()
    assert loads.max() <= 2048 and rows.tokens.sum() == sum(s or 0 for s in sizes)
    pieces = rows.groupby("id").size()
    assert set(pieces[pieces > 1].index) == {i for i, s in enumerate(sizes) if s and s > 2048}
    assert not set(rows.id) & {4000, 4001} and rows.container_id.notna().all()
    assert loads.sum() / (len(loads) * 2048) > 0.97
    long = rows[rows.id == 4004].sort_values("piece")
    assert long.first_token.tolist() == [2048 * i for i in range(5)] and long.tokens.sum() == 10_000
    assert M.pack(df.limit(0), "doc_id", "size").count() == 0


def test_tokens(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("hello world",), ("",), (None,), ("<|endoftext|>",)], "t string")
    got = [r[0] for r in df.select(M.token_count(F.col("t"), spark, VOCABULARY)).collect()]
    assert got[0] == 2 and got[1] == 0 and got[2] is None and got[3] > 1
