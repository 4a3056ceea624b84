"""Evaluation passages in a corpus: n-grams of the items as a broadcast hash set, scanned over all token windows, hits verified.

A text becomes a list of words without case, punctuation, mark-up, reference marks and line-end hyphens. Runs of words that
an item and a document share are followed word by word to both sides, past odd changed or inserted words; an item has
leaked if the followed stretch covers enough of its running words.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of a window; a stretch of RUNNING words with one changed word in each half still holds an unbroken window.
WINDOW = 6
RUNNING = 25
#: Most words of the stretch that may differ, as a share.
CHANGED = 0.14
#: n-grams of items that are broadcast at once; more items are scanned for in further passes.
BLOCK = 2_000_000

# What may be put into a quoted text without changing it.
MARKS = re.compile(r"<[^<>]{0,40}>|\[\d{1,4}\]|\(\d{1,4}\)|\(refs?\.? ?\d{1,4}\)|&[a-z]{2,6};|[*_~`|#>]+")
LINE_END = re.compile(r"(?<=\w)-\s*\n\s*(?=\w)")
HIDDEN = re.compile("[­​-‏⁠﻿]")
WORD = re.compile(r"[^\W_]+")
# Characters of scripts that write without spaces (Han, kana, Thai, Lao, Burmese, Khmer); each counts as a word.
UNSPACED = "\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff\u0e01-\u0e4e\u0e81-\u0ece\u1000-\u109f\u1780-\u17d3"
ANY_UNSPACED = re.compile(f"[{UNSPACED}]")
WORD_OR_CHARACTER = re.compile(rf"[{UNSPACED}]|(?:(?![{UNSPACED}])[^\W_])+")
#: An opening sentence is a stock instruction if items with so many different passages have it.
STOCK = 2


def words(text: str) -> list[str]:
    """Words of the text in lower case, without marks; none for an empty text. Text without spaces is taken character by character."""
    pattern = WORD
    if not text.isascii():
        text = HIDDEN.sub("", unicodedata.normalize("NFKC", text))
        pattern = WORD_OR_CHARACTER if ANY_UNSPACED.search(text) else WORD
    return pattern.findall(MARKS.sub(" ", LINE_END.sub("", text)).lower())


def without_instruction(items: list[tuple[int, str]]) -> list[tuple[int, list[str]]]:
    """Words of each item without an opening sentence that items with STOCK different passages share; copies of an item count once."""
    cut = [re.match(r"\s*(.*?[.!?:])(?=\s)", t or "", re.S) for _, t in items]
    opening = [" ".join(words(m.group(1))) if m else "" for m in cut]
    rests = defaultdict(set)
    for (_, t), m, o in zip(items, cut, opening):
        if o:
            rests[o].add(tuple(words(t[m.end() :])))
    stock = {o for o, different in rests.items() if len(different) >= STOCK}
    return [(i, words((t or "")[m.end() :] if m and o in stock else (t or ""))) for (i, t), m, o in zip(items, cut, opening)]


class Index:
    """Words of some items as numbers, and where each of their windows occurs."""

    def __init__(self, items: list[tuple[int, list[str]]]):
        self.number: dict[str, int] = {}
        self.items = [(i, np.array([self.number.setdefault(w, len(self.number)) for w in ws], np.int64)) for i, ws in items]
        places = defaultdict(list)
        for at, (_, ids) in enumerate(self.items):
            for pos, h in enumerate(_hashes(ids).tolist()):
                places[h].append((at, pos))
        self.places = dict(places)
        self.sorted = np.array(sorted(places), np.uint64)


def _hashes(ids: np.ndarray) -> np.ndarray:
    """A number for each window; windows with an unknown word get one that no item has."""
    n = len(ids) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    known = np.ones(n, bool)
    for k in range(WINDOW):
        part = ids[k : k + n]
        h = h * np.uint64(0x9E3779B97F4A7C15) + (part + 1).astype(np.uint64)
        h ^= h >> np.uint64(29)
        known &= part >= 0
    return np.where(known, h, np.uint64(0))


def _follow(doc: list[int], item: list[int], i: int, j: int, step: int) -> tuple[int, int, int]:
    """From the match at (i, j) on in one direction: the last matching places and the words of the item that differ."""
    changed, last = 0, (i, j)
    while True:
        i, j = i + step, j + step
        if not (0 <= i < len(doc) and 0 <= j < len(item)):
            break
        if doc[i] == item[j]:
            last = (i, j)
            continue
        for skip in ((1, 1), (1, 0), (0, 1), (2, 0), (2, 1), (1, 2), (3, 0), (2, 2), (4, 0), (3, 1), (0, 2)):
            a, b = i + skip[0] * step, j + skip[1] * step
            ahead = [(a + k * step, b + k * step) for k in range(2)]
            if all(0 <= x < len(doc) and 0 <= y < len(item) and doc[x] == item[y] for x, y in ahead):
                changed += skip[1]
                i, j = a, b
                last = (i, j)
                break
        else:
            break
    return last[0], last[1], changed


def stretches(text: str, index: Index, running: int = RUNNING) -> list[tuple[int, int, int, int]]:
    """``(item, first word, last word, running words)``, the longest stretch of each item that leaked into the text."""
    ids = [index.number.get(w, -1) for w in words(text)]
    if len(ids) < WINDOW:
        return []
    array = np.array(ids, np.int64)
    h = _hashes(array)
    at = np.searchsorted(index.sorted, h)
    hit = np.flatnonzero(index.sorted[np.minimum(at, len(index.sorted) - 1)] == h) if len(index.sorted) else []
    best: dict[int, tuple[int, int, int]] = {}
    seen: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    for i in hit:
        for which, j in index.places.get(int(h[i]), ()):
            if any(a <= i <= b and c <= j <= d for a, b, c, d in seen[which]):
                continue
            item = index.items[which][1]
            if not np.array_equal(array[i : i + WINDOW], item[j : j + WINDOW]):
                continue
            flat = item.tolist()
            left = _follow(ids, flat, int(i), j, -1)
            right = _follow(ids, flat, int(i) + WINDOW - 1, j + WINDOW - 1, 1)
            seen[which].append((left[0], right[0], left[1], right[1]))
            length = right[1] - left[1] + 1
            if length >= running and left[2] + right[2] <= CHANGED * length and length > best.get(which, (0, 0, 0))[2]:
                best[which] = (left[0], right[0], length)
    return [(index.items[k][0], *v) for k, v in best.items()]


def leaks(documents: DataFrame, items: DataFrame, running: int = RUNNING) -> DataFrame:
    """``(doc_id, item_id, first_word, last_word, running)``: the items that occur in a document with that many running words.

    ``items`` is a list of held-out items, which is read by the driver; its n-grams are broadcast in blocks of at most
    BLOCK, each with its own pass over the corpus. Null and empty texts hold nothing; an item shorter than ``running`` words can't
    leak; items of equal text are all reported.
    """
    spark = documents.sparkSession
    held = without_instruction([(r["item_id"], r["text"]) for r in items.select("item_id", "text").orderBy("item_id").toLocalIterator()])
    schema = "doc_id long, item_id long, first_word int, last_word int, running int"
    blocks: list[list] = [[]]
    for one in held:
        if sum(len(w) for _, w in blocks[-1]) + len(one[1]) > BLOCK and blocks[-1]:
            blocks.append([])
        blocks[-1].append(one)
    result = None
    for block in blocks:
        shared = spark.sparkContext.broadcast(Index(block))

        def scan(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            index = shared.value
            for batch in batches:
                rows = [(d, *s) for d, t in zip(batch["doc_id"], batch["text"]) if t for s in stretches(t, index, running)]
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "first_word", "last_word", "running"])

        found = documents.select("doc_id", "text").where("text is not null").mapInPandas(scan, schema)
        result = found if result is None else result.unionByName(found)
    return result


def without_leaks(documents: DataFrame, found: DataFrame) -> DataFrame:
    """The documents into which no item leaked."""
    return documents.join(found.select("doc_id").distinct(), "doc_id", "left_anti")
