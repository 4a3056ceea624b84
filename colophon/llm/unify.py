"""One consistent form for text that looks alike: composed, without compatibility variants, invisible characters and look-alikes.

A batch of Arrow strings is turned into one array of code points with row offsets. Lookup tables give each code point its
decomposition, gathered with expansion offsets; marks are ordered and composed, and look-alike letters replaced, by array
operations over the whole batch. No string function is called for a row.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

LIMIT = 0x110000

# Characters without an image, spaces and hyphens that stand for the ordinary ones.
INVISIBLE = [0x00AD, 0x034F, 0x061C, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180E, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2070), 0xFE00, *range(0xFE01, 0xFE10), 0xFEFF]
SPACES = [0x00A0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000]
HYPHENS = [0x2010, 0x2011, 0xFE63, 0xFF0D]
# Characters kept although they have a compatibility form: primes, quotes and dashes longer than a hyphen.
KEPT = [*range(0x2012, 0x2016), *range(0x2018, 0x2020), *range(0x2032, 0x2038), 0x2057]
# Latin letters and the Greek and Cyrillic letters that look like them.
LATIN_LOOKS = "ABCEHIJKMNOPSTXYZaceijopsxyv"
GREEK_LOOKS = "ΑΒ ΕΗΙ ΚΜΝΟΡ ΤΧΥΖα  ιϳορ χγν"
CYRILLIC_LOOKS = "АВСЕНІЈКМ ОРЅТХҮ асеіјорѕху "
FURTHER_LOOKS = {"ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "ɡ": "g", "ⅼ": "l", "Ԛ": "Q", "Ԝ": "W", "ε": "e", "κ": "k", "τ": "t", "υ": "u", "ω": "w", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "У": "Y", "Ү": "Y", "ү": "y", "ѵ": "v"}
SCRIPT_NAMES = ["LATIN", "GREEK", "CYRILLIC"]


@lru_cache(maxsize=1)
def _tables() -> dict[str, np.ndarray]:
    """Lookup tables over all code points, built from the character database once a worker."""
    size = np.ones(LIMIT, np.int32)
    start = np.arange(LIMIT, dtype=np.int64)  # a code point outside the table stands for itself
    flat = [np.arange(LIMIT, dtype=np.uint32)]
    at = LIMIT
    ccc, script, pairs = np.zeros(LIMIT, np.uint8), np.zeros(LIMIT, np.uint8), []
    letter = np.zeros(LIMIT, bool)
    special = {c: "" for c in INVISIBLE} | {c: " " for c in SPACES} | {c: "-" for c in HYPHENS} | {c: chr(c) for c in KEPT}
    for c in range(LIMIT):
        if 0xD800 <= c < 0xE000 or 0xE000 <= c < 0xF900 or 0x3400 <= c < 0xA000 or 0x20000 <= c < 0x2F800 or c >= 0x2FA20 and c < 0xE0000:
            continue
        ch = chr(c)
        full = special.get(c)
        if full is None:
            full = unicodedata.normalize("NFKD", ch)
        if full != ch:
            codes = np.array([ord(x) for x in full], np.uint32)
            size[c], start[c] = len(codes), at
            flat.append(codes)
            at += len(codes)
        ccc[c] = unicodedata.combining(ch)
        category = unicodedata.category(ch)
        letter[c] = category[0] in "LM" or category == "Nd"
        if category[0] == "L":
            first = unicodedata.name(ch, "").split(" ")[0]
            if first in SCRIPT_NAMES:
                script[c] = 1 + SCRIPT_NAMES.index(first)
        one = unicodedata.decomposition(ch)
        if one and not one.startswith("<"):
            parts = [int(x, 16) for x in one.split()]
            if len(parts) == 2 and unicodedata.normalize("NFC", ch) == ch:
                pairs.append((parts[0] << 21 | parts[1], c))
    pairs.sort()
    looks = np.zeros((3, LIMIT), np.uint32)  # the look-alike of a letter in Latin, Greek, Cyrillic
    for row, others in ((1, GREEK_LOOKS), (2, CYRILLIC_LOOKS)):
        for a, b in zip(LATIN_LOOKS, others):
            if b != " ":
                looks[0, ord(b)] = ord(a)
                looks[row, ord(a)] = ord(b)
    for b, a in FURTHER_LOOKS.items():
        looks[0, ord(b)] = ord(a)
    return {
        "size": size, "start": start, "flat": np.concatenate(flat), "ccc": ccc, "script": script, "letter": letter, "looks": looks,
        "pair": np.array([p for p, _ in pairs], np.uint64), "composed": np.array([c for _, c in pairs], np.uint32),
    }


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row and the row offsets; null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return codes, starts[offsets - offsets[0]]


def to_strings(codes: np.ndarray, offsets: np.ndarray) -> pa.Array:
    width = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
    ends = np.concatenate([[0], np.cumsum(width)])
    data = codes.astype("<u4").tobytes().decode("utf-32-le").encode("utf-8")
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(ends[offsets].astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


def _expand(codes: np.ndarray, offsets: np.ndarray, t: dict) -> tuple[np.ndarray, np.ndarray]:
    size = t["size"][codes]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    place = np.arange(total) - np.repeat(ends - size, size) + np.repeat(t["start"][codes], size)
    return t["flat"][place], np.concatenate([[0], ends])[offsets]


def _order_marks(codes: np.ndarray, row: np.ndarray, t: dict) -> np.ndarray:
    """Canonical order: stable by combining class between starters."""
    ccc = t["ccc"][codes]
    if not ((ccc[1:] > 0) & (ccc[:-1] > ccc[1:])).any():
        return codes
    block = np.cumsum((ccc == 0) | np.concatenate([[True], row[1:] != row[:-1]]))
    return codes[np.lexsort((np.arange(len(codes)), ccc, block))]


def _compose(codes: np.ndarray, row: np.ndarray, t: dict) -> tuple[np.ndarray, np.ndarray]:
    """Joins a mark to the starter before it, all texts at once, one mark of each starter a round."""
    while len(codes):
        ccc = t["ccc"][codes]
        at = np.arange(len(codes))
        head = np.maximum.accumulate(np.where((ccc == 0) | np.concatenate([[True], row[1:] != row[:-1]]), at, 0))
        # the last starter before each place, also for starters that may join the one right before them
        previous = np.concatenate([[0], head[:-1]])
        base = np.where(ccc == 0, previous, head)
        adjacent = (at - base == 1) | ((ccc > 0) & (np.concatenate([[0], ccc[:-1]]) < ccc) & (at > base))
        ok = adjacent & (row[base] == row) & (base < at) & (t["ccc"][codes[base]] == 0)
        key = codes[base].astype(np.uint64) << np.uint64(21) | codes.astype(np.uint64)
        found = np.minimum(np.searchsorted(t["pair"], key), max(len(t["pair"]) - 1, 0))
        joined = np.where(t["pair"][found] == key, t["composed"][found], 0).astype(np.uint32)
        lead, vowel = codes[base].astype(np.int64) - 0x1100, codes.astype(np.int64) - 0x1161
        hangul = (lead >= 0) & (lead < 19) & (vowel >= 0) & (vowel < 21)
        joined = np.where(hangul, 0xAC00 + (lead * 21 + vowel) * 28, joined)
        block, tail = codes[base].astype(np.int64) - 0xAC00, codes.astype(np.int64) - 0x11A7
        closed = (block >= 0) & (block < 11172) & (block % 28 == 0) & (tail > 0) & (tail < 28)
        joined = np.where(closed, codes[base].astype(np.int64) + tail, joined).astype(np.uint32)
        hit = np.flatnonzero(ok & (joined > 0))
        if not len(hit):
            break
        hit = hit[np.concatenate([[True], base[hit][1:] != base[hit][:-1]])]  # the first of each starter
        hit = hit[~np.isin(base[hit], hit)]  # a starter that is joined away waits for the next round
        codes = codes.copy()
        codes[base[hit]] = joined[hit]
        keep = np.ones(len(codes), bool)
        keep[hit] = False
        codes, row = codes[keep], row[keep]
    return codes, row


def _one_script(codes: np.ndarray, row: np.ndarray, t: dict) -> np.ndarray:
    """Look-alike letters of words in more than one script, replaced by those of the script most of the word is in."""
    inside = t["letter"][codes]
    if not inside.any():
        return codes
    first = inside & ~(np.concatenate([[False], inside[:-1]]) & np.concatenate([[False], row[1:] == row[:-1]]))
    word = np.where(inside, np.cumsum(first), 0)
    script = np.where(inside, t["script"][codes], 0)
    counts = np.stack([np.bincount(word, script == s, int(word.max()) + 1) for s in (1, 2, 3)])
    # a letter that has no look-alike in a script speaks against that script
    against = np.stack([np.bincount(word, (script > 0) & (script != s + 1) & (t["looks"][s][codes] == 0), int(word.max()) + 1) for s in range(3)])
    mixed = (counts > 0).sum(0) > 1
    mixed[0] = False
    if not mixed.any():
        return codes
    best = np.argmax(np.where(counts > 0, counts - 1000.0 * against, -np.inf), 0)
    target = best[word]
    other = t["looks"][target, codes]
    change = mixed[word] & (script > 0) & (script != target + 1) & (other > 0)
    return np.where(change, other, codes)


def unify_array(texts: pa.Array) -> pa.Array:
    """The consistent form of each text; nulls stay null."""
    t = _tables()
    codes, offsets = code_points(texts)
    codes, offsets = _expand(codes, offsets, t)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    codes = _order_marks(codes, row, t)
    codes, row = _compose(codes, row, t)
    codes = _one_script(codes, row, t)
    ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(offsets) - 1))]).astype(np.int64)
    out = to_strings(codes.astype(np.uint32), ends)
    return pa.compute.if_else(texts.is_valid(), out, pa.scalar(None, pa.string()))


def mixed_words(texts: pa.Array) -> np.ndarray:
    """Whether a text has a word with letters of more than one script, look-alikes or not."""
    t = _tables()
    codes, offsets = code_points(texts)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = t["letter"][codes]
    first = inside & ~(np.concatenate([[False], inside[:-1]]) & np.concatenate([[False], row[1:] == row[:-1]])) if len(codes) else inside
    word = np.where(inside, np.cumsum(first), 0)
    n = int(word.max()) + 1 if len(word) else 1
    counts = np.stack([np.bincount(word, t["script"][codes] == s, n) if len(word) else np.zeros(n) for s in (1, 2, 3)])
    bad = (counts > 0).sum(0) > 1
    bad[0] = False
    out = np.zeros(len(offsets) - 1, bool)
    out[row[bad[word]]] = True
    return out


def _unify(texts: pa.Array) -> pa.Array:
    return unify_array(texts)


def unified(text: Column) -> Column:
    """The text in its consistent form: NFC with compatibility variants resolved, no invisible characters, ordinary spaces and
    hyphens, look-alike letters within a word in the word's script. Primes, quotes and longer dashes stay. Null stays null,
    '' stays ''; the form of a consistent text is the text itself."""
    return F.arrow_udf(_unify, "string")(text)
