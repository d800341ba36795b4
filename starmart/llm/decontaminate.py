"""Benchmark decontamination by pigeonhole edit matching.

An item of m normalised characters may be met with k = floor(RATE * m) edits. Cut into
k + 1 pieces, at least one piece stands unedited in any such passage, so an automaton over all
pieces finds every candidate place; Myers' bit-parallel distance (one integer
holds a column) then verifies the whole item around it.

Items are handled in blocks of about ``BLOCK_BYTES`` of text, the proven size of what a task
holds; a larger benchmark takes more blocks, each a pass over the documents whose matches are
written before the next block is collected.

Normalised: lower case, runs of blanks as one space. Defined cases: null and empty texts are
clean; items that are null or blank are not searched for; an item shorter than ``MIN_CHARS``
must begin and end at the edge of a word; equal items are each reported, those without an id as one null
at the end; repeated rows are judged alike; input columns named like an output column are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.session import materialise

from . import common

RATE = 0.08
MIN_CHARS = 30
BLOCK_BYTES = 8 << 20


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def edit_distance_within(item: str, text: str) -> int:
    """Smallest edit distance of ``item`` to any stretch of ``text`` (Myers 1999)."""
    m = len(item)
    full, high = (1 << m) - 1, 1 << (m - 1)
    eq: dict[str, int] = {}
    for i, c in enumerate(item):
        eq[c] = eq.get(c, 0) | 1 << i
    pv, mv, now, best = full, 0, m, m
    for c in text:
        e = eq.get(c, 0)
        xv = e | mv
        xh = (((e & pv) + pv) ^ pv) | e
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        now += bool(ph & high) - bool(mh & high)
        best = min(best, now)
        ph, mh = (ph << 1) & full, (mh << 1) & full
        pv = mh | (full & ~(xv | ph))
        mv = ph & xv
    return best


def edit_distance(a: str, b: str) -> int:
    """Edit distance of two short texts."""
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, x in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (c != x))
    return row[-1]


UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\U0003ffff]")     # scripts that set no blanks between words


def _edge(text: str, at: int) -> bool:
    """No word goes on across ``at``."""
    return (at <= 0 or at >= len(text) or not (text[at - 1].isalnum() and text[at].isalnum())
            or bool(UNSPACED.search(text, at - 1, at + 1)))


def word_distance(item: str, text: str, start: int, k: int) -> int:
    """Smallest edit distance, k + 1 if above k, of ``item`` to a stretch from one edge to another near ``start``."""
    m, n = len(item), len(text)
    return min((edit_distance(item, text[a:b]) for a in range(max(0, start - k), min(n, start + k) + 1) if _edge(text, a)
                for b in range(max(a + 1, a + m - k), min(n, a + m + k) + 1) if _edge(text, b)), default=k + 1)


class Matcher:
    """The items of one block compiled to an automaton over their pieces."""

    def __init__(self, items: list[tuple[int, str]], rate: float = RATE):
        pieces: dict[str, list[tuple[int, int]]] = {}
        self.items = []
        for item_id, raw in items:
            text = normalise(raw)
            if not text:
                continue
            k = int(rate * len(text))
            cut = [round(x) for x in np.linspace(0, len(text), k + 2)]
            for a, b in zip(cut, cut[1:], strict=False):
                pieces.setdefault(text[a:b], []).append((len(self.items), a))
            self.items.append((item_id, text, k))
        self.auto = ahocorasick.Automaton()
        for p, where in pieces.items():
            self.auto.add_word(p, (len(p), where))
        if pieces:
            self.auto.make_automaton()

    def find(self, raw: str | None) -> dict[int, int]:
        """item_id -> smallest verified distance."""
        text = normalise(raw)
        found: dict[int, int] = {}
        if not self.items or not text:
            return found
        seen: set[tuple[int, int]] = set()
        for end, (size, where) in self.auto.iter(text):
            for n, offset in where:
                item_id, item, k = self.items[n]
                start = end - size + 1 - offset
                if (n, start) in seen or found.get(item_id) == 0:
                    continue
                seen.add((n, start))
                if len(item) < MIN_CHARS:
                    d = word_distance(item, text, start, k)
                else:
                    d = edit_distance_within(item, text[max(0, start - k):start + len(item) + k])
                if d <= k and d < found.get(item_id, k + 1):
                    found[item_id] = d
        return found


def block_count(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> int:
    total = benchmark.where(F.col("text").isNotNull()).agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    return -(-total * 2 // block_bytes) or 1


def _ids(found: dict) -> list:
    return sorted(found, key=lambda i: (i is None, i or 0))


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int, str]]]:
    """Items of the benchmark, block by block, each of bounded size."""
    items = benchmark.where(F.col("text").isNotNull()).select("item_id", "text")
    blocks = block_count(benchmark, block_bytes)
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        yield [(r["item_id"], r["text"]) for r in part.orderBy("item_id", "text").collect()]


def _finder(items: Broadcast, rate: float) -> Callable[[Column], Column]:
    def apply(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(items.value, rate)
        for s in texts:
            yield pd.Series([_ids(matcher.find(t)) for t in s])
    return F.pandas_udf(apply, "array<long>")


def _scanner(items: Broadcast, rate: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(items.value, rate)
        for b in batches:
            hits = [(key, i) for key, t in zip(b["_k"], b["text"], strict=True) for i in matcher.find(t)]
            yield pd.DataFrame({"_k": pd.Series([h[0] for h in hits], dtype=object),
                                "item": pd.array([h[1] for h in hits], dtype="Int64")})
    return scan


def _by_blocks(docs: DataFrame, benchmark: DataFrame, rate: float, block_bytes: int) -> DataFrame:
    """(_k, items) of the documents with items; one block's items are held at a time."""
    matches = None
    for items in item_blocks(benchmark, block_bytes):
        share = docs.sparkSession.sparkContext.broadcast(items)
        hits = materialise(docs.select("_k", "text").mapInPandas(_scanner(share, rate), "_k string, item long"), "leaks")
        share.destroy()
        matches = hits if matches is None else matches.unionByName(hits)
    one = F.array_sort(F.transform(F.collect_set(F.struct("item")), lambda s: s["item"]))
    return matches.groupBy("_k").agg(one.alias("_items"))


def contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``items`` (sorted ids of the items found) and ``contaminated``."""
    keep = common.replace_columns(docs, ["items", "contaminated"])
    if block_count(benchmark, block_bytes) == 1:
        items = docs.sparkSession.sparkContext.broadcast(next(item_blocks(benchmark, block_bytes)))
        out = docs.select(*keep, _finder(items, rate)("text").alias("items"))
    else:
        key = F.md5("text")
        found = _by_blocks(docs.select(key.alias("_k"), "text"), benchmark, rate, block_bytes)
        rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("_row"), key.alias("_k"))
        out = (rows.join(found.hint("merge"), "_k", "left")
               .select("_row.*", F.coalesce("_items", F.array().cast("array<long>")).alias("items")))
    return out.withColumn("contaminated", F.size("items") > 0)
