"""Substring dedup with repeated-phrase automata.

A window is ``window`` consecutive words; its phrase is the 8-gram with the smallest hash in it (the first of them), so equal
windows have equal phrases. Consecutive windows with the phrase at one place are a passage: the words from the
first word of the first window to the last word of the last.

1. Sketch: one scan hashes every passage of every document (its phrase and all its words) and writes the hashes.
2. Confirm: passages that occur twice or more are confirmed by counting; all their windows recur. A phrase that recurs
   with a passage of a single occurrence (the edge of a copy, an edit near by) is open: only its windows need a closer look.
3. Automata: documents that hold an open phrase (for passages with copies, one document of them) are dealt to shards of bounded
   size. A shard compiles the texts of its open phrases to an Aho-Corasick automaton and streams its documents through it;
   the windows around every hit are hashed.
4. Windows are counted over all shards, and those that start twice are removed together with the confirmed passages.

Hashes (64 bits of the phrase and 64 of the words) stand for passages and windows; no task holds a phrase's places or windows: all
meetings are partial aggregates and shuffle joins, which AQE splits where a phrase that a third of all documents share
is hot. Texts are shuffled compressed, once for step 3 and once for the removal.

Defined cases: null and empty texts have no words; documents shorter than a window stay whole; rows
equal in id and text are places of their own (so their windows recur); the kept text has
its words joined by one space; a text of one very long word or of very many words is handled whole; an empty table gives
an empty result; input columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.session import materialise

from . import common

PHRASE = 8
SHARD_DOCS = 2000
CHUNK = 1 << 19           # windows whose phrases are chosen together
OUT = ["n_words", "n_removed", "text"]
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _words(text: str | bytes | None) -> list[bytes]:
    return (text or "").encode().split() if not isinstance(text, bytes) else text.split()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(BASES[1])
    return x ^ (x >> np.uint64(32))


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 14)
        _POWERS[:] = [np.cumprod(np.concatenate(([np.uint64(1)], np.full(size - 1, b, np.uint64))), dtype=np.uint64)
                      for b in (BASES[0], pow(BASES[0], -1, 1 << 64))]
    return _POWERS[0][:n], _POWERS[1][:n]


class Sketch:
    """Passages and windows of one text of at least ``window`` words."""

    def __init__(self, words: list[bytes], window: int, known: dict[bytes, int]):
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        x = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        self.window = window
        up, self.down = _powers(len(x) + 1)
        self.sums = np.concatenate(([np.uint64(0)], np.cumsum(x * up[:-1], dtype=np.uint64)))
        grams = self.hashes(np.arange(len(x) - PHRASE + 1), PHRASE)
        self.grams = grams.view(np.int64)
        places = self._smallest(grams, window - PHRASE + 1)
        self.first = np.flatnonzero(np.diff(places, prepend=-1))              # first window of each passage
        self.n = np.diff(np.append(self.first, len(places)))                  # its windows
        self.at = places[self.first]                                          # its phrase

    def hashes(self, start: np.ndarray, size: int | np.ndarray) -> np.ndarray:
        """Of the ``size`` words from each ``start``."""
        return _mix((self.sums[start + size] - self.sums[start]) * self.down[start])

    @staticmethod
    def _smallest(grams: np.ndarray, span: int) -> np.ndarray:
        """Place of the (first) smallest hash in every ``span`` neighbours: 44 bits of the hash and the place are
        compared as one number, by minima over doubled lengths."""
        out = []
        for a in range(0, len(grams) - span + 1, CHUNK):
            part = grams[a:a + CHUNK + span - 1]
            low = (part & ~np.uint64((1 << 20) - 1)) | np.arange(len(part), dtype=np.uint64)
            have = 1
            while 2 * have <= span:
                low = np.minimum(low[:-have], low[have:])
                have *= 2
            if have < span:
                low = np.minimum(low[:len(low) - (span - have)], low[span - have:])
            out.append((low & np.uint64((1 << 20) - 1)).astype(np.int64) + a)
        return np.concatenate(out)

    def passages(self) -> tuple[np.ndarray, np.ndarray]:
        """Signed hashes of the phrase and of all words of each passage."""
        whole = self.hashes(self.first, self.n + self.window - 1) ^ self.n.astype(np.uint64)
        return self.grams[self.at], whole.view(np.int64)

    def windows(self, start: np.ndarray) -> np.ndarray:
        return self.hashes(start, self.window).view(np.int64)


def _zip(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in texts:
        z = zstandard.ZstdCompressor(level=3, write_content_size=True)
        yield pd.Series([z.compress((t or "").encode()) for t in s], dtype=object)


def _sketch(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            known: dict[bytes, int] = {}
            out: list[list] = [[], [], [], []]
            for text in b.column("text").to_pylist():
                words = _words(text)
                s = Sketch(words, window, known) if len(words) >= window else None
                for column, x in zip(out, (*s.passages(), s.first, s.n) if s else [np.zeros(0, np.int64)] * 4, strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("_h"), *[pa.array(c, pa.list_(k)) for c, k in zip(
                    out, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)]],
                ["doc_id", "_h", "phrase", "passage", "first", "n"])
    return run


def _locate(window: int):
    """(doc_id, _h, start, phrase, w): the windows around every hit of the shard's automaton in the shard's documents."""
    def run(docs: pd.DataFrame) -> pd.DataFrame:
        known: dict[bytes, int] = {}
        auto, texts, sketches, spelt = ahocorasick.Automaton(), [], [], set()
        for z, phrases in zip(docs["z"], docs["phrases"], strict=True):
            words = _words(zstandard.ZstdDecompressor().decompress(z))
            s = Sketch(words, window, known)
            hashes = s.grams[s.at]
            new = set(phrases.tolist()) - spelt
            for k in np.flatnonzero(np.isin(hashes, list(new))).tolist() if new else ():
                if hashes[k] not in spelt:
                    spelt.add(int(hashes[k]))
                    phrase = b" ".join(words[s.at[k]:s.at[k] + PHRASE]).decode()
                    auto.add_word(f" {phrase} ", len(phrase) + 2)
            texts.append(" " + b" ".join(words).decode() + " ")
            sketches.append(s)
        out = []
        if len(auto):
            auto.make_automaton()
        for doc_id, h, text, s in zip(docs["doc_id"], docs["_h"], texts, sketches, strict=True):
            ends = [end - size + 1 for end, size in auto.iter(text)] if len(auto) else []
            if not ends:
                continue
            blanks = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), np.uint32) == 32)     # before each word
            hit = np.flatnonzero(np.isin(s.at, np.searchsorted(blanks, ends)))
            start = np.repeat(s.first[hit] - np.cumsum(s.n[hit]) + s.n[hit], s.n[hit]) + np.arange(s.n[hit].sum())
            out.append(pd.DataFrame({"doc_id": pd.array([doc_id] * len(start), dtype="string"), "_h": h, "start": start,
                                     "phrase": np.repeat(s.grams[s.at[hit]], s.n[hit]), "w": s.windows(start)}))
        return pd.concat(out) if out else pd.DataFrame({c: [] for c in ("doc_id", "_h", "start", "phrase", "w")})
    return run


def repeated_windows(rows: DataFrame, window: int, zipped: DataFrame) -> DataFrame:
    """Per (doc_id, _h): ``first`` and ``n``, runs of windows that start elsewhere too. ``rows`` hold texts, ``zipped``
    the same compressed."""
    sketch = materialise(rows.mapInArrow(
        _sketch(window), "doc_id string, _h long, phrase array<long>, passage array<long>, first array<int>, n array<int>")
        .withColumn("row", F.monotonically_increasing_id()), "sub-passages")
    each = sketch.select("row", F.explode(F.arrays_zip("phrase", "passage", "first", "n")).alias("p")).select("row", "p.*")
    count = materialise(each.groupBy("phrase", "passage").agg(F.count("*").alias("c")), "sub-counts")
    heads = count.groupBy("phrase").agg(F.sum("c").alias("_t"), (F.min("c") == 1).alias("open")).where("_t > 1").drop("_t")
    sure = count.join(heads, "phrase").where(F.col("open") | (F.col("c") > 1)).select("phrase", "passage", (F.col("c") > 1).alias("copied"), "open")
    met = each.join(sure, ["phrase", "passage"])
    shut = F.when(F.col("open"), F.col("phrase"))      # hashes are needed of open phrases only
    met = materialise(met.select("row", "first", "n", "copied", shut.alias("phrase"),
                                 F.when(F.col("open"), F.col("passage")).alias("passage")), "sub-met")
    keys = sketch.select("row", "doc_id", "_h")

    # step 3: every passage of an open phrase, copied ones once
    some = met.where(F.col("phrase").isNotNull())
    asked = (some.where(~F.col("copied")).select("row", "phrase")
             .unionByName(some.where("copied").groupBy("phrase", "passage").agg(F.min("row").alias("row")).select("row", "phrase")))
    asked = asked.join(keys, "row").select("doc_id", "_h", "phrase").distinct()
    asked = materialise(asked.groupBy(F.col("doc_id").alias("_id"), F.col("_h").alias("_k")).agg(F.collect_list("phrase").alias("phrases")), "sub-open")
    shards = asked.count() // SHARD_DOCS + 1
    # of rows equal in id and text one is enough: their passages are copied ones
    docs = zipped.groupBy("doc_id", "_h").agg(F.any_value("z").alias("z"))
    docs = docs.join(asked, (docs["doc_id"] == asked["_id"]) & (docs["_h"] == asked["_k"]))
    docs = docs.select("doc_id", "_h", "z", "phrases", F.pmod(F.xxhash64("doc_id", "_h"), F.lit(shards)).alias("shard"))
    found = materialise(docs.groupBy("shard").applyInPandas(
        _locate(window), "doc_id string, _h long, start int, phrase long, w long"), "sub-windows")
    # written, so that both sides of the join are shuffles, which AQE can split where a window is hot
    twice = materialise(found.groupBy("phrase", "w").agg(F.count("*").alias("c")).where("c > 1").drop("c"), "sub-twice")
    single = found.join(twice, ["phrase", "w"], "left_semi").select("doc_id", "_h", F.col("start").alias("first"), F.lit(1).alias("n"))
    runs = met.where("copied").join(keys, "row").select("doc_id", "_h", "first", "n")
    return (runs.unionByName(single).distinct().groupBy("doc_id", "_h")
            .agg(F.collect_list("first").alias("first"), F.collect_list("n").alias("n")))


def _cut(window: int):
    def run(zs: pd.Series, first: pd.Series, n: pd.Series) -> pd.DataFrame:
        rows = []
        for z, at, many in zip(zs, first, n, strict=True):
            words = _words(zstandard.ZstdDecompressor().decompress(z))
            gone = np.zeros(len(words) + 1, np.int64)
            if at is not None and len(at):
                np.add.at(gone, np.asarray(at, np.int64), 1)
                np.add.at(gone, np.asarray(at, np.int64) + np.asarray(many, np.int64) + window - 1, -1)
            kept = np.flatnonzero(np.cumsum(gone)[:len(words)] == 0)
            rows.append((len(words), len(words) - len(kept), b" ".join([words[i] for i in kept.tolist()]).decode()))
        return pd.DataFrame(rows, columns=["n_words", "n_removed", "text"])
    return F.pandas_udf(run, "struct<n_words long, n_removed long, text string>")


def dedup_substrings(docs: DataFrame, window: int = 35) -> DataFrame:
    """``docs`` with the kept words as ``text``, ``n_words`` of the input and ``n_removed``."""
    keep = [c for c in common.replace_columns(docs, OUT) if c.lower() != "doc_id"]
    name = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit("~"))
    key = [name.alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_h")]
    z = F.pandas_udf(_zip, "binary")("text").alias("z")
    hits = repeated_windows(docs.select(*key, "text"), window, docs.select(*key, z)).withColumnsRenamed({"doc_id": "_id", "_h": "_k"})
    every = docs.select(F.struct(F.col("doc_id"), *[docs[c] for c in keep]).alias("_row"), *key, z)
    out = every.join(hits, (every["doc_id"] == hits["_id"]) & (every["_h"] == hits["_k"]), "left")
    return (out.select("_row.doc_id", *[F.col(f"_row.`{c}`").alias(c) for c in keep], _cut(window)("z", "first", "n").alias("_o"))
            .select("doc_id", *keep, "_o.*"))
