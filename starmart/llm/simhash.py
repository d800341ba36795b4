"""SimHash near-dedup over a byte-position inverted index with count filtering.

A fingerprint is eight positional bytes. Two fingerprints that differ in at most d
bits differ in at most d bytes, so they share at least 8 - d positional bytes: the
guaranteed minimum. The index keys are sets of three (position, byte) pairs
rather than single ones; the family of position sets is chosen so that any two fingerprints
with the guaranteed number of shared bytes meet under at least one key (20 sets for
d <= 4, a Turan system), which keeps posting lists 65,536 times shorter. For every pair in a
posting list the shared positional bytes are tallied, pairs below the guaranteed
minimum are dropped and the bit distance of the others is verified.

Only distinct fingerprints are indexed, so copies cost nothing. A posting list emits a
spanning forest of its links, never all pairs, which leaves components unchanged. A long list
is cut into tiles and every pair of tiles becomes a cell of bounded size of its own, so no
list is held by one task and none is capped.

Defined cases: null, empty and blank texts have fingerprint zero and link like any
other; texts of fewer words than a shingle are one shingle; repeated rows share a
component; a component whose ids are all null has a null id; an empty table gives an empty
result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.session import materialise

from .components import connected

SEED = 42
CELL = 4096          # fingerprints of a posting list that one tile holds
CHUNK = 1 << 16      # shingle hashes counted at once


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Unsigned 64-bit SimHash of one text."""
    words = (text or "").encode().lower().split()    # bytes.lower and bytes.split know ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        first = np.concatenate(([0], ends[:-shingle])).tolist()
        last = (ends[shingle - 1:] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(first, last, strict=True)]
    h = np.array(hashes, dtype="<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), CHUNK):
        part = h[at:at + CHUNK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = 4) -> Column:
    """The fingerprint as a signed 64-bit column."""
    @F.pandas_udf("long")
    def apply(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in s], dtype=np.uint64).view(np.int64))
    return apply(text)


def position_sets(max_bits: int) -> list[tuple[int, ...]]:
    """Sets of byte positions, one of which lies in any 8 - max_bits positions."""
    if not 0 <= max_bits <= 7:
        raise ValueError("max_bits is 0 to 7: beyond that no positional byte is guaranteed to be shared")
    least = 8 - max_bits
    if least < 4:
        return list(itertools.combinations(range(8), least))
    part = [0, 0, 0, 1, 1, 1, 2, 2]          # positions in three parts; a set lies in one or steps to the next
    out = []
    for c in itertools.combinations(range(8), 3):
        n = [sum(part[p] == k for p in c) for k in range(3)]
        if 3 in n or any(n[k] == 2 and n[(k + 1) % 3] == 1 for k in range(3)):
            out.append(c)
    return out


def index(prints: DataFrame, max_bits: int, column: str = "fp") -> DataFrame:
    """(key, fp): a row per fingerprint and position set."""
    byte = [F.shiftrightunsigned(F.col(column), 8 * p).bitwiseAND(F.lit(255)) for p in range(8)]
    keys = []
    for k, places in enumerate(position_sets(max_bits)):
        key = F.lit(k).cast("long")
        for p in places:
            key = F.shiftleft(key, 8).bitwiseOR(byte[p])
        keys.append(key)
    return prints.select(F.explode(F.array(*keys)).alias("key"), F.col(column).alias("fp"))


def _forest(fp: np.ndarray, run_end: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Spanning forest of the links within runs; ``run_end`` is the end of each row's run."""
    parent = np.arange(len(fp))
    edges = []
    here = np.arange(len(fp))
    for step in range(1, len(fp)):
        here = here[here + step < run_end[here]]
        if not len(here):
            break
        there = here + step
        x = fp[here] ^ fp[there]
        tally = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
        link = (tally >= 8 - max_bits) & (np.bitwise_count(x) <= max_bits) & (x != 0)
        link &= parent[here] != parent[there]
        if not link.any():
            continue
        for a, b in zip(here[link].tolist(), there[link].tolist(), strict=True):
            ra, rb = a, b
            while parent[ra] != ra:
                ra = parent[ra]
            while parent[rb] != rb:
                rb = parent[rb]
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
                edges.append((a, b))
        while (up := parent[parent]).tobytes() != parent.tobytes():
            parent = up
    return edges


def _links(max_bits: int):
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows sorted by cell; a cell that a batch cuts is carried over."""
        held: list[pd.DataFrame] = []

        def emit(rows: pd.DataFrame) -> pd.DataFrame:
            cell = rows[["key", "i", "j"]].to_numpy()
            fp = rows["fp"].to_numpy().view(np.uint64)
            cut = np.flatnonzero((cell[1:] != cell[:-1]).any(axis=1)) + 1
            bounds = np.concatenate((cut, [len(fp)]))
            sizes = np.diff(np.concatenate(([0], bounds)))
            found = _forest(fp, np.repeat(bounds, sizes), max_bits)
            pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
            ids = fp.view(np.int64)
            return pd.DataFrame({"a": ids[pairs[:, 0]], "b": ids[pairs[:, 1]]})

        for batch in batches:
            if not len(batch):
                continue
            last = batch[["key", "i", "j"]].to_numpy()
            differs = np.flatnonzero((last != last[-1]).any(axis=1))
            whole = differs[-1] + 1 if len(differs) else 0
            if whole:
                yield emit(pd.concat([*held, batch.iloc[:whole]], ignore_index=True))
                held = [batch.iloc[whole:]]
            elif held and tuple(held[-1][["key", "i", "j"]].iloc[-1]) != tuple(last[-1]):
                yield emit(pd.concat(held, ignore_index=True))
                held = [batch]
            else:
                held.append(batch)
        if held:
            yield emit(pd.concat(held, ignore_index=True))
    return scan


def links(prints: DataFrame, max_bits: int = 4, cell: int = CELL) -> DataFrame:
    """(a, b) links between distinct fingerprints ``fp``: a forest with the components of all links."""
    idx = index(prints, max_bits)
    long = (idx.groupBy("key").count().where(F.col("count") > cell)
            .select(F.col("key").alias("_k"), F.ceil(F.col("count") / cell).cast("int").alias("_tiles")))
    long = materialise(long, "simhash-long")
    idx = (idx.join(long, idx["key"] == long["_k"], "left")
           .withColumn("_tiles", F.coalesce("_tiles", F.lit(1)))
           .withColumn("_t", F.pmod(F.xxhash64("fp"), F.col("_tiles")).cast("int"))
           .withColumn("_x", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)))
           .select("key", F.least("_t", "_x").alias("i"), F.greatest("_t", "_x").alias("j"), "fp"))
    dealt = idx.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInPandas(_links(max_bits), "a long, b long")


def components(docs: DataFrame, shingle: int = 4, max_bits: int = 4, extra: tuple[Column, ...] = ()) -> DataFrame:
    """Per row of ``docs``: doc_id, ``extra``, fingerprint (hex), component_id, fp and the root fingerprint of its component."""
    prints = materialise(docs.select("doc_id", *extra, fingerprint_column(F.col("text"), shingle).alias("_fp")),
                         "simhash-prints")
    distinct = prints.groupBy(F.col("_fp").alias("fp")).agg(F.min("doc_id").alias("least"))
    distinct = materialise(distinct, "simhash-distinct")
    roots = connected(materialise(links(distinct.select("fp"), max_bits), "simhash-links"))
    member = (distinct.join(roots, distinct["fp"] == roots["node"], "left")
              .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    ids = member.groupBy(F.col("root").alias("_root")).agg(F.min("least").alias("component_id"))
    member = member.join(ids, member["root"] == ids["_root"]).select(F.col("fp").alias("_mfp"), "component_id", "root")
    out = prints.join(member, prints["_fp"] == member["_mfp"])
    named = [c for c in prints.columns if c not in ("_fp",)]
    return out.select(*[prints[c] for c in named], F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"),
                      "component_id", F.col("_fp").alias("fp"), "root")


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one row of each component: the smallest id (null last), then the smallest text hash."""
    who = components(docs, shingle, max_bits, (F.md5("text").alias("_h"),))
    first = (who.groupBy("root")
             .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", F.col("_h").isNull(), "_h")).alias("_m"))
             .select(_identity(F.col("_m.doc_id"), F.col("_m._h")).alias("_k")))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"),
                       _identity(docs["doc_id"], F.md5(docs["text"])).alias("_k"))
    # one shuffle of the texts: equal rows go map-side first, the join uses the same key
    return rows.dropDuplicates(["_k"]).join(first.hint("merge"), "_k", "left_semi").select("_row.*")


def _identity(doc_id: Column, digest: Column) -> Column:
    """One key for rows equal in id and text, nulls told from values."""
    return F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("~")), F.coalesce(digest, F.lit("~")))
