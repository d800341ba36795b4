"""Conversation prefix trie in balanced parentheses.

A node is a distinct sequence of the first d turns of a conversation. Its key is the sum, over these turns, of a hash of
(place, role, text): 88 bits, an associative sum, so keys are prefix sums that no task need gather a conversation for.

* A subtree with more than ``limit`` turn rows is shared: its node belongs to the spine. Below the spine every conversation
  hangs on one cut node; cut nodes are dealt to shards by their key, so a shard holds whole subtrees and
  some multiples of ``limit`` rows at most.
* Each shard writes its subtrees as balanced parentheses. ``findclose``, by a range min-max tree over the excess, delimits the
  subtree of every node; the rank of leaf pairs counts its leaves; cumulative arrays over preorder give members
  and savings.
* Spines of all shards are merged: what hangs below a spine node comes as sums from the shards' top nodes, and the spine
  itself, of at most rows / ``limit`` nodes a depth, is once more such a trie.

Conversations that end at a spine node may be a large share of all: they are numbered, written out in chunks of
``CHUNK`` ids, and the chunks of a node pass through one digest as a stream (SHA-256 has no other way), never held together.

Defined cases: null role and text are empty; turns that tie are ordered by content; rows without a
conversation id belong to none and are left out; a conversation without turns is a member of the root
alone; an empty table has no nodes; copies of a conversation are members of the same nodes; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.session import materialise

from . import common

LIMIT = 100_000           # turn rows of a subtree that is not shared
CHUNK = 256
RUN = 4096                # turns of a conversation that one task adds up
SPINE_BROADCAST = 200_000
BLOCK = 64
NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
        "ends_sha256 string")
NO_ENDS = hashlib.sha256(b"").hexdigest()


class Parens:
    """Balanced parentheses (True opens) with a range min-max tree over blocks of the excess."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        n = len(bits)
        self.excess = np.cumsum(np.where(bits, 1, -1))
        n_blocks = -(-n // BLOCK)
        padded = np.full(max(n_blocks, 1) * BLOCK, np.iinfo(np.int64).max)
        padded[:n] = self.excess
        self.blocks = padded.reshape(-1, BLOCK)
        self.least = [self.blocks.min(axis=1)]       # level 0: blocks; above: pairs
        while len(self.least[-1]) > 1:
            x = self.least[-1]
            if len(x) % 2:
                x = np.append(x, np.iinfo(np.int64).max)
            self.least.append(x.reshape(-1, 2).min(axis=1))
        pair = np.zeros(n, np.int64)
        pair[:-1] = bits[:-1] & ~bits[1:]
        self.leaf_rank = np.concatenate(([0], np.cumsum(pair)))        # leaf pairs that open before a place

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """The closing place of each opening one: the first later place of excess one less."""
        target = self.excess[opens] - 1
        block, out = opens // BLOCK, np.full(len(opens), -1)
        todo = np.arange(len(opens))
        for part in np.array_split(todo, max(1, len(todo) // 4096)):       # in its own block
            hit = (self.blocks[block[part]] <= target[part, None]) & (np.arange(BLOCK) > (opens[part] % BLOCK)[:, None])
            found = hit.any(axis=1)
            out[part[found]] = block[part[found]] * BLOCK + hit[found].argmax(axis=1)
        todo = np.flatnonzero(out < 0)
        at, level, down = block[todo].copy(), np.zeros(len(todo), np.int64), np.zeros(len(todo), bool)
        want, live = target[todo], np.ones(len(todo), bool)
        while live.any():       # up until the right sibling holds the target, then down to the first block that does
            for k in range(len(self.least)):
                here = np.flatnonzero(live & (level == k))
                if not len(here):
                    continue
                x = self.least[k]
                rising = here[~down[here]]
                right = at[rising] + 1
                holds = (at[rising] % 2 == 0) & (right < len(x)) & (x[np.minimum(right, len(x) - 1)] <= want[rising])
                at[rising[holds]] += 1
                down[rising[holds]] = True
                climb = rising[~holds]
                at[climb] //= 2
                level[climb] += 1
                sinking = here[down[here]]
                if k == 0:
                    live[sinking] = False
                else:
                    left = 2 * at[sinking]
                    at[sinking] = np.where(self.least[k - 1][left] <= want[sinking], left, left + 1)
                    level[sinking] -= 1
        for part in np.array_split(np.arange(len(todo)), max(1, len(todo) // 4096)):
            hit = self.blocks[at[part]] <= want[part, None]
            out[todo[part]] = at[part] * BLOCK + hit.argmax(axis=1)
        return out


class Trie:
    """A forest in preorder: ``depth`` of each node from the roots' depth up."""

    def __init__(self, depth: np.ndarray):
        n = len(depth)
        closes = depth - np.append(depth[1:], depth.min() - 1 if n else depth) + 1      # after a node opens
        if n:
            closes[-1] -= 1
        self.opens = np.concatenate(([0], np.cumsum(1 + closes)[:-1])) if n else np.zeros(0, np.int64)
        bits = np.zeros(int((1 + closes).sum()), bool)
        bits[self.opens] = True
        self.parens = Parens(bits)
        self.close = self.parens.findclose(self.opens)
        self.end = np.arange(n) + (self.close - self.opens + 1) // 2       # preorder place after the subtree

    def total(self, own: np.ndarray) -> np.ndarray:
        """Sum of ``own`` over each subtree, from its cumulative array."""
        cum = np.concatenate(([0], np.cumsum(own)))
        return cum[self.end] - cum[:-1]

    def leaves(self) -> np.ndarray:
        return self.parens.leaf_rank[self.close] - self.parens.leaf_rank[self.opens]


def _ends(ids: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, np.sort(ids).tolist())).encode()).hexdigest()


def _shard(rows: pd.DataFrame) -> pd.DataFrame:
    """Nodes of the subtrees of a shard: a row holds the part of a conversation below its stem."""
    keys, chars = [list(x) for x in rows["keys"]], list(rows["chars"])
    order = sorted(range(len(rows)), key=keys.__getitem__)
    ids = rows["conv_id"].to_numpy(np.int64)[order]
    stem_d, stem_key = rows["stem_d"].to_numpy(np.int64), rows["stem_key"].tolist()
    first = rows["stem_first"].to_numpy(np.int64)
    depth, size, parent, stem, last_node = [], [], [], [], []
    path: list[int] = []
    before: list[str] = []
    for i in order:
        own = keys[i]
        same = 0
        while same < len(before) and same < len(own) and before[same] == own[same]:
            same += 1
        del path[same:]
        for k in range(same, len(own)):
            parent.append(path[-1] if path else -1)
            path.append(len(depth))
            depth.append(stem_d[i] + 1 + k)
            size.append(chars[i][k])
            stem.append(i)
        last_node.append(path[-1])
        before = own
    depth, parent, stem, last_node = (np.array(x, np.int64) for x in (depth, parent, stem, last_node))
    # roots hang on stems of several depths: parentheses need the depth below the cut only
    trie = Trie(depth - stem_d[stem])
    n_convs = trie.total(np.bincount(last_node, minlength=len(depth)))
    lo, hi = np.searchsorted(last_node, np.arange(len(depth))), np.searchsorted(last_node, trie.end)
    least = np.minimum.reduceat(np.append(ids, np.iinfo(np.int64).max), np.stack([lo, hi], axis=1).ravel())[::2]
    top = parent < 0
    ends = [NO_ENDS] * len(depth)
    for node, a in zip(*np.unique(last_node, return_index=True), strict=True):
        ends[node] = _ends(ids[a:np.searchsorted(last_node, node, "right")])
    return pd.DataFrame({
        "conv_id": least, "depth": depth, "parent_conv_id": np.where(top, first[stem], least[parent]), "n_convs": n_convs,
        "n_children": np.bincount(parent[~top], minlength=len(depth)), "n_leaves": trie.leaves(),
        "saved_tokens": trie.total((n_convs - 1) * np.array(size, np.int64)), "ends_sha256": ends,
        "stem_d": np.where(top, stem_d[stem], -1), "stem_key": [stem_key[i] if t else None for i, t in zip(stem.tolist(), top.tolist(), strict=True)]})


def _spine(rows: pd.DataFrame) -> pd.DataFrame:
    """Nodes of the spine: rows hold what hangs below each outside the spine."""
    name = {k: i for i, k in enumerate(zip(rows["d"].tolist(), rows["key"].tolist(), strict=True))}
    up = [name.get((d - 1, k), -1) for d, k in zip(rows["d"].tolist(), rows["up"].tolist(), strict=True)]
    below: list[list[int]] = [[] for _ in up]
    for i, p in enumerate(up):
        if p >= 0:
            below[p].append(i)
    order, todo = [], [i for i, p in enumerate(up) if p < 0]
    while todo:
        order.append(todo.pop())
        todo += below[order[-1]]
    rows = rows.iloc[order].reset_index(drop=True)
    trie = Trie(rows["d"].to_numpy(np.int64))
    children = np.array([len(below[i]) for i in order], np.int64) + rows["tops"].to_numpy(np.int64)
    # a leaf pair of the spine is a leaf of the trie only where nothing hangs below it in a shard
    false = (rows["tops"].to_numpy(np.int64) > 0) & (trie.end == np.arange(len(rows)) + 1)
    n_convs = rows["n_convs"].to_numpy(np.int64)
    first = rows["first"].to_numpy(np.int64)
    own = (n_convs - 1) * rows["chars"].to_numpy(np.int64) + rows["top_saved"].to_numpy(np.int64)
    place = {i: k for k, i in enumerate(order)}
    return pd.DataFrame({
        "conv_id": first, "depth": rows["d"], "n_convs": n_convs, "n_children": children,
        "parent_conv_id": pd.array([None if up[i] < 0 else int(first[place[up[i]]]) for i in order], dtype="Int64"),
        "n_leaves": trie.leaves() - trie.total(false.astype(np.int64)) + trie.total(rows["top_leaves"].to_numpy(np.int64)),
        "saved_tokens": trie.total(own), "key": rows["key"]})


def _stream_ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One digest a node over its chunks, which come in order."""
    now, digest = None, None
    for b in batches:
        done = []
        for d, key, text in zip(b["d"].tolist(), b["key"].tolist(), b["ids"].tolist(), strict=True):
            if (d, key) != now:
                if now:
                    done.append((*now, digest.hexdigest()))
                now, digest = (d, key), hashlib.sha256()
                digest.update(text.encode())
            else:
                digest.update(b"," + text.encode())
        if done:
            yield pd.DataFrame(done, columns=["d", "key", "ends"])
    if now:
        yield pd.DataFrame([(*now, digest.hexdigest())], columns=["d", "key", "ends"])


def turn_hash(place: Column, digest: Column) -> Column:
    """88 bits of a turn at a place, as a decimal."""
    h = F.md5(F.concat(place.cast("string"), F.lit("|"), digest))
    half = [F.conv(F.substring(h, a, 11), 16, 10).cast("decimal(14,0)") for a in (1, 12)]
    return (half[0] * F.lit(1 << 44).cast("decimal(14,0)") + half[1]).cast("decimal(28,0)")


def number_turns(turns: DataFrame) -> DataFrame:
    """conv_id, idx (from 0, by turn, null first, ties by content), n (turns of the conversation), digest, chars."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit("|"), role, text)).alias("digest"),
        F.char_length(text).cast("long").alias("chars"))
    return common.numbered(rows, ["conv_id"], ["turn", "digest"], "turns").drop("turn")


def prefix_trie(members: DataFrame, turns: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Nodes of the trie over ``members`` (conv_id, total: their number of turns) and their ``turns``
    (conv_id, d from 1, digest, chars)."""
    rows = turns.select("conv_id", "d", "chars", turn_hash(F.col("d"), F.col("digest")).alias("_h"), F.floor(F.col("d") / RUN).alias("_b"))
    rows = common.with_prefix(materialise(rows, "trie-turns"), ["conv_id"], "_b", [F.col("d")], F.col("_h"), "_up")
    up = F.col("_up").cast("decimal(38,0)")
    rows = rows.join(members, "conv_id").select("conv_id", "d", (up + F.col("_h")).cast("decimal(38,0)").cast("string").alias("key"),
                                                up.cast("string").alias("up"), "chars", "total")
    zero = members.select("conv_id", F.lit(0).cast("long").alias("d"), F.lit("0").alias("key"), F.lit(None).cast("string").alias("up"),
                          F.lit(0).cast("long").alias("chars"), "total")
    all_rows = materialise(rows.unionByName(zero), "trie-places")

    # the spine: the root, and nodes above more than ``limit`` turn rows
    spine = all_rows.groupBy("d", "key").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("first"), F.min("up").alias("up"),
                                             F.min("chars").alias("chars"), F.sum(F.col("total") - F.col("d") + 1).alias("_rows"))
    spine = materialise(spine.where((F.col("_rows") > limit) | (F.col("d") == 0)).drop("_rows"), "trie-spine")
    stems = spine.select(F.col("d").alias("_d"), F.col("key").alias("_key"), "first")
    if stems.count() <= SPINE_BROADCAST:
        stems = F.broadcast(stems)
    met = all_rows.join(stems, (all_rows["d"] == stems["_d"]) & (all_rows["key"] == stems["_key"]), "left")
    inside = F.col("first").isNotNull()
    hung = met.groupBy("conv_id").agg(
        F.max(F.when(inside, F.struct("d", "key", "first"))).alias("stem"),
        F.sort_array(F.collect_list(F.when(~inside, F.struct("d", "key", "chars")))).alias("path"))     # at most ``limit`` rows
    hung = materialise(hung.select(
        "conv_id", F.col("stem.d").alias("stem_d"), F.col("stem.key").alias("stem_key"), F.col("stem.first").alias("stem_first"),
        F.col("path.key").alias("keys"), F.col("path.chars").alias("chars")), "trie-paths")

    below = hung.where(F.size("keys") > 0)
    shards = int(below.agg(F.coalesce(F.sum(F.size("keys")), F.lit(0))).first()[0]) // limit + 1
    shard = F.pmod(F.xxhash64("stem_d", F.col("keys")[0]), F.lit(shards))
    nodes = materialise(below.withColumn("shard", shard).groupBy("shard").applyInPandas(
        _shard, NODE + ", stem_d long, stem_key string"), "trie-nodes")

    tops = nodes.where(F.col("stem_d") >= 0).groupBy(F.col("stem_d").alias("d"), F.col("stem_key").alias("key")).agg(
        F.count("*").alias("tops"), F.sum("n_leaves").alias("top_leaves"), F.sum("saved_tokens").alias("top_saved"))
    merged = spine.join(tops, ["d", "key"], "left").fillna(0, ["tops", "top_leaves", "top_saved"])
    stem = merged.groupBy(F.lit(0).alias("_g")).applyInPandas(
        lambda rows: _spine(rows), NODE.replace(", ends_sha256 string", ", key string"))
    enders = hung.where(F.size("keys") == 0).select(F.col("stem_d").alias("d"), F.col("stem_key").alias("key"), "conv_id")
    enders = common.numbered(enders, ["d", "key"], ["conv_id"], "trie-ends").withColumn("chunk", F.floor(F.col("idx") / CHUNK))
    chunks = enders.groupBy("d", "key", "chunk").agg(F.concat_ws(",", F.sort_array(F.collect_list("conv_id")).cast("array<string>")).alias("ids"))
    ends = (chunks.repartition("d", "key").sortWithinPartitions("d", "key", "chunk").select("d", "key", "ids")
            .mapInPandas(_stream_ends, "d long, key string, ends string"))
    stem = stem.join(ends.withColumnRenamed("d", "depth"), ["depth", "key"], "left").withColumn(
        "ends_sha256", F.coalesce("ends", F.lit(NO_ENDS)))
    out = [c.split()[0] for c in NODE.split(", ")]
    return nodes.select(*out).unionByName(stem.select(*out))
