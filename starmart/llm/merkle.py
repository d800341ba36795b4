"""Merkle manifest of a data set, its trees stored as blocks in van Emde Boas layout.

Leaves of a group (``lang``) are numbered in order of their key. 4 096 neighbouring leaves are an aligned subtree, a
block: one task hashes it and stores its digests in van Emde Boas order, the tree split at half its height, the top part first,
then every bottom part, each laid out the same way. Block roots are the leaves of the next level, and so on until
a group has one block; the group roots, in order of the groups, are the leaves of one last tree of the same kind.

:class:`Layout` is the address arithmetic: the place of node i at depth d follows from the place of the
root of the part that was split above it. Building reads children and proving reads siblings through it; it
has no parameter for a cache or page size.

Proofs are made from the top down: the path of a block is its steps in the block above, then that block's path. A
step is a sibling's digest after ``L`` or ``R``, the side it stands on, or ``-`` for a node without one.

Defined cases: a null field is ``-``; leaves with a null key come first, those with equal keys are ordered
by digest, and copies of one row stand side by side, each a leaf; a null group comes first, an empty
group name after it; a group of one leaf has it as its root; texts of any length are hashed whole on the JVM; an empty table
gives an empty result; columns other than those named are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.session import materialise

from . import common

HEIGHT = 12               # of a block
WIDTH = 1 << HEIGHT
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _hash(*digests: str) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


class Layout:
    """Places of the nodes of a complete binary tree of ``height`` (edges) in van Emde Boas order."""

    def __init__(self, height: int):
        self.size = (1 << height + 1) - 1
        self.split: dict[int, tuple[int, int, int]] = {}     # depth -> depth of the split part's root, nodes of its top, of each bottom
        self._divide(0, height + 1)

    def _divide(self, first: int, levels: int) -> None:
        if levels == 1:
            return
        top = levels // 2
        self.split[first + top] = (first, (1 << top) - 1, (1 << levels - top) - 1)
        self._divide(first, top)
        self._divide(first + top, levels - top)

    def place(self, depth: int, i: np.ndarray) -> np.ndarray:
        """Places of nodes ``i`` (counted from the left) at ``depth``."""
        if depth == 0:
            return np.zeros(len(i), np.int64)
        root, top, bottom = self.split[depth]
        down = depth - root
        return self.place(root, i >> down) + top + (i & ((1 << down) - 1)) * bottom


_LAYOUTS = [Layout(h) for h in range(HEIGHT + 1)]


class Block:
    """An aligned subtree: ``count`` leaves at depth ``height``, digests in van Emde Boas order. Places of absent nodes are zero."""

    def __init__(self, count: int, height: int, nodes: np.ndarray):
        self.layout, self.height, self.nodes = _LAYOUTS[height], height, nodes
        self.counts = [-(-count >> (height - d)) for d in range(height + 1)]     # nodes at each depth

    @classmethod
    def build(cls, leaves: list[str], height: int) -> Block:
        block = cls(len(leaves), height, np.zeros((_LAYOUTS[height].size, 32), np.uint8))
        block._put(height, leaves)
        for depth in range(height - 1, -1, -1):
            below = block.level(depth + 1)
            block._put(depth, [_hash(*below[i:i + 2]) for i in range(0, len(below), 2)])
        return block

    def _put(self, depth: int, digests: list[str]) -> None:
        rows = np.frombuffer(bytes.fromhex("".join(digests)), np.uint8).reshape(-1, 32)
        self.nodes[self.layout.place(depth, np.arange(len(digests)))] = rows

    def level(self, depth: int) -> list[str]:
        text = self.nodes[self.layout.place(depth, np.arange(self.counts[depth]))].tobytes().hex()
        return [text[i:i + 64] for i in range(0, len(text), 64)]

    def steps(self, leaves: np.ndarray) -> list[list[str]]:
        """Steps of each leaf up to the root of the block."""
        out: list[list[str]] = [[] for _ in leaves]
        for depth in range(self.height, 0, -1):
            other = (leaves >> (self.height - depth)) ^ 1
            there = other < self.counts[depth]
            text = self.nodes[self.layout.place(depth, np.where(there, other, 0))].tobytes().hex()
            for k, (ok, right) in enumerate(zip(there.tolist(), (other & 1).tolist(), strict=True)):
                out[k].append(("R" if right else "L") + text[64 * k:64 * k + 64] if ok else "-")
        return out


def fold(leaf: str, steps: list[str]) -> str:
    """The root that a leaf and its steps lead to."""
    for s in steps:
        leaf = _hash(leaf) if s == "-" else _hash(leaf, s[1:]) if s[0] == "R" else _hash(s[1:], leaf)
    return leaf


def proof_digest(steps: list[str]) -> str:
    return _hash(*[s[1:] for s in steps])


def leaf_digest(fields: list[Column]) -> Column:
    """Hex sha256 of the fields, each its length in bytes and its value, null told from empty."""
    def field(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.sha2(F.concat(*[field(c) for c in fields]), 256)


def _order(leaves: DataFrame) -> DataFrame:
    """``leaves`` (tree, key, digest, ...) with ``idx`` within the tree and ``n`` of the tree."""
    return common.numbered(leaves, ["tree"], ["key", "digest"], "merkle")


def _height(n: int) -> int:
    """Of the block that holds a node of a level with n nodes: the tree's top where they fit into one."""
    return HEIGHT if n > WIDTH else (n - 1).bit_length()


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("idx")
    n = int(rows["n"].iloc[0])
    block = Block.build(rows["digest"].tolist(), _height(n))
    return pd.DataFrame({"tree": [rows["tree"].iloc[0]], "block": [int(rows["idx"].iloc[0]) >> HEIGHT], "n": [n],
                         "m": [len(rows)], "root": block.level(0), "nodes": [block.nodes.tobytes()]})


def _in_block(df: DataFrame) -> DataFrame:
    return df.withColumn("block", F.shiftright("idx", HEIGHT))


@dataclass
class Forest:
    """Trees over ``leaves`` (tree, idx, n, digest, ...): a table of blocks for each level, and the roots (tree, root)."""

    leaves: DataFrame
    levels: list[DataFrame]
    roots: DataFrame

    @classmethod
    def build(cls, leaves: DataFrame) -> Forest:
        """A level a round, each a written table; rounds grow with the logarithm (base 4 096) of the largest tree."""
        levels, rows = [], leaves.select("tree", "idx", "n", "digest")
        while True:
            level = _in_block(rows).groupBy("tree", "block").applyInPandas(
                _build, "tree string, block long, n long, m long, root string, nodes binary")
            levels.append(materialise(level, "merkle-blocks"))
            rows = levels[-1].where(F.col("n") > WIDTH).select(
                "tree", F.col("block").alias("idx"), F.ceil(F.col("n") / WIDTH).alias("n"), F.col("root").alias("digest"))
            if rows.isEmpty():
                break
        roots = levels[0].where(F.col("n") <= WIDTH).select("tree", "root")
        for level in levels[1:]:
            roots = roots.unionByName(level.where(F.col("n") <= WIDTH).select("tree", "root"))
        return cls(leaves, levels, roots)

    def climb(self, above: DataFrame | None, member, kind: str) -> DataFrame:
        """``member(row, steps)`` of every leaf (a dict of columns ``kind``): its steps to the root of its tree, then those of
        ``above`` (tree, steps)."""
        top = len(self.levels) - 1
        for k in range(top, -1, -1):
            blocks = self.levels[k]
            ends = F.col("n") <= WIDTH          # the tree's top block: its path is the tree's
            tops = blocks.where(ends)
            tops = (tops.join(above, "tree") if above is not None
                    else tops.withColumn("steps", F.array().cast("array<string>")))
            if k < top:
                tops = tops.unionByName(blocks.where(~ends).join(paths, ["tree", "block"]))    # noqa: F821
            # keys travel as text: pandas would turn a long column with nulls into doubles
            rows = (self.leaves.withColumn("key", F.col("key").cast("string")) if k == 0 else
                    self.levels[k - 1].where(~ends).select("tree", F.col("block").alias("idx")))
            made, kinds = (member, kind) if k == 0 else (_path, "tree string, block long, steps array<string>")
            out = _in_block(rows).groupBy("tree", "block").cogroup(tops.groupBy("tree", "block")).applyInPandas(_climb(made), kinds)
            if k:
                paths = materialise(out, "merkle-paths")
        return out


def _path(row: dict, steps: list[str]) -> dict:
    return {"tree": row["tree"], "block": row["idx"], "steps": steps}


def _climb(member):
    def run(rows: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        b = blocks.iloc[0]
        height = _height(int(b["n"]))
        block = Block(int(b["m"]), height, np.frombuffer(b["nodes"], np.uint8).reshape(-1, 32))
        above = list(b["steps"])
        steps = block.steps(rows["idx"].to_numpy(np.int64) & (WIDTH - 1))
        return pd.DataFrame([member(r, s + above) for r, s in zip(rows.to_dict("records"), steps, strict=True)])
    return run


def _verify(row: dict, steps: list[str]) -> dict:
    return {"tree": row["tree"], "key": row["key"], "leaf": row["digest"], "proof_sha256": proof_digest(steps),
            "folded_root": fold(row["claim"], steps)}


def _verify_steps(row: dict, steps: list[str]) -> dict:
    return _verify(row, steps) | {"steps": steps}


@dataclass
class Manifest:
    """The trees of the groups, the tree over their roots, and its root (a frame of one row, none for an empty table)."""

    groups: Forest
    top: Forest

    @property
    def root(self) -> DataFrame:
        return self.top.roots.select("root")

    def check(self, steps: bool = False) -> DataFrame:
        """Every leaf's claim folded up along its proof: key, leaf, subroot, root, proof_sha256, folded_root, verified
        (and with ``steps`` the proof itself)."""
        paths = self.top.climb(None, lambda r, s: {"tree": r["key"], "steps": s}, "tree string, steps array<string>")
        kind = "tree string, key string, leaf string, proof_sha256 string, folded_root string"
        paths = materialise(paths, "merkle-groups")
        out = (self.groups.climb(paths, _verify_steps, kind + ", steps array<string>") if steps
               else self.groups.climb(paths, _verify, kind))
        out = out.withColumn("key", F.col("key").cast("long"))
        out = out.join(self.groups.roots.withColumnRenamed("root", "subroot"), "tree").drop("tree")
        return out.withColumn("root", self.root.scalar()).withColumn("verified", F.col("folded_root") == F.col("root"))


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang", key: str = "doc_id",
             claim: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs``. ``claim`` replaces fields by other values: what a copy of the data is said to hold, to be
    checked against the proofs (without it the data themselves are checked)."""
    own = [F.col(f"`{f}`") for f in fields]
    said = [(claim or {}).get(f, c) for f, c in zip(fields, own, strict=True)]
    tree = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))     # null first, then in byte order
    leaves = docs.select(tree.alias("tree"), F.col(f"`{key}`").cast("long").alias("key"), leaf_digest(own).alias("digest"),
                         (leaf_digest(said) if claim else leaf_digest(own)).alias("claim"))
    groups = Forest.build(materialise(_order(leaves), "merkle-numbered"))
    roots = groups.roots.select(F.lit("").alias("tree"), F.col("tree").alias("key"), F.col("root").alias("digest"))
    return Manifest(groups, Forest.build(materialise(_order(roots), "merkle-roots")))
