"""Merkle manifest: address arithmetic against a recursive layout, results against a plain rebuild of the trees."""

import hashlib
import zlib

import numpy as np
import pytest

from starmart.llm import merkle, registry
from tests.conftest import SF


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain_layout(depth, i, levels):
    """Nodes (depth, i) of a subtree in van Emde Boas order, by definition."""
    if levels == 1:
        return [(depth, i)]
    top = levels // 2
    out = plain_layout(depth, i, top)
    for k in range(1 << top):
        out += plain_layout(depth + top, (i << top) + k, levels - top)
    return out


@pytest.mark.parametrize("height", range(merkle.HEIGHT + 1))
def test_places_are_the_van_emde_boas_order(height):
    layout, order = merkle.Layout(height), plain_layout(0, 0, height + 1)
    assert len(order) == layout.size
    for place, (depth, i) in enumerate(order):
        if place < 300 or place % 37 == 0:
            assert layout.place(depth, np.array([i]))[0] == place


def brute(rows):
    """{row number: (leaf, subroot, root, proof, folded root)} of (doc_id, source, lang, n_chars, text) rows, level by level."""
    def leaf(r):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    def tree(level):
        """Root and each member's siblings [(side, digest)] from the bottom up."""
        paths, at = [[] for _ in level], list(range(len(level)))
        while len(level) > 1:
            for p, k in zip(paths, at, strict=True):
                p.append(("R" if k % 2 == 0 else "L", level[k ^ 1]) if k ^ 1 < len(level) else None)
            level = [sha("".join(level[k:k + 2])) for k in range(0, len(level), 2)]
            at = [k // 2 for k in at]
        return level[0], paths

    groups = {}
    for k, r in enumerate(rows):
        groups.setdefault(r[2], []).append(k)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    made = {}
    for g in names:
        ks = sorted(groups[g], key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, leaf(rows[k])))
        made[g] = (ks, *tree([leaf(rows[k]) for k in ks]))
    if not names:
        return {}
    root, tops = tree([made[g][1] for g in names])
    out = {}
    for g, top in zip(names, tops, strict=True):
        ks, subroot, paths = made[g]
        for k, p in zip(ks, paths, strict=True):
            r = list(rows[k])
            if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                r[3] += 1
            x, siblings = leaf(r), ""
            for s in p + top:
                if s is None:
                    x = sha(x)
                else:
                    siblings += s[1]
                    x = sha(x + s[1]) if s[0] == "R" else sha(s[1] + x)
            out[k] = (rows[k][0], leaf(rows[k]), subroot, root, sha(siblings), x, x == root)
    return out


def _run(spark, tmp_path, rows):
    kind = "doc_id long, source string, lang string, n_chars long, text string, tree string, KEY int, digest binary"
    spark.createDataFrame([(*r, "t", 1, b"d") for r in rows], kind).write.parquet(f"{tmp_path}/documents.parquet")
    return sorted([tuple(r) for r in registry.op12_merkle(spark, str(tmp_path)).collect()], key=str)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    got = sorted([tuple(r) for r in registry.op12_merkle(spark, SF).collect()], key=str)
    assert got == sorted(brute(rows).values(), key=str)
    assert not all(r[-1] for r in got) and any(r[-1] for r in got)


ODD = [(k % 40 if k % 9 else None, None if k % 5 else "s", [None, "", "en", "é", "z"][k * k % 5], None if k % 4 == 0 else k,
        ["", None, "a", "x" * 300_000][k % 4]) for k in range(90)]
ODD += [ODD[7]] * 3 + [(2**60 + 1, "s", "one", 2**63 - 1, "t"), (14, "s", "two", 2**63 - 1, "t")]


@pytest.mark.parametrize("width", [2, 4])
def test_small_blocks_many_levels(width):
    assert _local(ODD, width) == sorted(brute(ODD).values(), key=str)


def _local(rows, width):
    """The operator's blocks and steps put together in this process, with blocks of ``width`` leaves."""
    height = width.bit_length() - 1

    def forest(digests):
        levels, level = [], digests
        while True:
            n = len(level)
            h = height if n > width else (n - 1).bit_length()
            blocks = [merkle.Block.build(level[i:i + width], h) for i in range(0, n, width)]
            levels.append(blocks)
            level = [b.level(0)[0] for b in blocks]
            if n <= width:
                break
        paths = []
        for k in range(len(digests)):
            steps = []
            for blocks in levels:
                steps += blocks[k // width].steps(np.array([k % width]))[0]
                k //= width
            paths.append(steps)
        return level[0], paths
    want = brute(rows)
    order = {}
    for k in want:
        order.setdefault(rows[k][2], []).append(k)
    names = list(order)
    trees = {g: forest([want[k][1] for k in order[g]]) for g in names}
    root, tops = forest([trees[g][0] for g in names])
    out = []
    for g, top in zip(names, tops, strict=True):
        for k, p in zip(order[g], trees[g][1], strict=True):
            r = list(rows[k])
            if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                r[3] += 1
            x = merkle.fold(sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r)), p + top)
            out.append((rows[k][0], want[k][1], trees[g][0], root, merkle.proof_digest(p + top), x, x == root))
    return sorted(out, key=str)


def test_nulls_ties_repeats_long_texts_and_clashing_columns(spark, tmp_path):
    assert _run(spark, tmp_path, ODD) == sorted(brute(ODD).values(), key=str)


def test_more_than_one_block(spark, tmp_path):
    rows = [(k, "s", "en" if k % 3 else "de", k, f"t{k}") for k in range(14_000)]
    assert _run(spark, tmp_path, rows) == sorted(brute(rows).values(), key=str)


def test_empty_table(spark, tmp_path):
    assert _run(spark, tmp_path, []) == []


def test_steps_lead_to_the_root(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = merkle.manifest(docs).check(steps=True).collect()
    assert all(r.verified and merkle.fold(r.leaf, r.steps) == r.root and merkle.proof_digest(r.steps) == r.proof_sha256 for r in rows)
