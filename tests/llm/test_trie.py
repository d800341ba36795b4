"""Prefix trie: parentheses against a stack, nodes against a plain dictionary of prefixes."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from starmart.llm import registry, trie
from tests.conftest import SF


def test_findclose_equals_a_stack():
    rng = random.Random(2)
    for n in (1, 2, 3, 40, 700, 9000):
        depth, at = [], 0
        for _ in range(n):
            at = rng.randint(1, at + 1) if rng.random() < 0.5 else at + 1
            depth.append(at)
        t = trie.Trie(np.array(depth, np.int64))
        stack, close = [], {}
        for k, b in enumerate(t.parens.bits.tolist()):
            if b:
                stack.append(k)
            else:
                close[stack.pop()] = k
        assert not stack and [close[k] for k in t.opens.tolist()] == t.close.tolist()
        ends = [next((j for j in range(i + 1, n) if depth[j] <= depth[i]), n) for i in range(min(n, 700))]
        assert t.end[:700].tolist() == ends


def brute(rows):
    """Nodes of (conv_id, turn, role, text) rows, by the contract of the query."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))

    def key(t):
        x = (t[0], t[1], hashlib.md5(f"{len(t[2].encode())}|{t[2]}{t[3]}".encode()).hexdigest())
        return x
    turns = {c: [t[2:] for t in sorted(ts, key=key)] for c, ts in own.items()}
    built = {}
    for c, ts in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(turns.get(c - c % 100, [])[:h] + ts[h:])
    nodes = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(ts[:d], []).append(c)
    children, leaves, saved = {}, {}, {}
    for p in nodes:
        if p:
            children[p[:-1]] = children.get(p[:-1], 0) + 1
    for p, cs in nodes.items():
        own_saved = (len(cs) - 1) * (len(p[-1][1]) if p else 0)
        for d in range(len(p) + 1):
            leaves[p[:d]] = leaves.get(p[:d], 0) + (p not in children)
            saved[p[:d]] = saved.get(p[:d], 0) + own_saved
    out = []
    for p, cs in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(built[c]) == len(p)))
        out.append((min(cs), len(p), min(nodes[p[:-1]]) if p else None, len(cs), children.get(p, 0), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def _run(spark, tmp_path, rows, kind="conv_id long, turn long, role string, text string"):
    spark.createDataFrame(rows, kind).write.mode("overwrite").parquet(f"{tmp_path}/conversations.parquet")
    return sorted([tuple(r) for r in registry.op11_prefix_trie(spark, str(tmp_path)).collect()], key=str)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted([tuple(r) for r in registry.op11_prefix_trie(spark, SF).collect()], key=str) == brute(rows)


@pytest.mark.parametrize("limit", [1, 7, 60, 100_000])
def test_spine_and_shards_of_any_size(spark, tmp_path, monkeypatch, limit):
    """Copies, shared first turns, a common first turn, nulls, ties, turnless and long conversations, absent bases."""
    monkeypatch.setattr(trie.prefix_trie, "__defaults__", (limit,))
    monkeypatch.setattr(trie, "CHUNK", 3)
    monkeypatch.setattr(trie, "RUN", 4)
    rng = random.Random(limit)
    rows = []
    for c in rng.sample(range(0, 420), 130):
        if c // 100 == 2 and c % 100 == 0:
            continue
        n = rng.choice([1, 2, 3, 5, 8])
        text = ["same", "", None, "é😀"][c % 4]
        rows += [(c, rng.choice([None, t, t, t // 2]), ["user", None, "assistant"][t % 3], text if t else "hello") for t in range(n)]
    rows += [(100, t, "user", f"t{t}") for t in range(30)] + [(None, 0, "user", "lost"), (300, 0, "user", "x" * 100_000)]
    rows += [r for r in rows if r[0] in (7, 100)]
    assert _run(spark, tmp_path, rows) == brute(rows)


def test_empty_table_and_clashing_columns(spark, tmp_path):
    kind = "conv_id long, turn long, role string, text string, IDX int, n string, d long, key binary"
    assert _run(spark, tmp_path, [], kind) == []
    rows = [(c, t, "u", f"a{t}", 1, "n", 2, b"k") for c in (1, 2, 100) for t in range(3)]
    assert _run(spark, tmp_path, rows, kind) == brute([r[:4] for r in rows])
