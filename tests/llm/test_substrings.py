"""Substring dedup against brute force on texts with copies, edits, edges, repeats within a text and long texts."""

import collections
import random

import numpy as np
import pytest

from starmart.llm import substrings


def brute(rows, window):
    seen = collections.Counter(tuple(w[i:i + window]) for _, t in rows for w in [(t or "").split()] for i in range(len(w) - window + 1))
    out = []
    for i, t in rows:
        w = (t or "").split()
        gone = {p for a in range(len(w) - window + 1) if seen[tuple(w[a:a + window])] > 1 for p in range(a, a + window)}
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=str)


def made(rng, window):
    """Words of a small and a large vocabulary, passages of about a window shared whole, in part, edited and back to back."""
    word = lambda: rng.choice(["a", "b", f"w{rng.randint(0, 60)}", f"é{rng.randint(0, 10**6)}"])
    text = lambda n: [word() for _ in range(n)]
    shared = [text(rng.randint(window - 2, 3 * window)) for _ in range(6)]
    rows = []
    for i in range(60):
        w = text(rng.randint(0, 2 * window))
        for _ in range(rng.randint(0, 3)):
            s = list(rng.choice(shared))
            if rng.random() < 0.5:
                s[rng.randrange(len(s))] = "edit"
            a = rng.randint(0, 4)
            w += s[a:len(s) - rng.randint(0, 4)] + text(rng.choice([0, 1, 30]))
        rows.append((i % 50 if i % 11 else None, rng.choice([" ", "\n", " \t "]).join(w)))
    rows += [rows[3], rows[3], (70, None), (71, ""), (72, "x" * 200_000), (73, "w " * 5000), (74, " ".join(shared[0]))]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(substrings, "SHARD_DOCS", 5)
    rows = made(random.Random(seed), 35)
    docs = spark.createDataFrame([(*r, 1, "c") for r in rows], "doc_id long, text string, n int, PHRASE string")
    got = substrings.dedup_substrings(docs, 35)
    assert got.columns == ["doc_id", "n", "PHRASE", "n_words", "n_removed", "text"]
    assert sorted([(r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in got.collect()], key=str) == brute(rows, 35)
    assert any(r[2] for r in brute(rows, 35))


def test_smallest_is_the_first_of_equal_ones(monkeypatch):
    rng = np.random.default_rng(1)
    grams = rng.integers(0, 5, 3000).astype(np.uint64) << np.uint64(40)
    monkeypatch.setattr(substrings, "CHUNK", 64)
    for span in (1, 2, 3, 28):
        want = [a + int(np.argmin(grams[a:a + span])) for a in range(len(grams) - span + 1)]
        assert substrings.Sketch._smallest(grams, span).tolist() == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.dedup_substrings(docs).collect() == []
