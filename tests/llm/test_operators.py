"""The training-data operators against brute force, on rows with nulls, ties, copies and odd texts."""

import collections
import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import (ann, common, decontaminate, lines, mixing, pii, sharding, simhash, substrings, token_output,
                          toxicity)
from starmart.llm.registry import END_ID, tokenizer_path

BASE = " ".join(f"w{i}" for i in range(60))
ROWS = [
    (1, "a\nb\nc\nd\ne", "s0"), (2, "x\nb\nc\nd\ny", "s0"), (3, None, None), (4, "", "s1"), (5, "   ", "s1"),
    (6, BASE, "s2"), (6, BASE, "s2"), (None, "lone " + BASE + " tail", "s2"), (8, "word " * 3000, "s0"),
    (9, "a\nb\nc\nd\ne", "s0"), (10, "mail a.b@c.example.org or 10.0.0.1 or +1 (743) 555-3824", "s1"),
    (11, "a  b \n c\td <|endoftext|> é.", "s3"), (12, BASE.replace("w30", "v30"), "s3"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 7, "clash") for r in ROWS], "doc_id long, text string, source string, size int, SHARD string")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where(F.lit(False))


def test_mixing_meets_targets(spark, docs):
    out = mixing.mix_plan(docs).collect()
    again = mixing.mix_plan(docs.repartition(5)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again)) and len(out) == len(ROWS)
    size = collections.Counter()
    for _, text, s in ROWS:
        size[s] += len((text or "").split())
    order = sorted((s for s in size if s is not None)) + [None]
    weight, cap = {s: float(1 + i % 3) for i, s in enumerate(order)}, {s: 3.0 * size[s] for s in order}
    target, left = {}, dict(weight)
    while left:                                     # excess reshared until none is above
        rest = sum(size.values()) - sum(target.values())
        over = [s for s in left if rest * left[s] / sum(left.values()) > cap[s]]
        if not over:
            target.update({s: rest * left[s] / sum(left.values()) for s in left})
            break
        for s in over:
            target[s] = cap[s]
            del left[s]
    taken = collections.Counter()
    for r in out:
        assert r["target"] == pytest.approx(target[r["source"]]) and r["source_size"] == size[r["source"]]
        assert r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in order:
        largest = max(len((t or "").split()) * ROWS.count((i, t, x)) for i, t, x in ROWS if x == s)
        assert abs(taken[s] - target[s]) <= largest / 2 + 1e-6
    assert mixing.mix(docs).columns == docs.columns
    assert mixing.mix(docs).count() == sum(r["copies"] for r in out)


def test_simhash_components(spark, docs):
    out = simhash.components(docs).collect()
    fp = [int(r["fingerprint"], 16) for r in out]
    ids = [r["doc_id"] for r in out]
    group = list(range(len(fp)))
    for _ in fp:
        for a, b in itertools.combinations(range(len(fp)), 2):
            if (fp[a] ^ fp[b]).bit_count() <= 4:
                group[a] = group[b] = min(group[a], group[b])
    for r, g in zip(out, group, strict=True):
        assert r["component_id"] == min((i for i, x in zip(ids, group, strict=True) if x == g and i is not None), default=None)
    kept = simhash.keep_one(docs)
    assert kept.count() == len(set(group)) and kept.columns == docs.columns


def test_simhash_keeps_one_of_near_copies_without_ids(spark):
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[:n]) for n in (400, 399, 398)]
    prints = [simhash.fingerprint(t) for t in texts]
    assert len(set(prints)) > 1 and all((a ^ b).bit_count() <= 4 for a, b in itertools.combinations(prints, 2))
    d = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    assert simhash.keep_one(d).count() == 1


def test_simhash_sets_cover_and_tiles_lose_no_link(spark):
    for bits in range(8):
        sets = simhash.position_sets(bits)
        for shared in itertools.combinations(range(8), 8 - bits):
            assert any(set(s) <= set(shared) for s in sets)
    rng = np.random.default_rng(3)
    base = int(rng.integers(1, 2**62))
    prints = sorted({base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 62, (60, 2))})
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    for cell in (4096, 7):
        pairs = simhash.links(df, 4, cell=cell).collect()
        parent = {p: p for p in prints}
        for _ in prints:
            for r in pairs:
                parent[r["a"]] = parent[r["b"]] = min(parent[r["a"]], parent[r["b"]])
        assert len(set(parent.values())) == 1


def test_token_segments_round_trip(spark, docs, tmp_path, monkeypatch):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    monkeypatch.setattr(token_output, "READ_DOCS", 3)
    folder = str(tmp_path / "tokens")
    manifest = token_output.write_tokens(docs, folder, tokenizer_path(), END_ID)
    got = token_output.read_tokens(spark, manifest, folder).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in ROWS), key=lambda i: (i is not None, i or 0))
    ids = {r[0]: tok.encode(r[1] or "", add_special_tokens=False).ids + [END_ID] for r in ROWS}
    at = 0
    for r in got:
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids[r["doc_id"]] and r["start"] == at
        at += r["n_tokens"]
    m = manifest.first()
    seg = token_output.Segment(folder, m["segment"])
    assert sum(len(seg.doc(i)) for i in range(seg.n)) == m["n_ids"]


def test_elias_fano():
    rng = np.random.default_rng(1)
    for n, u in ((0, 5), (1, 1), (700, 3), (3000, 10**9)):
        v = np.sort(rng.integers(0, u, n))
        ef, _ = token_output.EliasFano.from_bytes(token_output.EliasFano.encode(v).to_bytes())
        assert (ef.values(0, n).astype(np.int64) == v).all() and [ef.select(i) for i in range(n)] == v.tolist()
        for a in range(0, n, 97):
            assert (ef.values(a, min(a + 300, n)).astype(np.int64) == v[a:a + 300]).all()


def test_substrings_brute_force(spark, docs):
    texts = [(r[0], (r[1] or "").encode().split()) for r in ROWS]
    seen = collections.Counter(tuple(w[i:i + 35]) for _, w in texts for i in range(len(w) - 34))
    want = []
    for i, w in texts:
        gone = {p for a in range(len(w) - 34) if seen[tuple(w[a:a + 35])] > 1 for p in range(a, a + 35)}
        want.append((i, len(w), len(gone), b" ".join(x for p, x in enumerate(w) if p not in gone).decode()))
    got = [(r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in substrings.dedup_substrings(docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_toxicity_learns_and_holds_out(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(400):
        words = rng.choice(["lorem", "ipsum", "dolor", "amet"], 20).tolist() + (["idiotic"] if i % 4 == 0 else [])
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    rows += [(None, None, 0), (1000, "", None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    out = {r["doc_id"]: r for r in toxicity.score(d.drop("toxic"), d).collect()}
    for i, _, t in rows[:400]:
        assert out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and out[i]["predicted"] == t
    assert 0 <= out[None]["score"] <= 1 and not out[None]["held_out"]
    none = toxicity.score(d.drop("toxic"), d.where(F.lit(False)))
    assert none.where(F.col("score") < 0.5).count() == len(rows)


def test_toxicity_counts_all_labelled_rows(spark):
    rare = ["zqxj", "wvkp", "hjbd", "fygc", "mlnr", "kkuu", "bbvv", "ppqq", "ddjj", "ggww"]
    rows = [(i, "common text" + (f" {rare[i // 2 % 10]}" if i % 2 else ""), i % 2) for i in range(120)]
    d = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    counts, totals = toxicity.class_counts(d.withColumnRenamed("toxic", "_toxic"))
    plain = toxicity.features("common text")
    assert totals.tolist() == [60, 60] and (counts[:, plain].max(axis=0) == 60).all()
    weights = toxicity.train(d.drop("toxic"), d, max_rows=8)[0]      # 8 rows hold no rare word three times
    assert max(weights[np.setdiff1d(toxicity.features(f"common text {w}"), plain)].max() for w in rare) > 0


def test_decontamination_finds_edited_items(spark):
    item = "the quick brown fox jumps over the lazy dog while seven wizards box quietly nearby"
    edited = item.replace("lazy", "lasy").replace("seven", "sven").upper()
    far = item.replace("quick brown fox", "slow green turtle").replace("seven wizards", "eight lizards")
    d = spark.createDataFrame([(1, f"intro {item} outro"), (2, f"x  {edited}\n y"), (3, far), (4, None), (5, "")],
                              "doc_id long, text string")
    b = spark.createDataFrame([(7, item), (8, None), (9, "short"), (10, item)], "item_id long, text string")
    out = {r["doc_id"]: r["items"] for r in decontaminate.contaminated(d, b).collect()}
    assert out == {1: [7, 10], 2: [7, 10], 3: [], 4: [], 5: []}


def test_decontamination_finds_short_items_and_items_without_id(spark):
    d = spark.createDataFrame([(1, "He asked: Who wrote  Emma? Nobody knew"), (2, "grandwho wrote emmas"), (3, "who wrot emma"), (4, "pi is 3.14 or so"),
                               (5, "an item without any id at all but long enough"), (6, None), (7, "问题中国的首都是哪里答案")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "who wrote emma"), (2, "Pi"), (3, " "), (4, "中国的首都是哪里"), (None, "item without any id at all but long")],
                              "item_id long, text string")
    want = {1: [1], 2: [], 3: [1], 4: [2], 5: [None], 6: [], 7: [4]}
    for size in (8 << 20, 60):                       # one block, several blocks
        out = decontaminate.contaminated(d, b, block_bytes=size).collect()
        assert {r["doc_id"]: r["items"] for r in out} == want
        assert all(r["contaminated"] == bool(want[r["doc_id"]]) for r in out)


def test_decontamination_holds_one_block_at_a_time(spark, monkeypatch):
    d = spark.createDataFrame([(1, "one two three"), (1, "one two three")], "doc_id long, text string")
    b = spark.createDataFrame([(i, t) for i, t in enumerate(["one", "two", "three", "four"] * 2)], "item_id long, text string")
    events, blocks, write = [], decontaminate.item_blocks, decontaminate.materialise
    monkeypatch.setattr(decontaminate, "item_blocks", lambda *a: (events.append("block") or x for x in blocks(*a)))
    monkeypatch.setattr(decontaminate, "materialise", lambda *a: (events.append("written"), write(*a))[1])
    out = decontaminate.contaminated(d, b, block_bytes=100).collect()
    assert [r["items"] for r in out] == [[0, 1, 2, 4, 5, 6]] * 2
    assert events == ["block", "written"] * (len(events) // 2) and len(events) > 2


def test_myers_equals_dynamic_programming():
    rng = np.random.default_rng(5)
    for _ in range(200):
        p, t = ("".join(rng.choice(list("abc"), n)) for n in rng.integers(1, 15, 2))
        row = [0] * (len(t) + 1)
        for i, c in enumerate(p, 1):
            new = [i]
            for j, x in enumerate(t, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != x)))
            row = new
        assert decontaminate.edit_distance_within(p, t) == min(row)


def test_sharding_law(spark, docs):
    for d in (docs, docs.unionByName(docs)):
        rows = sharding.digest(d)
        out = sharding.interleave(rows, 5).collect()
        by = collections.defaultdict(list)
        for r in out:
            by[r["shard"]].append(r["slot"])
            assert r["law"] == "rows" and r["grown_shard"] is None
        assert all(sorted(s) == list(range(len(s))) for s in by.values())
        assert max(map(len, by.values())) - min(map(len, by.values())) <= 1 and len(out) == rows.count()
        assert sorted(map(str, sharding.interleave(rows.repartition(3), 5).collect())) == sorted(map(str, out))


def test_pii_base_and_learnt(spark, docs):
    assert pii.base_spans(ROWS[10][1]) == [("email", 5, 22), ("ip", 26, 34), ("phone", 38, 55)]
    out = {r["doc_id"]: r for r in pii.digest(pii.find(docs)).collect()}
    assert (out[10]["n_email"], out[10]["n_ip"], out[10]["n_phone"], out[3]["spans"]) == (1, 1, 1, "")
    rows = [(i, f"please call number +1 (743) 555-38{i:02d} today") for i in range(10, 30)] + [(99, "please call number 743-555-3899 now")]
    found = {r["doc_id"]: r["spans"] for r in pii.digest(pii.find(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert found[99] == "phone:19:31"


def test_pii_learns_grouped_numbers_and_addresses(spark):
    cards = ["4111 1111 1111 1111", "5500-0000-0000-0004", "340000000000009", "6011000000000004"]
    rows = [(i, f"please call number +1 (743) 555-38{i:02d} today") for i in range(10, 30)]
    rows += [(30 + i, f"write me at ann.lee{i}@example.org please") for i in range(10)]
    rows += [(40 + i, f"paid with card {c} now") for i, c in enumerate(cards)]
    asked = {
        90: ("please call number 555 123 4567 today", ["555 123 4567"]), 91: ("please call number (974) 555-3436.", ["(974) 555-3436"]),
        92: ("paid with card 4111 1111 1111 1112 now", ["4111 1111 1111 1112"]),
        93: ("write me at john(at)example.org please", ["john(at)example.org"]), 94: ("555 123 4567 rang", ["555 123 4567"]),
        95: ("john(at)example.org", ["john(at)example.org"]), 96: ("please call number 5 times", []),
        97: ("please call number 743-555-3899 2 times", ["743-555-3899"]), 98: ("please call number 743-555-3898", ["743-555-3898"])}
    rows += [(i, t) for i, (t, _) in asked.items()]
    found = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: [t[s["start"]:s["end"]] for s in found[i]] for i, (t, _) in asked.items()} == {i: w for i, (_, w) in asked.items()}
    twice = "4111 1111 1111 1112 4111 1111 1111 1112"
    assert pii.candidates(twice, []) == [(0, 19), (20, 39)]
    assert pii.candidates("10.0.0.1 555 123 4567", [(0, 8)]) == [(9, 21)]
    assert pii.candidates("a 743-AB-5521, jo [at] ex [dot] org or jo at ex dot org", []) == [(2, 13), (15, 35), (39, 55)]


def test_ann_recall_and_invalid_vectors(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 8)).astype("float32")
    x[200:400] = x[200]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000, None), (1020, [0.0] * 8), (1040, [float("nan")] * 8), (None, x[0].tolist())]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    by = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: r["rank"]):
        by[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(by) == set(range(0, 600, 20))
    hit = 0
    for q, near in by.items():
        s = x.astype(float) @ x[q].astype(float)
        s[q] = -np.inf
        best = np.argsort(-s, kind="stable")[:20]
        hit += len({i for i, _ in near} & set(best.tolist()))
        assert all(abs(v - s[i]) < 1e-9 for i, v in near) and len(near) == 20
    assert hit >= 0.9 * 20 * len(by)


def test_ann_gives_k_though_leaves_are_small(spark):
    x = np.random.default_rng(6).normal(size=(600, 8)).astype("float32")
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), every=50, k=300, target=0.001)
    assert {r["query_id"]: r["count"] for r in got.groupBy("query_id").count().collect()} == dict.fromkeys(range(0, 600, 50), 300)


def test_lines_brute_force(spark, docs):
    out = {r["doc_id"]: r for r in lines.dedup_lines(docs).collect()}
    assert out[1]["text"] == ROWS[0][1] and out[2]["text"] == "x\ny" and out[9]["text"] == ""
    assert out[3]["text"] is None and out[4]["n_lines"] == 1 and out[6]["n_removed"] == 0


def test_lines_of_copies_are_later_occurrences(spark):
    rows = ([(1, "a\nb\nc\nd", "s0")] * 3 + [(1, "a\nb\nc\nd", "s1"), (2, "x\na\nb\nc", "s0"), (3, "p\nq", "s0"), (3, "p\nq", "s0")]
            + [(None, "k\nl\nm", "s0")] * 2 + [(None, "k\nl\nm", None), (4, "k\nl\nm\nn", "s0"), (None, None, "s0"), (None, None, "s0")])
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = [(1, "a\nb\nc\nd", 4, 0)] + [(1, "", 4, 4)] * 3 + [(2, "x", 4, 3)] + [(3, "p\nq", 2, 0)] * 2
    want += [(None, "k\nl\nm", 3, 0)] + [(None, "", 3, 3)] * 2 + [(4, "n", 4, 3)] + [(None, None, 0, 0)] * 2
    for d in (df, df.repartition(5)):
        out = lines.dedup_lines(d)
        got = out.select("doc_id", "text", "n_lines", "n_removed").collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
        assert (sorted(map(str, out.select("doc_id", "source").collect()))
                == sorted(map(str, df.select("doc_id", "source").collect())))


def test_empty_tables(spark, empty, tmp_path):
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    assert mixing.mix_plan(empty).count() == 0
    assert simhash.components(empty).count() == 0
    assert lines.dedup_lines(empty).count() == 0
    assert sharding.interleave(sharding.digest(empty), 24).count() == 0
    assert substrings.dedup_substrings(empty).count() == 0
    assert toxicity.score(empty, labels).count() == 0
    assert pii.find(empty).count() == 0
    assert ann.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    folder = str(tmp_path / "none")
    manifest = token_output.write_tokens(empty, folder, tokenizer_path(), END_ID)
    assert token_output.read_tokens(spark, manifest, folder).count() == 0
    assert common.replace_columns(empty, ["shard", "SIZE"]) == ["doc_id", "text", "source"]
