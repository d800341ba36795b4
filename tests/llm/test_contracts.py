"""Results of the queries against second computations: repeated rows, long texts, overflow, brute force over small tables."""

import collections
import random
import re
import time
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from starmart.llm import ann, decontaminate, mixing, pii, registry, sharding, simhash, token_output, toxicity
from tests.conftest import SF

NO_SQL = {"op2_simhash", "op3_tokens", "op5_toxicity", "op6_decontaminate", "op7_sharding", "op8_pii", "op9_ann", "op13_bpe", "pipeline"}


def test_queries_with_and_without_sql():
    assert set(registry.queries()) - set(registry.oracle_sql()) == NO_SQL


# --- op2 ------------------------------------------------------------------------------------------------------

def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] if words else []
    out = 0
    for bit in range(64):
        ones = sum(xxhash.xxh64_intdigest(s.encode(), 42) >> bit & 1 for s in shingles)
        out |= (2 * ones > len(shingles)) << bit
    return out


def test_fingerprints_equal_a_plain_count(spark):
    rng = random.Random(1)
    texts = [None, "", " \t ", "one", "One TWO three", "\xc4 B \xc4 b c", "a a a a a a", "x" * 300_000,
             *(" ".join(rng.choice(["A", "b", "\xc9", "d\xa0e"]) for _ in range(n)) for n in range(1, 60, 7))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["fingerprint"] for r in simhash.components(docs).collect()}
    assert got == {i: f"{plain_fingerprint(t):016x}" for i, t in enumerate(texts)}


# --- op6 ------------------------------------------------------------------------------------------------------

def plain_items(text, items):
    """Ids of the items within their budget of a stretch of the text, by a table of all distances."""
    out = []
    for i, item in items:
        a, b = decontaminate.normalise(item), decontaminate.normalise(text)
        if not a or not b:
            continue
        row = [0] * (len(b) + 1)
        for n, c in enumerate(a, 1):
            left, row[0] = row[0], n
            for j, x in enumerate(b, 1):
                left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (c != x))
        if min(row) <= int(decontaminate.RATE * len(a)):
            out.append(i)
    return sorted(out)


def test_decontamination_equals_brute_force(spark, tmp_path):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(2, 6)))
    items = [(i, " ".join(word() for _ in range(rng.randint(9, 20)))) for i in range(25)]
    docs = [(1000, None), (1001, "")]
    for n in range(60):
        text = [word() for _ in range(rng.randint(0, 20))]
        for _ in range(rng.randint(0, 2)):
            s = list(rng.choice(items)[1])
            for _ in range(rng.randint(0, 10)):
                s[rng.randrange(len(s))] = rng.choice(["", "x", "ab", " "])
            text += ["".join(s)] + [word() for _ in range(rng.randint(0, 9))]
        docs.append((n, "  ".join(text).upper()))
    spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, ITEMS int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r["doc_id"]: sorted(r["items"]) for r in registry.op6_decontaminate(spark, str(tmp_path)).collect()}
    want = {i: plain_items(t, items) for i, t in docs}
    assert got == want and any(want.values())


# --- op7 ------------------------------------------------------------------------------------------------------

def test_shards_match_the_mixture_and_copies_are_spread(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", 64)
    rows = [(7, "same", "a")] * 900 + [(i, f"t{i}", "b" if i % 3 else None) for i in range(800)] + [(None, None, "c")] * 100
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = sharding.interleave(sharding.digest(docs), 6).collect()
    n, by = collections.Counter(r[2] for r in rows), collections.Counter((r["shard"], r["source"]) for r in out)
    slots = collections.defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
        assert r["text_crc32"] == zlib.crc32(("" if r["doc_id"] is None else "same" if r["source"] == "a" else f"t{r['doc_id']}").encode())
    assert sorted(map(len, slots.values())) == [300] * 6 and all(sorted(s) == list(range(300)) for s in slots.values())
    for s, count in n.items():
        for shard in range(6):
            assert abs(by[shard, s] - count / 6) <= 1 + len(n) * count / len(rows)
    base = spark.createDataFrame([("r", "a", "same")] * 900 + [(str(i), "b", f"h{i}") for i in range(10)], "_row string, _src string, _h string")
    apart = sharding._apart(base, 17)
    assert apart.select("_h").distinct().count() == apart.count() == 910


# --- op8 ------------------------------------------------------------------------------------------------------

def plain_spans(text):
    out = []
    for kind, p in pii.PATTERNS.items():
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": lambda: True, "ip": lambda m=m: all(int(x) <= 255 for x in m.group().split(".")),
                    "card": lambda d=digits: 13 <= len(d) <= 19 and pii.luhn(d), "phone": lambda d=digits: 9 <= len(d) <= 15}[kind]
            if good():
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(8)
    pieces = ["a", "b@", "@", ".", "c.d", "-", "+", "1", "25", "255", "256", "0000000001", " ", "(", ")", "4111 1111 1111 1111", "+49 30 1234567",
              "x@y.z", "%", "_", "\xe9", "1.2.3.4", "\n"]
    for _ in range(30_000):
        text = "".join(rng.choices(pieces, k=rng.randint(0, 12)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_long_texts_take_linear_time(spark):
    t = time.time()
    for text in ("a" * 1_000_000, "1" * 1_000_000, "a." * 400_000, "@" * 500_000, "+1" * 300_000, "1." * 400_000, "a@b" * 300_000, "(1 " * 300_000):
        pii.base_spans(text)
    assert time.time() - t < 30
    rows = [(1, "9" * 10_000 + ".1.1.1 x"), (2, "a" * 1_000_000), (3, "1" * 1_000_000), (4, "word " * 200_000 + "10.0.0.1")]
    out = {r["doc_id"]: r for r in pii.digest(pii.find(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert [out[i]["n_ip"] for i in (1, 2, 3, 4)] == [0, 0, 0, 1]


# --- op9 ------------------------------------------------------------------------------------------------------

def _near(spark, rows, **more):
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), **more).collect()
    by = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by[r["query_id"]].append((r["vec_id"], r["score"]))
    return dict(by)


def test_repeated_query_rows_and_ids(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(200)]
    once = _near(spark, rows, k=5)
    assert _near(spark, rows + [rows[20], rows[40], rows[40]], k=5)[20][:5] == once[20]
    many = _near(spark, rows + [rows[20]] * 3, k=5)
    assert all(len(v) == 5 for v in many.values()) and all(i != 20 for i, _ in many[20])
    # a copy of a candidate is a candidate of its own
    best = once[20][0][0]
    assert [i for i, _ in _near(spark, rows + [rows[best]], k=5)[20][:2]] == [best, best]
    # two vectors of one id: a candidate counts with its better score
    other = rng.normal(size=6)
    both = _near(spark, rows + [(20, other.tolist())], k=300, target=1.0)[20]
    want = sorted(((max(float(np.dot(v, x)) for v in (rows[20][1], other)), i) for i, x in rows if i != 20), key=lambda t: (-t[0], t[1]))
    assert [i for i, _ in both] == [i for _, i in want]


def test_scores_that_overflow_take_part(spark):
    rows = [(i, [float(i), 1.0]) for i in range(30)] + [(100, [1e200, 1e200]), (101, [1e200, -1e200]), (120, [1e200, 1e200])]
    near = _near(spark, rows, k=40)
    assert near[100][0] == (120, float("inf")) and {i for i, _ in near[100]} == {i for i, _ in rows} - {100}
    assert near[20][:2] == [(i, 20 * 1e200 + 1e200) for i in (100, 120)]


def test_equal_vectors_tie_to_the_smaller_id(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 16)
    x = np.random.default_rng(3).normal(size=17)
    rows = [(i, x.tolist()) for i in range(300)]
    for q, near in _near(spark, rows, k=20).items():
        assert [i for i, _ in near] == [i for i in range(21) if i != q][:20] and len({s for _, s in near}) == 1


# --- pipeline ---------------------------------------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def corpus(spark, tmp_path):
    """A folder of the pipeline's tables, from (doc_id, text, lang, source, n_chars, extra columns of clashing names) rows."""
    def write(rows, labels, items):
        spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS + ", copies string, Score int").write.parquet(f"{tmp_path}/documents.parquet")
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
        spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
        return str(tmp_path)
    return write


def test_pipeline_equals_its_stages_by_brute_force(spark, corpus):
    from tokenizers import Tokenizer
    rng = random.Random(12)
    vocabulary = [f"word{i}" for i in range(300)]
    item = " ".join(rng.choices(vocabulary, k=20))
    rows, labels = [], []
    for i in range(160):
        words = rng.choices(vocabulary, k=rng.randint(20, 60))
        if i % 4 == 0:
            words += ["idiotic", "vile"] * 4
        if i % 9 == 1:
            words[5:5] = item.split()
        rows.append((i, " ".join(words), "en", f"s{i % 3}" if i % 10 else None, None))
        labels.append((i, i % 2, int(i % 4 == 0)))
    rows += [(200 + k, rows[k][1], "en", "s0", 1) for k in (1, 2, 2, 3)] + [(300, None, None, None, None), (301, "", "en", "s1", 0),
             (None, "lone words here", None, "s2", 3), (302, "y" * 200_000, "en", "s1", 1)] + [rows[5]] * 2
    folder = corpus(rows, labels, [(1, item), (2, None)])
    got = sorted((r["start"], r["doc_id"] is not None, r["doc_id"] or 0, r["n_tokens"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, folder).collect())

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    weights, bias = toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))     # its own test recomputes it
    clean = [r for r in rows if 1 / (1 + np.exp(-(float(weights[toxicity.features(r[1])].sum(dtype=np.float64)) + bias))) < 0.5]
    toxic = {r[0] for r in rows} - {r[0] for r in clean}
    assert toxic >= {i for i in range(0, 160, 4)} and len(toxic) < 60
    prints = [plain_fingerprint(r[1]) for r in clean]
    group = list(range(len(clean)))
    for _ in range(3):
        for a in range(len(clean)):
            for b in range(a):
                if (prints[a] ^ prints[b]).bit_count() <= 4:
                    group[a] = group[b] = min(group[a], group[b])
    kept = [min((clean[k] for k in range(len(clean)) if group[k] == g), key=lambda r: (r[0] is None, r[0] or 0)) for g in sorted(set(group))]
    kept = [r for r in kept if not plain_items(r[1], [(1, item)])]
    frame = spark.createDataFrame([(*r, "x", 1) for r in kept], DOCS + ", copies string, Score int")
    plan = mixing.mix_plan(frame, quality=mixing.quality_weights(spark.read.parquet(f"{folder}/labels.parquet")))      # equal to SQL, see op1
    tokenizer = Tokenizer.from_file(registry.tokenizer_path())
    taken = []
    for r in plan.collect():
        text = next(t for i, t, *_ in kept if i == r["doc_id"])
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [registry.END_ID]
        taken += [(r["doc_id"] is not None, r["doc_id"] or 0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] * r["copies"]
    want, at = [], 0
    for t in sorted(taken):
        want.append((at, *t))
        at += t[2]
    assert got == want and len(want) > 50


def test_pipeline_of_empty_tables(spark, corpus):
    assert corpus_pipeline.run(spark, corpus([], [], [])).collect() == []


def test_pipeline_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_all_queries_take_empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "benchmark", "embeddings", "conversations"):
        spark.read.parquet(f"{SF}/{name}.parquet").where(F.lit(False)).write.parquet(f"{tmp_path}/{name}.parquet")
    for name, query in registry.queries().items():
        assert query(spark, str(tmp_path)).count() == 0, name


def test_token_segments_of_one_very_long_document(spark, tmp_path):
    docs = spark.createDataFrame([(1, "word " * 300_000), (0, "z" * 500_000)], "doc_id long, text string")
    manifest = token_output.write_tokens(docs, str(tmp_path / "t"), registry.tokenizer_path(), registry.END_ID)
    out = {r["doc_id"]: (r["start"], r["n_tokens"]) for r in token_output.read_tokens(spark, manifest, str(tmp_path / "t")).collect()}
    assert out[0][0] == 0 and out[1][0] == out[0][1] and out[1][1] == 300_002
