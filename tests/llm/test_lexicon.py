"""BPE lexicon: transducer against a dictionary, encoding and decoding against the library."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from starmart.llm import lexicon, registry
from tests.conftest import SF


@pytest.fixture(scope="module")
def codec():
    return lexicon.Codec(registry.tokenizer_path())


def _ids(x):
    return np.frombuffer(x, "<u4").tolist()


def test_transducer_equals_dictionary_and_is_minimal():
    rng = random.Random(3)
    words = {bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 7))): tuple(rng.choices(range(3), k=rng.randint(0, 3)))
             for _ in range(200)}
    fst = lexicon.Transducer.from_buffer(lexicon.Transducer.build(sorted(words.items())).to_bytes())
    asked = [*words, *(bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 9))) for _ in range(300))]
    ok, ids, at = fst.lookup(asked)
    for k, w in enumerate(asked):
        assert ok[k] == (w in words)
        assert tuple(ids[at[k]:at[k + 1]].tolist()) == words.get(w, ())
    ends = {w + s: (7,) for w in (b"a", b"b", b"c", b"d") for s in (b"ing", b"ed", b"s")}
    fst = lexicon.Transducer.build(sorted(ends.items()))
    assert len(fst.final_n) == 1 + 1 + 2 + 1 + 1     # start, one state for all stems, two inside -ing, one inside -ed, the end


def test_transducer_of_nothing():
    fst = lexicon.Transducer.from_buffer(lexicon.Transducer.build([]).to_bytes())
    ok, ids, at = fst.lookup([b"a", b""])
    assert not ok.any() and not len(ids) and at.tolist() == [0, 0, 0]


ODD = ["", " ", "  a", "a  ", "a \n b", "a\n b  c", "a <|endoftext|> b", "a  <|endoftext|>  b<|endoftext|>", "<|endoftext|>",
       "x's 's it''s  'll", "  a  b  c", "\0 \0a  \0", "\U0001f600 \U0001f600  \U0001f600", "\xa0 　a", "a" * 50_000, "1 " * 3000,
       "\t\n\x0b\x0c\r \x1c \x1d a\x85 b \x85c", "<|endoftext|", "é ​ a"]


@pytest.mark.parametrize("seen", [False, True])
def test_codec_equals_library(codec, seen):
    rng = random.Random(5)
    pool = [" ", " ", "\n", "a", "b'", "'s", "1", "\xe9", "\xa0", "\x1c", "\x85", "​", "　", "<|endoftext|>", "\U0001f600", ".", ",", "ab"]
    texts = ODD + ["".join(rng.choices(pool, k=rng.randint(0, 14))) for _ in range(5000)]
    words = sorted({b" " + p.encode() for t in texts for p in t.split(" ") if p and not p[0].isspace() and "<|" not in p}) if seen else []
    fst = lexicon.Transducer.build([(w, tuple(x.tolist())) for w, x in zip(words, codec.merge([w.decode() for w in words]), strict=True)])
    library, decoder = Tokenizer.from_file(registry.tokenizer_path()), lexicon.Decoder(registry.tokenizer_path())
    for got, want in zip(codec.encode(texts, fst), library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert _ids(got) == want.ids
        assert decoder.decode(got) == library.decode(want.ids, skip_special_tokens=False)
    broken = np.array([222, 100, 50256, 171], "<u4")     # ids whose bytes are no UTF-8
    assert decoder.decode(broken.tobytes()) == library.decode(broken.tolist(), skip_special_tokens=False)


def test_every_character_beside_a_space(codec):
    chars = [chr(c) for c in [*range(0x3100), *range(0xA000, 0xD800), *range(0xE000, 0x11000), *range(0x1F000, 0x1FB00)]]
    texts = [f"x {c} y {c}{c}" for c in chars]
    library = codec.merge(texts)
    assert all(got == want.tobytes() for got, want in zip(codec.encode(texts, None), library, strict=True))


def test_other_tokenizers_get_whole_texts(tmp_path):
    import public_tokenizers
    codec = lexicon.Codec(public_tokenizers.path("word_bpe_49k.json"))
    assert not codec.by_part
    assert [_ids(x) for x in codec.encode(["Hello  World", ""], None)] == [x.tolist() for x in codec.merge(["Hello  World", ""])]


def test_query_equals_library_on_all_documents(spark):
    import hashlib
    from pyspark.sql import functions as F
    library = Tokenizer.from_file(registry.tokenizer_path())
    rows = {r.doc_id: r for r in registry.op13_bpe(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = library.encode(d.text, add_special_tokens=False).ids
        r = rows[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_nulls_repeats_empty_and_clashing_columns(spark):
    rows = [(1, None, "x", 1), (1, "b b b", "y", 2), (1, "b b b", "y", 2), (None, "", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, IDS string, word long")
    out = lexicon.decode(lexicon.encode(docs, registry.tokenizer_path()), registry.tokenizer_path())
    assert out.columns == ["doc_id", "text", "word", "ids", "n_tokens", "decoded"]
    assert sorted((r.doc_id or 0, r.decoded, r.n_tokens) for r in out.collect()) == [(0, "", 0), (1, "", 0), (1, "b b b", 3), (1, "b b b", 3)]
    assert lexicon.encode(docs.limit(0), registry.tokenizer_path()).count() == 0


def test_lexicon_holds_the_most_frequent_words(spark):
    docs = spark.createDataFrame([("x a a a b b c",), ("y a b" + " z" * 9 + " " + "w" * 40 + " " + "w" * 40,)], "text string")
    assert [tuple(r) for r in lexicon.frequent_words(docs, 2).collect()] == [("z", 9), ("a", 4)]
