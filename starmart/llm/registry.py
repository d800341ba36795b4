"""Queries and oracle SQL of the training-data operators, one ``opN_<name>`` each, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.session import materialise, scratch_path

from . import ann, decontaminate, lexicon, lines, merkle, mixing, pii, sharding, simhash, substrings, token_output, toxicity, trie
from .common import table

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2

SHARDS = 24


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to their targets (quality labels weigh the sampling keys)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    out = mixing.mix_plan(docs, quality=mixing.quality_weights(table(spark, sf_dir, "labels")))
    return out.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.components(docs, shingle=4, max_bits=4).select("doc_id", "fingerprint", "component_id")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


def op3_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token segments and read back."""
    folder = scratch_path(spark, "tokens")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    manifest = token_output.write_tokens(docs, folder, tokenizer_path(), END_ID)
    return token_output.read_tokens(spark, manifest, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words that repeated 35-word windows cover."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.dedup_substrings(docs, 35).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id", "contaminated", "items")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt to 24 shards, equal in rows."""
    rows = sharding.digest(table(spark, sf_dir, "documents"))
    return sharding.interleave(rows, SHARDS).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data found in every document."""
    return pii.digest(pii.find(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows found of every vector whose id is divisible by 20."""
    return ann.search(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that later occurrences of three-line windows cover."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each rebuilt on the first turns of the first conversation of its hundred."""
    own = materialise(trie.number_turns(table(spark, sf_dir, "conversations")), "turns")
    mine = own.where(F.col("idx") == 0).select("conv_id", "n", (F.crc32(F.col("conv_id").cast("string")) % 6).alias("h"),
                                               (F.col("conv_id") - F.col("conv_id") % 100).alias("base"))
    base = mine.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    mine = materialise(mine.join(base, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0)))), "rebuilt")
    lent = own.where(F.col("idx") < 5).select(F.col("conv_id").alias("base"), "idx", "digest", "chars")
    lent = mine.join(lent, "base").where(F.col("idx") < F.col("h")).select("conv_id", (F.col("idx") + 1).alias("d"), "digest", "chars")
    kept = own.join(mine.select("conv_id", "h", "taken"), "conv_id").where(F.col("idx") >= F.col("h")).select(
        "conv_id", (F.col("taken") + F.col("idx") - F.col("h") + 1).alias("d"), "digest", "chars")
    members = mine.select("conv_id", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total"))
    return trie.prefix_trie(members, lent.unionByName(kept))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents, those of a seventh of the ids checked with one added to their ``n_chars``."""
    docs = table(spark, sf_dir, "documents")
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")      # beyond the largest long too
    said = {"n_chars": F.when(hit, more).otherwise(F.col("n_chars").cast("string"))}
    return merkle.manifest(docs, claim=said).check().withColumnRenamed("key", "doc_id").select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded through the lexicon of their frequent words, and decoded again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = lexicon.encode(docs, tokenizer_path(), decoded="decoded")
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def _crc32(number: str) -> str:
    """DuckDB SQL: the unsigned crc32 of a number's decimal text, bit by bit."""
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({number}::VARCHAR, ''), "
            "lambda ch: ascii(ch)::BIGINT)), lambda crc, b: list_reduce([xor(crc, b), 0::BIGINT, 0, 0, 0, 0, 0, 0, 0], "
            "lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))))")


def _leaf(n_chars: str) -> str:
    """DuckDB SQL: the digest of a row of documents."""
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')"
                                   for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


ORACLE = {
    "op1_mixing": """
WITH d AS (
  SELECT doc_id, source, md5(concat_ws('|', '17', coalesce('=' || doc_id::VARCHAR, '~'), coalesce('=' || text, '~'))) AS h,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         CASE WHEN q > 0 THEN 2.0 WHEN q IS NOT NULL THEN 0.5 ELSE 1.0 END::DOUBLE AS w
  FROM documents LEFT JOIN (SELECT doc_id AS lid, max(quality) AS q FROM labels GROUP BY 1) ON lid = doc_id),
k AS (SELECT *, -ln((('0x' || substr(h, 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0) / w AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY 1),
r AS (SELECT *, (1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::DOUBLE AS sw,
             3.0::DOUBLE * source_size AS cap FROM s),
v AS (SELECT *, (sum(source_size) OVER ()::DOUBLE
                 - coalesce(sum(cap) OVER (ORDER BY cap / sw, source NULLS LAST
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
                / sum(sw) OVER (ORDER BY cap / sw, source NULLS LAST
                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
t AS (SELECT *, least(cap, coalesce((SELECT min_by(level, cap / sw) FROM v WHERE level * sw <= cap) * sw, cap)) AS target
      FROM v),
e AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END::INTEGER AS epochs FROM t),
p AS (SELECT k.*, source_size, target, epochs,
             CASE WHEN epochs < 3 THEN target - epochs * source_size ELSE 0 END AS rest,
             sum(size) OVER (PARTITION BY k.source ORDER BY key, k.doc_id, h) - size AS before
      FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       (size * (epochs + (rest > 0 AND before + size / 2.0 <= rest)::INTEGER))::BIGINT AS taken,
       (epochs + (rest > 0 AND before + size / 2.0 <= rest)::INTEGER)::INTEGER AS copies
FROM p""",
    "op4_substrings": """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS l FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(l) - 33)) AS i, l FROM d WHERE len(l) >= 35),
k AS (SELECT doc_id, i, md5(array_to_string(l[i:i + 34], ' ')) AS win FROM w),
f AS (SELECT doc_id, i, count(*) OVER (PARTITION BY win) AS n FROM k),
c AS (SELECT DISTINCT doc_id, i + j AS i FROM (SELECT doc_id, i, unnest(range(0, 35)) AS j FROM f WHERE n > 1)),
n AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS word FROM d),
t AS (SELECT n.doc_id, count(*) AS n_words, count(c.i) AS n_removed,
             coalesce(string_agg(word, ' ' ORDER BY n.i) FILTER (WHERE c.i IS NULL), '') AS kept
      FROM n LEFT JOIN c ON n.doc_id = c.doc_id AND n.i = c.i GROUP BY n.doc_id)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN t ON t.doc_id = d.doc_id""",
    "op10_lines": """
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(l) - 1)) AS i, l FROM d WHERE len(l) >= 3),
k AS (SELECT doc_id, i, l[i] || chr(10) || l[i + 1] || chr(10) || l[i + 2] AS win FROM w),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS occurrence FROM k),
c AS (SELECT DISTINCT doc_id, i + o.j AS i FROM f, (VALUES (0), (1), (2)) AS o(j) WHERE occurrence > 1),
n AS (SELECT d.doc_id, u.i, d.l[u.i] AS line FROM d, LATERAL (SELECT unnest(range(1, len(d.l) + 1)) AS i) AS u),
t AS (SELECT n.doc_id, count(c.i) AS n_removed,
             coalesce(string_agg(line, chr(10) ORDER BY n.i) FILTER (WHERE c.i IS NULL), '') AS text
      FROM n LEFT JOIN c ON n.doc_id = c.doc_id AND n.i = c.i GROUP BY n.doc_id)
SELECT d.doc_id, coalesce(len(l), 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE t.text END AS text
FROM d LEFT JOIN t ON t.doc_id = d.doc_id""",
    "op11_prefix_trie": f"""
WITH o AS (SELECT conv_id, md5(octet_length(encode(coalesce(role, '')))::VARCHAR || '|' || coalesce(role, '') || coalesce(text, '')) AS k,
                  length(coalesce(text, '')) AS chars, turn FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT conv_id, list(k ORDER BY turn NULLS FIRST, k) AS ks, list(chars ORDER BY turn NULLS FIRST, k) AS cs FROM o GROUP BY 1),
h AS (SELECT *, {_crc32('conv_id')} % 6 AS h FROM s),
r AS (SELECT h.conv_id, coalesce(b.ks, [])[1:h.h::BIGINT] || h.ks[(h.h + 1)::BIGINT:] AS ks,
             coalesce(b.cs, [])[1:h.h::BIGINT] || h.cs[(h.h + 1)::BIGINT:] AS cs
      FROM h LEFT JOIN s AS b ON b.conv_id = h.conv_id - h.conv_id % 100),
p AS (SELECT conv_id, len(ks) AS total, u.d, array_to_string(ks[1:u.d], ',') AS node,
             CASE WHEN u.d > 0 THEN array_to_string(ks[1:u.d - 1], ',') END AS up, CASE WHEN u.d > 0 THEN cs[u.d] ELSE 0 END AS chars
      FROM r, LATERAL (SELECT unnest(range(0, len(ks) + 1)) AS d) AS u),
n AS (SELECT d, node, min(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(chars) AS own,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE total = d), '')) AS ends_sha256
      FROM p GROUP BY 1, 2),
c AS (SELECT d - 1 AS d, up AS node, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c USING (d, node)),
a AS (SELECT u.d, array_to_string(string_split(node, ',')[1:u.d], ',') AS node, sum((n_children = 0)::INT) AS n_leaves, sum(own) AS saved_tokens
      FROM f, LATERAL (SELECT unnest(range(0, f.d + 1)) AS d) AS u GROUP BY 1, 2)
SELECT f.conv_id, f.d::BIGINT AS depth, q.conv_id AS parent_conv_id, f.n_convs::BIGINT AS n_convs, f.n_children::BIGINT AS n_children,
       a.n_leaves::BIGINT AS n_leaves, a.saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
FROM f JOIN a USING (d, node) LEFT JOIN n AS q ON q.d = f.d - 1 AND q.node = f.up""",
    "op12_merkle": f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf('n_chars')} AS leaf,
         CASE WHEN {_crc32('doc_id')} % 7 = 0 THEN {_leaf('(n_chars::HUGEINT + 1)')} ELSE {_leaf('n_chars')} END AS claim
  FROM documents),
m AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d),
t AS (SELECT tree, 0 AS k, list(leaf ORDER BY i) AS l FROM m GROUP BY tree
      UNION ALL
      SELECT tree, k + 1, list_transform(range(0, (len(l) + 1) // 2), lambda j: sha256(l[2 * j + 1] || coalesce(l[2 * j + 2], ''))) FROM t WHERE len(l) > 1),
r AS (SELECT tree, l[1] AS subroot, row_number() OVER (ORDER BY tree) - 1 AS i FROM t WHERE len(l) = 1),
u AS (SELECT 0 AS k, list(subroot ORDER BY i) AS l FROM r HAVING count(*) > 0
      UNION ALL
      SELECT k + 1, list_transform(range(0, (len(l) + 1) // 2), lambda j: sha256(l[2 * j + 1] || coalesce(l[2 * j + 2], ''))) FROM u WHERE len(l) > 1),
low AS (SELECT m.tree, m.i, list(coalesce((['R', 'L'])[(m.i >> t.k) % 2 + 1] || t.l[xor(m.i >> t.k, 1) + 1], '-') ORDER BY t.k) AS steps
        FROM m JOIN t ON t.tree = m.tree AND len(t.l) > 1 GROUP BY 1, 2),
top AS (SELECT r.tree, list(coalesce((['R', 'L'])[(r.i >> u.k) % 2 + 1] || u.l[xor(r.i >> u.k, 1) + 1], '-') ORDER BY u.k) AS steps
        FROM r JOIN u ON len(u.l) > 1 GROUP BY 1),
w AS (SELECT m.doc_id, m.leaf, m.claim, r.subroot, (SELECT l[1] FROM u WHERE len(l) = 1) AS root,
             coalesce(low.steps, []) || coalesce(top.steps, []) AS steps
      FROM m JOIN r USING (tree) LEFT JOIN low ON low.tree = m.tree AND low.i = m.i LEFT JOIN top ON top.tree = m.tree),
z AS (SELECT *, sha256(array_to_string(list_transform(steps, lambda s: CASE WHEN s = '-' THEN '' ELSE s[2:] END), '')) AS proof_sha256,
             list_reduce(list_prepend(claim, steps), lambda x, s: sha256(CASE WHEN s = '-' THEN x WHEN s[1] = 'R' THEN x || s[2:] ELSE s[2:] || x END)) AS folded_root
      FROM w)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM z""",
}


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline.py over all documents."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = [op1_mixing, op2_simhash, op3_tokens, op4_substrings, op5_toxicity, op6_decontaminate, op7_sharding, op8_pii, op9_ann,
           op10_lines, op11_prefix_trie, op12_merkle, op13_bpe, pipeline]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
