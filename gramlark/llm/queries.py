"""Queries of the training-data operators, and their reference SQL where there is any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gramlark.llm import (
    hard_negatives,
    html_text,
    licences,
    mixing,
    neighbours,
    packing,
    pieces,
    pii,
    quality,
    simhash,
    spelling,
    toxicity,
    vector_dedup,
)
from gramlark.llm.common import table


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.select("doc_id", toxicity.predict(docs, chain).alias("out")).select("doc_id", "out.*")


def _listed(spans: str):
    """kind:start:end of every span, comma-joined."""
    each = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, each), ",")


def op2_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    digest = F.sha2(_listed("base"), 256).alias("base_sha256")
    return found.select("doc_id", *[count(k) for k in pii.KINDS], digest, _listed("spans").alias("spans"))


def op3_licence_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op4_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_product_quantised_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_html_recurrent(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    text = html_text.main_text(pages, html_text.train(pages)).alias("out")
    return pages.select("page_id", "url", text).select("page_id", "url", "out.text", "out.n_chars")


def op7_sentencepiece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = pieces.digests(docs, tokenizer_path("piece_bpe_32k.model")).alias("out")
    return docs.select("doc_id", out).select("doc_id", "out.*")


def op8_simhash_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, distance=2)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return groups.select(F.col("key").alias("doc_id"), hexed, "component_id")


def op9_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(packing.tokenised_pieces(docs, tokenizer_path("word_bpe_49k.json")))


def op10_quality_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    forest = quality.fit(docs, table(spark, sf_dir, "labels"), where=~held_out)
    scored = docs.select("doc_id", held_out.alias("held_out"), quality.predict(docs, forest)["score"].alias("score"))
    return scored.select("*", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op11_one_bit_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


def op12_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return mixing.score_texts(docs, held_out).select("doc_id", "lm.*")


def op13_letter_count_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_spellings(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity_chain,
        op2_pii_bootstrap,
        op3_licence_paragraphs,
        op4_learned_partitions,
        op5_product_quantised_dedup,
        op6_html_recurrent,
        op7_sentencepiece_viterbi,
        op8_simhash_pigeonhole,
        op9_best_two_fit,
        op10_quality_boosting,
        op11_one_bit_hard_negatives,
        op12_context_mixing,
        op13_letter_count_trie,
    )
}

OP11_SQL = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM usable a JOIN usable b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 3
"""

# the table of CRC32 comes from its polynomial, eight halvings a byte
OP13_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(
    list_prepend(i::UBIGINT, list_transform(range(8), lambda k: 0::UBIGINT)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)) AS t
), runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), counted AS (
  SELECT run, hex(encode(doc_id || ':' || run)) AS x, count(*) AS n FROM runs GROUP BY ALL
), hashed AS (
  SELECT run, n, xor(4294967295::UBIGINT, list_reduce(
    list_prepend(4294967295::UBIGINT, list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::UBIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::BIGINT + 1]))) AS h
  FROM counted, crc
), words AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word,
         sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3
), cuts AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut
  FROM (SELECT word, unnest(range(1, length(word) + 1))::INT AS i FROM words)
), near AS (
  SELECT c.word AS a, w.word AS b FROM cuts c JOIN words w ON w.word = c.cut
  UNION SELECT w.word, c.word FROM cuts c JOIN words w ON w.word = c.cut
  UNION SELECT x.word, y.word FROM cuts x JOIN cuts y ON x.i = y.i AND x.cut = y.cut AND x.word <> y.word
), best AS (
  SELECT a, b, n AS b_n, count(*) OVER (PARTITION BY a) AS many
  FROM near JOIN words ON word = b
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY n DESC, b) = 1
), forms AS (
  SELECT word, n, coalesce(many, 0)::BIGINT AS n_near,
         CASE WHEN b_n >= 2 * n THEN b END AS form, CASE WHEN b_n >= 2 * n THEN b_n END AS form_n
  FROM words LEFT JOIN best ON word = a
), chain AS (
  SELECT word, word AS at FROM forms
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NOT NULL
), roots AS (
  SELECT c.word, c.at AS root FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""

ORACLE_SQL: dict[str, str] = {
    "op11_one_bit_hard_negatives": OP11_SQL,
    "op13_letter_count_trie": OP13_SQL,
}
