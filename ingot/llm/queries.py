"""Registered queries of the corpus operators: each applies one operator to
its whole table with production parameters. ``ORACLES`` has DuckDB SQL where
SQL can express the result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingot.llm import decontaminate, embeddings, four_russians, harmonic, html_extract, language, minhash, packing, repeats, shared_search, token_files, token_rollups, toxicity
from ingot.llm.common import corpus_table, written
from ingot.llm.tokens import BYTE_LEVEL, WORD_LEVEL
from ingot.session import new_workspace

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"


def op1_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = corpus_table(spark, sf_dir, "documents")
    labels = corpus_table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("grade"))
    sample = toxicity.grade_by_marks(toxicity.labelled_sample(docs, labels))
    model = toxicity.fit(*map(list, zip(*sample, strict=True))) if sample else None
    return toxicity.severity(docs.select("doc_id", "text"), model).drop("text")


def op2_mincut_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = corpus_table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.train(pages))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = corpus_table(spark, sf_dir, "documents")
    pieces = packing.token_pieces(docs, public_tokenizers.path(WORD_BPE), WORD_LEVEL)
    return packing.pack(pieces)


def op4_pstable_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(corpus_table(spark, sf_dir, "embeddings"), least=0.95)


OP4_SQL = r"""
WITH RECURSIVE
u AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
      WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
      WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
r(id, root) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id),
c AS (SELECT id, min(root) AS component_id FROM r GROUP BY id),
n AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON c.id = vec_id LEFT JOIN n ON n.a = vec_id
"""


def op5_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(corpus_table(spark, sf_dir, "documents"), k=2, percent=80)


OP5_SQL = r"""
WITH RECURSIVE
w AS (SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^ \t\n\x0B\f\r]+') AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) < 2 THEN ws
        ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS sh FROM w),
u AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.x = b.x AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r(id, root) AS (SELECT doc_id, doc_id FROM s UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM s JOIN (SELECT id, min(root) AS component_id FROM r GROUP BY id) c ON c.id = s.doc_id
"""


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = corpus_table(spark, sf_dir, "documents")
    return token_files.token_files(spark, docs, public_tokenizers.path(BYTE_BPE), BYTE_LEVEL)


COUNTERS = {"words-1": token_rollups.word_count, "byte-quads-1": token_rollups.byte_quads}


def op7_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four batches over all documents: provisional inserts (words-1 counted
    as byte quads), the revised words-1 counts, deletes of the documents
    without a word, and a replay of the revision that must change nothing."""
    docs = corpus_table(spark, sf_dir, "documents")
    true = {v: f(F.col("text")) for v, f in COUNTERS.items()}
    provisional = true | {"words-1": token_rollups.byte_quads(F.col("text"))}
    table = token_rollups.Rollup(spark, new_workspace(spark, "rollup") + "/totals")
    revision = token_rollups.signed(token_rollups.count_changes(
        docs, token_rollups.REVISE, {"words-1": true["words-1"]}, {"words-1": provisional["words-1"]}))
    table.commit("0001", token_rollups.signed(token_rollups.count_changes(docs, token_rollups.INSERT, provisional)))
    table.commit("0002", revision)
    table.commit("0003", token_rollups.signed(token_rollups.count_changes(
        docs.filter(true["words-1"] == 0), token_rollups.DELETE, true)))
    table.commit("0002", revision)
    return table.totals()


TOKENIZERS = {"word_bpe_49k": (WORD_BPE, WORD_LEVEL), "byte_bpe_50k": (BYTE_BPE, BYTE_LEVEL)}


def op7_tokenizer_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of the public tokenizers, every document encoded by both.
    Four batches as above: word_bpe_49k first with the counts of byte_bpe_50k,
    the revision, deletes of the documents without a token, a replay."""
    files = {v: (public_tokenizers.path(name), kind) for v, (name, kind) in TOKENIZERS.items()}
    counts = written(token_rollups.token_counts(corpus_table(spark, sf_dir, "documents"), files), "token-counts")
    true = {v: F.col(v) for v in TOKENIZERS}
    provisional = true | {"word_bpe_49k": true["byte_bpe_50k"]}
    table = token_rollups.Rollup(spark, new_workspace(spark, "rollup") + "/totals")
    revision = token_rollups.signed(token_rollups.count_changes(
        counts, token_rollups.REVISE, {"word_bpe_49k": true["word_bpe_49k"]}, {"word_bpe_49k": provisional["word_bpe_49k"]}))
    table.commit("0001", token_rollups.signed(token_rollups.count_changes(counts, token_rollups.INSERT, provisional)))
    table.commit("0002", revision)
    table.commit("0003", token_rollups.signed(token_rollups.count_changes(
        counts.filter(true["word_bpe_49k"] == 0), token_rollups.DELETE, true)))
    table.commit("0002", revision)
    return table.totals()


OP7_SQL = r"""
WITH c AS (
  SELECT source, lang,
         coalesce(len(regexp_extract_all(text, '[^ \t\n\x0B\f\r]+')), 0) AS words,
         coalesce(CAST(ceil(strlen(text) / 4.0) AS BIGINT), 0) AS quads
  FROM documents),
t AS (
  SELECT source, lang, 'words-1' AS tokenizer, words AS n FROM c WHERE words > 0
  UNION ALL
  SELECT source, lang, 'byte-quads-1', quads FROM c WHERE words > 0)
SELECT source, lang, tokenizer, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens
FROM t GROUP BY ALL
"""

def op8_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = corpus_table(spark, sf_dir, "documents")
    model = language.train(docs.filter(~language.held_out()))
    return language.predict(docs.select("doc_id", language.held_out().alias("held_out"), "text"), model).drop("text")


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_digests(corpus_table(spark, sf_dir, "documents"))


OP9_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
s AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS w FROM d, unnest(range(0, n - 99)) AS t(i)),
again AS (SELECT doc_id, i FROM s QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, i) > 1),
heads AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS head
          FROM again),
runs AS (SELECT doc_id, min(i) AS lo, max(i) + 100 AS hi FROM
           (SELECT doc_id, i, sum(head) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM heads) GROUP BY doc_id, run),
gaps AS (SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS prior FROM runs),
kept AS (SELECT doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans, max(hi) AS tail,
                string_agg(substr(h, 2 * prior + 1, 2 * (lo - prior)), '' ORDER BY lo) AS k
         FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN k IS NULL THEN h ELSE k || substr(h, 2 * tail + 1) END)) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

def op10_lsa_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item found in it."""
    return decontaminate.find_leaks(corpus_table(spark, sf_dir, "documents"), corpus_table(spark, sf_dir, "benchmark"))


def op11_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harmonic.pack(corpus_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), BYTE_LEVEL)


def op12_shared_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_search.search(corpus_table(spark, sf_dir, "documents"), corpus_table(spark, sf_dir, "benchmark"), k=10)


_OP12_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_OP12_TERMS} AS ts FROM documents),
c AS (SELECT count(*) FILTER (len(ts) > 0) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM d),
q AS (SELECT i, item_id, unnest(list_distinct(ts)) AS t
      FROM (SELECT row_number() OVER () AS i, item_id, {_OP12_TERMS} AS ts FROM benchmark)),
f AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY r, t),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM f, c GROUP BY t, n_docs),
m AS (SELECT r, doc_id, 100 - 90 + (90 * len(ts) * n_docs) // n_terms AS m FROM d, c WHERE len(ts) > 0),
s AS (SELECT i, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM q JOIN f USING (t) JOIN w USING (t) JOIN m USING (r) GROUP BY i, item_id, r, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id, r) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10
"""


def op13_four_russians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of every seventh vec_id are moved on, as labelling errors."""
    vectors = corpus_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return four_russians.hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 50 == 0)


OP13_SQL = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
      FROM e a JOIN e c ON a.vec_id % 50 = 0 AND len(a.v) = len(c.v)),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same AND vec_id <> anchor_id
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


QUERIES = {
    "op1_ordinal_toxicity": op1_ordinal_toxicity,
    "op2_mincut_html": op2_mincut_html,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_pstable_embeddings": op4_pstable_embeddings,
    "op5_bbit_minhash": op5_bbit_minhash,
    "op6_token_files": op6_token_files,
    "op7_token_rollups": op7_token_rollups,
    "op7_tokenizer_rollups": op7_tokenizer_rollups,
    "op8_crf_language": op8_crf_language,
    "op9_repeated_passages": op9_repeated_passages,
    "op10_lsa_decontamination": op10_lsa_decontamination,
    "op11_harmonic_packing": op11_harmonic_packing,
    "op12_shared_search": op12_shared_search,
    "op13_four_russians": op13_four_russians,
}

ORACLES = {
    "op4_pstable_embeddings": OP4_SQL,
    "op5_bbit_minhash": OP5_SQL,
    "op7_token_rollups": OP7_SQL,
    "op9_repeated_passages": OP9_SQL,
    "op12_shared_search": OP12_SQL,
    "op13_four_russians": OP13_SQL,
}
