"""The registered queries of the subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, collocations, common, decontaminate, html_text, kneser_ney, license_scan, multiset_hash, piece_lattice, quality, simhash, token_files, vector_cells, whitening
from .common import table
from .registry import ORACLES, QUERIES, query  # noqa: F401


@query("op1_document_fingerprints")
def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, with their likeness."""
    return multiset_hash.edits(table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")


@query("op2_quality_classifier")
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores, soft labels and verdict of every document."""
    docs = table(spark, sf_dir, "documents")
    return quality.scores(docs, quality.fit(docs, table(spark, sf_dir, "labels"))).withColumnRenamed("key", "doc_id")


@query("op3_lm_scoring")
def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kneser-Ney (word triples) and add-one scores of every document; fold 2 of 7 is held out."""
    return kneser_ney.score_corpus(table(spark, sf_dir, "documents"), folds=7, fold=2, order=3).withColumnRenamed("key", "doc_id")


@query("op4_benchmark_decontamination")
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and contamination of every document: windows of 13 words, 5 per cent."""
    found = decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), words=13)
    return found.drop("spans").withColumnRenamed("key", "doc_id")


@query("op5_sampled_pieces")
def op5_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model's own encoding and two sampled segmentations of every document with their ids, decoded again."""
    found = piece_lattice.segment(table(spark, sf_dir, "documents"), "piece_bpe_32k.model", k=2, ids=True)
    return found.withColumnRenamed("key", "doc_id")


@query("op6_token_files")
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents with end id 1, read back."""
    found = token_files.round_trip(table(spark, sf_dir, "documents"), "word_bpe_49k.json", end=1)
    return found.withColumnRenamed("key", "doc_id")


@query("op7_html_extraction")
def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


@query("op8_simhash_near_dedup")
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 4-word shingles, seed 42, links at 4 bits or fewer."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, seed=42, radius=4)
    return found.withColumnRenamed("key", "doc_id")


OP9_SQL = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', chr(92) || '### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', chr(92) || '### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(14 + length(replace(replace(replace(replace(role, chr(92), chr(92) || chr(92)), '##', '#' || chr(92) || '#'), '</', '<' || chr(92) || '/'), chr(10), chr(92) || 'n'))
    + length(replace(replace(replace(text, chr(92), chr(92) || chr(92)), '##', '#' || chr(92) || '#'), '</', '<' || chr(92) || '/'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


@query("op9_chat_formatting", OP9_SQL)
def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and a probe that holds control strings, formatted, stored and read back."""
    probe = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_format.digests(common.stored(chat_format.render(rows), "chat"))


@query("op10_license_scan")
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License of every document, as a file at source/lang/doc_id."""
    docs = table(spark, sf_dir, "documents").withColumn("path", F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")))
    return license_scan.scan(docs, counted=True).withColumnRenamed("key", "doc_id")


OP13_SQL = """
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), pieces AS (
  SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?' || chr(10) || '-' || chr(13) || ']')) AS piece FROM texts
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^ ' || chr(9) || ']+') AS w FROM pieces
), spots AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), grams AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS a
  FROM spots, (VALUES (1), (2), (3)) AS lengths(k) WHERE i + k - 1 <= len(w) GROUP BY 1, 2, 3
), totals AS (
  SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM grams WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM grams WHERE k > 1 AND a >= 10
), longer AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM candidates WHERE k = 3
    UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM candidates WHERE k = 3) GROUP BY 1, 2
), cuts AS (
  SELECT c.lang, c.phrase, c.a, cut.cut AS cut, l.a AS l, r.a AS r,
    (c.a::HUGEINT * c.a * 1000000) // (l.a::HUGEINT * r.a) AS score
  FROM candidates c LEFT JOIN longer USING (lang, phrase) JOIN (VALUES (1), (2)) AS cut(cut) ON cut.cut < c.k
  JOIN grams l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : cut.cut], ' ')
  JOIN grams r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[cut.cut + 1 :], ' ')
  WHERE longer IS NULL OR 100 * longer < 50 * c.a
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@query("op13_phrase_collocations", OP13_SQL)
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of 2 to 3 words of each language."""
    return collocations.phrases(table(spark, sf_dir, "documents"), longest=3, least=10, share=50, top=2000)


@query("op12_vector_near_dedup")
def op12_vector_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every embedding at a cosine of 0.95 or more."""
    return vector_cells.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.95).withColumnRenamed("key", "vec_id")


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 32 whitened components of every embedding."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=32).withColumnRenamed("key", "vec_id")
