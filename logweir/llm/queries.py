"""The registered queries of this subpackage: each operator over its whole table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.llm import hard_negatives, mixing, prefix_trie, warc
from logweir.llm.ann import nearest
from logweir.llm.fingerprints import edited_fingerprints
from logweir.llm.langid import identified
from logweir.llm.packing import packed, tokenized
from logweir.llm.personal_data import personal_data, span_digest
from logweir.llm.quality import quality_scores
from logweir.llm.secret_scan import findings
from logweir.llm.simhash import simhash_components
from logweir.llm.substrings import remove_repeats


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(_table(spark, sf_dir, "documents"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(_table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(spark, _table(spark, sf_dir, "pages"))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents")).drop("spans")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identified(_table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(tokenized(_table(spark, sf_dir, "documents")))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings(_table(spark, sf_dir, "documents"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digest(personal_data(_table(spark, sf_dir, "documents")))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(_table(spark, sf_dir, "conversations"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = hard_negatives.shifted(_table(spark, sf_dir, "embeddings"))
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 50 == 0)


QUERIES = {
    "op1_quality": op1_quality,
    "op2_neighbours": op2_neighbours,
    "op3_simhash": op3_simhash,
    "op4_fingerprints": op4_fingerprints,
    "op5_warc": op5_warc,
    "op6_substrings": op6_substrings,
    "op7_language": op7_language,
    "op8_packing": op8_packing,
    "op9_mixing": op9_mixing,
    "op10_secrets": op10_secrets,
    "op11_personal_data": op11_personal_data,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_hard_negatives": op13_hard_negatives,
}

_SUBSTRINGS_SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), windows AS (
  SELECT doc_id, place, array_to_string(words[place + 1 : place + 50], ' ') AS passage
  FROM (SELECT doc_id, words, unnest(range(0, len(words) - 49)) AS place FROM texts)
), first AS (
  SELECT passage, min(doc_id) AS first FROM windows GROUP BY passage
), gone AS (
  SELECT DISTINCT w.doc_id, unnest(range(w.place, w.place + 50)) AS word
  FROM windows w JOIN first f USING (passage)
  WHERE w.doc_id > f.first
), removed AS (
  SELECT doc_id, list(word) AS places FROM gone GROUP BY doc_id
), kept AS (
  SELECT t.doc_id, len(t.words) AS n_words, coalesce(len(r.places), 0) AS n_removed,
         CASE WHEN r.places IS NULL THEN t.words
              ELSE list_filter(t.words, lambda w, i: NOT list_contains(r.places, i - 1)) END AS words
  FROM texts t LEFT JOIN removed r USING (doc_id)
)
SELECT doc_id, n_words, n_removed, sha256(array_to_string(words, ' ')) AS kept_sha256 FROM kept
"""

#: The other operators hash, learn or search in ways SQL has no words for: see tests/llm.
ORACLE: dict[str, str] = {
    "op5_warc": warc.ORACLE_SQL,
    "op6_substrings": _SUBSTRINGS_SQL,
    "op9_mixing": mixing.ORACLE_SQL,
    "op12_prefix_trie": prefix_trie.ORACLE_SQL,
    "op13_hard_negatives": hard_negatives.ORACLE_SQL,
}
