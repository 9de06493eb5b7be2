"""The registered queries of the text operators, with production parameters over whole tables."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsieve.llm.bpe import round_trip
from tabsieve.llm.collocations import collocations
from tabsieve.llm.common import scratch_folder, table
from tabsieve.llm.decontamination import leaked_items
from tabsieve.llm.html_extraction import extract_text
from tabsieve.llm.language import held_out, identify_language, language_samples
from tabsieve.llm.masked_lm import fit, score
from tabsieve.llm.periodic_runs import run_digests
from tabsieve.llm.pii import find_personal_data
from tabsieve.llm.quality import judge_quality
from tabsieve.llm.secrets import find_secrets
from tabsieve.llm.simhash import simhash_components
from tabsieve.llm.token_files import read_token_files, write_token_files
from tabsieve.llm.word_trie import round_trip as word_round_trip


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and test item that it holds."""
    found = leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"), keep=["doc_id"]).select("doc_id", "fingerprint", "component_id")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, keep=["doc_id"])


def op5_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op6_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, *fit(docs), keep=["doc_id"])


def op7_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_quality(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_perplexity")


def op8_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark)
    write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), folder)
    return read_token_files(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


def op10_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    samples = language_samples(docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()))
    found = identify_language(docs, samples, keep=["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def with_repeats(doc_id: int | None, n: int) -> list[int] | None:
    """Which of its n words a document takes instead, for one in ten ids: from word a on, every p-th; none for null ids."""
    if doc_id is None or not n or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return None
    g = h // 10
    a = g % n
    p, at = 1 + (n - a) // (3 + g % 8), np.arange(n)
    return np.where(at < a, at, a + (at - a) % p).tolist()


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(table(spark, sf_dir, "documents"), keep=["doc_id"], key="doc_id", rearranged=with_repeats)


def op12_word_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id"])


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_html_extraction": op2_html_extraction,
    "op3_simhash": op3_simhash,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_pii_crf": op5_pii_crf,
    "op6_masked_lm": op6_masked_lm,
    "op7_kneser_ney": op7_kneser_ney,
    "op8_secret_links": op8_secret_links,
    "op9_token_files": op9_token_files,
    "op10_cross_parsing": op10_cross_parsing,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_word_trie": op12_word_trie,
    "op13_collocations": op13_collocations,
}

ORACLES: dict[str, str] = {
    "op13_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n-\r]')) AS piece
  FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
grams AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS phrase FROM words, range(1, 6) AS t(k)),
counted AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 100),
candidates AS (
  SELECT * FROM counted c WHERE k >= 2 AND NOT EXISTS (
    SELECT 1 FROM counted o WHERE o.lang = c.lang AND o.f = c.f AND o.k > c.k AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' '))),
cuts AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM candidates),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, l.f AS l, r.f AS r, t.n,
         (1000::HUGEINT * c.a * t.n) // (l.f::HUGEINT * r.f) AS score
  FROM cuts c
  JOIN counted l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : c.cut], ' ')
  JOIN counted r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.cut + 1 :], ' ')
  JOIN totals t ON t.lang = c.lang),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
""",
}
