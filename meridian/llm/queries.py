"""The registered queries of the operators: opN_<name>(spark, sf_dir), with DuckDB SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.common import crc_of_id, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of documents by a chain of two weak categories and the verdict. The labels know one category, toxic;
    the weak ones are parts of the toxic training documents, told by words that training finds."""
    from meridian.llm import toxicity

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score(docs, toxicity.train(docs, labels.select("doc_id", "toxic"), ["toxic"], weak=2), ["weak_1", "weak_2", "toxic"])


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of documents to ids and back."""
    from meridian.llm import bpe

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = bpe.encode(table(spark, sf_dir, "documents"), ranks, decoded="decoded")
    return out.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that texts of documents hold, with the least number of edits."""
    from meridian.llm import decontaminate

    flagged = decontaminate.flag(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return flagged.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.item_id", "leak.distance")


def op4_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every text of documents."""
    from meridian.llm import mil

    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(F.pmod(crc_of_id(), F.lit(5)) != 0)
    out = mil.score(docs, mil.train(docs, labels))
    # a row without an id is never learned from
    return out.select("doc_id", F.coalesce(F.pmod(crc_of_id(), F.lit(5)) == 0, F.lit(True)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text of documents."""
    from meridian.llm import langid

    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(crc_of_id(), F.lit(4)) == 2, F.lit(True))  # a row without an id is never learned from
    out = langid.identify(docs, langid.train(docs.filter(~held_out)))
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text of documents without its repeated 100-byte strings."""
    from meridian.llm import suffix

    out = suffix.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of documents as ids in files, read back."""
    from meridian.llm import tokens

    return tokens.write_and_read(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, read back through the index."""
    from meridian.llm import warc

    return warc.write_and_read(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all texts of documents and the components of those that are near."""
    from meridian.llm import simhash

    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every text of documents and whether the decision list keeps it."""
    from meridian.llm import rules

    out = rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def quality_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 10's statistics alone, which SQL can say too."""
    from meridian.llm import rules

    out = rules.with_stats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_byte_bpe, op3_decontamination, op4_quality_mil, op5_language_id, op6_suffix_dedup, op7_token_files, op8_warc, op9_simhash, op10_quality_rules, quality_statistics)}

#: Base 32 of a SHA-1 digest in hex: each five hex digits are four letters.
_BASE32 = """array_to_string(list_transform(range(0, 8), lambda k: array_to_string(list_transform([15, 10, 5, 0], lambda s:
 substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(sha, CAST(5 * k + 1 AS INT), 5) AS BIGINT) >> s) & 31)::INT, 1)), '')), '')"""

ORACLES: dict[str, str] = {
    "quality_statistics": r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
 x AS (SELECT doc_id, unnest(range(1, greatest(len(ws) - 1, 1))) AS i, ws FROM w), g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS n FROM x),
 r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM g WHERE n > 1) GROUP BY 1),
 l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda v: regexp_matches(v, '[^\x20\x09-\x0D]')) AS ls FROM d)
 SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars, CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
 CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, len(ws) < 50 OR 100 * coalesce(r.n, 0) > 50 * len(ws) AS base_failed
 FROM w JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)""",
    "op8_warc": f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha FROM pages),
 q AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p)
 SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
 CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
 CASE WHEN page_id <> first THEN first END AS refers_to FROM q""",
    "op6_suffix_dedup": """WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
 w AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS s FROM (SELECT doc_id, h, unnest(range(greatest(n - 99, 0))) AS i FROM d)),
 r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM w),
 m AS (SELECT doc_id, i, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 1 ELSE 0 END AS fresh FROM r WHERE k > 1),
 g AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM m),
 s AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM g GROUP BY doc_id, g),
 p AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS x, a AS y FROM s UNION ALL SELECT doc_id, max(b), NULL FROM s GROUP BY 1),
 k AS (SELECT p.doc_id, string_agg(substr(h, 2 * x + 1, 2 * (coalesce(y, n) - x)), '' ORDER BY x) AS kept FROM p JOIN d USING (doc_id) GROUP BY 1),
 t AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans FROM s GROUP BY 1)
 SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
 sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id) LEFT JOIN t USING (doc_id)""",
}
