"""Queries of the operators, and their SQL where SQL can express them.

Where SQL cannot express an operator's whole result, a second query gives the
columns that it can, from the same operator: ``license_base``,
``edited_texts`` and ``mix_targets``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeward.llm import (bpe, divergence, fingerprints, hardneg, langid, licenses, mainhtml, mixing, neardup, neighbours, packing, toxicity,
                          warc)


def license_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base phrases of the license scan."""
    return licenses.op1_license_scan(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def edited_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths and edited texts of the fingerprints."""
    return fingerprints.op4_fingerprints(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and targets of the mix, and that no document is taken more than twice."""
    return mixing.op8_mix_sources(spark, sf_dir).selectExpr("doc_id", "size", "source_size", "target", "taken <= 2 * size AS within")


QUERIES = {
    "op1_license_scan": licenses.op1_license_scan,
    "op2_main_text": mainhtml.op2_main_text,
    "op3_nearest": neighbours.op3_nearest,
    "op4_fingerprints": fingerprints.op4_fingerprints,
    "op5_near_duplicates": neardup.op5_near_duplicates,
    "op6_packing": packing.op6_packing,
    "op7_language": langid.op7_language,
    "op8_mix_sources": mixing.op8_mix_sources,
    "op9_warc": warc.op9_warc,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_bpe_round_trip": bpe.op11_bpe_round_trip,
    "op12_source_divergence": divergence.op12_source_divergence,
    "op13_hard_negatives": hardneg.op13_hard_negatives,
    "license_base": license_base,
    "edited_texts": edited_texts,
    "mix_targets": mix_targets,
}

_LICENSE_BASE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS uid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
phrases(phrase, label) AS (VALUES (['cc', 'by'], 'cc-by'), (['general', 'public', 'license'], 'gpl'), (['all', 'rights', 'reserved'], 'reserved')),
places AS (SELECT uid, w, unnest(range(0, len(w))) AS pos FROM d),
hits AS (SELECT uid, pos, label FROM places JOIN phrases ON w[pos + 1] = phrase[1] AND list_slice(w, pos + 1, pos + len(phrase)) = phrase),
per AS (SELECT uid, count(*) AS n, min(pos) AS lo, max(pos) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM hits GROUP BY uid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, lo AS first_word, hi AS last_word, coalesce(labels, '') AS base_labels
FROM d LEFT JOIN per USING (uid)
"""

_EDITED_TEXTS_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (
  SELECT doc_id, text, length(text) AS n,
    coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS following FROM d)
SELECT doc_id, n AS n_chars, sha256(substring(text, 1, n - n // 2) || substring(following, 1, n // 2)) AS edited_sha256 FROM n
"""

_MIX_TARGETS_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (SELECT source, sum(size) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap FROM s),
-- sources in the order in which a rising level reaches their caps
l AS (
  SELECT *, ((SELECT sum(source_size) FROM s) * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
o AS (SELECT min_by(level, cap / weight) AS level FROM l WHERE cap > level * weight),
t AS (SELECT source, source_size, CASE WHEN cap <= l.level * weight THEN cap ELSE least(cap, o.level * weight) END AS target FROM l CROSS JOIN o)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, true AS within FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
"""

ORACLE_SQL = {
    "op3_nearest": neighbours.ORACLE_SQL,
    "op9_warc": warc.ORACLE_SQL,
    "op12_source_divergence": divergence.ORACLE_SQL,
    "op13_hard_negatives": hardneg.ORACLE_SQL,
    "license_base": _LICENSE_BASE_SQL,
    "edited_texts": _EDITED_TEXTS_SQL,
    "mix_targets": _MIX_TARGETS_SQL,
}

#: Queries whose results SQL cannot express; tests hold them against brute
#: force, round trips or held-out rows.
WITHOUT_SQL = frozenset({
    "op1_license_scan", "op2_main_text", "op4_fingerprints", "op5_near_duplicates", "op6_packing", "op7_language", "op8_mix_sources", "op10_toxicity",
    "op11_bpe_round_trip"})
