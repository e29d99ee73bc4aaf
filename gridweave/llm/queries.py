"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, codes, fingerprints, langid, linededup, media, neardup, packing, pages, quality, shards, toxicity, whitening
from .common import scratch, table


def tokenizer(name: str) -> str:
    """The file of a public tokenizer on this machine; operators take any such path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op2_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.predict(documents, toxicity.learn(documents, table(spark, sf_dir, "labels")))


def op6_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(table(spark, sf_dir, "pages"))


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digests(media.media_columns(table(spark, sf_dir, "documents")))


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each sequence of the shards is, read back from them."""
    to = scratch(spark, "shards")
    shards.write(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), to)
    return shards.read(spark, to).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    profiles = langid.learn(documents.where(langid.training(F.col("doc_id"))))
    held_out = F.coalesce(~langid.training(F.col("doc_id")), F.lit(False))
    return langid.predict(documents.select("doc_id", held_out.alias("held_out"), "text"), profiles)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    scorer = quality.learn(documents, labels.where(~out))
    return quality.predict(documents.select("doc_id", F.coalesce(out, F.lit(False)).alias("held_out"), "text"), scorer)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.digests(*codes.compress(table(spark, sf_dir, "embeddings")))


def op13_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.without_common_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_neardup": op2_neardup,
    "op3_packing": op3_packing,
    "op4_bpe": op4_bpe,
    "op5_toxicity": op5_toxicity,
    "op6_pages": op6_pages,
    "op7_media": op7_media,
    "op8_shards": op8_shards,
    "op9_langid": op9_langid,
    "op10_quality": op10_quality,
    "op11_whitening": op11_whitening,
    "op12_codes": op12_codes,
    "op13_linededup": op13_linededup,
}

_ALL = "abcdefghijklmnopqrstuvwxyz"

LINEDEDUP = f"""WITH li AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place FROM documents),
keyed AS (SELECT doc_id, place, line, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), '{_ALL.upper()}', '{_ALL}') AS key FROM li),
common AS (SELECT key FROM keyed WHERE length(key) >= {linededup.LEAST} GROUP BY key HAVING count(DISTINCT doc_id) >= {linededup.DOCUMENTS})
SELECT k.doc_id, count(*) AS n_lines, count(c.key) AS n_dropped, sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.place) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN common c ON c.key = k.key GROUP BY k.doc_id"""


def _codes_sql(width: int = 16, parts: int = codes.PARTS, entries: int = codes.ENTRIES, rounds: int = codes.ROUNDS) -> str:
    """The rounds one after another; distances as inner products of doubles, which hold these whole numbers exactly."""
    steps = [
        "v AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS x FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"p AS MATERIALIZED (SELECT vec_id, label, part, x[part * {width} + 1 : part * {width} + {width}] AS x FROM v, range({parts}) t(part))",
        f"b0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS z FROM p QUALIFY entry < {entries})",
    ]
    for i in range(rounds + 1):
        steps.append(f"a{i} AS MATERIALIZED (SELECT p.vec_id, p.part, min((list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, b.z) + list_inner_product(b.z, b.z)) * {entries} + b.entry) AS best FROM p JOIN b{i} b ON b.part = p.part GROUP BY p.vec_id, p.part)")
        steps.append(f"e{i} AS (SELECT p.part, CAST(a.best AS BIGINT) % {entries} AS entry, unnest(p.x) AS c, generate_subscripts(p.x, 1) AS place FROM p JOIN a{i} a ON a.vec_id = p.vec_id AND a.part = p.part)")
        steps.append(f"m{i} AS (SELECT part, entry, list(mean ORDER BY place) AS z FROM (SELECT part, entry, place, floor(sum(c) / count(*)) AS mean FROM e{i} GROUP BY ALL) GROUP BY part, entry)")
        steps.append(f"b{i + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.z, b.z) AS z FROM b{i} b LEFT JOIN m{i} m ON m.part = b.part AND m.entry = b.entry)")
    last = f"""r AS (SELECT vec_id, string_agg(lower(printf('%02x', CAST(best AS BIGINT) % {entries})), '' ORDER BY part) AS code, CAST(sum(CAST(best AS BIGINT) // {entries}) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id),
k AS (SELECT sha256(string_agg(array_to_string(list_transform(z, lambda c: CAST(CAST(c AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})
SELECT r.vec_id, r.code, r.error, CAST(sum(r.error) OVER (PARTITION BY v.label) AS BIGINT) AS label_error, k.codebooks_sha256 FROM r JOIN v ON v.vec_id = r.vec_id CROSS JOIN k"""
    return "WITH " + ",\n".join(steps) + ",\n" + last


ORACLES: dict[str, str] = {"op12_codes": _codes_sql(), "op13_linededup": LINEDEDUP}
