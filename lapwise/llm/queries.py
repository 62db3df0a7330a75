"""The registered queries of this folder: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lapwise.catalog.registry import query
from lapwise.llm import (
    alignment, contamination, language, neardup, neighbours, packing, phrases, pii, repeats, sharding, toxicity, urls, warc,
)
from lapwise.llm.common import table

#: Name of the vocabulary file of the packing query.
VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """The installed vocabulary file; every worker has the same package."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_sharding")
def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.vector_shards(table(spark, folder, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "tokens",
    )


@query("op2_packing")
def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.harmonic_pack(table(spark, folder, "documents"), vocabulary_path())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op3_decontamination")
def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return contamination.contaminated(found).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return toxicity.toxicity(documents, documents, table(spark, folder, "labels"))


@query("op5_repeats")
def op5_repeats(spark: SparkSession, folder: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


_URL_CHECK = """
    WITH cut AS (
        SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages
    ), parts AS (
        SELECT page_id,
            translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
        FROM cut
    ), ruled AS (
        SELECT *, CASE
            WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
            WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
            WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
            WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule
        FROM parts
    )
    SELECT *, CASE
        WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
        WHEN (host LIKE '%spam%' OR host LIKE '%casino%' OR host LIKE '%porn%') AND (path = '' OR starts_with(path, '/'))
        THEN 'block' ELSE 'allow' END AS verdict
    FROM ruled
"""


@query("op6_url_filter", _URL_CHECK)
def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge_urls(table(spark, folder, "pages"))


@query("op7_language")
def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    fold = F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5, F.lit(1))
    learned = language.language_tables(documents.where(fold != 0))
    found = language.identify_languages(documents.select(F.struct("doc_id", (fold == 0).alias("held_out")).alias("row"), "text"),
                                        learned, id_col="row")
    return found.select("row.doc_id", "row.held_out", "lang_pred", "score")


_BASE = ("email", "ip", "card", "phone")


@query("op8_pii")
def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_pii(table(spark, folder, "documents").select("doc_id", "text"), into="found")

    def count(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(kind) for kind in _BASE],
        F.sha2(pii.listed("found", _BASE), 256).alias("base_sha256"), pii.listed("found").alias("spans"),
    )


@query("op9_neighbours")
def op9_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"))


@query("op10_near_duplicates")
def op10_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents")).select("doc_id", "class_id", "kept")


#: The piece vocabulary that is aligned with the byte-level one.
PIECES = "piece_bpe_32k.model"


@query("op11_alignment")
def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_tokenizers(table(spark, folder, "documents"), vocabulary_path(), vocabulary_path(PIECES))


_WARC_CHECK = """
    WITH named AS (
        SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
    ), firsts AS (
        SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM named
    )
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
    FROM firsts
"""


@query("op12_archives", _WARC_CHECK)
def op12_archives(spark: SparkSession, folder: str) -> DataFrame:
    bundles = warc.write_archives(table(spark, folder, "pages"))
    return warc.read_archives(bundles).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_PHRASE_CHECK = """
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    ), worded AS (
        SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces
    ), grams AS (
        SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
        FROM worded, range(1, 5) AS lengths(m) WHERE len(w) >= m
    ), counts AS (
        SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL
    ), sizes AS (
        SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE m = 1 GROUP BY lang
    ), candidates AS (
        SELECT lang, m, phrase, string_split(phrase, ' ') AS w, f AS a FROM counts WHERE m > 1 AND f >= 30
    ), inner_phrases AS (
        SELECT lang, a, unnest(flatten(list_transform(range(2, m), lambda k:
            list_transform(range(1, m - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))))) AS phrase
        FROM candidates
    ), covered AS (
        SELECT DISTINCT c.lang, c.phrase FROM candidates c JOIN inner_phrases i USING (lang, phrase) WHERE 100 * i.a >= 80 * c.a
    ), cuts AS (
        SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:m], ' ') AS rest
        FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates) ANTI JOIN covered USING (lang, phrase)
    ), scored AS (
        SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, (CAST(2000000 AS HUGEINT) * c.a) // (x.f + y.f) AS score
        FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.first JOIN counts y ON y.lang = c.lang AND y.phrase = c.rest
    ), weakest AS (
        SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
    )
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
        CAST(score AS BIGINT) AS score
    FROM weakest JOIN sizes USING (lang) QUALIFY rank <= 2000
"""


@query("op13_collocations", _PHRASE_CHECK)
def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


@query("pipeline")
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
