"""The registered queries of the operators: digests of each operator's results, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemart.llm import (
    fingerprints, merkle_log, mixing, ngram_join, ngram_model, packing, personal, phrases, quality, suffix_dedup, token_files, toxicity, warc,
)
from pulsemart.llm.common import scratch_path, stage, table, word_count


def op1_ngram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of all documents."""
    return ngram_model.score(table(spark, sf_dir, "documents"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the byte strings that repeat."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of each document; cutoffs come from the labelled ones."""
    measured = stage(quality.measure(table(spark, sf_dir, "documents"), ["doc_id", "lang"]), "measures")
    cutoffs = quality.choose_cutoffs(measured, table(spark, sf_dir, "labels"))
    return quality.judge(measured, cutoffs).drop("lang")


def op5_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records and read back: responses with their payloads, revisits by their headers alone."""
    folder = scratch_path(spark, "warc")
    warc.register(spark)
    warc.write_pages(table(spark, sf_dir, "pages"), folder)
    responses = warc.read_archive(spark, folder).where("record_type = 'response'").select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"),
        "record_type", "refers_to",
    )
    headers = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return responses.unionByName(warc.read_archive(spark, folder, headers).where("record_type = 'revisit'"))


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file; the package is installed wherever tasks run."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written to files and read back from them."""
    folder = scratch_path(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), folder, vocabulary("word_bpe_49k.json"), 1)
    return token_files.read_tokens(spark, folder)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    items = stage(packing.pieces(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), 0), "pieces")
    return packing.pack(items).drop("key")


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a curriculum takes of each document, in the order of first use."""
    sizes = stage(table(spark, sf_dir, "documents").select("doc_id", "source", word_count().alias("size")), "sizes")
    mixed = mixing.mix(sizes, size=F.col("size"))
    return mixed.select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        F.aggregate("mix_copies", F.lit(0).cast("long"), lambda n, c: n + c["words"]).alias("taken"),
        F.get("mix_copies", F.lit(0))["position"].alias("position"),
    ).orderBy("position", "doc_id")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: strict patterns, and what the trained classifier adds."""
    return personal.find(table(spark, sf_dir, "documents"))


def op10_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consistent-weighted-sampling fingerprints of all documents and their edited texts."""
    return fingerprints.compare_neighbours(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, roots and proofs of all documents; some are checked after their row was tampered with."""
    return merkle_log.manifest(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's best collocations, counted over all documents."""
    return phrases.mine(table(spark, sf_dir, "documents"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents; a fifth of the ids is held out from training."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    labels = table(spark, sf_dir, "labels").where(~held_out)
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_scores": op1_ngram_scores,
    "op2_ngram_join": op2_ngram_join,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_warc_archive": op5_warc_archive,
    "op6_token_files": op6_token_files,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_source_mixing": op8_source_mixing,
    "op9_personal_data": op9_personal_data,
    "op10_weighted_fingerprints": op10_weighted_fingerprints,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_collocations": op12_collocations,
    "op13_toxicity": op13_toxicity,
}
SQL: dict[str, str] = {
    "op5_warc_archive": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
        d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha256(b) AS payload_digest FROM p),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
        FROM f
    """,
    "op11_merkle_manifest": """
        WITH RECURSIVE f AS (
            SELECT doc_id, lang, n_chars, coalesce(octet_length(encode(text)) || ':' || text, '-') AS body,
                coalesce(length(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
                || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS head,
                -- CRC-32 by its polynomial
                xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                    lambda x: ascii(x)::UBIGINT)), lambda c, x: list_reduce(list_prepend(xor(c, x), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
                    lambda y, z: xor(y >> 1, (y & 1) * 3988292384::UBIGINT)))) AS crc
            FROM documents),
        g AS (
            SELECT *, n_chars + CASE WHEN crc % 7 = 0 THEN 1 ELSE 0 END AS raised FROM f),
        h AS (
            SELECT doc_id, lang, sha256(head || coalesce(length(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || body) AS leaf,
                sha256(head || coalesce(length(CAST(raised AS VARCHAR)) || ':' || raised, '-') || body) AS checked FROM g),
        leaves AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS cnt
            FROM h),
        tree AS (
            SELECT lang, 0 AS level, pos, cnt, leaf AS h FROM leaves
            UNION ALL
            SELECT lang, level + 1, pos // 2, (cnt + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM tree WHERE cnt > 1
            GROUP BY lang, level, pos // 2, cnt),
        tops AS (
            SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS cnt FROM tree WHERE cnt = 1),
        top AS (
            SELECT 0 AS level, pos, cnt, subroot AS h FROM tops
            UNION ALL
            SELECT level + 1, pos // 2, (cnt + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE cnt > 1
            GROUP BY level, pos // 2, cnt),
        height AS (SELECT lang, max(level) AS height FROM tree GROUP BY lang),
        steps AS (
            SELECT l.lang, l.pos, t.level, t.pos < l.pos >> t.level AS before, t.h FROM leaves l
            JOIN tree t ON t.lang IS NOT DISTINCT FROM l.lang AND t.cnt > 1 AND t.pos = xor(l.pos >> t.level, 1)
            UNION ALL
            SELECT l.lang, l.pos, height + t.level, t.pos < s.pos >> t.level, t.h FROM leaves l
            JOIN tops s ON s.lang IS NOT DISTINCT FROM l.lang JOIN height e ON e.lang IS NOT DISTINCT FROM l.lang
            JOIN top t ON t.cnt > 1 AND t.pos = xor(s.pos >> t.level, 1)),
        fold AS (
            SELECT lang, pos, 0 AS level, checked AS h FROM leaves
            UNION ALL
            SELECT o.lang, o.pos, o.level + 1, sha256(CASE WHEN s.h IS NULL THEN o.h WHEN s.before THEN s.h || o.h ELSE o.h || s.h END)
            FROM fold o JOIN height e ON e.lang IS NOT DISTINCT FROM o.lang
            LEFT JOIN steps s ON s.lang IS NOT DISTINCT FROM o.lang AND s.pos = o.pos AND s.level = o.level
            WHERE o.level < e.height + (SELECT max(level) FROM top)),
        ends AS (SELECT lang, pos, arg_max(h, level) AS folded_root FROM fold GROUP BY lang, pos),
        proofs AS (SELECT lang, pos, string_agg(h, '' ORDER BY level) AS sides FROM steps GROUP BY lang, pos),
        root AS (SELECT h AS root FROM top WHERE cnt = 1)
        SELECT l.doc_id, l.leaf, s.subroot, root.root, sha256(coalesce(p.sides, '')) AS proof_sha256, n.folded_root, n.folded_root = root.root AS verified
        FROM leaves l JOIN tops s ON s.lang IS NOT DISTINCT FROM l.lang JOIN ends n ON n.lang IS NOT DISTINCT FROM l.lang AND n.pos = l.pos
        LEFT JOIN proofs p ON p.lang IS NOT DISTINCT FROM l.lang AND p.pos = l.pos CROSS JOIN root
    """,
    "op12_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        listed AS (
            SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
        grams AS (
            SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM listed, (SELECT unnest([1, 2, 3, 4, 5]) AS size) WHERE len(w) >= size),
        f AS (
            SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, any_value(w[i:i + size - 1]) AS w, count(*) AS f FROM grams GROUP BY ALL
            HAVING size = 1 OR count(*) >= 100),
        n AS (SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang),
        c AS (SELECT * FROM f WHERE size > 1),
        inner_phrases AS (
            SELECT lang, array_to_string(w[s:s + k - 1], ' ') AS phrase, max(f) AS around
            FROM c, (SELECT unnest([1, 2, 3, 4]) AS s), (SELECT unnest([2, 3, 4]) AS k) WHERE k < size AND s + k - 1 <= size GROUP BY ALL),
        cuts AS (
            SELECT c.lang, c.phrase, f AS a, k, array_to_string(w[:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
            FROM c LEFT JOIN inner_phrases i ON i.lang = c.lang AND i.phrase = c.phrase, (SELECT unnest([1, 2, 3, 4]) AS k)
            WHERE k < size AND (around IS NULL OR 100 * around < 100 * f)),
        scored AS (
            SELECT cuts.lang, cuts.phrase, a, k, l.f AS l, r.f AS r, n.n,
                CAST(1000 * CAST(a AS HUGEINT) * n.n // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
            FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = first JOIN f r ON r.lang = cuts.lang AND r.phrase = rest
            JOIN n ON n.lang = cuts.lang),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
        FROM best QUALIFY rank <= 2000
    """,
}
