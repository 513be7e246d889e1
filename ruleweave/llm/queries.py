"""The registered queries of the training-data operators: thin, over whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ruleweave.llm import (decontamination, filter_audit, language_id, licenses, minhash_dedup, mixing, packing, pii,
                           quality_rules, simhash_dedup, substring_dedup, warc, whitening)
from ruleweave.llm.stage import scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in a document: five-word shingles, weighted similarity of 0.8 or more."""
    return decontamination.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and digest of the base kinds, all spans."""
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    counts = [F.expr(f"CAST(size(filter(spans, s -> s.kind = '{kind}')) AS bigint)").alias(f"n_{kind}")
              for kind in pii.BASE_KINDS]
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return found.select("doc_id", *counts, F.sha2(pii.spans_text(base), 256).alias("base_sha256"),
                        pii.spans_text(F.col("spans")).alias("spans"))


def op3_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document tokenized and packed into rows of 2,048 ids."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources mixed to weights by the root of their size, in one global order; as many documents as there are."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"), alpha=0.5, epochs=1.0, seed=42)
    return mixed.select("doc_id", "copy", "source", "rate", "lang", "text")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and risk-controlled verdict of every document."""
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", "rejected_by")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that are left once passages of 50 words seen in earlier documents go."""
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=50)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and templates in every document."""
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    places = F.filter("hits", lambda h: h["kind"] == "phrase")
    starts = F.transform(places, lambda h: h["start"])

    def labels(hits):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["label"]))), ",")

    return found.select("doc_id", "n_words", F.size(places).cast("bigint").alias("n_base"),
                        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                        labels(places).alias("base_labels"), labels(F.col("hits")).alias("labels"), "score")


def op8_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to a content-addressed archive and read back from it."""
    path = scratch(spark, "archive")
    warc.write_archive(table(spark, sf_dir, "pages"), path, min_bytes=0)
    return warc.read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type",
                                                 "refers_to", "verified")


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of near-duplicates of every document."""
    groups = simhash_dedup.simhash_groups(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three of four folds."""
    return language_id.identify(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes from every language, at every step of all 120 orders."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the sixteen widest directions, at unit variance."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=16)


def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of the shingle set and group of near-duplicates of every document: four words, similarity of 0.8."""
    return minhash_dedup.minhash_groups(table(spark, sf_dir, "documents"), shingle=4, percent=80)


QUERIES = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_pii": op2_pii,
    "op3_token_packing": op3_token_packing,
    "op4_source_mixing": op4_source_mixing,
    "op5_quality_rules": op5_quality_rules,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_license_scan": op7_license_scan,
    "op8_warc_archive": op8_warc_archive,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_language_id": op10_language_id,
    "op11_filter_audit": op11_filter_audit,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_minhash_near_dedup": op13_minhash_near_dedup,
}
ORACLES: dict[str, str] = {
    "op4_source_mixing": """
        WITH n AS (SELECT coalesce(source, '') AS s, count(*) AS n FROM documents GROUP BY 1),
        r AS (SELECT s, sqrt(n) / (SELECT sum(sqrt(n)) FROM n) * (SELECT sum(n) FROM n) / n AS rate FROM n),
        t AS (SELECT s, rate, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p
              FROM r, unnest(range(CAST(ceil(rate + 12 * sqrt(rate) + 31) AS BIGINT))) AS u(k)),
        c AS (SELECT s, rate, sum(p) OVER (PARTITION BY s ORDER BY k) AS c FROM t),
        d AS (SELECT *, coalesce(source, '') AS s,
                     CAST('0x' || substr(md5('42|draw|' || coalesce(source, '') || '|' || coalesce(CAST(doc_id AS VARCHAR), '')
                                         || '|' || md5(coalesce(text, ''))), 1, 13) AS BIGINT) / 4503599627370496.0 AS u FROM documents),
        m AS (SELECT d.doc_id, d.source, d.lang, d.text, any_value(c.rate) AS rate, count(*) AS n
              FROM d JOIN c ON c.s = d.s AND c.c <= d.u GROUP BY ALL)
        SELECT doc_id, CAST(copy AS INTEGER) AS copy, source, rate, lang, text FROM m, unnest(range(1, n + 1)) AS u(copy)""",
    "op8_warc_archive": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS h,
                     min(page_id) OVER (PARTITION BY html) AS low FROM p)
        SELECT page_id, payload_bytes,
               array_to_string([translate(to_base(CAST('0x' || substr(h, 5 * i + 1, 5) AS BIGINT), 32, 4),
                   '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') FOR i IN range(8)], '')
                   AS payload_digest,
               CASE WHEN page_id = low THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> low THEN low END AS refers_to, TRUE AS verified
        FROM d""",
    "op11_filter_audit": r"""
        WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                          regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
                     max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
        f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                     concat(CASE WHEN len(words) < 200 THEN 'A' ELSE '' END,
                            CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END,
                            CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 'C' ELSE '' END,
                            CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END,
                            CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END) AS fails
              FROM d LEFT JOIN l ON l.doc_id = d.doc_id),
        c AS (SELECT part, fails, count(*) AS n, sum(good) AS n_good, sum(toxic) AS n_toxic FROM f GROUP BY part, fails),
        x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        o AS (SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order FROM x a, x b, x c, x d, x e
              WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS letter,
                     filter_order[1:step - 1] AS earlier FROM o, unnest(range(1, 6)) AS u(step)),
        t AS (SELECT c.*, s.*, contains(fails, letter) AS fail, len(translate(fails, earlier, '')) < len(fails) AS gone
              FROM c, s),
        r AS (SELECT part, filter_order, step, letter,
                     sum(CASE WHEN NOT fail AND NOT gone THEN n ELSE 0 END) AS kept,
                     sum(CASE WHEN fail AND NOT gone THEN n ELSE 0 END) AS removed,
                     sum(CASE WHEN fail AND gone THEN n ELSE 0 END) AS redundant,
                     sum(CASE WHEN fails = letter THEN n ELSE 0 END) AS unique_fails,
                     sum(CASE WHEN fail AND NOT gone THEN n_good ELSE 0 END) AS good_lost,
                     sum(CASE WHEN fail AND NOT gone THEN n_toxic ELSE 0 END) AS toxic_lost
              FROM t GROUP BY part, filter_order, step, letter)
        SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
               CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
               CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
        FROM r""",
}
