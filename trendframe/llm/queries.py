"""One query per operator, over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendframe.llm import bpe, bpe_index, hard_negatives, host_rules, jaccard_join, langid, merkle, packing, pii, resampling, secret_scan, syncmers, warc
from trendframe.llm.common import table
from trendframe.session import scratch_dir


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2048, end_id=1)
    return pieces.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    made, normal = scratch_dir(spark, "warc"), scratch_dir(spark, "warc-members")
    warc.write(table(spark, sf_dir, "pages"), made)
    return warc.read(warc.normalise(spark, made, normal)).drop("uri")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *(secret_scan.count_of(k).alias(f"n_{k}") for k in secret_scan.BASE),
        F.sha2(secret_scan.joined(secret_scan.BASE), 256).alias("base_sha256"), secret_scan.joined().alias("spans"),
    )


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classes(table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *(secret_scan.count_of(k).alias(f"n_{k}") for k in pii.BASE),
        F.sha2(secret_scan.joined(pii.BASE), 256).alias("base_sha256"), secret_scan.joined().alias("spans"),
    )


def op8_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.quality_rules(table(spark, sf_dir, "documents"))


def op9_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.compare(table(spark, sf_dir, "documents"))


def op11_bpe_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe_index.digests(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.translate(text, UPPER, UPPER.lower())).otherwise(text)
    return merkle.verify(merkle.manifest(table(spark, sf_dir, "documents"), {"text": tampered}))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(hard_negatives.quantised(vectors.withColumn("label", moved), 256), every=100)


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_warc": op2_warc,
    "op3_langid": op3_langid,
    "op4_bpe": op4_bpe,
    "op5_secrets": op5_secrets,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_pii": op7_pii,
    "op8_host_rules": op8_host_rules,
    "op9_resampling": op9_resampling,
    "op10_syncmers": op10_syncmers,
    "op11_bpe_index": op11_bpe_index,
    "op12_merkle": op12_merkle,
    "op13_hard_negatives": op13_hard_negatives,
}

#: The digest of a payload and the smallest page with it say all.
OP2_SQL = """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), f AS (
    SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN first <> coalesce(page_id, first - 1) THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN first <> coalesce(page_id, first - 1) THEN first END AS refers_to
FROM f
"""

#: Windows by their words, not by hashes; the prior as in the operator.
OP8_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents
), w AS (
    SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
    FROM d
), g AS (
    SELECT r, i, ws[i : i + 4] AS gram FROM w, unnest(generate_series(1, len(ws) - 4)) AS u(i)
), twice AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS c FROM g) WHERE c > 1
), covered AS (
    SELECT r, count(DISTINCT i + k) AS n FROM twice, unnest(generate_series(0, 4)) AS u(k) GROUP BY r
), m AS (
    SELECT doc_id, source, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
        (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
    FROM w LEFT JOIN covered c USING (r)
), b AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m
), h AS (
    SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS x FROM b GROUP BY source
), s AS (
    SELECT count(*) AS hosts, sum(n)::DOUBLE AS n, sum(x) / sum(n) AS mean, sum(x * x / n) AS square FROM h
), v AS (
    SELECT *, mean * (1 - mean) AS within, square / n - mean * mean - mean * (1 - mean) * hosts / n AS between_hosts FROM s
), p AS (
    SELECT mean, CASE WHEN between_hosts > 0 THEN least(greatest(within / between_hosts - 1, 1), 1000) ELSE 1000 END AS strength FROM v
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND (h.x + mean * strength) / (h.n + strength) <= 0.5 AS kept
FROM b JOIN h ON b.source IS NOT DISTINCT FROM h.source, p
"""

def _merkle_sql(levels: int = 8) -> str:
    """Level after level of both trees, enough for ``8 ** levels`` rows of a language and as many languages."""
    said = ", ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END" for c in ("doc_id", "source", "lang", "n_chars"))
    text = lambda t: f"CASE WHEN {t} IS NULL THEN '-' ELSE strlen({t}) || ':' || {t} END"
    # CRC-32 one bit at a time: eight steps for each byte of the decimal id.
    step = "list_reduce(list_concat([xor(a, b)], generate_series(1, 8)), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))"
    crc = f"xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda a, b: {step}), 4294967295)"
    steps = [
        f"""d AS (
    SELECT doc_id, lang, sha256(concat({said}, {text("text")})) AS leaf,
        sha256(concat({said}, {text("changed")})) AS claimed
    FROM (SELECT *, CASE WHEN {crc} % 3 = 0 THEN translate(text, '{UPPER}', '{UPPER.lower()}') ELSE text END AS changed FROM documents)
), r AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS g FROM d
), a0 AS (
    SELECT g, rank AS i, leaf AS h FROM r
)"""
    ]

    def level(n: str, k: int) -> str:
        return f"""{n}{k + 1} AS (
    SELECT g, i // 8 AS i, CASE WHEN any_value(many) THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h
    FROM (SELECT *, count(*) OVER (PARTITION BY g) > 1 AS many FROM {n}{k}) GROUP BY g, i // 8
)"""

    def path(n: str, k: int) -> str:
        return f"""{n}p{k} AS (
    SELECT x.g, x.i, coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (y.i < x.i), '') AS l,
        coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (y.i > x.i), '') AS r, count(*) > 0 AND any_value(y.n) > 1 AS there
    FROM {n}{k} x JOIN (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM {n}{k}) y ON x.g = y.g AND x.i // 8 = y.i // 8
    GROUP BY x.g, x.i
)"""

    for k in range(levels):
        steps += [path("a", k), level("a", k)]
    steps.append(f"b0 AS (SELECT 0 AS g, g - 1 AS i, h FROM a{levels})")
    for k in range(levels):
        steps += [path("b", k), level("b", k)]
    joins, proof = [], []
    for n, g, i in (("a", "r.g", "r.rank"), ("b", "0", "(r.g - 1)")):
        for k in range(levels):
            t = f"{n}p{k}"
            joins.append(f"JOIN {t} ON {t}.g = {g} AND {t}.i = {i} // {8**k}")
            proof.append(f"{t}.l || {t}.r")
    steps.append(
        "w AS (SELECT r.*, "
        + f"a{levels}.h AS subroot, b{levels}.h AS root, sha256({' || '.join(proof)}) AS proof_sha256, "
        + ", ".join(f"{n}p{k}.l AS {n}l{k}, {n}p{k}.r AS {n}r{k}, {n}p{k}.there AS {n}t{k}" for n in "ab" for k in range(levels))
        + f" FROM r {' '.join(joins)} JOIN a{levels} ON a{levels}.g = r.g JOIN b{levels} ON true)"
    )
    below = "claimed"
    for n in "ab":
        for k in range(levels):
            steps.append(f"f{n}{k} AS (SELECT *, CASE WHEN {n}t{k} THEN sha256({n}l{k} || {below} || {n}r{k}) ELSE {below} END AS c{n}{k} FROM {'w' if below == 'claimed' else last})")
            below, last = f"c{n}{k}", f"f{n}{k}"
    return (
        "WITH " + ",\n".join(steps)
        + f"\nSELECT doc_id, leaf, subroot, root, proof_sha256, {below} AS folded_root, {below} = root AS verified FROM {last}"
    )


#: Every anchor against every row; sums of integers in whole numbers.
OP13_SQL = """
WITH v AS (
    SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
        coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))), 0)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS place FROM s WHERE same
), n AS (
    SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS rank
    FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
    WHERE p.place <= 5
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

ORACLES: dict[str, str] = {"op2_warc": OP2_SQL, "op8_host_rules": OP8_SQL, "op12_merkle": _merkle_sql(), "op13_hard_negatives": OP13_SQL}
