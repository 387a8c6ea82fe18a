"""Thin queries over the training-data operators, one per operator, with their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (
    decontamination, disclosure, language_mix, merkle, mixing, packing, page_diff, periodic, quality, ring, simhash, token_counts, tool_calls,
)
from ledgerline.llm.common import let, table, words


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = quality.label(table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])
    q = F.col("quality")
    return d.select("doc_id", *[q[c].alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")])


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("mix")
    return mixing.mix(table(spark, sf_dir, "documents"), carry=["doc_id"]).select(
        "doc_id", m["size"].alias("size"), m["source_size"].alias("source_size"), m["target"].alias("target"),
        (m["copies"] * m["size"]).alias("taken"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), F.col("n_item").cast("long").alias("n_item"),
                        F.col("n_shared").cast("long").alias("n_shared"),
                        (F.col("n_shared") / F.col("n_item")).alias("containment"))


def op4_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = tool_calls.as_tool_messages(table(spark, sf_dir, "conversations"))
    return tool_calls.linked(messages, tool_calls.SCHEMAS).withColumnRenamed("conv", "conv_id")


def op5_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = disclosure.find(table(spark, sf_dir, "documents"), carry=["doc_id"])
    p = F.col("private")
    n = lambda kind: F.size(F.filter(p["base"], lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return d.select("doc_id", *[n(k) for k in disclosure.KINDS], F.sha2(disclosure.written(p["base"]), 256).alias("base_sha256"),
                    disclosure.written(F.concat(p["base"], p["terms"])).alias("spans"))


def op6_hash_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("placed")
    return ring.assign(table(spark, sf_dir, "documents"), carry=["doc_id"]).select(
        "doc_id", p["size"].alias("size"), p["text_crc32"].alias("text_crc32"), F.lit("rows").alias("law"),
        p["shard"].alias("shard"), p["slot"].alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


#: Tokenizer of the token-count query: a file of the installed ``public_tokenizers`` package.
TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 1024


def op7_token_counts(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    import public_tokenizers
    d = token_counts.count(table(spark, sf_dir, "documents"), tokenizer or str(public_tokenizers.path(TOKENIZER)))
    return d.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op8_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    d = language_mix.predict(docs.withColumn("held_out", F.coalesce(fold == 0, F.lit(False))).drop("lang"),
                             docs.where(fold != 0), carry=["doc_id", "held_out"])
    m = F.col("mixture")
    return d.select("doc_id", "held_out", m["lang"].alias("lang_pred"), m["score"].alias("score"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_page_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = page_diff.main_text(table(spark, sf_dir, "pages"))
    return d.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


def _crc(c) -> F.Column:
    return F.crc32(c.cast("string").cast("binary"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    cut = F.when(_crc(F.col("doc_id")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    d = d.withColumn("tampered", merkle.leaf([cut if c == "text" else F.col(c) for c in merkle.FIELDS]))
    p = F.col("proof")
    d = merkle.prove(d, carry=["doc_id", "tampered"])
    return d.select("doc_id", *[p[c].alias(c) for c in ("leaf", "subroot", "root")], merkle.siblings_digest(p["path"]).alias("proof_sha256"),
                    merkle.fold(F.col("tampered"), p["path"]).alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_pattern_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    import public_tokenizers
    d = packing.token_pieces(table(spark, sf_dir, "documents"), tokenizer or str(public_tokenizers.path(TOKENIZER)), carry=["doc_id"])
    t, p = F.col("tokens"), F.col("packed")
    d = d.select("doc_id", *[t[c].alias(c) for c in ("piece", "start", "length")], F.crc32(t["ids"]).alias("ids_crc32"))
    d = packing.pack(d, limit=TOKEN_LIMIT)
    return d.select("doc_id", "piece", "start", "length", "ids_crc32", p["sequence_id"].alias("sequence_id"), p["offset"].alias("offset"))


def with_periods(docs: DataFrame) -> DataFrame:
    """``documents`` with a repeated passage planted in a tenth of them: from word a on, the next p words over and over."""
    h = _crc(F.col("doc_id"))
    g, n = F.floor(h / 10), F.size(F.col("w"))
    d = docs.select("doc_id", "text", words(F.col("text")).alias("w"), h.alias("h"), g.alias("g"))
    a = F.pmod(g, n)
    p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
    planted = let(F.struct("w", a.alias("a"), p.alias("p")), lambda v: F.array_join(F.transform(v["w"], lambda x, i: F.when(
        i < v["a"], x).otherwise(F.get(v["w"], (v["a"] + F.pmod(i - v["a"], v["p"])).cast("int")))), " "))
    return d.select("doc_id", F.when((F.pmod(F.col("h"), F.lit(10)) == 0) & (n > 0), planted).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = periodic.detect(with_periods(table(spark, sf_dir, "documents")), carry=["doc_id"])
    r, best = F.col("periodic")["runs"], F.col("best")
    d = d.withColumn("best", periodic.longest(r))
    lines = F.transform(r, lambda x: F.concat(x["start"], F.lit(","), x["length"], F.lit(","), x["period"], F.lit("\n")))
    return d.select("doc_id", F.size(r).cast("long").alias("n_runs"), *[best[c].alias(c) for c in ("start", "length", "period")],
                    F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
                    F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2(F.col("periodic")["collapsed"], 256).alias("collapsed_sha256"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_mix_sources": op2_mix_sources,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_tool_calls": op4_tool_calls,
    "op5_disclosure": op5_disclosure,
    "op6_hash_ring_shards": op6_hash_ring_shards,
    "op7_token_counts": op7_token_counts,
    "op8_language_mixture": op8_language_mixture,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_page_difference": op10_page_difference,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_pattern_packing": op12_pattern_packing,
    "op13_periodic_runs": op13_periodic_runs,
}

_WORDS = "list_filter(regexp_split_to_array(lower({t}), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
_GRAMS = """CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END"""

_FIELD = "CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR END"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c=c) for c in ("doc_id", "source", "lang", "n_chars")) + " || " + _FIELD.format(c="{t}") + ")"
# CRC-32 of decimal digits, bit by bit (reflected polynomial 0xEDB88320)
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))))"""

ORACLES: dict[str, str] = {
    "op11_merkle_manifest": f"""
WITH RECURSIVE docs AS (
    SELECT doc_id, source, {_LEAF.format(t="text")} AS leaf, {_LEAF.format(t="cut")} AS tampered
    FROM (SELECT *, CASE WHEN ({_CRC}) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS cut FROM documents)
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
           row_number() OVER () AS rid, count(*) OVER (PARTITION BY source) AS n FROM docs
), lower(l, source, idx, n, h) AS (
    SELECT 0, source, pos, n, leaf FROM leaves
    UNION ALL
    SELECT l + 1, source, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM lower WHERE n > 1 GROUP BY l, source, idx // 3, n
), subroots AS (
    SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM lower WHERE n = 1
), upper(l, idx, n, h) AS (
    SELECT 0, pos, n, h FROM subroots
    UNION ALL
    SELECT l + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM upper WHERE n > 1 GROUP BY l, idx // 3, n
), steps AS (
    SELECT d.rid, a.l, coalesce(string_agg(a.h, '' ORDER BY a.idx) FILTER (a.idx < d.pos // (3 ** a.l)::BIGINT), '') AS lft,
           coalesce(string_agg(a.h, '' ORDER BY a.idx) FILTER (a.idx > d.pos // (3 ** a.l)::BIGINT), '') AS rgt
    FROM leaves d JOIN lower a ON a.source IS NOT DISTINCT FROM d.source AND a.n > 1 AND a.idx // 3 = d.pos // (3 ** (a.l + 1))::BIGINT
    GROUP BY d.rid, a.l
    UNION ALL
    SELECT d.rid, 1000 + a.l, coalesce(string_agg(a.h, '' ORDER BY a.idx) FILTER (a.idx < s.pos // (3 ** a.l)::BIGINT), ''),
           coalesce(string_agg(a.h, '' ORDER BY a.idx) FILTER (a.idx > s.pos // (3 ** a.l)::BIGINT), '')
    FROM leaves d JOIN subroots s ON s.source IS NOT DISTINCT FROM d.source
    JOIN upper a ON a.n > 1 AND a.idx // 3 = s.pos // (3 ** (a.l + 1))::BIGINT
    GROUP BY d.rid, a.l
), paths AS (
    SELECT rid, list(lft || '|' || rgt ORDER BY l) AS path, string_agg(lft || rgt, '' ORDER BY l) AS siblings FROM steps GROUP BY rid
), folded AS (
    SELECT d.doc_id, d.leaf, s.h AS subroot, (SELECT h FROM upper WHERE n = 1) AS root, sha256(coalesce(p.siblings, '')) AS proof_sha256,
           list_reduce(list_prepend(d.tampered, coalesce(p.path, [])), lambda h, x: sha256(split_part(x, '|', 1) || h || split_part(x, '|', 2))) AS folded_root
    FROM leaves d JOIN subroots s ON s.source IS NOT DISTINCT FROM d.source LEFT JOIN paths p USING (rid)
)
SELECT *, folded_root = root AS verified FROM folded
""",
    "op3_benchmark_decontamination": f"""
WITH items AS (
    SELECT item_id, t, {_GRAMS} AS grams FROM (SELECT DISTINCT item_id, text AS t, {_WORDS.format(t="text")} AS w FROM benchmark)
), docs AS (
    SELECT doc_id, t, {_GRAMS} AS grams FROM (SELECT DISTINCT doc_id, text AS t, {_WORDS.format(t="text")} AS w FROM documents)
), found AS (
    SELECT d.doc_id, d.t AS dt, i.item_id, i.t AS it, any_value(len(i.grams)) AS n_item, count(*) AS n_shared
    FROM (SELECT doc_id, t, unnest(grams) AS g FROM docs) d
    JOIN (SELECT item_id, t, grams, unnest(grams) AS g FROM items) i ON d.g = i.g
    GROUP BY d.doc_id, d.t, i.item_id, i.t
)
SELECT doc_id, item_id, n_item::BIGINT AS n_item, n_shared::BIGINT AS n_shared, n_shared / n_item AS containment
FROM found WHERE n_shared * 10 >= n_item * 8
""",
}
