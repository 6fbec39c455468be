"""The registered queries of this subpackage, thin over its operators, and the
DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (byte_bpe, conversation, decontaminate, embedding_dedup, exact_dedup, language_id, mixing, simhash, spelling,
                         suffix_dedup, toxicity, url_filter, warc)
from tessera.llm.common import scratch, table, text_or_empty

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

TOKENIZER = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


@register("op1_warc")
def op1_warc(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch(spark, "warc-archives")
    files = warc.write_archives(table(spark, sf, "pages").select("page_id", "url", "html"), folder)
    found = warc.resolve_revisits(warc.read_archives(files, folder))
    return found.select(F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                        F.col("refers_to").cast("long").alias("refers_to"))


ORACLE["op1_warc"] = """
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS d, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY d, n) AS first FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""


@register("op2_suffix_dedup")
def op2_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = suffix_dedup.suffix_dedup(table(spark, sf, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register("op3_byte_bpe")
def op3_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    ids = byte_bpe.encode(docs, TOKENIZER, PATTERN)
    both = byte_bpe.decode(ids, TOKENIZER, carry=("doc_id", "ids"))
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op4_simhash")
def op4_simhash(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = simhash.simhash_components(docs, shingle=4, distance=4)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


@register("op5_embeddings")
def op5_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    found = embedding_dedup.embedding_components(table(spark, sf, "embeddings").select("vec_id", "embedding"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")


RULES = tuple(url_filter.rule(text, verdict) for text, verdict in (
    ("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")))


_TWO_LABELS = ", ".join(f"'{x}'" for x in url_filter.TWO_LABEL_SUFFIXES)
_RULES_SQL = " ".join(
    f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.name}'"
    for r in sorted(RULES, key=lambda r: (len(r.name), r.name), reverse=True))
_VERDICT_SQL = " ".join(f"WHEN '{r.name}' THEN '{r.verdict}'" for r in RULES)


def _strength_sql(level: str) -> str:
    """The moment estimate of a prior's strength from a table of (n, k, prior)."""
    share = ("sum((k - n * prior) ** 2 - n * prior * (1 - prior)) / nullif(sum(n * (n - 1) * prior * (1 - prior)), 0)")
    low, high = url_filter.WEAKEST, url_filter.STRONGEST
    return f"(SELECT CASE WHEN {share} > 0 THEN least({high}, greatest({low}, 1 / ({share}) - 1)) ELSE {high} END FROM {level})"


@register("op6_url_filter", f"""
WITH rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
seen AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{url_filter.UPPER}', '{url_filter.UPPER.lower()}') AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
bad AS (SELECT doc_id AS id, max(bad) AS bad FROM (
  SELECT doc_id, greatest(CAST(toxic > 0 AS INTEGER), CAST(quality <= 0 AS INTEGER)) AS bad FROM labels)
  WHERE doc_id IS NOT NULL AND bad IS NOT NULL GROUP BY 1),
h0 AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS k FROM seen LEFT JOIN bad ON page_id = id WHERE host <> '' GROUP BY 1),
h1 AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS bare FROM h0),
h2 AS (SELECT *, string_split(bare, '.') AS parts, regexp_matches(bare, '^[0-9.]+$|^\\[') AS numeric FROM h1),
h3 AS (SELECT host, n, k, numeric, CASE WHEN numeric THEN bare
              WHEN array_to_string(parts[-2:], '.') IN ({_TWO_LABELS}) THEN array_to_string(parts[-3:], '.')
              ELSE array_to_string(parts[-2:], '.') END AS domain FROM h2),
h AS (SELECT host, n, k, domain, CASE WHEN numeric THEN '' WHEN contains(domain, '.') THEN substr(domain, strpos(domain, '.') + 1)
                                 ELSE domain END AS suffix FROM h3),
d0 AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM h GROUP BY 1, 2),
s AS (SELECT suffix, sum(n) AS n, sum(k) AS k, (SELECT (sum(k) + 0.5) / (sum(n) + 1.0) FROM d0) AS prior FROM d0 GROUP BY 1),
d AS (SELECT d0.*, (s.k - d0.k + {_strength_sql('s')} * s.prior) / (s.n - d0.n + {_strength_sql('s')}) AS prior FROM d0 JOIN s USING (suffix)),
hp AS (SELECT h.host, h.n, h.k, (d.k - h.k + {_strength_sql('d')} * d.prior) / (d.n - h.n + {_strength_sql('d')}) AS prior
       FROM h JOIN d USING (domain)),
rated AS (SELECT host, n, {_strength_sql('hp')} AS w, (k + {_strength_sql('hp')} * prior) / (n + {_strength_sql('hp')}) AS rate FROM hp),
ruled AS (SELECT page_id, host, path, CASE {_RULES_SQL} END AS rule FROM seen)
SELECT page_id, ruled.host, path, rule, coalesce(CASE rule {_VERDICT_SQL} END,
       CASE WHEN rate - {url_filter.Z} * sqrt(rate * (1 - rate) / (n + w + 1)) > {url_filter.BLOCK_ABOVE} THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN rated ON ruled.host = rated.host
""")
def op6_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    pages, labels = table(spark, sf, "pages").select("page_id", "url"), table(spark, sf, "labels")
    found = url_filter.judge(pages, labels, RULES)
    return found.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


@register("op7_mixing", r"""
WITH sized AS (
  SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w, source_size * 3 AS cap FROM per),
leveled AS (
  SELECT *, row_number() OVER o AS pos,
         CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0) AS DOUBLE)
           / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level
  FROM ranked
  WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / w, source NULLS LAST),
         b AS (ORDER BY CAST(cap AS DOUBLE) / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
         least(CAST(cap AS DOUBLE), coalesce((SELECT arg_min(level, pos) FROM leveled WHERE cap >= level * w) * w, cap)) AS target
  FROM leveled),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.size ROWS UNBOUNDED PRECEDING) - s.size / 2.0 AS middle,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST((epochs + CASE WHEN source_size > 0 AND middle < target - epochs * source_size THEN 1 ELSE 0 END) AS BIGINT)
         * size AS taken
FROM placed
""")
def op7_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    return mixing.mix_sources(docs).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@register("op8_language")
def op8_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = language_id.learn(docs.where(~language_id.held_out()).select("doc_id", "text", "lang"))
    rows = docs.select("doc_id", language_id.held_out().alias("held_out"), "text")
    return language_id.identify(rows, model, carry=("doc_id", "held_out"))


@register("op9_exact_dedup", """
SELECT doc_id, max(doc_id) OVER t AS keep_id, CAST(count(*) OVER t AS BIGINT) AS group_size,
       doc_id = max(doc_id) OVER t AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW t AS (PARTITION BY coalesce(text, ''))
""")
def op9_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = exact_dedup.exact_dedup(docs, extra={"text_sha256": F.sha2(text_or_empty("text").cast("binary"), 256)})
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


@register("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf, "labels")))


@register("op11_spelling")
def op11_spelling(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf, "documents").select("doc_id", "text"))


@register("op12_conversation")
def op12_conversation(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations")
    return conversation.repair_conversations(conversation.damaged(rows), rows)


@register("op13_decontaminate", r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item, w, least(len(w), 10) AS size, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS pos FROM b WHERE len(w) > 0),
iw AS (SELECT DISTINCT coalesce(item, '') AS item, size, array_to_string(w[pos:pos + size - 1], ' ') AS passage FROM bw),
sizes AS (SELECT DISTINCT size FROM iw),
dw AS (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS pos FROM d, sizes WHERE len(w) >= size),
hit AS (SELECT r, pos, size, item FROM (SELECT r, pos, size, array_to_string(w[pos:pos + size - 1], ' ') AS passage FROM dw) JOIN iw USING (size, passage)),
per AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY r),
cov AS (SELECT r, count(DISTINCT covered) AS n_hit FROM (SELECT r, unnest(range(pos, pos + size)) AS covered FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN per USING (r) LEFT JOIN cov USING (r)
""")
def op13_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")
