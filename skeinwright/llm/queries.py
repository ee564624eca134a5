"""The queries opN_<name>: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audio, bpe, decontam, langid, secretscan, sharding, simhash, surrogates, tokenstore, warc
from .common import materialize, table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_audio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    raw = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    # the stored form is written to the shared folder, and all that follows comes from the bytes read back
    stored = materialize(audio.media_table(docs.withColumn("n_bytes", raw)).drop("text"), "media")
    done = audio.audio_features(stored)
    samples = audio.wav_payload(F.col("media"))
    return done.select(
        "doc_id",
        "n_bytes",
        F.octet_length(samples).cast("long").alias("payload_bytes"),
        F.sha2(samples, 256).alias("payload_sha256"),
        F.crc32(F.substring(samples, -64, 64)).cast("long").alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.concat_ws(":", F.col("features.n_frames").cast("string"), F.size("features.segments").cast("string"), F.sha2("features.tensors", 256)).alias("feature"),
    )


def op2_stratified_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.interleave(table(spark, sf_dir, "documents"), shards=40)
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")


def op3_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("word_bpe_49k.json")
    ids = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return bpe.decode(ids.drop("text"), path).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = tokenstore.token_store(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").cast("long").alias("ids_crc32"))


def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    # the derived records are written to the shared folder; digests are those of the records read back
    made = materialize(warc.derive(warc.responses(pages).select("page_id", "response")), "derivatives")
    return made.select("page_id", "derived.*").withColumn("record_sha256", F.sha2("record", 256)).drop("record")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages, whose addresses, hosts and markup are evidence beside their texts; trained on labelled documents."""
    model = langid.fit(table(spark, sf_dir, "documents"), "text", "lang", "doc_id")
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = langid.identify(pages, model, text="html", address="url", markup=True, keep_text=False)
    return found.select("page_id", "lid.language", "lid.confidence", "lid.accepted")


def op8_fm_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    items = F.size("leaks.items")
    return found.select(
        "doc_id",
        "leaks.n_words",
        "leaks.n_hit",
        items.cast("long").alias("n_items"),
        F.sha2(F.array_join("leaks.items", ","), 256).alias("items_sha256"),
        (items >= 2).alias("contaminated"),
        F.array_join(F.transform("leaks.word_spans", lambda x: F.concat_ws("-", x["start"].cast("string"), x["end"].cast("string"))), ",").alias("word_spans"),
    )


def op9_secret_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secretscan.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("secrets", lambda s: s["kind"].isin(*secretscan.BASE))
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in secretscan.BASE],
        F.sha2(shown(base), 256).alias("base_sha256"),
        shown(F.col("secrets")).alias("spans"),
    )


def op10_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = surrogates.pseudonymize(docs, key="skeinwright-demo-key")
    return done.select("doc_id", F.size("pii").cast("long").alias("n_entities"), F.array_join("pii", ",").alias("kinds"), "text")


def queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_audio_features,
            op2_stratified_interleave,
            op3_simhash_bktree,
            op4_word_bpe,
            op5_token_files,
            op6_warc_derivatives,
            op7_language_id,
            op8_fm_decontaminate,
            op9_secret_automaton,
            op10_pii_surrogates,
        )
    }


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP8_SQL = f"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
iw AS (SELECT DISTINCT item, n, array_to_string(w[p : p + n - 1], ' ') AS k FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM (SELECT *, least({decontam.WINDOW}, len(w)) AS n FROM b WHERE len(w) > 0))),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
dw AS (SELECT doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') AS k FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM iw))),
h AS (SELECT doc_id, n, p, item FROM dw JOIN iw USING (n, k)),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h WHERE item IS NOT NULL) GROUP BY doc_id),
c AS (SELECT DISTINCT doc_id, p - 1 + o AS q FROM (SELECT doc_id, p, unnest(range(n)) AS o FROM h)),
r AS (SELECT doc_id, min(q) AS a, max(q) + 1 AS z, count(*) AS n FROM (SELECT doc_id, q, q - row_number() OVER (PARTITION BY doc_id ORDER BY q) AS g FROM c) GROUP BY doc_id, g),
s AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_hit, string_agg(a || '-' || z, ',' ORDER BY a) AS word_spans FROM r GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated, coalesce(word_spans, '') AS word_spans
FROM d LEFT JOIN i USING (doc_id) LEFT JOIN s USING (doc_id)
"""


def _either_case(pattern: str) -> str:
    """Each letter outside of classes and escapes in both ASCII cases."""
    return re.sub(r"\\x..|\\.|\[[^]]*\]|[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]" if len(m[0]) == 1 else m[0], pattern)


def _op9_sql() -> str:
    parts = []
    for k, rule in enumerate(secretscan.RULES):
        pattern = rule.pattern.replace("{16,}", "+")
        pattern = (_either_case(pattern) if rule.any_case else pattern).replace("'", "''")
        size = f"length(regexp_extract(m, '{pattern}', 2))" if rule.value else "length(m)"
        parts.append(
            f"SELECT doc_id, {k} AS k, '{rule.kind}' AS kind, a, a + length(m) AS z FROM (SELECT *, sum(length(g)) OVER o + coalesce(sum(length(m)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM"
            f" (SELECT doc_id, unnest(string_split_regex(t, '{pattern}')) AS g, unnest(regexp_extract_all(t, '{pattern}')) AS m, unnest(range(len(string_split_regex(t, '{pattern}')))) AS i FROM d) WINDOW o AS (PARTITION BY doc_id ORDER BY i)) WHERE m IS NOT NULL AND {size} >= {rule.least}"
        )
    shown = "kind || ':' || CAST(a AS BIGINT) || ':' || CAST(z AS BIGINT)"
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in secretscan.BASE)
    base = f"kind IN ({', '.join(repr(k) for k in secretscan.BASE)})"
    return (
        f"WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), m AS ({' UNION ALL '.join(parts)})"
        f" SELECT doc_id, {counts}, sha256(coalesce(string_agg({shown}, ',' ORDER BY a, k) FILTER ({base}), '')) AS base_sha256, coalesce(string_agg({shown}, ',' ORDER BY a, k), '') AS spans FROM d LEFT JOIN m USING (doc_id) GROUP BY doc_id"
    )


def oracle_sql() -> dict[str, str]:
    """The two whose results SQL can express on whole tables; tests hold the others against plain code."""
    return {"op8_fm_decontaminate": OP8_SQL, "op9_secret_automaton": _op9_sql()}
