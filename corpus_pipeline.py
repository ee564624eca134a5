"""The corpus pipeline: language ID, near copies, benchmark leaks, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the
next one's docs; all but the last return the columns of documents.

* ``language``: documents that the language model rejects go.
* ``near_duplicates``: documents whose five-word shingles have a Jaccard similarity of 0.8 or more are
  linked; of each component the document of least id stays.
* ``decontaminate``: documents with two or more benchmark items go; from others every benchmark passage
  is cut out.
* ``secrets``: secrets are replaced by their kind in brackets.
* ``tokens``: each document's token ids, and the text that they decode to.

Stages keep null and empty texts as their operators define: language ID rejects them, since they have no
letters. Empty tables pass through as empty tables of the same columns; extra columns are kept, and
working columns have names of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwright.llm import bpe, decontam, langid, secretscan, simhash
from skeinwright.llm.common import fresh_path, free_names, quoted, release, table
from skeinwright.llm.queries import tokenizer_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs, "text", "lang", "doc_id")
    (lid,) = free_names(docs, "lid")
    found = langid.identify(docs, model, declared="lang", host="source", out=lid)
    return found.filter(F.col(lid)["accepted"]).select(*map(quoted, docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.first_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    (leaks,) = free_names(docs, "leaks")
    found = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), out=leaks)
    return decontam.remove_spans(found.filter(F.size(F.col(leaks)["items"]) < 2), leaks=leaks).select(*map(quoted, docs.columns))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    (spans,) = free_names(docs, "secrets")
    return secretscan.redact_secrets(docs, out=spans).select(*map(quoted, docs.columns))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = tokenizer_path("word_bpe_49k.json")
    done = bpe.decode(bpe.encode(docs.select("doc_id", "text"), path), path)
    return done.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("secrets", secrets),
    ("tokens", tokens),
]

#: Trigram models, MinHash bands and automata have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:  # its successor is whole
            release(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
