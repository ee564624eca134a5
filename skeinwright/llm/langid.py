"""Language identification by Bayesian fusion of evidence.

Text likelihoods come from a naive Bayes model over hashed byte trigrams, trained here on a bounded,
documented sample of labelled rows (about ``FIT_ROWS``, in equal parts of every language that any row has; every
other count covers all rows). They are fused with
the declared markup language, the address suffix, and a prior of the host, smoothed towards its parent
domain, that towards its suffix, and that towards all rows; the prior's counts are a grouped aggregation
of every row's text-only posterior. The sum is

    log P(l | host) + text(l) + log P(declared | l) + log P(suffix | l)

where text(l) is the mean log-likelihood of all the text's trigrams times their number, or times ``evidence`` where
there are more: trigrams of a text depend on each other, so a long text weighs no more than that many independent
ones, and the other evidence keeps a say (infinity: none but the text counts in long ones). In each sum a host counts
at the levels that are its own: one of two labels is its domain, one without dots has neither domain nor suffix.
Texts are scored once: the scores are written with the rows, from which priors and fusion are read. A text is rejected if it has no letters, if a uniform model of
unknown text with its small prior beats the whole sum of every language, or if the best language's
posterior is under ``ACCEPT``.

Defined results: a null text, or one without letters, has language ``und`` and is rejected; null or
unknown declarations, addresses and hosts are no evidence. A tie goes to the language first in order.
An empty table gives no rows; a sample without labels gives a model without languages, with which all
rows are ``und``. Columns added are ``language``, ``confidence`` and ``accepted``, in one struct; a column of its
name is replaced, and all others are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, free_names, materialize, once, quoted, written
from .warc import extract_text

FIT_ROWS = 4000
BUCKETS = 1 << 15
EVIDENCE = 60.0
ACCEPT = 0.5
SMOOTH = 8.0
UNKNOWN, UNKNOWN_PRIOR = -11.0, 0.0005
DECLARED_TRUST, SUFFIX_TRUST = 0.8, 0.6
BROADCAST_ROWS = 50_000
#: The language of country suffixes, where one clearly leads (fixed values).
SUFFIXES = {"at": "de", "ar": "es", "br": "pt", "cl": "es", "cz": "cs", "de": "de", "dk": "da", "es": "es", "fi": "fi", "fr": "fr", "hu": "hu", "ie": "en", "it": "it", "jp": "ja", "kr": "ko", "mx": "es", "nl": "nl", "nz": "en", "pl": "pl", "pt": "pt", "ro": "ro", "ru": "ru", "se": "sv", "tr": "tr", "ua": "uk", "uk": "en", "us": "en"}

#: Bytes as the model sees them: letters and bytes of other characters as they are, all else a space.
_SEEN = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def trigrams(text: bytes | None) -> np.ndarray:
    """Hashed trigrams of the lower-cased text with runs of other bytes as one space; none without letters."""
    words = (text or b"").lower().translate(_SEEN).split()
    if not words:
        return np.empty(0, np.int64)
    b = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)


@dataclass
class Model:
    languages: list[str]
    #: log P(trigram | language), BUCKETS x languages
    table: np.ndarray
    #: The most trigrams that count as independent.
    evidence: float = EVIDENCE

    def score(self, text: bytes | None) -> list[float] | None:
        """Tempered log-likelihood of each language and, last, of unknown text; None without letters."""
        grams = trigrams(text)
        if not len(grams):
            return None
        weight = min(self.evidence, len(grams)) / len(grams)
        sums = np.zeros(len(self.languages), np.float64)
        for k in range(0, len(grams), 1 << 16):
            sums += self.table[grams[k : k + (1 << 16)]].sum(axis=0, dtype=np.float64)
        return [*(round(float(x), 6) for x in sums * weight), UNKNOWN * len(grams) * weight]


def fit(df: DataFrame, text: str, label: str, key: str, rows: int = FIT_ROWS, evidence: float = EVIDENCE) -> Model:
    """The model of a sample of the labelled rows: of each of n languages those of a hashed key under a bound that
    leaves ``rows`` / n of them, in expectation, or all of them where it has fewer."""
    bound_batches(df.sparkSession)
    columns = [F.lower(quoted(label)).alias("l"), F.col(quoted(text)).cast("binary").alias("t"), F.xxhash64(F.lit("fit"), quoted(key)).alias("h")]
    labelled = df.select(*columns).filter("l is not null")
    counts = {r.l: r.n for r in labelled.groupBy("l").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a language
    if not counts:
        return Model([], np.zeros((BUCKETS, 0), np.float32), evidence)
    share = rows / len(counts)
    rates = F.create_map(*[F.lit(x) for l, n in sorted(counts.items()) for x in (l, min(1.0, share / n))])
    sample = labelled.filter(F.col("h") / F.lit(2.0**64) + 0.5 <= rates[F.col("l")]).select("l", "t")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[lang] = sums.get(lang, 0) + np.bincount(trigrams(t), minlength=BUCKETS)
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.record_batch([pa.array([lang] * len(at)), pa.array(at), pa.array(n[at])], ["l", "g", "n"])

    counted = sample.mapInArrow(count, "l string, g bigint, n bigint").groupBy("l", "g").agg(F.sum("n").alias("n"))
    found: dict[str, np.ndarray] = {}
    for r in counted.collect():  # BUCKETS rows a language at most
        found.setdefault(r.l, np.zeros(BUCKETS))[r.g] = r.n
    languages = sorted(counts)
    table = np.zeros((BUCKETS, len(languages)), np.float32)
    for i, lang in enumerate(languages):
        if lang not in found:
            found[lang] = np.zeros(BUCKETS)
        table[:, i] = np.log((found[lang] + 0.1) / (found[lang].sum() + 0.1 * BUCKETS))
    return Model(languages, table, evidence)


def host_of(address: Column) -> Column:
    """The lower-case host of an address, without user, port and a leading www."""
    host = F.lower(F.regexp_extract(address, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.regexp_replace(F.when(host != "", host), r"^www\.", "")


def _levels(host: Column) -> list[Column]:
    """Its domain, the last two labels, and its suffix, the last one; null for hosts without dots."""
    return [F.when(host.contains("."), F.substring_index(host, ".", -n)) for n in (2, 1)]


def declared_markup(page: Column) -> Column:
    """The language that a page's html element declares."""
    said = F.regexp_extract(page, r"(?i)<html\b[^>]{0,2000}?\blang\s{0,9}=\s{0,9}[\"']?([A-Za-z]{1,8}(?:[-_][A-Za-z0-9]{1,8}){0,8})", 1)
    return F.when(said != "", said)


def _softmax(scores: Column) -> Column:
    top = F.array_max(scores)
    powers = F.transform(scores, lambda x: F.exp(x - top))
    total = F.aggregate(powers, F.lit(0.0), lambda a, x: a + x)
    return F.transform(powers, lambda x: x / total)


def _add(*scores: Column) -> Column:
    out = scores[0]
    for x in scores[1:]:
        out = F.zip_with(out, x, lambda a, b: a + b)
    return out


def _vote(value: Column, languages: list[str], trust: float) -> Column:
    """log P(value | language): ``trust`` that it names the language; none of ours is no evidence."""
    other = math.log((1 - trust) / max(1, len(languages) - 1))
    return F.when(
        value.isin(languages),
        F.array(*[F.when(value == x, F.lit(math.log(trust))).otherwise(F.lit(other)) for x in languages]),
    ).otherwise(F.array(*[F.lit(0.0)] * len(languages)))


def host_priors(scored: DataFrame, host: str, scores: str, languages: list[str]) -> DataFrame:
    """(host, prior) with the log-prior of each language; one row for each host, a null host included."""
    n = len(languages)
    levels = _levels(F.col("host"))
    share = _softmax(F.slice(scores, 1, n))
    known = scored.filter(F.col(scores).isNotNull())
    own = known.groupBy(F.col(host).alias("host")).agg(*[F.sum(share[i]).alias(f"n{i}") for i in range(n)])
    own = materialize(own, "hosts")
    total = own.agg(*[F.coalesce(F.sum(f"n{i}"), F.lit(0.0)).alias(f"n{i}") for i in range(n)]).head()
    whole = sum(total)
    everywhere = [(x + 1) / (whole + n) for x in total]
    keyed = own.select("*", levels[0].alias("domain"), levels[1].alias("suffix"))

    def rolled(by: str) -> DataFrame:
        sums = keyed.filter(f"{by} is not null").groupBy(F.col(by).alias(f"{by}_key"))
        return materialize(sums.agg(*[F.sum(f"n{i}").alias(f"{by}{i}") for i in range(n)]), by)

    def blend(counts: list[Column], above: list[Column]) -> list[Column]:
        size = sum(counts[1:], counts[0])
        return [(c + SMOOTH * a) / (size + SMOOTH) for c, a in zip(counts, above, strict=True)]

    for by in ("domain", "suffix"):
        up = rolled(by)
        keyed = keyed.join(up, keyed[by] == up[f"{by}_key"], "left").drop(f"{by}_key")
    cols = lambda p: [F.coalesce(F.col(f"{p}{i}"), F.lit(0.0)) for i in range(n)]
    # a host that is its own domain has no level below it
    own_n = [F.when(F.col("host").eqNullSafe(F.col("domain")), 0.0).otherwise(c) for c in cols("n")]
    prior = blend(own_n, blend(cols("domain"), blend(cols("suffix"), [F.lit(x) for x in everywhere])))
    prior = [F.when(F.col("host").isNull(), F.lit(e)).otherwise(p) for p, e in zip(prior, everywhere, strict=True)]
    return materialize(keyed.select("host", F.array(*[F.round(F.log(p), 6) for p in prior]).alias("prior")), "priors")


def score(df: DataFrame, model: Model, text: str, out: str, markup: bool = False) -> DataFrame:
    """Adds the tempered log-likelihoods of each text; of a page, with ``markup``, of its visible text."""
    bound_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages numbers

    def run(texts: pa.Array) -> pa.Array:
        own = shared.value
        shown = (extract_text(t.decode("utf-8", "replace")).encode() if markup and t else t for t in texts.to_pylist())
        return pa.array([own.score(t) for t in shown], pa.list_(pa.float64()))

    return df.withColumn(out, once(run, "array<double>")(F.col(quoted(text)).cast("binary")))


def identify(
    df: DataFrame,
    model: Model,
    text: str = "text",
    declared: str | None = None,
    address: str | None = None,
    host: str | None = None,
    out: str = "lid",
    markup: bool = False,
    keep_text: bool = True,
) -> DataFrame:
    """Adds struct<language, confidence, accepted>. ``host`` names a column with a host or source; where
    it is None, hosts are taken from ``address``. With ``markup`` texts are pages, and where ``declared`` is None
    the language is the one that they declare. Without ``keep_text`` the text column is left out."""
    languages = model.languages
    n = len(languages)
    names = [c for c in df.columns if c != out and (keep_text or c != text)]
    if not n:
        none = F.struct(F.lit("und").alias("language"), F.lit(0.0).alias("confidence"), F.lit(False).alias("accepted"))
        return df.select(*map(quoted, names), none.alias(out))
    where, ll, said, tail, prior, at, fused, post = free_names(df, "where", "ll", "said", "tail", "prior", "at", "fused", "post")
    nothing = F.lit(None).cast("string")
    url = host_of(F.col(quoted(address))) if address else nothing
    told = F.col(quoted(declared)) if declared else declared_markup(F.col(quoted(text))) if markup else nothing
    made = score(df, model, text, ll, markup).select(
        *map(quoted, names),
        ll,
        (F.lower(quoted(host)) if host else url).alias(where),
        F.lower(F.substring_index(F.regexp_replace(F.trim(told), "_", "-"), "-", 1)).alias(said),
        F.when(url.contains("."), F.substring_index(url, ".", -1)).alias(tail),
    )
    both, _ = written(made, "scores")
    priors = host_priors(both.select(where, ll), where, ll, languages).select(F.col("host").alias(at), F.col("prior").alias(prior))
    if priors.count() <= BROADCAST_ROWS:  # else the rows are joined by shuffle
        priors = F.broadcast(priors)
    both = both.join(priors, F.col(where).eqNullSafe(F.col(at)), "left")
    none = F.array(*[F.lit(-math.log(n))] * n)
    by_suffix = F.create_map(*[F.lit(x) for kv in SUFFIXES.items() for x in kv])[F.col(tail)]
    total = _add(
        F.coalesce(F.col(prior), none),
        F.slice(ll, 1, n),
        _vote(F.col(said), languages, DECLARED_TRUST),
        _vote(by_suffix, languages, SUFFIX_TRUST),
    )
    both = both.withColumn(fused, F.when(F.col(ll).isNotNull(), total))
    unknown = F.element_at(ll, n + 1) + F.lit(math.log(UNKNOWN_PRIOR)) > F.array_max(fused)
    both = both.withColumn(post, F.when(F.col(fused).isNotNull(), _softmax(F.col(fused))))
    best = F.array_max(post)
    named = F.element_at(F.array(*[F.lit(x) for x in languages]), F.array_position(post, best).cast("int"))
    usable = F.col(ll).isNotNull() & ~unknown
    result = F.struct(
        F.when(usable, named).otherwise(F.lit("und")).alias("language"),
        F.when(usable, F.round(best, 6)).otherwise(F.lit(0.0)).alias("confidence"),
        F.coalesce(usable & (best >= ACCEPT), F.lit(False)).alias("accepted"),
    )
    return both.select(*map(quoted, names), result.alias(out))
