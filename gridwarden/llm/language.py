"""Language identification by Bayesian fusion of what a text, its markup, its address and its host say.

- Text: naive Bayes over hashed byte trigrams of every language that occurs, fitted on a bounded sample of documents with
  a known language (about `SAMPLE` of each at most, chosen by id hash). A whole text counts; its evidence is tempered, since
  neighbouring trigrams aren't independent.
- Markup: P(declared | language), counted over all items from their text posteriors.
- Address suffix: P(suffix | language), counted alike.
- Host: P(language | host), smoothed towards its domain's, and that towards all items'. An item's own posterior is
  taken out of its host's and domain's counts before they judge it.

All counts are grouped aggregations with partial sums; only numbers per language reach the driver, the likelihoods of
trigrams among them (512 KB a language).

Defined cases: null or empty texts have no text evidence; items without a host, a suffix or a declared language lack
that evidence only; declared languages that were never learned count as `other`; without any known language the answer
is null with probability 0; repeated rows repeat; an empty table gives no rows; ties go to the first language by name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwarden.llm.common import is_small, stored, table
from gridwarden.llm.hashing import BASE
from gridwarden.operators.joins import spread_join

SAMPLE = 500
BUCKETS = 1 << 16
TEMPER = 0.1
#: Pseudo-counts towards the wider level, and towards evenness in confusion counts.
HOST_WEIGHT, EVEN_WEIGHT = 5.0, 1.0
PIECE = 1 << 20
#: Languages whose counts a task holds at once (512 KB each), and buckets that travel to the driver in a row.
HELD_LANGUAGES, ROW_BUCKETS = 64, 4096


def trigram_counts(text: str | None) -> np.ndarray:
    """How often each bucket's byte trigrams occur in a lower-cased text."""
    data, counts = (text or "").lower().encode(), np.zeros(BUCKETS, np.int64)
    for at in range(0, max(len(data) - 2, 0), PIECE):
        raw = np.frombuffer(data[at : at + PIECE + 2], np.uint8).astype(np.uint64)
        grams = (raw[:-2] << np.uint64(16)) | (raw[1:-1] << np.uint64(8)) | raw[2:]
        counts += np.bincount(((grams * np.uint64(BASE)) >> np.uint64(48)).astype(np.int64), minlength=BUCKETS)
    return counts


def trigram_sums(texts: DataFrame) -> DataFrame:
    """(lang, buckets, counts): how often the texts of a language hold each bucket's trigrams; some buckets to a row."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def flushed() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                used = np.flatnonzero(counts)
                columns = [pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(counts[used], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if lang not in held and len(held) == HELD_LANGUAGES:
                    yield from flushed()
                held[lang] = held.get(lang, 0) + trigram_counts(text)
        yield from flushed()

    parts = texts.select("lang", "text").mapInArrow(counted, "lang string, bucket int, n long")
    summed = parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    rows = summed.groupBy("lang", F.floor(F.col("bucket") / ROW_BUCKETS).alias("row"))
    held = rows.agg(F.collect_list(F.struct("bucket", "n")).alias("held"))
    return held.select("lang", F.col("held.bucket").alias("buckets"), F.col("held.n").alias("counts"))


def fitted(docs: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """The known languages, and the log likelihood of each bucket in each, from a bounded sample."""
    known = docs.where("lang is not null and text is not null")
    counts = known.groupBy("lang").count().collect()
    languages = sorted(row["lang"] for row in counts)
    shares = [(row["lang"], min(1.0, sample / row["count"])) for row in counts]
    shares = F.broadcast(docs.sparkSession.createDataFrame(shares, "lang string, share double"))  # a row per language
    chosen = known.select("doc_id", "lang", "text").join(shares, "lang")
    chosen = chosen.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.col("share") * (1 << 20))
    number = {language: i for i, language in enumerate(languages)}
    seen = np.zeros((len(languages), BUCKETS), np.int64)
    for row in trigram_sums(chosen).toLocalIterator():
        seen[number[row["lang"]], row["buckets"]] = row["counts"]
    table_of = np.empty((BUCKETS, len(languages)), np.float32)
    for i, own in enumerate(seen):
        own = own + 0.5
        table_of[:, i] = np.log(own / own.sum())
    return languages, table_of


def with_text_evidence(items: DataFrame, languages: list[str], table_of: np.ndarray) -> DataFrame:
    """The items with `evidence`, a tempered log likelihood per language, instead of their text."""
    shared = items.sparkSession.sparkContext.broadcast(table_of)
    kept = [f for f in items.schema if f.name != "text"]
    names, fields = [f.name for f in kept], ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    n = len(languages)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        likelihood = shared.value
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                counts = trigram_counts(text.as_py())
                used = np.flatnonzero(counts)
                evidence = TEMPER * (counts[used] @ likelihood[used]) if len(used) else np.zeros(n)
                rows.append((evidence - evidence.max(initial=-np.inf) if n else evidence).tolist())
            columns = {name: batch.column(name) for name in names}
            columns["evidence"] = pa.array(rows, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_pydict(columns)

    return items.mapInArrow(judged, f"{fields}, evidence array<double>")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body of the value, which is computed once, and not again for each element that the body's functions visit."""
    return F.element_at(F.transform(F.array(value), body), 1)


def posterior(evidence: Column) -> Column:
    """Log evidence per language as probabilities."""
    powers = let(evidence, lambda own: let(F.array_max(own), lambda top: F.transform(own, lambda e: F.exp(e - top))))
    return let(powers, lambda own: let(total(own), lambda whole: F.transform(own, lambda p: p / whole)))


def sums(rows: DataFrame, key: str, n: int, name: str) -> DataFrame:
    """The summed posteriors of each key's rows."""
    grouped = rows.where(F.col(key).isNotNull()).groupBy(key)
    return grouped.agg(F.array(*[F.sum(F.col("p")[i]) for i in range(n)]).alias(name))


def joined(rows: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    """The rows with their key's counts; missing keys are dealt over tasks, and AQE can split a hot one."""
    if is_small(counts, 100_000):
        return rows.join(F.broadcast(counts), key, "left")
    return spread_join(rows, counts.withColumnRenamed(key, "key__"), key, "key__", "evidence")


def plus(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: a + b)


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


def identify(items: DataFrame, languages: list[str], table_of: np.ndarray) -> DataFrame:
    """Items (text, declared, suffix, domain, host) with `language`, `probability` and `text_language`."""
    n = len(languages)
    if n == 0:
        none = [F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("probability"), F.lit(None).cast("string").alias("text_language")]
        return items.select(*[c for c in items.columns if c != "text"], *none)
    known = F.when(F.col("declared").isin(*languages) | F.col("declared").isNull(), F.col("declared")).otherwise("other")
    rows = with_text_evidence(items.withColumn("declared", known), languages, table_of)
    rows = stored(rows.withColumn("p", posterior(F.col("evidence"))), "evidence")
    every = rows.agg(*[F.sum(F.col("p")[i]) for i in range(n)]).first()
    mass = [value or 0.0 for value in every]
    prior = F.array(*[F.lit((m + EVEN_WEIGHT) / (sum(mass) + n * EVEN_WEIGHT)) for m in mass])
    none = F.array(*[F.lit(0.0)] * n)
    for key in ("host", "domain", "declared", "suffix"):
        rows = joined(rows, sums(rows.select(key, "p"), key, n, f"{key}_counts"), key)

    def others(counts: str) -> Column:
        """Counts of the other items with the same key."""
        own = F.zip_with(counts, "p", lambda c, p: F.greatest(c - p, F.lit(0.0)))
        return F.coalesce(own, none)

    def smoothed(counts: Column, wider: Column) -> Column:
        share = lambda own, whole: F.zip_with(own, wider, lambda c, w: (c + HOST_WEIGHT * w) / (whole + HOST_WEIGHT))
        return let(counts, lambda own: let(total(own), lambda whole: share(own, whole)))

    def likelihood(counts: str) -> Column:
        """Log P(value | language); nothing where the item lacks the value."""
        of_language = F.array(*[F.lit(m) for m in mass])
        even = F.zip_with(counts, of_language, lambda c, m: F.ln((c + EVEN_WEIGHT) / (m + 2 * EVEN_WEIGHT)))
        return F.coalesce(even, none)

    rows = rows.withColumn("domain_prior", smoothed(others("domain_counts"), prior))
    rows = rows.withColumn("host_prior", smoothed(others("host_counts"), F.col("domain_prior")))
    fused = plus(F.col("evidence"), F.transform("host_prior", lambda p: F.ln(p)))
    fused = plus(plus(fused, likelihood("declared_counts")), likelihood("suffix_counts"))
    rows = rows.withColumn("fused", posterior(fused))
    name = F.array(*[F.lit(language) for language in languages])
    best = lambda p: name[(F.array_position(p, F.array_max(p)) - 1).cast("int")]
    out = [c for c in items.columns if c != "text"]
    text_language = F.when(F.array_max("evidence") > F.array_min("evidence"), best(F.col("p")))
    return rows.select(*out, best(F.col("fused")).alias("language"), F.array_max("fused").alias("probability"), text_language.alias("text_language"))


def items_of(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """Documents, whose source is their host, and pages, which declare a language and have an address."""
    none = F.lit(None).cast("string")
    host = F.lower(F.regexp_extract(F.col("url"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    bare = F.regexp_replace(F.col("html"), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    declared = F.lower(F.regexp_extract(F.col("html"), r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", 1))
    blank = lambda c: F.when(c != "", c)
    labels = F.split(F.col("host"), r"\.")
    from_pages = pages.select(
        F.lit("page").alias("kind"), F.lit(None).cast("long").alias("doc_id"), "page_id", bare.alias("text"), blank(declared).alias("declared"), blank(host).alias("host")
    )
    from_pages = from_pages.withColumn("suffix", F.element_at(labels, -1)).withColumn(
        "domain", F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), ".")
    )
    from_docs = docs.select(
        F.lit("document").alias("kind"), "doc_id", F.lit(None).cast("long").alias("page_id"), "text", none.alias("declared"), F.col("source").alias("host"), none.alias("suffix"), none.alias("domain")
    )
    return from_docs.unionByName(from_pages)


def language_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    found = identify(items_of(docs, pages), *fitted(docs.select("doc_id", "lang", "text")))
    return found.select("kind", "doc_id", "page_id", "language", F.round("probability", 6).alias("probability"), "text_language", "declared")


