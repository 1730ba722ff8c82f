"""Benchmark decontamination: test n-grams as a broadcast hash set, scanned over all word windows of the documents.

Items and documents are lower-cased (A-Z) and cut into words. A window is `N` consecutive words of an item, or all
words of a shorter item. Every window of a document is hashed; its hash is looked up in the broadcast windows and each
match is verified word by word. A document's hit words are the union of its matched windows.

Only the windows' hashes are broadcast, eight bytes each however long the words are, and one scan looks up windows of
all lengths. The windows whose hash is found are written to the shared folder with their words, so that a lost executor
doesn't repeat the scan, and joined to the benchmark's windows by hash and words. The hashes are counted first: up to
`BROADCAST_HASHES` are broadcast at once; more are cut into parts of that size, with a scan of the documents for each.

Everything is DataFrame functions. The scan also leaves a row per document with its number of words.

Defined cases: null or wordless texts have no words and no hits; items without words have no window; an item with a
null id marks words but isn't listed; a repeated item_id counts once; documents repeated with the same id and text each
get the same answer; null doc_ids are matched with each other; an empty benchmark or an empty table of documents
gives no hits; other columns, whatever their names, are kept where documents are returned and never read. A text is
one row of one task, at some 40 bytes a word; its hits are merged by running maxima, in proportion to their number.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridwarden.llm.common import BETWEEN, CASED_WORD, ascii_lower, is_small, stored, table, with_words

N = 10
#: Broadcast at most so many hashes at once; Spark's table of them takes some 60 bytes each.
BROADCAST_HASHES = 2_000_000


def hashes_of(words: Column) -> Column:
    """A hash per word. It lower-cases more than A-Z, so unequal words may share one; matches are compared in full."""
    return F.transform(words, lambda word: F.xxhash64(F.lower(word)))


def window_hashes(hashes: Column, n: int) -> Column:
    """The hash of each run of n words; none if there are fewer."""
    begins = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - n + 1, F.lit(0)))
    return F.transform(begins, lambda first, i: F.xxhash64(first, *[F.get(hashes, i + k) for k in range(1, n)]))


def window_text(words: Column, at: Column, length: Column) -> Column:
    """Lower-cased words with blanks between. No lambda: those would keep the join out of generated code."""
    return ascii_lower(F.array_join(F.slice(words, at, length), " "))


def benchmark_windows(benchmark: DataFrame, n: int = N) -> DataFrame:
    """(item_id, window, length, hash) for every window of every item, without repetitions."""
    words = with_words(benchmark, "item_id").where(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(n))
    placed = words.select("item_id", "words", length.alias("length"), F.explode(F.sequence(F.lit(1), F.size("words") - length + 1)).alias("at"))
    text = window_text(F.col("words"), F.col("at"), F.col("length"))
    # an array's hash is that of its elements in turn, as in window_hashes
    hashed = F.xxhash64(hashes_of(F.slice("words", F.col("at"), F.col("length"))))
    return placed.select("item_id", text.alias("window"), "length", hashed.alias("hash")).distinct()


def row_key() -> Column:
    """Rows with the same id and text have the same key."""
    return F.struct(F.col("doc_id").alias("doc_id"), F.xxhash64(F.col("text")).alias("text"))


def all_window_hashes(hashes: Column, lengths: list[int]) -> Column:
    """The hashes of the windows of every length, one length after another."""
    return F.concat(*[window_hashes(hashes, n) for n in lengths]) if lengths else F.array().cast("array<bigint>")


def place_of(place: Column, n_words: Column, lengths: list[int]) -> tuple[Column, Column]:
    """Where the window at a place of `all_window_hashes` begins, and its length."""
    begin, length, before = place, F.lit(lengths[-1] if lengths else 0), F.lit(0)
    bounds = []
    for n in lengths[:-1]:
        after = before + F.greatest(n_words - n + 1, F.lit(0))
        bounds.append((n, before, after))
        before = after
    begin = place - before
    for n, low, high in reversed(bounds):
        begin = F.when(place < high, place - low).otherwise(begin)
        length = F.when(place < high, F.lit(n)).otherwise(length)
    return begin, length


def scanned(docs: DataFrame, windows: DataFrame, bound: int = BROADCAST_HASHES) -> DataFrame:
    """(key, n_words, first, at, length, hash, window) from the documents' words.

    Each row of `docs` gives one row that is `first`; each window whose hash is one of the benchmark's gives a row with
    its place, hash and words, null in other rows.
    """
    lengths = sorted(row["length"] for row in windows.select("length").distinct().collect())  # N at most
    known = windows.select(F.col("hash").alias("known")).distinct()
    parts = max(1, math.ceil(known.count() / bound))
    words = with_words(docs.select(row_key().alias("key"), "text"), "key")
    words = words.withColumn("hashes", hashes_of(F.col("words")))
    # hashes are a column of their own, so that generator and join run in one generated loop; the outer generator
    # keeps the optimizer from testing their number below, which would compute them twice
    hashed = words.select("key", "words", all_window_hashes(F.col("hashes"), lengths).alias("windows"))
    placed = hashed.select("key", "words", F.posexplode_outer("windows").alias("place", "hash"))
    found = None
    for part in range(parts):
        own = F.broadcast(known.where(F.pmod("known", F.lit(parts)) == part))
        first = F.coalesce(F.col("place"), F.lit(0)) == 0 if part == 0 else F.lit(False)
        looked_up = placed.join(own, placed["hash"] == own["known"], "left").where(F.col("known").isNotNull() | first)
        begin, length = place_of(F.col("place"), F.size("words"), lengths)
        hit = lambda value: F.when(F.col("known").isNotNull(), value)
        rows = looked_up.select(
            "key",
            F.size("words").cast("long").alias("n_words"),
            first.alias("first"),
            hit(begin).alias("at"),
            hit(length).alias("length"),
            F.col("known").alias("hash"),
            hit(window_text(F.col("words"), begin + 1, length)).alias("window"),
        )
        found = rows if found is None else found.unionByName(rows)
    return found


def verified(found: DataFrame, windows: DataFrame) -> DataFrame:
    """(key, at, length, hash, window) of the scan's rows whose words are those of a window of the benchmark.

    Both sides should be stored tables: so the join's shuffles are its own, and AQE can split a passage that a third of
    all documents hold.
    """
    hits = found.where("hash is not null").select("key", "at", "length", "hash", "window")
    return hits.join(windows, ["hash", "window"], "left_semi").select("key", "at", "length", "hash", "window")


def merged_spans(hits: DataFrame) -> DataFrame:
    """(key, spans): each key's hits as disjoint (begin, end) spans in order; hits that touch become one."""
    in_order = Window.partitionBy("key").orderBy("at")
    placed = hits.select("key", "at", (F.col("at") + F.col("length")).alias("end"))
    reached = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    opens = placed.withColumn("opens", (reached.isNull() | (F.col("at") > reached)).cast("long"))
    numbered = opens.withColumn("span", F.sum("opens").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = numbered.groupBy("key", "span").agg(F.min("at").alias("begin"), F.max("end").alias("end"))
    return spans.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("spans"))


def hits_of(found: DataFrame, windows: DataFrame) -> DataFrame:
    """(hit_key, spans, items) for each key with hits: spans of hit words, ids of the items that hit them."""
    hits = stored(verified(found, windows), "matches")
    named = windows.where("item_id is not null").select("hash", "window", F.col("item_id").cast("string").alias("item_id")).distinct()
    pairs = hits.select("key", "hash", "window").distinct().join(named, ["hash", "window"]).select("key", "item_id").distinct()
    items = pairs.groupBy("key").agg(F.sort_array(F.collect_list("item_id")).alias("items"))
    return merged_spans(hits).join(items, "key", "left").withColumnRenamed("key", "hit_key")


def scan(docs: DataFrame, benchmark: DataFrame, n: int = N, bound: int = BROADCAST_HASHES) -> tuple[DataFrame, DataFrame]:
    """The stored rows of `scanned` and the benchmark's stored windows."""
    windows = stored(benchmark_windows(benchmark, n), "windows")
    return stored(scanned(docs, windows, bound), "scanned"), windows


def hit_rows(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """(hit_key, spans, items) of the documents with hits."""
    return hits_of(*scan(docs, benchmark, n))


def with_hits(keyed: DataFrame, found: DataFrame) -> DataFrame:
    """Rows that hold `row_key__` with `spans` and `items`; null where there are none."""
    joined = keyed.join(found, F.col("row_key__").eqNullSafe(F.col("hit_key")), "left")
    return joined.drop("row_key__", "hit_key")


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """The documents with `spans` of hit words and the ids of the `items` that hit them; null where there are none.

    Columns of these names are replaced.
    """
    kept = docs.drop("spans", "items")
    return with_hits(kept.withColumn("row_key__", row_key()), hit_rows(docs, benchmark, n))


def without_spans(text: Column, spans: Column) -> Column:
    """The text without its hit words and the signs that follow each of them."""
    lead = F.regexp_extract(text, f"^{BETWEEN}*", 0)
    pieces = F.regexp_extract_all(text, F.lit(f"{CASED_WORD}{BETWEEN}*"), F.lit(0))
    begins = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(F.transform(spans, lambda s: s["begin"]), F.array(F.size(pieces)))
    kept = F.zip_with(begins, ends, lambda b, e: F.array_join(F.slice(pieces, b + 1, e - b), ""))
    return F.concat(lead, F.array_join(kept, ""))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", n: int = N) -> DataFrame:
    """The documents without contaminated ones, or with `remove="spans"` without the hit words."""
    columns = docs.columns
    keyed = docs.withColumn("row_key__", row_key())
    if remove == "documents":  # only the keys of contaminated documents travel, if few to every task
        keys = stored(verified(*scan(docs, benchmark, n)).select(F.col("key").alias("hit_key")).distinct(), "hits")
        keys = F.broadcast(keys) if is_small(keys) else keys
        return keyed.join(keys, F.col("row_key__").eqNullSafe(F.col("hit_key")), "left_anti").select(columns)
    found = hit_rows(docs, benchmark, n).select("hit_key", F.col("spans").alias("spans__"))
    judged = with_hits(keyed, found)
    if remove != "spans":
        raise ValueError("remove is 'documents' or 'spans'")
    cut = without_spans(F.col("text"), F.col("spans__"))
    cleaned = F.when(F.col("spans__").isNull(), F.col("text")).otherwise(cut)
    return judged.withColumn("text", cleaned).select(columns)


def decontamination_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, windows = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    documents = found.where("first").select(F.col("key.doc_id").alias("doc_id"), "n_words", F.col("key").alias("row_key__"))
    judged = with_hits(documents, hits_of(found, windows))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    items = F.coalesce("items", F.array().cast("array<string>"))
    return judged.select(
        "doc_id",
        "n_words",
        F.coalesce(n_hit, F.lit(0).cast("long")).alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        F.col("spans").isNotNull().alias("contaminated"),
    )


ORACLE = r"""
with d as (
  select doc_id, text, row_number() over () as r, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from documents
), b as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from benchmark
), w as (
  select distinct item_id, words[i:i + least(10, len(words)) - 1] as win
  from (select item_id, words, unnest(range(1, len(words) - least(10, len(words)) + 2)) as i from b where len(words) > 0)
), p as (
  select r, i, k, words[i:i + k - 1] as win
  from (select r, words, k, unnest(range(1, len(words) - k + 2)) as i
        from d, (select distinct len(win) as k from w) where len(words) >= k)
), hit as (
  select distinct r, i, k, item_id from p join w using (win)
), covered as (
  select r, count(distinct place) as n_hit from (select r, unnest(range(i, i + k)) as place from hit) group by r
), items as (
  select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
  from (select distinct r, item_id::varchar as item_id from hit where item_id is not null) group by r
)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(ids, '')) as items_sha256, n_hit is not null as contaminated
from d left join covered using (r) left join items using (r)
"""
