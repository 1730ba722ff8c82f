"""N-gram Jaccard join: MinHash bands find candidates, full shingle sets decide.

Texts are sets of five-word shingles. Band and row counts follow from the wanted recall at the threshold. Documents
with the same words are one text, so that copies are counted and not paired. Texts meet where a band's hash is equal:

1. Buckets are counted with partial aggregation. Of buckets with the same members only the first band's is kept.
2. A bucket with many or long members is cut into blocks; each pair of blocks is a task of bounded memory and receives
   the full sets of its members. A pair is judged only in the first band that it shares, so it is judged once.
3. A task returns, for each member, the links it found and one edge to the smallest member it is connected with.
   Pairs themselves are never shuffled.
4. Classes are the connected components of those edges.

Defined cases: texts without words (null, empty, signs only) are alone in their class, with no links; texts of fewer
words than a shingle are one shingle; documents with the same words are always one class; repeated rows are copies;
a null doc_id takes part, and its class is named by the smallest id of the others; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridwarden.llm.components import connected_components
from gridwarden.llm.common import frugal, is_small, pieces, stored, table
from gridwarden.llm.hashing import BASE, WordHasher, mixed, shingles

THRESHOLD = 0.8
RECALL = 0.999
MOST_HASHES = 128
#: A task holds at most two blocks.
BLOCK_BYTES, BLOCK_TEXTS = 8 << 20, 1024


def bands_and_rows(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """The longest bands that still find pairs at the threshold with the wanted probability."""
    best = (math.ceil(math.log(1 - recall) / math.log(1 - threshold)), 1)
    for rows in range(2, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= most:
            best = (bands, rows)
    return best


def band_hashes(found: np.ndarray, factors: np.ndarray, offsets: np.ndarray, rows: int) -> np.ndarray:
    """The band hashes of a shingle set."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 4096):
        products = np.multiply.outer(factors, found[at : at + 4096])
        products += offsets[:, None]
        np.minimum(least, products.min(axis=1), out=least)
    total = np.arange(len(factors) // rows, dtype=np.uint64)
    for k in range(rows):
        total = mixed((total + least[k::rows][: len(total)]) * np.uint64(BASE))
    return total.view(np.int64)


def row_hash(text: Column) -> Column:
    return F.xxhash64(text)


def signatures(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """(doc_id, row_hash, text_key, size, bands) of every document; the key is null for texts without words."""
    seeds = mixed(np.arange(1, 2 * bands * rows + 1, dtype=np.uint64))
    factors, offsets = seeds[: bands * rows] | np.uint64(1), seeds[bands * rows :]

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for whole in batches:
            for batch in pieces(whole, 2):
                keys, sizes, found = [], [], []
                for words in hasher.texts(batch.column(2).to_pylist()):
                    own = shingles(words)
                    keys.append(hashlib.md5(words.tobytes()).digest() if len(words) else None)
                    sizes.append(len(own))
                    found.append(band_hashes(own, factors, offsets, rows) if len(own) else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(found, pa.list_(pa.int64()))],
                    ["doc_id", "row_hash", "text_key", "size", "bands"],
                )

    read = docs.select(F.col("doc_id").cast("long"), row_hash(F.col("text")).alias("row_hash"), F.col("text").cast("string"))
    return read.mapInArrow(frugal(signed), "doc_id long, row_hash long, text_key binary, size int, bands array<long>")


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(text_key, shingles) for the wanted texts, read from the document that stands for each."""

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for whole in batches:
            for batch in pieces(whole, 1):
                sets = [shingles(words).tobytes() for words in hasher.texts(batch.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["text_key", "shingles"])

    read = docs.select("doc_id", row_hash(F.col("text")).alias("row_hash"), "text")
    same = read["doc_id"].eqNullSafe(wanted["first"]["doc_id"]) & (read["row_hash"] == wanted["first"]["row_hash"])
    return read.join(wanted, same).select("text_key", "text").mapInArrow(frugal(gathered), "text_key binary, shingles binary")


def open_pairs(bands: np.ndarray, sizes: np.ndarray, block: np.ndarray, band: int, i: int, j: int, threshold: float) -> np.ndarray:
    """Which pairs a task must judge: of its two blocks, not met in an earlier band, of sizes that can reach the threshold."""
    mask = np.tri(len(block), k=-1, dtype=bool) if i == j else np.logical_and.outer(block == i, block == j)
    for k in range(band):
        mask &= bands[:, k][:, None] != bands[:, k][None, :]
    least = np.minimum.outer(sizes, sizes) >= threshold * np.maximum.outer(sizes, sizes)
    return np.argwhere(mask & least)


def common_counts(sets: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """How many shingles the texts of each pair share."""
    if len(pairs) <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in pairs], np.int64)
    used, places = np.unique(pairs, return_inverse=True)
    places = places.reshape(pairs.shape)
    columns = np.unique(np.concatenate([sets[t] for t in used]))
    common = np.zeros((len(used), len(used)), np.float32)
    width = max(1, (16 << 20) // (4 * len(used)))
    for at in range(0, len(columns), width):
        part = columns[at : at + width]
        held = np.zeros((len(used), len(part)), np.float32)
        for row, t in enumerate(used):
            own = sets[t]
            own = own[np.searchsorted(own, part[0]) : np.searchsorted(own, part[-1], "right")]
            held[row, np.searchsorted(part, own)] = 1
        common += held @ held.T
    return common[places[:, 0], places[:, 1]].astype(np.int64)


def roots_of(n: int, pairs: np.ndarray) -> np.ndarray:
    """The smallest index that each index is connected with."""
    root = np.arange(n)
    while len(pairs):
        ends = root[pairs]
        low, high = ends.min(axis=1), ends.max(axis=1)
        if (low == high).all():
            break
        np.minimum.at(root, high, low)
        while (root != root[root]).any():
            root = root[root]
    return root


def judged(rows: list[tuple], band: int, i: int, j: int, threshold: float) -> pa.RecordBatch | None:
    """Links and edges among the members of one task."""
    members = {row[0]: row for row in rows}  # a text may arrive twice if its document's row is repeated
    rows = [members[key] for key in sorted(members)]
    sets = [np.frombuffer(row[4], np.uint64) for row in rows]
    sizes = np.array([len(s) for s in sets])
    bands = np.array([row[3] for row in rows])
    pairs = open_pairs(bands, sizes, np.array([row[2] for row in rows]), band, i, j, threshold)
    if not len(pairs):
        return None
    common = common_counts(sets, pairs)
    total = sizes[pairs[:, 0]] + sizes[pairs[:, 1]]
    pairs = pairs[common >= threshold * (total - common)]
    if not len(pairs):
        return None
    copies, links = np.array([row[1] for row in rows]), np.zeros(len(rows), np.int64)
    np.add.at(links, pairs[:, 0], copies[pairs[:, 1]])
    np.add.at(links, pairs[:, 1], copies[pairs[:, 0]])
    root, keys = roots_of(len(rows), pairs), [row[0] for row in rows]
    linked = np.flatnonzero(links)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([keys[t] for t in linked], pa.binary()),
            pa.array([keys[root[t]] for t in linked], pa.binary()),
            pa.array(links[linked], pa.int64()),
        ],
        ["a", "b", "links"],
    )


def found_links(docs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(a, b, links): a text, a smaller one that it is connected with or itself, and documents linked to it there."""
    in_band = texts.select("text_key", "size", F.posexplode("bands").alias("band", "bucket"))
    counted = in_band.groupBy("band", "bucket").agg(
        F.count("*").alias("n"),
        F.sum("size").alias("total"),
        F.bit_xor(F.xxhash64("text_key")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit(1), "text_key")).alias("y"),
    )
    first = counted.where("n > 1").groupBy("n", "total", "x", "y").agg(F.min(F.struct("band", "bucket")).alias("at"))
    kept = stored(first.select("at.band", "at.bucket", "n", "total"), "buckets")
    blocks = F.greatest(F.ceil(F.col("total") * 8 / BLOCK_BYTES), F.ceil(F.col("n") / BLOCK_TEXTS)).cast("int")
    members = in_band.select("text_key", "band", "bucket").join(kept, ["band", "bucket"])
    members = members.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64(F.lit(2), "text_key"), F.col("blocks")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.select("text_key", "band", "bucket", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    wanted = members.select("text_key").distinct().join(texts.select("text_key", "first"), "text_key")
    sets = shingle_sets(docs, wanted).join(texts.select("text_key", "copies", "bands"), "text_key")
    rows = members.join(sets, "text_key").select("band", "bucket", "i", "j", "text_key", "copies", "own", "bands", "shingles")
    tasks = rows.repartition("band", "bucket", "i", "j").sortWithinPartitions("band", "bucket", "i", "j")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held = None, []
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(4)]
            for at, key in enumerate(zip(*columns, strict=True)):
                if key != task:
                    if len(held) > 1 and (out := judged(held, task[0], task[2], task[3], threshold)):
                        yield out
                    task, held = key, []
                held.append(tuple(batch.column(k)[at].as_py() for k in range(4, 9)))
        if len(held) > 1 and (out := judged(held, task[0], task[2], task[3], threshold)):
            yield out

    return tasks.mapInArrow(frugal(judge), "a binary, b binary, links long")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(doc_id, row_hash, text_key, class, n_links) of every document row; class is the class's smallest text key."""
    bands, rows = bands_and_rows(threshold, recall)
    signed = stored(signatures(docs, bands, rows), "signatures")
    texts = signed.where("text_key is not null").groupBy("text_key").agg(
        F.count("*").alias("copies"),
        F.min(F.struct("doc_id", "row_hash")).alias("first"),
        F.first("size").alias("size"),
        F.first("bands").alias("bands"),
    )
    texts = stored(texts, "texts")
    found = stored(found_links(docs, texts, threshold), "links")
    roots = connected_components(found.select("a", "b"))
    links = found.groupBy(F.col("a").alias("text_key")).agg(F.sum("links").alias("links"))
    classes = texts.select("text_key", "copies").join(links, "text_key", "left").join(roots.withColumnRenamed("node", "text_key"), "text_key", "left")
    classes = classes.select(
        "text_key",
        F.coalesce("root", "text_key").alias("class"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    joined = signed.select("doc_id", "row_hash", "text_key").join(classes, "text_key", "left")
    return joined.withColumn("n_links", F.coalesce("n_links", F.lit(0)).cast("long"))


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """The documents without all but one of each class: its row with the smallest id."""
    judged_rows = stored(near_duplicates(docs, threshold, recall), "classes")
    grouped = judged_rows.where("class is not null")
    stays = grouped.groupBy("class").agg(F.min(F.struct("doc_id", "row_hash")).alias("stays"), F.count("*").alias("n"))
    goes = (
        grouped.groupBy("class", "doc_id", "row_hash").agg(F.count("*").alias("times"))
        .join(stays.where("n > 1"), "class")
        .withColumn("goes", F.struct("doc_id", "row_hash") != F.col("stays"))
        .where("goes or times > 1")
        .select(F.col("doc_id").alias("id__"), F.col("row_hash").alias("hash__"), F.col("goes").alias("goes__"), F.col("times").alias("times__"))
    )
    goes = stored(goes, "decisions")
    hashed = docs.withColumn("row_hash__", row_hash(F.col("text")))
    same = F.col("doc_id").eqNullSafe(F.col("id__")) & (F.col("row_hash__") == F.col("hash__"))
    if is_small(goes):  # texts then stay where they are read
        goes = F.broadcast(goes)
    if goes.where("not goes__").limit(1).count() == 0:
        return hashed.join(goes, same, "left_anti").select(docs.columns)
    rank = F.row_number().over(Window.partitionBy("doc_id", "row_hash__").orderBy(F.lit(0)))
    joined = hashed.join(goes, same, "left").where("goes__ is null or not goes__").withColumn("rank__", rank)
    return joined.where("times__ is null or rank__ = 1").select(docs.columns)


def join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = stored(near_duplicates(docs), "classes")
    named = found.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("class_id"))
    joined = found.join(named, "class", "left")
    return joined.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), "n_links")
