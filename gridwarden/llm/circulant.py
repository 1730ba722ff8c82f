"""Circulant MinHash near-dedup: two permutations give every signature coordinate, full shingle sets decide.

A document's set are its two-word shingles. The first permutation of the 64-bit numbers breaks up the shingles' hashes; the
second, shifted circularly by k steps, gives coordinate k as the least value over the set. Bands of coordinates, whose
number follows from the wanted recall, make buckets of candidate sets. Documents with one set are judged as one.

1. Each bucket has a hub, and the distinct pairs of a member and its hub are judged on full sets: one comparison a
   member, also where a group of near copies fills a bucket. Linked pairs are edges; components follow.
2. Where a bucket still holds several components, members outside its largest one are compared with all others there
   that are not in their own component. Pairs within a component need no comparison, as more links would not change it.
   So no link between components is lost.
3. What a task compares is bounded: hubs in blocks against members in blocks, each with its full sets. Pairs are not
   shuffled; a task returns one edge per linked set.

Defined cases: texts without words (null, empty, blank) have no shingles and are alone; one word is one shingle; equal
sets are linked, whatever their order of words; repeated rows are judged alike; a null doc_id takes part, and a component
is named by the smallest of its other ids, or null; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwarden.llm.common import is_small, stored, table
from gridwarden.llm.components import connected_components
from gridwarden.llm.hashing import BASE, WordHasher, mixed, shingles
from gridwarden.llm.ngram_join import bands_and_rows, common_counts, roots_of, row_hash

WORDS = 2
THRESHOLD_PERCENT = 80
RECALL = 0.9999
#: A task holds one block of hubs and one of members.
BLOCK_BYTES, BLOCK_TEXTS = 8 << 20, 512
BATCH_ROWS = 256
STEP, FIRST, SECOND = (np.uint64(n) for n in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


class BlankWords(WordHasher):
    """Words are what stands between ASCII blanks."""

    def __init__(self):
        super().__init__()
        byte = np.arange(256)
        self.is_word = ~((byte == 32) | ((byte >= 9) & (byte <= 13)))


def coordinates(found: np.ndarray, n: int) -> np.ndarray:
    """The n signature coordinates of a set of 64-bit hashes."""
    first, least = mixed(found), np.full(n, np.iinfo(np.uint64).max, np.uint64)
    shifts = (np.arange(n, dtype=np.uint64) * STEP)[:, None]
    for at in range(0, len(first), 512):
        second = first[at : at + 512] + shifts
        second *= FIRST
        second ^= second >> np.uint64(32)
        second *= SECOND
        np.minimum(least, second.min(axis=1), out=least)
    return least


def band_hashes(signature: np.ndarray, rows: int) -> np.ndarray:
    total = np.arange(len(signature) // rows, dtype=np.uint64)
    for k in range(rows):
        total = mixed((total + signature[k::rows]) * np.uint64(BASE))
    return total.view(np.int64)


def signatures(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """(doc_id, row_hash, set_key, size, bands) of every document; the key is null for texts without words."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = BlankWords()
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                keys, sizes, found = [], [], []
                for words in hasher.texts(batch.column(2).to_pylist()):
                    own = shingles(words, WORDS)
                    keys.append(hashlib.md5(own.tobytes()).digest() if len(own) else None)
                    sizes.append(len(own))
                    found.append(band_hashes(coordinates(own, bands * rows), rows) if len(own) else None)
                columns = [batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row_hash", "set_key", "size", "bands"])

    read = docs.select(F.col("doc_id").cast("long"), row_hash(F.col("text")).alias("row_hash"), F.col("text").cast("string"))
    return read.mapInArrow(signed, "doc_id long, row_hash long, set_key binary, size long, bands array<long>")


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(set_key, shingles) of the wanted sets, read from the document that stands for each."""

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = BlankWords()
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                sets = [shingles(words, WORDS).tobytes() for words in hasher.texts(batch.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["set_key", "shingles"])

    read = docs.select(F.col("doc_id").cast("long").alias("own_id"), row_hash(F.col("text")).alias("own_hash"), F.col("text").cast("string"))
    wanted = stored(wanted.select("set_key", "first.doc_id", "first.row_hash"), "wanted")
    wanted = F.broadcast(wanted) if is_small(wanted) else wanted
    return read.join(wanted, F.expr("own_id <=> doc_id and own_hash = row_hash")).select("set_key", "text").mapInArrow(
        gathered, "set_key binary, shingles binary"
    )


def judged(rows: list[tuple]) -> pa.RecordBatch | None:
    """Edges among the sets of one task, from rows of (is hub, set_key, component, shingles)."""
    keys = sorted({row[1] for row in rows})
    place = {key: at for at, key in enumerate(keys)}
    sets, parts = [np.empty(0, np.uint64)] * len(keys), [b""] * len(keys)
    hub, member = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    for is_hub, key, part, held in rows:
        at = place[key]
        sets[at], parts[at] = np.frombuffer(held, np.uint64), part
        (hub if is_hub else member)[at] = True
    sizes, part = np.array([len(s) for s in sets]), np.unique(np.array(parts, object), return_inverse=True)[1]
    hubs, members = np.flatnonzero(hub), np.flatnonzero(member)
    small, large = np.minimum.outer(sizes[hubs], sizes[members]), np.maximum.outer(sizes[hubs], sizes[members])
    wanted = (part[hubs][:, None] != part[members]) & (100 * small >= THRESHOLD_PERCENT * large)
    wanted &= ~(member[hubs][:, None] & hub[members] & (hubs[:, None] > members))
    at = np.argwhere(wanted)
    if not len(at):
        return None
    pairs = np.stack([hubs[at[:, 0]], members[at[:, 1]]], axis=1)
    common = common_counts(sets, pairs)
    total = sizes[pairs[:, 0]] + sizes[pairs[:, 1]] - common
    pairs = pairs[100 * common >= THRESHOLD_PERCENT * total]
    root = roots_of(len(keys), pairs)
    linked = np.flatnonzero(root != np.arange(len(keys)))
    if not len(linked):
        return None
    return pa.RecordBatch.from_arrays([pa.array([keys[t] for t in linked], pa.binary()), pa.array([keys[root[t]] for t in linked], pa.binary())], ["a", "b"])


def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, held = None, []
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in range(3)]
        for at, key in enumerate(zip(*columns, strict=True)):
            if key != task:
                if held and (out := judged(held)):
                    yield out
                task, held = key, []
            held.append(tuple(batch.column(k)[at].as_py() for k in range(3, 7)))
    if held and (out := judged(held)):
        yield out


def blocks(texts: Column, size: Column) -> Column:
    return F.greatest(F.ceil(texts / BLOCK_TEXTS), F.ceil(size * 8 / BLOCK_BYTES)).cast("int")


def found_links(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """Edges between hubs and other members of each group `g`, from (g, set_key, size, part, hub); equal parts are skipped."""
    of_hubs = [F.count_if("hub").alias("hubs"), F.sum(F.when(F.col("hub"), F.col("size"))).alias("hub_size")]
    totals = groups.groupBy("g").agg(*of_hubs, F.count("*").alias("texts"), F.sum("size").alias("total")).where("hubs > 0")
    totals = stored(totals.select("g", blocks(F.col("hubs"), F.col("hub_size")).alias("h"), blocks(F.col("texts"), F.col("total")).alias("c")), "groups")
    rows = groups.join(totals, "g")
    own, all_of = (lambda n: F.pmod(F.xxhash64(F.lit(3), "set_key"), F.col(n)).cast("int")), (lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1)))
    hubs = rows.where("hub").select("g", own("h").alias("h"), all_of("c").alias("c"), F.lit(True).alias("hub"), "set_key", "part")
    members = rows.select("g", all_of("h").alias("h"), own("c").alias("c"), F.lit(False).alias("hub"), "set_key", "part")
    dealt = hubs.unionByName(members).join(sets, "set_key").select("g", "h", "c", "hub", "set_key", "part", "shingles")
    return dealt.repartition("g", "h", "c").sortWithinPartitions("g", "h", "c").mapInArrow(judge, "a binary, b binary")


def star_groups(pairs: DataFrame) -> DataFrame:
    """Groups of a hub and its members from pairs (hub: set_key, size, part; set_key, size, part)."""
    pairs = pairs.groupBy("hub.set_key", F.col("set_key").alias("key")).agg(
        F.first("hub").alias("hub"), F.first("size").alias("size"), F.first("part").alias("part")
    )
    pairs = stored(pairs.select("hub", F.col("key").alias("set_key"), "size", "part"), "pairs")
    hubs = pairs.select("hub").distinct().select(F.col("hub.set_key").alias("g"), "hub.*", F.lit(True).alias("hub"))
    return hubs.unionByName(pairs.select(F.col("hub.set_key").alias("g"), "set_key", "size", "part", F.lit(False).alias("hub")))


def bucket_members(texts: DataFrame) -> DataFrame:
    """(g, n, set_key, size, centre) of the buckets with several sets; buckets with the same members are one.

    The centre, the bucket's hub, is its member with the most neighbours over all bands: the one most like the others. The
    buckets of one group of near copies then have few different hubs, and most of their pairs are the same.
    """
    in_band = texts.select("set_key", "size", F.posexplode("bands").alias("band", "bucket"))
    counted = in_band.groupBy("band", "bucket").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("set_key")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "set_key")).alias("y")
    )
    once = counted.where("n > 1").groupBy("n", "x", "y").agg(F.min(F.struct("band", "bucket")).alias("at"), F.count("*").alias("bands"))
    kept = stored(once.select("n", "bands", "at.*"), "buckets")
    found = stored(in_band.join(kept, ["band", "bucket"]).select(F.xxhash64("band", "bucket").alias("g"), "n", "bands", "set_key", "size"), "members")
    near = stored(found.groupBy(F.col("set_key").alias("own")).agg(F.sum(F.col("n") * F.col("bands")).alias("near")), "neighbours")
    best = F.max(F.struct("near", "set_key", "size", F.col("set_key").alias("part")))
    centres = found.join(near, F.col("set_key") == F.col("own")).groupBy("g").agg(best.alias("best"))
    centres = stored(centres.select("g", F.struct("best.set_key", "best.size", "best.part").alias("centre")), "centres")
    return stored(found.select("g", "n", "set_key", "size").join(centres, "g"), "candidates")


def open_members(members: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members of buckets that hold several components, with `part`, their component, and `hub`: outside the largest one and
    not the bucket's first hub. Also all components."""
    roots = connected_components(edges)
    parts = members.where("n > 2").join(roots, members["set_key"] == roots["node"], "left")
    parts = stored(parts.withColumn("part", F.coalesce("root", "set_key")).drop("node", "root"), "parts")
    several = parts.groupBy("g", "part").agg(F.count("*").alias("k")).groupBy("g").agg(F.max(F.struct("k", "part"))["part"].alias("most"), F.count("*").alias("parts"))
    several = stored(several.where("parts > 1").select("g", "most"), "open")
    hub = (F.col("part") != F.col("most")) & (F.col("set_key") != F.col("centre.set_key"))
    return parts.join(several, "g").select("g", "set_key", "size", "part", hub.alias("hub")), roots


def components_of(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, root) of the sets linked with a smaller one."""
    members = bucket_members(texts)
    wanted = members.select("set_key").distinct().join(texts.select("set_key", "first"), "set_key")
    sets = stored(shingle_sets(docs, wanted).dropDuplicates(["set_key"]), "sets")
    pairs = members.where("set_key <> centre.set_key").select(F.col("centre").alias("hub"), "set_key", "size", F.col("set_key").alias("part"))
    edges = stored(found_links(star_groups(pairs), sets), "links")
    found, roots = open_members(members, edges)
    found = stored(found, "comparisons")
    if not found.where("hub").limit(1).count():
        return roots
    return connected_components(edges.unionByName(stored(found_links(found, sets), "links")))


def near_duplicates(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """Per document the size of its set, the smallest id of its component, and whether that is its own."""
    bands, rows = bands_and_rows(THRESHOLD_PERCENT / 100, recall)
    signed = stored(signatures(docs, bands, rows), "signatures")
    texts = signed.where("set_key is not null").groupBy("set_key").agg(
        F.min(F.struct("doc_id", "row_hash")).alias("first"),
        F.min("doc_id").alias("least"),
        F.first("size").alias("size"),
        F.first("bands").alias("bands"),
    )
    texts = stored(texts, "texts")
    roots = components_of(docs, texts)
    named = stored(texts.select("set_key", "least").join(roots, F.col("set_key") == F.col("node"), "left").select("set_key", "least", F.coalesce("root", "set_key").alias("part")), "named")
    least = stored(named.groupBy("part").agg(F.min("least").alias("component_id")), "components")
    classes = stored(named.join(least, "part").select("set_key", "component_id"), "classes")
    joined = signed.select("doc_id", F.col("size").alias("n_shingles"), "set_key").join(classes, "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    found = joined.select("doc_id", "n_shingles", component.alias("component_id"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
