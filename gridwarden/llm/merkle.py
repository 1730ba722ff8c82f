"""Merkle dataset manifest: witnesses grow as leaves are appended in order, block by block, then root by root.

H is the lower-case hex SHA-256 of its inputs, digests entering as hex text. A document's leaf is H of its columns; the
leaves of a language ascend by doc_id, and pairs of neighbours become their H level by level (a last one alone its own)
until the language's subroot remains. Subroots in the order of their languages likewise give the root.

1. Leaves are written, dealt by ranges of (lang, doc_id) and numbered: rows are counted per range and language, and
   running sums over these few counts give each leaf its place in its language.
2. Each run of 256 places is an aligned block. A task appends a block's leaves one after another. Open subtrees of equal
   height are joined as soon as the later one is complete, and both sides' partial witnesses get the other's root.
3. Block roots are appended as leaves of the next level in the same way, until each language has one, and then the
   subroots as leaves of the last tree. A leaf's witness is its own steps, its block's, and so on up to the root.
4. Each leaf is folded along its witness and compared with the root.

A language with a third of all rows is as many blocks as any other. Nothing is collected but the number of nodes.

Defined cases: null columns have the encoding `-`; null languages come first, null doc_ids first in their language and
are never tampered with; repeated doc_ids ascend by leaf, and equal rows are leaves each; texts enter whole; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridwarden.llm.common import is_small, stored, table

BITS = 8
#: Upper witnesses are broadcast up to so many rows of at most about a kilobyte.
UPPER_ROWS = 20_000
#: What stands before the digest in a witness: nothing to join with, a sibling on the left, one on the right.
ALONE, LEFT, RIGHT = 0, 1, 2
STEP = 33


def joined(*digests: bytes) -> bytes:
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(n_chars: Column) -> Column:
    parts = [F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")]
    return F.unhex(F.sha2(F.concat(*map(encoded, parts)), 256))


def tampered() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """(lang, doc_id, digest, other): the leaf, and the leaf of the document tampered with, if it is."""
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    return docs.select(
        F.col("lang").cast("string"),
        F.col("doc_id").cast("long"),
        leaf_digest(F.col("n_chars")).alias("digest"),
        F.when(tampered(), leaf_digest(more)).alias("other"),
    )


def numbered(found: DataFrame) -> DataFrame:
    """The leaves with their language's number `g`, their place `pos` in it, its size `n` and the number of languages."""
    own = found.withColumn("own", F.monotonically_increasing_id())  # equal rows go to different ranges too
    dealt = own.repartitionByRange("lang", "doc_id", "digest", "own").sortWithinPartitions("lang", "doc_id", "digest", "own")
    order = stored(dealt.drop("own").withColumn("row", F.monotonically_increasing_id()), "order")
    part = F.shiftright("row", 33).alias("part")
    counts = stored(order.groupBy("lang", part).agg(F.count("*").alias("rows"), F.min("row").alias("first")), "counts")
    in_lang = Window.partitionBy("lang")
    counts = counts.select(
        "*",
        F.sum("rows").over(in_lang).alias("n"),
        (F.sum("rows").over(in_lang.orderBy("part")) - F.col("rows")).alias("before"),
        F.min("part").over(in_lang).alias("begins"),
    )
    langs = counts.where("part = begins").select("lang", "begins")
    per_part = langs.groupBy("begins").agg(F.count("*").alias("langs"))  # a row per range
    total = F.sum("langs").over(Window.orderBy("begins").rowsBetween(Window.unboundedPreceding, -1))
    per_part = per_part.select(F.col("begins").alias("at"), F.coalesce(total, F.lit(0)).alias("earlier"))
    place = F.row_number().over(Window.partitionBy("begins").orderBy(F.col("lang").asc_nulls_first())) - 1
    langs = langs.withColumn("place", place).join(per_part, F.col("begins") == F.col("at"))
    langs = langs.select(F.col("lang").alias("of_lang"), (F.col("earlier") + F.col("place")).cast("long").alias("g"))
    ranges = counts.join(langs, F.expr("lang <=> of_lang")).select(
        "of_lang", F.col("part").alias("of_part"), "first", "before", "n", "g"
    )
    ranges = stored(ranges, "ranges")
    ranges = F.broadcast(ranges) if is_small(ranges) else ranges
    placed = order.withColumn("part", part).join(ranges, F.expr("part = of_part and lang <=> of_lang"))
    return placed.select("g", (F.col("row") - F.col("first") + F.col("before")).alias("pos"), "n", "digest", "doc_id", "lang", "other")


class OpenBlock:
    """The subtrees of a block that are complete so far, and the witness steps that its leaves have got."""

    def __init__(self, levels: int, size: int = 1 << BITS):
        self.levels, self.leaves = levels, 0
        self.open: list[tuple[int, bytes, int]] = []
        self.steps = np.zeros((size, levels, STEP), np.uint8)

    def append(self, digest: bytes) -> None:
        self.open.append((0, digest, self.leaves))
        self.leaves += 1
        self.join_equal()

    def join_equal(self) -> None:
        """The last two subtrees, while they have one height; each side's witnesses get the other's root."""
        while len(self.open) > 1 and self.open[-2][0] == self.open[-1][0]:
            (height, left, first), (_, right, middle) = self.open[-2:]
            self.steps[first:middle, height] = np.frombuffer(bytes([RIGHT]) + right, np.uint8)
            self.steps[middle : self.leaves, height] = np.frombuffer(bytes([LEFT]) + left, np.uint8)
            self.open[-2:] = [(height + 1, joined(left, right), first)]

    def close(self) -> bytes:
        """The root, once no leaf follows: a last subtree without a sibling goes up by itself."""
        while len(self.open) > 1 or self.open[0][0] < self.levels:
            height, root, first = self.open[-1]
            self.open[-1] = height + 1, joined(root), first
            self.join_equal()
        return self.open[0][1]

    def witnesses(self) -> list[bytes]:
        return [own.tobytes() for own in self.steps[: self.leaves]]


def levels_of(n: int) -> int:
    """Levels of a block in a tree of n leaves: all of them if it is the only one."""
    return min(BITS, (n - 1).bit_length())


def appended(nodes: DataFrame) -> DataFrame:
    """The nodes with their `block`, witness `steps` in it, and on its last row the block's `top`."""
    columns = nodes.columns
    kept = nodes.withColumn("block", F.shiftright("pos", BITS))
    dealt = kept.repartition("g", "block").sortWithinPartitions("g", "block", "pos")
    schema = ", ".join(f"{name} {kind}" for name, kind in dealt.dtypes) + ", steps binary, top binary"

    def closed(pieces: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(pieces).combine_chunks()
        block = OpenBlock(levels_of(rows.column("n")[0].as_py()))
        for digest in rows.column("digest").to_pylist():
            block.append(digest)
        top = [None] * (len(rows) - 1) + [block.close()]
        rows = rows.append_column("steps", pa.array(block.witnesses(), pa.binary())).append_column("top", pa.array(top, pa.binary()))
        yield from rows.to_batches()

    def append(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, own = [], None
        for batch in batches:
            g, block = (np.asarray(batch.column(k)) for k in (columns.index("g"), len(columns)))
            edges = np.flatnonzero((np.diff(g) != 0) | (np.diff(block) != 0)) + 1
            for begin, end in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
                if end > begin:
                    key = g[begin], block[begin]
                    if pieces and key != own:
                        yield from closed(pieces)
                        pieces = []
                    own = key
                    pieces.append(batch.slice(begin, end - begin))
        if pieces:
            yield from closed(pieces)

    return dealt.mapInArrow(append, schema)


def tree(nodes: DataFrame, name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The nodes with steps in their blocks; per block (g, block, above) the steps from its root on; per tree (g, top)."""
    levels = [stored(appended(nodes), name)]
    while True:
        tops = levels[-1].where("top is not null").select(
            "g", F.col("block").alias("pos"), (F.shiftright(F.col("n") - 1, BITS) + 1).alias("n"), F.col("top").alias("digest")
        )
        if tops.agg(F.max("n")).first()[0] in (None, 1):
            break
        levels.append(stored(appended(tops), name))
    above = tops.select("g", F.col("pos").alias("block"), F.lit(b"").alias("above"))
    for level in reversed(levels[1:]):
        longer = F.concat("steps", "above")
        above = level.select("g", "pos", "block", "steps").join(above, ["g", "block"]).select("g", F.col("pos").alias("block"), longer.alias("above"))
    return levels[0], above, tops.select("g", F.col("digest").alias("top"))


RESULT = {"doc_id": "long", "lang": "string", "leaf": "string", "subroot": "string", "root": "string", "proof_sha256": "string", "folded_root": "string", "verified": "boolean"}


def fold(leaf: str, steps: bytes) -> tuple[str, str]:
    """What a leaf gives along its witness, and the digest of the witness's siblings."""
    node, siblings = leaf, []
    for at in range(0, len(steps), STEP):
        sibling = "" if steps[at] == ALONE else steps[at + 1 : at + STEP].hex()
        siblings.append(sibling)
        pair = sibling + node if steps[at] == LEFT else node + sibling
        node = hashlib.sha256(pair.encode()).hexdigest()
    return node, hashlib.sha256("".join(siblings).encode()).hexdigest()


def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (doc_id, lang, leaf, leaf to fold, subroot, root, steps) to the result's columns."""
    for batch in batches:
        leaf, own, subroot, root = ([d.hex() for d in batch.column(k).to_pylist()] for k in range(2, 6))
        ends = [fold(a, b) for a, b in zip(own, batch.column(6).to_pylist(), strict=True)]
        same = [a[0] == b for a, b in zip(ends, root, strict=True)]
        columns = [pa.array(c, pa.string()) for c in (leaf, subroot, root, [e[1] for e in ends], [e[0] for e in ends])]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns, pa.array(same, pa.bool_())], list(RESULT))


def manifest(docs: DataFrame) -> DataFrame:
    """Per document its leaf, its language's subroot, the root, the digest of its witness, and whether its leaf, tampered
    with or not, folds to the root."""
    nodes, above, subroots = tree(numbered(stored(leaves(docs), "leaves")), "witnesses")
    langs = subroots.agg(F.count("*")).first()[0]
    top_nodes = subroots.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("pos"), F.lit(langs).cast("long").alias("n"), F.col("top").alias("digest"))
    own, over, root = tree(top_nodes, "subroots")
    own = own.select("g", "block", "pos", "digest", "steps")
    over = own.join(over, ["g", "block"]).join(root, "g").select(
        F.col("pos").alias("g"), F.col("digest").alias("subroot"), F.col("steps").alias("own"), F.col("above").alias("over"), F.col("top").alias("root")
    )
    upper = above.join(over, "g").select("g", "block", "subroot", "root", F.concat("above", "own", "over").alias("above"))
    upper = stored(upper, "upper")
    upper = F.broadcast(upper) if is_small(upper, UPPER_ROWS) else upper
    found = nodes.select("g", "block", "doc_id", "lang", "digest", "other", "steps").join(upper, ["g", "block"])
    steps = F.concat("steps", "above")
    return found.select("doc_id", "lang", "digest", F.coalesce("other", "digest"), "subroot", "root", steps).mapInArrow(
        folded, ", ".join(f"{name} {kind}" for name, kind in RESULT.items())
    )


def manifest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


def _encoded_sql(value: str) -> str:
    return f"case when {value} is null then '-' else strlen({value}::varchar) || ':' || {value}::varchar end"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_encoded_sql, ["doc_id", "source", "lang", n_chars, "text"])) + ")"


#: CRC-32 of a decimal number, bit by bit.
_CRC = """
xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, length(doc_id::varchar) + 1), lambda i: ascii((doc_id::varchar)[i])::bigint)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda s, k: xor(s >> 1, (s & 1) * 3988292384::bigint))), 4294967295::bigint)
"""

ORACLE = f"""
with recursive leaf as (
    select row_number() over (order by lang nulls first, doc_id nulls first, d) - 1 id, *,
        dense_rank() over (order by coalesce('1' || lang, '0')) - 1 g,
        row_number() over (partition by lang order by doc_id nulls first, d) - 1 pos, count(*) over (partition by lang) n
    from (select doc_id, lang, {_leaf_sql("n_chars")} d, case when {_CRC} % 7 = 0 then {_leaf_sql("(n_chars::hugeint + 1)")} end other from documents)
), node(g, level, pos, n, d) as (
    select g, 0, pos, n, d from leaf
    union all
    select g, level + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(d, '' order by pos)) from node where n > 1 group by g, level, pos // 2
), sub as (select g, d, level depth, count(*) over () langs from node where n = 1),
top(level, pos, n, d) as (
    select 0, g, langs, d from sub
    union all
    select level + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(d, '' order by pos)) from top where n > 1 group by level, pos // 2
), root as (select d, level height from top where n = 1),
step as (
    select leaf.id, node.level, node.d sibling, leaf.pos >> node.level & 1 odd from leaf join node on node.g = leaf.g and node.n > 1
        and node.pos = xor(leaf.pos >> node.level, 1)
    union all
    select leaf.id, sub.depth + top.level, top.d, leaf.g >> top.level & 1 from leaf join sub on sub.g = leaf.g join top on top.n > 1
        and top.pos = xor(leaf.g >> top.level, 1)
), fold(id, level, last, d) as (
    select leaf.id, 0, sub.depth + root.height, coalesce(leaf.other, leaf.d) from leaf join sub on sub.g = leaf.g cross join root
    union all
    select fold.id, fold.level + 1, last, sha256(case when odd = 1 then sibling || fold.d else fold.d || coalesce(sibling, '') end)
    from fold left join step on step.id = fold.id and step.level = fold.level where fold.level < last
), proof as (select id, string_agg(sibling, '' order by level) siblings from step group by id)
select leaf.doc_id, leaf.lang, leaf.d leaf, sub.d subroot, root.d root, sha256(coalesce(siblings, '')) proof_sha256, fold.d folded_root, fold.d = root.d verified
from leaf join sub on sub.g = leaf.g cross join root join fold on fold.id = leaf.id and fold.level = last left join proof on proof.id = leaf.id
"""
