"""Line dedup by site-relative frequency: lines on too large a share of a host's pages are boilerplate and go.

Pages holding each line are counted per host with partial aggregation, a page's repeated lines once. A line is
boilerplate if it is on more than `ratio` of the host's pages and on `min_pages` at least. A host thus has fewer
boilerplate lines than its mean number of lines per page divided by `ratio`, so they fit one array per host, and each
page drops its lines without being regrouped. The arrays are broadcast if they hold few lines in all, else joined by host
over salted keys.

Defined cases: a page is a row, repeated or not; blank lines are never counted or dropped; rows without a host (null)
form one host; null texts stay null, count as pages and have no lines; a page whose lines are all boilerplate keeps
its row with an empty text; untouched texts stay as they are; other columns are kept; n_chars is renewed where it
exists; an empty table stays empty; columns of any name are kept, but `counts` replaces those named like its own; a page's
lines are one array, so a text may be as long as a row allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwarden.llm.common import is_small, salted, table

RATIO = 0.02
MIN_PAGES = 5
SALTS = 64


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    """Null for blank lines."""
    return F.when(F.trim(line) != "", F.unhex(F.md5(line)))


def unused(taken: set[str], name: str) -> str:
    """A column name that no document column has, whatever its case."""
    while name in taken:
        name += "_"
    return name


def boilerplate(docs: DataFrame, host: str, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, line): the keys of each host's boilerplate lines."""
    keys = F.array_distinct(F.array_compact(F.transform(lines_of(F.col("text")), line_key)))
    pages = docs.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("pages"))
    held = docs.select(F.col(host).alias("host"), F.explode(keys).alias("line")).groupBy("host", "line").count()
    frequent = held.where(F.col("count") >= min_pages).withColumnRenamed("host", "line_host")
    found = frequent.join(pages, F.col("host").eqNullSafe(F.col("line_host"))).where(F.col("count") > ratio * F.col("pages"))
    return found.select("host", "line")


def drop_boilerplate(
    docs: DataFrame, host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES, counts: bool = False
) -> DataFrame:
    """The documents without boilerplate lines; with `counts`, also n_lines and n_dropped, instead of columns so named."""
    columns = [name for name in docs.columns if not (counts and name.lower() in ("n_lines", "n_dropped"))]
    docs = docs.select(columns)
    taken = {name.lower() for name in columns}
    key, listed, salt, dealt, kept, gone = (unused(taken, name) for name in ("host__", "lines__", "salt__", "dealt__", "kept__", "dropped__"))
    flat = boilerplate(docs, host, ratio, min_pages)
    lines = flat.groupBy(F.col("host").alias(key)).agg(F.collect_list("line").alias(listed))
    same = docs[host].eqNullSafe(F.col(key))
    if is_small(flat):  # a row per line, since a host's array can be long
        joined = docs.join(F.broadcast(lines), same, "left")
    else:
        copies = lines.withColumn(dealt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        spread = docs.withColumn(salt, salted(docs[host], SALTS, F.col("text")))
        joined = spread.join(copies, same & (F.col(salt) == F.col(dealt)), "left")
    own = lines_of(F.col("text"))
    left = F.filter(own, lambda line: ~F.coalesce(F.array_contains(listed, line_key(line)), F.lit(False)))
    joined = joined.withColumn(kept, F.when(F.col(listed).isNotNull(), left).otherwise(own))
    dropped = F.coalesce(F.size(own) - F.size(kept), F.lit(0)).cast("long")
    joined = joined.withColumn(gone, F.when(F.col("text").isNull(), F.lit(0)).otherwise(dropped))
    text = F.when(F.col(gone) > 0, F.array_join(kept, "\n")).otherwise(F.col("text"))
    renewed = {"text": text}
    if "n_chars" in columns:
        renewed["n_chars"] = F.when(F.col(gone) > 0, F.char_length(text).cast("long")).otherwise(F.col("n_chars"))
    out = [renewed.get(name, F.col(name)).alias(name) for name in columns]
    if counts:
        n_lines = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(own)).cast("long")
        out = [*out, n_lines.alias("n_lines"), F.col(gone).cast("long").alias("n_dropped")]
    return joined.select(out)


def line_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return drop_boilerplate(docs, counts=True)


ORACLE = """
with d as (select row_number() over () as r, doc_id, source, text, string_split(text, chr(10)) as lines from documents),
l as (select r, source, unnest(lines) as line, unnest(range(len(lines))) as place from d where text is not null),
held as (
  select source, line, count(distinct r) as pages from l where trim(line, ' ') <> '' group by source, line
), hosts as (select source, count(*) as pages from d group by source),
boiler as (
  select h.source, h.line from held h join hosts t on h.source is not distinct from t.source
  where h.pages >= 5 and h.pages > 0.02 * t.pages
), kept as (
  select r, count(*) as n_lines, count(*) filter (where b.line is not null) as n_dropped,
    string_agg(l.line, chr(10) order by place) filter (where b.line is null) as text
  from l left join boiler b on l.source is not distinct from b.source and l.line = b.line group by r
)
select doc_id, source, case when d.text is null then null else coalesce(kept.text, '') end as text,
  coalesce(n_lines, 0)::bigint as n_lines, coalesce(n_dropped, 0)::bigint as n_dropped
from d left join kept using (r)
"""
