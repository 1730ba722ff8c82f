"""Periodic run detection: rare words split texts recursively, surviving segments are scanned lag by lag.

A run is a stretch of words with smallest period q, of max(6, 4 q) words at least, that neither neighbour extends. So
each of its words occurs four times in it. Every text is one segment at first. Words with fewer occurrences in
their segment are in no run there: they go, and what lies between them are new, shorter segments with lower counts. Once
nothing changes, most prose is gone, and for each lag the rest is cut into blocks of that length. A run has two equal
blocks in a row wherever the cuts fall; block hashes find them, and word by word comparison extends and confirms.
Blocks inside a run already found at a smaller lag, which then divides this one, are passed over, so the smallest
period is the one reported and a long run costs its length once. The blocks of all lags of n words number n log n.

Texts are judged in slabs of about a megabyte, or one longer text; memory is a small multiple of that.

Defined cases: null, empty and blank texts have no words and no runs; repeated rows are judged each by itself; a null
doc_id stays null; other columns, of whatever name, are not read; an empty table gives no rows; no length is cut.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwarden.llm.common import table
from gridwarden.llm.hashing import BASE, mixed, powers

LEAST_LENGTH, LEAST_PERIODS = 6, 4
SLAB_BYTES = 1 << 20

Run = tuple[int, int, int]
#: From a document's id and number of words, the order in which its words are read, or None for the order as it is.
Order = Callable[[int | None, int], np.ndarray | None]


def surviving(ids: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and segment numbers of the words left, given each word's id and the number of its text."""
    place, segment, width = np.arange(len(ids)), text, int(ids.max(initial=0)) + 1
    while len(place):
        code = pd.factorize(segment * width + ids[place])[0]
        often = np.bincount(code)[code] >= LEAST_PERIODS
        place, segment = place[often], segment[often]
        edge = np.flatnonzero((np.diff(place) != 1) | (np.diff(segment) != 0)) + 1
        lengths = np.diff(np.concatenate(([0], edge, [len(place)])))
        long = np.repeat(lengths >= LEAST_LENGTH, lengths)
        segment = np.repeat(np.arange(len(lengths)), lengths)
        place, segment = place[long], segment[long]
        if often.all() and long.all():
            break
    return place, segment


def matches_after(x: np.ndarray, at: int, lag: int) -> int:
    """How many elements in a row from `at` on equal the one a lag later."""
    end, begin, step = len(x) - lag, at, 64
    while at < end:
        stop = min(at + step, end)
        differs = x[at:stop] != x[at + lag : stop + lag]
        first = int(differs.argmax())
        if differs[first]:
            return at + first - begin
        at, step = stop, step * 2
    return end - begin


def matches_before(x: np.ndarray, at: int, lag: int) -> int:
    """How many elements in a row up to `at` equal the one a lag later."""
    end, step = at, 64
    while at > 0:
        stop = max(at - step, 0)
        differs = (x[stop:at] != x[stop + lag : at + lag])[::-1]
        first = int(differs.argmax())
        if differs[first]:
            return end - at + first
        at, step = stop, step * 2
    return end


def lag_scan(x: np.ndarray, place: np.ndarray, room: np.ndarray) -> list[Run]:
    """(place, length, period) of all runs among segments that end in an element found nowhere else.

    `place` is each element's place in the whole, `room` the length of its segment.
    """
    runs, reach, least = [], np.zeros(len(x), np.int64), 1
    while len(x):
        up = powers(BASE, max(len(x), 2 * least) + 1)
        running = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(mixed(x.astype(np.uint64)) * up[: len(x)], out=running[1:])
        for lag in range(least, 2 * least):
            block = np.diff(running[::lag])
            twice = np.flatnonzero(block[:-1] * up[lag] == block[1:]) * lag
            done = -1
            for at in twice[reach[twice] < place[twice] + 2 * lag].tolist():
                if at < done:
                    continue
                after = matches_after(x, at, lag)
                if after < lag:
                    continue  # only the hashes were equal
                begin, done = at - matches_before(x, at, lag), at + after
                length = done - begin + lag
                if length >= max(LEAST_LENGTH, LEAST_PERIODS * lag):
                    first = int(place[begin])
                    runs.append((first, length, lag))
                    np.maximum(reach[begin : begin + length], first + length, out=reach[begin : begin + length])
        least *= 2
        keep = room >= LEAST_PERIODS * least
        x, place, room, reach = x[keep], place[keep], room[keep], reach[keep]
    return runs


def periodic_runs(ids: np.ndarray, text: np.ndarray) -> list[Run]:
    """All runs as (place, length, period) by place, then period; texts lie one after another."""
    place, segment = surviving(ids, text)
    if not len(place):
        return []
    segment = np.unique(segment, return_inverse=True)[1]
    lengths = np.bincount(segment)
    ends = np.cumsum(lengths + 1) - 1
    size = len(place) + len(lengths)
    x, whole = np.empty(size, np.int64), np.full(size, -1, np.int64)
    words = np.ones(size, bool)
    words[ends] = False
    x[words], whole[words] = ids[place], place
    x[ends] = int(ids.max()) + 1 + np.arange(len(ends))
    return sorted(lag_scan(x, whole, np.repeat(lengths, lengths + 1)), key=lambda run: (run[0], run[2]))


def cut_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in a row, and at which of them each text begins, with the end."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
    flat, offsets = lists.flatten(), lists.offsets.to_numpy()
    filled = np.asarray(pc.greater(pc.binary_length(flat), 0))
    before = np.concatenate(([0], np.cumsum(filled)))
    return flat.filter(pa.array(filled)).cast(pa.binary()), before[offsets - offsets[0]]


def slabs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about SLAB_BYTES of text, or of one longer text."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(1)), 0)).tolist()
    begin, held = 0, 0
    for at, size in enumerate(sizes):
        if held and held + size > SLAB_BYTES:
            yield batch.slice(begin, at - begin)
            begin, held = at, 0
        held += size
    if begin < len(sizes):
        yield batch.slice(begin)


COLUMNS = {
    "doc_id": pa.int64(),
    "n_words": pa.int64(),
    "n_runs": pa.int64(),
    "start": pa.int64(),
    "length": pa.int64(),
    "period": pa.int64(),
    "exponent_milli": pa.int64(),
    "runs": pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])),
    "collapsed": pa.string(),
}
SCHEMA = (
    "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs array<struct<start: long, length: long, period: long>>, collapsed string"
)
DIGESTS = {"runs_sha256": pa.string(), "collapsed_sha256": pa.string()}
DIGEST_SCHEMA = SCHEMA.split(", runs ")[0] + ", runs_sha256 string, collapsed_sha256 string"


def strongest(runs: list[Run]) -> Run:
    """The run with the most repeats, then the smallest start and period."""
    return max(runs, key=lambda run: (Fraction(run[1], run[2]), -run[0], -run[2]))


def judged(batch: pa.RecordBatch, order: Order | None, digests: bool) -> pa.RecordBatch:
    keys = batch.column(0).to_pylist()
    words, begins = cut_words(batch.column(1))
    if order:
        parts, changed = [], False
        for key, begin, end in zip(keys, begins[:-1].tolist(), begins[1:].tolist(), strict=True):
            own = order(key, end - begin)
            changed |= own is not None
            parts.append(np.arange(begin, end) if own is None else own + begin)
        words = words.take(pa.array(np.concatenate(parts))) if changed else words
    ids = np.asarray(words.dictionary_encode().indices).astype(np.int64)
    runs = periodic_runs(ids, np.repeat(np.arange(len(keys)), np.diff(begins)))
    kept, of_text = np.ones(len(ids), bool), [[] for _ in keys]
    for (place, length, period), at in zip(runs, np.searchsorted(begins, [run[0] for run in runs], "right") - 1, strict=True):
        of_text[at].append((place - int(begins[at]), length, period))
        kept[place + period : place + length] = False
    before = np.concatenate(([0], np.cumsum(kept)))[begins]
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(before, pa.int32()), words.filter(pa.array(kept))), b" ")
    best = [strongest(found) if found else (None, None, None) for found in of_text]
    columns = [
        keys,
        np.diff(begins),
        [len(found) for found in of_text],
        *([row[k] for row in best] for k in range(3)),
        [None if row[0] is None else 1000 * row[1] // row[2] for row in best],
    ]
    if digests:
        lines = ("".join(f"{s},{n},{q}\n" for s, n, q in found).encode() for found in of_text)
        columns += [[hashlib.sha256(line).hexdigest() for line in lines]]
        columns += [[hashlib.sha256(text.as_buffer()).hexdigest() for text in collapsed]]
        kinds = {k: v for k, v in COLUMNS.items() if k not in ("runs", "collapsed")} | DIGESTS
    else:
        columns += [[[dict(start=s, length=n, period=q) for s, n, q in found] for found in of_text], collapsed.cast(pa.string())]
        kinds = COLUMNS
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds.values(), strict=True)], list(kinds))


def detect(docs: DataFrame, order: Order | None = None, digests: bool = False) -> DataFrame:
    """Per document its runs, the one with the most repeats, and `collapsed`: its words without all but each run's first
    period, joined by blanks. `digests` gives the SHA-256 of both instead: of `start,length,period` lines, and of the text.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slab in slabs(batch):
                yield judged(slab, order, digests)

    read = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return read.mapInArrow(judge, DIGEST_SCHEMA if digests else SCHEMA)


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """The query's order: a tenth of the documents repeat a stretch of their words from some word on to the end."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    begin = g % n
    period = 1 + (n - begin) // (3 + g % 8)
    own = np.arange(n)
    own[begin:] = begin + (own[begin:] - begin) % period
    return own


def runs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(table(spark, sf_dir, "documents"), planted, digests=True)
