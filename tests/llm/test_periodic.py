"""Periodic runs against brute force: random words, edge cases, and the registered query on whole tables."""

import hashlib
import os
import re
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridwarden.llm import periodic, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    """All runs, straight from their definition."""
    n, found, seen = len(words), [], set()
    for q in range(1, n // 4 + 1):
        at = 0
        while at + q < n:
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end - at + q
            if length >= max(6, 4 * q) and (at, length) not in seen:
                seen.add((at, length))
                found.append((at, length, q))
            at = max(end, at) + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words, brute(words)


def row_of(doc_id, text):
    words, runs = expected(doc_id, text)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    return {
        "doc_id": doc_id, "n_words": len(words), "n_runs": len(runs), "start": best[0], "length": best[1], "period": best[2],
        "exponent_milli": 1000 * best[1] // best[2] if runs else None,
        "runs_sha256": sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
        "collapsed_sha256": sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    }


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), min_size=1, max_size=4))
def test_runs_of_random_words(texts):
    ids = np.array([w for text in texts for w in text], np.int64)
    found = periodic.periodic_runs(ids, np.repeat(np.arange(len(texts)), [len(t) for t in texts]))
    at, wanted = 0, []
    for text in texts:
        wanted += [(s + at, n, q) for s, n, q in brute(text)]
        at += len(text)
    assert found == wanted


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=5), st.integers(1, 9)), max_size=6))
def test_runs_of_repeated_pieces(pieces):
    words = [w for piece, times in pieces for w in piece * times]
    assert periodic.periodic_runs(np.array(words, np.int64), np.zeros(len(words), np.int64)) == brute(words)


@pytest.mark.parametrize("words", [["a"] * 300_000, ["a", "b", "a"] * 100_000, [str(i % 40_000) for i in range(200_000)]])
def test_long_runs_cost_their_length_once(words):
    ids = np.unique(words, return_inverse=True)[1].astype(np.int64)
    found = periodic.periodic_runs(ids, np.zeros(len(ids), np.int64))
    assert [(s, n) for s, n, _ in found] == [(0, len(ids))]


def test_few_words_without_runs_stay_fast():
    ids = np.random.default_rng(1).integers(0, 50, 200_000)
    found = periodic.periodic_runs(ids, np.zeros(len(ids), np.int64))
    assert all(n >= max(6, 4 * q) for _, n, q in found)


def test_edge_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n", "x"), (4, "a a a a a a", "x"), (4, "a a a a a a", "x"), (None, "b c " * 5, "x")]
    rows += [(5, "a a a a a", "x"), (6, "a\x85a   " * 3 + "é é é é é é", "x"), (7, "x y\x0b" * 400, "x"), (10, "q", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    out = periodic.detect(docs, periodic.planted, digests=True).collect()
    key = lambda row: str(sorted(row.items()))
    assert sorted((r.asDict() for r in out), key=key) == sorted((row_of(*row[:2]) for row in rows), key=key)
    texts = {(r.doc_id, r.collapsed) for r in periodic.detect(docs).collect()}
    assert {(4, "a"), (7, "x y"), (None, "b c"), (1, ""), (5, "a a a a a")} <= texts
    assert periodic.detect(docs.limit(0)).collect() == []


def test_query_on_whole_table(spark):
    out = [r.asDict() for r in queries.queries()["op12_periodic_runs"](spark, SF_DIR).collect()]
    rows = duckdb.sql(f"select doc_id, text from '{SF_DIR}/documents.parquet'").fetchall()
    assert sorted(out, key=lambda r: r["doc_id"]) == [row_of(*row) for row in sorted(rows)]
    assert sum(r["n_runs"] > 0 for r in out) > 5
