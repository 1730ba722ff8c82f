"""Circulant MinHash near-dedup against brute force over all pairs."""

import os
import random
import re

import duckdb
import numpy as np

from gridwarden.llm import circulant, queries
from gridwarden.llm.ngram_join import bands_and_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def set_of(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 2]) for i in range(max(1, len(words) - 1))} if words else set()


def brute(rows):
    sets = [set_of(text) for _, text in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and 100 * common >= 80 * (len(a) + len(sets[j]) - common):
                root[max(top(i), top(j))] = min(top(i), top(j))
    parts = {}
    for i, (doc_id, _) in enumerate(rows):
        parts.setdefault(top(i), []).append(doc_id)
    least = {k: min((d for d in ids if d is not None), default=None) for k, ids in parts.items()}
    return sorted(((d, len(s), least[top(i)], d == least[top(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def found(docs):
    out = circulant.near_duplicates(docs)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_edge_rows(spark):
    rows = [(9, None), (8, ""), (7, " \n\t"), (6, "One"), (5, "oNE"), (4, "a b"), (3, "b a"), (2, "a b a b"), (1, "b a b a b"), (None, "x y z"), (11, "X Y  z"), (None, "q r")]
    rows += [(20, "é Ä ß"), (21, "é ä ß"), (22, "long word " * 300_000), (23, "word long " * 300_000), (24, "w" * 2_000_000), (6, "One"), (6, "other text here")]
    docs = spark.createDataFrame([(*row, "x", 1) for row in rows], "doc_id long, text string, set_key string, size long")
    assert found(docs) == brute(rows)
    assert found(docs.limit(0)) == []


def near_copies(n, seed, most=12):
    """Copies of a text with a few words changed, in chains that drift."""
    draw = random.Random(seed)
    words = [f"w{draw.randrange(400)}" for _ in range(80)]
    for i in range(n):
        if i % 10 == 9:
            words = [w if draw.random() > 0.08 else f"v{draw.randrange(400)}" for w in words]
        own = list(words)
        for _ in range(draw.randrange(most)):
            own[draw.randrange(len(own))] = f"u{draw.randrange(1000)}"
        yield " ".join(own)


def test_large_buckets_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(circulant, "BLOCK_TEXTS", 16)
    rows = list(enumerate([*near_copies(250, 1), *near_copies(120, 2, 3), *["same text of five words"] * 300]))
    random.Random(3).shuffle(rows)
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == brute(rows)


def test_coordinates_estimate_similarity():
    bands, rows = bands_and_rows(0.8, circulant.RECALL)
    assert 1 - (1 - 0.8**rows) ** bands >= circulant.RECALL
    draw, errors, missed = np.random.default_rng(4), [], 0
    for _ in range(300):
        both = draw.integers(0, 1 << 63, 800, dtype=np.uint64)
        a, b = (np.concatenate([both, draw.integers(0, 1 << 63, 100, dtype=np.uint64)]) for _ in range(2))
        x, y = (circulant.coordinates(s, bands * rows) for s in (a, b))
        errors.append((x == y).mean() - 0.8)
        missed += not (circulant.band_hashes(x, rows) == circulant.band_hashes(y, rows)).any()
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05 and missed <= 2


def test_query_on_whole_table(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SF_DIR}/documents.parquet'").fetchall()
    out = queries.queries()["op13_circulant_near_dedup"](spark, SF_DIR)
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute(rows)
