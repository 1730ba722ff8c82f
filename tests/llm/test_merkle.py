"""The Merkle manifest against a plain tree in Python; whole tables are compared with SQL in test_native.py."""

import hashlib
import zlib

import pytest

from gridwarden.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, g string, pos long, root string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return h(*("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def climbed(nodes):
    """The root, and for each node its siblings from the lowest level up as (sibling or none, whether it is on the left)."""
    steps, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(places):
            other = p ^ 1
            steps[i].append((nodes[other], other < p) if other < len(nodes) else (None, False))
        nodes = [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        places = [p // 2 for p in places]
    return nodes[0], steps


def expected(rows):
    rows = [row[:5] for row in rows]
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    groups = [sorted((r for r in rows if r[2] == v), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r))) for v in langs]
    trees = [climbed([leaf_of(*r) for r in group]) for group in groups]
    root, above = climbed([t[0] for t in trees])
    out = []
    for group, (subroot, steps), over in zip(groups, trees, above, strict=True):
        for r, own in zip(group, steps, strict=True):
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            node = leaf_of(r[0], r[1], r[2], r[3] + 1, r[4]) if changed else leaf_of(*r)
            for sibling, left in own + over:
                node = h(sibling, node) if left else h(node, sibling or "")
            proof = h(*(sibling or "" for sibling, _ in own + over))
            out.append((r[0], r[2], leaf_of(*r), subroot, root, proof, node, node == root))
    return sorted(out, key=str)


def result(spark, rows, slices=None):
    docs = spark.createDataFrame(rows, SCHEMA)
    out = merkle.manifest(docs.repartition(slices) if slices else docs)
    assert out.columns == list(merkle.RESULT)
    return sorted((tuple(r) for r in out.collect()), key=str)


def doc(i, lang="en", text="t", n_chars=1):
    return (i, f"s{i}", lang, n_chars, text, "g", 5, "root")


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [doc(3), doc(3), doc(3, text="other"), doc(None), doc(None, text=None), doc(1, None), doc(2, None, "é" * 50_000), doc(4, "é"), doc(5, "z", "", None)]
    rows += [(7, None, "", None, None, None, None, None), doc(14, "en", "x", None)]
    found = result(spark, rows)
    assert found == expected(rows)
    assert len({r[4] for r in found}) == 1


@pytest.mark.parametrize("n", [1, 2, 257, 1025])
def test_sizes_around_blocks(spark, n):
    rows = [doc(i) for i in range(n)]
    found = result(spark, rows, 5)
    assert found == expected(rows)
    assert all(r[7] != (zlib.crc32(str(r[0]).encode()) % 7 == 0) for r in found)


def test_three_levels_of_blocks_and_many_languages(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BITS", 2)
    monkeypatch.setattr(merkle, "UPPER_ROWS", 3)
    rows = [doc(i, "hot") for i in range(150)] + [doc(1000 + i, f"l{i}") for i in range(21)] + [doc(2000 + i, None) for i in range(6)] + [doc(9, "rep")] * 40
    assert result(spark, rows, 7) == expected(rows)


def test_empty_table(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_appended_witnesses_match_the_tree():
    for n in range(1, 40):
        nodes = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
        block = merkle.OpenBlock((n - 1).bit_length(), n)
        for node in nodes:
            block.append(node)
        root, steps = climbed([node.hex() for node in nodes])
        assert block.close().hex() == root
        for witness, own in zip(block.witnesses(), steps, strict=True):
            found = [(witness[at], witness[at + 1 : at + 33].hex()) for at in range(0, len(witness), 33)]
            assert found == [(merkle.ALONE, "0" * 64) if s is None else (merkle.LEFT if left else merkle.RIGHT, s) for s, left in own]
