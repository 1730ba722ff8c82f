"""Byte-pair encoding and decoding with a public vocabulary file.

Encoding: control strings are split off, the rest is composed (NFC), its blanks are folded, it is lower-cased
and cut into words; each word's UTF-8 bytes become symbols in a doubly linked list, the last with the word-end
suffix. A priority queue holds the adjacent pairs by merge rank and place; entries whose symbols have changed since
are skipped. Decoding joins the vocabulary strings of the ids by the decoder's separator (a blank where the file names
no decoder).

The vocabulary file is read on the driver and broadcast (a few MB, whatever the data's size). Words already merged are
kept per Python worker, up to `CACHED_WORDS`.

Defined cases: a null or empty text has no ids and decodes to the empty string; texts of any length are encoded whole,
in slabs of words; rows are never merged, so repeated rows repeat; other columns are kept, and columns named like the
outputs are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import islice, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridwarden.llm.common import frugal, pieces, table

CACHED_WORDS = 300_000
SLAB_WORDS = 100_000
BATCH_CHARS = 4 << 20
#: Outside these ranges Unicode versions differ in what is a letter; there the tokenizers library cuts the words.
SETTLED = [(0x00, 0x52F), (0x2010, 0x2046), (0x20AC, 0x20AC)]
BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u2028\u2029\u202f"
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_characters() -> list[str]:
    """A printable character for each byte, as byte-level vocabularies write them."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def category_class(category: str) -> str:
    """The settled characters of a Unicode category, for a bracket of a pattern."""
    chars = (chr(c) for first, last in SETTLED for c in range(first, last + 1))
    return "".join(re.escape(c) for c in chars if unicodedata.category(c)[0] == category)


def settled_patterns() -> tuple[str, str]:
    """What finds an unsettled character, and what SPLIT means for settled ones, commonest case first."""
    letters, numbers = category_class("L"), category_class("N")
    unsettled = "[^" + "".join(f"{chr(a)}-{chr(b)}" for a, b in SETTLED) + "]"
    return unsettled, f"[{letters}]+|'(?:s|t|re|ve|m|ll|d)|[{numbers}]|[^{BLANKS}{letters}{numbers}]+"


def load_vocabulary(path: str) -> dict:
    """What encoding and decoding need, as plain data that can be broadcast."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, steps = spec["model"], spec["normalizer"]["normalizers"]
    splitter = spec["pre_tokenizer"]["pretokenizers"][0]
    kinds = [step["type"] for step in steps]
    if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or splitter["pattern"]["Regex"] != SPLIT:
        raise ValueError("the file describes another kind of tokenizer")
    vocabulary = dict(model["vocab"])
    pairs = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
    rules = [(vocabulary[left], vocabulary[right], vocabulary[left + right]) for left, right in pairs]
    special = {token["content"]: token["id"] for token in spec["added_tokens"]}
    strings = [""] * (1 + max(*vocabulary.values(), *special.values()))
    for string, i in [*vocabulary.items(), *special.items()]:
        strings[i] = string
    suffix = model["end_of_word_suffix"] or ""
    letters = byte_characters()
    unsettled, words = settled_patterns()
    return {
        "ranks": {(left, right): rank for rank, (left, right, _) in enumerate(rules)},
        "rules": rules,
        "special": special,
        "strings": strings,
        "first": [vocabulary[c] for c in letters],
        "last": [vocabulary[c + suffix] for c in letters],
        "unsettled": unsettled,
        "words": words,
        "separator": " ",
        "cutter": json.dumps(
            spec | {"added_tokens": [], "model": {"type": "BPE", "vocab": {}, "merges": []}}
        ),
        "known": {},
    }


def merge_word(symbols: list[int], ranks: dict[tuple[int, int], int], rules: list[tuple[int, int, int]]) -> list[int]:
    """Applies merges by rank, leftmost first, until none is left. A queue entry is the rank and, below it, the place."""
    n = len(symbols)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    rank_of = ranks.get
    queue = [r << 32 | at for at, pair in enumerate(pairwise(symbols)) if (r := rank_of(pair)) is not None]
    heapq.heapify(queue)
    while queue:
        entry = heapq.heappop(queue)
        left, right, merged = rules[entry >> 32]
        at = entry & 0xFFFFFFFF
        follows = after[at]
        if symbols[at] != left or follows >= n or symbols[follows] != right:
            continue  # stale: one of the two has been merged since
        symbols[at], symbols[follows] = merged, -1
        after[at] = end = after[follows]
        if end < n:
            before[end] = at
            if (r := rank_of((merged, symbols[end]))) is not None:
                heapq.heappush(queue, r << 32 | at)
        begin = before[at]
        if begin >= 0 and (r := rank_of((symbols[begin], merged))) is not None:
            heapq.heappush(queue, r << 32 | begin)
    return [symbol for symbol in symbols if symbol >= 0]


def normalized(text: str) -> str:
    """Composed, each character lower-cased by itself (a final sigma is not told apart). Blanks never reach a word."""
    text = text if text.isascii() else unicodedata.normalize("NFC", text)
    return (text.replace("Σ", "σ") if "Σ" in text else text).lower()


def words_in(text: str, vocabulary: dict) -> Iterator[list[str]]:
    """The words of a text without control strings, slab by slab."""
    plain = normalized(text)
    if re.search(vocabulary["unsettled"], plain):
        if isinstance(vocabulary["cutter"], str):
            vocabulary["cutter"] = Tokenizer.from_str(vocabulary["cutter"])
            vocabulary["bytes"] = {c: b for b, c in enumerate(byte_characters())}
        cutter, to_byte = vocabulary["cutter"], vocabulary["bytes"]
        cut = cutter.pre_tokenizer.pre_tokenize_str(cutter.normalizer.normalize_str(text))
        yield [bytes(map(to_byte.__getitem__, word)).decode() for word, _ in cut]
        return
    if len(plain) <= BATCH_CHARS:
        yield re.findall(vocabulary["words"], plain)
        return
    found = re.finditer(vocabulary["words"], plain)
    while slab := [match.group() for match in islice(found, SLAB_WORDS)]:
        yield slab


def encode(text: str, vocabulary: dict) -> np.ndarray:
    """The ids of a whole text."""
    known, special = vocabulary["known"], vocabulary["special"]  # known: the ids of a word as bytes
    parts = []
    control = "|".join(map(re.escape, special))
    for piece in re.split(f"({control})", text) if any(c in text for c in special) else [text]:
        if piece in special:
            parts.append(np.int32(special[piece]).tobytes())
            continue
        for words in words_in(piece, vocabulary):
            if len(known) > CACHED_WORDS:
                known.clear()
            for word in words:
                if word not in known:
                    data = word.encode()
                    symbols = [vocabulary["first"][b] for b in data[:-1]] + [vocabulary["last"][data[-1]]]
                    known[word] = np.array(merge_word(symbols, vocabulary["ranks"], vocabulary["rules"]), np.int32).tobytes()
            parts.extend(map(known.__getitem__, words))
    return np.frombuffer(b"".join(parts), np.int32)


def decode(ids: np.ndarray, vocabulary: dict) -> str:
    return vocabulary["separator"].join(map(vocabulary["strings"].__getitem__, ids.tolist()))


def with_tokens(docs: DataFrame, tokenizer: str, decoded: bool = False) -> DataFrame:
    """The rows with `ids`, and with `decoded` also the text decoded from those ids."""
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(tokenizer))
    kept = docs.drop("ids", "decoded")

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            for piece in pieces(batch, "text"):
                yield of_rows(piece, vocabulary)

    names = kept.columns

    def of_rows(batch: pa.RecordBatch, vocabulary: dict) -> pa.RecordBatch:
        encoded = [encode(text or "", vocabulary) for text in batch.column("text").to_pylist()]
        places = np.concatenate([[0], np.cumsum([len(ids) for ids in encoded])]).astype(np.int32)
        columns = {name: batch.column(name) for name in names}
        columns["ids"] = pa.ListArray.from_arrays(places, np.concatenate(encoded))
        if decoded:
            columns["decoded"] = pa.array([decode(ids, vocabulary) for ids in encoded], pa.string())
        return pa.RecordBatch.from_pydict(columns)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(frugal(tokens), f"{fields}, ids array<int>" + (", decoded string" if decoded else ""))


def bpe_query(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents") if docs is None else docs
    tokens = with_tokens(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), decoded=True)
    return tokens.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
