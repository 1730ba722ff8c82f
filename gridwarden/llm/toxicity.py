"""Toxicity of whole texts: a bidirectional recurrent network over characters and words scores all overlapping windows.

Training: up to `SAMPLE` labelled texts of each class, chosen by id hash among those of `MOST_TRAIN_CHARS` characters at
most, are collected; these bounds hold at any size of the data. Labels are of texts, not windows, so the network is
first fitted with every window of a toxic text as toxic, then twice more with each toxic text's best windows and
other texts' worst. A fifth of
the sample is kept apart to turn a text's greatest logits and its number of windows into a probability.

Scoring: every window of every text. Distinct words are projected once per batch, texts are gathered to batches of
bounded size, and long texts are scored in parts that overlap by a window.

Defined cases: null texts and texts without words have no window and get the score of no evidence; without labels of both
classes every score is 0; repeated rows repeat; other columns are kept; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwarden.llm.common import frugal, pieces, table
from gridwarden.llm.gru import WINDOW, Network, Words, sigmoid, windows_of
from gridwarden.llm.hashing import WordHasher

SAMPLE = 3000
MOST_TRAIN_CHARS = 20_000
WINDOWS_OF_TEXT = 12
SEEN_IN_TEXTS = 4
FIRST_STEPS = 140
ROUNDS = ((160, 0.006), (160, 0.004))
THRESHOLD = 0.3
BATCH_BYTES = 1 << 20
LONG_WORDS = 1 << 16
NO_EVIDENCE = -8.0
PRIOR_WEIGHTS, HOLD = np.array([0.6, 0.3, 0.3, -0.5, -1.0]), 1.0


def held_out() -> Column:
    """Whether a document is kept from training."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2


def training_texts(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray, float]:
    """A bounded sample of labelled texts for training, as even in its classes as the labels allow, and the share of toxic ones."""
    usable = labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {row["toxic"]: row["count"] for row in usable.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return [], np.empty(0), 0.5
    share = F.when(F.col("toxic") == 1, sample / counts[1]).otherwise(sample / counts[0])
    chosen = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20)).limit(3 * sample)
    short = docs.where(F.char_length("text") <= MOST_TRAIN_CHARS).select("doc_id", "text")
    rows = short.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic").limit(4 * sample).collect()
    rows = sorted(set(rows), key=lambda row: (row.doc_id, row.text))
    prior = counts[1] / (counts[0] + counts[1])
    return [row.text for row in rows], np.array([row.toxic for row in rows], np.float32), prior


def ranked(logits: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Each text's greatest, second and fourth logit, or its least if it has fewer, and the log of its number of windows.

    A word lies in two windows, so the fourth tells whether a second word agrees with the first.
    """
    out = np.full((n, 4), NO_EVIDENCE, np.float32)
    order = np.lexsort((-logits, text))
    first = np.searchsorted(text[order], np.arange(n))
    count = np.bincount(text, minlength=n)
    some = np.flatnonzero(count > 0)
    for column, place in enumerate((0, 1, 3)):
        out[some, column] = logits[order[first[some] + np.minimum(place, count[some] - 1)]]
    out[:, 3] = np.log1p(count)
    return np.clip(out, NO_EVIDENCE, -NO_EVIDENCE)


def calibrated(features: np.ndarray, target: np.ndarray, prior: float) -> np.ndarray:
    """Weights of a logistic regression by Newton's method, held near PRIOR_WEIGHTS where there is little data.

    The sample's classes are weighted so that their shares are those of all labels.
    """
    share = target.mean()
    rows = np.where(target > 0, prior / max(share, 1e-6), (1 - prior) / max(1 - share, 1e-6))
    x, weights = np.hstack([features, np.ones((len(features), 1))]).astype(np.float64), PRIOR_WEIGHTS.copy()

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return (rows * (np.logaddexp(0, z) - target * z)).sum() + HOLD / 2 * ((w - PRIOR_WEIGHTS) ** 2).sum()

    for _ in range(30):
        p = sigmoid(x @ weights)
        gradient = x.T @ (rows * (p - target)) + HOLD * (weights - PRIOR_WEIGHTS)
        step = np.linalg.solve(x.T @ (x * (rows * p * (1 - p))[:, None]) + HOLD * np.eye(len(weights)), gradient)
        while loss(weights - step) > loss(weights) and np.abs(step).max() > 1e-9:
            step /= 2
        weights = weights - step
    return weights


class Model:
    """A trained network and its calibration."""

    def __init__(self, texts: list[str], toxic: np.ndarray, prior: float):
        self.network, self.weights = None, None
        if not len(toxic) or toxic.min() == toxic.max():
            return
        hasher, data = WordHasher(), [text.encode() for text in texts]
        words = Words.of_many(data, hasher)
        begin, text = windows_of(words.offsets)
        apart = np.arange(len(texts)) % 5 == 4
        make = np.random.default_rng(1)
        order = make.permutation(len(begin))
        rank = np.empty(len(begin), np.int64)
        by_text = order[np.argsort(text[order], kind="stable")]
        rank[by_text] = np.arange(len(begin)) - np.searchsorted(text[by_text], text[by_text])
        chosen = np.flatnonzero((rank < WINDOWS_OF_TEXT) & ~apart[text])
        in_texts = np.unique(np.repeat(np.arange(len(texts)), np.diff(words.offsets)) * len(words.hashes) + words.index)
        seen = np.bincount(in_texts % max(len(words.hashes), 1), minlength=len(words.hashes))
        self.network = Network(words.hashes[seen >= SEEN_IN_TEXTS])
        self.network.fit(words, begin[chosen], text[chosen], toxic[text[chosen]], steps=FIRST_STEPS)
        for steps, rate in ROUNDS:
            logits, _ = self.network.logits(words)
            best = np.lexsort((-logits, text))
            place = np.empty(len(begin), np.int64)
            place[best] = np.arange(len(begin)) - np.searchsorted(text[best], text[best])
            positive = (toxic[text] == 1) & (place < 3) & (logits > np.quantile(logits[toxic[text] == 0], 0.9))
            negative = (toxic[text] == 0) & ((rank < WINDOWS_OF_TEXT // 2) | (place < 4))
            chosen = np.flatnonzero((positive | negative) & ~apart[text])
            self.network.fit(words, begin[chosen], text[chosen], toxic[text[chosen]], steps=steps, rate=rate)
        logits, _ = self.network.logits(words)
        features = ranked(logits, text, len(texts))
        self.weights = calibrated(features[apart], toxic[apart], prior)

    def plain(self) -> dict | None:
        """Arrays only, to be broadcast."""
        if self.network is None:
            return None
        return {"vocabulary": self.network.vocabulary, "p": self.network.p, "weights": self.weights}

    @classmethod
    def of_plain(cls, plain: dict | None) -> Model:
        model = cls([], np.empty(0), 0.5)
        if plain is not None:
            model.network, model.weights = Network(plain["vocabulary"][:0]), plain["weights"]
            model.network.vocabulary, model.network.p = plain["vocabulary"], plain["p"]
        return model

    def scores(self, texts: list[str | None], hasher: WordHasher) -> np.ndarray:
        """The probability of each text."""
        if self.network is None:
            return np.zeros(len(texts))
        features = np.full((len(texts), 4), NO_EVIDENCE, np.float32)
        features[:, 3] = 0
        held, size = [], 0
        for at, text in enumerate([*texts, None]):
            data = (text or "").encode()
            if at == len(texts) or size + len(data) > BATCH_BYTES:
                if held:
                    self.score_batch(features, held, hasher)
                held, size = [], 0
            if len(data) > BATCH_BYTES:
                features[at] = self.long_features(data, hasher)
            elif data:
                held.append((at, data))
                size += len(data)
        return sigmoid(np.hstack([features, np.ones((len(texts), 1))]) @ self.weights)

    def score_batch(self, features: np.ndarray, held: list[tuple[int, bytes]], hasher: WordHasher) -> None:
        logits, text = self.network.logits(Words([data for _, data in held], hasher))
        features[[at for at, _ in held]] = ranked(logits, text, len(held))

    def long_features(self, data: bytes, hasher: WordHasher) -> np.ndarray:
        """Features of a text of any length, from parts that share WINDOW words."""
        best, count, at = [], 0, 0
        while at < len(data):
            end = min(at + BATCH_BYTES, len(data))
            while end < len(data) and hasher.is_word[data[end]]:
                end += 1
            part = data[at:end]
            begin, _ = hasher.chunk(part)
            logits, _ = self.network.logits(Words([part], hasher))
            best = sorted([*best, *logits.tolist()], reverse=True)[:4]
            count += len(logits)
            back = begin[-WINDOW] if end < len(data) and len(begin) > 2 * WINDOW else len(part)
            at += int(back)
        found = [best[min(place, len(best) - 1)] if best else NO_EVIDENCE for place in (0, 1, 3)]
        return np.clip([*found, np.log1p(count)], NO_EVIDENCE, -NO_EVIDENCE)


def with_scores(docs: DataFrame, labels: DataFrame, name: str = "score") -> DataFrame:
    """The rows with a score in the column `name`, by a network trained on the labels of rows that aren't held out."""
    shared = docs.sparkSession.sparkContext.broadcast(Model(*training_texts(docs, labels)).plain())
    kept = docs.drop(name)
    names, fields = kept.columns, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, model = WordHasher(), None
        for whole in batches:
            model = model or Model.of_plain(shared.value)
            for batch in pieces(whole, "text"):
                columns = {kept_name: batch.column(kept_name) for kept_name in names}
                columns[name] = pa.array(model.scores(batch.column("text").to_pylist(), hasher), pa.float64())
                yield pa.RecordBatch.from_pydict(columns)

    return kept.mapInArrow(frugal(scored), f"{fields}, {name} double")


def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = with_scores(docs, table(spark, sf_dir, "labels"))
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"))


def clean_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score stays below the threshold, with their columns."""
    return with_scores(docs, labels, "score__").where(F.col("score__") < threshold).select(docs.columns)
