"""A bidirectional gated recurrent network with attention pooling, in numpy: forward, backward, training.

A word's input joins a word vector (for words of a vocabulary; zero for others) and the mean of the vectors of its
character three- and four-grams. Everything the recurrence needs from a word is one projected row, so scoring projects
each distinct word of a batch once and then only gathers rows.
"""

from __future__ import annotations

import numpy as np

from gridwarden.llm.hashing import WordHasher, mixed

WINDOW, STRIDE = 32, 16
WORD_DIM, CHAR_DIM, HIDDEN = 8, 12, 8
GRAM_BUCKETS = 1 << 15
#: Words projected at once.
SLAB = 8192
#: Stands for what lies before and after a word.
EDGE = np.uint64(8)


class Words:
    """The distinct words of some texts: their hashes, their character grams, and each text's words as indexes."""

    def __init__(self, texts: list[bytes], hasher: WordHasher):
        data = b" ".join(texts) + b" "
        begin, hashes = hasher.chunk(data)
        cuts = np.searchsorted(begin, np.cumsum([len(t) + 1 for t in texts]))
        self.offsets = np.concatenate([[0], cuts])
        self.hashes, first, self.index = np.unique(hashes, return_index=True, return_inverse=True)
        raw = hasher.value[np.frombuffer(data, np.uint8)]
        inside = hasher.is_word[np.frombuffer(data, np.uint8)]
        stops = np.flatnonzero(np.diff(np.concatenate([inside, [False]]).astype(np.int8)) == -1) + 1
        self.grams, self.gram_offsets = character_grams(raw, begin[first], stops[first])

    @classmethod
    def of_many(cls, texts: list[bytes], hasher: WordHasher, size: int = 1 << 20) -> Words:
        """The same for any number of texts, worked through in groups of bounded size."""
        ends = np.cumsum([len(text) for text in texts]) // size
        groups = np.split(np.arange(len(texts)), np.flatnonzero(np.diff(ends)) + 1)
        parts = [cls([texts[at] for at in group], hasher) for group in groups]
        out = cls.__new__(cls)
        begins = np.cumsum([0, *(len(part.hashes) for part in parts)])
        out.hashes, first, place = np.unique(np.concatenate([part.hashes for part in parts]), return_index=True, return_inverse=True)
        out.index = np.concatenate([place[begin + part.index] for begin, part in zip(begins, parts, strict=False)])
        out.offsets = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(part.offsets) for part in parts]))])
        lengths = np.concatenate([np.diff(part.gram_offsets) for part in parts])
        starts = (np.cumsum(lengths) - lengths)[first]
        lengths = lengths[first]
        out.gram_offsets = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat(starts - out.gram_offsets[:-1], lengths) + np.arange(out.gram_offsets[-1])
        out.grams = np.concatenate([part.grams for part in parts])[at]
        return out


def character_grams(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the three- and four-grams around each byte of the given words, ends of words included."""
    length = end - begin
    if not len(length):
        return np.empty(0, np.uint16), np.zeros(1, np.int64)
    first = np.concatenate([[0], np.cumsum(length + 1)])  # a word of n bytes has n + 1 places, the last its end
    place = np.arange(first[-1]) - np.repeat(first[:-1], length + 1)
    at, size = np.repeat(begin, length + 1) + place, np.repeat(length, length + 1)
    take = lambda k: np.where((place + k >= 0) & (place + k < size), values[np.clip(at + k, 0, len(values) - 1)], EDGE)
    a, b, c, d = take(-2), take(-1), take(0), take(1)
    three = mixed(b * np.uint64(3) + c * np.uint64(5) + d * np.uint64(7))
    four = mixed(three + a * np.uint64(11) + np.uint64(1))
    grams = np.stack([three, four], axis=1).reshape(-1) % np.uint64(GRAM_BUCKETS)
    return grams.astype(np.uint16), 2 * first


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def windows_of(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin of every overlapping window, and the text that it is of; the last window of a text may be short."""
    counts = np.diff(offsets)
    per_text = np.where(counts > 0, np.maximum(1, -(-(counts - WINDOW) // STRIDE) + 1), 0)
    text = np.repeat(np.arange(len(counts)), per_text)
    number = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    return offsets[text] + number * STRIDE, text


class Network:
    """Parameters and computations."""

    def __init__(self, vocabulary: np.ndarray, seed: int = 7):
        make = np.random.default_rng(seed)
        draw = lambda *shape, scale: (make.normal(size=shape) * scale).astype(np.float32)
        self.vocabulary = np.sort(vocabulary)
        width = WORD_DIM + CHAR_DIM
        self.p = {
            "words": draw(len(vocabulary) + 1, WORD_DIM, scale=0.1),
            "chars": draw(GRAM_BUCKETS, CHAR_DIM, scale=0.3),
            "v": draw(2 * HIDDEN, scale=0.3),
            "w": draw(2 * HIDDEN, scale=0.3),
            "c": np.zeros(1, np.float32),
        }
        for side in "fb":
            self.p[f"x{side}"] = draw(width, 3 * HIDDEN, scale=0.4)
            self.p[f"u{side}"] = draw(HIDDEN, 3 * HIDDEN, scale=0.3)
            self.p[f"c{side}"] = np.zeros(3 * HIDDEN, np.float32)

    def word_rows(self, hashes: np.ndarray) -> np.ndarray:
        """The row of each word's vector; the last row stands for words outside the vocabulary."""
        at = np.searchsorted(self.vocabulary, hashes)
        known = self.vocabulary[np.minimum(at, len(self.vocabulary) - 1)] == hashes if len(self.vocabulary) else np.zeros(len(hashes), bool)
        return np.where(known, at, len(self.vocabulary))

    def inputs(self, words: Words) -> np.ndarray:
        """The input of each distinct word."""
        vectors = np.zeros((len(words.hashes), WORD_DIM + CHAR_DIM), np.float32)
        if len(words.hashes):
            table = self.p["words"].copy()
            table[-1] = 0
            vectors[:, :WORD_DIM] = table[self.word_rows(words.hashes)]
            offsets = words.gram_offsets
            for at in range(0, len(words.hashes), SLAB):  # the gathered rows are many times larger than their sums
                own = offsets[at : at + SLAB + 1]
                sums = np.add.reduceat(self.p["chars"][words.grams[own[0] : own[-1]]], own[:-1] - own[0], axis=0)
                vectors[at : at + SLAB, WORD_DIM:] = sums / np.sqrt(np.diff(own))[:, None]
        return vectors

    def scan(self, side: str, rows: np.ndarray, mask: np.ndarray, keep: bool):
        """Hidden states along the windows; rows are projected inputs (steps, windows, 3 * HIDDEN)."""
        u, h, states, trace = self.p[f"u{side}"], np.zeros((rows.shape[1], HIDDEN), np.float32), [None] * len(rows), []
        for t in range(len(rows)) if side == "f" else range(len(rows) - 1, -1, -1):
            hu = h @ u
            gates = sigmoid(rows[t, :, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            n = 2 * sigmoid(2 * (rows[t, :, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])) - 1
            m = mask[t][:, None]
            new = n + z * (h - n)
            if keep:
                trace.append((t, h, z, r, n, hu[:, 2 * HIDDEN :]))
            h = np.where(m, new, h)
            states[t] = h
        return np.stack(states), trace

    def pooled(self, states: np.ndarray, mask: np.ndarray):
        """Logits, attention weights and context of each window."""
        e = np.where(mask, states @ self.p["v"], -1e9)
        a = np.exp(e - e.max(axis=0))
        a /= a.sum(axis=0)
        context = np.einsum("tn,tnd->nd", a, states)
        return context @ self.p["w"] + self.p["c"], a, context

    def logits(self, words: Words, step: int = 4096) -> tuple[np.ndarray, np.ndarray]:
        """The logit of every window, and the text that it is of."""
        begin, text = windows_of(words.offsets)
        vectors = self.inputs(words)
        projected = {side: vectors @ self.p[f"x{side}"] + self.p[f"c{side}"] for side in "fb"}
        out = np.empty(len(begin), np.float32)
        for at in range(0, len(begin), step):
            part = slice(at, at + step)
            place = begin[part][None, :] + np.arange(WINDOW)[:, None]
            mask = place < words.offsets[text[part] + 1][None, :]
            steps = max(1, int(mask.any(axis=1).sum()))
            place, mask = place[:steps], mask[:steps]
            index = words.index[np.minimum(place, len(words.index) - 1)]
            sides = [self.scan(side, projected[side][index], mask, False)[0] for side in "fb"]
            out[part] = self.pooled(np.concatenate(sides, axis=2), mask)[0]
        return out, text

    def gradients(self, vectors: np.ndarray, index: np.ndarray, mask: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the weighted log loss for the parameters and for the distinct words' inputs."""
        g = {}
        rows = {side: (vectors @ self.p[f"x{side}"] + self.p[f"c{side}"])[index] for side in "fb"}
        run = {side: self.scan(side, rows[side], mask, True) for side in "fb"}
        states = np.concatenate([run[side][0] for side in "fb"], axis=2)
        logit, a, context = self.pooled(states, mask)
        dl = ((sigmoid(logit) - target) * weight / weight.sum()).astype(np.float32)
        g["w"], g["c"] = context.T @ dl, dl.sum(keepdims=True)
        dc = dl[:, None] * self.p["w"]
        da = np.einsum("tnd,nd->tn", states, dc)
        de = a * (da - (a * da).sum(axis=0))
        g["v"] = np.einsum("tn,tnd->d", de, states)
        ds = a[:, :, None] * dc[None] + de[:, :, None] * self.p["v"]
        dv = np.zeros_like(vectors)
        for k, side in enumerate("fb"):
            u, dh = self.p[f"u{side}"], np.zeros((index.shape[1], HIDDEN), np.float32)
            du, drows = np.zeros_like(u), np.zeros_like(rows[side])
            own = ds[:, :, k * HIDDEN : (k + 1) * HIDDEN]
            for t, h, z, r, n, hn in reversed(run[side][1]):
                dh = dh + own[t]
                m = mask[t][:, None]
                dnew = np.where(m, dh, 0)
                dn = dnew * (1 - z) * (1 - n * n)
                dz = dnew * (h - n) * z * (1 - z)
                dr = dn * hn * r * (1 - r)
                dhu = np.concatenate([dz, dr, dn * r], axis=1)
                drows[t] = np.concatenate([dz, dr, dn], axis=1)
                du += h.T @ dhu
                dh = np.where(m, dnew * z, dh) + dhu @ u.T
            flat = drows.reshape(-1, 3 * HIDDEN)
            summed = np.zeros((len(vectors), 3 * HIDDEN), np.float32)
            np.add.at(summed, index.reshape(-1), flat)
            g[f"u{side}"], g[f"c{side}"] = du, flat.sum(axis=0)
            g[f"x{side}"] = vectors.T @ summed
            dv += summed @ self.p[f"x{side}"].T
        return g, dv

    def fit(self, words: Words, begin: np.ndarray, text: np.ndarray, target: np.ndarray, steps: int, rate: float = 0.01, batch: int = 512, seed: int = 3) -> None:
        """Adam over the given windows; known words are hidden at random, so that characters are learned too."""
        make = np.random.default_rng(seed)
        weight = np.where(target > 0, 0.5 / max(target.mean(), 1e-6), 0.5 / max(1 - target.mean(), 1e-6)).astype(np.float32)
        moments = {name: [np.zeros_like(value), np.zeros_like(value)] for name, value in self.p.items()}
        word_row, count = self.word_rows(words.hashes), 0
        while count < steps:
            order = make.permutation(len(begin))
            for at in range(0, min(len(order), batch * (steps - count)), batch):
                chosen = order[at : at + batch]
                place = begin[chosen][None, :] + np.arange(WINDOW)[:, None]
                mask = place < words.offsets[text[chosen] + 1][None, :]
                used, index = np.unique(words.index[np.minimum(place, len(words.index) - 1)], return_inverse=True)
                index = index.reshape(place.shape)
                rows = np.where(make.random(len(used)) < 0.4, len(self.vocabulary), word_row[used])
                lengths = np.diff(words.gram_offsets)[used]
                gram_at = np.repeat(words.gram_offsets[used] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
                grams, owner = words.grams[gram_at], np.repeat(np.arange(len(used)), lengths)
                scale = (1 / np.sqrt(lengths)).astype(np.float32)
                vectors = np.zeros((len(used), WORD_DIM + CHAR_DIM), np.float32)
                vectors[:, :WORD_DIM] = self.p["words"][rows] * (rows < len(self.vocabulary))[:, None]
                vectors[:, WORD_DIM:] = np.add.reduceat(self.p["chars"][grams], np.cumsum(lengths) - lengths, axis=0) * scale[:, None]
                g, dv = self.gradients(vectors, index, mask, target[chosen], weight[chosen])
                g["words"], g["chars"] = np.zeros_like(self.p["words"]), np.zeros_like(self.p["chars"])
                np.add.at(g["words"], rows, dv[:, :WORD_DIM])
                np.add.at(g["chars"], grams, (dv[:, WORD_DIM:] * scale[:, None])[owner])
                count += 1
                for name, grad in g.items():
                    first, second = moments[name]
                    first += 0.1 * (grad - first)
                    second += 0.01 * (grad * grad - second)
                    step = first / (1 - 0.9**count) / (np.sqrt(second / (1 - 0.99**count)) + 1e-6)
                    self.p[name] -= (rate * step).astype(np.float32)
