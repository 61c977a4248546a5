"""Toxicity: a bidirectional gated recurrent network with attention pooling over windows of words.

A word enters the network with three parts: how far its share of toxic documents lies from the share in all (a number
learnt from labelled rows), a learnt vector of its hash, and the mean of learnt vectors of its character trigrams.
Two gated recurrent layers read a window in both directions, attention weighs their states, and a linear layer
gives the window's logit. Windows have ``WINDOW`` words and start every ``STRIDE`` words, so they overlap and cover the
whole text; a document has the logit of its highest window, turned into a score by a fitted sigmoid.

The network is trained in numpy on at most ``TOXIC_ROWS`` toxic and ``CLEAN_ROWS`` clean labelled rows of at most
``LONGEST_ROW`` characters (those with the smallest hash of their id), in four folds. While it trains, a document is read with
the shares that the other folds give; one fold is left to the sigmoid and to find when to stop. Labels are of documents, so in every round a document
trains through the window that scores highest, and clean documents through two more on average.

Scoring gathers the distinct words of some documents, projects each once for all gates, and runs the windows
side by side. Memory per step is bounded, also for a very long text.

Defined results: a NULL or empty text, or one without words, has one empty window and gets a score. Labels that are NULL or have
a NULL id are not used; of several labels the majority counts, clean if equal. With labels of one class only, or none, every
score is the share of toxic labels (0 without labels). Rows with equal texts get equal scores up to rounding. Extra columns
are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Shared, in_train, map_batches, smallest_hashes, table
from millrace.llm.quality import fit_sigmoid, one_label
from millrace.session import materialise

HELD_OUT = (4, 2)  # rows whose checksum of the id leaves remainder 2 by 4 are not learnt from
THRESHOLD = 0.3
WINDOW, STRIDE = 32, 16
TOXIC_ROWS, CLEAN_ROWS, LONGEST_ROW = 1_000, 2_000, 20_000
SHARE_BITS, WORD_BITS, GRAM_BITS = 18, 12, 12
VECTOR, HIDDEN, ATTEND = 8, 8, 8
INPUT = 1 + 2 * VECTOR
FOLDS, STEPS, PATIENCE = 4, 600, 4
STEP, TABLE_STEP = 0.01, 0.001

WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(WORD_BYTES).split()


class Words:
    """Distinct words with their hashes: ``code`` for shares and vectors, and runs of trigram hashes."""

    def __init__(self, words: list[bytes]):
        self.code = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        text = np.frombuffer(b" " + b" ".join(words) + b"  ", np.uint8).astype(np.uint32)
        mixed = (text[:-2] * np.uint32(961) + text[1:-1] * np.uint32(31) + text[2:]) * np.uint32(2654435761)
        self.gram = (mixed >> np.uint32(32 - GRAM_BITS)).astype(np.int64)
        self.start = np.concatenate(([0], np.cumsum(self.size + 1)[:-1])).astype(np.int64) if words else np.zeros(0, np.int64)
        if words:  # the trigram that spans two words counts for none
            self.gram[self.start + self.size] = 1 << GRAM_BITS
            self.gram = self.gram[: self.start[-1] + self.size[-1] + 1]

    @property
    def share(self) -> np.ndarray:
        return (self.code >> np.uint32(32 - SHARE_BITS)).astype(np.int64)

    @property
    def bucket(self) -> np.ndarray:
        return (self.code & np.uint32((1 << WORD_BITS) - 1)).astype(np.int64)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """The parameters, and the passes over windows given as rows of word numbers (-1: no word)."""

    def __init__(self, shares: np.ndarray, seed: int = 0):
        random = np.random.default_rng(seed)
        normal = lambda *shape: random.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        self.shares = shares.astype(np.float32)
        self.calibration = (1.0, 0.0)
        self.p = {
            "word": 0.1 * random.normal(size=(1 << WORD_BITS, VECTOR)).astype(np.float32),
            "gram": 0.1 * random.normal(size=((1 << GRAM_BITS) + 1, VECTOR)).astype(np.float32),
            "attend": normal(2 * HIDDEN, ATTEND), "attend_bias": np.zeros(ATTEND, np.float32), "pick": normal(ATTEND),
            "out": normal(2 * HIDDEN), "out_bias": np.zeros(1, np.float32),
        }
        self.p["gram"][-1] = 0
        for side in "fb":
            self.p |= {f"in_{side}": normal(INPUT, 3 * HIDDEN), f"bias_{side}": np.zeros(3 * HIDDEN, np.float32), f"state_{side}": normal(HIDDEN, 3 * HIDDEN)}

    def inputs(self, words: Words, word_share: np.ndarray | None = None) -> np.ndarray:
        x = np.empty((len(words.code), INPUT), np.float32)
        x[:, 0] = self.shares[words.share] if word_share is None else word_share[: len(words.code)]
        x[:, 1 : 1 + VECTOR] = self.p["word"][words.bucket]
        if len(words.code):
            sums = np.add.reduceat(self.p["gram"][words.gram], words.start, axis=0)
            x[:, 1 + VECTOR :] = sums / words.size[:, None]
        return x

    def logits(self, words: Words, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray, at_once: int = 4096, word_share: np.ndarray | None = None) -> np.ndarray:
        """The logit of each window ``flat[start:end]`` of word numbers; ``word_share`` stands in for the shares."""
        x = self.inputs(words, word_share)
        gates = {s: np.concatenate((x @ self.p[f"in_{s}"] + self.p[f"bias_{s}"], np.zeros((1, 3 * HIDDEN), np.float32))) for s in "fb"}
        out = [np.zeros(0, np.float32)]
        for k in range(0, len(starts), at_once):
            ids = window_ids(flat, starts[k : k + at_once], ends[k : k + at_once])
            out.append(self.forward({s: gates[s][ids] for s in "fb"}, ids >= 0)["logit"])
        return np.concatenate(out)

    def forward(self, gates: dict[str, np.ndarray], mask: np.ndarray, keep: bool = False) -> dict:
        """``gates``: per direction windows x positions x (reset, update, new) inputs."""
        n, length = mask.shape
        states = np.empty((n, length, 2 * HIDDEN), np.float32)
        saved: dict = {"f": [], "b": []}
        weight = mask.astype(np.float32)[:, :, None]
        for side, order, part in (("f", range(length), slice(0, HIDDEN)), ("b", range(length - 1, -1, -1), slice(HIDDEN, None))):
            state = np.zeros((n, HIDDEN), np.float32)
            matrix = self.p[f"state_{side}"]
            for t in order:
                x, m = gates[side][:, t], weight[:, t]
                s = state @ matrix
                both = sigmoid(x[:, : 2 * HIDDEN] + s[:, : 2 * HIDDEN])
                reset, update = both[:, :HIDDEN], both[:, HIDDEN:]
                new = np.tanh(x[:, 2 * HIDDEN :] + reset * s[:, 2 * HIDDEN :])
                if keep:
                    saved[side].append((t, state, reset, update, new, s[:, 2 * HIDDEN :]))
                state = state + m * (1 - update) * (new - state)
                states[:, t, part] = state
        hidden = np.tanh(states @ self.p["attend"] + self.p["attend_bias"])
        weights = np.where(mask, hidden @ self.p["pick"], -np.inf)
        top = np.where(mask.any(1), weights.max(1), 0)[:, None]
        weights = np.exp(weights - top)
        weights /= np.maximum(weights.sum(1, keepdims=True), 1e-30)
        pooled = (weights[:, :, None] * states).sum(1)
        logit = pooled @ self.p["out"] + self.p["out_bias"][0]
        return {"logit": logit, "states": states, "hidden": hidden, "weights": weights, "pooled": pooled, "saved": saved, "mask": weight}

    def gradients(self, words: Words, ids: np.ndarray, target: np.ndarray, share: np.ndarray | None = None) -> tuple[float, dict[str, np.ndarray]]:
        """Mean logistic loss of some windows and its gradient by every parameter; ``share`` stands in for the shares."""
        p = self.p
        used, local = np.unique(ids, return_inverse=True)
        local = local.reshape(ids.shape)
        x = np.zeros((len(used), INPUT), np.float32)
        sub = subset(words, used[used >= 0])
        x[used >= 0] = self.inputs(sub)
        placed = x[local]
        if share is not None:
            placed[:, :, 0] = share
        g = self.forward({s: placed @ p[f"in_{s}"] + p[f"bias_{s}"] for s in "fb"}, ids >= 0, keep=True)
        n = len(ids)
        chance = sigmoid(g["logit"])
        loss = float(np.mean(np.logaddexp(0, g["logit"]) - target * g["logit"]))
        d_logit = ((chance - target) / n).astype(np.float32)
        d = {"out": g["pooled"].T @ d_logit, "out_bias": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * p["out"]
        d_states = g["weights"][:, :, None] * d_pooled[:, None]
        d_weight = (g["states"] * d_pooled[:, None]).sum(2)
        d_weight = g["weights"] * (d_weight - (g["weights"] * d_weight).sum(1, keepdims=True))
        d["pick"] = np.einsum("nt,nth->h", d_weight, g["hidden"])
        d_hidden = d_weight[:, :, None] * p["pick"] * (1 - g["hidden"] ** 2)
        d["attend"] = np.einsum("ntk,nth->kh", g["states"], d_hidden)
        d["attend_bias"] = d_hidden.sum((0, 1))
        d_states += d_hidden @ p["attend"].T
        d_x = np.zeros((*ids.shape, INPUT), np.float32)
        for side, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
            matrix = p[f"state_{side}"]
            d_gate = np.zeros((*ids.shape, 3 * HIDDEN), np.float32)
            d_matrix = np.zeros_like(matrix)
            carry = np.zeros((n, HIDDEN), np.float32)
            for t, before, reset, update, new, s_new in reversed(g["saved"][side]):
                m = g["mask"][:, t]
                total = carry + d_states[:, t, part]
                through = total * m
                d_new = through * (1 - update) * (1 - new**2)
                d_update = through * (before - new) * update * (1 - update)
                d_reset = d_new * s_new * reset * (1 - reset)
                inner = np.concatenate((d_reset, d_update, d_new * reset), axis=1)
                d_gate[:, t] = np.concatenate((d_reset, d_update, d_new), axis=1)
                d_matrix += before.T @ inner
                carry = total * (1 - m) + through * update + inner @ matrix.T
            d[f"state_{side}"] = d_matrix
            d[f"bias_{side}"] = (d_gate * g["mask"]).sum((0, 1))
            d[f"in_{side}"] = np.einsum("ntk,nth->kh", placed * g["mask"], d_gate)
            d_x += d_gate @ p[f"in_{side}"].T
        by_word = np.zeros((len(used), INPUT), np.float32)
        np.add.at(by_word, local.ravel(), (d_x * g["mask"]).reshape(-1, INPUT))
        by_word = by_word[used >= 0]
        d["word"] = np.zeros_like(p["word"])
        np.add.at(d["word"], sub.bucket, by_word[:, 1 : 1 + VECTOR])
        d["gram"] = np.zeros_like(p["gram"])
        lengths = np.diff(np.append(sub.start, len(sub.gram)))
        np.add.at(d["gram"], sub.gram, np.repeat(by_word[:, 1 + VECTOR :] / sub.size[:, None], lengths, axis=0))
        d["gram"][-1] = 0
        return loss, d

    def document_logits(self, words: Words, flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The highest window logit of each document ``flat[bounds[i]:bounds[i + 1]]``."""
        starts, ends, first = windows(bounds)
        return np.maximum.reduceat(self.logits(words, flat, starts, ends), first)

    def score(self, logit: np.ndarray) -> np.ndarray:
        slope, shift = self.calibration
        return 1 / (1 + np.exp(-np.clip(slope * logit.astype(np.float64) + shift, -500, 500)))


def subset(words: Words, chosen: np.ndarray) -> Words:
    out = Words.__new__(Words)
    out.code, out.size = words.code[chosen], words.size[chosen]
    out.start = np.concatenate(([0], np.cumsum(out.size)[:-1])).astype(np.int64) if len(chosen) else np.zeros(0, np.int64)
    out.gram = words.gram[np.arange(out.size.sum()) - np.repeat(out.start - words.start[chosen], out.size)]
    return out


def windows(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all windows, and the first window of each document; every document has one at least."""
    sizes = np.diff(bounds)
    counts = np.maximum(1, -(-(sizes - WINDOW) // STRIDE) + 1)
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    place = np.arange(counts.sum()) - np.repeat(first, counts)
    starts = np.repeat(bounds[:-1], counts) + STRIDE * place
    return starts, np.minimum(starts + WINDOW, np.repeat(bounds[1:], counts)), first


def window_ids(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(flat):
        return np.full((len(starts), WINDOW), -1)
    at = starts[:, None] + np.arange(WINDOW)
    return np.where(at < ends[:, None], flat[np.minimum(at, len(flat) - 1)], -1)


def number(texts: list[str | None]) -> tuple[Words, np.ndarray, np.ndarray]:
    """The distinct words of some texts, all texts as word numbers, and where each text begins."""
    numbers: dict[bytes, int] = {}
    parts, bounds = [], [0]
    for text in texts:
        words = words_of(text)
        parts.append(np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64))
        bounds.append(bounds[-1] + len(words))
    return Words(list(numbers)), np.concatenate(parts) if parts else np.zeros(0, np.int64), np.array(bounds)


def word_shares(words: Words, flat: np.ndarray, bounds: np.ndarray, toxic: np.ndarray, use: np.ndarray) -> np.ndarray:
    """Per hash, over the documents in ``use``: signed logarithm of how many deviations the count of toxic documents
    lies off its expectation."""
    counts = np.zeros((2, 1 << SHARE_BITS))
    for i in np.flatnonzero(use):
        counts[int(toxic[i]), np.unique(words.share[np.unique(flat[bounds[i] : bounds[i + 1]])])] += 1
    base = toxic[use].mean()
    total = counts.sum(0)
    off = (counts[1] - base * total) / np.sqrt(base * (1 - base) * total + 1)
    return np.sign(off) * np.log1p(np.abs(off))


def train(texts: list[str], toxic: np.ndarray, seed: int = 0) -> Network:
    """Fit shares, network and sigmoid."""
    random = np.random.default_rng(seed)
    words, flat, bounds = number(texts)
    fold = np.empty(len(toxic), np.int64)
    for side in (toxic, ~toxic):
        fold[side] = np.arange(side.sum()) % FOLDS
    # a document never meets shares that its own label went into
    tables = np.stack([word_shares(words, flat, bounds, toxic, fold != k) for k in range(FOLDS)])
    net = Network(word_shares(words, flat, bounds, toxic, fold >= 0), seed)
    starts, ends, first = windows(bounds)
    owner = np.repeat(np.arange(len(toxic)), np.diff(np.append(first, len(starts))))
    word_share = np.concatenate((tables[:, words.share], np.zeros((FOLDS, 1), np.float32)), axis=1).astype(np.float32)

    def chances(which):
        """Logits of the chosen windows, with the shares of their documents' folds."""
        out = np.zeros(len(which), np.float32)
        for k in range(FOLDS):
            at = np.flatnonzero(fold[owner[which]] == k)
            out[at] = net.logits(words, flat, starts[which[at]], ends[which[at]], word_share=word_share[k])
        return out

    seen = np.flatnonzero(fold[owner] > 0)  # fold 0 is left to the sigmoid
    clean = seen[~toxic[owner[seen]]]
    per_round = int((fold > 0).sum()) + min(len(clean), 2 * int(((fold > 0) & ~toxic).sum()))
    mean = {k: np.zeros_like(v) for k, v in net.p.items()}
    square = {k: np.zeros_like(v) for k, v in net.p.items()}
    rest = np.flatnonzero(fold[owner] == 0)
    firsts = np.flatnonzero(np.diff(owner[rest], prepend=-1))
    left = toxic[owner[rest][firsts]]
    empty = np.full((4, WINDOW), -1)  # a window without words is clean
    best_loss, best, waited, step = np.inf, None, 0, 0
    batches = max(60, per_round // 48)
    for turn in range(max(4, min(16, STEPS // batches))):
        if turn:
            scores = chances(seen)
        else:
            ids = window_ids(flat, starts[seen], ends[seen])
            scores = word_share[fold[owner[seen]][:, None], ids].max(1)
        order = np.lexsort((-scores, owner[seen]))
        top = seen[order[np.flatnonzero(np.diff(owner[seen][order], prepend=-1))]]
        chosen = np.concatenate((top, random.choice(clean, per_round - len(top), replace=False)))
        for batch in np.array_split(random.permutation(chosen), min(len(chosen), batches)):
            ids = np.concatenate((window_ids(flat, starts[batch], ends[batch]), empty))
            own_share = word_share[np.append(fold[owner[batch]], [0] * len(empty))[:, None], ids]
            _, d = net.gradients(words, ids, np.append(toxic[owner[batch]], [False] * len(empty)).astype(np.float32), own_share)
            step += 1
            for k, g in d.items():
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.001 * (g * g - square[k])
                pace = TABLE_STEP if k in ("word", "gram") else STEP
                net.p[k] -= pace * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
        scores = np.maximum.reduceat(chances(rest).astype(np.float64), firsts)
        loss = float(np.mean(np.logaddexp(0, scores) - left * scores))
        if loss < best_loss:
            best_loss, waited, best = loss, 0, ({k: v.copy() for k, v in net.p.items()}, scores)
        elif (waited := waited + 1) == PATIENCE:
            break
    net.p, scores = best
    net.calibration = fit_sigmoid(scores, left)
    return net


def constant(share: float) -> Network:
    net = Network(np.zeros(1 << SHARE_BITS))
    share = min(max(share, 1e-6), 1 - 1e-6)
    net.calibration = (0.0, float(np.log(share / (1 - share))))
    return net


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic") -> Network:
    """Train on a bounded number of labelled rows that may be learnt from."""
    usable = one_label(labels, column).where(in_train("doc_id", *HELD_OUT))
    # rows that cannot be trained on make room for others
    short = docs.where(F.length("text") <= LONGEST_ROW).select("doc_id")
    usable = materialise(usable.join(short, "doc_id", "left_semi"), "toxic-labels")
    chosen = smallest_hashes(usable.where("y = 1"), "doc_id", TOXIC_ROWS).unionByName(smallest_hashes(usable.where("y = 0"), "doc_id", CLEAN_ROWS))
    rows = (
        docs.select("doc_id", "text")
        .where(F.length("text") <= LONGEST_ROW)
        .join(F.broadcast(chosen), "doc_id")  # at most TOXIC_ROWS + CLEAN_ROWS ids
        .groupBy("doc_id", "y")
        .agg(F.min("text").alias("text"))
        .collect()
    )
    rows.sort(key=lambda r: (zlib.crc32(str(r.doc_id).encode()), r.doc_id))
    toxic = np.array([r.y == 1 for r in rows], bool)
    if not len(toxic) or toxic.all() or not toxic.any():
        return constant(float(toxic.mean()) if len(toxic) else 0.0)
    return train([r.text for r in rows], toxic)


def score_documents(docs: DataFrame, net: Network, words_at_once: int = 200_000) -> DataFrame:
    """doc_id and score of every row."""
    sent = Shared(docs.sparkSession, net)

    def score(batches):
        for batch in batches:
            scores, held, size = [], [], 0
            for text in [*batch.column(1).to_pylist(), False]:
                if held and (text is False or size + len(text or "") > 6 * words_at_once):
                    scores.append(sent.value.score(sent.value.document_logits(*number(held))))
                    held, size = [], 0
                held.append(text)
                size += len(text or "")
            out = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], names=["doc_id", "score"])

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), score, "doc_id long, score double")


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    return score_documents(docs, fit(docs, labels)).select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT[0] == HELD_OUT[1], F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op10_toxicity(spark, sf_dir):
    return digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
