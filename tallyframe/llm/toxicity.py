"""Toxicity scores from a bidirectional gated recurrent network with attention pooling."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of, written

WORD = re.compile(r"\w+")
WINDOW, STRIDE = 64, 32
HIDDEN, WORD_DIM, CHAR_DIM, ATTENTION = 8, 8, 8, 8
CHAR_SLOTS = 1 << 15
WORDS_AT_ONCE = 1_000_000


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def ngram_slots(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash slots of the character 3- and 4-grams of each ``<word>``, and how many each word has."""
    flat = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    ends = np.repeat(np.cumsum(sizes), sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    slots, owners = [], []
    for n in (3, 4):
        at = np.flatnonzero(np.arange(len(flat)) + n <= ends)
        h = np.full(len(at), n, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + flat[at + k]
            h ^= h >> np.uint64(29)
        slots.append((h % np.uint64(CHAR_SLOTS)).astype(np.int64))
        owners.append(owner[at])
    slot, own = np.concatenate(slots), np.concatenate(owners)
    order = np.argsort(own, kind="stable")
    return slot[order], np.bincount(own, minlength=len(words))


def windows_of(n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For texts of ``n_words`` words: the text and the first word of each overlapping window."""
    count = np.maximum(1, -(-(n_words - WINDOW) // STRIDE) + 1)
    text = np.repeat(np.arange(len(n_words)), count)
    first = (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)) * STRIDE
    return text, first


@dataclass
class Network:
    """Parameters, and the vocabulary of words that have a vector of their own (0: any other word)."""

    vocabulary: dict[str, int]
    p: dict[str, np.ndarray] = field(default_factory=dict)

    def inputs(self, words: list[str]) -> tuple[np.ndarray, tuple]:
        """Word vector and character vector of each word, one after the other."""
        ids = np.fromiter((self.vocabulary.get(w, 0) for w in words), np.int64, len(words))
        slots, n = ngram_slots(words)
        total = np.add.reduceat(self.p["chars"][slots], np.cumsum(n) - n, axis=0) if len(words) else np.zeros((0, CHAR_DIM), np.float32)
        return np.hstack([self.p["words"][ids], total / np.sqrt(n)[:, None].astype(np.float32)]), (ids, slots, n)

    def run(self, x: np.ndarray, at: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        """Logits of windows; ``at``: rows of ``x`` by window and place, -1 past a window's end."""
        p, (n, steps) = self.p, at.shape
        real = at >= 0
        full = real.all(0)
        states, kept = np.zeros((steps, n, 2 * HIDDEN), np.float32), []
        half = np.repeat(np.float32([0.5, 1]), [2 * HIDDEN, HIDDEN])  # gates as tanh(x / 2), one call for both
        for d in "fb":
            given = np.vstack([(x @ p["W" + d] + p["b" + d]) * half, np.zeros((1, 3 * HIDDEN), np.float32)])
            u, h, side = p["U" + d] * half, np.zeros((n, HIDDEN), np.float32), slice(0, HIDDEN) if d == "f" else slice(HIDDEN, None)
            for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
                a, g = given.take(at[:, t], axis=0, mode="wrap"), h @ u
                zr = np.tanh(a[:, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])
                zr += 1
                zr *= np.float32(0.5)
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                c = np.tanh(a[:, 2 * HIDDEN :] + r * g[:, 2 * HIDDEN :])
                new = c + z * (h - c)
                on = True if full[t] else real[:, t, None]
                if not full[t]:
                    new = np.where(on, new, h)
                if keep:
                    kept.append((d, t, h, z, r, c, g[:, 2 * HIDDEN :], on))
                states[t, :, side] = h = new
        hidden = np.tanh(states @ p["A"])
        e = np.where(real.T, hidden @ p["v"], -1e9)
        weight = np.exp(e - e.max(0))
        weight *= real.T
        weight /= np.maximum(weight.sum(0), 1e-9)
        pooled = np.einsum("tn,tnh->nh", weight, states)
        return pooled @ p["o"] + p["c"][0], [states, hidden, weight, pooled, kept] if keep else []

    def gradients(self, x: np.ndarray, at: np.ndarray, toxic: np.ndarray, looked: tuple) -> dict[str, np.ndarray]:
        """Of the mean logistic loss over windows."""
        p, g = self.p, {k: np.zeros_like(v) for k, v in self.p.items()}
        logit, (states, hidden, weight, pooled, kept) = self.run(x, at, keep=True)
        d = ((sigmoid(logit) - toxic) / len(at)).astype(np.float32)
        g["o"], g["c"] = pooled.T @ d, np.array([d.sum()], np.float32)
        dpool = d[:, None] * p["o"]
        dweight = np.einsum("tnh,nh->tn", states, dpool)
        de = weight * (dweight - (weight * dweight).sum(0))
        dstates = weight[:, :, None] * dpool
        dhidden = de[:, :, None] * p["v"] * (1 - hidden**2)
        g["v"] = np.einsum("tn,tna->a", de, hidden)
        g["A"] = np.einsum("tnh,tna->ha", states, dhidden)
        dstates += dhidden @ p["A"].T
        dgiven = {s: np.zeros((len(x) + 1, 3 * HIDDEN), np.float32) for s in "fb"}
        carry, before = None, ""
        for s, t, h, z, r, c, gc, on in reversed(kept):
            side = slice(0, HIDDEN) if s == "f" else slice(HIDDEN, None)
            dh = dstates[t, :, side] + (carry if s == before else 0)
            dnew = np.where(on, dh, 0)
            dc = dnew * (1 - z) * (1 - c**2)
            dz = dnew * (h - c) * z * (1 - z)
            dr = dc * gc * r * (1 - r)
            dg = np.hstack([dz, dr, dc * r])
            np.add.at(dgiven[s], at[:, t], np.hstack([dz, dr, dc]))
            g["U" + s] += h.T @ dg
            carry, before = np.where(on, dnew * z, dh) + dg @ p["U" + s].T, s
        dx = np.zeros_like(x)
        for s in "fb":
            own = dgiven[s][:-1]
            g["W" + s], g["b" + s] = x.T @ own, own.sum(0)
            dx += own @ p["W" + s].T
        ids, slots, n = looked
        np.add.at(g["words"], ids, dx[:, :WORD_DIM])
        g["words"][0] = 0
        np.add.at(g["chars"], slots, np.repeat(dx[:, WORD_DIM:] / np.sqrt(n)[:, None].astype(np.float32), n, axis=0))
        return g


def indexed(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct words of texts, the texts' words by number in a row, and how many each text has."""
    number: dict[str, int] = {}
    rows = [np.fromiter((number.setdefault(w, len(number)) for w in WORD.findall(t.lower())), np.int32) for t in texts]
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    return list(number), np.concatenate(rows) if rows else np.zeros(0, np.int32), sizes


def laid_out(flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The text of each window, and its words by number (-1 past its end)."""
    text, first = windows_of(sizes)
    start, left = (np.cumsum(sizes) - sizes)[text] + first, sizes[text] - first
    at = np.full((len(text), WINDOW), -1, np.int32)
    for t in range(WINDOW):
        inside = left > t
        at[inside, t] = flat[start[inside] + t]
    return text, at


def score_texts(net: Network, texts: list[str], rows: int = 4096) -> np.ndarray:
    """The largest score over all overlapping windows of each whole text; 0 for one without words."""
    words, flat, sizes = indexed(texts)
    x, _ = net.inputs(words)
    text, at = laid_out(flat, sizes)
    logit = np.concatenate([net.run(x, at[lo : lo + rows])[0] for lo in range(0, len(at), rows)])
    best = np.full(len(texts), -np.inf)
    np.maximum.at(best, text, logit)
    return np.where(sizes > 0, sigmoid(best), 0)


def train(texts: list[str], toxic: np.ndarray, epochs: int = 8, most_batch: int = 256, seed: int = 7) -> Network:
    """A network fitted to labelled texts.

    Only some window of a toxic text need be toxic, so each epoch first scores
    all windows and learns from the highest window of every text and from as
    many other windows of clean texts. Vectors start with how much more often a
    word or character n-gram occurs in toxic texts.
    """
    rng = np.random.default_rng(seed)
    words, flat, sizes = indexed(texts)
    text, at = laid_out(flat, sizes)
    held = [np.zeros(len(words), np.int64) for _ in (0, 1)]
    for end, size, k in zip(np.cumsum(sizes), sizes, toxic, strict=True):
        held[k][np.unique(flat[end - size : end])] += 1
    scale = max(1, (toxic == 0).sum()) / max(1, (toxic == 1).sum())
    odds = lambda bad, good: np.clip(np.log((bad * scale + 4) / (good + 4)), -4, 4) / 2
    often = np.flatnonzero(held[0] + held[1] >= 3)
    net = Network({words[w]: i + 1 for i, w in enumerate(often)})

    per_slot = [np.zeros(CHAR_SLOTS) for _ in held]
    for lo in range(0, len(words), 20_000):
        slots, n = ngram_slots(words[lo : lo + 20_000])
        for total, h in zip(per_slot, held, strict=True):
            total += np.bincount(slots, np.repeat(h[lo : lo + 20_000], n), CHAR_SLOTS)
    draw = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
    net.p = {"words": draw(len(often) + 1, WORD_DIM) * 0.1, "chars": draw(CHAR_SLOTS, CHAR_DIM) * 0.1, "A": draw(2 * HIDDEN, ATTENTION), "v": draw(ATTENTION), "o": draw(2 * HIDDEN), "c": np.zeros(1, np.float32)}
    net.p["words"][0] = 0
    net.p["words"][1:, 0] = odds(held[1][often], held[0][often])
    net.p["chars"][:, 0] = odds(per_slot[1], per_slot[0])
    for d in "fb":
        net.p |= {"W" + d: draw(WORD_DIM + CHAR_DIM, 3 * HIDDEN), "U" + d: draw(HIDDEN, 3 * HIDDEN), "b" + d: np.zeros(3 * HIDDEN, np.float32)}
    if not len(texts):
        return net

    m, v = ({k: np.zeros_like(x) for k, x in net.p.items()} for _ in "mv")
    step = 0
    clean = np.flatnonzero(toxic[text] == 0)
    for epoch in range(epochs):
        x = np.concatenate([net.inputs(words[lo : lo + 20_000])[0] for lo in range(0, len(words), 20_000)]) if words else net.inputs([])[0]
        if epoch:
            logit = np.concatenate([net.run(x, at[lo : lo + 2048])[0] for lo in range(0, len(at), 2048)])
        else:
            value = np.append(x[:, 0] + x[:, WORD_DIM], -9)
            logit = value[at].max(1)
        order = np.lexsort((-logit, text))
        top = order[np.append(True, text[order][1:] != text[order][:-1])]
        other = rng.choice(clean, min(len(clean), len(top)), replace=False)
        chosen = rng.permutation(np.unique(np.concatenate([top, other])))
        batch = int(np.clip(len(chosen) // 50, 8, most_batch))  # few texts still give enough steps
        for lo in range(0, len(chosen), batch):
            own = at[chosen[lo : lo + batch]]
            used, small = np.unique(own, return_inverse=True)
            small = small.reshape(own.shape) - (used[0] < 0)
            here = [words[w] for w in used if w >= 0]
            x, looked = net.inputs(here)
            g, step = net.gradients(x, small, toxic[text[chosen[lo : lo + batch]]].astype(np.float32), looked), step + 1
            rate = 0.01 * (1 - 0.9 * step / (epochs * -(-len(chosen) // batch)))
            for k in net.p:
                slow = rate * 0.2 if k in ("words", "chars") else rate
                m[k] += 0.1 * (g[k] - m[k])
                v[k] += 0.01 * (g[k] ** 2 - v[k])
                net.p[k] -= (slow * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return net


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, per_class: int, most_chars: int) -> DataFrame:
    """At most ``per_class`` labelled texts of each class, the ones with the smallest id hashes."""
    told = labels.select(labels[id_col].alias("_id"), labels[label_col].alias("_y")).where("_y in (0, 1) and _id is not null").groupBy("_id").agg(F.max("_y").alias("_y"))
    told = told.where(F.pmod(F.crc32(F.col("_id").cast("string")), F.lit(5)) != 0)
    sizes = docs.select(docs[id_col].alias("_id"), F.length(text_of(docs, text_col)).alias("_n")).where(F.col("_n") <= most_chars)
    both = told.join(sizes, "_id").select("_id", "_y", F.xxhash64("_id").alias("_h"))
    chosen = [both.where(F.col("_y") == y).orderBy("_h", "_id").limit(per_class) for y in (0, 1)]
    ids = written(chosen[0].unionByName(chosen[1]).select("_id", "_y").distinct())
    texts = docs.select(docs[id_col].alias("_id"), text_of(docs, text_col).alias("_text"))
    return texts.join(F.broadcast(ids), "_id").select("_id", "_text", "_y")  # at most 2 * per_class ids


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    per_class: int = 2000,
    most_chars: int = 20_000,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: held_out, score (0 to 1) and predicted (score >= 0.5).

    A bidirectional gated recurrent network reads words, each given as a word
    vector and a vector of its character n-grams, in windows of 64 words that
    overlap by half; attention pools each window; a text's score is that of its
    highest window, over all windows of the whole text, however long. Null, empty
    and wordless texts score 0. Rows that repeat are scored each for itself; an id
    that ``labels`` repeats counts as toxic if any of its rows says so; without any
    usable label the untrained network's scores come out. Columns of ``docs`` in
    ``keep`` come along; others, whatever their names, are not touched. An empty
    table gives no rows.

    It is trained on the driver, in numpy, on a bounded sample: of each class at
    most ``per_class`` labelled texts of at most ``most_chars`` characters, none
    of them held out (CRC-32 of the id as text, mod 5, is 0). Scoring reads every
    row, in tasks that need nothing but the network, and so restart freely.
    """
    spark = docs.sparkSession
    sample = training_rows(docs, labels, id_col, text_col, label_col, per_class, most_chars).toPandas().sort_values("_id")
    net = spark.sparkContext.broadcast(train(sample["_text"].tolist(), sample["_y"].to_numpy(np.int64)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, got, lo = batch.column(1).to_pylist(), [], 0
            while lo < len(texts):
                hi, chars = lo, 0
                while hi < len(texts) and (hi == lo or chars + len(texts[hi]) < WORDS_AT_ONCE):
                    chars += len(texts[hi])
                    hi += 1
                got.append(score_texts(net.value, texts[lo:hi]))
                lo = hi
            if got:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(got).astype(np.float64)), *batch.columns[2:]], ["_id", "_score", *kept])

    kind = lambda name: docs.schema[name].dataType.simpleString()
    kept = [f"_keep{i}" for i in range(len(keep))]
    more = [docs[x].alias(k) for x, k in zip(keep, kept, strict=True)]
    scored = docs.select(docs[id_col].alias("_id"), text_of(docs, text_col).alias("_text"), *more).mapInArrow(
        score, ", ".join([f"_id {kind(id_col)}, _score double", *(f"{k} {kind(x)}" for x, k in zip(keep, kept, strict=True))])
    )
    return scored.select(
        F.col("_id").alias(id_col),
        F.coalesce(F.pmod(F.crc32(F.col("_id").cast("string")), F.lit(5)) == 0, F.lit(False)).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"),
        *(F.col(k).alias(x) for x, k in zip(keep, kept, strict=True)),
    )
