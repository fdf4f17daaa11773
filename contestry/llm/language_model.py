"""A gated recurrent language model that scores whole documents.

Words are hashed to 64 bits and counted over all training documents by Spark. The most frequent words
form classes; there are at least FREQUENT of them, and their number and the size of a class grow with
the distinct words. All other words form RARE classes by their last letters. The output softmax is
factored: first the class given the state, then, in the classes of frequent words, the word given class
and state; in rare classes the word's smoothed share of its class.

Training is data-parallel. In each of ROUNDS rounds the documents of the round form shards of about
SHARD_TOKENS tokens, whatever the number of tasks; over each runs truncated backpropagation (numpy),
each document in one round; the shards' weights are averaged by Spark, weighted by their tokens.
Documents are read in windows of STEPS words, and the state is carried from window to window, in
training and in scoring, so that a document's log-likelihood is that of its whole text. A window is
cut from the texts' words when its turn comes: long documents aren't padded to anything.

Counts of the LISTED most frequent words are broadcast (that many entries at most); the tokens beyond
meet their counts in a shuffled join.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import most_counted, text_of, written
from .shingles import slices, text_bytes, word_hashes

FOLDS, HELD_OUT = 5, 1
#: Least frequent words and least words a class; frequent words by the root of the distinct words.
FREQUENT, CLASS_WORDS, RARE = 1024, 32, 32
ROOTS = 4
LISTED = 200_000
HIDDEN, STEPS = 16, 32
#: Documents side by side: fewer in training, where each window is a step of the descent.
LANES, SCORE_LANES = 256, 768
#: Adagrad's rate and the first sum of squares. Biases stay those of the unigram model.
ROUNDS, RATE, START = 3, 0.1, 1e-6
SHARD_TOKENS = 2_000_000
#: Tokens that a task scores together at least.
SCORE_TOKENS = 4_000_000
#: Tokens whose softmax is in memory at a time.
TILE = 2_048
#: Distinct words a counting task holds before it passes them on.
COUNTED = 1_000_000
#: Pieces in which weights are averaged, and partial averages of each.
PIECES, PARTIAL = 32, 32
#: The token that ends each document.
END = np.uint64(0)


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def rare_class(suffix: bytes) -> int:
    """Of the RARE classes, from a word's last two bytes."""
    return zlib.crc32(suffix) % RARE


#: rare_class of a last byte and, by the place 256 * (byte before + 1), of two; upper case counts as lower.
RARE_CLASSES = np.array([[rare_class((bytes([b]) if b >= 0 else b"") + bytes([c])) for c in bytes(range(256)).lower()] for b in [-1, *bytes(range(256)).lower()]], np.int32)


def tokens_of(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each token, its rare class, offsets of the documents); each document ends with END."""
    data, offsets = text_bytes(text)
    hashes, first, last = word_hashes(data, offsets[:-1])
    of = np.searchsorted(first, offsets)
    before = np.where(last > first, data[last - 1].astype(np.int32) + 1, 0)
    out, rare = np.full(len(hashes) + len(text), END, np.uint64), np.full(len(hashes) + len(text), rare_class(b""), np.int32)
    place = np.arange(len(hashes)) + np.repeat(np.arange(len(text)), np.diff(of))
    out[place], rare[place] = hashes, RARE_CLASSES[before, data[last]]
    return out, rare, of + np.arange(len(of))


def frequent_words(v: int) -> int:
    """How many of v distinct words the network tells apart."""
    return min(max(FREQUENT, ROOTS * math.isqrt(v)), LISTED)


def _text(batch: pa.RecordBatch) -> pa.Array:
    return batch.column(batch.schema.get_field_index("text"))


def count_words(docs: DataFrame) -> DataFrame:
    """word (its hash), k (its rare class), c over docs' texts; each document has one END besides its words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            for a, b in slices(_text(batch)):
                words, rare, _ = tokens_of(_text(batch).slice(a, b - a))
                held.append(_summed(words, rare, np.ones(len(words), np.int64)))
                if sum(len(w) for w, _, _ in held) > COUNTED:
                    held = [_summed(*map(np.concatenate, zip(*held)))]
                    if len(held[0][0]) > COUNTED // 2:
                        yield _counts(held.pop())
        if held:
            yield _counts(_summed(*map(np.concatenate, zip(*held))))

    return docs.select("text").mapInArrow(count, "word long, k int, c long").groupBy("word", "k").agg(F.sum("c").alias("c"))


def _summed(words: np.ndarray, rare: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found, at, back = np.unique(words, return_index=True, return_inverse=True)
    return found, rare[at], np.bincount(back, c, len(found)).astype(np.int64)


def _counts(found: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(found[0].view(np.int64)), pa.array(found[1]), pa.array(found[2])], ["word", "k", "c"])


class Vocabulary:
    """What all tasks know of the words: bounded by LISTED, whatever the corpus.

    words, rare, counts: the listed words, most frequent first; the first `frequent` have output classes
    of class_words. n, v: all tokens and distinct words; rare_n, rare_v: those of each rare class.
    """

    def __init__(self, words: np.ndarray, rare: np.ndarray, counts: np.ndarray, n: int, v: int, rare_n: np.ndarray, rare_v: np.ndarray):
        self.words, self.n, self.v, self.rare_n, self.rare_v = words, n, v, rare_n, rare_v
        self.counts = counts.astype(float)
        self.frequent = min(frequent_words(v), len(counts))
        self.class_words = max(CLASS_WORDS, math.isqrt(self.frequent))
        self.classes = -(-self.frequent // self.class_words)
        self.id_at = np.where(np.arange(len(counts)) < self.frequent, np.arange(len(counts)), self.frequent + rare).astype(np.int32)
        # open addressing: a word's slot is the first from its hash on that is free when it comes
        self.slots = np.full(1 << max(10, (len(words) * 4).bit_length()), -1, np.int32)
        left, step = np.arange(len(words)), 0
        while len(left):
            at = self._slot(words[left], step)
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]
            left, step = left[self.slots[at] != left], step + 1

    def _slot(self, words: np.ndarray, step: int) -> np.ndarray:
        return (words + np.uint64(step)) & np.uint64(len(self.slots) - 1)

    def places(self, words: np.ndarray) -> np.ndarray:
        """Each word's place among the listed; -1 where it has none."""
        out, left, step = np.full(len(words), -1, np.int32), np.arange(len(words)), 0
        while len(left):
            found = self.slots[self._slot(words[left], step)]
            hit = (found >= 0) & (self.words[found] == words[left]) if len(self.words) else np.zeros(len(left), bool)
            out[left[hit]] = found[hit]
            left, step = left[(found >= 0) & ~hit], step + 1
        return out

    def ids(self, rare: np.ndarray, places: np.ndarray) -> np.ndarray:
        """A frequent word's place, or the number of frequent words and the rare class."""
        if not len(self.id_at):
            return rare + np.int32(self.frequent)
        return np.where(places >= 0, self.id_at[places], rare + np.int32(self.frequent))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """counts: word, k, c (written before)."""
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = most_counted(counts, "c", LISTED).toPandas().sort_values(["c", "word"], ascending=[False, True])
    words, rare, c = top["word"].to_numpy(np.int64).view(np.uint64), top["k"].to_numpy(np.int32), top["c"].to_numpy(np.int64)
    rare_n, rare_v = np.zeros(RARE), np.zeros(RARE)
    for r in counts.groupBy("k").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
        rare_n[r.k], rare_v[r.k] = r.n, r.v
    told = min(frequent_words(v), len(c))
    rare_n -= np.bincount(rare[:told], c[:told], RARE)
    rare_v -= np.bincount(rare[:told], minlength=RARE)
    return Vocabulary(words, rare, c, n, v, rare_n, rare_v)


class Network:
    """The weights and the passes of one gated recurrent network with a class-factored softmax.

    The softmax's biases bc and bw are the unigram model's and aren't trained: the weights tell by how much
    a context departs from it.
    """

    def __init__(self, known: Vocabulary, weights: np.ndarray | None = None):
        self.words, self.k, self.size = known.frequent, known.classes, known.class_words
        inputs, out = self.words + RARE + 1, self.k + RARE
        self.shapes = {"E": (inputs, 3 * HIDDEN), "U": (HIDDEN, 3 * HIDDEN), "b": (3 * HIDDEN,), "Wc": (HIDDEN, out), "bc": (out,), "Ww": (self.k, HIDDEN, self.size), "bw": (self.k, self.size)}
        sizes = [int(np.prod(s)) for s in self.shapes.values()]
        self.flat = self._start(known, sum(sizes)) if weights is None else np.array(weights, np.float32)
        at = 0
        for (name, shape), size in zip(self.shapes.items(), sizes):
            setattr(self, name, self.flat[at : at + size].reshape(shape))
            at += size
        if weights is None:
            self._biases(known)

    def _start(self, known: Vocabulary, size: int) -> np.ndarray:
        return np.random.default_rng(7).normal(0, 0.1, size).astype(np.float32)

    def _biases(self, known: Vocabulary) -> None:
        """The untrained network is the unigram model."""
        c = np.full(self.k * self.size, 0.0)
        c[: self.words] = known.counts[: self.words]
        c = c.reshape(self.k, self.size)
        self.bw[:] = np.where(c > 0, np.log(np.maximum(c, 1e-9) / np.maximum(c.sum(1, keepdims=True), 1)), -30)
        share = np.concatenate([c.sum(1), known.rare_n]) + 0.5
        self.bc[:] = np.log(share / share.sum())
        self.Wc *= 0.1
        self.Ww *= 0.1
        self.b[:] = 0

    def forward(self, ids: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, tuple]:
        """States after each step, and what backward needs; ids: (steps, lanes) of input words, h: (lanes, HIDDEN)."""
        # 1 / (1 + exp(-y)) = (1 + tanh(y / 2)) / 2
        half = np.repeat(np.array([0.5, 0.5, 1], np.float32), HIDDEN)
        x, u = self.E[ids], self.U * half
        x += self.b
        x *= half
        shape = (*ids.shape, HIDDEN)
        states, before, new, inner = (np.empty(shape, np.float32) for _ in range(4))
        gates = np.empty((*ids.shape, 2 * HIDDEN), np.float32)
        for t in range(len(ids)):
            before[t] = h
            a = h @ u
            g = gates[t]
            np.add(x[t, :, : 2 * HIDDEN], a[:, : 2 * HIDDEN], out=g)
            np.tanh(g, out=g)
            g += 1
            g *= 0.5
            inner[t] = a[:, 2 * HIDDEN :]
            n = new[t]
            np.multiply(g[:, HIDDEN:], inner[t], out=n)
            n += x[t, :, 2 * HIDDEN :]
            np.tanh(n, out=n)
            h = h - n
            h *= g[:, :HIDDEN]
            h += n
            states[t] = h
        return states, (before, gates[:, :, :HIDDEN], gates[:, :, HIDDEN:], inner, new)

    def loss(self, states: np.ndarray, targets: np.ndarray, grads: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log probabilities of the targets' classes and frequent words; and the gradient of the states."""
        frequent = targets < self.words
        of = np.where(frequent, targets // self.size, self.k + targets - self.words)
        out = np.empty(len(of), np.float32)
        # sums over a row as products with ones, and shares of the targets alone where no gradient is asked for
        ones, single = np.ones(self.k + RARE, np.float32), np.ones(self.size, np.float32)
        d = np.empty_like(states) if grads is not None else None
        for at in range(0, len(of), TILE):
            tile, goal = states[at : at + TILE], of[at : at + TILE]
            logits = tile @ self.Wc
            logits += self.bc
            np.exp(np.minimum(logits, 60, out=logits), out=logits)
            share = 1 / (logits @ ones)
            every = np.arange(len(goal))
            out[at : at + TILE] = np.log(np.maximum(logits[every, goal] * share, 1e-30))
            if grads is not None:
                logits *= share[:, None]
                logits[every, goal] -= 1
                grads["Wc"] += tile.T @ logits
                np.matmul(logits, self.Wc.T, out=d[at : at + TILE])
        told = np.flatnonzero(frequent)
        order = told[np.argsort(of[told], kind="stable")]
        ends = np.searchsorted(of[order], np.arange(self.k + 1)).tolist()
        rows, word = states[order], targets[order] % self.size
        back, logs = np.empty_like(rows), np.empty(len(order), np.float32)
        for k in range(self.k):
            i, j = ends[k], ends[k + 1]
            if i == j:
                continue
            p = rows[i:j] @ self.Ww[k]
            p += self.bw[k]
            np.exp(np.minimum(p, 60, out=p), out=p)
            share = 1 / (p @ single)
            at = (np.arange(j - i), word[i:j])
            logs[i:j] = p[at] * share
            if grads is not None:
                p *= share[:, None]
                p[at] -= 1
                grads["Ww"][k] += rows[i:j].T @ p
                np.matmul(p, self.Ww[k].T, out=back[i:j])
        out[order] += np.log(np.maximum(logs, 1e-30))
        if grads is not None:
            d[order] += back
        return out, d

    def backward(self, ids: np.ndarray, kept: tuple, d_states: np.ndarray, grads: dict) -> None:
        """Backpropagation through one window; it stops at the window's first state."""
        before, z, r, inner, new = kept
        fall = 1 - z
        by_new, by_z, by_r = fall * (1 - new * new), (before - new) * z * fall, inner * r * (1 - r)
        dx, da = np.empty((*ids.shape, 3 * HIDDEN), np.float32), np.empty((*ids.shape, 3 * HIDDEN), np.float32)
        dh, back = np.zeros_like(d_states[0]), np.ascontiguousarray(self.U.T)
        for t in range(len(ids) - 1, -1, -1):
            dh += d_states[t]
            dn = dh * by_new[t]
            np.multiply(dh, by_z[t], out=dx[t, :, :HIDDEN])
            np.multiply(dn, by_r[t], out=dx[t, :, HIDDEN : 2 * HIDDEN])
            dx[t, :, 2 * HIDDEN :] = dn
            da[t, :, : 2 * HIDDEN] = dx[t, :, : 2 * HIDDEN]
            np.multiply(dn, r[t], out=da[t, :, 2 * HIDDEN :])
            dh = dh * z[t]
            dh += da[t] @ back
        grads["U"] += before.reshape(-1, HIDDEN).T @ da.reshape(-1, 3 * HIDDEN)
        dx = dx.reshape(-1, 3 * HIDDEN)
        grads["b"] += dx.sum(0)
        flat = ids.ravel()
        order = np.argsort(flat, kind="stable")
        words, starts = np.unique(flat[order], return_index=True)
        grads["E"] = (words, np.add.reduceat(dx[order], starts))


def windows(net: Network, ids: np.ndarray, offsets: np.ndarray, lanes: int, grads=None) -> Iterator[tuple]:
    """Every window of some documents, so many lanes side by side: (documents of the lanes, real steps, log probabilities).

    ids: the documents' words, one after the other. A lane carries its document's state from window to
    window and takes the next document when it ends: the longest ones first, the others in mixed order.
    """
    begin, starts, lengths = np.int32(net.E.shape[0] - 1), offsets[:-1], np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    order = np.concatenate([order[:lanes], np.random.default_rng(len(order)).permutation(order[lanes:])])
    doc, taken = order[:lanes].copy(), lanes
    at, h = np.zeros(len(doc), np.int64), np.zeros((len(doc), HIDDEN), np.float32)
    while len(doc):
        step = at + np.arange(STEPS)[:, None]
        real = step < lengths[doc]
        goal = ids[np.minimum(starts[doc] + step, len(ids) - 1)]
        given = np.empty_like(goal)
        given[1:] = goal[:-1]
        given[0] = np.where(at > 0, ids[starts[doc] + at - 1], begin)
        states, kept = net.forward(given, h)
        if grads is None:
            logp, _ = net.loss(states[real], goal[real])
        else:
            logp, d = net.loss(states[real], goal[real], grads)
            d_states = np.zeros_like(states)
            d_states[real] = d
            net.backward(given, kept, d_states, grads)
        yield doc, real, logp
        at += STEPS
        h = states[-1].copy()
        done = np.flatnonzero(at >= lengths[doc])
        fresh = order[taken : taken + len(done)]
        taken += len(fresh)
        filled = done[: len(fresh)]
        doc = doc.copy()
        doc[filled], at[filled], h[filled] = fresh, 0, 0
        if len(done) > len(fresh):
            left = np.delete(np.arange(len(doc)), done[len(fresh) :])
            doc, at, h = doc[left], at[left], h[left]


Texts = tuple[np.ndarray, np.ndarray]


def train_part(known: Vocabulary, weights: np.ndarray | None, shards: Iterator[Texts]) -> Iterator[tuple[np.ndarray, int]]:
    """(weights after one pass over a shard (Adagrad), the tokens it saw) of each shard: (ids, offsets) of its documents.

    Every shard starts from the given weights.
    """
    for ids, offsets in shards:
        net, seen = Network(known, weights), 0
        sums = {name: np.full(shape, START, np.float32) for name, shape in net.shapes.items()}
        grads = {n: np.zeros(net.shapes[n], np.float32) for n in ("U", "b", "Wc", "Ww")}
        for _, _, logp in windows(net, ids, offsets, LANES, grads):
            scale = np.float32(1 / (LANES * STEPS))  # a window of few lanes counts by its tokens
            words, g = grads.pop("E")
            g *= scale
            sums["E"][words] += g * g
            net.E[words] -= RATE * g / np.sqrt(sums["E"][words])
            for n, g in grads.items():
                g *= scale
                np.clip(g, -1, 1, out=g)
                sums[n] += g * g
                getattr(net, n)[...] -= RATE * g / np.sqrt(sums[n])
                g[...] = 0
            seen += len(logp)
        yield net.flat, seen


def gathered(parts: Iterator[Texts], most: int) -> Iterator[Texts]:
    """Documents of several parts together, at least `most` tokens (but for the last)."""
    held: list[Texts] = []
    for part in parts:
        held.append(part)
        if sum(len(ids) for ids, _ in held) >= most:
            yield _together(held)
            held = []
    if held:
        yield _together(held)


def _together(parts: list[Texts]) -> Texts:
    ends = np.concatenate([np.diff(offsets) for _, offsets in parts])
    return np.concatenate([ids for ids, _ in parts]), np.concatenate([[0], np.cumsum(ends)])


def id_parts(known: Vocabulary, batches: Iterator[pa.RecordBatch]) -> Iterator[Texts]:
    for batch in batches:
        for i, j in slices(_text(batch)):
            words, rare, offsets = tokens_of(_text(batch).slice(i, j - i))
            yield known.ids(rare, known.places(words)), offsets


def train(docs: DataFrame, known: Vocabulary) -> np.ndarray:
    """Averaged weights after ROUNDS rounds; docs: text, round.

    A task sums its shards' weights; pieces of the sums are added up in two steps, so that no task
    gathers more than a part of them.
    """
    spark = docs.sparkSession
    shared, weights = spark.sparkContext.broadcast(known), None
    for turn in range(ROUNDS):
        start = spark.sparkContext.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vocab, total, seen = shared.value, None, 0
            for flat, n in train_part(vocab, start.value, gathered(id_parts(vocab, batches), SHARD_TOKENS)):
                total, seen = flat.astype(np.float64) * n + (0 if total is None else total), seen + n
            if seen:
                parts = np.array_split(total, PIECES)
                task = TaskContext.get().partitionId() % PARTIAL
                yield pa.RecordBatch.from_arrays([pa.array([task] * PIECES, pa.int32()), pa.array(range(PIECES), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary()), pa.array([seen] * PIECES, pa.int64())], ["task", "piece", "w", "seen"])

        schema = "task int, piece int, w binary, seen long"
        tasks = max(1, -(-known.n // (ROUNDS * SHARD_TOKENS)))
        parts = docs.where(F.col("round") == turn).select("text").coalesce(tasks).mapInArrow(run, schema)
        found = parts.groupBy("task", "piece").applyInArrow(_added, schema).groupBy("piece").applyInArrow(_added, schema).orderBy("piece").collect()
        if found:
            weights = np.concatenate([np.frombuffer(r.w, np.float64) / r.seen for r in found]).astype(np.float32)
    return Network(known).flat if weights is None else weights


def _added(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(w, np.float64) for w in table["w"].to_pylist())
    return pa.table([table["task"][:1], table["piece"][:1], pa.array([total.tobytes()], pa.binary()), pa.array([sum(table["seen"].to_pylist())], pa.int64())], ["task", "piece", "w", "seen"])


SCORED = "n_tokens long, n_known long, base double, score double, others array<struct<word:long,times:int>>"


def score(docs: DataFrame, known: Vocabulary, weights: np.ndarray, carry: list[str]) -> DataFrame:
    """carry's columns, and of each text what a task can tell; others: words that aren't listed."""
    spark = docs.sparkSession
    shared, trained = spark.sparkContext.broadcast(known), spark.sparkContext.broadcast(weights)
    schema = T.StructType([*(docs.schema[c] for c in carry), *T._parse_datatype_string(SCORED).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, held = Scorer(shared.value, trained.value), []
        for batch in batches:
            for i, j in slices(_text(batch)):
                kept = [batch.column(batch.schema.get_field_index(c)).slice(i, j - i) for c in carry]
                held.append((kept, scorer.prepared(_text(batch).slice(i, j - i))))
                if sum(len(x.ids) for _, x in held) >= SCORE_TOKENS:
                    yield from scored(scorer, held)
                    held = []
        yield from scored(scorer, held)

    def scored(scorer: Scorer, held: list) -> Iterator[pa.RecordBatch]:
        for (kept, _), made in zip(held, scorer([x for _, x in held])):
            yield pa.RecordBatch.from_arrays([*kept, *made], [*carry, "n_tokens", "n_known", "base", "score", "others"])

    return docs.select(*carry, "text").mapInArrow(run, schema)


@dataclass
class Prepared:
    """What scoring needs of some texts: their ids, and the columns of SCORED but for the network's share."""

    ids: np.ndarray
    offsets: np.ndarray
    n_known: np.ndarray
    base: np.ndarray
    score: np.ndarray
    others: pa.Array


class Scorer:
    """Texts -> the columns of SCORED."""

    def __init__(self, known: Vocabulary, weights: np.ndarray):
        self.known, self.net = known, Network(known, weights)
        self.share = np.log10(known.rare_n + 0.5 * (known.rare_v + 1))
        self.logs = np.log10(known.counts + 0.5)
        self.total = float(np.log10(known.n + 0.5 * (known.v + 1)))

    def prepared(self, text: pa.Array) -> Prepared:
        known, (words, rare, offsets) = self.known, tokens_of(text)
        at = known.places(words)
        ids = known.ids(rare, at)
        n, of = np.diff(offsets), np.repeat(np.arange(len(text)), np.diff(offsets))
        listed, in_rare = at >= 0, ids >= known.frequent
        summed = lambda mask, values: np.bincount(of[mask], values, len(text))
        base = summed(listed, self.logs[at[listed]]) - self.total * n
        score = np.zeros(len(text)) + summed(listed & in_rare, self.logs[at[listed & in_rare]]) - summed(in_rare, self.share[ids[in_rare] - known.frequent])
        other, who = words[~listed], of[~listed]
        order = np.lexsort((other, who))
        other, who = other[order], who[order]
        fresh = np.ones(len(other), bool)
        fresh[1:] = (other[1:] != other[:-1]) | (who[1:] != who[:-1])
        cuts = np.flatnonzero(fresh)
        times = np.diff(np.concatenate([cuts, [len(other)]])).astype(np.int32)
        rows = pa.StructArray.from_arrays([pa.array(other[cuts].view(np.int64)), pa.array(times)], ["word", "times"])
        starts = np.searchsorted(who[cuts], np.arange(len(text) + 1)).astype(np.int32)
        return Prepared(ids, offsets, summed(listed, None), base, score, pa.ListArray.from_arrays(pa.array(starts), rows))

    def __call__(self, parts: list[Prepared]) -> Iterator[list[pa.Array]]:
        if not parts:
            return
        ids, offsets = _together([(p.ids, p.offsets) for p in parts])
        sums, at = np.zeros(len(offsets) - 1), 0
        for doc, real, logp in windows(self.net, ids, offsets, SCORE_LANES):
            sums[doc] += np.bincount(np.nonzero(real)[1], logp, len(doc))
        for p in parts:
            n = np.diff(p.offsets)
            score = p.score + sums[at : at + len(n)] / np.log(10)
            at += len(n)
            yield [pa.array(n, pa.int64()), pa.array(p.n_known.astype(np.int64)), pa.array(p.base), pa.array(score), p.others]


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    Null texts are empty: one end token. Null ids are training documents. Repeated rows are scored one
    by one. Where there is no training document, every token is unknown. A very long text is read window
    by window, whole. An empty table stays empty; further columns don't matter.
    """
    part = F.pmod(fold(F.col("doc_id")), F.lit(FOLDS))
    parted = docs.select("doc_id", text_of(F.col("text")).alias("text"), (part == HELD_OUT).alias("held_out"), (F.floor(fold(F.col("doc_id")) / FOLDS) % ROUNDS).alias("round"))
    training = parted.where("not held_out")
    counts = written(count_words(training), "counts")
    known = vocabulary(counts)
    weights = train(training, known)
    rows = written(score(parted, known, weights, ["doc_id", "held_out"]).withColumn("row", F.monotonically_increasing_id()), "scored")
    others = rows.select("row", F.inline("others")).join(counts, "word", "left")
    c = F.coalesce("c", F.lit(0))
    rare = others.groupBy("row").agg(F.sum(F.col("times") * F.log10(c + 0.5)).alias("logs"), F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("more"))
    joined = rows.drop("others").join(rare, "row", "left")
    logs = F.coalesce("logs", F.lit(0.0))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).cast("long").alias("n_known"),
        F.lit(known.n).cast("long").alias("train_tokens"),
        (F.col("base") + logs).alias("base_score"),
        (F.col("score") + logs).alias("score"),
    )
