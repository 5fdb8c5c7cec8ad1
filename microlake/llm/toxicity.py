"""Toxicity: a bidirectional gated recurrent network with attention pooling.

A word's input is its hashed word embedding beside the greatest of the hashed embeddings of
its character grams, 4 to 10 bytes long: the long ones tell words that share a stem. Overlapping windows of ``WINDOW`` words, ``STRIDE`` apart, run through a
gated recurrent unit in both directions; attention pools the states of a window into one
logit. The score of a text is its highest window's, calibrated: every window of the whole
text counts.

Trained here in numpy from a bounded sample of labelled rows (``SAMPLE_TOXIC`` and
``SAMPLE_CLEAN`` rows of at most ``SAMPLE_CHARS`` characters, chosen by digest). A label says that some
window is toxic, not which: the first epochs learn from the window whose words are most
particular to toxic texts of the sample, later ones from the window the network itself
scores highest, beside other windows of non-toxic texts. Only words and grams in at least as
many texts as ``LEAST_SHARE`` of the toxic ones (and two) are learnt, all others stay near
zero: what one text alone holds would be learnt by heart. Scoring runs in Spark's tasks.
"""
from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import unused_name

WINDOW, STRIDE = 24, 12
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_CHARS = 900, 2700, 6000
WORD_SLOTS, GRAM_BITS, EMBED, HIDDEN, ATTEND = 1 << 16, 17, 8, 8, 8
GRAM_SLOTS = 1 << GRAM_BITS
LEAST_SHARE = 0.03
EPOCHS, WARM_SHARE, LEAST_STEPS, BATCH, RATE = 8, 0.4, 300, 128, 0.03
MAX_WORDS = 150_000
_SIGNS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”‘’„…–—¡¿"


# --- inputs -------------------------------------------------------------------------

def words_of(text: str | None) -> list[str]:
    """Lower-cased words, separated by white space; signs at their ends are taken off later."""
    return (text or "").lower().split()


def inputs_of(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word slot per word, gram slots one word after another, first gram of each word)."""
    raw = [w.strip(_SIGNS).encode("utf-8", "surrogatepass") for w in words]
    slots = np.fromiter((zlib.crc32(w) % WORD_SLOTS for w in raw), np.int64, len(raw))
    marked = b"".join(b"\x02" + w + b"\x03\x03\x03" for w in raw) + bytes(10)
    octets = np.frombuffer(marked, np.uint8).astype(np.uint32)
    sizes = np.fromiter((len(w) + 4 for w in raw), np.int64, len(raw))
    ends = np.cumsum(sizes)
    n = len(octets) - 10
    four = ((octets[:-3] * 31 + octets[1:-2]) * 31 + octets[2:-1]) * 31 + octets[3:]
    eight = four[:n + 2] * np.uint32(1000003) + four[4:n + 6]
    grams = np.stack([four[:n], four[:n] * np.uint32(8191) + four[2:n + 2], eight[:n], eight[:n] * np.uint32(131071) + four[6:n + 6]], axis=1)
    grams = (grams * np.uint32(2654435761) >> np.uint32(32 - GRAM_BITS)).astype(np.int64)
    left = np.repeat(ends, sizes) - np.arange(n)                    # octets of the word from here on, end marks too
    inside = left[:, None] >= np.array([4, 8, 10, 12])              # grams over 4 octets take one end mark at most
    counts = np.add.reduceat(inside.sum(axis=1), ends - sizes)
    return slots, grams[inside], np.cumsum(counts) - counts


def window_starts(n: int) -> np.ndarray:
    """First word of each window; the last window ends with the text."""
    if n <= WINDOW:
        return np.zeros(1, np.int64)
    starts = np.arange(0, n - WINDOW + 1, STRIDE)
    return starts if starts[-1] + WINDOW == n else np.append(starts, n - WINDOW)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


# --- the network --------------------------------------------------------------------

def new_network(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)

    def normal(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    return {
        "word": normal(WORD_SLOTS, EMBED, scale=0.005), "gram": normal(GRAM_SLOTS, EMBED, scale=0.005),
        "wx": normal(2, 2 * EMBED, 3 * HIDDEN, scale=0.3), "bx": np.zeros((2, 1, 3 * HIDDEN), np.float32),
        "wh": normal(2, HIDDEN, 3 * HIDDEN, scale=0.3),
        "wa": normal(2 * HIDDEN, ATTEND, scale=0.3), "ba": np.zeros(ATTEND, np.float32), "va": normal(ATTEND, scale=0.3),
        "wo": normal(2 * HIDDEN, scale=0.3), "bo": np.zeros(1, np.float32),
        "scale": np.array([1.0, 0.0], np.float32),
    }


def embed(net, slots, grams, firsts):
    """Inputs of words: word embedding, greatest character-gram embedding."""
    return np.concatenate([net["word"][slots], np.maximum.reduceat(net["gram"][grams], firsts, axis=0)], axis=1)


def project(net, x):
    """Input parts of the gates in both directions, one row per word: (n, 2, 3 * HIDDEN)."""
    return (np.matmul(x[None], net["wx"]) + net["bx"]).transpose(1, 0, 2)


def forward(net, rows, table, keep=None):
    """Logits of windows. ``rows``: (windows, WINDOW) rows of ``table``, -1 pads short texts at the end."""
    b, steps = rows.shape
    mask = (rows >= 0) if (rows < 0).any() else None
    safe = np.maximum(rows, 0) if mask is not None else rows
    h = np.zeros((2, b, HIDDEN), np.float32)
    states = np.empty((steps, b, 2 * HIDDEN), np.float32)
    tape = []
    for t in range(steps):
        gates = np.stack([table[safe[:, t], 0], table[safe[:, steps - 1 - t], 1]])
        part = np.matmul(h, net["wh"])
        zr = _sigmoid(gates[..., :2 * HIDDEN] + part[..., :2 * HIDDEN])
        z, r = zr[..., :HIDDEN], zr[..., HIDDEN:]
        new = np.tanh(gates[..., 2 * HIDDEN:] + r * part[..., 2 * HIDDEN:])
        after = new + z * (h - new)
        if mask is not None:
            m = np.stack([mask[:, t], mask[:, steps - 1 - t]])[..., None]
            after = np.where(m, after, h)
        if keep is not None:
            tape.append((h, z, r, new, part[..., 2 * HIDDEN:]))
        h = after
        states[t, :, :HIDDEN] = h[0]
        states[steps - 1 - t, :, HIDDEN:] = h[1]
    seen = np.tanh(states @ net["wa"] + net["ba"])
    score = seen @ net["va"]
    if mask is not None:
        score = np.where(mask.T, score, -1e9)
    weight = np.exp(score - score.max(axis=0))
    weight /= weight.sum(axis=0)
    pooled = np.einsum("tb,tbk->bk", weight, states)
    logit = pooled @ net["wo"] + net["bo"]
    if keep is not None:
        keep.update(mask=mask, safe=safe, tape=tape, states=states, seen=seen, weight=weight, pooled=pooled)
    return logit


def backward(net, kept, d_logit, n_rows):
    """Gradients of all dense weights, and of the projected inputs per table row."""
    safe, states, seen, weight, mask = (kept[k] for k in ("safe", "states", "seen", "weight", "mask"))
    b, steps = safe.shape
    g = {"wo": kept["pooled"].T @ d_logit, "bo": d_logit.sum(keepdims=True)}
    d_pooled = d_logit[:, None] * net["wo"]
    d_weight = np.einsum("bk,tbk->tb", d_pooled, states)
    d_states = weight[..., None] * d_pooled
    d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
    g["va"] = np.einsum("tb,tba->a", d_score, seen)
    d_pre = d_score[..., None] * net["va"] * (1 - seen ** 2)
    g["wa"], g["ba"] = np.einsum("tbk,tba->ka", states, d_pre), d_pre.sum(axis=(0, 1))
    d_states += d_pre @ net["wa"].T
    d_table = np.zeros((n_rows, 2, 3 * HIDDEN), np.float32)
    g["wh"] = np.zeros_like(net["wh"])
    d_h = np.zeros((2, b, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1):
        d_h = d_h + np.stack([d_states[t, :, :HIDDEN], d_states[steps - 1 - t, :, HIDDEN:]])
        h, z, r, new, part = kept["tape"][t]
        through = 0
        if mask is not None:
            m = np.stack([mask[:, t], mask[:, steps - 1 - t]])[..., None]
            through, d_h = np.where(m, 0, d_h), np.where(m, d_h, 0)
        d_new = d_h * (1 - z) * (1 - new ** 2)
        d_z = d_h * (h - new) * z * (1 - z)
        d_r = d_new * part * r * (1 - r)
        d_gates = np.concatenate([d_z, d_r, d_new], axis=-1)
        d_part = np.concatenate([d_z, d_r, d_new * r], axis=-1)
        np.add.at(d_table, (safe[:, t], 0), d_gates[0])
        np.add.at(d_table, (safe[:, steps - 1 - t], 1), d_gates[1])
        g["wh"] += np.matmul(h.transpose(0, 2, 1), d_part)
        d_h = d_h * z + np.matmul(d_part, net["wh"].transpose(0, 2, 1)) + through
    return g, d_table


class _Adagrad:
    def __init__(self, net):
        self.seen = {k: np.full_like(v, 1e-6) for k, v in net.items()}

    def step(self, net, key, grad, rows=None):
        at = slice(None) if rows is None else rows
        self.seen[key][at] += grad ** 2
        net[key][at] -= RATE * grad / np.sqrt(self.seen[key][at])


def _learn(net, adagrad, rows, labels, weights, vocab):
    """One step on a batch of windows over the sample's vocabulary."""
    used = np.unique(rows[rows >= 0])
    local = np.where(rows >= 0, np.searchsorted(used, rows), -1)
    slots, grams, firsts = vocab.of(used)
    x = embed(net, slots, grams, firsts)
    kept: dict = {}
    p = _sigmoid(forward(net, local, project(net, x), kept))
    g, d_table = backward(net, kept, ((p - labels) * weights / len(labels)).astype(np.float32), len(used))
    d_gates = d_table.transpose(1, 0, 2)
    g["wx"], g["bx"] = np.matmul(x.T[None], d_gates), d_gates.sum(axis=1, keepdims=True)
    d_x = np.matmul(d_gates, net["wx"].transpose(0, 2, 1)).sum(axis=0)
    where, back = np.unique(slots, return_inverse=True)
    d_word = np.zeros((len(where), EMBED), np.float32)
    np.add.at(d_word, back, d_x[:, :EMBED])
    values = net["gram"][grams]
    owner = np.repeat(np.arange(len(used)), np.diff(np.append(firsts, len(grams))))
    top = values == x[owner, EMBED:]                     # the gram that gave the greatest value takes the gradient
    where_g, back_g = np.unique(grams, return_inverse=True)
    d_gram = np.zeros((len(where_g), EMBED), np.float32)
    np.add.at(d_gram, back_g, top * d_x[owner, EMBED:])
    for key, grad in g.items():
        adagrad.step(net, key, grad)
    for key, grad, at, shared in (("word", d_word, where, vocab.shared_words), ("gram", d_gram, where_g, vocab.shared_grams)):
        adagrad.step(net, key, grad[shared[at]], at[shared[at]])


def _in_texts(keys, size, least):
    """Whether at least ``least`` of the texts hold a key."""
    count = np.zeros(size, np.int64)
    for key in keys:
        count[np.unique(key)] += 1
    return count >= least


class _Vocabulary:
    """The words of the sample and their inputs."""

    def __init__(self, texts, least=2):
        self.place: dict[str, int] = {}
        self.texts = [np.fromiter((self.place.setdefault(w, len(self.place)) for w in words_of(t)), np.int64) for t in texts]
        self.slots, self.grams, firsts = inputs_of(list(self.place) or [""])
        self.firsts = np.append(firsts, len(self.grams))
        held = [self.of(np.unique(t)) for t in self.texts if len(t)]
        self.shared_words = _in_texts([h[0] for h in held], WORD_SLOTS, least)
        self.shared_grams = _in_texts([h[1] for h in held], GRAM_SLOTS, least)

    def of(self, used):
        sizes = self.firsts[used + 1] - self.firsts[used]
        firsts = np.cumsum(sizes) - sizes
        at = np.arange(sizes.sum()) - np.repeat(firsts, sizes) + np.repeat(self.firsts[used], sizes)
        return self.slots[used], self.grams[at], firsts


def _windows(text):
    if not len(text):
        return np.full((1, WINDOW), -1, np.int64)
    if len(text) < WINDOW:
        return np.append(text, np.full(WINDOW - len(text), -1))[None]
    return text[window_starts(len(text))[:, None] + np.arange(WINDOW)]


def _particular(vocab, labels):
    """Per word, how much more texts with label 1 hold it or its most telling character gram."""
    good, bad = (labels == 0).sum(), (labels == 1).sum()

    def odds(keys, size):
        count = np.zeros((2, size))
        for key, y in zip(keys, labels):
            count[int(y), key] += 1
        p, q = (count[1] + 0.5) / (bad + 1), (count[0] + 0.5) / (good + 1)
        return np.where(count[1] > 1, np.log(p / q) * np.sqrt(count[1]), -10)

    texts = [np.unique(t) for t in vocab.texts]
    by_word = odds(texts, len(vocab.slots))
    by_gram = odds([np.unique(vocab.of(t)[1]) if len(t) else t for t in texts], GRAM_SLOTS)
    return np.maximum(by_word, np.maximum.reduceat(by_gram[vocab.grams], vocab.firsts[:-1]))


def train(rows: list[tuple[str | None, int]], epochs: int = EPOCHS, seed: int = 7) -> dict[str, np.ndarray] | None:
    """Weights fitted to (text, label) rows; None if a label is missing among them."""
    rows = [(t, int(y)) for t, y in rows if y is not None and words_of(t)]
    labels = np.array([y for _, y in rows], dtype=np.int64)
    if not len(rows) or labels.min() == labels.max():
        return None
    rng = np.random.default_rng(seed)
    vocab = _Vocabulary([t for t, _ in rows], max(2, int(LEAST_SHARE * labels.sum())))
    windows = [_windows(t) for t in vocab.texts]
    flat = np.concatenate(windows)
    ends = np.cumsum([len(w) for w in windows])
    begins = ends - [len(w) for w in windows]
    particular = np.append(_particular(vocab, labels), -20.0)       # the last is the pad's
    guess = particular[flat].max(axis=1)
    net = new_network(seed)
    adagrad = _Adagrad(net)
    flat_clean = np.flatnonzero(np.repeat(labels, [len(w) for w in windows]) == 0)
    clean = np.flatnonzero(labels == 0)
    epochs = max(epochs, -(-LEAST_STEPS * BATCH // (len(labels) + 3 * len(clean))))
    for epoch in range(epochs):
        if epoch >= WARM_SHARE * epochs:
            guess = _all_logits(net, flat, vocab)
        top = np.array([a + int(np.argmax(guess[a:b])) for a, b in zip(begins, ends)])
        hard = flat_clean[np.argsort(-guess[flat_clean], kind="stable")[:len(clean)]]
        more = np.concatenate([hard, *(rng.integers(begins[clean], ends[clean]) for _ in range(2))])
        pick, y = np.append(top, more), np.append(labels, np.zeros(len(more), np.int64))
        weight = np.append(np.where(labels == 1, 1.0, 0.5), np.full(len(more), 0.5))
        order = rng.permutation(len(pick))
        for k in range(0, len(order), BATCH):
            at = order[k:k + BATCH]
            _learn(net, adagrad, flat[pick[at]], y[at], weight[at], vocab)
    best = np.maximum.reduceat(_all_logits(net, flat, vocab), begins)
    net["scale"] = _calibrate(best, labels)
    return net


def _all_logits(net, flat, vocab):
    table = project(net, embed(net, vocab.slots, vocab.grams, vocab.firsts[:-1]))
    return np.concatenate([forward(net, flat[k:k + 2048], table) for k in range(0, len(flat), 2048)])


def _calibrate(logits, labels):
    """Slope and offset of a logistic fit of labels to text logits, by Newton steps with a little shrinkage."""
    x = np.stack([logits.astype(np.float64), np.ones(len(logits))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(20):
        p = _sigmoid(x @ w)
        grad = x.T @ (p - labels) + 0.1 * (w - [1.0, 0.0])
        hess = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        w = w - np.clip(np.linalg.solve(hess, grad), -1, 1)
    return np.array([max(w[0], 1e-3), w[1]], np.float32)


# --- scoring ------------------------------------------------------------------------

class Scorer(dict):
    """Scores of whole texts. Words map to rows of a table of projected inputs, at most ``MAX_WORDS`` at a time."""

    def __init__(self, net):
        super().__init__()
        self.net, self.pending, self.table = net, [], np.zeros((0, 2, 3 * HIDDEN), np.float32)

    def __missing__(self, word):
        self[word] = k = len(self)
        self.pending.append(word)
        return k

    def _fill(self):
        if self.pending:
            rows = project(self.net, embed(self.net, *inputs_of(self.pending)))
            used = len(self) - len(self.pending)
            if len(self) > len(self.table):
                grown = np.zeros((max(len(self), 2 * len(self.table)), 2, 3 * HIDDEN), np.float32)
                grown[:used] = self.table[:used]
                self.table = grown
            self.table[used:len(self)] = rows
            self.pending = []

    def _logits(self, windows):
        self._fill()
        return np.concatenate([forward(self.net, windows[k:k + 2048], self.table) for k in range(0, len(windows), 2048)])

    def scores(self, texts) -> np.ndarray:
        """Score of each text, from 0 to 1; 0 for a text without a word. Texts are gathered until enough windows wait, long ones go in slices."""
        out = np.full(len(texts), -np.inf)
        waiting, owners, number = [], [], 0

        def settle():
            nonlocal waiting, owners, number
            if waiting:
                np.maximum.at(out, np.concatenate(owners), self._logits(np.concatenate(waiting)))
            waiting, owners, number = [], [], 0
            if len(self) > MAX_WORDS:
                self.clear()

        for k, text in enumerate(texts):
            words = words_of(text)
            step = 512 * STRIDE
            for a in range(0, max(len(words) - STRIDE, min(len(words), 1)), step):       # slices share a window's overlap
                part = words[a:a + step + WINDOW - STRIDE]
                ids = np.fromiter(map(self.__getitem__, part), np.int64, len(part))
                waiting.append(_windows(ids))
                owners.append(np.full(len(waiting[-1]), k))
                number += len(waiting[-1])
                if number >= 4096:
                    settle()
        settle()
        slope, offset = self.net["scale"].astype(np.float64)
        return np.where(np.isneginf(out), 0.0, _sigmoid(slope * out + offset))


def _score_batches(at: int, net, names):
    def run(batches):
        scorer = Scorer(net.value) if net.value is not None else None
        for batch in batches:
            texts = batch.column(at).to_pylist()
            scores = scorer.scores(texts) if scorer is not None else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=names)

    return run


def with_scores(spark: SparkSession, docs: DataFrame, net, name: str = "score") -> DataFrame:
    """``docs`` with a column of scores from their ``text`` alone. Without a network every score is 0.

    Null, empty and blank texts score 0; rows are scored each on their own.
    """
    shared = spark.sparkContext.broadcast(net)          # a network of fixed size, about 6 MB
    fields = docs.schema.fieldNames()
    return docs.mapInArrow(_score_batches(fields.index("text"), shared, [*fields, name]),
                           T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def held_out(doc_id: str = "doc_id"):
    """True for the fifth of the rows that training never sees; null doc_ids count as held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN,
        chars: int = SAMPLE_CHARS):
    """A network trained on at most ``toxic`` and ``clean`` labelled rows, none of them held out; None without both.

    Several labels of one doc_id count as the greatest. The candidates' ids are chosen by
    digest, three times as many as needed, since some texts may be longer than ``chars``.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")) \
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out()) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    digest = F.xxhash64("doc_id")
    bounds = {1: toxic, 0: clean}
    ids = [known.where(F.col("toxic") == y).orderBy(digest, "doc_id").limit(3 * n) for y, n in bounds.items()]
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = slim.where(F.length("text") <= chars).join(F.broadcast(ids[0].union(ids[1])), "doc_id")     # 3 * (toxic + clean) rows
    sample = [found.where(F.col("toxic") == y).orderBy(digest, "doc_id", "text").limit(n) for y, n in bounds.items()]
    return train([(r["text"], r["toxic"]) for r in sample[0].union(sample[1]).select("text", "toxic").collect()])


def judge(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per document row; repeated rows and null doc_ids stay."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return with_scores(spark, slim, fit(spark, docs, labels)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` scored under 0.5, with all their columns."""
    name = unused_name(docs, "score")
    return with_scores(spark, docs, fit(spark, docs, labels), name).where(F.col(name) < 0.5).drop(name)
