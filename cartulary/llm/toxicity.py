"""Toxicity by a convolutional text classifier trained here in numpy.

Words (runs of letters, A-Z folded) and their first ``LEAD`` bytes are hashed into
embedding buckets; a word's embedding is the sum of the two.  Filters of widths 1, 2
and 3 run over the whole text, each filter's largest response over all positions is
kept (max pooling), and a logistic layer gives the score.  A bucket carries check bits
of the word it was trained for; others of the bucket and unseen ones take the row of
the unknown word.

The score never sees language, source or id.  Besides the fixed score threshold of
0.5, a threshold per language is calibrated for ``rejected``, on training rows that are
kept back from a first fit.  These also tell when to stop; the model is then fitted
anew on all training rows.  Weights decay towards where they started.

The training sample is bounded by ``TRAIN_ROWS`` labelled rows, those of least
crc32 of their id.  All words of a text train, as all are scored; the driver holds
the hashes of these texts.

Defined cases: null and wordless texts are scored as a text of unknown words;
documents without a label are scored alike; a document with several labels counts
as toxic if one says so; without labelled rows of both kinds every score is the
share of toxic labels (0 without labels); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cartulary.llm.shared import bounded_batches, row_blocks, utf8_column
from cartulary.llm.wordhash import BLOCK, word_hashes

BUCKETS, DIM, WIDTHS, FILTERS = 1 << 18, 4, (1, 2, 3), 3
LEAD = 4
TRAIN_ROWS, FOLDS, HELD_OUT = 6_000, 5, 0
RATE, DECAY = 0.01, 0.3
BACK, LEAST_BACK, PATIENCE = 6, 20, 4


def fold(doc_id: Column) -> Column:
    """Remainder of the crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


@dataclass
class Model:
    """``keys``: check bits of the word that owns a bucket; rows of ``embed`` only for owned buckets and the unknown word."""

    keys: np.ndarray  # uint32 per bucket, 0 for none
    row_of: np.ndarray  # int32 per bucket
    embed: np.ndarray  # (rows + 1, DIM); the last is the unknown word
    filters: list[np.ndarray]  # per width (width, DIM, FILTERS)
    bias: list[np.ndarray]
    out: np.ndarray  # (len(WIDTHS) * FILTERS + 1,)
    constant: float | None = None
    thresholds: dict[str, float] | None = None

    def like(self) -> Model:
        return Model(self.keys.copy(), self.row_of.copy(), self.embed, [], [], self.out, thresholds={})

    def rows(self, h: np.ndarray) -> np.ndarray:
        """Embedding rows of word hashes."""
        bucket = (h & np.uint64(BUCKETS - 1)).astype(np.int64)
        mine = self.keys[bucket] == check_bits(h)
        return np.where(mine, self.row_of[bucket], np.int32(len(self.embed) - 1))


def check_bits(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def _pooled(model: Model, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Largest response of each filter in each text.

    ``rows`` (2, n) holds the texts one after the other, each followed by two unknown words.
    """
    out = []
    for f, b in zip(model.filters, model.bias):
        n = rows.shape[1] - (len(f) - 1)
        r = 0
        for j in range(len(f)):
            table = model.embed @ f[j]
            r = r + table[rows[0, j : j + n]] + table[rows[1, j : j + n]]
        out.append(np.maximum(np.maximum.reduceat(r, starts, axis=0) + b, 0))
    return np.concatenate(out, axis=1)


def _padded(rows: np.ndarray, texts: np.ndarray, count: int, unknown: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``count`` texts with two unknown words after each, and where each text starts."""
    lengths = np.bincount(texts, minlength=count)
    starts = np.concatenate(([0], np.cumsum(lengths + 2)))[:-1]
    flat = np.full((2, int(lengths.sum()) + 2 * count), unknown, np.int32)
    flat[:, np.arange(len(texts)) + 2 * texts] = rows
    return flat, starts


def score_block(model: Model, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    count = len(offsets) - 1
    if model.constant is not None:
        return np.full(count, model.constant)
    h, text, _, _, first = word_hashes(raw, offsets, lead=LEAD)
    flat, starts = _padded(np.stack([model.rows(h), model.rows(first)]), text, count, len(model.embed) - 1)
    z = _pooled(model, flat, starts) @ model.out[:-1] + model.out[-1]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _log_odds(hashes: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each hash in two texts or more: the hash, its texts, and how surely it tells toxic texts (log odds by their deviation)."""
    once = [np.unique(h) for h in hashes]
    label = np.repeat(y, [len(u) for u in once])
    flat = np.concatenate(once)
    order = np.argsort(flat)
    flat, label = flat[order], label[order]
    first = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
    seen = np.diff(np.append(first, len(flat)))
    toxic = np.add.reduceat(label, first)
    common = seen >= 2
    vocab, seen, toxic = flat[first][common], seen[common], toxic[common]
    odds = np.log((toxic + 0.5) / (y.sum() + 1)) - np.log((seen - toxic + 0.5) / ((1 - y).sum() + 1))
    return vocab, seen, odds / np.sqrt(1 / (toxic + 0.5) + 1 / (seen - toxic + 0.5))


def train_hashes(hashes: list[list[np.ndarray]], labels: np.ndarray, langs: list[str | None], seed: int = 7) -> Model:
    """Fit the network on the hashes of each text's words and of their first bytes.

    Embeddings start from each word's log odds of toxic texts, then Adam moves all weights.  A first fit without the
    rows kept back tells how many epochs to take, and calibrates the thresholds; a second one takes all rows."""
    y = np.asarray(labels, np.float64)
    back = calibration_rows(hashes[0], y)
    blank = Model(np.zeros(BUCKETS, np.uint32), np.zeros(BUCKETS, np.int32), np.zeros((1, DIM)), [], [], np.zeros(1))
    blank.thresholds = {}
    if len(y) == 0 or y.min() == y.max() or not any(map(len, hashes[0])):
        blank.constant = float(y.mean()) if len(y) else 0.0
        return blank
    lengths = np.array([len(h) for h in hashes[0]])
    epochs = None
    if back.any():
        first = blank.like()
        flat, starts = _begin(first, hashes, y, ~back, seed)
        kept_back = np.flatnonzero(back)
        epochs = _fit(first, flat, starts, lengths, y, np.flatnonzero(~back), seed, rows_back=kept_back)
        p = _scores(first, flat, starts, lengths, kept_back)
        for k in sorted({x for x in langs if x is not None}):
            mine = np.array([langs[i] == k for i in kept_back], bool)
            blank.thresholds[str(k)] = calibrated(p[mine], y[kept_back][mine])
        del first, flat
    flat, starts = _begin(blank, hashes, y, np.ones(len(y), bool), seed)
    _fit(blank, flat, starts, lengths, y, np.arange(len(y)), seed, epochs)
    return blank


def _begin(model: Model, hashes: list[list[np.ndarray]], y: np.ndarray, some: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Vocabulary and starting weights from the rows ``some``; the padded embedding rows of all texts and their starts."""
    rng = np.random.default_rng(seed)
    found = [_log_odds([x for x, s in zip(h, some) if s], y[some]) for h in hashes]
    vocab, seen, sure = (np.concatenate([f[k] for f in found]) for k in range(3))
    kind = np.repeat([0, 1], [len(f[0]) for f in found])
    order = np.argsort(seen, kind="stable")  # the most common word owns a bucket
    bucket = (vocab[order] & np.uint64(BUCKETS - 1)).astype(np.int64)
    model.keys[bucket] = check_bits(vocab[order])
    model.row_of[bucket] = order
    size = len(vocab) + 1
    model.embed = rng.normal(0, 0.01, (size, DIM))
    model.embed[np.arange(size - 1), kind] = np.clip(sure, -3, 6) / 3
    model.filters = [rng.normal(0, 0.05, (w, DIM, FILTERS)) for w in WIDTHS]
    for f in model.filters:  # the first filter starts on words, the second on first bytes
        f[:, [0, 1], [0, 1]] += 1 / len(f)
    model.bias = [np.full(FILTERS, -0.3) for _ in WIDTHS]
    model.out = rng.normal(0, 0.05, len(WIDTHS) * FILTERS + 1)
    model.out[:2], model.out[-1] = 1.0, -1.5
    owner = np.repeat(np.arange(len(y), dtype=np.int32), [len(h) for h in hashes[0]])
    rows = np.stack([np.concatenate([model.rows(h).astype(np.int32) for h in part]) for part in hashes])
    return _padded(rows, owner, len(y), size - 1)


def calibration_rows(hashes: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Whether a row is kept back from the fit: those of one remainder in ``BACK`` of a digest of the text's words, so
    that copies of a text stay together; none where that leaves fewer than ``LEAST_BACK`` rows of either kind."""
    back = np.array([int(h.sum(dtype=np.uint64) >> np.uint64(33)) % BACK == 0 for h in hashes], bool)
    few = min(y[back].sum(), (1 - y)[back].sum()) < LEAST_BACK if len(y) else True
    return np.zeros(len(y), bool) if few else back


def calibrated(p: np.ndarray, y: np.ndarray) -> float:
    """The threshold of least error on the rows of a language, the one nearest to 0.5 among equals;
    0.5 where the language has too few rows (under 10) of either kind."""
    if min(y.sum(), (1 - y).sum()) < 10:
        return 0.5
    cuts = np.linspace(0.2, 0.8, 61)
    errors = np.array([((p >= c) != (y > 0.5)).sum() for c in cuts])
    best = cuts[errors == errors.min()]
    return float(best[np.argmin(np.abs(best - 0.5))])


def _batch(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    take = lengths[pick] + 2
    at = np.concatenate(([0], np.cumsum(take)))[:-1]
    return flat[:, np.arange(take.sum()) - np.repeat(at - starts[pick], take)], at


def _scores(model: Model, flat, starts, lengths, pick) -> np.ndarray:
    out = [np.zeros(0)]
    for i in range(0, len(pick), 256):
        rows, at = _batch(flat, starts, lengths, pick[i : i + 256])
        out.append(1 / (1 + np.exp(-np.clip(_pooled(model, rows, at) @ model.out[:-1] + model.out[-1], -30, 30))))
    return np.concatenate(out)


def _loss(p: np.ndarray, y: np.ndarray) -> float:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


def _fit(model: Model, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, y: np.ndarray, rows_in: np.ndarray, seed: int, epochs: int | None = None, rows_back: np.ndarray = np.zeros(0, np.int64)) -> int:
    """Adam; the gradient of a pooled filter flows to the words of its largest response.

    Weights decay towards where they started.  Returns the epochs taken: ``epochs`` if given, else as many as have the
    least loss on ``rows_back``, whose weights stay, or all if there are none."""
    rng = np.random.default_rng(seed + 1)
    params = [model.embed, *model.filters, *model.bias, model.out]
    began = [p.copy() for p in params]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    most = epochs or int(np.clip(60_000 // max(len(rows_in), 1), 4, 40))
    batch, step, rate = 64, 0, RATE
    weight = np.where(y > 0.5, min(4.0, np.sqrt((1 - y).sum() / y.sum())), 1.0)
    best, least, taken = None, np.inf, most
    for epoch in range(1, most + 1):
        order = rng.permutation(rows_in)
        for i in range(0, len(order), batch):
            pick = order[i : i + batch]
            rows, at = _batch(flat, starts, lengths, pick)
            ends = np.append(at[1:], rows.shape[1])
            grads = [np.zeros_like(p) if k else None for k, p in enumerate(params)]
            touched, feats, tops = [], [], []
            for f, b in zip(model.filters, model.bias):
                w = len(f)
                n = rows.shape[1] - (w - 1)
                r = sum(model.embed[k[j : j + n]] @ f[j] for k in rows for j in range(w))
                top = np.stack([s + r[s : min(e, n)].argmax(0) for s, e in zip(at, ends)])
                tops.append(top)
                feats.append(np.maximum(np.take_along_axis(r, top, 0) + b, 0))
            x = np.concatenate(feats, axis=1)
            p = 1 / (1 + np.exp(-np.clip(x @ model.out[:-1] + model.out[-1], -30, 30)))
            g = (p - y[pick]) * weight[pick] / len(pick)
            grads[-1][:-1], grads[-1][-1] = x.T @ g, g.sum()
            for k, f in enumerate(model.filters):
                part = slice(k * FILTERS, (k + 1) * FILTERS)
                d = g[:, None] * model.out[part][None] * (feats[k] > 0)
                grads[1 + len(WIDTHS) + k] += d.sum(0)
                for j in range(len(f)):
                    for kind in rows:
                        at_rows = kind[tops[k] + j]
                        grads[1 + k][j] += np.einsum("tf,tfd->df", d, model.embed[at_rows])
                        touched.append((at_rows.ravel(), (d[:, :, None] * f[j].T[None]).reshape(-1, DIM)))
            idx = np.concatenate([a for a, _ in touched])
            u, inv = np.unique(idx, return_inverse=True)
            ge = np.zeros((len(u), DIM))
            np.add.at(ge, inv, np.concatenate([b for _, b in touched]))
            step += 1
            scale = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, par in enumerate(params):
                if k == 0:
                    m[0][u] = 0.9 * m[0][u] + 0.1 * ge
                    v[0][u] = 0.999 * v[0][u] + 0.001 * ge**2
                    par[u] -= scale * m[0][u] / (np.sqrt(v[0][u]) + 1e-8) + rate * DECAY * (par[u] - began[0][u])
                else:
                    m[k] = 0.9 * m[k] + 0.1 * grads[k]
                    v[k] = 0.999 * v[k] + 0.001 * grads[k] ** 2
                    par -= scale * m[k] / (np.sqrt(v[k]) + 1e-8) + rate * DECAY * (par - began[k])
        if len(rows_back):
            now = _loss(_scores(model, flat, starts, lengths, rows_back), y[rows_back])
            if now < least:
                best, least, taken = [p.copy() for p in params], now, epoch
            elif epoch >= taken + PATIENCE:
                break
    if best is not None:
        for p, q in zip(params, best):
            p[...] = q
    return taken


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Train on at most ``rows`` labelled documents outside the held-out fold."""
    mine = labels.where(F.col("toxic").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.crc32(F.concat(F.lit("sample "), F.col("doc_id").cast("string")).cast("binary"))
    chosen = mine.orderBy(order, "doc_id").limit(rows)
    sample = docs.select("doc_id", "text", "lang").join(chosen, "doc_id").select("doc_id", "text", "lang", "toxic")
    ids, toxic, langs, hashes = [], [], [], ([], [])
    for doc_id, text, lang, label in sample.toLocalIterator():  # texts are hashed as they come, not held
        raw = np.frombuffer((text or "").encode(), np.uint8)
        h, _, _, _, first = word_hashes(raw, np.array([0, len(raw)]), lead=LEAD)
        ids.append((doc_id, len(raw), int(h.sum()) if len(h) else 0))
        toxic.append(label)
        langs.append(lang)
        for out, x in zip(hashes, (h, first)):
            out.append(x)
    order = sorted(range(len(ids)), key=ids.__getitem__)  # the same order whatever the partitions
    return train_hashes([[part[i] for i in order] for part in hashes], np.array([toxic[i] for i in order]), [langs[i] for i in order])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``rejected`` (score at or above its language's threshold)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # bounded by BUCKETS and the training sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for b in batches:
            offsets, raw = utf8_column(b, "text")
            p = [score_block(net, raw, offsets[i : j + 1]) for i, j in row_blocks(offsets, BLOCK // 4)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), b.column("lang"), pa.array(np.concatenate([*p, np.zeros(0)]))], ["doc_id", "lang", "score"])

    bounded_batches(docs)
    scored = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang")).mapInArrow(run, "doc_id long, lang string, score double")
    cut = F.coalesce(*(F.when(F.col("lang") == k, F.lit(t)) for k, t in (model.thresholds or {}).items()), F.lit(0.5))
    return scored.select("doc_id", "lang", "score", (F.col("score") >= cut).alias("rejected"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with its own columns, without the documents that the calibrated classifier rejects."""
    model = fit(docs, labels)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        cuts = net.thresholds or {}
        for b in batches:
            offsets, raw = utf8_column(b, "text")
            p = np.concatenate([*(score_block(net, raw, offsets[i : j + 1]) for i, j in row_blocks(offsets, BLOCK // 4)), np.zeros(0)])
            cut = np.array([cuts.get(x, 0.5) for x in b.column("lang").to_pylist()])
            yield b.filter(pa.array(p < cut)) if len(p) else b

    bounded_batches(docs)
    return docs.select(*names).mapInArrow(run, docs.schema)
