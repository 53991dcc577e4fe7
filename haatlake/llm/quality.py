"""A quality classifier learnt from positives and unlabelled text.

Features are shares of kinds of bytes, of pairs of bytes (hashed), of words in capitals,
of words that repeat the word before, lengths of words and lines: they describe how a
text is written, and are computed for whole blocks of texts in numpy. The model is linear in
them and minimises the non-negative unbiased risk

    prior * E_positive[loss(f)] + max(0, E_unlabelled[loss(-f)] - prior * E_positive[loss(-f)])

with the logistic loss, by mini-batch gradient descent: trusted positives, a sample of web
text whose labels aren't looked at, and the share of positives in it. Where a batch makes
the second term negative, its gradient is followed the other way round, which undoes
overfitting. The prior is estimated from the mixture: a first model orders positives and web text,
and where positives are dense and others rare, the web text's share over the positives' share
is least, and bounds the prior from above. With few rows it is the parameter. Where
trusted negatives occur too, a Platt scaling makes the score a probability; it is optional, without it the
score is the model's own.

Edge cases: a null or empty text has the features of no words and gets a score like any
other. Rows without id or label aren't learnt from; a document with conflicting labels
neither. Without positives or unlabelled text every score is the prior. Whole texts are
read, however long. Repeated rows are scored one by one; an empty table gives an empty
table; input columns pass through unless an output has their name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haatlake.llm.common import text_blocks, with_text
from haatlake.llm.hashing import word_hashes

PAIRS = 128
# Rows to learn from, at most about so many of each: trusted positives, trusted negatives, unlabelled.
POSITIVES, NEGATIVES, UNLABELLED = 6_000, 2_000, 8_000
PRIOR, EPOCHS, BATCH, RATE, DECAY = 0.7, 40, 256, 0.05, 1e-4
ACCEPT = 0.3
# Positives, and unlabelled rows, from which the prior is estimated.
ENOUGH = 200

MARKS = b".,;:!?|#$%&*()<>[]{}/\\\"'-_=+@~^`"
KIND = np.zeros(256, np.int32)  # 0: other control bytes
for _group, _bytes in enumerate((range(0x61, 0x7B), range(0x41, 0x5B), range(0x30, 0x3A), (0x20,), (0x0A,), range(0x80, 0x100), *([m] for m in MARKS)), 1):
    KIND[list(_bytes)] = _group
KINDS = int(KIND.max()) + 1
WIDTH = 2 * KINDS + PAIRS + 10


def features(texts: list[str]) -> np.ndarray:
    """A row of WIDTH numbers for each text."""
    n = len(texts)
    raws = [t.encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)
    sizes = np.fromiter(map(len, raws), np.int64, n)
    ends = np.cumsum(sizes + 1)
    owner = np.repeat(np.arange(n, dtype=np.int32), sizes + 1)
    out = np.zeros((n, WIDTH), np.float32)
    kinds = np.bincount(owner * KINDS + KIND[raw], minlength=n * KINDS).reshape(n, KINDS).astype(np.float64)
    kinds[:, 5] -= 1  # the line feed that ends a text here
    size = np.maximum(sizes, 1)[:, None]
    out[:, :KINDS] = np.sqrt(kinds / size)
    out[:, KINDS : 2 * KINDS] = kinds > 0
    pair = (KIND[raw[:-1]] * KINDS + KIND[raw[1:]]) % PAIRS
    within = owner[:-1] == owner[1:]  # none with the next text's first byte
    pairs = np.bincount((owner[:-1] * PAIRS + pair)[within], minlength=n * PAIRS).reshape(n, PAIRS)
    out[:, 2 * KINDS : 2 * KINDS + PAIRS] = np.sqrt(pairs / size)
    starts, stops, words = word_hashes(raw)
    mine = owner[starts]
    count = np.bincount(mine, minlength=n)
    each = np.maximum(count, 1)
    share = lambda flags, lag: np.bincount(mine[lag:][flags], minlength=n) / each
    same = lambda lag: (words[lag:] == words[:-lag]) & (mine[lag:] == mine[:-lag])
    upper = np.r_[0, np.cumsum((raw >= 0x41) & (raw < 0x5B))]
    length = stops - starts
    loud = (upper[stops] - upper[starts]) * 2 > length
    lines = np.maximum(kinds[:, 5] + 1, 1)
    extra = [
        share(same(1), 1), share(same(2), 2), share(loud & (length > 1), 0), share(loud, 0) > 0, share(same(1), 1) > 0,
        np.bincount(mine, length, minlength=n) / each / 10, share(length > 20, 0), np.log1p(count) / 10,
        np.log1p(count / lines) / 5, np.log1p(sizes) / 10,
    ]
    out[:, 2 * KINDS + PAIRS :] = np.stack(extra, 1)
    return out


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weight: np.ndarray
    bias: float
    scale: tuple[float, float]  # Platt

    def margin(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.spread).clip(-6, 6) @ self.weight + self.bias

    def score(self, texts: list[str]) -> np.ndarray:
        return sigmoid(self.scale[0] * self.margin(features(texts)) + self.scale[1]) if texts else np.zeros(0)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 1) -> Model:
    """The linear model of least non-negative risk on feature rows."""
    mean, spread = unlabelled.mean(0), np.maximum(unlabelled.std(0), 1e-3)
    p, u = (((x - mean) / spread).clip(-6, 6) for x in (positive, unlabelled))
    rng = np.random.default_rng(seed)
    weight, bias = np.zeros(p.shape[1]), 0.0
    steps = EPOCHS * max(1, len(u) // BATCH)
    for step in range(steps):
        xp, xu = p[rng.integers(0, len(p), BATCH)], u[rng.integers(0, len(u), BATCH)]
        fp, fu = xp @ weight + bias, xu @ weight + bias
        loss_down = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        up = (sigmoid(fp) - 1) * prior / len(fp)  # slope of prior * loss(f)
        down_u, down_p = sigmoid(fu) / len(fu), -prior * sigmoid(fp) / len(fp)
        if loss_down < 0:
            slope_p, slope_u = -down_p, -down_u
        else:
            slope_p, slope_u = up + down_p, down_u
        rate = RATE * (1 - step / steps)
        weight -= rate * (xp.T @ slope_p + xu.T @ slope_u + DECAY * weight)
        bias -= rate * (slope_p.sum() + slope_u.sum())
    return Model(mean, spread, weight, float(bias), (1.0, 0.0))


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray, least: float = 0.2) -> float:
    """The share of positives in unlabelled rows, from margins: the least ratio of upper tails that hold `least` of the positives.

    A tail of the unlabelled rows holds at least the prior times the positives' tail, and hardly more where
    others are rare. The ratio's own error at a tail's size is added before the least is taken.
    """
    cuts = np.quantile(positive, np.linspace(0, 1 - least, 60))
    p, u = ((x[:, None] >= cuts).mean(0) for x in (positive, unlabelled))
    error = u / p * np.sqrt((1 - u) / np.maximum(u, 1e-9) / unlabelled.size + (1 - p) / p / positive.size)
    at = int((u / p + error).argmin())
    return float(np.clip(u[at] / p[at], 0.01, 0.99))


def platt(margin: np.ndarray, label: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope and offset of least log loss, by Newton's method with a little shrinkage."""
    a, b = 1.0, 0.0
    target = np.where(label == 1, 1 - 1 / (2 + (label == 1).sum()), 1 / (2 + (label == 0).sum()))
    for _ in range(steps):
        q = sigmoid(a * margin + b)
        w = q * (1 - q) + 1e-9
        grad = np.array([((q - target) * margin).sum() + 1e-3 * (a - 1), (q - target).sum()])
        hess = np.array([[(w * margin * margin).sum() + 1e-3, (w * margin).sum()], [(w * margin).sum(), w.sum() + 1e-3]])
        move = np.linalg.solve(hess, grad)
        a, b = a - np.clip(move[0], -1, 1), b - np.clip(move[1], -1, 1)
    return max(float(a), 1e-3), float(b)


def feature_rows(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The features of each row as an array of floats."""
    rows, hidden = with_text(df, keep, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches, hidden):
            made = pa.array(list(features(texts)), pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [made], [*keep, "x"])

    schema = df.select(*keep, F.array(F.lit(0.0).cast("float")).alias("x")).schema
    return rows.mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, usable: Column, doc_id: str = "doc_id", text: str = "text",
          quality: str = "quality", prior: float = PRIOR) -> Model:
    """Learn from bounded samples, chosen by a hash of the id, of rows for which usable (of doc_id) holds.

    Only the features of the sampled rows reach the driver.
    """
    draw = lambda at_most, of: F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < min(1.0, at_most / max(1, of)) * 1_000_000
    trusted = (labels.select(labels[doc_id].alias("doc_id"), labels[quality].alias("quality")).where(usable & F.expr("doc_id is not null"))
               .groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("most")).where("label = most").drop("most"))
    counts = {r[0]: r[1] for r in trusted.groupBy("label").count().collect()}
    ones, zeros = counts.get(1, 0), counts.get(0, 0)
    chosen = trusted.where((F.col("label") == 1) & draw(POSITIVES, ones) | (F.col("label") == 0) & draw(NEGATIVES, zeros))
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).where(usable & F.expr("doc_id is not null"))
    total = rows.count()
    # At most POSITIVES + NEGATIVES rows, give or take the chance of the draw.
    drawn = rows.join(F.broadcast(chosen), "doc_id", "left").withColumn("web", draw(UNLABELLED, total)).where("label is not null or web")
    got = feature_rows(drawn, "text", ["label", "web"]).collect()
    x, label, web = np.array([r[2] for r in got], np.float32).reshape(-1, WIDTH), np.array([-1 if r[0] is None else r[0] for r in got]), np.array([r[1] for r in got], bool)
    if not (label == 1).any() or not web.any():
        zero = np.zeros(WIDTH)
        return Model(zero, zero + 1, zero, float(np.log(prior / (1 - prior))), (1.0, 0.0))
    order = np.lexsort(x.T)  # the same model whatever the order of arrival
    x, label, web = x[order], label[order], web[order]
    positive, unlabelled = x[label == 1].astype(np.float64), x[web].astype(np.float64)
    if len(positive) >= ENOUGH and len(unlabelled) >= ENOUGH:
        # Ordered by a model of one half of either, judged on the other half.
        first = fit(positive[::2], unlabelled[::2], 0.5)
        prior = estimated_prior(first.margin(positive[1::2]), first.margin(unlabelled[1::2]))
    model = fit(positive, unlabelled, prior)
    if (label == 0).any():
        prior = ones / (ones + zeros)  # of trusted labels, where there are both
        # Negatives and positives were drawn at different rates: the offset follows the prior.
        margin = model.margin(x[label >= 0].astype(np.float64))
        a, b = platt(margin, label[label >= 0])
        taken = (label == 1).sum() / (label == 0).sum()
        model.scale = (a, b + float(np.log(prior / (1 - prior) / taken)))
    return model


def score(df: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] | None = None,
          out: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """Add the columns of out: score (0 to 1) and predicted (1 if score >= ACCEPT). No shuffle; the model's size is fixed."""
    held = df.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in (df.columns if keep is None else keep) if c not in out]
    schema = df.select(*kept, F.lit(0.0).alias(out[0]), F.lit(1).alias(out[1])).schema
    rows, hidden = with_text(df, kept, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches, hidden):
            found = held.value.score(texts)
            made = [pa.array(found, pa.float64()), pa.array((found >= ACCEPT).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + made, [*kept, *out])

    return rows.mapInArrow(run, schema)
