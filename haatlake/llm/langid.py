"""Language identification: averaged hashed subword embeddings with a linear softmax.

Subwords are the byte n-grams of the lower-case text, hashed into BUCKETS rows of an
embedding table. A text is the mean of its subwords' rows; a linear layer and softmax
give the languages. Training is mini-batch gradient descent in numpy on pieces of a
bounded sample of labelled texts. Part of the sample is held apart to fit a temperature,
so that the score is a probability, and for each range of lengths the score below which a prediction
is rejected. Pieces of such a length are scored: recognised ones, the same ones with their own language taken
from the choice (a language that wasn't learnt), and random letters. The threshold is what turns
nearly all of the latter away, but at most what keeps all but the share ALPHA of the former. Likewise
a prediction is rejected if fewer of the text's triples of bytes occur in what was learnt than in
nearly all recognised pieces of its length: other alphabets and junk have next to none. For
prediction the table and the layer are one table of a number for each bucket and language.
A text's score doesn't depend on the texts beside it.

Edge cases: a null text or one without a letter is `und` with score 0 and counts as
rejected. Rows without id, text or language aren't learnt from. Without any example the
model knows no language and answers `und` throughout. Whole texts are read, however
long. Repeated rows are predicted one by one; an empty table gives an empty table;
input columns pass through unless an output has their name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haatlake.llm.common import text_blocks, with_text

BUCKETS, DIM, ORDERS = 1 << 16, 16, (1, 2, 3, 4)
# Texts to learn from: at most about so many, divided evenly among the languages.
SAMPLE = 6_000
# Bytes of a piece of a text in training; pieces drawn from one text in an epoch.
PIECE, PIECES, EPOCHS, RATE = 160, 4, 3, 0.5
# Lengths in bytes from which a threshold of its own holds; pieces to fit it on.
LENGTHS, FITTED = (0, 8, 16, 32, 64, 128, 256, 512), 400
# Share of recognised texts that may fall below the threshold, give or take SLACK in log-odds; share of others that should.
ALPHA, SLACK, TURNED = 0.001, 1.0, 0.99
# Of the least share of triples seen in recognised pieces, what is enough.
FAMILIAR = 0.8
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


def subwords(raw: np.ndarray) -> list[np.ndarray]:
    """For each order, the bucket of the n-gram that starts at each byte; grams at the end are shortened."""
    padded = np.zeros(raw.size + max(ORDERS), np.uint32)
    padded[: raw.size] = raw
    out, gram = [], np.zeros(raw.size, np.uint32)
    for k in range(max(ORDERS)):
        gram = gram | (padded[k : k + raw.size] << np.uint32(8 * k))
        if k + 1 in ORDERS:
            mixed = (gram + np.uint32(k + 1)) * np.uint32(0x9E3779B1)
            mixed ^= mixed >> np.uint32(15)
            out.append((mixed * np.uint32(0x85EBCA77)) >> np.uint32(32 - BUCKETS.bit_length() + 1))
    return out


def triples(raw: np.ndarray) -> np.ndarray:
    """The number of the three bytes from each position on."""
    wide = raw.astype(np.int32)
    return wide[:-2] | wide[1:-1] << 8 | wide[2:] << 16


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # a row of logits for each bucket, to be averaged
    bias: np.ndarray
    temperature: float
    thresholds: np.ndarray  # one for each of LENGTHS
    familiar: np.ndarray  # for each of LENGTHS, the least share of triples that were seen
    seen: np.ndarray  # a bit for each triple of bytes

    def shares_seen(self, texts: list[str]) -> np.ndarray:
        """The share of each text's triples of bytes that were learnt from; 1 for texts of fewer bytes."""
        raws = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
        sizes = np.maximum(np.fromiter(map(len, raws), np.int64, len(raws)) - 2, 0)
        raw = np.frombuffer(b"".join(raws) + b"\0\0", np.uint8)
        at = triples(raw)
        known = np.r_[0, np.cumsum(self.seen[at >> 3] >> (at & 7).astype(np.uint8) & 1)]
        begin = np.cumsum(np.fromiter(map(len, raws), np.int64, len(raws))) - np.fromiter(map(len, raws), np.int64, len(raws))
        return np.where(sizes > 0, (known[begin + sizes] - known[begin]) / np.maximum(sizes, 1), 1.0)

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A row of logits for each text, and its bytes."""
        n = len(texts)
        raws = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
        sizes = np.fromiter(map(len, raws), np.int64, n)
        gap = b"\0" * max(ORDERS)  # grams at a text's end reach into it, as in training
        raw = np.frombuffer(gap.join(raws) + gap, np.uint8)
        begin = np.cumsum(sizes + len(gap)) - sizes - len(gap)
        cuts = np.stack([begin, begin + sizes], 1).ravel()
        sums = np.zeros((n, len(self.langs)))
        for grams in subwords(raw):
            for k in range(len(self.langs)):
                sums[:, k] += np.add.reduceat(self.table[:, k][grams], cuts, dtype=np.float64)[::2]
        sums[sizes == 0] = 0
        return sums / np.maximum(sizes, 1)[:, None] / len(ORDERS) + self.bias, sizes

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether the prediction is rejected."""
        n = len(texts)
        if not self.langs or not n:
            return [UNKNOWN] * n, np.zeros(n), np.ones(n, bool)
        logits, sizes = self.logits(texts)
        share = softmax(logits / self.temperature)
        best = share.argmax(1)
        lettered = np.array([LETTER.search(t) is not None for t in texts])
        score = np.where(lettered, share[np.arange(n), best], 0.0)
        length = np.searchsorted(LENGTHS, sizes, "right") - 1
        strange = (score < self.thresholds[length]) | (self.shares_seen(texts) < self.familiar[length])
        return [self.langs[b] if x else UNKNOWN for b, x in zip(best, lettered)], score, ~lettered | strange


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _pieces(raws: list[bytes], labels: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Random pieces of the texts, zero-padded to PIECE bytes, in random order."""
    rows, owner = [], []
    for i, raw in enumerate(raws):
        for _ in range(min(PIECES, 1 + len(raw) // PIECE)):
            size = int(rng.integers(12, PIECE + 1))
            at = int(rng.integers(0, max(1, len(raw) - size + 1)))
            rows.append(np.frombuffer(raw[at : at + size].ljust(PIECE, b"\0"), np.uint8))
            owner.append(i)
    order = rng.permutation(len(rows))
    return np.stack(rows)[order], labels[np.array(owner)[order]]


def fit(examples: list[tuple[str, str]], seed: int = 1) -> Model:
    """A model from (text, language) pairs."""
    examples = sorted(examples)
    langs = sorted({lang for _, lang in examples})
    if not langs:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, np.zeros(len(LENGTHS)), np.zeros(len(LENGTHS)), np.zeros(1 << 21, np.uint8))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(examples))
    apart = order[: len(order) // 8] if len(order) >= 80 else order
    learn = order[len(order) // 8 :] if len(order) >= 80 else order
    raws = [examples[i][0].lower().encode("utf-8", "surrogatepass") for i in learn]
    labels = np.array([langs.index(examples[i][1]) for i in learn])
    table = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    layer, bias = np.zeros((DIM, len(langs)), np.float32), np.zeros(len(langs), np.float32)
    step, steps, batch = 0, None, 64
    for _ in range(EPOCHS):
        rows, target = _pieces(raws, labels, rng)
        steps = steps or EPOCHS * -(-len(rows) // batch)
        for at in range(0, len(rows), batch):
            rate = RATE * (1 - step / (steps * 1.01 + 1))
            step += 1
            part, y = rows[at : at + batch], target[at : at + batch]
            grams = np.stack(subwords(part.ravel()), 1).reshape(len(part), -1)
            used = np.repeat(part != 0, len(ORDERS), axis=1)
            count = np.maximum(used.sum(1), 1)[:, None].astype(np.float32)
            mean = (table[grams] * used[:, :, None]).sum(1) / count
            slope = softmax(mean @ layer + bias)
            slope[np.arange(len(y)), y] -= 1
            slope /= len(y)
            back = (slope @ layer.T) / count
            layer -= rate * 10 * (mean.T @ slope)
            bias -= rate * slope.sum(0)
            where = used.ravel()
            moved = np.repeat(back, grams.shape[1], axis=0)[where]
            np.add.at(table, grams.ravel()[where], -rate * len(y) * 10 * moved.astype(np.float32))
    seen = np.zeros(1 << 24, bool)
    for raw in raws:
        if len(raw) > 2:
            seen[triples(np.frombuffer(raw, np.uint8))] = True
    model = Model(langs, table @ layer, bias.astype(np.float64), 1.0, np.zeros(len(LENGTHS)), np.zeros(len(LENGTHS)), np.packbits(seen, bitorder="little"))
    _calibrate(model, [examples[i] for i in apart], rng)
    return model


def _calibrate(model: Model, held: list[tuple[str, str]], rng: np.random.Generator) -> None:
    """The temperature of least log loss, and the thresholds, on texts held apart and as many short pieces of them."""
    pieces = held + [(t[at : at + int(rng.integers(3, 60))], lang) for t, lang in held for at in (int(rng.integers(0, max(1, len(t) - 20))),)]
    pieces = [(t, lang) for t, lang in pieces if LETTER.search(t)]
    if not pieces:
        return
    logits, _ = model.logits([t for t, _ in pieces])
    target = np.array([model.langs.index(x) for _, x in pieces])
    losses = []
    for temperature in np.geomspace(0.05, 5, 30):
        share = softmax(logits / temperature)[np.arange(target.size), target]
        losses.append((-np.log(np.clip(share, 1e-6, 1)).mean(), float(temperature)))
    model.temperature = min(losses)[1]
    for k, least in enumerate(LENGTHS):
        shorter = (model.thresholds[k - 1], model.familiar[k - 1]) if k else (0.0, 0.0)
        model.thresholds[k], model.familiar[k] = _threshold(model, held, least, LENGTHS[k + 1] if k + 1 < len(LENGTHS) else None, rng, shorter)


def _threshold(model: Model, held: list[tuple[str, str]], least: int, below: int | None, rng: np.random.Generator, shorter: tuple[float, float]) -> tuple[float, float]:
    """Below which score, and share of triples seen, texts of at least so many bytes are rejected; those of shorter ones where there are few to fit on."""
    known = []
    for t, lang in (held[int(i)] for i in rng.permutation(len(held))):
        if len(t) >= least and len(known) < FITTED:
            size = len(t) if below is None else min(len(t), int(rng.integers(max(least, 3), below)))
            at = int(rng.integers(0, len(t) - size + 1))
            if LETTER.search(piece := t[at : at + size]):
                known.append((piece, model.langs.index(lang)))
    if len(known) < 20:
        return shorter
    logits, _ = model.logits([t for t, _ in known])
    target = np.array([y for _, y in known])
    right = logits.argmax(1) == target
    if not right.any():
        return shorter
    score = softmax(logits / model.temperature).max(1)[right]
    kept = float(np.quantile(score, ALPHA, method="lower"))
    odds = np.log(max(kept, 1e-9) / max(1 - kept, 1e-9)) - SLACK
    letters = "abcdefghijklmnopqrstuvwxyz  абвгдежзийклмнопрстуфхцчшщъыьэюя"  # of no language in particular
    noise = ["".join(letters[int(i)] for i in rng.integers(0, len(letters), max(4, len(t)))) for t, _ in known]
    noise += [str(letters[int(i)]) * max(4, len(t)) for (t, _), i in zip(known, rng.integers(0, len(letters), len(known)))]
    others = [softmax(model.logits(noise)[0] / model.temperature).max(1)]
    if len(model.langs) > 2:  # without the text's own language
        left = logits.copy()
        left[np.arange(target.size), target] = -np.inf
        others.append(softmax(left / model.temperature).max(1))
    turned = float(np.quantile(np.concatenate(others), TURNED))
    familiar = float(np.quantile(model.shares_seen([t for t, _ in known])[right], ALPHA, method="lower"))
    return min(1 / (1 + np.exp(-odds)), turned), familiar * FAMILIAR


def train(df: DataFrame, usable: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    """Learn from about `sample` of the rows for which usable holds, chosen by a hash of their id."""
    rows = df.where(usable & df[doc_id].isNotNull() & df[text].isNotNull() & df[lang].isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(df[lang].alias("lang")).count().collect()}  # a row for each language
    each = sample / max(1, len(counts))
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, each / n))]) if counts else None
    if share is None:
        return fit([])
    drawn = F.pmod(F.xxhash64(df[doc_id]), F.lit(1_000_000)) / 1_000_000 < share[df[lang]]
    return fit([(r[0], r[1]) for r in rows.where(drawn).select(df[text], df[lang]).collect()])


def predict(df: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] | None = None,
            out: tuple[str, str, str] = ("lang_pred", "score", "rejected")) -> DataFrame:
    """Add the columns of out: language, score and whether it is rejected. No shuffle; the model's size is fixed."""
    held = df.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in (df.columns if keep is None else keep) if c not in out]
    schema = df.select(*kept, *[F.lit(x).alias(o) for x, o in zip(("", 0.0, True), out)]).schema
    rows, hidden = with_text(df, kept, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches, hidden):
            found, score, rejected = held.value.predict(texts)
            made = [pa.array(found, pa.string()), pa.array(score), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + made, [*kept, *out])

    return rows.mapInArrow(run, schema)
