"""Language identification: averaged hashed subword embeddings, a linear softmax, rejection.

A text is the mean of the embeddings of its hashed character n-grams (one to three characters
of a word between two blanks); a linear softmax gives the language. Embeddings and softmax are
trained together by stochastic gradient descent in numpy. Part of the training rows is kept
back to fit a temperature and the rejection bar. The bar is the lowest confidence above which at
least ``precision`` of the kept-back rows are right, and no lower than the confidence below which
kept-back rows and letter noise (characters drawn from the kept-back texts, any label is wrong) are
more often wrong than right; for noise at most a share of ``loss`` of the right rows is given up.
With one language every confidence is 1, and only texts without a letter are rejected.

Training reads a bounded sample: of the texts of at most ``train_chars`` characters ``per_language``
of each language, the first by a hash of the id, one text per id; if they hold more than
``sample_chars`` characters, an equal share of every language. Prediction reads every whole text.

NULL text, or text without a letter, is ``und``, with score 0, and rejected. Rows without a
language or id do not train. Repeated rows get equal results. Without any labelled row every
text is ``und``. Columns other than id, text and language are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import regex
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import hashed_sample, map_rows, pick, remainder
from .registry import query

BUCKETS = 1 << 15
WIDTH = 16
ORDERS = (1, 2, 3)
PIECE = 1 << 16
# Rows of letter noise, and their length at most.
NOISE_ROWS, NOISE_CHARS = 2_000, 2_000
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


def subwords(text: str) -> np.ndarray:
    """Bucket numbers of the n-grams inside words; blanks stand for their ends."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    blank = codes <= 32
    codes = np.where(blank, 32, codes).astype(np.uint64)
    out = []
    for n in ORDERS:
        if len(codes) < n:
            continue
        m = len(codes) - n + 1
        h = np.full(m, n, dtype=np.uint64)
        keep = ~blank[:m] if n == 1 else np.ones(m, dtype=bool)
        for i in range(n):
            h = (h ^ codes[i : i + m]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            if 0 < i < n - 1:
                keep &= ~blank[i : i + m]
        if n == 2:
            keep &= ~(blank[:m] & blank[1 : 1 + m])
        out.append((h[keep] % np.uint64(BUCKETS)).astype(np.int64))
    return np.concatenate(out)


class Model:
    """Trained tables. ``logits[b]`` is bucket b's embedding times the softmax weights."""

    def __init__(self, labels: list[str], logits: np.ndarray, bias: np.ndarray):
        self.labels, self.logits, self.bias = labels, logits.astype(np.float32), bias
        self.temperature, self.bar = 1.0, 0.0

    def scores(self, text: str) -> np.ndarray:
        """Mean logits over the whole text, piece by piece so that memory stays bounded."""
        total, n = np.zeros(len(self.labels)), 0
        for at in range(0, len(text), PIECE):
            grams = subwords(text[at : at + PIECE])
            total += self.logits[grams].sum(axis=0, dtype=np.float64)
            n += len(grams)
        return total / max(1, n) + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, calibrated confidence, rejected)."""
        if not text or not self.labels or not _LETTER.search(text):
            return UNKNOWN, 0.0, True
        p = softmax(self.scores(text) / self.temperature)
        best = int(p.argmax())
        return self.labels[best], float(p[best]), bool(p[best] < self.bar)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def letter_noise(texts: list[str], seed: int) -> list[str]:
    """Texts as long as the given ones, at most NOISE_CHARS, of characters drawn from all of them."""
    texts = [t[:NOISE_CHARS] for t in texts[:NOISE_ROWS] if _LETTER.search(t[:NOISE_CHARS])]
    pool = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    rng = np.random.default_rng(seed)
    drawn = (rng.choice(pool, len(t)).tobytes().decode("utf-32-le", "surrogatepass") for t in texts)
    return [t for t in drawn if _LETTER.search(t)]


def fit(
    rows: list[tuple[str, str]],
    precision: float = 0.95,
    epochs: int = 8,
    seed: int = 5,
    loss: float = 0.01,
) -> Model:
    """Train on (text, language) rows; every fifth row calibrates."""
    labels = sorted({lang for _, lang in rows})
    if not labels:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0))
    rng = np.random.default_rng(seed)
    rows = [rows[i] for i in rng.permutation(len(rows))]
    number = {lang: i for i, lang in enumerate(labels)}
    kept = rows[::5] if len(rows) >= 10 else []
    train = [r for i, r in enumerate(rows) if not kept or i % 5]
    bags = [np.unique(subwords(t), return_counts=True) for t, _ in train]
    target = [number[lang] for _, lang in train]
    emb = rng.normal(0, 0.1, (BUCKETS, WIDTH))
    out = np.zeros((WIDTH, len(labels)))
    bias = np.zeros(len(labels))
    steps, step = epochs * len(train), 0
    for _ in range(epochs):
        for i in rng.permutation(len(train)):
            rate = 2.0 * (1 - step / steps)
            step += 1
            ids, counts = bags[i]
            if not len(ids):
                continue
            share = counts / counts.sum()
            mean = share @ emb[ids]
            gap = softmax(mean @ out + bias)
            gap[target[i]] -= 1
            back = out @ gap
            out -= rate * 0.2 * np.outer(mean, gap)
            bias -= rate * 0.02 * gap
            emb[ids] -= rate * 5 * share[:, None] * back[None, :]
    model = Model(labels, emb @ out, bias)
    noise = letter_noise([t for t, _ in kept], seed)
    _calibrate(model, kept, noise, number, precision, loss)
    return model


def _calibrate(
    model: Model, kept: list, noise: list[str], number: dict, precision: float, loss: float
) -> None:
    kept = [(model.scores(t), number[lang]) for t, lang in kept if t]
    if not kept:
        return
    z, y = np.array([s for s, _ in kept]), np.array([lang for _, lang in kept])

    def confidences(z, t):
        e = np.exp((z - z.max(axis=1, keepdims=True)) / t)
        return e / e.sum(axis=1, keepdims=True)

    # Rows that are all right would make any temperature too high, so a row's target is not quite 1.
    spare = 1 / (len(y) + 2) / max(1, len(model.labels) - 1)
    target = np.full(z.shape, spare)
    target[np.arange(len(y)), y] = 1 - spare * (len(model.labels) - 1)
    grid = [2.0**x for x in np.arange(-6, 5, 0.25)]
    misfit = [-(target * np.log(confidences(z, t) + 1e-12)).sum(axis=1).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(misfit))])
    p = confidences(z, model.temperature)
    best, hit = p.max(axis=1), p.argmax(axis=1) == y
    order = np.argsort(-best)
    right = np.cumsum(hit[order]) / np.arange(1, len(y) + 1)
    good = np.nonzero(right >= precision)[0]
    # All kept-back rows above the bar are right often enough; if that holds for all, noise decides.
    if len(good) == 0:
        model.bar = float(best.max())
    elif good[-1] + 1 < len(y):
        model.bar = float(best[order][good[-1]])
    if noise:
        strange = confidences(np.array([model.scores(t) for t in noise]), model.temperature).max(axis=1)
        model.bar = max(model.bar, _noise_bar(best, hit, strange, loss))


def _noise_bar(best: np.ndarray, hit: np.ndarray, strange: np.ndarray, loss: float) -> float:
    """Confidence with the most wrong rows less right ones below it; noise weighs as much as rows."""
    values = np.concatenate([best, strange])
    gains = np.concatenate([np.where(hit, -1.0, 1.0), np.full(len(strange), len(best) / len(strange))])
    order = np.argsort(values)
    values, gains = values[order], np.cumsum(gains[order])
    # A bar stands between two values; equal ones are on one side.
    ends = np.nonzero(np.append(values[1:] > values[:-1], False))[0]
    if not len(ends) or gains[ends].max() <= 0:
        return 0.0
    at = ends[int(np.argmax(gains[ends]))]
    bar = float(values[at] + values[at + 1]) / 2
    sure = np.sort(best[hit])
    return min(bar, float(sure[int(loss * len(sure))])) if len(sure) else bar


def train(
    docs: DataFrame,
    trains: Column,
    per_language: int = 500,
    max_languages: int = 500,
    train_chars: int = 20_000,
    sample_chars: int = 100_000_000,
    precision: float = 0.95,
    loss: float = 0.01,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> Model:
    """Fit on the rows where ``trains`` (on doc_id) holds; see the module for the sample."""
    rows = pick(docs, doc_id=id_column, text=text_column, lang=lang_column)
    # Texts that cannot train take no place in the sample.
    rows = rows.where(trains & F.length("text").between(1, train_chars))
    ids = hashed_sample(rows.select("lang", "doc_id"), "lang", "doc_id", per_language, max_languages)
    # At most per_language ids of max_languages languages; of rows equal in both one text is taken.
    one = F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text")
    sample = rows.join(F.broadcast(ids), ["lang", "doc_id"]).groupBy("lang", "doc_id").agg(one)
    sample = materialize(sample, "language-sample")
    chars = sample.agg(F.sum(F.length("text"))).first()[0] or 0
    if chars > sample_chars:
        place = F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
        sample = sample.where(place < sample_chars / chars)
    sample = sorted((r["doc_id"], r["text"], r["lang"]) for r in sample.collect())
    return fit([(text, lang) for _, text, lang in sample], precision, loss=loss)


def identify(
    docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, lang_pred, score and rejected of every row."""
    rows = pick(docs, doc_id=id_column, text=text_column)
    kind = dict(rows.dtypes)["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    found = map_rows(
        rows.select(F.col("doc_id").cast("string"), "text"),
        predictor(lambda: shared.value),
        "doc_id string, lang_pred string, score double, rejected boolean",
    )
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))


def predictor(model: Callable[[], Model]) -> Callable:
    def predict(doc_id, text):
        return doc_id, *model().predict(text)

    return predict


def accept(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose language is recognized with confidence."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def accepted(texts):
        return texts.map(lambda t: not shared.value.predict(t)[2]).astype(bool)

    return docs.where(accepted(F.col(f"`{text_column}`")))


@query("op6_language_id")
def op6_language_id(load) -> DataFrame:
    """Every document; rows whose remainder modulo 3 is 1 are held out of the training."""
    docs = load("documents")
    model = train(docs, remainder("doc_id", 3) != 1)
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    return identify(docs, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected"
    )
