"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's probability is logistic in its words and their
beginnings; the document's is the noisy-or of its sentences, 1 - prod(1 - p). Weights are
trained from document labels alone, so the sentences that carry a label are found on the way,
and the worst ones are reported.

Training reads a bounded sample: of the labelled texts of at most ``train_chars`` characters
``per_class`` of each class, the first by a hash of the id, one text per id. Scoring reads every whole text.

NULL and empty texts have no sentence and score 0. Unlabelled rows and rows without an id do not
train. Repeated rows get equal results. Without labels, or with one class only, all scores are
0. Columns other than id, text and label are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import hashed_sample, map_rows, pick, remainder
from .registry import query

# Ends of sentences. Shorter parts are joined to the next one ("NO!! WAY!! EVER!!" is not three
# sentences), and a long stretch without an end is cut.
_SENTENCE = re.compile(r"[.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")
LEAST_WORDS, SENTENCE_WORDS = 5, 40
PREFIXES = (4, 5, 6)
# A feature needs this many training documents; a task remembers this many words.
LEAST_DOCS = 4
MEMORY = 500_000


def sentences(text: str | None) -> list[list[str]]:
    """Words of each sentence, in lower case; sentences without words are left out."""
    out, words = [], []
    for part in _SENTENCE.split(text.lower()) if text else ():
        words += _WORD.findall(part)
        if len(words) >= LEAST_WORDS:
            out += [words[i : i + SENTENCE_WORDS] for i in range(0, len(words), SENTENCE_WORDS)]
            words = []
    return [*out, words] if words else out


def features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) >= n)]


class Model:
    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias, self._seen = weights, bias, {}

    def word_weight(self, word: str) -> float:
        w = self._seen.get(word)
        if w is None:
            if len(self._seen) >= MEMORY:
                self._seen.clear()
            w = self._seen[word] = sum(self.weights.get(f, 0.0) for f in features(word))
        return w

    def sentence_scores(self, text: str | None) -> list[tuple[float, list[str]]]:
        out = []
        for words in sentences(text):
            z = self.bias + sum(map(self.word_weight, set(words)))
            out.append((1 / (1 + math.exp(-max(-60.0, min(60.0, z)))), words))
        return out

    def score(self, text: str | None) -> float:
        return noisy_or([p for p, _ in self.sentence_scores(text)])


def noisy_or(p: list[float]) -> float:
    return -math.expm1(sum(math.log1p(-min(x, 1 - 1e-12)) for x in p)) if p else 0.0


def fit(rows: list[tuple[str, int]], epochs: int = 300, l1: float = 4e-4) -> Model:
    """Train on (text, label) rows by proximal gradient steps with momentum (Adam)."""
    bags = [(sentences(t), y) for t, y in rows]
    bags = [(s, y) for s, y in bags if s]
    if len({y for _, y in bags}) < 2:
        return Model({}, -60.0)
    counts = Counter(f for s, _ in bags for f in {f for ws in s for w in ws for f in features(w)})
    names = sorted(f for f, n in counts.items() if n >= LEAST_DOCS)
    number = {f: i for i, f in enumerate(names)}
    sent, feat, doc = [], [], []
    for d, (s, _) in enumerate(bags):
        for words in s:
            ids = [i for w in set(words) for f in features(w) if (i := number.get(f)) is not None]
            sent += [len(doc)] * len(ids)
            feat += ids
            doc.append(d)
    sent, feat, doc = (np.array(a, dtype=np.int64) for a in (sent, feat, doc))
    y = np.array([t for _, t in bags], dtype=float)
    # Both classes weigh the same, so a rare class is not drowned.
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    # A document of many plain sentences starts out as clean as one of few.
    w, bias = np.zeros(len(names)), -math.log(np.bincount(doc).max()) - 2.0
    m, v, mb, vb = np.zeros(len(names)), np.zeros(len(names)), 0.0, 0.0
    for step in range(1, epochs + 1):
        rate = 0.1 * (1 - step / (epochs + 1)) + 0.002
        z = np.clip(np.bincount(sent, w[feat], len(doc)) + bias, -30, 30)
        p = 1 / (1 + np.exp(-z))
        clear = np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-9)), len(bags))
        toxic = np.maximum(-np.expm1(clear), 1e-9)
        # d loss / d z of a sentence: p for a clean document, -p (1 - P) / P for a toxic one.
        pull = weight * np.where(y == 1, -np.exp(clear) / toxic, 1.0)
        dz = pull[doc] * p
        g, gb = np.bincount(feat, dz[sent], len(names)), dz.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        scale = rate / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w -= scale * m / (1 - 0.9**step)
        w = np.sign(w) * np.maximum(np.abs(w) - np.minimum(scale * l1, rate), 0)
        bias -= rate * (mb / (1 - 0.9**step)) / (math.sqrt(vb / (1 - 0.99**step)) + 1e-8)
    return Model({f: float(x) for f, x in zip(names, w, strict=True) if abs(x) > 1e-6}, float(bias))


def train(
    docs: DataFrame,
    labels: DataFrame,
    trains: Column,
    per_class: int = 2_000,
    train_chars: int = 20_000,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
) -> Model:
    """Fit on labelled rows where ``trains`` (on doc_id) holds; see the module for the sample."""
    graded = pick(labels, doc_id=id_column, toxic=label_column).where(
        trains & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()
    )
    # Several labels of one document: toxic if any says so.
    graded = graded.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = pick(docs, doc_id=id_column, text=text_column)
    # Texts that cannot train take no place in the sample.
    texts = texts.where(F.length("text").between(1, train_chars))
    graded = graded.join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
    # At most per_class ids of two classes; of rows with one id one text is taken.
    chosen = F.broadcast(hashed_sample(graded, "toxic", "doc_id", per_class, 2))
    one = F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text")
    rows = texts.join(chosen, "doc_id").groupBy("doc_id", "toxic").agg(one)
    rows = sorted((r["doc_id"], r["text"], r["toxic"]) for r in rows.collect())
    return fit([(text, toxic) for _, text, toxic in rows])


def score(
    docs: DataFrame,
    model: Model,
    worst: int = 3,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, score, and the ``worst`` sentences at 0.5 or more with numbers and scores."""
    rows = pick(docs, doc_id=id_column, text=text_column)
    kind = dict(rows.dtypes)["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(doc_id, text):
        found = shared.value.sentence_scores(text)
        bad = sorted(((p, -i) for i, (p, _) in enumerate(found) if p >= 0.5), reverse=True)[:worst]
        return (
            doc_id,
            noisy_or([p for p, _ in found]),
            [-i for _, i in bad],
            [p for p, _ in bad],
            [" ".join(found[-i][1]) for _, i in bad],
        )

    scored = map_rows(
        rows.select(F.col("doc_id").cast("string"), "text"),
        judge,
        "doc_id string, score double, sentence array<bigint>, sentence_score array<double>, "
        "sentence_words array<string>",
    )
    return scored.withColumn("doc_id", F.col("doc_id").cast(kind))


@query("op9_toxicity")
def op9_toxicity(load) -> DataFrame:
    """Every document; rows whose remainder modulo 5 is 0 are held out of the training."""
    docs = load("documents")
    model = train(docs, load("labels"), remainder("doc_id", 5) != 0)
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    return score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
        F.get("sentence", F.lit(0)).alias("worst_sentence"),
    )
