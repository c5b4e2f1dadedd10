"""Toxicity by multiple-instance learning: sentences combine by noisy-or, labels are per text.

A sentence's probability is a logistic function of its features (words and word stems); a
text is toxic if any sentence is, so its probability is 1 - (1 - leak) * prod(1 - p). Only
sentences that hold a learned feature count as instances; all others share one leak per
text, so that a long clean text does not become toxic by its length.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterbill.llm.common import stage

SENTENCE = re.compile(r"[^.!?\n]+")
NOT_LETTERS = re.compile(r"[\W\d_]+")
STEMS = (4, 5, 6)


@dataclass(frozen=True)
class Model:
    """Weight of each feature, the bias of a sentence, and the log-odds of the leak."""

    weights: dict[str, float]
    bias: float
    leak: float


def features(token: str) -> list[str]:
    """The word in a token, marked by $, and its first letters; none without a letter."""
    word = NOT_LETTERS.sub("", token.lower())
    return [word + "$", *(word[:n] for n in STEMS if len(word) >= n)] if word else []


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Rows whose labels are for measuring: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _text_features(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for some in texts:
        yield pd.Series([sorted({f for t in (text or "").split() for f in features(t)}) for text in some])


def _bags(names: dict[str, int]):
    def work(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for some in texts:
            rows = []
            for text in some:
                bags = set()
                for m in SENTENCE.finditer(text or ""):
                    got = {names[f] for t in m[0].split() for f in features(t) if f in names}
                    if got:
                        bags.add(tuple(sorted(got)))
                rows.append([list(b) for b in sorted(bags)])
            yield pd.Series(rows)

    return F.pandas_udf(work, "array<array<int>>")


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def fit(bags: list[list[list[int]]], toxic: np.ndarray, weight: np.ndarray, n_features: int, rounds: int = 500) -> tuple[np.ndarray, float, float]:
    """Maximum likelihood of the noisy-or by Adam over all bags: weights, bias, leak.

    A doc's log probability of being clean is the sum of -softplus(z) over its sentences and
    its leak. weight: what a doc counts for. Ridge on the weights keeps them finite.
    """
    doc = np.array([d for d, b in enumerate(bags) for _ in b], np.int64)
    sizes = np.array([len(s) for b in bags for s in b], np.int64)
    feature = np.array([f for b in bags for s in b for f in s], np.int64)
    sentence = np.repeat(np.arange(len(sizes)), sizes)
    theta = np.zeros(n_features + 2)
    theta[-2:] = -1.0, -4.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    ridge = 2e-5 * np.concatenate([np.ones(n_features), [0, 0]])
    total = max(weight.sum(), 1.0)
    for t in range(1, rounds + 1):
        z = theta[-2] + np.bincount(sentence, theta[feature], len(sizes))
        log_clean = -np.bincount(doc, _softplus(z), len(bags)) - _softplus(theta[-1])
        clean = np.exp(log_clean)
        # d loss / d log_clean, per doc
        push = weight * np.where(toxic == 1, clean / np.maximum(1 - clean, 1e-9), -1.0)
        to_z = -push[doc] / (1 + np.exp(-z))
        gradient = np.concatenate(
            [
                np.bincount(feature, to_z[sentence], n_features),
                [to_z.sum(), -push.sum() / (1 + np.exp(-theta[-1]))],
            ]
        )
        gradient = gradient / total + ridge * theta
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        theta -= 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    return theta[:-2], float(theta[-2]), float(theta[-1])


def train(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = 8000,
    most_features: int = 4096,
    least_lift: float = 3.0,
    least_texts: int = 3,
    least_z: float = 5.0,
) -> Model:
    """Learn from the labelled documents that are not held out.

    sample: about how many texts per class are learned from, by a hash of their id; all, if
    there are fewer. most_features, least_lift, least_texts, least_z: features that are kept, how many times
    commoner they are among toxic texts, in how many of these they are, and how many standard
    errors apart the two shares lie. The sample's ids
    and what is collected for the fit are bounded by these. Labels that are null are left
    out; a doc with several labels counts as toxic if one says so; of several texts under one id, the one with the
    least hash is learned from. Without toxic or without
    clean labels the model has no features and a leak near the share of toxic texts.
    """
    marked = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    marked = marked.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    totals = dict(map(tuple, marked.groupBy("toxic").count().collect()))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)
    n = F.when(F.col("toxic") == 1, F.lit(totals.get(1, 0))).otherwise(F.lit(totals.get(0, 0)))
    chosen = marked.where(draw * n < sample)
    # about `sample` ids a class: a bounded table
    # one text of each id, so that what is collected is bounded too
    texts = stage(
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.min_by("text", F.xxhash64("text")).alias("text")),
        "labelled",
    )
    count = {c: n for c, n in texts.groupBy("toxic").count().collect()}
    n1, n0 = count.get(1, 0), count.get(0, 0)
    share = (n1 + 0.5) / (n1 + n0 + 50.0)
    if not n1 or not n0:
        return Model({}, 0.0, float(np.log(share / (1 - share))))
    of_text = F.pandas_udf(_text_features, "array<string>")
    seen = (
        texts.select("toxic", F.explode(of_text("text")).alias("f"))
        .groupBy("f")
        .agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    )
    p1, p0 = F.col("a") / n1, (F.col("b") + 0.5) / n0
    both = (F.col("a") + F.col("b")) / (n1 + n0)
    strength = (F.col("a") / n1 - F.col("b") / n0) / F.sqrt((both * (1 - both) + 1e-9) * (1 / n1 + 1 / n0))
    names = [
        r.f
        for r in seen.where((F.col("a") >= least_texts) & (p1 >= least_lift * p0) & (strength >= least_z))
        .orderBy(strength.desc(), "f")
        .limit(most_features)
        .collect()
    ]
    index = {f: i for i, f in enumerate(names)}
    rows = texts.select("doc_id", "toxic", _bags(index)("text").alias("bags")).toPandas()
    rows = rows.sort_values("doc_id", kind="stable")
    toxic = rows.toxic.to_numpy()
    # a clean text stands for as many as were not sampled
    weight = np.where(toxic == 1, totals.get(1, n1) / n1, totals.get(0, n0) / n0).astype(float)
    weights, bias, leak = fit(list(rows.bags), toxic, weight, len(names))
    return Model(dict(zip(names, map(float, weights))), bias, leak)


class _TokenWeights(dict):
    """The learned features of a token; as a cache it is bounded."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, token: str) -> tuple[str, ...]:
        value = tuple(f for f in features(token) if f in self.weights)
        if len(self) < 300_000:
            self[token] = value
        return value


def sentences(text: str, known: _TokenWeights, bias: float) -> list[tuple[int, int, float, frozenset[str]]]:
    """(start, end, log-odds, learned features) of each sentence that holds a learned feature."""
    odds: dict[frozenset[str], float] = {}
    out = []
    for m in SENTENCE.finditer(text):
        got = frozenset(f for t in m[0].split() for f in known[t])
        if got:
            if got not in odds:
                odds[got] = bias + math.fsum(known.weights[f] for f in got)
            out.append((m.start(), m.end(), odds[got], got))
    return out


FOUND = "score double, offending array<struct<start:int,end:int,score:double>>"


def scorer(model: Model, least: float = 0.5):
    """A column function: text to its score and the sentences that score `least` or more."""

    def work(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = _TokenWeights(model.weights)
        leak = float(_softplus(np.float64(model.leak)))
        for some in texts:
            scores, spans = [], []
            for text in some:
                found = sentences(text or "", known, model.bias)
                different = {got: z for _, _, z, got in found}
                scores.append(float(-np.expm1(-leak - math.fsum(_softplus(np.array(list(different.values())))))))
                spans.append([{"start": a, "end": b, "score": float(p)} for a, b, z, _ in found if (p := 1 / (1 + np.exp(-z))) >= least])
            yield pd.DataFrame({"score": scores, "offending": spans})

    return F.pandas_udf(work, FOUND)


def score(docs: DataFrame, model: Model, least_score: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted and the offending sentences of each document.

    Nothing but the text enters a score: one minus the product, over the leak and the text's different
    instances, of their chances to be clean. An instance is the set of learned features of a sentence, so
    a sentence that is repeated counts once, as in training. A null or empty text gets the leak alone. Spans are
    in code points. A null doc_id is not held out. Other columns are ignored.
    """
    return docs.select("doc_id", scorer(model)("text").alias("r")).select(
        "doc_id",
        held_out().alias("held_out"),
        "r.score",
        (F.col("r.score") >= least_score).cast("int").alias("predicted"),
        "r.offending",
    )


def drop_toxic(docs: DataFrame, model: Model, least_score: float = 0.7) -> DataFrame:
    """documents without those that score `least_score` or more; all columns stay."""
    return docs.where(scorer(model)(docs["text"])["score"] < least_score)
