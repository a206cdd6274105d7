"""Quality classifier: supervised subword embeddings.

A text's features are its words and its character n-grams (code points, within
words, with the white space around as boundary marks), hashed into a table of
learned vectors; a word that repeats the word before it has a mark, "again",
beside each of its features.  The vectors are averaged over the text and go through a
softmax.  Training is plain stochastic gradient descent in numpy.

Training takes at most ``per_class`` labelled documents of each label (those
first in the order of a hash of their id), as sparse bags of hashed features,
so at most 2 * per_class * buckets * 8 bytes reach the driver; the loss weighs
the two classes by their true shares.  Scoring covers the whole text of every
document.  After training, the average and the linear layer are folded into one
weight per bucket (average of vectors times matrix = average of products), so
the model that tasks get is a fixed ``buckets`` x 4 bytes.

Defined cases: a null or empty text has no feature but the constant one that
every text has, and gets a score from it; labels other than 0 and 1 and null
labels are ignored, several labels of one document count as their maximum;
with no labelled document every score is 0.5, with one class only that class's
share (0 or 1); repeated rows are scored each; very long texts are scored whole (a text is the
least that is held at a time) and learnt from whole; an empty table gives an empty
result; an input column named like an output column is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import chunks, id_and_text, others
from strata.llm.wordhash import split_words

_MUL = (np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35), np.uint32(0x27D4EB2F), np.uint32(0x165667B1), np.uint32(0x9E3779B1))
#: Marks a word that repeats the word before it.
_AGAIN = np.uint64(0x2545F4914F6CDD1D)


@dataclass(frozen=True)
class Features:
    buckets: int = 1 << 16
    ngrams: tuple[int, ...] = (3, 4)


@dataclass(frozen=True)
class QualityModel:
    features: Features
    weight: np.ndarray      # log-odds of label 1, per bucket
    bias: float


def hashed_features(texts: list[bytes], f: Features) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of a chunk, and the text that each is of."""
    mask = f.buckets - 1
    w = split_words(texts)
    word, owner = w.hash, w.doc()
    again = np.flatnonzero((word[1:] == word[:-1]) & (owner[1:] == owner[:-1])) + 1
    at, doc, marked = [(word & np.uint64(mask)).astype(np.int32)], [owner], [owner[again]]
    repeat = np.zeros(len(word) + 1, bool)
    repeat[again] = True
    decoded = [t.decode("utf-8", "replace") for t in texts]
    code = np.frombuffer(" ".join(["", *decoded, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    white = (code == 32) | ((code >= 9) & (code <= 13))
    code = np.where(white, np.uint32(32), code)
    inside = np.cumsum(white, dtype=np.int32)  # white characters up to here
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in decoded])
    begun = np.cumsum(~white & np.concatenate([[True], white[:-1]]))
    repeat = repeat[np.where(white, begun, begun - 1)]      # by the word that an n-gram from here on is of
    for n in f.ngrams:
        m = len(code) - n + 1
        if m <= 0:
            continue
        h = np.full(m, n, np.uint32)
        for j in range(n):
            h = (h ^ (code[j:j + m] * _MUL[j % 5])) * np.uint32(0xCC9E2D51)
            h ^= h >> np.uint32(15)
        # no white space but as the first or the last character
        ok = np.flatnonzero(inside[n - 2:n - 2 + m] == inside[:m]) if n > 2 else np.arange(m)
        at.append((h[ok] & np.uint32(mask)).astype(np.int32))
        doc.append(owner[np.minimum(ok, len(owner) - 1)])
        marked.append(owner[ok[repeat[ok]]])
    doc += marked
    at.append(np.full(sum(map(len, marked)), _AGAIN & np.uint64(mask), np.int32))
    return np.concatenate(at), np.concatenate(doc)


def _bags(f: Features):
    def run(batches):
        for pdf in batches:
            for rows, texts in chunks(list(range(len(pdf))), pdf["text"].tolist()):
                at, doc = hashed_features(texts, f)
                pair, count = np.unique(doc * f.buckets + at, return_counts=True)
                first = np.searchsorted(pair, np.arange(len(texts) + 1) * f.buckets)
                yield pd.DataFrame({
                    "id": pdf["id"].iloc[rows].to_numpy(), "label": pdf["label"].iloc[rows].to_numpy(),
                    "at": [(pair[a:b] % f.buckets).astype("<i4").tobytes() for a, b in zip(first, first[1:])],
                    "n": [count[a:b].astype("<f4").tobytes() for a, b in zip(first, first[1:])]})
    return run


def _train(bags: list, share: dict[int, float], f: Features, dim: int, epochs: int, rate: float, seed: int):
    """Vectors, matrix and bias by stochastic gradient descent, one document a step; the rate falls linearly to zero."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (f.buckets, dim)).astype(np.float32)
    matrix, bias = np.zeros((dim, 2), np.float32), np.zeros(2, np.float32)
    taken = {c: sum(b[0] == c for b in bags) / len(bags) for c in (0, 1)}
    step, steps = 0, epochs * len(bags)
    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            label, at, n = bags[i]
            lr = rate * (1 - step / steps) * share[label] / taken[label]
            step += 1
            total = n.sum()
            n = n / total if total else n
            hidden = n @ vectors[at]
            logit = hidden @ matrix + bias
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[label] -= 1
            back = matrix @ p
            matrix -= lr * np.outer(hidden, p)
            bias -= lr * 0.1 * p
            vectors[at] -= lr * np.outer(n, back)
    return vectors, matrix, bias


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", features: Features = Features(), per_class: int = 1200, dim: int = 16,
                epochs: int = 5, rate: float = 2.0, seed: int = 7) -> QualityModel:
    """Learn from the documents that ``labels`` marks 0 or 1 (give only rows that may be learnt from)."""
    known = (labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).cast("long").alias("id"))
             .agg(F.max(label_col).cast("int").alias("label")).where("id is not null"))
    n = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(n.values())
    if len(n) < 2:
        share = float(next(iter(n), 0.5))
        return QualityModel(features, np.zeros(features.buckets, np.float32), _logit(share))
    parts = [known.where(F.col("label") == c).orderBy(F.xxhash64("id"), "id").limit(per_class) for c in (0, 1)]
    sample = parts[0].unionByName(parts[1])
    texts = (id_and_text(docs, id_col, text_col).join(F.broadcast(sample), "id")  # at most 2 * per_class ids
             .groupBy("id", "label").agg(F.min("text").alias("text")))
    got = texts.mapInPandas(_bags(features), "id long, label int, at binary, n binary").collect()
    bags = [(r["label"], np.frombuffer(r["at"], "<i4"), np.frombuffer(r["n"], "<f4")) for r in sorted(got, key=lambda r: r["id"])]
    if len({b[0] for b in bags}) < 2:
        return QualityModel(features, np.zeros(features.buckets, np.float32), _logit(float(bags[0][0]) if bags else 0.5))
    vectors, matrix, bias = _train(bags, {c: n[c] / total for c in n}, features, dim, epochs, rate, seed)
    return QualityModel(features, vectors @ (matrix[:, 1] - matrix[:, 0]), float(bias[1] - bias[0]))


def _logit(p: float) -> float:
    return float(np.clip(np.log(max(p, 1e-300) / max(1 - p, 1e-300)), -700, 700))


def quality_score(text: Column, model: QualityModel) -> Column:
    """Probability of label 1 for a text column."""
    @F.pandas_udf("double")
    def score(column: pd.Series) -> pd.Series:
        out = np.empty(len(column))
        for rows, texts in chunks(list(range(len(column))), column.tolist()):
            at, doc = hashed_features(texts, model.features)
            n = np.bincount(doc, minlength=len(texts))
            s = np.bincount(doc, model.weight[at], len(texts)) / np.maximum(n, 1) + model.bias
            out[rows] = 1 / (1 + np.exp(-np.clip(s, -700, 700)))
        return pd.Series(out)
    return score(F.coalesce(text, F.lit("")))


def with_quality(docs: DataFrame, model: QualityModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the score of each text."""
    return docs.select(*(F.col(f"`{c}`") for c in others(docs, [score_col])), quality_score(F.col(text_col), model).alias(score_col))
