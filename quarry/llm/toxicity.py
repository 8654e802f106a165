"""Toxicity scores by non-negative positive-unlabelled learning (numpy, trained on the driver).

Positives are documents labelled toxic; the unlabelled set is drawn from all training documents,
whatever their label, since a missing or zero label does not prove a document clean. With p the class
prior, R+ and Ru- the mean losses, the risk is

    p * R+(1) + max(0, Ru-(0) - p * R+(0))

and a step that makes the second term negative is taken against it instead (non-negative
correction). The prior is the labelled training rows' share of toxic ones. The model is a logistic
score over the distinct words of a text and their beginnings (inflected insults share them), hashed
to ``2**bits`` features; words are runs of letters, lower-cased. Only features whose share of documents differs beyond chance between the
positives and the unlabelled rows not known to be toxic enter the model, so a long text does not gather noise; the
lift is taken against the clean share, which the prior gives, so it holds at any share of toxic
documents, and no feature is too rare but for chance. Near copies in the training sample
count once there, so that one much-copied document is no evidence.

Training reads at most ``max_positive`` positives and ``max_unlabelled`` other rows, those with the
smallest hash of their id (documented bounds of a sample of labelled rows); scoring reads every whole text.

Defined results: null and empty texts score the model's bias; rows keep their multiplicity; null
ids are scored and never trained on; without any positive every score is 0; ids with several
labels count as toxic if one of them is; other columns are never read.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.hashing import slices

WORD = re.compile(r"[^\W\d_]+")
BITS = 20
PREFIXES = (4, 5, 6, 7, 8)
CACHED = 200_000


def features_of_word(word: str, bits: int) -> list[int]:
    """The word and its beginnings of PREFIXES characters, hashed."""
    parts = [word, *["^" + word[:n] for n in PREFIXES if len(word) >= n]]
    return [zlib.crc32(x.encode()) & ((1 << bits) - 1) for x in parts]


def features(text: str | None, bits: int, known: dict[str, tuple], only=None) -> set[int]:
    """Hashed features of a text's distinct words; ``only`` keeps those of a model. ``known`` caches the
    features of up to CACHED words."""
    out: set[int] = set()
    for word in set(WORD.findall((text or "").lower())):
        found = known.get(word)
        if found is None:
            if len(known) > CACHED:
                known.clear()
            found = tuple(f for f in features_of_word(word, bits) if only is None or f in only)
            known[word] = found
        if found:
            out.update(found)
    return out


def training_fold(id_col: str) -> Column:
    """Rows that may be learned from: crc32 of the id as text leaves 0 or 2 modulo 3."""
    return F.col(id_col).isNotNull() & (F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 != 1)


def without_copies(rows: list[np.ndarray], rare: np.ndarray) -> list[np.ndarray]:
    """One of the rows that share their four smallest rare words: copies would count as evidence."""
    seen, out = set(), []
    for row in rows:
        key = tuple(np.sort(row[rare[row]])[:4].tolist())
        if len(key) < 4 or key not in seen:
            seen.add(key)
            out.append(row)
    return out


def evident_words(positive: list[np.ndarray], others: list[np.ndarray], size: int, toxic: float,
                  least_count: int = 4, least_ratio: float = 5.0, least_z: float = 4.0) -> np.ndarray:
    """Words whose share of documents differs between toxic and clean ones beyond chance; a share
    ``toxic`` of ``others`` is toxic as well, and its words are taken off before the lift is measured."""
    n_p, n_u = max(1, len(positive)), max(1, len(others))
    in_p = np.bincount(np.concatenate([*positive, np.zeros(0, np.int64)]).astype(np.int64), minlength=size)
    in_u = np.bincount(np.concatenate([*others, np.zeros(0, np.int64)]).astype(np.int64), minlength=size)
    p, u = in_p / n_p, in_u / n_u
    clean = np.maximum(u - toxic * p, 0) / (1 - toxic)
    pooled = (in_p + in_u + 1) / (n_p + n_u + 2)
    z = (p - u) / np.sqrt(pooled * (1 - np.minimum(pooled, 0.999)) * (1 / n_p + 1 / n_u))
    more = (z >= least_z) & (in_p >= least_count) & (p >= least_ratio * clean)
    less = (z <= -least_z) & (in_u >= least_count) & (clean >= least_ratio * p)
    return np.flatnonzero(more | less)


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, bits: int = BITS,
          epochs: int = 600, rate: float = 0.05, decay: float = 1e-4, seed: int = 0,
          listed: np.ndarray | None = None) -> np.ndarray:
    """Weights of ``2**bits`` words, and the bias last. ``listed`` marks the unlabelled rows that are
    positives too; words are held against the others."""
    size = 1 << bits
    seen = np.bincount(np.concatenate([*unlabelled, np.zeros(0, np.int64)]).astype(np.int64), minlength=size)
    rare = seen <= 0.02 * len(unlabelled)
    listed = np.zeros(len(unlabelled), bool) if listed is None else listed
    others = without_copies([x for x, k in zip(unlabelled, listed, strict=True) if not k], rare)
    positive, unlabelled = without_copies(positive, rare), without_copies(unlabelled, rare)
    held = listed.mean() if len(listed) else 0.0
    toxic = float(np.clip((prior - held) / max(1 - held, 1e-9), 0, 0.99))
    used = evident_words(positive, others, size, toxic)
    place = np.full(size, -1)
    place[used] = np.arange(len(used))

    def entries(rows):
        """(row, feature) of the ones, as the features of a large corpus would not fit as a matrix."""
        at = place[np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)]
        row = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
        return row[at >= 0], at[at >= 0]

    (p_row, p_at), (u_row, u_at) = entries(positive), entries(unlabelled)
    n_p, n_u = max(1, len(positive)), max(1, len(unlabelled))
    w, bias = np.random.default_rng(seed).normal(0, 1e-3, len(used)), -2.0
    m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    soft = lambda z: np.logaddexp(0, z).mean()  # noqa: E731  loss of score z under label 0
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for step in range(1, epochs + 1):
        p_z = np.bincount(p_row, w[p_at], n_p) + bias
        u_z = np.bincount(u_row, w[u_at], n_u) + bias
        p, u = sigmoid(p_z), sigmoid(u_z)
        # gradients of the losses by the score: p-1 for label 1, p for label 0
        if soft(u_z) - prior * soft(p_z) >= 0:
            of_p, of_u = -np.full(n_p, prior / n_p), u / n_u
        else:
            of_p, of_u = prior * p / n_p, -u / n_u
        by_word = np.bincount(p_at, of_p[p_row], len(w)) + np.bincount(u_at, of_u[u_row], len(w))
        slope = np.append(by_word + decay * w, of_p.sum() + of_u.sum())
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope ** 2
        move = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    out = np.zeros(size + 1)
    out[used], out[-1] = w, bias
    return out


def least_hashed(ids: DataFrame, order: Column, n: int) -> DataFrame:
    """The ``n`` distinct rows of ``ids`` (__id) first in ``order``, a 64-bit hash, then by id.

    Rows under a threshold of the hash that some 1.5 n rows should meet are kept first, and the threshold is
    doubled while fewer than ``n`` do: the final merge sees about 2 n rows, however many tasks there are, and the result is that of the
    plain order and limit.
    """
    share = 1.5 * n / max(1, ids.count())
    some = ids.distinct()
    while share < 1:
        trial = ids.filter(order < F.lit(int(share * 2**64) - 2**63)).distinct()
        if trial.count() >= n:
            some = trial
            break
        share *= 2
    return some.orderBy(order, "__id").limit(n)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", max_positive: int = 4000, max_unlabelled: int = 8000,
        bits: int = BITS) -> np.ndarray | None:
    known = labels.filter(training_fold(id_col)).groupBy(F.col(id_col).alias("__id")).agg(
        F.max(label_col).alias("__y"))
    share = known.agg(F.avg(F.col("__y").cast("double")).alias("p")).first()["p"]
    if not share:
        return None
    order = F.xxhash64(F.lit(7), F.col("__id"))
    chosen = least_hashed(known.filter("__y = 1").select("__id"), order, max_positive).withColumn("__kind", F.lit(1))
    others = least_hashed(docs.filter(training_fold(id_col)).select(F.col(id_col).alias("__id")), order, max_unlabelled)
    listed = F.when(F.col("__y") == 1, 2).otherwise(0)  # unlabelled, but a positive as well
    others = others.join(known.filter("__y = 1"), "__id", "left").withColumn("__kind", listed)
    wanted = chosen.select("__id", "__kind").unionByName(others.select("__id", "__kind"))
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text")) \
        .join(F.broadcast(wanted), "__id").dropDuplicates(["__id", "__kind"])  # bounded by the two limits
    rows = rows.select("__kind", "__text")

    def run(batches):
        known: dict[str, tuple] = {}
        for whole in batches:
            for batch in slices(whole, "__text"):
                found = [list(features(t, bits, known)) for t in batch["__text"].to_pylist()]
                yield pa.RecordBatch.from_pydict({
                    "kind": batch["__kind"], "words": pa.array(found, pa.list_(pa.int32()))})

    got = rows.mapInArrow(run, "kind int, words array<int>").toArrow()
    if not got.num_rows:
        return None
    kind, lists = got["kind"].to_numpy(), got["words"].combine_chunks()
    ends = np.cumsum(pa.compute.list_value_length(lists).to_numpy())
    words = np.split(lists.flatten().to_numpy(), ends[:-1])
    positive = [w for w, k in zip(words, kind, strict=True) if k == 1]
    if not positive:
        return None
    unlabelled = [w for w, k in zip(words, kind, strict=True) if k != 1]
    return train(positive, unlabelled, float(share), bits, listed=kind[kind != 1] == 2)


def scorer(model: np.ndarray):
    """Texts to log-odds. The word cache is the worker's own, it does not travel."""
    weights = {int(i): float(model[i]) for i in np.flatnonzero(model[:-1])}
    bits, bias = (len(model) - 1).bit_length() - 1, float(model[-1])

    def rated(texts: list[str | None], known: dict[str, tuple] = {}) -> np.ndarray:  # noqa: B006
        return np.array([bias + sum(weights[i] for i in sorted(features(t, bits, known, weights)))
                         for t in texts], dtype=float)
    return rated


def score(docs: DataFrame, model: np.ndarray | None, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.7) -> DataFrame:
    """id, score, predicted of every row; the model (one number a feature, a fixed size) travels in the task."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    if model is None:
        return base.select("id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    rated = scorer(model)

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                z = np.clip(rated(batch["text"].to_pylist()), -500, 500)
                yield pa.RecordBatch.from_pydict({
                    "id": batch["id"], "score": pa.array(1 / (1 + np.exp(-z)), pa.float64())})

    kind = base.schema["id"].dataType.simpleString()
    return base.mapInArrow(run, f"id {kind}, score double").withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               threshold: float = 0.7, **options) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns unchanged, in one pass."""
    model = fit(docs, labels, id_col, text_col, **options)
    if model is None:
        return docs
    return keep_scored(docs, model, text_col, threshold)


def keep_scored(docs: DataFrame, model: np.ndarray, text_col: str, threshold: float) -> DataFrame:
    rated = scorer(model)
    least = float(np.log(threshold / (1 - threshold)))

    def run(batches):
        for whole in batches:
            for batch in slices(whole, text_col):
                yield batch.filter(pa.array(rated(batch[text_col].to_pylist()) < least, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
