"""Toxicity by non-negative positive-unlabelled learning.

The classifier is linear over the presence of hashed features of a whole text:
its lower-cased words, the words' inner n-grams of five characters, so that
inflected forms of one stem share features, and the stems that come in two, three or
five forms, since one form may be chance. It is fitted in numpy on confirmed
toxic texts (P) and unlabelled texts (U) with the non-negative risk estimator
``pi R_P^+ + max(0, R_U^- - pi R_P^-)``: where the corrected negative risk of a
step falls below zero, the step goes back along its gradient. The class prior pi is
measured over all labelled rows that may be learnt from.

Training texts are bounded samples by hash: about ``positives`` and
``unlabelled`` texts, parameters both. Scoring covers all rows and whole texts.

Defined cases: null and empty texts get the score of a text without features;
rows without a label, or with a null one, are unlabelled; with no confirmed
toxic row every score is 0; several labels of one id count as toxic if one
does; rows that repeat an id and text are learnt from once and scored each;
rows without an id are scored, but never learnt from; very long texts are scored
whole; features of equal evidence are taken by their number; an empty table gives
an empty result; extra columns pass through, and where one has the name of a result
column, that gets underscores in front.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.llm.langid import held_out
from sparkloom.llm.names import fresh
from sparkloom.scratch import cut as cut_table
from sparkloom.scratch import small_side

BITS = 18
GRAM = 5
#: Letters of a stem, how many forms of it are features of their own, and the factor that sets their hashes apart.
STEM, FORMS, FORM = 5, (2, 3, 5), 2654435761
LEAST_FEATURES = 100
MEMO = 200_000
WORDS = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> tuple[bytes, int]:
    """Hashed features of one word: itself, and its n-grams with the word's start marked; and the hash of its stem (0: too short for one)."""
    mark = f"^{word}"
    parts = [f"={word}", *(mark[i : i + GRAM] for i in range(len(mark) - GRAM + 1))]
    stem = _hash(f"#{word[:STEM]}") if len(word) >= STEM else 0
    return np.array([_hash(p) for p in parts], np.uint32).tobytes(), stem


def _hash(part: str) -> int:
    return zlib.crc32(part.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)


def features(text: str | None, memo: dict[str, tuple[bytes, int]]) -> np.ndarray:
    """Distinct features of a whole text."""
    found: list[bytes] = []
    stems: list[int] = []
    for word in set(WORDS.findall((text or "").lower())):
        own = memo.get(word)
        if own is None:
            if len(memo) >= MEMO:
                memo.clear()
            own = memo[word] = word_features(word)
        found.append(own[0])
        if own[1]:
            stems.append(own[1])
    stem, forms = np.unique(np.array(stems, np.uint32), return_counts=True)
    many = [(stem[forms >= k] * np.uint32(FORM) + np.uint32(k)) & np.uint32((1 << BITS) - 1) for k in FORMS]
    return np.unique(np.concatenate([np.frombuffer(b"".join(found), np.uint32), *many])).astype(np.int64)


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def score(self, text: str | None, memo: dict[str, tuple[bytes, int]]) -> float:
        x = features(text, memo)
        return float(1 / (1 + np.exp(-np.clip(self.weights[x].sum() + self.bias, -50, 50))))


def train(positive: list[str], unlabelled: list[str], prior: float, epochs: int = 20, batch: int = 128, rate: float = 0.3, decay: float = 1e-4, significance: float = 5.0, threshold: float = 0.3, seed: int = 7) -> Model | None:
    """Fit by AdaGrad on mini-batches of both samples."""
    if not positive:
        return None
    memo: dict[str, tuple[bytes, int]] = {}
    p, u = [features(t, memo) for t in positive], [features(t, memo) for t in unlabelled]
    prior = min(max(prior, 1e-3), 0.9)
    chosen = select(p, u, significance)
    place = np.full(1 << BITS, -1)
    place[chosen] = np.arange(len(chosen))
    p, u = ([place[x][place[x] >= 0] for x in side] for side in (p, u))
    w, g2, bias, b2 = np.zeros(len(chosen)), np.full(len(chosen), 1e-6), float(np.log(prior / (1 - prior))), 1e-2
    rng = np.random.default_rng(seed)
    steps = max(1, -(-max(len(u), len(p)) // batch))
    for _ in range(epochs):
        pos, unl = rng.permutation(len(p)), rng.permutation(len(u))
        for k in range(steps):
            ip = pos[np.arange(k * batch, (k + 1) * batch) % len(p)][: max(1, min(batch, len(p)))]
            iu = unl[k * batch : (k + 1) * batch]
            rows = [p[i] for i in ip] + [u[i] for i in iu]
            n = np.array([len(x) for x in rows])
            col = np.concatenate(rows)
            row = np.repeat(np.arange(len(rows)), n)
            out = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[col], len(rows)) + bias, -30, 30)))
            loss_n = -np.log(np.maximum(1 - out, 1e-12))
            part = np.zeros(len(rows))
            part[: len(ip)], part[len(ip) :] = 1 / len(ip), 1 / max(1, len(iu))
            toxic = np.arange(len(rows)) < len(ip)
            negative_risk = (loss_n * part)[~toxic].sum() - prior * (loss_n * part)[toxic].sum()
            if negative_risk >= 0:
                slope = np.where(toxic, prior * part * (out - 1) - prior * part * out, part * out)
            else:
                slope = np.where(toxic, prior * part * out, -part * out)
            grad = np.bincount(col, slope[row], len(chosen)) + decay * w
            g2 += grad * grad
            w -= rate * grad / np.sqrt(g2)
            b2 += slope.sum() ** 2
            bias -= rate * slope.sum() / np.sqrt(b2)
    weights = np.zeros(1 << BITS)
    weights[chosen] = w
    out_p, out_u = (np.array([w[x].sum() + bias for x in side]) for side in (p, u))
    return Model(weights, float(bias + np.log(threshold / (1 - threshold)) - cut(out_p, out_u, prior)))


def cut(out_p: np.ndarray, out_u: np.ndarray, prior: float) -> float:
    """The output from which texts are best called toxic, by the F1 that positive and unlabelled texts and the prior imply.

    Recall is the share of P above the cut; the share of all texts above it is that of U.
    """
    at = np.unique(out_p)
    recall = 1 - np.searchsorted(np.sort(out_p), at) / len(out_p)
    called = 1 - np.searchsorted(np.sort(out_u), at) / max(1, len(out_u))
    best = int(np.argmax(2 * prior * recall / (prior + np.maximum(called, prior * recall))))
    if called[best] > 0.5:  # nothing sets positives apart
        return float(at[-1] + 1)
    below = np.concatenate([out_p, out_u])
    below = below[below < at[best]]
    return float((at[best] + (below.max() if len(below) else at[best])) / 2)


def select(p: list[np.ndarray], u: list[np.ndarray], significance: float) -> np.ndarray:
    """Features whose share of the positive texts differs from their share of the unlabelled ones by so many standard errors.

    The sum over a text's features is not scaled by its length: a few toxic
    words in a long text must not be thinned out, so features that carry no
    evidence are left out of the sum.
    """
    in_p, in_u = (np.bincount(np.concatenate([*side, np.empty(0, np.int64)]), minlength=1 << BITS) for side in (p, u))
    in_p, in_u = (in_p + 1) / (len(p) + 2), (in_u + 1) / (len(u) + 2)  # a feature that few texts could show isn't absent for certain
    error = np.sqrt(in_p * (1 - in_p) / (len(p) + 2) + in_u * (1 - in_u) / (len(u) + 2))
    z = np.abs(in_p - in_u) / error
    # few positives leave little significance: then the strongest features with some of it
    return np.sort(np.argsort(-z, kind="stable")[: max(int((z > significance).sum()), min(LEAST_FEATURES, int((z > 2).sum())))])


def samples(docs: DataFrame, labels: DataFrame, positives: int, unlabelled: int, id_col: str, text_col: str, label_col: str) -> tuple[list[str], list[str], float]:
    """Confirmed toxic texts, unlabelled texts and the class prior, none of them from held-out rows."""
    marked = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("label_id")).agg(F.max(label_col).alias("toxic")).where(~held_out("label_id"))
    n, toxic = marked.agg(F.count(F.lit(1)), F.sum((F.col("toxic") == 1).cast("long"))).first()
    dice = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col), F.lit("toxicity sample")), F.lit(1_000_000))
    open_rows = docs.where(F.col(id_col).isNotNull() & ~held_out(id_col)).select(dice.alias("dice"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    within = lambda k, of: F.col("dice") < min(1_000_000, -(-k * 1_000_000 // max(1, of)))
    confirmed = small_side(cut_table(marked.where("toxic = 1").select(F.col("label_id").alias("id")), "confirmed"))
    flagged = open_rows.select("id").join(confirmed.withColumn("hit", F.lit(1)), "id", "left")
    total, hits = flagged.agg(F.count(F.lit(1)), F.coalesce(F.sum("hit"), F.lit(0))).first()
    p = open_rows.where(within(positives, hits)).join(confirmed, "id", "left_semi").distinct().collect()
    u = open_rows.where(within(unlabelled, total)).distinct().collect()
    order = lambda rows: [r["text"] for r in sorted(rows, key=lambda r: (r["dice"], r["id"], r["text"] or ""))]
    return order(p), order(u), (toxic or 0) / max(1, n)


def score(docs: DataFrame, model: Model | None, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``toxic_score`` and ``toxic_pred`` (by :func:`fresh`) added; extra columns pass through."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = [fresh(c, docs.columns) for c in ("toxic_score", "toxic_pred")]
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, memo = shared.value, {}
        for b in batches:
            s = np.array([0.0 if model is None else model.score(t.as_py(), memo) for t in b.column(place)])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))], names=names)

    names = [f"c{i}" for i in range(len(docs.columns) + 2)]  # dotted names don't reach Python
    kinds = [*(f.dataType for f in docs.schema.fields), T.DoubleType(), T.IntegerType()]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)])
    return docs.toDF(*names[:-2]).mapInArrow(run, schema).toDF(*docs.columns, *added)


def fit(docs: DataFrame, labels: DataFrame, positives: int = 3000, unlabelled: int = 9000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model | None:
    return train(*samples(docs, labels, positives, unlabelled, id_col, text_col, label_col))
