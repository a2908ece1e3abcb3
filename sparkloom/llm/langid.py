"""Language identification with string kernels.

The kernel of two texts is the blended spectrum of n-gram presence: the number
of character n-grams of orders 1 to 3 that both hold, over the root of the
product of their own numbers. Landmarks give the Nyström features of a text,
its kernels with the landmarks times the inverse root of the landmarks' own
kernel matrix, on which one-versus-rest kernel ridge regression is solved.

Training uses a bounded sample: about ``per_class`` texts per language, chosen
by hash, of the ``classes`` languages with most texts; ``landmarks`` of them are landmarks; the bounds are parameters.
Everything else covers all rows and whole texts. Since a kernel with a landmark
is a sum over the n-grams of a text, landmarks, Nyström map and ridge weights
fold into one matrix, and a batch of texts is scored as a product of its
presence matrix with that matrix. N-grams are packed exactly into 63 bits.

Defined cases: a text that is null or has no letter is ``und`` with score 0;
ties go to the language whose name sorts first; with no labelled rows every
text is ``und``; rows that repeat id, text and language are learnt from once and scored
each; rows without an id are scored, but never learnt from; very long texts are
scored whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDERS = 3
BATCH = 64
#: Most languages that are learnt.
CLASSES = 200


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that nothing is learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def grams(text: str) -> np.ndarray:
    """Distinct n-grams of a lower-cased text, runs of what is no letter as one space; sorted packed longs."""
    kept = " ".join("".join([c if c.isalpha() else " " for c in text.lower()]).split())
    codes = np.frombuffer(f" {kept} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    found, packed = [], codes
    for _ in range(ORDERS):
        found.append(packed)
        if len(packed) < 2:
            break
        packed = (packed[:-1] << 21) | codes[len(codes) - len(packed) + 1 :]
    return np.unique(np.concatenate(found))


@dataclass
class Model:
    langs: list[str]
    vocabulary: np.ndarray
    weights: np.ndarray

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        """Ridge outputs, rows by texts' n-grams, columns by language."""
        presence = np.zeros((len(texts), len(self.vocabulary)), np.float32)
        norms = np.ones(len(texts))
        for i, g in enumerate(texts):
            at = np.searchsorted(self.vocabulary, g)
            at[at == len(self.vocabulary)] = 0
            presence[i, at[self.vocabulary[at] == g]] = 1
            norms[i] = max(1, len(g))
        return presence @ self.weights / np.sqrt(norms)[:, None]


def train(texts: list[str], langs: list[str], landmarks: int = 256, ridge: float = 0.1) -> Model | None:
    """Fit on labelled texts in the order given; every ``len(texts) / landmarks``-th is a landmark."""
    sets = [grams(t) for t in texts]
    names = sorted(set(langs))
    if not names:
        return None
    chosen = sorted(set(np.linspace(0, len(sets) - 1, min(landmarks, len(sets))).astype(int).tolist()))
    vocabulary = np.unique(np.concatenate([sets[i] for i in chosen]))
    marks = np.zeros((len(vocabulary), len(chosen)), np.float32)
    for k, i in enumerate(chosen):
        marks[np.searchsorted(vocabulary, sets[i]), k] = 1 / np.sqrt(max(1, len(sets[i])))
    kernel = Model([], vocabulary, marks)
    k_rows = np.concatenate([kernel.scores(sets[i : i + BATCH]) for i in range(0, len(sets), BATCH)]).astype(np.float64)
    value, vector = np.linalg.eigh(k_rows[chosen])
    keep = value > 1e-6 * value.max()
    nystrom = vector[:, keep] / np.sqrt(value[keep])
    z = k_rows @ nystrom
    targets = np.array([[1.0 if g == n else 0.0 for n in names] for g in langs])
    weight = 1 / np.maximum(1, targets.sum(0))[targets.argmax(1)]
    gram = z.T @ (z * weight[:, None]) + ridge / len(sets) * np.eye(z.shape[1])
    solved = np.linalg.solve(gram, z.T @ (targets * weight[:, None]))
    return Model(names, vocabulary, (marks.astype(np.float64) @ nystrom @ solved).astype(np.float32))


def sample(docs: DataFrame, per_class: int, id_col: str, text_col: str, lang_col: str, classes: int = CLASSES) -> tuple[list[str], list[str]]:
    """About ``per_class`` labelled texts of each of the ``classes`` languages with most of them, by the hash of id and text."""
    lang, text = F.col(lang_col).alias("lang"), F.col(text_col).alias("text")
    usable = docs.where(F.col(id_col).isNotNull() & ~held_out(id_col) & F.col(lang_col).isNotNull() & F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))).select(F.col(id_col).alias("id"), text, lang)
    shares = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(classes)
    shares = shares.select("lang", F.ceil(F.lit(per_class * 1_000_000) / F.col("n")).alias("share"))
    dice = F.pmod(F.xxhash64("id", "text", F.lit("language sample")), F.lit(1_000_000))
    rows = usable.withColumn("dice", dice).join(F.broadcast(shares), "lang").where("dice < share").select("dice", "id", "text", "lang").distinct().collect()
    rows.sort(key=lambda r: (r["dice"], r["id"], r["text"], r["lang"]))
    return [r["text"] for r in rows], [r["lang"] for r in rows]


def classify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            names, scores = [], []
            for i in range(0, len(b), BATCH):
                texts = b.column(2)[i : i + BATCH].to_pylist()
                real = [model is not None and t is not None and any(map(str.isalpha, t)) for t in texts]
                found = iter(model.scores([grams(t) for t, r in zip(texts, real, strict=True) if r]) if any(real) else [])
                for r in real:
                    row = np.clip(next(found), 0, None) if r else None
                    best = int(row.argmax()) if r else 0
                    names.append(model.langs[best] if r else "und")
                    scores.append(float(min(1.0, row[best] / max(row.sum(), 1e-9))) if r else 0.0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, per_class: int = 300, landmarks: int = 256, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Train on the sample and classify every row."""
    return classify(docs, train(*sample(docs, per_class, id_col, text_col, lang_col), landmarks), id_col, text_col)
