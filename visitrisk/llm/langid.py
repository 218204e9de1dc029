"""Language identification by a blended-spectrum string kernel with Nyström landmarks and kernel ridge regression.

**Kernel.** A text is the set of its character 1- to 3-grams: lower-cased, each run of characters that are no
letters is one space, with a space at both ends; the space alone is no n-gram. The kernel of two texts is the number of common n-grams over
the geometric mean of their numbers (presence, not frequency).

**Fit.** From rows with a language: a bounded sample, of about the same size for each language and chosen by
hash of the id, gives the training texts, and a part of them the landmarks. Texts become the Nyström
features of the landmark kernel; one ridge regression per language is solved against the rest. Both bounds
are parameters.

**Scoring.** Kernel and regression are linear in the presence vector, so a batch is one product of its presence
matrix with the landmarks' n-grams and one with the coefficients.

Defined cases: NULL texts and texts without a letter are ``und`` with score 0; a text that has no n-gram of
the landmarks gets the language with the largest intercept and ``known`` false; equal decision values take
the first language in order; rows without language or with a NULL id teach nothing; without any labelled
row every text is ``und``; input columns named like an output are replaced by it.

**Rejection.** A text of a language that was never learned scores low everywhere. :func:`limit` is read from a
histogram of all labelled texts' scores; without any, it is 0. Texts of equal score pass or fail together.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitrisk.llm.common import columns, extended, extended_batch, stored

UNDETERMINED = "und"
#: Expected number of training texts and of landmarks, over all languages.
TRAINING_TEXTS = 3000
LANDMARKS = 240
#: Per training text.
RIDGE = 1e-4
#: Texts scored by one matrix product.
BATCH = 64

#: Share of the labelled texts that a limit on the score must let pass, and the steps of that limit.
KEPT_LABELLED = 0.9995
STEPS = 1000

RESULT = columns("lang_pred string, score double, known boolean")

_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    """Which code points are letters; made once per worker."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def ngrams(text: str | None) -> np.ndarray:
    """The set of 1- to 3-grams, each as one sorted unsigned number; empty without a letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le"), np.uint32)
    letters = _letter_table()[points]
    if not letters.any():
        return np.zeros(0, np.uint64)
    kept = letters.copy()
    kept[1:] |= letters[:-1]  # the first of a run of other characters stands for the run
    line = np.where(letters, points, 32)[kept].astype(np.uint64)
    line = line[int(line[0] == 32) : len(line) - int(line[-1] == 32)]
    line = np.concatenate([[32], line, [32, 0]]).astype(np.uint64)
    three = np.unique((line[:-2] << np.uint64(42)) | (line[1:-1] << np.uint64(21)) | line[2:])
    two = np.unique(three >> np.uint64(21))
    one = np.unique(two >> np.uint64(21))
    one = one[one != 32]
    # 0 marks an n-gram's unused places; the 3-gram with the end mark is no n-gram.
    three = three[(three & np.uint64(0x1FFFFF)) > 0]
    return np.concatenate([one, two, three])


@dataclass
class Model:
    """``grams``: sorted n-grams of the landmarks; ``presence``: n-gram by landmark; ``weights``: landmark by language."""

    languages: list[str]
    grams: np.ndarray
    presence: np.ndarray
    weights: np.ndarray
    intercepts: np.ndarray

    def decisions(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Decision values, whether a text has a letter, and whether it shares an n-gram with a landmark."""
        kernel, sizes = kernels(texts, self.grams, self.presence)
        return kernel @ self.weights + self.intercepts, sizes > 0, kernel.any(axis=1)


def kernels(texts: list[str | None], grams: np.ndarray, presence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kernel of each text with each landmark, and the texts' numbers of n-grams."""
    out, sizes = np.zeros((len(texts), presence.shape[1]), np.float32), np.zeros(len(texts))
    for at in range(0, len(texts), BATCH):
        have = np.zeros((min(BATCH, len(texts) - at), len(grams)), np.float32)
        for k in range(len(have)):
            own = ngrams(texts[at + k])
            place = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
            have[k, place[grams[place] == own]] = 1
            sizes[at + k] = len(own)
        out[at : at + BATCH] = have @ presence
    return out / np.sqrt(np.maximum(sizes, 1))[:, None].astype(np.float32), sizes


def _sampled(labelled: DataFrame, total: int, seed: int) -> DataFrame:
    """About ``total`` rows, spread over the languages, by hash of the id; rows repeated in full count once.

    A sample of a sample needs another seed, or else all of it would be drawn.
    """
    counts = {r["lang"]: max(1, r["n"]) for r in labelled.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n")).toLocalIterator()}
    if not counts:
        return labelled
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, total / len(counts) / n)])[F.col("lang")]
    draw = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1_000_000)) / 1_000_000
    return labelled.filter(draw < share).dropDuplicates()


def fit(labelled: DataFrame, training_texts: int = TRAINING_TEXTS, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """A model from ``labelled`` (doc_id, text, lang); None where no row has id, language and letters.

    What reaches the driver is bounded: the landmarks' n-grams, then one kernel row per training text.
    """
    rows = labelled.filter("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    sample = stored(_sampled(rows, training_texts, 1), "languages")
    chosen = _sampled(sample, landmarks, 2)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([pa.array([ngrams(t).view(np.int64) for t in batch.column("text").to_pylist()], pa.list_(pa.int64()))], names=["grams"])

    marks = [np.array(r["grams"], np.int64).view(np.uint64) for r in chosen.mapInArrow(cut, "grams array<long>").toLocalIterator() if r["grams"]]
    if not marks:
        return None
    grams = np.unique(np.concatenate(marks))
    presence = np.zeros((len(grams), len(marks)), np.float32)
    for k, own in enumerate(marks):
        presence[np.searchsorted(grams, own), k] = 1 / np.sqrt(len(own))
    sent = sample.sparkSession.sparkContext.broadcast((grams, presence))

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kernel, sizes = kernels(batch.column("text").to_pylist(), *sent.value)
            part = batch.filter(pa.array(sizes > 0))
            yield pa.record_batch([part.column("lang"), pa.array(list(kernel[sizes > 0]), pa.list_(pa.float32()))], names=["lang", "kernel"])

    taught = sample.mapInArrow(project, "lang string, kernel array<float>").toPandas()
    sent.destroy()
    languages = sorted(taught["lang"].unique())
    values, vectors = np.linalg.eigh((presence.T @ presence).astype(np.float64))
    keep = values > 1e-6 * values.max()
    nystroem = vectors[:, keep] / np.sqrt(values[keep])
    features = np.column_stack([np.stack(taught["kernel"].to_numpy()).astype(np.float64) @ nystroem, np.ones(len(taught))])
    answers = np.where(taught["lang"].to_numpy()[:, None] == np.array(languages, object)[None, :], 1.0, -1.0)
    # Each language weighs the same, whatever its share of the sample.
    weight = (1 / taught.groupby("lang")["lang"].transform("count")).to_numpy() * len(taught) / len(languages)
    square = features.T @ (features * weight[:, None]) + ridge * len(taught) * np.eye(features.shape[1])
    solved = np.linalg.solve(square, features.T @ (answers * weight[:, None]))
    return Model(languages, grams, presence, (nystroem @ solved[:-1]).astype(np.float32), solved[-1].astype(np.float32))


def predict(docs: DataFrame, model: Model | None, texts: bool = True) -> DataFrame:
    """``docs`` (text, any more) with RESULT. ``score`` maps the decision value from -1..1 to 0..1. ``texts=False`` drops the text."""
    sent = docs.sparkSession.sparkContext.broadcast(model and astuple(model))

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value and Model(*sent.value)
        for batch in batches:
            lang, score, known = [], [], []
            for at in range(0, batch.num_rows, BATCH):
                part = batch.column("text").slice(at, BATCH).to_pylist()
                if own is None:
                    lang, score, known = lang + [UNDETERMINED] * len(part), score + [0.0] * len(part), known + [False] * len(part)
                    continue
                values, letters, shared = own.decisions(part)
                best = values.argmax(axis=1)
                lang += [own.languages[b] if ok else UNDETERMINED for b, ok in zip(best, letters, strict=True)]
                score += np.where(letters, np.clip((values.max(axis=1) + 1) / 2, 0, 1), 0).astype(float).tolist()
                known += (letters & shared).tolist()
            batch = batch if texts else batch.drop_columns(["text"])
            yield extended_batch(batch, lang_pred=pa.array(lang, pa.string()), score=pa.array(score, pa.float64()), known=pa.array(known, pa.bool_()))

    kept = T.StructType([f for f in docs.schema if texts or f.name != "text"])
    return docs.mapInArrow(add, extended(kept, *RESULT))


def step(score: Column) -> Column:
    return F.floor(score * STEPS).cast("long")


def limit(labelled: DataFrame, model: Model | None, kept: float = KEPT_LABELLED) -> int:
    """The highest step of the score that at least a share ``kept`` of the known texts in ``labelled`` (text, lang) reaches."""
    rows = predict(labelled.filter("lang IS NOT NULL").select(F.col("text").cast("string").alias("text")), model, texts=False)
    found = np.zeros(STEPS + 1, np.int64)
    for r in rows.filter("known").groupBy(step(F.col("score")).alias("step")).count().collect():
        found[r["step"]] = r["count"]
    below = np.cumsum(found) - found
    return int(np.flatnonzero(below <= (1 - kept) * found.sum()).max()) if found.any() else 0
