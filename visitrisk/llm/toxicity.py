"""Toxicity by multiple-instance learning: a document is toxic if any of its sentences is.

**Model.** Sentences end at ``.``, ``!``, ``?`` or a line break. A sentence's score is the logistic of an
intercept plus the weights of its distinct telling words, 0 without any; a document's score is the noisy-or of its sentences,
1 - prod(1 - p). Only document labels are known: the weights maximise the likelihood of those labels, so
the gradient of a toxic document goes to the sentences that explain it. The same sentence scores then say
where the offence is. Labels err whatever a text's length, so in the fit one more cause, the leak, can make a
document toxic; else each sentence would carry some of the errors, and long clean texts their sum.

**Fit.** Words that take part are those whose document counts differ between the labels beyond chance; the
noisy-or is then fitted with a ridge penalty. Copies would let one labelled text vote many times, so texts
with the same smallest three-word hash share one vote. About ``training_texts`` labels, chosen by hash of
the id, are used; that bound is a parameter. Scoring reads every whole text.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased. Defined cases: NULL and empty texts have
no sentence and score 0; NULL labels teach nothing; several labels of one document are used one by one;
without labels of both kinds every score is 0; input columns named like an output are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitrisk.llm.common import HashSet, Words, columns, extended, extended_batch, joined, text_blocks

TRAINING_TEXTS = 8_000
#: A word takes part if the likelihood-ratio test puts its two shares so many standard deviations apart, in at least so many votes.
DEVIATION = 5.0
LEAST_VOTES = 6
RIDGE = 2e-6
STEPS = 400
DECIDE = 0.7

RESULT = T.StructType([*columns("score double, predicted int, n_sentences long"), T.StructField("sentences", T.ArrayType(T.StructType([*columns("sentence int, score double")])))])

_STOP = np.isin(np.arange(256), np.frombuffer(b".!?\n", np.uint8))


def sentence_of_words(data: np.ndarray, offsets: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """For each word the number of its sentence in the block, and for each text its first such number (and one for the end)."""
    stops = np.cumsum(_STOP[data])
    # Every stop and every text begins a sentence; those without words are numbered, too, and dropped later.
    at = (stops[words.starts] if len(words.starts) else np.zeros(0, np.int64)) + words.text
    before = np.concatenate([[0], stops])[offsets]
    return at, before + np.arange(len(offsets))


@dataclass
class Model:
    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    intercept: float = -np.inf

    def __post_init__(self) -> None:
        order = np.argsort(self.words)
        self.words, self.weights, self.known = self.words[order], self.weights[order], HashSet(self.words)

    def sentences(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the sentences with words in a block: text, number in the text (from 0), probability."""
        words = Words(data, offsets)
        at, first = sentence_of_words(data, offsets, words)
        present = np.unique(at)
        where, which = self.known.find(words.hashes)
        pairs = np.unique(at[where] * (len(self.words) + 1) + which)
        z, own = np.full(len(present), -np.inf), np.searchsorted(present, pairs // (len(self.words) + 1))
        z[own] = self.intercept
        np.add.at(z, own, self.weights[pairs % (len(self.words) + 1)])
        text = np.searchsorted(first, present, "right") - 1
        number = np.arange(len(present)) - np.searchsorted(text, text)
        return text, number, 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def noisy_or(p: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    return 1 - np.exp(np.bincount(group, np.log1p(-np.minimum(p, 1 - 1e-12)), groups))


def training_ids(labels: DataFrame, training_texts: int = TRAINING_TEXTS) -> DataFrame:
    """(doc_id, toxic) of about ``training_texts`` labels, chosen by hash: all, if there are fewer."""
    rows = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct()
    share = training_texts / max(1, rows.count())
    return rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000)


def fit(docs: DataFrame, labels: DataFrame, training_texts: int = TRAINING_TEXTS) -> Model:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic 0/1). The ids broadcast are bounded by
    ``training_texts``, and so are the words of sentences that reach the driver, as numbers."""
    texts = docs.filter("text IS NOT NULL").select("doc_id", F.col("text").cast("string").alias("text"))
    sample = texts.join(F.broadcast(training_ids(labels, training_texts)), "doc_id").dropDuplicates(["doc_id", "text", "toxic"])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = 0
            for data, offsets in text_blocks(batch.column("text")):
                words, n = Words(data, offsets), len(offsets) - 1
                at, first = sentence_of_words(data, offsets, words)
                order = np.lexsort((words.hashes, at))
                at, hashes = at[order], words.hashes[order]
                new = np.append(True, (at[1:] != at[:-1]) | (hashes[1:] != hashes[:-1]))[: len(at)]
                text = words.text[new]  # a text's words stay in its place, whatever their order
                bounds = np.searchsorted(text, np.arange(n + 1)).astype(np.int32)
                own = pa.ListArray.from_arrays(pa.array(bounds), pa.array(hashes[new].view(np.int64)))
                number = pa.ListArray.from_arrays(pa.array(bounds), pa.array((at[new] - first[text]).astype(np.int32)))
                votes = np.full(n, np.iinfo(np.uint64).max, np.uint64)
                three = words.windows(3)
                np.minimum.at(votes, words.text[: len(three)][three > 0], three[three > 0])
                yield pa.record_batch([pa.array(votes.view(np.int64)), batch.column("toxic").slice(row, n), own, number], names=["vote", "toxic", "words", "sentence"])
                row += n

    kind = T.StructType([*columns("vote long, toxic int"), T.StructField("words", T.ArrayType(T.LongType())), T.StructField("sentence", T.ArrayType(T.IntegerType()))])
    return _fit(sample.mapInArrow(cut, kind).toArrow())


def _fit(taught: pa.Table) -> Model:
    taught = taught.combine_chunks().filter(pa.compute.greater(pa.compute.list_value_length(taught["words"]), 0))
    votes, y = taught["vote"].to_numpy(), taught["toxic"].to_numpy() > 0
    words = joined([c.flatten().to_numpy() for c in taught["words"].chunks]).view(np.uint64)
    doc = np.repeat(np.arange(len(y), dtype=np.int32), pa.compute.list_value_length(taught["words"]).to_numpy())
    number = joined([c.flatten().to_numpy() for c in taught["sentence"].chunks])
    # A text's words come sentence by sentence, so a sentence begins where either number changes.
    begins = np.append(True, (doc[1:] != doc[:-1]) | (number[1:] != number[:-1]))[: len(doc)]
    sentence = np.cumsum(begins, dtype=np.int32) - 1
    doc, base = doc[begins], int(begins.sum())
    del taught, number, begins
    if not y.any() or y.all():
        return Model()
    _, group, size = np.unique(votes, return_inverse=True, return_counts=True)
    vote = 1 / size[group]
    vocabulary, word = np.unique(words, return_inverse=True)
    chosen = _telling(word, doc[sentence], len(vocabulary), y, vote)
    keep = np.isin(word, chosen)
    word, (present, sentence) = np.searchsorted(chosen, word[keep]), np.unique(sentence[keep], return_inverse=True)
    doc, base = doc[present], len(present)
    # Rarely said words need large weights: the ridge is weak, and steps are scaled by running second moments.
    logistic = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    w, b, leak = np.zeros(len(chosen)), -8.0, -3.0
    moments, total = np.zeros((2, len(chosen) + 2)), vote.sum()
    for step in range(1, STEPS + 1):
        p, chance = logistic(b + np.bincount(sentence, w[word], base)), logistic(leak)
        clean = 1 - noisy_or(p, doc, len(y))
        whole = np.clip(1 - (1 - chance) * clean, 1e-9, 1)
        grad_z = np.where(y[doc], p * ((1 - whole) / whole)[doc], -p) * vote[doc]
        grad_leak = np.where(y, chance * (1 - chance) * clean / whole, -chance) * vote
        grad = np.concatenate([np.bincount(word, grad_z[sentence], len(chosen)) / total - RIDGE * w, [grad_z.sum() / total, grad_leak.sum() / total]])
        moments[0] = 0.9 * moments[0] + 0.1 * grad
        moments[1] = 0.95 * moments[1] + 0.05 * grad**2
        move = 0.25 * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.95**step)) + 1e-8)
        w, b, leak = w + move[:-2], b + move[-2], leak + move[-1]
    return Model(vocabulary[chosen], w, float(b))


def _telling(word: np.ndarray, doc: np.ndarray, size: int, y: np.ndarray, vote: np.ndarray) -> np.ndarray:
    """Words whose share among the votes of toxic texts differs from that of the others."""
    seen = np.unique(word.astype(np.int64) * len(y) + doc)
    word, doc = seen // len(y), seen % len(y)
    toxic, other = vote[y].sum(), vote[~y].sum()
    a, c = np.bincount(word, vote[doc] * y[doc], size), np.bincount(word, vote[doc] * ~y[doc], size)
    share = (a + c) / (toxic + other)
    log_ratio = lambda n, expected: n * np.log(np.maximum(n, 1e-12) / np.maximum(expected, 1e-12))
    likelihood = 2 * (log_ratio(a, toxic * share) + log_ratio(toxic - a, toxic * (1 - share)) + log_ratio(c, other * share) + log_ratio(other - c, other * (1 - share)))
    return np.flatnonzero((likelihood > DEVIATION**2) & (a + c >= LEAST_VOTES))


def score(docs: DataFrame, model: Model, decide: float = DECIDE, texts: bool = True, least: float = 0.5) -> DataFrame:
    """``docs`` (text, any more) with RESULT. ``sentences`` are those scored ``least`` or more: number among the
    text's sentences with words, from 0, and score. ``texts=False`` leaves out the text."""
    sent = docs.sparkSession.sparkContext.broadcast((model.words, model.weights, model.intercept))

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*sent.value)
        for batch in batches:
            row = 0
            for data, offsets in text_blocks(batch.column("text")):
                n = len(offsets) - 1
                text, number, p = own.sentences(data, offsets)
                whole = noisy_or(p, text, n)
                found: list[list] = [[] for _ in range(n)]
                for k in np.flatnonzero(p >= least):
                    found[text[k]].append({"sentence": int(number[k]), "score": float(p[k])})
                part = batch.slice(row, n)
                part = part if texts else part.drop_columns(["text"])
                kind = pa.list_(pa.struct([("sentence", pa.int32()), ("score", pa.float64())]))
                yield extended_batch(part, score=pa.array(whole), predicted=pa.array((whole >= decide).astype(np.int32)), n_sentences=pa.array(np.bincount(text, minlength=n)), sentences=pa.array(found, kind))
                row += n

    kept = T.StructType([f for f in docs.schema if texts or f.name != "text"])
    return docs.mapInArrow(add, extended(kept, *RESULT))
