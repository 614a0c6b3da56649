"""Toxicity by multiple-instance learning: sentence scores, combined by noisy-or, learned from document labels."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordtide.llm import text as tx
from wordtide.llm.store import written

# A word is a feature, and so is its beginning of each of these lengths in bytes.
PREFIXES = (4, 5, 6)
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True
_STOP = np.zeros(256, bool)
_STOP[[0x0A, 0x21, 0x2E, 0x3F]] = True
_BITS = 20


@dataclass
class Model:
    """Sorted feature hashes with their weights, and the score of a sentence without features."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def __post_init__(self) -> None:
        self.filter = np.zeros(1 << _BITS, bool)
        self.filter[(self.features >> np.uint64(64 - _BITS)).astype(np.int64)] = True


def sentence_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts of all sentences, sentences before each text). A text that is not empty has at least one.

    A sentence ends with its stop, a line end or ``.``, ``!``, ``?``.
    """
    begin = np.zeros(len(data) + 1, bool)
    begin[1:] = _STOP[data]
    begin[offsets] = True
    begin[-1] = False
    starts = np.flatnonzero(begin)
    return starts, np.searchsorted(starts, offsets)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of words, hashes): every word and its prefixes; data is lower-cased."""
    starts, ends, _ = tx.spans(_LETTER[data], offsets)
    place, hashed = [starts], [tx.span_hashes(data, starts, ends)]
    for n in PREFIXES:
        long = starts[ends - starts > n]
        place.append(long)
        hashed.append(tx.mix(tx.span_hashes(data, long, long + n) ^ np.uint64(n)))
    return np.concatenate(place), np.concatenate(hashed)


def _picked(known: np.ndarray, filter_: np.ndarray, place: np.ndarray, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, indexes of known features) of the features that the model has."""
    maybe = np.flatnonzero(filter_[(hashed >> np.uint64(64 - _BITS)).astype(np.int64)])
    at = np.minimum(np.searchsorted(known, hashed[maybe]), len(known) - 1)
    real = known[at] == hashed[maybe]
    return place[maybe[real]], at[real]


def sentence_logits(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(logit of each sentence, sentence starts, sentences before each text)."""
    low = tx.ascii_lower(data)
    starts, bounds = sentence_starts(low, offsets)
    logits = np.full(len(starts), model.bias)
    if len(model.features) and len(starts):
        place, index = _picked(model.features, model.filter, *features(low, offsets))
        sentence = np.searchsorted(starts, place, "right") - 1
        logits += np.bincount(sentence, model.weights[index], len(starts))
    return logits, starts, bounds


def noisy_or(logits: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """1 - product of (1 - p) over each text's sentences; 0 for a text without any."""
    return -np.expm1(-tx.exact_sums(np.logaddexp(0, logits), bounds))


def train(
    rows: np.ndarray, index: np.ndarray, bounds: np.ndarray, labels: np.ndarray, share: np.ndarray, start: np.ndarray,
    steps: int = 200, rate: float = 0.1, decay: float = 1e-5,
) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch Adam on the likelihood of the document labels.

    rows, index: sentence and feature of each occurrence; bounds: sentences before each document;
    share: what each document counts for; start: the weights to begin with.
    """
    n, sentences = len(start), int(bounds[-1])
    w = np.append(start, -5.0)
    share = share / share.sum()
    first, second = np.zeros(n + 1), np.zeros(n + 1)
    document = np.repeat(np.arange(len(labels)), np.diff(bounds))
    for step in range(1, steps + 1):
        z = np.bincount(rows, w[index], sentences) + w[n]
        p = 1 / (1 + np.exp(-z))
        keep = np.exp(-tx.exact_sums(np.logaddexp(0, z), bounds))
        pull = np.where(labels == 1, keep / np.maximum(1 - keep, 1e-12), -1.0) * share
        gz = -p * pull[document]
        grad = np.append(np.bincount(index, gz[rows], n), gz.sum())
        grad[:n] += decay * w[:n] / max(n, 1)
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        w = w - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-10)
    return w[:n], float(w[n])


def _labelled(docs: DataFrame, labels: DataFrame, per_class: int, most_bytes: int) -> DataFrame:
    """(text, label, share): at most about ``per_class`` labelled texts of each class."""
    clean = labels.filter("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    sizes = {r["label"]: r["n"] for r in clean.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for label, n in sizes.items():
        share = F.when(F.col("label") == label, F.lit(max(1.0, n / per_class))).otherwise(share)
    spread = 1 << 40
    picked = clean.withColumn("share", share).filter(
        F.pmod(F.xxhash64("doc_id"), F.lit(spread)) * F.col("share") < F.lit(float(spread))
    )
    # about 2 * per_class rows of three numbers, whatever the size of the labels
    texts = docs.filter(F.octet_length("text") <= most_bytes).select("doc_id", "text")
    return texts.join(F.broadcast(picked), "doc_id").select("text", "label", "share")


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each batch: a feature and the number of documents of each class that have it."""
    for batch in batches:
        labels = np.array(batch.column("label").to_pylist(), np.int64)
        parts = []
        for low, high, data, offsets in tx.blocks(batch.column("text")):
            place, hashed = features(tx.ascii_lower(data), offsets)
            document = np.searchsorted(offsets, place, "right") - 1
            pairs = np.unique(np.stack([hashed, document.astype(np.uint64)]), axis=1)
            parts.append((pairs[0], labels[low:high][pairs[1].astype(np.int64)]))
        if parts:
            hashed, label = (np.concatenate(x) for x in zip(*parts, strict=True))
            keys, at = np.unique(hashed, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tx.signed(keys)), *(pa.array(np.bincount(at, label == k, len(keys)).astype(np.int64)) for k in (0, 1))],
                ["feature", "clean", "toxic"],
            )


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 3000, most_bytes: int = 100_000, most_features: int = 4096) -> Model:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, label: 1 is toxic).

    It is fitted on a bounded sample: about ``per_class`` labelled texts of each class, of at most
    ``most_bytes`` bytes each, picked by a hash of doc_id; a text counts for those left out of its
    class. Features are the words and beginnings of words that speak most for the toxic class. No
    sentence has a label: a document's label is that of the noisy-or over its sentences.

    Null texts, and labels other than 0 and 1, give nothing. Of several labels of a document the
    largest counts. Without labelled texts every sentence scores the same, which is next to nothing.
    """
    sample = written(_labelled(docs, labels, per_class, most_bytes), "toxicity-sample")
    counted = sample.select("text", "label").mapInArrow(_frequencies, "feature bigint, clean bigint, toxic bigint")
    summed = counted.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).filter("clean + toxic >= 3")
    sizes = sample.agg(F.sum((F.col("label") == 0).cast("int")), F.sum((F.col("label") == 1).cast("int"))).first()
    no, yes = (float(x or 0) for x in sizes)
    nothing = Model(np.zeros(0, np.uint64), np.zeros(0), -12.0)
    if not yes or not no:
        return nothing
    t, c = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(t / (yes + 1 - t)) - F.log(c / (no + 1 - c))
    best = summed.withColumn("z", odds / F.sqrt(1 / t + 1 / c)).filter("z > 3").orderBy(F.desc("z"), "feature").limit(most_features)
    picked = best.select("feature", odds.alias("odds")).toPandas()
    if not len(picked):
        return nothing
    known = picked["feature"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(known)
    known, start = known[order], np.minimum(picked["odds"].to_numpy(np.float64)[order], 8.0) / 2
    probe = Model(known, np.zeros(len(known)), 0.0)

    def occurrences(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            out = []
            for _, _, data, offsets in tx.blocks(column):
                low = tx.ascii_lower(data)
                starts, bounds = sentence_starts(low, offsets)
                place, index = _picked(probe.features, probe.filter, *features(low, offsets))
                sentence = np.searchsorted(starts, place, "right") - 1
                sort = np.argsort(sentence, kind="stable")
                sentence, index = sentence[sort], index[sort]
                cut = np.searchsorted(sentence, bounds)
                for i in range(len(offsets) - 1):
                    part = slice(cut[i], cut[i + 1])
                    out.append({"sentences": int(bounds[i + 1] - bounds[i]), "at": sentence[part] - bounds[i], "feature": index[part]})
            yield pa.array(out, pa.struct([("sentences", pa.int32()), ("at", pa.list_(pa.int32())), ("feature", pa.list_(pa.int32()))]))

    found = F.arrow_udf(occurrences, "sentences int, at array<int>, feature array<int>")
    rows = sample.select("label", "share", found(F.col("text")).alias("o")).select("label", "share", "o.*").toPandas()
    bounds = np.concatenate(([0], np.cumsum(rows["sentences"].to_numpy()))).astype(np.int64)
    at = np.concatenate([np.asarray(a, np.int64) + b for a, b in zip(rows["at"], bounds[:-1], strict=True)])
    index = np.concatenate([np.asarray(f, np.int64) for f in rows["feature"]])
    weights, bias = train(at, index, bounds, rows["label"].to_numpy(), rows["share"].to_numpy(), start)
    return Model(known, weights, bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a struct column ``toxicity``: score (0 to 1) and offending.

    score is the noisy-or over the sentences of the whole text. offending lists (start, end, score)
    of each sentence that scores at least 0.3, as byte places in the text's UTF-8. A null or empty
    text has score 0 and no sentences.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def judge(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for column in columns:
            scores, spots = [np.zeros(0)], []
            for _, _, data, offsets in tx.blocks(column):
                logits, starts, bounds = sentence_logits(m, data, offsets)
                scores.append(noisy_or(logits, bounds))
                ends = np.append(starts[1:], len(data))
                p = 1 / (1 + np.exp(-logits))
                mine = [[] for _ in range(len(offsets) - 1)]
                for s in np.flatnonzero(p >= 0.3):
                    d = int(np.searchsorted(bounds, s, "right")) - 1
                    mine[d].append({"start": int(starts[s] - offsets[d]), "end": int(ends[s] - offsets[d]), "score": float(p[s])})
                spots += mine
            yield pa.StructArray.from_arrays([pa.array(np.concatenate(scores)), pa.array(spots, kind)], ["score", "offending"])

    udf = F.arrow_udf(judge, "score double, offending array<struct<start: bigint, end: bigint, score: double>>")
    return docs.withColumn("toxicity", udf(F.coalesce("text", F.lit(""))))
