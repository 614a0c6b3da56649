"""Language identification by interpolated Kneser-Ney character models in sorted hash arrays."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordtide.llm import text as tx
from wordtide.llm.store import written

ORDER = 5
UNKNOWN = "und"
# A character never seen is one of so many.
ALPHABET = 1000
# Upper ends of length classes, and the length of pieces that calibrate each; the last uses whole texts.
CLASSES, PIECES = (32, 128, 512), (16, 48, 192)
_P = np.uint64(0x9E3779B97F4A7C15)


def letters(text: Column) -> Column:
    """Lower-cased letters and marks; all between them is one space."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}]+", " "))


def kneser_ney(texts: list[str], order: int = ORDER) -> Iterator[tuple[str, float | None, float | None]]:
    """(gram, log p of its last character, log of the weight it passes on as a context) of one language.

    The highest order counts occurrences, lower ones the distinct characters to the left.
    """
    grams: list[Counter] = [Counter() for _ in range(order + 1)]
    for text in texts:
        padded = " " * (order - 1) + text
        grams[order].update(padded[i : i + order] for i in range(len(text)))
    for n in range(order - 1, 0, -1):
        grams[n].update(g[1:] for g in grams[n + 1])
    p: dict[str, float] = {"": 1 / ALPHABET}
    weight: dict[str, float] = {}
    for n in range(1, order + 1):
        ones = sum(c == 1 for c in grams[n].values())
        twos = sum(c == 2 for c in grams[n].values())
        d = ones / (ones + 2 * twos) if ones and twos else 0.5
        total, kinds = defaultdict(int), Counter(g[:-1] for g in grams[n])
        for g, c in grams[n].items():
            total[g[:-1]] += c
        for h, k in kinds.items():
            weight[h] = d * k / total[h]
        for g, c in grams[n].items():
            p[g] = (c - d) / total[g[:-1]] + weight[g[:-1]] * p[g[1:]]
    for g in p.keys() | weight.keys():
        yield g, float(np.log(p[g])) if g in p else None, float(np.log(weight[g])) if g in weight else None


@dataclass
class Model:
    """Per order: sorted gram hashes with one log probability for each language, and the same for contexts."""

    languages: list[str] = field(default_factory=list)
    keys: list[np.ndarray] = field(default_factory=list)
    logp: list[np.ndarray] = field(default_factory=list)
    context_keys: list[np.ndarray] = field(default_factory=list)
    passed_on: list[np.ndarray] = field(default_factory=list)
    limits: np.ndarray = field(default_factory=lambda: np.full((0, len(CLASSES) + 1), np.inf))


def _hash(units: np.ndarray, first: int, at: np.ndarray) -> np.ndarray:
    """Hashes of units[at - first .. at], the last unit first."""
    out, power = units[at].copy(), np.array([_P])
    for back in range(1, first + 1):
        out += units[at - back] * power
        power = power * _P
    return out


def _hashes_of(grams: list[str]) -> np.ndarray:
    n = len(grams[0])
    units = np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    return _hash(units, n - 1, np.arange(len(grams)) * n + n - 1)


def assemble(rows: pd.DataFrame, order: int = ORDER) -> Model:
    """One table for each order over the grams of all languages.

    Where a language has not seen a gram, its entry is what it would back off to.
    """
    model = Model(sorted(rows["lang"].unique()))
    if not model.languages:
        return model
    rows = rows.assign(n=rows["gram"].str.len())
    one = lambda n, value: rows[(rows["n"] == n) & rows[value].notna()].pivot(
        index="gram", columns="lang", values=value
    ).reindex(columns=model.languages)
    lower = pd.DataFrame(-np.log(ALPHABET), index=[""], columns=model.languages)
    for n in range(1, order + 1):
        contexts = one(n - 1, "weight").fillna(0.0)
        table = one(n, "logp")
        grams = table.index.to_series()
        back = contexts.reindex(grams.str[:-1]).fillna(0.0).to_numpy() + lower.loc[grams.str[1:]].to_numpy()
        table = table.where(table.notna(), back)
        lower = table
        for frame, keys, values in ((table, model.keys, model.logp), (contexts, model.context_keys, model.passed_on)):
            names = frame.index.tolist()
            hashed = _hashes_of(names) if names and names[0] else np.zeros(len(names), np.uint64)
            sort = np.argsort(hashed)
            keys.append(hashed[sort])
            values.append(frame.to_numpy(np.float32)[sort])
    return model


def _rows(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def cross_entropies(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nats per character for each text and language, characters of each text); data is UTF-8."""
    order = len(model.keys)
    heads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    bounds = heads[offsets]
    lengths = np.diff(bounds)
    n, texts = int(bounds[-1]), len(lengths)
    units = np.full(n + (order - 1) * texts, 33, np.uint64)
    at = np.arange(n) + np.repeat((order - 1) * np.arange(1, texts + 1), lengths)
    units[at] = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    total = np.zeros((n, len(model.languages)), np.float32)
    open_ = np.arange(n)
    for k in range(order, 0, -1):
        if not len(open_):
            break
        row, found = _rows(model.keys[k - 1], _hash(units, k - 1, at[open_]))
        total[open_[found]] += model.logp[k - 1][row[found]]
        open_ = open_[~found]
        if k > 1:
            row, found = _rows(model.context_keys[k - 1], _hash(units, k - 2, at[open_] - 1))
            total[open_[found]] += model.passed_on[k - 1][row[found]]
        else:
            total[open_] += model.passed_on[0][0] - np.float32(np.log(ALPHABET))
    sums = np.stack([tx.exact_sums(total[:, j], bounds) for j in range(total.shape[1])], axis=1)
    return -sums / np.maximum(lengths, 1)[:, None], lengths


def calibrate(model: Model, rows: pd.DataFrame, margin: float, wrong: float = 0.05) -> None:
    """Per language and length class the cross-entropy above which a text is rejected.

    It is ``margin`` times the quantile ``1 - wrong`` over labelled texts that the models have not
    seen, whole and cut into pieces: labels can be wrong, and the few texts that are in truth in
    another language must not set the limit. The margin leaves room for passages in another language.
    A shorter class is at least as lenient as a longer one.
    """
    model.limits = np.full((len(model.languages), len(CLASSES) + 1), np.inf)
    for j, name in enumerate(model.languages):
        texts = rows.loc[rows["lang"] == name, "letters"].tolist()
        lenient = 0.0
        for c in range(len(CLASSES), -1, -1):
            size = PIECES[c] if c < len(CLASSES) else None
            parts = texts if size is None else [t[i : i + size] for t in texts for i in range(0, len(t) - size + 1, size)]
            if parts:
                packed = [p.encode() for p in parts]
                ends = np.concatenate(([0], np.cumsum([len(p) for p in packed])))
                got, _ = cross_entropies(model, np.frombuffer(b"".join(packed), np.uint8), ends)
                lenient = max(lenient, margin * float(np.quantile(got[:, j], 1 - wrong)))
            model.limits[j, c] = lenient or np.inf


def fit(docs: DataFrame, texts_per_language: int = 200, most_bytes: int = 100_000, margin: float = 1.75) -> Model:
    """A model from ``docs`` (text, lang).

    It is fitted on a bounded sample: about ``texts_per_language`` distinct texts of each language,
    of at most ``most_bytes`` bytes each, picked by a hash of the text. Three quarters of them give
    the counts, the rest the limits of rejection. Rows without text, letters or language give nothing.
    """
    known = docs.filter("text IS NOT NULL AND lang IS NOT NULL").filter(F.octet_length("text") <= most_bytes)
    marked = known.select("lang", "text", F.xxhash64("text").alias("h"))
    sizes = marked.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("distinct"))
    spread = 1 << 40
    share = F.least(F.lit(spread).cast("double"), F.lit(float(spread * texts_per_language)) / F.col("distinct"))
    sample = (
        marked.join(F.broadcast(sizes.withColumn("share", share)), "lang")
        .filter(F.pmod("h", F.lit(spread)) < F.col("share"))
        .dropDuplicates(["lang", "h"])
        .select("lang", letters(F.col("text")).alias("letters"), (F.pmod(F.shiftright("h", 40), F.lit(4)) == 0).alias("held"))
        .filter("letters != ''")
    )
    # bounded, and read three times: written once, so that the corpus is not
    sample = written(sample, "language-sample")

    def one(part: pd.DataFrame) -> pd.DataFrame:
        seen = part.loc[~part["held"], "letters"].tolist() or part["letters"].tolist()
        out = pd.DataFrame(kneser_ney(seen), columns=["gram", "logp", "weight"])
        return out.assign(lang=part["lang"].iloc[0], letters=None)[["lang", "gram", "logp", "weight", "letters"]]

    schema = "lang string, gram string, logp double, weight double, letters string"
    grams = sample.groupBy("lang").applyInPandas(one, schema)
    held = sample.filter("held").select("lang", "letters")
    model = assemble(grams.select("lang", "gram", "logp", "weight").toPandas())
    if model.languages:
        calibrate(model, held.toPandas(), margin)
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a struct column ``language``: lang_pred, score, rejected, cross_entropy.

    The whole text is scored, as lower-cased letters with single spaces between. lang_pred is the
    language of the lowest cross-entropy per character; score is its share among the languages if
    each is weighted by the likelihood of up to 64 characters at that rate. A text is rejected if
    its cross-entropy is above the limit of that language for its length. A null text, or one
    without letters, is ``und``, with score 0, rejected, and no cross-entropy; so is every text if
    the model has learned no language. Ties go to the language that comes first by name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m: Model = shared.value
        for column in columns:
            lang, score, rejected, best = [], [], [], []
            for _, _, data, offsets in tx.blocks(column, 1 << 19):
                if not m.languages:
                    lengths = np.zeros(len(offsets) - 1)
                    h = np.zeros((len(lengths), 1))
                else:
                    h, lengths = cross_entropies(m, data, offsets)
                pick = h.argmin(axis=1)
                low = h[np.arange(len(h)), pick]
                share = 1 / np.exp(-(h - low[:, None]) * np.minimum(lengths, 64)[:, None]).sum(axis=1)
                kind = np.searchsorted(CLASSES, lengths, "right")
                for i in range(len(h)):
                    has = lengths[i] > 0
                    lang.append(m.languages[pick[i]] if has else UNKNOWN)
                    score.append(float(share[i]) if has else 0.0)
                    rejected.append(bool(low[i] > m.limits[pick[i], kind[i]]) if has else True)
                    best.append(float(low[i]) if has else None)
            yield pa.StructArray.from_arrays(
                [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_()), pa.array(best, pa.float64())],
                ["lang_pred", "score", "rejected", "cross_entropy"],
            )

    udf = F.arrow_udf(judge, "lang_pred string, score double, rejected boolean, cross_entropy double")
    has_letter = F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}")
    return docs.withColumn("language", udf(F.when(has_letter, letters(F.col("text"))).otherwise("")))
