"""Language-model scores: a log-bilinear model trained with noise-contrastive estimation, over corpus counts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordtide.llm import text as tx
from wordtide.llm.store import written

DIM, CONTEXT, NOISE, BATCH = 16, 2, 64, 16_384
# Noise words that an example has for itself in each step below the first.
INNER = 4
# Updates that a task makes at least, going over its examples again if they are few.
STEPS = 100
# This many most frequent words, and the end, are reached in one step; all other words in three.
TOP = 254
# Groups of a section, and outcomes of a group.
GROUPS, LEAVES = 32, 256
# Words with parameters and a count in every task; the others are dealt to bins, and their counts stay on the cluster.
FREQUENT = 1 << 18
# Bins have this many words on average, until there are 2^MOST_BIN_BITS of them, a group.
BIN_WORDS, MOST_BIN_BITS = 256, 8
# Contexts whose probabilities are worked out at once: a table that stays in a processor's cache.
TABLE = 512
# Examples that are told from noise at once: another such table.
NOISED = 2048
# Rows of more gradients than this in an update have them added up in one go.
FEW = 8
# Rows of parameters that are changed at once.
ASCENDED = 4096
# Examples that a task gathers before it trains on them.
EXAMPLES = 4_000_000
# Neighbouring rows of parameters that a task gives out as one record.
AVERAGED = 64
# Bytes of text that are scored at once, so that many tokens share a context or a group.
SCORED_BYTES = 1 << 21
# No sum of exponentials of logits up to this overflows.
SAFE = 60.0
END = (1, 1)


@dataclass
class Lookup:
    """Sorted word hashes with a count and a class, its own; other words have the class ``rest`` plus their bin.

    The end is no word: it has a class and a count of its own, ``ends``, and is never looked up.
    """

    h1: np.ndarray
    h2: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    end: int
    rest: int
    ends: int
    bits: int = 0

    def find(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, whether found)."""
        if not len(self.h1):
            return np.zeros(len(h1), np.int64), np.zeros(len(h1), bool)
        bits, begin = self.begin
        at, last = begin.take(h1 >> np.uint64(64 - bits)).astype(np.int64), len(self.h1) - 1
        # the first words of a hash are spread evenly, so few steps lead to the first one that is not less
        less = np.flatnonzero(self.h1.take(at, mode="clip") < h1)
        for _ in range(8):
            at[less] += 1
            less = less[self.h1.take(at[less], mode="clip") < h1[less]]
        at[less] = np.searchsorted(self.h1, h1[less])
        np.minimum(at, last, out=at)
        found = self.h1.take(at) == h1
        found &= self.h2.take(at) == h2
        return at, found

    @cached_property
    def begin(self) -> tuple[int, np.ndarray]:
        """A number of bits, and for each value of that many first bits of a hash the number of words with lesser ones."""
        bits = max(len(self.h1).bit_length() + 1, 1)
        return bits, np.searchsorted(self.h1, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).astype(np.int32)

    def bins(self, h1: np.ndarray) -> np.ndarray:
        """The bin of each word: the first bits of its hash."""
        return (h1 >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(h1), np.int64)


@dataclass
class Tree:
    """Classes 0 to ``top`` are reached in one step; the others, ``LEAVES`` a group, by section, group and class.

    A step is a choice among neighbouring rows: of the first classes and all sections, of the groups of a
    section, or of the classes of a group. Bins come right after ``top``, so one group holds them all.
    """

    top: int
    classes: int

    def __post_init__(self) -> None:
        self.tail = self.classes - self.top - 1
        self.groups = -(-self.tail // LEAVES)
        self.head = self.top + 1 + -(-self.groups // GROUPS)
        self.rows = self.head + self.groups + self.tail

    def first(self, classes: np.ndarray) -> np.ndarray:
        """The row of the first step to each class."""
        return np.where(classes <= self.top, classes, self.top + 1 + (classes - self.top - 1) // (LEAVES * GROUPS))

    def later(self, classes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row, first row, number of rows to choose from) of the second and third step to classes beyond ``top``."""
        at = classes - self.top - 1
        out = []
        for row, n, size, before in [(at // LEAVES, self.groups, GROUPS, self.head), (at, self.tail, LEAVES, self.head + self.groups)]:
            low = row // size * size
            out.append((before + row, before + low, np.minimum(n - low, size)))
        return out

    def summed(self, shares: np.ndarray) -> np.ndarray:
        """The share of each row among those of its step."""
        tail = shares[self.top + 1 :]
        if not len(tail):
            return shares / shares.sum()
        groups = np.add.reduceat(tail, np.arange(0, self.tail, LEAVES))
        sections = np.add.reduceat(groups, np.arange(0, self.groups, GROUPS))
        return np.concatenate([
            np.append(shares[: self.top + 1], sections) / shares.sum(),
            groups / np.repeat(sections, GROUPS)[: self.groups],
            tail / np.repeat(groups, LEAVES)[: self.tail],
        ])


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b``, in pieces too small for more threads of the library than the one core that a task has."""
    n, inner = a.shape
    rows = max(1, (1 << 17) // (inner * b.shape[1]))
    out, whole = np.empty((n, b.shape[1]), np.float32), n // rows * rows
    np.matmul(a[:whole].reshape(-1, rows, inner), b, out=out[:whole].reshape(-1, rows, b.shape[1]))
    np.matmul(a[whole:], b, out=out[whole:])
    return out


def _extended(predicted: np.ndarray) -> np.ndarray:
    out = np.ones((len(predicted), DIM + 1), np.float32)
    out[:, :DIM] = predicted
    return out


@dataclass
class Parameters:
    """Of the model: in each step s(row | h) = sum over places i of (place_i * context_{h_i}) . word_row + bias_row.

    Every class has a context vector, every row of the tree a word vector. Below the first step a bias is
    the logarithm of a share of the corpus and stays so.
    """

    context: np.ndarray
    place: np.ndarray
    word: np.ndarray
    bias: np.ndarray
    tree: Tree

    @staticmethod
    def start(shares: np.ndarray, top: int | None = None) -> Parameters:
        draw = np.random.Generator(np.random.PCG64(11))
        tree = Tree(len(shares) - 1 if top is None else top, len(shares))
        small = lambda n: (draw.standard_normal((n, DIM), np.float32) * np.float32(0.1))
        # below the first step, words are told apart by their shares alone until they are learned
        word = np.concatenate([small(tree.head), np.zeros((tree.rows - tree.head, DIM), np.float32)])
        return Parameters(small(len(shares)), np.ones((CONTEXT, DIM), np.float32), word, np.log(tree.summed(shares)).astype(np.float32), tree)

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.place, self.word, self.bias]

    def whole(self) -> np.ndarray:
        """Rows of context, word and place, then the biases of the first step, ``DIM`` a row."""
        first = self.bias[: self.tree.head]
        return np.concatenate([self.context, self.word, self.place, np.pad(first, (0, -len(first) % DIM)).reshape(-1, DIM)])

    def replaced(self, at: np.ndarray, values: np.ndarray) -> Parameters:
        """With other values in the numbered rows of the whole."""
        whole, bias = self.whole(), self.bias.copy()
        whole[at] = values
        context, word, place, first = np.split(whole, np.cumsum([len(self.context), len(self.word), CONTEXT]))
        bias[: self.tree.head] = first.ravel()[: self.tree.head]
        return Parameters(context, place, word, bias, self.tree)

    def safe(self, predicted: np.ndarray) -> bool:
        """Whether no sum of exponentials of logits can overflow."""
        longest = [np.sqrt(np.einsum("nd,nd->n", x, x).max(initial=0.0)) for x in (predicted, self.word)]
        return bool(longest[0] * longest[1] + np.abs(self.bias).max() < SAFE)

    def logits(self, extended: np.ndarray, low: int, high: int, safe: bool) -> np.ndarray:
        """Scores of the rows ``low`` to ``high``, one step of the tree, less the largest if they may not be safe.

        ``extended`` is what is predicted, with a column of ones, which the biases are multiplied with.
        """
        step = np.empty((DIM + 1, high - low), np.float32)
        step[:DIM], step[DIM] = self.word[low:high].T, self.bias[low:high]
        out = _product(extended, step)
        if not safe:
            out -= out.max(axis=1, keepdims=True)
        return out

    def step(self, predicted: np.ndarray, low: int, high: int) -> np.ndarray:
        """Normalized log probabilities of the rows ``low`` to ``high``, one step of the tree."""
        logits = self.logits(_extended(predicted), low, high, self.safe(predicted))
        logits -= np.log(np.exp(logits).sum(axis=1, keepdims=True))
        return logits

    def log_probabilities(self, contexts: np.ndarray) -> np.ndarray:
        """Normalized log probabilities of all classes after each context (a row of classes, nearest last)."""
        t, r = self.tree, self.predicted(contexts)
        first = self.step(r, 0, t.head)
        out = [first[:, : t.top + 1]]
        for section, low in enumerate(range(0, t.groups, GROUPS)):
            groups = self.step(r, t.head + low, t.head + min(low + GROUPS, t.groups)) + first[:, [t.top + 1 + section]]
            for i, group in enumerate(groups.T):
                at = (low + i) * LEAVES
                out.append(self.step(r, t.head + t.groups + at, t.head + t.groups + min(at + LEAVES, t.tail)) + group[:, None])
        return np.concatenate(out, axis=1)

    def chosen(
        self, contexts: np.ndarray, at: np.ndarray, classes: np.ndarray, unseen: np.ndarray, sort: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Log probabilities of ``classes``, each after the context ``contexts[at]``: only the steps to it are taken.

        Then, for bins (the classes after ``top``), the log of what the shares ``unseen`` of all bins make
        together, as a part of the probability of the one bin. ``sort`` may give the order of ``at``.
        """
        t, out, part_unseen = self.tree, np.zeros(len(classes)), np.zeros(len(classes))
        first, predicted = self.tree.first(classes), self.predicted(contexts)
        safe, predicted = self.safe(predicted), _extended(predicted)
        ones, sums = np.ones(max(t.head, LEAVES, GROUPS), np.float32), np.empty(len(classes), np.float32)
        sort = np.argsort(at) if sort is None else sort
        cuts = np.searchsorted(at[sort], np.arange(0, len(contexts) + TABLE, TABLE))
        for i, (low, high) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            table = self.logits(predicted[i * TABLE : (i + 1) * TABLE], 0, t.head, safe)
            part = sort[low:high]
            of = at[part] - i * TABLE
            out[part] = table[of, first[part]]
            sums[part] = (np.exp(table, out=table) @ ones[: t.head])[of]
        out -= np.log(sums)
        deep = np.flatnonzero(classes > t.top)
        deep = deep[np.argsort(classes[deep])]
        at = at[deep]
        for row, start, size in t.later(classes[deep]):
            own, sums, share = (np.zeros(len(deep), np.float32) for _ in range(3))
            cuts = np.append(np.flatnonzero(np.append(True, start[1:] != start[:-1])), len(deep)).tolist() if len(deep) else [0]
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                begin, n = int(start[low]), int(size[low])
                some = TABLE * max(1, LEAVES // n)
                for a in range(low, high, some):
                    part = slice(a, min(a + some, high))
                    table = self.logits(predicted.take(at[part], axis=0), begin, begin + n, safe)
                    own[part] = table[np.arange(len(table)), row[part] - begin]
                    sums[part] = np.exp(table, out=table) @ ones[:n]
                    if begin == t.head + t.groups:  # the group of the bins
                        share[part] = np.log(table[:, : len(unseen)] @ unseen) - own[part]
            out[deep] += own - np.log(sums)
            part_unseen[deep] += share
        return out, part_unseen

    def predicted(self, contexts: np.ndarray) -> np.ndarray:
        out = self.context.take(contexts[:, 0], axis=0)
        out *= self.place[0]
        for i in range(1, CONTEXT):
            more = self.context.take(contexts[:, i], axis=0)
            more *= self.place[i]
            out += more
        return out


def _whole_rows(x: np.ndarray) -> np.ndarray:
    """The rows as one value each, which are put in their places as they are."""
    return x.view(f"V{x.itemsize * x.shape[1]}").ravel() if x.ndim > 1 else x


def _added(rows: np.ndarray, grads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows, sums of their gradients)."""
    sort = np.argsort(rows, kind="stable" if rows.itemsize == 2 else None)
    ordered = rows.take(sort)
    fresh = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    times = np.diff(np.append(fresh, len(rows)))
    out = grads.take(sort.take(fresh), axis=0)
    # rows of few gradients get them one by one
    for i in range(1, FEW):
        some = np.flatnonzero((times > i) & (times <= FEW))
        out[some] += grads.take(sort.take(fresh[some] + i), axis=0)
    often = times > FEW
    if often.any():
        # complex numbers are pairs of neighbouring columns, added up in one go
        parts = grads.take(sort[np.repeat(often, times)], axis=0).view(np.complex64)
        out[often] = np.add.reduceat(parts, np.append(0, np.cumsum(times[often])[:-1]), axis=0).view(np.float32)
    return ordered.take(fresh), out


def _added_apart(rows: np.ndarray, grads: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows, sums of their gradients) of rows below ``size`` that seldom repeat; ``grads`` are used up."""
    last, places = np.empty(size, np.int32), np.arange(len(rows), dtype=np.int32)
    last[rows] = places
    last = last.take(rows)
    kept = last == places
    others = np.flatnonzero(~kept)
    if len(others):
        at, more = _added(last.take(others), grads.take(others, axis=0))
        grads[at] += more
    kept = np.flatnonzero(kept)
    return rows.take(kept), grads.take(kept, axis=0)


def _ascend(x: np.ndarray, squares: np.ndarray, rows: np.ndarray, grads: np.ndarray, rate: float) -> None:
    """Adagrad, in place, of distinct rows by their gradients, which are used up."""
    for low in range(0, len(rows), ASCENDED):
        at, g = rows[low : low + ASCENDED], grads[low : low + ASCENDED]
        s = squares.take(at, axis=0)
        s += g * g
        np.put(_whole_rows(squares), at, _whole_rows(s))
        g *= np.float32(rate)
        g /= np.sqrt(s, out=s)
        g += x.take(at, axis=0)
        np.put(_whole_rows(x), at, _whole_rows(g))


def _loss(logits: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Gradients by the logits of noise, given the negative logits, in their place."""
    np.exp(logits, out=logits)
    logits += 1
    return np.divide(-weights[:, None], logits, out=logits)


def _sections(
    p: Parameters, extended: np.ndarray, weights: np.ndarray, row: np.ndarray, start: np.ndarray, among: np.ndarray, others: np.ndarray
) -> tuple[list[tuple[slice, slice]], np.ndarray]:
    """In the second step, for examples sorted by section: (examples, rows) of each, and gradients of logits by row of the section."""
    n, at, own = len(row), np.arange(len(row)), row - start
    cuts = np.append(np.flatnonzero(np.append(True, start[1:] != start[:-1])), n).tolist()
    parts = [(slice(low, high), slice(int(start[low]), int(start[low] + among[low]))) for low, high in zip(cuts[:-1], cuts[1:], strict=True)]
    negative = np.zeros((n, GROUPS), np.float32)
    for part, section in parts:
        size = section.stop - section.start
        columns = -np.vstack([p.word[section].T, p.bias[section] - np.float32(np.log(INNER / size))])
        negative[part, :size] = _product(extended[part], columns)
    gain = weights / (1 + np.exp(-negative[at, own]))
    drawn = np.bincount((others + (at * GROUPS - start)[:, None]).ravel(), minlength=n * GROUPS).reshape(n, GROUPS)
    out = _loss(negative, weights)
    out *= drawn.astype(np.float32)
    out[at, own] += gain
    return parts, out


def train(p: Parameters, contexts: np.ndarray, words: np.ndarray, weights: np.ndarray, shares: np.ndarray, rate: float = 0.1, steps: int | None = None) -> int:
    """Adagrad on noise-contrastive estimation, in place: one pass, or as many as make ``steps`` updates; how many it made.

    In each step to its word, an example tells the row from others: in the first from rows drawn from
    ``shares``, which a batch has in common, and in later ones from ``INNER`` drawn evenly from the step's rows.
    """
    t = p.tree
    draw = np.random.Generator(np.random.PCG64(13))
    squares = [np.full(x.shape, 1e-6, np.float32) for x in p.parts()]
    log_noise = np.log(NOISE * shares).astype(np.float32)
    size = min(BATCH, len(words))
    passes = max(1, -(-(STEPS if steps is None else steps) // -(-len(words) // size)))
    mixed = np.concatenate([draw.permutation(len(words)) for _ in range(passes)])
    for low in range(0, len(mixed), size):
        at = mixed[low : low + size]
        # sorted by word, so the examples of a section, a group and a row are neighbours
        w = words.take(at)
        sort = np.argsort(w)
        at, w = at[sort], w[sort]
        h, wt = contexts.take(at, axis=0), weights.take(at)
        wt = (wt / wt.sum()).astype(np.float32)
        noise, row = draw.choice(len(shares), NOISE, p=shares), t.first(w)
        before = p.context.take(h.T.ravel(), axis=0).reshape(CONTEXT, len(at), DIM)
        r, own = sum(c * place for c, place in zip(before, p.place, strict=True)), p.word.take(row, axis=0)
        extended = _extended(r)
        gain = wt / (1 + np.exp(np.einsum("bd,bd->b", r, own) + (p.bias[: t.head] - log_noise).take(row)))
        pull = np.multiply(gain[:, None], own, out=own)
        theirs, against = p.word[noise], np.zeros((NOISE, DIM + 1), np.float32)
        columns = -np.vstack([theirs.T, p.bias[noise] - log_noise[noise]])
        for i in range(0, len(at), NOISED):
            some = slice(i, i + NOISED)
            loss = _loss(_product(extended[some], columns), wt[some])
            pull[some] += _product(loss, theirs)
            against += loss.T @ extended[some]
        first = np.append(row, noise)
        biases = np.bincount(first, np.append(gain, against[:, DIM]), t.head).astype(np.float32)
        first = first.astype(np.int16 if t.head < 1 << 15 else np.int64)
        updates = [_added(first, np.concatenate([gain[:, None] * r, against[:, :DIM]]))]
        deep = int(np.searchsorted(w, t.top, "right"))
        rd, wd, add, given = r[deep:], wt[deep:], pull[deep:], sort[deep:]
        for row, start, among in t.later(w[deep:]):
            choice = np.flatnonzero(among > 1)
            if not len(choice):
                continue
            # drawn in the order in which examples came
            drawn = np.zeros((len(rd), INNER))
            drawn[choice[np.argsort(given[choice])]] = draw.random((len(choice), INNER))
            others = start[:, None] + (drawn * among[:, None]).astype(np.int64)
            weighted = wd * (among > 1)
            if start[0] < t.head + t.groups:
                parts, coefficients = _sections(p, extended[deep:], weighted, row, start, among, others)
                for part, section in parts:
                    some = coefficients[part, : section.stop - section.start]
                    add[part] += _product(some, p.word[section])
                    updates.append((np.arange(section.start, section.stop), some.T @ rd[part]))
            else:
                # noise by noise; the last is the own row
                rows = np.concatenate([*others.T, row])
                grads, log_even = np.empty((INNER + 1, *rd.shape), np.float32), np.log(INNER / among).astype(np.float32)
                for k, (its, grad) in enumerate(zip(rows.reshape(INNER + 1, -1), grads, strict=True)):
                    vectors = p.word.take(its, axis=0)
                    logits = np.einsum("bd,bd->b", rd, vectors) + p.bias.take(its) - log_even
                    factor = (-weighted / (1 + np.exp(-logits)) if k < INNER else weighted / (1 + np.exp(logits)))[:, None]
                    np.multiply(factor, rd, out=grad)
                    add += np.multiply(factor, vectors, out=vectors)
                updates.append(_added_apart(rows, grads.reshape(-1, DIM), t.rows))
        places = np.stack([np.einsum("bd,bd->d", pull, c) for c in before])
        for c, place in zip(before, p.place, strict=True):
            np.multiply(pull, place, out=c)
        _ascend(p.context, squares[0], *_added(h.T.ravel(), before.reshape(-1, DIM)), rate)
        _ascend(p.place, squares[1], np.arange(CONTEXT), places, rate)
        for at, g in updates:
            _ascend(p.word, squares[2], at, g, rate)
        _ascend(p.bias, squares[3], np.arange(t.head), biases, rate)
    return -(-len(mixed) // size)


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first hashes, second hashes, tokens before each text): words with A-Z lower-cased, then an end."""
    low = tx.ascii_lower(data)
    starts, ends, bounds = tx.word_spans(low, offsets)
    texts = len(bounds) - 1
    at = np.arange(len(starts)) + np.repeat(np.arange(texts), np.diff(bounds))
    n = len(starts) + texts
    h1, h2 = np.full(n, END[0], np.uint64), np.full(n, END[1], np.uint64)
    h1[at], h2[at] = tx.span_hashes(low, starts, ends), tx.second_hashes(low, starts, ends)
    return h1, h2, bounds + np.arange(texts + 1)


def _summed(h1: np.ndarray, h2: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    return _summed_each(np.zeros(len(h1), np.uint8), h1, h2, *values)[1:]


def _summed_each(text: np.ndarray, h1: np.ndarray, h2: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct words of each text, in order, with sums of their values."""
    sort = np.argsort(h1)
    if len(text) and text.any():
        key = text[sort]
        sort = sort[np.argsort(key.astype(np.uint16) if key.max() < 1 << 16 else key, kind="stable")]

    def fresh(x: np.ndarray) -> np.ndarray:
        x = x[sort]
        return x[1:] != x[:-1]

    word, other = fresh(text) | fresh(h1), fresh(h2)
    if (other & ~word).any():  # two words of one first hash
        sort = np.lexsort((h2, h1, text))
        word, other = fresh(text) | fresh(h1), fresh(h2)
    at = np.flatnonzero(np.append(True, word | other)) if len(h1) else np.zeros(0, np.int64)
    return *(x[sort[at]] for x in (text, h1, h2)), *(np.add.reduceat(x[sort], at) if len(at) else x for x in values)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts of a task, given out whenever a million are held."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def out() -> pa.RecordBatch:
        h1, h2, n = _summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
        return pa.RecordBatch.from_arrays([pa.array(tx.signed(h1)), pa.array(tx.signed(h2)), pa.array(n)], ["h1", "h2", "c"])

    for batch in batches:
        for _, _, data, offsets in tx.blocks(batch.column("text")):
            h1, h2, _ = _tokens(data, offsets)
            held.append(_summed(h1, h2, np.ones(len(h1), np.int64)))
            if sum(len(x[0]) for x in held) > 1_000_000:
                yield out()
                held.clear()
    if held:
        yield out()


def _contexts(classes: np.ndarray, bounds: np.ndarray, end: int) -> np.ndarray:
    """The classes before each token, nearest last; ends stand before a text's first token."""
    out = np.full((len(classes), CONTEXT), end, np.int64)
    inside = np.arange(len(classes)) - np.repeat(bounds[:-1], np.diff(bounds))
    for back in range(1, CONTEXT + 1):
        far = np.flatnonzero(inside >= back)
        out[far, CONTEXT - back] = classes[far - back]
    return out


def _classes(lookup: Lookup, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    row, found = lookup.find(h1, h2)
    classes = np.where(found, lookup.classes[row], 0) if len(lookup.h1) else np.zeros(len(h1), np.int64)
    classes[~found] = lookup.rest + lookup.bins(h1[~found])
    classes[(h1 == END[0]) & (h2 == END[1])] = lookup.end
    return classes, row, found


TRAINED = "block int, at array<int>, weight array<double>, row array<float>"
MEAN = "at array<int>, row array<float>"


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows averaged by weight over the tasks that give them; all records of a block must be in one task."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        at, weight, row = (batch.column(x).flatten().to_numpy() for x in ("at", "weight", "row"))
        ends = np.cumsum(batch.column("at").value_lengths().to_numpy())
        row = row.reshape(-1, DIM)
        for block, low, high in zip(batch.column("block").to_pylist(), np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True):
            total = totals.get(block)
            if total is None:
                total = totals[block] = np.zeros((AVERAGED, DIM + 1))
            some, w = at[low:high] - block * AVERAGED, weight[low:high, None]
            total[some] += np.hstack([row[low:high] * w, w])
    for block, total in totals.items():
        some = np.flatnonzero(total[:, DIM])
        mean = (total[some, :DIM] / total[some, DIM:]).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([some + block * AVERAGED], pa.list_(pa.int32())), pa.array([mean.ravel()], pa.list_(pa.float32()))], ["at", "row"])


def _trainer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, shares, top = shared.value
        p, n, trained, steps = Parameters.start(shares, top), len(shares), 0.0, 0
        bits = n.bit_length()
        t = p.tree
        drawn = t.summed(shares)[: t.head]
        held: list[np.ndarray] = []
        # how often each row of context and word was learned from
        seen = [np.zeros(n), np.zeros(t.rows)]

        def learn() -> float:
            nonlocal steps
            codes, weights = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            *before, words = ((codes >> (bits * i) & ((1 << bits) - 1)).astype(np.int32) for i in range(CONTEXT, -1, -1))
            contexts = np.stack(before, axis=1)
            del codes, before
            weights = weights.astype(np.float64)
            for column in contexts.T:
                seen[0] += np.bincount(column, weights, n)
            tail = np.bincount(words, weights, n)[t.top + 1 :]
            if len(tail):
                seen[1][t.head : t.head + t.groups] += np.add.reduceat(tail, np.arange(0, t.tail, LEAVES))
                seen[1][t.head + t.groups :] += tail
            steps += train(p, contexts, words, weights, drawn, steps=STEPS - steps)
            return float(weights.sum())

        for batch in batches:
            for _, _, data, offsets in tx.blocks(batch.column("text")):
                h1, h2, bounds = _tokens(data, offsets)
                classes, _, _ = _classes(lookup, h1, h2)
                code = np.zeros(len(classes), np.int64)
                for column in [*_contexts(classes, bounds, lookup.end).T, classes]:
                    code = code << bits | column
                held.append(code)
                if sum(map(len, held)) > EXAMPLES:
                    trained += learn()
        if held:
            trained += learn()
        if trained:
            # rows of the first step and places are learned from every token
            seen[1][: t.head] = trained
            rows = p.whole()
            weights = np.concatenate([*seen, np.full(len(rows) - n - t.rows, trained)])
            learned = np.flatnonzero(weights)
            blocks = learned // AVERAGED
            fresh = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1]))
            for low in range(0, len(fresh), 512):
                cuts = np.append(fresh, len(learned))[low : low + 513]
                at, cut = learned[cuts[0] : cuts[-1]], pa.array(cuts - cuts[0], pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.array(blocks[cuts[:-1]], pa.int32()),
                    pa.ListArray.from_arrays(cut, pa.array(at, pa.int32())),
                    pa.ListArray.from_arrays(cut, pa.array(weights[at])),
                    pa.ListArray.from_arrays(pa.array((cuts - cuts[0]) * DIM, pa.int32()), pa.array(rows[at].ravel())),
                ], ["block", "at", "weight", "row"])

    return run


@dataclass
class Model:
    lookup: Lookup
    parameters: Parameters
    tokens: int
    words: int
    discount: float
    rest_tokens: int
    rest_words: int
    bin_tokens: np.ndarray
    bin_words: np.ndarray

    def unseen(self) -> np.ndarray:
        """The share of words never seen in each bin."""
        return np.where(self.bin_tokens > 0, self.discount * self.bin_words / np.maximum(self.bin_tokens, 1), 1.0)

    @cached_property
    def known_base(self) -> np.ndarray:
        return self.log_base(self.lookup.counts)

    def log_base(self, counts: np.ndarray | int) -> np.ndarray:
        return np.log10((counts + 1) / (self.tokens + self.words + 1))


def word_counts(docs: DataFrame) -> DataFrame:
    """(h1, h2, c) of every token of all texts; a word is its 128 bits of hash."""
    text = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    counted = text.mapInArrow(_count, "h1 bigint, h2 bigint, c bigint")
    return written(counted.groupBy("h1", "h2").agg(F.sum("c").alias("c")), "word-counts")


def _bin(bits: int) -> Column:
    return F.shiftrightunsigned("h1", 64 - bits).cast("int") if bits else F.lit(0)


def fit(docs: DataFrame, counts: DataFrame) -> Model:
    """A model of all texts of ``docs``, with their ``counts``.

    Every task trains on all of its texts from the same start; parameters are averaged, weighted by how
    often they were learned from. The most frequent words, ``FREQUENT`` at most, are classes with
    parameters of their own, as words and as contexts. All words beyond, and those that occur once, are
    dealt to bins by their hashes, and bins are classes; the share of a word within its bin comes from
    the counts, with a discount that is left to unseen words.
    """
    spark = docs.sparkSession
    is_end = (F.col("h1") == END[0]) & (F.col("h2") == END[1])
    total, words, ones, twos, ends = counts.agg(
        F.sum("c"), F.count("c"), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2), F.sum(F.when(is_end, F.col("c")))
    ).first()
    total, ends = total or 0, ends or 0
    spread = counts.filter(~is_end)
    # the lowest power of two, from 2, that at most FREQUENT words reach
    by_power = {r["k"]: r["n"] for r in spread.groupBy(F.floor(F.log2("c")).alias("k")).agg(F.count("*").alias("n")).collect()}
    power, held = max(by_power, default=0) + 1, 0
    while power > 1 and held + by_power.get(power - 1, 0) <= FREQUENT:
        power -= 1
        held += by_power.get(power, 0)
    known = spread.filter(F.col("c") >= 1 << power).toPandas()
    if len(known) < TOP:  # a power that more words reach than may go to tasks has the next of the top words all the same
        more = spread.filter(F.col("c").between(2, (1 << power) - 1)).orderBy(F.desc("c"), "h1", "h2").limit(TOP - len(known)).toPandas()
        known = pd.concat([known, more], ignore_index=True) if len(more) else known
    known = known.sort_values(["c", "h1", "h2"], ascending=[False, True, True]).reset_index(drop=True)
    top = min(TOP, len(known))
    h1 = known["h1"].to_numpy(np.int64).view(np.uint64)
    sort = np.argsort(h1)
    c = known["c"].to_numpy(np.int64)
    rest_tokens, rest_words = total - int(c.sum()) - ends, words - len(known) - (ends > 0)
    bits = min(max(rest_words // BIN_WORDS, 1).bit_length() - 1, MOST_BIN_BITS)
    # classes: top words, the end, bins, other known words
    end, rest, rank = top, top + 1, np.arange(len(known))
    classes = np.where(rank < top, rank, rank + 1 + (1 << bits))
    lookup = Lookup(h1[sort], known["h2"].to_numpy(np.int64).view(np.uint64)[sort], c[sort], classes[sort], end, rest, ends, bits)
    bins = np.zeros((2, 1 << bits), np.int64)
    for r in spread.filter(F.col("c") < 1 << power).groupBy(_bin(bits).alias("bin")).agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect():
        bins[:, r["bin"]] = r["c"], r["n"]
    low = c < 1 << power
    np.subtract.at(bins[0], lookup.bins(h1[low]), c[low])
    np.subtract.at(bins[1], lookup.bins(h1[low]), 1)
    shares = np.concatenate([c[:top], [ends], bins[0], c[top:]]).astype(np.float64) + 1
    shares /= shares.sum()
    start = Parameters.start(shares, top)
    trained = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        _trainer(spark.sparkContext.broadcast((lookup, shares, top))), TRAINED
    )
    mean = trained.repartition("block").mapInArrow(_average, MEAN).toArrow()
    at, values = (pa.concat_arrays([pa.array([], x.type.value_type), *(c.flatten() for c in x.chunks)]).to_numpy() for x in mean.columns)
    discount = ones / (ones + 2 * twos) if ones and twos else 0.5
    parameters = start.replaced(at, values.reshape(-1, DIM))
    return Model(lookup, parameters, int(total), int(words), discount, rest_tokens, rest_words, *bins)


SCORED = "n_tokens bigint, n_known bigint, base double, model double, rare array<struct<h1: bigint, h2: bigint, n: bigint, unseen: double>>"


def _scorer(shared):
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m: Model = shared.value
        bits = m.parameters.tree.classes.bit_length()
        for column in columns:
            parts, rare = [], []
            for _, _, data, offsets in tx.blocks(column, SCORED_BYTES):
                h1, h2, bounds = _tokens(data, offsets)
                classes, row, found = _classes(m.lookup, h1, h2)
                # the class of each token after its context; equal contexts are one
                contexts = _contexts(classes, bounds, m.lookup.end)
                code = np.zeros(len(classes), np.int64)
                for place in contexts.T:
                    code = code << bits | place
                sort = np.argsort(code)
                fresh = np.append(True, np.diff(code[sort]) != 0)
                at = np.empty(len(code), np.int64)
                at[sort] = np.cumsum(fresh) - 1
                chosen = m.parameters.chosen(contexts[sort[fresh]], at, classes, m.unseen(), sort)
                model, unseen = (x / np.log(10) for x in chosen)
                is_end = classes == m.lookup.end
                base = np.where(found, m.known_base.take(row), 0.0) if len(m.known_base) else np.zeros(len(row))
                base[is_end] = m.log_base(m.lookup.ends)
                known = found | is_end & (m.lookup.ends > 0)
                parts.append((np.diff(bounds), tx.sums(known.astype(np.int64), bounds), tx.exact_sums(base, bounds), tx.exact_sums(model, bounds)))
                open_ = np.flatnonzero(~found & ~is_end)
                texts = np.repeat(np.arange(len(bounds) - 1), np.diff(np.searchsorted(open_, bounds)))
                text, *word = _summed_each(texts, h1[open_], h2[open_], np.ones(len(open_), np.int64), unseen[open_])
                rare.append((np.bincount(text, minlength=len(bounds) - 1), *word))
            if not parts:
                parts = [tuple(np.zeros(0, t) for t in (np.int64, np.int64, float, float))]
            arrays = [pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)]
            lengths, *flat = [np.concatenate(x) for x in zip(*rare, strict=True)] if rare else [np.zeros(0, t) for t in (np.int64, np.uint64, np.uint64, np.int64, float)]
            ends = np.append(0, np.cumsum(lengths)).astype(np.int32)
            inner = pa.StructArray.from_arrays([pa.array(x) for x in (tx.signed(flat[0]), tx.signed(flat[1]), *flat[2:])], ["h1", "h2", "n", "unseen"])
            yield pa.StructArray.from_arrays([*arrays, pa.ListArray.from_arrays(pa.array(ends), inner)], ["n_tokens", "n_known", "base", "model", "rare"])

    return run


def score(docs: DataFrame, learn: DataFrame) -> DataFrame:
    """``docs`` without text, with n_tokens, n_known, train_tokens, base_score and score.

    Tokens are words (anything but ``[\\x20\\x09-\\x0D]``, A-Z lower-cased) and one end for each text;
    a null text is an empty one, with its end alone. All texts of ``learn`` are learned from.
    base_score adds log10((c + 1) / (N + V + 1)) for each token, c being its count, N all tokens and
    V the distinct ones learned from; n_known counts tokens with c > 0. score is the model's log10
    probability: of each token's class after the two before it, and, in a bin, of the word within it;
    all words never seen are one word. The end has a class of its own, so its probability is that of
    the class. Without texts to learn from, all is unseen. Columns of ``docs`` other than text are
    kept; one with the name of a result is replaced by it.

    Counts and parameters of the most frequent words go to every task (at most ``FREQUENT``). Other words
    are looked up by a join, one row for each text and distinct word. Repeated rows stay apart.
    """
    counts = word_counts(learn)
    model = fit(learn, counts)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # numbered once, in the table that is written
    given = [x for x in docs.columns if x not in ("text", "n_tokens", "n_known", "train_tokens", "base_score", "score")]
    scored = written(
        docs.select(
            F.struct(F.lit(0).alias("_"), *(F.col(f"`{x}`") for x in given)).alias("given"),
            F.arrow_udf(_scorer(shared), SCORED)(F.coalesce("text", F.lit(""))).alias("scored"),
            F.monotonically_increasing_id().alias("row_number"),
        ),
        "scored",
    )
    rare = scored.select("row_number", F.inline("scored.rare"))
    c, n = F.coalesce("c", F.lit(0)), F.col("n")
    tokens = F.get(F.array(*(F.lit(float(x)) for x in np.maximum(model.bin_tokens, 1))), _bin(model.lookup.bits))
    looked = rare.join(counts, ["h1", "h2"], "left").select(
        "row_number", F.when(c > 0, n).otherwise(0).alias("known"),
        (n * F.log10((c + 1) / F.lit(float(model.tokens + model.words + 1)))).alias("base"), F.when(c > 0, n * F.log10((c - model.discount) / tokens)).otherwise(F.col("unseen")).alias("model"),
    )
    added = looked.groupBy("row_number").agg(*(F.sum(x).alias(f"rare_{x}") for x in ("known", "base", "model")))
    zero = lambda x: F.coalesce(f"rare_{x}", F.lit(0))
    heads = scored.select("given", "row_number", *(f"scored.{x}" for x in ("n_tokens", "n_known", "base", "model")))
    return heads.join(added, "row_number", "left").select(
        *(F.col("given").getField(x).alias(x) for x in given), "n_tokens", (F.col("n_known") + zero("known")).alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"), (F.col("base") + zero("base")).alias("base_score"),
        (F.col("model") + zero("model")).alias("score"),
    )
