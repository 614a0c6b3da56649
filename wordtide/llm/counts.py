"""Token counts of byte-level BPE: whole tokens are looked up, and only the rest is merged."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the pre-tokens of byte-level BPE.
PRE_TOKENS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
# Pre-tokens up to this many characters are remembered, and up to so many of them in a process.
REMEMBERED_CHARS, REMEMBERED = 48, 600_000
_NEVER = 1 << 60


def byte_letters() -> list[str]:
    """The letter that stands for each byte in vocabulary files: itself if printable, else one from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters, spare = [], 0x100
    for b in range(256):
        letters.append(chr(b) if b in plain else chr(spare))
        spare += b not in plain
    return letters


def merge(parts: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """BPE: the pair of lowest rank is merged, leftmost first, until no pair has a rank."""
    if len(parts) > 64:
        return _merge_long(parts, ranks)
    get = ranks.get
    around = [get(pair, _NEVER) for pair in zip(parts, parts[1:], strict=False)]
    while around and (best := min(around)) != _NEVER:
        i = around.index(best)
        parts[i] += parts[i + 1]
        del parts[i + 1], around[i]
        if i < len(around):
            around[i] = get((parts[i], parts[i + 1]), _NEVER)
        if i:
            around[i - 1] = get((parts[i - 1], parts[i]), _NEVER)
    return parts


def _merge_long(parts: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """The same with a heap, in time near to proportional."""
    n = len(parts)
    after, before = [*range(1, n), -1], list(range(-1, n - 1))
    heap = [(r, i, p) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if (r := ranks.get(p)) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, pair = heapq.heappop(heap)
        j = after[i] if parts[i] is not None else -1
        if j < 0 or (parts[i], parts[j]) != pair:
            continue
        parts[i], parts[j] = parts[i] + parts[j], None
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for left in (before[i], i):
            if left >= 0 and (right := after[left]) >= 0:
                pair = (parts[left], parts[right])
                if (rank := ranks.get(pair)) is not None:
                    heapq.heappush(heap, (rank, left, pair))
    return [p for p in parts if p is not None]


def read_vocabulary(path: str) -> tuple[list[str], list[tuple[str, str]], list[str]]:
    """(token strings in byte letters, merges in order, special strings) of a tokenizer's JSON file."""
    with open(path, encoding="utf-8") as file:
        found = json.load(file)
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in found["model"]["merges"]]
    specials = [t["content"] for t in found["added_tokens"]]
    return list(found["model"]["vocab"]), merges, specials


def whole_tokens(vocabulary: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """The vocabulary strings that, encoded alone, are proved to be one token."""
    return [t for t in vocabulary if merge(list(t), ranks) == [t]]


class _Counts(dict):
    """Pre-token to its number of tokens. Whole tokens are there from the start and stay."""

    def __init__(self, whole: list[str], ranks: dict[tuple[str, str], int]) -> None:
        self.letters = byte_letters()
        back = {c: b for b, c in enumerate(self.letters)}
        self.whole = {}
        for token in whole:
            try:
                self.whole[bytes(map(back.__getitem__, token)).decode()] = 1
            except (KeyError, UnicodeDecodeError):
                continue  # part of a character: no pre-token
        self.ranks = ranks
        super().__init__(self.whole)

    def __missing__(self, pre_token: str) -> int:
        n = len(merge([self.letters[b] for b in pre_token.encode()], self.ranks))
        if len(pre_token) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.clear()
                self.update(self.whole)
            self[pre_token] = n
        return n


_ready: dict = {}


def _counter(shared):
    """One counter for each process; its memory of merged pre-tokens is bounded and only saves time."""
    if shared not in _ready:
        whole, merges, specials = shared.value
        counts = _Counts(whole, {m: i for i, m in enumerate(merges)})
        split = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        _ready.clear()
        _ready[shared] = counts, split, regex.compile(PRE_TOKENS).findall
    return _ready[shared]


def count_text(text: str, counts: dict[str, int], split, pre_tokens) -> int:
    if split is None or not (cuts := list(split.finditer(text))):
        return sum(map(counts.__getitem__, pre_tokens(text)))
    total, at = len(cuts), 0
    for cut in [*cuts, None]:
        end = cut.start() if cut else len(text)
        total += sum(map(counts.__getitem__, pre_tokens(text[at:end])))
        at = cut.end() if cut else end
    return total


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, one row per row of ``docs``.

    ``path``: the JSON file of a byte-level BPE tokenizer. Tokens are counted as its library counts
    them by default: without begin, end or padding, without truncation; special strings inside a
    text are one token each and part what is around them. A null text is an empty one: no bytes, no
    tokens. Repeated rows, null ids and any length of text are counted one by one.

    The driver reads the vocabulary and proves, by merging each string, which of them encode alone
    as one token. Those and the merges go to the tasks; their size is that of the vocabulary. A
    pre-token among them counts as one; any other is merged.
    """
    vocabulary, merges, specials = read_vocabulary(path)
    whole = whole_tokens(vocabulary, {m: i for i, m in enumerate(merges)})
    shared = docs.sparkSession.sparkContext.broadcast((whole, merges, specials))

    def count(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counts, split, pre_tokens = _counter(shared)
        for column in columns:
            yield pa.array([count_text(t, counts, split, pre_tokens) for t in column.to_pylist()], pa.int64())

    tokens = F.arrow_udf(count, "bigint")
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.octet_length(text).cast("bigint").alias("n_bytes"), tokens(text).alias("n_tokens")).withColumn(
        "over_limit", F.col("n_tokens") > limit
    )
