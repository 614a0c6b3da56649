"""SentencePiece encoding by a streaming Viterbi search, and decoding."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordtide.llm import text as tx

# Fixed value: the letter that stands for a space.
SPACE = "▁"
# Segments up to this many characters are remembered, and of the beginnings of segments the last pieces.
REMEMBERED_CHARS, BEGUN_CHARS = 48, 12
# Findings that a process remembers, at most twice so many: for two neighbours, of beginnings, and of segments.
REMEMBERED, REMEMBERED_BEGUN, REMEMBERED_SEGMENTS = 262_144, 262_144, 524_288
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


@dataclass
class Pieces:
    """The vocabulary: pieces that text can become, their scores, bytes, and control pieces."""

    ids: dict[str, int]
    scores: dict[str, float]
    bytes_: list[int]  # id of each byte's piece, or empty
    spelled: list[bytes]  # of each id, what decoding writes
    unknown: int
    merges: bool  # scores are the ranks of merges, not log probabilities


def read_model(path: str) -> Pieces:
    """The vocabulary of a model file. Only models that leave characters as they are are taken."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    probe = "  a  B\tc é ﬁ "
    if sp.normalize(probe) != normalized(probe):
        raise ValueError(f"{path}: its normalization is not the identity with a leading space")
    ids, scores, spelled, bytes_ = {}, {}, [], [0] * 256
    has_bytes = False
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            value = int(_BYTE.fullmatch(piece)[1], 16)
            bytes_[value], has_bytes = i, True
            spelled.append(bytes([value]))
        elif sp.is_control(i) or sp.is_unused(i):
            spelled.append(b"")
        elif sp.is_unknown(i):
            spelled.append(" ⁇ ".encode())
        else:
            ids[piece], scores[piece] = i, sp.get_score(i)
            spelled.append(piece.replace(SPACE, " ").encode())
    merges = all(v == int(v) for v in scores.values())
    return Pieces(ids, scores, bytes_ if has_bytes else [], spelled, sp.unk_id(), merges)


def normalized(text: str) -> str:
    return SPACE + text.replace(" ", SPACE) if text else ""


class Remembered(dict):
    """Findings by key: the newest ``size``, and of the ``size`` before them those that are asked for again. None is none."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.old: dict = {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is not None:
            self.keep(key, found)
        return found

    def keep(self, key, found) -> None:
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = found


class Viterbi:
    """The best path through the pieces of a stream of characters.

    With log probabilities, the best path has the largest sum of scores. With merge ranks, it is the
    one path whose neighbours are stable: merging the characters of two neighbours gives the two
    again. Every prefix has exactly one such path, and it is what merging the whole text gives.
    Either way one backpointer per boundary is enough. Only boundaries within the longest piece of
    the end can still be extended; once all their paths go through one boundary, what is before it
    is committed and forgotten.
    """

    def __init__(self, pieces: Pieces, share: float = 1.0) -> None:
        self.known = pieces.scores
        self.longest = max(map(len, pieces.scores), default=1)
        self.merges = pieces.merges
        self.unknown_score = min(pieces.scores.values(), default=0.0) - 10.0
        self.ends = {p[i:] for p in pieces.scores for i in range(1, len(p))}
        # what was found before: for two neighbours, and for the last piece of a short beginning
        self.stable, self.begun = Remembered(int(REMEMBERED * share)), Remembered(int(REMEMBERED_BEGUN * share))
        self.streamed = 0  # characters the search has gone over

    def merged(self, text: str) -> list[str]:
        """The pieces that merging neighbours, best score first and leftmost of equals, ends with."""
        parts, score = list(text), self.known.get
        around = [score(a + b, -np.inf) for a, b in zip(parts, parts[1:], strict=False)]
        while around and (best := max(around)) > -np.inf:
            i = around.index(best)
            parts[i] += parts[i + 1]
            del parts[i + 1], around[i]
            if i < len(around):
                around[i] = score(parts[i] + parts[i + 1], -np.inf)
            if i:
                around[i - 1] = score(parts[i - 1] + parts[i], -np.inf)
        return parts

    def neighbours(self, left: str, right: str) -> bool:
        """Whether merging the characters of both ends with these two. The answer is remembered."""
        found = left + right not in self.known if left else True
        found = found and self.merged(left + right) == ([left, right] if left else [right])
        self.stable.keep((left, right), found)
        return found

    def _back(self, window: str, last: list[str], best: list[float], i: int) -> tuple[str, float]:
        """The last piece on the best path to boundary i, and the path's score."""
        known, picked, top = self.known, None, -np.inf
        if self.merges:
            remembered, ends = self.stable, self.ends
            for j in range(i - 1, max(0, i - self.longest) - 1, -1):
                piece = window[j:i]
                if j < i - 1 and piece not in known:
                    if piece not in ends:
                        break
                    continue
                found = remembered[last[j], piece]
                if found is None:
                    found = self.neighbours(last[j], piece)
                if found:
                    return piece, 0.0
            raise AssertionError(f"no path to boundary {i} of {window!r}")
        for j in range(max(0, i - self.longest), i):
            piece = window[j:i]
            score = known.get(piece, self.unknown_score if j == i - 1 else -np.inf)
            if best[j] + score > top:
                picked, top = piece, best[j] + score
        return picked, top

    def stream(self, parts: Iterable[str], closed: bool = False) -> Iterator[list[str]]:
        """The pieces of a text given in parts, committed as soon as no later character can change them.

        Paths that survive end within the longest piece of the last character. They are followed
        back whenever the window has grown to twice that length, and what lies before the boundary
        that they share is committed. With ``closed``, no piece crosses from one part into the next,
        so all paths share the boundary between the two, and everything before it is committed.
        """
        window, last, best, begins = "", [""], [0.0], True
        for part in parts:
            self.streamed += len(part)
            for c in part:
                window += c
                start = window if begins and self.merges and len(window) <= BEGUN_CHARS else None
                piece, score = self.begun[start] if start else None, 0.0
                if piece is None:
                    piece, score = self._back(window, last, best, len(window))
                    if start:
                        self.begun.keep(start, piece)
                last.append(piece)
                best.append(score)
                if len(window) >= 2 * self.longest and (cut := self._converged(last)):
                    yield self._path(last, cut)
                    # the piece before the cut stays as the left neighbour of what follows
                    window, last, best, begins = window[cut:], last[cut:], [b - best[cut] for b in best[cut:]], False
            if closed:
                yield self._path(last, len(window))
                window, last, best, begins = "", [""], [0.0], True
        if window:
            yield self._path(last, len(window))

    def _converged(self, last: list[str]) -> int:
        """The last boundary that the paths to all boundaries that can be extended have in common."""
        end = len(last) - 1
        at = set(range(max(0, end - self.longest + 1), end + 1))
        while len(at) > 1:
            far = max(at)
            at.remove(far)
            at.add(max(0, far - len(last[far])) if far else 0)
        return at.pop()

    @staticmethod
    def _path(last: list[str], end: int) -> list[str]:
        out = []
        while end > 0:
            out.append(last[end])
            end -= len(last[end])
        return out[::-1]


def _segments(pieces: Pieces) -> Callable[[str], list[str]]:
    """A function that cuts a text where no piece can cross, so that all paths have a boundary there.

    Which places those are follows from the pairs of characters that stand together in some piece:
    around control characters in none of them, ahead of a space after anything but a space, and
    ahead of a mark after a letter.
    """
    inner = {(a, b) for p in pieces.ids for a, b in zip(p, p[1:], strict=False)}
    within = {c for pair in inner for c in pair}
    alone = "".join(re.escape(c) for c in "\n\t\r" if c not in within)
    either = f"[{alone}]|" if alone else ""
    if any(a != SPACE and b == SPACE for a, b in inner):
        return re.compile(f"{either}[^{alone}]+" if alone else "(?s:.+)").findall
    marks = {c for c in within if not c.isalpha() and not c.isdecimal() and c != SPACE}
    while drop := {b for a, b in inner if b in marks and a != SPACE and a not in marks}:
        marks -= drop
    m = "".join(map(re.escape, sorted(marks)))
    word = f"[^{SPACE}{alone}{m}]+"
    return re.compile(f"{either}{SPACE}*[{m}]*{word}|{SPACE}*[{m}]+|{SPACE}+" if m else f"{either}{SPACE}*{word}|{SPACE}+").findall


class Encoder:
    """Text to the bytes of its ids, through one streaming search.

    The text is streamed in parts that no piece crosses. Ids of a short part that was streamed before
    are remembered; ``share`` of the findings that a process may remember.
    """

    def __init__(self, pieces: Pieces, share: float = 1.0) -> None:
        self.pieces, self.search = pieces, Viterbi(pieces, share)
        self.segments = _segments(pieces)
        self.remembered = Remembered(int(REMEMBERED_SEGMENTS * share))

    def _streamed(self, segment: str) -> bytes:
        ids: list[int] = []
        for committed in self.search.stream((segment,), closed=True):
            for piece in committed:
                known = self.pieces.ids.get(piece)
                if known is not None:
                    ids.append(known)
                elif self.pieces.bytes_:
                    ids += [self.pieces.bytes_[b] for b in piece.encode()]
                elif not ids or ids[-1] != self.pieces.unknown:
                    ids.append(self.pieces.unknown)
        out = np.array(ids, np.int32).tobytes()
        if len(segment) <= REMEMBERED_CHARS:
            self.remembered.keep(segment, out)
        return out

    def encode(self, text: str) -> bytes:
        known, search = self.remembered, self._streamed
        return b"".join([known[s] or search(s) for s in self.segments(normalized(text))])


def decode(ids: list[int], spelled: list[bytes]) -> str:
    """The text of ids: pieces and bytes joined, without the leading space. Broken UTF-8 is replaced."""
    return b"".join(map(spelled.__getitem__, ids)).decode("utf-8", "replace").removeprefix(" ")


_ready: dict = {}


def _encoder(shared, share: float) -> Encoder:
    """One encoder for each process; its memory of segments is bounded and only saves time."""
    if shared not in _ready:
        _ready.clear()
        _ready[shared] = Encoder(shared.value, share)
    return _ready[shared]


def _id_lists(parts: list[bytes]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(p) // 4 for p in parts]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), np.int32)))


def _by_blocks(column: pa.Array, coded: Callable[[list[str]], pa.Array]) -> pa.Array:
    """``coded`` of all texts; those of a block at a time are Python objects."""
    done = [coded(column.slice(low, high - low).to_pylist()) for low, high, _, _ in tx.blocks(column)]
    return pa.concat_arrays(done) if done else coded([])


def coder(docs: DataFrame, path: str, share: float = 1.0) -> tuple[Callable[[Column], Column], Callable[[Column], Column], Callable[[Column], Column]]:
    """Column functions (encode, decode, both) for the model at ``path``.

    encode: text to ids, as the model's library encodes, without begin or end. decode: ids to text;
    an id outside of the vocabulary is an error. both: a struct of ids and of the text they decode
    to. A null or empty text has no ids, and no ids are an empty text. Texts of any length are
    encoded whole; the search keeps a window of a few times the longest piece.

    The driver reads the vocabulary and sends it to the tasks; that is all the model has. Tasks that are
    short of memory remember a smaller ``share`` of findings, which takes time and changes no result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_model(path))

    def encode(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(shared, share)
        for column in columns:
            yield _by_blocks(column, lambda texts: _id_lists([encoder.encode(t) for t in texts]))

    def spell(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        spelled = shared.value.spelled
        for column in columns:
            yield pa.array([decode(x or [], spelled) for x in column.to_pylist()], pa.string())

    def both(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(shared, share)

        def coded(texts: list[str]) -> pa.Array:
            parts = [encoder.encode(t) for t in texts]
            decoded = [decode(np.frombuffer(p, np.int32).tolist(), encoder.pieces.spelled) for p in parts]
            return pa.StructArray.from_arrays([_id_lists(parts), pa.array(decoded, pa.string())], ["ids", "decoded"])

        for column in columns:
            yield _by_blocks(column, coded)

    text_of = lambda text: F.coalesce(text, F.lit(""))
    encode_udf, decode_udf = F.arrow_udf(encode, "array<int>"), F.arrow_udf(spell, "string")
    both_udf = F.arrow_udf(both, "ids array<int>, decoded string")
    return lambda c: encode_udf(text_of(c)), lambda c: decode_udf(c), lambda c: both_udf(text_of(c))


def encode_decode(docs: DataFrame, path: str, share: float = 1.0) -> DataFrame:
    """``docs`` with ``pieces``: a struct of ids and decoded, the text that the ids give back."""
    _, _, both = coder(docs, path, share)
    return docs.withColumn("pieces", both(F.col("text")))
