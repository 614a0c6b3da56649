"""Operators on texts: edge cases of every kind, each against a plain version."""

from __future__ import annotations

import math
import random
import tracemalloc
from collections import Counter
from itertools import chain, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wordtide.llm import components, counts, decontaminate, lang, lines, lm, near, pieces, text, toxic
from wordtide.llm.queries import token_file

SCHEMA = "doc_id bigint, text string, row string, n_lines int, leaks string, s int"
ODD = ["", None, " \n\t ", "x", "é" * 30, "a\x0bb\x1cc\x85d", "ÄÖ straße İI", "one two three four five", "|" * 40]


@pytest.fixture
def docs(spark):
    """Rows of (doc_id, text), with columns whose names the operators use themselves."""

    def make(rows):
        return spark.createDataFrame([(i, t, "own", 7, "own", 3) for i, t in rows], SCHEMA)

    return make


def numbered(texts):
    return list(enumerate(texts))


# words and hashes


def test_blocks_and_words_of_any_text():
    import pyarrow as pa

    column = pa.array([*ODD, "last one"]).slice(1)
    got = []
    for _, _, data, offsets in text.blocks(column, 16):
        starts, ends, bounds = text.word_spans(data, offsets)
        words = [data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
        got += [words[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        assert len(text.span_hashes(data, starts, ends)) == len(words)
    assert got == [(t or "").encode().split() for t in [*ODD, "last one"][1:]]


def test_hashes_depend_on_the_word_alone():
    data = np.frombuffer(b"abc xabc abcd abc", np.uint8)
    starts, ends, _ = text.word_spans(data, np.array([0, len(data)]))
    h = text.span_hashes(data, starts, ends)
    assert h[0] == h[3] and len(set(h.tolist())) == 3


# line dedup


def plain_lines(rows, min_chars=20, min_docs=3):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    key = lambda line: line.strip(lines.SPACE).translate(low)
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, t in rows:
        kept = [
            line for line in (t or "").split("\n")
            if len(key(line)) < min_chars or len(holders.get(key(line), ())) < min_docs or i == max(holders[key(line)])
        ]
        out.append((i, "\n".join(kept), len((t or "").split("\n")), len((t or "").split("\n")) - len(kept)))
    return sorted(out, key=repr)


def test_line_dedup_is_the_plain_one(docs):
    line, other = "A line that many documents SHARE", "ünother one that documents share É"
    rows = numbered([*ODD, line, f"x\n {line.lower()}\t", f"{line}\n{line}\ny", other, other.upper(), f"{other}\n\n{line}", other])
    rows += [(12, f"{line}\nmore"), (12, f"{line}\nmore"), (None, f"{line}\n{line}"), (40, "short\nshort"), (41, "short"), (42, "short")]
    got = lines.dedup_lines(docs(rows))
    assert got.columns[:3] == ["doc_id", "text", "row"]
    taken = got.toDF("doc_id", "text", "row", "own", "leaks", "s", "n", "dropped").select("doc_id", "text", "n", "dropped").collect()
    assert sorted(map(tuple, taken), key=repr) == plain_lines(rows)
    assert lines.dedup_lines(docs([])).count() == 0


# token counts


def test_token_counts_are_the_library_s(spark, docs):
    tokenizers = pytest.importorskip("tokenizers")
    path = token_file("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    rng = random.Random(3)
    noise = ["".join(rng.choice("abé '’.,1²\n\t\u3000\x1c\x85🙂語the ") for _ in range(rng.randint(1, 80))) for _ in range(150)]
    rows = numbered([*ODD, "<|endoftext|>a<|endoftext|><|endoftext|>", "a" * 3000, "it's we'LL 'd", *noise, "x", "x"])
    got = counts.token_counts(docs(rows), path, limit=5).collect()
    assert [r.doc_id for r in got] == [i for i, _ in rows]
    for r, (_, t) in zip(got, rows, strict=True):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((t or "").encode()), n, n > 5), t
    assert counts.token_counts(docs([]), path).count() == 0


def test_only_proved_tokens_are_whole():
    ranks = {("a", "b"): 0, ("b", "c"): 1, ("ab", "c"): 2}
    assert counts.whole_tokens(["a", "ab", "bc", "abc", "ac"], ranks) == ["a", "ab", "bc", "abc"]
    rng = random.Random(5)
    for _ in range(50):
        word = [rng.choice("abc") for _ in range(rng.randint(65, 90))]
        short = word[:]
        while True:
            best = min(((ranks[p], i) for i, p in enumerate(zip(short, short[1:], strict=False)) if p in ranks), default=None)
            if best is None:
                break
            short[best[1] : best[1] + 2] = ["".join(short[best[1] : best[1] + 2])]
        assert counts.merge(word[:], ranks) == short


# pieces


def test_pieces_are_the_library_s_and_come_back(docs):
    sentencepiece = pytest.importorskip("sentencepiece")
    path = token_file("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(4)
    noise = ["".join(rng.choice("abcdeé .,\n▁th🙂語\x00") for _ in range(rng.randint(1, 120))) for _ in range(150)]
    rows = numbered([*ODD, "a" * 3000, "▁ ▁▁x", " ", "<s><0x41>", "aab" * 500, *noise])
    got = pieces.encode_decode(docs(rows), path).select("doc_id", "pieces.*").collect()
    for r, (_, t) in zip(got, rows, strict=True):
        assert r.ids == library.encode(t or "")
        assert r.decoded == library.decode(r.ids)
        assert r.decoded == (t or "").replace("▁", " ")
    assert pieces.encode_decode(docs([]), path).count() == 0


def test_streaming_search_is_the_whole_search():
    rng = random.Random(6)
    scores = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 4))): -rng.random() * 5 for _ in range(14)}
    search = pieces.Viterbi(pieces.Pieces({p: i for i, p in enumerate(scores)}, scores, [], [], 0, False))
    for _ in range(60):
        chars = "".join(rng.choice("abx" if rng.random() < 0.1 else "ab") for _ in range(rng.randint(1, 120)))
        best = [0.0] + [-math.inf] * len(chars)
        for i in range(1, len(chars) + 1):
            for j in range(max(0, i - 4), i):
                s = scores.get(chars[j:i], search.unknown_score if j == i - 1 else -math.inf)
                best[i] = max(best[i], best[j] + s)
        out = list(chain.from_iterable(search.stream([chars[:7], chars[7:]])))
        assert "".join(out) == chars
        assert math.isclose(sum(scores.get(p, search.unknown_score) for p in out), best[-1])


def test_streaming_search_keeps_a_window(monkeypatch):
    search = pieces.Viterbi(pieces.Pieces({"a": 0, "aa": 1}, {"a": -2.0, "aa": -1.0}, [], [], 0, True))
    widest = 0
    back = search._back

    def watched(window, *rest):
        nonlocal widest
        widest = max(widest, len(window))
        return back(window, *rest)

    monkeypatch.setattr(search, "_back", watched)
    commits = list(search.stream(["a" * 5001]))
    assert list(chain.from_iterable(commits)) == ["aa"] * 2500 + ["a"]
    assert widest <= 2 * search.longest and len(commits) > 1000


def test_every_character_goes_through_the_streaming_search(monkeypatch):
    sentencepiece = pytest.importorskip("sentencepiece")
    path = token_file("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    monkeypatch.setattr(pieces, "REMEMBERED_CHARS", 0)
    encoder = pieces.Encoder(pieces.read_model(path))
    rng = random.Random(8)
    prose = " ".join("".join(rng.choice("etaoinsrh") for _ in range(rng.randint(1, 9))) for _ in range(3000))
    solid = "".join(rng.choice("etaoinsrhlé") for _ in range(4000))
    for text in (prose, solid, solid + "\n\n" + prose[:500], " " * 700):
        before = encoder.search.streamed
        commits = list(encoder.search.stream([pieces.normalized(text)]))
        assert len(commits) > len(text) / (4 * encoder.search.longest)
        assert [encoder.pieces.ids[p] for c in commits for p in c if p in encoder.pieces.ids] == [
            i for i in library.encode(text) if i not in encoder.pieces.bytes_
        ]
        assert encoder.search.streamed - before == len(pieces.normalized(text))
        before = encoder.search.streamed
        assert np.frombuffer(encoder.encode(text), np.int32).tolist() == library.encode(text)
        assert encoder.search.streamed - before == len(pieces.normalized(text))


def test_encoding_holds_a_bounded_number_of_findings_and_texts(monkeypatch):
    path = token_file("piece_bpe_32k.model")
    for name, size in {"REMEMBERED": 64, "REMEMBERED_BEGUN": 64, "REMEMBERED_SEGMENTS": 32}.items():
        monkeypatch.setattr(pieces, name, size)
    plain, encoder = pieces.Encoder(pieces.read_model(path)), pieces.Encoder(pieces.read_model(path))
    plain.remembered.size = plain.search.stable.size = plain.search.begun.size = 1 << 30
    rng = random.Random(24)
    for i in range(300):
        line = f"hot {rng.randrange(10**6)} {''.join(rng.choice('abcdeé') for _ in range(9))}"
        before = encoder.search.streamed
        assert encoder.encode(line) == plain.encode(line)
        # what is asked for again and again is never forgotten
        assert i == 0 or encoder.search.streamed - before <= len(line) + 1 - len("▁hot")
    for found, size in ((encoder.remembered, 32), (encoder.search.stable, 64), (encoder.search.begun, 64)):
        assert len(found) <= size and len(found.old) <= size
    monkeypatch.setattr(text.blocks, "__defaults__", (64,))
    seen = []

    def lengths(texts):
        seen.append(len(texts))
        return pa.array([len(t) for t in texts], pa.int64())

    assert pieces._by_blocks(pa.array(["x" * 30] * 9 + ["y" * 200]), lengths).to_pylist() == [30] * 9 + [200]
    assert max(seen) == 2 and pieces._by_blocks(pa.array([], pa.string()), lengths).to_pylist() == []


# near duplicates


def shingles(t):
    w = (t or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain_near(rows, percent):
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, s), (b, t) in combinations(rows, 2):
        x, y = shingles(s), shingles(t)
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    return sorted((i, len(shingles(t)), find(i), find(i) == i) for i, t in rows)


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_are_the_plain_ones(docs, percent):
    rng = random.Random(8)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(120)]
    near_texts = []
    for _ in range(40):  # a group in which many copies are linked through others alone
        words = base[:]
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(120)] = f"n{rng.randint(0, 10**6)}"
        near_texts.append(" ".join(words))
    rows = numbered([*ODD, "ONE two three four five", "one two", "One  two", *near_texts, "y " * 400, "y " * 500])
    got = near.near_duplicates(docs(rows), percent).collect()
    assert sorted(map(tuple, got)) == plain_near(rows, percent)


def test_near_duplicates_without_ids_or_rows(docs):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (3, "a b c d e f"), (9, None)]
    got = Counter(map(tuple, near.near_duplicates(docs(rows)).collect()))
    assert got == {(None, 2, None, True): 2, (5, 2, 3, False): 2, (3, 2, 3, True): 1, (9, 0, 9, True): 1}
    assert near.near_duplicates(docs([])).count() == 0


def test_large_mixed_buckets_are_compared_in_blocks(docs, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 3)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(100)]
    texts = []
    for _ in range(30):
        words = base[:]
        for k in rng.sample(range(100), rng.randint(1, 5)):
            words[k] = f"n{rng.randint(0, 10**6)}"
        texts.append(" ".join(words))
    rows = numbered(texts)
    assert sorted(map(tuple, near.near_duplicates(docs(rows), 80).collect())) == plain_near(rows, 80)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(20)] + [(7, 7), (None, 3), (300, 200), (200, 300)]
    got = dict(map(tuple, components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(20)}, 200: 200, 300: 200}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# benchmark


def distance(window, whole):
    """Edits of the best place of a window in a text."""
    row = [0] * (len(whole) + 1)
    for i, a in enumerate(window, 1):
        fresh = [i]
        for j, b in enumerate(whole, 1):
            fresh.append(min(row[j - 1] + (a != b), row[j] + 1, fresh[-1] + 1))
        row = fresh
    return min(row)


def test_benchmark_passages_are_found_as_by_full_alignment(spark, docs):
    rng = random.Random(10)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))
    items = [(1, prose(40)), (2, prose(12)), (3, "tiny"), (None, prose(30)), (4, None), (1, prose(9)), (5, "exactly ten")]
    texts = [*ODD, prose(100), items[5][1]]
    for i in (0, 1, 0, 1, 0):
        for edits in (0, 2, 4, 6, 8, 12):
            passage = list(items[i][1])
            for _ in range(edits):
                at = rng.randrange(len(passage))
                kind = rng.randrange(3)
                passage[at : at + (kind != 0)] = [] if kind == 1 else [rng.choice("xyz")]
            texts.append(f"{prose(20)} {''.join(passage).upper()}! {prose(30)}")
    rows = numbered(texts)
    bench = spark.createDataFrame([(i, t, "own") for i, t in items], "item_id bigint, text string, leaks string")
    got = {r.doc_id: {x.item_id: x.edits for x in r.found} for r in decontaminate.find_benchmark(docs(rows).drop("leaks"), bench).select("doc_id", F.col("leaks").alias("found")).collect()}
    strip = lambda t: " ".join("".join(c if c.isalnum() else " " for c in (t or "").lower()).split())
    for i, t in rows:
        expected = {}
        for item, passage in items:
            if item is None or len(strip(passage)) < decontaminate.Q:
                continue
            for _, w in decontaminate.windows(strip(passage)):
                e = distance(w, strip(t))
                if e <= decontaminate.budget(len(w)):
                    expected[item] = min(e, expected.get(item, 99))
        assert got[i] == expected, t
    assert decontaminate.find_benchmark(docs([]).drop("leaks"), bench).count() == 0
    assert decontaminate.find_benchmark(docs(rows).drop("leaks"), bench.limit(0)).filter("size(leaks) > 0").count() == 0


def test_a_large_benchmark_is_searched_in_parts(spark, docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "INDEX_CHARS", 150)
    items = [(i, f"passage number {i} says that " + "abcdefghij"[i : i + 3] * 20) for i in range(6)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.find_benchmark(docs(items).drop("leaks"), bench).select("doc_id", "leaks.item_id").collect()
    assert all(r.doc_id in r.item_id for r in found) and len(found) == 6


# language


def made_up(rng, syllables, n):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n)).capitalize() + "."


def test_languages_are_told_apart_and_others_rejected(spark, docs):
    rng = random.Random(12)
    kinds = {"aa": ["tho", "ing", "re", "an"], "bb": ["sch", "ei", "ung", "ße"]}
    train = [(made_up(rng, s, rng.randint(3, 60)), k, 1) for k, s in kinds.items() for _ in range(60)]
    train += [(None, "aa", 1), ("text", None, 1), ("", "bb", 1), ("12 !!", "aa", 1)]
    model = lang.fit(spark.createDataFrame(train, "text string, lang string, h int"))
    assert model.languages == ["aa", "bb"]
    tests = [(made_up(rng, s, 30), k) for k, s in kinds.items() for _ in range(30)]
    rows = numbered([t for t, _ in tests] + [None, "", "123 ...", "Ελληνικά γράμματα είναι όμορφα και παλιά"])
    got = lang.identify(docs(rows), model).select("doc_id", "language.*").collect()
    right = [r.lang_pred == k and not r.rejected for r, (_, k) in zip(got, tests, strict=False)]
    assert all(right)
    assert [(r.lang_pred, r.score, r.rejected, r.cross_entropy) for r in got[60:63]] == [("und", 0.0, True, None)] * 3
    assert got[63].rejected and all(0 <= r.score <= 1 for r in got)
    empty = lang.fit(spark.createDataFrame([], "text string, lang string"))
    assert {r.lang_pred for r in lang.identify(docs(rows[:3]), empty).select("language.lang_pred").collect()} == {"und"}
    assert lang.identify(docs([]), model).count() == 0


def test_unseen_languages_are_rejected_and_known_ones_kept(spark, docs):
    rng = random.Random(15)
    kinds = {"aa": ["tho", "ing", "re", "an", "ed"], "bb": ["sch", "ei", "ung", "ße", "der"], "cc": ["que", "oir", "lé", "nou"]}
    train = [(made_up(rng, s, rng.randint(30, 90)), k) for k, s in kinds.items() if k != "cc" for _ in range(190)]
    # a few labels are wrong: they must not set the limits
    train += [(made_up(rng, kinds["bb"], 60), "aa") for _ in range(2)]
    model = lang.fit(spark.createDataFrame(train, "text string, lang string"))
    known = [made_up(rng, kinds[k], 40) for k in ("aa", "bb") for _ in range(150)]
    mixed = [made_up(rng, kinds["aa"], 50) + " " + made_up(rng, kinds["bb"], 3) for _ in range(20)]
    unseen = [made_up(rng, kinds["cc"], 40)[:100] for _ in range(100)]
    got = [r.rejected for r in lang.identify(docs(numbered(known + mixed + unseen)), model).select("language.rejected").collect()]
    assert sum(got[:300]) <= 3 and not any(got[300:320]) and sum(got[320:]) >= 90


def test_cross_entropies_are_those_of_a_plain_back_off():
    rng = random.Random(16)
    texts = {"aa": [made_up(rng, ["tho", "in", "é"], 12).lower()[:-1] for _ in range(6)], "bb": ["zu zu sch", "語 uu", "t"]}
    grams = {k: {g: (p, w) for g, p, w in lang.kneser_ney(t)} for k, t in texts.items()}
    rows = pd.DataFrame([(k, g, p, w) for k, seen in grams.items() for g, (p, w) in seen.items()], columns=["lang", "gram", "logp", "weight"])
    model = lang.assemble(rows)

    def plain(seen, text):
        padded, total = " " * (lang.ORDER - 1) + text, 0.0
        for i in range(len(text)):
            h, c = padded[i : i + lang.ORDER - 1], padded[i + lang.ORDER - 1]
            while h and seen.get(h + c, (None, None))[0] is None:
                total += seen.get(h, (None, None))[1] or 0.0
                h = h[1:]
            known = seen.get(h + c, (None, None))[0]
            total += known if known is not None else (seen[""][1] or 0.0) - math.log(lang.ALPHABET)
        return -total / max(len(text), 1)

    tests = ["thothoin é", "", "zu sch", "qqq 語", "t", "x" * 3000, texts["aa"][0] + " zu"]
    packed = [t.encode() for t in tests]
    got, lengths = lang.cross_entropies(model, np.frombuffer(b"".join(packed), np.uint8), np.cumsum([0, *map(len, packed)]))
    assert lengths.tolist() == [len(t) for t in tests]
    for i, t in enumerate(tests):
        for j, k in enumerate(model.languages):
            assert math.isclose(got[i, j], plain(grams[k], t), rel_tol=1e-4, abs_tol=1e-6)


def test_kneser_ney_sums_to_one():
    rows = {g: (p, w) for g, p, w in lang.kneser_ney(["abab", "abc", "ba"], 3)}
    letters = sorted({c for t in ("abab", "abc", "ba") for c in t} | {" "})
    for h in ("ab", "ba", "  "):
        total = 0.0
        for c in letters + ["?"]:
            weight, context = 1.0, h
            while context + c not in rows or rows[context + c][0] is None:
                weight *= math.exp(rows[context][1]) if context in rows and rows[context][1] is not None else 1.0
                if not context:
                    weight *= 1 / lang.ALPHABET
                    break
                context = context[1:]
            else:
                weight *= math.exp(rows[context + c][0])
            total += weight if c in letters and (c != " ") else weight * (lang.ALPHABET - len(letters)) if c == "?" else weight
        assert abs(total - 1) < 1e-6


# language model


def test_counts_and_base_scores_are_the_plain_ones(docs):
    rng = random.Random(14)
    rows = numbered([*ODD, *(" ".join(rng.choice(["the", "of", "Of", "x1", "x2", f"r{rng.randint(0, 99)}"]) for _ in range(rng.randint(1, 60))) for _ in range(60))])
    rows += [(3, "x"), (None, "the of")]
    learn = [r for r in rows if r[0] is not None and r[0] % 3]
    count = Counter(w for _, t in learn for w in [*(t or "").encode().lower().split(), None])
    total, words = sum(count.values()), len(count)
    got = lm.score(docs(rows), docs(learn)).collect()
    assert got[0].row == "own"
    plain = Counter()
    for i, t in rows:
        w = [*(t or "").encode().lower().split(), None]
        plain[i, len(w), sum(count[x] > 0 for x in w), total, round(sum(math.log10((count[x] + 1) / (total + words + 1)) for x in w), 6)] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == plain
    assert all(r.score <= 0 for r in got)
    nothing = lm.score(docs(rows[:3]), docs([])).collect()
    assert [(r.train_tokens, r.n_known, r.base_score) for r in nothing] == [(0, 0, 0.0)] * 3
    assert lm.score(docs([]), docs(learn)).count() == 0


def plain_scores(model, counts, texts):
    """log10 probabilities of texts, from the model's class probabilities, one token at a time."""
    end, rest = model.lookup.end, model.lookup.rest

    def class_of(word):
        found = [c for h1, h2, c in zip(model.lookup.h1, model.lookup.h2, model.lookup.classes, strict=True) if (h1, h2) == hashes(word)]
        return found[0] if found else rest

    def hashes(word):
        data = np.frombuffer(word, np.uint8)
        at = np.array([0]), np.array([len(word)])
        return text.span_hashes(data, *at)[0], text.second_hashes(data, *at)[0]

    def score(line):
        total, context = 0.0, [end, end]
        for word in [*line, None]:
            c = end if word is None else class_of(word)
            total += model.parameters.log_probabilities(np.array([context]))[0][c] / math.log(10)
            if c == rest:
                n = counts.get(word, 0)
                share = n - model.discount if n else model.discount * model.rest_words
                total += math.log10(share / model.rest_tokens) if model.rest_tokens else 0.0
            context = [context[1], c]
        return total

    return [score(t) for t in texts]


def test_scores_are_those_of_a_plain_loop_and_sum_to_one(docs, monkeypatch):
    monkeypatch.setattr(lm, "TOP", 3)
    rng = random.Random(18)
    learn = numbered([" ".join(rng.choice("abcde") for _ in range(rng.randint(0, 6))) for _ in range(80)])
    counts = Counter(w for _, t in learn for w in t.encode().split())
    model = lm.fit(docs(learn), lm.word_counts(docs(learn)))
    texts = ["", "a", "a b", "e d", "zz", "zz e a", None]
    got = {r.doc_id: r.score for r in lm.score(docs(numbered(texts)), docs(learn)).collect()}
    plain = plain_scores(model, counts, [(t or "").encode().split() for t in texts])
    assert [round(got[i], 4) for i in range(len(texts))] == [round(p, 4) for p in plain]
    # the next token is a known word, one never seen, or the end
    words = [*sorted(counts), b"zz"]
    for start in ([], [b"a"], [b"e", b"zz"]):
        ended, *longer = plain_scores(model, counts, [start, *([*start, w] for w in words)])
        heads = [s - e for s, e in zip(longer, ends_after(model, [[*start, w] for w in words], counts), strict=True)]
        whole = ended - ends_after(model, [start], counts)[0]
        total = sum(10 ** (h - whole) for h in heads) + 10 ** ends_after(model, [start], counts)[0]
        assert abs(total - 1) < 1e-4


def ends_after(model, lines, counts):
    """log10 of the chance of an end after each line."""
    return [plain_end(model, line, counts) for line in lines]


def plain_end(model, line, counts):
    context = [model.lookup.end, model.lookup.end]
    for word in line:
        data = np.frombuffer(word, np.uint8)
        h1 = text.span_hashes(data, np.array([0]), np.array([len(word)]))[0]
        at = np.flatnonzero(model.lookup.h1 == h1)
        context = [context[1], model.lookup.classes[at[0]] if len(at) else model.lookup.rest]
    return model.parameters.log_probabilities(np.array([context]))[0][model.lookup.end] / math.log(10)


def test_the_second_hash_is_no_function_of_the_first(spark):
    # words of equal first hashes: the powers of an odd base cancel over the Thue-Morse sequence
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    pair = [bytes(97 + b for b in bits), bytes(98 - b for b in bits)]
    data = np.frombuffer(b"".join(pair), np.uint8)
    starts, ends = np.array([0, 1024]), np.array([1024, 2048])
    first, second = text.span_hashes(data, starts, ends), text.second_hashes(data, starts, ends)
    assert first[0] == first[1] and second[0] != second[1]
    # a hash that goes on from another is a function of it; a line's second digest starts anew
    line = F.col("id").cast("string")
    rows = spark.range(50).select(*(d.alias(f"d{i}") for i, d in enumerate(lines._digest(line))), F.xxhash64(line, F.lit(7)).alias("chained"))
    assert rows.filter("d1 = d0 OR d1 = chained").count() == 0 and rows.select("d1").distinct().count() == 50


def test_model_learns_what_follows_what(docs):
    rng = random.Random(15)
    texts = [" ".join(["red", "blue", "green"][(k + i) % 3] for i in range(30)) for k in (rng.randint(0, 2) for _ in range(200))]
    other = " ".join(rng.choice(["red", "blue", "green"]) for _ in range(30))
    got = {r.doc_id: r for r in lm.score(docs(numbered([texts[0], other])), docs(numbered(texts))).collect()}
    assert got[0].score > got[0].base_score + 5 and got[0].score > got[1].score + 5


def test_words_beyond_the_top_ones_are_learned_in_context(docs, monkeypatch):
    monkeypatch.setattr(lm, "TOP", 2)
    rng = random.Random(21)
    ring = [f"w{i}" for i in range(12)]
    texts = [" ".join(ring[(k + i) % 12] for i in range(24)) for k in (rng.randrange(12) for _ in range(200))]
    mixed = " ".join(rng.sample([w for w in ring for _ in range(2)], 24))
    got = {r.doc_id: r for r in lm.score(docs(numbered([texts[0], mixed])), docs(numbered(texts))).collect()}
    assert sorted(texts[0].split()) == sorted(mixed.split()) and got[0].score > got[0].base_score + 5 and got[0].score > got[1].score + 5


def test_scores_over_words_with_parameters_bins_and_unseen_words_sum_to_one(docs, monkeypatch):
    for name, value in {"TOP": 3, "FREQUENT": 30, "BIN_WORDS": 4}.items():
        monkeypatch.setattr(lm, name, value)
    rng = random.Random(22)
    # 20 words often, 40 of about eight times, which are too many for tasks, 20 once
    words = [w for n, k in ((20, 30), (40, 8), (20, 1)) for i in range(n) for w in [f"v{n}k{k}i{i}"] * k]
    rng.shuffle(words)
    learn = docs(numbered([" ".join(words[i : i + 10]) for i in range(0, len(words), 10)])).coalesce(1)
    model = lm.fit(learn, lm.word_counts(learn))
    assert len(model.lookup.h1) == 20 and model.lookup.bits == 3 and model.bin_words.sum() == 60
    tried = [*sorted(set(words)), "never"]
    got = {r.doc_id: r.score for r in lm.score(docs(numbered(tried)), learn).collect()}
    total = 10 ** lm.score(docs(numbered([""])), learn).first().score
    for i, word in enumerate(tried):
        data = np.frombuffer(word.encode(), np.uint8)
        at = np.array([0]), np.array([len(data)])
        own = lm._classes(model.lookup, text.span_hashes(data, *at), text.second_hashes(data, *at))[0][0]
        end = model.parameters.log_probabilities(np.array([[model.lookup.end, own]]))[0][model.lookup.end] / math.log(10)
        total += 10 ** (got[i] - end)
    assert abs(total - 1) < 1e-3


def test_steps_of_the_tree_make_the_probabilities_of_all_classes(monkeypatch):
    monkeypatch.setattr(lm, "LEAVES", 16)
    monkeypatch.setattr(lm, "GROUPS", 2)
    draw = np.random.default_rng(23)
    p = lm.Parameters.start(draw.random(100) + 0.01, 3)
    p.word += draw.standard_normal(p.word.shape).astype(np.float32)
    contexts = draw.integers(0, 100, (5, 2))
    table = p.log_probabilities(contexts)
    assert table.shape == (5, 100) and np.allclose(np.exp(table).sum(axis=1), 1, atol=1e-5)
    at, classes = draw.integers(0, 5, 400), draw.integers(0, 100, 400)
    unseen = draw.random(8)
    got, part = p.chosen(contexts, at, classes, unseen)
    assert np.allclose(got, table[at, classes], atol=1e-4)
    bins = (classes > 3) & (classes < 12)
    assert np.allclose((got + part)[bins], np.log(np.exp(table[at, 4:12]) @ unseen)[bins], atol=1e-4)


def test_top_words_are_found_among_words_of_equal_counts(docs, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 4)
    learn = docs(numbered([" ".join(f"e{i}" for i in range(20))] * 3))
    assert len(lm.fit(learn, lm.word_counts(learn)).lookup.h1) == 20


def test_parameters_of_tasks_are_averaged_from_narrow_records(monkeypatch):
    monkeypatch.setattr(lm, "STEPS", 6)
    monkeypatch.setattr(lm, "EXAMPLES", 300)
    monkeypatch.setattr(lm, "BATCH", 150)
    shares = np.arange(1.0, 41) / np.arange(1.0, 41).sum()
    # no word is known, so all are dealt to 32 bins beyond the top
    lookup = lm.Lookup(*(np.zeros(0, x) for x in (np.uint64, np.uint64, np.int64, np.int64)), 3, 4, 9, 5)
    made, plain = [], lm.train
    monkeypatch.setattr(lm, "train", lambda *a, **k: made.append(plain(*a, **k)) or made[-1])
    monkeypatch.setattr(text.blocks, "__defaults__", (1000,))
    rng = random.Random(25)
    tasks = [[" ".join(f"w{rng.randrange(99)}" for _ in range(60)) for _ in range(n)] for n in (8, 23)]
    shared = type("Shared", (), {"value": (lookup, shares, 3)})
    out = [list(lm._trainer(shared)(iter([pa.RecordBatch.from_arrays([pa.array(x)], ["text"])]))) for x in tasks]
    # later examples of a task go over once: its first ones have made the updates that it needs
    assert len(made) == 4 and min(made[:2]) >= 6 > max(made[2:])
    assert all(b.nbytes < 110 * sum(b.column("at").value_lengths().to_pylist()) for x in out for b in x)
    totals, weights = np.zeros((2000, lm.DIM)), np.zeros((2000, 1))
    for batch in chain.from_iterable(out):
        for r in batch.to_pylist():
            assert {x // lm.AVERAGED for x in r["at"]} == {r["block"]}
            w = np.array(r["weight"])[:, None]
            totals[r["at"]] += np.array(r["row"]).reshape(-1, lm.DIM) * w
            weights[r["at"]] += w
    got = {x: v for b in lm._average(chain.from_iterable(out)) for r in b.to_pylist() for x, v in zip(r["at"], np.array(r["row"]).reshape(-1, lm.DIM), strict=True)}
    assert sorted(got) == np.flatnonzero(weights).tolist()
    assert all(np.allclose(v, totals[x] / weights[x], atol=1e-5) for x, v in got.items())
    p = lm.Parameters.start(shares, 3)
    same = p.replaced(np.arange(len(p.whole())), p.whole())
    assert all((a == b).all() for a, b in zip(p.parts(), same.parts(), strict=True))


def test_hashes_are_the_plain_ones_and_made_in_small_arrays():
    def plain(word):
        total = sum((b + 1) * pow(int(text._P1), i, 1 << 64) for i, b in enumerate(word)) + len(word) * int(text._P2)
        places = text.mix(np.arange(len(word), dtype=np.uint64) * text._P1 + text._P2).tolist()
        other = sum(int(text._RANDOM[b]) ^ p for b, p in zip(word, places, strict=True)) * int(text._P1) + len(word)
        return [int(text.mix(np.array([x % (1 << 64)], np.uint64))[0]) for x in (total, other)]

    rng = random.Random(26)
    words = [bytes(rng.randrange(33, 256) for _ in range(n)) for n in (1, text.SHORT, text.SHORT + 1, 70_000, 3, 40_000, 40_000, 200)]
    words += [bytes(rng.randrange(33, 256) for _ in range(rng.randint(1, 12))) for _ in range(20_000)]
    data = np.frombuffer(b" ".join(words), np.uint8)
    starts, ends, _ = text.word_spans(data, np.array([0, len(data)]))
    got = text.span_hashes(data, starts, ends), text.second_hashes(data, starts, ends)
    for i in [*range(2000), *range(len(words) - 2000, len(words))]:
        assert [int(x[i]) for x in got] == plain(words[i])
    # no array of eight bytes for each byte of a whole block, one after the other: that is slow, as it leaves the cache
    data = np.frombuffer(b"abcdefghi " * 100_000, np.uint8)
    starts = np.arange(0, len(data), 10)
    for hashes in (text.span_hashes, text.second_hashes):
        tracemalloc.start()
        hashes(data, starts, starts + 9)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 8 * len(data)


def test_words_are_found_by_their_hashes_however_those_are_spread():
    draw = np.random.default_rng(27)
    spread, near = draw.integers(0, 1 << 63, 3000).astype(np.uint64) * np.uint64(2), np.arange(500, dtype=np.uint64) * np.uint64(2)
    for h1 in (spread, near, np.append(spread, near), spread[:1], np.array([0, 2**64 - 2], np.uint64)):
        h1 = np.unique(h1)
        lookup = lm.Lookup(h1, text.mix(h1), np.ones(len(h1), np.int64), np.arange(len(h1)), 0, 0, 0)
        tried = np.concatenate([h1, h1 + np.uint64(1), h1])
        second = np.concatenate([text.mix(h1), text.mix(h1), h1 * np.uint64(3) + np.uint64(1)])
        at, found = lookup.find(tried, second)
        assert found.tolist() == [True] * len(h1) + [False] * 2 * len(h1) and (at[found] == np.arange(len(h1))).all()


def test_gradients_of_a_row_are_added_up_however_many_it_has():
    draw = np.random.default_rng(28)
    rows = np.concatenate([np.full(3000, 7), np.repeat(np.arange(20, 60), np.arange(40)), [5], draw.integers(100, 400, 500)])
    draw.shuffle(rows)
    grads = draw.standard_normal((len(rows), lm.DIM)).astype(np.float32)
    whole = np.zeros((400, lm.DIM))
    np.add.at(whole, rows, grads.astype(np.float64))
    distinct = sorted(set(rows.tolist()))
    for at, got in (lm._added(rows, grads), lm._added(rows.astype(np.int16), grads), lm._added_apart(rows, grads.copy(), 400)):
        assert sorted(at.tolist()) == distinct and np.allclose(got, whole[at], atol=1e-3)
    x, squares = np.ones((400, lm.DIM), np.float32), np.full((400, lm.DIM), 1e-6, np.float32)
    lm._ascend(x, squares, at, got.copy(), 0.1)
    assert np.allclose(squares[at], 1e-6 + got * got) and np.allclose(x[at], 1 + 0.1 * got / np.sqrt(squares[at]), atol=1e-6)
    rest = np.setdiff1d(np.arange(400), at)
    assert (x[rest] == 1).all() and (squares[rest] == np.float32(1e-6)).all()


def test_words_of_equal_first_hashes_are_counted_apart():
    h1, h2 = np.array([9, 4, 9, 4, 9], np.uint64), np.array([2, 1, 1, 1, 2], np.uint64)
    assert [x.tolist() for x in lm._summed(h1, h2, np.ones(5, np.int64))] == [[4, 9, 9], [1, 1, 2], [2, 1, 2]]


def test_large_logits_do_not_overflow():
    p = lm.Parameters.start(np.array([0.5, 0.3, 0.2]))
    p.word *= 4000
    p.context *= 50
    got, _ = p.chosen(np.array([[0, 1], [2, 2]]), np.array([0, 0, 0, 1, 1, 1]), np.array([0, 1, 2] * 2), np.zeros(0))
    assert np.isfinite(got).all() and np.allclose(np.exp(got).reshape(2, 3).sum(axis=1), 1, atol=1e-3)


def test_class_probabilities_sum_to_one():
    p = lm.Parameters.start(np.array([0.5, 0.3, 0.2]))
    assert np.allclose(np.exp(p.log_probabilities(np.array([[0, 1], [2, 2]]))).sum(axis=1), 1, atol=1e-5)


# toxicity


def test_offending_sentences_are_learned_from_documents(spark, docs):
    rng = random.Random(16)
    clean = lambda: " ".join(rng.choice(["tree", "house", "walk", "green", "über"]) for _ in range(6))
    rows, labels = [], []
    for i in range(300):
        bad = i % 5 == 0
        sentences = [clean() for _ in range(5)] + ([f"{clean()} {rng.choice(['scum', 'loserish', 'loserdom'])}"] if bad else [])
        rng.shuffle(sentences)
        rows.append((i, ". ".join(sentences) + "."))
        labels.append((i, int(bad)))
    labels += [(0, 1), (1, None), (None, 1), (2, 7)]
    model = toxic.fit(docs(rows[:250]), spark.createDataFrame(labels, "doc_id bigint, label int"))
    tests = [*rows[250:], (900, None), (901, ""), (902, "tree. green house scum! walk"), (903, "loserhood tree"), (904, "." * 100)]
    got = {r.doc_id: r for r in toxic.score(docs(tests), model).select("doc_id", "toxicity.*").collect()}
    assert all((got[i].score >= 0.3) == (i % 5 == 0) for i in range(250, 300))
    assert got[900].score == got[901].score == 0.0 and got[903].score >= 0.3
    assert [(o.start, o.end) for o in got[902].offending] == [(5, 23)]
    none = toxic.fit(docs(rows[:5]), spark.createDataFrame([], "doc_id bigint, label int"))
    assert all(r.score < 0.01 for r in toxic.score(docs(rows), none).select("toxicity.score").collect())
    assert toxic.score(docs([]), model).count() == 0
