"""Spelling variants, shards and collocations, each against a plain version."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from wordtide.llm import phrases, sharding, spelling

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = ["", None, " \n\t ", "Ähnlich ähnlich ähnliche", "x" * 200, "naïve÷×façade" * 2]


def one_edit(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows):
    seen = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UP)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= 7:
                seen[run] += 1
    n = {w: c for w, c in seen.items() if c >= 2}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best and n[best] >= 10 * n[w]:
            form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def test_variants_equal_a_plain_search(spark):
    draw = random.Random(5)
    stems = ["".join(draw.choices("abé", k=draw.randint(7, 9))) for _ in range(25)]
    long = "".join(draw.choices("ab", k=spelling.TRIE_CHARS - 1))
    stems += [long, long + "a", long + "ab", long + "abc", "aaaaaaa", "aaaaaaaa", "c" * 3000, "c" * 1500 + "d" + "c" * 1499]
    rows = [(i, " ".join(draw.choices(stems, [3**(-k % 5) for k in range(len(stems))], k=60))) for i in range(60)]
    rows += [(None, rows[0][1]), (7, "X" + rows[1][1]), (7, rows[2][1]), *enumerate(ODD)]
    docs = spark.createDataFrame([(i, t, "own", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    got = [tuple(r) for r in spelling.spelling_variants(docs).collect()]
    want = plain_variants(rows)
    assert len(got) == len(set(got)) and set(got) == want
    assert any(r[1] for r in want) and any(r[4] > 1 for r in want)


def test_variants_of_nothing_and_chains_of_forms(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    words = spark.createDataFrame([("aaaaaaa", 1), ("aaaaaab", 10), ("aaaaabb", 100), ("aaaabbb", 1000), (None, 5), ("zzzzzzz", 3)], "word string, n long")
    got = {r.word: (r.form, r.root, r.n_near, r.form_n) for r in spelling.variants(words).collect()}
    assert got["aaaaaaa"] == ("aaaaaab", "aaaabbb", 1, 10) and got["aaaaabb"] == ("aaaabbb", "aaaabbb", 2, 1000)
    assert got["zzzzzzz"] == (None, "zzzzzzz", 0, None) and len(got) == 5


def test_crc32_of_spans():
    words = [b"", b"a", b"abc" * 90, "é".encode() * 3]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    states = np.array([zlib.crc32(b"%d:" % i) for i in range(4)])
    got = spelling.crc32_after(states, data, ends - [len(w) for w in words], ends)
    assert got.tolist() == [zlib.crc32(b"%d:" % i + w) for i, w in enumerate(words)]


def shards_of(spark, rows, shards=8):
    docs = spark.createDataFrame([(i, t, 9, "own") for i, t in rows], "doc_id long, text string, shard int, link string")
    got = sharding.shard_documents(docs, shards).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    slots, loads, groups = defaultdict(list), [0] * shards, defaultdict(Counter)
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        loads[r.shard] += r["size"]
        groups[r["size"], r.text_crc32][r.shard] += 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return loads, groups


def test_shards_are_even_and_keep_copies_together(spark):
    draw = random.Random(2)
    rows = [(i, f"single {i} " * draw.randint(1, 60)) for i in range(600)]
    rows += [(1000 + i, f"copy {i // 4} " * 9) for i in range(400)] + [(None, "single"), (None, None), (5, "")]
    loads, groups = shards_of(spark, rows)
    assert max(loads) - min(loads) <= 2 * 60 * 11
    assert all(len(g) == 1 for g in groups.values())


def test_a_link_larger_than_a_shard_fills_one_after_the_other(spark):
    rows = [(i, "hot" * 30) for i in range(400)] + [(1000 + i, f"single {i:04d} " * 7) for i in range(800)]
    loads, groups = shards_of(spark, rows)
    assert max(loads) - min(loads) <= 400
    held = max(groups.values(), key=lambda g: sum(g.values())).most_common()
    assert sum(n for _, n in held[:4]) >= 0.9 * 400  # 3 shards could just hold them


def test_shards_of_linked_documents_alone_one_large_one_and_none(spark):
    loads, groups = shards_of(spark, [(i, f"{i // 5:03d}") for i in range(500)])
    assert max(loads) - min(loads) <= 16 and sum(len(g) == 1 for g in groups.values()) >= 50
    loads, _ = shards_of(spark, [(1, "x" * 5000), (2, "a"), (3, "b"), (3, "c")], 2)
    assert sorted(loads) == [6, 5001]
    assert shards_of(spark, [(1, "same"), (1, "same")], 1)[0] == [10]
    assert sharding.shard_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_bundles_never_pass_the_quota():
    draw = random.Random(4)
    wanted = [(s, d, sc, b, draw.randint(1, 50)) for s in range(4) for d in range(4) for sc in range(3) for b in range(4) if s != d]
    loads = [400] * 4
    taken = sharding._accepted(wanted, loads, 500)
    size = {w[:4]: w[4] for w in wanted}
    again = [400] * 4
    for t in taken:
        again[t[0]] -= size[t]
        again[t[1]] += size[t]
    assert taken and again == loads and max(loads) <= 500


def plain_phrases(rows, least, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UP)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i : i + k])] += 1
    out = set()
    for lang, counts in f.items():
        kept = []
        for p, a in counts.items():
            if len(p) < 2 or a < least:
                continue
            if any(len(q) > len(p) and c >= least and 100 * c >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, c in counts.items()):
                continue
            s, k = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-s, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.add((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_phrases_equal_a_plain_count(spark, monkeypatch, small):
    if small:  # containers burst, tries spill, runs of a part come in several pieces
        for name, value in {"BURST": 16, "ENTRIES": 200, "MERGE_NODES": 40, "LEAST_PARTS": 8}.items():
            monkeypatch.setattr(phrases, name, value)
    draw = random.Random(6)
    vocabulary = [*"abcdefgh", "Ünd", "über", "\x00", "a\x1c"]
    rows = [(draw.choice(["en", "de", None, "und"]), "".join(draw.choice(vocabulary) + draw.choice(["  ", " ", "\t", " ", ", ", "\x0b"]) for _ in range(60))) for _ in range(120)]
    rows += [("en", t) for t in ODD] + [rows[0]] * 3
    docs = spark.createDataFrame([(*r, "own", 3) for r in rows], "lang string, text string, phrase string, n int").repartition(3)
    got = [tuple(r) for r in phrases.collocations(docs, least=8, top=40).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_phrases(rows, 8, 40)


def test_phrases_of_nothing_and_of_one_long_text(spark):
    schema = "lang string, text string"
    assert phrases.collocations(spark.createDataFrame([], schema)).count() == 0
    assert phrases.collocations(spark.createDataFrame([("en", "a b " * 10)], schema)).count() == 0
    text = "one two three. " * 200_000
    got = [tuple(r) for r in phrases.collocations(spark.createDataFrame([("en", text)], schema)).collect()]
    n = 200_000
    assert got == [("en", 1, "one two three", n, n, n, 3 * n, 1_000_000)]


def test_equal_hashes_do_not_part_counts(monkeypatch):
    monkeypatch.setattr(phrases, "mix", lambda x: x * np.uint64(0))
    keys = [np.array(x, np.int64) for x in ([0, 1, 0, 1], [5, 5, 5, 5], [1, 1, 1, 2])]
    got = phrases._grouped(keys, np.array([1, 2, 4, 8]))
    assert sorted(zip(*(x.tolist() for x in got), strict=True)) == [(0, 5, 1, 5), (1, 5, 1, 2), (1, 5, 2, 8)]


def test_long_texts_are_cut_between_pieces():
    texts = ["a b", "c d. " * 50 + "e", "", "f"]
    data, offsets = phrases.flat(pa.array(texts))
    got = defaultdict(bytes)
    for ahead, part, ends in phrases._slices(data, offsets, 16):
        for i in range(len(ends) - 1):
            got[ahead + i] += part[ends[i] : ends[i + 1]].tobytes()
    assert [got[i].decode() for i in range(4)] == texts
