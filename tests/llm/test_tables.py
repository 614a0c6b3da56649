"""Vectors, urls, the queries and the pipeline."""

from __future__ import annotations

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from wordtide.llm import ann, graphs, queries, sql, urls

FOLDER = os.environ.get("WORDTIDE_TABLES", entry.SMOKE_FOLDER)
tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason=f"{FOLDER} is not there")


def exact(rows, asked, k):
    out = []
    for q, own in asked:
        others = sorted((-float(np.dot(np.float64(v), np.float64(own))), i) for i, v in rows if i != q and len(v) == len(own))
        out += [(q, r + 1, i, round(-s, 9)) for r, (s, i) in enumerate(others[:k])]
    return sorted(out)


def test_few_vectors_are_ranked_exactly(spark):
    good = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (4, [-1.0, 3.0]), (6, [1.0, 0.0]), (20, [0.5, 0.5]), (7, [1.0, 2.0, 3.0])]
    bad = [(8, None), (9, []), (10, [0.0, 0.0]), (11, [1.0, None]), (12, [float("nan"), 1.0]), (13, [float("inf"), 1.0]), (None, [1.0, 1.0])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in good + bad + good[:2]], "vec_id bigint, vector array<float>, dim string")
    got = ann.nearest(frame, frame, k=3)
    assert sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in got.collect()) == exact(good, good, 3)
    assert ann.nearest(frame.limit(0), frame, k=3).count() == 0
    assert ann.nearest(frame, frame.limit(0), k=3).count() == 0


def test_vectors_of_any_length_are_found(spark):
    draw = np.random.Generator(np.random.PCG64(3))
    vectors = draw.standard_normal((3000, 12))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    longer = {5: 1e4, 77: 1e20, 78: 1e20, 400: 1e-20, 401: 1e200, 900: 1e-200}
    for i, size in longer.items():
        vectors[i] *= size
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id bigint, vector array<double>")
    got = ann.nearest(frame, frame.filter("vec_id % 20 = 0 OR vec_id IN (77, 401)"), k=10, rows_per_shard=700).collect()
    found = {(r.query_id, r.rank): r for r in got}
    hits = total = 0
    for q in [*range(0, 3000, 20), 77, 401]:
        scores = (vectors * vectors[q]).sum(axis=1)
        scores[q] = -np.inf
        best = np.lexsort((np.arange(3000), -scores))[:10]
        mine = [found[q, k].vec_id for k in range(1, 11)]
        assert [found[q, k].score for k in range(1, 11)] == [scores[i] for i in mine]
        hits, total = hits + len(set(mine) & set(best.tolist())), total + 10
    assert hits >= 0.95 * total


def test_shards_of_many_vectors_reach_the_nearest(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((1500, 16)) * rng.uniform(0.2, 2, (1500, 1))
    x[100:700] = x[100]  # a very common vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id bigint, vector array<double>")
    got = ann.nearest(frame, frame.filter("vec_id % 20 = 0"), k=10, rows_per_shard=400, queries_per_block=30).collect()
    want = exact(rows, [r for r in rows if r[0] % 20 == 0], 10)
    assert len(got) == len(want) == 750
    found = {(r.query_id, r.vec_id) for r in got}
    assert sum((q, v) in found for q, _, v, _ in want) / len(want) >= 0.95


def test_layers_are_prefixes_of_flat_neighbours():
    graph = graphs.build(np.random.default_rng(1).standard_normal((2000, 8)))
    assert [len(x) for x in graph.layers] == sorted((len(x) for x in graph.layers), reverse=True)
    assert all(x.max() < len(x) for x in graph.layers) and graph.layers[0].shape == (2000, 2 * graphs.LINKS)


def plain_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:cut].translate({c: c + 32 for c in range(65, 91)}), rest[cut:].split("#")[0].split("?")[0]
    fits = [(len(h), len(p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


@pytest.mark.parametrize("per_bucket", [10_000, 7])
def test_urls_get_the_longest_rule(spark, per_bucket):
    rng = random.Random(2)
    rules = [*queries.URL_RULES, ("a.example.net", "/", "block"), ("a.example.net", "/en/x", "allow"), ("ünet", "/", "block"), ("net", "/en", "allow")]
    made = [f"{rng.choice(['http', 'HTTPS'])}://{rng.choice(['', 'a.', 'b.a.', 'x'])}{rng.choice(['Example.NET', 'example.com', 'net', 'org', 'ünet', 'example.com:80'])}{rng.choice(['', '/', '/en/', '/en/x/y', '/de/1', '/fr/?q=/de/', '#/en/', '?x'])}" for _ in range(300)]
    urls_ = [*made, None, "", "no scheme", "://", "x://net", "http://.net/", "http://net./", "a://b://net/", *["http://hot.example.com/de/1"] * 200]
    frame = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(urls_)], "page_id bigint, url string, rule string, bucket int")
    table = spark.createDataFrame([*rules, (None, "/", "block"), ("com", None, "block"), ("", "/", "block"), rules[0]], "host string, path string, verdict string")
    got = {r.page_id: tuple(r)[1:] for r in urls.url_filter(frame, table, rows_per_bucket=per_bucket).collect()}
    assert got == {i: plain_verdict(u, rules) for i, u in enumerate(urls_)}
    assert urls.url_filter(frame.limit(0), table).count() == 0
    assert urls.url_filter(frame, table.limit(0)).filter("verdict = 'allow' AND rule IS NULL").count() == len(urls_)


@tables
@pytest.mark.parametrize("name", sorted(sql.ORACLE))
def test_query_equals_its_twin(spark, name):
    duckdb = pytest.importorskip("duckdb").connect()
    for t in ("documents", "pages"):
        duckdb.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    got = entry.queries()[name](spark, FOLDER)
    listed = ", ".join(sorted(got.columns))
    expected = duckdb.sql(f"SELECT {listed} FROM ({sql.ORACLE[name]})").fetchall()
    assert sorted(map(tuple, got.select(*sorted(got.columns)).collect()), key=repr) == sorted(expected, key=repr)


@tables
def test_held_out_documents_are_judged_right(spark):
    names = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    judged = entry.queries()["op3_language_id"](spark, FOLDER).filter("held_out").join(names, "doc_id")
    assert judged.filter("lang = lang_pred").count() >= 0.97 * judged.count()
    scored = entry.queries()["op6_lm_scoring"](spark, FOLDER).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert scored[0] > scored[1]


@tables
def test_pipeline_keeps_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    extra = docs.withColumn("row", F.lit(1)).withColumn("leaks", F.lit("x")).withColumn("language", F.lit("y"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, extra, FOLDER)
        assert kept.columns == extra.columns and 0.8 * docs.count() < kept.count() <= docs.count()
        assert stage(spark, extra.limit(0), FOLDER).count() == 0
    final = corpus_pipeline.run(spark, FOLDER)
    assert final.columns == ["doc_id", "ids", "n_pieces", "text"]
    assert 0.8 * docs.count() < final.count() < docs.count()


def test_every_numbered_operator_has_a_query():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 11)}
    assert "pipeline" in entry.queries() and not set(entry.oracle_sql()) - set(entry.queries())
