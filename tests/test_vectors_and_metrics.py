import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lingofold.operators import embed, lookup, metrics, sampling
from lingofold.operators import vector_search as vs
from lingofold.operators.inference import dispatch_batches
from lingofold.plans import jobs


def frame(spark, vectors, name="id"):
    return spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(vectors)], f"{name} bigint, vector array<double>")


TRIPLE = [(1, 0), (0, 1), (0.6, 0.8)], [(0.8, 0.6), (0, 1), (1, 0)]


def test_margin_fixture(spark):
    a, b = TRIPLE
    one, two = frame(spark, a), frame(spark, b)
    fwd = vs.knn(one.withColumnRenamed("id", "query_id"), two, 2)
    bwd = vs.knn(two.withColumnRenamed("id", "query_id"), one, 2)
    near = {}
    for r in fwd.orderBy("query_id", "rank").collect():
        near.setdefault(r.query_id, []).append(r.id)
    assert near == {0: [2, 0], 1: [1, 0], 2: [0, 1]}
    mass = {r.query_id: r.mass for r in vs.neighbour_mass(fwd, 2).collect()}
    assert [mass[i] for i in range(3)] == pytest.approx([0.45, 0.40, 0.44])
    mass = {r.query_id: r.mass for r in vs.neighbour_mass(bwd, 2).collect()}
    assert [mass[i] for i in range(3)] == pytest.approx([0.44, 0.45, 0.40])
    margins = {(r.query_id, r["rank"]): r.margin for r in vs.margin_candidates(fwd, bwd, 2).collect()}
    want = [1.176471, 0.898876, 1.176471, 0.714286, 1.090909, 0.898876]
    assert [margins[q, k] for q in range(3) for k in (1, 2)] == pytest.approx(want, abs=1e-6)
    picks, accuracy = jobs.mine_bitext(one, two, 2)
    assert {r.query_id: r.id for r in picks.collect()} == {0: 2, 1: 1, 2: 0}
    assert accuracy.first().margin_accuracy == pytest.approx(1 / 3)


@pytest.mark.parametrize("block_rows", [7, 64, 4096, None])
def test_knn_equals_brute_force_with_many_equal_rows(spark, block_rows):
    """Small blocks use the block job, ``None`` the scan with broadcast queries."""
    rng = np.random.default_rng(5)
    corpus = rng.normal(size=(90, 8))
    corpus[30:60] = corpus[0]
    queries = rng.normal(size=(23, 8))
    queries[3] = corpus[0]
    got = {}
    for r in vs.knn(frame(spark, queries, "query_id"), frame(spark, corpus), 5, block_rows).collect():
        got[r.query_id, r["rank"]] = r.id
    scores = np.round(queries @ corpus.T, 9)
    for q in range(23):
        want = sorted(range(90), key=lambda i: (-scores[q, i], i))[:5]
        assert [got[q, k + 1] for k in range(5)] == want


def test_fewer_rows_than_k(spark):
    got = vs.knn(frame(spark, [(1, 0)], "query_id"), frame(spark, [(1, 0), (0, 1)]), 5).collect()
    assert sorted(r["rank"] for r in got) == [1, 2]


def test_ann_recall(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    rows = np.vstack([c + 0.2 * rng.normal(size=(40, 16)) for c in centres])
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    corpus = frame(spark, rows).cache()
    queries = corpus.withColumnRenamed("id", "query_id")
    exact = vs.knn(queries, corpus, 5)
    found = vs.ann_knn(queries, corpus, 5, probes=4, n_cells=12, block_rows=16)
    report = vs.recall_report(found, exact).first()
    assert report.n_exact == 480 * 5 and report.recall >= 0.9
    every = vs.ann_knn(queries, corpus, 5, probes=12, n_cells=12, block_rows=16)
    assert vs.recall_report(every, exact).first().recall == 1.0


def clustered(n, per, dims, spread, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n, dims))
    rows = np.vstack([c + spread * rng.normal(size=(per, dims)) for c in centres])
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def test_exact_search_leaves_out_cells(spark):
    rows = clustered(12, 60, 24, 0.05)
    rows[100:130] = rows[100]  # ties
    corpus, queries = frame(spark, rows).cache(), frame(spark, rows[::7], "query_id").cache()
    got = {(r.query_id, r["rank"]): r.id for r in vs.knn(queries, corpus, 5, block_rows=40).collect()}
    scores = np.round(rows[::7] @ rows.T, 9)
    for q in range(len(scores)):
        want = sorted(range(len(rows)), key=lambda i: (-scores[q, i], i))[:5]
        assert [got[q, k + 1] for k in range(5)] == want
    centres = vs.fit_cells(corpus, 18)
    placed, asking = vs._nearest_cells(corpus, "id", centres, 1), vs._nearest_cells(queries, "query_id", centres, 1)
    near = vs._search_cells(asking, placed, 5, 40)
    visits = vs.other_cells(asking, placed, near, centres, 5)
    sizes = placed.groupBy("cell").count()
    met = asking.select("cell").unionByName(visits.select("cell")).join(sizes, "cell").agg(F.sum("count")).first()[0]
    assert met < 0.4 * len(rows[::7]) * len(rows)
    # a query with fewer neighbours than wanted asks every cell
    every = vs.other_cells(asking, placed, near, centres, 1000)
    assert every.count() == queries.count() * (placed.select("cell").distinct().count() - 1)


def test_exact_search_by_cells_with_repeated_ids(spark):
    rows = clustered(5, 30, 8, 0.2)
    ids = np.arange(len(rows)) // 3
    corpus = spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, rows)], "id bigint, vector array<double>")
    queries = corpus.withColumnRenamed("id", "query_id").where("query_id % 4 = 0")
    blocks = vs.knn(queries, corpus, 3, block_rows=16, repeated=True).collect()
    scan = vs.knn(queries, corpus, 3, repeated=True).collect()
    assert sorted(map(tuple, blocks)) == sorted(map(tuple, scan)) and blocks


def test_compressed_search(spark):
    rows = clustered(12, 40, 18, 0.3)  # 18 numbers are four and a half parts
    corpus = frame(spark, rows).cache()
    queries = corpus.withColumnRenamed("id", "query_id")
    index = vs.build_codes(corpus, n_cells=8, values=64)
    sizes = index.codes.select(F.length("code").alias("n")).distinct().collect()
    assert [r.n for r in sizes] == [5] and index.codes.count() == 480
    found = vs.compressed_knn(queries, corpus, index, 10, probes=5, block_rows=32)
    exact = vs.knn(queries, corpus, 10)
    assert vs.recall_report(found, exact).first().recall >= 0.9
    scores = np.round(rows @ rows.T, 9)
    assert all(r.score == pytest.approx(scores[r.query_id, r.id], abs=2e-9) for r in found.collect())
    # with every row scored again the result is exact
    whole = vs.compressed_knn(queries, corpus, index, 10, probes=8, refine=48)
    assert vs.recall_report(whole, exact).first().recall == 1.0
    odd = corpus.unionByName(spark.createDataFrame([(900, [1.0]), (901, None)], corpus.schema))
    assert vs.build_codes(odd, n_cells=4, values=8).codes.count() == 480
    few = corpus.limit(3)
    tiny = vs.build_codes(few, n_cells=16)
    assert vs.compressed_knn(queries, few, tiny, 10, probes=16).count() == 480 * 3
    none = corpus.limit(0)
    assert vs.compressed_knn(queries, none, vs.build_codes(none, n_cells=4), 10, probes=2).count() == 0


def test_weights_of_neighbours(spark):
    near = spark.createDataFrame(
        [(1, "x", 0.9), (1, "y", 0.8), (1, "y", 0.6), (2, "x", 1.0), (2, "y", 0.8)],
        "query_id int, label string, score double")
    got = {(r.query_id, r.label): r.prob for r in vs.weigh_neighbours(near).collect()}
    assert got[1, "x"] == pytest.approx(0.571429, abs=1e-6)
    assert got[1, "y"] == pytest.approx(0.428571, abs=1e-6)
    assert got[2, "x"] == 1.0 and got[2, "y"] == 0.0


def test_topk_accuracy(spark):
    probs = spark.createDataFrame(
        [(1, "a", 0.9), (1, "b", 0.1), (2, "b", 0.5), (2, "c", 0.3), (2, "d", 0.2), (3, "a", 1.0)],
        "query_id int, label string, prob double")
    truth = spark.createDataFrame([(1, "a"), (2, "e"), (3, "b")], "query_id int, label string")
    labels = spark.createDataFrame([(c,) for c in "abcdefgh"], "label string")
    # 2: after b, c, d come the classes at zero, later first: h, g, f, e -> rank 7.
    # 3: after a come h, g, f, e, d, c, b -> rank 8.
    got = metrics.topk_accuracy(probs, truth, labels, ks=(1, 6, 7, 8)).first()
    assert (got.n, got.top1, got.top6, got.top7, got.top8) == (
        3, pytest.approx(1 / 3), pytest.approx(1 / 3), pytest.approx(2 / 3), 1.0)


def test_equal_probabilities_rank_later_label_first(spark):
    probs = spark.createDataFrame([(1, "a", 0.5), (1, "b", 0.5)], "query_id int, label string, prob double")
    labels = probs.select("label")
    for label, want in (("a", 0.0), ("b", 1.0)):
        truth = spark.createDataFrame([(1, label)], "query_id int, label string")
        assert metrics.topk_accuracy(probs, truth, labels, ks=(1,)).first().top1 == want


def test_chrf(spark):
    df = spark.createDataFrame(
        [(1, "the cat sat.", "the cat sat down."), (2, "Hello World", "Hello, world")],
        "id int, hyp string, ref string")
    assert metrics.chrf(df.filter("id = 1")).first().score == pytest.approx(62.718513, abs=1e-6)
    assert metrics.chrf(df).first().score == pytest.approx(53.115459, abs=1e-6)
    same = df.select("id", F.col("ref").alias("hyp"), "ref")
    assert metrics.chrf(same).first().score == pytest.approx(100.0)


def test_blocks(spark):
    df = spark.createDataFrame([(i, f"s{i}") for i in range(112)], "idx int, sentence string")
    got = metrics.make_blocks(df).orderBy("batch", "part").collect()
    assert [r.n for r in got] == [20, 20, 20, 18, 17, 17]
    assert got[0].text == " ".join(f"s{i}" for i in range(20))


def test_means(spark):
    df = spark.createDataFrame(
        [(99.53, 1899), (99.00, 9086), (99.61, 9580), (97.94, 14435)], "acc double, n int")
    assert metrics.weighted_mean(df, "acc", "n").first()[0] == pytest.approx(98.76, abs=0.005)
    langs = spark.createDataFrame([("a",), ("b",), ("c",)], "lang string")
    scores = spark.createDataFrame([("a", 1.0), ("c", 3.0)], "lang string, score double")
    assert tuple(metrics.mean_over_groups(langs, scores).first()) == (2.0, 2, "b")


@pytest.mark.parametrize("small, size", [(200_000, 4096), (20, 64), (300, 200)])
def test_exact_percentiles_of_a_skewed_group(spark, small, size):
    rng = np.random.default_rng(1)
    heavy = np.concatenate([rng.lognormal(0, 2, 3000), np.full(1500, 7.0), [1e9]])
    dense = np.concatenate([5 + 1e-9 * rng.random(5000), [-1e3, 1e6], rng.normal(size=40)])
    rows = [("heavy", float(v)) for v in heavy] + [("dense", float(v)) for v in dense]
    df = spark.createDataFrame(rows + [("one", 5.0), ("none", None)], "k string, v double")
    probs = [0.0, 0.5, 0.9, 0.99, 0.999, 1.0]
    got = {(r.k, r.prob): r.value for r in metrics.exact_percentiles(
        df, ["k"], "v", probs, sketch_size=size, small=small, error=0.1 if size < 300 else 0.0026).collect()}
    assert len(got) == 18
    for p in probs:
        assert got["heavy", p] == pytest.approx(np.quantile(heavy, p), rel=1e-9)
        assert got["dense", p] == pytest.approx(np.quantile(dense, p), rel=1e-12)
        assert got["one", p] == 5.0


def test_spans_get_narrow_whatever_the_distribution(spark):
    """99 of 100 values in a hundred-millionth of the range: no task orders more than its share."""
    rng = np.random.default_rng(2)
    values = np.concatenate([1 + 1e-8 * rng.random(19_800), 1e3 * rng.random(200)])
    rows = spark.createDataFrame([("a", float(v)) for v in values], "k string, v double")
    wide = spark.createDataFrame(
        [("a", float(values.min()), float(values.max()), 20_000, 0.5, 9999.5, 9999, 0)],
        "k string, low double, high double, inside long, prob double, place double, rank long, before long")
    closer = metrics._closer(rows, wide, ["k"], 4096, 0.0026).first()
    assert closer.inside < 0.01 * len(values) and 1 < closer.low < closer.high < 1 + 1e-8
    assert closer.before == (values < closer.low).sum() and closer.before <= 9999 < closer.before + closer.inside


def skewed_tokens(spark):
    """A third of the rows has one token, another third has no entry, some have none."""
    token = (
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "lost")
        .when(F.col("id") % 100 == 2, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("t"), F.col("id").cast("string")))
    )
    rows = spark.range(3000).select("id", token.alias("t"), F.lit("x").alias("v2"))
    table = spark.range(3000).select(
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("t"), F.col("id").alias("v"),
        F.when(F.col("id") % 2 == 0, "even").alias("w"),
    ).unionByName(spark.createDataFrame([("hot", None, "x"), ("unused", 2, "y")], "t string, v long, w string"))
    return rows, table


@pytest.mark.parametrize("how", ["left", "inner"])
def test_skew_join_equals_plain_join(spark, how):
    rows, table = skewed_tokens(spark)
    plain = rows.join(table, ["t"], how)
    for found in (lookup.skew_join(rows, table, ["t"], how), lookup.skew_join(rows, table, ["t"], how, max_hot_bytes=0),
                  lookup.lookup_join(rows, table, ["t"], how, max_broadcast_bytes=0), lookup.lookup_join(rows, table, ["t"], how)):
        assert found.columns == plain.columns
        assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_skew_join_deals_hot_keys_and_copies_no_row(spark):
    rows, table = skewed_tokens(spark)
    hot = lookup.hot_hashes(rows, ["t"])
    want = {r.h for r in spark.createDataFrame([("hot",), ("lost",)], "t string").select(F.xxhash64("t").alias("h")).collect()}
    assert set(hot) == want
    plan = lookup.skew_join(rows, table, ["t"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and plan.count("Join") == 2 and plan.count("broadcast") == 1
    even = spark.range(3000).select("id", F.col("id").cast("string").alias("t"))
    assert lookup.hot_hashes(even, ["t"]) == [] and lookup.hot_hashes(even.limit(0), ["t"]) == []
    plan = lookup.skew_join(even, table, ["t"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "broadcast" not in plan
    # no task gets more than its share of a hot key
    spread = F.pmod(F.xxhash64("id", "v2"), F.lit(4)) + 1
    dealt = rows.where("t = 'hot'").groupBy(spread.alias("s")).count().collect()
    assert len(dealt) == 4 and max(r["count"] for r in dealt) < 300


def test_vocabulary_and_tokens(spark):
    df = spark.createDataFrame(
        [(1, "a a b"), (2, "c a b d"), (3, "q r s t u v"), (4, None)], "doc_id int, text string")
    vocab = embed.build_vocabulary(df.filter("doc_id < 3"))
    ids = {r.token: r.token_id for r in vocab.collect()}
    assert ids["a"] == 4 and ids["b"] == 5 and sorted(ids.values()) == [4, 5, 6, 7]
    got = {r.doc_id: r for r in embed.tokenize(df, vocab, "doc_id", max_len=5).collect()}
    assert got[1].ids == [4, 4, 5, 1, 1] and got[2].n_tokens == 4
    assert got[3].ids is None and "6 tokens, the maximum is 5" in got[3].error.message
    assert got[4].error.message == "missing text"


def test_tokens_meet_the_vocabulary_once_per_block(spark, monkeypatch):
    monkeypatch.setattr(embed, "BLOCK_BYTES", 400)
    texts = {i: " ".join(f"W{(i * j) % 7}" for j in range(12)) + "\f\tde \u00c9t\u00e9\x0b" for i in range(60)}
    rows = [*texts.items(), (60, None), (61, " \n"), (62, "w " * 21), (63, "w?")]
    df = spark.createDataFrame(rows, "doc_id int, text string").coalesce(2)
    vocab = embed.build_vocabulary(df)
    want = {}
    for _, text in rows:
        for t in re.findall("[^ \t\n\r\f]+", (text or "").lower()):
            want[t] = want.get(t, 0) + 1
    assert {r.token: r.n for r in vocab.collect()} == want
    id_of = {r.token: r.token_id for r in vocab.where("token != 'w3'").collect()}
    assert len(id_of) == len(want) - 1
    assert "\u00e9t\u00e9\x0b" in id_of
    joined, join = [], embed.lookup_join

    def watched(rows, *args, **options):
        joined.append(rows.count())
        return join(rows, *args, **options)

    monkeypatch.setattr(embed, "lookup_join", watched)
    twice = df.union(spark.createDataFrame([(5, "w0 w1"), (None, "de"), (None, None)], "doc_id int, text string"))
    found = embed.tokenize(twice, vocab.where("token != 'w3'"), "doc_id", max_len=20).collect()
    got = {r.doc_id: r for r in found}
    assert len(found) == len(got) == 65
    for i, text in texts.items():
        ids = [id_of.get(t, embed.UNKNOWN_ID) for t in re.findall("[^ \t\n\r\f]+", text.lower())]
        if i == 5:  # rows that share a key are one row, by place
            both = sorted([*enumerate(ids), (0, id_of["w0"]), (1, id_of["w1"])])
            ids = [t for _, t in both]
        assert got[i].ids == ids + [1] * (20 - len(ids)) and got[i].error is None
    assert got[60].error.message == "missing text" and got[60].ids is None and got[60].n_tokens is None
    assert got[61].ids == [1] * 20 and got[61].n_tokens == 0
    assert got[62].ids is None and "21 tokens, the maximum is 20" in got[62].error.message
    assert sum(len(t.split()) for t in texts.values()) > 3 * joined[0]  # tokens of a block, not of its texts


def test_masked_mean(spark):
    table = spark.createDataFrame([(5, [1.0, 0.0]), (9, [0.0, 1.0])], "token_id bigint, vector array<double>")
    df = spark.createDataFrame([(1, [5, 9, 1, 1]), (2, [1, 1])], "doc_id int, ids array<bigint>")
    got = {r.doc_id: r for r in embed.masked_mean(df, table, "doc_id").collect()}
    assert got[1].mean == [0.5, 0.5] and got[1].error is None
    assert got[2].mean is None and got[2].error.code == "INVALID_ARG"


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation")


def test_texts_are_read_once_whatever_the_models(spark, tmp_path):
    rows = [(i, f"query: w{i} x", {"embed_model": ("siglip_text", "multilingual_e5_large", "other")[i % 3]}) for i in range(30)]
    spark.createDataFrame(rows, "doc_id int, text string, params map<string,string>").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    done = jobs.embed_text_job(docs)
    assert scans(done) == 1
    got = {r.doc_id: r for r in done.collect()}
    for name, encoder in embed.ENCODERS.items():
        own = docs.where(f"params['embed_model'] = '{name}'")
        want = {r.doc_id: r.embedding for r in embed.embed_with(own, encoder).collect()}
        assert want and all(got[i].embedding == v for i, v in want.items())
    assert all(got[i].error.stage == "model" and got[i].embedding is None for i in range(2, 30, 3))
    raw = docs.withColumn("text", F.col("text").cast("binary"))
    assert sorted(map(str, jobs.embed_text_job(raw).collect())) == sorted(map(str, got.values()))
    bad = spark.createDataFrame([(1, bytearray(b"query: \xff"))], "doc_id int, text binary")
    assert jobs.embed_text_job(bad).first().error.stage == "decode"
    registry = {"a": lambda: lambda batch: [r["text"] + "a" for r in batch], "b": lambda: lambda batch: [r["text"] + "b" for r in batch]}
    named = docs.select("doc_id", "text", F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), F.col("doc_id") % 3 + 1).alias("m"))
    out = dispatch_batches(named, ["text"], "m", registry, "t", "string", 7)
    assert scans(out) == 1
    for r in out.collect():
        assert r.t == (f"query: w{r.doc_id} x{r.m}" if r.m != "c" else None) and (r.error is None) == (r.m != "c")


def test_embed_text_job(spark):
    rows = [
        (1, "query: hello world", None), (2, "hello world", None),
        (3, "hello world", {"embed_model": "siglip_text"}), (4, "x", {"embed_model": "other"}),
        (5, "w " * 600, None), (6, "w " * 65, {"embed_model": "siglip_text"}), (7, None, None),
        (8, "query: hello   world", None)]
    df = spark.createDataFrame(rows, "doc_id int, text string, params map<string,string>")
    got = {r.doc_id: r for r in jobs.embed_text_job(df).collect()}
    assert len(got) == 8
    assert len(got[1].embedding) == 1024
    assert np.linalg.norm(got[1].embedding) == pytest.approx(1.0, abs=1e-6)
    assert got[1].embedding == got[8].embedding
    assert len(got[3].embedding) == 1152 and np.linalg.norm(got[3].embedding) > 1
    assert got[2].error.stage == "prefix" and got[4].error.stage == "model"
    assert got[5].error.stage == "tokens" and got[6].error.stage == "tokens"
    assert got[7].error.message == "missing text"
    assert all((r.embedding is None) != (r.error is None) for r in got.values())


def test_samples(spark):
    df = spark.createDataFrame([(i, "big" if i % 3 else "small") for i in range(30)], "id int, label string")
    got = sampling.sample_per_class(df, "label", "id", n=2).collect()
    assert sorted((r.label, r.id) for r in got) == [("big", 1), ("big", 2), ("small", 0), ("small", 3)]
    assert sampling.sample_per_class(df, "label", "id", n_classes=1).select("label").distinct().count() == 1


def test_search_finds_the_same_words(spark):
    corpus = spark.createDataFrame(
        [(1, "red apples and pears"), (2, "green boats sail"), (3, "pears")], "id bigint, text string")
    queries = spark.createDataFrame([(7, "boats that sail")], "query_id bigint, text string")
    assert jobs.semantic_search(queries, corpus, 1).first().id == 2


def test_long_texts_are_searched_by_passages(spark):
    filler = " ".join(f"w{i}" for i in range(511))
    corpus = spark.createDataFrame(
        [(1, filler + " green boats sail " + filler), (2, "red apples"), (3, filler), (4, None), (5, "green boats sail")],
        "id bigint, text string")
    queries = spark.createDataFrame(
        [(7, "green boats sail"), (8, filler + " red apples"), (9, None)], "query_id bigint, text string")
    rows = jobs.semantic_search(queries, corpus, 4).collect()
    got = {(r.query_id, r.id): r.score for r in rows}
    assert {(q, d) for q, d in got if q == 7} == {(7, d) for d in (1, 2, 3, 5)}
    assert len(rows) == 9 and max((s, -d) for (q, d), s in got.items() if q == 7)[1] == -5
    assert got[8, 3] > 0.9 and got[8, 2] > got[7, 2]
    assert [r.error.code for r in rows if r.query_id == 9] == ["INVALID_ARG"]


@pytest.mark.parametrize("block_rows", [None, 2, 100])
def test_repeated_ids_count_with_their_best_score(spark, block_rows):
    rng = np.random.default_rng(5)
    left, right = rng.integers(-3, 4, (9, 4)), rng.integers(-3, 4, (30, 4))
    side = lambda m, n, key: spark.createDataFrame(
        [(i % n, [float(x) for x in row]) for i, row in enumerate(m)], f"{key} bigint, vector array<double>")
    found = vs.knn(side(left, 3, "query_id"), side(right, 7, "id"), 4, block_rows, repeated=True).collect()
    for q in range(3):
        best = sorted((-max((left[q::3] @ right[d::7].T).ravel()), d) for d in range(7))[:4]
        assert [(-r.score, r.id) for r in sorted(found, key=lambda r: r.rank) if r.query_id == q] == best


def test_zero_shot(spark):
    classes = spark.createDataFrame([("n1", "red apple"), ("n2", "green boat")], "label string, description string")
    items = jobs.class_vectors(
        spark.createDataFrame([("q", "big green boat")], "label string, description string")
    ).select(F.lit(1).cast("bigint").alias("query_id"), "vector")
    got = {r.label: r.prob for r in jobs.classify_zero_shot(classes, items, k=2).collect()}
    assert got["n2"] > got["n1"]


def test_chrf_leaves_out_orders_the_reference_does_not_have(spark):
    df = spark.createDataFrame([("Hi there", "Hi")], "hyp string, ref string")
    got = {r.order: (r.hyp, r.ref, r.match) for r in metrics.chrf_counts(df).collect()}
    assert got == {1: (7, 2, 2), 2: (6, 1, 1), 7: (2, 1, 1)}


def test_search_skips_null_and_odd_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, None), (3, [0.0, 1.0]), (4, [1.0])]
    corpus = spark.createDataFrame(rows, "id long, vector array<double>")
    queries = corpus.withColumnRenamed("id", "query_id")
    for block_rows in (None, 2):
        got = vs.knn(queries, corpus, 2, block_rows).collect()
        assert {(r.query_id, r.id) for r in got} == {(1, 1), (1, 3), (3, 1), (3, 3)}


@pytest.mark.parametrize("block_rows", [None, 2])
def test_one_over_long_query_does_not_empty_the_search(spark, block_rows):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 1.0])]
    corpus = spark.createDataFrame([*rows, (3, None)], "id long, vector array<double>")
    queries = spark.createDataFrame(
        [*rows, (4, [1.0, 0.0, 0.0]), (5, None), (6, [])], "query_id long, vector array<double>")
    got = vs.knn(queries, corpus, 1, block_rows, errors=True).collect()
    assert {(r.query_id, r.id) for r in got if not r.error} == {(1, 1), (2, 2)}
    assert {r.query_id: r.error.message for r in got if r.error} == {
        4: "the vector has 3 numbers, 2 are expected", 5: "missing vector", 6: "missing vector"}
    assert len(got) == 5
    approximate = vs.ann_knn(queries, corpus, 1, probes=2, n_cells=2, errors=True).collect()
    assert {(r.query_id, r.id) for r in approximate} == {(r.query_id, r.id) for r in got}


def test_refused_vectors_are_rows_of_classification_and_mining(spark):
    train = spark.createDataFrame(
        [(1, [1.0, 0.0], "x"), (2, [0.0, 1.0], "y"), (3, [1.0], "z")], "id long, vector array<double>, label string")
    items = spark.createDataFrame(
        [(7, [1.0, 0.1]), (8, None), (9, [1.0, 0.0, 0.0])], "query_id long, vector array<double>")
    got = vs.knn_classify(train, items, 2).collect()
    assert {r.query_id for r in got if r.prob is not None} == {7}
    assert {(r.query_id, r.label) for r in got if r.error} == {(8, None), (9, None), (None, "z")}
    side1 = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0] * 3)], "id long, vector array<double>")
    side2 = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (4, None)], "id long, vector array<double>")
    picks, accuracy = jobs.mine_bitext(side1, side2, 2)
    picks = picks.collect()
    assert {(r.query_id, r.id) for r in picks if not r.error} == {(1, 1), (2, 2)}
    assert {(r.query_id, r.id) for r in picks if r.error} == {(3, None), (None, 4)}
    row = accuracy.first()
    assert row.n == 3 and row.margin_accuracy == pytest.approx(2 / 3)


def test_masked_mean_keeps_refused_rows(spark):
    table = spark.createDataFrame([(4, [1.0, 0.0]), (5, [0.0, 1.0])], "token_id bigint, vector array<double>")
    df = spark.createDataFrame([(1, "a b"), (2, "a b a b a b"), (3, None), (4, "")], "doc_id int, text string")
    vocab = spark.createDataFrame([("a", 4), ("b", 5)], "token string, token_id bigint")
    ids = embed.tokenize(df, vocab, "doc_id", max_len=5)
    got = {r.doc_id: r for r in embed.masked_mean(ids, table, "doc_id").collect()}
    assert len(got) == 4 and got[1].mean == [0.5, 0.5] and got[1].error is None
    assert [got[i].error.message for i in (2, 3, 4)] == [
        "text has 6 tokens, the maximum is 5", "missing text", "no token besides padding"]


def test_long_captions_and_refused_items_of_zero_shot(spark):
    filler = " ".join(f"w{i}" for i in range(70))
    classes = spark.createDataFrame(
        [("n1", "red apple"), ("n2", filler + " green boat"), ("n3", None)], "label string, description string")
    encoded = embed.embed_with(spark.createDataFrame(
        [(1, "A photo of a w3 w4 w5"), (2, "w " * 65)], "query_id long, text string"), embed.CAPTION_ENCODER)
    items = encoded.select("query_id", F.col("embedding").alias("vector"), "error")
    got = jobs.classify_zero_shot(classes, items, k=3).collect()
    probs = {r.label: r.prob for r in got if r.query_id == 1}
    assert set(probs) == {"n1", "n2"} and sum(probs.values()) == pytest.approx(1)
    errors = {(r.query_id, r.label): r.error.message for r in got if r.error}
    assert set(errors) == {(2, None), (None, "n3")}
    assert errors[2, None] == "text has 65 tokens, the maximum is 64" and "missing text" in errors[None, "n3"]


def test_refused_items_are_misses_of_few_shot(spark):
    train = spark.createDataFrame([(1, [1.0, 0.0], "x"), (2, [0.0, 1.0], "y")], "id long, vector array<double>, label string")
    items = spark.createDataFrame(
        [(7, [1.0, 0.1], "x"), (8, None, "y"), (9, [1.0], "y")], "query_id long, vector array<double>, label string")
    probs, accuracy = jobs.classify_few_shot(train, items, 2)
    assert {r.query_id for r in probs.collect() if r.error} == {8, 9}
    row = accuracy.first()
    assert row.n == 3 and row.top1 == row.top5 == pytest.approx(1 / 3)


def test_vectors_of_a_text_are_summed_before_they_move():
    keys = pa.array([7, None, 7, 3, 7, None])
    vectors = pa.array([[1.0, 2.0], [10.0, 0.0], [3.0, 4.0], [5.0, 5.0], [1.0, 1.0], [1.0, 1.0]])
    batch = pa.RecordBatch.from_arrays([keys, vectors], names=["key", "vector"])
    empty = batch.slice(0, 0)
    (out,) = embed._sums_by_key(iter([empty, batch]))
    got = {r["key"]: (r["n"], r["total"]) for r in out.to_pylist()}
    assert got == {7: (3, [5.0, 7.0]), None: (2, [11.0, 1.0]), 3: (1, [5.0, 5.0])}


def test_best_in_parts_equals_brute_force(monkeypatch):
    monkeypatch.setattr(vs, "TILE", (5, 16))
    rng = np.random.default_rng(2)
    for trial in range(12):
        right = rng.normal(size=(120, 6)) if trial % 2 else rng.integers(-1, 2, (120, 6)).astype(float)
        right[40:90] = right[3]
        left, ids = rng.normal(size=(13, 6)), np.arange(120) // (3 if trial % 3 == 0 else 1)
        best = vs._Best(left, 4)
        for part in (slice(60, 120), slice(0, 60)):
            best.add(ids[part], right[part])
        got = set(zip(*(x.tolist() for x in best.rows()[:2])))
        scores = np.round(left @ right.T, 9)
        want = set()
        for q in range(13):
            each = {i: scores[q, ids == i].max() for i in set(ids.tolist())}
            want |= {(q, i) for i in sorted(each, key=lambda i: (-each[i], i))[:4]}
        assert got == want


def test_exact_search_gives_every_core_pairs_of_blocks():
    for rows, cores in ((40_000, 8), (100_000, 12)):
        assert (rows / vs._even_block(64, rows, rows, cores)) ** 2 >= 0.9 * vs.BLOCK_PAIRS * cores
    most = vs._even_block(64, 10**7, 10**7, 12)
    assert most * 64 * 8 <= vs.BLOCK_BYTES
