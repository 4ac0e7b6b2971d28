import json
import os
import struct
import zlib
from collections import Counter
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lingofold.operators import images
from lingofold.operators.inference import predict_batches
from lingofold.plans import catalog, jobs
from lingofold.sources import corpora, requests
from lingofold.sources.images import read_image_dir
from lingofold.streaming import feeds


def png(colour, size=8):
    def chunk(kind, data):
        body = kind + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body))

    rows = b"".join(b"\0" + bytes(colour) * size for _ in range(size))
    head = struct.pack(">IIBBBBB", size, size, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


@pytest.fixture(scope="module")
def image_dir(tmp_path_factory):
    root = tmp_path_factory.mktemp("images")
    for label, colour in (("n01", (250, 10, 10)), ("n02", (10, 10, 250))):
        (root / label).mkdir()
        for i in range(3):
            shade = [max(0, c - i) for c in colour]
            (root / label / f"{label}_{i}.png").write_bytes(png(shade))
    (root / "n02" / "n02_9.png").write_bytes(b"no image")
    return root


def test_read_requests(spark, tmp_path):
    data = {"data": [{"LANG_ID": ["en"], "INPUT_TEXT": ["a b"]}, {"INPUT_TEXT": ["c"]}]}
    (tmp_path / "r.json").write_text(json.dumps(data, indent=1))
    got = requests.read_requests(spark, str(tmp_path), {"INPUT_TEXT": "string", "SRC_LANG": "string"})
    assert [(r.request_id, r.input_text, r.src_lang) for r in got.orderBy("request_id").collect()] == [
        (0, "a b", "en"), (1, "c", None)]


def test_read_token_requests(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"data": [{"INPUT_IDS": [5, 9, 1]}]}))
    got = requests.read_requests(spark, str(tmp_path), {"INPUT_IDS": "bigint"}, lists=("INPUT_IDS",))
    assert got.first().input_ids == [5, 9, 1]


def test_class_map(spark, tmp_path):
    (tmp_path / "m.txt").write_text("n01 red  apple,  fruit\n\nn02 boat\n")
    got = corpora.read_class_map(spark, str(tmp_path / "m.txt")).collect()
    assert sorted(map(tuple, got)) == [("n01", "red apple, fruit"), ("n02", "boat")]


def test_golden_segments(spark, tmp_path):
    cases = {"en": [{"title": "two", "text": "A b. C d.", "target": ["A b.", "C d."]},
                    {"title": "wrong", "text": "A b. C d.", "target": ["A b. ", "C d."]},
                    {"title": "size", "text": "A b. C d.", "target": ["A b. C d."]}]}
    (tmp_path / "g.json").write_text(json.dumps(cases, indent=2))
    golden = corpora.read_golden_segments(spark, str(tmp_path))
    got = jobs.evaluate_segmenter(golden).first()
    assert (got.n, got.n_size, got.n_text, got.n_exact) == (3, 1, 1, 1)


def test_wide_corpus(spark):
    df = spark.createDataFrame([(1, "x", "y")], "id int, sentence_eng_Latn string, sentence_zho_Hant string")
    got = corpora.read_parallel_wide(df, ["eng", "zho_Hant"]).collect()
    assert sorted(map(tuple, got)) == [(1, "eng", "Latn", "x"), (1, "zho", "Hant", "y")]
    with pytest.raises(ValueError):
        corpora.read_parallel_wide(df, ["deu"])


def test_results_are_split_once(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "a", None), (2, None, ("X", "s", "m"))],
        "doc_id int, out string, error struct<code:string,stage:string,message:string>")
    requests.write_results(df, str(tmp_path / "ok"), str(tmp_path / "err"))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "ok")).collect()] == [(1, "a")]
    assert [r.error.message for r in spark.read.parquet(str(tmp_path / "err")).collect()] == ["m"]


def test_image_files(spark, image_dir):
    assert read_image_dir(spark, str(image_dir), n_per_class=2).count() == 4
    got = images.embed_image_files(spark, str(image_dir)).collect()
    assert len(got) == 7
    assert [r.error.message for r in got if r.error] == ["not an image"]
    for r in got:
        if r.error is None:
            red, blue = np.array(r.embedding).reshape(3, -1)[[0, 2]].mean(axis=1)
            assert len(r.embedding) == 1152 and (red > blue) == (r.label == "n01")


def test_few_shot_images(spark, image_dir):
    probs, accuracy = jobs.classify_image_files(spark, str(image_dir), str(image_dir), k=3)
    got = accuracy.first()
    assert got.n == 6 and got.top1 == 1.0


def test_files_that_are_no_images_are_rows(spark, image_dir):
    probs, _ = jobs.classify_image_files(spark, str(image_dir), str(image_dir), k=3)
    bad = [r for r in probs.collect() if r.error]
    assert len(bad) == 2 and {(r.query_id is None, r.label) for r in bad} == {(True, "n02"), (False, None)}
    assert all("not an image" in r.error.message for r in bad)


def test_image_columns(spark):
    def decode(content):
        if content == b"boom":
            raise OSError("secret")
        return np.full((4, 4, 3), content[0], np.uint8)

    df = spark.createDataFrame(
        [(1, bytearray(b"ab"), None), (2, bytearray(b"YWI="), {"base64_encoded": "true"}),
         (3, bytearray(b"!!!"), {"base64_encoded": "true"}), (4, bytearray(b"boom"), None),
         (5, None, None), (6, bytearray(b"ab"), {"embed_model": "other"})],
        "image_id int, content binary, params map<string,string>")
    got = {r.image_id: r for r in jobs.embed_image_job(df, decoder=decode).collect()}
    assert got[1].embedding == got[2].embedding and len(got[1].embedding) == 1152
    assert got[3].error.stage == "base64" and got[4].error.message == "OSError in model"
    assert got[5].error.message == "missing content" and got[6].error.stage == "model"
    assert all((r.embedding is None) != (r.error is None) for r in got.values())


def test_stream_equals_batch_and_repeats_replace(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    fields = {"INPUT_TEXT": "string", "SRC_LANG": "string"}
    for i in range(3):
        data = {"data": [{"SRC_LANG": ["en"] if i else [], "INPUT_TEXT": [f"A {i}. B {i}."]}]}
        (source / f"{i}.json").write_text(json.dumps(data))

    def job(batch):
        named = batch.select(F.col("input_text").alias("text"), F.col("src_lang").alias("lang"))
        return jobs.segment_job(named.withColumn("doc_id", F.md5("text")))

    sink = feeds.split_sink(str(tmp_path / "ok"), str(tmp_path / "err"))
    stream = feeds.stream_requests(spark, str(source), fields, max_files_per_trigger=1)
    feeds.stream_job(stream, job, sink, str(tmp_path / "progress")).awaitTermination()
    want = job(requests.read_requests(spark, str(source), fields)).collect()
    ok = spark.read.parquet(str(tmp_path / "ok")).collect()
    err = spark.read.parquet(str(tmp_path / "err")).collect()
    assert {(r.doc_id, tuple(r.sentences)) for r in ok} == {
        (r.doc_id, tuple(r.sentences)) for r in want if r.error is None}
    assert len(ok) == 2 and len(err) == 1
    sink(job(requests.read_requests(spark, str(source), fields)), 1)
    assert spark.read.parquet(f"{tmp_path}/ok/batch=1").count() == 2


def test_stream_latency_windows(spark, tmp_path):
    rows = spark.range(400).select(
        F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("ts"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("service"),
        (F.col("id") % 17).cast("double").alias("latency"))
    for i in range(2):
        rows.filter(f"id % 2 = {i}" if "id" in rows.columns else "true").write.mode("append").parquet(
            str(tmp_path / "log"))
        break
    stream = feeds.stream_table(spark, str(tmp_path / "log"), rows.schema)
    report = feeds.stream_latency(stream, ["service"], "latency", "ts")
    query = (report.writeStream.format("memory").queryName("windows").outputMode("append")
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    query.awaitTermination()
    got = {(r.window_start, r.service): tuple(r)[2:] for r in spark.table("windows").collect()}
    want = {(r.window_start, r.service): tuple(r)[2:] for r in
            feeds.stream_latency(rows, ["service"], "latency", "ts").collect()}
    assert got and all(want[k] == v for k, v in got.items())
    assert len(got) < len(want)


def test_bitmaps(spark):
    random = np.random.default_rng(2)
    for shape in ((1, 1, 3), (5, 7, 3), (16, 24, 3)):
        pixels = random.integers(0, 256, shape).astype(np.uint8)
        raw = images.bitmap(pixels)
        assert (images.bitmap_decoder(raw) == pixels).all()
        for bad in (raw[:-1], raw[:20], b"", b"PN" + raw[2:]):
            with pytest.raises(ValueError):
                images.bitmap_decoder(bad)
    top_down = bytearray(raw)
    top_down[22:26] = struct.pack("<i", -16)
    assert (images.bitmap_decoder(bytes(top_down)) == pixels[::-1]).all()


def test_bitmap_files_and_columns_give_the_same_vectors(spark, tmp_path):
    random = np.random.default_rng(3)
    rows = []
    for i in range(3):
        raw = images.bitmap(random.integers(0, 256, (20, 30, 3)).astype(np.uint8))
        (tmp_path / f"n0{i}_1.bmp").write_bytes(raw)
        rows.append((f"n0{i}", bytearray(raw)))
    files = {r.label: r.embedding for r in images.embed_image_files(spark, str(tmp_path)).collect()}
    columns = spark.createDataFrame(rows, "image_id string, content binary")
    got = {r.image_id: r.embedding for r in jobs.embed_image_job(columns, decoder=images.bitmap_decoder).collect()}
    assert got == files and len(got) == 3


def test_repeated_and_late_requests_pass_once(spark, tmp_path):
    schema = "request_id string, ts timestamp, text string"

    def feed(rows, name):
        df = spark.createDataFrame([(i, t and datetime.fromisoformat(f"2024-05-01 {t}"), x) for i, t, x in rows], schema)
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run():
        stream = feeds.stream_table(spark, str(tmp_path / "in"), T._parse_datatype_string(schema), pattern="*.parquet")
        guarded = feeds.guard_requests(stream, ["request_id"], "ts", "5 minutes")
        sink = feeds.split_sink(str(tmp_path / "ok"), str(tmp_path / "err"))
        feeds.stream_job(guarded, lambda d: d, sink, str(tmp_path / "cp"), idle_batches=False).awaitTermination()

    def seen():
        ok = Counter(r.request_id for r in spark.read.parquet(str(tmp_path / "ok")).collect())
        err = Counter((r.request_id, r.error.message) for r in spark.read.parquet(str(tmp_path / "err")).collect())
        return ok, err

    late = "the request came after the watermark"
    feed([("a", "10:00:00", "x"), ("b", "10:00:01", "x"), ("a", "10:00:02", "again"), ("n", None, "x")], "0")
    run()
    assert seen() == ({"a": 1, "b": 1}, {("n", "missing time"): 1})
    feed([("b", "10:00:01", "again"), ("c", "10:30:00", "x")], "1")  # a repeat within the watermark
    run()  # every run starts anew from the checkpoint
    assert seen()[0] == {"a": 1, "b": 1, "c": 1}
    feed([("d", "10:02:00", "x"), ("d", "10:02:00", "x"), ("c", "10:30:00", "again"), ("e", "10:26:00", "x"), ("a", "10:00:00", "x")], "2")
    run()
    ok, err = seen()
    assert ok == {"a": 1, "b": 1, "c": 1, "e": 1}
    assert err == {("n", "missing time"): 1, ("d", late): 1}
    run()
    assert seen() == (ok, err)


def test_models_are_loaded_once_per_worker_and_version(spark, tmp_path):
    log = str(tmp_path / "loads")

    def maker(version):
        def make():
            with open(log, "a") as out:
                out.write(f"{version} {os.getpid()}\n")
            return lambda rows: [len(r["text"]) for r in rows]
        return make

    def loads():
        return [line.split() for line in open(log).read().splitlines()]

    df = spark.createDataFrame([(i, "x" * i) for i in range(40)], "id int, text string")
    for _ in range(4):  # as the micro-batches of a stream
        got = predict_batches(df, ["text"], maker("1"), "n", "int", 7, model=("sizes", "1")).collect()
        assert all(r.n == r.id for r in got)
    assert len(loads()) == len({pid for _, pid in loads()})
    predict_batches(df, ["text"], maker("2"), "n", "int", 7, model=("sizes", "2")).collect()
    assert {v for v, _ in loads()} == {"1", "2"}

    def broken():
        def run(rows):
            import no_such_module_here
            return [no_such_module_here] * len(rows)
        return run

    with pytest.raises(Exception, match="no_such_module_here"):
        predict_batches(df, ["text"], broken, "n", "int", 7).collect()


def test_streams_of_embedding_equal_batches(spark, tmp_path):
    rows = [(i, f"query: word{i} and more", {"embed_model": "siglip_text"} if i % 3 == 0 else None) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, params map<string,string>")
    for i in range(3):
        docs.where(f"doc_id % 3 = {i}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = feeds.stream_table(spark, str(tmp_path / "in"), docs.schema, max_files_per_trigger=1)
    sink = feeds.split_sink(str(tmp_path / "ok"), str(tmp_path / "err"))
    feeds.stream_job(stream, jobs.embed_text_job, sink, str(tmp_path / "cp")).awaitTermination()
    got = {r.doc_id: r.embedding for r in spark.read.parquet(str(tmp_path / "ok")).collect()}
    assert got == {r.doc_id: r.embedding for r in jobs.embed_text_job(docs).collect()} and len(got) == 12


def test_streams_read_tables_of_one_file_and_of_many(spark, tmp_path):
    rows = [(i, "one two " * (300 if i % 4 == 0 else 3), "en", f"src{i}", 9) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(str(tmp_path / "many" / "documents.parquet"))
    (tmp_path / "one").mkdir()
    docs.toPandas().to_parquet(tmp_path / "one" / "documents.parquet")
    for layout in ("many", "one"):
        found = catalog.t3_split_sink(spark, str(tmp_path / layout))
        assert Counter(r.status for r in found.collect()) == {"ok": 9, "error": 3}
        assert catalog.t2_stream_segment(spark, str(tmp_path / layout)).count() == 12


def test_stream_detection_reads_a_table_of_many_files(spark, tmp_path):
    rows = [(i, "the cat sat on the mat" if i % 2 else "le chat est sur la table", "en" if i % 2 else "fr", "src0", 9) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id: r.lang for r in catalog.t2_stream_detect(spark, str(tmp_path)).collect()}
    assert found == {i: "eng" if i % 2 else "fra" for i in range(12)}


def test_a_large_arrow_batch_is_worked_off_in_parts(spark, monkeypatch):
    import pyarrow as pa

    from lingofold.operators import embed

    df = spark.range(1).select(F.col("id").alias("n"))
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, function, schema: function)
    run = predict_batches(df, ["n"], lambda: lambda rows: [[float(r["n"])] for r in rows], "v", "array<float>", 60)
    batch = pa.RecordBatch.from_pydict({"n": pa.array(range(3001), pa.int64())})
    found = list(run([batch, batch.slice(0, 0)]))
    assert max(b.num_rows for b in found) <= 480
    assert [v for b in found for v in b.column("v").to_pylist()] == [[float(n)] for n in range(3001)]

    sizes, pool = [], embed._pool
    monkeypatch.setattr(embed, "_pool", lambda votes, encoder: sizes.append(len(votes)) or pool(votes, encoder))
    votes = pa.array([[1, 2]] * 1200 + [None], pa.list_(pa.int32()))
    one = embed.CAPTION_ENCODER
    vectors = embed._pooler({one.name: one}).func(votes, pa.array([one.name] * 1201))
    assert len(vectors) == 1201 and vectors.null_count == 1 and max(sizes) <= 500


class _State:
    """One group's state, with the clock and the watermark of the test."""

    def __init__(self):
        self.held, self.now, self.watermark, self.hasTimedOut, self.due = None, 0, 0, False, None

    exists = property(lambda self: self.held is not None)
    get = property(lambda self: self.held)

    def update(self, held):
        self.held = held

    def remove(self):
        self.held = self.due = None

    def setTimeoutDuration(self, ms):
        self.due = self.now + ms

    def getCurrentProcessingTimeMs(self):
        return self.now

    def getCurrentWatermarkMs(self):
        return self.watermark


def test_requests_of_a_group_are_looked_up_together():
    import pandas as pd

    fields = T._parse_datatype_string("id string, n long, ts timestamp").fields
    run, state = feeds._guard(fields, "ts", 1000), _State()

    def batch(*frames):
        made = [pd.DataFrame({"id": [r[0] for r in f], "n": [r[1] for r in f], feeds.KEY: [r[0] for r in f],
                              "ts": pd.to_datetime([r[2] for r in f], unit="ms")}) for f in frames]
        return [tuple(r) for out in run((0,), iter(made), state) for r in out[["id", "n", "late"]].values.tolist()]

    assert batch([("a", 1, 5000), ("b", 2, 9000), ("a", 3, 4000)], [], [("b", 4, 9000), ("c", 5, 100)]) == [
        ("b", 2, False), ("a", 3, False), ("c", 5, False)]
    state.now, state.watermark = 500, 4500
    assert batch([("a", 6, 8000), ("d", 7, 100), ("d", 8, 200), ("e", 9, 100), ("e", 10, 6000)]) == [("d", 7, True), ("e", 10, False)]
    assert batch([("d", 11, 300), ("c", 12, 100)]) == [("d", 11, True)]  # a late one is not remembered, c has passed
    state.now, state.watermark, state.hasTimedOut = 1200, 8000, True
    assert batch() == []  # a and c are forgotten, b is not behind the watermark
    state.hasTimedOut = False
    assert batch([("a", 13, 9000), ("b", 14, 9000), ("c", 15, 100)]) == [("a", 13, False), ("c", 15, True)]
    state.now, state.watermark, state.hasTimedOut = 90000, 90000, True
    assert batch() == [] and not state.exists


def test_requests_with_many_ids_need_few_calls(spark, tmp_path):
    rows = spark.range(6000).select(
        F.when(F.col("id") > 2, F.col("id") % 3000).alias("request"), F.lit("a").alias("part"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 7).alias("ts"))
    rows.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = feeds.stream_table(spark, str(tmp_path / "in"), rows.schema)
    guarded = feeds.guard_requests(stream, ["request", "part"], "ts", "5 minutes")
    plan = guarded._jdf.queryExecution().analyzed().toString()
    assert "__group" in plan and feeds.GUARD_GROUPS < 3000
    sink = feeds.split_sink(str(tmp_path / "ok"), str(tmp_path / "err"))
    feeds.stream_job(guarded, lambda d: d, sink, str(tmp_path / "cp"), idle_batches=False).awaitTermination()
    ok = spark.read.parquet(str(tmp_path / "ok"))
    assert ok.count() == 3001 and ok.select("request").distinct().count() == 3001  # ids 0 to 2 come once more, null once
    assert spark.read.parquet(str(tmp_path / "err")).count() == 0
