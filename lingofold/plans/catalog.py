"""Registered queries: one per operator, each over whole given tables.

Where an operator needs something the tables lack (a missing value, a bad label, a second side),
the query derives it from the table with column expressions, row by row.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lingofold.functions import codes, vectors
from lingofold.functions import text as txt
from lingofold.functions.errors import INTERNAL, error_if, first_error
from lingofold.operators import alignment, embed, images, metrics, options, routing, sampling, sentence_ends, validate
from lingofold.operators import language_id as lid
from lingofold.operators import translate as tr
from lingofold.operators import vector_search as vs
from lingofold.operators.inference import dispatch_batches, predict_batches
from lingofold.operators.segment import sentences
from lingofold.plans import jobs
from lingofold.session import shared_path, ship_package, spread, stage_table
from lingofold.sources import corpora, requests
from lingofold.streaming import feeds

PER_GRAM = {"per_gram": True}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def _by_source(*pairs: tuple[str, str | None], other: Column) -> Column:
    """A value per ``source``, else ``other``."""
    out = other
    for source, value in pairs:
        out = F.when(F.col("source") == source, F.lit(value)).otherwise(out)
    return out


def _three_letter() -> Column:
    lang = F.col("lang")
    return (
        F.when(lang == "en", "eng").when(lang == "fr", "fra").when(lang == "es", "spa")
        .otherwise("deu")
    )


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").withColumn(
        "label", F.concat(_three_letter(), F.lit("_Latn"))
    )


_kept: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make):
    """Models are made once per session and data folder; they are written tables."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]


def _model(spark: SparkSession, sf_dir: str) -> lid.LanguageModel:
    return _once(
        spark, sf_dir, "lid", lambda: lid.train_language_model(_documents(spark, sf_dir))
    )


def _vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(
        spark, sf_dir, "vocabulary",
        lambda: stage_table(embed.build_vocabulary(_documents(spark, sf_dir)), "vocabulary"),
    )


def _foreign(text: Column) -> Column:
    """Made-up English side of a sentence: other vowels, and the first word comes last."""
    found = txt.words(F.translate(F.lower(text), "aeiou", "eioua"))
    return F.array_join(F.concat(F.slice(found, F.lit(2), F.size(found)), F.slice(found, 1, 1)), " ")


def _parallel_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned pairs: every sentence that is not English, with its English side."""
    rows = _sentence_rows(spark, sf_dir).where(_three_letter() != "eng")
    return rows.select(
        _three_letter().alias("src"), F.lit("eng").alias("tgt"),
        F.col("sentence").alias("source"), _foreign(F.col("sentence")).alias("target"),
    )


def _lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from the whole parallel sentences; it grows with the documents."""
    return _once(
        spark, sf_dir, "lexicon", lambda: alignment.train_lexicon(_parallel_sentences(spark, sf_dir))
    )


def _parts_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from the parallel sentences in parts, as the SQL of the document jobs has it."""
    return _once(
        spark, sf_dir, "parts-lexicon",
        lambda: alignment.train_lexicon(_parallel_sentences(spark, sf_dir), max_words=alignment.MAX_WORDS),
    )


def _code(error: str = "error") -> Column:
    return F.col(f"{error}.code").alias("error_code")


def _digest(column) -> Column:
    return F.md5(F.coalesce(column if isinstance(column, Column) else F.col(column), F.lit("")))


# --- sources and sinks ---------------------------------------------------------------------

REQUEST_FIELDS = {"INPUT_TEXT": "string", "SRC_LANG": "string"}


def _request_feed(spark: SparkSession, sf_dir: str) -> str:
    """The documents as request objects of up to 50 requests, one object per line."""

    def make() -> str:
        path = shared_path(spark, "feed")
        request = F.struct(
            F.array("text").alias("INPUT_TEXT"), F.array("lang").alias("LANG_ID")
        )
        (
            _documents(spark, sf_dir)
            .groupBy(F.floor(F.col("doc_id") / 50))
            .agg(F.collect_list(request).alias("data"))
            .select(F.to_json(F.struct("data")).alias("value"))
            .write.text(path)
        )
        return path

    return _once(spark, sf_dir, "feed", make)


def s1_read_requests(spark, sf_dir):
    rows = requests.read_requests(
        spark, _request_feed(spark, sf_dir), REQUEST_FIELDS, multi_line=False
    )
    return rows.select(F.col("src_lang").alias("lang"), _digest("input_text").alias("text_md5"))


def s3_class_map(spark, sf_dir):
    line = F.concat(
        F.lit(" p"), F.col("p_partkey").cast("string"), F.lit("  "), "p_name", F.lit("   "),
        "p_type", F.lit(" "),
    )
    return corpora.parse_class_map(_table(spark, sf_dir, "part").select(line.alias("value")))


def s4_parallel_wide(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    names = ["eng_Latn", "fra_Latn", "spa_Latn", "deu_Latn"]
    wide = docs.select(
        F.col("doc_id").alias("id"),
        *[F.when(F.col("label") == n, F.col("text")).alias(f"sentence_{n}") for n in names],
    )
    rows = corpora.read_parallel_wide(wide, ["eng", "fra", "spa_Latn", "deu"])
    return rows.select("id", "lang", "script", _digest("sentence").alias("sentence_md5"))


def s5_aligned_pairs(spark, sf_dir):
    turns = _table(spark, sf_dir, "conversations")
    replies = turns.select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("sentence2")
    )
    pairs = turns.join(replies, ["conv_id", "turn"]).select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("idx"),
        F.col("text").alias("sentence1"), "sentence2",
    )
    rows = corpora.read_aligned_pairs(pairs)
    return rows.select("side", "idx", _digest("text").alias("text_md5"))


def s6_golden_segments(spark, sf_dir):
    """The documents as golden cases, up to 50 in an object, cut after every full stop and blank."""

    def make() -> str:
        path = shared_path(spark, "golden")
        case = F.struct(
            F.col("doc_id").cast("string").alias("title"), "text", F.split("text", r"(?<=\.) ").alias("target")
        )
        (
            _documents(spark, sf_dir).groupBy("lang", F.floor(F.col("doc_id") / 50)).agg(F.collect_list(case).alias("cases"))
            .select(F.to_json(F.create_map("lang", "cases")).alias("value")).write.text(path)
        )
        return path

    rows = corpora.read_golden_segments(spark, _once(spark, sf_dir, "golden", make), whole_files=False)
    return rows.select(
        "lang", "title", _digest("text").alias("text_md5"), F.size("target").alias("n_target"),
        F.md5(F.array_join("target", "\u0002")).alias("target_md5"),
    )


def _checked_lengths(spark, sf_dir) -> DataFrame:
    tokens = F.size(txt.words(F.col("text")))
    return _documents(spark, sf_dir).select(
        "doc_id", "lang", tokens.alias("n_tokens"),
        validate.max_tokens(tokens, 512).alias("error"),
    )


def s7_write_results(spark, sf_dir):
    ok_path, err_path = shared_path(spark, "ok"), shared_path(spark, "err")
    requests.write_results(
        _checked_lengths(spark, sf_dir), ok_path, err_path, partition_by="lang",
        staging_path=shared_path(spark, "staging"),
    )
    ok = spark.read.parquet(ok_path).select("doc_id", F.lit("ok").alias("status"))
    err = spark.read.parquet(err_path).select("doc_id", F.lit("error").alias("status"))
    return ok.unionByName(err)


# --- scalar functions ----------------------------------------------------------------------


def p1_with_options(spark, sf_dir):
    params = F.from_json("props", "map<string,string>")
    k = F.try_element_at(params, F.lit("k")).cast("int")
    params = (
        F.when(k < 20, F.map_filter(params, lambda name, _: name != "k"))
        .when(k < 25, F.map_from_arrays(F.array(F.lit("k")), F.array(F.lit("many"))))
        .otherwise(params)
    )
    rows = _table(spark, sf_dir, "events").select("event_id", params.alias("params"))
    rows = options.with_options(rows, {"k": 7, "threshold": 0.5})
    return rows.select("event_id", "k", "threshold", _code("option_error"))


def p2_decode_text(spark, sf_dir):
    raw = F.encode("text", "UTF-8")
    bad = F.concat(raw, F.unhex(F.lit("FF")))
    rows = _documents(spark, sf_dir).select(
        "doc_id", F.when(F.col("source") == "src3", bad).otherwise(raw).alias("raw")
    )
    text, error = txt.decode_text(F.col("raw"))
    return rows.select("doc_id", F.md5(text).alias("text_md5"), error.alias("error")).select(
        "doc_id", "text_md5", _code()
    )


def p3_decode_image_bytes(spark, sf_dir):
    raw = F.encode("text", "UTF-8")
    encoded = F.encode(F.base64(raw), "UTF-8")
    rows = _documents(spark, sf_dir).select(
        "doc_id",
        (F.col("lang") == "en").alias("flag"),
        F.when(F.col("source") == "src5", F.encode(F.lit("!!!"), "UTF-8"))
        .when(F.col("lang") == "en", encoded).otherwise(raw).alias("content"),
    )
    content, error = txt.decode_image_bytes(F.col("content"), F.col("flag"))
    return rows.select("doc_id", F.md5(content).alias("content_md5"), error.alias("error")).select(
        "doc_id", "content_md5", _code()
    )


def p4_flatten_newlines(spark, sf_dir):
    return _documents(spark, sf_dir).select(
        "doc_id", F.md5(txt.flatten_newlines(F.col("text"))).alias("text_md5")
    )


def p5_split_label(spark, sf_dir):
    label = F.concat(
        F.lit("__label__"),
        F.when(F.col("source") == "src7", _three_letter()).otherwise(F.col("label")),
    )
    lang, script, error = codes.split_label(label)
    return _documents(spark, sf_dir).select(
        "doc_id", lang.alias("lang"), script.alias("script"), error.alias("error")
    ).select("doc_id", "lang", "script", _code())


def p6_to_iso1(spark, sf_dir):
    code = _by_source(
        ("src0", "ary"), ("src1", "prs"), ("src2", "yue"), ("src3", "zlm"), ("src4", "xxx"),
        ("src5", "fr"), ("src6", "srp"), ("src7", "nob"), other=_three_letter(),
    )
    rows = _documents(spark, sf_dir).select("doc_id", code.alias("code"))
    return codes.to_iso1(rows, "code", "iso1", codes.iso1_table(spark))


def p7_fix_chinese(spark, sf_dir):
    lang = _by_source(("src0", "zho"), ("src1", "zho"), ("src2", "zho"), ("src3", "yue"),
                      other=_three_letter())
    script = _by_source(("src0", "Hant"), ("src1", "Hans"), ("src2", None), ("src3", "Hant"),
                        other=F.lit("Latn"))
    return _documents(spark, sf_dir).select("doc_id", codes.fix_chinese(lang, script).alias("lang"))


def _translator_name() -> Column:
    return _by_source(("src0", "nllb"), ("src1", "unknown"), ("src2", "nllb"),
                      other=F.lit(codes.DEFAULT_TRANSLATOR))


def p8_default_target(spark, sf_dir):
    given = F.when(F.col("lang") == "fr", "fra")
    model = _translator_name()
    return _documents(spark, sf_dir).select(
        "doc_id",
        codes.default_target(given, model).alias("tgt"),
        validate.require_model(model, tuple(codes.DEFAULT_TARGETS)).alias("error"),
    ).select("doc_id", "tgt", _code())


def p9_lang_token(spark, sf_dir):
    code = F.when(F.col("lang") == "de", F.lit("__deu__")).otherwise(_three_letter())
    return _documents(spark, sf_dir).select("doc_id", codes.lang_token(code).alias("token"))


def p10_prompt(spark, sf_dir):
    name, kind = F.col("p_name"), F.col("p_type")
    return _table(spark, sf_dir, "part").select(
        "p_partkey",
        txt.prompt(txt.QUERY_PROMPT, text=name).alias("query"),
        txt.prompt(txt.CAPTION_PROMPT, text=name).alias("caption"),
        txt.prompt(txt.CATEGORY_PROMPT, text=name, label=kind).alias("category"),
    )


def p11_label_from_path(spark, sf_dir):
    path = F.concat(F.lit("/data/"), "source", F.lit("/"), "source", F.lit("_"),
                    F.col("doc_id").cast("string"), F.lit(".tar.JPEG"))
    return _documents(spark, sf_dir).select("doc_id", txt.label_from_path(path).alias("label"))


def p12_corpus_code(spark, sf_dir):
    lang = _by_source(("src0", "cmn_Hant"), ("src1", "cmn"), other=_three_letter())
    return _documents(spark, sf_dir).select("doc_id", codes.corpus_code(lang).alias("code"))


#: Letters of other scripts that take the place of frequent Latin ones, by source.
LETTERS = {
    "src1": "абвгд", "src2": "ابتثج", "src3": "的一是不了", "src4": "가나다라마", "src5": "あいうカキ", "src6": "अआइईउ",
    "src7": "αβγδε", "src8": "אבגדה", "src9": "กขคงจ", "src10": "აბგდე", "src11": "ԱԲԳԴԵ",
}


def p13_dominant_script(spark, sf_dir):
    text = F.col("text")
    for source, letters in LETTERS.items():
        moved = F.translate("text", "aeiorntshlud", (letters * 3)[:12])
        text = F.when(F.col("source") == source, moved).otherwise(text)
    return _documents(spark, sf_dir).select("doc_id", txt.dominant_script(text).alias("script"))


# --- validation ----------------------------------------------------------------------------


def v1_require(spark, sf_dir):
    rows = _documents(spark, sf_dir).select(
        "doc_id",
        F.when(F.col("source") != "src1", F.col("text")).alias("text"),
        F.when(F.col("source") != "src2", F.col("lang")).alias("lang"),
    )
    return rows.select("doc_id", validate.require("text", "lang").alias("error")).select(
        "doc_id", _code(), F.col("error.message").alias("message")
    )


def v2_require_model(spark, sf_dir):
    model = _by_source(("src0", "siglip_text"), ("src1", "word2vec"),
                       other=F.lit("multilingual_e5_large"))
    error = validate.require_model(model, tuple(embed.ENCODERS))
    return _documents(spark, sf_dir).select("doc_id", error.alias("error")).select(
        "doc_id", F.col("error.message").alias("message")
    )


def _supported(spark) -> DataFrame:
    return spark.createDataFrame([("eng",), ("fra",), ("spa",), ("cmn",)], "lang string")


def v3_require_language(spark, sf_dir):
    rows = _documents(spark, sf_dir).select(
        "doc_id", _three_letter().alias("src"),
        _by_source(("src0", "__eng__"), ("src1", "tlh"), ("src2", "fra"), other=F.lit("eng"))
        .alias("tgt"),
    )
    checked = validate.require_language(rows, _supported(spark))
    return checked.select("doc_id", F.col("language_error.message").alias("message"))


def v4_max_tokens(spark, sf_dir):
    return _checked_lengths(spark, sf_dir).select(
        "doc_id", "n_tokens", F.col("error.message").alias("message")
    )


def _prefixed() -> Column:
    lang = F.col("lang")
    prefix = (
        F.when(lang == "en", "query: ").when(lang == "fr", "passage: ")
        .when(lang == "de", "Query: ").otherwise("query:")
    )
    return F.concat(prefix, F.col("text"))


def v5_require_prefix(spark, sf_dir):
    return _documents(spark, sf_dir).select(
        "doc_id", validate.require_prefix(_prefixed()).alias("error")
    ).select("doc_id", _code())


def v6_first_error(spark, sf_dir):
    text = F.when(F.col("source") != "src1", _prefixed())
    rows = _documents(spark, sf_dir).select("doc_id", text.alias("text"))
    error = first_error(
        validate.require("text"),
        validate.max_tokens(F.size(txt.words(F.col("text"))), 512),
        validate.require_prefix(F.col("text")),
    )
    ok, err = requests.split_results(rows.withColumn("error", error))
    return ok.select("doc_id", F.lit("ok").alias("stage")).unionByName(
        err.select("doc_id", F.col("error.stage").alias("stage"))
    )


def v7_isolate_batch(spark, sf_dir):
    def make():
        def run(rows):
            if any(len(r["text"]) % 7 == 0 for r in rows):
                raise ValueError("refused")
            return [len(r["text"]) for r in rows]

        return run

    rows = predict_batches(
        _documents(spark, sf_dir).select("doc_id", "text"), ["text"], make, "size", "bigint", 50
    )
    return rows.select("doc_id", "size", _code(), F.col("error.message").alias("message"))


# --- dataflow ------------------------------------------------------------------------------


def _sentence_rows(spark, sf_dir) -> DataFrame:
    docs = _documents(spark, sf_dir).select(
        "doc_id", "lang", sentences(F.col("text"), F.col("lang")).alias("sentences")
    )
    return routing.explode_sentences(docs)


def d1_explode_sentences(spark, sf_dir):
    return _sentence_rows(spark, sf_dir).select(
        "doc_id", "chunk_id", _digest("sentence").alias("sentence_md5")
    )


def _given_source() -> Column:
    return _by_source(("src0", "fra"), ("src1", "deu"), ("src2", "eng"), ("src3", ""),
                      other=F.lit(None).cast("string"))


def d2_route_by_source(spark, sf_dir):
    rows = _documents(spark, sf_dir).select("doc_id", "text", _given_source().alias("src_lang"))
    routed = routing.route_by_source(rows, _model(spark, sf_dir), ["doc_id"], **PER_GRAM)
    return routed.select("doc_id", "lang", "script", F.round("prob", 6).alias("prob"))


REDETECT_THRESHOLD = 0.95


def d3_redetect_low_confidence(spark, sf_dir):
    model = _model(spark, sf_dir)
    rows = _documents(spark, sf_dir).select(
        "doc_id", "text", F.col("lang").alias("iso1"), _given_source().alias("src_lang"),
        F.lit(REDETECT_THRESHOLD).alias("language_id_threshold"),
    )
    routed = routing.route_by_source(rows, model, ["doc_id"], **PER_GRAM)
    again = routing.redetect_low_confidence(
        routed.withColumn("sentences", sentences(F.col("text"), F.col("iso1"))).drop("text"),
        model, "doc_id",
    )
    return again.select("doc_id", "chunk_id", "lang", "redetected")


def d4_reassemble(spark, sf_dir):
    failed = F.length("text") % 11 == 0
    rows = _table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.col("text").alias("translation"),
        error_if(failed, INTERNAL, "translate", F.concat(F.lit("turn "), F.col("turn").cast("string")))
        .alias("error"),
    )
    whole = routing.reassemble(rows, "conv_id", order_col="turn")
    return whole.select(
        "conv_id", F.md5("translated_text").alias("text_md5"),
        F.col("error.message").alias("message"),
    )


def d5_align_by_key(spark, sf_dir):
    joined = routing.align_by_key(
        _documents(spark, sf_dir).select("doc_id"), _table(spark, sf_dir, "labels"), ["doc_id"]
    )
    return joined.select("doc_id", "quality", "toxic", F.col("error.message").alias("message"))


def d6_dispatch(spark, sf_dir):
    rows = _documents(spark, sf_dir).select(
        "doc_id", "text", F.when(F.col("lang") == "en", "words").otherwise("chars").alias("model")
    )
    registry = {
        "words": lambda: lambda batch: [len(re.findall(f"[^{txt.BLANKS}]+", r["text"])) for r in batch],
        "chars": lambda: lambda batch: [len(r["text"]) for r in batch],
    }
    done = dispatch_batches(rows, ["text"], "model", registry, "n", "int", 60)
    return done.select("doc_id", "model", "n")


# --- model jobs ----------------------------------------------------------------------------


def m1_train_lid(spark, sf_dir):
    model = _model(spark, sf_dir)
    unseen = F.array(*[
        F.struct(F.lit(i).alias("at"), F.lit(x).alias("label"), F.lit(u).cast("bigint").alias("logp"))
        for i, (x, u) in enumerate(zip(model.labels, model.unseen, strict=True))
    ])
    gains = F.map_from_arrays("at", "gain").alias("gains")
    rows = model.grams.select("gram", gains, F.explode(unseen).alias("u"))
    logp = F.col("u.logp") + F.coalesce(F.try_element_at("gains", F.col("u.at")), F.lit(0))
    return rows.select("gram", "u.label", logp.alias("logp"))


def m2_detect_language(spark, sf_dir):
    found = lid.detect_languages(_documents(spark, sf_dir), _model(spark, sf_dir), ["doc_id"])
    top = lid.top_language(found, ["doc_id"])
    return top.select("doc_id", "lang", "script", F.round("prob", 6).alias("prob"))


def m3_detect_top_k(spark, sf_dir):
    found = lid.detect_languages(
        _documents(spark, sf_dir), _model(spark, sf_dir), ["doc_id"], top_k=3, threshold=0.02,
        **PER_GRAM,
    )
    return found.select(
        "doc_id", F.posexplode(F.arrays_zip("lang", "script", "prob")).alias("rank", "e")
    ).select("doc_id", "rank", "e.lang", "e.script", F.round("e.prob", 6).alias("prob"))


def m4_segment(spark, sf_dir):
    found = sentences(F.col("text"), F.col("lang"))
    return _documents(spark, sf_dir).select("doc_id", found.alias("s")).select(
        "doc_id", F.size("s").alias("n_sentences"),
        F.md5(F.array_join("s", "\u0002")).alias("sentences_md5"),
    )


def m4_sentence_ends(spark, sf_dir):
    """Every type seen with a dot: is it an abbreviation?"""
    return sentence_ends.abbreviation_scores(_documents(spark, sf_dir)).withColumn(
        "score", _rounded_to("score", 6)
    )


def m5_train_lexicon(spark, sf_dir):
    return _lexicon(spark, sf_dir).select(
        "src", "tgt", "token", "translation", F.round("prob", 6).alias("prob")
    )


def m5_translate_sentences(spark, sf_dir):
    rows = _sentence_rows(spark, sf_dir).select(
        "doc_id", "chunk_id", "sentence",
        _three_letter().alias("src"), F.lit("eng").alias("tgt"),
    )
    done = tr.translate_sentences(
        rows, tr.LexiconTranslator(_lexicon(spark, sf_dir)), ["doc_id", "chunk_id"]
    )
    return done.select("doc_id", "chunk_id", _digest("translation").alias("translation_md5"))




def _ids(spark, sf_dir) -> DataFrame:
    return embed.tokenize(_documents(spark, sf_dir), _vocabulary(spark, sf_dir), "doc_id")


def m6_tokenize_pad(spark, sf_dir):
    return _ids(spark, sf_dir).select(
        "doc_id", "n_tokens", F.size("ids").alias("n_ids"),
        F.md5(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_md5"), _code(),
    )


def m7_attention_mask(spark, sf_dir):
    rows = _ids(spark, sf_dir).select("doc_id", vectors.attention_mask(F.col("ids")).alias("mask"))
    return rows.select(
        "doc_id", F.size("mask").alias("n_mask"),
        F.aggregate("mask", F.lit(0), lambda a, x: a + x).alias("n_on"),
    )


def _masked_means(spark, sf_dir) -> DataFrame:
    """Token vectors come from the vectors table: token id modulo its size."""
    table = _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("token_id"), F.col("embedding").alias("vector")
    )
    size = table.count()
    rows = _ids(spark, sf_dir).select(
        "doc_id", F.transform("ids", lambda x: F.when(x == 1, -1).otherwise(x % size)).alias("ids"), "error"
    )
    return embed.masked_mean(rows, table, "doc_id", pad=-1)


def m8_masked_mean(spark, sf_dir):
    """The means alone, as the SQL gives them; ``m8_masked_mean_all`` has every document."""
    means = _masked_means(spark, sf_dir).filter("error is null")
    return means.select("doc_id", F.posexplode("mean").alias("dim", "x")).select(
        "doc_id", "dim", _rounded_to("x", 6).alias("value")
    )


def m8_masked_mean_all(spark, sf_dir):
    """Every document: its mean by dimension, or one row with the code of its error."""
    means = _masked_means(spark, sf_dir)
    return means.select("doc_id", "error", F.posexplode_outer("mean").alias("dim", "x")).select(
        "doc_id", "dim", _rounded_to("x", 6).alias("value"), _code()
    )


def m9_l2_normalize(spark, sf_dir):
    tripled = F.transform("embedding", lambda x: x.cast("double") * 3)
    rows = _table(spark, sf_dir, "embeddings").select(
        "vec_id", F.posexplode(vectors.l2_normalize(tripled)).alias("dim", "x")
    )
    return rows.select("vec_id", "dim", _rounded_to("x", 6).alias("value"))


def _rounded_to(column, digits: int) -> Column:
    """Rounded, with one spelling of zero."""
    value = F.round(column, digits)
    return F.when(value == 0, 0.0).otherwise(value)


def _fingerprint(rows: DataFrame, key: str) -> DataFrame:
    """Size, non-zero places and a weighted sum of the vector: enough to tell two apart."""
    vec = F.col("embedding").cast("array<double>")
    ramp = F.aggregate(
        F.transform(vec, lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, x: a + x
    )
    return rows.select(
        key,
        F.size("embedding").alias("n_dims"),
        F.size(F.filter("embedding", lambda x: x != 0)).alias("n_nonzero"),
        _rounded_to(ramp / F.size("embedding"), 5).alias("ramp"),
        F.col("error.stage").alias("error_stage"),
    )


def m10_embed_default(spark, sf_dir):
    text = F.concat(
        F.when(F.col("source") == "src1", F.lit("")).otherwise(F.lit("query: ")), F.col("text")
    )
    rows = _documents(spark, sf_dir).select("doc_id", text.alias("text"))
    return _fingerprint(embed.embed_with(rows, embed.DEFAULT_ENCODER), "doc_id")


def m11_embed_caption(spark, sf_dir):
    rows = _documents(spark, sf_dir).select("doc_id", "text")
    return _fingerprint(embed.embed_with(rows, embed.CAPTION_ENCODER), "doc_id")


def _bitmaps(spark, sf_dir) -> DataFrame:
    """(vec_id, content): each vector as the gray levels of an image of eight by eight, as a bitmap."""

    @F.arrow_udf("binary")
    def draw(lists: pa.Array) -> pa.Array:
        out = []
        for vector in lists.to_pylist():
            level = np.floor(np.clip(np.array(vector[:64], np.float64), -1, 1) * 127 + 128).astype(np.uint8).reshape(8, 8)
            out.append(images.bitmap(np.stack([level, 255 - level, level // 2], axis=2)))
        return pa.array(out, pa.binary())

    ship_package(spark)
    rows = _table(spark, sf_dir, "embeddings")
    return rows.select("vec_id", draw(F.col("embedding").cast("array<double>")).alias("content"))


def m12_embed_image(spark, sf_dir):
    rows = _bitmaps(spark, sf_dir).select(
        "vec_id", F.when(F.col("vec_id") % 10 == 3, F.lit(b"BMx")).otherwise(F.col("content")).alias("content"),
        F.lit(False).alias("base64_encoded"), F.lit("siglip_vision").alias("embed_model"),
    )
    return _fingerprint(images.embed_images(rows, images.bitmap_decoder), "vec_id")


def q3_embed_image(spark, sf_dir):
    """Every other image as base64; some are cut off, some no base64, some name an unknown model."""
    k = F.col("vec_id") % 10
    content = F.col("content")
    encoded = F.base64("content").cast("binary")
    rows = _bitmaps(spark, sf_dir).select(
        "vec_id",
        F.when(k == 3, F.substr(content, F.lit(1), F.lit(60))).when(k == 5, F.lit(b"!!!"))
        .when(k % 2 == 1, encoded).otherwise(content).alias("content"),
        F.when(k == 3, F.lit(None).cast("map<string,string>"))
        .when(k == 8, F.create_map(F.lit("embed_model"), F.lit("other")))
        .when(k % 2 == 1, F.create_map(F.lit("base64_encoded"), F.lit("true"))).alias("params"),
    )
    return _fingerprint(jobs.embed_image_job(rows, "vec_id", images.bitmap_decoder), "vec_id")


def m13_predict_batches(spark, sf_dir):
    def make():
        vowels = set("aeiou")

        def run(rows):
            return [sum(ch in vowels for ch in r["text"]) for r in rows]

        return run

    rows = predict_batches(
        _documents(spark, sf_dir).select("doc_id", "text"), ["text"], make, "n_vowels", "bigint", 60
    )
    return rows.select("doc_id", "n_vowels", _code())


# --- vector search -------------------------------------------------------------------------


def _vectors(spark, sf_dir) -> DataFrame:
    return _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector"), "label"
    )


def _other_side(rows: DataFrame) -> DataFrame:
    """A second side with known partners: each vector blended with itself shifted by one place."""
    v = F.col("vector")
    shifted = F.concat(F.slice(v, 2, F.size(v) - 1), F.slice(v, 1, 1))
    blend = F.zip_with(v, shifted, lambda a, b: a * 0.3 + b)
    return rows.withColumn("vector", vectors.l2_normalize(blend))


def k1_similarity(spark, sf_dir):
    rows = _vectors(spark, sf_dir)
    both = rows.select("id", F.col("vector").alias("a")).join(
        _other_side(rows).select("id", F.col("vector").alias("b")), "id"
    )
    a, b = F.col("a"), F.col("b")
    return both.select(
        "id",
        F.round(vectors.inner_product(a, b), 6).alias("ip"),
        F.round(vectors.cosine(a, b), 6).alias("cosine"),
        F.round(vectors.cosine_distance(a, b), 6).alias("distance"),
    )


def _sides(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    rows = _vectors(spark, sf_dir)
    return rows.select("id", "vector"), _other_side(rows).select("id", "vector")


def _queries(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("id", "query_id")


def _rounded(found: DataFrame) -> DataFrame:
    return found.withColumn("score", F.round("score", 6))


def d7_cross_corpus(spark, sf_dir):
    one, two = _sides(spark, sf_dir)
    return _rounded(vs.knn(_queries(two), one, 1, errors=True)).drop("rank", "error")


def k2_knn(spark, sf_dir):
    one, two = _sides(spark, sf_dir)
    return _rounded(vs.knn(_queries(one), two, 4, errors=True)).drop("error")


def _recall_row(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """Queries, rows of each, and whether nine of ten exact neighbours were found."""
    approximate = stage_table(approximate, "approximate")
    per_query = approximate.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).agg(
        F.count(F.lit(1)).alias("n_queries"), F.min("n").alias("least"), F.max("n").alias("most")
    )
    report = vs.recall_report(approximate, exact)
    return per_query.join(report).select("n_queries", "least", "most", (F.col("recall") >= 0.9).alias("recall_reached"))


def k3_ann_knn(spark, sf_dir):
    one, two = (stage_table(side, "side") for side in _sides(spark, sf_dir))
    found = vs.ann_knn(_queries(one), two, 10, probes=12, n_cells=16)
    return _recall_row(found, vs.knn(_queries(one), two, 10))


def k3_compressed_knn(spark, sf_dir):
    one, two = (stage_table(side, "side") for side in _sides(spark, sf_dir))
    index = vs.build_codes(two, n_cells=16)
    found = vs.compressed_knn(_queries(one), two, index, 10, probes=12)
    return _recall_row(found, vs.knn(_queries(one), two, 10))


def k3_ann_all_cells(spark, sf_dir):
    one, two = _sides(spark, sf_dir)
    return _rounded(vs.ann_knn(_queries(one), two, 4, probes=8, n_cells=8))


def k4_neighbour_mass(spark, sf_dir):
    one, two = _sides(spark, sf_dir)
    return vs.neighbour_mass(vs.knn(_queries(one), two, 4), 4).select(
        "query_id", F.round("mass", 6).alias("mass")
    )


def _candidates(spark, sf_dir) -> DataFrame:
    one, two = _sides(spark, sf_dir)
    return vs.margin_candidates(
        vs.knn(_queries(one), two, 4), vs.knn(_queries(two), one, 4), 4
    )


def k5_margin_score(spark, sf_dir):
    return _candidates(spark, sf_dir).select(
        "query_id", "rank", "id", F.round("margin", 6).alias("margin")
    )


def k6_rerank_top1(spark, sf_dir):
    return vs.rerank_top1(_candidates(spark, sf_dir)).select(
        "query_id", "id", F.round("margin", 6).alias("margin")
    )


SHOTS = 20


def _few_shot(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    rows = _vectors(spark, sf_dir)
    train = sampling.first_per_class(rows, "label", "id", SHOTS)
    rest = rows.join(train.select("id"), "id", "left_anti")
    return train, _queries(rest)


def k7_knn_classify(spark, sf_dir):
    train, items = _few_shot(spark, sf_dir)
    return vs.knn_classify(train, items.select("query_id", "vector"), 10).select(
        "query_id", "label", F.round("prob", 6).alias("prob")
    )


def k8_zero_shot(spark, sf_dir):
    parts = _table(spark, sf_dir, "part")
    names = parts.select("p_name").distinct()
    class_map = names.select(
        F.translate("p_name", " ", "_").alias("label"), F.col("p_name").alias("description")
    )
    text = F.concat_ws(" ", F.lit("A photo of a"), F.lower("p_type"), "p_name", F.lit("."))
    items = embed.embed_with(
        parts.select(F.col("p_partkey").alias("query_id"), text.alias("text")),
        embed.CAPTION_ENCODER,
    ).select("query_id", F.col("embedding").alias("vector"), "error")
    return jobs.classify_zero_shot(class_map, items, k=3).select(
        "query_id", "label", F.round("prob", 6).alias("prob")
    )


def k9_sample_per_class(spark, sf_dir):
    return sampling.sample_per_class(_vectors(spark, sf_dir), "label", "id", 4, 10, seed=3).select(
        "id", "label"
    )


def k10_semantic_search(spark, sf_dir):
    queries = _table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    corpus = _documents(spark, sf_dir).select(F.col("doc_id").alias("id"), "text")
    return _rounded(jobs.semantic_search(queries, corpus, 5)).drop("error")


# --- metrics -------------------------------------------------------------------------------


def _report(rows: DataFrame) -> DataFrame:
    return rows.select(
        "lang", "n_true", "n_pred", "hits",
        *[F.round(c, 6).alias(c) for c in ("micro_f1", "precision", "recall", "f1")],
    )


def a1_lid_f1(spark, sf_dir):
    """Declared language of the pages against the detected one."""
    model = _model(spark, sf_dir)
    code = F.regexp_extract("html", 'lang="([a-z]+)"', 1)
    truth = (
        F.when(code == "en", "eng").when(code == "fr", "fra").when(code == "es", "spa")
        .when(code == "de", "deu")
    )
    text = F.regexp_replace("html", "<[^>]*>", " ")
    rows = _table(spark, sf_dir, "pages").select("page_id", truth.alias("truth"), text.alias("text"))
    return _report(jobs.evaluate_lid(rows, model, "page_id"))


def a2_golden_fraction(spark, sf_dir):
    """Against a naive target: cut after a full stop and one space."""
    naive = F.split(F.regexp_replace("text", r"\. ", ".\u0002"), "\u0002")
    rows = _documents(spark, sf_dir).select("lang", "text", naive.alias("target"))
    return metrics.golden_fraction(
        rows.withColumn("sentences", sentences(F.col("text"), F.col("lang")))
    ).withColumn("fraction", F.round("fraction", 6))


def a3_topk_accuracy(spark, sf_dir):
    train, items = _few_shot(spark, sf_dir)
    _, accuracy = jobs.classify_few_shot(train, items, 10)
    return accuracy.select("n", F.round("top1", 6).alias("top1"), F.round("top5", 6).alias("top5"))


def a4_bitext_accuracy(spark, sf_dir):
    one, two = _sides(spark, sf_dir)
    _, accuracy = jobs.mine_bitext(one, two, 4)
    return accuracy.select(
        "n", F.round("margin_accuracy", 6).alias("margin_accuracy"),
        F.round("cosine_accuracy", 6).alias("cosine_accuracy"),
    )


def a5_weighted_mean(spark, sf_dir):
    """Mean quality per source, weighted by the number of labelled documents."""
    rated = _documents(spark, sf_dir).join(_table(spark, sf_dir, "labels"), "doc_id")
    groups = rated.groupBy("source").agg(
        F.avg("quality").alias("accuracy"), F.count(F.lit(1)).alias("n")
    )
    return metrics.weighted_mean(groups, "accuracy", "n").select(
        F.round("weighted_mean", 6).alias("weighted_mean")
    )


def _spoilt() -> Column:
    """A hypothesis that differs from its text: some endings cut, full stops set apart."""
    return F.regexp_replace(F.regexp_replace("text", "tion", "t"), r"\.", " .")


def a6_chrf(spark, sf_dir):
    rows = _table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", _spoilt().alias("hyp"), F.col("text").alias("ref")
    )
    return metrics.chrf(rows, ["role"]).select(
        "role", F.round("score", 6).alias("score")
    )


def a7_make_blocks(spark, sf_dir):
    rows = _documents(spark, sf_dir).select(F.col("doc_id").alias("idx"), F.col("text").alias("sentence"))
    return metrics.make_blocks(rows).select("batch", "part", "n", F.md5("text").alias("text_md5"))


def _source_scores(spark, sf_dir) -> DataFrame:
    rated = _documents(spark, sf_dir).join(_table(spark, sf_dir, "labels"), "doc_id")
    return rated.groupBy(F.col("source").alias("lang"), (F.col("toxic") == 1).alias("use_src")).agg(
        F.avg("quality").alias("score")
    )


def a8_mean_over_groups(spark, sf_dir):
    expected = _documents(spark, sf_dir).select(F.col("source").alias("lang"))
    scores = _source_scores(spark, sf_dir).filter("use_src").select("lang", "score")
    return metrics.mean_over_groups(expected, scores).withColumn(
        "mean_score", F.round("mean_score", 6)
    )


def a9_latency_report(spark, sf_dir):
    report = metrics.latency_report(
        _table(spark, sf_dir, "events"), ["event_type"], "value", "ts"
    )
    return report.select(
        "event_type", "n",
        *[F.round(c, 6).alias(c) for c in
          ("throughput", "mean", "std", "p50", "p90", "p95", "p99")],
    )


def a10_batch_efficiency(spark, sf_dir):
    log = _table(spark, sf_dir, "events").select(
        "event_type", F.floor(F.col("event_id") / 50).alias("batch_id"), F.lit(1).alias("rows")
    )
    return metrics.batch_efficiency(log, ["event_type"], "batch_id", "rows").withColumn(
        "rows_per_batch", F.round("rows_per_batch", 6)
    )


def a11_src_effect(spark, sf_dir):
    effect = metrics.src_effect(_source_scores(spark, sf_dir))
    return effect.select(
        "lang", *[F.round(c, 6).alias(c) for c in ("with_src", "without_src", "difference")]
    )


# --- composite jobs ------------------------------------------------------------------------


def _translated(docs: DataFrame, spark, sf_dir) -> DataFrame:
    rows = docs.select(
        "doc_id",
        F.when(F.col("source") != "src9", F.col("text")).alias("text"),
        _given_source().alias("src_lang"),
        F.when(F.col("source") == "src4", "tlh").alias("tgt_lang"),
        F.map_from_arrays(
            F.array(F.lit("language_id_threshold"), F.lit("translation_model")),
            F.array(F.lit(str(REDETECT_THRESHOLD)), _translator_name_q1()),
        ).alias("params"),
    )
    return jobs.translate_job(
        rows, _model(spark, sf_dir), tr.LexiconTranslator(_parts_lexicon(spark, sf_dir)),
        _supported(spark), **PER_GRAM,
    )


def _translated_digest(done: DataFrame) -> DataFrame:
    return done.select(
        "doc_id", F.md5("translated_text").alias("text_md5"), F.col("error.message").alias("message")
    )


def q1_translate(spark, sf_dir):
    return _translated_digest(_translated(_documents(spark, sf_dir), spark, sf_dir))


def _translator_name_q1() -> Column:
    return _by_source(("src5", "unknown"), other=F.lit(codes.DEFAULT_TRANSLATOR))


def _embedded(docs: DataFrame) -> DataFrame:
    model = _by_source(("src0", "siglip_text"), ("src1", "word2vec"), ("src2", "siglip_text"),
                       other=F.lit(None).cast("string"))
    rows = docs.select(
        "doc_id", _prefixed().alias("text"),
        F.when(model.isNotNull(), F.create_map(F.lit("embed_model"), model)).alias("params"),
    )
    return jobs.embed_text_job(rows)


def q2_embed_text(spark, sf_dir):
    return _fingerprint(_embedded(_documents(spark, sf_dir)), "doc_id")


def q4_detect_language(spark, sf_dir):
    params = F.when(
        F.col("lang") == "en",
        F.create_map(F.lit("top_k"), F.lit("3"), F.lit("threshold"), F.lit("0.01")),
    ).when(F.col("source") == "src3", F.create_map(F.lit("top_k"), F.lit("all")))
    rows = _documents(spark, sf_dir).select(
        "doc_id", F.when(F.col("source") != "src1", F.col("text")).alias("text"),
        params.alias("params"),
    )
    found = jobs.detect_language_job(rows, _model(spark, sf_dir), **PER_GRAM)
    return found.select(
        "doc_id", F.array_join("lang", ",").alias("langs"), F.array_join("script", ",").alias("scripts"),
        F.round(F.get("prob", F.lit(0)), 6).alias("best_prob"), F.col("error.message").alias("message"),
    )


def q5_segment(spark, sf_dir):
    rows = _documents(spark, sf_dir).select(
        "doc_id", "text", F.when(F.col("source") != "src1", _three_letter()).alias("lang")
    )
    return jobs.segment_job(rows).select(
        "doc_id", F.size("sentences").alias("n_sentences"),
        F.md5(F.array_join("sentences", "\u0002")).alias("sentences_md5"),
        F.col("error.message").alias("message"),
    )


def q6_mine_bitext(spark, sf_dir):
    one, two = _sides(spark, sf_dir)
    picks, _ = jobs.mine_bitext(one, two, 4)
    return picks.select("query_id", "id", F.round("margin", 6).alias("margin"))


def q7_classify_few_shot(spark, sf_dir):
    train, items = _few_shot(spark, sf_dir)
    probs, _ = jobs.classify_few_shot(train, items, 10)
    best = probs.groupBy("query_id").agg(
        F.max(F.struct(F.round("prob", 6).alias("p"), "label")).alias("b")
    )
    return best.select("query_id", F.col("b.label").alias("label"), F.col("b.p").alias("prob"))


#: Code of the translator, code of the corpus, and what is altered in the English turn.
TURN_LANGS = (("fra", "fra", "en", "an"), ("cmn_Hant", "zho_Hant", "er", "or"), ("tlh", "tlh", "the", "tha"))


def _turns(spark, sf_dir) -> DataFrame:
    return _table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 20 + F.col("turn")).alias("idx"), "text"
    )


def _parallel_turns(spark, sf_dir) -> DataFrame:
    """A parallel corpus of the conversation turns: English, and altered copies."""
    entries = [F.struct(F.lit("eng").alias("lang"), F.col("text").alias("sentence"))] + [
        F.struct(F.lit(code).alias("lang"), F.regexp_replace("text", old, new).alias("sentence"))
        for _, code, old, new in TURN_LANGS
    ]
    return _turns(spark, sf_dir).select("idx", F.explode(F.array(*entries)).alias("e")).select(
        "idx", "e.lang", "e.sentence"
    )


def _turn_lexicon(spark, sf_dir) -> DataFrame:
    """Learned from the turns of the first two languages; the third has no lexicon."""

    def make() -> DataFrame:
        sides = [
            F.struct(F.lit(src).alias("src"), F.regexp_replace("text", old, new).alias("source"))
            for src, _, old, new in TURN_LANGS[:2]
        ]
        pairs = _turns(spark, sf_dir).select(
            F.col("text").alias("target"), F.explode(F.array(*sides)).alias("s")
        ).select("s.src", F.lit("eng").alias("tgt"), "s.source", "target")
        return alignment.train_lexicon(pairs, max_words=alignment.MAX_WORDS)

    return _once(spark, sf_dir, "turn-lexicon", make)


def q8_evaluate_translation(spark, sf_dir):
    """Translates with a learned lexicon, with and without the source language; Klingon fails."""
    translator = tr.LexiconTranslator(_turn_lexicon(spark, sf_dir))
    supported = spark.createDataFrame([("eng",), ("fra",), ("spa",), ("deu",), ("cmn_Hant",)], "lang string")
    model = _model(spark, sf_dir)

    def translate(docs: DataFrame) -> DataFrame:
        return jobs.translate_job(docs, model, translator, supported, **PER_GRAM)

    found = jobs.compare_sources(
        _parallel_turns(spark, sf_dir), translate, [src for src, *_ in TURN_LANGS], "eng"
    )
    return found.select(
        F.coalesce("lang", F.lit("mean")).alias("lang"),
        *[F.round(c, 6).alias(c) for c in ("with_src", "without_src", "difference")], "failed",
    )


def q9_evaluate_lid(spark, sf_dir):
    rows = _documents(spark, sf_dir).select("doc_id", "text", _three_letter().alias("truth"))
    return _report(jobs.evaluate_lid(rows, _model(spark, sf_dir)))


def q9_evaluate_segmenter(spark, sf_dir):
    naive = F.split(F.regexp_replace("text", r"\.[ \n]", ".\u0002"), "\u0002")
    rows = _documents(spark, sf_dir).select(
        _three_letter().alias("lang"), "text", naive.alias("target")
    )
    return jobs.evaluate_segmenter(rows).withColumn("fraction", F.round("fraction", 6))


def language_and_sentences(spark, sf_dir):
    """Flagship: detect the language, split into sentences, count both per language."""
    docs = _documents(spark, sf_dir).select("doc_id", "text", F.lit(None).cast("string").alias("src_lang"))
    routed = routing.route_by_source(docs, _model(spark, sf_dir), ["doc_id"])
    iso = codes.to_iso1(routed, "lang", "iso1", codes.iso1_table(spark))
    counted = iso.select("iso1", F.size(sentences(F.col("text"), F.col("iso1"))).alias("n"))
    return counted.groupBy(F.col("iso1").alias("lang")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_sentences")
    )


# --- streaming -----------------------------------------------------------------------------


def _run_to_table(spark, stream: DataFrame, job, name: str) -> DataFrame:
    path = shared_path(spark, name)

    def sink(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    feeds.stream_job(stream, job, sink, shared_path(spark, f"{name}-progress")).awaitTermination()
    return spark.read.parquet(path)


def _table_stream(spark, sf_dir, name: str) -> DataFrame:
    """A table as a stream: one file, or a folder of files, as ``read.parquet`` takes either.

    The braces make the path a pattern, since a stream takes a single file by pattern only.
    """
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return feeds.stream_table(spark, f"{sf_dir}/{{{name}.parquet}}", schema)


def _document_stream(spark, sf_dir) -> DataFrame:
    return _table_stream(spark, sf_dir, "documents")


def t1_stream_requests(spark, sf_dir):
    stream = feeds.stream_requests(
        spark, _request_feed(spark, sf_dir), REQUEST_FIELDS, 2, multi_line=False
    )
    rows = _run_to_table(spark, stream.select("src_lang", "input_text"), lambda d: d, "requests")
    return rows.select(F.col("src_lang").alias("lang"), _digest("input_text").alias("text_md5"))


def t2_stream_detect(spark, sf_dir):
    model = _model(spark, sf_dir)

    def job(batch: DataFrame) -> DataFrame:
        found = lid.detect_languages(spread(batch), model, ["doc_id"])
        return lid.top_language(found, ["doc_id"]).drop("error")

    rows = _run_to_table(spark, _document_stream(spark, sf_dir), job, "detected")
    return rows.select("doc_id", "lang", "script", F.round("prob", 6).alias("prob"))


def t2_stream_segment(spark, sf_dir):
    stream = _document_stream(spark, sf_dir)
    rows = _run_to_table(spark, stream, jobs.segment_job, "segmented")
    return rows.select(
        "doc_id", F.size("sentences").alias("n_sentences"),
        F.md5(F.array_join("sentences", "\u0002")).alias("sentences_md5"),
    )


def t2_stream_translate(spark, sf_dir):
    stream = _document_stream(spark, sf_dir)
    rows = _run_to_table(spark, stream, lambda batch: _translated(spread(batch), spark, sf_dir), "translated")
    return _translated_digest(rows)


def t2_stream_embed(spark, sf_dir):
    rows = _run_to_table(spark, _document_stream(spark, sf_dir), lambda batch: _embedded(spread(batch)), "embedded")
    return _fingerprint(rows, "doc_id")


def t3_guarded_requests(spark, sf_dir):
    """The events as requests in three feeds: some come again, some an hour too late.

    The stream is started anew for each feed and goes on from its checkpoint.
    """
    path, ok_path, err_path = (shared_path(spark, name) for name in ("requests", "ok", "err"))
    progress = shared_path(spark, "guard-progress")
    start = F.timestamp_seconds(F.lit(1_700_000_000))
    rows = _table(spark, sf_dir, "events").select("event_id", F.pmod("event_id", F.lit(6)).alias("k"))

    def at(hours: Column | int) -> Column:
        return (start + F.make_dt_interval(hours=hours if isinstance(hours, Column) else F.lit(hours))).alias("ts")

    feed = {
        0: rows.where("k in (0, 3)").select("event_id", at(0)),
        1: rows.where("k in (0, 1, 4)").select("event_id", at(1)),
        2: rows.where("k in (1, 2, 5)").select("event_id", at(F.when(F.col("k") == 2, 0).otherwise(1))),
    }
    for part in feed.values():
        part.write.mode("append").parquet(path)
        stream = feeds.guard_requests(feeds.stream_table(spark, path, part.schema), ["event_id"], "ts", "10 minutes")
        feeds.stream_job(stream, lambda batch: batch, feeds.split_sink(ok_path, err_path), progress, idle_batches=False).awaitTermination()
    ok = spark.read.parquet(ok_path).select("event_id", F.lit(None).cast("string").alias("message"))
    err = spark.read.parquet(err_path).select("event_id", F.col("error.message").alias("message"))
    return ok.unionByName(err)


def t3_split_sink(spark, sf_dir):
    ok_path, err_path = shared_path(spark, "ok"), shared_path(spark, "err")

    def job(batch: DataFrame) -> DataFrame:
        tokens = F.size(txt.words(F.col("text")))
        return batch.select("doc_id", validate.max_tokens(tokens, 512).alias("error"))

    feeds.stream_job(
        _document_stream(spark, sf_dir), job, feeds.split_sink(ok_path, err_path),
        shared_path(spark, "split-progress"),
    ).awaitTermination()
    ok = spark.read.parquet(ok_path).select("doc_id", F.lit("ok").alias("status"))
    err = spark.read.parquet(err_path).select("doc_id", F.lit("error").alias("status"))
    return ok.unionByName(err)


def _latency_rows(report: DataFrame) -> DataFrame:
    return report.select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "n",
        F.round("mean", 6).alias("mean"), "max", "p50", "p90", "p95", "p99",
    )


def t4_latency_windows(spark, sf_dir):
    """The batch twin of ``t4_stream_latency``."""
    return _latency_rows(
        feeds.stream_latency(_table(spark, sf_dir, "events"), ["event_type"], "value", "ts", window="1 day")
    )


def t4_stream_latency(spark, sf_dir):
    """Windows of a stream of events, all of them written anew after every micro-batch."""
    stream = _table_stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    report = feeds.stream_latency(stream, ["event_type"], "value", "ts", window="1 day")
    path = shared_path(spark, "latency")
    feeds.write_windows(report, path, shared_path(spark, "latency-progress")).awaitTermination()
    return _latency_rows(spark.read.parquet(path))


QUERIES = {
    name: fn
    for name, fn in list(globals().items())
    if callable(fn) and name[0] in "spvdmkaqt" and name[1:2].isdigit()
} | {"language_and_sentences": language_and_sentences}
