"""The public jobs. Every input row gives one output row: a result or an error."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lingofold.functions.codes import (
    DEFAULT_TARGETS,
    DEFAULT_TRANSLATOR,
    corpus_code,
    default_target,
    fix_chinese,
    iso1_table,
    to_iso1,
)
from lingofold.functions.errors import first_error
from lingofold.functions.text import (
    CAPTION_PROMPT,
    PASSAGE_PROMPT,
    QUERY_PROMPT,
    decode_text,
    prompt,
    words,
)
from lingofold.operators import embed, metrics, validate
from lingofold.operators.images import embed_image_files, embed_images, pillow_decoder
from lingofold.operators.language_id import LanguageModel, detect_languages
from lingofold.operators.options import (
    DETECT_DEFAULTS,
    EMBED_IMAGE_DEFAULTS,
    EMBED_TEXT_DEFAULTS,
    LANGUAGE_ID_MODELS,
    SENTENCE_SEGMENTERS,
    TRANSLATE_DEFAULTS,
    with_options,
)
from lingofold.operators.routing import (
    align_by_key,
    dispatch,
    reassemble,
    redetect_low_confidence,
    route_by_source,
)
from lingofold.operators.segment import sentences
from lingofold.operators.translate import translate_sentences
from lingofold.operators.vector_search import (
    ann_knn,
    bitext_accuracy,
    common_length,
    knn,
    knn_classify,
    margin_candidates,
    refused,
    rerank_top1,
    usable,
)
from lingofold.session import stage_table


def detect_language_job(
    df: DataFrame, model: LanguageModel, key: str = "doc_id", **detect_options
) -> DataFrame:
    """(key, lang[], script[], prob[], error); options ``top_k`` and ``threshold`` per row."""
    rows = with_options(df, DETECT_DEFAULTS)
    rows = rows.withColumn("row_error", first_error(validate.require("text"), F.col("option_error")))
    # refused rows go along without their text, so that the texts are read once
    asked = rows.select(
        key, F.when(F.col("row_error").isNull(), F.col("text")).alias("text"), "top_k", "threshold", "row_error"
    )
    found = detect_languages(
        asked, model, [key], top_k=F.col("top_k"), threshold=F.col("threshold"),
        carry=["top_k", "threshold", "row_error"], **detect_options,
    )
    good = F.col("row_error").isNull()
    return found.select(
        key, *[F.when(good, F.col(c)).alias(c) for c in ("lang", "script", "prob")],
        F.coalesce("row_error", "error").alias("error"),
    )


def segment_job(
    df: DataFrame, key: str = "doc_id", iso_table: DataFrame | None = None
) -> DataFrame:
    """(key, sentences[], error) from (key, lang, text); ``lang`` is ISO 639-1 or 639-3."""
    table = iso1_table(df.sparkSession) if iso_table is None else iso_table
    rows = to_iso1(df.withColumn("error", validate.require("lang", "text")), "lang", "iso1", table)
    good = F.col("error").isNull()
    return rows.select(
        key, F.when(good, sentences(F.col("text"), F.col("iso1"))).alias("sentences"), "error"
    )


def translate_job(
    df: DataFrame,
    model: LanguageModel,
    translator,
    supported: DataFrame,
    key: str = "doc_id",
    iso_table: DataFrame | None = None,
    **detect_options,
) -> DataFrame:
    """(key, translated_text, error) for documents with optional src_lang, tgt_lang, params.

    Source and target are request parameters of these names; columns of the same names hold where
    a row has no such parameter. An unknown model, detector or segmenter is a row error.
    ``translator`` serves every translation model, or is a dict from model name to translator; a row
    whose model has none is an error.

    Detect (only without a source), split, detect unsure sentences again, translate, rejoin.
    """
    translators = translator if isinstance(translator, dict) else dict.fromkeys(DEFAULT_TARGETS, translator)
    for name in ("src_lang", "tgt_lang"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string"))
        if "params" in df.columns:
            df = df.withColumn(name, F.coalesce(F.try_element_at("params", F.lit(name)), F.col(name)))
    rows = with_options(df, TRANSLATE_DEFAULTS)
    rows = rows.withColumn(
        "error",
        first_error(
            validate.require("text"),
            F.col("option_error"),
            validate.require_model(F.col("translation_model"), tuple(DEFAULT_TARGETS)),
            validate.require_model(F.col("translation_model"), tuple(translators)),
            validate.require_model(F.col("language_id_model"), LANGUAGE_ID_MODELS),
            validate.require_model(F.col("sentence_segmenter"), SENTENCE_SEGMENTERS),
        ),
    ).select(
        key, "text", "src_lang", "error", "language_id_threshold", "translation_model",
        default_target(F.col("tgt_lang"), F.col("translation_model")).alias("tgt"),
    )
    routed = route_by_source(rows, model, [key], **detect_options)
    table = iso1_table(df.sparkSession) if iso_table is None else iso_table
    routed = to_iso1(routed, "lang", "iso1", table)
    good = F.col("error").isNull() & F.col("detect_error").isNull()
    documents = routed.select(
        key, "tgt", "lang", "script", "prob", "language_id_threshold", "translation_model",
        first_error(F.col("error"), F.col("detect_error")).alias("error"),
        F.when(good, sentences(F.col("text"), F.col("iso1"))).alias("sentences"),
    )
    pieces = redetect_low_confidence(documents, model, key, **detect_options)
    fixed = F.col("translation_model") == DEFAULT_TRANSLATOR
    src = F.when(fixed, fix_chinese(F.col("lang"), F.col("script"))).otherwise(F.col("lang"))
    pieces = pieces.withColumn("src", src)
    checked = validate.require_language(pieces, supported)
    wrong = F.when(F.col("sentence").isNotNull(), F.col("language_error"))
    ready = checked.select(
        key, "chunk_id", "sentence", "src", "tgt",
        first_error(F.col("error"), wrong).alias("error"), "translation_model",
    )
    if not isinstance(translator, dict):
        done = translate_sentences(ready.drop("translation_model"), translator, [key, "chunk_id"])
        return reassemble(done, key)
    first = next(iter(translators))
    known = F.col("translation_model").isin(*translators)
    ready = ready.withColumn("translation_model", F.when(known, F.col("translation_model")).otherwise(first))
    parts = {
        name: (lambda part, t=each: translate_sentences(part.drop("translation_model"), t, [key, "chunk_id"])
               .select(key, "chunk_id", "translation", "error"))
        for name, each in translators.items()
    }
    return reassemble(dispatch(ready, "translation_model", parts), key)


def embed_text_job(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, embed_model, embedding, error); the row's ``embed_model`` picks the encoder.

    The texts are read once; a text given as bytes is decoded, and no UTF-8 is a row error.
    """
    rows = with_options(df, EMBED_TEXT_DEFAULTS)
    errors = [F.col("option_error"), validate.require_model(F.col("embed_model"), tuple(embed.ENCODERS))]
    if isinstance(df.schema["text"].dataType, T.BinaryType):
        text, wrong = decode_text(F.col("text"))
        rows = rows.withColumn("error", first_error(*errors, wrong)).withColumn("text", text)
    else:
        rows = rows.withColumn("error", first_error(*errors))
    rows = rows.select(key, "text", "embed_model", "error")
    return embed.embed_by_name(rows, embed.ENCODERS, "embed_model").select(key, "embed_model", "embedding", "error")


def embed_image_job(
    df: DataFrame, key: str = "image_id",
    decoder: Callable[[bytes], np.ndarray] = pillow_decoder,
) -> DataFrame:
    """(key, embedding, error) from image bytes or base64 in ``content``."""
    rows = with_options(df, EMBED_IMAGE_DEFAULTS).withColumnRenamed("option_error", "error")
    return embed_images(rows, decoder).select(key, "embedding", "error")


def mine_bitext(
    side1: DataFrame, side2: DataFrame, k: int = 4, search: Callable | None = None
) -> tuple[DataFrame, DataFrame]:
    """(picks, accuracy) for two sides ``(id, vector)`` of unit vectors.

    ``search(queries, corpus, k)`` may be an approximate search, the default is the exact one. A row
    without a vector of the common length is a pick with an ``error``: of side 1 with its id as
    ``query_id``, of side 2 as ``id``. Those of side 1 count as misses in the accuracy. Both sides
    and the neighbours are written once.
    """
    def as_queries(df: DataFrame) -> DataFrame:
        return df.withColumnRenamed("id", "query_id")

    side1, side2 = stage_table(side1, "side-1"), stage_table(side2, "side-2")
    dims = common_length(side2, side1)
    find = search or partial(knn, dims=dims)
    good1, good2 = usable(side1, dims), usable(side2, dims)
    bad1 = as_queries(refused(side1, dims)).select("query_id", "error")
    bad2 = refused(side2, dims).select("id", "error")
    forward = stage_table(find(as_queries(good1), good2, k), "forward")
    backward = stage_table(find(as_queries(good2), good1, k), "backward")
    picks = rerank_top1(margin_candidates(forward, backward, k))
    for bad in (bad1, bad2):
        picks = picks.unionByName(bad, allowMissingColumns=True)
    return picks, bitext_accuracy(forward, backward, k, bad1)


def semantic_search(
    queries: DataFrame, corpus: DataFrame, k: int, query_kind: str = "query",
    corpus_kind: str = "passage", probes: int = 0, n_cells: int = 0,
) -> DataFrame:
    """(query_id, rank, id, score, error) for ``queries(query_id, text)`` in ``corpus(id, text)``.

    Asymmetric by default (query against passage); give "query" twice for the symmetric form.
    A text over the encoder's limit is cut into passages, and the best pair of passages counts.
    A query without a text gives one row with an ``error``. Vectors are made once and stored.
    """
    templates = {"query": QUERY_PROMPT, "passage": PASSAGE_PROMPT}
    encoder = embed.DEFAULT_ENCODER

    def vectors(df: DataFrame, key: str, kind: str) -> DataFrame:
        room = encoder.max_tokens - len(templates[kind].format(text="").split())
        parts = df.select(key, F.explode_outer(embed.passages(F.col("text"), room)).alias("part"))
        text = prompt(templates[kind], text=F.col("part"))
        made = embed.embed_with(parts.select(key, text.alias("text")), encoder)
        return stage_table(made.select(key, F.col("embedding").alias("vector"), "error"), "vectors")

    left, right = vectors(queries, "query_id", query_kind), vectors(corpus, "id", corpus_kind)
    sides = left.drop("error"), right.drop("error")
    if n_cells:
        found = ann_knn(*sides, k, probes or n_cells, n_cells, repeated=True)
    else:
        found = knn(*sides, k, repeated=True)
    without = left.filter("error is not null").select("query_id", "error")
    return found.unionByName(without, allowMissingColumns=True)


def classify_few_shot(
    train: DataFrame, items: DataFrame, k: int = 10, count_refused: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(class probabilities, accuracy): ``train(id, vector, label)``,
    ``items(query_id, vector, label)``, both with an optional ``error``.

    Rows without a fitting vector are rows with an ``error`` (see ``knn_classify``); such items are
    misses in the accuracy, or not part of it without ``count_refused``.
    """
    train, items = stage_table(train, "training-items"), stage_table(items, "items")
    dims = common_length(train, items)
    probs = stage_table(knn_classify(train, items.drop("label"), k, dims=dims), "class-probabilities")
    labels = train.select("label").unionByName(items.select("label")).distinct()
    if not count_refused:
        good = usable(items, dims).select("query_id", "label")
        return probs, metrics.topk_accuracy(probs, good, labels)
    truth = items.select("query_id", "label")
    return probs, metrics.topk_accuracy(probs, truth, labels, refused=refused(items, dims))


def class_vectors(class_map: DataFrame, template: str = CAPTION_PROMPT) -> DataFrame:
    """``class_map(label, description)`` -> (id, label, vector, error) by the caption encoder.

    A description over the encoder's limit is cut into passages, one row each with the same id.
    """
    encoder = embed.CAPTION_ENCODER
    around = F.size(words(prompt(template, text=F.lit("x"), label=F.col("label")))) - 1
    room = F.greatest(F.lit(encoder.max_tokens) - around, F.lit(1))
    parts = class_map.select("label", F.explode_outer(embed.passages(F.col("description"), room)).alias("part"))
    text = prompt(template, text=F.col("part"), label=F.col("label"))
    made = embed.embed_with(parts.withColumn("text", text), encoder)
    return made.select(
        F.conv(F.substr(F.md5("label"), F.lit(1), F.lit(15)), 16, 10).cast("bigint").alias("id"),
        "label",
        F.col("embedding").alias("vector"),
        "error",
    )


def classify_zero_shot(
    class_map: DataFrame, items: DataFrame, template: str = CAPTION_PROMPT, k: int = 10
) -> DataFrame:
    """(query_id, label, prob, error): class descriptions take the place of training items.

    The best passage of a long description counts. An item without a vector is a row with an
    ``error`` (its own, if ``items`` has the column), and so is a class that cannot be embedded.
    Vectors of both sides are made once and stored, since the search reads them several times.
    """
    train = stage_table(class_vectors(class_map, template), "class-vectors")
    kept = [c for c in ("query_id", "vector", "error") if c in items.columns]
    return knn_classify(train, stage_table(items.select(*kept), "item-vectors"), k, repeated=True)


def classify_image_files(
    spark: SparkSession, train_path: str, valid_path: str, k: int = 10
) -> tuple[DataFrame, DataFrame]:
    """Few-shot classification of image folders, labels taken from the file names.

    Files that are no images are rows with an ``error``; the accuracy is over the images.
    """
    def vectors(path: str, key: str) -> DataFrame:
        made = embed_image_files(spark, path)
        return made.select(
            F.xxhash64("path").alias(key), F.col("embedding").alias("vector"), "label", "error"
        )

    return classify_few_shot(vectors(train_path, "id"), vectors(valid_path, "query_id"), k, count_refused=False)


def evaluate_translation(
    corpus: DataFrame,
    translate: Callable[[DataFrame], DataFrame],
    src_langs: list[str],
    tgt_lang: str,
    use_src: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(scores per language, one-row mean with the failed languages).

    ``corpus(idx, lang, sentence)`` holds every language of a parallel corpus under corpus codes,
    ``translate`` is a job from (doc_id, text, src_lang, tgt_lang) to (doc_id, translated_text) and
    an optional ``error``. A language with a failed block, or without any block, has no score and is
    listed as failed. Blocks and their translations are made once and stored.
    """
    spark = corpus.sparkSession
    wanted = spark.createDataFrame([(s,) for s in src_langs], "src string").select(
        "src", corpus_code(F.col("src")).alias("lang")
    )
    blocks = stage_table(metrics.make_blocks(corpus, group_by=["lang"]), "blocks")
    doc_id = F.concat_ws(":", "src", "batch", "part")
    sources = F.broadcast(wanted).join(blocks, "lang").select(
        doc_id.alias("doc_id"), "src", "batch", "part", "text",
        F.when(F.lit(use_src), F.col("src")).alias("src_lang"), F.lit(tgt_lang).alias("tgt_lang"),
    )
    references = blocks.filter(F.col("lang") == corpus_code(F.lit(tgt_lang))).select(
        "batch", "part", F.col("text").alias("ref")
    )
    results = translate(sources.select("doc_id", "text", "src_lang", "tgt_lang"))
    kept = [c for c in ("doc_id", "translated_text", "error") if c in results.columns]
    aligned = align_by_key(sources.drop("text"), results.select(*kept), ["doc_id"])
    pairs = stage_table(
        aligned.join(references, ["batch", "part"]).select(
            "doc_id", F.col("src").alias("lang"), F.col("translated_text").alias("hyp"), "ref",
            F.col("error").isNotNull().alias("failed"),
        ),
        "translated-blocks",
    )
    failed = pairs.where("failed").select("lang").distinct()  # at most the given languages
    scores = metrics.chrf(pairs.join(F.broadcast(failed), "lang", "left_anti"), ["lang"])
    return scores, metrics.mean_over_groups(wanted.select(F.col("src").alias("lang")), scores)


def compare_sources(
    corpus: DataFrame, translate: Callable[[DataFrame], DataFrame], src_langs: list[str], tgt_lang: str
) -> DataFrame:
    """(lang, with_src, without_src, difference, failed) with and without a given source language.

    One row per language with a score in either run, and a row without ``lang`` that has the mean
    scores and, as ``failed``, the languages that failed in either run.
    """
    parts, means = [], []
    for use_src in (True, False):
        scores, mean = evaluate_translation(corpus, translate, src_langs, tgt_lang, use_src)
        parts.append(scores.select("lang", F.lit(use_src).alias("use_src"), "score"))
        means.append(mean.select(F.lit(use_src).alias("use_src"), "mean_score", "failed"))
    effect = metrics.src_effect(parts[0].unionByName(parts[1]))
    both = means[0].unionByName(means[1])
    overall = both.agg(
        F.max(F.when(F.col("use_src"), F.col("mean_score"))).alias("with_src"),
        F.max(F.when(~F.col("use_src"), F.col("mean_score"))).alias("without_src"),
        F.concat(
            F.lit("with: "), F.max(F.when(F.col("use_src"), F.col("failed"))),
            F.lit("; without: "), F.max(F.when(~F.col("use_src"), F.col("failed"))),
        ).alias("failed"),
    ).withColumn("difference", F.col("with_src") - F.col("without_src"))
    return effect.unionByName(overall, allowMissingColumns=True)


def evaluate_lid(df: DataFrame, model: LanguageModel, key: str = "doc_id") -> DataFrame:
    """Per-language report for rows (key, text, truth); only the language part is compared."""
    found = detect_language_job(df.select(key, "text"), model, key)
    joined = df.select(key, "truth").join(
        found.select(key, F.get("lang", F.lit(0)).alias("pred")), key, "left"
    )
    return metrics.lid_f1(joined)


def evaluate_segmenter(golden: DataFrame) -> DataFrame:
    """Exact-match report for (lang, text, target)."""
    iso = to_iso1(golden, "lang", "iso1", iso1_table(golden.sparkSession))
    return metrics.golden_fraction(
        iso.withColumn("sentences", sentences(F.col("text"), F.col("iso1")))
    )
