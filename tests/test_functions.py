import pytest
from pyspark.sql import functions as F

from lingofold.functions import codes, text, vectors
from lingofold.operators import options, validate


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def rows(spark, values, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(values, schema).coalesce(1).select(*columns).collect()]


def test_split_label(spark):
    lang, script, error = codes.split_label(F.col("l"))
    got = rows(spark, [("__label__spa_Latn",), ("__label__spa",), ("a_b_c",)], "l string",
               lang, script, error["code"])
    assert got == [("spa", "Latn", None), (None, None, "INVALID_ARG"), (None, None, "INVALID_ARG")]


def test_iso1(spark):
    want = {"eng": "en", "ary": "ar", "prs": "fa", "yue": "zh", "zlm": "ms", "fr": "fr",
            "xxx": "xxx", "bos": "sh", "nob": "no", "deu": "de", "heb": "he", "ind": "ms"}
    df = spark.createDataFrame([(c,) for c in want], "c string")
    got = codes.to_iso1(df, "c", "iso1", codes.iso1_table(spark)).collect()
    assert {r.c: r.iso1 for r in got} == want


def test_iso1_with_full_macrolanguage_table(spark, tmp_path):
    path = tmp_path / "macro.tab"
    path.write_text("M_Id\tI_Id\tI_Status\nara\tabh\tA\nara\tzzz\tR\nzho\tgan\tA\n")
    from lingofold.sources.corpora import read_macrolanguages

    table = codes.iso1_table(spark, read_macrolanguages(spark, str(path)))
    got = {r.iso3: r.iso1 for r in table.collect()}
    assert got["abh"] == "ar" and got["gan"] == "zh" and got["eng"] == "en" and "zzz" not in got


def test_chinese_targets_tokens_corpus(spark):
    got = rows(spark, [("zho", "Hant"), ("zho", "Hans"), ("zho", None), ("yue", "Hant"), ("eng", None)],
               "l string, s string", codes.fix_chinese(F.col("l"), F.col("s")))
    assert [g[0] for g in got] == ["cmn_Hant", "cmn", "cmn", "yue", "eng"]
    got = rows(spark, [(None, codes.DEFAULT_TRANSLATOR), (None, "nllb"), ("fra", "nllb"), ("fra", "no")],
               "t string, m string", codes.default_target(F.col("t"), F.col("m")))
    assert [g[0] for g in got] == ["eng", "eng_Latn", "fra", None]
    got = rows(spark, [("eng",), ("__eng__",), ("cmn_Hant",)], "l string", codes.lang_token(F.col("l")))
    assert [g[0] for g in got] == ["__eng__", "__eng__", "__cmn_Hant__"]
    got = rows(spark, [("cmn_Hant",), ("cmn",), ("deu",)], "l string", codes.corpus_code(F.col("l")))
    assert [g[0] for g in got] == ["zho_Hant", "zho_Hans", "deu"]


def test_text(spark):
    assert one(spark, text.label_from_path(F.lit("/a/n01440764/n01440764_3198.JPEG"))) == "n01440764"
    assert one(spark, text.flatten_newlines(F.lit("a\nb\r\nc"))) == "a b\r c"
    assert one(spark, text.prompt("x {a} y {b}.", a=F.lit("1"), b=F.lit("2"))) == "x 1 y 2."
    assert one(spark, text.words(F.lit("  \n "))) == []
    assert one(spark, text.words(F.lit(" a\tb\n c "))) == ["a", "b", "c"]


@pytest.mark.parametrize("value, want", [
    ("hello", "Latn"), ("привет", "Cyrl"), ("日本", "Hans"), ("한국어", "Hang"), ("123", None),
    ("aб", "Latn"), ("カタカナ語", "Jpan"), ("ગુજરાતી", "Gujr"), ("ქართული", "Geor"), ("", None), ("ᱚᱞ 𐐀", "Olck"),
])
def test_dominant_script(spark, value, want):
    assert one(spark, text.dominant_script(F.lit(value))) == want


def test_scripts_equal_patterns(spark, monkeypatch):
    import random

    import regex

    pick = random.Random(4)
    letters = [chr(pick.choice([pick.randrange(32, 0x3000), pick.randrange(0x10000)])) for _ in range(4000)]
    rows = ["".join(pick.choices(letters, k=pick.randrange(40))).encode("utf-8", "ignore").decode() for _ in range(300)] + [None]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string").select(
        "i", text.dominant_script(F.col("t")).alias("s")).collect()
    for r in got:
        counts = [len(regex.findall("|".join(rf"\p{{Script={n}}}" for n in names.split()), rows[r.i] or ""))
                  for names in text.SCRIPTS.values()]
        want = list(text.SCRIPTS)[counts.index(max(counts))] if max(counts) else None
        assert r.s == want


def test_decode(spark):
    df = spark.createDataFrame([(bytearray(b"ab\xc3\xa9"),), (bytearray(b"\xff\x41"),), (None,)], "b binary")
    value, error = text.decode_text(F.col("b"))
    got = [tuple(r) for r in df.coalesce(1).select(value, error["code"]).collect()]
    assert got == [("abé", None), (None, "INVALID_ARG"), (None, None)]


def test_decode_image_bytes(spark):
    df = spark.createDataFrame(
        [(bytearray(b"aGk="), True), (bytearray(b"!!!"), True), (bytearray(b"!!!"), False),
         (bytearray(b"aG\nk="), True), (bytearray(b"aGk"), True), (bytearray(b"hi"), None)],
        "c binary, f boolean",
    )
    value, error = text.decode_image_bytes(F.col("c"), F.col("f"))
    got = [(r[0] and bytes(r[0]), r[1]) for r in df.coalesce(1).select(value, error["code"]).collect()]
    assert got == [(b"hi", None), (None, "INVALID_ARG"), (b"!!!", None), (b"hi", None),
                   (None, "INVALID_ARG"), (b"hi", None)]


def test_vectors(spark):
    ids = F.array(*[F.lit(x).cast("bigint") for x in (5, 9)])
    assert one(spark, vectors.pad_ids(ids, 4)) == [5, 9, 1, 1]
    assert one(spark, vectors.pad_ids(ids, 1)) == [5, 9]
    assert one(spark, vectors.attention_mask(vectors.pad_ids(ids, 4))) == [1, 1, 0, 0]
    half = F.array(F.lit(0.5), F.lit(0.5))
    assert one(spark, vectors.l2_normalize(half)) == pytest.approx([0.7071067811865475] * 2)
    zero = F.array(F.lit(0.0), F.lit(0.0))
    assert one(spark, vectors.l2_normalize(zero)) == [0.0, 0.0]
    assert one(spark, vectors.cosine(half, zero)) is None
    assert one(spark, vectors.cosine_distance(half, half)) == pytest.approx(0.0, abs=1e-12)


def test_prefix(spark):
    got = rows(spark, [("query: x",), ("passage: x",), ("Query: x",), ("query:x",)], "t string",
               validate.require_prefix(F.col("t")).isNull())
    assert [g[0] for g in got] == [True, True, False, False]


def test_options(spark):
    df = spark.createDataFrame(
        [({"top_k": "3"},), ({"top_k": "x"},), (None,), ({"threshold": "0.5"},)], "params map<string,string>"
    ).coalesce(1)
    got = [(r.top_k, r.threshold, r.option_error is None)
           for r in options.with_options(df, options.DETECT_DEFAULTS).collect()]
    assert got == [(3, 0.0, True), (1, 0.0, False), (1, 0.0, True), (1, 0.5, True)]


def test_require_language_source_first(spark):
    supported = spark.createDataFrame([("eng",), ("__fra__",)], "lang string")
    df = spark.createDataFrame(
        [(1, "eng", "fra"), (2, "tlh", "xyz"), (3, "eng", "xyz"), (4, None, "eng")],
        "id int, src string, tgt string",
    )
    got = {r.id: r.language_error for r in validate.require_language(df, supported).collect()}
    assert got[1] is None
    assert "source language tlh" in got[2].message and "__eng__, __fra__" in got[2].message
    assert "target language xyz" in got[3].message
    assert "source" in got[4].message


def test_grams_of_many_blocks_are_counted_together():
    from lingofold.operators import ngrams

    text = "abc " * (ngrams.BLOCK // 2)
    blocks = list(ngrams.count_grams([text, None, "abc"], 3))
    assert len(blocks) == 1
    found = dict(zip(*blocks[0]))
    assert found["abc"] == ngrams.BLOCK // 2 + 1 and found["bc "] == found["abc"]
