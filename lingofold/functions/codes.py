"""Language and script codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .errors import INVALID_ARG, error_if

DEFAULT_TRANSLATOR = "seamlessm4t_text2text"
# Target language used when the request names none, by translator.
DEFAULT_TARGETS = {DEFAULT_TRANSLATOR: "eng", "nllb": "eng_Latn"}

# ISO 639-3 members of macrolanguages among the languages the default
# detector and translator know (public ISO 639-3 macrolanguage table). For the full table
# pass ``read_macrolanguages(...)`` to ``iso1_table``.
MACROLANGUAGE_MEMBERS = {
    "ara": "acm acq aeb ajp apc arb ars ary arz",
    "aym": "ayr",
    "aze": "azb azj",
    "est": "ekk",
    "fas": "pes prs",
    "ful": "fuv",
    "grn": "gug",
    "hbs": "bos hrv srp",
    "kau": "knc",
    "kon": "kng",
    "kur": "ckb kmr sdh",
    "lav": "ltg lvs",
    "mlg": "plt",
    "mon": "khk",
    "msa": "bjn ind min zlm zsm",
    "nep": "npi",
    "nor": "nno nob",
    "ori": "ory",
    "orm": "gaz",
    "pus": "pbt",
    "que": "quy",
    "sqi": "als",
    "srd": "src",
    "swa": "swh",
    "uzb": "uzn",
    "yid": "ydd",
    "zho": "cmn hak lzh nan wuu yue",
    "aka": "fat twi",
}
# Two-letter codes of macrolanguages the Java locale data does not list.
EXTRA_ISO1 = {"hbs": "sh", "nor": "no"}


# Withdrawn two-letter codes and their present form.
RENAMED_ISO1 = {"in": "id", "iw": "he", "ji": "yi", "mo": "ro"}


_own_codes: dict[str, str] = {}


def _iso1_codes(spark: SparkSession) -> dict[str, str]:
    """ISO 639-3 -> 639-1 of single languages, from the locale data of the Java runtime."""
    if not _own_codes:
        locale = spark._jvm.java.util.Locale
        for two in locale.getISOLanguages():
            three = locale.forLanguageTag(two).getISO3Language()
            if len(three) == 3:
                _own_codes[three] = RENAMED_ISO1.get(two, two)
        _own_codes.update(EXTRA_ISO1)
    return dict(_own_codes)


def iso1_table(spark: SparkSession, macrolanguages: DataFrame | None = None) -> DataFrame:
    """``(iso3, iso1)``: two-letter codes from the Java locale data, dialects folded.

    A member of a macrolanguage takes the two-letter code of the macrolanguage, even if it
    has one of its own. ``macrolanguages(macro, member)`` replaces the built-in members.
    """
    own = _iso1_codes(spark)
    base = spark.createDataFrame(sorted(own.items()), "iso3 string, iso1 string")
    if macrolanguages is None:
        members = [(m, own[macro]) for macro, names in MACROLANGUAGE_MEMBERS.items()
                   for m in names.split() if macro in own]
        table = dict(own)
        table.update(members)
        return spark.createDataFrame(sorted(table.items()), "iso3 string, iso1 string")
    folded = macrolanguages.join(
        F.broadcast(base), macrolanguages.macro == base.iso3
    ).select(F.col("member").alias("iso3"), "iso1")
    return base.join(folded.select("iso3"), "iso3", "left_anti").unionByName(folded)


def to_iso1(df: DataFrame, lang_col: str, out_col: str, table: DataFrame) -> DataFrame:
    """Two-letter code of ``lang_col``; codes missing from the table pass through.

    The table is bounded by the registered ISO codes (about 8,000), hence the broadcast.
    """
    lookup = table.select(F.col("iso3").alias("__iso3"), F.col("iso1").alias("__iso1"))
    return (
        df.join(F.broadcast(lookup), F.col(lang_col) == F.col("__iso3"), "left")
        .withColumn(out_col, F.coalesce("__iso1", lang_col))
        .drop("__iso3", "__iso1")
    )


def split_label(label: Column) -> tuple[Column, Column, Column]:
    """``__label__spa_Latn`` -> (lang, script, error); any other shape is a row error."""
    pattern = "^(?:__label__)?([^_]+)_([^_]+)$"
    good = label.rlike(pattern)
    lang = F.when(good, F.regexp_extract(label, pattern, 1))
    script = F.when(good, F.regexp_extract(label, pattern, 2))
    error = error_if(~good, INVALID_ARG, "label", F.concat(F.lit("malformed label "), label))
    return lang, script, error


def fix_chinese(lang: Column, script: Column) -> Column:
    """Chinese code the default translator expects; other codes unchanged."""
    traditional = F.coalesce(script == "Hant", F.lit(False))
    return F.when(lang == "zho", F.when(traditional, "cmn_Hant").otherwise("cmn")).otherwise(lang)


def default_target(target: Column, model: Column) -> Column:
    """The given target, else the translator's default; null when the translator is unknown."""
    chosen = F.lit(None).cast("string")
    for name, code in DEFAULT_TARGETS.items():
        chosen = F.when(model == name, F.lit(code)).otherwise(chosen)
    known = model.isin(*DEFAULT_TARGETS)
    return F.when(known, F.coalesce(target, chosen))


def lang_token(lang: Column) -> Column:
    """``eng`` -> ``__eng__``; already wrapped codes stay."""
    wrapped = lang.startswith("__") & lang.endswith("__")
    return F.when(wrapped, lang).otherwise(F.concat(F.lit("__"), lang, F.lit("__")))


# Translator code -> corpus code.
CORPUS_CODES = {"cmn_Hant": "zho_Hant", "cmn": "zho_Hans"}


def corpus_code(lang: Column) -> Column:
    code = lang
    for translator, corpus in CORPUS_CODES.items():
        code = F.when(lang == translator, F.lit(corpus)).otherwise(code)
    return code
