"""Sentence segmentation in built-in expressions: protect, mark, split, restore."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from lingofold.functions.text import BLANKS

from .sentence_ends import SentenceEnds

# Abbreviations that do not end a sentence, without their last dot.
ABBREVIATIONS = {
    "en": "Mr Mrs Ms Dr Prof Sr Jr St Gen Col Capt Lt Rev Hon etc vs cf viz al Inc Ltd Co No Fig "
          "Jan Feb Mar Apr Jun Jul Aug Sep Sept Oct Nov Dec",
    "de": "Dr Prof Hr Fr Nr Str bzw usw ca evtl ggf inkl vgl Abb Bd St Jh",
    "fr": "M MM Mme Mlle Dr Pr etc cf env av apr ex St Ste",
    "es": "Sr Sra Srta Dr Dra Prof Ud Uds etc cf pág núm Av",
    "it": "Sig Dott Prof ecc cfr pag",
    "pt": "Sr Sra Dr Dra Prof etc pág",
    "nl": "dhr mevr dr prof bijv enz nl",
}
UNSPLIT = ("th", "km")

HOLD = "\u0001"
CUT = "\u0002"
KEEP = "\u0003"
EDGE = r"(^|[^\p{L}\p{N}])"
# Two single letters with dots (i.e., e.g., a.m., z.B.), then single capital initials.
LETTER_PAIR = EDGE + r"(\p{L})\.([ ]?)(\p{L})\."
INITIAL = EDGE + r"(\p{Lu})\."
# A word in lower case goes on with the sentence behind a full stop, and behind a closing quote.
GOES_ON = r"""(\.+|[.!?…؟।۔]+["'»”’)\]]+)([ \t]+["'«„“(\[]*\p{Ll})"""
END = r"""([.!?…؟।۔]+["'»”’)\]]*)[ \t\n\r\f]+"""
NOTHING = r"([^\s\S])([^\s\S])"
FULL_WIDTH_END = "([。！？]+[」』”]*)"


def _abbreviation(names: tuple[str, ...]) -> str:
    return EDGE + "(" + "|".join(names) + r")\."


def _of_lang(lang: Column, patterns: dict[str, str], other: str) -> Column:
    chosen = F.lit(other)
    for code, pattern in patterns.items():
        chosen = F.when(lang == code, F.lit(pattern)).otherwise(chosen)
    return chosen


def sentences(text: Column, lang: Column, learned: SentenceEnds | None = None) -> Column:
    """Ordered array of trimmed, non-empty sentences; ``lang`` is a two-letter code.

    Every character of the text is kept except the blanks between sentences. A full stop or a closing
    quote before a word in lower case ends nothing. ``learned`` abbreviations, in any case, are held
    like the built-in ones, and a learned sentence starter behind an abbreviation begins a sentence.
    """
    held = F.regexp_replace(text, LETTER_PAIR, f"$1$2{HOLD}$3$4{HOLD}")
    names = {code: _abbreviation(tuple(found.split())) for code, found in ABBREVIATIONS.items()}
    held = F.regexp_replace(held, _of_lang(lang, names, NOTHING), f"$1$2{HOLD}")
    if learned and learned.abbreviations:
        found = {
            code: "(?iu)" + _abbreviation(tuple(re.escape(n) for n in sorted(types, key=len, reverse=True)))
            for code, types in learned.abbreviations.items()
        }
        held = F.regexp_replace(held, _of_lang(lang, found, NOTHING), f"$1$2{HOLD}")
    held = F.regexp_replace(held, INITIAL, f"$1$2{HOLD}")
    if learned and learned.starters:
        found = {
            code: HOLD + r"([ \t\n\r\f]+)((?:" + "|".join(re.escape(w[0].upper() + w[1:]) for w in types)
            + r")(?![\p{L}\p{N}]))"
            for code, types in learned.starters.items()
        }
        held = F.regexp_replace(held, _of_lang(lang, found, NOTHING), ".$1$2")
    held = F.regexp_replace(held, GOES_ON, f"$1{KEEP}$2")
    marked = F.regexp_replace(
        F.regexp_replace(held, END, f"$1{CUT}"), FULL_WIDTH_END, f"$1{CUT}"
    )
    pieces = F.transform(
        F.split(marked, CUT),
        lambda s: F.btrim(F.translate(s, HOLD + KEEP, "."), F.lit(BLANKS)),
    )
    whole = F.array(F.btrim(text, F.lit(BLANKS)))
    chosen = F.when(lang.isin(*UNSPLIT), whole).otherwise(pieces)
    return F.filter(chosen, lambda s: s != "")
