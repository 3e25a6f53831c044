"""Names of ports and destinations."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Beginnings, endings and whole names that are no destinations.
BAD_PREFIXES = (
    "RESCUE", "FISHFARMS", "TLF ", "TEL ", "CALL ", "PHONE", "FISHING", "MOB ", "SAR ", "SEARCH AND RESCUE", "POLICE", "ON DUTY", "WORKING",
    "SURVEYING", "SEA TRIAL", "CH ", "VHF CH", "PESCA ", "DREDGE ",
)
BAD_SUFFIXES = (
    "FOR ORDER", "TOWING", "CRUISING", "OIL FIELDS", "OIL FIELD", "DREDGE", "PARADE", "TRADE", "WORK", " TRIAL", "PESCA", "PECHE", "OIL FIELDS",
    "HARBOR DUTY", " ESCORT", "SAILING",
)
BAD_NAMES = (
    "CITY", "B # A", "AN", "NULL", "T #NKCL KR V", "A ARO", "VIGO MOANA VIGO", "BDAM VIA NOK", "GILLNETTER #", "OIL AND GAS ACTIVITY", "# #", "HOME",
    "A B C O", "SOUTH FLORIDA", "# T E D JT", "O P", "M Y SPACE OR SHORE", "OWER BY NAVALMARINE", "A#B #GD E", "Y B AND Y YY AND FY AND X",
    "# # N # # E", "ON THE BAY", "PLY PTOWN PLY", "SPLIT DUBROVNIK SPLI", "#O#", "BBBBBBBBB", "# # #", "ON THE BAY", "NO DESTINATION", "CLASSIFIED",
)

# Letters that have no decomposition; upper case.
LETTERS = {
    "Ø": "O", "Æ": "AE", "Œ": "OE", "ß": "SS", "ẞ": "SS", "Þ": "TH", "Ð": "D", "Đ": "D", "Ł": "L", "Ħ": "H", "İ": "I", "ı": "I",
    "А": "A", "Б": "B", "В": "V", "Г": "G", "Д": "D", "Е": "E", "Ж": "ZH", "З": "Z", "И": "I", "К": "K", "Л": "L", "М": "M", "Н": "N", "О": "O", "П": "P",
    "Р": "R", "С": "S", "Т": "T", "У": "U", "Ф": "F", "Х": "KH", "Ц": "TS", "Ч": "CH", "Ш": "SH", "Щ": "SHCH", "Ъ": "'", "Ы": "Y", "Ь": "'", "Э": "E", "Ю": "IU", "Я": "IA",
    "Α": "A", "Β": "B", "Γ": "G", "Δ": "D", "Ε": "E", "Ζ": "Z", "Η": "E", "Θ": "TH", "Ι": "I", "Κ": "K", "Λ": "L", "Μ": "M", "Ν": "N", "Ξ": "X", "Ο": "O", "Π": "P", "Ρ": "R",
    "Σ": "S", "Τ": "T", "Υ": "U", "Φ": "PH", "Χ": "KH", "Ψ": "PS", "Ω": "O",
}


def normalize_name(x: Column) -> Column:
    """Upper case, & as AND, runs of anything but letters, digits and underscores as one space, trimmed."""
    return F.trim(F.regexp_replace(F.replace(F.upper(x), F.lit("&"), F.lit(" AND ")), r"[^\p{L}\p{N}_]+", " "))


def is_valid_name(x: Column) -> Column:
    n = F.regexp_replace(x, r"\p{Nd}+", "#")
    prefix = n.rlike("^(" + "|".join(BAD_PREFIXES) + ")")
    suffix = n.rlike("(" + "|".join(dict.fromkeys(BAD_SUFFIXES)) + ")$")
    return (F.char_length(n) > 1) & ~prefix & ~suffix & ~n.isin(*dict.fromkeys(BAD_NAMES))


def normalized_valid_names(names: Column) -> Column:
    """The valid ones of an array of raw names, normalised."""
    return F.filter(F.transform(names, normalize_name), is_valid_name)


def other_letters(spark: SparkSession) -> dict[str, str]:
    """Letters of all other scripts of the basic plane, by the transliteration rules of the ICU library inside Spark; Han syllables end in a space."""
    own = [chr(c) for c in range(0x80, 0xFFFF) if unicodedata.category(chr(c)) in ("Lu", "Ll", "Lo", "Lt", "Lm", "Nd", "Pd", "Pi", "Pf") and chr(c) not in LETTERS]
    icu = spark.sparkContext._jvm.com.ibm.icu.text.Transliterator.getInstance("Any-Latin; Latin-ASCII")
    found = icu.transliterate("\n".join(own)).split("\n")
    out = {}
    for c, x in zip(own, found, strict=True):
        x = "".join(d for d in unicodedata.normalize("NFKD", x) if d.isascii() and d != "~").upper()  # ~ marks small kana
        if x:
            out[c] = x + " " if unicodedata.name(c, "").startswith("CJK UNIFIED") else x
    return out


def to_ascii(text: str | None, more: dict[str, str] | None = None) -> str | None:
    """ASCII upper case; null for null and blank. more: letters beyond the table; letters in neither and without a decomposition are left out."""
    if text is None or not text.strip():
        return None
    more = more or {}
    out = []
    for c in unicodedata.normalize("NFC", text.strip()).upper():
        if c in LETTERS:
            out.append(LETTERS[c])
            continue
        plain = unicodedata.normalize("NFKD", c)
        if not any(d.isascii() or d in LETTERS for d in plain) and c in more:
            out.append(more[c])
            continue
        for d in plain:
            out.append(d if d.isascii() else "" if unicodedata.combining(d) else LETTERS.get(d) or more.get(d, ""))
    return "".join(out).strip()


_SENT: dict[str, Broadcast] = {}


def _letters() -> Broadcast:
    """other_letters(), sent once for each application: some 30,000 short strings, whatever the data."""
    spark = SparkSession.getActiveSession()
    app = spark.sparkContext.applicationId
    if app not in _SENT:
        _SENT[app] = spark.sparkContext.broadcast(other_letters(spark))
    return _SENT[app]


def normalize_label(label: Column) -> Column:
    sent = _letters()

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield s.map(lambda x: to_ascii(x, sent.value))

    return run(label)
