"""Normalization of record texts and the keys derived from them, as Column expressions."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Legal forms, address abbreviations and first words too common for a key.
LEGAL_FORMS = (
    r"\b(corp(?:oration)?|inc(?:orporated)?|ltd|limited|pvt|private|llc|llp|co|company|enterprises?|services?|solutions?"
    r"|group|technologies|tech|sarl|sas|gmbh|ag|plc)\b"
)
ADDRESS_WORDS = {
    "rd": "road", "st": "street", "ave": "avenue", "blvd": "boulevard", "hwy": "highway", "apt": "apartment", "ste": "suite",
    "fl": "floor", "nr": "near", "opp": "opposite", "bldg": "building", "dist": "district", "ctr": "center",
    "intl": "international", "no": "number",
}
COMMON_FIRST_WORDS = [
    "the", "a", "an", "new", "old", "national", "global", "international", "american", "general", "united", "first", "best", "top",
    "prime", "great", "good", "super", "mega", "metro", "city", "state", "central", "north", "south", "east", "west", "royal",
    "golden", "blue", "green", "red", "white", "black", "star", "sun", "sky", "land", "home", "world", "modern", "standard",
    "professional", "premium", "elite", "alpha", "omega", "apex", "delta", "sigma", "shri", "sri", "m", "s", "r", "k",
]


def fold_text(x: str | None) -> str | None:
    """Compatibility decomposition without all that is not ASCII."""
    return x if x is None or x.isascii() else unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode()


@F.arrow_udf(T.StringType())
def _fold(x: pa.Array) -> pa.Array:
    return pa.array([fold_text(v) for v in x.to_pylist()], pa.string())


def text(c: Column) -> Column:
    """Null as the empty string."""
    return F.coalesce(c, F.lit(""))


def ascii_fold(c: Column) -> Column:
    return _fold(text(c))


def strip(c: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def _words_only(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"[^\w\s]", " "), r"\s+", " "))


def clean_name(folded: Column) -> Column:
    """Lower case, '&' as 'and', legal forms and punctuation removed; of an already folded name."""
    return _words_only(F.regexp_replace(F.regexp_replace(F.lower(folded), "&", " and "), LEGAL_FORMS, " "))


def clean_addr(folded: Column) -> Column:
    """Lower case, abbreviations written out, punctuation removed; of an already folded address."""
    full = reduce(lambda c, w: F.regexp_replace(c, rf"\b{w[0]}\b", w[1]), ADDRESS_WORDS.items(), F.lower(folded))
    return _words_only(full)


def extract_postal(raw: Column) -> Column:
    """The first token of five or six digits of the address as delivered, else ''."""
    return F.regexp_extract(text(raw), r"(?U)\b(\d{5,6})\b", 1)


def country_key(c: Column) -> Column:
    return F.lower(strip(text(c)))


def tokens(c: Column) -> Column:
    """Tokens between white space; the empty text has none."""
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


def first_word(c: Column) -> Column:
    return F.coalesce(F.get(tokens(c), F.lit(0)), F.lit(""))


def sorted_2word(c: Column) -> Column:
    """The first two tokens in order of their bytes, joined."""
    return F.array_join(F.array_sort(F.slice(tokens(c), 1, 2)), "")


def numbers(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"(\d+)"), 1)


def sorted_nums(c: Column) -> Column:
    """All digit runs in string order, joined."""
    return F.array_join(F.array_sort(numbers(c)), "")


def soundex_key(word: Column) -> Column:
    """Soundex of a word; one that starts with no letter gets that character and three zeros or the codes of its letters."""
    letter = F.soundex(F.regexp_replace(word, r"[^a-zA-Z]", ""))
    other = F.rpad(F.concat(F.substring(word, 1, 1), F.regexp_replace(F.substring(F.soundex(F.concat(F.lit("a"), F.regexp_replace(word, r"[^a-zA-Z]", ""))), 2, 3), "0+$", "")), 4, "0")
    return F.when(word == "", "").when(word.rlike("^[a-zA-Z]"), letter).otherwise(other)


def grams(c: Column, n: int) -> Column:
    """All substrings of n characters, in order; none for shorter texts."""
    return F.when(F.length(c) >= n, F.transform(F.sequence(F.lit(1), F.length(c) - F.lit(n - 1)), lambda i: F.substr(c, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def name_trigrams(clean: Column) -> Column:
    return grams(F.replace(clean, F.lit(" "), F.lit("")), 3)


def word_grams(c: Column, low: int = 2, high: int = 4) -> Column:
    """Character n-grams inside words padded with one space each side; a padded word shorter than n gives itself once."""

    def of(word: Column) -> Column:
        padded = F.concat(F.lit(" "), word, F.lit(" "))
        return F.flatten(
            F.transform(
                F.sequence(F.lit(low), F.least(F.lit(high), F.length(padded))),
                lambda n: F.transform(F.sequence(F.lit(1), F.length(padded) - n + 1), lambda i: F.substr(padded, i, n)),
            )
        )

    return F.flatten(F.transform(tokens(F.lower(c)), of))
