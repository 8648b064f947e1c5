"""Text rules as Column expressions.

The whitespace class is Unicode whitespace plus the four ASCII separators U+001C-U+001F;
a word character is a Unicode letter, number or underscore.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from brandlens.contract import (
    COUNTRY_SYNONYMS, LEGAL_FORMS, MISSING_WORDS, NA_WORDS, UNKNOWN_COUNTRY, UNKNOWN_DOMAIN,
)

# The whitespace characters, as a set to trim and as regex ranges. Ranges are
# cheaper per character than Unicode properties.
SPACES = "".join(map(chr, [*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]))
NOT_PLAIN = r"\t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE = f"[ {NOT_PLAIN}]"
VISIBLE = f"[^ {NOT_PLAIN}]"
# Whitespace beyond what the regex class \s knows; texts without it take a much faster pattern.
RARE_SPACE = r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
WORD = r"\p{L}\p{N}_"
# The look-behind comes last, so that it runs only where four digits were found.
YEAR_MENTION = rf"(?:1[89]|20)\p{{Nd}}{{2}}(?<![{WORD}][\s\S]{{4}})(?![{WORD}])"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def squeeze(c: Column) -> Column:
    """Runs of whitespace to one space; single plain spaces need no replacement."""
    full = F.regexp_replace(c, f"{SPACE}{{2,}}|[{NOT_PLAIN}]", " ")
    return F.when(c.rlike(RARE_SPACE), full).otherwise(F.regexp_replace(c, r"\s{2,}|[\t-\r]", " "))


def is_blank(c: Column) -> Column:
    """True for text without any visible character; null counts as blank."""
    return F.coalesce(~c.rlike(VISIBLE), F.lit(True))


def basic_text(c: Column) -> Column:
    """Strip, lower, drop zero-width spaces, squeeze; null becomes empty text."""
    return F.coalesce(squeeze(F.translate(F.lower(strip(c)), "\u200b", "")), F.lit(""))


def tokens(c: Column) -> Column:
    return F.filter(F.split(c, f"{SPACE}+"), lambda t: t != "")


def clean_name(c: Column, yo: bool = True) -> Column:
    """Lower-case word tokens without legal forms, each kept once in first-seen order.

    Without ``yo`` the letter ё separates words, as an older rule had it.
    """
    letters = F.regexp_replace(basic_text(c), "[^a-zа-яё0-9 ]" if yo else "[^a-zа-я0-9 ]", " ")
    kept = F.filter(F.split(letters, " +"), lambda t: (t != "") & ~t.isin(LEGAL_FORMS))
    return F.array_join(F.array_distinct(kept), " ")


def country_key(c: Column) -> Column:
    return strip(squeeze(F.regexp_replace(basic_text(c), rf"[^{WORD} ,-]", "")))


def country(c: Column) -> Column:
    """Synonyms to one spelling, empty keys to unknown, anything else stripped but kept."""
    key = country_key(c)
    synonyms = F.create_map(*[F.lit(x) for pair in COUNTRY_SYNONYMS.items() for x in pair])
    return F.when(key == "", F.lit(UNKNOWN_COUNTRY)).otherwise(
        F.coalesce(F.try_element_at(synonyms, key), strip(c))
    )


def domain(c: Column) -> Column:
    return F.coalesce(F.nullif(squeeze(strip(c)), F.lit("")), F.lit(UNKNOWN_DOMAIN))


def domain_key(c: Column) -> Column:
    return strip(squeeze(F.regexp_replace(basic_text(c), rf"[^{WORD} ]", " ")))


def char_count(c: Column) -> Column:
    """Code points of the text as it is; null counts zero."""
    return F.length(F.coalesce(c, F.lit("")))


def word_count(c: Column) -> Column:
    """Whitespace-separated words. Counted by word starts, so no array is built."""
    full = F.regexp_count(c, F.lit(f"{VISIBLE}+"))
    plain = F.regexp_count(c, F.lit(r"\S+"))
    return F.when(c.isNull(), 0).when(c.rlike(RARE_SPACE), full).otherwise(plain).cast("int")


def has_digit(c: Column) -> Column:
    return F.coalesce(c.rlike(r"\p{Nd}"), F.lit(False)).cast("int")


def year_mentions(c: Column) -> Column:
    """Stand-alone four-digit years 18xx, 19xx, 20xx."""
    return F.regexp_count(F.coalesce(c, F.lit("")), F.lit(YEAR_MENTION)).cast("int")


def empty_flag(c: Column) -> Column:
    return is_blank(c).cast("int")


def missing_text(c: Column) -> Column:
    """The result view's idea of missing: null or one of the missing words."""
    return F.coalesce(F.lower(strip(c.cast("string"))).isin(MISSING_WORDS), F.lit(True))


def na_to_null(c: Column) -> Column:
    return F.when(~c.isin(NA_WORDS), c)
