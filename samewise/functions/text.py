"""Text normalization as Column expressions; only NFKC needs an Arrow function, and only for rows it may change."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Quotes that become an apostrophe, quotes that become a space.
APOSTROPHES, QUOTES = "‘’ʼ`´", "“”\""
#: Characters beyond ASCII and the composed Latin letters, none of which NFKC leaves alone for sure.
COMPOSED = "[^\\x00-\\x7FÀ-ÖØ-öø-ÿ]"
INVISIBLE = "[​-‏﻿]"
LEGAL_FORMS = ("inc", "llc", "ltd", "company", "corporation", "corp")
_SPACE = "(?U)[\\s\\x1c-\\x1f]"
# What stands before is looked at after the character itself, which few positions hold.
_APOSTROPHE_ALONE = "'(?:(?<![\\p{L}\\p{N}]')|(?![\\p{L}\\p{N}]))"


def _nfkc(texts):
    import unicodedata

    return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))


def nfkc(c: Column) -> Column:
    """Unicode compatibility composition; ASCII strings are returned as they are."""
    return F.pandas_udf(_nfkc, "string")(c)


def may_compose(columns: list[str]) -> Column:
    """Whether NFKC may change one of the texts; ``by_form`` takes it from a column of this name if there is one."""
    return reduce(or_, (F.coalesce(F.col(c).cast("string"), F.lit("")).rlike(COMPOSED) for c in columns))


def by_form(df: DataFrame, columns: list[str], f: Callable[[DataFrame, bool], DataFrame]) -> DataFrame:
    """``f(rows, whether to compose)`` on rows whose texts NFKC may change and on the others, which need no Python."""
    may = F.col("may_compose") if "may_compose" in df.columns else may_compose(columns)
    return f(df.filter(~may), False).unionByName(f(df.filter(may), True))


def stripped(c: Column) -> Column:
    """Without white space of any kind at its ends."""
    return F.regexp_replace(c, f"^{_SPACE}+|{_SPACE}+$", "")


def safe_string(c: Column) -> Column:
    """Text without white space at its ends; null becomes empty, as the typed reader makes of NaN and other such cells."""
    return stripped(F.coalesce(c.cast("string"), F.lit("")))


def _folded(c: Column, unicode_form: bool) -> Column:
    c = F.coalesce(c.cast("string"), F.lit(""))
    c = F.lower(F.regexp_replace(nfkc(c) if unicode_form else c, INVISIBLE, ""))
    return F.translate(c, APOSTROPHES + QUOTES, "'" * len(APOSTROPHES) + " " * len(QUOTES))


def _replaced(c: Column, *steps: tuple[str, str]) -> Column:
    for pattern, by in steps:
        c = F.regexp_replace(c, pattern, by)
    return c


def normalize_name(c: Column, unicode_form: bool = True) -> Column:
    """Lower-cased letters, marks and numbers with inner apostrophes, ``&`` and ``+``."""
    steps = (("[^\\p{L}\\p{M}\\p{N}'&+]", " "), (_APOSTROPHE_ALONE, " "), ("[&+](?<=\\s[&+])(?=\\s)", " "), (f"{_SPACE}+", " "))
    return F.trim(_replaced(_folded(c, unicode_form), *steps))


# The patterns of the address rules, in their order.
def normalize_address(c: Column, unicode_form: bool = True) -> Column:
    """Lower-cased address with single commas, inner hyphens and slashes kept."""
    s = _SPACE
    steps = (
        ("[<>()\\[\\]{}#~*_!?;]", " "),
        ("\\.{2,}", " "),
        ("-{2,}", " "),
        (",{2,}", ","),
        (f"\\.(?={s}|,|$)", ""),
        (f"{s}+-{s}+", " "),
        (f"(?<={s})-(?=[0-9])", ""),
        (f"(?<={s})[-/](?={s})", " "),
        (_APOSTROPHE_ALONE, " "),
        (f"{s}*,{s}*", ", "),
        (f"^(?:,|{s})+|(?:,|{s})+$", ""),
        (f"{s}+", " "),
    )
    return F.trim(_replaced(_folded(c, unicode_form), *steps))


def address_key(c: Column, unicode_form: bool = True) -> Column:
    """Letters a-z and digits of the address; no step of ``normalize_address`` adds or drops one."""
    c = F.coalesce(c.cast("string"), F.lit(""))
    return F.regexp_replace(F.lower(nfkc(c) if unicode_form else c), "[^a-z0-9]+", "")


def feature_text(c: Column) -> Column:
    """ASCII letters and digits, lower-cased, single spaces."""
    return F.trim(F.regexp_replace(F.lower(safe_string(c)), "[^a-z0-9]+", " "))


def core_name(normalized: Column) -> Column:
    return F.trim(F.regexp_replace(normalized, f"\\b(?:{'|'.join(LEGAL_FORMS)})\\b", ""))


def last_pin(c: Column) -> Column:
    """The last run of five or six digits that stands alone; null if none."""
    return F.try_element_at(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("(?<![\\p{L}\\p{N}_])\\p{Nd}{5,6}(?![\\p{L}\\p{N}_])"), F.lit(0)), F.lit(-1))


#: Words that mark a number as a postal code, or as something else, and streets that a number may belong to.
CODE_WORDS = "pin|pincode|pin ?code|zip|zipcode|zip ?code|postal ?code|code ?postal"
NOT_SIX = "flat|plot|survey|sy|house|h\\.no|po ?box|road|rd|highway|hwy|route|rt"
NOT_FIVE = "po ?box|box|suite|ste|unit|apt|apartment|fl|floor|room|rm|plot|flat"
ROADS = "rd|road|hwy|highway|street|st|ave|blvd|lane|ct"
STREETS = "rd|road|st|street|ave|avenue|blvd|boulevard|lane|ln|drive|dr|way|court|ct|trail|highway|hwy|circle|cir|terrace|ter"


def postal_code(c: Column) -> Column:
    """A code after a keyword, else the last plausible six-digit, else the last plausible five-digit number; null if none.

    What stands before and after a number is looked at by bounded look-around, which white space as single spaces allows.
    """
    text = stripped(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), f"{_SPACE}+", " "))
    number = " ?(?:no\\.?|#)? ?[:\\-]? ?"
    keyword = f"(?iU)\\b(?:{CODE_WORDS}) ?[:\\-#]? ?([0-9]{{5,6}})\\b"
    six = f"(?iU)(?<!\\b(?:{NOT_SIX}){number})(?!^[0-9]{{6}} ?(?:\\d+ )?(?:{ROADS})\\b)\\b[1-9][0-9]{{5}}\\b"
    five = f"(?iU)(?<!\\b(?:{NOT_FIVE}){number})(?!^)\\b(?>([0-9]{{5}})(?:-[0-9]{{4}})?\\b)(?! ?[a-z0-9\\-]+ (?:{STREETS})\\b)"
    last = lambda pattern, group: F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.lit(-1))
    first = F.regexp_extract(text, keyword, 1)
    return F.coalesce(F.when(first != "", first), last(six, 0), last(five, 1))
