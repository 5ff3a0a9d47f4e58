"""Text functions as column expressions."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType


def capitalize(c: Column) -> Column:
    """First letter of the whole string upper case, the rest lower."""
    return F.concat(F.upper(F.left(c, F.lit(1))), F.lower(F.substr(c, F.lit(2))))


def title(c: Column) -> Column:
    return F.initcap(c)


def swapcase(c: Column) -> Column:
    swapped = F.transform(F.split(c, ""), lambda x: F.when(x == F.upper(x), F.lower(x)).otherwise(F.upper(x)))
    return F.array_join(swapped, "")


def find(c: Column, part: str) -> Column:
    """0-based position of the first occurrence, -1 when absent."""
    return F.instr(c, part) - 1


def rfind(c: Column, part: str) -> Column:
    back = F.instr(F.reverse(c), part[::-1])
    return F.when(back == 0, -1).otherwise(F.length(c) - back - len(part) + 1)


def ljust(c: Column, width: int, fill: str = " ") -> Column:
    """Pad on the right; a longer string is left whole."""
    return F.when(F.length(c) < width, F.rpad(c, width, fill)).otherwise(c)


def rjust(c: Column, width: int, fill: str = " ") -> Column:
    return F.when(F.length(c) < width, F.lpad(c, width, fill)).otherwise(c)


def center(c: Column, width: int, fill: str = " ") -> Column:
    gap = F.greatest(F.lit(width) - F.length(c), F.lit(0))
    # An odd gap puts the extra character on the left when the width is odd.
    left = F.floor(gap / 2).cast("int") + (gap.bitwiseAND(F.lit(width)).bitwiseAND(F.lit(1)))
    return F.concat(F.repeat(F.lit(fill), left), c, F.repeat(F.lit(fill), gap - left))


def zfill(c: Column, width: int) -> Column:
    """Pad with zeros after a leading sign."""
    sign = F.regexp_extract(c, r"^[+-]", 0)
    body = F.regexp_replace(c, r"^[+-]", "")
    gap = F.greatest(F.lit(width) - F.length(c), F.lit(0))
    return F.concat(sign, F.repeat(F.lit("0"), gap), body)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


# What each character test accepts; an empty string passes none.
CLASS_PATTERNS = {
    "isalnum": r"^[\p{L}\p{N}]+$",
    "isalpha": r"^\p{L}+$",
    "isdigit": r"^\p{Nd}+$",
    "isdecimal": r"^\p{Nd}+$",
    "isnumeric": r"^\p{N}+$",
    "isspace": r"^\s+$",
    "istitle": r"^[^\p{L}]*(\p{Lu}\p{Ll}*[^\p{L}]+)*\p{Lu}\p{Ll}*[^\p{L}]*$",
}


def is_class(c: Column, name: str) -> Column:
    if name == "islower":
        return (c == F.lower(c)) & (c != F.upper(c))
    if name == "isupper":
        return (c == F.upper(c)) & (c != F.lower(c))
    return c.rlike(CLASS_PATTERNS[name])


def words(c: Column) -> Column:
    """Split on runs of white space, empty pieces dropped."""
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


def partition(c: Column, sep: str) -> Column:
    """struct(head, sep, tail) at the first separator; (text, '', '') without one."""
    at = F.instr(c, sep)
    return F.struct(
        F.when(at > 0, F.substr(c, F.lit(1), at - 1)).otherwise(c).alias("head"),
        F.when(at > 0, sep).otherwise("").alias("sep"),
        F.when(at > 0, F.substr(c, at + len(sep))).otherwise("").alias("tail"))


def rpartition(c: Column, sep: str) -> Column:
    """struct(head, sep, tail) at the last separator; ('', '', text) without one."""
    at = rfind(c, sep)
    return F.struct(
        F.when(at >= 0, F.substr(c, F.lit(1), at)).otherwise("").alias("head"),
        F.when(at >= 0, sep).otherwise("").alias("sep"),
        F.when(at >= 0, F.substr(c, at + 1 + len(sep))).otherwise(c).alias("tail"))


def rsplit_once(c: Column, sep: str) -> Column:
    p = rpartition(c, sep)
    return F.when(p["sep"] == "", F.array(c)).otherwise(F.array(p["head"], p["tail"]))


def slice_replace(c: Column, start: int, stop: int, new: str) -> Column:
    """Characters start..stop-1 (0-based) replaced."""
    return F.concat(F.left(c, F.lit(start)), F.lit(new), F.substr(c, F.lit(stop + 1)))


def match(c: Column, pattern: str) -> Column:
    """Pattern found at the start of the text."""
    return c.rlike(rf"\A(?:{pattern})")


@pandas_udf(StringType())
def _normalize(c: pd.Series, form: pd.Series) -> pd.Series:
    return pd.Series([None if s is None else unicodedata.normalize(f, s) for s, f in zip(c, form)])


def normalize(c: Column, form: str = "NFC") -> Column:
    return _normalize(c, F.lit(form))


# The white space that separates words of a line.
BLANKS = r"\t\n\x0B\f\r "
TAB_STOP = 8


def expand_tabs(c: Column) -> Column:
    """Tabs filled up with blanks to the next multiple of eight characters since the start of the line."""
    # A tab always ends on a multiple of eight, so what stands before the one before does not matter.
    def filled(piece: Column) -> Column:
        return F.concat(piece, F.repeat(F.lit(" "), TAB_STOP - F.length(F.regexp_replace(piece, r"(?s)\A.*[\n\r]", "")) % TAB_STOP))

    pieces = F.split(c, "\t")
    before = F.array_join(F.transform(F.slice(pieces, 1, F.size(pieces) - 1), filled), "")
    return F.when(F.contains(c, F.lit("\t")), F.concat(before, F.element_at(pieces, -1))).otherwise(c)


def wrap(c: Column, width: int) -> Column:
    """Lines of at most ``width`` characters, joined by line feeds.

    Lines break at white space, which counts one blank a character and is dropped where a line ends, and after a hyphen
    between two letters on either side; a word longer than a line is cut at its edge. A null stays null, a text
    without words gives an empty text.
    """
    text = F.rtrim(F.regexp_replace(expand_tabs(c), f"[{BLANKS}]", " "))
    hyphen = r"(?<=[\p{L}_]{2}-)(?=[\p{L}_]{2})"
    # A line is one match: up to the edge where a word longer than a line begins in it or just behind it, else to the last
    # place where it may break. Blanks before it go, but for those at the start of the text if the first word fits behind them.
    long = rf"(?=.{{0,{width}}}?(?:\G|(?<= )|{hyphen})[^ ](?:(?!{hyphen})[^ ]){{{width}}}).{{{width}}}"
    whole = rf".{{0,{width - 1}}}[^ ](?= |\z|{hyphen})"
    lines = F.when(F.rlike(text, F.lit(rf"[^ ]{{{width + 1}}}")), F.regexp_replace(text, rf"(?s)(?:\A| *+)({long}|{whole})", "$1\n")).otherwise(
        F.regexp_replace(text, rf"(?s)(?:\A| *+)({whole})", "$1\n"))
    return F.left(lines, F.greatest(F.length(lines) - 1, F.lit(0)))


def chain(c: Column, *steps) -> Column:
    """Apply cleaning steps in order."""
    return reduce(lambda x, f: f(x), steps, c)


def remove_marks(c: Column, marks: str = "[!#?]") -> Column:
    return F.regexp_replace(c, marks, "")


def clean_names(c: Column) -> Column:
    """Strip, drop punctuation marks, title case."""
    return chain(c, strip, remove_marks, title)


# Rewrites of the sentence cleaner, in order: what is matched and what replaces it.
SENTENCE_REWRITES = (
    (r"[^A-Za-z0-9(),!?'`]", " "),
    (r"'s", " 's"),
    (r"'ve", " 've"),
    (r"n't", " n't"),
    (r"'re", " 're"),
    (r"'d", " 'd"),
    (r"'ll", " 'll"),
    (r",", " , "),
    (r"!", " ! "),
    (r"\(", " \\( "),
    (r"\)", " \\) "),
    (r"\?", " \\? "),
    (r"\s{2,}", " "),
)


# The same rewrites in fewer passes: none makes or breaks a match of another, and blanks, which the first rewrite turns into
# themselves, are left alone.
SENTENCE_PASSES = (
    (r"[^\p{Alnum}(),!?'` ]+", " "),  # ASCII only; with its ranges written out, Java takes nine times as long
    (r"'(?:s|ve|re|d|ll)|n't", " $0"),
    (r"[,!]", " $0 "),
    (r"[()?]", r" \\$0 "),
    (r" {2,}", " "),
)


def clean_sentence(c: Column) -> Column:
    """Lower-case text with punctuation and clitics set apart; brackets and '?' keep a backslash mark."""
    for pattern, new in SENTENCE_PASSES:
        c = F.regexp_replace(c, F.lit(pattern), F.lit(new))
    return F.lower(F.trim(c))
