"""Text rules shared by the parsers: what is a space, a line break, a number."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Unicode white space and line boundaries, as regular expression classes.
_SPACES = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SPACE = f"[{_SPACES}]"
NOT_SPACE = f"[^{_SPACES}]"
INNER_BREAK = r"[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"
LINE_BREAK = rf"\r\n|{INNER_BREAK}"

_DIGITS = r"[0-9]+(?:_[0-9]+)*"
_NUMBER = (
    rf"^[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    r"|(?i:inf|infinity|nan))$"
)


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def words(text: Column) -> Column:
    return F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")


def lines(text: Column) -> Column:
    return F.split(text, LINE_BREAK)


def first_word(text: Column) -> Column:
    """What stands before the first inner space, '' for blank text. To cut at a space costs a third of a match of all that is none."""
    return F.get(F.split(F.regexp_replace(text, f"^{SPACE}+", ""), SPACE, 2), F.lit(0))


def number(text: Column) -> Column:
    """Double for text that spells a number (outer spaces allowed), else NULL."""
    return word_number(stripped(text))


def word_number(value: Column) -> Column:
    """`number` of text without outer spaces."""
    return F.when(value.rlike(_NUMBER), F.replace(value, F.lit("_"), F.lit("")).try_cast("double"))
