"""Column expressions over text. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carledger.schema import WAN

# The characters that count as whitespace when page text is trimmed or split (control blanks, NBSP,
# the Unicode space separators, the ideographic space). None of them is special inside a regex class.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
# The same characters as the inside of a regex character class, in ranges.
BLANK_CLASS = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
NBSP = "\xa0"


def literal_replace(c: Column, find: str, put: str = "") -> Column:
    return F.replace(c, F.lit(find), F.lit(put))


def strip(c: Column) -> Column:
    """Trim every kind of whitespace, not just U+0020."""
    return F.btrim(c, F.lit(BLANKS))


def words(c: Column) -> Column:
    """Split on runs of whitespace, without empty tokens."""
    return F.filter(F.split(c, f"[{BLANK_CLASS}]+"), lambda w: w != "")


def title_brand(title: Column) -> Column:
    return F.get(words(title), F.lit(0))


def title_style(title: Column) -> Column:
    return F.coalesce(F.get(words(title), F.lit(1)), F.lit(""))


def title_model(title: Column) -> Column:
    tokens = words(title)
    return F.array_join(F.slice(tokens, F.lit(3), F.greatest(F.size(tokens) - 2, F.lit(0))), " ")


def price_text(c: Column) -> Column:
    """Price without currency and unit signs, with one unit sign at the end; null stays null."""
    return F.concat(F.regexp_replace(c, f"[{WAN}￥¥]", ""), F.lit(WAN))


def new_price_text(c: Column) -> Column:
    """The part after the first colon (either width), up to the next one; the whole text without a colon."""
    parts = F.split(c, "[:：]")
    return F.coalesce(strip(F.coalesce(F.get(parts, F.lit(1)), F.get(parts, F.lit(0)))), F.lit(""))


def year_month(c: Column) -> Column:
    """`2024年01月` -> `2024-01`."""
    return literal_replace(literal_replace(c, "年", "-"), "月")


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def blank_text(c: Column) -> Column:
    """True for empty or whitespace-only text and for the text `nan`, false otherwise (null for null)."""
    # The first character settles nearly every value without the regex.
    suspect = F.substring(c, 1, 1).isin("", "n", "N", *BLANKS)
    return suspect & F.rlike(c, F.lit(f"^[{BLANK_CLASS}]*(?i:nan)?[{BLANK_CLASS}]*$"))


def nan_text(c: Column) -> Column:
    """True for null and for text that reads as NaN."""
    return c.isNull() | (F.lower(F.trim(c)) == "nan")


def float_text(c: Column) -> Column:
    """A float or double as shortest decimal text: `12.5`, `10000000.0`, `1e-05`, `nan`.

    Spark switches to exponents outside [1e-3, 1e7); here the switch is at [1e-4, 1e16), with a lower-case
    exponent of two digits. A FLOAT is widened first, so 12.34 gives `12.34000015258789`. (On Java 17 a value above
    1e17 can carry a digit more than it needs.)
    """
    value = c.cast("double")
    size = F.abs(value)
    text = value.cast("string")
    # The exponent form holds the shortest digits, so the decimal is written from it and not from the value.
    positional = F.regexp_replace(text.try_cast("decimal(38,21)").cast("string"), "0+$", "")
    short_mantissa = F.regexp_replace(text, r"\.0E", "E")
    two_digits = F.regexp_replace(short_mantissa, r"E(-?)(\d)$", "E$10$2")
    scientific = F.regexp_replace(literal_replace(two_digits, "E-", "e-"), "E", "e+")
    return (
        F.when(F.isnan(value), "nan")
        .when(size == float("inf"), F.when(value > 0, "inf").otherwise("-inf"))
        .when(~text.contains("E"), text)
        .when((size >= 1e-4) & (size < 1e16), F.regexp_replace(positional, r"\.$", ".0"))
        .otherwise(scientific)
    )
