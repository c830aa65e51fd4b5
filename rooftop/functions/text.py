"""Addresses: normalised text, house numbers, titles of suggestions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm_text(value: Column) -> Column:
    """Lower case, one blank between words, no punctuation, the two forms of one letter made equal; null gives ''."""
    text = F.translate(F.lower(F.trim(value.cast("string"))), "ё", "е")
    text = F.regexp_replace(text, r"(?U)[^\w\s]", " ")
    return F.coalesce(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")), F.lit(""))


def house_number(value: Column) -> Column:
    """The first number of a normalised address, with at most one letter after it; '' if none."""
    return F.regexp_extract(norm_text(value), r"(?U)\b\d+[а-яa-z]?\b", 0)


def suggestion_title(name: Column) -> Column:
    """What stands before the first comma."""
    return F.trim(F.get(F.split(name, ","), F.lit(0)))


def suggestion_subtitle(name: Column) -> Column:
    """The second and third part between commas, joined again."""
    return F.trim(F.array_join(F.slice(F.split(name, ","), 2, 2), ","))
