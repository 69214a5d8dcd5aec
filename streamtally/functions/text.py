"""Text signals in chat messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The stems each mood rate looks for.
HYPE_STEMS = ["lul", "kekw", "pog", "hype"]
POSITIVE_STEMS = [
    "merci", "super", "genial", "bravo", "parfait", "excellent", "adorable", "magnifique", "incroyable", "love",
]
HOSTILE_STEMS = ["connard", "connasse", "idiot", "debile", "degage", "ta gueule"]


def starts_a_word(text: str, stems: list[str]) -> Column:
    """Case-insensitive match of a stem at the start of a word; the end is open, so
    plurals and drawn-out spellings count. `U` makes accented letters word characters."""
    return F.col(text).rlike(r"(?iU)\b(" + "|".join(stems) + ")")


def is_shouted(text: str) -> Column:
    t = F.col(text)
    return (t == F.upper(t)) & (t != F.lower(t)) & (F.length(t) >= 4)


def share_of(condition: Column) -> Column:
    """Fraction of rows on which the condition is true; null counts as false."""
    return F.avg(F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0)))


def tokens(text: str) -> Column:
    """Whitespace-separated pieces, keeping an empty piece before leading whitespace."""
    return F.split(F.col(text), r"(?U)\s+", -1)


def has_long_digit_suffix(name: str | Column) -> Column:
    return (F.col(name) if isinstance(name, str) else name).rlike("[0-9]{4,}$")
