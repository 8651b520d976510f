"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters stripped from both ends of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip_text(text: Column) -> Column:
    """Remove Unicode whitespace at both ends."""
    return F.trim(text, F.lit(WHITESPACE))


def strip_html(html: Column) -> Column:
    """Replace every tag by a space, then strip."""
    return strip_text(F.regexp_replace(html, "<[^>]+>", " "))


def category_or_unknown(category: Column) -> Column:
    """Stripped category; null or blank becomes ``unknown``."""
    return F.coalesce(F.nullif(strip_text(category), F.lit("")), F.lit("unknown"))


def capitalise(word: Column) -> Column:
    """First letter upper case, the rest lower case."""
    rest = word.substr(F.lit(2), F.length(word))
    return F.concat(F.upper(F.substring(word, 1, 1)), F.lower(rest))


def first_sentences(text: Column, sentences: int = 2, max_chars: int = 320) -> Column:
    """The first sentences of a text on one line, cut to ``max_chars`` characters."""
    flat = strip_text(F.regexp_replace(text, r"\s+", " "))
    found = F.regexp_extract_all(flat, F.lit(r"[^.!?]+[.!?]*"), F.lit(0))
    joined = strip_text(F.array_join(F.slice(found, 1, sentences), ""))
    return strip_text(F.substring(joined, 1, max_chars))


def words(text: Column, min_letters: int = 3) -> Column:
    """Lower-case runs of at least ``min_letters`` ASCII letters."""
    runs = F.regexp_extract_all(text, F.lit(f"[A-Za-z]{{{min_letters},}}"), F.lit(0))
    return F.transform(runs, F.lower)
