"""Scalar text operators as Spark column expressions.

Everything here is a ``Column -> Column`` function built from native Spark
SQL expressions (regex, higher-order array functions), so it stays inside
the JVM and runs per row with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES — the characters Python's ``str.split()`` / ``str.strip()``
# treat as whitespace, as a regex class both Java and RE2 accept. Java's
# ``(?U)\s`` lacks U+001C..U+001F, so the class is spelled out.
WHITESPACE_CLASS = (
    r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
WHITESPACE_RUN = WHITESPACE_CLASS + "+"
# FIXED VALUES — the same characters, one by one, for ``trim``.
WHITESPACE_CHARS = ("\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
                    + "\u2028\u2029\u202f\u205f\u3000")

# Default token pattern: a run of letters / marks / digits / underscore, or
# one other non-whitespace character. Written out because ``\w`` is
# ASCII-only in Java and RE2 and ``\s`` differs between them.
TOKEN_PATTERN = r"[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_" + WHITESPACE_CLASS[1:-1] + "]"

# Sentence boundary: end punctuation followed by whitespace. RE2 has no
# look-behind, so the split marks the boundary with a record separator first.
_SENT_MARK = "\u001e"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(text) -> Column:
    """``str.strip()``: remove leading and trailing whitespace, in time linear in the text
    (an anchored regex retries at every character of an inner run of blanks)."""
    return F.trim(_col(text), F.lit(WHITESPACE_CHARS))


def is_blank(text) -> Column:
    """``not text.strip()`` (null counts as blank)."""
    return F.coalesce(~_col(text).rlike("[^" + WHITESPACE_CLASS[1:]), F.lit(True))


def words(text) -> Column:
    """``text.split()`` as an array (empty for blank or null text)."""
    t = strip_ws(text)
    return F.when(F.coalesce(t, F.lit("")) == "", F.array().cast("array<string>")) \
        .otherwise(F.split(t, WHITESPACE_RUN))


def word_count(text) -> Column:
    """T4: number of whitespace-separated words."""
    return F.size(words(text)).cast("long")


def letter_tokens(text) -> Column:
    """Words reduced to their letters, lower-cased, kept when at least 2 long.

    Dropping every character that is neither a letter nor whitespace from the
    whole text, then taking letter runs, gives the same tokens as cleaning
    word by word, in two regex passes instead of one per word.
    """
    letters_only = F.regexp_replace(F.coalesce(_col(text), F.lit("")),
                                    r"[^\p{L}" + WHITESPACE_CLASS[1:-1] + "]", "")
    # marks can only come from lower-casing here (e.g. U+0130 -> i + U+0307),
    # and they stay part of their token, as in lower-casing word by word
    return F.regexp_extract_all(F.lower(letters_only), F.lit(r"[\p{L}\p{M}]{2,}"), 0)


def word_ratio_heuristic(text) -> Column:
    """Share of letter tokens that are 3+ long and hold an ASCII vowel; 0.0 if none."""
    # bind the token array once so it is not recomputed inside the lambdas
    return F.element_at(F.transform(F.array(letter_tokens(text)), lambda ts: F.when(
        F.size(ts) == 0, F.lit(0.0)
    ).otherwise(
        F.size(F.filter(ts, lambda w: (F.length(w) >= 3) & w.rlike("[aeiou]"))).cast("double")
        / F.size(ts).cast("double")
    )), 1)


def upper_text(text) -> Column:
    """Trimmed, upper-cased text (Python ``text.strip().upper()``)."""
    return F.upper(strip_ws(text))


def sentences(text) -> Column:
    """Split after ``. ! ?`` followed by whitespace; pieces trimmed, blanks dropped."""
    marked = F.regexp_replace(_col(text), r"([.!?])" + WHITESPACE_RUN, "$1" + _SENT_MARK)
    parts = F.transform(F.split(marked, _SENT_MARK), lambda s: strip_ws(s))
    return F.filter(parts, lambda s: s != "")


def token_count(text, pattern: str = TOKEN_PATTERN) -> Column:
    """T9 default counter: words and single punctuation marks."""
    return F.coalesce(F.size(F.regexp_extract_all(_col(text), F.lit(pattern), 0)), F.lit(0)).cast("long")
