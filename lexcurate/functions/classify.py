"""Document type (judgment / order / unknown) as one CASE expression.

Decision order (first hit wins):
  1. a judgment pattern in the first 1000 characters of the trimmed,
     upper-cased text
  2. an order pattern in that head
  3. more than 1200 words and a reasoning cue anywhere
  4. fewer than 1000 words and a procedural phrase anywhere
  5. fewer than 300 words
  6. otherwise unknown
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexcurate.functions.lexicons import Lexicon, get_lexicon
from lexcurate.functions.text import upper_text, word_count
from lexcurate.functions.trie import bounded_regex, trie_regex

HEAD_CHARS = 1000
JUDGMENT_MIN_WORDS = 1200   # strictly more than
PROCEDURAL_MAX_WORDS = 1000  # strictly less than
SHORT_MAX_WORDS = 300        # strictly less than


# A word boundary over Python's word characters (letters, digits, underscore).
# Java's ``(?U)\\b`` would also count combining marks as word characters.
_W = r"[\p{L}\p{N}_]"
WORD_BOUNDARY = rf"(?:(?<={_W})(?!{_W})|(?<!{_W})(?={_W}))"


#: Patterns that are words between boundaries (their ends are letters or digits), and patterns without any sign.
_WHOLE_WORDS = re.compile(r"\\b([A-Za-z0-9](?:[A-Za-z0-9 ]*[A-Za-z0-9])?)\\b")
_LITERAL = re.compile(r"[^\\.^$|?*+()\[\]{}]+")


def _python_boundaries(p: str) -> str:
    """``\\b`` of a pattern as Python's boundary. A ``\\b`` before a leading
    (after a trailing) letter or digit only needs the other side checked."""
    b = chr(92) + "b"
    if p.startswith(b) and len(p) > 2 and (p[2].isalnum() or p[2] == "_"):
        p = f"(?<!{_W})" + p[2:]
    if p.endswith(b) and len(p) > 2 and (p[-3].isalnum() or p[-3] == "_") and p[-4:-2] != chr(92) * 2:
        p = p[:-2] + f"(?!{_W})"
    return p.replace(b, WORD_BOUNDARY)


def head_regex(patterns: list[str]) -> str:
    """The head patterns as one, ``\\b`` as Python's Unicode word boundary: whole words and literals as prefix trees, others as they are."""
    words = [m[1] for p in patterns if (m := _WHOLE_WORDS.fullmatch(p))]
    literals = [p for p in patterns if _LITERAL.fullmatch(p)]
    rest = [f"(?:{_python_boundaries(p)})" for p in patterns if not _WHOLE_WORDS.fullmatch(p) and not _LITERAL.fullmatch(p)]
    trees = [bounded_regex(words, f"(?<!{_W})", f"(?!{_W})")] * bool(words) + [trie_regex(literals)] * bool(literals)
    return "|".join(trees + rest)


def any_phrase(text_upper: Column, phrases: list[str]) -> Column:
    """Does the (upper-cased) text contain any of the phrases."""
    return text_upper.rlike(trie_regex(phrases))


def doc_type(text, lexicon: str | Lexicon = "latin", fix_fused: bool = False) -> Column:
    """Classify a text column; returns 'judgment', 'order' or 'unknown'."""
    lex = lexicon if isinstance(lexicon, Lexicon) else get_lexicon(lexicon, fix_fused)
    text = F.col(text) if isinstance(text, str) else text
    text = F.coalesce(text, F.lit(""))

    def body(b):
        up, n = b["up"], b["n"]
        head = F.substring(up, 1, HEAD_CHARS)
        return (
            F.when(head.rlike(head_regex(lex.judgment)), F.lit("judgment"))
            .when(head.rlike(head_regex(lex.order)), F.lit("order"))
            .when((n > JUDGMENT_MIN_WORDS) & any_phrase(up, lex.reasoning), F.lit("judgment"))
            .when((n < PROCEDURAL_MAX_WORDS) & any_phrase(up, lex.procedural), F.lit("order"))
            .when(n < SHORT_MAX_WORDS, F.lit("order"))
            .otherwise(F.lit("unknown"))
        )

    # bind upper text and word count once for the whole CASE
    bound = F.array(F.struct(upper_text(text).alias("up"), word_count(text).alias("n")))
    return F.element_at(F.transform(bound, body), 1)

