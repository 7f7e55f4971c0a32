"""One pattern for many phrases: a prefix tree written as nested groups.

A flat alternation tries every phrase at every position of a text. Nested, phrases
share their common beginnings, and a look-ahead for the possible first characters passes over
all other positions at once. The pattern matches where the flat one does (a phrase that begins
another is enough there, so nothing is looked for beyond it).
"""

from __future__ import annotations

import re


def _quoted(text: str) -> str:
    """Characters as themselves: ASCII marks are escaped."""
    return re.sub(r"([!-/:-@\[-`{-~])", r"\\\1", text)


def _group(phrases: list[str], whole: bool) -> str:
    """Alternatives for what is left of the phrases; ``whole``: longer phrases count beside their beginnings."""
    if "" in phrases and not whole:
        return ""
    heads: dict[str, list[str]] = {}
    for p in phrases:
        if p:
            heads.setdefault(p[0], []).append(p[1:])
    parts = []
    for head, rest in heads.items():
        prefix = head
        while len(set(r[:1] for r in rest)) == 1 and rest[0] and "" not in rest:  # no branch: one run of characters
            prefix, rest = prefix + rest[0][0], [r[1:] for r in rest]
        tail = _group(rest, whole) if rest != [""] else ""
        parts.append(_quoted(prefix) + tail)
    body = "|".join(parts)
    optional = "?" if "" in phrases else ""
    return f"(?:{body}){optional}" if len(parts) > 1 or optional else body


def trie_regex(phrases: list[str]) -> str:
    """Pattern that is found in a text exactly where one of ``phrases`` is; matches nothing without a phrase."""
    phrases = list(dict.fromkeys(phrases))
    if not phrases:
        return r"(?!)"
    if "" in phrases:
        return ""
    # ASCII beginnings are one bit set; a position that has neither costs that and a comparison
    plain, other = ([p for p in phrases if p[0].isascii() == ascii_] for ascii_ in (True, False))
    parts = []
    if plain:
        parts.append(f"(?=[{''.join(_quoted(c) for c in dict.fromkeys(p[0] for p in plain))}])(?:{_group(plain, False)})")
    if other:
        parts.append(rf"(?=[^\x00-\x7f])(?:{_group(other, False)})")
    return f"(?:{'|'.join(parts)})"


def bounded_regex(phrases: list[str], before: str, after: str) -> str:
    """Pattern for any of ``phrases`` between the zero-width ``before`` and ``after``; a longer phrase counts where its beginning ends amid a word."""
    phrases = sorted(set(phrases) - {""})
    first = "".join(_quoted(c) for c in dict.fromkeys(p[0] for p in phrases))
    return f"(?=[{first}]){before}(?:{_group(phrases, True)}){after}" if phrases else r"(?!)"


def whole_regex(phrases: list[str]) -> str:
    """Pattern that matches a string that is one of ``phrases``, and no other."""
    phrases = sorted(set(phrases) - {""})
    return rf"\A(?:{_group(phrases, True)})\z" if phrases else r"(?!)"
