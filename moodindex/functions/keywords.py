"""Many keywords at once, as one pattern.

A lexicon is compiled to a radix trie written as a regular expression: at each
place of the text one walk down the trie finds the longest keyword that begins there,
so the work per character does not grow with the number of keywords.
The other keywords that begin at that place are prefixes of the longest one; they are
known from the lexicon alone and need no second look at the text.
Plain, case-sensitive substrings; nothing in a keyword is a metacharacter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def escaped(text: str) -> str:
    """A text as a literal of a Java pattern."""
    return "".join("\\" + c if c.isascii() and not c.isalnum() else c for c in text)


def _common(words: Sequence[str]) -> str:
    """The longest common prefix of sorted words."""
    a, b = words[0], words[-1]
    n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[:n]


def _branches(words: Sequence[str]) -> str:
    """Sorted distinct words, none empty, as alternatives by their first character."""
    parts, start = [], 0
    for i in range(1, len(words) + 1):
        if i < len(words) and words[i][0] == words[start][0]:
            continue
        group = words[start:i]
        stem = _common(group)
        rest = [w[len(stem):] for w in group]
        tail = _branches([w for w in rest if w]) if any(rest) else ""
        if tail and rest[0] == "":
            tail = f"(?:{tail})?"  # a longer keyword is tried first
        elif tail and len(set(w[0] for w in rest)) > 1:
            tail = f"(?:{tail})"
        parts.append(escaped(stem) + tail)
        start = i
    return "|".join(parts)


def any_pattern(words: Sequence[str]) -> str:
    """Matches where any of the words begins."""
    return f"(?:{_branches(sorted(set(words)))})"


def longest_pattern(words: Sequence[str]) -> str:
    """At each place of a text, group 1 is the longest word that begins there."""
    words = sorted(set(words))
    first = "".join(dict.fromkeys(escaped(w[0]) for w in words))
    return f"(?=[{first}])(?=({_branches(words)}))"


def prefixes(words: Sequence[str]) -> list[str]:
    """The words that are proper prefixes of other words."""
    out, open_ = {}, []
    for w in sorted(set(words)):
        while open_ and not w.startswith(open_[-1]):
            open_.pop()
        for p in open_:
            out[p] = None
        open_.append(w)
    return list(out)


def found_keywords(text: Column, words: Sequence[str]) -> Column:
    """The distinct keywords that occur in the text (words not empty)."""
    hits = F.array_distinct(F.regexp_extract_all(text, F.lit(longest_pattern(words)), 1))
    short = prefixes(words)
    if not short:
        return hits
    # bound once by the outer lambda: the text is searched once a row
    whole = F.transform(F.array(hits), lambda h: F.array_union(
        h, F.filter(F.lit(short), lambda p: F.exists(h, lambda w: F.startswith(w, p)))))
    return whole[0]


def mentions_any(text: Column, words: Sequence[str]) -> Column:
    """Whether any of the words occurs in the text."""
    return F.rlike(text, F.lit(any_pattern(words)))
