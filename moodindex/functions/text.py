"""Text column functions: cleaners, URL flag, tokenisers, lexicon matching.

All of these are built-in Spark expressions (JVM side, inside whole-stage
codegen); no Python runs per row.

The regular expressions reproduce Python ``re`` semantics on ``str``
patterns, which the cleaning rules were written in.  Java's ``\\s`` and
``\\w`` are ASCII-only, so the two classes are spelled out below; the same
spellings are valid RE2 (DuckDB) syntax, so an SQL oracle can use them
verbatim.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from moodindex.functions.keywords import found_keywords, mentions_any

# ---------------------------------------------------------------------------
# Fixed values (must equal the cleaning rules' behaviour).
#
# White space: exactly the characters for which Python's str.isspace() is
# true (what `\s` and str.split()/strip() use).
SPACE_CHARS = (r"\t\n\x0B\f\r\x1C-\x1F \x85\xA0\x{1680}\x{2000}-\x{200A}"
               r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
# The same set as code-point ranges (inclusive).
SPACE_RANGES = ((0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
                (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F),
                (0x3000, 0x3000))
# Kept by the counting cleaners: Hangul syllables, ASCII letters, digits
# (plus white space).
HANGUL_SYLLABLES = (0xAC00, 0xD7A3)
COUNT_KEEP_RANGES = (HANGUL_SYLLABLES, (0x61, 0x7A), (0x41, 0x5A), (0x30, 0x39)) + SPACE_RANGES
# Word characters: Python's Unicode `\w` (letters, numbers, underscore).
WORD_CHARS = r"\p{L}\p{N}_"

# Markup tag, and a URL with the rest of its non-space run.
TAG_RE = r"<[^>]+>"
URL_RUN_RE = rf"https?://[^{SPACE_CHARS}]+|www\.[^{SPACE_CHARS}]+"
# A text that mentions a link at all (case-sensitive, on the raw text),
# and the same test as plain substrings.
URL_FLAG_RE = r"https?://|www\.|\.com|\.kr"
URL_MARKERS = ("http://", "https://", "www.", ".com", ".kr")
# Characters the counting cleaner keeps: Hangul syllables, ASCII letters,
# digits and white space.
TFIDF_DROP_RE = rf"[^가-힣a-zA-Z0-9{SPACE_CHARS}]"
# Characters the model cleaner keeps: word characters, white space,
# `! ? . ,`, Hangul jamo (consonants, vowels) and syllables.
BERT_DROP_RE = rf"[^{WORD_CHARS}{SPACE_CHARS}!?.,ㄱ-ㅎㅏ-ㅣ가-힣]"
# Characters the word counter keeps (U+AC00..U+D7A3 is 가..힣).
WORD_COUNT_DROP_RE = rf"[^가-힣a-zA-Z0-9{SPACE_CHARS}]"
SPACE_RUN_RE = rf"[{SPACE_CHARS}]+"
NON_SPACE_RUN_RE = rf"[^{SPACE_CHARS}]+"
# Vectoriser token: a run of two or more word characters.
TOKEN_RE = rf"[{WORD_CHARS}]{{2,}}"
# ---------------------------------------------------------------------------

MAX_CODE_POINT = 0x10FFFF


def _esc(cp: int) -> str:
    return chr(cp) if chr(cp).isascii() and chr(cp).isalnum() else f"\\x{{{cp:X}}}"


def complement_class(keep: tuple[tuple[int, int], ...]) -> str:
    """A *positive* character class of every code point outside ``keep``.

    Same matches as the negated class ``[^keep]``; Java's regex engine runs
    a positive union of ranges several times faster than a negated one, and
    these classes are evaluated once per character of every text.
    """
    merged: list[list[int]] = []
    for lo, hi in sorted(keep):
        if merged and lo <= merged[-1][1] + 1:
            merged[-1][1] = max(merged[-1][1], hi)
        else:
            merged.append([lo, hi])
    parts, nxt = [], 0
    for lo, hi in merged:
        if lo > nxt:
            parts.append(_esc(nxt) if lo - 1 == nxt else f"{_esc(nxt)}-{_esc(lo - 1)}")
        nxt = hi + 1
    if nxt <= MAX_CODE_POINT:
        parts.append(f"{_esc(nxt)}-{_esc(MAX_CODE_POINT)}")
    return "[" + "".join(parts) + "]"


# Spark-side forms of TFIDF_DROP_RE / WORD_COUNT_DROP_RE (runs of them).
COUNT_DROP_FAST_RE = complement_class(COUNT_KEEP_RANGES) + "+"
# Every white-space character, for ``translate``.
SPACE_STRING = "".join(chr(cp) for lo, hi in SPACE_RANGES for cp in range(lo, hi + 1))
_OTHER_SPACE = SPACE_STRING.replace(" ", "")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse_space(c: Column | str) -> Column:
    """Runs of white space become one blank; blanks at both ends go.

    Every white-space character is mapped to a blank (``translate``), the
    text is split on the blank (a plain character split, no regex), empty
    pieces dropped and the rest joined with one blank: the same result as
    ``trim(regexp_replace(c, '[space]+', ' '))`` at a fraction of the cost.
    A null text stays null.
    """
    col = _c(c)
    blanks = F.translate(col, _OTHER_SPACE, " " * len(_OTHER_SPACE))
    joined = F.concat_ws(" ", F.array_remove(F.split(blanks, " "), ""))
    return F.when(col.isNotNull(), joined)


def strip_markup(c: Column | str) -> Column:
    """Drop tags first, then URL runs (the order matters: a URL inside a
    tag attribute disappears with the tag)."""
    # Each regex pass decodes and re-encodes the whole text; a plain byte
    # search first skips both for texts that hold no tag / no link.
    col = _c(c)
    no_tags = F.when(col.contains("<"), F.regexp_replace(col, TAG_RE, "")).otherwise(col)
    has_link = no_tags.contains("http") | no_tags.contains("www.")
    return F.when(has_link, F.regexp_replace(no_tags, URL_RUN_RE, "")).otherwise(no_tags)


def clean_tfidf(c: Column | str) -> Column:
    """Cleaner for counting: no tags, no URLs, only Hangul syllables, ASCII
    letters, digits and single blanks.  May return ``''`` (kept, N7)."""
    return collapse_space(F.regexp_replace(strip_markup(c), COUNT_DROP_FAST_RE, ""))


def clean_bert(c: Column | str) -> Column:
    """Cleaner for the classifier: like :func:`clean_tfidf` but keeps every
    letter and digit, ``_``, ``! ? . ,`` and Hangul jamo."""
    return collapse_space(F.regexp_replace(strip_markup(c), BERT_DROP_RE, ""))


def clean_words(c: Column | str) -> Column:
    """Word-count cleaner: drop other characters, lower-case."""
    return F.lower(F.regexp_replace(_c(c), COUNT_DROP_FAST_RE, ""))


def sql_literal(value: str) -> str:
    """A Spark SQL string literal (backslash and quote escaped)."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def has_url(c: Column | str) -> Column:
    """True when the raw text mentions a link (``URL_FLAG_RE`` as plain
    substring tests: no regex pass over the text)."""
    if isinstance(c, str):  # one SQL expression: one round trip to build
        return F.expr(" OR ".join(f"contains({_ident(c)}, {sql_literal(m)})"
                                  for m in URL_MARKERS))
    col = _c(c)
    out = col.contains(URL_MARKERS[0])
    for m in URL_MARKERS[1:]:
        out = out | col.contains(m)
    return out


def remove_space(c: Column | str) -> Column:
    """Delete every white-space character (a per-character map, no regex)."""
    return F.translate(_c(c), SPACE_STRING, "")


def split_words(c: Column | str) -> Column:
    """White-space tokeniser (``str.split()``): non-empty runs of non-space.

    Split on runs of white space, then drop the empty ends."""
    return F.array_remove(F.split(_c(c), SPACE_RUN_RE), "")


def tokenize_words(c: Column | str) -> Column:
    """Vectoriser tokeniser: lower-case, runs of two or more word chars."""
    return F.regexp_extract_all(F.lower(_c(c)), F.lit(TOKEN_RE), 0)


# ---------------------------------------------------------------------------
# Lexicon matching (plain, case-sensitive substring; no regex).

def _distinct(words: Iterable[str]) -> list[str]:
    seen: dict[str, None] = {}
    for w in words:
        if w is not None and w != "":
            seen.setdefault(w, None)
    return list(seen)


# A plain substring search takes about 1/150 of one walk with the keyword
# pattern, whose time does not depend on the number of words.
FEW_WORDS, FEW_MENTIONS = 100, 8


def _found(col: Column, words: list[str]) -> Column:
    """The words that occur in ``col``: a few are tried one by one, many are
    one pattern.  Either way the lexicon is one literal of the plan."""
    if len(words) > FEW_WORDS:
        return found_keywords(col, words)
    return F.filter(F.lit(words), lambda w: F.contains(col, w))


def lexicon_hit_count(c: Column | str, words: Iterable[str]) -> Column:
    """Number of **distinct** lexicon words found inside the text.
    A null text counts 0 hits."""
    ws = _distinct(words)
    if not ws:
        return F.lit(0)
    return F.when(_c(c).isNull(), F.lit(0)).otherwise(F.size(_found(_c(c), ws))).cast("int")


def lexicon_found(c: Column | str, *lexicons: Iterable[str]) -> Column | None:
    """The words of any of the lexicons in the text, from one walk, where each of
    them would take its own; null for a null text."""
    sets = [_distinct(ws) for ws in lexicons]
    if min(map(len, sets)) <= FEW_WORDS:
        return None
    return found_keywords(_c(c), _distinct(w for ws in sets for w in ws))


def found_count(found: Column | str, words: Iterable[str]) -> Column:
    """:func:`lexicon_hit_count` from :func:`lexicon_found`."""
    return F.when(_c(found).isNull(), F.lit(0)).otherwise(
        F.size(F.array_intersect(_c(found), F.lit(_distinct(words))))).cast("int")


def contains_any_nospace(c: Column | str, words: Iterable[str]) -> Column:
    """True when any keyword occurs in the text once all its white space is
    removed (N11); keywords are not stripped, so one holding white space can
    never match.  Null text: false."""
    space = set(SPACE_STRING)
    return contains_any(remove_space(_c(c)), [w for w in _distinct(words) if not (set(w) & space)])


def contains_any(c: Column | str, words: Iterable[str]) -> Column:
    """True when any lexicon word occurs in the text (null text: false)."""
    ws = _distinct(words)
    if not ws:
        return F.lit(False)
    if len(ws) > FEW_MENTIONS:
        return F.coalesce(mentions_any(_c(c), ws), F.lit(False))
    # the text is bound once by the outer lambda, so that what computes it
    # (white-space removal) runs once a row and not once a word
    return F.exists(F.array(F.coalesce(_c(c), F.lit(""))),
                    lambda t: F.exists(F.lit(ws), lambda w: F.contains(t, w)))
