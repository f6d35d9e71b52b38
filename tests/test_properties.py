"""Property tests: the text functions against per-character expectations, on
random strings mixing scripts, white space, tags and links."""

import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st

from moodindex.functions import text as T

ALPHABET = (list("abcXYZ019 _!?.,:/<>-") + ["\t", "\n", "\x0b", "\x1c", "\x85", "\xa0",
            " ", "　", "​", "é", "ü", "한", "글", "ㅋ", "ㅏ", "①", "²", "😀",
            "ﬁ", "́"])
TOKENS = st.sampled_from(["http://a.b/c", "https://x.kr", "www.y.com", "<b>", "</i>",
                          "token", "to ken", "li　cense", ".com", ".kr"])
TEXT = st.lists(st.one_of(st.sampled_from(ALPHABET), TOKENS), max_size=25).map("".join)


def letter(c):
    return unicodedata.category(c)[0] in "LN" or c == "_"


def hangul(c):
    return unicodedata.name(c, "").startswith("HANGUL SYLLABLE")


def plain(c):
    """A character that survives counting: an ASCII letter or digit, a Hangul syllable."""
    return c.isascii() and c.isalnum() or hangul(c)


def scan_markup(text):
    """The text without tags, then without links: one walk for each."""
    out, i = [], 0
    while i < len(text):
        end = text.find(">", i + 1) if text[i] == "<" else -1
        if end > i + 1:
            i = end + 1
        elif end == i + 1:  # "<>" opens at the "<" and may close further on
            end = text.find(">", i + 2)
            out.append(text[i])
            i += 1
        else:
            out.append(text[i])
            i += 1
    text, out, i = "".join(out), [], 0
    while i < len(text):
        head = next((h for h in ("https://", "http://", "www.") if text.startswith(h, i)), None)
        rest = text[i + len(head):] if head else ""
        if head and rest and not rest[0].isspace():
            i += len(head) + len(rest.split(None, 1)[0])
        else:
            out.append(text[i])
            i += 1
    return "".join(out)


def kept(text, keep):
    """Characters that are kept, words joined by single spaces."""
    return " ".join("".join(c for c in text if c.isspace() or keep(c)).split())


def word_runs(text):
    runs, run = [], ""
    for c in text.lower() + " ":
        if letter(c):
            run += c
        else:
            runs += [run] * (len(run) > 1)
            run = ""
    return runs


@settings(max_examples=15, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=40))
def test_text_functions_match_per_character_expectations(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(
        T.clean_tfidf("t").alias("tfidf"), T.clean_bert("t").alias("bert"),
        T.has_url("t").alias("url"), T.contains_any_nospace("t", ["token", "license"]).alias("topic"),
        T.split_words(T.clean_words("t")).alias("words"), T.tokenize_words("t").alias("toks"),
    ).collect()
    for t, r in zip(texts, rows):
        bare = scan_markup(t)
        squeezed = "".join(t.split())
        assert r["tfidf"] == kept(bare, plain), repr(t)
        assert r["bert"] == kept(bare, lambda c: letter(c) or c in "!?."or c == ","), repr(t)
        assert r["url"] == any(m in t for m in ("http://", "https://", "www.", ".com", ".kr")), repr(t)
        assert r["topic"] == ("token" in squeezed or "license" in squeezed), repr(t)
        assert r["words"] == kept(t, plain).lower().split(), repr(t)
        assert r["toks"] == word_runs(t), repr(t)
