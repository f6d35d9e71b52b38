"""Parameters of the registered queries over the test tables.

Fixed values: fixture lexicons for the synthetic text (plain substrings),
the original jobs' seeds, sizes and window lengths, and the run
timestamps of the two upsert batches.
"""

# Lexicons (our own, for the synthetic prose of the test tables).
FEAR_WORDS = ("oner", "anes", "hest", "haon", "dem", "error")
GREED_WORDS = ("ontion", "ores", "atre", "atea", "ung", "gain")
TOPIC_WORDS = ("token", "license")
# Lexicons of a real size (214 and 136 words), from a rule: pairs of syllables.
_FEAR_SYLLABLES = "on er an th re st nd ti in ed ou ha sh wh le".split()
_GREED_SYLLABLES = "es ea or at it en ing ly he ion ble nt".split()
FEAR_WORDS_LONG = tuple(dict.fromkeys(
    FEAR_WORDS + tuple(a + b for a in _FEAR_SYLLABLES for b in _FEAR_SYLLABLES)))[:214]
GREED_WORDS_LONG = tuple(dict.fromkeys(
    GREED_WORDS + tuple(a + b for a in _GREED_SYLLABLES for b in _GREED_SYLLABLES)))[:136]

# 3,500 words: triples of syllables beside the pairs.
WORDS_3500 = tuple(dict.fromkeys(FEAR_WORDS_LONG + GREED_WORDS_LONG + tuple(
    a + b + c for a in _FEAR_SYLLABLES for b in _GREED_SYLLABLES for c in _FEAR_SYLLABLES)))[:3500]

# Seeds and sizes of the original jobs.
SAMPLE_N = 1000
SAMPLE_SEED = 41
SPLIT_SEED = 42
TEST_SIZE = 0.2
WORD_TOP_K = 50
TFIDF_TOP_K = 30
TFIDF_MAX_FEATURES = 1000
MA_SHORT = 7
MA_LONG = 30
EPOCHS = 4
RATE = 2.0
TOKEN_WINDOW = 128
PAD = "[PAD]"

# One entity for the entity filter.
ENTITY = "src3"

# Two publishing runs: the first covers events before TARGET_END, the
# second re-runs from UPDATE_START (overlapping, with a partial first day).
RUN1 = "2024-02-01 00:00:00"
RUN2 = "2024-02-02 00:00:00"
TARGET_END = "2024-01-21 00:00:00"
UPDATE_START = "2024-01-15 12:00:00"
# The entity whose second batch breaks a rule (a key occurs twice).
FAILING_ENTITY = "error"
ORDERS_TARGET_END = "1999-01-01 00:00:00"
ORDERS_UPDATE_START = "1998-07-01 00:00:00"
