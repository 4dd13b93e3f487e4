"""Quality rules: a threshold table compiled into one Spark projection.

Every measure is a built-in expression over the row's own text, so the whole
operator is one map stage: no shuffle, no Python, no group to become hot.
Null or empty texts have no words and fail the base rule; a text of any
length is measured whole; repeated rows give repeated, equal results; other
columns are left alone unless asked for with ``keep``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, WORD, bind, words

#: Frequent function words of the four languages, lower case.
STOP_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "was", "with", "be", "by", "on", "are", "this", "from", "at", "as", "an", "or", "not"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht", "ein", "eine", "als", "auch", "es"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "a", "par", "plus", "pas", "au", "sur", "avec"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una", "su", "para", "es", "al", "lo", "como"],
}

#: The threshold table: (rule, measure, lowest allowed, highest allowed, words
#: from which the rule applies). A measure outside its range rejects.
THRESHOLDS = [
    ("word_length", "mean_word_chars", 1.5, 20.0, 20),
    ("symbols", "symbol_ratio", None, 0.1, 20),
    ("repeated_lines", "dup_line_ratio", None, 0.5, 20),
    ("stop_words", "stop_ratio", 0.01, None, 50),
]

_WINDOW = 8


def _n_repeat_words(w: Column) -> Column:
    """Words in windows of 8 that occur twice or more. Windows are compared by
    hash; only a text with an equal pair pays for sorting (hash, place)."""
    def places(hs: Column) -> Column:
        paired = F.array_sort(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.cast("long").alias("i"))))
        hit = bind(paired, lambda s: F.filter(s, lambda x, j: (
            (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"])).eqNullSafe(True)))
        return F.array_sort(F.transform(hit, lambda x: x["i"]))

    def covered(at: Column) -> Column:
        start = F.struct(F.lit(-_WINDOW).cast("long").alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(at, start, lambda acc, i: F.struct(
            i.alias("last"),
            (acc["n"] + F.least(F.lit(_WINDOW).cast("long"), i - acc["last"])).alias("n")))["n"]

    def of(ws: Column) -> Column:
        last = F.size(ws) - (_WINDOW - 1)
        hashes = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(ws, i, _WINDOW)))
        return F.when(last < 2, F.lit(0).cast("long")).otherwise(bind(hashes, lambda hs: F.when(
            F.size(F.array_distinct(hs)) == last, F.lit(0).cast("long")).otherwise(covered(places(hs)))))

    return bind(w, of)


def measures(text: Column) -> dict[str, Column]:
    """The measures that are read from the text itself."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))
    stop = sorted({w for ws in STOP_WORDS.values() for w in ws})
    return {
        "_w": words(t),
        "n_symbols": F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long"),
        "_lines": lines,
        "n_stop_words": F.size(F.filter(F.split(F.lower(t), rf"[\s\p{{Punct}}]+"), lambda x: x.isin(stop))).cast("long"),
    }


def quality(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
            thresholds: list[tuple] = THRESHOLDS) -> DataFrame:
    """``keep`` columns, the measures, ``base_failed`` (under 20 words, or more
    than 30 % of the words in repeated windows), ``failed`` (names of the
    failed rules of ``thresholds``) and ``kept``. A ratio over no words or no
    lines is 0."""
    one = docs.select(*keep, *[c.alias(n) for n, c in measures(F.col(text_col)).items()])
    two = one.select(
        *keep, "n_symbols", "n_stop_words",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _n_repeat_words(F.col("_w")).alias("n_repeat_words"))
    per = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    ratios = {"mean_word_chars": per("word_chars", "n_words"), "symbol_ratio": per("n_symbols", "word_chars"),
              "dup_line_ratio": per("n_dup_lines", "n_lines"), "stop_ratio": per("n_stop_words", "n_words")}
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rules = []
    for rule, measure, low, high, least in thresholds:
        out = F.lit(False)
        if low is not None:
            out = out | (F.col(measure) < low)
        if high is not None:
            out = out | (F.col(measure) > high)
        rules.append(F.when(out & (F.col("n_words") >= least), F.lit(rule)))
    judged = (two.withColumns(ratios).withColumn("base_failed", base)
              .withColumn("failed", F.array_compact(F.array(*rules))))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
