"""Quality rules: a table of thresholds compiled into one Spark projection.

Every rule is a ratio of two counts of a text and the least and the most percent that it may be.  The counts are Spark
expressions over the text's words and lines; the whole table becomes one projection, without user functions, without
a shuffle, and in whole numbers (``100 * part`` against ``percent * whole``), so that no rounding decides.

Words are runs of characters other than 0x20 and 0x09-0x0D, unchanged.  Lines are what ``\\n`` separates; only lines
with a word count.

Counts: n_words; word_chars, their characters; n_symbols, characters of ``#*$%&|<>``; n_lines; n_dup_lines, lines
equal to an earlier one; n_repeat_words, words inside three-word windows that the text holds at least twice (the first
of them included); n_stop_words, words that are in the stop list, as they are or with a capital; n_alpha_words,
words with a letter (A-Z, a-z or any character above 0x7F); n_bullet_lines, lines that begin with a bullet; n_ellipsis_lines, lines that end in an ellipsis.

The base rules (``BASE``: too few words, too many repeated words) go first; a text that fails them is not kept
whatever the others say.  ``rules_failed`` names every rule of the table that a text breaks.

Repeated windows.  The windows of a text, with their places, are sorted; equal neighbours are repeated windows, and the
places of these, sorted again, give the words covered: each window adds as many as lie between it and the next, at most
three.  So a text costs n log n however often a word recurs.

Defined cases: null, empty and white-space-only texts have counts of 0 and fail the base rules; a whole of 0 (no lines)
breaks no rule of a most, and none of a least; very long texts are one row, judged whole; repeated rows and null ids are
judged each for itself; an empty table gives an empty result; input columns named like an output column are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import others

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = ("the", "be", "to", "of", "and", "that", "have", "with", "in", "is", "it", "for", "was", "on", "as",
              "le", "la", "les", "de", "des", "et", "un", "une", "du", "en", "que", "qui", "dans", "pour", "est",
              "der", "die", "das", "und", "den", "von", "zu", "mit", "sich", "nicht", "ist", "ein", "eine",
              "el", "los", "las", "y", "se", "del", "por", "con", "no", "una", "su", "para", "es")


@dataclass(frozen=True)
class Rule:
    """``least <= 100 * part / whole <= most``; None bounds nothing."""

    name: str
    part: str
    whole: str
    least: int | None = None
    most: int | None = None

    def broken(self) -> Column:
        part, whole = 100 * F.col(self.part), F.col(self.whole)
        bounds = [part < self.least * whole] * (self.least is not None) + [part > self.most * whole] * (self.most is not None)
        out = F.lit(False)
        for b in bounds:
            out = out | b
        return out & (whole > 0)


#: (least words, most percent of repeated words)
BASE = (50, 50)
RULES = (
    Rule("word_length", "word_chars", "n_words", least=300, most=1000),
    Rule("symbols", "n_symbols", "n_words", most=10),
    Rule("stop_words", "n_stop_words", "n_words", least=2),
    Rule("alpha_words", "n_alpha_words", "n_words", least=70),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=50),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", most=90),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", most=30),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_alpha_words", "n_bullet_lines", "n_ellipsis_lines")
_ADDED = (*COUNTS, "base_failed", "rules_failed", "kept")
_WORD = r"[^\x20\x09-\x0D]+"
_WITHOUT_LETTER = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0DA-Za-z\x{80}-\x{10FFFF}]+(?![^\x20\x09-\x0D])"
_WINDOW = 3


def _next(a: Column, by: int = 1) -> Column:
    """The array from its ``by``-th next element on."""
    return F.slice(a, by + 1, F.greatest(F.size(a), F.lit(1)))


def _windows(words: Column) -> Column:
    """(hash, three words, place of the first) of every window, sorted; the words decide, the hash only sorts faster."""
    pairs = F.zip_with(words, _next(words), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    threes = F.zip_with(pairs, _next(words, 2), lambda p, c: F.struct(F.xxhash64(p["a"], p["b"], c).alias("h"), p["a"].alias("a"), p["b"].alias("b"), c.alias("c")))
    whole = F.slice(threes, 1, F.greatest(F.size(words) - (_WINDOW - 1), F.lit(0)))
    return F.sort_array(F.transform(whole, lambda w, i: F.struct(w["h"].alias("h"), w["a"].alias("a"), w["b"].alias("b"), w["c"].alias("c"), i.alias("i"))))


def _repeated(windows: Column) -> Column:
    """Places of the windows that stand next to an equal one in the sorted ``windows``, sorted."""
    both = F.zip_with(windows, _next(windows), lambda x, y: F.when((x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]),
                                                                   F.array(x["i"], y["i"])).otherwise(F.array().cast("array<int>")))
    return F.sort_array(F.array_distinct(F.flatten(both)))


def _covered(places: Column) -> Column:
    """Words inside the windows that begin at the sorted ``places``."""
    steps = F.zip_with(places, _next(places), lambda a, b: F.least(F.coalesce(b - a, F.lit(_WINDOW)), F.lit(_WINDOW)))
    return F.aggregate(steps, F.lit(0), lambda total, x: total + x)


def quality_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the columns of ``COUNTS``."""
    keep = [F.col(f"`{c}`") for c in others(docs, _ADDED)]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    split = docs.select(*keep, text.alias("__text"), F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)).alias("__words"))
    lines = F.filter(F.split("__text", "\n", -1), lambda x: x.rlike(_WORD))
    plain = F.filter("__words", lambda w: w.isin(*STOP_WORDS, *(s.capitalize() for s in STOP_WORDS)))
    split = split.select(*keep, "__text", "__words", lines.alias("__lines"), _windows(F.col("__words")).alias("__windows"))
    split = split.select(*keep, "__text", "__words", "__lines", _repeated(F.col("__windows")).alias("__places"))
    values = (F.size("__words"), F.length(F.array_join("__words", "")), F.regexp_count("__text", F.lit(r"[#*$%&|<>]")), F.size("__lines"),
              F.size("__lines") - F.size(F.array_distinct("__lines")), _covered(F.col("__places")), F.size(plain),
              F.size("__words") - F.regexp_count("__text", F.lit(_WITHOUT_LETTER)),
              F.size(F.filter("__lines", lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*\x{2022}]"))),
              F.size(F.filter("__lines", lambda x: x.rlike(r"(\.\.\.|\x{2026})[\x20\x09-\x0D]*$"))))
    return split.select(*keep, *(v.cast("long").alias(c) for c, v in zip(COUNTS, values, strict=True)))


def quality_rules(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, base: tuple[int, int] = BASE) -> DataFrame:
    """``docs`` with the counts, base_failed, rules_failed (names) and kept."""
    counted = quality_counts(docs, text_col)
    failed = (F.col("n_words") < base[0]) | (100 * F.col("n_repeat_words") > base[1] * F.col("n_words"))
    broken = F.array_compact(F.array(*(F.when(r.broken(), F.lit(r.name)) for r in rules))) if rules else F.array().cast("array<string>")
    return (counted.withColumn("base_failed", failed).withColumn("rules_failed", broken)
            .withColumn("kept", ~F.col("base_failed") & (F.size("rules_failed") == 0)))
