"""Quality rules, line first: rules judge each line, failing lines go, documents that lose too much go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from veil.llm.common import SPACES, words

# Fixed values that the measured columns are defined by.
SYMBOL_CLASS = "[#*$%&|<>]"
WINDOW = 3
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

# Line rules.
SEPARATORS = "|»›·•"
# Phrases by their first letter, tried where a word begins.
BOILERPLATE = (
    "(?i)(?:^\\s*(?:©|\\(c\\)) |\\b(?:a(?:ll rights reserved|dd to (?:cart|basket))|c(?:ookie (?:policy|settings)|lick here|opyright (?:©|\\(c\\)|[12][0-9]))"
    "|enable javascript|javascript is (?:disabled|required)|l(?:orem ipsum|icensed under)|privacy policy|read more\\.\\.\\."
    "|s(?:ubscribe to (?:our|the) newsletter|ign up for our newsletter|hare (?:this )?on (?:facebook|twitter|whatsapp))"
    "|terms of (?:use|service)|uses cookies|we use cookies))"
)
# No phrase is the beginning of another way to read the same text, so nothing is lost by possessive loops, which
# need no stack for a long line.
NAVIGATION = (
    "(?i)^\\s*+(?:(?:home|menu|login|log in|sign in|sign up|register|search|contact|about(?: us)?+|next|previous|back|top|skip to content"
    "|share|print|faq|help|sitemap|rss)[\\s/,:>-]*+)++$"
)
#: A document is rejected when less than this share of its characters stays.
LEAST_KEPT_PERCENT = 50


def punctuation_fails(line: Column) -> Column:
    """Eight words without an end of a sentence, shouted words, or one symbol in ten characters."""
    unended = ~line.rlike("[.!?…。]") & line.rlike(f"^(?:[^ ]*+ ){{7}}[^ ]")
    shouted = line.rlike("(?:(?<!!)![!]++(?:\\s|$)[^!]*+){3}")
    symbols = F.regexp_count(line, F.lit(SYMBOL_CLASS))
    return unended | shouted | (symbols * 10 > F.length(line))


def navigation_fails(line: Column) -> Column:
    """Two or more separators, or nothing but words of menus."""
    return line.rlike(f"[{SEPARATORS}][^{SEPARATORS}]*+[{SEPARATORS}]") | line.rlike(NAVIGATION)


def boilerplate_fails(line: Column) -> Column:
    return line.rlike(BOILERPLATE)


def line_fails(line: Column) -> Column:
    return (F.trim(line, F.lit(SPACES)) != "") & (punctuation_fails(line) | navigation_fails(line) | boilerplate_fails(line))


def measured_rules(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed.

    All of the whole text and in one row, without a shuffle. Repeated windows are looked for by
    sorting one number for each window, the upper bits of its hash and then its place, and those found are
    compared by their whole hashes.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    long = lambda c: c.cast("bigint")
    out = docs.withColumn("_words", words(text)).withColumn("_lines", F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(SPACES)) != ""))
    n = F.size("_words")
    # All bits but those that the largest place needs.
    bits = F.ceil(F.log2(F.greatest(n, F.lit(1)) + 1)).cast("int")
    out = out.withColumn("n_words", long(n)).withColumn("_mask", F.call_function("shiftleft", F.lit(-1).cast("bigint"), bits))
    out = out.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    hashed = lambda i: F.xxhash64(*(F.get("_hashes", i + j) for j in range(WINDOW)))
    packed = lambda i: hashed(i).bitwiseAND(F.col("_mask")) + i
    windows = F.when(n > WINDOW, F.sort_array(F.transform(F.sequence(F.lit(0), n - WINDOW), packed)))
    out = out.withColumn("_windows", windows)
    name = lambda x: x.bitwiseAND(F.col("_mask"))
    twice = F.filter(
        "_windows",
        lambda x, i: (name(x) == name(F.get("_windows", i - 1))) | (name(x) == name(F.get("_windows", i + 1))),
    )
    # get() knows no negative index: null there, and null counts as different.
    whole = lambda x: F.struct(hashed(x.cast("int")).alias("h"), x.alias("at"))
    out = out.withColumn("_maybe", F.sort_array(F.transform(twice, lambda x: whole(x.bitwiseAND(F.bitwise_not("_mask"))))))
    again = F.filter("_maybe", lambda x, i: (x["h"] == F.get("_maybe", i - 1)["h"]) | (x["h"] == F.get("_maybe", i + 1)["h"]))
    out = out.withColumn("_places", F.sort_array(F.transform(again, lambda x: x["at"])))
    gaps = F.transform(
        "_places",
        lambda x, i: F.least(F.lit(WINDOW).cast("bigint"), F.coalesce(F.get("_places", i + 1) - x, F.lit(WINDOW).cast("bigint"))),
    )
    out = out.withColumn("n_repeat_words", F.coalesce(F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, x: a + x), F.lit(0).cast("bigint")))
    out = (
        out.withColumn("word_chars", long(F.length(F.array_join("_words", ""))))
        .withColumn("n_symbols", long(F.regexp_count(text, F.lit(SYMBOL_CLASS))))
        .withColumn("n_dup_lines", long(F.size("_lines") - F.size(F.array_distinct("_lines"))))
        .withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (F.lit(100) * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")))
    )
    return out.drop("_words", "_mask", "_hashes", "_windows", "_maybe", "_places")


def apply_quality_rules(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the columns of ``measured_rules``, and n_lines, n_lines_removed, kept_chars, cleaned, kept.

    ``cleaned`` is the text without the lines that fail a rule; lines without a word have no
    part in it. ``kept`` is false if ``base_failed``, or if the lines that stay have less than
    ``LEAST_KEPT_PERCENT`` of the characters of all lines. Null and empty text: zeros, base_failed,
    not kept. Equal rows get equal results; an empty table gives an empty result. Columns with
    the names of results are replaced, and those with the names of steps (``_words``, ``_lines`` and so on) come through
    as they are. A line may be as long as a text.
    """
    steps = {"_words", "_lines", "_mask", "_hashes", "_windows", "_maybe", "_places", "_stay"}
    docs = docs.withColumnsRenamed({c: f"{c}_given" for c in docs.columns if c in steps})
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_lines", "n_lines_removed", "kept_chars", "cleaned", "kept"]
    out = measured_rules(docs.drop(*(c for c in names if c != text_col)), text_col)
    out = out.withColumn("_stay", F.filter("_lines", lambda x: ~line_fails(x)))
    chars = lambda c: F.length(F.array_join(c, ""))
    return (
        out.withColumn("n_lines", F.size("_lines").cast("bigint"))
        .withColumn("n_lines_removed", (F.size("_lines") - F.size("_stay")).cast("bigint"))
        .withColumn("kept_chars", chars("_stay").cast("bigint"))
        .withColumn("kept", ~F.col("base_failed") & (F.lit(100) * F.col("kept_chars") >= LEAST_KEPT_PERCENT * chars("_lines")))
        .withColumn("cleaned", F.array_join("_stay", "\n"))
        .drop("_lines", "_stay")
        .withColumnsRenamed({f"{c}_given": c for c in steps})
    )
