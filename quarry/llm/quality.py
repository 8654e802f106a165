r"""Line-first quality rules (DataFrame functions only, no shuffle).

Every line of a text (split on \n) is judged by the punctuation, navigation and boilerplate rules
below. Lines that fail are removed; a text that loses more than ``max_removed`` of its characters,
or that fails the base rules, is rejected. Everything happens inside one row's expressions, so a
hot source or a very long text costs what its characters cost and nothing is shuffled.

Base rules, over words ``[^\x20\x09-\x0D]+`` of the whole text: fewer than ``min_words`` words, or
more than ``max_repeat_pct`` percent of the words inside 8-word windows that occur twice or more.

Line rules; w is the number of words of the line:

* punctuation: at least 3 characters of ``#*$%&|<>`` and more than w/10 of them; or at least 3 of
  ``!?`` and more than w/2 of them; or w >= ``long_line`` without any of ``. ! ? ; : ,`` or a CJK stop.
* navigation: 3 or more of the separators ``| » › ·``; or the whole line, lower-cased and without
  outer punctuation, is one of NAVIGATION.
* boilerplate: the lower-cased line contains one of BOILERPLATE.

Defined results: a null text counts as empty and is rejected (0 words); blank lines never fail and
carry no weight; other columns are not read, so their names cannot clash; rows keep their
multiplicity; null ids stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import text_of

SEPARATORS = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8

NAVIGATION = [
    "home", "menu", "search", "login", "log in", "sign in", "sign up", "register", "next",
    "previous", "back", "back to top", "read more", "click here", "skip to content", "share",
    "contact", "contact us", "about", "about us", "sitemap", "subscribe",
]
BOILERPLATE = [
    "all rights reserved", "cookie policy", "uses cookies", "accept cookies", "privacy policy",
    "terms of use", "terms of service", "enable javascript", "powered by", "lorem ipsum",
    "subscribe to our newsletter", "sign up for our newsletter",
]


def let(value: Column, body) -> Column:
    """``body`` with ``value`` bound to a variable, so that it is computed once a row."""
    return F.transform(F.array(value), body).getItem(0)


def count_matches(text: Column, pattern: str) -> Column:
    return F.size(F.split(text, pattern, -1)) - 1


def words_of(text: Column) -> Column:
    trimmed = F.trim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SEPARATORS, -1))


def repeated_words(words: Column) -> Column:
    """Words that lie in windows of WINDOW words found twice or more, the first included.

    Windows are compared by a 64-bit hash, and equal hashes by their words. The sort runs only
    for texts in which two windows share a hash.
    """
    window = lambda i: F.slice(words, i + 1, WINDOW)

    def starts(keys: Column) -> Column:
        pairs = F.sort_array(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
        return let(pairs, lambda s: F.array_sort(F.filter(F.transform(
            s, lambda x, j: F.when(same(x, F.get(s, j - 1)) | same(x, F.get(s, j + 1)), x["i"])),
            lambda i: i.isNotNull())))

    def same(a: Column, b: Column) -> Column:
        return F.coalesce((a["k"] == b["k"]) & (window(a["i"]) == window(b["i"])), F.lit(False))

    def covered(found: Column) -> Column:
        steps = F.transform(found, lambda x, j: F.least(F.lit(WINDOW), F.get(found, j + 1) - x))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    keys = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW),
                       lambda i: F.xxhash64(window(i)))
    some = lambda k: F.when(F.size(F.array_distinct(k)) < F.size(k),
                            let(starts(k), covered)).otherwise(F.lit(0).cast("long"))
    return F.when(F.size(words) < WINDOW, F.lit(0).cast("long")).otherwise(let(keys, some))


def line_fails(line: Column, long_line: int) -> Column:
    words = F.size(F.split(F.trim(line, F.lit(BLANKS)), SEPARATORS, -1))
    low = F.lower(line)

    def judged(x: Column) -> Column:
        return ((x["symbols"] >= 3) & (x["symbols"] * 10 > x["w"])
                | (x["shouts"] >= 3) & (x["shouts"] * 2 > x["w"])
                | (x["w"] >= long_line) & ~x["stops"]
                | (x["bars"] >= 3)
                | F.regexp_replace(x["low"], r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "").isin(NAVIGATION)
                | F.coalesce(x["low"].rlike("|".join(BOILERPLATE)), F.lit(False)))
    return let(F.struct(words.alias("w"), count_matches(line, SYMBOLS).alias("symbols"),
                        count_matches(line, "[!?]").alias("shouts"),
                        count_matches(line, "[|»›·]").alias("bars"),
                        line.rlike("[.!?;:,。！？…]").alias("stops"),
                        low.alias("low")), judged)


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            min_words: int = 20, max_repeat_pct: int = 30, max_removed: float = 0.4,
            long_line: int = 12) -> DataFrame:
    """Verdict per row: id, base counts, base_failed, n_lines, n_bad_lines, chars and
    removed_chars of lines with a word, kept, and clean_text (the text without failed lines)."""
    base = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t"))
    counted = let(words_of(F.col("t")), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w).alias("n_repeat_words")))
    lines = F.transform(F.split(F.col("t"), "\n", -1), lambda line: F.struct(
        line.alias("line"), (F.trim(line, F.lit(BLANKS)) != "").alias("full")))
    lines = F.transform(lines, lambda x: F.struct(
        x["line"].alias("line"), x["full"].alias("full"),
        (x["full"] & line_fails(x["line"], long_line)).alias("bad")))

    def summed(items: Column) -> Column:
        full = F.transform(F.filter(items, lambda x: x["full"]), lambda x: x["line"])
        chars = lambda keep: F.aggregate(
            items, F.lit(0).cast("long"),
            lambda total, x: total + F.when(keep(x), F.length(x["line"])).otherwise(0))
        return F.struct(
            let(full, lambda f: F.size(f) - F.size(F.array_distinct(f))).cast("long").alias("n_dup_lines"),
            F.size(full).cast("long").alias("n_lines"),
            F.size(F.filter(items, lambda x: x["bad"])).cast("long").alias("n_bad_lines"),
            chars(lambda x: x["full"]).alias("chars"),
            chars(lambda x: x["bad"]).alias("removed_chars"),
            F.array_join(F.transform(F.filter(items, lambda x: ~x["bad"]), lambda x: x["line"]),
                         "\n").alias("clean_text"))
    out = base.select("id", counted.alias("c"), let(lines, summed).alias("l"),
                      count_matches(F.col("t"), SYMBOLS).cast("long").alias("n_symbols"))
    failed = (F.col("c.n_words") < min_words) | (
        100 * F.col("c.n_repeat_words") > max_repeat_pct * F.col("c.n_words"))
    return out.select(
        "id", "c.n_words", "c.word_chars", "n_symbols", "l.n_dup_lines", "c.n_repeat_words",
        failed.alias("base_failed"), "l.n_lines", "l.n_bad_lines", "l.chars", "l.removed_chars",
        (~failed & (F.col("l.removed_chars") <= max_removed * F.col("l.chars"))).alias("kept"),
        "l.clean_text")
