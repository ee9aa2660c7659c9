"""Line-first quality rules in DataFrame functions only.

Every line is judged by itself (punctuation, navigation, boilerplate, symbols, shouting); only lines
of wrapped prose may stand without punctuation of their own. Failing lines are removed, and a document that loses too much of its text that way is rejected. Two base
rules on the whole text come on top: too few words, and too many words in repeated windows.

All work happens inside the row. No text is exploded into rows and nothing is shuffled, so a very
long document costs its own length only, and copies cost what other rows cost.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import BLANKS, named

# Fixed values of the base rules: characters counted as symbols, words of a window, least words,
# and the largest share (percent) of words in repeated windows.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
REPEATED_PERCENT = 30

# Line rules. A line fails if any of them holds.
SENTENCE_END = r"[\x{3002}\x{ff01}\x{ff1f}]|[.!?\x{2026}:;]['\")\]\x{bb}\x{201d}\x{2019}]*(\s|$)"
LINE_END = r"[.!?\x{2026}\x{3002}\x{ff01}\x{ff1f}:;]['\")\]\x{bb}\x{201d}\x{2019}]*$"
SHORT_LINE = 12
# Lengths that a wrapped line may have, and how many lines around it show the width of the wrapping.
WRAPPED = (24, 120)
AROUND = 3
SEPARATORS = r" [|>\x{bb}\x{b7}\x{2022}/] "
BOILERPLATE = (
    r"(?i)all rights reserved|terms of (use|service)|privacy policy|cookie policy|"
    r"(accept|uses?) (all )?cookies|sign up for|subscribe to|log ?in to|click here|read more|"
    r"share (this )?on|follow us on|enable javascript|skip to (main )?content|back to top"
)
BOILERPLATE_WORDS = 30
SYMBOL_PERCENT = 5
SHOUT_PERCENT = 30

# The largest share (percent) of characters that may go with failing lines.
LOST_PERCENT = 50


def without(text: Column, characters: str) -> Column:
    """``text`` without these characters; one byte search each, quick where they are rare."""
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), characters, text)


def count_of(text: Column, characters: str) -> Column:
    return F.char_length(text) - F.char_length(without(text, characters))


def words_of(text: Column) -> Column:
    inner = F.btrim(text, F.lit(BLANKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(
        F.split(inner, r"[\x20\x09-\x0D]+")
    )


def _padded(column: Column) -> Column:
    return F.concat(F.array_repeat(F.lit(None).cast("int"), AROUND), column)


def _largest(column: Column, by: int) -> Column:
    return F.zip_with(column, _shifted(column, by), lambda a, b: F.greatest(a, b))


def with_wrapped(rows: DataFrame, lines: str, out: str) -> DataFrame:
    """``rows`` with ``out``: per element of ``lines``, whether it is a line of wrapped prose.

    A line flows into the next if it does not end a sentence and the first word of the next would
    have made it longer than the next and all lines around: that is what breaking lines at a width
    gives, in any language. Lines that flow, and those they flow into, are wrapped prose if a
    sentence ends in a line around. Lists of titles have no such ends, menus no such lengths.
    """
    least, most = WRAPPED

    def measured(line: Column) -> Column:
        inner = F.btrim(line, F.lit(BLANKS))
        size = F.char_length(inner)
        return F.struct(
            size.alias("n"),
            F.char_length(F.substring_index(inner, " ", 1)).alias("first"),
            F.when(size <= most, size).alias("near"),
            F.when(size <= most, line.rlike(SENTENCE_END).cast("int")).alias("stop"),
            (size.between(least, most) & ~inner.rlike(LINE_END)).alias("open"),
        )

    found = rows.withColumn("_m", F.transform(lines, measured))
    for name in ("near", "stop"):
        found = found.withColumn(f"_{name}", _padded(F.col(f"_m.{name}")))
        # Windows of 2, 4 and 7 lines.
        for by in (1, 2, AROUND):
            found = found.withColumn(f"_{name}", _largest(F.col(f"_{name}"), by))

    def flows(a: Column, b: Column) -> Column:
        reach = a.n + 1 + b.first
        return F.when(a.open & (b.n > 0) & (reach > b.n), reach)

    reach = F.zip_with("_m", _shifted(F.col("_m"), 1), flows)
    found = found.withColumn("_flow", F.zip_with(reach, "_near", lambda r, w: F.coalesce(r > w, F.lit(False))))
    before = F.concat(F.array(F.lit(False)), "_flow")
    either = F.zip_with("_flow", before, lambda a, b: a | b)
    wrapped = F.zip_with(either, "_stop", lambda e, s: F.coalesce(e & (s > 0), F.lit(False)))
    return found.withColumn(out, wrapped).drop("_m", "_near", "_stop", "_flow")


def line_fails(line: Column, wrapped: Column) -> Column:
    """True if a line with at least one word fails one of the line rules."""
    spaces = F.char_length(line) - F.char_length(F.replace(line, F.lit(" "), F.lit("")))
    words = spaces + 1
    length = F.char_length(line)
    unpunctuated = (words < SHORT_LINE) & ~wrapped & ~line.rlike(SENTENCE_END)
    links = F.regexp_count(line, F.lit(SEPARATORS))
    navigation = (links >= 3) & (links * 4 >= words)
    boilerplate = (words <= BOILERPLATE_WORDS) & line.rlike(BOILERPLATE)
    symbols = count_of(line, SYMBOLS) * 100 > length * SYMBOL_PERCENT
    # Exclamation marks doubled behind the words.
    shouts = F.char_length(line) - F.char_length(F.replace(line, F.lit("!!"), F.lit("")))
    shouting = (shouts >= 6) & (shouts * 50 > words * SHOUT_PERCENT)
    return symbols | navigation | shouting | unpunctuated | boilerplate


def _sorted_windows(hashes: Column) -> Column:
    """Window hashes with their positions, ordered by hash."""
    return F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))


def _shifted(column: Column, by: int) -> Column:
    return F.slice(column, by + 1, F.greatest(F.size(column) - by, F.lit(0)))


def _joined(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lost_percent: int = LOST_PERCENT,
) -> DataFrame:
    """One row per input row with its counts, verdict and cleaned text.

    Columns: ``id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, n_lines, n_failed_lines, lost_chars, clean_text``.

    A null text is an empty one: no words, so ``base_failed``. Null ids pass through, repeated
    rows are judged each, an empty table gives an empty result, and no other column is read.
    Words in repeated windows are found by 64-bit hashes of eight words within one text.
    """
    text = F.coalesce(named(docs, text_col).cast("string"), F.lit(""))
    base = docs.select(
        named(docs, id_col).alias("_id"),
        text.alias("_text"),
        words_of(text).alias("_words"),
        F.split(text, "\n").alias("_raw"),
    )
    filled = lambda x: F.btrim(x, F.lit(BLANKS)) != ""
    judged = F.zip_with("_raw", "_wrapped", lambda x, w: F.struct(x.alias("x"), w.alias("w")))
    good = F.filter(judged, lambda p: filled(p.x) & ~line_fails(p.x, F.coalesce(p.w, F.lit(False))))
    hashed = with_wrapped(base, "_raw", "_wrapped").select(
        "_id",
        "_text",
        F.filter("_raw", filled).alias("_lines"),
        F.size("_words").alias("n_words"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_one"),
        F.transform(good, lambda p: p.x).alias("_good"),
    )
    two = hashed.withColumn("_two", _joined(F.col("_one"), _shifted(F.col("_one"), 1))).drop("_one")
    four = two.withColumn("_four", _joined(F.col("_two"), _shifted(F.col("_two"), 2))).drop("_two")
    eight = four.withColumn("_all", _joined(F.col("_four"), _shifted(F.col("_four"), 4)))
    windows = eight.drop("_four").withColumn(
        "_windows", F.slice("_all", 1, F.greatest(F.col("n_words") - (WINDOW - 1), F.lit(0)))
    ).drop("_all")
    # Most texts repeat no window; only the others are sorted.
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    ordered = windows.withColumn("_sorted", F.when(repeats, _sorted_windows(F.col("_windows"))))
    linked = ordered.drop("_windows").withColumn(
        "_linked",
        F.zip_with(
            "_sorted",
            _shifted(F.col("_sorted"), 1),
            lambda a, b: F.struct(
                a.i.alias("i"), a.h.alias("h"), F.coalesce(a.h == b.h, F.lit(False)).alias("more")
            ),
        ),
    )
    before = F.concat(
        F.array(F.lit(None).cast("bigint")), F.transform("_sorted", lambda x: x.h)
    )
    marked = linked.withColumn(
        "_marked",
        F.sort_array(
            F.filter(
                F.zip_with(
                    "_linked",
                    before,
                    lambda a, p: F.when(a.more | F.coalesce(a.h == p, F.lit(False)), a.i),
                ),
                lambda i: i.isNotNull(),
            )
        ),
    ).drop("_sorted", "_linked")
    covered = F.aggregate(
        F.zip_with(
            "_marked",
            _shifted(F.col("_marked"), 1),
            lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)).cast("bigint"),
        ),
        F.lit(0).cast("bigint"),
        lambda total, n: total + n,
    )
    chars = lambda lines: F.aggregate(
        lines, F.lit(0).cast("bigint"), lambda total, x: total + F.char_length(x)
    )
    counted = marked.select(
        "_id",
        F.col("n_words").cast("bigint"),
        F.char_length(without(F.col("_text"), BLANKS)).cast("bigint").alias("word_chars"),
        count_of(F.col("_text"), SYMBOLS).cast("bigint").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size("_good")).cast("bigint").alias("n_failed_lines"),
        chars(F.col("_lines")).alias("_chars"),
        chars(F.col("_good")).alias("_left"),
        F.array_join("_good", "\n").alias("clean_text"),
    )
    base_failed = (F.col("n_words") < LEAST_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * REPEATED_PERCENT
    )
    judged = counted.withColumn("base_failed", base_failed).withColumn(
        "lost_chars", F.col("_chars") - F.col("_left")
    )
    kept = ~F.col("base_failed") & (F.col("lost_chars") * 100 <= F.col("_chars") * lost_percent)
    return judged.select(
        F.col("_id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        kept.alias("kept"),
        "n_lines",
        "n_failed_lines",
        "lost_chars",
        "clean_text",
    )
