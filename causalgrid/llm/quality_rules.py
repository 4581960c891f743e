"""Line-first cleaning: rules per line, failed lines go, documents that lose too much text are rejected.

Built from DataFrame functions only. A null text has no words. Equal rows get equal results, very
long texts cost n log n, an empty table gives an empty table, and columns of the input keep their
values: the result is one struct column whose name the caller chooses.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from causalgrid.llm.common import SPACE, doc_texts, fresh

# Phrases of licence, cookie and account lines.
BOILERPLATE = (
    "all rights reserved", "cookie policy", "privacy policy", "terms of service", "terms of use", "accept cookies", "use cookies",
    "enable javascript", "click here", "sign in", "log in", "subscribe to our newsletter", "licensed under", "powered by",
)


#: The phrases as words of their own.
PHRASES = r"(?<![\p{L}\p{N}_])(?:" + "|".join(BOILERPLATE) + r")(?![\p{L}\p{N}_])"
SYMBOLS = r"[#*$%&|<>]+"


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules and of the document verdict."""

    symbols_per_100_words: int = 50  # symbols # * $ % & | < > beyond it: markup or navigation
    shouts_per_100_words: int = 50  # exclamation marks beyond it: shouting
    unfinished_words: int = 2  # a line of so few words has to end in punctuation
    distinct_words_at_least: int = 10  # lines of so many words are tested for repetition
    distinct_per_100_words: int = 20  # fewer different words: one word over and over
    lost_percent: int = 50  # a document that loses more of its word characters is rejected
    words_at_least: int = 50
    repeated_percent: int = 50
    #: A line of more words than this may mention a phrase; it fails only if phrases make up ``phrase_percent`` of its words.
    phrase_line_words: int = 20
    phrase_percent: int = 20


def has_boilerplate(small: Column) -> Column:
    """Of a lower-case text."""
    return reduce(lambda a, b: a | b, [small.contains(x) for x in BOILERPLATE])


def boilerplate_line(line: Column, n: Column, rules: LineRules) -> Column:
    """True where phrases fail a line of ``n`` words."""
    small = F.lower(line)
    found = F.regexp_extract_all(small, F.lit(PHRASES), F.lit(0))
    share = F.size(F.split(F.array_join(found, " "), " ")) * 100 >= n * rules.phrase_percent
    return has_boilerplate(small) & (F.size(found) > 0) & ((n <= rules.phrase_line_words) | share)


def signs(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def failing_line(line: Column, words: Column, rules: LineRules, marked: Column, shouted: Column, boiler: Column) -> Column:
    """True where a line, with these ``words``, breaks a rule.

    ``marked``, ``shouted`` and ``boiler`` say of the whole document whether it holds a symbol, an
    exclamation mark or a boilerplate phrase at all, so that most lines need no look for them.
    """
    n = F.size(words)
    unfinished = (n <= rules.unfinished_words) & ~line.rlike(r"[\p{P}][\x20\x09-\x0D]*$")
    repeated = (n >= rules.distinct_words_at_least) & (
        F.size(F.array_distinct(words)) * 100 < n * rules.distinct_per_100_words
    )
    return (
        (marked & (signs(line, SYMBOLS) * 100 > n * rules.symbols_per_100_words))
        | (shouted & (signs(line, "!+") * 100 > n * rules.shouts_per_100_words))
        | unfinished
        | repeated
        | (boiler & boilerplate_line(line, n, rules))
    )


def repeated_words(words: str) -> str:
    """SQL for the number of words in 3-word windows that occur twice or more in ``words``.

    Windows are compared by 64-bit hashes, sorted once with their places: n log n for any text.
    """
    return f"""
    CASE WHEN size({words}) < 4 THEN 0L ELSE
      aggregate(
        array(transform(arrays_zip(slice({words}, 1, size({words}) - 2), slice({words}, 2, size({words}) - 2), slice({words}, 3, size({words}) - 2)),
                        z -> xxhash64(z['0'], z['1'], z['2']))),
        0L,
        (total, hashes) -> CASE WHEN size(array_distinct(hashes)) = size(hashes) THEN total ELSE
          aggregate(
            transform(array(sort_array(transform(hashes, (h, i) -> struct(h AS h, i AS i)))),
              s -> sort_array(transform(filter(s, (x, k) -> coalesce(get(s, k - 1).h = x.h, false) OR coalesce(get(s, k + 1).h = x.h, false)), x -> x.i))),
            total,
            (t, places) -> aggregate(transform(places, (p, k) -> least(3, coalesce(p - get(places, k - 1), 3))), t, (a, b) -> a + b))
          END)
    END"""


def with_verdict(docs: DataFrame, out: str, text_col: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """``docs`` with a struct column ``out``: the counts, ``base_failed``, ``kept``, ``failed_lines`` and ``clean_text``."""
    own = {k: fresh(docs, f"_{k}_of_quality") for k in ("text", "words", "lines", "good", "marks", "shouts", "boiler", "small")}
    text, words, lines, good, marks, shouts, boiler, small = (F.col(c) for c in own.values())
    has_word = lambda x: x.rlike(r"[^\x20\x09-\x0D]")
    split = lambda x: F.array_remove(F.split(x, SPACE), "")
    bad = lambda x: failing_line(x.line, x.words, rules, marks > 0, shouts > 0, boiler)
    parts = (
        docs.withColumn(own["text"], F.coalesce(F.col(text_col), F.lit("")))
        .withColumns({own["marks"]: signs(text, SYMBOLS), own["shouts"]: signs(text, "!+"), own["small"]: F.lower(text)})
        .withColumn(own["boiler"], has_boilerplate(small))
        .withColumns({own["words"]: split(text), own["lines"]: F.filter(F.split(text, "\n"), has_word)})
        .withColumn(own["good"], F.filter(F.transform(lines, lambda x: F.struct(x.alias("line"), split(x).alias("words"))), lambda x: ~bad(x)).line)
    )
    n_words = F.size(words).cast("long")
    chars = lambda a: F.length(F.regexp_replace(F.array_join(a, ""), SPACE, ""))
    counted = parts.withColumn(
        out,
        F.struct(
            n_words.alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            marks.cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            F.expr(repeated_words(f"`{own['words']}`")).alias("n_repeat_words"),
            (F.size(lines) - F.size(good)).cast("long").alias("failed_lines"),
            F.when(F.size(lines) == F.size(good), F.col(text_col)).otherwise(F.array_join(good, "\n")).alias("clean_text"),
            F.when(F.size(lines) == F.size(good), F.lit(0)).otherwise(chars(lines) - chars(good)).cast("long").alias("lost_chars"),
        ),
    ).drop(*own.values())
    v = F.col(out)
    failed = (v.n_words < rules.words_at_least) | (v.n_repeat_words * 100 > v.n_words * rules.repeated_percent)
    lost = v.lost_chars * 100 > v.word_chars * rules.lost_percent
    return counted.withColumn(out, v.withField("base_failed", failed).withField("kept", ~failed & ~lost))


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """One row per document: its counts and whether it is kept."""
    v = with_verdict(doc_texts(docs, id_col, text_col), "v", rules=rules)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_lines", "lost_chars")
    return v.select("doc_id", *[F.col("v")[n].alias(n) for n in names])


def keep_good(docs: DataFrame, text_col: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """The documents that are kept, without their failed lines, under the columns of ``docs``.

    A column ``n_chars`` follows the text where lines were taken out.
    """
    out = fresh(docs, "_quality")
    judged = with_verdict(docs, out, text_col, rules)
    # a condition on the verdict would be pushed below it and bring copies of its whole expression; it stops at a generator
    kept = judged.withColumn(out, F.explode(F.array(out))).where(F.col(out).kept)
    changed = F.col(out).failed_lines > 0
    new = {text_col: F.when(changed, F.col(out).clean_text).otherwise(F.col(text_col))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.length(F.col(out).clean_text).cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumns(new).select(*docs.columns)
