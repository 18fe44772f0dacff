"""Quality rules: clean line by line first, then reject what lost too much of its text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txflow.llm.common import NOT_SPACE, SPACE, words

WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
BOILERPLATE = (
    r"(cookie policy|cookies? settings|privacy policy|terms of (use|service)|all rights reserved|enable javascript"
    r"|javascript is (disabled|required)|click here|subscribe to our|sign in|log in|read more|share this|lorem ipsum)"
)


# A line without any of these cannot fail the counting rules, which is cheaper to see than to count.
MARKS = r"[|>/\x{00BB}#*$%&<]|::|--|[!?]{2}|[A-Z]{2}"
SEPARATORS = r"(^|[\x20\x09])([|>/\x{00BB}]|::|--)"


@dataclass(frozen=True)
class LineRules:
    """When a line fails, and how much of its text a document may lose.

    A line fails if one of these is true (``n`` is its number of words):
    ``separators`` navigation marks a word or more; ``symbols`` decoration marks a word or more;
    ``exclaims`` doubled exclamation or question marks a word or more; ``capitals`` of its ASCII letters are upper case,
    there are ``min_letters`` of them and two stand side by side; a boilerplate phrase in at most ``short`` characters;
    neither a letter nor a digit; or, from ``min_words`` words on, no punctuation mark at all.
    """

    separators: float = 0.2
    symbols: float = 0.2
    exclaims: float = 0.2
    capitals: float = 0.7
    min_letters: int = 20
    min_words: int = 10
    short: int = 100
    min_kept: float = 0.5


RULES = LineRules()


def line_fails(line: Column, rules: LineRules = RULES) -> Column:
    """Whether a line that holds a word fails a rule of :class:`LineRules`. Cheap tests stand before counts."""
    count = lambda pattern: F.regexp_count(line, F.lit(pattern))
    n, letters = count(f"{NOT_SPACE}+"), count("[A-Za-z]")
    marked = (
        (count(SEPARATORS) >= rules.separators * n)
        | (count(SYMBOLS) >= rules.symbols * n)
        | (count(r"[!?]{2,}") >= rules.exclaims * n)
        | (line.rlike("[A-Z]{2}") & (letters >= rules.min_letters) & (count("[A-Z]") >= rules.capitals * letters))
    )
    return (
        (line.rlike(MARKS) & marked)
        | (~line.rlike(r"[.,;:!?]") & (n >= rules.min_words))
        | ((F.char_length(line) <= rules.short) & line.rlike("(?i)" + BOILERPLATE))
        | ~line.rlike(r"[\p{L}\p{N}]")
    )


def clean_lines(docs: DataFrame, rules: LineRules = RULES) -> DataFrame:
    """One row for each document: base counts, cleaned text and verdict.

    ``text`` is what is left after failing lines are removed; ``kept`` is false where ``base_failed`` holds or where
    the lines left hold less than ``min_kept`` of the characters in words. NULL text counts as empty: no words, so
    it fails. Other columns of ``docs`` are not read, so that they cannot clash. Nothing is shuffled: every row is
    judged by itself, and repeated rows get the same verdict.

    Words of repeated windows are found from sorted 64-bit window hashes, in time n log n of the text.
    """
    text = F.coalesce("text", F.lit("")).alias("t")
    step = docs.select("doc_id", text).withColumn("w", words(F.col("t")))
    step = step.withColumn("hw", F.transform("w", lambda x: F.xxhash64(x)))
    at = lambda i: F.xxhash64(*[F.get("hw", i + k) for k in range(WINDOW)])
    none = F.array().cast("array<bigint>")
    step = step.withColumn(
        "win", F.when(F.size("hw") >= WINDOW, F.transform(F.sequence(F.lit(0), F.size("hw") - WINDOW), at)).otherwise(none)
    )
    pairs = F.sort_array(F.transform("win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    step = step.withColumn("s", F.when(F.size(F.array_distinct("win")) < F.size("win"), pairs))
    same = lambda x, k: F.coalesce(F.get("s", k)["h"] == x["h"], F.lit(False))
    twice = F.filter("s", lambda x, k: same(x, k - 1) | same(x, k + 1))
    step = step.withColumn("p", F.sort_array(F.transform(twice, lambda x: x["i"])))
    gaps = F.aggregate(
        F.transform("p", lambda x, k: F.least(F.lit(WINDOW), x - F.coalesce(F.get("p", k - 1), x - WINDOW))),
        F.lit(0),
        lambda a, x: a + x,
    )
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(NOT_SPACE))
    chars = lambda x: F.char_length(F.regexp_replace(x, f"{SPACE}+", ""))
    step = step.withColumns({"lines": lines, "n_repeat_words": F.coalesce(gaps, F.lit(0)).cast("long")})
    step = step.withColumn("good", F.filter("lines", lambda x: ~line_fails(x, rules)))
    step = step.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("good")).cast("long").alias("n_removed_lines"),
        F.array_join("good", "\n").alias("text"),
    )
    left = F.when(F.col("n_removed_lines") == 0, F.col("word_chars")).otherwise(chars(F.col("text")))
    step = step.withColumn("kept_chars", left.cast("long"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    enough = F.col("kept_chars") >= rules.min_kept * F.col("word_chars")
    return step.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & enough)


def op8_quality(docs: DataFrame) -> DataFrame:
    return clean_lines(docs).drop("text")


_COUNT = "len(regexp_extract_all({0}, '{1}'))"
_LINE = f"""
    {_COUNT.format("l", SEPARATORS)} >= {RULES.separators} * n
    or {_COUNT.format("l", SYMBOLS)} >= {RULES.symbols} * n
    or {_COUNT.format("l", "[!?]{2,}")} >= {RULES.exclaims} * n
    or (regexp_matches(l, '[A-Z]{{2}}') and {_COUNT.format("l", "[A-Za-z]")} >= {RULES.min_letters}
        and {_COUNT.format("l", "[A-Z]")} >= {RULES.capitals} * {_COUNT.format("l", "[A-Za-z]")})
    or (n >= {RULES.min_words} and not regexp_matches(l, '[.,;:!?]'))
    or (length(l) <= {RULES.short} and regexp_matches(l, '(?i){BOILERPLATE}'))
    or not regexp_matches(l, '[\\p{{L}}\\p{{N}}]')
"""
SQL = f"""
with d as (select doc_id, coalesce(text, '') t from documents),
w as (select doc_id, t, [x for x in string_split_regex(t, '{SPACE}+') if x <> ''] w from d),
win as (select doc_id, i, array_to_string(w[i:i + 7], ' ') h
        from (select doc_id, w, unnest(range(1, len(w) - 6)) i from w where len(w) >= {WINDOW})),
twice as (select doc_id, i from (select *, count(*) over (partition by doc_id, h) n from win) where n > 1),
rep as (select doc_id, count(distinct p) n_repeat_words
        from (select doc_id, unnest(range(i, i + {WINDOW})) p from twice) group by doc_id),
ln as (select doc_id, l, len(regexp_extract_all(l, '{NOT_SPACE}+')) n
       from (select doc_id, unnest(string_split(t, chr(10))) l from d) where regexp_matches(l, '{NOT_SPACE}')),
judged as (select doc_id, l, {_LINE} bad from ln),
by_line as (select doc_id, count(*) n_lines, count(*) - count(distinct l) n_dup_lines,
            count(*) filter (bad) n_removed_lines,
            sum(case when bad then 0 else length(regexp_replace(l, '{SPACE}+', '', 'g')) end)::bigint kept_chars
            from judged group by doc_id),
base as (select doc_id, len(w)::bigint n_words, length(regexp_replace(t, '{SPACE}+', '', 'g'))::bigint word_chars,
         {_COUNT.format("t", SYMBOLS)}::bigint n_symbols, coalesce(n_dup_lines, 0) n_dup_lines,
         coalesce(n_repeat_words, 0) n_repeat_words, coalesce(n_lines, 0) n_lines,
         coalesce(n_removed_lines, 0) n_removed_lines, coalesce(kept_chars, 0) kept_chars
         from w left join by_line using (doc_id) left join rep using (doc_id))
select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words base_failed,
       not (n_words < 20 or 100 * n_repeat_words > 30 * n_words) and kept_chars >= {RULES.min_kept} * word_chars kept
from base
"""
