"""Line-first cleaning: rules per line, then a verdict on what is left of the document.

Everything is a column expression of one row; nothing is shuffled. A null text counts as
empty, an empty text has no words and fails the base rules, blank lines are neither judged
nor removed. Repeated rows are judged alike, an empty table gives an empty result, and only
the columns named in ``clean`` are read, so further columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.llm.common import let

# Words as the contract has them: white space is ASCII only.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MIN_LEFT_PERCENT = 50

# Line rules. Shares are of the words of the line.
SEPARATOR = r"[|>•»·]"
SEPARATOR_SHARE = 4  # one separator for each four words or more: a navigation bar
SHOUT = r"[!?*#$%&=~_]{2,}"
SHOUT_SHARE = 5  # one run of marks for each five words or more
STOPS = r"[.,;:!?…]"
LONG_LINE = 8  # words from which a line needs some punctuation
SHORT_LINE = 30  # words up to which a line can be navigation or boilerplate
NAVIGATION = (
    r"(?i)^(home|menu|next|previous|back|top|login|log in|sign in|sign up|register|search|"
    r"contact|about|sitemap|share|tweet|print|read more|skip to content)[.:]?$"
)
BOILERPLATE = (
    r"(?i)all rights reserved|licensed under|released under the|cookie|privacy policy|"
    r"terms of (use|service)|enable javascript|lorem ipsum|click here|subscribe to|"
    r"powered by|copyright \d{4}"
)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def repeated_words(words: Column) -> Column:
    """Words that stand in a five-word window found twice or more, the first find included.

    Windows are told apart by a 64-bit hash. Texts without any repeat leave at the distinct
    count; in others the windows are sorted by hash and place, packed into one number (40
    bits of the hash, 24 of the place, so texts of up to 16 million words), neighbours are
    compared by their whole hashes, and overlapping windows count their words once.
    """
    place = F.lit(0xFFFFFF).cast("long")

    def covered(hashes: Column) -> Column:
        packed = F.transform(hashes, lambda h, i: h.bitwiseAND(~0xFFFFFF).bitwiseOR(i))

        def starts(s: Column) -> Column:
            def same(x: Column, y: Column) -> Column:
                at = lambda z: F.get(hashes, z.bitwiseAND(place).cast("int"))
                near = F.shiftright(x.bitwiseXOR(y), 24) == 0
                return F.coalesce(near & (at(x) == at(y)), F.lit(False))

            found = F.filter(s, lambda x, i: same(x, F.get(s, i - 1)) | same(x, F.get(s, i + 1)))
            return F.sort_array(F.transform(found, lambda x: x.bitwiseAND(place).cast("int")))

        def total(p: Column) -> Column:
            own = F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW))))
            return F.aggregate(own, F.lit(0), lambda a, b: a + b)

        return let(let(F.sort_array(packed), starts), total)

    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    )
    counted = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))
    return F.when(F.size(words) > WINDOW, counted).otherwise(F.lit(0)).cast("long")


def bad_line(line: Column, n_words: Column) -> Column:
    """True for a line of navigation, boilerplate or broken punctuation."""
    marks = F.regexp_count(line, F.lit(SEPARATOR)) * SEPARATOR_SHARE, F.regexp_count(line, F.lit(SHOUT)) * SHOUT_SHARE
    short = (n_words <= SHORT_LINE) & (F.trim(line).rlike(NAVIGATION) | line.rlike(BOILERPLATE))
    broken = line.rlike(f"{SEPARATOR}|{SHOUT}") & ((marks[0] >= n_words) | (marks[1] >= n_words))
    return (n_words > 0) & (broken | ((n_words >= LONG_LINE) & ~line.rlike(STOPS)) | short)


def clean(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: the key, the counts, the cleaned text and the verdict.

    ``kept`` is false when a base rule fails or when fewer than half of the characters in
    words are left after the failing lines are gone.
    """
    whole = F.coalesce(F.col(text), F.lit(""))

    def judged(line: Column) -> Column:
        return let(
            words_of(line),
            lambda w: F.struct(
                line.alias("line"),
                w.alias("words"),
                F.length(F.array_join(w, "")).cast("long").alias("chars"),
                bad_line(line, F.size(w)).alias("bad"),
            ),
        )

    def summed(values: Column) -> Column:
        return F.aggregate(values, F.lit(0).cast("long"), lambda a, b: a + b)

    lines = docs.select(
        F.col(key),
        F.regexp_count(whole, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        F.transform(F.split(whole, "\n"), judged).alias("_lines"),
    )
    left = F.filter("_lines", lambda x: ~x["bad"])
    with_word = F.transform(F.filter("_lines", lambda x: x["chars"] > 0), lambda x: x["line"])
    counted = lines.select(
        key,
        let(
            F.flatten("_lines.words"),
            lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words")),
        ).alias("_facts"),
        summed(F.col("_lines.chars")).alias("word_chars"),
        "n_symbols",
        let(with_word, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        let(
            left,
            lambda x: F.struct(
                F.array_join(x["line"], "\n").alias("text"),
                F.size(x).cast("long").alias("n"),
                summed(x["chars"]).alias("chars"),
            ),
        ).alias("_left"),
    )
    n_words, repeats = F.col("_facts.n_words"), F.col("_facts.n_repeat_words")
    base = (n_words < MIN_WORDS) | (repeats * 100 > n_words * MAX_REPEAT_PERCENT)
    return counted.select(
        key,
        n_words.alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        repeats.alias("n_repeat_words"),
        base.alias("base_failed"),
        (~base & (F.col("_left.chars") * 100 >= F.col("word_chars") * MIN_LEFT_PERCENT)).alias("kept"),
        (F.col("n_lines") - F.col("_left.n")).alias("n_removed_lines"),
        F.col("_left.chars").alias("left_chars"),
        F.col("_left.text").alias("clean_text"),
    )
