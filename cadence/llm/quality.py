"""Quality rules (operator 3): a threshold table compiled into one projection.

Every measure is a DataFrame expression; nothing leaves the JVM and nothing is
shuffled. ``RULES`` bounds ratios of the measures; ``verdict`` turns the table
into one boolean expression.

Words are runs of characters other than space and ``\\x09-\\x0D``.

``n_repeat_words`` is linear in the text but for sorting: each 8-word window
gets a 64-bit hash; only texts in which a hash occurs twice go on, and there
the windows' words decide, so the count is exact.

Edge cases: a null text has no words and fails the base rule, as the empty text
does; a ratio over nothing is 0; rows are judged one by one, so ties, repeated
rows and null ids change nothing; other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import whole_text

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 8

#: Frequent words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and a to in is that it was for on are with as he his they be at one have this "
    "der die das und ist zu den mit ein eine auf nicht sich des dem von im "
    "le la les de et un une est que qui en dans pour pas sur au du "
    "el los las y es por con se del no al para"
).split()


@dataclass(frozen=True)
class Rule:
    """``least <= part / whole <= most``, from ``from_words`` words on."""

    name: str
    part: str
    whole: str
    least: float | None = None
    most: float | None = None
    from_words: int = 0


RULES = (
    Rule("symbol_ratio", "n_symbols", "n_words", most=0.1),
    Rule("word_length", "word_chars", "n_words", least=2.0, most=15.0),
    Rule("duplicate_line_ratio", "n_dup_lines", "n_lines", most=0.5),
    Rule("stutter_ratio", "n_stutter", "n_words", most=0.25),
    Rule("stop_word_ratio", "n_stop_words", "n_words", least=0.005, from_words=200),
)


def _without(text: Column, pattern: str) -> Column:
    return F.char_length(F.regexp_replace(text, pattern, ""))


def _covered(places: Column, width: int) -> Column:
    """Words covered by windows of ``width`` words at ascending ``places``."""
    steps = F.transform(places, lambda p, i: F.least(F.lit(width), F.coalesce(F.get(places, i + 1) - p, F.lit(width))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)


def _neighbours_equal(rows: Column, key: str) -> Column:
    """The rows of a sorted array whose ``key`` equals that of the row before or after."""
    def twice(row: Column, i: Column) -> Column:
        same = lambda j: F.coalesce(F.get(rows, j)[key] == row[key], F.lit(False))
        return same(i - 1) | same(i + 1)
    return F.filter(rows, twice)


def measured(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id and all measures (long) of each row."""
    # Each step is a projection of its own so that no expression is evaluated twice.
    text = docs.select(F.col(id_column), whole_text(text_column).alias("text"))
    words = text.select(
        id_column,
        F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"),
        _without(F.col("text"), SPACE + "+").cast("long").alias("word_chars"),
        (F.char_length("text") - _without(F.col("text"), SYMBOL + "+")).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD)).alias("lines"),
    )
    hashed = words.withColumn("h", F.transform("words", lambda w: F.xxhash64(w)))
    h = F.col("h")
    windows = F.when(F.size(h) > WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(h) - WINDOW),
        lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])))
    counted = hashed.withColumn("w", windows).select(
        id_column, "words", "word_chars", "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter(h, lambda x, i: F.coalesce(x == F.get(h, i + 1), F.lit(False)))).cast("long").alias("n_stutter"),
        F.size(F.filter("words", lambda w: w.isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.when(F.size(F.array_distinct("w")) < F.size("w"), F.col("w")).alias("w"),
    )
    # From here on only texts with a hash that occurs twice have a "w".
    by_hash = counted.withColumn("w", F.array_sort(F.transform("w", lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
    suspects = by_hash.withColumn("w", _neighbours_equal(F.col("w"), "h"))
    by_words = suspects.withColumn("w", F.array_sort(F.transform(
        "w", lambda x: F.struct(F.array_join(F.slice("words", x["i"] + 1, WINDOW), " ").alias("s"), x["i"].alias("i")))))
    places = by_words.withColumn("w", F.array_sort(F.transform(_neighbours_equal(F.col("w"), "s"), lambda x: x["i"])))
    # Through a generator of one row: a filter on a measure stays above it, else
    # the optimizer would copy the steps into the filter, one into the other.
    return places.select(id_column, F.inline(F.array(F.struct(
        "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(_covered(F.col("w"), WINDOW), F.lit(0)).cast("long").alias("n_repeat_words"),
        "n_lines", "n_stutter", "n_stop_words"))))


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """The threshold table as one expression over the measures."""
    kept = F.lit(True)
    for rule in rules:
        ratio = F.coalesce(F.try_divide(F.col(rule.part), F.col(rule.whole)), F.lit(0.0))
        inside = F.lit(True)
        if rule.least is not None:
            inside = inside & (ratio >= rule.least)
        if rule.most is not None:
            inside = inside & (ratio <= rule.most)
        kept = kept & (inside | (F.col("n_words") < rule.from_words))
    return kept


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


def quality_report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                   rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row for each row: its measures, ``base_failed`` and ``kept``."""
    return (measured(docs, id_column, text_column)
            .withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & verdict(rules)))


def good_documents(docs: DataFrame, text_column: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows, with all their columns, that the rules keep."""
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), whole_text(text_column).alias("text"))
    report = quality_report(held, "__row", "text", rules)
    return report.where("kept").select(*[F.col("__row")[c].alias(c) for c in docs.columns])
