"""Quality rules: a threshold table compiled into one projection of native expressions."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CLOSING = ".,;:!?"
WINDOW = 8

# Frequent words of the four languages.
LANGUAGES = ("en", "de", "fr", "es")
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "with", "that", "for", "on", "as", "was", "it", "this", "are", "by", "from",
    "der", "die", "das", "und", "zu", "den", "von", "mit", "ist", "ein", "eine", "auf", "sich", "des", "dem", "für", "im",
    "le", "la", "les", "de", "et", "un", "une", "du", "en", "est", "que", "pour", "dans", "qui", "sur", "pas", "au",
    "el", "los", "las", "y", "se", "del", "por", "con", "una", "su", "es", "lo", "no", "al",
)


@dataclass(frozen=True)
class Rule:
    """Documents fail where measure lies outside [least, most] percent of base."""

    name: str
    measure: str
    base: str
    least: int | None = None
    most: int | None = None
    #: Documents in other languages pass; those without a language do not.
    languages: tuple[str, ...] | None = None

    def failed(self, of) -> Column:
        measure, base = 100 * of(self.measure), of(self.base)
        low = F.lit(False) if self.least is None else measure < self.least * base
        high = F.lit(False) if self.most is None else measure > self.most * base
        return low | high


#: Every document has to pass these.
BASE = (
    Rule("too_short", "n_words", "one", least=2000),
    Rule("repeated_words", "n_repeat_words", "n_words", most=30),
)
#: The method's own table.
RULES = (
    Rule("word_length", "word_chars", "n_words", least=200, most=1500),
    Rule("symbols", "n_symbols", "n_words", most=10),
    Rule("shouting", "n_marks", "n_words", most=50),
    Rule("stop_words", "n_stop_words", "n_words", least=4, languages=LANGUAGES),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=40),
)


def _drop(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _words(text: Column) -> Column:
    """Split at single spaces after all white space has become spaces."""
    return F.array_remove(F.split(F.translate(text, SPACE, " " * len(SPACE)), " "), "")


def _covered(window_hashes: Column) -> Column:
    """Words in windows that are found twice or more: equal hashes are neighbours after a sort, and each place counts as
    many words as it adds to the ones before."""
    keyed = F.sort_array(F.transform(window_hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = lambda a, b: F.coalesce(F.get(a, b)["h"] == F.get(a, b + 1)["h"], F.lit(False))
    # keyed occurs in the lambda below as one column, so that it is sorted once.
    held = F.transform(F.array(keyed), lambda k: F.transform(k, lambda x, j: F.when(same(k, j - 1) | same(k, j), x["i"])))
    places = F.transform(held, lambda x: F.sort_array(F.array_compact(x)))
    total = F.transform(
        places,
        lambda p: F.aggregate(
            F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW)))),
            F.lit(0).cast("long"),
            lambda total, x: total + x,
        ),
    )
    return total[0]


def _paired(hashes: Column, half: int) -> Column:
    """Hashes of each hash with the one that is half places after it. The array is one column in the lambda."""

    def pairs(h: Column) -> Column:
        n = F.greatest(F.size(h) - half, F.lit(0))
        return F.zip_with(F.slice(h, F.lit(1), n), F.slice(h, F.lit(half + 1), n), lambda a, b: F.xxhash64(a, b))

    return F.transform(F.array(hashes), lambda h: pairs(h))[0]


def measured(documents: DataFrame, keep: str = "__row") -> DataFrame:
    """All columns of the documents in one struct column, beside the measures.

    Words are runs of other characters than ASCII white space. Two windows count as equal where a 64-bit hash built from
    their words is; null texts count as empty ones. No shuffle, no Python: rows stay where they are.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = F.lower(text)
    first = documents.select(
        F.struct("*").alias(keep),
        text.alias("text"),
        _words(text).alias("words"),
        F.split(text, "\n").alias("lines"),
        _words(_drop(plain, CLOSING)).alias("plain_words"),
    )
    # Hashes of runs of 1, 2, 4 and 8 words, each from two of the half as long ones before.
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    for half in (1, 2, 4):
        hashes = _paired(hashes, half)
    second = first.select(
        keep,
        "text",
        "lines",
        F.size("words").cast("long").alias("n_words"),
        F.size(F.filter("plain_words", lambda w: w.isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        hashes.alias("windows"),
    )
    length = lambda c: F.length(c).cast("long")
    third = second.select(
        keep,
        "n_words",
        "n_stop_words",
        length(_drop(F.col("text"), SPACE)).alias("word_chars"),
        (length("text") - length(_drop(F.col("text"), SYMBOLS))).alias("n_symbols"),
        (length("text") - length(_drop(F.col("text"), "!?"))).alias("n_marks"),
        F.filter("lines", lambda line: F.length(_drop(line, SPACE)) > 0).alias("lines"),
        F.when(F.size(F.array_distinct("windows")) < F.size("windows"), _covered(F.col("windows")))
        .otherwise(F.lit(0).cast("long"))
        .alias("n_repeat_words"),
    )
    counts = "n_words", "word_chars", "n_symbols", "n_marks", "n_stop_words", "n_repeat_words"
    return third.select(
        keep,
        *counts,
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )


def judged(documents: DataFrame, keep: str = "__row", base=BASE, rules=RULES, language: str | None = None) -> DataFrame:
    """The measures with base_failed, kept, and the names of the rules that failed.

    language names a column that says which documents the rules of some languages are for ("en", "en-GB"); without one they
    are for all.
    """
    lang = F.coalesce(F.lower(F.split(F.col(keep)[language].cast("string"), "[-_]")[0]), F.lit("")) if language else None
    spoken = lambda rule: F.lit(True) if lang is None or rule.languages is None else lang.isin("", *rule.languages)
    of = lambda name: F.lit(1) if name == "one" else F.col(name)
    failed = [F.when(rule.failed(of) & spoken(rule), F.lit(rule.name)) for rule in (*base, *rules)]
    rows = measured(documents, keep).withColumn("failed", F.array_compact(F.array(*failed)))
    names = F.array(*(F.lit(rule.name) for rule in base))
    return rows.withColumn("base_failed", F.arrays_overlap("failed", names)).withColumn("kept", F.size("failed") == 0)


def kept(documents: DataFrame, language: str | None = None) -> DataFrame:
    """The documents that pass every rule, with all their columns.

    A plain filter on the verdict would be pushed below the projections, each measure written out again for every use. An
    array of one row keeps verdict and row together until the verdict is there.
    """
    rows = judged(documents, language=language).select(F.explode(F.array(F.struct("kept", "__row"))).alias("one"))
    return rows.where("one.kept").select("one.__row.*")
