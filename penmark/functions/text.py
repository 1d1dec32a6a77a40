"""Text functions as column expressions.

Nothing here is a UDF, so every function stays in the JVM and behaves the same
on a batch frame and on a stream.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penmark.functions.lexicon import ARABIC, DIACRITICS, TATWEEL, LanguageProfile

FEATURE_COLUMNS = (
    "feature_10_avg_word_length",
    "feature_30_question_marks",
    "feature_50_prepositions",
    "feature_70_first_person",
    "feature_90_entity_diversity",
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    # Evaluates `value` once per row and hands it to `body` as a variable;
    # naming a computed array inside a lambda would recompute it per element.
    return F.get(F.transform(F.array(value), body), F.lit(0))


# -- cleaning ------------------------------------------------------------------


def strip_diacritics(text: Column) -> Column:
    return F.translate(text, DIACRITICS, "")


def drop_tatweel(text: Column) -> Column:
    return F.translate(text, TATWEEL, "")


def fold_letters(text: Column, profile: LanguageProfile = ARABIC) -> Column:
    return F.translate(text, profile.fold_from, profile.fold_to)


def keep_script(text: Column, profile: LanguageProfile = ARABIC) -> Column:
    """Each run of foreign characters, white space included, becomes one space."""
    return F.regexp_replace(text, f"[^{profile.kept_class}]+", " ")


def collapse_spaces(text: Column) -> Column:
    # Unicode white space, plus the four separators that class leaves out.
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)[\s\u001c-\u001f]+", " "))


def clean_text(text: Column, profile: LanguageProfile = ARABIC) -> Column:
    """All cleaning rules: one translate, one regex, one trim. Null gives ''."""
    folded = F.translate(
        F.coalesce(text, F.lit("")),
        profile.fold_from + profile.dropped,
        profile.fold_to,
    )
    return F.trim(keep_script(folded, profile))


def words(clean: Column) -> Column:
    """All words of a cleaned text, stop words kept."""
    return F.split(clean, " ")


def is_content_word(word: Column, profile: LanguageProfile = ARABIC) -> Column:
    long_enough = F.length(word) > 1
    return long_enough & ~word.isin(*profile.stop_words) if profile.stop_words else long_enough


def tokenize(clean: Column, profile: LanguageProfile = ARABIC) -> Column:
    return F.filter(words(clean), lambda w: is_content_word(w, profile))


# -- stylometric features --------------------------------------------------------


def average_word_length(tokens: Column) -> Column:
    size = F.size(tokens)
    return F.when(size > 0, F.length(F.array_join(tokens, "")) / size).otherwise(F.lit(0.0))


def question_marks(raw: Column, profile: LanguageProfile = ARABIC) -> Column:
    """Counted on the raw text: cleaning may drop the marks."""
    marks = "[" + re.escape(profile.question_marks) + "]"
    return F.coalesce(F.regexp_count(raw, F.lit(marks)), F.lit(0))


def count_listed(tokens: Column, listed: tuple[str, ...]) -> Column:
    if not listed:
        return F.lit(0)
    return F.coalesce(F.size(F.filter(tokens, lambda w: w.isin(*listed))), F.lit(0))


def entity_mentions(clean: Column, profile: LanguageProfile = ARABIC) -> Column:
    """Every marker word together with the word that follows it."""
    if not profile.entity_markers:
        return F.array().cast("array<string>")

    def pairs(ws: Column) -> Column:
        following = F.slice(ws, F.lit(2), F.size(ws))
        return F.filter(
            F.zip_with(
                ws,
                following,
                lambda a, b: F.when(a.isin(*profile.entity_markers) & b.isNotNull(), F.concat(a, F.lit(" "), b)),
            ),
            lambda pair: pair.isNotNull(),
        )

    return _let(words(clean), pairs)


def entity_diversity(clean: Column, profile: LanguageProfile = ARABIC) -> Column:
    return _let(
        entity_mentions(clean, profile),
        lambda found: F.when(
            F.size(found) > 0, F.size(F.array_distinct(found)) / F.size(found)
        ).otherwise(F.lit(0.0)),
    )


# -- arrays of tokens ---------------------------------------------------------------


def term_counts(tokens: Column) -> Column:
    """``array<struct<term, tf>>`` of one document, sorted by term.

    Counting inside the row needs no shuffle: the tokens are sorted and the
    ends of equal runs are subtracted from each other.
    """

    def run_ends(s: Column) -> Column:
        return F.filter(
            F.sequence(F.lit(1), F.size(s)),
            lambda i: (i == F.size(s)) | (F.get(s, i) != F.get(s, i - 1)),
        )

    def runs(s: Column) -> Column:
        return _let(
            run_ends(s),
            lambda ends: F.transform(
                ends,
                lambda end, j: F.struct(
                    F.get(s, end - 1).alias("term"),
                    (end - F.coalesce(F.get(ends, j - 1), F.lit(0))).cast("bigint").alias("tf"),
                ),
            ),
        )

    return F.when(F.size(tokens) > 0, _let(F.sort_array(tokens), runs)).otherwise(
        F.array().cast("array<struct<term:string,tf:bigint>>")
    )


def bigrams(tokens: Column) -> Column:
    """Neighbouring tokens joined by a space, as an array."""
    left = F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0)))
    return F.zip_with(left, F.slice(tokens, F.lit(2), F.size(tokens)), lambda a, b: F.concat(a, F.lit(" "), b))


# -- frames ------------------------------------------------------------------------


def prepare(df: DataFrame, profile: LanguageProfile = ARABIC, text: str = "text") -> DataFrame:
    """Add ``clean_text`` and ``tokens``."""
    return df.withColumn("clean_text", clean_text(F.col(text), profile)).withColumn(
        "tokens", tokenize(F.col("clean_text"), profile)
    )


def add_style_features(df: DataFrame, profile: LanguageProfile = ARABIC, text: str = "text") -> DataFrame:
    """Add the five stylometric columns to a prepared frame."""
    tokens, clean = F.col("tokens"), F.col("clean_text")
    return df.withColumns(
        dict(
            zip(
                FEATURE_COLUMNS,
                (
                    average_word_length(tokens),
                    question_marks(F.col(text), profile),
                    count_listed(tokens, profile.prepositions),
                    count_listed(tokens, profile.first_person),
                    entity_diversity(clean, profile),
                ),
            )
        )
    )
