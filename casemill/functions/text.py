"""Text expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from casemill.functions.arrays import let

# The tokens that mean "no value" in a CSV field.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Default English stop words, those of Spark's StopWordsRemover with contractions as the pieces that the
# tokens have, and a few more (pass another list for another language).
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
    hers herself it its itself they them their theirs themselves what which who whom this that these
    those am is are was were be been being have has had having do does did doing a an the and but if or
    because as until while of at by for with about against between into through during before after
    above below to from up down in out on off over under again further then once here there when where
    why how all any both each few more most other some such no nor not only own same so than too very
    can will just should now would could may might must shall also ever however cannot us upon ought let
    don ll ve re isn aren wasn weren haven hasn hadn doesn didn won wouldn shan shouldn mustn couldn
    """.split()
)

# White space in the Unicode sense plus the four separators, as characters and as a class.
WHITE_SPACE = "".join(
    map(chr, (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F,
              0x3000))
)
_SPACE = r"\s\x1c-\x1f"
_NOT_WORD_BEFORE = r"(?<![\p{L}\p{N}_])"
_NOT_WORD_AFTER = r"(?![\p{L}\p{N}_])"


def strip(c: Column) -> Column:
    """Remove white space of any kind at both ends (plain ``trim`` would remove blanks only)."""
    return F.trim(c, F.lit(WHITE_SPACE))


def null_tokens(c: Column, tokens: Sequence[str] = NA_TOKENS) -> Column:
    return F.when(~c.isin(list(tokens)), c)


def char_count(c: Column) -> Column:
    return F.coalesce(F.length(c), F.lit(0))


def word_count(c: Column) -> Column:
    """Number of white-space separated words; null and blank text count 0."""
    return F.coalesce(F.regexp_count(c, F.lit(rf"(?U)[^{_SPACE}]+")), F.lit(0))


def clean_text(c: Column) -> Column:
    """Lower-case letters a-z only, redaction words (``xx``, ``xxxx``) out, one blank between words."""
    def cleaned(t: Column) -> Column:
        no_redaction = F.regexp_replace(t, rf"{_NOT_WORD_BEFORE}xx+{_NOT_WORD_AFTER}", " ")
        return F.trim(F.regexp_replace(F.when(t.contains("xx"), no_redaction).otherwise(t), "[^a-z]+", " "))

    return let(F.lower(c), cleaned)


def ascii_words(c: Column, min_length: int = 3) -> Column:
    """Whole words made of ASCII letters only, lower-cased; accented words do not break into pieces."""
    pattern = rf"{_NOT_WORD_BEFORE}[a-z]{{{min_length},}}{_NOT_WORD_AFTER}"
    return F.regexp_extract_all(F.lower(c), F.lit(pattern), F.lit(0))


def tokens(clean: Column, min_length: int = 2) -> Column:
    """Words of cleaned text (letters, one blank between words) with at least ``min_length`` letters."""
    return F.filter(F.split(clean, " "), lambda w: F.length(w) >= min_length)


def drop_stop_words(words: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    return F.filter(words, lambda w: ~w.isin(list(stop_words)))


def ngrams(words: Column, n: int) -> Column:
    if n == 1:
        return words
    return let(words, lambda w: _ngrams(w, n))


def _ngrams(words: Column, n: int) -> Column:
    first = F.slice(words, F.lit(1), F.greatest(F.size(words) - F.lit(n - 1), F.lit(0)))
    rest = lambda i: [part for j in range(1, n) for part in (F.lit(" "), F.get(words, i + F.lit(j)))]
    return F.coalesce(F.transform(first, lambda w, i: F.concat(w, *rest(i))), F.array().cast("array<string>"))


def ngrams_up_to(words: Column, n: int) -> Column:
    if n == 1:
        return words
    return let(words, lambda w: F.concat(w, *[_ngrams(w, i) for i in range(2, n + 1)]))


def two_decimals(c: Column) -> Column:
    return F.regexp_replace(F.format_number(c, 2), ",", "")


def shared_words(a: Column, b: Column) -> tuple[Column, Column]:
    """Sorted shared words of two labels and their Jaccard ratio."""
    def words(c: Column) -> Column:
        return F.filter(F.array_distinct(F.split(F.lower(c), r"\s+")), lambda w: w != "")

    shared = F.array_sort(F.array_intersect(words(a), words(b)))
    return shared, F.size(shared) / F.greatest(F.size(F.array_union(words(a), words(b))), F.lit(1))
