"""Text measures as built-in column expressions.

Words are runs of non-blank characters and blanks are the characters that
Python's `str.split` treats as such, so the counts agree with Python's.
Counting regex matches replaces splitting wherever only a number is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lexloom.functions.columns import let, no_strings, ratio

# Patterns that define the measures.
# Python counts four separator controls as blanks, Unicode's white space does not.
SEPARATORS = "\x1c\x1d\x1e\x1f"
BLANK_RUN = r"(?U)\s+"
WORD = r"(?U)\S+"
SENTENCE_END = r"[.!?]+"
TOKEN = r"[a-z]+(?:'[a-z]+)?"
SILENT_ENDING = r"(?:es|ed|e)"
PUNCTUATION = r"""[.,;:!?\-()\[\]{}"'/]"""
LETTER = r"\p{L}"
UPPER = r"\p{IsUppercase}"
# Superscript, subscript and enclosed digits, which str.isdigit accepts beside decimal ones.
OTHER_DIGIT = (
    r"\u00b2\u00b3\u00b9\u1369-\u1371\u19da\u2070\u2074-\u2079\u2080-\u2089"
    r"\u2460-\u2468\u2474-\u247c\u2488-\u2490\u24ea\u24f5-\u24fd\u24ff\u2776-\u277e"
    r"\u2780-\u2788\u278a-\u2792\x{10a40}-\x{10a43}\x{10e60}-\x{10e68}\x{11052}-\x{1105a}"
    r"\x{1f100}-\x{1f10a}"
)
# Weights of the two readability grades.
FK_WORDS, FK_SYLLABLES, FK_BASE = 0.39, 11.8, 15.59
CL_LETTERS, CL_SENTENCES, CL_BASE = 0.0588, 0.296, 15.8

# From one vowel run of a word to the next: a vowel (not that of a three-letter word),
# consonants, and a vowel ahead that does not belong to a silent ending.
NEXT_SYLLABLE = (
    r"(?U)[aeiouy](?<!(?<!\S)[aeiouy](?=\S\S(?!\S)))"
    r"[^\saeiouy]++"
    rf"(?!{SILENT_ENDING}(?!\S))(?=[aeiouy])"
)


def spaced(text: Column) -> Column:
    """The text with separator controls turned into spaces.

    White space and its complement are then the regex engine's own classes, which
    it matches many times faster than a negated list of ranges.
    """
    replaced = F.translate(text, SEPARATORS, " " * len(SEPARATORS))
    return F.when(text.rlike(f"[{SEPARATORS}]"), replaced).otherwise(text)


def trim_blanks(text: Column) -> Column:
    """Remove every kind of blank at both ends (`trim` removes only spaces)."""
    blank = rf"(?U)[\s{SEPARATORS}]"
    return F.regexp_replace(text, rf"\A{blank}+|{blank}+\z", "")


def is_blank(text: Column) -> Column:
    return ~spaced(text).rlike(WORD)


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(spaced(text), F.lit(WORD)), F.lit(0))


def count_sentences(text: Column) -> Column:
    """Runs of end marks, at least 1."""
    return F.greatest(F.regexp_count(text, F.lit(SENTENCE_END)), F.lit(1))


def count_syllables(text: Column, n_words: Column) -> Column:
    """Syllables of all words of a text.

    Per word: 1 for up to three characters, otherwise the vowel runs left after
    the silent ending is cut off, at least 1. That is one per word plus one for
    every step from a vowel run to the next, which one pass of a regex counts.
    """
    return n_words + F.coalesce(F.regexp_count(spaced(F.lower(text)), F.lit(NEXT_SYLLABLE)), F.lit(0))


def length_without(text: Column, dropped: str) -> Column:
    return F.char_length(F.regexp_replace(text, dropped, ""))


def count_digits(text: Column) -> Column:
    """Decimal digits and the few other kinds; only texts with a numeric mark are searched for those."""
    decimal = F.char_length(text) - length_without(text, r"\p{Nd}+")
    other = F.char_length(text) - length_without(text, f"[{OTHER_DIGIT}]+")
    return decimal + F.when(text.rlike(r"\p{No}"), other).otherwise(0)


def flesch_kincaid(words: Column, sentences: Column, syllables: Column) -> Column:
    grade = FK_WORDS * (words / sentences) + FK_SYLLABLES * (syllables / words) - FK_BASE
    return F.when(words > 0, grade).otherwise(F.lit(0.0))


def coleman_liau(letters: Column, words: Column, sentences: Column) -> Column:
    grade = CL_LETTERS * (letters / words * 100) - CL_SENTENCES * (sentences / words * 100) - CL_BASE
    return F.when(words > 0, grade).otherwise(F.lit(0.0))


def tokens(text: Column) -> Column:
    """Lower-case alphabetic words with an optional apostrophe part."""
    found = F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))
    return F.coalesce(found, no_strings())


def alnum_words(text: Column) -> Column:
    """Lower-case runs of [a-z0-9], everything else separates."""
    found = F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))
    return F.coalesce(found, no_strings())


def label_words(label: Column, rule: str) -> Column:
    """Words of a label: 'clean' separates at all but [a-z0-9], 'split' only at _, - and blanks."""
    if rule == "clean":
        return alnum_words(label)
    if rule == "split":
        return F.regexp_extract_all(spaced(F.translate(F.lower(label), "_-", "  ")), F.lit(WORD), F.lit(0))
    raise ValueError(f"unknown overlap rule {rule!r}")


def overlap_scores(text: Column, labels: Column, rule: str = "clean") -> Column:
    """array<double>: for each label the share of its words found in the text.

    The text's words are hashed once per row against the labels' words; each
    label then looks only at the few words that were found.
    """

    def score(words: Column, found: Column) -> Column:
        hits = F.size(F.filter(words, lambda w: F.array_contains(found, w)))
        return ratio(hits, F.size(words))

    per_label = F.transform(labels, lambda label: label_words(label, rule))
    return let(
        per_label,
        lambda words: let(
            F.array_intersect(F.flatten(words), alnum_words(text)),
            lambda found: F.transform(words, lambda w: score(w, found)),
        ),
    )


def mean_of(values: Column) -> Column:
    """Mean of an array<double>, 0 when empty."""
    return let(
        values,
        lambda v: ratio(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x), F.size(v)),
    )
