"""Text rules: models, vehicle and engine types, prices, keywords, years.

All rules read the whole text and stay inside Spark's own expressions.
"""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from labelmill.functions.let import let

# Type rules in order of preference.
CAR_TYPES = ["SUV", "Sedan"]
ENGINE_TYPES = ["Electric", "Hybrid"]

# Language code to language tag.
LANGUAGE_TAGS = {
    "ko": "ko-KR",
    "en": "en-US",
    "de": "de-DE",
    "fr": "fr-FR",
    "es": "es-ES",
}

# Words that say nothing about a text.
STOP_WORDS = sorted(
    "a an and are as at be by for from has have in is it its of on or that the"
    " this to was were will with 그 그리고 는 등 및 수 에 에서 을 의 이 있는 있다 하는 한".split()
)

# A number is tried from its beginning only: inside a run of digits and commas
# the rest of the pattern fails as it did from there.
_NUMBER = r"(?<![0-9])(?<![0-9],)[0-9][0-9,]*+(?:[.][0-9]++)?"
_WON = rf"({_NUMBER})\s*만\s*원"
_DOLLAR = r"[$]\s*([0-9][0-9,]*(?:[.][0-9]+)?)"
_EDGE_BEFORE = r"(?<![\p{L}\p{N}])"
_EDGE_AFTER = r"(?![\p{L}\p{N}])"


def _words(names: list[str]) -> str:
    """Any of the names as a whole word, the longest first."""
    longest_first = sorted((n.lower() for n in names), key=lambda n: (-len(n), n))
    escaped = "|".join(re.escape(n) for n in longest_first)
    return f"{_EDGE_BEFORE}({escaped}){_EDGE_AFTER}"


def model_name(text: Column, models: list[str]) -> Column:
    """The first of the given names to occur in the text, else ``UNKNOWN``.

    Case is ignored.
    """
    if not models:
        return F.lit("UNKNOWN")
    found = F.regexp_extract(F.lower(text), _words(models), 1)
    canonical = F.create_map(*[F.lit(x) for m in models for x in (m.lower(), m)])
    return F.coalesce(F.try_element_at(canonical, found), F.lit("UNKNOWN"))


def _says(text: Column, word: str, pattern: str | None = None) -> Column:
    """Whether a word occurs as a whole, case ignored.

    A plain search goes first: few texts hold the word, and only those are
    looked at with a pattern.
    """
    lowered, word = F.lower(text), word.lower()
    edged = rf"{_EDGE_BEFORE}(?:{pattern or re.escape(word)}){_EDGE_AFTER}"
    return F.contains(lowered, F.lit(word)) & lowered.rlike(edged)


def _first_kind(text: Column, kinds: list[str]) -> Column:
    result = F.lit("UNKNOWN")
    for kind in reversed(kinds):
        result = F.when(_says(text, kind), F.lit(kind)).otherwise(result)
    return result


def car_type(text: Column) -> Column:
    return _first_kind(text, CAR_TYPES)


def engine_type(text: Column) -> Column:
    return _first_kind(text, ENGINE_TYPES)


def xev_type(text: Column) -> Column:
    """Hybrid kind of a vehicle, null when the text names none."""
    plug_in = _says(text, "hybrid", "plug-?in[- ]hybrid")
    return F.when(plug_in, F.lit("Plugin-Hybrid")).when(_says(text, "hybrid"), F.lit("Hybrid"))


def _amounts(text: Column, sign: str, pattern: str, currency: str, factor: int) -> Column:
    """Amounts by the pattern, in texts that hold the sign. Decimal but for endless digits."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))

    def amount(written: Column) -> Column:
        number = F.regexp_replace(written, ",", "")
        exact = (number.try_cast("decimal(28,4)") * factor).cast("double")
        return F.coalesce(exact, number.cast("double") * factor)

    every = F.transform(
        found,
        lambda a: F.struct(F.lit(currency).alias("currency"), amount(a).alias("amount")),
    )
    return F.when(F.contains(text, F.lit(sign)), every).otherwise(
        F.array().cast("array<struct<currency:string,amount:double>>")
    )


def prices(text: Column) -> Column:
    """All won and dollar amounts of a text as ``(currency, amount)``.

    Won amounts are written in units of ten thousand.
    """
    return F.concat(
        _amounts(text, "만", _WON, "KRW", 10_000), _amounts(text, "$", _DOLLAR, "USD", 1)
    )


def price_text(text: Column) -> Column:
    """The first amount as written, null without one."""
    written = F.regexp_extract(
        text, rf"({_NUMBER}\s*만\s*원|[$]\s*[0-9][0-9,]*+(?:[.][0-9]++)?)", 1
    )
    priced = F.contains(text, F.lit("만")) | F.contains(text, F.lit("$"))
    return F.when(priced, F.nullif(written, F.lit("")))


def model_years(text: Column) -> Column:
    """Four-digit years of the 20th and 21st century that occur in a text."""
    return F.regexp_extract_all(
        text, F.lit(r"(?<![0-9])((?:19|20)[0-9]{2})(?![0-9])"), F.lit(1)
    )


def language_tag(code: Column) -> Column:
    pairs = [F.lit(x) for pair in LANGUAGE_TAGS.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), F.lit("UNKNOWN"))


def words(text: Column, stop_words: list[str] = STOP_WORDS) -> Column:
    """Lower-case words of two letters or more, stop words left out."""
    tokens = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.filter(
        tokens, lambda w: (F.length(w) >= 2) & ~w.isin(list(stop_words))
    )


def word_counts(text: Column, stop_words: list[str] = STOP_WORDS) -> Column:
    """Distinct words as ``(neg, word)``, counted inside the row.

    ``neg`` is the count below zero, so that sorting puts the most frequent
    word first and ties in word order. Sorted words stand side by side; a word's
    count is the distance from its first place to that of the next word.
    Nothing is exploded and nothing is shuffled.
    """

    def starts(s: Column) -> Column:
        new = lambda w, i: F.when((i == 0) | (w != F.get(s, i - 1)), i)
        return F.array_compact(F.transform(s, new))

    def counts(s: Column, b: Column) -> Column:
        return F.transform(
            b,
            lambda p, j: F.struct(
                (p - F.coalesce(F.get(b, j + 1), F.size(s))).cast("bigint").alias("neg"),
                F.get(s, p).alias("word"),
            ),
        )

    ordered = F.sort_array(words(text, stop_words))
    return let(ordered, lambda s: let(starts(s), lambda b: counts(s, b)))


def top_words(counts: Column, k: int = 10) -> Column:
    """The ``k`` most frequent words, ties in word order, best first."""
    return F.transform(
        F.slice(F.sort_array(counts), 1, k),
        lambda c, i: F.struct(
            (i + 1).cast("bigint").alias("rank"),
            c["word"].alias("word"),
            (-c["neg"]).alias("n"),
        ),
    )
