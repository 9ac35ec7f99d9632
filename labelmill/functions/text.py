"""Whitespace, truncation, code fences and summaries."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from labelmill.functions.let import let
from labelmill.schema import REQUEST_TEXT_CHARS, SUMMARY_CHARS

# The characters that count as white space in a text, Unicode
# blanks and the four ASCII separators included.
WHITESPACE = "".join(
    map(
        chr,
        [
            *range(0x09, 0x0E),
            *range(0x1C, 0x21),
            0x85,
            0xA0,
            0x1680,
            *range(0x2000, 0x200B),
            0x2028,
            0x2029,
            0x202F,
            0x205F,
            0x3000,
        ],
    )
)
# A paragraph worth quoting, and what is quoted where there is none.
SUMMARY_MINIMUM = 50
SUMMARY_FALLBACK = 200

# The wording of a labelling request.
REQUEST_OPENING = "다음 문서를 분석하여 메타데이터를 추출해주세요."
REQUEST_FORMAT = "파일 형식: "
REQUEST_CONTENT = "문서 내용:"
REQUEST_CLOSING = "위 문서를 분석하여 JSON 형식으로 메타데이터를 반환해주세요."


def strip(text: Column) -> Column:
    """Remove white space at both ends, Unicode blanks included.

    Trimming a character set is linear; a ``\\s+$`` pattern rescans every
    inner run of blanks.
    """
    return F.btrim(text, F.lit(WHITESPACE))


def clean_text(text: Column) -> Column:
    """Each run of white space becomes one blank; none is left at the ends.

    Every kind of white space is first made a plain blank, which leaves the
    pattern nothing but runs of blanks to look for.
    """
    kinds = WHITESPACE.replace(" ", "")
    blanks = F.translate(text, kinds, " " * len(kinds))
    return F.btrim(F.regexp_replace(blanks, " {2,}", " "), F.lit(" "))


def request_text(text: Column) -> Column:
    """The leading characters that are sent for labelling."""
    return F.substring(text, 1, REQUEST_TEXT_CHARS)


def label_request(file_format: Column, text: Column) -> Column:
    """The request sent to a labelling service for one document."""
    return F.concat(
        F.lit(f"{REQUEST_OPENING}\n\n{REQUEST_FORMAT}"),
        file_format,
        F.lit(f"\n\n{REQUEST_CONTENT}\n"),
        request_text(text),
        F.lit(f"\n\n{REQUEST_CLOSING}"),
    )


def _drop_opening(text: Column, fence: str) -> Column:
    rest = F.substring(text, len(fence) + 1, 2**31 - 1)
    return F.when(F.startswith(text, F.lit(fence)), rest).otherwise(text)


def _drop_closing(text: Column, fence: str) -> Column:
    rest = F.substring(text, F.lit(1), F.length(text) - len(fence))
    return F.when(F.endswith(text, F.lit(fence)), rest).otherwise(text)


def strip_fences(answer: Column) -> Column:
    """Take an answer out of its Markdown code fence.

    A language-tagged fence goes first, then a plain one, so a doubled opening
    is removed as well; the closing fence goes last.
    """
    untagged = let(strip(answer), lambda a: _drop_opening(a, "```json"))
    opened = let(untagged, lambda a: _drop_opening(a, "```"))
    return strip(let(opened, lambda a: _drop_closing(a, "```")))


def summary_paragraph(text: Column) -> Column:
    """First paragraph that is long enough, cut to the limit.

    A paragraph is a line, white space at its ends ignored. Texts without such
    a line yield their first characters.
    """
    opening = F.substring(strip(text), 1, SUMMARY_FALLBACK)
    return F.substring(F.coalesce(long_paragraph(text), opening), 1, SUMMARY_CHARS)


def long_paragraph(text: Column) -> Column:
    """The first paragraph that is long enough, cut to the limit; null without one."""
    lines = F.transform(F.split(text, r"[\r\n]+"), strip)
    long_enough = F.filter(lines, lambda line: F.length(line) >= SUMMARY_MINIMUM)
    return F.substring(F.get(long_enough, F.lit(0)), 1, SUMMARY_CHARS)
