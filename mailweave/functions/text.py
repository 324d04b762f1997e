"""Text, header and query-text expressions. All of them are native Spark SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes and patterns that define the results.
WHITESPACE = r"\s\x0B\x1C-\x1F\x85\p{Z}"
WORD = r"\p{L}\p{N}_"
ANGLE_ADDRESS = r"(?d)<(.*?)>"
BARE_ADDRESS = rf"[{WORD}.-]+@[{WORD}.-]+"
BODY_HEADER = r"(?d)\A.*?From"
BODY_BANNER = r"(?d)UNCLASSIFIED.*?STATE.*\n"
PUNCTUATION = rf"[^{WORD}{WHITESPACE}]"
REPLY_PREFIX = r"(?i)^(re|fwd):"
TRAILING_CAPITALS = rf"(?d)(?<![{WORD}])[A-Z]{{1,3}}$"
OM_WORD = rf"(?<![{WORD}])OM(?![{WORD}])"
TOKEN = r"[\p{L}\p{N}_]+(?:['’.][\p{L}\p{N}_]+)*"
QUERY_TASK = "Given an email search query, retrieve the most relevant emails"
DATE_FORMATS = (
    "MMMM d, yyyy h:mm a",
    "MMMM d, yyyy H:mm",
    "MMMM d, yyyy",
    "MMM d, yyyy h:mm a",
    "MMM d, yyyy",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
    "M/d/yyyy h:mm a",
    "M/d/yyyy",
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a bound variable.

    Inside a lambda an inlined expression would be evaluated for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(col: Column) -> Column:
    """Trim Unicode whitespace at both ends."""
    return F.regexp_replace(col, rf"\A[{WHITESPACE}]+|[{WHITESPACE}]+\z", "")


def extract_alias(col: Column) -> Column:
    """Sender alias: the text in the first ``<..>``, else a bare address, else all of it."""
    text = strip(F.lower(F.coalesce(col, F.lit(""))))
    return (
        F.when(text.rlike(ANGLE_ADDRESS), strip(F.regexp_extract(text, ANGLE_ADDRESS, 1)))
        .when(text.rlike(BARE_ADDRESS), F.regexp_extract(text, BARE_ADDRESS, 0))
        .otherwise(text)
    )


def _words_only(col: Column) -> Column:
    spaced = F.regexp_replace(F.lower(col), PUNCTUATION, " ")
    return F.trim(F.regexp_replace(spaced, rf"[{WHITESPACE}]+", " "))


def clean_body(col: Column) -> Column:
    """Body text without header prefix and banner lines, lower case, words only."""
    text = F.regexp_replace(F.coalesce(col, F.lit("")), BODY_HEADER, "")
    return _words_only(F.regexp_replace(text, BODY_BANNER, ""))


def clean_subject(col: Column, strip_reply: bool = False) -> Column:
    """Subject in lower case, words only.

    By default ``re:`` survives as the word ``re``; ``strip_reply`` removes the prefix.
    """
    text = F.coalesce(col, F.lit(""))
    if strip_reply:
        text = F.regexp_replace(strip(text), REPLY_PREFIX, "")
    return _words_only(text)


def repair_date_text(col: Column) -> Column:
    """Drop a trailing word of one to three capitals, then read ``OM`` as ``AM``."""
    return F.regexp_replace(F.regexp_replace(col, TRAILING_CAPITALS, ""), OM_WORD, "AM")


def parse_date(col: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """First format that fits, with a leading day name ignored; null when none fits."""
    text = strip(F.regexp_replace(col, r"\A\s*\p{L}+,\s*", ""))
    tried = [F.try_to_timestamp(text, F.lit(f)) for f in formats]
    return F.coalesce(*tried).cast("timestamp_ntz")


def iso_date(col: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """Date text in ISO form, null when it cannot be read."""
    return F.date_format(parse_date(col, formats), "yyyy-MM-dd'T'HH:mm:ss")


def is_owner(col: Column, pattern: str) -> Column:
    """Case-blind pattern test that is false for null."""
    return F.coalesce(col.rlike(f"(?i){pattern}"), F.lit(False))


def compose_text(subject: Column, body: Column) -> Column:
    """Text to embed: subject, line break, body."""
    empty = F.lit("")
    return F.concat(F.coalesce(subject, empty), F.lit("\n"), F.coalesce(body, empty))


def query_prompt(col: Column, task: str = QUERY_TASK) -> Column:
    """Instruction prompt of a query for an instruction-tuned encoder."""
    return F.format_string("Instruct: %s\nQuery: %s", F.lit(task), col)


def query_len(col: Column) -> Column:
    """Number of whitespace-separated words of the raw query."""
    text = strip(F.coalesce(col, F.lit("")))
    return F.when(text == "", 0).otherwise(F.size(F.split(text, rf"[{WHITESPACE}]+")))


def tokens(col: Column) -> Column:
    """Lower-case word tokens in text order."""
    return F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))), F.lit(TOKEN), F.lit(0))


def _run_starts(ordered: Column) -> Column:
    """Positions at which a new value begins in an ordered, non-empty array."""
    return F.filter(
        F.sequence(F.lit(0), F.size(ordered) - 1),
        lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
    )


def _run_length(starts: Column, ordered: Column, j: Column) -> Column:
    return F.coalesce(F.get(starts, j + 1), F.size(ordered)) - F.get(starts, j)


def term_counts(col: Column) -> Column:
    """``array<struct<term, tf, len, head>>`` of one text, ``head`` true for exactly one entry.

    ``len`` is the token count of the whole text. Counting inside the row needs no shuffle: the tokens are sorted and equal
    neighbours counted. ``head`` lets one pass over the postings count the texts.
    """

    def entries(ordered: Column) -> Column:
        return let(
            _run_starts(ordered),
            lambda starts: F.transform(
                starts,
                lambda p, j: F.struct(
                    F.get(ordered, p).alias("term"),
                    _run_length(starts, ordered, j).alias("tf"),
                    F.size(ordered).alias("len"),
                    (j == 0).alias("head"),
                ),
            ),
        )

    none = F.array().cast("array<struct<term:string,tf:int,len:int,head:boolean>>")
    return let(
        F.sort_array(tokens(col)),
        lambda ordered: F.when(F.size(ordered) == 0, none).otherwise(entries(ordered)),
    )


def bucket_counts(col: Column, dim: int) -> Column:
    """Token counts per hash bucket as a dense ``array<int>`` of length ``dim``.

    Every bucket is added once before sorting, so run ``j`` is bucket ``j``.
    """
    bucket = lambda t: F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("bigint") % dim
    return let(
        F.sort_array(
            F.concat(
                F.sequence(F.lit(0).cast("bigint"), F.lit(dim - 1).cast("bigint")),
                F.transform(tokens(col), bucket),
            )
        ),
        lambda ordered: let(
            _run_starts(ordered),
            lambda starts: F.transform(
                starts, lambda _, j: _run_length(starts, ordered, j) - 1
            ),
        ),
    )
