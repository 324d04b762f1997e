"""Date mentions in text, read by a small grammar.

Words and signs are classified (year, number, ordinal, month, unit, ...) and folded through a state
machine with ``aggregate``: a mention starts at the first word from which it can be read and goes
on as far as it can. All of it is column expressions.

Forms: ``2012-03-03``, ``3/14/2012`` (month first), ``March 3, 2012``, ``3 March 2012``, ``the 3rd of
March 2012``, ``March 2012``, ``2012``, ``March 3``, ``3 March``, ``March`` (a full name with a
capital; not ``May``, which is a verb more often), ``last March``, ``last week/month/year``,
``yesterday``, ``today``. A mention without a day starts at the first, a bare year at January 1;
without a year it is that of ``as_of``; ``last March`` is the latest March before its month.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailweave.functions.text import WORD, let

# Names of months, and what a word can be.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
MONTH = (
    "jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?"
    "|sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
)
FULL_MONTH = "January|February|March|April|June|July|August|September|October|November|December"
PIECE = rf"[{WORD}]+|\S"
KINDS = ["other", "year", "digits", "number", "ordinal", "month", "Month", "-", "/", ",", ".", "of", "last", "week", "months", "years", "yesterday", "today"]
WORDS = {"of": "of", "last": "last", "week": "week", "month": "months", "year": "years", "yesterday": "yesterday", "today": "today"}
SIGNS = "-/,."

# What may follow what. A state is named by the parts read so far.
STEPS = {
    "": {"year": "Y", "digits": "Y?", "month": "M?", "Month": "M", "number": "D", "ordinal": "D", "last": "L", "yesterday": "yesterday", "today": "today"},
    "Y": {"-": "Y-"}, "Y?": {"-": "Y-"}, "Y-": {"number": "Y-M"}, "Y-M": {"-": "Y-M-"}, "Y-M-": {"number": "Y-M-D"},
    "D": {"/": "D/", "of": "D of", "month": "DM", "Month": "DM"}, "D/": {"number": "D/M"}, "D/M": {"/": "D/M/"},
    "D/M/": {"year": "M/D/Y", "digits": "M/D/Y"}, "D of": {"month": "DM", "Month": "DM"},
    "DM": {".": "DM,", ",": "DM,", "year": "DMY", "digits": "DMY"}, "DM,": {"year": "DMY", "digits": "DMY"},
    "MD": {",": "MD,", "year": "DMY", "digits": "DMY"}, "MD,": {"year": "DMY", "digits": "DMY"},
    "M,": {"year": "MY", "digits": "MY"},
    "L": {"month": "last M", "Month": "last M", "week": "last week", "months": "last month", "years": "last year"},
}
for _month in ("M", "M?", "M."):
    STEPS[_month] = {"number": "MD", "ordinal": "MD", "year": "MY", "digits": "MY", ",": "M,"} | ({".": "M."} if _month != "M." else {})
COMPLETE = ["Y", "Y-M-D", "M/D/Y", "DM", "DMY", "MD", "MY", "M", "last M", "last week", "last month", "last year", "yesterday", "today"]
STATES = ["", *sorted({s for follow in STEPS.values() for s in follow.values()})]
PUTS = {s: "y" for s in ("Y", "Y?", "M/D/Y", "DMY", "MY")} | {s: "m" for s in ("Y-M", "D/M", "M", "M?", "DM", "last M")} | {s: "d" for s in ("Y-M-D", "D", "MD")}


def _table(values: list[int]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _kind(piece: Column) -> Column:
    low = F.lower(piece)
    kind = lambda name: F.lit(KINDS.index(name))
    found = (
        F.when(piece.rlike(r"^(?:19|20)\d{2}$"), kind("year"))
        .when(piece.rlike(r"^\d{4}$"), kind("digits"))
        .when(piece.rlike(r"^\d{1,2}$"), kind("number"))
        .when(low.rlike(r"^\d{1,2}(?:st|nd|rd|th)$"), kind("ordinal"))
        .when(piece.rlike(rf"^(?:{FULL_MONTH})$"), kind("Month"))
        .when(low.rlike(rf"^(?:{MONTH})$"), kind("month"))
    )
    for word, name in WORDS.items():
        found = found.when(low == word, kind(name))
    for sign in SIGNS:
        found = found.when(piece == sign, kind(sign))
    return found.otherwise(kind("other"))


def _value(piece: Column) -> Column:
    """The number of a piece: its digits, or the place of a month's name."""
    digits = F.regexp_extract(piece, r"^\d{1,4}", 0)
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.substring(piece, 1, 3)))
    return F.when(digits != "", digits.cast("int")).otherwise(month.cast("int"))


def date_mention(text: Column) -> Column:
    """``struct<form, d, m, y>`` of the first mention: the place of its form in ``COMPLETE``, or -1."""
    steps = _table([STATES.index(STEPS.get(s, {}).get(k, "")) for s in STATES for k in KINDS])
    puts = _table(["-dmy".index(PUTS.get(s, "-")) for s in STATES])
    complete = _table([COMPLETE.index(s) if s in COMPLETE else -1 for s in STATES])
    zero, parts = F.lit(0), ("d", "m", "y")
    pieces = F.transform(
        F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PIECE), F.lit(0)),
        lambda p: F.struct(_kind(p).alias("k"), _value(p).alias("v")),
    )
    start = F.struct(
        zero.alias("s"), *[zero.alias(p) for p in parts], F.lit(-1).alias("form"), *[zero.alias(f"f{p}") for p in parts], F.lit(False).alias("over")
    )

    def read(known: Column, piece: Column) -> Column:
        onward = F.get(steps, known["s"] * len(KINDS) + piece["k"])
        return let(
            F.struct(onward.alias("onward"), (onward == 0).alias("stuck")),
            lambda x: F.when(known["over"], known).otherwise(
                F.when(
                    x["stuck"] & (known["form"] >= 0),
                    F.struct(*[known[f].alias(f) for f in ("s", *parts, "form", "fd", "fm", "fy")], F.lit(True).alias("over")),
                ).otherwise(let(F.when(x["stuck"], F.get(steps, piece["k"])).otherwise(x["onward"]), lambda s: step(known, piece, x["stuck"], s)))
            ),
        )

    def step(known: Column, piece: Column, stuck: Column, state: Column) -> Column:
        put = F.get(puts, state)
        now = {
            p: F.when(put == i + 1, piece["v"]).otherwise(F.when(stuck, zero).otherwise(known[p])) for i, p in enumerate(parts)
        }
        whole = F.get(complete, state)
        kept = {p: F.when(whole >= 0, now[p]).otherwise(known[f"f{p}"]) for p in parts}
        return F.struct(
            state.alias("s"), *[now[p].alias(p) for p in parts], F.when(whole >= 0, whole).otherwise(known["form"]).alias("form"),
            *[kept[p].alias(f"f{p}") for p in parts], F.lit(False).alias("over"),
        )

    return F.aggregate(
        pieces, start, read, lambda x: F.struct(x["form"].alias("form"), x["fd"].alias("d"), x["fm"].alias("m"), x["fy"].alias("y"))
    )


def mention_start(mention: Column, as_of: Column) -> Column:
    """The first day of a ``date_mention``; null without one, or if there is no such day."""
    form, day, month, year = (mention[p] for p in ("form", "d", "m", "y"))
    this, one = F.year(as_of), F.lit(1)
    last = this - F.when(month < F.month(as_of), 0).otherwise(1)
    parts = {
        "Y": (year, one, one), "Y-M-D": (year, month, day), "M/D/Y": (year, day, month), "DMY": (year, month, day), "MY": (year, month, one),
        "M": (this, month, one), "MD": (this, month, day), "DM": (this, month, day), "last M": (last, month, one),
    }
    text = None
    for name, numbers in parts.items():
        is_it, written = form == COMPLETE.index(name), F.concat_ws("-", *[n.cast("string") for n in numbers])
        text = F.when(is_it, written) if text is None else text.when(is_it, written)
    back = {
        "last week": F.date_sub(as_of, 7), "last month": F.add_months(as_of, -1), "last year": F.add_months(as_of, -12),
        "yesterday": F.date_sub(as_of, 1), "today": as_of,
    }
    found = F.try_to_timestamp(text, F.lit("y-M-d")).cast("date")
    for name, date in back.items():
        found = F.when(form == COMPLETE.index(name), date).otherwise(found)
    return found
