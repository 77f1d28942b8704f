"""Dates found in pages, and the text form of timestamps in exported tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from presskiln.functions.binding import let

# Fixed value: the name of a zone behind a time, which is not looked at: the time is UTC.
_ZONE_NAME = r"(:\d{2}(?: ?[AaPp]\.?[Mm]\.?)?) [A-Z]{3,5}$| \([A-Z]{3,5}\)$"
# Fixed value: digits without separators, as year, month and day, hour, minute and second.
_COMPACT = r"^(\d{4})(\d{2})(\d{2})(?:t?(\d{2})(\d{2})(\d{2})?)?(?=z|[+-]|$)"
# Fixed value: a time of day. Its pieces: hour, minute, second, fraction; half of the day; sign,
# hours and minutes of an offset; or an hour alone with its half of the day.
_TIME = (
    r"(?<!\d)(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)?(?:\s*([ap])\.?m\b\.?)?"
    r"(?:\s*(?:z\b|utc|gmt)?\s*([+-])(\d{2}):?(\d{2})?(?!\d))?"
    r"|(?<!\d)(\d{1,2})\s*([ap])\.?m\b\.?"
)
# Words of a date by kind. Any other word makes a text unreadable.
_MONTH = (
    "jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sep(?:t(?:ember)?)?"
    "|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
)
_FILLER = (
    "(?:mon|tues?|wed(?:nes)?|thu(?:rs?)?|fri|sat(?:ur)?|sun)(?:day)?|st|nd|rd|th|t|z|utc|gmt|at|on|of|and"
)
# The forms in which most dates without a time are written: day, month and year, or month, day and
# year, or year, month and day.
_PLAIN = (
    rf"^(?:{_FILLER.split('|st|')[0]},?\s+)?(?:(\d{{1,2}})(?:st|nd|rd|th)?\s+({_MONTH}),?\s+(\d{{4}})"
    rf"|({_MONTH})\.?\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}}))$"
    r"|^(\d{4})[/.](\d{1,2})[/.](\d{1,2})$|^(\d{4})(\d{2})(\d{2})$"
)
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"


def _number_of(month: Column) -> Column:
    """Number of a named month."""
    return F.floor((F.instr(F.lit(_MONTHS), F.substr(month, F.lit(1), F.lit(3))) + 2) / 3).cast("int")


def _day(words: Column, numbers: Column) -> Column:
    """(year, month, day) from the words and numbers of a text; NULL where they make no date.

    With a month's name the number of four digits is the year. Without, a year stands first or
    last, and the month before the day unless only the other order makes a month.
    """
    first, second, third = (F.get(numbers, F.lit(k)) for k in range(3))
    long_first, long_second, long_third = (F.length(n) == 4 for n in (first, second, third))
    count = F.size(numbers)

    def as_date(year, month, day):
        return F.struct(year.cast("int").alias("y"), month.cast("int").alias("m"), day.cast("int").alias("d"))

    def either(year, a, b):
        swapped = a.cast("int") > 12
        return as_date(year, F.when(swapped, b).otherwise(a), F.when(swapped, a).otherwise(b))

    def with_month(month):
        named = _number_of(month)
        return F.when(month.isNull(), numeric).when(
            (count == 2) & long_first & ~long_second, as_date(first, named, second)
        ).when((count == 2) & long_second & ~long_first, as_date(second, named, first))

    numeric = F.when(
        (count == 3) & ~long_second,
        F.when(long_first & ~long_third, either(first, second, third)).when(long_third & ~long_first, either(third, first, second)),
    )
    month = F.get(F.filter(words, lambda w: w.rlike(f"^(?:{_MONTH})$")), F.lit(0))
    unknown = F.exists(words, lambda w: ~w.rlike(f"^(?:{_MONTH}|{_FILLER})$"))
    short = F.forall(numbers, lambda n: (F.length(n) <= 2) | (F.length(n) == 4))
    return F.when(count.between(2, 3) & short & ~unknown, let(month, with_month))


def _moment(day: Column, piece) -> Column:
    """Timestamp of a (year, month, day) and the pieces of a time, of which all may be ''."""
    def number(k):
        return F.coalesce(F.nullif(piece(k), F.lit("")).cast("int"), F.lit(0))

    alone = piece(9) != ""
    half = F.when(alone, piece(10)).otherwise(piece(5))
    hour = F.when(alone, number(9)).otherwise(number(1))
    hour = F.when(half == "", hour).when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0))
    seconds = F.concat(number(3).cast("string"), F.lit("."), piece(4), F.lit("0")).try_cast("decimal(8,6)")
    stamp = F.try_make_timestamp(day["y"], day["m"], day["d"], hour, number(2), seconds)
    offset = F.make_dt_interval(F.lit(0), number(7), number(8), F.lit(0))
    return F.when(piece(6) == "", stamp).when(piece(6) == "+", stamp - offset).otherwise(stamp + offset)


def parse_date(text: Column) -> Column:
    """Timestamp written in ``text``; NULL where it holds no four-digit year or makes no date.

    ISO forms are read by a cast. Any other text is taken apart: a time of day with its offset,
    then words (names of months, what says nothing) and numbers. Text without an offset is read in
    the session time zone, which is UTC.
    """
    def read(plain: Column) -> Column:
        rest = let(F.lower(plain), lambda low: F.coalesce(common(low), let(spaced(low), pieces)))
        return F.when(plain.rlike(r"\d{4}"), F.coalesce(plain.try_cast("timestamp"), rest))

    def common(low: Column) -> Column:
        parts = F.regexp_replace(low, _PLAIN, "$3$6$7$10|$2$4$8$11|$1$5$9$12")
        return let(parts, lambda p: F.when(p != low, let(F.split(p, "[|]"), whole)))

    def whole(part: Column) -> Column:
        # Not a try_cast: one that fails costs far more than all the rest.
        month = F.when(part[1] < ":", part[1].cast("int")).otherwise(_number_of(part[1]))
        return F.when(month <= 12, F.try_make_timestamp(part[0].cast("int"), month, part[2].cast("int"), F.lit(0), F.lit(0), F.lit(0)))

    def spaced(low: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(low, _COMPACT, "$1-$2-$3 $4:$5:$6"), r":+(?=$|[z+-])", "")

    # Every piece that is used more than once is bound: it would be worked out for each use.
    def pieces(low: Column) -> Column:
        return let(F.regexp_replace(low, _TIME, " "), lambda rest: dated(low, rest))

    def dated(low: Column, rest: Column) -> Column:
        words, numbers = (F.regexp_extract_all(rest, F.lit(p), F.lit(0)) for p in ("[a-z]+", r"\d+"))
        day = F.when(~rest.rlike(r"[^\sa-z0-9,./:'-]"), let(words, lambda w: let(numbers, lambda n: _day(w, n))))
        return let(day, lambda d: F.when(d.isNotNull(), F.when(low == rest, midnight(d)).otherwise(timed(low, d))))

    def midnight(d: Column) -> Column:
        return F.try_make_timestamp(d["y"], d["m"], d["d"], F.lit(0), F.lit(0), F.lit(0))

    def timed(low: Column, d: Column) -> Column:
        time = F.array(*[F.regexp_extract(low, _TIME, k) for k in range(1, 11)])
        return let(time, lambda t: _moment(d, lambda k: t[k - 1]))

    plain = F.trim(text)
    return let(F.when(plain.rlike("[A-Za-z)]$"), F.regexp_replace(plain, _ZONE_NAME, "$1")).otherwise(plain), read)


def parse_iso(text: Column) -> Column:
    """Timestamp of ISO text; the empty text of an exported table is NULL."""
    return F.nullif(text, F.lit("")).try_cast("timestamp")


def iso_text(ts: Column) -> Column:
    """ISO text of a UTC timestamp with its fraction only where there is one; NULL gives ''."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.when(F.unix_micros(ts) % 1_000_000 != 0, F.date_format(ts, ".SSSSSS")).otherwise("")
    return F.coalesce(F.concat(whole, fraction, F.lit("+00:00")), F.lit(""))
