"""Date parsing. Every parse is guarded by the shape of the text, so that junk gives null and
nothing is parsed leniently."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import fixed_values as fv
from .text import SPACES, as_col, let, nonempty, or_empty, string_map, strip

_WEEKDAY = r"^(?i:mon|tue|wed|thu|fri|sat|sun)[a-z]*,\s*"
_MONTH = (
    "(?i:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?"
    "|sep(?:tember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
)
_ISO_DAY = r"(\d{4})-(\d{1,2})-(\d{1,2})"
_CLOCK = r"\d{1,2}:\d{1,2}:\d{1,2}"
_OFFSET = r"(?:Z|[+-]\d{2}:?\d{2})"


def _day(text: Column, shape: str, pattern: str) -> Column:
    """Date of ``text`` when it has the shape, else null."""
    return F.when(text.rlike(shape), F.try_to_date(text, pattern))


def iso_date(value: Column | str) -> Column:
    """``m/d/Y``, ``m/d/y`` (years from 69 on are 19xx) and ``Y-m-d`` to ISO; other text as it
    is, trimmed."""
    text = strip(as_col(value))
    short = r"^(\d{1,2}/\d{1,2})/(\d{2})$"
    century = F.when(F.regexp_extract(text, short, 2) >= "69", F.lit("19")).otherwise(F.lit("20"))
    long_year = F.concat(
        F.regexp_extract(text, short, 1), F.lit("/"), century, F.regexp_extract(text, short, 2)
    )
    parsed = F.coalesce(
        _day(text, r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
        F.when(text.rlike(short), F.try_to_date(long_year, "M/d/yyyy")),
        _day(text, rf"^{_ISO_DAY}$", "yyyy-M-d"),
    )
    return F.coalesce(F.date_format(parsed, "yyyy-MM-dd"), text)


def first_short_date(value: Column | str) -> Column:
    """First ``m/d/Y`` inside a text, as ISO; null when there is none."""
    return iso_date(nonempty(F.regexp_extract(or_empty(value), fv.SHORT_DATE_PATTERN, 0)))


def parse_year(value: Column | str, strict_formats: bool = False) -> Column:
    """Year of a publication date.

    Known formats first, then the first lone four-digit token between 1900 and 2100. The
    format ``dd/MM/yyyy``, which the feed scan itself writes, is known unless
    ``strict_formats`` is set.
    """

    def parse(text: Column) -> Column:
        bare = F.regexp_replace(text, _WEEKDAY, "")
        moment = F.regexp_extract(text, rf"^({_ISO_DAY}T{_CLOCK}){_OFFSET}$", 1)
        stamp = F.regexp_extract(bare, rf"^(\d{{1,2}} {_MONTH} \d{{4}} {_CLOCK}) \S+$", 1)
        dates = [
            _day(text, rf"^{_ISO_DAY}$", "yyyy-M-d"),
            _day(text, r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
            _day(text, rf"^\d{{1,2}} {_MONTH} \d{{4}}$", "d MMM yyyy"),
            _day(text, rf"^\d{{1,2}} {_MONTH} \d{{4}}$", "d MMMM yyyy"),
            F.when(stamp != "", F.try_to_timestamp(stamp, F.lit("d MMM yyyy H:m:s")).cast("date")),
            F.when(moment != "", F.try_to_timestamp(moment, F.lit("yyyy-M-d'T'H:m:s")).cast("date")),
        ]
        if not strict_formats:
            dates.append(_day(text, r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"))
        tokens = F.filter(
            F.split(text, SPACES),
            lambda t: t.rlike(r"^[0-9]{4}$") & (t >= "1900") & (t <= "2100"),
        )
        return F.coalesce(F.year(F.coalesce(*dates)), F.get(tokens, F.lit(0)).cast("int"))

    return let(strip(as_col(value)), parse)


# Zone names of mail dates.
_ZONES = {
    "UT": "+0000",
    "UTC": "+0000",
    "GMT": "+0000",
    "Z": "+0000",
    "EST": "-0500",
    "EDT": "-0400",
    "CST": "-0600",
    "CDT": "-0500",
    "MST": "-0700",
    "MDT": "-0600",
    "PST": "-0800",
    "PDT": "-0700",
}


def _utc_day(moment: Column) -> Column:
    """UTC day of a timestamp, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(moment) / 86_400).cast("int"))


def _mail_date(text: Column) -> Column:
    """Mail date, with or without weekday, seconds and zone; as a timestamp (no zone is UTC)."""
    shape = rf"^(\d{{1,2}}) ({_MONTH}) (\d{{4}}|\d{{2}}) (\d{{1,2}}:\d{{2}})(:\d{{2}})?(?: (\S+))?$"
    bare = F.regexp_replace(text, _WEEKDAY, "")
    # All parts by one match, with a separator that no date holds.
    cut = F.split(F.regexp_replace(bare, shape, "\x01".join(["", *(f"${i}" for i in range(1, 7))])), "\x01")

    def moment(parts: Column) -> Column:
        def part(i: int) -> Column:
            return F.get(parts, F.lit(i))

        year = F.when(F.length(part(3)) == 4, part(3)).otherwise(
            F.concat(F.when(part(3) >= "69", F.lit("19")).otherwise(F.lit("20")), part(3))
        )
        zone = F.upper(part(6))
        known = F.try_element_at(string_map(_ZONES), zone)
        offset = F.coalesce(F.when(zone.rlike(r"^[+-]\d{4}$"), zone), known, F.lit("+0000"))
        seconds = F.coalesce(nonempty(part(5)), F.lit(":00"))
        stamp = F.concat_ws(
            " ", part(1), F.substring(part(2), 1, 3), year, F.concat(part(4), seconds), offset
        )
        return F.when(F.size(parts) == 7, F.try_to_timestamp(stamp, F.lit("d MMM yyyy H:m:s Z")))

    return let(cut, moment)


def feed_day(value: Column | str) -> Column:
    """UTC day of a feed date text: mail date, ISO with offset, ISO with blank, ISO day; else
    null. Texts without offset count as UTC."""

    def parse(text: Column) -> Column:
        zoned = F.regexp_replace(F.regexp_replace(text, r"Z$", "+0000"), r"([+-]\d{2}):(\d{2})$", "$1$2")
        no_fraction = F.regexp_replace(zoned, r"(T\d{1,2}:\d{1,2}:\d{1,2})\.\d+", "$1")
        with_offset = F.coalesce(
            _mail_date(text),
            F.when(
                no_fraction.rlike(rf"^{_ISO_DAY}T{_CLOCK}[+-]\d{{4}}$"),
                F.try_to_timestamp(no_fraction, F.lit("yyyy-M-d'T'H:m:sXX")),
            ),
        )
        plain = F.when(
            text.rlike(rf"^{_ISO_DAY} {_CLOCK}$"), F.try_to_timestamp(text, F.lit("yyyy-M-d H:m:s"))
        )
        return F.coalesce(
            _utc_day(with_offset), plain.cast("date"), _day(text, rf"^{_ISO_DAY}$", "yyyy-M-d")
        )

    return let(strip(as_col(value)), parse)


def feed_date(*values: Column | str) -> Column:
    """First parsable date of the values as ``dd/MM/yyyy``, else ''."""
    parsed = F.coalesce(*[feed_day(v) for v in values])
    return F.coalesce(F.date_format(parsed, "dd/MM/yyyy"), F.lit(""))
