"""Zone-safe timestamp and date parsing, week arithmetic.

``to_utc_ntz`` turns ISO-like timestamp text into a naive UTC
``timestamp_ntz``: an explicit offset is honoured, text without one is taken
as UTC. The result never depends on ``spark.sql.session.timeZone`` because the
instant is computed from epoch microseconds, not through a local-time cast.

Common ISO layouts are cast directly; for all others one pattern tells the layout
and takes its parts out of the text in one pass, and the parts are put together as
ISO text for one typed cast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from subledger.functions.text import trimmed

# English month names, and zone names with their offsets.
_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_ZONES = {
    "Z": "Z", "z": "Z", "UTC": "Z", "GMT": "Z", "utc": "Z", "gmt": "Z", "EST": "-05:00", "EDT": "-04:00",
    "CST": "-06:00", "CDT": "-05:00", "MST": "-07:00", "MDT": "-06:00", "PST": "-08:00", "PDT": "-07:00",
}
_MONTH = f"((?i:{'|'.join(_MONTHS)}))(?i:[a-z]*)\\.?"
# The accepted layouts, a date and perhaps a time of day; a bare year or
# time of day is none, nothing is completed from today, and no text may follow.
_LAYOUT = (
    r"^(?:"
    r"([0-9]{4})([-/])([0-9]{1,2})\2([0-9]{1,2})"  # 1-4: 2024-01-05, 2024/1/5
    r"|([0-9]{4})([0-9]{2})([0-9]{2})(?=T[0-9]{6})"  # 5-7: 20240105, with a compact time only
    r"|([0-9]{1,2})[-/]([0-9]{1,2})[-/]([0-9]{4})"  # 8-10: 01/05/2024, month first unless above 12
    rf"|(?:[A-Za-z]{{3,9}},?\s+)?([0-9]{{1,2}})\s+{_MONTH}\s+([0-9]{{4}})"  # 11-13: [Fri, ]05 Jan 2024
    rf"|{_MONTH}\s+([0-9]{{1,2}}),?\s+([0-9]{{4}})"  # 14-16: Jan 5, 2024
    r")(?:[T ](?:"
    r"([0-9]{1,2}):([0-9]{2})(?::([0-9]{2})(?:\.([0-9]+))?)?(?:\s?([AaPp])\.?[Mm]\.?)?"  # 17-21: 10:00[:00[.0]][ PM]
    r"|([0-9]{2})([0-9]{2})([0-9]{2})(?:\.([0-9]+))?"  # 22-25: 100000[.0]
    r"|([0-9]{2})"  # 26: 10
    rf")\s?({'|'.join(_ZONES)}|[+-][0-9]{{2}}(?::?[0-9]{{2}})?)?)?$"  # 27: zone
)
_GROUPS, _MARK = 27, "\x01"

# Fast paths: the common ISO layouts cast directly, without the rewrite chain.
_ISO_ZONED = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?(Z|[+-][0-9]{2}:[0-9]{2})$"
_ISO_NAIVE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?$"
_ISO_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


class _Parts:
    """The parts that ``_LAYOUT`` takes out of a text."""

    def __init__(self, groups: Column):
        self.groups = groups

    def first(self, *numbers: int) -> Column:
        """The first of these groups that stands in the text, else null."""
        return F.coalesce(*[F.nullif(F.get(self.groups, F.lit(n)), F.lit("")) for n in numbers])

    def found(self) -> Column:
        """Did the pattern fit, and is a compact time of day that of a compact date?"""
        return (F.get(self.groups, F.lit(0)) == _MARK) & (self.first(22).isNull() == self.first(5).isNull()) & self.hour().isNotNull()

    def day(self) -> Column:
        """The date as ISO text."""
        turned = self.first(8).cast("int") > 12
        months = F.create_map(*[F.lit(x) for i, m in enumerate(_MONTHS, 1) for x in (m, f"{i:02d}")])
        named = F.element_at(months, F.lower(self.first(12, 14)))
        month = F.coalesce(self.first(3, 6), named, F.when(turned, self.first(9)).otherwise(self.first(8)))
        day = F.coalesce(self.first(4, 7, 11, 15), F.when(turned, self.first(8)).otherwise(self.first(9)))
        return F.concat(self.first(1, 5, 10, 13, 16), F.lit("-"), F.lpad(month, 2, "0"), F.lit("-"), F.lpad(day, 2, "0"))

    def hour(self) -> Column:
        """The hour on the 24-hour clock; null for an hour that a 12-hour one lacks."""
        hour, half = F.coalesce(self.first(17, 22, 26), F.lit("0")).cast("int"), F.lower(self.first(21))
        late = F.when(half == "p", 12).otherwise(0)
        return F.when(half.isNull(), hour).when(hour.between(1, 12), hour % 12 + late)

    def time(self) -> Column:
        """The time of day with its zone as ISO text; UTC where none is named."""
        minute, second = (F.coalesce(self.first(*n), F.lit("00")) for n in ((18, 23), (19, 24)))
        fraction = F.coalesce(F.concat(F.lit("."), self.first(20, 25)), F.lit(""))
        zone = F.coalesce(self.first(27), F.lit("Z"))
        offset = F.concat(F.substring(zone, 1, 3), F.lit(":"), F.coalesce(F.nullif(F.regexp_replace(F.substring(zone, 4, 3), ":", ""), F.lit("")), F.lit("00")))
        names = F.create_map(*[F.lit(x) for pair in _ZONES.items() for x in pair])
        clock = F.concat_ws(":", F.lpad(self.hour().cast("string"), 2, "0"), minute, second)
        return F.concat(F.lit("T"), clock, fraction, F.coalesce(F.element_at(names, zone), offset))


def _by_layout(text: Column, use) -> Column:
    """``use`` of the parts of a text in one of the accepted layouts, else null."""
    marked = F.regexp_replace(text, _LAYOUT, "|".join([_MARK, *(f"${n}" for n in range(1, _GROUPS + 1))]))

    def read(groups: Column) -> Column:
        parts = _Parts(groups)
        return F.when(parts.found(), use(parts))

    return _let(F.split(marked, r"\|", -1), read)


def to_utc_ntz(c: str | Column) -> Column:
    """Timestamp text -> naive UTC timestamp_ntz; unparseable -> null."""
    raw = trimmed(c)
    text = (
        F.when(raw.rlike(_ISO_ZONED), raw)
        .when(raw.rlike(_ISO_NAIVE), F.concat(raw, F.lit("Z")))
        .otherwise(_by_layout(raw, lambda p: F.concat(p.day(), p.time())))
    )
    micros = F.unix_micros(text.try_cast("timestamp"))
    return F.timestamp_add("MICROSECOND", micros, F.expr(_EPOCH_NTZ))


def parse_date(c: str | Column) -> Column:
    """Lenient date text -> date: ISO date or timestamp (time part ignored),
    and the other accepted layouts. Unparseable text, or text after the date that
    is no time of day, -> null. Zone independent."""
    raw = trimmed(c)
    day = F.when(raw.rlike(_ISO_DAY), raw).otherwise(_by_layout(raw, lambda p: p.day()))
    return day.try_cast("date")


def weekday_mon0(c: str | Column) -> Column:
    """Day of week with Monday = 0 ... Sunday = 6."""
    return F.weekday(_col(c))


def week_start(c: str | Column) -> Column:
    """Monday of the week containing the date/timestamp (as date)."""
    d = _col(c).cast("date")
    return F.date_sub(d, F.weekday(d))
