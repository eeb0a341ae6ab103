"""Years, ends and starts of periods, and calendar dates named in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import YEAR

_HAN = ("〇○零一二三四五六七八九", "000123456789")
_HAN_YEAR = r"二[零〇][〇零一二三四五六七八九]{2}"
_HAN_NUMBER = "[〇零一二三四五六七八九十]{1,3}"


def year_of(c: Column) -> Column:
    """The first year of the twenty-first century in a text, in digits or Chinese numerals; null for none."""
    return F.translate(F.nullif(F.regexp_extract(c, YEAR, 1), F.lit("")), "二" + _HAN[0], "2" + _HAN[1]).cast("int")


def han_number(c: Column) -> Column:
    """A number up to 99 in digits or Chinese numerals; what is neither gives 0."""
    left, right = F.substring_index(c, "十", 1), F.substring_index(c, "十", -1)
    digit = lambda x: F.coalesce(F.when(F.length(x) == 1, F.translate(x, *_HAN).try_cast("int")), F.lit(0))
    tens = F.when(left == "", F.lit(1)).otherwise(F.when(digit(left) == 0, F.when(left.rlike("^[零〇]$"), 0).otherwise(1)).otherwise(digit(left)))
    return F.when(c.rlike(r"^\d+$"), c.try_cast("int")).when(c.contains("十"), tens * 10 + digit(right)).otherwise(digit(c))


def month_end(year: Column, month: Column) -> Column:
    """The last day of a month; null when there is no such month."""
    return F.when(month.between(1, 12) & year.between(1, 9999), F.last_day(F.make_date(year, F.when(month.between(1, 12), month).otherwise(1), F.lit(1))))


# Months of the ends of quarters, by how a quarter is written.
_QUARTERS = (("[一1]季度", "3"), ("[二2]季度", "6"), ("[三3]季度", "9"), ("[四4]季度", "12"))
# The notations of a period in the order they are tried: pattern, and the group or the value of the month.
_NOTATIONS = (
    (rf"({_HAN_YEAR})年({_HAN_NUMBER})月{_HAN_NUMBER}日", 2),
    (r"(\d{4})年(\d{1,2})月", 2),
    (r"(\d{4})年(\d{1,2})末", 2),
    (r"(\d{4})年(第[一二三四1234]季度)", "quarter"),
    (r"(\d{4})年([一二三四1234]季度)", "quarter"),
    (r"(\d{4})年\d{1,2}-(\d{1,2}季度)", "quarter"),
    (r"(\d{4})年(前[一二三四1234]季度)", "quarter"),
    (r"(\d{4})年(半年度|上半年)", "6"),
    (r"(\d{4})(年度|年部分经营数据|年公司境内|年经营)", "12"),
    (r"(\d{4})年\d{1,2}-(\d{1,2})月", 2),
    (r"(\d{4})年(年度|年末|末)", "12"),
    (r"(\d{4})年(共同|发行)", "12"),
)


def ranked_period_end(c: Column) -> Column:
    """(rank, end): the end of the period a text names and the place of the notation it was read by; null for none.

    Twelve notations are tried in order: a date in Chinese numerals, year and month, month's end, quarters,
    half-year, year, range of months, year's end. The end is always a month's end, null for an impossible month.
    """

    def read(s: Column) -> Column:
        """'rank|year|month' by the first notation that is in the text."""
        out = None
        for rank, (pattern, month) in enumerate(_NOTATIONS):
            if month == "quarter":
                q = F.regexp_extract(s, pattern, 2)
                value = F.when(q.rlike(_QUARTERS[0][0]), _QUARTERS[0][1])
                for form, m in _QUARTERS[1:]:
                    value = value.when(q.rlike(form), m)
            else:
                value = F.regexp_extract(s, pattern, month) if isinstance(month, int) else F.lit(month)
            fields = F.concat_ws("|", F.lit(str(rank)), F.regexp_extract(s, pattern, 1), value)
            out = F.when(s.rlike(pattern), fields) if out is None else out.when(s.rlike(pattern), fields)
        return out

    def end(fields: Column) -> Column:
        f = F.split(fields, r"\|")
        year = F.translate(F.get(f, F.lit(1)), "二" + _HAN[0], "2" + _HAN[1]).try_cast("int")
        return F.when(fields.isNotNull(), F.struct(F.get(f, F.lit(0)).try_cast("int").alias("rank"), month_end(year, han_number(F.coalesce(F.get(f, F.lit(2)), F.lit("")))).alias("end")))

    # Lambdas over one-element arrays bind a value once, where a nested expression would be repeated in code.
    text = F.array(F.regexp_replace(c, r"[ \n\t]", ""))
    return F.get(F.transform(F.transform(text, read), end), F.lit(0))


def period_end(c: Column) -> Column:
    """The end of the period a text names, by the first of the notations that matches; null when none does."""
    return ranked_period_end(c)["end"]


def clamped_date(c: Column) -> Column:
    """Yyyy-M-d as a date, its day held to the month's length; null for anything else."""
    p = r"^\s*(\d{4})-(\d{1,2})-(\d{1,2})\s*$"
    y, m, d = (F.nullif(F.regexp_extract(c, p, i), F.lit("")).cast("int") for i in (1, 2, 3))
    last = month_end(y, m)
    return F.when(d >= 1, F.make_date(y, F.when(last.isNotNull(), m), F.least(d, F.dayofmonth(last))))


_MONTHS = ((r"(?i)六個月|六个月|6\s*個月|6\s*个月|six months", 6), (r"(?i)九個月|九个月|9\s*個月|9\s*个月|nine months", 9), ("季度", 3))


def months_rank(text: Column) -> Column:
    """The place in order of the months that a text speaks of, past the last for none."""
    out = F.when(text.rlike(_MONTHS[0][0]), 0)
    for k, (words, _) in enumerate(_MONTHS[1:], 1):
        out = out.when(text.rlike(words), k)
    return out.otherwise(len(_MONTHS))


def months_of(rank: Column) -> Column:
    return F.coalesce(F.get(F.array(*[F.lit(m) for _, m in _MONTHS]), rank), F.lit(12))


def period_months(text: Column) -> Column:
    """The months of a period that a text speaks of: 6, 9, 3 for a quarter, else 12."""
    return months_of(months_rank(text))


def period_start(end: Column, text: Column) -> Column:
    """The day after the end shifted back by the period's months, days held to the month's length."""
    return F.date_add(F.add_months(end, -period_months(text)), 1)


def aligned_end(end: Column, year: Column) -> Column:
    """The end's month and day in a given year, held to the month's length; 31 December without an end."""
    moved = F.make_date(year, F.month(end), F.lit(1))
    return F.when(end.isNull(), F.make_date(year, F.lit(12), F.lit(31))).otherwise(F.make_date(year, F.month(end), F.least(F.dayofmonth(end), F.dayofmonth(F.last_day(moved)))))


def business_date(c: Column, zone: str = "Asia/Shanghai") -> Column:
    """The calendar date of a text: a date or a time without zone as written, an instant in ``zone``."""
    s = F.regexp_replace(c, r"^\s+|\s+$", "")
    date = r"^(\d{4}-\d{2}-\d{2})$"
    naive = r"^(\d{4}-\d{2}-\d{2})[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?$"
    zoned = s.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})$")
    literal = F.coalesce(F.nullif(F.regexp_extract(s, date, 1), F.lit("")), F.nullif(F.regexp_extract(s, naive, 1), F.lit("")))
    instant = F.when(zoned, s).try_cast("timestamp")
    # the instant's wall clock in UTC whatever the session's zone, then in ``zone``
    utc = F.to_utc_timestamp(instant, F.current_timezone())
    return F.coalesce(literal.try_cast("date"), F.to_date(F.from_utc_timestamp(utc, zone)))


def year_hint(code: Column) -> Column:
    """Two period texts for the year in a code 'AN' yyyy… and the year before; '' for other codes."""
    y = F.nullif(F.regexp_extract(code, r"^AN(\d{4})", 1), F.lit("")).cast("int")
    return F.when(y.isNull(), "").otherwise(F.format_string("截至%d年12月31日止年度 截至%d年12月31日止年度", y, y - 1))
