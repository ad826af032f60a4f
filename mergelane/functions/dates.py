"""Date expressions: mixed-format parsing, dates hidden in file paths, date keys."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class DateStep:
    """One way to read a date: texts of one of the `shapes` are parsed with `pattern`.

    A shape is the text with every digit written as 9, so the test is a plain comparison and a row
    pays for the one parser that fits. `prefix` completes the text to a full date first; `month_end`
    moves the result to the last day of its month.
    """

    name: str
    shapes: tuple[str, ...]
    pattern: str
    prefix: str = ""
    month_end: bool = False

    def expression(self, text: Column, shape: Column) -> Column:
        whole = F.concat(F.lit(self.prefix), text) if self.prefix else text
        day = F.try_to_date(whole, self.pattern)
        return F.when(shape.isin(*self.shapes), F.last_day(day) if self.month_end else day)


@dataclass(frozen=True)
class QuarterStep:
    """A quarter, read as its last day. `shape` is a regex with groups for `year` and `quarter`."""

    name: str
    shape: str
    year: int
    quarter: int

    def expression(self, text: Column, shape: Column) -> Column:
        year = F.regexp_extract(text, self.shape, self.year).cast("int")
        month = F.regexp_extract(text, self.shape, self.quarter).cast("int") * 3
        return F.when(text.rlike(self.shape), F.last_day(F.make_date(year, month, F.lit(1))))


@dataclass(frozen=True)
class NamedMonthStep:
    """A day with the month as three letters; in any case, as Spark reads it."""

    name: str
    shape: str
    pattern: str

    def expression(self, text: Column, shape: Column) -> Column:
        return F.when(text.rlike(self.shape), F.try_to_date(text, self.pattern))


@dataclass(frozen=True)
class IsoStep:
    """Whatever else Spark's own parser takes that starts with a year.

    That parser reads a bare time of day as today; such text is no date, hence the year.
    """

    name: str

    def expression(self, text: Column, shape: Column) -> Column:
        found = F.coalesce(F.try_to_timestamp(text).cast("date"), F.try_to_date(text))
        return F.when(shape.rlike("^[+-]?9999"), found)


Step = DateStep | QuarterStep | NamedMonthStep | IsoStep

# The accepted texts, tried from top to bottom; the first that parses wins. Two-digit
# years mean 20yy.
DEFAULT_STEPS: tuple[Step, ...] = (
    DateStep("iso_day", ("9999-99-99", "9999-9-99", "9999-99-9", "9999-9-9"), "yyyy-M-d"),
    DateStep("slash_day", ("99/99/9999", "9/99/9999", "99/9/9999", "9/9/9999"), "d/M/yyyy"),
    DateStep("dotted_day", ("99.99.9999", "9.99.9999", "99.9.9999", "9.9.9999"), "d.M.yyyy"),
    DateStep("month_year2", ("99_99",), "dd_MM_yy", prefix="01_", month_end=True),
    DateStep("month_year", ("99_9999",), "dd_MM_yyyy", prefix="01_", month_end=True),
    DateStep("slash_month_year", ("99/9999", "9/9999"), "d/M/yyyy", prefix="1/", month_end=True),
    DateStep("hyphen_month_year", ("99-9999", "9-9999"), "d-M-yyyy", prefix="1-", month_end=True),
    DateStep("underscore_day", ("99_99_9999",), "dd_MM_yyyy"),
    DateStep("digits8", ("99999999",), "yyyyMMdd"),
    DateStep("seconds", ("9999-99-99 99:99:99",), "yyyy-MM-dd HH:mm:ss"),
    DateStep("millis", ("9999-99-99 99:99:99.999",), "yyyy-MM-dd HH:mm:ss.SSS"),
    QuarterStep("year_quarter", r"^(\d{4})_[qQ]([1-4])$", year=1, quarter=2),
    QuarterStep("quarter_year", r"[qQ]([1-4])_(\d{4})", year=2, quarter=1),
    NamedMonthStep("named_month_year2", r"^\d{1,2}-\p{L}{3}-\d{2}$", "d-MMM-yy"),
    NamedMonthStep("named_month", r"^\d{1,2}-\p{L}{3}-\d{4}$", "d-MMM-yyyy"),
    IsoStep("iso"),
)

# Strict mode: slashed days need two digits, dots do not count, quarters need a capital Q.
_STRICTER: dict[str, Step | None] = {
    "slash_day": DateStep("slash_day", ("99/99/9999",), "dd/MM/yyyy"),
    "dotted_day": None,
    "year_quarter": QuarterStep("year_quarter", r"^(\d{4})_Q([1-4])$", year=1, quarter=2),
    "quarter_year": QuarterStep("quarter_year", r"Q([1-4])_(\d{4})", year=2, quarter=1),
}
STRICT_STEPS: tuple[Step, ...] = tuple(
    step for s in DEFAULT_STEPS if (step := _STRICTER.get(s.name, s)) is not None
)


def _column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_mixed_date(
    col: Column | str, steps: tuple[Step, ...] | None = None, strict_parity: bool = False
) -> Column:
    """Text of unknown date format to DATE; null when no step reads it.

    ``strict_parity`` turns the wider forms off (one-digit or dotted days, lower-case quarters).

    The steps are the body of a lambda over a one-element array. So the text is computed once per
    row, and the sixteen parsers stay out of the generated code of the stage around them: inlined,
    they make its main method longer than the JVM compiles, which slows down all of the stage.
    """
    chosen = steps or (STRICT_STEPS if strict_parity else DEFAULT_STEPS)
    text = F.trim(_column(col).cast("string"))
    shape = F.translate(text, "012345678", "999999999")
    seen = F.array(F.struct(text.alias("text"), shape.alias("shape")))
    days = F.transform(
        seen, lambda row: F.coalesce(*[s.expression(row["text"], row["shape"]) for s in chosen])
    )
    return F.get(days, F.lit(0))


# What counts as a bare date, what marks a path, and which date parts a path may hold.
BARE_DATE = (
    r"(?i)^(\d{1,2}[/-]\d{2,4}|\d{1,2}_\d{2,4}|\d{2}_\d{2}_\d{4}|q[1-4]_\d{4}|\d{4}_q[1-4]"
    r"|\d{4}-\d{1,2}-\d{1,2}.*|\d{8})$"
)
PATH_MARK = r"(volumes|datalake)/"
DATE_IN_PATH = r"(\d{2}_\d{2}_\d{4}|\d{2}_\d{4}|\d{2}_\d{2}|[qQ][1-4]_\d{4}|\d{4}_[qQ][1-4])"


def extract_path_date(col: Column | str) -> Column:
    """The date text a value carries: itself if it is one, the first hit inside a path, otherwise null.

    The hit is the leftmost one: ``2023_01`` in a path yields ``23_01``.
    """
    text = F.trim(_column(col).cast("string"))
    hit = F.regexp_extract(text, DATE_IN_PATH, 1)
    return F.when(text.rlike(BARE_DATE), text).when(text.rlike(PATH_MARK), hit)


def date_text(col: Column | str) -> Column:
    """The text to parse of a value that holds a date or the path of the file it came from."""
    text = F.trim(_column(col).cast("string"))
    in_path = text.rlike(PATH_MARK) & ~text.rlike(BARE_DATE)
    return F.when(in_path, F.regexp_extract(text, DATE_IN_PATH, 1)).otherwise(text)


def parse_date_or_path(df: DataFrame, col: str, strict_parity: bool = False) -> DataFrame:
    """`df` with `col`, a date text or the path of the file it came from, as DATE.

    Bare dates and path dates are parsed by `parse_mixed_date`, and so is any other text. In strict
    mode, other text has to be ``dd/MM/yyyy``. The text is cut out in a projection of its own, as
    every step of the parser looks at it.
    """
    if strict_parity:
        texts = df.withColumns({"__date": extract_path_date(col), "__raw": F.col(col).cast("string")})
        rest = F.when(F.col("__raw").rlike(r"^\d{2}/\d{2}/\d{4}$"), F.try_to_date("__raw", "dd/MM/yyyy"))
        day = F.coalesce(parse_mixed_date("__date", strict_parity=True), rest)
        return texts.withColumn(col, day).drop("__date", "__raw")
    texts = df.withColumn("__date", date_text(col))
    return texts.withColumn(col, parse_mixed_date("__date")).drop("__date")


def date_key(col: Column | str) -> Column:
    """DATE to its yyyyMMdd integer."""
    return F.date_format(_column(col), "yyyyMMdd").cast("int")


def since_month_start(col: Column | str, now: datetime) -> Column:
    """True from the first moment of the month of `now`; the caller supplies the clock."""
    start = now.replace(day=1, hour=0, minute=0, second=0, microsecond=0)
    return _column(col) >= F.lit(start)
