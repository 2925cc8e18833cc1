"""Column functions (C-series): parsing, cleaning and date attributes.

Every function takes and returns a ``Column`` built from ``pyspark.sql.functions``
only, so the work stays inside Catalyst and in code that the JVM compiles.  None of them depends on
``spark.sql.ansi.enabled``: lenient parsers use ``try_*`` and the strict id cast
raises explicitly, so results are the same in either mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# The missing-value tokens a CSV reader treats as NULL by default.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Accepted numeric text (finite decimal or scientific, optional sign,
# surrounding whitespace) and the infinities.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
PLAIN_NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$"
INFINITY_PATTERN = r"^\s*[+-]?(?i:inf|infinity)\s*$"
# Whitespace a text strip removes: every character Python's ``str.isspace`` accepts
# (29 code points: ASCII controls 9-13 and 28-31, space, NEL, no-break spaces,
# the Unicode space separators).  ``F.trim`` alone only removes spaces.
WHITESPACE = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_text(c: ColumnOrName) -> Column:
    """Remove leading and trailing whitespace of any kind (tabs, newlines, Unicode)."""
    return F.btrim(_c(c), F.lit(WHITESPACE))


def _sql_text_list(values: list[str]) -> str:
    return ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)


NA_LIST_SQL = _sql_text_list(NA_TOKENS)


def null_tokens(c: ColumnOrName, tokens: list[str] | None = None) -> Column:
    """Missing-value tokens (and blank text) become NULL.  Spark looks a text up in a
    list of more than ten tokens by its hash."""
    c = _c(c)
    return F.when(~c.isin(NA_TOKENS if tokens is None else tokens), c)


def clean_text(c: ColumnOrName) -> Column:
    """C8 then S3/C9: trimmed text, with blank and missing-value tokens as NULL."""
    return null_tokens(strip_text(c))


def strict_bigint(c: ColumnOrName, name: str = "id") -> Column:
    """Text of an integral number to BIGINT (``12``, ``12.0``, ``1e3``: a column read as float
    is cast to integers the same way); NULL stays NULL, anything else
    (``12.5``, ``abc``, overflow) raises, as a strict nullable-integer cast does."""
    c = _c(c)
    text = c.cast("string")
    wrong = F.when(text.isNotNull(), F.raise_error(F.concat(F.lit(f"not an integer in {name}: "), text)).cast("bigint"))
    # The lambda binds the text once and keeps its long formula out of the generated code of the projection: that code is one
    # method per stage, which the JVM doesn't compile beyond 8,000 bytes.
    exact = F.transform(F.array(text), _exact_bigint)[0]
    return F.coalesce(text.try_cast("bigint"), exact, wrong).cast("bigint")


def _exact_bigint(text: Column) -> Column:
    """Integral text with a point or an exponent to BIGINT, else NULL; exact, never by a double: digits and exponent of the text say whether it is integral."""
    part = lambda i: F.regexp_extract(text, r"^\s*[+-]?(\d*)\.?(\d*)(?:[eE]([+-]?\d{1,9}))?\s*$", i)
    digits, shift = F.concat(part(1), part(2)), F.coalesce(part(3).try_cast("int"), F.lit(0))
    kept = F.regexp_replace(digits, "0+$", "")
    integral = (kept == "") | (F.length(part(2)) - shift <= F.length(digits) - F.length(kept))
    return F.when((digits != "") & integral, text.try_cast("decimal(38,0)").try_cast("bigint"))


def _exponent_out_of_range(text: Column) -> Column:
    """True for scientific text whose decimal exponent, less the digits after the
    point, is above 308 (``0e309``, ``0.1e310``): such text is not a number, even
    when its value would be 0."""
    exp_text = F.regexp_extract(text, r"[eE]([+-]?\d+)", 1)
    exp = F.coalesce(
        exp_text.try_cast("long"), F.when(exp_text.startswith("-"), F.lit(-(10**18))).otherwise(F.lit(10**18))
    )
    decimals = F.length(F.regexp_extract(text, r"\.(\d*)", 1))
    return exp - decimals > MAX_DECIMAL_EXPONENT


# Fixed value: the largest decimal exponent a finite double can carry.
MAX_DECIMAL_EXPONENT = 308


def parse_number(c: ColumnOrName) -> Column:
    """Lenient numeric parse to DOUBLE; unparsable text becomes NULL, never NaN.
    Finite text that overflows (``1e309``) is unparsable too; ``inf`` text is infinity."""
    text = _c(c).cast("string")
    # as in ``strict_bigint``: the rarer forms stay out of the generated code
    rarer = F.transform(F.array(text), _scientific_or_infinite)[0]
    return F.when(text.rlike(PLAIN_NUMBER_PATTERN), text.try_cast("double")).when(text.isNotNull(), rarer).cast("double")


def _scientific_or_infinite(text: Column) -> Column:
    value = text.try_cast("double")
    finite = text.rlike(NUMBER_PATTERN) & ~F.abs(value).eqNullSafe(F.lit(float("inf"))) & ~_exponent_out_of_range(text)
    return F.when(finite | text.rlike(INFINITY_PATTERN), value)


def parse_int(c: ColumnOrName) -> Column:
    """C5 for integer columns: lenient numeric parse, then truncation to INT."""
    return parse_number(c).try_cast("int")


def parse_currency(c: ColumnOrName) -> Column:
    """Drop literal ``$`` and ``,`` then parse leniently (``-$5.00`` -> -5.0)."""
    return parse_number(F.regexp_replace(_c(c).cast("string"), r"[$,]", ""))


def parse_date(c: ColumnOrName, fmt: str = "yyyy-MM-dd") -> Column:
    """Lenient date parse; text that does not match ``fmt`` becomes NULL.  Months and
    days of the default format may lack their leading zero."""
    text = _c(c).cast("string")
    if fmt != "yyyy-MM-dd":
        return F.try_to_date(text, fmt)
    return F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(text, "yyyy-M-d"))


def parse_flag(c: ColumnOrName, true: str = "t", false: str = "f") -> Column:
    """``'t'`` -> true, ``'f'`` -> false, anything else -> NULL."""
    c = _c(c)
    return F.when(c == true, F.lit(True)).when(c == false, F.lit(False))


def flag_to_bit(c: ColumnOrName) -> Column:
    """Boolean to 1/0 (NULL stays NULL)."""
    return _c(c).cast("int")


def date_key(c: ColumnOrName) -> Column:
    """C11/K4: smart key yyyyMMdd as INT."""
    d = _c(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_key(c: ColumnOrName) -> Column:
    """yyyyMM as INT: the partition column of both facts."""
    d = _c(c)
    return (F.year(d) * 100 + F.month(d)).cast("int")


def day_of_week(c: ColumnOrName) -> Column:
    """C14: Monday = 1 ... Sunday = 7."""
    return (F.weekday(_c(c)) + 1).cast("int")


def date_attributes(c: ColumnOrName) -> dict[str, Column]:
    """Every DimDate attribute of a DATE column, by output name.

    ``week_of_year`` is the ISO week, next to the calendar ``year``: 2027-01-01
    is in week 53 of ISO year 2026, so (year, week_of_year) is not a valid
    grouping key across a year boundary."""
    d = _c(c)
    return {
        "date_key": date_key(d),
        "full_date": d,
        "day": F.dayofmonth(d).cast("int"),
        "month": F.month(d).cast("int"),
        "month_name": F.date_format(d, "MMMM"),
        "quarter": F.quarter(d).cast("int"),
        "year": F.year(d).cast("int"),
        "day_name": F.date_format(d, "EEEE"),
        "day_of_week": day_of_week(d),
        "week_of_year": F.weekofyear(d).cast("int"),
        "month_key": month_key(d),
    }


def composite_key(*cols: ColumnOrName, sep: str = "-") -> Column:
    """C17: ``CONCAT(a, '-', b)`` with NULL parts as empty text."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(F.coalesce(_c(c).cast("string"), F.lit("")))
    return F.concat(*parts)
