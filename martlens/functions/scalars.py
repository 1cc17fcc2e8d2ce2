"""Column expressions shared by the operators.  All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

# What counts as white space in Python's str.strip and in \s on text.
SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

Name = Column | str

#: Seconds since 1970 at the end of the year 9999.
LAST_SECOND = 253_402_300_800


def col(c: Name) -> Column:
    return F.col(c) if isinstance(c, str) else c


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column so that it is evaluated a single time per row.

    Spark pushes a filter on a computed column below the projection and then computes the value
    for the filter and again for the result.  It does not push filters through a generator.
    """
    return df.withColumn(name, F.explode(F.array(value)))


def strip(c: Name) -> Column:
    """Remove white space of any kind from both ends."""
    return F.regexp_replace(col(c), f"^{SPACE}+|{SPACE}+$", "")


def is_blank(c: Name) -> Column:
    return F.coalesce(strip(c), F.lit("")) == ""


def blank_to_null(c: Name) -> Column:
    return F.nullif(col(c), F.lit(""))


def is_truthy(c: Name, dtype: T.DataType) -> Column:
    """Python truthiness of a value: null, zero, empty text and empty list are false."""
    c = col(c)
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        test = F.size(c) > 0
    elif isinstance(dtype, T.BooleanType):
        test = c
    elif isinstance(dtype, T.NumericType):
        test = c != 0
    elif isinstance(dtype, T.StringType):
        test = c != ""
    else:
        test = c.isNotNull()
    return F.coalesce(test, F.lit(False))


def strip_html(c: Name) -> Column:
    """Drop tags, collapse white space to one blank, trim; null becomes ''."""
    no_tags = F.regexp_replace(F.coalesce(col(c), F.lit("")), "<[^>]+>", "")
    return F.trim(F.regexp_replace(no_tags, f"{SPACE}+", " "))


def preview(c: Name, n: int) -> Column:
    return F.left(col(c), F.lit(n))


def path_tail_int(c: Name) -> Column:
    """Last segment of a '/'-separated path as an int; null when it is not a number."""
    last = F.try_element_at(F.split(col(c), "/"), F.lit(-1))
    return strip(last).try_cast("int")


def page_from_note(c: Name) -> Column:
    """The page number in a note such as 'Last page: 12'; null when there is none."""
    return F.regexp_extract(col(c), r"Last page: (\d+)", 1).try_cast("int")


def id_list(c: Name) -> Column:
    """'1, 2,3' to an array of long ids."""
    return F.transform(F.split(col(c), ","), lambda x: F.trim(x).cast("bigint"))


def moment(c: Name, fallback: Column) -> Column:
    """Text holding epoch seconds or an ISO-8601 time to a UTC timestamp; past the year 9999 it is no time."""
    text = col(c)
    seconds = text.try_cast("double")
    epoch = F.when(F.abs(seconds) < LAST_SECOND, F.timestamp_seconds(seconds))
    iso = text.try_cast("timestamp")
    numeric = text.rlike(r"^-?\d+(\.\d+)?$")
    return F.coalesce(F.when(numeric, epoch).otherwise(iso), fallback)


def iso_text(c: Name) -> Column:
    """Timestamp to ISO text; microseconds are written only when there are any."""
    c = col(c)
    whole = F.date_trunc("second", c) == c
    return F.when(whole, F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(
        F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )


def minute_text(c: Name) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd HH:mm")


def hour_of(c: Name) -> Column:
    return F.date_trunc("hour", col(c))


def seconds_between(start: Name, end: Name) -> Column:
    return F.unix_micros(col(end).cast("timestamp")) / 1e6 - F.unix_micros(
        col(start).cast("timestamp")
    ) / 1e6


def ratio(part: Column, whole: Column, scale: int = 2, times: int = 100) -> Column:
    """part * times / whole as a double rounded to `scale`; null when whole is 0."""
    return F.round(
        part.cast("double") * F.lit(float(times)) / F.nullif(whole.cast("double"), F.lit(0.0)),
        scale,
    )


def mean(total: Column, n: Column, scale: int = 4) -> Column:
    """Exact decimal total divided once, as a rounded double."""
    return F.round(total.cast("double") / F.nullif(n.cast("double"), F.lit(0.0)), scale)


def name_id(c: Name) -> Column:
    """A stable id below 10^9 made from a name, the same on every run and machine."""
    head = F.substring(F.md5(col(c).cast("binary")), 1, 8)
    return F.conv(head, 16, 10).cast("bigint") % F.lit(1_000_000_000)


def words(c: Name, min_length: int = 1) -> Column:
    """Lower-case words of a text in order: runs of at least `min_length` letters."""
    text = F.lower(F.coalesce(col(c), F.lit("")))
    return F.regexp_extract_all(text, F.lit(rf"\p{{L}}{{{min_length},}}"), F.lit(0))


def count_words(c: Name, wanted: Iterable[str]) -> Column:
    """How many of a text's words are among `wanted`, without building the list of words."""
    if any(not w.isalpha() for w in wanted):
        raise ValueError("words must consist of letters")
    one_of = "|".join(sorted(wanted))
    text = F.lower(F.coalesce(col(c), F.lit("")))
    return F.regexp_count(text, F.lit(rf"(?<!\p{{L}})(?:{one_of})(?!\p{{L}})"))


def word_balance(c: Name, plus: Iterable[str], minus: Iterable[str]) -> Column:
    """How many more of a text's words are among `plus` than among `minus`, in one scan of the text."""
    plus, minus = sorted(set(plus)), sorted(set(minus))
    wanted = sorted({*plus, *minus})
    if any(not w.isalpha() for w in wanted):
        raise ValueError("words must consist of letters")
    if not wanted:
        return F.lit(0)
    # most words are passed over by their first letter
    first = "".join(sorted({w[0] for w in wanted}))
    text = F.lower(F.coalesce(col(c), F.lit("")))
    found = F.regexp_extract_all(text, F.lit(rf"(?<!\p{{L}})(?=[{first}])(?:{'|'.join(wanted)})(?!\p{{L}})"), F.lit(0))
    among = lambda ws, side: F.size(F.filter(ws, lambda w: w.isin(side))) if side else F.lit(0)
    return let(found, lambda ws: among(ws, plus) - among(ws, minus))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it in `body`; a lambda would evaluate it per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def softmax(scores: Column) -> Column:
    """Softmax over an array of numbers, shifted by the maximum so exp cannot overflow."""

    def normalised(exps: Column) -> Column:
        total = F.aggregate(exps, F.lit(0.0), lambda acc, x: acc + x)
        return let(total, lambda t: F.transform(exps, lambda x: x / t))

    shifted = lambda top: F.transform(scores, lambda x: F.exp((x - top).cast("double")))
    return let(F.array_max(scores), lambda top: let(shifted(top), normalised))


def argmax(scores: Column) -> Column:
    """0-based position of the first maximum."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")
