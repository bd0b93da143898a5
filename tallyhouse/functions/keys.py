"""Hash keys over typed columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: text that stands for NULL inside a key
NULL_TEXT = "_dbt_utils_surrogate_key_null_"


def double_text(value: Column) -> Column:
    """Text of a double as a key holds it: plain digits from 1e-4 up to 1e16, else an exponent.

    Spark's own text is the shortest that gives the double back, but turns to an exponent
    outside 1e-3 .. 1e7. The few values out there go through a higher-order function, so
    that moving their digits is no part of the code that runs for every row.
    """
    size = F.abs(value)
    plain = ((size >= 1e-3) & (size < 1e7)) | (value == 0.0)
    rare = F.get(F.transform(F.array(value), _text_without_exponent), F.lit(0))
    return F.when(plain, value.cast("string")).otherwise(rare)


def _text_without_exponent(value: Column) -> Column:
    """The digits of Spark's text moved by its exponent; none is rounded.

    (From 1e16 on Java 17 can write one digit more than the shortest text has.)
    """
    text = value.cast("string")
    short = text.rlike("E")
    mantissa, exponent = F.split_part(text, F.lit("E"), F.lit(1)), F.split_part(text, F.lit("E"), F.lit(2))
    sign = F.when(mantissa.startswith("-"), "-").otherwise("")
    digits = F.rtrim(F.translate(mantissa, "-.", ""), F.lit("0"))
    power = exponent.try_cast("int")
    size = F.length(digits)
    below_one = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    whole = F.concat(digits, F.repeat(F.lit("0"), power + 1 - size), F.lit(".0"))
    split = F.concat(digits.substr(F.lit(1), power + 1), F.lit("."), digits.substr(power + 2, size))
    rest = F.when(size > 1, F.concat(F.lit("."), digits.substr(F.lit(2), size))).otherwise("")
    with_exponent = F.concat(
        digits.substr(F.lit(1), F.lit(1)),
        rest,
        F.when(power < 0, "e-").otherwise("e+"),
        F.lpad(F.abs(power).cast("string"), F.greatest(F.length(F.abs(power).cast("string")), F.lit(2)), F.lit("0")),
    )
    moved = (
        F.when((power < -4) | (power > 15), with_exponent)
        .when(power < 0, below_one)
        .when(size <= power + 1, whole)
        .otherwise(split)
    )
    # the fixed words of what is no finite number
    odd = F.when(F.isnan(value), "nan").when(text == "Infinity", "inf").when(text == "-Infinity", "-inf")
    return F.coalesce(odd, F.when(short, F.concat(sign, moved)).otherwise(text))


def surrogate_key(*fields: Column) -> Column:
    """md5 over the text of the fields joined by a dash; NULL takes part as a fixed text."""
    texts = [F.coalesce(field.cast("string"), F.lit(NULL_TEXT)) for field in fields]
    return F.md5(F.concat_ws("-", *texts))


def packed_key(value: Column) -> Column:
    """The text of a key as bytes; the digits of a hash take half of their room. The first byte tells the two apart."""
    text = value.cast("string")
    digits = text.rlike(r"\A[0-9a-f]{32}\z")
    hashed = F.concat(F.lit(b"\x01"), F.unhex(text))
    return F.when(digits, hashed).otherwise(F.concat(F.lit(b"\x00"), text.cast("binary")))


def unpacked_key(packed: Column) -> Column:
    """The text that :func:`packed_key` packed."""
    rest = F.substring(packed, 2, 2**31 - 1)
    return F.when(F.substring(packed, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))
