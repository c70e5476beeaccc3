"""Conversions between provider text and values."""

from __future__ import annotations

import re
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidebook.functions import workers

#: What counts as a number's text. It keeps out forms that try_cast alone would take, such as 1d.
NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"
BLANKS = r"[\s\x1c-\x1f\x85   -     　]"


def try_double(text: Column) -> Column:
    """A number's text as double, else null; ``nan`` and ``inf`` are numbers."""
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def _format6(values: pd.Series) -> pd.Series:
    # of functions on iterators Spark would give each column a Python worker of its own in every task; these share one
    return values.map(lambda x: f"{x:.6f}".rstrip("0").rstrip("."))


def number_text(value: Column) -> Column:
    """A double with at most six decimals and no trailing zeros; null is the empty text, which pandas can't tell from NaN."""
    workers.ship()
    return F.when(value.isNull(), F.lit("")).otherwise(F.pandas_udf(_format6, "string")(value))


def strip(text: Column) -> Column:
    """Text without white space of any kind at its ends."""
    return F.regexp_replace(F.regexp_replace(text, f"^{BLANKS}+", ""), f"{BLANKS}+$", "")


def normal_symbol(text: Column) -> Column:
    return F.upper(strip(text))


def archive_name(symbol: Column, iso: Column) -> Column:
    """The name of a payload's own file: the symbol with / as _, and the time without its marks."""
    return F.concat(F.replace(symbol, F.lit("/"), F.lit("_")), F.lit("_"), F.translate(iso, ":-", ""), F.lit(".json"))


def iso_z(at: Column) -> Column:
    """A timestamp as ISO text of UTC to the second."""
    return F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def epoch_iso(text: Column) -> Column:
    """Epoch seconds (digits, or a number cut to a whole one) as ISO text; what is no number is empty."""
    whole = F.coalesce(F.when(text.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(text).try_cast("bigint")))
    return F.coalesce(iso_z(F.timestamp_seconds(whole)), F.lit(""))


# --- fields of JSON objects -----------------------------------------------------


def field(item: Column, name: str) -> Column:
    """A member of a variant object as a variant; null if it is missing."""
    return F.try_variant_get(item, f"$['{re.sub(chr(39), '', name)}']", "variant")


def is_object(item: Column) -> Column:
    return F.coalesce(F.schema_of_variant(item).startswith("OBJECT"), F.lit(False))


def is_list(item: Column) -> Column:
    return F.coalesce(F.schema_of_variant(item).startswith("ARRAY"), F.lit(False))


def py_text(item: Column, name: str) -> Column:
    """A member as the text that dynamic languages give it: missing is empty, null is None, booleans are True and False.

    Objects and lists come as JSON.
    """
    member = field(item, name)
    plain = F.try_variant_get(member, "$", "string")
    return (
        F.when(member.isNull(), F.lit(""))
        .when(F.is_variant_null(member), F.lit("None"))
        .when(F.schema_of_variant(member) == "BOOLEAN", F.initcap(plain))
        .when(F.schema_of_variant(member).rlike("^(DECIMAL|DOUBLE|FLOAT)"), float_text(plain))
        .otherwise(plain)
    )


def float_text(plain: Column) -> Column:
    """A JSON number with a fraction or exponent as the shortest text of the double it stands for."""
    value = plain.try_cast("double").cast("string")
    # Java writes 1.0E20 and 1.0E-5 where the shortest text is 1e+20 and 1e-05
    exponent = F.regexp_extract(value, r"E(-?\d+)$", 1).try_cast("int")
    digits = F.regexp_replace(F.regexp_extract(value, r"^(-?[\d.]+)E", 1), r"\.0$", "")
    signed = F.concat(F.when(exponent < 0, "-").otherwise("+"), F.lpad(F.abs(exponent).cast("string"), F.greatest(F.lit(2), F.length(F.abs(exponent).cast("string"))), F.lit("0")))
    return (
        F.when(~value.contains("E"), value)
        .when((exponent >= -4) & (exponent < 16), F.regexp_replace(F.regexp_replace(value.try_cast("decimal(38,19)").cast("string"), r"0+$", ""), r"\.$", ".0"))
        .otherwise(F.concat(digits, F.lit("e"), signed))
    )


def said(item: Column, name: str) -> Column:
    """A member for an error's text: null if it is missing or says nothing (an empty text, list or object, null, false, 0).

    What it says is judged by its type: the texts "0" and "None" say something.
    """
    text, member = py_text(item, name), field(item, name)
    a_text = F.schema_of_variant(member) == "STRING"
    nothing = text.isin("", "None", "False", "0", "0.0", "-0.0", "[]", "{}")
    return F.when(F.when(a_text, text != "").otherwise(~nothing), text)
