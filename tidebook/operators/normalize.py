"""Provider payloads (JSON text) to rows.

Each function takes a DataFrame with a ``payload`` column and returns a row per item, with the
columns in ``keep`` carried along and ``pos``, the item's place in its payload. Payloads that are
no such list give no rows; what they say instead is in ``payload_errors``. All fields are text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.functions import casts

SERIES = "Time Series (Daily)"
#: Names of the fields in a keyed series.
SERIES_FIELDS = {"open": "1. open", "high": "2. high", "low": "3. low", "close": "4. close", "volume": "5. volume"}


#: What is said of a payload that can't be parsed, be it none of JSON or, by its parts' sizes, beyond Spark's variants.
UNREADABLE = "not JSON"


#: Spark's setting by which, of members of one name in an object, the last counts instead of none of the payload.
LAST_OF_A_NAME = "spark.sql.variant.allowDuplicateKeys"


def _allow_repeated_names(payloads: DataFrame) -> None:
    payloads.sparkSession.conf.set(LAST_OF_A_NAME, "true")


def _json(payload: Column) -> Column:
    """The payload as a variant; null, and so no rows, for one that ``payload_errors`` says can't be read."""
    return F.try_parse_json(payload)


def _items(payloads: DataFrame, keep: list[str], items: Column) -> DataFrame:
    """(keep, pos, item) of the objects in a list of variants."""
    _allow_repeated_names(payloads)
    rows = payloads.select(*keep, _json(F.col("payload")).alias("__json"))
    rows = rows.select(*keep, F.posexplode(items).alias("pos", "item"))
    return rows.where(casts.is_object(F.col("item")))


def _list(path: str) -> Column:
    return F.when(casts.is_list(F.try_variant_get("__json", path, "variant")), F.try_variant_get("__json", path, "array<variant>"))


def bar_list(payloads: DataFrame, keep: list[str]) -> DataFrame:
    """Price bars from a list of objects under "values"; those with an empty time are left out."""
    rows = _items(payloads, keep, _list("$.values"))
    names = {"date": "datetime", **{c: c for c in ("open", "high", "low", "close", "volume")}}
    rows = rows.select(*keep, "pos", *[casts.py_text(F.col("item"), n).alias(c) for c, n in names.items()])
    return rows.where("date <> ''")


def bar_map(payloads: DataFrame, keep: list[str]) -> DataFrame:
    """Price bars from an object keyed by date, where the payload says nothing else."""
    _allow_repeated_names(payloads)
    rows = payloads.select(*keep, _json(F.col("payload")).alias("__json")).where(bar_map_error(F.col("__json")).isNull())
    series = F.try_variant_get("__json", f"$['{SERIES}']", "map<string,variant>")
    rows = rows.select(*keep, F.posexplode(series).alias("pos", "date", "item")).where(casts.is_object(F.col("item")))
    return rows.select(*keep, "pos", "date", *[casts.py_text(F.col("item"), n).alias(c) for c, n in SERIES_FIELDS.items()])


def macro(payloads: DataFrame, keep: list[str]) -> DataFrame:
    """Observations from a list of objects under "observations"; those with an empty date are left out."""
    rows = _items(payloads, keep, _list("$.observations"))
    rows = rows.select(*keep, "pos", *[casts.py_text(F.col("item"), c).alias(c) for c in ("date", "value", "realtime_start", "realtime_end")])
    return rows.where("date <> ''")


def news(payloads: DataFrame, keep: list[str]) -> DataFrame:
    """News from a payload that is a list of objects; items without an id are still there."""
    rows = _items(payloads, keep, _list("$"))
    # numbers are cut to whole seconds, booleans count as 0 and 1, other values have no time
    at = casts.field(F.col("item"), "datetime")
    seconds = F.when(F.schema_of_variant(at).rlike("^(DECIMAL|DOUBLE|FLOAT)"), F.try_variant_get(at, "$", "double").try_cast("bigint").cast("string")).otherwise(
        F.when(F.schema_of_variant(at) == "BOOLEAN", F.try_variant_get(at, "$", "boolean").cast("int").cast("string")).otherwise(F.try_variant_get(at, "$", "string"))
    )
    iso = casts.epoch_iso(seconds)
    texts = [casts.py_text(F.col("item"), c).alias(c) for c in ("headline", "source", "summary", "url", "image", "category")]
    return rows.select(*keep, "pos", casts.py_text(F.col("item"), "id").alias("id"), iso.alias("datetime"), F.substring(iso, 1, 10).alias("date"), *texts)


def listed(payloads: DataFrame, keep: list[str]) -> DataFrame:
    """The normalized symbols of exchange listings, item by item."""
    _allow_repeated_names(payloads)
    rows = payloads.select(*keep, _json(F.col("payload")).alias("__json")).where(listing_error(F.col("__json")).isNull())
    rows = rows.select(*keep, F.posexplode(_list("$.data")).alias("pos", "item")).where(casts.is_object(F.col("item")))
    symbol = casts.normal_symbol(casts.said(F.col("item"), "symbol"))
    return rows.select(*keep, "pos", symbol.alias("symbol")).where("symbol <> ''")


def listing(payloads: DataFrame) -> DataFrame:
    """The distinct normalized symbols of exchange listings, in order."""
    return listed(payloads, []).select("symbol").distinct().orderBy("symbol")


def news_envelopes(bronze: DataFrame) -> DataFrame:
    """key, seq and envelope: archived news with the symbol and the days that were asked for, as one JSON object."""
    _allow_repeated_names(bronze)
    items = F.struct(F.col("key").alias("symbol"), F.col("asked_from").alias("from"), F.col("asked_to").alias("to"), _json(F.col("payload")).alias("items"))
    return bronze.select("key", "seq", F.to_json(items).alias("envelope"))


# --- errors ---------------------------------------------------------------------


def bar_list_error(json: Column) -> Column:
    chosen = F.coalesce(casts.said(json, "message"), casts.said(json, "status"), F.lit("missing values"))
    return F.when(~casts.is_list(casts.field(json, "values")), chosen)


def bar_map_error(json: Column) -> Column:
    out = F.when(casts.is_object(casts.field(json, SERIES)), F.lit(None).cast("string")).otherwise(F.lit("missing series"))
    for name in ("Error Message", "Information", "Note"):
        out = F.when(casts.field(json, name).isNotNull(), casts.py_text(json, name)).otherwise(out)
    return out


def macro_error(json: Column) -> Column:
    chosen = F.coalesce(casts.said(json, "error_message"), casts.said(json, "message"), F.lit("missing observations"))
    return F.when(~casts.is_list(casts.field(json, "observations")), chosen)


def news_error(json: Column) -> Column:
    chosen = F.coalesce(casts.said(json, "error"), casts.said(json, "message"), F.lit("unexpected object response"))
    return F.when(casts.is_object(json), chosen).when(~casts.is_list(json), F.lit("not a list"))


def listing_error(json: Column) -> Column:
    chosen = F.coalesce(casts.said(json, "message"), casts.said(json, "code"), F.lit("unknown error"))
    return F.when(casts.py_text(json, "status") == "error", chosen).when(~casts.is_list(casts.field(json, "data")), F.lit("missing data list"))


ERRORS = {"bar_list": bar_list_error, "bar_map": bar_map_error, "macro": macro_error, "news": news_error, "listing": listing_error}


def payload_errors(payloads: DataFrame, kind: str, keep: list[str]) -> DataFrame:
    """(keep, error, rate_limited) of every payload: what it says instead of rows, null if nothing."""
    _allow_repeated_names(payloads)
    rows = payloads.select(*keep, _json(F.col("payload")).alias("__json"))
    error = F.when(F.col("__json").isNull(), F.lit(UNREADABLE)).otherwise(ERRORS[kind](F.col("__json")))
    rows = rows.select(*keep, error.alias("error"))
    return rows.withColumn("rate_limited", F.coalesce(F.lower("error").contains("rate limit"), F.lit(False)))


ROWS = {"bar_list": bar_list, "bar_map": bar_map, "macro": macro, "news": news, "listing": listed}


def collect_results(payloads: DataFrame, kind: str, keep: list[str]) -> DataFrame:
    """(keep, status, rows, error): done with its rows, or failed.

    A payload of prices or observations without a row has failed; news may be empty.
    """
    counted = ROWS[kind](payloads, keep).groupBy(*keep).agg(F.count(F.lit(1)).alias("rows"))
    errors = payload_errors(payloads, kind, keep)
    joined = errors.join(counted, keep, "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    none = F.lit("no rows") if kind != "news" else F.lit(None).cast("string")
    error = F.coalesce("error", F.when(F.col("rows") == 0, none))
    return joined.select(*keep, F.when(error.isNull(), "done").otherwise("failed").alias("status"), "rows", error.alias("error"))
