"""Response bodies of a price service, reshaped to rows of the raw zone.

Bodies are parsed to text elements, each of which is then cast by itself: a damaged number costs its own
field only. A body that holds no rows for another reason than being empty leaves one row without a key, with its text
and the reason, which bronze sets aside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barmart.schemas import MALFORMED, MARKET_PAYLOAD, OHLC_PAYLOAD

REASON, BODY = "_body_reason", "_body"
UNREADABLE, NO_ARRAYS = "unreadable_body", "body_without_arrays"
TROUBLE = [REASON, BODY, "length_mismatch"]


# A cast that fails costs an exception, even a tried one, so only what can be cast is. The forms are those a cast accepts.
WHOLE = r"^-?[0-9]{1,18}$"
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,3})?\s*$|^\s*([nN][aA][nN]|[+-]?[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"
LONGS = 9.2e18


def _number(value: Column) -> Column:
    return F.when(value.rlike(NUMBER), value.try_cast("double"))


def _millis(value: Column) -> Column:
    """Whole milliseconds, also where they are written as 1.7e12 or 1700000000000.0."""
    number = _number(value)
    return F.when(value.rlike(WHOLE), value.try_cast("long")).when(number.between(-LONGS, LONGS), number.try_cast("long"))


def _trouble(reason: Column, payload: str) -> list[Column]:
    return [reason.alias(REASON), F.when(reason.isNotNull(), F.col(payload)).alias(BODY)]


def flatten_ohlc(df: DataFrame, keep: list[str], payload: str = "payload") -> DataFrame:
    """``[[ms, open, high, low, close], ...]`` to one row per inner array; a missing or damaged element is null.

    A body that isn't such an array yields one row without a key, with its text and the reason.
    """
    body = F.col("body")
    parsed = df.select(*keep, payload, F.from_json(payload, OHLC_PAYLOAD).alias("body"))
    listed = F.col(payload).rlike(r"^\s*\[")
    reason = F.when(body.isNull() | ~F.coalesce(listed, F.lit(False)), F.lit(UNREADABLE))
    none = F.array(F.lit(None).cast(OHLC_PAYLOAD.elementType))
    bars = parsed.select(*keep, *_trouble(reason, payload), F.explode(F.when(reason.isNull(), body).otherwise(none)).alias("bar"))
    bar = F.col("bar")
    prices = [_number(F.get(bar, F.lit(i))).alias(name) for i, name in enumerate(("open", "high", "low", "close"), 1)]
    return bars.select(*keep, _millis(F.get(bar, F.lit(0))).alias("timestamp_ms"), *prices, REASON, BODY)


def zip_market(df: DataFrame, keep: list[str], payload: str = "payload") -> DataFrame:
    """Three parallel arrays of ``[ms, value]`` to rows, up to the shortest of the three.

    The time comes from the prices. ``length_mismatch`` tells whether elements were left
    over. A body that is unreadable, lacks an array, or whose shortest array is empty while another is not, yields
    one row without a key, with its text and the reason.
    """
    names = MARKET_PAYLOAD.fieldNames()
    readable = T.StructType([*MARKET_PAYLOAD.fields, T.StructField(MALFORMED, T.StringType())])
    nothing = F.array().cast(MARKET_PAYLOAD[names[0]].dataType)
    parsed = df.select(*keep, payload, F.from_json(payload, readable).alias("body"))
    damaged = F.col("body").isNull() | F.col("body")[MALFORMED].isNotNull()
    absent = F.lit(False)
    for name in names:
        absent = absent | F.col("body")[name].isNull()
    held = parsed.select(
        *keep, payload, damaged.alias("damaged"), absent.alias("absent"), *[F.coalesce(F.col("body")[n], nothing).alias(n) for n in names]
    )
    sizes = [F.size(n) for n in names]
    shortest, uneven = F.least(*sizes), F.least(*sizes) != F.greatest(*sizes)
    reason = (
        F.when(F.col("damaged"), F.lit(UNREADABLE))
        .when(F.col("absent"), F.lit(NO_ARRAYS))
        .when((shortest == 0) & uneven, F.lit("empty_array"))
    )
    points = F.arrays_zip(*[F.slice(n, F.lit(1), shortest).alias(n) for n in names])
    no_point = F.array(F.struct(*[F.lit(None).cast(MARKET_PAYLOAD[n].dataType.elementType).alias(n) for n in names]))
    cut = held.select(
        *keep,
        *_trouble(reason, payload),
        uneven.alias("length_mismatch"),
        F.explode(F.when(reason.isNull(), points).otherwise(no_point)).alias("point"),
    )

    def element(name: str, index: int) -> Column:
        return F.get(F.col("point")[name], F.lit(index))

    return cut.select(
        *keep,
        _millis(element("prices", 0)).alias("timestamp_ms"),
        _number(element("prices", 1)).alias("price_usd"),
        _number(element("market_caps", 1)).alias("market_cap_usd"),
        _number(element("total_volumes", 1)).alias("total_volume_usd"),
        "length_mismatch",
        REASON,
        BODY,
    )
