"""Column expressions shared by batch cleaning, the stream and the checks.

All of them are built-in Catalyst expressions, so they stay inside
whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def safe_cast(c: Column | str, type_name: str) -> Column:
    """``try_cast``: text that does not parse becomes NULL instead of
    raising (ANSI mode makes a plain cast fail the whole job)."""
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast(type_name)


def null_safe_true(pred: Column) -> Column:
    """A predicate where NULL counts as false (``coalesce(p, false)``)."""
    return F.coalesce(pred, F.lit(False))


def money_product(amount: Column, quantity: Column) -> Column:
    """``round(amount * quantity, 2)`` computed in decimal arithmetic.

    Rounding the binary double product is not stable at the .xx5 ties; the
    amount to eight decimals times the quantity is exact, and only the
    product is rounded.  An amount that no decimal(27,8) holds (1e19 and
    more, infinite, NaN) has no total: NULL, never an error.
    """
    exact = amount.try_cast("decimal(27,8)") * quantity.cast("decimal(10,0)")
    return F.round(exact, 2).cast("double")


def to_event_time(text: Column) -> Column:
    """ISO-8601 text (with or without offset) -> TIMESTAMP; bad text -> NULL."""
    return F.try_to_timestamp(text)


def hour_of(ts: Column) -> Column:
    """Start of the hour, as a zone-less timestamp (``date_trunc`` returns a
    zoned timestamp even for zone-less input)."""
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def is_valid_event(amount="amount", quantity="quantity", event_time="event_time",
                   ids=("order_id", "customer_id", "product_id")) -> Column:
    """Row validity of an order event, NULL-safe.

    amount > 0 with a total (so finite) AND quantity > 0 AND every id present
    AND an event time present (the landing table requires both).
    """
    a = F.col(amount)
    total = money_product(a, F.col(quantity))
    pred = (a > 0) & total.isNotNull() & (F.col(quantity) > 0) & F.col(event_time).isNotNull()
    for c in ids:
        pred = pred & F.col(c).isNotNull()
    return null_safe_true(pred)


def is_hex_id(c: Column) -> Column:
    """Whether a text is 32 lower-case hexadecimal digits (NULL for NULL)."""
    same = (F.octet_length(c) == 32) & (F.lower(F.hex(F.unhex(c))) == c)
    return F.when(c.isNotNull(), null_safe_true(same))


def packed_id(c: Column) -> Column:
    """Any text as bytes that no other text has, for shuffles: 32 hexadecimal
    digits are the 16 bytes they spell, other texts their UTF-8 bytes, with
    one byte more from 16 on.  Among hexadecimal ids the order is kept."""
    raw = c.cast("binary")
    return F.when(is_hex_id(c), F.unhex(c)).when(F.length(raw) < 16, raw).otherwise(F.concat(raw, F.expr("X'00'")))


def unpacked_id(p: Column) -> Column:
    """The text of :func:`packed_id`."""
    n = F.length(p)
    return (F.when(n == 16, F.lower(F.hex(p))).when(n < 16, p.cast("string"))
             .otherwise(p.substr(F.lit(1), n - 1).cast("string")))


def text_columns(df: DataFrame, columns) -> list[str]:
    """Those of the columns that hold text."""
    types = dict(df.dtypes)
    return [c for c in columns if types[c] == "string"]


def pack_ids(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({c: packed_id(F.col(c)) for c in columns}) if columns else df


def unpack_ids(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({c: unpacked_id(F.col(c)) for c in columns}) if columns else df
