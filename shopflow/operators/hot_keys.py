"""Joins with a few very frequent keys.

Every task counts keys in a summary of a fixed number of counters and the
summaries are merged (``approx_top_k``, a frequent-items sketch), so finding
the keys that hold a large share of the rows costs one pass without a
shuffle of rows, and its result is small whatever the data.  Rows of such a
key are then spread over ``salts`` join keys and its partner rows repeated
for each of them; all other rows are joined as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARE = 0.01        # of all rows, from which on a key counts as hot
COUNTERS = 10_000   # of a task's summary: a count is off by about 1 in 7,500 rows at most
SALTS = 64


def hot_keys(df: DataFrame, key: str, share: float = SHARE, counters: int = COUNTERS) -> list:
    """The values of ``key`` that at least ``share`` of the rows carry, most
    frequent first; at most 1 / ``share`` values reach the driver.  A value
    near the bound may go either way: it is a matter of speed, not of results.
    """
    most = max(1, int(1 / share))
    there = df.where(F.col(key).isNotNull())
    top, n = there.agg(F.expr(f"approx_top_k(`{key}`, {most}, {counters})"), F.count(F.lit(1))).first()
    return [r["item"] for r in top or [] if r["count"] >= share * n]


def salted_join(rows: DataFrame, partners: DataFrame, key: str, hot: list, salts: int = SALTS) -> DataFrame:
    """``rows`` inner-join ``partners`` on ``key``, where the rows of the
    ``hot`` keys are spread.  ``partners`` should hold few rows of one key.

    A row's salt is a hash of the whole row, so a task that runs again deals
    its rows as before."""
    if not hot:
        return rows.join(partners, key, "inner")
    is_hot = F.col(key).isin(list(hot))
    spread = rows.withColumn("salt__", F.when(is_hot, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(salts)))
                             .otherwise(F.lit(0)).cast("int"))
    each = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeated = partners.withColumn("salt__", F.explode(each))
    return spread.join(repeated, [key, "salt__"], "inner").drop("salt__")
