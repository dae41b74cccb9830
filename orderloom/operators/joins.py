"""Left joins that stay balanced when a few keys hold much of the left side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

HOT_SHARE = 1 / 32     # a key with this share of the rows is hot; so at most 32 are
SALTS = 32             # tasks one hot key is spread over
_SKETCH_ITEMS = 4096   # frequency error below 0.1 % of the rows
_SALT, _OWN = "__salt", "__own"


def hot_values(df: DataFrame, columns: Sequence[str]) -> dict[str, list]:
    """Values (NULL included) holding more than `HOT_SHARE` of a column's rows.

    One pass over the named columns with a bounded sketch, so neither a task nor
    the driver holds more than a fixed number of values, whatever the data.
    """
    found = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.expr(f"approx_top_k(`{c}`, {int(2 / HOT_SHARE)}, {_SKETCH_ITEMS})").alias(c)
          for c in columns],
    ).first()
    floor = max(found["rows"] * HOT_SHARE, 1)
    return {c: [hit["item"] for hit in (found[c] or []) if hit["count"] > floor]
            for c in columns}


def _is_hot(key: str, hot: Sequence) -> Column:
    known = [v for v in hot if v is not None]
    test = F.coalesce(F.col(key).isin(known), F.lit(False)) if known else F.lit(False)
    return test | F.col(key).isNull() if len(known) < len(hot) else test


def lookup_known(left: DataFrame, rights: Sequence[DataFrame], key: str) -> DataFrame:
    """Left outer join to each of ``rights`` on a key that repeats in none and may be missing.

    A row without a key meets nothing. It is dealt out by the number of the reading task, as a
    key of the same type where that can be one, so no task gets all such rows.
    """
    kind = left.schema[key].dataType
    spread = F.spark_partition_id().cast("string").try_cast(kind)
    dealt = left.withColumn(_OWN, F.coalesce(key, spread))
    for side in rights:
        found = side.withColumnRenamed(key, "__found")
        dealt = dealt.join(found, (F.col(_OWN) == F.col("__found")) & F.col(key).isNotNull(),
                           "left").drop("__found")
    return dealt.drop(_OWN)


def lookup(left: DataFrame, rights: Sequence[DataFrame], key: str,
           hot: Sequence = ()) -> DataFrame:
    """Left outer join to each of ``rights`` on ``key``.

    Without hot values this is a plain chain of joins. With some, every row gets a salt and the
    join is on key and salt: 0 for most, and for rows of a hot key the number of the reading
    task, which a retried task repeats. Only the right rows of hot keys are repeated once per
    salt. So every row is kept, each side is read once, and no task gets a whole hot key. No
    side is broadcast by hint; Spark does so where it measures a small one.
    """
    if not hot:
        for side in rights:
            left = left.join(side, key, "left")
        return left
    is_hot = _is_hot(key, hot)
    salted = left.withColumn(_SALT, F.when(is_hot, F.spark_partition_id() % SALTS).otherwise(0))
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    for side in rights:
        salted = salted.join(side.withColumn(_SALT, F.explode(salts)), [key, _SALT], "left")
    return salted.drop(_SALT)
