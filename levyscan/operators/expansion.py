"""Growing and changing tables in a repeatable way.

Choices hang on a salted hash of the row key, not on a seeded generator: the result does
not depend on the partition layout, and two uses with different salts are independent.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levyscan.functions.scalars import hash_fraction, hash_number, padded_id
from levyscan.operators.keyed import lookup_join
from levyscan.operators.ordering import number_rows, sample_rows
from levyscan.operators.setops import append_by_position


def repeat_rows(df: DataFrame, times: int, name: str = "copy") -> DataFrame:
    """Each row `times` times, with the copy number: row-local, no join."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(times - 1))))


def expand_rows(
    df: DataFrame, target: int, order: list[str], id_column: str, prefix: str, width: int
) -> DataFrame:
    """Repeat the table until it has `target` rows and give every row a new id.

    Row i of n gets the numbers i, i+n, i+2n, ...; those above the target are left out. The
    output starts from the numbers 1 to `target`, dealt over many tasks, and looks its rows up.
    """
    numbered = number_rows(df, order, "_nth")
    n = numbered.count()
    if not n:
        return numbered.drop("_nth")
    numbers = df.sparkSession.range(1, target + 1).withColumnRenamed("id", "_new")
    placed = numbers.withColumn("_nth", F.pmod(F.col("_new") - 1, F.lit(n)) + 1)
    grown = lookup_join(placed, numbered, ["_nth"], ["_new"])
    return grown.withColumn(id_column, padded_id(prefix, F.col("_new"), width)).select(*df.columns)


def assign_key(
    df: DataFrame, lookup: DataFrame, key: str, row_key: str, salt: str
) -> DataFrame:
    """Spread rows evenly over the keys of a lookup table."""
    numbered = number_rows(lookup.select(key).distinct(), [key], "_nth")
    n = numbered.count()
    drawn = df.drop(key).withColumn("_nth", hash_number(salt, F.col(row_key)) % n + 1)
    return lookup_join(drawn, numbered, ["_nth"], [row_key]).drop("_nth")


def positional_join(
    left: DataFrame, left_order: list[str], right: DataFrame, right_order: list[str], how: str = "inner"
) -> DataFrame:
    """Row i of the left table with row i of the right one, each in its own order."""
    a = number_rows(left, left_order, "position")
    b = number_rows(right, right_order, "position")
    return a.join(b, "position", how)


def perturb(
    df: DataFrame, column: str, rate: float, change: Column, salt: str, key: str
) -> DataFrame:
    """Rewrite a column on a share of the rows."""
    hit = hash_fraction(salt, F.col(key)) < rate
    return df.withColumn(column, F.when(hit, change).otherwise(F.col(column)))


def duplicate_rows(df: DataFrame, n: int, salt: str, key: str) -> DataFrame:
    """Append exact copies of n rows."""
    return append_by_position(df, sample_rows(df, n, salt, key))


