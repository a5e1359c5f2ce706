"""Rows are equal by their digest exactly when they are equal by content."""

from pyspark.sql import functions as F

from lakeaudit.functions.columns import row_digest
from lakeaudit.operators import audit, profile


def test_digest_tells_rows_apart_like_their_content(spark):
    df = spark.sql("""
      select * from values
        (1, cast(null as int), 0.0D, 'a', array(1, null), map('x', 1, 'y', 2), named_struct('p', 1, 'q', 'z')),
        (cast(null as int), 1, 0.0D, 'a', array(1, null), map('x', 1, 'y', 2), named_struct('p', 1, 'q', 'z')),
        (1, cast(null as int), -0.0D, 'a', array(1, null), map('y', 2, 'x', 1), named_struct('p', 1, 'q', 'z')),
        (1, cast(null as int), double('NaN'), 'a', array(1, null), map('x', 1, 'y', 2), named_struct('p', 1, 'q', 'z')),
        (1, cast(null as int), double('NaN'), 'a', array(1, null), map('x', 1, 'y', 2), named_struct('p', 1, 'q', 'z')),
        (1, cast(null as int), null, 'a', array(null, 1), null, null),
        (1, cast(null as int), null, 'a', array(1, null), null, null),
        (1, cast(null as int), null, '', array(), null, null),
        (1, cast(null as int), null, null, null, null, null)
      as t(i, j, d, s, a, m, n)""")
    groups = sorted(r["n"] for r in df.groupBy(row_digest(df, df.columns)).agg(F.count(F.lit(1)).alias("n")).collect())
    assert groups == [1, 1, 1, 1, 1, 2, 2]
    assert audit.full_row_duplicates(df, "t").first()["duplicate_count"] == 2
    found = profile.table_profile(df, "t").first()
    assert (found.row_count, found.duplicate_full_rows, found.total_missing_cells) == (9, 2, 25)


def test_digest_of_many_columns(spark):
    wide = spark.range(4).select(*[F.when(F.col("id") != i % 4, F.col("id") * 0).alias(f"c{i}") for i in range(130)])
    assert wide.select(row_digest(wide, wide.columns).alias("d")).distinct().count() == 4
