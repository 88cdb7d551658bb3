"""Catalog tables over paths that hold rows already."""

import pytest

from portrisk.sources.tables import create_or_append


@pytest.mark.parametrize("partition_by", [None, "day"])
def test_rows_of_a_path_without_a_table_are_kept(spark, tmp_path, rows, partition_by):
    path, table = f"{tmp_path}/t", f"kept_{partition_by or 'flat'}"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    writer = spark.createDataFrame([(i, f"2024-01-0{i}") for i in range(1, 6)], "id long, day string").write
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    create_or_append(spark.createDataFrame([(9, "2024-01-09")], "id long, day string"), table, path, partition_by)
    assert [r[0] for r in rows(spark.table(table), "id")] == [1, 2, 3, 4, 5, 9]
    spark.sql(f"DROP TABLE {table}")
