"""The registered queries against their SQL twins on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from portrisk.registry import QUERIES
from tools.check_queries import TABLES, table_of

SF = "/root/testdata/sf0.001"
CHECKED = (
    "a04_row_width_audit", "a05_coerce_types", "a15_advance_control", "a16_upsert", "b04_parse_tone",
    "b09_weight_news", "b12_geodesic_km", "f04_drop_emotional", "g01_weighted_report", "g02_theme_growth_base",
    "g06_daily_goldstein", "j01_label_cameo", "j03_densify", "j06_attach_pages", "s02_preview", "t02_feature_frame",
    "t05_extract_paragraphs", "w01_rank_negative_ranges", "w02_top_themes",
)


def test_every_statement_belongs_to_a_query():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries)
    # only fitted models have no statement
    assert {n for n in QUERIES if n not in oracles} == {
        "t03_fit_forecaster", "t03_score", "t03_model_mae", "t04_next_day_news_model", "e3_daily_predictions",
    }


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    import duckdb

    connection = duckdb.connect()
    connection.sql("set timezone='UTC'")
    for table in TABLES:
        connection.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_statement(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cursor = duck.execute(entry.oracle_sql()[name])
    assert table_of(df.columns, df.collect()) == table_of([c[0] for c in cursor.description], cursor.fetchall())


def test_entry_has_rows(spark, duck):
    assert entry.entry(spark).count() > 0


def test_daily_predictions_are_of_the_day_and_complete(spark, duck):
    """Only the days asked for are stored, and the figure moved on from the day before is there."""
    got = entry.queries()["e3_daily_predictions"](spark, SF).collect()
    assert got and {str(r.Date) for r in got} == {"2024-01-29", "2024-01-30"}
    assert len({(r.profile, r.Date) for r in got}) == len(got)
    assert all(r.NextDayNewsPredAdjusted is not None and r.NextDayNegativeNewsPredictions is not None for r in got)
