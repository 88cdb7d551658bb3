"""Embedded fields, flags, weights and filters on literal rows."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from portrisk import profiles as P
from portrisk.functions import parse, themes
from portrisk.operators import aggregates, filters, ranking, windows
from portrisk.plans.report import route_news, scored_news, theme_grid, weighted_report
from tests.conftest import plan_of

GKG = "DATE int, NUMARTS int, THEMES string, LOCATIONS string, TONE string, CAMEOEVENTIDS string, SOURCEURLS string"


def news(spark, *rows):
    base = dict(
        DATE=20240101, NUMARTS=1, THEMES="PORT;TRANSPORT;", LOCATIONS="4#P#CA#CA02#1#2#F;1#O#US#USCA#0#0#X",
        TONE="-2.0,1.0,3.0,4.0,5", CAMEOEVENTIDS="1", SOURCEURLS="u",
    )
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], GKG)


def test_session_is_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_first_location_block_and_short_fields(spark):
    got = parse.parse_news(
        news(spark, {}, {"LOCATIONS": "nan"}, {"LOCATIONS": None}, {"TONE": "bad,,1", "DATE": 20241340})
    ).collect()
    assert (got[0].CountryCode, got[0].LocationCode) == ("CA", "CA02")
    assert got[1].LocationCode is None and got[2].LocationCode is None
    assert got[1].is_ruta_transpacifica == 0
    assert (got[3].AverageTone, got[3].TonePositiveScore, got[3].ToneNegativeScore, got[3].Polarity) == (None, None, 1.0, None)
    assert got[3].Date is None and got[0].Date == dt.date(2024, 1, 1)
    assert "DATE" not in got[0].asDict()


def test_location_on_both_routes(spark):
    row = parse.parse_news(news(spark, {"LOCATIONS": "4#P#CA#CA10#"})).first()
    assert (row.is_ruta_transpacifica, row.is_ruta_transatlantica, row.is_ruta_del_cabo_de_buena_esperanza) == (1, 1, 0)
    assert "CA10" in P.TRANS_PACIFIC and "CA10" in P.TRANS_ATLANTIC
    assert len(P.all_route_locations()) == 19


def test_tone_is_compared_as_number(spark):
    """A tone between -1 and 0 is negative, and 10.5 exceeds 9.5."""
    df = parse.parse_tone(news(spark, {"TONE": "-0.3,0,9.5,1"}, {"TONE": "-0.3,0,10.5,1"}))
    assert filters.negative_only(df).count() == 2
    assert df.agg(F.max("ToneNegativeScore")).first()[0] == 10.5


@pytest.mark.parametrize(
    "tone,kept",
    [("0.4,0,0,9.0", False), ("-0.5,0,0,9.0", False), ("0.5,0,0,8.99", True), ("0.51,0,0,20", True),
     ("x,0,0,20", True), ("0.1,0,0,x", True)],
)
def test_emotional_news(spark, tone, kept):
    df = filters.drop_emotional(parse.parse_tone(news(spark, {"TONE": tone})))
    assert (df.count() == 1) is kept


@pytest.mark.parametrize(
    "words,broad,strict",
    [("EXPORT;", True, False), ("MARITIME;", True, False), ("PORT;TRANSPORT;AIRPORT;", False, False),
     ("WB_135_TRANSPORT;", True, True), ("NAVAL_PORT;TRADE;", True, False), ("TRADE;", False, False), (None, False, False)],
)
def test_port_filters(spark, words, broad, strict):
    df = news(spark, {"THEMES": words})
    assert (filters.port_themes_broad(df).count() == 1) is broad
    assert (filters.port_themes_strict(df).count() == 1) is strict


def test_theme_is_literal_not_a_pattern(spark):
    row = themes.theme_flags(news(spark, {"THEMES": "MARITIMEXDISASTER"}), P.DISRUPTION_THEMES, None).first()
    assert row.NewsAboutMaritimeDisaster == 0
    assert themes.theme_flags(news(spark, {"THEMES": None})).first().Total == 0


def test_weight_branches(spark):
    rows = [(5, 2), (5, 3), (4, 3), (3, 3), (0, 3), (2, 3), (2, 2), (3, 4), (1, 1)]
    df = spark.createDataFrame(rows, "Total int, NumberOfNews long")
    weights = [r.WeightedCountOfNews for r in themes.weight_news(df).collect()]
    assert weights == [1000, 1500, 750, 300, 300, 300, 10, 0, 0]
    fixed = [r.WeightedCountOfNews for r in themes.weight_news(df, fix_total3=True).collect()]
    assert fixed == [1000, 1500, 750, 300, 0, 15, 10, 400, 0]


def test_fill_zero_leaves_text_and_dates(spark):
    df = spark.createDataFrame([(None, None, None, None)], "n int, x double, s string, d date")
    assert tuple(themes.fill_zero(df).first()) == (0, 0.0, None, None)


def test_dateadded_filter_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([(1, 20240105)], "id int, DATEADDED long").write.parquet(str(tmp_path / "e"))
    df = parse.dateadded_between(spark.read.parquet(str(tmp_path / "e")), "2024-01-01", "2024-01-31")
    assert "GreaterThanOrEqual(DATEADDED,20240101)" in plan_of(df)


def test_week_keys_are_unpadded(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 202401)], "Date date, MonthYear int")
    assert parse.week_keys(df).first().MonthYearWeek == "2024011"


def test_root_codes_match_with_and_without_zero(spark):
    from portrisk.operators.joins import label_cameo

    events = spark.createDataFrame([("1",), ("01",), ("14",), ("20",)], "EventRootCode string")
    names = spark.createDataFrame([("01", "A"), ("14", None), ("20", "B")], "`CAMEO CODE` string, DESCRIPTION string")
    assert sorted(r.DESCRIPTION for r in label_cameo(events, names).collect()) == ["A", "A", "B"]


def test_since_and_period(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, d),) for d in range(1, 11)], "Date date")
    assert filters.since(df, 8, "2024-01-10").count() == 9
    assert filters.period(df, "2024-01-02", "2024-01-05").count() == 3
    assert filters.period(df, "2024-01-05", "2024-01-02").count() == 0


def test_report_is_one_scan_one_shuffle(spark, tmp_path):
    news(spark, {}).write.parquet(str(tmp_path / "n"))
    plan = plan_of(weighted_report(route_news(spark.read.parquet(str(tmp_path / "n")))))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    assert "LOCATIONS" in plan and "NUMARTS" not in plan and "Python" not in plan


def test_report_counts(spark):
    df = news(spark, {"THEMES": "PORT;TRANSPORT_INFRASTRUCTURE;TRADE;"}, {"THEMES": "PORT;TRANSPORT_INFRASTRUCTURE;TRADE;"},
              {"TONE": "2,3,1,4"}, {"LOCATIONS": "4#P#MX#MX09#"})
    got = weighted_report(route_news(df)).collect()
    assert len(got) == 1
    assert (got[0].Total, got[0].NumberOfNews, got[0].WeightedCountOfNews) == (2, 2, 10)


def test_grid_has_no_cross_join_and_fills_zero(spark, rows):
    df = news(spark, {}, {"DATE": 20240103, "LOCATIONS": "4#P#US#USCA#"}, {"DATE": 20240104, "TONE": "2,3,1,4"})
    grid = theme_grid(route_news(df))
    assert rows(grid, "Date", "LocationCode", "NumberOfNews") == [
        (dt.date(2024, 1, d), c, n) for d, c, n in
        [(1, "CA02", 1), (1, "USCA", 0), (3, "CA02", 0), (3, "USCA", 1), (4, "CA02", 0), (4, "USCA", 0)]
    ]
    assert "Cartesian" not in plan_of(grid) and "NestedLoop" not in plan_of(grid)


def test_growth_without_base_is_zero(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, d), 1, "CA02", n) for d, n in ((1, 0), (2, 4), (3, 6), (4, 0))],
        "Date date, Total int, LocationCode string, NumberOfNews long",
    )
    got = [(r.GrowthNumberOfNewsPastDay, r.LagGrowthNumberOfNewsPastDay) for r in windows.growth(df).orderBy("Date").collect()]
    assert got == [(0.0, 0.0), (0.0, 0.0), (0.5, 0.0), (-1.0, 0.5)]


def _ranked_input(spark):
    # one group holds most rows, many of them exact copies
    hot = [(dt.date(2024, 1, 1), "CA02", float(i % 5), str(i % 50), "u") for i in range(400)]
    rest = [(dt.date(2024, 1, 1 + i % 3), "USCA", float(i), str(i), None if i % 4 else "v") for i in range(40)]
    nulls = [(None, "CH02", None, str(i), "u") for i in range(5)]
    return spark.createDataFrame(
        hot + rest + nulls, "Date date, LocationCode string, ToneNegativeScore double, CAMEOEVENTIDS string, SOURCEURLS string"
    ).repartition(4)


def test_ranks_equal_a_window_and_spread_equal_rows(spark, rows):
    df = _ranked_input(spark)
    window = Window.partitionBy("Date", "LocationCode").orderBy(
        F.col("ToneNegativeScore").desc_nulls_last(), F.col("CAMEOEVENTIDS").asc_nulls_last(), F.col("SOURCEURLS").asc_nulls_last()
    )
    plain = df.withColumn("rank", F.row_number().over(window))
    for parts in (None, 1, 16):
        assert rows(ranking.rank_negative(df, parts=parts)) == rows(plain)
    assert ranking.rank_negative(df.limit(0)).count() == 0
    same = spark.range(4000).select(F.lit("a").alias("g"), F.lit(1).alias("v"))
    ranked = ranking.rank_rows(same, ["g"], [F.col("v").asc()], parts=8)
    assert [r["rank"] for r in ranked.orderBy("rank").collect()] == list(range(1, 4001))
    written = [spark.read.parquet(f).count() for f in ranked.inputFiles()]
    assert max(written) < 1500  # no task has sorted the whole group


def test_top_k_limits_before_the_shuffle(spark, rows):
    df = _ranked_input(spark)
    top = ranking.top_negative(df, 3)
    assert rows(top) == rows(ranking.rank_negative(df).where("rank <= 3"))
    assert plan_of(top).count("WindowGroupLimit") == 2


def test_daily_features_scan_once(spark, tmp_path):
    from portrisk.operators.joins import route_members
    from portrisk.plans.features import feature_news

    news(spark, {}).write.parquet(str(tmp_path / "n"))
    df = aggregates.daily_features(feature_news(spark.read.parquet(str(tmp_path / "n"))), route_members(spark))
    assert plan_of(df).count("FileScan") == 1
    got = {r.profile: r.NegativeNews for r in df.collect()}
    assert got == {"trans_pacific": 1, "CA02": 1}


def test_preview_takes_without_sorting_all(spark):
    assert "TakeOrderedAndProject" in plan_of(ranking.preview(spark.range(100), 5, F.col("id").desc()))


def test_row_width_audit_takes_any_separator(spark, rows):
    lines = spark.createDataFrame([("a|b",), ("a|b",), ("a",)], "value string")
    assert rows(aggregates.row_width_audit(lines, "|")) == [(1, 1), (2, 2)]


def test_scored_news_has_no_python(spark):
    assert "Python" not in plan_of(scored_news(route_news(news(spark, {}))))


def test_day_bounds_reach_the_scan(spark, tmp_path, rows):
    days = [20240101 + i for i in range(20)]
    df = spark.createDataFrame([(d, i) for i, d in enumerate(days)], "DATE int, id long")
    df.write.parquet(str(tmp_path / "plain"))
    df.write.partitionBy("DATE").parquet(str(tmp_path / "parted"))
    for name, shown in (("plain", "PushedFilters: ["), ("parted", "PartitionFilters: [")):
        stored = spark.read.parquet(str(tmp_path / name))
        found = filters.period(stored, "2024-01-05", "2024-01-08", "DATE")
        assert rows(found, "DATE") == [(20240105,), (20240106,), (20240107,)]
        assert rows(filters.since(stored, 2, "2024-01-20", "DATE"), "DATE") == [(20240118,), (20240119,), (20240120,)]
        plan = plan_of(found)
        assert "20240105" in plan.split(shown)[1].split("]")[0] and "cast" not in plan.split(shown)[1].split("]")[0]
