"""Merge laws: idempotence, null keys, ambiguous updates, stored tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from portrisk import schemas
from portrisk.session import new_folder
from portrisk.sources import control, merge, raw, readers
from portrisk.streaming.ingest import incremental_ingest
from tests.conftest import plan_of

SCHEMA = "id long, day date, value string"
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, D1, "a"), (2, D1, "b"), (None, D1, "n")], SCHEMA)


def test_upsert_updates_and_inserts(spark, target, rows):
    source = spark.createDataFrame([(2, D1, "B"), (3, D2, "c")], SCHEMA)
    merged = merge.upsert(target, source, ["id"])
    assert rows(merged, "id", "value") == [(1, "a"), (2, "B"), (3, "c"), (None, "n")]
    assert rows(merge.upsert(merged, source, ["id"])) == rows(merged)


def test_null_key_never_matches_unless_asked(spark, target, rows):
    source = spark.createDataFrame([(None, D1, "N")], SCHEMA)
    assert rows(merge.upsert(target, source, ["id"]), "value") == [("N",), ("a",), ("b",), ("n",)]
    assert rows(merge.upsert(target, source, ["id"], null_safe=True), "value") == [("N",), ("a",), ("b",)]


@pytest.mark.parametrize("null_safe", [False, True])
def test_two_updates_of_one_row_are_an_error(spark, target, null_safe):
    source = spark.createDataFrame([(2, D1, "x"), (2, D1, "y")], SCHEMA)
    with pytest.raises(Exception, match="several source rows update the target row with key 2"):
        merge.upsert(target, source, ["id"], null_safe).collect()


def test_repeated_new_rows_are_all_added(spark, target, rows):
    source = spark.createDataFrame([(9, D1, "x"), (9, D1, "y")], SCHEMA)
    assert rows(merge.upsert(target, source, ["id"]).where("id = 9"), "value") == [("x",), ("y",)]


def test_insert_only_keeps_stored_rows(spark, target, rows):
    source = spark.createDataFrame([(1, D1, "new"), (4, D2, "d")], SCHEMA)
    once = merge.insert_only_merge(target, source, ["id"])
    assert rows(once.where("id is not null"), "id", "value") == [(1, "a"), (2, "b"), (4, "d")]
    assert rows(merge.insert_only_merge(once, source, ["id"])) == rows(once)


def test_upsert_joins_once_and_never_nests_loops(spark, target):
    source = spark.createDataFrame([(2, D1, "B")], SCHEMA)
    plan = plan_of(merge.upsert(target, source, ["id"]))
    assert plan.count("Join") == 1
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_stored_upsert_rewrites_only_touched_days(spark, rows):
    path = new_folder(spark, "t")
    first = spark.createDataFrame([(1, D1, "a"), (2, D2, "b")], SCHEMA)
    merge.upsert_into(spark, path, first, ["id"], "day")
    first_day = lambda: {f for f in spark.read.parquet(path).inputFiles() if f"day={D1}" in f}
    files = first_day()
    merge.upsert_into(spark, path, spark.createDataFrame([(2, D2, "B"), (3, D2, "c")], SCHEMA), ["id"], "day")
    table = spark.read.parquet(path)
    assert rows(table, "id", "value") == [(1, "a"), (2, "B"), (3, "c")]
    assert files and files == first_day()


def test_stored_insert_only_is_idempotent(spark, rows):
    path = new_folder(spark, "t")
    first = spark.createDataFrame([(1, D1, "a")], SCHEMA)
    again = spark.createDataFrame([(1, D1, "changed"), (2, D1, "b")], SCHEMA)
    for _ in range(2):
        merge.insert_only_into(spark, path, first, ["id"], "day")
        merge.insert_only_into(spark, path, again, ["id"], "day")
    assert rows(spark.read.parquet(path), "id", "value") == [(1, "a"), (2, "b")]


def test_landing_replaces_only_its_day(spark, rows):
    path = new_folder(spark, "raw")
    df = spark.createDataFrame([(1,)], "id int")
    raw.land_raw(df, path, "2024-01-01")
    raw.land_raw(df, path, "2024-01-03")
    raw.land_raw(spark.createDataFrame([(7,)], "id int"), path, "2024-01-03")
    assert rows(raw.read_raw(spark, path, "2024-01-01", "2024-01-03"), "id") == [(1,), (7,)]
    plan = plan_of(raw.read_raw(spark, path, "2024-01-03"))
    assert "PartitionFilters: [isnotnull(dt" in plan
    found, missing = raw.backfill(spark, path, "2024-01-01", "2024-01-04")
    assert found.count() == 2
    assert rows(missing) == [(dt.date(2024, 1, 2),), (dt.date(2024, 1, 4),)]


def test_control_advances_to_the_processed_day_and_never_back(spark):
    table = spark.createDataFrame([("news", D1, dt.datetime(2024, 1, 1))], schemas.CONTROL)
    table = control.advance_control(table, "news", "2024-01-05")
    assert control.next_date_to_process(table, "news").first()[1] == dt.date(2024, 1, 6)
    table = control.advance_control(table, "news", "2024-01-02")
    assert control.next_date_to_process(table, "news").first()[1] == dt.date(2024, 1, 6)
    table = control.advance_control(table, "events", "2024-01-02")
    assert table.count() == 2
    assert control.next_date_to_process(control.empty_control(spark)).count() == 0


def test_stream_equals_batch_and_picks_up_late_files(spark, rows):
    landing, table, progress = (new_folder(spark, n) for n in ("l", "t", "p"))
    deliveries = [
        [(1, D1, "a"), (2, D2, "b")],
        [(2, D2, "B"), (3, D1, "late")],
    ]
    batch = None
    for delivery in deliveries:
        df = spark.createDataFrame(delivery, SCHEMA)
        df.coalesce(1).write.mode("append").parquet(landing)
        for _ in range(2):  # the second call finds nothing new
            assert incremental_ingest(spark, landing, df.schema, table, progress, ["id"], "day", timeout=120)
        batch = df if batch is None else merge.upsert(batch, df, ["id"])
    assert rows(spark.read.parquet(table), "id", "day", "value") == rows(batch)


def test_readers_pad_short_rows_and_null_bad_numbers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('20240101\t3\tx "quoted\tT\n20240102\tbad\n')
    first, second = readers.read_gkg_tsv(spark, str(tmp_path)).orderBy("DATE").collect()
    assert (first.DATE, first.NUMARTS, first.COUNTS, first.THEMES) == (20240101, 3, 'x "quoted', "T")
    assert second.DATE == 20240102 and second.NUMARTS is None and second.THEMES is None


def test_zipped_feed_equals_plain_feed(spark, tmp_path, rows):
    import zipfile

    text = "20240101\t3.0\tc\tPORT;\t\n\n20240102\t4\td\tTRADE;\t\n"
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "a.csv").write_text(text)
    for name in ("20240101.zip", "20240102.zip"):
        with zipfile.ZipFile(tmp_path / name, "w") as archive:
            archive.writestr("day.csv", text)
            archive.writestr("ignored.csv", "1\t2\n")
    zipped = readers.read_zipped_tsv(spark, str(tmp_path / "*.zip"), schemas.GKG)
    plain = readers.read_gkg_tsv(spark, str(tmp_path / "plain"))
    wanted = rows(plain)
    assert rows(zipped) == sorted(wanted * 2, key=repr)
    wanted = rows(plain, "DATE", "NUMARTS", "THEMES")
    assert rows(zipped, "DATE", "NUMARTS", "THEMES") == sorted(wanted * 2, key=repr)


def test_coerce_keeps_long_ids_exact(spark):
    text = spark.createDataFrame([("9007199254740993", "12.0"), ("x", "-")], "GlobalEventID string, NumMentions string")
    got = readers.coerce_types(text, schemas.EVENTS).collect()
    assert tuple(got[0]) == (9007199254740993, 12)
    assert tuple(got[1]) == (None, None)


def test_event_layout():
    assert len(schemas.EVENTS) == 58 and len(schemas.GKG) == 11
    assert schemas.EVENTS["EventRootCode"].dataType.simpleString() == "string"
    assert schemas.EVENTS.names[25] == "IsRootEvent" and schemas.EVENTS.names[-1] == "SOURCEURL"


def test_latest_delivery_counts_and_its_copies_stay(spark, rows):
    df = spark.createDataFrame(
        [(1, D1, "old"), (1, D2, "new"), (1, D2, "new"), (2, D1, "only"), (None, D1, "n1"), (None, D2, "n2")], SCHEMA
    )
    assert rows(merge.latest_rows(df, ["id"], "day"), "value") == [("n1",), ("n2",), ("new",), ("new",), ("only",)]
    assert rows(merge.latest_rows(df, ["id"], "day", null_safe=True), "value") == [("n2",), ("new",), ("new",), ("only",)]


def test_redelivered_event_is_updated_whatever_day_it_arrives(spark, rows):
    """Day by day and as one range the table is the same: one row per event, the latest."""
    from portrisk.plans import daily

    def events(*values):
        named = spark.createDataFrame(values, "GlobalEventID long, Day int, SOURCEURL string")
        return named.select(
            *[(F.col(f.name) if f.name in named.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.EVENTS.fields]
        )

    landed, single, whole = (new_folder(spark, n) for n in ("raw", "single", "whole"))
    raw.land_raw(events((1, 20240101, "first"), (2, None, "undated")), landed, "2024-01-01")
    raw.land_raw(events((1, 20240101, "again"), (2, None, "undated again"), (3, 20240102, "c")), landed, "2024-01-02")
    for day in ("2024-01-01", "2024-01-02"):
        daily.bronze_events(spark, landed, single, day)
    daily.bronze_events(spark, landed, whole, "2024-01-01", "2024-01-02")
    want = [(1, "again"), (2, "undated again"), (3, "c")]
    for path in (single, whole):
        assert rows(spark.read.parquet(path), "GlobalEventID", "SOURCEURL") == want


def test_stream_batch_with_two_deliveries_keeps_the_latest(spark, rows):
    landing, table, progress = (new_folder(spark, n) for n in ("l", "t", "p"))
    schema = "id long, day date, value string, sent int"
    for sent in (1, 2):
        spark.createDataFrame([(1, D1, f"v{sent}", sent)], schema).write.mode("append").parquet(landing)
    struct = spark.createDataFrame([], schema).schema
    assert incremental_ingest(spark, landing, struct, table, progress, ["id"], "day", latest_by="sent", timeout=120)
    assert rows(spark.read.parquet(table), "id", "value") == [(1, "v2")]


def test_moved_key_leaves_one_row_and_emptied_days_go(spark, rows):
    path = new_folder(spark, "t")
    first = spark.createDataFrame([(1, D1, "a"), (2, D2, "b"), (None, D2, "n"), (3, None, "c")], SCHEMA)
    merge.upsert_into(spark, path, first, ["id"], "day", moving=True)
    moved = spark.createDataFrame([(1, D2, "A"), (3, D2, "C")], SCHEMA)
    for _ in range(2):
        merge.upsert_into(spark, path, moved, ["id"], "day", moving=True)
        assert rows(spark.read.parquet(path), "id", "day", "value") == sorted([(1, D2, "A"), (2, D2, "b"), (None, D2, "n"), (3, D2, "C")], key=repr)
    merge.upsert_into(spark, path, spark.createDataFrame([(1, D1, "back")], SCHEMA), ["id"], "day", moving=True)
    assert rows(spark.read.parquet(path).where("id = 1"), "day", "value") == [(D1, "back")]


def test_index_is_made_for_a_table_without_one(spark, rows):
    path = new_folder(spark, "t")
    merge.upsert_into(spark, path, spark.createDataFrame([(1, D1, "a"), (2, D1, "b")], SCHEMA), ["id"], "day")
    merge.upsert_into(spark, path, spark.createDataFrame([(1, D2, "A")], SCHEMA), ["id"], "day", moving=True)
    assert rows(spark.read.parquet(path), "id", "day") == [(1, D2), (2, D1)]
    found = merge._between(spark.read.parquet(merge.key_index(path)), spark.createDataFrame([(2,)], "id long"), ["id"])
    assert "PushedFilters: [IsNotNull(id), GreaterThanOrEqual(id,2), LessThanOrEqual(id,2)]" in plan_of(found)


def test_batch_is_merged_once_and_replayed_safely(spark, rows):
    path, twice = new_folder(spark, "t"), spark.createDataFrame([(1, D1, "x"), (1, D1, "y"), (2, D1, "z")], SCHEMA)
    again = lambda batch: merge.merge_batch(spark, path, twice, ["id"], "day", "s", batch)
    want = [(1, "x"), (1, "y"), (2, "z")]
    assert again(0) and rows(spark.read.parquet(path), "id", "value") == want
    assert not again(0)
    merge.note_batch(spark, path, "s", 1, "started")  # lost between the merge and its last note
    assert again(1) and rows(spark.read.parquet(path), "id", "value") == want
    for _ in range(2):  # a real ambiguity stays an error
        with pytest.raises(ValueError, match="several source rows update the target row with key 1"):
            again(2)
    assert rows(spark.read.parquet(path), "id", "value") == want


def test_replayed_stream_batch_changes_nothing(spark, rows, tmp_path):
    """The stream forgets that a batch was committed and runs it again."""
    import shutil

    landing, table, progress = (new_folder(spark, n) for n in ("l", "t", "p"))
    df = spark.createDataFrame([(1, D1, "x"), (1, D1, "y")], SCHEMA)
    df.coalesce(1).write.parquet(landing)
    run = lambda: incremental_ingest(spark, landing, df.schema, table, progress, ["id"], "day", timeout=120)
    assert run()
    folder = progress.removeprefix("file:")
    shutil.move(f"{folder}/commits/0", tmp_path / "commit")
    shutil.move(f"{folder}/commits/.0.crc", tmp_path / "crc")
    assert run()
    assert rows(spark.read.parquet(table), "id", "value") == [(1, "x"), (1, "y")]


def test_control_run_advances_only_after_success(spark):
    from portrisk.plans import daily

    path, seen = new_folder(spark, "control"), []
    with pytest.raises(LookupError):
        daily.run_day(spark, path, "news", seen.append)
    control.store_control(spark, path, "news", "2024-01-30")
    assert daily.run_day(spark, path, "news", seen.append) == ["2024-01-31"]

    def broken(day):
        raise OSError(day)

    with pytest.raises(OSError, match="2024-02-01"):
        daily.run_day(spark, path, "news", broken)
    assert daily.run_day(spark, path, "news", seen.append, "2024-02-02") == ["2024-02-01", "2024-02-02"]
    assert daily.run_day(spark, path, "news", seen.append, "2024-02-02") == []
    assert seen == ["2024-01-31", "2024-02-01", "2024-02-02"]


def test_only_unknown_news_are_parsed(spark, monkeypatch):
    from portrisk.plans import daily

    parsed = []

    def seen(raw):
        parsed.append(sorted(r.CAMEOEVENTIDS for r in raw.select("CAMEOEVENTIDS").collect()))
        return route_news(raw)

    route_news = daily.route_news
    monkeypatch.setattr(daily, "route_news", seen)
    fields = {f.name: f.dataType for f in schemas.GKG.fields}
    given = {"LOCATIONS": "1#x#US#USCA#0#0#f", "TONE": "-1,0,2,0", "THEMES": "PORT;MARITIME"}
    bronze, silver = new_folder(spark, "b"), new_folder(spark, "s")
    for ids in (["a", "b", "b"], ["c", "d"]):
        made = spark.createDataFrame([(20240101, x) for x in ids], "DATE int, CAMEOEVENTIDS string").withColumns({c: F.lit(v) for c, v in given.items()})
        made = made.select(*[(F.col(c) if c in made.columns else F.lit(None)).cast(t).alias(c) for c, t in fields.items()])
        made.write.mode("append").partitionBy("DATE").parquet(bronze)
        daily.silver_news(spark, bronze, silver, "2024-01-01")
    assert parsed == [["c", "d"]]
    assert sorted((r.rank, r.CAMEOEVENTIDS) for r in spark.read.parquet(silver).collect()) == [(1, "a"), (2, "b"), (3, "b"), (4, "c"), (5, "d")]


def test_unmatched_with_keys_of_other_types(spark):
    left = spark.createDataFrame([(1, "a"), (1, None), (None, None), (2, "a"), (2, "a")], "id int, name string")
    for kind in ("int", "long"):
        right = spark.createDataFrame([(1, "a"), (1, "a"), (None, None), (None, "a")], f"id {kind}, name string")
        got = merge.unmatched(left, right, ["id", "name"], null_safe=True)
        assert got.columns == ["id", "name"] and sorted(map(tuple, got.collect()), key=str) == [(1, None), (2, "a"), (2, "a")]


def test_late_news_rank_again_only_their_groups(spark, rows):
    """News in two deliveries give the silver rows of one, page texts included, and leave other days alone."""
    from portrisk.plans import daily
    from portrisk.plans.report import build_silver

    def news(*values):
        made = spark.createDataFrame(values, "DATE int, CAMEOEVENTIDS string, place string, tone double")
        location = F.concat(F.lit("1#x#US#"), F.col("place"), F.lit("#0#0#f"))
        tone = F.concat(F.lit("-1,0,"), F.col("tone").cast("string"), F.lit(",1,0,0"))
        made = made.withColumns({"LOCATIONS": location, "TONE": tone, "THEMES": F.lit("PORT;MARITIME"), "SOURCEURLS": F.concat(F.lit("http://u/"), "CAMEOEVENTIDS")})
        fields = {f.name: f.dataType for f in schemas.GKG.fields}
        return made.select(*[(F.col(c) if c in made.columns else F.lit(None)).cast(t).alias(c) for c, t in fields.items()])

    first = [(20240101, f"a{i}", "USCA", float(i)) for i in range(4)] + [(20240101, "b0", "CA02", 1.0), (20240102, "c0", "USCA", 1.0)]
    late = [(20240101, "a9", "USCA", 2.5), (20240101, "a8", "USCA", 9.0)]
    pages = spark.createDataFrame([(f"http://u/{x}", f"<p>text {x}</p>") for x in ("a0", "a1", "a2", "a3", "a8", "a9", "b0", "c0")], "url string, html string")
    bronze, silver = new_folder(spark, "b"), new_folder(spark, "s")
    for part in (first, late):
        news(*part).write.mode("append").partitionBy("DATE").parquet(bronze)
        daily.silver_news(spark, bronze, silver, "2024-01-01", "2024-01-02", pages)
        if part is first:
            quiet = {f for f in spark.read.parquet(silver).inputFiles() if "2024-01-02" in f}
    shown = ("Date", "LocationCode", "CAMEOEVENTIDS", "rank", "contenturl")
    assert rows(spark.read.parquet(silver), *shown) == rows(build_silver(news(*first, *late), pages), *shown)
    files = set(spark.read.parquet(silver).inputFiles())
    assert quiet and quiet <= files
    daily.silver_news(spark, bronze, silver, "2024-01-01", "2024-01-02", pages)
    assert set(spark.read.parquet(silver).inputFiles()) == files  # nothing new, nothing written
