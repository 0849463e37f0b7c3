import os

import pytest
from pyspark.sql import functions as F
from test_ads import DAY, clicks_frame, line, lines_frame

from shoptrail.operators import ads
from shoptrail.params import TaskParams
from shoptrail.functions import bitmaps
from shoptrail.sources.streams import STAGED_PARTS, file_lines, staged_events
from shoptrail.sources.tables import StarSchema
from shoptrail.streaming import live, products
from shoptrail.streaming.sinks import CurrentRows

PARAMS = TaskParams("2024-01-01", "2024-01-31", blacklist_threshold=3)


def land(folder, batches):
    """One text file per batch, in order of arrival."""
    folder.mkdir(exist_ok=True)
    for number, lines in enumerate(batches):
        path = folder / f"part-{number:03d}.txt"
        path.write_text("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))
    return str(folder)


def some_lines(n=120):
    return [line(i * 40_000, user=i % 7 if i % 3 else 0, ad=i % 4, province=f"p{i % 3}", city=f"c{i % 5}") for i in range(n)]


def chunks(lines, size):
    return [lines[i : i + size] for i in range(0, len(lines), size)]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def batches(out):
    return sorted(int(n) for n in os.listdir(f"{out}/checkpoint/commits") if n.isdigit())


def stream(spark, folder):
    return file_lines(spark, folder, files_per_batch=1)


@pytest.mark.parametrize("size", [15, 50, 200])
def test_blacklist_is_the_same_for_any_split(spark, tmp_path, size):
    lines = some_lines()
    expected = rows(ads.blacklist(ads.user_ad_counts(clicks_frame(spark, lines)), 3))
    out = str(tmp_path / "out")
    clicks = ads.parse(stream(spark, land(tmp_path / "in", chunks(lines, size))))
    products.start(clicks, products.write_blacklist(out, 3), out).awaitTermination()
    assert rows(products.listed_users(spark, out)) == expected and expected


def test_listed_users_are_filtered_from_the_next_batch_on(spark, tmp_path):
    batches = [[line(i, user=1) for i in range(4)], [line(10 + i, user=1) for i in range(5)] + [line(20, user=2)]]
    out = str(tmp_path / "out")
    query = live.start_ad_statistics(stream(spark, land(tmp_path / "in", batches)), out, PARAMS, interval=None)
    query.awaitTermination()
    assert rows(products.user_ad_counts(spark, out)) == [("2024-01-01", 1, 1, 4), ("2024-01-01", 2, 1, 1)]
    assert rows(products.place_totals(spark, out)) == [("2024-01-01", "p", "c", 1, 5)]
    assert rows(products.minute_totals(spark, out)) == [("20240101", "00", "00", 1, 5)]
    assert [(r.adid, r.click_count) for r in products.top_rows(spark, out).collect()] == [(1, 5)]


def test_place_counts_equal_their_batch_twin(spark, tmp_path):
    lines = some_lines()
    listed = spark.createDataFrame([(0,), (3,)], "user_id bigint")
    out = str(tmp_path / "out")
    arriving = ads.parse(stream(spark, land(tmp_path / "in", chunks(lines, 30))))
    kept = bitmaps.without(arriving, bitmaps.bitmaps(listed))
    products.start(kept, products.write_place_counts(out), out).awaitTermination()
    expected = ads.place_counts(ads.without_listed(clicks_frame(spark, lines), listed))
    assert rows(products.place_totals(spark, out)) == rows(expected)
    assert batches(out) == [0, 1, 2, 3]


def test_top_ads_equal_their_batch_twin(spark, tmp_path):
    lines = some_lines() + [line(DAY + i, ad=i % 2, province="p9") for i in range(5)]
    out = str(tmp_path / "out")
    clicks = ads.parse(stream(spark, land(tmp_path / "in", chunks(lines, 30))))
    products.start(clicks, products.write_province_top(out, 3), out).awaitTermination()
    expected = ads.province_top(ads.place_counts(clicks_frame(spark, lines)), 3)
    columns = ["date", "province", "adid", "click_count", "rank"]
    assert rows(products.top_rows(spark, out).select(columns)) == rows(expected.select(columns))


def test_minute_trend_counts_late_clicks(spark, tmp_path):
    lines = some_lines(60)
    late_first = chunks(lines, 20)[::-1]
    out = str(tmp_path / "out")
    clicks = ads.parse(stream(spark, land(tmp_path / "in", late_first)))
    products.start(clicks, products.write_minute_counts(out), out).awaitTermination()
    total = products.minute_totals(spark, out)
    assert rows(total) == rows(ads.minute_counts(clicks_frame(spark, lines)))
    assert total.agg(F.sum("click_count")).first()[0] == 60


def windows_of(spark, tmp_path, batches, length, lateness="1 hour"):
    """What the stateful sliding windows put out; a last click far ahead closes all windows before."""
    out = str(tmp_path / "out")
    far = [[line(30 * DAY, ad=99)], [line(30 * DAY + 1, ad=99)]]
    clicks = ads.parse(stream(spark, land(tmp_path / "in", [*batches, *far])))
    write = lambda df, batch_id: df.write.parquet(f"{out}/rows/{batch_id}")
    products.start(products.sliding_counts(clicks, lateness, length), write, out).awaitTermination()
    found = spark.read.option("recursiveFileLookup", "true").parquet(f"{out}/rows")
    return rows(found.where("adid <> 99"))


def test_sliding_windows_of_a_stream_equal_the_batch(spark, tmp_path):
    lines = some_lines(40)
    found = windows_of(spark, tmp_path, chunks(lines, 10), "10 minutes")
    assert found == rows(ads.sliding_counts(clicks_frame(spark, lines), 10))


def test_click_behind_the_watermark_is_not_counted(spark, tmp_path):
    hour = 3_600_000
    found = windows_of(spark, tmp_path, [[line(0)], [line(10 * hour)], [line(10 * hour + 1)], [line(1)]], "1 minute")
    assert [r[2] for r in found] == [1, 2]


def test_sliding_windows_in_update_mode_go_on_after_a_stop(spark, tmp_path):
    lines, out = some_lines(40), str(tmp_path / "out")
    for n in (1, 2, 4):
        folder = land(tmp_path / "in", chunks(lines, 10)[:n])
        products.start_sliding_counts(ads.parse(stream(spark, folder)), out, length="10 minutes").awaitTermination()
        expected = rows(ads.sliding_counts(clicks_frame(spark, lines[: 10 * n]), 10))
        assert rows(products.window_totals(spark, out)) == expected
    assert batches(out)[-1] >= 3


def test_late_rows_of_sliding_windows_are_reported(spark, tmp_path):
    hour = 3_600_000
    parts = [[line(0)], [line(10 * hour)], [line(10 * hour + 1)], [line(1), line(10 * hour + 2)]]
    out = str(tmp_path / "out")
    clicks = ads.parse(stream(spark, land(tmp_path / "in", parts)))
    query = products.start_sliding_counts(clicks, out, lateness="1 hour", length="1 minute")
    query.awaitTermination()
    assert products.late_rows(query) == 1
    assert [r[2] for r in rows(products.window_totals(spark, out))] == [1, 3]


def test_batch_delivered_twice_changes_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    write = products.write_everything(out, 3, 3)
    first = clicks_frame(spark, [line(i, user=1) for i in range(5)] + [line(9, user=2)])
    second = clicks_frame(spark, [line(20 + i, user=u) for i, u in enumerate([1, 2, 2, 2, 3])])

    def state():
        return [
            rows(products.listed_users(spark, out)),
            rows(products.user_ad_counts(spark, out)),
            rows(products.place_totals(spark, out)),
            rows(products.minute_totals(spark, out)),
            rows(products.top_rows(spark, out)),
        ]

    write(first, 0)
    write(second, 1)
    before = state()
    write(second, 1)
    assert state() == before
    assert before[0] == [(1,), (2,)]
    # The first batch once more would be an error of the caller's; its own version is what it was.
    assert rows(products._user_ads(spark, out).rows(0)) == [("2024-01-01", 1, 1, 5), ("2024-01-01", 2, 1, 1)]


def test_empty_tables_have_their_schema(spark, tmp_path):
    none = CurrentRows(spark, str(tmp_path / "none"), "date string, click_count bigint", {"click_count": F.sum})
    assert none.rows().count() == 0 and none.rows().columns == ["date", "click_count"]
    assert none.add(none.rows(), 0) == [] and none.rows().count() == 0


def current(spark, folder):
    return CurrentRows(spark, str(folder), "date string, k int, n bigint", {"n": F.sum})


def test_batches_merge_into_the_days_they_touch(spark, tmp_path):
    table = current(spark, tmp_path / "t")
    frame = lambda *r: spark.createDataFrame(r, "date string, k int, n bigint")
    assert sorted(table.add(frame(("x", 1, 5), ("x", 2, 1), ("y", 1, 2)), 0)) == ["x", "y"]
    for _ in range(3):  # a batch that is delivered again
        table.add(frame(("x", 1, 10), ("x", 3, 1), (None, 1, 4)), 1)
        assert rows(table.rows(parts=["x", "y"])) == [("x", 1, 15), ("x", 2, 1), ("x", 3, 1), ("y", 1, 2)]
        assert rows(table.rows(parts=[None])) == [(None, 1, 4)]
        assert rows(table.rows(0)) == [("x", 1, 5), ("x", 2, 1), ("y", 1, 2)]
    table.replace(frame(("y", 7, 7)), 2, ["y"])
    assert rows(table.rows(parts=["y"])) == [("y", 7, 7)]


def test_a_day_keeps_two_versions_however_many_batches(spark, tmp_path):
    table = current(spark, tmp_path / "t")
    day = spark.createDataFrame([("x", k, 1) for k in range(50)], "date string, k int, n bigint")
    for batch in range(12):
        table.add(day, batch)
        versions = os.listdir(tmp_path / "t" / "date=x")
        assert len(versions) <= 2 and f"batch_id={batch}" in versions
    assert rows(table.rows()) == [("x", k, 12) for k in range(50)]


def test_bitmaps_hold_any_id(spark):
    ids = [0, 1, -1, 7, 8, 32_767, 32_768, 32_769, -32_768, -32_767, 65_536, 2**63 - 1, -(2**63), 10**12]
    frame = spark.createDataFrame([(i,) for i in ids] * 2 + [(None,)], "user_id bigint")
    sets = bitmaps.bitmaps(frame)
    assert sorted(r[0] for r in bitmaps.members(sets).collect()) == sorted(ids)
    others = sorted({i + d for i in ids for d in (-2, 2, 8)} - set(ids))
    others = [i for i in others if -(2**63) <= i < 2**63]
    rows_in = spark.createDataFrame([(i, "x") for i in [*ids, *others, None]], "user_id bigint, v string")
    kept = bitmaps.without(rows_in, sets)
    assert kept.columns == ["user_id", "v"]
    assert sorted(map(repr, (r[0] for r in kept.collect()))) == sorted(map(repr, [*others, None]))


def test_running_counts_go_on_after_a_stop(spark, tmp_path):
    lines = some_lines()
    out = str(tmp_path / "out")
    for number, part in enumerate(chunks(lines, 30)):
        folder = land(tmp_path / "in", chunks(lines, 30)[: number + 1])
        products.start_running_counts(ads.parse(stream(spark, folder)), out).awaitTermination()
        expected = rows(ads.place_counts(clicks_frame(spark, lines[: 30 * number + len(part)])))
        assert rows(products.running_totals(spark, out)) == expected
    assert batches(out)[-1] >= 3
    # A single count, looked up in the state.
    one = products.state_rows(spark, out).where("province = 'p1' and city = 'c1' and adid = 1").collect()
    assert [tuple(r) for r in one] == [r for r in expected if r[1:4] == ("p1", "c1", 1)] and one


def test_failure_between_sink_and_commit(spark, tmp_path):
    """The batch is written, but the query fails before it is committed: the next start delivers it again."""
    lines = some_lines()
    folder, out = land(tmp_path / "in", chunks(lines, 40)), str(tmp_path / "out")
    fails = [1]

    def failing(writer):
        def write(df, batch_id):
            writer(df, batch_id)
            if batch_id in fails:
                fails.remove(batch_id)
                raise RuntimeError("after the sink")

        return write

    for writer, stateful in ((products.write_running_counts(out + "/a"), True), (products.write_everything(out + "/b", 3, 3), False)):
        fails[:] = [1]
        at = out + ("/a" if stateful else "/b")
        for _ in range(2):
            clicks = ads.parse(stream(spark, folder))
            with products.state_on_disk(spark):
                source, mode = (products.running_place_counts(clicks), "update") if stateful else (clicks, "append")
                query = products.start(source, failing(writer), at, mode)
            try:
                query.awaitTermination()
            except Exception as error:
                assert "after the sink" in str(error)
        assert not fails and batches(at)[:3] == [0, 1, 2]
    expected = rows(ads.place_counts(clicks_frame(spark, lines)))
    assert rows(products.running_totals(spark, out + "/a")) == rows(products.state_rows(spark, out + "/a")) == expected
    whole = str(tmp_path / "whole")
    products.start(ads.parse(stream(spark, folder)), products.write_everything(whole, 3, 3), whole).awaitTermination()
    for read in (products.user_ad_counts, products.place_totals, products.minute_totals, products.top_rows, products.listed_users):
        assert rows(read(spark, out + "/b")) == rows(read(spark, whole))


def test_closed_days_leave_the_state(spark, tmp_path):
    parts = [[line(0), line(1)], [line(3 * DAY)], [line(3 * DAY + 1)], [line(5)], [line(3 * DAY + 2)]]
    out = str(tmp_path / "out")
    query = products.start_running_counts(ads.parse(stream(spark, land(tmp_path / "in", parts))), out, lateness="1 day")
    query.awaitTermination()
    state = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
    assert state[-1]["numRowsTotal"] == 1 and sum(s["numRowsDroppedByWatermark"] for s in state) == 1
    assert [r[4] for r in rows(products.running_totals(spark, out))] == [2, 3]


def test_null_and_negative_ids_are_staged(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    odd = events.limit(5).withColumn("event_id", F.lit(None).cast("bigint")).union(events.limit(3).withColumn("event_id", F.lit(-9).cast("bigint")))
    all_rows = events.union(odd)
    all_rows.write.parquet(str(tmp_path / "events.parquet"))
    staged, files = staged_events(spark, str(tmp_path))
    assert files == 1 and spark.read.parquet(staged).count() == all_rows.count()


@pytest.mark.parametrize("gap", [False, True])
def test_large_parts_are_staged_in_several_files(spark, tmp_path, gap):
    """A batch of a large part has more tasks than one, and parts stay batches where one of them has few rows."""
    ids = spark.range(660_000).where("NOT (id >= 220000 AND id < 329990)" if gap else "true")
    columns = ["id AS event_id", "CAST(null AS timestamp_ntz) AS ts", "id AS user_id", "'' AS event_type", "0D AS value", "'' AS props"]
    ids.selectExpr(*columns).write.parquet(str(tmp_path / "events.parquet"))
    staged, files = staged_events(spark, str(tmp_path))
    assert files == (1 if gap else 2)
    stream = spark.readStream.schema(spark.read.parquet(staged).schema).option("maxFilesPerTrigger", files).parquet(staged)
    seen = []

    def write(batch, _):
        seen.append(tuple(batch.agg(F.min("event_id"), F.max("event_id"), F.count("*")).first()))

    products.start(stream, write, str(tmp_path / "out")).awaitTermination()
    expected = [(k * 110_000, k * 110_000 + 109_999, 110_000) for k in range(STAGED_PARTS)]
    if gap:
        expected[2] = (329_990, 329_999, 10)
    assert seen == expected


def test_archived_input_is_not_read_twice(spark, tmp_path):
    lines = some_lines()
    folder, out, archive = land(tmp_path / "in", chunks(lines, 20)), str(tmp_path / "out"), str(tmp_path / "done")
    for _ in range(2):
        clicks = ads.parse(file_lines(spark, folder, bytes_per_batch=2000, archive=archive))
        products.start(clicks, products.write_minute_counts(out), out).awaitTermination()
        assert rows(products.minute_totals(spark, out)) == rows(ads.minute_counts(clicks_frame(spark, lines)))
    assert len(batches(out)) > 1
    moved = [f for _, _, names in os.walk(archive) for f in names if f.endswith(".txt")]
    assert moved and len(moved) + sum(n.endswith(".txt") for n in os.listdir(folder)) == 6


def test_registered_streams_run_in_several_batches(spark):
    tables = "/root/testdata/sf0.001"
    out = live.run_live(spark, tables, PARAMS)
    assert batches(out) == list(range(STAGED_PARTS))
    admitted = products.place_totals(spark, out).agg(F.sum("click_count")).first()[0]
    assert 0 < admitted <= StarSchema(spark, tables).events().count()


def test_parquet_line_source(spark, tmp_path):
    folder = str(tmp_path / "lines")
    lines_frame(spark, some_lines(10)).write.parquet(folder)
    out = str(tmp_path / "out")
    clicks = ads.parse(file_lines(spark, folder, "parquet"))
    products.start(clicks, products.write_minute_counts(out), out).awaitTermination()
    assert products.minute_totals(spark, out).agg(F.sum("click_count")).first()[0] == 10


def test_counters_of_a_running_stream(spark, tmp_path):
    parts = [[line(1, user=1), "broken line", line(2, user=2)], ["", line(3, user=1)], [line(4, user=3)]]
    out, listed = str(tmp_path / "out"), bitmaps.bitmaps(spark.createDataFrame([(1,)], "user_id bigint"))
    clicks = products.counted_clicks(stream(spark, land(tmp_path / "in", parts)), listed)
    query = products.start(clicks, products.write_minute_counts(out), out)
    query.awaitTermination()
    assert products.counters(query) == [(0, 3, 1, 1), (1, 2, 1, 1), (2, 1, 0, 0)]
    assert products.minute_totals(spark, out).agg(F.sum("click_count")).first()[0] == 2
