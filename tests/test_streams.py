from datetime import datetime, timedelta

import pytest

from panelyard.streaming import bars as S

SCHEMA = "event_id long, user_id long, ts timestamp, value double"
START = datetime(2024, 3, 1)


def land(spark, folder, rows):
    """One event a file."""
    for i, d, h in rows:
        row = (i, 1, START + timedelta(days=d, hours=h), float(i))
        spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def places(tmp_path):
    return str(tmp_path / "landed"), str(tmp_path / "root")


def bars_of(spark, landed, root):
    events = S.open_events(spark, landed, "*.parquet", "ts", files_per_batch=1)
    bars, run = S.collect_bars(events, root, "user_id", "ts", "value")
    return {str(r.day): (r.open, r.high, r.low, r.close, r.volume, r.final) for r in bars.collect()}, run


def test_late_events_stay_across_restarts(spark, places):
    landed, root = places
    land(spark, landed, [(0, 60, 1), (1, 0, 5), (2, 0, 2), (3, 30, 1)])
    first, run = bars_of(spark, landed, root)
    assert first == {"2024-03-01": (2.0, 2.0, 1.0, 1.0, 2, True), "2024-03-31": (3.0, 3.0, 3.0, 3.0, 1, True),
                     "2024-04-30": (0.0, 0.0, 0.0, 0.0, 1, False)}
    assert run.dropped == 0 and run.watermark.replace(tzinfo=None) == START + timedelta(days=53, hours=1)
    land(spark, landed, [(4, 60, 2), (5, 0, 9), (6, 68, 1)])
    second, run = bars_of(spark, landed, root)
    assert second == {"2024-03-01": (2.0, 5.0, 1.0, 5.0, 3, True), "2024-03-31": (3.0, 3.0, 3.0, 3.0, 1, True),
                      "2024-04-30": (0.0, 4.0, 0.0, 4.0, 2, True), "2024-05-08": (6.0, 6.0, 6.0, 6.0, 1, False)}
    late = S._late(spark, root, S.open_events(spark, landed, "*.parquet", "ts").schema)
    assert sorted(r.event_id for r in late.collect()) == [1, 2, 3, 5]
    assert bars_of(spark, landed, root)[0] == second          # nothing new: the watermark stays known


def test_repeated_batch_of_the_split_replaces_itself(spark, places, monkeypatch):
    """A run dies after a batch was written and before its progress was; the next run writes it again."""
    landed, root = places
    land(spark, landed, [(0, 1, 0), (1, 20, 0)])
    real = spark.createDataFrame

    def dying(rows, schema=None, *more):
        if schema == "newest timestamp" and rows[0][0] is not None and rows[0][0].day == 21:
            raise RuntimeError("lost")
        return real(rows, schema, *more)

    events = lambda: S.open_events(spark, landed, "*.parquet", "ts", files_per_batch=1)
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, *a, **k: dying(*a, **k))
    with pytest.raises(Exception, match="lost"):
        S.collect_bars(events(), root, "user_id", "ts", "value")
    monkeypatch.undo()
    got, _ = bars_of(spark, landed, root)
    assert {k: v[4] for k, v in got.items()} == {"2024-03-02": 1, "2024-03-21": 1}


def test_each_key_once_with_bounded_state(spark, places):
    landed, root = places
    read = lambda: S.open_events(spark, landed, "*.parquet", "ts", files_per_batch=4)
    days = [(d, d, 3) for d in range(30)]
    land(spark, landed, days + days[-3:])
    out, _ = S.collect_once(read(), root, ["event_id"], "ts")
    assert sorted(r.event_id for r in out.collect()) == list(range(30))
    land(spark, landed, days[25:] + days[:2] + [(100, 2, 1), (100, 2, 1), (101, 31, 1)])
    out, run = S.collect_once(read(), root, ["event_id"], "ts")
    assert sorted(r.event_id for r in out.collect()) == [*range(30), 100, 101]
    assert run.state_rows <= 16 and run.dropped == 0         # of 32 keys: a key leaves a look-back after it expires
