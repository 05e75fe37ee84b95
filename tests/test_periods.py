"""Alarms as intervals, periods with late events, and last-wins streams without state."""

import random

import pytest
from pyspark.sql import functions as F

from assayframe.operators import metrics as m
from assayframe.streaming import periods as pr, streams as st

READING = "name string, value double, ts long, dimensions map<string,string>"


def readings(spark, rows):
    return spark.createDataFrame(rows, READING).withColumn("ts", F.timestamp_seconds("ts"))


def changed(states):
    """Rows where the state of an alarm begins or changes, from a state per period."""
    out, was = [], {}
    for r in sorted(states.collect(), key=lambda r: (r["alarm"], r["period_start"])):
        if was.get(r["alarm"]) != r["state"]:
            out.append((r["alarm"], r["period_start"], r["state"]))
        was[r["alarm"]] = r["state"]
    return out


def told(changes):
    return sorted((r["alarm"], r["period_start"], r["state"]) for r in changes.collect())


ALARMS = [m.Alarm("high", "a", {}, "Sum", ">", 5.0, 2, 300),
          m.Alarm("quiet", "a", {}, "SampleCount", "<", 2.0, 3, 300, "breaching"),
          m.Alarm("mean", "b", {"k": "x"}, "Average", "<=", 2.0, 1, 600),
          m.Alarm("none", "c", {}, "Maximum", ">=", 1.0, 1, 300, "breaching")]


@pytest.mark.parametrize("seed", range(4))
def test_changes_equal_states_per_period(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice("ab"), float(rnd.randrange(6)), 300 * rnd.randrange(40) + rnd.randrange(300),
             {"k": rnd.choice("xy")}) for _ in range(rnd.choice([3, 30, 90]))]
    rows += [("a", None, 300 * 5, None), ("a", 9.0, 300 * 45, {})]
    df = readings(spark, rows)
    measured = m.measure_alarms(df, ALARMS)
    for alarms in (ALARMS[:2] + ALARMS[3:], ALARMS[2:3]):
        length = alarms[0].period_s
        start = min(r[2] for r in rows) // length * length
        end = 46 * 300 // length * length + length
        want = changed(m.alarm_states(df, alarms, start, end - 1))
        got, carry = m.alarm_changes(measured, alarms, start, end)
        assert told(got) == sorted(want)
        # In parts, each going on from where the one before stopped.
        parts, carry = [], None
        for to in (start + length * 4, start + length * 4, start + length * 19, end):
            part, carry = m.alarm_changes(measured, alarms, start, to, carry)
            parts, carry = parts + told(part), spark.createDataFrame(carry.collect(), carry.schema)
        assert sorted(parts) == sorted(want)


def test_far_reading_makes_no_rows(spark):
    far = 253_370_764_800  # in the year 9999
    df = readings(spark, [("a", 9.0, 0, {}), ("a", 9.0, 300, {}), ("a", 9.0, far, {})])
    got, carry = m.alarm_changes(m.measure_alarms(df, ALARMS[:2]), ALARMS[:2], 0, far + 300)
    assert [(a, s) for a, _, s in told(got)] == [
        ("high", "OK"), ("high", "ALARM"), ("high", "OK"), ("quiet", "OK"), ("quiet", "ALARM")]
    assert {r["alarm"]: r["streak"] for r in carry.collect()}["quiet"] == far // 300 + 1


def _events(rnd, n):
    return [(i, rnd.choice("ab"), float(rnd.randrange(9)), rnd.choice([None] + [
        300 * rnd.randrange(60) + rnd.randrange(300)] * 20)) for i in range(n)]


EVENT = "id long, kind string, value double, at long"


def test_kept_and_late_add_up_and_batches_repeat(spark, tmp_path):
    rnd = random.Random(1)
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "cp"))
    alarms = [m.Alarm("high", "a", {}, "Sum", ">", 20.0, 2, 600)]
    batches = []
    for i in range(4):
        rows = [(a, k, v, None if t is None else t + 6000 * i) for a, k, v, t in _events(rnd, 60)]
        batches.append(rows)
        df = spark.createDataFrame(rows, EVENT).withColumn("ts", F.timestamp_seconds("at"))
        df.coalesce(1).write.parquet(f"{source}/{i}")

        def run():
            arrivals = st.read_files(spark, f"{source}/*", df.schema)
            st.once(pr.period_stream(arrivals, target, progress, F.col("value"), 1200, ["kind"],
                                     alarms=alarms))

        run()
        if i == 2:  # the batch is run again, as after a crash before its commit
            before = told(pr.changes(spark, target))
            commit = tmp_path / "cp" / "commits" / "2"
            assert commit.exists()
            commit.unlink()
            (tmp_path / "cp" / "commits" / ".2.crc").unlink(missing_ok=True)
            run()
            assert told(pr.changes(spark, target)) == before
    until, kept, late = None, {}, []
    for rows in batches:
        limit = until
        for a, k, v, t in rows:
            if t is None or (limit is not None and t // 300 * 300 + 300 <= limit):
                late.append(a)
            else:
                n, total = kept.get((t // 300 * 300, k), (0, 0.0))
                kept[t // 300 * 300, k] = (n + 1, total + v)
        newest = [t for *_, t in rows if t is not None]
        until = max([until or 0, max(newest) - 1200])
    assert {(r["period"], r["kind"]): (r["n"], r["total"])
            for r in pr.kept(spark, target).collect()} == kept
    assert sorted(r["id"] for r in pr.late(spark, target).collect()) == sorted(late)
    assert sum(n for n, _ in kept.values()) + len(late) == 240 and late
    # Alarms from the stream equal those of the closed periods in one go.
    closed = pr.closed(spark, target).where("kind = 'a'")
    measured = closed.groupBy(F.lit("high").alias("alarm"), (F.floor(F.col("period") / 600) * 600)
                              .alias("period")).agg(F.sum("total").alias("statistic_value"))
    first = min(p for p, _ in kept) // 600 * 600
    want, _ = m.alarm_changes(measured, alarms, first, until // 600 * 600)
    assert told(pr.changes(spark, target)) == told(want)


def test_last_wins_without_state(spark, tmp_path):
    rnd = random.Random(2)
    source, target, progress, merged = (str(tmp_path / n) for n in ("in", "out", "cp", "merged"))
    rows = [(rnd.randrange(20), i, f"v{i}") for i in range(300)]
    rnd.shuffle(rows)
    schema = "key long, at long, v string"
    for i in range(3):
        spark.createDataFrame(rows[100 * i:100 * i + 100], schema).write.parquet(f"{source}/{i}")
        query = st.once(st.last_wins_stream(st.read_files(spark, f"{source}/*", schema), "key",
                                            "at", target, progress))
        assert not any(p["stateOperators"] for p in query.recentProgress)
    best = {}
    for k, at, v in rows:
        best[k] = max(best.get(k, (-1, "")), (at, v))

    def found(path):
        return {r["key"]: (r["at"], r["v"]) for r in st.current(spark, path, ["key"], "at").collect()}

    assert found(target) == best
    early = {}
    for k, at, v in rows[:200]:
        early[k] = max(early.get(k, (-1, "")), (at, v))
    got = {r["key"]: (r["at"], r["v"]) for r in st.changes(spark, target, "key", "at", 2).collect()}
    assert got == {k: x for k, x in best.items() if early.get(k) != x}
    st.compact(spark, target, merged, ["key"], "at", F.col("at") >= 250)
    assert found(merged) == {k: x for k, x in best.items() if x[0] >= 250}
