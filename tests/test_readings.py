"""The micro fixtures: one sharp edge each, results worked out by hand."""

import math
import random
import re
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from helpers import readings, tuples
from pyspark.sql import functions as F

from __spark_entry__ import queries
from frostline.functions import significant_digits, truncated
from frostline.operators.defrost import defrost_events, defrosted_devices
from frostline.operators.efficiency import efficiency_delta, efficiency_rolling
from frostline.operators.pattern import door_alerts, door_severity, rising_pairs
from frostline.operators.status import fold_status, latest_efficiency, status_changes, status_table
from frostline.operators.timeline import newest_first, retained, upsert_timeline
from frostline.operators.work import work_windows, work_windows_expanded
from frostline.plans import views
from frostline.sources.events import read_readings

SECOND = 1000
T0 = 1_704_067_200_000


def pairs(spark, rows):
    return tuples(rising_pairs(readings(spark, rows)), "prev_time_ms", "time_ms")


def test_threshold_edge(spark):
    r = readings(spark, [(0, -0.01, 0.1), (1, 0, 0.1), (2, 0.01, 0.1)])
    assert tuples(defrost_events(r), "time_ms") == [(1,), (2,)]
    assert tuples(defrosted_devices(defrost_events(r)), "device_id", "defrosted") == [("d", True)]


def test_trunc_compare(spark):
    assert pairs(spark, [(0, -0.7, 0.1), (1000, 0.7, 0.2)]) == []
    assert pairs(spark, [(0, 0.9, 0.1), (1000, 1.0, 0.2)]) == [(0, 1000)]


def test_within_edge(spark):
    assert pairs(spark, [(0, 1, 0.1), (9_999, 2, 0.1), (19_999, 3, 0.1)]) == [(0, 9_999)]


def test_overlap(spark):
    assert pairs(spark, [(0, 1, 0.1), (1, 2, 0.1), (2, 3, 0.1)]) == [(0, 1), (1, 2)]


def test_contiguity(spark):
    assert pairs(spark, [(0, 5, 0.1), (1, 1, 0.1), (2, 4, 0.1)]) == [(1, 2)]


def test_warn_only(spark):
    rising = rising_pairs(readings(spark, [(0, 1, 0.1), (1, 2, 0.1), (2, 3, 0.2)]))
    assert tuples(door_alerts(rising), "time_ms", "door_open") == [(1, False), (2, True)]
    assert tuples(door_severity(rising), "time_ms", "severity") == [(1, "warning"), (2, "alert")]


def test_latch(spark):
    rows = [(0, -3, 0.1), (1000, -1, 0.2), (2000, -5, 0.1), (3000, -9, 0.1)]
    assert tuples(status_table(readings(spark, rows)), "door_open", "defrosted") == [(True, None)]


def test_tie(spark):
    """Equal times: the order of arrival decides."""
    assert pairs(spark, [(5, 1, 0.1), (5, 2, 0.1), (5, 0, 0.1)]) == [(5, 5)]
    assert pairs(spark, [(5, 2, 0.1), (5, 1, 0.1)]) == []


def test_single(spark):
    r = readings(spark, [(T0 + 500, -4, 0.25)])
    windows = work_windows(r)
    ends = [T0 + SECOND * n for n in range(1, 31)]
    assert tuples(windows, "window_end_ms", "temp", "work") == [(e, -4.0, 0.25) for e in ends]
    assert tuples(rising_pairs(r), "time_ms") == []
    delta = {r["window_end_ms"]: r["efficiency"] for r in efficiency_delta(windows).collect()}
    assert delta[ends[0]] is None and all(delta[e] == 0.0 for e in ends[1:])


def test_zero_work(spark):
    windows = work_windows(readings(spark, [(T0, 1, 0)]))
    assert {r["efficiency"] for r in efficiency_delta(windows).collect()} == {None}
    rolled = [r["efficiency"] for r in efficiency_rolling(windows).orderBy("window_end_ms").collect()]
    assert rolled == [100.0] + [None] * 29


def test_partial_status(spark):
    rows = [("a", T0, -5, 0.1), ("a", T0 + 40 * SECOND, -6, 0.1), ("b", T0, 3, 0.1)]
    got = tuples(status_table(readings(spark, rows)), "device_id", "door_open", "defrosted", "efficiency")
    assert [x[:3] for x in got] == [("a", None, None), ("b", None, True)]
    assert got[0][3] is not None
    again = fold_status(status_changes(readings(spark, rows)))
    assert tuples(again, "device_id", "efficiency") == [(x[0], x[3]) for x in got]


def test_upsert(spark):
    r = readings(spark, [(5, 1, 0.1), (5, 2, 0.2), (6, 3, 0.3), (5, 4, 0.4)])
    assert tuples(upsert_timeline(r), "time_ms", "temp") == [(5, 4.0), (6, 3.0)]


def test_ttl_edge(spark):
    as_of = F.lit("2024-01-01 10:00:00").cast("timestamp")
    ages = F.array(F.lit(7199), F.lit(7200), F.lit(7201))
    r = readings(spark, [(0, 1, 0.1)]).withColumn("age", F.explode(ages))
    r = r.withColumn("ingest_ts", as_of - F.make_interval(secs=F.col("age")))
    assert tuples(retained(r, as_of), "age") == [(7199,)]


def test_timeline_order_is_newest_first(spark):
    r = readings(spark, [("b", 1, 1, 1), ("a", 5, 1, 1), ("a", 9, 1, 1), ("b", 3, 1, 1)]).repartition(3)
    times = {}
    for row in newest_first(upsert_timeline(r)).collect():
        times.setdefault(row["device_id"], []).append(row["time_ms"])
    assert times == {"a": [9, 5], "b": [3, 1]}


def test_extreme_numbers(spark):
    """Huge finite values neither fail nor drop out."""
    rows = [(T0, -1e30, 5e9), (T0 + 1, 1e30, 6e9), (T0 + 2, 2e30, 7e9), (T0 + 3, 3, 4e-10), (T0 + 4, 4, 4e-10)]
    r = readings(spark, rows)
    assert tuples(rising_pairs(r), "prev_time_ms", "time_ms") == [(T0, T0 + 1), (T0 + 3, T0 + 4)]
    total = float(Decimal("18000000000") + 2 * Decimal("4e-10"))
    assert {x["work"] for x in work_windows(r).collect()} == {total}
    assert status_table(r).count() == 1
    tiny = work_windows(readings(spark, [(T0, 1, 4e-10), (T0 + 1, 1, 4e-10)]))
    assert {x["work"] for x in tiny.collect()} == {8e-10}


def test_truncated_saturates(spark):
    values = spark.createDataFrame([(v,) for v in (-0.7, 0.7, 1e30, -1e30, 9.3e18, None)], "v double")
    got = [r[0] for r in values.select(truncated(F.col("v"))).collect()]
    assert got == [0, 0, 2**63 - 1024, -(2**63 - 1024), 2**63 - 1024, None]


@pytest.mark.parametrize("bucket_slides", [1, 7, 29, 31, 600])
def test_windows_in_buckets_equal_plain_ones(spark, bucket_slides):
    """Gaps, crowded seconds, times before 1970 and several devices."""
    rng = random.Random(bucket_slides)
    rows, now = [], -40_000
    for _ in range(150):
        now += rng.choice([1, 300, 1000, 5000, 31_000, 70_000])
        rows.append((rng.choice("ab"), now, rng.randint(-9, 9), rng.randint(1, 99) / 100))
    r = readings(spark, rows)
    columns = ["device_id", "window_end_ms", "temp", "work"]
    plain = tuples(work_windows_expanded(r), *columns)
    assert tuples(work_windows(r, bucket_slides=bucket_slides), *columns) == plain
    before, want = {}, []
    for device, end, temp, work in plain:
        last = before.get(device)
        want.append((device, end, None if last is None else (last - temp) / work * 100))
        before[device] = temp
    delta = efficiency_delta(work_windows(r), bucket_ms=bucket_slides * 1000)
    assert tuples(delta, "device_id", "window_end_ms", "efficiency") == want


def test_rolling_takes_windows_in_any_partitioning(spark, small):
    r = read_readings(spark, small)
    columns = ["device_id", "window_end_ms", "efficiency"]
    plain = tuples(efficiency_rolling(work_windows(r)), *columns)
    assert tuples(efficiency_rolling(work_windows_expanded(r)), *columns) == plain
    assert tuples(efficiency_rolling(work_windows(r).repartition(4)), *columns) == plain


def test_status_can_take_the_rolling_efficiency(spark, small):
    r = read_readings(spark, small)
    rolled = efficiency_rolling(work_windows(r)).where("efficiency is not null")
    last = rolled.groupBy("device_id").agg(F.max_by("efficiency", "window_end_ms").alias("efficiency"))
    got = tuples(status_table(r, efficiency="rolling"), "device_id", "efficiency")
    assert got == tuples(last, "device_id", "efficiency")


@pytest.mark.parametrize(
    "value,shown",
    [(1.0005, 1.0), (-1.0005, -1.0), (8.0085, 8.008), (9212.5, 9213.0), (-9212.5, -9213.0), (0.0, 0.0),
     (1.23456, 1.235), (99995.0, 100000.0), (None, None), (math.inf, math.inf)],
)
def test_four_significant_digits_of_the_exact_value(spark, value, shown):
    got = spark.createDataFrame([(value,)], "v double").select(significant_digits(F.col("v"))).first()[0]
    assert got == shown


def test_four_digits_equal_decimal_arithmetic(spark):
    def exact(value):
        wanted = Decimal(value)
        step = Decimal(1).scaleb(wanted.adjusted() - 3)
        with localcontext(prec=800):
            return float(wanted.quantize(step, rounding=ROUND_HALF_UP))

    rng = random.Random(3)
    halves = [float(f"{rng.choice('-+')}{rng.randint(1000, 9999)}5e{rng.randint(-21, 21)}") for _ in range(4000)]
    near = [math.nextafter(v, rng.choice((0.0, math.inf, -math.inf))) for v in halves]
    others = [rng.uniform(-10, 10) * 10.0 ** rng.randint(-300, 300) for _ in range(2000)]
    values = halves + near + others
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    got = rows.select("v", significant_digits(F.col("v"))).collect()
    assert [tuple(r) for r in got if r[1] != exact(r[0])] == []
    assert len(got) == len(values)
    nan, zero = spark.createDataFrame([(math.nan,), (-0.0,)], "v double").select(significant_digits(F.col("v"))).collect()
    assert math.isnan(nan[0]) and math.copysign(1, zero[0]) == -1


def test_sinusoid_closed_form(spark):
    """Rising where the cosine is positive, in steps of more than one degree."""
    times = range(0, 62_832, 1000)
    rows = [(t, 15 * math.sin(t / 10_000) - 5, (200 * math.sin(2 * t / 10_000) + 400) / 3600) for t in times]
    want = [
        (a[0], b[0], b[2] > a[2]) for a, b in zip(rows, rows[1:]) if math.trunc(b[1]) > math.trunc(a[1])
    ]
    rising = rising_pairs(readings(spark, rows))
    assert tuples(rising, "prev_time_ms", "time_ms", (F.col("prev_kw") < F.col("kw")).alias("up")) == want
    defrosting = [t for t, temp, _ in rows if temp >= 0]
    assert [x[0] for x in tuples(defrost_events(readings(spark, rows)), "time_ms")] == defrosting


def test_sparkline_keeps_the_newest_and_the_range_of_all(spark):
    rows = [(t, t % 7 - 3, 0.1) for t in range(0, 40)]
    got = views.sparkline(readings(spark, rows), "temp", length=5).orderBy("pos").collect()
    assert [(r["pos"], r["time_ms"], r["value"]) for r in got] == [(i + 1, 35 + i, (35 + i) % 7 - 3.0) for i in range(5)]
    assert {(r["min_value"], r["max_value"]) for r in got} == {(-3.0, 3.0)}


def test_json_keeps_nulls_and_pages_stay_small(spark):
    status = spark.createDataFrame(
        [(f"d{i:03d}", None, True, 1.5) for i in range(25)], "device_id string, door_open boolean, defrosted boolean, efficiency double"
    )
    all_ = views.all_status(status)
    text = views.json_elements(all_).orderBy("deviceID").first()["json"]
    assert text == '{"deviceID":"d000","door-open":null,"defrosted":true,"efficiency":1.5}'
    pages = views.json_pages(all_, "status", 10).orderBy("page").collect()
    counts = [p["json"].count('"deviceID"') for p in pages]
    assert sum(counts) == 25 and max(counts) <= 10
    ids = [x.split('"')[3] for p in pages for x in p["json"].split("{")[2:]]
    assert ids == sorted(ids)
    one = views.json_pages(all_.limit(1), "status", 10).first()["json"]
    assert one == '{"status":[{"deviceID":"d000","door-open":null,"defrosted":true,"efficiency":1.5}]}'


def test_quoted_id(spark):
    rows = spark.createDataFrame(
        [('"device1"', True, None, 0.5)], "device_id string, door_open boolean, defrosted boolean, efficiency double"
    )
    assert [r["deviceID"] for r in views.one_status(rows, "device1", quoted=True).collect()] == ["device1"]
    assert views.one_status(rows, "nobody", quoted=True).count() == 0
    r = readings(spark, [('"device1"', 1, 1, 1), ('"device1"', 2, 5, 1)])
    assert [x["sensorValue1"] for x in views.latest_reading(r, "device1", quoted=True).collect()] == [5.0]


@pytest.mark.parametrize("bucket_ms", [1, 50, 10_000])
def test_latency_quantiles_are_exact(spark, bucket_ms):
    import numpy as np

    from frostline.operators.latency import latency_summary

    rng = random.Random(8)
    delays = [rng.choice([0, 3, 70, rng.randint(0, 5000)]) for _ in range(333)]
    frame = spark.createDataFrame([(10, 10 + d) for d in delays], "time_ms long, ingest_ms long")
    got = latency_summary(frame, bucket_ms).first()
    assert (got["readings"], got["min_ms"], got["max_ms"]) == (333, min(delays), max(delays))
    want = [*np.quantile(delays, [0.5, 0.95, 0.99]), sum(delays) / 333]
    assert [got[c] for c in ("p50_ms", "p95_ms", "p99_ms", "mean_ms")] == pytest.approx(want, rel=1e-12)
    assert latency_summary(frame.where("false"), bucket_ms).first()["readings"] is None


def test_panes_and_windows_stay_in_as_many_partitions_as_asked_for(spark):
    """Joined by the bytes they are shuffled in, they made tasks of gigabytes."""
    r = readings(spark, [(f"d{n % 9}", T0 + n * 700, n % 5, 1) for n in range(400)])
    asked = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert work_windows(r).rdd.getNumPartitions() == asked
    assert efficiency_delta(work_windows(r)).rdd.getNumPartitions() == asked
    assert efficiency_rolling(work_windows(r)).rdd.getNumPartitions() == asked


@pytest.mark.parametrize("bucket_slides", [7, 600])
def test_windows_that_name_their_bucket_are_not_shuffled_again(spark, bucket_slides):
    r = readings(spark, [(f"d{n % 3}", T0 + n * n * 90, n % 5, 1 + n % 3) for n in range(150)])
    kept = efficiency_delta(work_windows(r, bucket_slides=bucket_slides, keep_bucket=True))
    columns = ["device_id", "window_end_ms", "efficiency"]
    plain = efficiency_delta(work_windows(r, bucket_slides=bucket_slides))
    assert tuples(kept.fillna(-1.5e9), *columns) == tuples(plain.fillna(-1.5e9), *columns)
    dealt = "REPARTITION_BY_NUM"
    assert plain._jdf.queryExecution().executedPlan().toString().count(dealt) == 3
    assert kept._jdf.queryExecution().executedPlan().toString().count(dealt) == 2  # panes, for lasts and for windows


def sorts_of_windows(frame):
    """Sorts in a plan, outside of an exchange, of rows that windows have been expanded into."""
    found, expanded, above = 0, 0, []
    for line in frame._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = next((n for n, c in enumerate(line) if c.isalpha()), 0)
        above = [(d, node) for d, node in above if d < depth]
        node = line[depth:]
        if re.match(r"Generate explode\(sequence\(.*\[end#\d+L\]", node):
            nodes = [n for _, n in above]
            shuffled = max((i for i, n in enumerate(nodes) if n.startswith("Exchange")), default=-1)
            expanded += 1
            found += sum(n.startswith("Sort") for n in nodes[shuffled + 1 :])
        above.append((depth, node))
    assert expanded
    return found


@pytest.mark.parametrize(
    "view",
    [views.all_status, lambda s: views.json_pages(views.all_status(s), "status", 9),
     lambda s: views.all_status(s.withColumn("device_id", F.concat(F.lit('"'), "device_id", F.lit('"'))))],
)
def test_the_status_does_not_sort_windows(spark, view):
    """A pane makes up to 30 of them; sorted, they were most of what a task held."""
    r = readings(spark, [(f"d{n % 3}", T0 + n * 700, n % 5, 1) for n in range(40)])
    assert sorts_of_windows(view(status_table(r))) == 0


@pytest.mark.parametrize("name", ["status_pages", "status_quoted"])
def test_registered_views_of_the_status_do_not_sort_windows(spark, tmp_path, name):
    events = spark.range(40).selectExpr(
        "id AS event_id", "timestamp_seconds(1704067200 + id * 7000) AS ts", "id % 3 AS user_id",
        "'view' AS event_type", "id % 5 + 0.5D AS value", """concat('{"k": ', id % 9, '}') AS props""",
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    view = queries()[name](spark, str(tmp_path))
    assert sorts_of_windows(view) == 0
    assert {r["deviceID"] for r in view.collect()} == {"device0", "device1", "device2"}


@pytest.mark.parametrize("bucket_slides", [1, 2, 30, 31, 600])
def test_kept_windows_name_the_temperature_before(spark, bucket_slides):
    """Equal to the delta in order, over gaps, unknown temperatures and buckets."""
    rows = [(f"d{n % 2}", T0 + n * n * 700, n % 4, n % 3) for n in range(40)]
    r = readings(spark, rows).withColumn("temp", F.when(F.col("temp") < 3, F.col("temp")))
    kept = efficiency_delta(work_windows(r, bucket_slides=bucket_slides, keep_bucket=True))
    before, want = {}, []
    for device, end, temp, work in sorted(map(tuple, work_windows_expanded(r).drop("window_end").collect())):
        last = before.get(device)
        known = last is not None and temp is not None and work
        want.append((device, end, (last - temp) / work * 100 if known else None))
        before[device] = temp
    assert sorted(map(tuple, kept.collect()), key=lambda t: t[:2]) == want


def test_efficiency_folded_first_gives_the_same_status(spark):
    """Also of a device whose efficiency is never known, by device and by a further column."""
    rows = [(f"d{n % 4}", T0 + n * n * 90, n % 5 - 6, 0 if n % 4 == 3 else 1 + n % 3) for n in range(60)]
    r = readings(spark, [*rows, ("lone", T0, -5, 0)])
    columns = ["device_id", "door_open", "defrosted", "efficiency"]
    whole = [tuple(x) for x in fold_status(status_changes(r)).select(*columns).collect()]
    folded = [tuple(x) for x in status_table(r).select(*columns).collect()]
    assert sorted(folded, key=str) == sorted(whole, key=str)
    assert ("lone", None, None, None) in folded

    third = F.pmod(F.col("time_ms"), F.lit(3)).alias("third")
    changes = spark.createDataFrame(
        [("a", 3, 0, 1.0), ("a", 6, 0, 2.0), ("a", 9, 0, None), ("a", 4, 0, None), ("b", 5, 0, 7.0)],
        "device_id string, time_ms bigint, seq bigint, efficiency double",
    )
    by_third = latest_efficiency(changes, third).orderBy("device_id", "third")
    got = [tuple(x) for x in by_third.select("device_id", "third", "efficiency", "time_ms").collect()]
    assert got == [("a", 0, 2.0, 6), ("a", 1, None, 4), ("b", 2, 7.0, 5)]
