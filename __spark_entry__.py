"""Registered queries, and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from frostline.functions import float32_millis
from frostline.operators.defrost import defrost_events, defrosted_devices
from frostline.operators.efficiency import efficiency_delta, efficiency_rolling, efficiency_rolling_scan
from frostline.operators.latency import (
    QUANTILES,
    SKETCH_RANK_ERROR,
    latency_sketch,
    latency_summary,
    merged_latency,
)
from frostline.operators.order import backward_counts, backward_readings
from frostline.operators.pattern import door_alerts, door_severity, rising_pairs
from frostline.operators.status import compact_changes, status_changes, status_table
from frostline.operators.timeline import (
    latest_per_device,
    newest_first,
    retained,
    running_extremes,
    upsert_timeline,
)
from frostline.operators.work import work_windows, work_windows_expanded
from frostline.plans import views
from frostline.schema import READING_SCHEMA
from frostline.session import scratch_dir, stream_session
from frostline.sources.events import EPOCH_MS, MICROS_PER_MS, read_readings
from frostline.sources.messages import decode, decode_with_extra, encode, extra_json, quarantine
from frostline.sources.replay import replay_stream
from frostline.sources.tables import (
    compact_status,
    read_status,
    read_timeline,
    write_changes,
    write_timeline,
)
from frostline.streaming import bounded, clustered, feeds, latest, series, shared, status
from frostline.streaming.efficiency import efficiency_rolling_stream

try:  # the training-data package may be left out
    import corpus_pipeline
    from frostline.llm import queries as llm_queries
except ImportError:
    corpus_pipeline = llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"
ONE_DEVICE = "device7"
RETAINED_AS_OF = "2024-01-30 00:00:00"
STATUS_PAGE_ROWS = 1000
# Small enough to bind: fewer values than a device has, fewer devices than there are.
SHORT_SPARKLINE = 5
HOT_THRESHOLD = 9.5
UNKNOWN_DEVICE = "no such device"
# Enough energy for the rolling recurrence to be stable, and buckets that cut its history.
STABLE_SCALE = 100
SCAN_BUCKET_MS = 20_000
SKETCH_SPAN_MS = 10_000
BACKWARD_MS = 5_000
# Short enough that most devices have expired by the end.
LATEST_TTL_SECONDS = 6 * 3_600


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: door alerts from adjacent readings."""
    return door_alerts(rising_pairs(read_readings(spark, SMOKE_DIR)))


# --- batch -----------------------------------------------------------------


def _readings(spark, sf_dir):
    return _plain(read_readings(spark, sf_dir))


def _plain(readings: DataFrame) -> DataFrame:
    """Times as epoch milliseconds only, to compare across engines."""
    return readings.drop("ts")


def _decode_json(spark, sf_dir):
    return _plain(decode(encode(read_readings(spark, sf_dir))))


def _damaged_messages(spark, sf_dir) -> DataFrame:
    """Every message, those of three event types damaged in three ways."""
    readings = read_readings(spark, sf_dir, event_type=F.col("event_type"))
    text = F.col("value")
    broken = F.substring(text, F.lit(1), F.length(text) - 1)
    text_number = F.regexp_replace(text, r'"sensor-value-1":([^,]+)', r'"sensor-value-1":"$1"')
    missing = F.regexp_replace(text, r',"sensor-value-2":[^,}]+', "")
    damaged = (
        F.when(F.col("event_type") == "error", broken)
        .when(F.col("event_type") == "purchase", text_number)
        .when(F.col("event_type") == "signup", missing)
        .otherwise(text)
    )
    return encode(readings, "event_type").select("seq", damaged.alias("value"))


def _decode_extra(spark, sf_dir):
    """Messages that carry two keys besides those of a reading."""
    readings = read_readings(spark, sf_dir, event_type=F.col("event_type"))
    messages = encode(readings, "event_type")
    added = F.concat(F.lit(',"site":{"kind":"'), "event_type", F.lit('"},"batch":'), F.col("seq") % 7, F.lit("}"))
    text = F.concat(F.substring("value", F.lit(1), F.length("value") - 1), added)
    decoded = decode_with_extra(messages.select("seq", text.alias("value")))
    return _plain(decoded).withColumn("extra", extra_json(F.col("extra")))


def _float32_time(spark, sf_dir):
    r = read_readings(spark, sf_dir)
    return r.select("seq", "device_id", float32_millis(F.col("time_ms")).alias("time_ms"))


def _pairs(spark, sf_dir, **options):
    return rising_pairs(read_readings(spark, sf_dir), **options)


def _windows(spark, sf_dir):
    return work_windows(read_readings(spark, sf_dir))


def _status(spark, sf_dir):
    return status_table(read_readings(spark, sf_dir))


def _timeline(spark, sf_dir):
    return upsert_timeline(read_readings(spark, sf_dir))


def _timeline_upserted(spark, sf_dir):
    """Every reading comes twice; the copy that came first has another value."""
    r = read_readings(spark, sf_dir)
    older = r.withColumns({"seq": -F.col("seq") - 1, "temp": F.col("temp") + 1})
    return upsert_timeline(older.unionByName(r))


def _timeline_positions(spark, sf_dir):
    """Where each reading stands among those of its device."""
    ordered = newest_first(_timeline(spark, sf_dir)).withColumn("at", F.monotonically_increasing_id())
    of_device = Window.partitionBy("device_id").orderBy("at")
    return ordered.select("device_id", "time_ms", F.row_number().over(of_device).alias("position"))


def _timeline_float32(spark, sf_dir):
    messages = encode(read_readings(spark, sf_dir))
    return upsert_timeline(decode(messages, time_precision="float32"))


def _timeline_retained(spark, sf_dir):
    r = read_readings(spark, sf_dir, ingest_ts=F.col("ts").cast("timestamp"))
    kept = retained(upsert_timeline(r, extra=("ingest_ts",)), F.lit(RETAINED_AS_OF).cast("timestamp"))
    return kept.drop("ingest_ts")


def _timeline_stored(spark, sf_dir):
    path = scratch_dir(spark, "timeline")
    write_timeline(read_readings(spark, sf_dir), path)
    return read_timeline(spark, path, ttl_seconds=None).drop("ts", "ingest_ts")


def _status_stored(spark, sf_dir):
    """Stored in three batches, with a compaction after each of the first two."""
    path = scratch_dir(spark, "status")
    for batch, third in enumerate(_changes_in_thirds(spark, sf_dir)):
        write_changes(third, path, "all", batch)
        if batch < 2:
            compact_status(spark, path)
    return read_status(spark, path)


def _changes_in_thirds(spark, sf_dir) -> list[DataFrame]:
    """The change log as three batches by time, each folded; all are made in one go and stored."""
    third = F.pmod(F.col("time_ms"), F.lit(3)).alias("third")
    changes = status_changes(read_readings(spark, sf_dir), folded_by=[third])
    path = scratch_dir(spark, "thirds")
    compact_changes(changes.select("*", third).where("third is not null"), "third").write.parquet(path)
    return [spark.read.parquet(path).where(F.col("third") == batch).drop("third") for batch in range(3)]


def _millis(view: DataFrame) -> DataFrame:
    return view.withColumn("time_stamp", F.unix_millis("time_stamp"))


def _quoted_status(spark, sf_dir):
    quoted = F.concat(F.lit('"'), F.col("device_id"), F.lit('"'))
    return views.all_status(_status(spark, sf_dir).withColumn("device_id", quoted))


def _parsed(json: DataFrame, fields: str) -> DataFrame:
    return json.select(F.inline(F.array(F.from_json("json", fields))))


STATUS_JSON = "deviceID string, `door-open` boolean, defrosted boolean, efficiency double"
TIMELINE_JSON = (
    "deviceID string, time_stamp string, sensorName1 string, sensorValue1 double,"
    " sensorName2 string, sensorValue2 double"
)


def _status_json(spark, sf_dir):
    elements = views.json_elements(views.all_status(_status(spark, sf_dir)))
    return _parsed(elements, STATUS_JSON)


def _status_pages(spark, sf_dir):
    pages = views.json_pages(views.all_status(_status(spark, sf_dir)), "status", STATUS_PAGE_ROWS)
    listed = pages.select(F.from_json("json", f"status array<struct<{STATUS_JSON}>>").alias("p"))
    return listed.select(F.inline("p.status"))


def _timeline_json(spark, sf_dir):
    latest = views.timeline_names(latest_per_device(read_readings(spark, sf_dir)))
    return _parsed(views.json_elements(latest), TIMELINE_JSON)


def _latest_payload(spark, sf_dir):
    reading = views.latest_reading(read_readings(spark, sf_dir), ONE_DEVICE)
    page = views.json_pages(reading, "timeline", STATUS_PAGE_ROWS)
    listed = page.select(F.from_json("json", f"timeline array<struct<{TIMELINE_JSON}>>").alias("p"))
    return listed.select(F.inline("p.timeline"))


def _chart_points(spark, sf_dir):
    latest = views.timeline_names(latest_per_device(read_readings(spark, sf_dir)))
    payload = latest.select("deviceID", F.array(F.struct(*latest.columns)).alias("timeline"))
    temps = views.sparkline_point(payload, "timeline", "sensorValue1")
    energy = views.sparkline_point(payload, "timeline", "sensorValue2")
    return temps.select("deviceID", F.lit("Temp").alias("chart"), "value").unionByName(
        energy.select("deviceID", F.lit("Energy").alias("chart"), "value")
    )


def _latency(spark, sf_dir):
    return latency_summary(_delays(spark, sf_dir))


def _delays(spark, sf_dir):
    delay = F.get_json_object("props", "$.k").cast("bigint") * 10
    r = read_readings(spark, sf_dir, delay=delay)
    return r.withColumn("ingest_ms", F.col("time_ms") + F.col("delay"))


def _latency_merged(spark, sf_dir):
    """Sketches of short spans, merged; each quantile against the exact ranks."""
    readings = _delays(spark, sf_dir)
    span = F.call_function("div", F.col("time_ms"), F.lit(SKETCH_SPAN_MS))
    merged = merged_latency(latency_sketch(readings, span.alias("span")))
    held = merged.first()
    if held is None:
        return merged.select(F.lit(0.5).alias("quantile"), "readings", "min_ms", "max_ms", "mean_ms",
                             F.lit(True).alias("within_bound"))
    delay = F.col("ingest_ms") - F.col("time_ms")
    judged = []
    for q in QUANTILES:
        found = held[f"p{round(q * 100)}_ms"]
        low, high = F.avg((delay < found).cast("int")), F.avg((delay <= found).cast("int"))
        near = (low <= q + SKETCH_RANK_ERROR) & (high >= q - SKETCH_RANK_ERROR)
        judged.append(near.alias(f"near_{round(q * 100)}"))
    exact = [F.struct(F.lit(q).alias("quantile"), F.col(f"near_{round(q * 100)}").alias("within_bound")) for q in QUANTILES]
    facts = [F.lit(held[c]).alias(c) for c in ("readings", "min_ms", "max_ms", "mean_ms")]
    return readings.agg(*judged).select(*facts, F.inline(F.array(*exact)))


def _rolling_scan(spark, sf_dir):
    r = read_readings(spark, sf_dir).withColumn("kw", F.col("kw") * STABLE_SCALE)
    scanned = efficiency_rolling_scan(work_windows(r), SCAN_BUCKET_MS)
    return scanned.withColumn("efficiency", F.round("efficiency", 6))


def _one_payloads(spark, sf_dir):
    """What the API answers for a device, and for one that it does not know."""
    status, readings = _status(spark, sf_dir), read_readings(spark, sf_dir)
    asked = []
    for device in (ONE_DEVICE, UNKNOWN_DEVICE):
        for name, rows, fields in (
            ("status", views.one_status(status, device), STATUS_JSON),
            ("timeline", views.latest_reading(readings, device), TIMELINE_JSON),
        ):
            page = views.one_payload(rows, name)
            items = F.from_json("json", f"{name} array<struct<{fields}>>")[name]
            asked.append(page.select(F.lit(device).alias("asked"), F.lit(name).alias("view"),
                                     F.size(items).cast("bigint").alias("items"),
                                     F.get(items, 0)["deviceID"].alias("deviceID")))
    return asked[0].unionByName(asked[1]).unionByName(asked[2]).unionByName(asked[3])


def _disordered(spark, sf_dir):
    """Readings of one event type bear a time some seconds back."""
    r = read_readings(spark, sf_dir, event_type=F.col("event_type"))
    back = F.when(F.col("event_type") == "error", BACKWARD_MS).otherwise(0)
    return r.withColumn("time_ms", F.col("time_ms") - back).withColumn("ts", F.timestamp_millis("time_ms"))


def _backward_times(spark, sf_dir):
    return backward_counts(backward_readings(_disordered(spark, sf_dir)))


def _stream_backward_times(spark, sf_dir):
    found = bounded.run_over(_disordered(spark, sf_dir), series.backward_stream, "stream-backward", by="seq")
    return backward_counts(found)


def _stream_sparkline(column):
    def query(spark, sf_dir):
        readings = read_readings(spark, sf_dir)
        updates = bounded.run_updates(readings, lambda r: series.sparkline_stream(r, column), "stream-sparkline")
        return series.latest_series(updates)

    return query


# --- streams, run to their end ---------------------------------------------


def _stream(result, name, late=None):
    return lambda spark, sf_dir: bounded.run_over_events(spark, sf_dir, result, name, late)


def _late():
    """Readings that reach the stream long after the watermark has passed them."""
    return F.col("event_type") == "error"


def _stream_timeline(spark, sf_dir):
    written = bounded.run_over_events(spark, sf_dir, feeds.timeline_stream, "stream-timeline")
    return upsert_timeline(written)


def _stream_status(spark, sf_dir):
    folder = bounded.run_all_over_events(spark, sf_dir, "stream-status")
    status = read_status(spark, f"{folder}/status")
    return status.where(F.col("device_id") != bounded.END_DEVICE)


def _stream_shared_timeline(spark, sf_dir):
    folder = bounded.run_shared_over_events(spark, sf_dir, "stream-shared")
    stored = read_timeline(spark, f"{folder}/{shared.TIMELINE}", ttl_seconds=None).drop("ts", "ingest_ts")
    return stored.where(F.col("device_id") != bounded.END_DEVICE)


def _stream_clustered(spark, sf_dir):
    """What the stream has written, after every date has been clustered."""
    folder = bounded.run_shared_over_events(spark, sf_dir, "stream-clustered")
    clustered.cluster_closed_dates(spark, folder, date.max)
    clustered.cluster_closed_dates(spark, folder, date.max)
    stored = clustered.read_stream_timeline(spark, folder, ttl_seconds=None).drop("ts", "ingest_ts")
    return stored.where(F.col("device_id") != bounded.END_DEVICE)


def _stream_status_state(spark, sf_dir):
    """The change log, written in three batches, kept as state and read from there."""
    folder = scratch_dir(spark, "status-state")
    for batch, third in enumerate(_changes_in_thirds(spark, sf_dir)):
        write_changes(third, f"{folder}/{shared.STATUS}", "all", batch)
    status.keep_status(status.changes_stream(stream_session(spark), folder), folder, available_now=True).awaitTermination()
    return status.read_status_state(spark, folder)


def _stream_latest_state(spark, sf_dir):
    """The latest readings not yet expired, from state; events were written when they say."""
    folder = scratch_dir(spark, "latest-state")
    written_ms = (F.col("time_ms") - EPOCH_MS) * (MICROS_PER_MS // 1000) + EPOCH_MS
    readings = read_readings(spark, sf_dir)
    files = bounded.write_slices(readings, f"{folder}/readings")
    stream = replay_stream(stream_session(spark), f"{folder}/readings", READING_SCHEMA, files_per_trigger=files)
    stream = stream.where(F.col("device_id") != bounded.END_DEVICE).withColumn("ingest_ms", written_ms)
    latest.keep_latest(stream, folder, LATEST_TTL_SECONDS, available_now=True).awaitTermination()
    end = readings.agg(F.max(written_ms)).first()[0] or 0
    return latest.read_latest_state(spark, folder, F.lit(end), LATEST_TTL_SECONDS)


def _stream_latency(spark, sf_dir):
    """Readings that the running stream's own sketches of delay have counted."""
    folder = bounded.run_shared_over_events(spark, sf_dir, "stream-latency")
    found = shared.read_latency(spark, folder)
    rising = (F.col("min_ms") <= F.col("p50_ms")) & (F.col("p50_ms") <= F.col("p95_ms")) & (F.col("p95_ms") <= F.col("p99_ms"))
    # The end marker is a reading too.
    return found.select((F.col("readings") - 1).alias("readings"), rising.alias("in_order"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _sensor_queries() | _llm_queries()


def _llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if llm_queries is None:
        return {}
    return llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}


def _llm_oracle_sql() -> dict[str, str]:
    if llm_queries is None:
        return {}
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return llm_queries.ORACLE_SQL | pipeline


def _sensor_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "readings": _readings,
        "decode_json": _decode_json,
        "decode_damaged": lambda s, d: _plain(decode(_damaged_messages(s, d))),
        "quarantine": lambda s, d: quarantine(_damaged_messages(s, d)).drop("value"),
        "float32_time": _float32_time,
        "defrost_events": lambda s, d: defrost_events(read_readings(s, d)),
        "defrost_status_hot": lambda s, d: defrosted_devices(
            defrost_events(read_readings(s, d), threshold=HOT_THRESHOLD)
        ),
        "defrost_status": lambda s, d: defrosted_devices(defrost_events(read_readings(s, d))),
        "rising_pairs": _pairs,
        "rising_pairs_dense": lambda s, d: _pairs(s, d, dense_ms=1_000),
        "door_alerts": lambda s, d: door_alerts(_pairs(s, d)),
        "door_severity": lambda s, d: door_severity(_pairs(s, d)),
        "work_windows": _windows,
        "work_windows_expanded": lambda s, d: work_windows_expanded(read_readings(s, d)).drop(
            "window_end"
        ),
        "efficiency_delta": lambda s, d: efficiency_delta(_windows(s, d)),
        "efficiency_rolling": lambda s, d: efficiency_rolling(_windows(s, d)),
        "status_table": _status,
        "status_rolling": lambda s, d: status_table(read_readings(s, d), efficiency="rolling"),
        "status_stored": _status_stored,
        "timeline_table": _timeline,
        "timeline_stored": _timeline_stored,
        "timeline_float32": _timeline_float32,
        "timeline_retained": _timeline_retained,
        "timeline_upserted": _timeline_upserted,
        "timeline_positions": _timeline_positions,
        "timeline_order": lambda s, d: newest_first(_timeline(s, d)),
        "status_all": lambda s, d: views.all_status(_status(s, d)),
        "status_quoted": _quoted_status,
        "status_one": lambda s, d: views.one_status(_status(s, d), ONE_DEVICE),
        "latest_reading": lambda s, d: _millis(views.latest_reading(read_readings(s, d), ONE_DEVICE)),
        "latest_per_device": lambda s, d: latest_per_device(read_readings(s, d)),
        "status_json": _status_json,
        "status_pages": _status_pages,
        "timeline_json": _timeline_json,
        "latest_payload": _latest_payload,
        "chart_points": _chart_points,
        "status_panel": lambda s, d: views.status_panel(_status(s, d)),
        "efficiency_gauge": lambda s, d: views.efficiency_gauge(_status(s, d)),
        "device_list": lambda s, d: views.device_list(read_readings(s, d)),
        "sparkline_temp": lambda s, d: views.sparkline(read_readings(s, d), "temp"),
        "sparkline_kw": lambda s, d: views.sparkline(read_readings(s, d), "kw"),
        "sparkline_short": lambda s, d: views.sparkline(read_readings(s, d), "temp", length=SHORT_SPARKLINE),
        "running_extremes": lambda s, d: running_extremes(read_readings(s, d), "temp"),
        "latency_summary": _latency,
        "latency_merged": _latency_merged,
        "efficiency_rolling_scan": _rolling_scan,
        "one_payloads": _one_payloads,
        "backward_times": _backward_times,
        "stream_backward_times": _stream_backward_times,
        "stream_sparkline_temp": _stream_sparkline("temp"),
        "stream_sparkline_kw": _stream_sparkline("kw"),
        "stream_shared_timeline": _stream_shared_timeline,
        "stream_clustered_timeline": _stream_clustered,
        "stream_latency": _stream_latency,
        "stream_latest_state": _stream_latest_state,
        "stream_status_state": _stream_status_state,
        "decode_extra": _decode_extra,
        "stream_defrost": _stream(defrost_events, "stream-defrost"),
        "stream_door_alerts": _stream(feeds.door_stream, "stream-door"),
        "stream_work_windows": lambda s, d: _stream(feeds.windows_stream, "stream-work")(s, d).drop(
            "window_end"
        ),
        "stream_efficiency_delta": _stream(feeds.efficiency_stream, "stream-delta"),
        "stream_efficiency_rolling": _stream(
            lambda r: efficiency_rolling_stream(feeds.windows_stream(r)), "stream-rolling"
        ),
        "stream_timeline": _stream_timeline,
        "stream_status": _stream_status,
        "stream_late_defrost": lambda s, d: _stream(defrost_events, "late-defrost", _late())(s, d),
        "stream_late_door": lambda s, d: _stream(feeds.door_stream, "late-door", _late())(s, d),
        "stream_late_windows": lambda s, d: _stream(feeds.windows_stream, "late-work", _late())(s, d).drop(
            "window_end"
        ),
    }


# --- oracle ----------------------------------------------------------------

_READINGS = """readings AS (
  SELECT 'device' || user_id::varchar AS device_id,
         1704067200000 + ((epoch_us(ts) - 1704067200000000) // 10000000) AS time_ms,
         event_id AS seq, 'temp' AS sensor_name_1,
         (round(value*100)::bigint % 3000)/100.0::double - 20.0::double AS temp,
         'kws' AS sensor_name_2,
         (200 + 4*cast(json_extract(props,'$.k') AS bigint))/3600.0::double AS kw,
         ts AS event_ts, event_type,
         10*cast(json_extract(props,'$.k') AS bigint) AS delay
  FROM events)"""

_ALL_READINGS = _READINGS.replace("readings AS", "all_readings AS", 1)
_ON_TIME = """readings AS (
  SELECT a.* FROM all_readings a, (SELECT min(time_ms) AS lo, max(time_ms) AS hi FROM all_readings)
  WHERE NOT (event_type = 'error' AND (time_ms - lo) * 4 // (hi - lo + 1) = 0))"""

_PAIRS = """lagged AS (
  SELECT *, lag(time_ms) OVER w AS prev_time_ms, lag(temp) OVER w AS prev_temp, lag(kw) OVER w AS prev_kw
  FROM readings WINDOW w AS (PARTITION BY device_id ORDER BY time_ms, seq)),
pairs AS (
  SELECT device_id, prev_time_ms, time_ms, prev_temp, temp, prev_kw, kw, seq FROM lagged
  WHERE time_ms - prev_time_ms < 10000 AND trunc(temp) > trunc(prev_temp))"""

_WINDOWS = """windows AS (
  SELECT device_id, start_ms + 30000 AS window_end_ms,
         arg_min(temp, (time_ms, seq)) AS temp, sum(kw::decimal(38,12))::double AS work
  FROM (SELECT device_id, time_ms, seq, temp, kw,
               unnest(range(time_ms - time_ms % 1000 - 29000, time_ms + 1, 1000)) AS start_ms
        FROM readings)
  GROUP BY device_id, start_ms)"""

_DELTA = """delta AS (
  SELECT device_id, window_end_ms,
         (lag(temp) OVER (PARTITION BY device_id ORDER BY window_end_ms) - temp) / nullif(work, 0) * 100 AS efficiency
  FROM windows)"""

_STATUS = """door AS (SELECT device_id, arg_max(prev_kw < kw, (time_ms, seq)) AS door_open FROM pairs GROUP BY device_id),
defrost AS (SELECT DISTINCT device_id, true AS defrosted FROM readings WHERE temp >= 0),
eff AS (SELECT device_id, arg_max(efficiency, window_end_ms) AS efficiency FROM delta
        WHERE efficiency IS NOT NULL GROUP BY device_id),
status AS (
  SELECT coalesce(a.device_id, e.device_id) AS device_id, door_open, defrosted, efficiency
  FROM (SELECT coalesce(d.device_id, f.device_id) AS device_id, door_open, defrosted
        FROM door d FULL OUTER JOIN defrost f ON d.device_id = f.device_id) a
  FULL OUTER JOIN eff e ON a.device_id = e.device_id
  UNION ALL
  SELECT device_id, NULL, NULL, NULL FROM (SELECT DISTINCT device_id FROM windows) w
  WHERE NOT EXISTS (SELECT 1 FROM door WHERE door.device_id = w.device_id)
    AND NOT EXISTS (SELECT 1 FROM defrost WHERE defrost.device_id = w.device_id)
    AND NOT EXISTS (SELECT 1 FROM eff WHERE eff.device_id = w.device_id))"""

_TIMELINE = """timeline AS (
  SELECT * FROM readings
  QUALIFY row_number() OVER (PARTITION BY device_id, time_ms ORDER BY seq DESC) = 1)"""

_LATEST = """latest AS (
  SELECT * FROM readings
  QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY time_ms DESC, seq DESC) = 1)"""

_ROLLING = """numbered AS (
  SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY window_end_ms) AS n FROM windows),
rolling AS (
  SELECT device_id, window_end_ms, n, temp AS acc FROM numbered WHERE n = 1
  UNION ALL
  SELECT w.device_id, w.window_end_ms, w.n, (r.acc - w.temp) / nullif(w.work, 0)
  FROM rolling r JOIN numbered w ON w.device_id = r.device_id AND w.n = r.n + 1)"""

_ROLLING_AS_DELTA = "delta AS (SELECT device_id, window_end_ms, 100 * acc AS efficiency FROM rolling)"

_READING_COLUMNS = "device_id, time_ms, seq, sensor_name_1, temp, sensor_name_2, kw"
_STATUS_VIEW = 'SELECT device_id AS "deviceID", door_open AS "door-open", defrosted, efficiency FROM status'
_HTTP_DATE = "strftime(make_timestamp(time_ms * 1000), '%a, %d %b %Y %H:%M:%S GMT')"
_TIMELINE_VIEW = (
    'SELECT device_id AS "deviceID", {time} AS time_stamp, sensor_name_1 AS "sensorName1",'
    ' temp AS "sensorValue1", sensor_name_2 AS "sensorName2", kw AS "sensorValue2" FROM latest'
)
# A value exactly half way between two roundings goes away from zero, as it does
# in the gauge. printf alone would take the even one, so move just these values,
# whose digits after the fourth are a five and zeros, off the half way mark.
_AWAY_FROM_ZERO = """CASE WHEN regexp_full_match(printf('%.60e', abs(efficiency)), '[0-9][.][0-9]{3}50*e.*')
    THEN nextafter(efficiency, sign(efficiency) * 'infinity'::double) ELSE efficiency END"""
_ALL_STATUS = (_READINGS, _PAIRS, _WINDOWS, _DELTA, _STATUS)


def _with(ctes: tuple[str, ...], select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(ctes)} {select}"


def _sparkline_sql(column: str, length: int = 100) -> str:
    return _with(
        (_READINGS,),
        f"""SELECT device_id, row_number() OVER (PARTITION BY device_id ORDER BY age DESC) AS pos,
                   time_ms, value, min_value, max_value
            FROM (SELECT device_id, time_ms, {column} AS value,
                         row_number() OVER (PARTITION BY device_id ORDER BY time_ms DESC, seq DESC) AS age,
                         min({column}) OVER (PARTITION BY device_id) AS min_value,
                         max({column}) OVER (PARTITION BY device_id) AS max_value
                  FROM readings)
            WHERE age <= {length}""",
    )


def oracle_sql() -> dict[str, str]:
    return _sensor_oracle_sql() | _llm_oracle_sql()


def _sensor_oracle_sql() -> dict[str, str]:
    plain = _with((_READINGS,), f"SELECT {_READING_COLUMNS} FROM readings")
    defrost = _with(
        (_READINGS,), "SELECT device_id, true AS defrosted, time_ms, seq FROM readings WHERE temp >= 0"
    )
    pairs = _with((_READINGS, _PAIRS), "SELECT * FROM pairs")
    door = _with(
        (_READINGS, _PAIRS), "SELECT device_id, prev_kw < kw AS door_open, time_ms, seq FROM pairs"
    )
    windows = _with((_READINGS, _WINDOWS), "SELECT device_id, window_end_ms, temp, work FROM windows")
    delta = _with((_READINGS, _WINDOWS, _DELTA), "SELECT * FROM delta")
    rolling = _with(
        (_READINGS, _WINDOWS, _ROLLING),
        "SELECT device_id, window_end_ms, 100 * acc AS efficiency FROM rolling",
        recursive=True,
    )
    status = _with(_ALL_STATUS, "SELECT * FROM status")
    status_view = _with(_ALL_STATUS, _STATUS_VIEW)
    timeline = _with((_READINGS, _TIMELINE), f"SELECT {_READING_COLUMNS} FROM timeline")
    one = f"WHERE device_id = '{ONE_DEVICE}'"
    backward = _with(
        (_READINGS,),
        f"""SELECT device_id, count(*) AS backward, max(greatest_ms - at_ms) AS farthest_ms
            FROM (SELECT device_id, at_ms, max(at_ms) OVER (PARTITION BY device_id ORDER BY seq
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS greatest_ms
                  FROM (SELECT device_id, seq, time_ms - CASE event_type WHEN 'error' THEN {BACKWARD_MS} ELSE 0 END AS at_ms
                        FROM readings))
            WHERE at_ms < greatest_ms GROUP BY device_id""",
    )
    http_view = _TIMELINE_VIEW.format(time=_HTTP_DATE)
    return {
        "readings": plain,
        "decode_json": plain,
        "decode_damaged": f"{plain} WHERE event_type NOT IN ('error', 'purchase', 'signup')",
        "quarantine": """SELECT event_id AS seq,
              CASE event_type WHEN 'signup' THEN 'unusable field' ELSE 'malformed' END AS reason
            FROM events WHERE event_type IN ('error', 'purchase', 'signup')""",
        "float32_time": _with(
            (_READINGS,), "SELECT seq, device_id, cast(cast(time_ms AS float) AS bigint) AS time_ms FROM readings"
        ),
        "defrost_events": defrost,
        "defrost_status": _with(
            (_READINGS,), "SELECT DISTINCT device_id, true AS defrosted FROM readings WHERE temp >= 0"
        ),
        "defrost_status_hot": _with(
            (_READINGS,),
            f"SELECT DISTINCT device_id, true AS defrosted FROM readings WHERE temp >= {HOT_THRESHOLD}",
        ),
        "rising_pairs": pairs,
        "rising_pairs_dense": pairs,
        "door_alerts": door,
        "door_severity": _with(
            (_READINGS, _PAIRS),
            """SELECT device_id, CASE WHEN prev_kw < kw THEN 'alert' ELSE 'warning' END AS severity,
                      time_ms, seq FROM pairs""",
        ),
        "work_windows": windows,
        "work_windows_expanded": windows,
        "efficiency_delta": delta,
        "efficiency_rolling": rolling,
        "status_table": status,
        "status_rolling": _with(
            (_READINGS, _PAIRS, _WINDOWS, _ROLLING, _ROLLING_AS_DELTA, _STATUS), "SELECT * FROM status", recursive=True
        ),
        "status_stored": status,
        "timeline_table": timeline,
        "timeline_stored": timeline,
        "timeline_float32": _with(
            (_READINGS,),
            f"""SELECT {_READING_COLUMNS} FROM
                (SELECT * REPLACE (cast(cast(time_ms AS float) AS bigint) AS time_ms) FROM readings)
                QUALIFY row_number() OVER (PARTITION BY device_id, time_ms ORDER BY seq DESC) = 1""",
        ),
        "timeline_retained": f"""{timeline}
            WHERE event_ts > TIMESTAMP '{RETAINED_AS_OF}' - INTERVAL 7200 SECONDS""",
        "timeline_upserted": timeline,
        "timeline_positions": _with(
            (_READINGS, _TIMELINE),
            """SELECT device_id, time_ms,
                      row_number() OVER (PARTITION BY device_id ORDER BY time_ms DESC) AS position FROM timeline""",
        ),
        "timeline_order": timeline,
        "status_all": status_view,
        "status_quoted": status_view,
        "status_one": f"{status_view} {one}",
        "latest_reading": _with((_READINGS, _LATEST), f"{_TIMELINE_VIEW.format(time='time_ms')} {one}"),
        "latest_per_device": _with((_READINGS, _LATEST), f"SELECT {_READING_COLUMNS} FROM latest"),
        "status_json": status_view,
        "status_pages": status_view,
        "timeline_json": _with((_READINGS, _LATEST), http_view),
        "latest_payload": _with((_READINGS, _LATEST), f"{http_view} {one}"),
        "chart_points": _with(
            (_READINGS, _LATEST),
            """SELECT device_id AS "deviceID", 'Temp' AS chart, temp AS value FROM latest
               UNION ALL SELECT device_id, 'Energy', kw FROM latest""",
        ),
        "status_panel": _with(
            _ALL_STATUS,
            """SELECT device_id, CASE WHEN door_open THEN 'Open' ELSE 'Closed' END AS door,
                      CASE WHEN defrosted THEN 'Thawed' ELSE 'Normal' END AS defrost FROM status""",
        ),
        "efficiency_gauge": _with(
            _ALL_STATUS,
            f"""SELECT device_id, CASE WHEN efficiency IS NOT NULL
                        THEN cast(printf('%.3e', {_AWAY_FROM_ZERO}) AS double) END AS shown,
                      'Δ°F/kw' AS unit,
                      CASE WHEN efficiency IS NOT NULL
                        THEN least(greatest(efficiency, 0.0::double), 5.0::double) END AS gauge_position
               FROM status""",
        ),
        "device_list": _with((_READINGS,), "SELECT DISTINCT device_id FROM readings ORDER BY device_id"),
        "sparkline_temp": _sparkline_sql("temp"),
        "sparkline_kw": _sparkline_sql("kw"),
        "sparkline_short": _sparkline_sql("temp", SHORT_SPARKLINE),
        "running_extremes": _with(
            (_READINGS,),
            """SELECT device_id, time_ms, seq, temp AS value,
                      min(temp) OVER w AS min_so_far, max(temp) OVER w AS max_so_far
               FROM readings
               WINDOW w AS (PARTITION BY device_id ORDER BY time_ms, seq ROWS UNBOUNDED PRECEDING)""",
        ),
        "latency_summary": _with(
            (_READINGS,),
            """SELECT count(*) AS readings, min(delay) AS min_ms, max(delay) AS max_ms,
                      sum(delay)::double / count(*) AS mean_ms,
                      quantile_cont(delay::double, 0.5) AS p50_ms,
                      quantile_cont(delay::double, 0.95) AS p95_ms,
                      quantile_cont(delay::double, 0.99) AS p99_ms FROM readings""",
        ),
        "latency_merged": _with(
            (_READINGS,),
            f"""SELECT q.quantile, count(*) AS readings, min(delay) AS min_ms, max(delay) AS max_ms,
                      sum(delay)::double / count(*) AS mean_ms, true AS within_bound
               FROM readings, (SELECT unnest([{", ".join(f"{q}::DOUBLE" for q in QUANTILES)}]) AS quantile) q
               GROUP BY q.quantile""",
        ),
        "efficiency_rolling_scan": _with(
            (_READINGS.replace("/3600.0::double AS kw", f"/3600.0::double * {STABLE_SCALE} AS kw"), _WINDOWS, _ROLLING),
            "SELECT device_id, window_end_ms, round(100 * acc, 6) AS efficiency FROM rolling",
            recursive=True,
        ),
        "one_payloads": _with(
            (_READINGS,),
            f"""SELECT asked, view, count(device_id) AS items, any_value(device_id) AS "deviceID"
                FROM (SELECT unnest(['{ONE_DEVICE}', '{UNKNOWN_DEVICE}']) AS asked) a,
                     (SELECT unnest(['status', 'timeline']) AS view) v
                LEFT JOIN (SELECT DISTINCT device_id FROM readings) r ON device_id = asked
                GROUP BY asked, view""",
        ),
        "backward_times": backward,
        "stream_backward_times": backward,
        "stream_sparkline_temp": _sparkline_sql("temp"),
        "stream_sparkline_kw": _sparkline_sql("kw"),
        "stream_latest_state": _with(
            (_READINGS.replace("readings AS", "unwritten AS", 1),
             """readings AS (SELECT *, 1704067200000 + (time_ms - 1704067200000) * 10000 AS ingest_ms FROM unwritten)""",
             f"""fresh AS (SELECT * FROM readings
                           WHERE ingest_ms > (SELECT max(ingest_ms) FROM readings) - {LATEST_TTL_SECONDS} * 1000)"""),
            f"""SELECT {_READING_COLUMNS} FROM fresh
                QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY time_ms DESC, seq DESC) = 1""",
        ),
        "stream_shared_timeline": timeline,
        "stream_status_state": status,
        "stream_clustered_timeline": timeline,
        "decode_extra": _with(
            (_READINGS,),
            f"""SELECT {_READING_COLUMNS},
                       '{{"batch":' || (seq % 7) || ',"site":{{"kind":"' || event_type || '"}}}}' AS extra FROM readings""",
        ),
        "stream_latency": _with((_READINGS,), "SELECT count(*) AS readings, true AS in_order FROM readings"),
        "stream_defrost": defrost,
        "stream_door_alerts": door,
        "stream_work_windows": windows,
        "stream_efficiency_delta": delta,
        "stream_efficiency_rolling": rolling,
        "stream_timeline": timeline,
        "stream_status": status,
        # Late readings count where there is no state, and only there.
        "stream_late_defrost": defrost,
        "stream_late_door": _with(
            (_ALL_READINGS, _ON_TIME, _PAIRS), "SELECT device_id, prev_kw < kw AS door_open, time_ms, seq FROM pairs"
        ),
        "stream_late_windows": _with(
            (_ALL_READINGS, _ON_TIME, _WINDOWS), "SELECT device_id, window_end_ms, temp, work FROM windows"
        ),
    }
