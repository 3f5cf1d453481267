from datetime import datetime, timezone

from frostline.schema import READING_SCHEMA


def readings(spark, rows, device="d"):
    """Readings from (time_ms, temp, kw) or (device, time_ms, temp, kw), in order of arrival."""
    full = []
    for n, row in enumerate(rows):
        name, time_ms, temp, kw = row if len(row) == 4 else (device, *row)
        ts = datetime.fromtimestamp(time_ms / 1000, timezone.utc)
        full.append((name, time_ms, ts, n, "temp", float(temp), "kws", float(kw)))
    return spark.createDataFrame(full, READING_SCHEMA)


def tuples(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())
