import json

import pytest
from helpers import readings, tuples
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frostline.operators.work import work_windows
from frostline.sources import messages as M
from frostline.sources.kafka import kafka_options, messages_from_records
from frostline.sources.messages import decode, encode, quarantine
from frostline.sources.replay import read_json_array

GOOD = '{"time": 5.9, "device-id": "d", "sensor-name-1": "temp", "sensor-value-1": %s, "sensor-name-2": "kws", "sensor-value-2": %s}'
BAD = {
    "broken": (GOOD % (1, 2))[:-1],
    "missing key": '{"time": 1, "device-id": "d"}',
    "text number": GOOD % ('"1"', 2),
    "infinite temp": GOOD % ("1e400", 2),
    "infinite energy": GOOD % (1, "1e400"),
    "energy out of range": GOOD % (1, "1e13"),
    "no number": GOOD % ("NaN", 2),
    "null": None,
}


def messages(spark, values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, seq long")


def test_bad_messages_are_quarantined(spark):
    m = messages(spark, [GOOD % (1, 2), *BAD.values(), GOOD % ("1e30", 5e9)])
    assert tuples(decode(m), "seq", "time_ms") == [(0, 5), (len(BAD) + 1, 5)]
    assert tuples(quarantine(m), "seq") == [(i + 1,) for i in range(len(BAD))]
    assert work_windows(decode(m)).count() == 30


@pytest.mark.parametrize("kind", BAD)
def test_failfast_ends_the_job(spark, kind):
    with pytest.raises(Exception, match="bad reading"):
        decode(messages(spark, [GOOD % (1, 2), BAD[kind]]), mode="FAILFAST").collect()


def test_decode_undoes_encode(spark):
    r = readings(spark, [(7, -1.5, 0.25), (9, 2.0, 0.5)])
    assert tuples(decode(encode(r)), *r.columns) == tuples(r, *r.columns)


def test_kafka_options_and_order(spark):
    options = kafka_options(servers="h:1", topic="t", group="g", starting="earliest", max_per_trigger=7)
    assert options == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "groupIdPrefix": "g",
        "startingOffsets": "earliest", "maxOffsetsPerTrigger": "7",
    }
    assert "maxOffsetsPerTrigger" not in kafka_options()
    kind = "value binary, offset long, partition int"
    rows = [(b"a", o, p) for o in (0, 1, 2**40) for p in (0, 4095, 4096, 65535)]
    seqs = [r["seq"] for r in messages_from_records(spark.createDataFrame(rows, kind)).collect()]
    assert len(set(seqs)) == len(rows) and seqs == sorted(seqs)
    with pytest.raises(Exception, match="too large for seq"):
        messages_from_records(spark.createDataFrame([(b"a", 0, 65536)], kind)).collect()


def test_json_array_file(spark, tmp_path):
    rows = [{"a": 1, "b": "x"}, {"a": 2}]
    (tmp_path / "one.json").write_text(json.dumps(rows, indent=1))
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    assert tuples(read_json_array(spark, str(tmp_path), schema), "a") == [(1,), (2,)]


def test_other_keys_of_a_message_are_kept(spark, tmp_path):
    good = '{"time": 5.0, "device-id": "a", "sensor-name-1": "temp", "sensor-value-1": 1.5, "sensor-name-2": "kws", "sensor-value-2": 2'
    rows = [
        (1, good + ', "z": [1, "two", null], "a": {"b": 1.5}, "t": true}'),
        (2, good + "}"),
        (3, '{"time": 5.0, "site": "x"}'),
        (4, "{broken"),
        (5, None),
    ]
    messages = spark.createDataFrame(rows, "seq long, value string")
    got = M.decode_with_extra(messages)
    plain = M.decode(messages)
    assert sorted(map(tuple, got.drop("extra").collect())) == sorted(map(tuple, plain.collect()))
    text = M.extra_json(F.col("extra"))
    want = {1: '{"a":{"b":1.5},"t":true,"z":[1,"two",null]}', 2: None}
    assert {r["seq"]: r["json"] for r in got.select("seq", text.alias("json")).collect()} == want
    got.write.parquet(str(tmp_path / "kept"))  # and it can be stored
    again = spark.read.parquet(str(tmp_path / "kept")).select("seq", text.alias("json"))
    assert {r["seq"]: r["json"] for r in again.collect()} == want
    bad = M.rejected(M.with_extra(M.parse(messages)), keep=("extra",)).select("seq", text.alias("json"))
    assert {r["seq"]: r["json"] for r in bad.collect()} == {3: '{"site":"x"}', 4: None, 5: None}
