import json

import pytest

from helio.operators.normalize import (
    normalize_events,
    normalize_grid,
    normalize_payloads,
    normalize_rows,
    rejected_payloads,
)
from helio.schema import REQUIRED_COLUMNS
from helio.sources import emit_events, read_observations

NOW = "arrived"


def frame(spark, *payloads):
    texts = [p if isinstance(p, str) or p is None else json.dumps(p) for p in payloads]
    return spark.createDataFrame([(t, NOW) for t in texts], "payload string, at string")


def records(df):
    assert tuple(df.columns) == REQUIRED_COLUMNS
    return [tuple(r) for r in df.collect()]


def one(spark, payload):
    (found,) = records(normalize_payloads(frame(spark, payload), arrival="at"))
    return dict(zip(REQUIRED_COLUMNS, found, strict=True))


def test_grid(spark):
    cells = [[1, 2, 3.5], [7], "x", 5, {"a": 1}, [4, "b", "9"], [0, 0, None]]
    found = one(spark, {"Observation Time": "", "Forecast Time": "f", "coordinates": cells})
    assert found == {
        "time_tag": "f",
        "speed": 19.5 / 4,
        "density": 3.0,
        "temperature": 9.0,
        "bx": 19.5 / 4,
        "by": 7.0,
        "bz": 0.0,
        "bt": 9.0,
    }


def test_grid_without_cells(spark):
    found = one(spark, {"coordinates": []})
    assert found.pop("time_tag") == NOW
    assert set(found.values()) == {0.0}


def test_grid_keys_in_an_event_list_mean_nothing(spark):
    found = one(spark, [{"coordinates": [[1, 2, 3]], "speed": 4, "time": "t"}])
    assert (found["time_tag"], found["speed"], found["by"]) == ("t", 4.0, 0.0)


@pytest.mark.parametrize(
    ("props", "outside", "expected"),
    [
        ({"mag": 0, "magnitude": 4.5, "speed": 9}, {}, {"speed": 4.5}),
        ({"mag": 0, "magnitude": None, "speed": 9}, {}, {"speed": 9.0}),
        ({"mag": "abc", "magnitude": 4.5}, {}, {"speed": 0.0}),
        ({"mag": "0", "magnitude": 4.5}, {}, {"speed": 0.0}),
        ({"mag": 0.0, "magnitude": False, "speed": True}, {}, {"speed": 1.0}),
        ({"sig": 3, "score": 4, "bt": 5}, {}, {"bt": 3.0}),
        ({"sig": None, "score": 0, "bt": 5}, {}, {"bt": 5.0}),
        ({"depth": 8}, {"geometry": {"coordinates": [1, 2, 33]}}, {"density": 33.0}),
        ({"depth": 8}, {"geometry": {"coordinates": [1, 2, None]}}, {"density": 0.0}),
        ({"depth": 8}, {"geometry": {"coordinates": [1, 2]}}, {"density": 8.0}),
        ({"depth": 8}, {"geometry": None}, {"density": 8.0}),
        ({"density": 6}, {}, {"density": 0.0}),
        ({"time": 1700000000000}, {"timestamp": "x"}, {"time_tag": "1700000000000"}),
        ({"time": 0}, {"timestamp": "x", "time": "y"}, {"time_tag": "x"}),
        ({"time": ""}, {"time": ""}, {"time_tag": NOW}),
        ({"time_tag": "no", "temperature": "5", "bx": -1, "by": " 2 ", "bz": "z"}, {},
         {"time_tag": NOW, "temperature": 5.0, "bx": -1.0, "by": 2.0, "bz": 0.0}),
    ],
)
def test_feature(spark, props, outside, expected):
    found = one(spark, {"features": [{"properties": props, **outside}]})
    assert {name: found[name] for name in expected} == expected


def test_flat_event_times(spark):
    assert one(spark, {"time_tag": "", "timestamp": None, "time": ""})["time_tag"] == ""
    assert one(spark, {"time_tag": "a", "timestamp": "b"})["time_tag"] == "a"
    assert one(spark, {"timestamp": 0, "time": "c"})["time_tag"] == "c"
    assert one(spark, {"mag": 7, "speed": 3})["speed"] == 3.0
    assert one(spark, {"properties": [1], "speed": 3})["speed"] == 3.0


def test_envelopes(spark):
    event = {"speed": 1, "time": "t"}
    df = frame(
        spark,
        {"features": [event, event]},
        {"features": None, "results": [event]},
        {"features": {}, "speed": 1, "time": "t"},
        [event, event, event],
        event,
        {"features": []},
        {"coordinates": []},
    )
    assert len(records(normalize_events(df))) == 8
    assert len(records(normalize_grid(df))) == 1
    assert len(records(normalize_payloads(df))) == 9


def test_rejects(spark):
    df = frame(spark, "5", '"text"', "{broken", None, [1, {"speed": 1}], {"speed": 1}, [])
    assert records(normalize_payloads(df))[0][1] == 1.0
    bad = [r["payload"] for r in rejected_payloads(df).collect()]
    assert bad == ["5", '"text"', "{broken", None, '[1, {"speed": 1}]']


def test_rows_from_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("bt,timestamp,speed,extra\n1_0,t1, 5 ,x\n,t2,abc,y\n")
    raw = read_observations(spark, str(tmp_path), typed=False)
    found = records(normalize_rows(raw))
    assert sorted(found) == [
        ("t1", 5.0, 0.0, 0.0, 0.0, 0.0, 0.0, 10.0),
        ("t2", 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0),
    ]


def test_emitted_records(spark):
    df = spark.createDataFrame([("t", None, 2.0)], "time_tag string, speed double, bt double")
    assert emit_events(df, "bt").first().asDict() == {
        "key": "2.0",
        "value": '{"time_tag":"t","speed":null,"bt":2.0}',
    }
    assert emit_events(df, "unknown").first()["key"] == "t"
