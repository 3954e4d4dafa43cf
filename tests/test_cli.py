import json

from helio.__main__ import main
from tests.samples import sample


def test_from_csv_to_served_figures(spark, tmp_path, capsys):
    source, base = str(tmp_path / "csv"), str(tmp_path / "batch")
    sample(spark).coalesce(1).write.option("header", True).csv(source)
    main(["batch", "--input", source, "--output", base])
    main(["snapshots", "--input", source, "--output", str(tmp_path / "speed" / "live"),
          "--checkpoint", str(tmp_path / "checkpoint"), "--once"])
    capsys.readouterr()
    main(["merge", "--output", base])
    merged = json.loads(capsys.readouterr().out)
    assert merged == {
        "time_tag": "2026-07-26T09:45:00Z",
        "current_speed": 620.0,
        "rolling_avg_speed": 597.5,
        "historical_avg_speed": 567.5,
        "historical_p95_speed": 705.0,
        "historical_p99_speed": 731.0,
        # 597.5 scores 3, a density of 9.35 scores 4 and a field of 6.4 scores 3
        "disturbance_score": 10,
        "risk_band": "high",
    }
    main(["merge", "--output", base, "--view"])
    assert json.loads(capsys.readouterr().out)["freshness_gap"] == 52.5
    main(["benchmark", "--input", source])
    assert json.loads(capsys.readouterr().out) == {"records": 20, "avg_speed": 567.5, "max_speed": 731.0}


def test_produce(spark, tmp_path):
    (tmp_path / "broken.json").write_text("no payload")
    (tmp_path / "p.json").write_text('{"features": [\n{"speed": 1, "time": "t"},\n{"speed": 2}]}')
    out = str(tmp_path / "out")
    main(["produce", "--source", "payloads", "--input", str(tmp_path / "*.json"), "--output", out])
    assert spark.read.json(f"{out}-rejects").first()["payload"] == "no payload"
    rows = {r["speed"]: r["time_tag"] for r in spark.read.json(out).collect()}
    assert rows[1.0] == "t"
    assert rows[2.0].endswith("Z")


def test_produce_goes_on_from_its_checkpoint(spark, tmp_path):
    (tmp_path / "in").mkdir()
    out, told = str(tmp_path / "out"), ["--checkpoint", str(tmp_path / "checkpoint"), "--once"]
    for i, text in enumerate(['{"speed": 1, "time": "t"}', "no payload", '[\n{"speed": 2, "time": "u"}]']):
        (tmp_path / "in" / f"{i}.json").write_text(text)
        main(["produce", "--source", "payloads", "--input", str(tmp_path / "in"), "--output", out, *told])
    sent = spark.read.schema("key string, value string, batch_id int").json(out).collect()
    assert {(r["key"], json.loads(r["value"])["speed"], r["batch_id"]) for r in sent} == {("t", 1.0, 0), ("u", 2.0, 2)}
    assert [r["payload"] for r in spark.read.json(f"{out}-rejects").collect()] == ["no payload"]
