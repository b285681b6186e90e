"""Records of JSON arrays that are read in pieces."""

import json
import random

import pytest
from pyspark.sql import types as T

from riverstat.sources import json_records, services

RECORD = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType()), T.StructField("v", T.DoubleType())])
PLAIN = ["plain", 'a"b', "\\", "{open", "", None]
BRACES = [*PLAIN, 'q"u}o{te', "back\\slash}", "}}{{", '{"a":1},', "ünï}", '\\"}\\', "x\ny}"]


@pytest.fixture(params=[300, 128 << 20])
def splits(spark, request):
    """Splits far smaller than a file, and none."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def put(folder, name, value, indent=None):
    (folder / name).write_text(json.dumps(value, indent=indent, ensure_ascii=False), encoding="utf-8")


def test_records_equal_the_json_module(spark, tmp_path, splits):
    rng, expected = random.Random(3), []
    for number, size in enumerate([60, 0, 1, 60, 40]):
        texts = BRACES if number % 2 else PLAIN
        records = [{"id": 1000 * number + i, "t": rng.choice(texts), "v": rng.random()} for i in range(size)]
        expected += [tuple(r.values()) for r in records]
        put(tmp_path, f"{number}.json", records, rng.choice([None, 2]))
    objects = json_records.read_objects(spark, str(tmp_path))
    found = [tuple(r) for r in json_records.parsed(json_records.elements(objects), RECORD).collect()]
    assert sorted(found, key=lambda r: r[0]) == sorted(expected, key=lambda r: r[0])


def test_one_record_a_line_or_alone(spark, tmp_path):
    (tmp_path / "lines.json").write_text('{"id": 1}\n{"id": 2, "t": "}"}\n')
    (tmp_path / "one.json").write_text('\n {"id": 3} ')
    objects = json_records.read_objects(spark, str(tmp_path))
    assert sorted(r.id for r in json_records.parsed(json_records.elements(objects), RECORD).collect()) == [1, 2, 3]


def test_data_sets_before_and_behind_their_points(spark, tmp_path, splits):
    points = [{"timestamp": f"t{i}", "value": i / 4, "comment": "}" if i % 7 == 0 else "c"} for i in range(50)]
    attributes = {"identifier": "T@1", "label": "a } \"dataset\": {", "parameter": "pH"}
    put(tmp_path, "a.json", {"numPoints": [50], "dataset": attributes, "points": points})
    put(tmp_path, "b.json", {"points": points, "numPoints": [50], "dataset": {**attributes, "identifier": "T@2"}}, 1)
    put(tmp_path, "c.json", {"numPoints": [0], "points": [], "dataset": attributes})
    put(tmp_path, "d.json", {"numPoints": [0], "points": []})
    rows = services.read_datasets(spark, str(tmp_path)).collect()
    assert sorted((r.identifier, r.label, r.timestamp, r.value, r.comment) for r in rows) == sorted(
        (name, attributes["label"], *p.values()) for name in ("T@1", "T@2") for p in points
    )


@pytest.mark.parametrize("value, message", [
    ({"points": [{"timestamp": "t", "value": {"x": 1}}], "dataset": {}}, "objects inside"),
    ({"points": [{"timestamp": "t"}], "notes": [{"timestamp": "n"}], "dataset": {}}, "another name"),
    ({"points": [{"timestamp": "t"}], "dataset": {"label": "a"}, "other": {"dataset": {"label": "b"}}}, "more than one"),
    ([{"points": [{"timestamp": "t"}], "dataset": {"label": "a"}}], "objects inside"),
])
def test_other_layouts_are_errors(spark, tmp_path, value, message):
    put(tmp_path, "x.json", value)
    with pytest.raises(Exception, match=message):
        services.read_datasets(spark, str(tmp_path)).collect()
