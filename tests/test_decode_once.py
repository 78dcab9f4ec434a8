"""JSON lines are parsed once a line, also below a filter on what was parsed."""

from emporia.sources import files


def test_lines_are_parsed_once(spark):
    schema = spark.createDataFrame([], "order_id string, quantity long").schema
    text = spark.createDataFrame([('{"order_id": "a"}',), ("not json",), (None,)], "value string")
    good, bad = files.split_quarantine(files.decode_json_column(text, "value", schema))
    assert good._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert sorted(r.order_id or "" for r in good.collect()) == ["", "a"]
    assert [r[0] for r in bad.collect()] == ["not json"]
