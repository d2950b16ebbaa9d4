from __future__ import annotations

import json

import pytest

from orderflow.operators.wire import (
    judge_wire,
    orderless,
    parse_wire,
    parse_wire_variant,
    split_wire,
    stringify_wire,
)
from orderflow.schemas import STAGING, WIRE, assert_schema
from orderflow.sources.stage import (
    Stage,
    mark_ready,
    purge_batches,
    read_lines,
    read_wire,
    ready_batches,
    short_batches,
    sweep_unfinished,
    write_wire,
)
from tests.rows import bag, dicts, wire

# Three wire lines as older and newer writers leave them.
GOOD = {
    "salesorderid": "43659", "sys_change_op": "U", "OrderDate": "2011-05-31 00:00:00",
    "orderupdatedtm": "2011-06-07 00:00:00", "ProductID": "776", "productname": "road bike",
    "PostalCode": "98011", "productorderqty": "1", "productsales": "2024.994000",
    "job_exec_id": "7",
}
OLD = dict.fromkeys(WIRE.names, "None") | {
    "salesorderid": "43660", "sys_change_op": "D", "job_exec_id": "7",
}
SHORT = {"salesorderid": "43661", "sys_change_op": "D", "job_exec_id": "7"}


def written(tmp_path, *rows):
    stage = Stage(str(tmp_path))
    folder = tmp_path / "data" / "batch=7"
    folder.mkdir(parents=True)
    (folder / "part-0.json").write_text("".join(json.dumps(r) + "\n" for r in rows))
    return stage


def test_parse(spark, tmp_path):
    typed = parse_wire(read_wire(spark, written(tmp_path, GOOD, OLD, SHORT), [7]), "None")
    assert typed.schema.simpleString() == STAGING.simpleString()
    good, old, short = sorted(dicts(typed), key=lambda r: r["salesorderid"])
    assert (good["productid"], str(good["orderdate"])) == (776, "2011-05-31")
    assert (good["productsales"], str(good["orderupdatedtm"])) == (2024.994, "2011-06-07 00:00:00")
    assert old == short | {"salesorderid": 43660}
    assert short["productid"] is None and short["src_cdt_batch_id"] == 7


def test_a_value_that_does_not_fit_fails_the_load(spark, tmp_path):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        parse_wire(read_wire(spark, written(tmp_path, OLD), [7])).collect()


def test_or_goes_to_the_side(spark):
    lines = wire(spark, GOOD, OLD | {"OrderDate": "soon"}, SHORT)
    good, bad = split_wire(judge_wire(lines, "None"), "None")
    assert [r["salesorderid"] for r in dicts(good)] == [43659, 43661]
    assert [(r["OrderDate"], r["problem"]) for r in dicts(bad)] == [("soon", "unreadable orderdate")]


def test_a_cut_off_line_fails_a_strict_read(spark, tmp_path):
    stage = written(tmp_path, GOOD, SHORT)
    with open(tmp_path / "data" / "batch=7" / "part-0.json", "a") as f:
        f.write(json.dumps(GOOD)[:40] + "\n")
    for lines in (read_wire(spark, stage, [7]), read_lines(spark, stage, [7])):
        with pytest.raises(Exception, match="MALFORMED_RECORD"):
            lines.collect()


def test_whole_orders_go_to_the_side(spark, tmp_path):
    """One line of an order is cut off, one of another is unreadable: none of their
    lines is loaded, and each is kept with its reason."""
    two = GOOD | {"salesorderid": "2"}
    stage = written(tmp_path, GOOD, two, two | {"ProductID": "5"}, SHORT | {"salesorderid": "3"})
    with open(tmp_path / "data" / "batch=7" / "part-1.json", "w") as f:
        f.write(json.dumps(two | {"ProductID": "6"})[:60] + "\n")
        f.write(json.dumps(SHORT | {"salesorderid": "3", "productorderqty": "many"}) + "\n")
    lines = read_lines(spark, stage, [7], strict=False)
    judged = judge_wire(lines).cache()
    good, bad = split_wire(judged)
    assert [r["salesorderid"] for r in dicts(good)] == [43659]
    assert sorted((r["about"], r["problem"], r["batch"]) for r in dicts(bad)) == [
        (2, "another line of the order", 7), (2, "another line of the order", 7), (2, "not JSON", 7),
        (3, "another line of the order", 7), (3, "unreadable productorderqty", 7),
    ]
    assert orderless(judged).count() == 0


def test_a_number_cut_off_is_not_taken_for_an_order(spark, tmp_path):
    stage = written(tmp_path, GOOD)
    with open(tmp_path / "data" / "batch=7" / "part-1.json", "w") as f:
        f.write('{"salesorderid":"436\n{"salesorderid":436\n{"ProductID":"5"}\n')
    judged = judge_wire(read_lines(spark, stage, [7], strict=False))
    assert sorted(r["problem"] for r in dicts(orderless(judged))) == ["no order", "not JSON", "not JSON"]


def test_the_word_none_is_text_or_null_as_told(spark):
    lines = wire(spark, OLD, GOOD | {"productname": "None"})
    told = split_wire(judge_wire(lines, "None"), "None")[0]
    assert sorted((r["salesorderid"], r["productname"]) for r in dicts(told)) == [(43659, None), (43660, None)]
    untold = split_wire(judge_wire(lines))[0]
    assert [(r["salesorderid"], r["productname"]) for r in dicts(untold)] == [(43659, "None")]


def test_variant_equals_the_declared_fields(spark):
    rows = [GOOD, SHORT, GOOD | {"productname": ""}, GOOD | {"salesorderid": 12, "productsales": 1.5}]
    lines = spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")
    path_read = parse_wire_variant(lines)
    assert path_read.drop("more").schema.simpleString() == STAGING.simpleString()
    assert {r["more"] for r in dicts(path_read)} == {None}
    declared = parse_wire(wire(spark, *[{k: str(v) for k, v in r.items()} for r in rows]))
    assert sorted(map(repr, dicts(path_read.drop("more")))) == sorted(map(repr, dicts(declared)))


def test_variant_keeps_added_fields(spark):
    line = json.dumps(GOOD | {"colour": "red", "size": {"cm": 4}})
    got = dicts(parse_wire_variant(spark.createDataFrame([(line,)], "value string")))[0]
    assert json.loads(got["more"]) == {"colour": "red", "size": '{"cm":4}'}
    assert got["productid"] == 776


def test_short_batches(spark, tmp_path):
    stage = Stage(str(tmp_path))
    for batch in (1, 2, 3):
        write_wire(captured(spark), stage, batch)
    assert short_batches(spark, stage).count() == 0
    mark_ready(spark, stage, 2, 9)
    purge_batches(spark, stage, [3])
    mark_ready(spark, stage, 3, 1)
    assert sorted(map(tuple, short_batches(spark, stage).collect())) == [(2, 9, 3), (3, 1, 0)]


def test_what_failed_captures_left_is_swept(spark, tmp_path):
    stage = Stage(str(tmp_path))
    write_wire(captured(spark), stage, 1)
    for folder in ("data/batch=2", "data/batch=4", "work/batch=1", "work/batch=4"):
        (tmp_path / folder).mkdir(parents=True)
    sweep_unfinished(spark, stage, 4)
    left = sorted(str(p.relative_to(tmp_path)) for f in ("data", "work") for p in (tmp_path / f).iterdir())
    assert left == ["data/batch=1", "data/batch=4", "work/batch=4"]


def test_empty_text_is_not_null(spark):
    assert dicts(parse_wire(wire(spark, GOOD | {"productname": ""}), "None"))[0]["productname"] == ""


CAPTURED = (
    "salesorderid long, sys_change_op string, OrderDate timestamp_ntz, "
    "orderupdatedtm timestamp_ntz, ProductID long, productname string, PostalCode string, "
    "productorderqty int, productsales decimal(18,4), job_exec_id long"
)


def captured(spark):
    return spark.sql(
        """select * from values
        (1L, 'I', timestamp_ntz'2020-01-01 00:00:00', timestamp_ntz'2020-01-01 05:06:07', 5L,
         'a "quoted" name', '00007', 2, 1.5000BD, 9L),
        (2L, 'D', null, null, null, null, null, null, null, 9L),
        (3L, 'D', null, null, null, null, null, null, null, 9L)"""
    ).toDF(*WIRE.names)


def test_text_form(spark):
    first = dicts(stringify_wire(captured(spark)))[0]
    assert first["orderupdatedtm"] == "2020-01-01 05:06:07"
    assert (first["salesorderid"], first["productsales"]) == ("1", "1.5000")


def test_round_trip_counts_and_ready_file(spark, tmp_path):
    stage = Stage(str(tmp_path))
    counts = write_wire(captured(spark), stage, 9)
    assert counts == {"total": 3, "I": 1, "U": 0, "D": 2}
    assert [tuple(r) for r in ready_batches(spark, stage).collect()] == [(9, 3)]
    lines = [json.loads(x) for p in (tmp_path / "data/batch=9").glob("*.json") for x in open(p)]
    assert {"salesorderid": "2", "sys_change_op": "D", "job_exec_id": "9"} in lines  # no NULLs
    back = {r["salesorderid"]: r for r in dicts(parse_wire(read_wire(spark, stage, [9])))}
    assert back[1]["productname"] == 'a "quoted" name' and back[1]["postalcode"] == "00007"
    assert back[2]["orderdate"] is None


def test_an_empty_batch_is_readable(spark, tmp_path):
    stage = Stage(str(tmp_path))
    assert write_wire(captured(spark).where("false"), stage, 1)["total"] == 0
    assert read_wire(spark, stage, [1]).count() == 0


def test_purge(spark, tmp_path):
    stage = Stage(str(tmp_path))
    for batch in (1, 2):
        write_wire(captured(spark), stage, batch)
    purge_batches(spark, stage, [1])
    assert [p.name for p in (tmp_path / "data").iterdir()] == ["batch=2"]
    assert [p.name for p in (tmp_path / "ready").iterdir()] == ["batch=2"]


def test_assert_schema(spark):
    df = spark.createDataFrame([("x", 1)], "b string, a long")
    assert assert_schema(df, spark.createDataFrame([(1, "x")], "a long, b string").schema).columns == ["a", "b"]
    with pytest.raises(ValueError, match="mismatch"):
        assert_schema(df, STAGING)


def test_lines_of_a_packed_stage(spark, tmp_path):
    stage = Stage(str(tmp_path), "gzip")
    write_wire(captured(spark), stage, 9)
    files = list((tmp_path / "data/batch=9").glob("part-*"))
    assert files and all(f.name.endswith(".json.gz") for f in files)
    plain = Stage(str(tmp_path / "plain"))
    write_wire(captured(spark), plain, 9)
    assert bag(read_wire(spark, stage, [9])) == bag(read_wire(spark, plain, [9]))
    assert short_batches(spark, stage).collect() == []
