"""Sources, packages and the streaming variants."""

import pytest

from pyspark.sql import functions as F

from plumbline.contracts import TableContract
from plumbline.operators.normalise import normalise
from plumbline.session import new_folder
from plumbline.sources import files as f
from plumbline.streaming import incremental as inc

from .conftest import rows

FOLDER = "/root/testdata/sf0.001"


def test_first_alias_wins(frame):
    contract = TableContract("pl_dim_x", ("code", "rate", "gone"), ("code",), numeric=("rate",), aliases={"code": ("编号", "school code")})
    df = frame("`School_Code` string, `编号` string, ` RATE ` string", ("x", " 7 ", "12.5%"), ("y", "", "1,200"))
    assert rows(normalise(df, contract)) == [("7", 0.125, None), (None, 1200.0, None)]


def test_locations(frame):
    lon, lat = f.split_location(F.col("t"))
    df = frame("t string", ("120.5, 30",), ("bad",), (None,))
    assert rows(df.select(lon, lat)) == [(120.5, 30.0), (None, None), (None, None)]


def test_sheets_take_the_first_rule(frame):
    df = frame("sheet string", ("A science",), ("A",), ("none",))
    got = f.route_sheets(df, "sheet", [("exact", "A", "b1", "s1"), ("contains", "science", "b2", "s2")])
    assert rows(got) == [("A science", "b2", "s2"), ("A", "b1", "s1"), ("none", None, None)]


def test_stream_gives_the_batch_result(spark):
    events = spark.read.parquet(f"{FOLDER}/events.parquet").select("user_id", "ts", "event_id", "event_type")
    source, table, state = (new_folder(spark, x) for x in ("events", "latest", "state"))
    events.repartition(4).write.parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = inc.keep_latest(stream, ["user_id"], ["ts", "event_id"], table, state).trigger(availableNow=True).start()
    query.awaitTermination()
    want = f.latest_wins(events, events.limit(0), ["user_id"], ["ts", "event_id"])
    assert rows(inc.read_latest(spark, table, ["user_id"], ["ts", "event_id"]), "user_id", "event_id") == rows(want, "user_id", "event_id")

    inc.compact_latest(spark, table, ["user_id"], ["ts", "event_id"], upto=2)
    assert {r[0] for r in spark.read.parquet(table).select(inc.BATCH).distinct().collect()} == {2, 3}
    assert rows(inc.read_latest(spark, table, ["user_id"], ["ts", "event_id"]), "user_id", "event_id") == rows(want, "user_id", "event_id")

    health, state = new_folder(spark, "health"), new_folder(spark, "state")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    inc.keep_health(stream, "user_id", F.col("event_type") == "error", health, state).trigger(availableNow=True).start().awaitTermination()
    direct = events.groupBy("user_id").agg(F.count(F.lit(1)), F.count_if(F.col("event_type") == "error"))
    assert rows(inc.read_health(spark, health, "user_id"), "user_id", "check_count", "blocked_count") == rows(direct)


def test_tree_of_any_depth(spark):
    from plumbline.sources.files import flatten_districts

    leaf = "code string, name string, level string"
    node = f"struct<{leaf.replace(' string', ':string')}>"
    schema = f"node struct<{leaf.replace(' string', ':string')},districts:array<struct<{leaf.replace(' string', ':string')},districts:array<struct<{leaf.replace(' string', ':string')},districts:array<{node}>>>>>>"
    tree = (("0", "Land", "country", [("1", "P", "province", [("2", "C", "city", [("3", "D", "district"), ("4", "E", "street")])])]),)
    found = flatten_districts(spark.createDataFrame([tree], schema))
    assert sorted(tuple(r) for r in found.select("code", "province", "city", "depth").collect()) == [
        ("0", None, None, 0), ("1", "P", None, 1), ("2", "P", "C", 2), ("3", "P", "C", 3), ("4", "P", "C", 3),
    ]


def test_faulty_packages_are_refused(spark, tmp_path):
    from plumbline.contracts import TableContract
    from plumbline.sources import packages as pk

    contract = TableContract(name="pl_fact_visits", columns=("k", "v"), key=("k",), required=("v",))
    make = lambda *r: spark.createDataFrame(list(r), "k int, v string, package_id string")
    for i, bad in enumerate((make((1, "a", "p"), (2, "", "q")), make((1, "a", "p"), (1, "b", "p")), make((1, None, "p")))):
        with pytest.raises(ValueError, match="quality errors"):
            pk.write_packages(bad, contract, f"{tmp_path}/{i}", "package_id")
        assert not (tmp_path / str(i)).exists()
    root = f"{tmp_path}/good"
    pk.write_packages(make((1, "a", "p"), (1, "b", "q")), contract, root, "package_id")
    entries, quality = pk.read_manifest(spark, root, contract.name), pk.read_quality(spark, root, contract.name)
    assert pk.manifest_violations(entries, pk.file_hashes(spark, root, contract.name), quality).collect() == []
    assert sorted((r["package_id"], r["row_count"], r["error_count"]) for r in quality.collect()) == [("p", 1, 0), ("q", 1, 0)]


def test_quoted_cells_with_line_breaks(spark, tmp_path):
    from plumbline.sources.files import scan_delimited

    (tmp_path / "a.csv").write_text('\ufeffa,b\n1,"x\ny ""z"", w"\n2,q\n', encoding="utf-8")
    assert [tuple(r) for r in scan_delimited(spark, str(tmp_path), line_breaks=True).collect()] == [("1", 'x\ny "z", w'), ("2", "q")]
