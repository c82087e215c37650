"""Answers of several APIs: shapes, records of one form and a report, against Python's own JSON reader."""

import json

from pyspark.sql import functions as F

from vellum import catalogue_queries
from vellum.sources import probes

SF = "/root/testdata/sf0.01"
KINDS = "name string, status int, asked int, body string"


def test_edges(spark):
    rows = [
        ("a", 200, 1, '{"info": {"total": "12"}}'), ("a", 200, 2, '{"info": {"total": [1]}}'), ("a", 200, 3, "{"), ("a", None, 4, '{"info": {"total": 5}}'), ("a", 500, 5, None),
        ("b", 200, 6, '{"data": [{"id": 1, "t": ["x", "y"]}, {"id": null, "t": ""}, 7, null]}'), ("b", 200, 7, '{"data": {"id": 1}}'), ("b", 200, 8, "[]"), ("b", 200, 9, ""), ("b", 200, 10, None),
        ("c", 404, 11, "{}"), ("d", 200, 12, '{"total": 3}'), (None, 200, 13, "{}"),
    ]
    d = spark.createDataFrame(rows, KINDS).withColumn("extra", F.lit(1))
    asked = [probes.Probe("a", total="$.info.total"), probes.Probe("b", items="$.data", fields={"id": "$.id", "t": ("$.none", "$.t[1]", "$.t")}), probes.Probe("c", total="$.n")]
    got = {r.name: tuple(r)[1:] for r in probes.report(d, asked).collect()}
    assert got["a"] == (5, 2, 1, 12, True, "status 500, none")
    assert got["b"] == (5, 0, 2, 4, True, None)
    assert got["c"] == (1, 1, 0, None, None, "status 404")
    assert got["d"] == (1, 0, 0, 0, False, None)  # read, but no probe says how
    seen = [tuple(r) for r in probes.items(d, asked).orderBy("asked", "place").collect()]
    assert seen == [("b", 200, 6, 1, 0, "1", "y"), ("b", 200, 6, 1, 1, None, None), ("b", 200, 6, 1, 2, None, None), ("b", 200, 6, 1, 3, None, None)]
    assert probes.report(d.limit(0), asked).count() == 0 and probes.items(d.limit(0), asked).count() == 0
    shape = {r.name: r.shape for r in probes.shapes(d.where("asked in (6, 7, 12)")).collect()}
    assert shape["d"] == "OBJECT<total: BIGINT>" and shape["b"] == "OBJECT<data: VARIANT>"


def test_whole_tables_equal_a_plain_reader(spark):
    from vellum import function_queries

    t = lambda n: spark.read.parquet(f"{SF}/{n}.parquet")
    works, records = {}, 0
    for r in function_queries.answers(t).collect():
        try:
            v = json.loads(r.body) if r.status == 200 else None
        except ValueError:
            v = None
        if v is None:
            continue
        if r["name"] == "click":
            n = sum("bolt" in x["artist"]["name"].lower() for x in v["data"])
        elif r["name"] == "purchase":
            n = len(v["response"]["rows"])
        else:
            n = v["info"]["total"] if r["name"] == "view" else v["totalResults"]
        records += n if r["name"] in ("click", "purchase") else 0
        works[r["name"]] = works.get(r["name"], 0) + n
    q = catalogue_queries.queries()
    assert {r["name"]: r.works for r in q["s29_probe_report"](spark, SF).collect() if r.works is not None} == works
    assert q["s29_probe_items"](spark, SF).count() == records


def test_each_body_is_read_once_and_only_where_a_list_is_asked_for(spark, capsys):
    body = F.format_string('{"data": [{"id": %d, "t": " "}, {"id": "", "t": "x"}], "rows": [{"n": %d}]}', "id", "id")
    d = spark.range(6).select(F.when(F.col("id") < 2, "a").when(F.col("id") < 4, "b").otherwise("c").alias("name"), F.lit(200).alias("status"), F.col("id").alias("asked"), body.alias("body"))
    asked = [probes.Probe("a", items="$.data", fields={"id": "$.id", "t": ("$.t", "$.id")}, keep=lambda c: c("t").isNotNull()), probes.Probe("b", items="$.rows", fields={"id": "$.n"}), probes.Probe("c", total="$.n", fields={"more": ()})]
    got = probes.items(d, asked)
    got.explain()
    plan = capsys.readouterr().out
    assert plan.count("parseJson") == 1
    assert plan.count("$.t,") <= 3  # twice in the condition, once for what it holds for
    assert sorted(tuple(r) for r in got.collect()) == [("a", 200, 0, 0, "0", "0", None), ("a", 200, 0, 1, None, "x", None), ("a", 200, 1, 0, "1", "1", None), ("a", 200, 1, 1, None, "x", None), ("b", 200, 2, 0, "2", None, None), ("b", 200, 3, 0, "3", None, None)]
    assert probes.items(d, [asked[2]]).count() == 0


def test_events_of_one_file_are_answered_by_all_tasks(spark):
    from vellum import function_queries

    read = function_queries.answers(lambda n: spark.read.parquet(f"{SF}/{n}.parquet")).where("name <> 'page'")
    counts = read.groupBy(F.spark_partition_id()).count().collect()
    assert len(counts) >= 4 and max(r["count"] for r in counts) < 5000
