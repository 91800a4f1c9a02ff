import os
import time
import uuid
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException

from zonecast.session import materialize, shared_dir
from zonecast.sources import bronze, inspect, sinks


def test_ingest_unites_drifting_schemas_and_skips_corrupt_files(spark, tmp_path):
    a, b, c = (str(tmp_path / f"trips_2024-0{i}.parquet") for i in (1, 2, 3))
    spark.sql("SELECT 1 AS zone, CAST(2.5 AS DECIMAL(5,2)) AS fare, DATE'2024-01-01' AS day").coalesce(1).write.parquet(a)
    spark.sql("SELECT CAST(2 AS BIGINT) AS zone, 'x' AS flag, ARRAY(1) AS odd").coalesce(1).write.parquet(b)
    os.makedirs(c)
    with open(os.path.join(c, "part-0.parquet"), "wb") as f:
        f.write(b"not a parquet file")
    with pytest.raises(ValueError, match="damaged"):
        bronze.ingest(spark, [c, b, a])
    df, damaged = bronze.ingest(spark, [c, b, a], skip_damaged=True)
    assert [(r["path"], "not a Parquet file" in r["reason"]) for r in damaged.collect()] == [(c, True)]
    assert {f.name: f.dataType.simpleString() for f in df.schema.fields if not f.name.startswith("_")} == {
        "zone": "double", "fare": "double", "day": "timestamp_ntz", "flag": "string", "odd": "string",
    }
    rows = {r["zone"]: r for r in df.collect()}
    assert rows[1.0]["fare"] == 2.5 and rows[1.0]["flag"] is None and rows[1.0]["_layer"] == "bronze"
    assert rows[1.0]["day"] == datetime(2024, 1, 1) and "trips_2024-01" in rows[1.0]["_source_file"]
    assert rows[2.0]["fare"] is None and rows[2.0]["flag"] == "x"


def jobs_of(spark, run):
    """The number of Spark jobs that ``run`` starts."""
    group = f"count-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        run()
        time.sleep(1)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_schemas_of_many_files_in_as_many_jobs_as_of_few(spark, tmp_path):
    paths = []
    for i in range(40):
        paths.append(str(tmp_path / f"m{i}.parquet"))
        pq.write_table(pa.table({"v": pa.array([i], [pa.int32(), pa.int64()][i % 2])}), paths[-1])
    few, many = jobs_of(spark, lambda: bronze.probe_schemas(spark, paths[:4])), jobs_of(spark, lambda: bronze.probe_schemas(spark, paths))
    assert few == many <= 6
    groups, damaged = bronze.probe_schemas(spark, ["file://" + p for p in paths])
    assert sorted(map(len, groups.values())) == [20, 20] and not damaged


@pytest.mark.parametrize("content", [b"", b"PAR1", b"PAR1" + bytes(40), b"PAR1" + bytes(20) + b"\x08\0\0\0PAR1", b"PAR1" + b"\xff" * 30 + b"\x10\0\0\0PAR1"])
def test_damage_is_told_by_bytes(spark, tmp_path, content):
    good, bad = str(tmp_path / "good.parquet"), str(tmp_path / "bad.parquet")
    pq.write_table(pa.table({"v": [1]}), good)
    with open(bad, "wb") as f:
        f.write(content)
    groups, damaged = bronze.probe_schemas(spark, [bad, good])
    assert list(groups.values()) == [[good]] and [p for p, _ in damaged] == [bad] and "bad.parquet" in damaged[0][1]


def test_a_file_that_may_not_be_read_is_an_error(spark, tmp_path):
    """A folder whose listing fails proves no damage."""
    with pytest.raises(Exception, match="none|PATH_NOT_FOUND|not exist"):
        bronze.probe_schemas(spark, [str(tmp_path / "none.parquet")])


def test_files_of_one_schema_share_a_scan(spark, tmp_path):
    paths = []
    for i in range(6):
        paths.append(str(tmp_path / f"m{i}.parquet"))
        kind = "INT" if i % 2 else "BIGINT"
        spark.sql(f"SELECT CAST({i} AS {kind}) AS v").coalesce(1).write.parquet(paths[-1])
    df, _ = bronze.ingest(spark, paths)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
    assert sorted(r["v"] for r in df.collect()) == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]


def test_ingest_without_any_readable_file(spark, tmp_path):
    # An absent path proves no damage, so it is an error even when damaged files may be skipped.
    with pytest.raises(AnalysisException):
        bronze.ingest(spark, [str(tmp_path / "none.parquet")], skip_damaged=True)


def test_read_table_by_suffix(spark, tmp_path):
    report = spark.sql("SELECT 'a' AS name, 1.5D AS score")
    sinks.write_csv(report, str(tmp_path / "r.csv"))
    assert bronze.read_table(spark, str(tmp_path / "r.csv")).collect()[0].asDict() == {"name": "a", "score": 1.5}
    with pytest.raises(ValueError):
        bronze.read_table(spark, "x.txt")


def test_discovery_and_fallback_candidates(spark, tmp_path):
    new, old = tmp_path / "new", tmp_path / "old"
    for folder, name in ((new, "b-2024-02.parquet"), (old, "a-2024-01.parquet"), (old, "notes.txt")):
        folder.mkdir(exist_ok=True)
        (folder / name).write_bytes(b"x")
    found = bronze.discover(spark, [str(new), str(old), str(new), str(tmp_path / "absent")])
    assert [os.path.basename(p) for p in found] == ["a-2024-01.parquet", "b-2024-02.parquet"]
    templates = [str(new) + "/b-{year}-{month:02d}.parquet", str(old) + "/a-{year}-{month:02d}.parquet"]
    names = [os.path.basename(p) for p in bronze.context_candidates(2024, 1, templates)]
    assert names == ["b-2023-12.parquet", "a-2023-12.parquet", "a-2023-01.parquet", "b-2023-01.parquet"]
    assert bronze.first_available(spark, bronze.context_candidates(2024, 2, templates)).endswith("a-2024-01.parquet")
    assert bronze.first_available(spark, bronze.context_candidates(2025, 1, templates)).endswith("a-2024-01.parquet")
    assert bronze.first_available(spark, bronze.context_candidates(2030, 1, templates)) is None


def test_partition_overwrite_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.sql("SELECT explode(array(1, 2)) AS month, 2024 AS year, 10 AS v")
    assert sinks.overwrite_partitions(first, path, ["year", "month"]) == {"rows": 2, "columns": 3}
    sinks.overwrite_partitions(spark.sql("SELECT 2 AS month, 2024 AS year, 99 AS v"), path, ["year", "month"])
    assert {(r.month, r.v) for r in spark.read.parquet(path).collect()} == {(1, 10), (2, 99)}


def test_overwrite_replaces_the_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite(spark.sql("SELECT 1 AS a"), path)
    sinks.overwrite(spark.sql("SELECT 'x' AS b, 2 AS c"), path)
    row = sinks.read_back(spark, path).collect()[0]
    assert (row["rows"], row["columns"], row["column_list"]) == (1, 2, "b,c")


def test_null_safe_write(spark, tmp_path):
    df = spark.sql("SELECT CAST(NULL AS DOUBLE) AS empty, CAST(NULL AS STRING) AS s, TIMESTAMP'2024-01-01 00:00:00' AS t, 1 AS n UNION ALL SELECT NULL, 'a', NULL, NULL")
    out = sinks.write_null_safe(df, str(tmp_path / "t"))
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["string", "string", "timestamp_ntz", "int"]
    assert {(r.empty, r.s, r.n) for r in spark.read.parquet(str(tmp_path / "t")).collect()} == {("", "", 1), ("", "a", None)}


def test_layer_files(spark, tmp_path):
    for part in ("bronze/a", "bronze/b", "silver/c"):
        folder = tmp_path / part
        folder.parent.mkdir(exist_ok=True)
        folder.write_bytes(b"123")
    rows = {r["prefix"]: (r["files"], r["bytes"]) for r in inspect.layer_files(spark, str(tmp_path)).collect()}
    assert rows == {"bronze": (2, 6), "silver": (1, 3)}


def test_materialize_uses_the_shared_folder_and_prunes_columns(spark):
    df = materialize(spark.range(10).selectExpr("id", "id * 2 AS b", "id % 2 AS c"))
    assert df.inputFiles()[0].startswith(("file:" + shared_dir(spark), "file://" + shared_dir(spark)))
    plan = df.filter("c = 1").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(c), EqualTo(c,1)]" in plan and "b:bigint" not in plan


def test_large_reports_are_not_sent_to_one_task(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "REPORT_ROWS", 10)
    for n, files in ((10, 1), (11, 4)):
        path = tmp_path / str(n)
        sinks.write_csv(spark.range(0, n, 1, 4), str(path))
        assert len([f for f in os.listdir(path) if f.startswith("part-")]) == files and spark.read.option("header", True).csv(str(path)).count() == n
