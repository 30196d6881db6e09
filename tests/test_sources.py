"""Readers and sinks: verified writes, availability matrix, empty files, scan parallelism floor."""

import uuid

from pyspark.sql import functions as F

from hearth.session import scratch_path
from tests.conftest import SF_SMALL
from hearth.sources.readers import column_availability, file_catalogue, file_path, header_catalogue, list_files, read_drifting, rows_by_file
from hearth.sources.sinks import write_tab_files, write_verified
from hearth.sources.tables import table


def test_write_verified_counts_rows(spark):
    path = scratch_path(spark, f"test-sinks-{uuid.uuid4().hex[:8]}")
    df = spark.range(1234).withColumn("part", F.col("id") % 3)
    assert write_verified(df, path, "part") == 1234
    assert spark.read.parquet(path).count() == 1234


def test_availability_and_empty_files(spark):
    root = scratch_path(spark, f"test-readers-{uuid.uuid4().hex[:8]}")
    write_tab_files(spark.createDataFrame([("1", "a")], "A string, B string").coalesce(1), f"{root}/one")
    write_tab_files(spark.createDataFrame([("2", "c")], "A string, C string").coalesce(1), f"{root}/two")
    write_tab_files(spark.createDataFrame([], "A string, B string").coalesce(1), f"{root}/empty")
    files = list_files(spark, root, ".csv")
    folder = F.regexp_extract("file", "/([^/]+)/[^/]+$", 1)
    catalogue = header_catalogue(spark, files, "\t")
    cells = {(r["folder"], r["position"], r["column_name"]) for r in catalogue.withColumn("folder", folder).collect()}
    assert {("one", 0, "A"), ("one", 1, "B"), ("two", 0, "A"), ("two", 1, "C")} <= cells
    matrix = {r["column_name"]: r.asDict() for r in column_availability(catalogue, folder, ["one", "two"]).collect()}
    assert matrix["A"]["one"] == 1 and matrix["A"]["two"] == 1 and matrix["C"]["one"] == 0
    unioned = read_drifting(spark, files, "\t", lambda df, present: df)
    assert sorted(unioned.columns) == ["A", "B", "C"] and unioned.count() == 2


def test_headers_of_files_in_many_blocks(spark, tmp_path):
    """Files of several blocks, an empty one, a byte order mark, quoted names and a space in the path."""
    folder = tmp_path / "a folder"
    folder.mkdir()
    (folder / "long.csv").write_text('"A",B\n' + "x,1\n" * 5000)
    (folder / "mark.csv").write_bytes("\ufeffA,C\r\ny,2\r\n".encode())
    (folder / "only.csv").write_text("A,B\n")
    (folder / "none.csv").write_text("")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        files = list_files(spark, str(folder), ".csv")
        name = F.regexp_extract("file", "([^/]+)$", 1)
        got = {(r[0], r["position"], r["column_name"]) for r in header_catalogue(spark, files, ",").select(name, "position", "column_name").collect()}
        assert got == {("long.csv", 0, "A"), ("long.csv", 1, "B"), ("mark.csv", 0, "A"), ("mark.csv", 1, "C"), ("only.csv", 0, "A"), ("only.csv", 1, "B")}
        rows = read_drifting(spark, files, ",", lambda df, present: df.select("*", file_path().alias("file")))
        counts = {r[0]: r["rows"] for r in rows_by_file(file_catalogue(spark, files), rows).select(name, "rows").collect()}
        assert counts == {"long.csv": 5000, "mark.csv": 1, "only.csv": 0, "none.csv": 0}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_snapshots(spark):
    """Two writers at once give one table; a changed input gives a new version; old folders go, and types survive folder names."""
    from concurrent.futures import ThreadPoolExecutor

    from hearth.sources import snapshots
    root = scratch_path(spark, f"test-snapshots-{uuid.uuid4().hex[:8]}")

    def build(n):
        return lambda: spark.range(n).select("id", F.lpad((F.col("id") % 2).cast("string"), 3, "0").alias("part"))
    with ThreadPoolExecutor(4) as pool:
        tables = list(pool.map(lambda _: snapshots.table(spark, root, build(10), "a", "part"), range(4)))
    s = snapshots.Snapshots(spark, root)
    folders = lambda: [n for n in snapshots._names(spark, root) if n.startswith("v-")]
    assert {t.count() for t in tables} == {10} and len({t.inputFiles()[0].split("/part=")[0] for t in tables}) == 1
    assert len(s.entries()) == 1 and len(folders()) == 1
    assert dict(tables[0].dtypes)["part"] == "string" and {r["part"] for r in tables[0].collect()} == {"000", "001"}
    first = tables[0]
    assert snapshots.table(spark, root, build(20), "b", "part").count() == 20
    assert first.count() == 10 and len(folders()) == 2          # a reader of the version before still has it
    assert snapshots.table(spark, root, build(30), "c", "part").count() == 30
    assert len(folders()) == 2 == len(s.entries()) and s.newest()["inputs"] == "c"
    s._drop("none")
    spark.range(1).write.parquet(f"{root}/v-left-behind")
    s.vacuum()
    assert len(folders()) == 3                                   # its writer may still be at work
    s.vacuum(abandoned=-5)
    assert len(folders()) == 2


def test_scan_is_not_shuffled(spark):
    plan = table(spark, SF_SMALL, "lineitem")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "FileScan parquet" in plan

def test_deprivation_columns_bound_by_name(spark):
    """A wide CSV with extra, reordered columns: read as strings, select the 7 by name, aggregate."""
    from hearth.plans.gold import area_deprivation
    from hearth.sources import bronze
    from hearth.sources.readers import read_csv_strings
    path = scratch_path(spark, f"test-imd-{uuid.uuid4().hex[:8]}")
    cols = ["LSOA code", bronze.IMD_LIVING, bronze.IMD_NAME, "Other score", bronze.IMD_INCOME,
            bronze.IMD_CODE, bronze.IMD_SCORE, bronze.IMD_HEALTH, bronze.IMD_EMPLOY]
    rows = [("L1", "10", "Camden", "9", "0.2", "E09000007", "30", "1", "0.1"),
            ("L2", "20", "Camden", "9", "0.4", "E09000007", "50", "-1", "0.3"),
            ("L3", "5", "Elsewhere", "9", "0.9", "E07000001", "99", "0", "0.9")]
    spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in cols)).coalesce(1) \
        .write.option("header", True).csv(path)
    raw = read_csv_strings(spark, path)
    imd = raw.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in bronze.imd_schema()])
    out = area_deprivation(imd).collect()
    assert len(out) == 1
    r = out[0]
    assert (r["la_name"], r["imd_score"], r["income_deprivation_rate"], r["living_env_score"], r["lsoa_count"]) \
        == ("Camden", 40.0, 0.3, 15.0, 2)


def test_csv_bound_by_name_ignores_order_and_extra_columns(spark, tmp_path):
    import pytest
    from pyspark.sql import types as T

    from hearth.sources.readers import read_csv_named
    (tmp_path / "wide.csv").write_text("extra,score,area\nx,1.5,A\ny,none,B\n")
    schema = T.StructType([T.StructField("area", T.StringType()), T.StructField("score", T.DoubleType())])
    got = read_csv_named(spark, str(tmp_path / "wide.csv"), schema)
    assert got.dtypes == [("area", "string"), ("score", "double")]
    assert sorted(map(tuple, got.collect())) == [("A", 1.5), ("B", None)]
    with pytest.raises(ValueError, match=r"\['region'\]"):
        read_csv_named(spark, str(tmp_path / "wide.csv"), schema.add("region", T.StringType()), name="wide")


def test_no_row_in_scope_is_an_error(spark):
    import pytest

    from hearth.sources.readers import require_rows
    one = spark.createDataFrame([("a",)], "x string")
    assert require_rows(one, "lettings").count() == 1
    with pytest.raises(ValueError, match="lettings"):
        require_rows(one.where("x = 'b'"), "lettings")
