import json
import os

import pytest
from pyspark.sql import functions as F

from starfold.config import load_config
from starfold.schema.registry import Column, SchemaError, TableSchema, table_schema
from starfold.sources import files, text


def lines(spark, rows):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "seq long, value string")


def test_coll_13(spark):
    good = "1.5 10 11 14 13 14 " + " ".join(str(i) for i in range(10))
    rows = text.parse_coll_13(lines(spark, ["TIME NAME", good, "1 2 3", good.replace("1.5", "abc", 1),
                                            "  " + good.replace(" 13 ", " *** ") + "  "])).collect()
    assert [r["seq"] for r in rows] == [1, 4]
    assert rows[0]["TIME[NB]"] == 1.5 and rows[0]["P[days]"] == 9.0 and rows[1]["K*(I2)"] is None


def test_coal_24_both_layouts(spark):
    plain = " ".join(["2.0", "1", "2", "14", "14", "14", "0"] + ["1.0"] * 14)
    tagged = " ".join(["BINARY", "3", "2.5", "7", "8", "13", "14", "14"] + ["0"] * 8 + ["30.0", "20.0", "50.0", "0"] + ["0"] * 4 + ["0.5", "9.0"])
    rows = text.parse_coal_24(lines(spark, [plain, tagged, tagged.replace("BINARY", "OTHER"), "x"])).collect()
    assert len(rows) == 2
    assert rows[0]["Coalescence_trigger"] is None and rows[0]["VINF[km/s]"] == 1.0
    assert rows[1]["Coalescence_trigger"] == "BINARY" and rows[1]["TIME[NB]"] == 2.5
    assert rows[1]["M(I1)[M*]"] == 30.0 and rows[1]["VINF[km/s]"] is None and rows[1]["ECC"] == 0.5
    both = text.merge_events(text.parse_coll_13(lines(spark, [])), text.parse_coal_24(lines(spark, [tagged])), ["seq"])
    row = both.first()
    assert (row["primary_mass_msun"], row["stellar_type"], row["merger_type"]) == (30.0, "BH-NS", "coalescence")
    assert row["mass_ratio"] == pytest.approx(2 / 3)


def test_read_events_cleans_restarts(spark, tmp_path):
    for job, times in (("1", (1.0, 2.0, 3.0)), ("2", (2.5, 4.0))):
        os.makedirs(tmp_path / job)
        rows = [f"{t} 10 11 14 13 14 " + " ".join(["1.0"] * 10) for t in times]
        (tmp_path / job / "coll.13").write_text("\n".join(["HEAD", *rows]))
    (tmp_path / "1" / "coal.24").write_text("HEAD\n")
    got = text.read_events(spark, str(tmp_path), "s", 2.0)
    assert sorted((r["ttot"], r["time_myr"]) for r in got.collect()) == [(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (4.0, 8.0)]
    assert files.first_job_id(str(tmp_path)) == 1


def test_lagr_7(spark):
    header = text.lagr7_header()
    assert len(header) == 283 and header[0] == ("rlagr", "1.00E-03") and header[-1] == ("vrot", "<RC")
    row = lambda t, v: " ".join([str(t)] + [str(v)] * 283)
    raw = lines(spark, ["## title", "Time columns", row(0.0, 1.0), row(1.0, 2.0), row(1.0, 4.0), row(2.0, "***")])
    parsed = text.parse_lagr_7(raw)
    clean = text.clean_lagr_7(parsed, [], ["seq"])
    assert sorted(r["seq"] for r in clean.collect()) == [2, 4]
    assert sorted(r["seq"] for r in text.clean_lagr_7(parsed, [], ["seq"], compat=True).collect()) == [2, 3]
    scale = {"r": 2.0, "m": 3.0, "v": 5.0, "t": 10.0}
    long = text.lagr_7_long(clean.withColumn("simulation_id", F.lit("s")), ["simulation_id"], scale).toPandas()
    assert len(long) == 2 * (283 + 3 * 19)
    at = long[(long.time_myr == 10.0) & (long.suffix == "5.00E-01")].set_index("metric")["value"]
    assert (at["rlagr_s"], at["avmass"], at["nshell"], at["vx"], at["sigma2"], at["sigma"]) == (8.0, 12.0, 4.0, 20.0, 100.0, 10.0)
    with pytest.raises(Exception, match="283|284"):
        text.parse_lagr_7(lines(spark, ["1.0 2.0 3.0"])).collect()
    assert len(text.lagr_7_wide(clean, []).columns) == 284


def test_stdout_and_namelist(spark, tmp_path):
    out = lines(spark, ["x", "  PHYSICAL SCALING:   R* = 1.5  M* = 60000.0  V* = 12.0  T* = 0.125"])
    assert text.scale_factors(out) == {"r": 1.5, "v": 12.0, "m": 60000.0, "t": 0.125}
    with pytest.raises(ValueError):
        text.scale_factors(lines(spark, ["nothing"]))
    path = tmp_path / "run.inp"
    path.write_text("&INPUT\nKSTART=1, TCOMP=5.0,\n n = 1000000, NFIX=1\n/")
    assert text.namelist_value(spark, str(path), "TCOMP") == "5.0"
    assert text.namelist_value(spark, str(path), "N") == "1000000"
    with pytest.raises(KeyError):
        text.namelist_value(spark, str(path), "ZZZ")


def test_tables_and_catalogue(spark, tmp_path):
    (tmp_path / "bdat").write_text("A B C\n1 2 3\n4 5 x\n")
    rows = text.read_bdat(spark, str(tmp_path / "bdat")).collect()
    assert [tuple(r) for r in rows] == [(1.0, 2.0, 3.0), (4.0, 5.0, None)]
    (tmp_path / "bwdat").write_text("title\nA B\n1 2\n")
    assert tuple(text.read_bdat(spark, str(tmp_path / "bwdat"), skip=1).first()) == (1.0, 2.0)
    csv = tmp_path / "gwtc.csv"
    csv.write_text(
        "name,mass_1_source,mass_1_source_lower,mass_1_source_upper,mass_2_source,mass_2_source_lower,mass_2_source_upper\n"
        "a,30,-5,10,20,-4,5\n"
    )
    row = text.read_gwtc(spark, str(csv)).first()
    assert row["mass_ratio"] == pytest.approx(2 / 3)
    assert row["mass_ratio_lower"] == pytest.approx(16 / 40 - 2 / 3)
    assert row["mass_ratio_upper"] == pytest.approx(25 / 25 - 2 / 3)
    with pytest.raises(FileNotFoundError):
        text.read_gwtc(spark, "")


def catalog(spark, rows):
    return files.describe_files(spark.createDataFrame(rows, "path string, size_bytes long, mtime double"))


def test_file_selection(spark):
    rows = [
        ("/d/a/snap.40_0.h5part", 10, 0.0), ("/d/b/snap.40_0.h5part", 20, 0.0), ("/d/a/snap.40_1.h5part", 5, 0.0),
        ("/d/bad_run/snap.40_2.h5part", 5, 0.0), ("/d/a/snap.40_2.5.h5part", 5, 0.0), ("/d/a/snap.40_4.h5part", 5, 0.0),
        ("/d/a/snap.40_5.h5part", 5, 99_000.0),
    ]
    chosen = files.select_files(catalog(spark, rows), now=100_000.0, wait_age_hour=24)
    got = {r["path"] for r in chosen.collect()}
    assert got == {"/d/b/snap.40_0.h5part", "/d/a/snap.40_1.h5part", "/d/a/snap.40_4.h5part"}
    gone = files.missing_times(chosen, 1.0)
    assert sorted(r["missing_time"] for r in gone.collect()) == [2.0, 3.0]
    everything = files.select_files(catalog(spark, rows), now=1e9, every=None, exclude_bad=False)
    assert everything.count() == 6


def test_overlaps_and_gaps(spark):
    rows = [(f"/d/{d}/snap.40_{t}.h5part", 1, 0.0) for d, ts in
            {"a": range(0, 2000, 100), "b": range(1900, 4000, 100), "c": range(5000, 6000, 100)}.items() for t in ts]
    cat = catalog(spark, rows)
    pairs = files.directory_overlaps(cat).collect()
    assert [(r["run_dir_a"], r["run_dir_b"], r["overlap_lo"], r["overlap_hi"]) for r in pairs] == [("/d/a", "/d/b", 1900.0, 1900.0)]
    assert {r["path"] for r in files.duplicate_times(cat).collect()} == {"/d/a/snap.40_1900.h5part", "/d/b/snap.40_1900.h5part"}
    gaps = files.spacing_gaps(cat.withColumn("s", F.lit(1)), ["s"], chunk_width=250.0)
    assert [(r["before"], r["filename_time"]) for r in gaps.collect()] == [(3900.0, 5000.0)]
    steps = spark.createDataFrame([("/d/a", 1.0), ("/d/a", 2.0), ("/d/b", 2.0)], "run_dir string, ttot double")
    shared = files.shared_snapshots(files.directory_overlaps(cat), steps)
    assert [r["ttot"] for r in shared.collect()] == [2.0]


def test_file_catalog_reads_metadata(spark, tmp_path):
    os.makedirs(tmp_path / "run")
    (tmp_path / "run" / "snap.40_3.5.h5part").write_bytes(b"12345")
    row = files.file_catalog(spark, str(tmp_path)).first()
    assert row["filename_time"] == 3.5 and row["size_bytes"] == 5
    plan = files.file_catalog(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


@pytest.mark.parametrize("name, count", [
    ("compact_object_history", 22), ("snapshot_binaries", 45), ("snapshot_mergers", 55),
    ("snapshot_scalars", 73), ("snapshot_singles", 23), ("snapshot_summary", 17),
])
def test_registered_tables(name, count):
    schema = table_schema(name)
    assert len(schema.columns) == count and schema.names[:2] == ["simulation_id", "ttot"]
    assert schema.hash() == table_schema(name).hash()


def test_schema_rules(spark):
    for columns in ((), (Column("Bad", "int64"),), (Column("a", "decimal"),), (Column("a", "int64"), Column("a", "int64"))):
        with pytest.raises(SchemaError):
            TableSchema("t", 1, columns)
    with pytest.raises(FileNotFoundError):
        table_schema("nope")
    schema = TableSchema("t", 1, (Column("a", "int64"), Column("b", "float32"), Column("c", "Int64")))
    good = spark.createDataFrame([(1, 1.0, None)], "a int, b double, c long")
    schema.validate(good)
    for bad in (good.select("b", "a", "c"), good.withColumn("a", F.lit("x")), good.drop("c")):
        with pytest.raises(SchemaError):
            schema.validate(bad)
    hole = spark.createDataFrame([(None, 1.0, None)], "a int, b double, c long")
    with pytest.raises(SchemaError):
        schema.validate(hole)
    with pytest.raises(Exception, match="t.a is NULL"):
        schema.guarded(hole).collect()


def test_config(tmp_path):
    assert load_config().scan_options()["sample_every_nb_time"] == 1.0
    path = tmp_path / "c.json"
    path.write_text(json.dumps({
        "paths": {"simulations": {"a": "/d/a"}, "analysis_cache_dir": "/c"},
        "hdf5": {"scan": {"checkpoint_every_files": 7}}, "physics": {"ignored": 1},
    }))
    config = load_config(str(path))
    assert config.simulations == {"a": "/d/a"} and config.lake_root == "/c"
    assert config.scan_options()["checkpoint_every_files"] == 7
    assert config.scan_options(lake=True)["sample_every_nb_time"] is None
    with pytest.raises(ValueError):
        config.input_file("a")
    with pytest.raises(ValueError):
        load_config().cache_root


def test_lake_views_of_single_rows_shuffle_before_they_sum(spark, tmp_path):
    """Singles cross the shuffle as raw rows, so no map task holds a hash table of nearly all of its rows."""
    from starfold.sources.adapters import adapter_view

    rows = [(k // 3, k % 5, k % 2, k % 7, float(k % 50), 10.0 * k, "ANR"[k % 3]) for k in range(60)]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string"
    lines = spark.createDataFrame(rows, names).selectExpr("*", "date'1995-02-03' + cast(l_orderkey as int) * 20 l_shipdate")
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    view = adapter_view(spark, str(tmp_path), "snapshot_singles")
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Aggregate" not in plan[plan.index("Exchange") :]
    whole = view.selectExpr("count(*) n", "sum(mass_msun) m").first()
    assert whole["n"] == view.select("simulation_id", "ttot", "object_id").distinct().count()
