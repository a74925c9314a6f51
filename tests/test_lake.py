import pytest

from vanewright.operators import conform
from vanewright.plans import features
from vanewright.sources import lake


@pytest.fixture
def raw(tmp_path):
    d = tmp_path / "raw" / "datasets"
    d.mkdir(parents=True)
    head = ["time_stamp", "asset_id", "id", "train_test", "status_type_id", "power", "wind_speed", "s1"]
    for name, sep in (("1.csv", ","), ("comma_2.csv", ","), ("2.csv", ";"), ("3.csv", ";")):
        rows = [[f"2024-01-01 00:{m:02d}:00", "WT1", str(m), "train" if m < 40 else "prediction", "0", str(m * 1.5), str(m / 7), "" if m % 5 else "1"] for m in range(50)]
        if name == "3.csv":
            rows[7][0] = "broken"
        (d / name).write_text("\n".join(sep.join(r) for r in [head, *rows]))
    (d / "event_info.csv").write_text("event_id; Event_Label ;event_start;event_start_id\n1;anomaly;01-01-2024 00:30;30.0\n3;normal;;\n")
    (d / "feature_description.csv").write_text("Sensor_Name,Description,is_angle\ns1,some,FALSE\n")
    return d


def test_raw_to_gold(spark, raw, tmp_path):
    bronze, silver, gold = (str(tmp_path / x) for x in ("bronze", "silver", "gold"))
    assert {r["dataset_id"] for r in lake.discover(spark, str(raw.parent)).collect()} == {"1", "2", "3"}
    first = {r["dataset_id"]: r["n_rows"] for r in lake.ingest(spark, str(raw), bronze, "A").collect()}
    assert first == {"1": 50, "2": 50, "3": 50}
    assert lake.ingest(spark, str(raw), bronze, "A").count() == 0
    assert lake.ingest(spark, str(raw), bronze, "A", force=True).count() == 3
    assert lake.read(spark, bronze).count() == 150
    ev = lake.read_events(spark, str(raw / "event_info.csv"))
    assert {(r["event_id"], r["event_start_id"]) for r in ev.collect()} == {("1", 30), ("3", None)}
    assert lake.read_descriptions(spark, str(raw / "feature_description.csv")).count() == 1
    report = {r["dataset_id"]: r["rows_dropped"] for r in lake.to_silver(spark, bronze, silver, ev.withColumn("farm_id", lake.F.lit("A"))).collect()}
    assert report == {"1": 0, "2": 0, "3": 1}
    df = lake.read(spark, silver, where="power > 3", episodes="dataset_id = '1'")
    assert df.count() == 47 and "GreaterThan(power,3.0)" in df._jdf.queryExecution().executedPlan().toString()
    f, meta = features.gold(lake.read(spark, silver), ["s1"])
    lake.to_gold(f, meta, gold)
    back, names = lake.read_gold(spark, gold)
    assert back.count() == 149 and set(names) <= set(back.columns) and "power_roll6_mean" in names
    files = spark.createDataFrame([("f", "/f/metadata.json"), ("f", "/f/event_info.csv")], "folder string, path string")
    assert lake.preferred_file(files).first()["path"] == "/f/event_info.csv"
    lake.to_csv(meta, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 3
    assert conform.without_meta(f).columns[0] == "time_stamp"


def test_files_as_they_are(spark, tmp_path):
    """Swapped columns, both separators, latin-1, other headers, a long and a short line, a file without a required column."""
    d = tmp_path / "raw"
    d.mkdir()
    row = lambda k, *v: ",".join([f"2024-01-01 00:{k:02d}:00", "train", "0", *v])
    (d / "1.csv").write_text("\n".join(["time_stamp,train_test,status_type_id,a,b", row(0, "1", "2"), row(1, "1", "2", "9"), row(2, "1")]))
    (d / "2.csv").write_text("\n".join(["Time , split,status_id,b,a,c", row(0, "2", "1", "3")]))
    (d / "3.csv").write_text("\n".join(["timestamp;train_test;status;turbine_id;a;b;comma,in it", row(0, "WT", "1", "2", "x").replace(",", ";")]))
    (d / "4.csv").write_bytes("time_stamp,train_test,status_type_id,wt_id,temp °C\n2024-01-01,train,0,é,5\n".encode("latin-1"))
    (d / "5.csv").write_text("time_stamp,a\n2024-01-01,1\n")
    (d / "6.csv").write_text("\n")
    (d / "sensor_names.csv").write_text("a,b\n1,2\n")
    (d / "my description.csv").write_text("a,b\n1,2\n")
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    got = {r["dataset_id"]: (r["n_rows"], r["n_corrupt"], r["error"]) for r in lake.ingest(spark, str(d), bronze, "A").collect()}
    assert got == {"1": (3, 2, None), "2": (1, 0, None), "3": (1, 0, None), "4": (1, 0, None), "5": (0, 0, "missing columns train_test, status_type_id"), "6": (0, 0, "missing columns time_stamp, train_test, status_type_id")}
    rows = {(r["dataset_id"], r["time_stamp"][-5:]): r for r in lake.read(spark, bronze).collect()}
    for n in "123":
        assert (rows[n, "00:00"]["a"], rows[n, "00:00"]["b"], rows[n, "00:00"]["status_type_id"]) == ("1", "2", "0")
    assert rows["1", "01:00"]["_corrupt_record"].endswith("1,2,9") and rows["1", "02:00"]["_corrupt_record"].endswith(",1") and rows["2", "00:00"]["c"] == "3"
    assert rows["3", "00:00"]["asset_id"] == "WT" and rows["3", "00:00"]["comma,in it"] == "x" and rows["4", "01-01"]["temp °C"] == "5" and rows["4", "01-01"]["asset_id"] == "é"
    report = {r["dataset_id"]: (r["rows_in"], r["rows_dropped"]) for r in lake.to_silver(spark, bronze, silver).collect()}
    assert report == {"1": (3, 2), "2": (1, 0), "3": (1, 0), "4": (1, 0)}
    sizes = {r["dataset_id"]: (r["n_rows"], r["n_files"], r["n_bytes"] > 0) for r in lake.layer_report(spark, silver).collect()}
    assert sizes == {n: (1, 1, True) for n in "1234"}


def test_farms_of_different_width(spark, tmp_path):
    root = str(tmp_path / "layer")
    make = lambda farm, names, v: spark.createDataFrame([(farm, "01", *[v] * len(names))], "farm_id string, dataset_id string, " + ", ".join(f"{n} double" for n in names))
    lake.write(make("A", ["x"], 1.0), root)
    lake.write(make("B", ["x", "y"], 2.0), root)
    lake.write(make("C", ["z", "y"], 3.0), root)
    assert {(r["farm_id"], r["dataset_id"], r["x"], r["y"], r["z"]) for r in lake.read(spark, root).collect()} == {("A", "01", 1.0, None, None), ("B", "01", 2.0, 2.0, None), ("C", "01", None, 3.0, 3.0)}
    lake.write(make("A", ["y"], 9.0), root)
    assert {(r["x"], r["y"]) for r in lake.read(spark, root, where="farm_id = 'A'").collect()} == {(None, 9.0)}
    assert {tuple(r) for r in lake.done(spark, root).collect()} == {(f, "01") for f in "ABC"} and lake.done(spark, root + "none").isEmpty()
    with pytest.raises(ValueError, match="column x"):
        lake.write(make("D", ["x"], 1.0).withColumn("x", lake.F.lit("text")), root)


def bytes_read(spark, work):
    """Bytes that the executors' tasks read from files while ``work`` runs."""
    store = spark.sparkContext._jsc.sc().statusStore()
    total = lambda: sum(x.totalInputBytes() for x in (lambda l: [l.apply(k) for k in range(l.size())])(store.executorList(False)))
    before = total()
    work()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return total() - before


def test_raw_bytes_are_read_once(spark, tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    for n in range(3):
        rows = [f"2024-01-{k % 28 + 1:02d} 00:00:00,train,0,{k},{k * 1.25},{'x' * 40}" for k in range(20_000)]
        (d / f"{n}.csv").write_text("\n".join(["time_stamp,train_test,status_type_id,id,power,note", *rows]))
    size = sum(f.stat().st_size for f in d.iterdir())
    bronze = str(tmp_path / "bronze")
    read = bytes_read(spark, lambda: lake.ingest(spark, str(d), bronze, "A"))
    back = sum(f.stat().st_size for f in (tmp_path / "bronze").rglob("*.parquet"))  # the manifest reads three columns again
    assert lake.read(spark, bronze).count() == 60_000 and size <= read <= 1.1 * size + back


def test_commits(spark, tmp_path):
    """A write shows whole or not at all; files hold many episodes; only wanted files are opened; the last commit holds."""
    root = str(tmp_path / "layer")
    rows = lambda ids, v: spark.createDataFrame([("A", str(d), k, v) for d in ids for k in range(5)], "farm_id string, dataset_id string, id long, v double")
    lake.write(rows(range(100), 1.0), root)
    assert len(list((tmp_path / "layer").rglob("*.parquet"))) < 20 and lake.done(spark, root).count() == 100
    lake.write(rows([3, 4], 2.0), root)
    assert {(r["dataset_id"], r["v"]) for r in lake.read(spark, root).where("dataset_id in ('3', '5')").collect()} == {("3", 2.0), ("5", 1.0)} and lake.read(spark, root).count() == 500
    one = lake.read(spark, root, episodes="dataset_id = '4'")
    assert one.count() == 5 and len([f for f in one.inputFiles() if f.endswith(".parquet")]) == 1
    assert lake.read(spark, root, episodes=spark.createDataFrame([("A", "77")], "farm_id string, dataset_id string")).count() == 5 and lake.read(spark, root, episodes="dataset_id = 'none'").count() == 0
    before = lake.live(spark, root).count()
    rows([9], 7.0).withColumn("w", lake.F.lit(1)).write.partitionBy("farm_id").parquet(f"{root}/write=dead")  # a writer that died before its commit
    assert lake.live(spark, root).count() == before and "w" not in lake.read(spark, root).columns and lake.read(spark, root).where("v = 7").isEmpty()
    with pytest.raises(ValueError, match="no write"):
        lake.read(spark, str(tmp_path / "nothing"))


def test_concurrent_writers(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    root = str(tmp_path / "layer")
    make = lambda n: spark.createDataFrame([("A", d, n) for d in (str(n), "shared")], "farm_id string, dataset_id string, v long")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: lake.write(make(n), root), range(4)))
    got = sorted((r["dataset_id"], r["v"]) for r in lake.read(spark, root).collect())
    assert [x for x in got if x[0] != "shared"] == [(str(n), n) for n in range(4)]
    assert len([x for x in got if x[0] == "shared"]) == 1  # one whole commit of it holds


def test_silver_takes_what_is_new(spark, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    make = lambda d, n: spark.createDataFrame([("A", d, f"2024-01-01 00:{k:02d}:00" if k else "no time", "train", "0", str(k)) for k in range(n)], "farm_id string, dataset_id string, time_stamp string, train_test string, status_type_id string, power string")
    told = lambda: {r["dataset_id"]: (r["rows_in"], r["rows_out"], r["rows_dropped"]) for r in lake.to_silver(spark, bronze, silver).collect()}
    writes = lambda: lake.live(spark, silver).select("write").distinct().count()
    lake.write(make("1", 4), bronze)
    assert told() == {"1": (4, 3, 1)} == told() and writes() == 1
    lake.write(make("2", 6), bronze)
    assert told() == {"1": (4, 3, 1), "2": (6, 5, 1)} and writes() == 2
    lake.write(make("1", 9), bronze)  # changed in bronze
    assert told() == {"1": (9, 8, 1), "2": (6, 5, 1)} and lake.read(spark, silver).count() == 13


def test_header_longer_than_a_block(spark, tmp_path):
    names = ["time_stamp", "train_test", "status_type_id", *[f"sensor_{k}_°" for k in range(3000)]]
    (tmp_path / "w.csv").write_text("\n".join([",".join(names), ",".join(["2024-01-01", "train", "0"] + ["1"] * 3000)]))
    path = str(tmp_path / "w.csv")
    assert lake.headers(spark, [path], 64)[path] == (",".join(names), ",")


def test_classified_columns(spark):
    df = spark.createDataFrame([(1.0,) * 7], "power_30_avg double, power_29_avg double, reactive_power_1 double, wind_speed_3_avg double, wind_speed_4_avg double, sensor_0_avg double, sensor_1 double")
    desc = spark.createDataFrame([(0, "power_29", "Possible grid power", "FALSE", "no"), (1, "power_30", "Grid power", "FALSE", "no"), (2, "wind_speed_4", "Estimated windspeed", "FALSE", "no"), (3, "wind_speed_3", "Windspeed", "FALSE", "no"), (4, "sensor_0", "Wind direction", "TRUE", "no"), (5, "sensor_1", "Count", "FALSE", "yes")], "ordinal int, sensor_name string, description string, is_angle string, is_counter string")
    told = {r["column"]: r["role"] for r in conform.classified(df, desc).collect()}
    assert told == {"power_30_avg": "power", "power_29_avg": "sensor", "reactive_power_1": "sensor", "wind_speed_3_avg": "wind_speed", "wind_speed_4_avg": "sensor", "sensor_0_avg": "angle", "sensor_1": "counter"}
    bare = {r["column"] for r in conform.classified(df).where("role = 'power'").collect()}
    assert bare == {"power_30_avg", "power_29_avg"}
