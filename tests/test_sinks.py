import subprocess
import sys
from csv import reader as csv_reader
from decimal import Decimal
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import rows
from prismcube import scratch, versions
from prismcube.contract import ColumnSpec, Contract
from prismcube.functions.measures import MEASURES, finish
from prismcube.functions.naming import cuboid_names
from prismcube.operators.cube import full_cube, one_cuboid
from prismcube.plans import cube as cubes
from prismcube.plans import load, publish
from prismcube.plans.publish import publish_cube, published
from prismcube.scratch import scratch_path, scratch_root
from prismcube.sinks import csv as csv_sink
from prismcube.sinks import cuboids
from prismcube.sources import csv
from prismcube.streaming.load import stream_load, stream_refresh

REPO = Path(scratch.__file__).resolve().parent.parent
TEXTS = ["Gift More, Spend Less", "Supermarkets ", " lead", "Nescafé", "POÄNG", "Levi's", 'say "hi"', "A|B", "NA", "null"]
DIMS = ["a", "b"]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    csv_sink.write_csv(df, str(tmp_path / "t.csv"))
    assert rows(csv.read_csv(spark, str(tmp_path / "t.csv"), df.schema)) == rows(df)


def test_csv_text(spark, tmp_path):
    df = spark.createDataFrame([("x, y", "", None, 'q"', " b ")], "a string, b string, c string, d string, e string")
    csv_sink.write_csv(df.coalesce(1), str(tmp_path / "t.csv"))
    (part,) = (tmp_path / "t.csv").glob("part-*.csv")
    assert part.read_text() == 'a,b,c,d,e\n"x, y",,,"q"""' + ", b \n"


@pytest.fixture
def cube(spark, tmp_path):
    data = [("x", "p, q", "10.005"), ("x", "", "1.10"), ("y", 'r"s', "2.20"), ("y", "z ", "200000.01")]
    facts = spark.createDataFrame([(a, b, Decimal(m)) for a, b, m in data], "a string, b string, m decimal(18,2)")
    root = str(tmp_path / "cube")
    versions.reset(spark, root)
    cubes.write_cube(spark, root, full_cube(facts, DIMS, "m"), versions.latest(spark, root, "cube"), 0)
    return cubes.stored_cube(spark, root)


def test_one_csv_per_cuboid(spark, cube, tmp_path):
    folder = tmp_path / "out"
    report = cuboids.export_cuboids(cube, DIMS, str(folder))
    assert rows(report) == [(n, True, None) for n in ("cuboid_a", "cuboid_a_b", "cuboid_apex", "cuboid_b")]
    text = "".join(p.read_text() for p in sorted((folder / "cuboid_a.csv").glob("part-*.csv")))
    assert text.splitlines() == [
        "a,sum_amount,count,avg_amount,min_amount,max_amount",
        f"x,11.11,2,{11.11 / 2:.2f},1.10,10.01",
        f"y,200002.21,2,{200002.21 / 2:.2f},2.20,200000.01",
    ]
    apex = "".join(p.read_text() for p in (folder / "cuboid_apex.csv").glob("part-*.csv"))
    assert apex.splitlines()[0] == "sum_amount,count,avg_amount,min_amount,max_amount"


def test_discover(spark, cube, tmp_path):
    cuboids.export_cuboids(cube, DIMS, str(tmp_path / "out"))
    (tmp_path / "out" / "plain.csv").write_text("a,count\nx,1\n")
    (tmp_path / "out" / "empty.csv").write_text("")
    (tmp_path / "out" / "note.txt").write_text("not a table")
    found = csv.discover(spark, str(tmp_path / "out"))
    assert [f[0] for f in found] == ["cuboid_a", "cuboid_a_b", "cuboid_apex", "cuboid_b", "plain"]
    schemas = {name: schema.simpleString() for name, _, schema in found}
    assert schemas["plain"] == "struct<a:string,count:bigint>"
    assert schemas["cuboid_apex"] == (
        "struct<sum_amount:double,count:bigint,avg_amount:double,min_amount:double,max_amount:double>"
    )


def test_published_tables(spark, cube, tmp_path):
    cuboids.export_cuboids(cube, DIMS, str(tmp_path / "out"))
    for _ in range(2):  # replacing works
        report = cuboids.publish_tables(spark, str(tmp_path / "out"), str(tmp_path / "served"), "shop")
        assert report.where("published").count() == 4
    served = spark.table("shop.cuboid_a_b")
    wanted = finish(one_cuboid(cube, DIMS, 3))
    columns = ["a", "b", "count", "min_amount", "max_amount"]
    assert served.where("b = ''").count() == 1
    assert rows(served.select(columns)) == rows(wanted.withColumn("max_amount", F.round("max_amount", 2)).withColumn("min_amount", F.round("min_amount", 2)).select(columns))


def test_served_tables_keep_null_and_empty_apart_and_follow_the_cube(spark, tmp_path):
    root, location = str(tmp_path / "cube"), str(tmp_path / "served")
    versions.reset(spark, root)

    def put(data, batch):
        facts = spark.createDataFrame([(a, b, Decimal(m)) for a, b, m in data], "a string, b string, m decimal(18,2)")
        return cubes.merge_batch(facts, batch, root, DIMS, "m", "s")

    with pytest.raises(LookupError):
        publish_cube(spark, root, DIMS, location, "live")
    put([("x", "", "1.10"), ("x", None, "2.20"), ("y", "p", "3.00")], 0)
    assert rows(publish_cube(spark, root, DIMS, location, "live").select("table_name", "published")) == [
        (n, True) for n in ("cuboid_a", "cuboid_a_b", "cuboid_apex", "cuboid_b")
    ]
    table = spark.table("live.cuboid_b")
    assert table.dtypes == [("b", "string"), ("sum_amount", "double"), ("count", "bigint"), *((f"{m}_amount", "double") for m in ("avg", "min", "max"))]
    assert rows(table.where("b = ''").select("sum_amount")) == [(1.1,)]
    assert rows(table.where("b is null").select("sum_amount")) == [(2.2,)]
    assert publish_cube(spark, root, DIMS, location, "live").count() == 0
    record = put([("x", "", "0.90")], 1)
    assert publish_cube(spark, root, DIMS, location, "live").where("published").count() == 4
    assert published(spark, root, "live")["of_version"] == record["version"]
    assert rows(spark.table("live.cuboid_b").where("b = ''").select("sum_amount", "count")) == [(2.0, 2)]
    assert rows(spark.table("live.cuboid_apex").select("count")) == [(4,)]


def served_files(tmp_path):
    return {p: p.stat().st_mtime_ns for p in (tmp_path / "served").rglob("part-*.parquet")}


def put_facts(spark, root, data, batch):
    facts = spark.createDataFrame([(a, b, Decimal(m)) for a, b, m in data], "a string, b string, m decimal(18,2)")
    return cubes.merge_batch(facts, batch, root, DIMS, "m", "s")


def whole(spark, root):
    """What should be served: every cuboid of the newest cube, rounded."""
    cube = cuboids.rounded(cubes.stored_cube(spark, root))
    cube = cube.withColumns({m: F.col(m).cast("double") for m in MEASURES if m != "count"})
    return {n: rows(one_cuboid(cube, DIMS, m)) for m, n in enumerate(cuboid_names(DIMS))}


def served_now(spark, database):
    return {n: rows(spark.table(f"{database}.{n}")) for n in cuboid_names(DIMS)}


def test_a_delta_writes_the_slots_that_it_touches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(publish, "SLOT_ROWS", 50)
    root, location = str(tmp_path / "cube"), str(tmp_path / "served")
    versions.reset(spark, root)
    put_facts(spark, root, [(f"a{i % 40}", f"b{i}", "1.25") for i in range(800)], 0)
    publish_cube(spark, root, DIMS, location, "slots")
    before, base = served_files(tmp_path), published(spark, root, "slots")["rows"]
    for batch, data in enumerate(([("a3", "b3", "2.00")], [("new", None, "4.00"), ("a3", "b3", "1.00")], [("", "b9", "0.50")]), 1):
        put_facts(spark, root, data, batch)
        publish_cube(spark, root, DIMS, location, "slots")
        record = published(spark, root, "slots")
        assert record["rows"] < base / 3  # of the groups, those in touched slots
        assert len(versions.parts_of(record, "served")) == batch + 1
        assert served_now(spark, "slots") == whole(spark, root)
    assert {p: t for p, t in served_files(tmp_path).items() if p in before} == before
    row = publish.served_row(spark, "slots", DIMS, {"a": "a3", "b": "b3"})
    assert rows(row.select("sum_amount", "count")) == [(4.25, 3)]


def test_parts_that_are_served_stay_few(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(publish, "MOST_PARTS", 2)
    monkeypatch.setattr(publish, "MOST_NAMED", 1)
    root, location = str(tmp_path / "cube"), str(tmp_path / "served")
    versions.reset(spark, root)
    for batch in range(6):
        put_facts(spark, root, [(f"a{i}", f"b{i + batch}", "1.25") for i in range(30 if batch == 0 else 2)], batch)
        publish_cube(spark, root, DIMS, location, "few")
        assert len(versions.parts_of(published(spark, root, "few"), "served")) <= 2
        assert served_now(spark, "few") == whole(spark, root)
    # Versions whose deltas have expired are served whole.
    for batch in range(6, 6 + versions.KEPT_VERSIONS + 1):
        put_facts(spark, root, [("late", f"b{batch}", "1.00")], batch)
    publish_cube(spark, root, DIMS, location, "few")
    assert len(versions.parts_of(published(spark, root, "few"), "served")) == 1
    assert served_now(spark, "few") == whole(spark, root)


@pytest.mark.parametrize("where", ["write", "switch", "commit"])
def test_a_failed_attempt_and_its_retry_disturb_no_reader(spark, tmp_path, monkeypatch, where):
    database = f"retried_{where}"
    root, location = str(tmp_path / "cube"), str(tmp_path / "served")
    versions.reset(spark, root)
    put_facts(spark, root, [("x", "p", "1.00"), ("y", "q", "2.00")], 0)
    publish_cube(spark, root, DIMS, location, database)
    old = served_now(spark, database)
    reader = spark.table(f"{database}.cuboid_apex")  # begun before the attempt
    put_facts(spark, root, [("x", "p", "4.00")], 1)
    new = whole(spark, root)
    assert new != old

    def fail(*args, **named):
        raise OSError("disk full")

    with monkeypatch.context() as patched:
        if where == "write":
            patched.setattr(publish, "observed_write", fail)
        elif where == "switch":
            patched.setattr(publish, "ensure_view", fail)
        else:
            patched.setattr(versions, "commit", fail)
        with pytest.raises(OSError, match="disk full"):
            publish_cube(spark, root, DIMS, location, database)
    # All cuboids are of one version: before the switch the old one, after it the new one.
    assert served_now(spark, database) == (new if where == "commit" else old)
    real = publish.observed_write

    def read_meanwhile(*args, **named):
        assert served_now(spark, database) == (new if where == "commit" else old)
        found = real(*args, **named)
        assert served_now(spark, database) == (new if where == "commit" else old)
        return found

    monkeypatch.setattr(publish, "observed_write", read_meanwhile)
    publish_cube(spark, root, DIMS, location, database)
    assert served_now(spark, database) == new
    assert rows(reader) == old["cuboid_apex"]
    gone = publish.sweep_served(spark, root, location, database)
    assert len(gone) == (0 if where == "write" else 1) and served_now(spark, database) == new


def test_tables_of_the_same_names_give_way(spark, cube, tmp_path):
    cuboids.export_cuboids(cube, DIMS, str(tmp_path / "out"))
    cuboids.publish_tables(spark, str(tmp_path / "out"), str(tmp_path / "tables"), "mixed")
    publish_cube(spark, str(tmp_path / "cube"), DIMS, str(tmp_path / "served"), "mixed")
    assert spark.table("mixed.cuboid_a_b").count() == 4
    assert spark.catalog.getTable("mixed.cuboid_a").tableType == "VIEW"


def test_empty_cube_is_served(spark, tmp_path):
    root = str(tmp_path / "cube")
    versions.reset(spark, root)
    facts = spark.createDataFrame([], "a string, b string, m decimal(18,2)")
    cubes.merge_batch(facts, 0, root, DIMS, "m", "s")
    assert publish_cube(spark, root, DIMS, str(tmp_path / "served"), "none").where("published").count() == 4
    assert spark.table("none.cuboid_a_b").count() == 0


def test_positions_of_exported_rows(spark, cube, conf):
    conf({"spark.sql.adaptive.enabled": "false"})
    numbered = cuboids.numbered_cuboid(cube, DIMS, 3).orderBy("position").collect()
    assert [r["position"] for r in numbered] == [0, 1, 2, 3]
    assert [(r["a"], r["b"]) for r in numbered] == [("x", ""), ("x", "p, q"), ("y", 'r"s'), ("y", "z ")]


def test_failed_jobs_raise_when_asked(spark):
    with pytest.raises(RuntimeError, match="bad: division by zero"):
        cuboids.checked(cuboids.run_jobs(spark, [("good", lambda: None), ("bad", lambda: 1 / 0)]))


def test_a_failing_table_does_not_stop_the_others(spark):
    def fail():
        raise ValueError("disk full\nmore")

    report = cuboids.run_jobs(spark, [("good", lambda: None), ("bad", fail)])
    assert rows(report) == [("bad", False, "disk full"), ("good", True, None)]


def test_rounding_of_doubles(spark):
    state = spark.createDataFrame([(1, 0.125, 1, 2.675, 0.375)], "k int, sum_amount double, count bigint, min_amount double, max_amount double")
    row = cuboids.rounded(state).first()
    assert [str(row[c]) for c in ("sum_amount", "avg_amount", "min_amount", "max_amount")] == ["0.12", "0.12", "2.67", "0.38"]


def test_scratch_follows_the_session(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    settings = {"spark.sql.warehouse.dir": "/shared/tables"}
    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda key, *default: settings.get(key, *default)))
    assert scratch_root(bare) == "/shared/tables/_scratch"


def test_old_scratch_goes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "scratch_root", lambda spark: str(tmp_path / "shared"))
    assert scratch.sweep_scratch(spark) == 0
    kept = scratch.written(spark.range(3), "numbers")
    assert scratch.sweep_scratch(spark) == 0 and kept.count() == 3
    assert scratch.sweep_scratch(spark, hours=0) == 1 and scratch.sweep_scratch(spark, hours=0) == 0


# Streams ---------------------------------------------------------------------

CONTRACT = Contract(
    (ColumnSpec("id", not_null=True, unique=True), ColumnSpec("amount", kind="float", not_null=True), ColumnSpec("a"), ColumnSpec("b"))
)


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(["id,amount,a,b", *lines]) + "\n")


def test_stream_load(spark, tmp_path):
    landing, root, checkpoint = tmp_path / "landing", str(tmp_path / "root"), str(tmp_path / "checkpoint")
    load.init_tables(spark, root, CONTRACT)
    put(landing, "1.csv", ["1,1,x,p", "2,,x,p", "1,2,x,p", "7,1,x"])
    for _ in range(2):
        stream_load(spark, str(landing), root, CONTRACT, checkpoint).awaitTermination()
        report = load.load_report(spark, root).collect()
        assert [(r["rows"], r["errors"], r["width_errors"]) for r in report] == [(1, 2, 1)]
    put(landing, "2.csv", ["1,1,x,p", "2,5,y,q"])
    stream_load(spark, str(landing), root, CONTRACT, checkpoint).awaitTermination()
    assert [r["id"] for r in load.fact_table(spark, root, CONTRACT).orderBy("row_id").collect()] == ["1", "2"]
    assert rows(load.check_load(spark, root, CONTRACT)) == [(2, 2, True)]


def test_repeated_batch_is_skipped(spark, tmp_path):
    root = str(tmp_path / "root")
    versions.reset(spark, root)
    facts = spark.createDataFrame([("x", "p", 1.0), ("y", "q", 2.0)], "a string, b string, m double")
    assert cubes.merge_batch(facts, 0, root, DIMS, "m", "one")["version"] == 1
    assert cubes.merge_batch(facts, 0, root, DIMS, "m", "one")["version"] == 1
    assert cubes.merge_batch(facts, 0, root, DIMS, "m", "two")["version"] == 2
    apex = cubes.stored_cube(spark, root).where("cuboid_mask = 0").first()
    assert (apex["sum_amount"], apex["count"]) == (6.0, 4)


def test_stream_refresh_equals_recomputation(spark, tmp_path):
    root, landed, checkpoint = (str(tmp_path / n) for n in ("root", "landed", "checkpoint"))
    versions.reset(spark, root)
    for i in range(2):
        facts = spark.range(50).select(
            F.concat(F.lit("a"), (F.col("id") * (i + 1) % 7).cast("string")).alias("a"),
            F.concat(F.lit("b"), (F.col("id") % 4).cast("string")).alias("b"),
            (F.col("id") + i).cast("decimal(18,2)").alias("m"),
        )
        facts.write.mode("append").parquet(landed)
        stream = spark.readStream.schema(facts.schema).option("maxFilesPerTrigger", 2).parquet(landed)
        stream_refresh(stream, root, DIMS, "m", checkpoint).awaitTermination()
        whole = full_cube(spark.read.parquet(landed), DIMS, "m")
        assert rows(finish(cubes.stored_cube(spark, root))) == rows(finish(whole))


def test_export_in_key_order_over_many_files(spark, tmp_path, conf):
    conf({"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"})
    data = [(f"a{i % 13}", [f"b{i}", "", None, 'q"x', "p, q", "#c", "two\nlines"][i % 7], Decimal(i)) for i in range(500)]
    facts = spark.createDataFrame(data, "a string, b string, m decimal(18,2)")
    cuboids.export_cuboids(full_cube(facts, DIMS, "m"), DIMS, str(tmp_path / "out"))
    names = sorted(p.name for p in (tmp_path / "out").iterdir())
    assert names == sorted(f"{n}.csv" for n in cuboid_names(DIMS))
    files = sorted((tmp_path / "out" / "cuboid_a_b.csv").glob("part-*.csv"))
    assert len(files) > 1
    found = []
    for file in files:
        with open(file, newline="") as text:
            header, *lines = csv_reader(text)
        assert header == ["a", "b", "sum_amount", "count", "avg_amount", "min_amount", "max_amount"]
        found += [(a, b) for a, b, *_ in lines]
    pairs = {(a, b or "") for a, b, _ in data}
    assert set(found) == pairs
    assert [f"{a}|{b}".encode() for a, b in found] == sorted(f"{a}|{b}".encode() for a, b in found)


def test_a_retried_task_counts_once(tmp_path):
    """The counts of a load come from the job that writes; a task that fails first doesn't add to them."""
    script = f"""
import os, sys
sys.path.insert(0, {str(REPO)!r})
from pyspark.sql import SparkSession, functions as F
from prismcube.plans.load import observed_write
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()
def once(batches):
    rows = list(batches)
    yield from rows
    if not os.path.exists({str(tmp_path / "failed")!r}):
        open({str(tmp_path / "failed")!r}, "w").close()
        raise OSError("lost")
df = spark.range(0, 5000, 1, 2).mapInArrow(once, "id long")
found = observed_write(lambda d: d.write, df, {str(tmp_path / "out")!r}, odd=F.count_if(F.col("id") % 2 == 1))
print("COUNTED", found["rows"], found["odd"], spark.read.parquet({str(tmp_path / "out")!r}).count())
"""
    run = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert "COUNTED 5000 2500 5000" in run.stdout, run.stderr[-2000:]
    assert (tmp_path / "failed").exists()


def test_compressed_landing_files_load_like_plain_ones(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(csv_sink, "COMPRESSED_ROWS", 10)
    contract = Contract((ColumnSpec("k", not_null=True, unique=True), ColumnSpec("v", dictionary=True), ColumnSpec("a", kind="float")))
    df = spark.range(35).coalesce(1).selectExpr("concat('k', id % 30) AS k", "concat('v, ', id) AS v", "id / 4 AS a")
    found = []
    for compression in ("none", "gzip"):
        root = str(tmp_path / compression)
        load.init_tables(spark, root, contract)
        for day in (1, 2):
            csv_sink.write_csv(df if day == 1 else df.selectExpr("concat('x', k) AS k", "v", "a"), f"{root}/landing/{day}", compression=compression)
            load.append_load(spark, f"{root}/landing/*", root, contract)
        found.append(rows(load.fact_table(spark, root, contract)) + rows(load.reject_report(spark, root, contract)))
    assert found[0] == found[1] and len(found[0]) == 70
    names = sorted(p.name for p in (tmp_path / "gzip/landing/1").glob("part-*"))
    assert len(names) == 4 and all(n.endswith(".csv.gz") for n in names)
    stored = [p.name for p in (tmp_path / "gzip").rglob("*.parquet")]
    assert stored and any(".zstd." in n for n in stored)
