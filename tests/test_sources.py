"""Readers, writers and scratch tables."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from recordlens import sources
from recordlens.plans import prepare
from recordlens.plans.tables import campaigns
from recordlens.sources import files

QUOTED = 'name,desc,country,currency\nx,"say ""hi, there"" now",US,USD\n'


def test_quotes_inside_quoted_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text(QUOTED)
    columns = ["name", "desc", "country", "currency"]
    row = sources.read_csv(spark, str(tmp_path), columns).first()
    assert tuple(row) == ("x", 'say "hi, there" now', "US", "USD")
    # Another escape character makes the comma inside the text shift the columns to the right.
    assert sources.read_csv(spark, str(tmp_path), columns, escape="\\").first()["currency"] != "USD"


def test_line_breaks_inside_quoted_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text('name,goal\n"two\nlines",5\n')
    rows = sources.read_csv(spark, str(tmp_path), ["name", "goal"], {"goal": "int"}, multi_line=True).collect()
    assert [tuple(row) for row in rows] == [("two\nlines", 5)]


def test_csv_types_and_bad_values(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name,goal\na,20.7\nb,abc\nc,\n")
    df = sources.read_csv(spark, str(tmp_path), ["name", "goal"], {"goal": "int"})
    assert [row["goal"] for row in df.collect()] == [20, None, None]


def test_csv_read_looks_at_the_header_only(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name,goal\na,1\n")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("csv-read", "")
    sources.read_csv(spark, str(tmp_path), ["name", "goal"], {"goal": "int"})
    assert len(tracker.getJobIdsForGroup("csv-read")) <= 1
    spark.sparkContext.setJobGroup("", "")


def test_text_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"one two\r\n\nthree")
    assert [row[0] for row in sources.read_text(spark, str(tmp_path)).collect()] == ["one two", "", "three"]


def test_parquet_glob_reads_all_parts(spark, tmp_path):
    spark.range(100).repartition(4).write.parquet(str(tmp_path / "t"))
    assert sources.read_parquet(spark, f"{tmp_path}/t/*.parquet").count() == 100
    assert sources.read_parquet(spark, [f"{tmp_path}/t", f"{tmp_path}/t"]).count() == 200


def test_merged_schema(spark, tmp_path):
    spark.range(2).selectExpr("id", "1 as a").write.parquet(f"{tmp_path}/t/part=1")
    spark.range(2).selectExpr("id", "'x' as b").write.parquet(f"{tmp_path}/t/part=2")
    assert set(sources.read_parquet(spark, f"{tmp_path}/t", merge_schema=True).columns) == {"id", "a", "b", "part"}


def test_write_modes(spark, tmp_path):
    path = f"{tmp_path}/t"
    sources.write_parquet(spark.range(3), path)
    with pytest.raises(AnalysisException):
        sources.write_parquet(spark.range(5), path)
    assert spark.read.parquet(path).count() == 3
    sources.write_parquet(spark.range(5), path, overwrite=True)
    assert spark.read.parquet(path).count() == 5


def test_scratch_uses_the_shared_folder(spark, shared_folder):
    path = sources.scratch_path(spark, "x")
    assert path.startswith(f"{shared_folder}/x-")
    assert path != sources.scratch_path(spark, "x")
    assert sources.materialize(spark.range(7), "seven").count() == 7
    assert list(shared_folder.glob("seven-*"))


def test_scratch_without_shared_folder_is_in_the_warehouse():
    class Session:
        conf = {"spark.sql.warehouse.dir": "hdfs://store/warehouse"}
        sparkContext = type("Context", (), {"getCheckpointDir": lambda self: None})()

    assert sources.scratch_path(Session(), "x").startswith("hdfs://store/warehouse/scratch/x-")


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,goal,name\n7,20,n1\n")
    read = lambda *a, **k: [tuple(r) for r in sources.read_csv(spark, str(tmp_path), *a, **k).collect()]
    assert read(["name", "goal"], {"goal": "int"}) == [("n1", 20)]
    assert read(["name"], others=True) == [("n1", "7", "20")] and read() == [("7", "20", "n1")]
    with pytest.raises(ValueError, match="desc"):
        read(["name", "desc"])
    (tmp_path / "b.csv").write_text("goal,id,name\n20,7,n1\n")
    with pytest.raises(Exception, match="header"):
        read(["name", "goal"])


def test_prepare_job_from_csv_to_parquet(spark, tmp_path):
    header = ",".join(prepare.RAW_COLUMNS)
    line = '"Big ""Idea""","Make, it",20.7,Art-x,False,False,US,1435162500,0,1434927511,1434931111,3,1'
    (tmp_path / "in.csv").write_text(f"{header}\n{line}\n")
    prepare.run(spark, f"{tmp_path}/in.csv", f"{tmp_path}/out")
    row = sources.read_parquet(spark, f"{tmp_path}/out/*.parquet").first().asDict()
    assert row == {
        "name": 'big "idea"',
        "desc": "make, it",
        "goal": 20,
        "keywords": "art-x",
        "final_status": 1,
        "country2": "US",
        "currency2": "Unknown",
        "days_campaign": 2.678,
        "hours_prepa": 1.0,
        "text": 'big "idea" make, it art-x',
    }


def test_preparing_is_one_stage_and_reads_no_dropped_column(spark, tmp_path):
    raw = spark.createDataFrame(
        [("n", "d", "1", "k", "False", "US", "USD", 2, 3, 1, 1, 5, 1)], list(prepare.RAW_COLUMNS)
    )
    raw.write.parquet(f"{tmp_path}/raw")
    plan = prepare.prepare_records(spark.read.parquet(f"{tmp_path}/raw"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    scan = plan[plan.index("ReadSchema") :]
    assert "backers_count" not in scan and "disable_communication" not in scan


def test_preparing_takes_a_stream(spark, small, tmp_path):
    raw = campaigns(spark, small)
    raw.write.parquet(f"{tmp_path}/raw")
    stream = prepare.prepare_records(spark.readStream.schema(raw.schema).parquet(f"{tmp_path}/raw"))
    query = stream.writeStream.format("memory").queryName("prepared_stream").trigger(availableNow=True).start()
    query.awaitTermination(60)
    found, wanted = spark.table("prepared_stream"), prepare.prepare_records(raw)
    assert found.count() == wanted.count() and found.exceptAll(wanted).isEmpty()


# Malformed rows

ODD_LINES = """name,goal,desc
a,1,plain
b,2,"a, b",EXTRA
c,3
d,abc,"say ""hi, there"" now"
"e, f",20.7,
g,"open, never
,,
h,5,x,,
"""


@pytest.mark.parametrize("strict", [False, True])
def test_malformed_rows_are_set_apart(spark, tmp_path, strict):
    (tmp_path / "a.csv").write_text(ODD_LINES)
    (tmp_path / "b.csv").write_text("name,goal,desc\ni,7,y\nj\n")
    good, rejected = sources.read_csv_checked(spark, str(tmp_path), ["goal", "name"], {"goal": "int"}, strict=strict)
    unfit = [] if strict else [(None, "d")]
    assert sorted(map(tuple, good.collect()), key=repr) == sorted([(1, "a"), *unfit, (20, "e, f"), (None, None), (7, "i")], key=repr)
    found = {(r["file"].rpartition("/")[2], r["line"]): (r["n_fields"], r["reason"]) for r in rejected.collect()}
    wanted = {
        ("a.csv", 'b,2,"a, b",EXTRA'): (4, "too many fields"),
        ("a.csv", "c,3"): (2, "too few fields"),
        ("a.csv", 'g,"open, never'): (None, "a quote does not end"),
        ("a.csv", "h,5,x,,"): (5, "too many fields"),
        ("b.csv", "j"): (1, "too few fields"),
    }
    if strict:
        wanted["a.csv", 'd,abc,"say ""hi, there"" now"'] = (3, "goal is no int")
    assert found == wanted
    # A part of the columns changes nothing.
    assert good.count() == 5 - strict and rejected.select("reason").count() == len(wanted)


def test_checked_rows_of_good_and_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("_broken,_file\n1,2\n")
    good, rejected = sources.read_csv_checked(spark, str(tmp_path))
    assert [tuple(r) for r in good.collect()] == [("1", "2")] and good.columns == ["_broken", "_file"] and rejected.isEmpty()
    (tmp_path / "a.csv").write_text("_broken,_file\n")
    good, rejected = sources.read_csv_checked(spark, str(tmp_path), types={"_file": "int"}, strict=True)
    assert good.isEmpty() and rejected.isEmpty()
    with pytest.raises(ValueError, match="desc"):
        sources.read_csv_checked(spark, str(tmp_path), ["desc"])


def test_inferred_reading(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b,c,d,e,f,g\n1,2.5,2020-01-31,x,true,,3000000000\n-2,1e3,2020-02-30,1,FALSE,,1\n,.5,,,,,\n")
    df = sources.read_csv_inferred(spark, str(tmp_path))
    assert [t for _, t in df.dtypes] == ["int", "double", "string", "string", "boolean", "string", "bigint"]
    assert tuple(df.first()) == (1, 2.5, "2020-01-31", "x", True, None, 3000000000)
    loose = sources.read_csv_inferred(spark, str(tmp_path), least_share=0.5)
    assert [t for _, t in loose.dtypes][2:4] == ["date", "int"] and loose.where("c is null").count() == 2


# Replacing tables


def names_in(folder):
    return sorted(p.name for p in folder.iterdir())


def test_a_failed_overwrite_leaves_the_old_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    sources.write_parquet(spark.range(100), path)
    half = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 90, F.raise_error(F.lit("broken")).cast("long")).otherwise(-F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        sources.write_parquet(half, path, overwrite=True)
    assert spark.read.parquet(path).agg(F.sum("id")).first()[0] == 4950
    assert names_in(tmp_path) == ["t"]


def test_a_table_is_replaced_by_what_is_read_from_it(spark, tmp_path):
    path = f"{tmp_path}/t"
    for _ in range(2):
        sources.write_parquet(spark.range(100), path, overwrite=True)
    for left in (50, 25):
        sources.write_parquet(spark.read.parquet(path).where(f"id < {left}"), path, overwrite=True)
        assert spark.read.parquet(path).count() == left
    assert names_in(tmp_path) == ["t"]


def test_an_interrupted_overwrite_is_put_right(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    sources.write_parquet(spark.range(3), path)
    moves = []

    def rename(spark, old, new, real=files.rename):
        moves.append(old)
        if len(moves) == 2:
            raise OSError("the store is gone")
        real(spark, old, new)

    with monkeypatch.context() as patch:
        patch.setattr(files, "rename", rename)
        with pytest.raises(OSError, match="gone"):
            sources.write_parquet(spark.range(5), path, overwrite=True)
    assert spark.read.parquet(path).count() == 3 and names_in(tmp_path) == ["t"]
    # The driver died between the renames: the old table stands beside its place, hidden from readers of the folder.
    (tmp_path / "t").rename(tmp_path / "_t.old-1")
    assert sources.restore_interrupted(spark, path) and not sources.restore_interrupted(spark, path)
    assert spark.read.parquet(path).count() == 3
    (tmp_path / "t").rename(tmp_path / "_t.old-1")
    sources.write_parquet(spark.range(7), path, overwrite=True)
    assert spark.read.parquet(path).count() == 7 and names_in(tmp_path) == ["t"]


# Scratch tables that end


def test_a_scope_deletes_what_was_made_in_it(spark, shared_folder):
    before = set(names_in(shared_folder))
    with sources.scope(spark):
        sources.materialize(spark.range(3), "outer")
        with sources.scope(spark):
            inner = sources.materialize(spark.range(4), "inner")
            assert inner.count() == 4
        assert {n.partition("-")[0] for n in set(names_in(shared_folder)) - before} == {"outer"}
        with pytest.raises(KeyError), sources.scope(spark):
            sources.materialize(spark.range(5), "failed")
            raise KeyError
    assert set(names_in(shared_folder)) == before
