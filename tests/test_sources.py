"""Readers and sinks on small files."""

import datetime as dt
import os
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quartermill.sources import readers, writers


def write(path: Path, text: str) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_delimited_files_by_pattern(spark, rows, tmp_path):
    write(tmp_path / "Daily_1.txt", "psnu\tvalue\na\t1.5\n")
    write(tmp_path / "Daily_2.txt", "psnu\tvalue\nb\t\n")
    write(tmp_path / "Frozen.txt", "psnu\tvalue\nc\t9\n")
    df = readers.read_delimited(spark, str(tmp_path), "psnu string, value double", pattern="Daily*")
    assert rows(df) == [("a", 1.5), ("b", None)]
    assert len(df.inputFiles()) == 2


def test_many_files_one_scan_with_source(spark, rows, tmp_path):
    spark.range(2).coalesce(1).write.parquet(str(tmp_path / "a"))
    next((tmp_path / "a").glob("*.parquet")).rename(tmp_path / "x_1.parquet")
    spark.range(3).withColumn("extra", F.lit("e")).repartition(2).write.parquet(str(tmp_path / "x_2.parquet"))
    spark.range(9).write.parquet(str(tmp_path / "y.parquet"))
    df = readers.read_many(spark, str(tmp_path), "x_*.parquet", source="source", merge=True)
    assert set(df.columns) == {"id", "extra", "source"}
    assert rows(df.groupBy("source").count()) == [("x_1.parquet", 2), ("x_2.parquet", 3)]
    assert readers.read_many(spark, str(tmp_path), "x_*.parquet", schema="id long").columns == ["id"]


def test_moved_columns_are_bound_by_name(spark, rows, tmp_path):
    folder = tmp_path / "with space+plus"
    write(folder / "y_1.tsv", "k\tv\nA\t1\n")
    write(folder / "y_2.tsv", "v\tk\n2\tB\n")
    df = readers.read_delimited(spark, str(folder), "k string, v int", source="path")
    assert rows(df, "k", "v") == [("A", 1), ("B", 2)]
    assert {p.rsplit("/", 2)[-2] for (p,) in rows(df, "path")} == {"with space+plus"}
    write(folder / "y_3.tsv", "k\tw\nC\t3\n")
    with pytest.raises(ValueError, match="not declared"):
        readers.read_delimited(spark, str(folder), "k string, v int")
    with pytest.raises(ValueError, match="absent"):
        readers.read_delimited(spark, str(folder), "k string, v int", ignore_unknown=True)
    df = readers.read_delimited(spark, str(folder), "k string, v int", ignore_unknown=True, allow_absent=True)
    assert rows(df) == [("A", 1), ("B", 2), ("C", None)]


def test_many_text_files_have_header_and_source(spark, rows, tmp_path):
    folder = tmp_path / "in put"
    write(folder / "m_a.txt", "k\tv\nA\t1\n")
    write(folder / "m_b.txt" / "part-0.csv", "v\tk\n2\tB\n")
    df = readers.read_many(spark, str(folder), "m_*", fmt="csv", schema="k string, v int", source="source")
    assert rows(df) == [("A", 1, "m_a.txt"), ("B", 2, "m_b.txt")]


def test_entries_named_like_their_folder(spark, rows, tmp_path):
    write(tmp_path / "x" / "x" / "part-0.csv", "k\tv\nA\t1\n")
    write(tmp_path / "x" / "y" / "x" / "part-0.csv", "k\tv\nB\t2\n")
    for folder in (tmp_path / "x", f"file:{tmp_path}/x", f"{tmp_path}/*"):
        df = readers.read_many(spark, str(folder), "{x,y/x}", fmt="csv", schema="k string, v int", source="source")
        assert rows(df) == [("A", 1, "x"), ("B", 2, "y")]


def jobs(spark, build) -> int:
    """How many Spark jobs a function starts."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "")
    build()
    found = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext._jsc.clearJobGroup()
    return len(found)


def test_jobs_do_not_grow_with_files(spark, rows, tmp_path):
    for n in (100, 200):
        for i in range(n):
            write(tmp_path / str(n) / f"f{i:03}.tsv", ("k\tv\nA\t1\n" if i % 2 else "v\tk\n1\tA\n"))
    built = {}
    for n in (100, 200):
        count = jobs(spark, lambda n=n: built.update({n: readers.read_delimited(spark, str(tmp_path / str(n)), "k string, v int")}))
        built[n] = (count, built[n])
    # Spark lists many paths by jobs of its own, as many for either number.
    assert built[200][0] == built[100][0]
    assert rows(built[200][1].groupBy("k", "v").count()) == [("A", 1, 200)]


def test_empty_files_and_marks_of_byte_order(spark, rows, tmp_path):
    write(tmp_path / "a.tsv", "\ufeffk\tv\nA\t1\n")
    write(tmp_path / "b.tsv", "")
    assert rows(readers.read_delimited(spark, str(tmp_path), "k string, v int")) == [("A", 1)]
    with pytest.raises(FileNotFoundError):
        readers.read_delimited(spark, str(tmp_path), "k string", pattern="b*")


def test_quoted_line_ends_and_compressed_sheets(spark, rows, tmp_path):
    import gzip

    write(tmp_path / "q" / "s.csv", 'Title,\n"Org\nUnit",n\n"a\nb",1\n,\nc,2\n')
    df = readers.promote_header(spark, str(tmp_path / "q"), 2, multiline=True)
    assert rows(df) == [("a\nb", "1"), ("c", "2")] and df.columns[1] == "n"
    (tmp_path / "z").mkdir()
    for k in range(3):
        with gzip.open(tmp_path / "z" / f"{k}.csv.gz", "wt") as f:
            f.write("t\nk,v\n" + "".join(f"{k},{i}\n" for i in range(50)))
    df = readers.promote_header(spark, str(tmp_path / "z"), 2)
    assert rows(df.groupBy("k").count()) == [("0", 50), ("1", 50), ("2", 50)]


def test_latest_folder_is_read_whole(spark, rows, tmp_path):
    for i, name in enumerate(["1/part-0.csv", "2/part-0.csv", "2/part-1.csv"]):
        p = write(tmp_path / name, f"k\n{name}\n")
        os.utime(p, (1_700_000_000 + i * 100, 1_700_000_000 + i * 100))
    folder = readers.latest_folder(spark, f"{tmp_path}/*")
    assert rows(readers.read_delimited(spark, folder, "k string")) == [("2/part-0.csv",), ("2/part-1.csv",)]


def test_latest_file_by_time(spark, tmp_path):
    for i, name in enumerate(["CTX_old.txt", "CTX_new.txt", "other.txt"]):
        p = write(tmp_path / name, "x")
        os.utime(p, (1_700_000_000 + i * 100, 1_700_000_000 + i * 100))
    assert readers.latest_file(spark, str(tmp_path), "CTX*").endswith("CTX_new.txt")
    with pytest.raises(FileNotFoundError):
        readers.latest_file(spark, str(tmp_path), "none*")


def test_tagged_sheets(frame, rows):
    new = frame("a string, b string, c string", [("F1", "1234.0", "5")])
    kp = frame("a string, b string, k string, c string", [("F2", "12340", "KP", "x")])
    df = readers.tagged_union(
        {"TX_NEW": (new, ["Facility", "Code", "Total"]), "TX_NEW_KP": (kp, ["Facility", "Code", "KP_Type", "Total"])}
    )
    assert rows(df, "Facility", "Code", "Total", "indicator", "KP_Type") == [
        ("F1", "1234", 5.0, "TX_NEW", None), ("F2", "12340", None, "TX_NEW_KP", "KP"),
    ]


def test_grid_columns_by_header_name(frame, rows):
    docs = [
        (1, '{"listGrid":{"headers":[{"column":"b"},{"column":"a"}],"rows":[["1","2"],["3",null]]}}'),
        (2, '{"listGrid":{"headers":[{"column":"a"}],"rows":[["9"]]}}'),
        (3, "not json"),
    ]
    got = readers.flatten_grid(frame("id int, j string", docs), "j", ["a", "b"], ["id"])
    assert rows(got) == [(1, "2", "1"), (1, None, "3"), (2, "9", None)]


def test_header_on_a_later_line(spark, rows, tmp_path):
    path = write(tmp_path / "s.csv", "Title,,\nnote,,\nOrg Unit,Nurse - Count,FTE\nA,1,0.5\nB,2,1.0\n")
    df = readers.promote_header(spark, path, 3)
    assert df.columns == ["org_unit", "nurse_count", "fte"]
    assert rows(df) == [("A", "1", "0.5"), ("B", "2", "1.0")]


def test_data_rows_like_the_header_stay(spark, rows, tmp_path):
    path = write(tmp_path / "d" / "s.csv", '1,2\n"Org, Unit",n\n1,2\nx,5\n"Org, Unit",n\n')
    write(tmp_path / "d" / "t.csv", 'title\n"Org, Unit",n\n"a, b",7\nc\n')
    one = readers.promote_header(spark, path, 2)
    assert one.columns == ["org_unit", "n"]
    assert rows(one) == [("1", "2"), ("Org, Unit", "n"), ("x", "5")]
    both = readers.promote_header(spark, str(tmp_path / "d"), 2)
    assert rows(both) == [("1", "2"), ("Org, Unit", "n"), ("a, b", "7"), ("c", None), ("x", "5")]
    assert rows(readers.promote_header(spark, path, 2, skip_after=1)) == [("Org, Unit", "n"), ("x", "5")]


def test_null_is_written_empty(spark, frame, tmp_path):
    out = str(tmp_path / writers.dated_name("fact", "FY24Q2", dt.date(2024, 5, 1)))
    assert out.endswith("2024-05-01_fact_FY24Q2")
    writers.write_delimited(frame("a string, b double", [("x", None), (None, 1.0)]).coalesce(1), out)
    text = "".join(p.read_text() for p in Path(out).glob("part-*.csv"))
    assert sorted(line for line in text.split("\n") if line) == ["\t1.0", "a\tb", "x\t"]
    assert "NA" not in text and "null" not in text


def test_partner_folders_add_up(spark, frame, tmp_path):
    df = frame("mech_code string, value double", [(m, float(i)) for i, m in enumerate(["1", "2", "1", "3", "1"])])
    out = str(tmp_path / "split")
    writers.write_by_key(df, out, ["mech_code"])
    assert {p.name for p in Path(out).iterdir() if p.is_dir()} == {"mech_code=1", "mech_code=2", "mech_code=3"}
    back = spark.read.parquet(out)
    assert back.count() == 5 and back.agg(F.sum("value")).first()[0] == 10.0


def test_findings_by_level_folder(spark, frame, tmp_path):
    out = str(tmp_path / "findings")
    writers.write_findings(frame("level string, check string", [("Level 1", "a"), ("Level 2", "b")]), out)
    assert {p.name for p in Path(out).iterdir() if p.is_dir()} == {"level=Level 1", "level=Level 2"}
