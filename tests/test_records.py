"""Quoted records against a plain CSV reader, over splits of a few hundred bytes."""
import csv
import io
import os
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickscan.sources.dayfile import read_day_files
from tickscan.sources.records import cells, ends_inside, read_records
from test_dayfile import DESC, HEAD, PRE, write


def plain(text):
    return [r for r in csv.reader(io.StringIO(text, newline="")) if r]


def split_small(spark, size):
    class Held:
        def __enter__(self):
            self.old = spark.conf.get("spark.sql.files.maxPartitionBytes")
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))

        def __exit__(self, *exc):
            spark.conf.set("spark.sql.files.maxPartitionBytes", self.old)
    return Held()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text('a",', max_size=8), min_size=1, max_size=6))
def test_states(lines):
    """A line ends inside a cell exactly if a CSV reader asks for the next line."""
    inside, taken = False, 0
    for i, line in enumerate(lines):
        inside = ends_inside(line, inside)
        if not inside:
            assert len(list(csv.reader(io.StringIO("\n".join(lines[taken:i + 1]) + "\n")))) == 1
            taken = i + 1


def test_records(spark, tmpdir_path):
    r = random.Random(11)
    want = {}
    for k in range(6):
        rows = []
        for i in range(150):
            cell = lambda: r.choice(["", "a", "1.5", 'in "quotes"', "x,y", "two\nlines", "a\r\nb", "\n\n", '"', "é\n", "z" * r.randrange(40)])
            rows.append([f"{k}.{i}", *[cell() for _ in range(r.randrange(1, 5))]])
        out = io.StringIO(newline="")
        csv.writer(out, lineterminator=["\n", "\r\n"][k % 2]).writerows(rows)
        text = out.getvalue() + ["", 'tail 5" x,b"c\n'][k // 3]
        write_raw(tmpdir_path, f"f{k}.csv", text)
        want[f"f{k}.csv"] = plain(text)
    write_raw(tmpdir_path, "empty.csv", "")
    with split_small(spark, 300):
        got = read_records(spark, tmpdir_path)
    rows = got.records.withColumn("c", cells(F.col("value"))).orderBy("file", "record").collect()
    held = {}
    for row in rows:
        held.setdefault(os.path.basename(row["file"]), []).append(row["c"])
    assert held == want
    assert got.unclosed.collect() == []
    assert got.written.select("block").distinct().count() > 8
    got.release()


def write_raw(d, name, text):
    with open(os.path.join(d, name), "w", newline="") as f:
        f.write(text)


def test_quote_never_closed(spark, tmpdir_path):
    write_raw(tmpdir_path, "a.csv", "a,b\n" + '"open,\n' + "x,y\n" * 50)
    write_raw(tmpdir_path, "b.csv", 'c,"d\ne"\n')
    got = read_records(spark, tmpdir_path, max_lines=20)
    assert sorted(r["value"] for r in got.records.collect()) == ["a,b", 'c,"d\ne"']
    assert [(r["record"], r["lines"]) for r in got.unclosed.collect()] == [(1, 51)]


def test_day_file_over_small_splits(spark, tmpdir_path):
    body = "".join(f'AAA.FR,E,{i},08-11-2021,10:00:{i:02d},"note {i}\nwith, ""line"" ends"\n' for i in range(50))
    write_raw(tmpdir_path, "x.csv", PRE.replace("preamble line 3", '"preamble\nline 3"') + HEAD + DESC + body)
    write(tmpdir_path, "y.csv", PRE + HEAD)
    write_raw(tmpdir_path, "z.csv", "")
    with split_small(spark, 200):
        out = read_day_files(spark, tmpdir_path)
    got = out.ticks.orderBy("seq").collect()
    assert [r["last"] for r in got] == [str(i) for i in range(50)] and [r["seq"] for r in got] == list(range(13, 63))
    assert {os.path.basename(r["file"]): len(r["missing"]) for r in out.rejected.collect()} == {"z.csv": 5}
    out.release()


def test_small_splits_share_tasks(spark, tmpdir_path):
    """The number of tasks, each writing a file, does not follow the number of splits."""
    rows = [f'{i},"two\nlines, of ""{i}""",x' for i in range(1000)]
    write(tmpdir_path, "a.csv", "\n".join(rows) + "\n")
    with split_small(spark, 100):
        found = read_records(spark, tmpdir_path)
    blocks = found.written.select("block").distinct().count()
    assert blocks > 200 and len(found.written.inputFiles()) <= 5 * spark.sparkContext.defaultParallelism
    assert [r.value for r in found.records.orderBy("record").collect()] == rows
    assert spark.conf.get("spark.sql.files.maxPartitionNum", None) is None
    found.release()
