"""The stream over raw files: offsets at record ends, restarts inside a file, files that grow or fail."""
import os

from tickscan.sources.dayfile import read_day_files
from tickscan.sources.daystream import DayFileStreamReader, last_record_end, record_ends, stream_day_files
from test_dayfile import DESC, HEAD, PRE
from test_records import write_raw


def body(k, n, quoted=True):
    return "".join(f'{k}.FR,E,{i},08-11-2021,10:{i // 60:02d}:{i % 60:02d}' + (f',"note\n{i}, ""x"""\n' if quoted else ",y\n") for i in range(n))


def test_record_ends():
    data = b'a,"x\ny"\nb\n"c\n""d\n'
    assert list(record_ends(data)) == [8, 10]
    assert last_record_end(data) == 10 and last_record_end(b"ab") == 0 and last_record_end(b"ab\nc") == 3


def offsets(reader):
    seen = [reader.initialOffset()]
    while True:
        new = reader.latestOffset()
        if new == seen[-1]:
            return seen
        seen.append(new)


def test_offsets_and_ranges(tmpdir_path):
    write_raw(tmpdir_path, "a.csv", PRE + HEAD + DESC + body("A", 100))
    write_raw(tmpdir_path, "b.csv", PRE + HEAD.replace("Last", "Lost") + DESC + body("B", 5))
    write_raw(tmpdir_path, "c.csv", PRE + HEAD + DESC + body("C", 70, False)[:-1])   # no line end at the end
    write_raw(tmpdir_path, "d.csv", PRE)
    reader = DayFileStreamReader({"path": tmpdir_path, "max_bytes": "900", "range_bytes": "250"})
    seen = offsets(reader)
    assert len(seen) > 6
    rows, sizes = [], []
    for start, end in zip(seen, seen[1:]):
        parts = reader.partitions(start, end)
        sizes.append(sum(p.end - p.begin for p in parts))
        for p in parts:
            for batch in reader.read(p):
                rows += list(zip(*(batch.column(i).to_pylist() for i in range(5))))
    assert max(sizes) <= 900 and [r[:3] for r in rows] == [(f"{k}.FR", "E", str(i)) for k, n in (("A", 100), ("C", 70)) for i in range(n)]
    # a record longer than the bound is admitted whole
    tiny = DayFileStreamReader({"path": tmpdir_path, "max_bytes": "3"})
    assert len(offsets(tiny)) >= 170
    # a file that grows: its unfinished record waits
    write_raw(tmpdir_path, "e.csv", PRE + HEAD + DESC + body("E", 2) + "E.FR,E,9,08-11")
    live = DayFileStreamReader({"path": tmpdir_path, "glob": "e.csv", "growing": "true"})
    first = live.latestOffset()
    with open(os.path.join(tmpdir_path, "e.csv"), "a") as f:
        f.write("-2021,10:00:09,z\n")
    [part] = live.partitions(first, live.latestOffset())
    assert next(live.read(part)).column(2).to_pylist() == ["9"]


def test_restart_inside_a_file(spark, tmpdir_path):
    src, check, out = (os.path.join(tmpdir_path, n) for n in ("in", "check", "out"))
    os.makedirs(src)
    write_raw(src, "a.csv", PRE + HEAD + DESC + body("A", 200))
    write_raw(src, "b.csv", PRE + HEAD + DESC + body("B", 100))

    def start():
        return (stream_day_files(spark, src, check, max_bytes=4000, range_bytes=1000).writeStream.format("parquet").option("path", out)
                .option("checkpointLocation", check).trigger(processingTime="50 milliseconds").start())
    q = start()
    while not q.lastProgress or q.lastProgress["numInputRows"] == 0:
        assert q.exception() is None
    q.stop()
    part = spark.read.parquet(out).count()
    assert 0 < part < 300
    write_raw(src, "c.csv", PRE + HEAD + DESC + body("C", 10))
    q = start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    cols = ["id", "sec_type", "last", "trade_timestamp"]
    want = sorted(tuple(r) for r in read_day_files(spark, src).ticks.select(*cols).collect())
    assert sorted(tuple(r) for r in spark.read.parquet(out).select(*cols).collect()) == want and len(want) == 310
