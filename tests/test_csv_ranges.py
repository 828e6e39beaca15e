"""CSV files cut into ranges against the reader that takes a file in one task."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from gleanery.sources import csv_ranges, tables_csv

COLUMNS = ["a", "b", "c"]


def written(folder, rows, header=True, name="x.csv"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    for row in ([COLUMNS] if header else []) + rows:
        writer.writerow(row)
    (folder / name).write_text(out.getvalue(), encoding="utf-8", newline="")
    return str(folder)


def some_rows(seed, n=150):
    r = random.Random(seed)
    field = lambda: "".join(r.choices(['"', "\n", ",", "word", "é", " x", ""], k=r.choice([0, 1, 3, 12, 120 if r.random() < 0.05 else 2])))
    return [[str(i), field(), field()] for i in range(n)]


@pytest.mark.parametrize("seed, range_bytes", [(0, 64), (1, 300), (2, 2000), (3, None)])
def test_against_one_task(spark, tmp_path, seed, range_bytes):
    rows = some_rows(seed)
    rows[7:9] = [["7", "too", "many", "fields"], ["8", "few"]]
    path = written(tmp_path, rows)
    written(tmp_path, some_rows(seed + 10, 30), name="y.csv")
    plain = tables_csv.read_csv_tolerant(spark, path, COLUMNS, max_chars=200)
    found = csv_ranges.read_csv_ranges(spark, path, COLUMNS, max_chars=200, range_bytes=range_bytes)
    assert found.columns == plain.columns
    got = sorted(map(tuple, found.collect()))
    assert got == sorted(map(tuple, plain.collect())) and len(got) == 180
    assert sum(r[-1] for r in got) >= 2


def test_a_large_file_has_many_ranges_in_order(spark, tmp_path):
    rows = some_rows(5, 300)
    path = written(tmp_path, rows, header=False)
    records = csv_ranges.csv_records(spark, path, header=False, range_bytes=200)
    got = records.orderBy("range", "place").select(F.split("value", ",")[0]).collect()
    assert [r[0] for r in got] == [r[0] for r in rows]
    assert records.select("range").distinct().count() > 20


def test_a_record_over_many_ranges_and_one_that_never_ends(spark, tmp_path):
    long = "line\n" * 500
    path = written(tmp_path, [["1", long, "x"], ["2", "y", "z"]])
    got = csv_ranges.read_csv_ranges(spark, path, COLUMNS, range_bytes=100).collect()
    assert sorted((r.a, r.b, r.c) for r in got) == [("1", long, "x"), ("2", "y", "z")]
    (tmp_path / "open").mkdir()
    (tmp_path / "open" / "x.csv").write_text('a,b\n1,2\n3,"open\n' + "5,6\n" * 100)
    records = csv_ranges.csv_records(spark, str(tmp_path / "open"), range_bytes=50)
    assert sorted(len(r.value) for r in records.collect()) == [3, 7 + 1 + 4 * 100 - 1]


def test_line_ends_and_empty_files(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes(b'a,b\r\n1,"x\r\ny"\r\n\r\n2,z')
    (tmp_path / "y.csv").write_bytes(b"")
    (tmp_path / "z.csv").write_bytes(b"a,b\n")
    got = csv_ranges.read_csv_ranges(spark, str(tmp_path), ["a", "b"], range_bytes=10).collect()
    assert sorted((r.a, r.b.replace("\r\n", "\n")) for r in got) == [("1", "x\ny"), ("2", "z")]
