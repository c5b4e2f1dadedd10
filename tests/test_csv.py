"""CSV files in splits, by their own headers, against Spark's reader of whole files."""

import csv
import random

import pytest

from quarterbill import read_form
from quarterbill.sources.csv_records import read_csv, records
from quarterbill.sources.schemas import FORMS

CELLS = [
    "", "plain", "a,b", 'say "hi"', "two\nlines", "cr\r\nlf", "\n\n", "é\U0001f600", " sp ", '"', '"\n"',
    "tail\r", "x" * 300, '\n",\n"', "\\", "\t",
]


def write(path, header, rows, end="\n"):
    with path.open("w", newline="", encoding="utf-8") as out:
        csv.writer(out, lineterminator=end).writerows([header, *rows])


@pytest.fixture
def splits(spark):
    """Sets the size of a split."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def size(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", n)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)

    yield size
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size", [1 << 26, 5000, 400])
def test_same_rows_as_a_reader_of_whole_files(spark, tmp_path, splits, size):
    rng = random.Random(size)
    for name in "ab":
        write(tmp_path / f"{name}.csv", ["id", "n 1", "b\nreak", "c"], [[f"{name}{i}", *rng.choices(CELLS, k=3)] for i in range(1500)])
    splits(size)
    got = read_csv(spark, str(tmp_path))
    want = spark.read.options(header=True, multiLine=True, escape='"').csv(str(tmp_path))
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    if size == 5000:  # many tasks read the two files
        tasks = records(spark, str(tmp_path)).select("file", "split").distinct().count()
        assert tasks > 20


def test_a_cell_longer_than_many_splits_and_other_line_ends(spark, tmp_path, splits):
    long = "\n".join(f'line {i} "q", {i}' for i in range(2000))
    write(tmp_path / "a.csv", ["id", "text"], [["1", "x\r\ny"], ["2", long], ["3", long[:500]], ["4", "end"]], end="\r\n")
    splits(300)
    assert sorted(map(tuple, read_csv(spark, str(tmp_path)).collect())) == [("1", "x\r\ny"), ("2", long), ("3", long[:500]), ("4", "end")]


def test_files_with_headers_of_their_own(spark, tmp_path):
    write(tmp_path / "a.csv", ["id", "p", "q"], [["1", "p1", "q1"], ["2", "", "q2"]])
    write(tmp_path / "b.csv", ["q", "id", "p"], [["q3", "3", "p3"]])
    write(tmp_path / "c.csv", ["id", "r", "r"], [["4", "r4", "other"], ["5"], ["6", "x", "y", "more"]])
    write(tmp_path / "d.csv", ["id", "p", "q"], [])
    (tmp_path / "e.csv").write_text("")
    (tmp_path / "f.csv").write_text("\n\n  \nid,q\n\n7,q7")
    rows = read_csv(spark, str(tmp_path)).select("id", "p", "q", "r").collect()
    assert sorted(map(tuple, rows), key=str) == [
        ("1", "p1", "q1", None), ("2", None, "q2", None), ("3", "p3", "q3", None), ("4", None, None, "r4"),
        ("5", None, None, None), ("6", None, None, "x"), ("7", None, "q7", None),
    ]
    assert read_csv(spark, str(tmp_path), ["p", "no"]).columns == ["p"]


def test_forms_whose_columns_stand_in_another_order(spark, tmp_path):
    header = {f.name: f.header for f in FORMS["user"]}
    names = ["start_timestamp", "email", "last_name", "pi_last_name", "power_user"]
    write(tmp_path / "a.csv", [header[n] for n in names], [["2020-01-01 09:00:00", "a@x", "Kim", "Smith", "Yes"]])
    swapped = ["start_timestamp", "email", "pi_last_name", "last_name", "power_user"]
    write(tmp_path / "b.csv", [header[n] for n in swapped], [["2020-01-02 09:00:00", "b@x", "Smith", "Lee", "no"]])
    form = read_form(spark, str(tmp_path), "user")
    assert {(r.email, r.last_name, r.pi_last_name, r.power_user) for r in form.collect()} == {
        ("a@x", "kim", "smith", True), ("b@x", "lee", "smith", False),
    }
    # the form is landed: later reads scan columns of a table
    assert "ReadSchema: struct<email:string>" in form.select("email")._jdf.queryExecution().toString()


def test_an_empty_folder_of_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    form = read_form(spark, str(tmp_path), "pi")
    assert form.count() == 0 and "speed_code" in form.columns
