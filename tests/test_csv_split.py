"""Quoted line breaks in files that many tasks read."""

import csv
import io
import random

import pytest

from plumbmart.sources.csv_split import csv_records
from plumbmart.sources.files import HeaderError, scan_csv

HEADER = ["id", "note", "odd \"label\"\nof two lines"]


def write(folder, name, rows, end="\n", header=HEADER):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerows([header, *rows])
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(out.getvalue().encode())


def sample(seed, n):
    rng = random.Random(seed)
    words = ["plain", 'say "hi"', "two\nlines", "a,b", "", "\n", '"', '""\n"', "é\r\nß", " pad ", "x" * 300]
    return [[str(k), "".join(rng.choices(words, k=rng.randint(0, 5))), rng.choice(words)] for k in range(n)]


@pytest.fixture
def small_blocks(spark):
    for key, value in (("spark.sql.files.maxPartitionBytes", "700"), ("spark.sql.files.openCostInBytes", "1")):
        spark.conf.set(key, value)
    yield
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(key)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_over_block_borders(spark, tmp_path, small_blocks, end):
    folder = tmp_path / "files"
    first, second = sample(1, 300), [*sample(2, 50), ["long", "line\n" * 2000, "spans many blocks"], *sample(3, 50)]
    write(folder, "a.csv", first, end)
    write(folder, "b.csv", second, end)
    records = csv_records(spark, str(folder))
    assert records.rdd.getNumPartitions() > 20
    got = sorted(tuple(r) for r in scan_csv(spark, str(folder), HEADER).collect())
    assert got == sorted(map(tuple, [*first, *second]))


def test_blank_lines_and_a_last_line_without_end(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes(b'id,note\n\n1,"a\n\nb"\n\r\n2,z')
    assert sorted(map(tuple, scan_csv(spark, str(tmp_path / "x.csv"), ["id", "note"]).collect())) == [("1", "a\n\nb"), ("2", "z")]


def test_what_must_not_pass(spark, tmp_path, small_blocks):
    folder = tmp_path / "files"
    write(folder, "a.csv", sample(4, 60))
    write(folder, "b.csv", sample(5, 60), header=["id", "other", HEADER[2]])
    with pytest.raises(Exception, match="header differs"):
        scan_csv(spark, str(folder), ["id"]).collect()
    (tmp_path / "open.csv").write_text('id,note\n1,"' + "never closed\n" * 300)
    with pytest.raises(Exception, match="not closed"):
        scan_csv(spark, str(tmp_path / "open.csv"), ["id"]).collect()
    (tmp_path / "ragged.csv").write_text('id,note\n1,"a\nb"\n2\n')
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        scan_csv(spark, str(tmp_path / "ragged.csv"), ["id"]).collect()
    (tmp_path / "twice.csv").write_text("id,id\n1,2\n")
    with pytest.raises(HeaderError):
        scan_csv(spark, str(tmp_path / "twice.csv"), ["id"])


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_rows_are_numbered_as_a_reader_numbers_them(spark, tmp_path, small_blocks, end):
    folder = tmp_path / "files"
    files = {"a.csv": sample(1, 300), "b.csv": [*sample(2, 50), ["long", "line\n" * 2000, "spans many blocks"], *sample(3, 50)], "c.csv": []}
    for name, rows in files.items():
        write(folder, name, rows, end)
    scanned = scan_csv(spark, str(folder), HEADER, numbered=True)
    got = sorted((r.file.rsplit("/", 1)[1], r.row_number, *r[2:]) for r in scanned.collect())
    assert got == sorted((name, k + 2, *row) for name, rows in files.items() for k, row in enumerate(rows))


def test_numbers_without_blank_lines_need_the_splitter(spark, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    (folder / "a.csv").write_bytes(b'id\n\n1\n\n\n"2\n"\n3')
    got = sorted((r.row_number, r.id) for r in scan_csv(spark, str(folder), ["id"], numbered=True).collect())
    assert got == [(2, "1"), (3, "2\n"), (4, "3")]
    with pytest.raises(ValueError, match="split"):
        scan_csv(spark, str(folder), ["id"], multi_line=False, numbered=True)
