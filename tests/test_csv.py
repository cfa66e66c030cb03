from __future__ import annotations

import csv
import random

import pytest

from gradeline.sources import files, read_raw_csv, read_raw_csv_split

PIECES = ["a", "é", '"', '""', "\n", "\r\n", ",", " ", "word", "", '",\n"', "\n\n"]


def _write(path, seed, rows=400, terminator="\n"):
    """A file whose fields are full of quotes, commas and line breaks."""
    rng = random.Random(seed)
    with open(path, "w", newline="", encoding="utf-8") as file:
        writer = csv.writer(file, lineterminator=terminator, quoting=csv.QUOTE_MINIMAL)
        writer.writerow(["id", "text one", "c"])
        for i in range(rows):
            fields = ["".join(rng.choices(PIECES, k=rng.randint(0, 12))) for _ in range(2)]
            writer.writerow([f"{path.stem}-{i}", *fields])


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700b", "spark.sql.files.openCostInBytes": "0"}
    before = {key: spark.conf.get(key) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_every_column_is_text(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('a,b\n1,"two\nlines ""q"""\n2,\n')
    df = read_raw_csv(spark, str(path))
    assert [f.dataType.simpleString() for f in df.schema] == ["string", "string"]
    assert [tuple(r) for r in df.collect()] == [("1", 'two\nlines "q"'), ("2", None)]


@pytest.mark.parametrize("terminator", ["\n", "\r\n"])
def test_split_read_equals_whole_file_read(spark, tmp_path, small_splits, terminator):
    for seed, name in enumerate(["one", "two", "three"]):
        _write(tmp_path / f"{name}.csv", seed, terminator=terminator)
    (tmp_path / "tiny.csv").write_text("id,text one,c\n")
    whole = read_raw_csv(spark, str(tmp_path))
    split = read_raw_csv_split(spark, str(tmp_path))
    assert split.columns == whole.columns
    got, want = ([tuple(r) for r in df.collect()] for df in (split, whole))
    assert len(want) == 1200
    assert sorted(got, key=str) == sorted(want, key=str)


def test_a_record_over_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(f'line {i} ""quoted""' for i in range(500))
    (tmp_path / "x.csv").write_text(f'id,text\n1,"{long}"\n2,"short"\n')
    rows = {r["id"]: r["text"] for r in read_raw_csv_split(spark, str(tmp_path)).collect()}
    assert rows == {"1": long.replace('""', '"'), "2": "short"}


@pytest.mark.parametrize("record", ['5" pipe,x', '"q"r,x', '"open,x'])
def test_split_read_refuses_what_it_cannot_place(spark, tmp_path, record):
    (tmp_path / "x.csv").write_text(f"id,text\n1,a\n{record}\n3,b\n")
    with pytest.raises(Exception, match="not RFC 4180"):
        read_raw_csv_split(spark, str(tmp_path)).collect()


def test_a_quote_left_open_is_refused_before_its_text_is_gathered(spark, tmp_path, small_splits, monkeypatch):
    monkeypatch.setattr(files, "MAX_RECORD_BYTES", 5000)
    body = "\n".join(f"{i},plain" for i in range(2000))
    (tmp_path / "x.csv").write_text(f'id,text\n0,"open\n{body}\n')
    with pytest.raises(Exception, match="quote left open"):
        read_raw_csv_split(spark, str(tmp_path)).collect()
    (tmp_path / "x.csv").write_text(f'id,text\n0,"closed"\n{body}\n')
    assert read_raw_csv_split(spark, str(tmp_path)).count() == 2001
