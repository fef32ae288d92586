import csv
import gzip
import random

import duckdb
import pytest

from tallyrec.sources import readers
from tallyrec.sources.csv_records import _line_reader, split_starts


@pytest.fixture
def small_splits(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "4k")
    yield
    spark.conf.set(name, before)


def cells(seed, n):
    """Cells with line breaks, quotes and commas, some of them longer than a split."""
    rng = random.Random(seed)
    parts = ["word", '"', ",", "\n", "\n\n", 'say "hi"', '",', ',"', " x ", "a,b"]
    for i in range(n):
        size = 3000 if i % 97 == 13 else rng.randint(1, 8)
        yield [str(i), "t" + "".join(rng.choice(parts) for _ in range(size)) + "t", str(rng.randint(1, 5))]


def by_duckdb(path):
    sql = f"select * from read_csv('{path}', all_varchar=true, header=true, quote='\"', escape='\"', delim=',', max_line_size=10000000, parallel=false)"
    return sorted(tuple(r) for r in duckdb.sql(sql).fetchall())


def found(spark, path):
    return sorted(tuple(r) for r in readers.read_table(spark, path).collect())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_line_breaks_over_many_splits(spark, folder, small_splits, end):
    rows = list(cells(1, 900))
    with open(f"{folder}/t.csv", "w", newline="") as f:
        writer = csv.writer(f, lineterminator=end)
        writer.writerow(["id", "body", "stars"])
        writer.writerows(rows)
    read = readers.read_table(spark, f"{folder}/t.csv")
    assert sorted(tuple(r) for r in read.collect()) == sorted(map(tuple, rows))
    assert spark.read.text(f"{folder}/t.csv").rdd.getNumPartitions() > 8
    if end == "\n":
        assert found(spark, f"{folder}/t.csv") == by_duckdb(f"{folder}/t.csv")


def test_input_order_and_record_count(spark, folder, small_splits):
    rows = list(cells(2, 400))
    with open(f"{folder}/reviews.csv", "w", newline="") as f:
        writer = csv.writer(f, lineterminator="\n")
        writer.writerow(["asin", "reviewerID", "overall"])
        writer.writerows(rows)
    loaded = readers.load_reviews(spark, f"{folder}/reviews.csv")
    ordered = [r["product_id"] for r in loaded.orderBy(readers.INPUT_ORDER).collect()]
    assert ordered == [row[0] for row in rows]
    assert readers.raw_row_count(spark, folder).first()["n_raw"] == len(rows)


def test_gzip_and_several_files(spark, folder, small_splits):
    rows = list(cells(3, 300))
    for i in range(3):
        with gzip.open(f"{folder}/part{i}.csv.gz", "wt", newline="") as f:
            writer = csv.writer(f, lineterminator="\n")
            writer.writerow(["id", "body", "stars"])
            writer.writerows(rows[100 * i : 100 * i + 100])
    assert found(spark, f"{folder}/part*.csv.gz") == sorted(map(tuple, rows))


def test_quotes_inside_plain_cells_open_nothing(spark, folder):
    with open(f"{folder}/t.csv", "w") as f:
        f.write('a,b\n5" screen,x\nnone,6"\n"7"" wide",y\n\n')
    assert split_starts(spark, f"{folder}/t.csv") is None
    assert found(spark, f"{folder}/t.csv") == [('5" screen', "x"), ('7" wide', "y"), ("none", '6"')]
    with open(f"{folder}/u.csv", "w") as f:
        f.write('a,b\n5" screen,x\nthat,"two\nlines"\n"7"" wide",y\n')
    assert found(spark, f"{folder}/u.csv") == sorted([('5" screen', "x"), ("that", "two\nlines"), ('7" wide', "y")])


def test_lines_are_records_where_no_cell_breaks(spark, folder):
    with open(f"{folder}/t.csv", "w") as f:
        f.write('a,b\n"1","x, y"\n2,"say ""hi"""\n')
    assert split_starts(spark, f"{folder}/t.csv") is None
    assert found(spark, f"{folder}/t.csv") == [("1", "x, y"), ("2", 'say "hi"')]


def test_an_open_cell_at_the_end_and_empty_files(spark, folder):
    with open(f"{folder}/t.csv", "w") as f:
        f.write('a,b\n1,"never\nclosed')
    assert len(found(spark, f"{folder}/t.csv")) == 1
    with open(f"{folder}/e.csv", "w") as f:
        f.write("a,b\n")
    assert found(spark, f"{folder}/e.csv") == []


def test_line_states():
    ends = _line_reader()
    assert [ends(line, False) for line in ('a,b', '"a', 'a,"b', '"a",b', '"a"",b', 'a"b', '"a"b","c', "")] == [
        False, True, True, False, True, False, True, False,
    ]
    assert [ends(line, True) for line in ("a", 'a"', 'a"",', 'a","b', 'a",b', '""', '"')] == [
        True, False, True, True, False, True, False,
    ]
