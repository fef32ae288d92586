import gzip
import json

import pytest
from conftest import rows

from tallyrec.functions.columns import to_number
from tallyrec.plans.explore import explore_folder
from tallyrec.plans.prepare import prepare_folder
from tallyrec.sources import readers, sinks

REVIEWS = [
    {"reviewerID": "a", "asin": "x", "overall": 5.0, "unixReviewTime": 1_600_000_000, "summary": "fine"},
    {"reviewerID": "a", "asin": "x", "overall": 1.0, "unixReviewTime": 1_600_000_001, "summary": "again"},
    {"reviewerID": "b", "asin": "x", "overall": 4.0, "unixReviewTime": 1_600_000_002, "summary": "NA"},
    {"reviewerID": "b", "asin": "y", "overall": 9.0, "unixReviewTime": 1_600_000_003, "summary": "no"},
]


def write_csv(path, opener=open):
    names = list(REVIEWS[0])
    with opener(path, "wt") as f:
        f.write(",".join(names) + "\n")
        for review in REVIEWS:
            f.write(",".join(str(review[name]) for name in names) + "\n")


def write_json(path, opener=open):
    with opener(path, "wt") as f:
        f.writelines(json.dumps(review) + "\n" for review in REVIEWS)


WRITERS = {
    "json.gz": lambda path: write_json(path, gzip.open),
    "jsonl.gz": lambda path: write_json(path, gzip.open),
    "json": write_json,
    "jsonl": write_json,
    "csv.gz": lambda path: write_csv(path, gzip.open),
    "csv": write_csv,
}


@pytest.mark.parametrize("suffix", WRITERS)
def test_every_text_format_gives_the_same_reviews(spark, folder, suffix):
    WRITERS[suffix](f"{folder}/reviews.{suffix}")
    path = readers.resolve_source(spark, folder, "reviews")
    assert path.endswith(suffix)
    loaded = readers.load_reviews(spark, path)
    ordered = loaded.orderBy(readers.INPUT_ORDER).select("user_id", "product_id", to_number(loaded, "rating"))
    assert [tuple(r) for r in ordered.collect()] == [
        ("a", "x", 5.0), ("a", "x", 1.0), ("b", "x", 4.0), ("b", "y", 9.0),
    ]
    assert "summary" in loaded.columns
    assert readers.raw_row_count(spark, folder).first()["n_raw"] == 4


def test_suffixes_are_tried_in_order(spark, folder):
    assert readers.resolve_source(spark, folder, "reviews") is None
    assert readers.raw_row_count(spark, folder).first()["n_raw"] == 0
    for suffix in ("csv", "json"):
        WRITERS[suffix](f"{folder}/reviews.{suffix}")
    assert readers.resolve_source(spark, folder, "reviews").endswith("reviews.json")
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{folder}/reviews.parquet")
    assert readers.resolve_source(spark, folder, "reviews").endswith("reviews.parquet")


def test_csv_null_words_quotes_and_line_breaks(spark, folder):
    with open(f"{folder}/t.csv", "w") as f:
        f.write('a,b\nNA,"say ""hi""\nthere"\nnull,n/a\n,x\n')
    read = readers.read_table(spark, f"{folder}/t.csv", multiline_csv=True)
    assert set(rows(read)) == {(None, "x"), (None, 'say "hi"\nthere'), (None, None)}


def test_one_csv_file_is_read_by_several_tasks(spark, folder, monkeypatch):
    with open(f"{folder}/t.csv", "w") as f:
        f.write("a,b\n" + "".join(f"{i},{i}\n" for i in range(40_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        read = readers.read_table(spark, f"{folder}/t.csv")
        assert read.rdd.getNumPartitions() > 3 and read.count() == 40_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_an_input_column_named_seq_stays(spark, folder):
    spark.createDataFrame([("a", "x", 1.0, 7)], "user_id string, product_id string, rating double, seq int").write.parquet(f"{folder}/reviews.parquet")
    assert readers.load_reviews(spark, f"{folder}/reviews.parquet").first()["seq"] == 7


def test_missing_columns_are_an_error(spark):
    df = spark.createDataFrame([("a", 1.0)], "reviewerID string, overall double")
    with pytest.raises(ValueError, match="product_id"):
        readers.normalize_reviews(df)


@pytest.mark.parametrize(
    ("schema", "names"),
    [("asin string, categories string", ["product_id", "category"]),
     ("parent_asin string, main_category string", ["product_id", "category"]),
     ("asin string, parent_asin string", ["product_id", "parent_asin"]),
     ("product_id string, asin string", ["product_id", "asin"])],
)
def test_first_matching_product_column_is_renamed(spark, schema, names):
    df = spark.createDataFrame([("a", "b")], schema)
    assert readers.normalize_products(df).columns == names


def test_products_are_optional(spark):
    assert readers.load_products(spark, None) is None


def test_preparing_and_exploring_a_folder(spark, folder):
    write_csv(f"{folder}/reviews.csv")
    prepared = prepare_folder(spark, folder, f"{folder}/processed", 1, 1)
    assert rows(prepared.interactions) == [
        ("a", "x", 5.0, 1_600_000_000), ("b", "x", 4.0, 1_600_000_002),
    ]
    loaded = readers.load_processed(spark, f"{folder}/processed")
    assert rows(loaded.products) == [("x", None, None, None, None)]
    assert rows(loaded.users) == [("a", 1, 5.0), ("b", 1, 4.0)]
    explore_folder(spark, f"{folder}/processed", folder, f"{folder}/summary.json")
    summary = spark.read.json(f"{folder}/summary.json").first()
    assert summary["filter_impact"]["n_raw"] == 4
    assert summary["filter_impact"]["n_dropped"] == 2
    assert summary["categories"]["skipped"] is True
    assert summary["rating_distribution"]["mean"] == 4.5


def test_preparing_without_reviews_fails(spark, folder):
    with pytest.raises(FileNotFoundError, match="reviews.csv"):
        prepare_folder(spark, folder, f"{folder}/processed")


def test_vector_table_round_trip(spark, folder, vectors):
    sinks.save_vectors(vectors, f"{folder}/vectors")
    assert rows(sinks.load_vectors(spark, f"{folder}/vectors")) == rows(vectors)
