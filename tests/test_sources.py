import os

import pytest

from loanframe.rules import CORRUPT_COLUMN
from loanframe.sources import (
    load_baseline,
    read_checkpoint,
    read_raw_csv,
    save_baseline,
    shared_dir,
    write_checkpoint,
    write_csv,
    write_table,
)


def _write_text(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


# S1
def _texts(df):
    return sorted(tuple(r) for r in df.drop(CORRUPT_COLUMN).collect())


def test_columns_are_strings_named_by_the_header(spark, tmp_out):
    path = tmp_out("csv") + "/part.csv"
    _write_text(path, 'id,note,weight\n1, two  words,12.5\n2,"a, b",n/a\n')
    df = read_raw_csv(spark, path)
    assert df.dtypes == [(c, "string") for c in ("id", "note", "weight", CORRUPT_COLUMN)]
    assert _texts(df) == [("1", " two  words", "12.5"), ("2", "a, b", "n/a")]


def test_subsets_are_taken_by_name_not_by_place(spark, tmp_out):
    path = tmp_out("csv") + "/part.csv"
    _write_text(path, "id,url,amount,grade,state\n7,u,1000,B,QZ\n8,v,2000,C,ZQ\n")
    assert _texts(read_raw_csv(spark, path, columns=["state", "id", "grade"])) == [("QZ", "7", "B"), ("ZQ", "8", "C")]
    with pytest.raises(ValueError, match="rate"):
        read_raw_csv(spark, path, columns=["id", "rate"])


def test_files_with_other_column_orders(spark, tmp_out):
    one, two, three = (tmp_out("csv") + "/part.csv" for _ in range(3))
    _write_text(one, "id,grade,state\n1,A,QQ\n")
    _write_text(two, "state,id,grade\nZZ,2,B\n")
    _write_text(three, "id,grade\n3,C\n")
    assert _texts(read_raw_csv(spark, [one, two])) == [("1", "A", "QQ"), ("2", "B", "ZZ")]
    with pytest.raises(ValueError, match="state"):
        read_raw_csv(spark, [one, three])
    with pytest.raises(ValueError, match="adds"):
        read_raw_csv(spark, [three, one])
    assert _texts(read_raw_csv(spark, [one, three], columns=["id"])) == [("1",), ("3",)]
    with pytest.raises(ValueError):
        read_raw_csv(spark, [])


def test_one_folder_must_hold_one_header(spark, tmp_out):
    folder = tmp_out("csv")
    _write_text(f"{folder}/a.csv", "id,grade\n1,A\n")
    _write_text(f"{folder}/b.csv", "grade,id\nB,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw_csv(spark, folder).collect()


def test_rows_with_another_field_count_are_counted(spark, tmp_out):
    from loanframe.operators import batch_stats

    path = tmp_out("csv") + "/part.csv"
    _write_text(path, "addr_state,loan_status,purpose\nQQ,Fully Paid,car\nZZ,Current\nfree, text,QZ,car\n")
    df = read_raw_csv(spark, path)
    assert sorted(r[CORRUPT_COLUMN] for r in df.filter(f"{CORRUPT_COLUMN} is not null").collect()) == [
        "ZZ,Current", "free, text,QZ,car"]
    assert batch_stats(df).first().malformed_rows == 2
    assert CORRUPT_COLUMN not in read_raw_csv(spark, path, corrupt_column=None).columns
    _write_text(path, f"id,{CORRUPT_COLUMN}\n1,x\n")
    with pytest.raises(ValueError, match=CORRUPT_COLUMN):
        read_raw_csv(spark, path)


def test_unsplittable_files_are_spread(spark, tmp_out):
    import gzip

    folder = tmp_out("csv")
    _write_text(f"{folder}/plain.csv", "id,x\n" + "".join(f"{i},a\n" for i in range(90)))
    assert read_raw_csv(spark, f"{folder}/plain.csv").rdd.getNumPartitions() == 1
    assert read_raw_csv(spark, f"{folder}/plain.csv", partitions=3).rdd.getNumPartitions() == 3
    with gzip.open(f"{folder}/packed.csv.gz", "wt") as f:
        f.write("id,x\n" + "".join(f"{i},a\n" for i in range(90)))
    df = read_raw_csv(spark, f"{folder}/packed.csv.gz")
    assert df.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    written = write_checkpoint(df, tmp_out("ckpt"))
    assert len([f for f in os.listdir(written) if f.endswith(".parquet")]) > 1
    assert read_checkpoint(spark, written).count() == 90


def test_write_csv_keeps_spaces(spark, tmp_out):
    df = spark.createDataFrame([(" 36 months ",)], "term string")
    path = write_csv(df, tmp_out("csv"))
    assert read_raw_csv(spark, path).first().term == " 36 months "


# S3, S4, S5
def test_checkpoint_roundtrip_overwrites(spark, tmp_out):
    path = tmp_out("ckpt")
    write_checkpoint(spark.range(5), path)
    write_checkpoint(spark.range(3), path)
    assert read_checkpoint(spark, path).count() == 3


def test_checkpoint_partitioned(spark, tmp_out):
    path = tmp_out("ckpt")
    df = spark.range(10).selectExpr("id", "cast(2010 + id % 3 as int) AS vintage_year")
    write_checkpoint(df, path, partition_by=["vintage_year"])
    back = read_checkpoint(spark, path).filter("vintage_year = 2011")
    assert back.count() == 3
    assert "PartitionFilters: [isnotnull(vintage_year" in back._jdf.queryExecution().executedPlan().toString()


def test_write_table_path_and_catalog(spark, tmp_out):
    path = write_table(spark.range(4), tmp_out("table"))
    assert spark.read.parquet(path).count() == 4
    write_table(spark.range(2), "loanframe_test_table", as_table=True)
    assert spark.table("loanframe_test_table").count() == 2
    spark.sql("DROP TABLE loanframe_test_table")


# S6, S7
SNAP = "column string, value string, row_count bigint, pct double"


def test_baseline_life_cycle(spark, tmp_out):
    path = tmp_out("baseline")
    assert load_baseline(spark, path) is None
    one = spark.createDataFrame([("hue", "teal", 4, 100.0)], SNAP)
    two = spark.createDataFrame([("hue", "teal", 1, 50.0), ("hue", None, 1, 50.0)], SNAP)
    with pytest.raises(ValueError, match="no rows"):
        save_baseline(one.limit(0), path)
    assert load_baseline(spark, path) is None
    save_baseline(one, path)
    with pytest.raises(ValueError, match="already"):
        save_baseline(two, path)
    assert [tuple(r) for r in load_baseline(spark, path).collect()] == [("hue", "teal", 4, 100.0)]
    save_baseline(two, path, refresh=True)
    assert load_baseline(spark, path).count() == 2


def test_a_half_written_baseline_counts_as_none(spark, tmp_out):
    path = tmp_out("baseline")
    _write_text(f"{path}/_temporary/0/part-00000", "half")
    assert load_baseline(spark, path) is None
    save_baseline(spark.createDataFrame([("hue", "teal", 4, 100.0)], SNAP), path)
    assert load_baseline(spark, path).count() == 1


@pytest.mark.parametrize("text", ['{"hue": {"teal": 1', "[]", "{}", "", '{"hue": {"teal": "much"}}', '{"hue": 3}', "null"])
def test_a_damaged_json_baseline_is_an_error(spark, tmp_out, text):
    from loanframe.sources import load_json_baseline

    path = tmp_out("json") + "/b.json"
    _write_text(path, text)
    with pytest.raises(ValueError):
        load_json_baseline(spark, path)


def test_scratch_tables_can_be_removed(spark, tmp_out):
    from loanframe.sources import remove_scratch

    path = tmp_out("gone")
    write_table(spark.range(3), path)
    folder = os.path.dirname(path.removeprefix("file:"))
    assert os.path.isdir(folder) and spark.sparkContext.applicationId in folder
    remove_scratch(spark)
    assert not os.path.isdir(folder)


def test_shared_dir_comes_from_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert configured and shared_dir(spark) == configured


def test_partitioned_checkpoint_splits_a_hot_value(spark, tmp_out):
    from pyspark.sql import functions as F

    df = spark.range(0, 2_000_000, numPartitions=16).select(
        "id",
        F.when(F.col("id") % 3 == 0, 2015).otherwise((F.col("id") % 7 + 2010).cast("int")).alias("vintage_year"),
    )
    confs = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512k",
        "spark.sql.shuffle.partitions": "200",
    }
    saved = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        path = write_checkpoint(df, tmp_out("rebalance"), ["vintage_year"])
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    files = {
        d: len([f for f in os.listdir(os.path.join(path, d)) if f.endswith(".parquet")])
        for d in os.listdir(path)
        if d.startswith("vintage_year=")
    }
    assert files["vintage_year=2015"] > max(v for k, v in files.items() if k != "vintage_year=2015")
    assert read_checkpoint(spark, path).count() == 2_000_000


def test_shared_dir_is_required_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_json_baseline_joins_the_snapshot(spark, tmp_out):
    import json

    from loanframe.operators import distribution_snapshot, drift
    from loanframe.sources import load_json_baseline

    path = tmp_out("json-baseline") + "/baseline_snapshot.json"
    snapshot = {"grade": {"A": 50.0, "None": 50.0}, "has_prior_delinquency": {"True": 25.0, "False": 75.0}}
    _write_text(path, json.dumps(snapshot, indent=2))
    base = load_json_baseline(spark, path)
    got = {(r.column, r.value): (r.row_count, r.pct) for r in base.collect()}
    assert got == {
        ("grade", "A"): (None, 50.0),
        ("grade", None): (None, 50.0),
        ("has_prior_delinquency", "true"): (None, 25.0),
        ("has_prior_delinquency", "false"): (None, 75.0),
    }
    df = spark.createDataFrame([("A", True), (None, False), ("A", False), (None, False)],
                               "grade string, has_prior_delinquency boolean")
    current = distribution_snapshot(df, ["grade", "has_prior_delinquency"])
    shifts = {(r.column, r.value): r.shift_pct for r in drift(current, base).collect()}
    assert shifts == {("grade", "A"): 0.0, ("grade", None): 0.0,
                      ("has_prior_delinquency", "true"): 0.0, ("has_prior_delinquency", "false"): 0.0}
    assert load_json_baseline(spark, tmp_out("absent") + "/none.json") is None


def test_malformed_lines_are_told_whatever_columns_are_used(spark, tmp_out):
    path = tmp_out("csv") + "/a.csv"
    _write_text(path, "id,note,weight\n1,a,2\n2,b,3,surplus\n3,c\n")
    raw = read_raw_csv(spark, path)
    assert raw.drop("weight", "note").selectExpr(f"count({CORRUPT_COLUMN})").first()[0] == 2
    assert raw.selectExpr(f"count({CORRUPT_COLUMN})").first()[0] == 2
    named = read_raw_csv(spark, path, columns=["note"], file_column="from")
    assert named.columns == ["note", CORRUPT_COLUMN, "from"]
    assert {r["from"].rsplit("/", 1)[1] for r in named.collect()} == {"a.csv"}


def test_catalog_table_at_a_path(spark, tmp_out):
    path = tmp_out("external")
    write_table(spark.range(3), "loanframe_external_test", as_table=True, path=path)
    try:
        assert spark.table("loanframe_external_test").count() == 3
        assert spark.read.parquet(path).count() == 3
    finally:
        spark.sql("DROP TABLE loanframe_external_test")
