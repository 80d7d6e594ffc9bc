"""Text files: layout, round trips, bad rows, headers, dirty bytes."""

import glob
import gzip
import os

import pytest
from conftest import values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyferry.functions import text as X
from tallyferry.operators import chunking as C
from tallyferry.operators.columns import shout_columns
from tallyferry.sources import delimited as D
from tallyferry.specs import MissingInput, Settings, TooManyBadRows
from tallyferry.streaming import file_batches as B
from tallyferry.streaming.file_batches import load_in_batches

PLAIN = Settings(compression=None)
SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("note", T.StringType()),
        T.StructField("price", T.DecimalType(12, 2)),
        T.StructField("rate", T.DoubleType()),
        T.StructField("day", T.DateType()),
        T.StructField("stamp", T.TimestampNTZType()),
        T.StructField("active", T.BooleanType()),
    ]
)


def write_lines(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as out:
        out.write("".join(line + "\n" for line in lines))


def awkward(spark):
    rows = [
        (1, 'say "hi"', "1.50", 1e300, "2024-02-29", "2024-01-01 00:00:00.000001", "true"),
        (2, "back\\slash", "-0.01", 0.1, "0001-01-01", "1677-01-01 00:00:00", "false"),
        (3, '{"a": [1, "x"]}', None, float("nan"), None, None, None),
        (4, " padded ", "9999999999.99", float("-inf"), "9999-12-31", "9999-12-31 23:59:59.999999", "true"),
        (5, "tab\there", "0.00", -0.0, "2024-01-01", "2024-01-01 12:00:00", "false"),
        (6, None, "0.00", 5e-324, "2024-01-01", "2024-01-01 12:00:00", "false"),
        (7, "'quoted'", "0.00", 1.0, "2024-01-01", "2024-01-01 12:00:00", "false"),
        (8, "Zoë 漢字 🙂", "0.00", 1.0, "2024-01-01", "2024-01-01 12:00:00", "false"),
    ]
    text = spark.createDataFrame(rows, "id long, note string, price string, rate double, day string, stamp string, active string")
    return text.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMA.fields])


@pytest.mark.parametrize("compression", [None, "gzip"])
def test_round_trip_keeps_awkward_values(spark, tmp_path, compression):
    settings = Settings(compression=compression)
    df, path = awkward(spark), str(tmp_path / "out")
    D.write_delimited(df, path, settings)
    loaded = D.load_delimited(spark, path, df.schema, settings)
    assert loaded.bad().count() == 0
    assert repr(values(loaded.good())) == repr(values(df))


def test_empty_text_reads_back_as_null(spark, tmp_path):
    df, path = spark.createDataFrame([(1, ""), (2, None)], "id long, note string"), str(tmp_path / "out")
    D.write_delimited(df, path, PLAIN)
    assert values(D.load_delimited(spark, path, df.schema, PLAIN).good()) == [(1, None), (2, None)]


def test_line_breaks_in_text_need_multi_line(spark, tmp_path):
    df, path = spark.createDataFrame([(1, "two\nlines")], "id long, note string"), str(tmp_path / "out")
    D.write_delimited(df, path, PLAIN)
    assert values(D.load_delimited(spark, path, df.schema, PLAIN, multi_line=True).good()) == [(1, "two\nlines")]


@pytest.mark.parametrize("compression", [None, "gzip"])
def test_text_with_line_breaks_stays_on_one_line(spark, tmp_path, compression):
    settings = Settings(compression=compression)
    notes = ["two\nlines", "a\r\nb", "\\n", "\\\n\\\\n", "\n", "end\\", '"\nquoted\t"', "\\\\", "C:\\new\\\r", "plain", None]
    df, path = spark.createDataFrame(list(enumerate(notes)), "id long, note string"), str(tmp_path / "out")
    D.write_delimited(df, path, settings)
    loaded = D.load_delimited(spark, path, df.schema, settings)
    assert loaded.bad().isEmpty() and values(loaded.good()) == values(df)
    files = D.total_lines(D.line_counts(spark, path)).first()
    assert files["lines"] - files["files"] == len(notes)


def test_backslashes_of_other_writers(spark, tmp_path):
    write_lines(str(tmp_path / "in" / "0.csv"), "id\tnote", "1\tC:\\new", "2\tC:\\temp")
    schema, path = "id long, note string", str(tmp_path / "in")
    schema = spark.createDataFrame([], schema).schema
    as_written = Settings(compression=None, escape_breaks=False)
    assert values(D.load_delimited(spark, path, schema, as_written).good()) == [(1, "C:\\new"), (2, "C:\\temp")]
    assert values(D.load_delimited(spark, path, schema, PLAIN).good()) == [(1, "C:\new"), (2, "C:\\temp")]


def test_files_have_header_tabs_and_gzip_names(spark, tmp_path):
    path = str(tmp_path / "out")
    D.write_delimited(shout_columns(spark.range(3).select("id", (F.col("id") * 2).alias("x"))), path, Settings())
    lines = []
    for name in glob.glob(path + "/*.csv.gz"):
        with gzip.open(name, "rt") as f:
            lines += f.read().splitlines()
    assert lines.count("ID\tX") == len(glob.glob(path + "/*.csv.gz"))
    assert sorted(set(lines) - {"ID\tX"}) == ["0\t0", "1\t2", "2\t4"]


def test_write_replaces_what_was_there(spark, tmp_path):
    path = str(tmp_path / "out")
    for n in (50, 3):
        D.write_delimited(spark.range(n), path, PLAIN)
    counts = D.line_counts(spark, path)
    files = D.total_lines(counts).first()
    assert files["lines"] - files["files"] == 3


def test_chunk_folders(spark, tmp_path):
    df, path = spark.range(100).select(F.col("id").alias("k")), str(tmp_path / "out")
    plan = C.plan_chunks(df, "k", 30)
    D.write_delimited(C.spread_by_chunk(C.assign_chunks(df, plan), plan), path, PLAIN, chunked=True)
    assert sorted(n for n in os.listdir(path) if n.startswith("chunk")) == ["chunk_id=0", "chunk_id=1", "chunk_id=2"]
    rows = spark.read.option("header", True).csv(path).groupBy("chunk_id").count()
    assert values(rows) == [(0, 29), (1, 30), (2, 41)]


def test_columns_are_bound_by_name(spark, tmp_path):
    write_lines(str(tmp_path / "in" / "0.csv"), "B\tA", "x\t1", "y\t2")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    assert values(D.load_delimited(spark, str(tmp_path / "in"), schema, PLAIN).good()) == [(1, "x"), (2, "y")]


def test_differing_headers_fail_instead_of_mixing_columns(spark, tmp_path):
    write_lines(str(tmp_path / "in" / "0.csv"), "a\tb", "1\tx")
    write_lines(str(tmp_path / "in" / "1.csv"), "b\ta", "y\t2")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    with pytest.raises(Exception, match="(?i)header"):
        D.load_delimited(spark, str(tmp_path / "in"), schema, PLAIN).good().collect()


def test_bad_rows_are_told_apart(spark, tmp_path):
    write_lines(
        str(tmp_path / "in" / "0.csv"), "id\tprice", "1\t2.5", "2\tcheap", "3", "4\t1.0\tmore", "\t7.0", "5\t"
    )
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("price", T.DoubleType())])
    loaded = D.load_delimited(spark, str(tmp_path / "in"), schema, PLAIN)
    assert values(loaded.good()) == [(1, 2.5), (5, None)]
    assert values(loaded.bad()) == [
        ("malformed line", "3"),
        ("malformed line", "4\t1.0\tmore"),
        ("no value: id", "\t7.0"),
        ("not of its type: price", "2\tcheap"),
    ]


def test_columns_the_files_lack(spark, tmp_path):
    write_lines(str(tmp_path / "in" / "0.csv"), "id", "1")
    stamp = T.StructField("loaded", T.TimestampType(), False)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DateType()), stamp])
    path = str(tmp_path / "in")
    row = D.load_delimited(spark, path, schema, PLAIN, load_time_col="loaded").good().first()
    assert row["x"] is None and row["loaded"] is not None
    assert values(D.load_delimited(spark, path, schema, PLAIN).bad()) == [("no value: loaded", "1")]


def test_stray_quotes_stay(spark, tmp_path):
    write_lines(str(tmp_path / "in" / "0.csv"), "id\tnote", '1\t5" pipe', '2\tsay "hi" now')
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("note", T.StringType())])
    rows = values(D.load_delimited(spark, str(tmp_path / "in"), schema, PLAIN).good())
    assert rows == [(1, '5" pipe'), (2, 'say "hi" now')]


def test_nul_bytes_are_removed_on_load(spark, tmp_path):
    write_lines(str(tmp_path / "in" / "0.csv"), "id\tnote", "1\ta\x00b\x00", "2\t\x00", "3\x00\tc")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("note", T.StringType())])
    rows = values(D.load_delimited(spark, str(tmp_path / "in"), schema, PLAIN).good())
    assert rows == [(1, "ab"), (2, ""), (3, "c")]


def test_json_cells_and_lines(spark):
    df = spark.createDataFrame([('{"a": 1}', "{open", None), ('{\n}', "shut}", "plain")], "x string, y string, z string")
    assert [tuple(r) for r in X.quote_json_cells(df).collect()] == [
        ("'{\"a\": 1}'", "{open", None), ("'{\n}'", "shut}", "plain")]
    line = spark.createDataFrame([("1\t{a}\t{b}\t2",)], "line string")
    assert line.select(X.quote_json_lines(F.col("line"))).first()[0] == "1\t'{a}'\t'{b}'\t2"


def test_missing_folder_is_named(spark, tmp_path):
    with pytest.raises(MissingInput, match="nowhere"):
        D.read_delimited(spark, str(tmp_path / "nowhere"), PLAIN)


def make_files(spark, tmp_path, files, bad=0):
    for i in range(files):
        lines = [f"{i * 10 + j}\t{j}.5" for j in range(10)] + ["x\ty"] * (bad if i == 1 else 0)
        write_lines(str(tmp_path / "in" / f"{i}.csv"), "id\tprice", *lines)
    return T.StructType([T.StructField("id", T.LongType()), T.StructField("price", T.DoubleType())])


def test_files_load_in_batches_and_only_once(spark, tmp_path):
    schema = make_files(spark, tmp_path, 7)
    source, target, progress = (str(tmp_path / n) for n in ("in", "target", "progress"))
    settings = Settings(files_per_batch=3)
    for _ in range(2):
        batches = load_in_batches(spark, source, ["id", "price"], schema, target, settings, progress)
    assert batches == 3
    assert values(spark.read.parquet(target).select("id")) == sorted(((i,) for i in range(70)), key=repr)
    write_lines(str(tmp_path / "in" / "7.csv"), "id\tprice", "70\t1.0")
    assert load_in_batches(spark, source, ["id", "price"], schema, target, settings, progress) == 4
    assert spark.read.parquet(target).count() == 71


def test_batch_with_too_many_bad_rows_fails(spark, tmp_path):
    schema = make_files(spark, tmp_path, 3, bad=3)
    source, target = str(tmp_path / "in"), str(tmp_path / "target")
    with pytest.raises(Exception, match="3 bad rows, 2 allowed"):
        load_in_batches(spark, source, ["id", "price"], schema, target, Settings(max_bad_rows=2))
    assert load_in_batches(spark, source, ["id", "price"], schema, target, Settings(max_bad_rows=3)) == 1
    assert spark.read.parquet(target).count() == 30
    assert TooManyBadRows.__mro__[1].__name__ == "MoveError"


def test_many_batches_are_one_trigger_with_a_folder_and_budget_each(spark, tmp_path, monkeypatch):
    schema = make_files(spark, tmp_path, 11, bad=2)
    write_lines(str(tmp_path / "in" / "odd [name] %2 {ü}.csv"), "id\tprice", "x\ty", "x\ty")
    source, target, progress = (str(tmp_path / n) for n in ("in", "target", "progress"))
    jobs = []
    real = B.write_counting_bad
    monkeypatch.setattr(B, "write_counting_bad", lambda *a: jobs.append(1) or real(*a))
    settings = Settings(files_per_batch=2, max_bad_rows=1)
    with pytest.raises(Exception, match="2 bad rows, 1 allowed"):
        load_in_batches(spark, source, ["id", "price"], schema, target, settings, progress)
    # In order of names, 1.csv comes second: nothing of its batch or behind it stays.
    assert B.child_names(spark, target) in ([], ["_SUCCESS"])
    # Six batches; together they hold more bad rows than one may.
    assert load_in_batches(spark, source, ["id", "price"], schema, target, Settings(files_per_batch=2, max_bad_rows=2), progress) == 6
    # One job a run, and not one for every batch as before.
    assert len(jobs) == 2
    loaded = spark.read.parquet(target)
    assert sorted(r["id"] for r in loaded.collect()) == list(range(110))
    per_batch = loaded.groupBy("load_batch").agg(F.count_distinct(F.expr("id div 10")).alias("files"))
    assert sorted(r["files"] for r in per_batch.collect()) == [1, 2, 2, 2, 2, 2]


def test_batches_without_good_rows_keep_their_schema(spark, tmp_path):
    write_lines(str(tmp_path / "in" / "0.csv"), "id\tprice", "x\ty")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("price", T.DoubleType())])
    assert load_in_batches(spark, str(tmp_path / "in"), ["id", "price"], schema, str(tmp_path / "target"), PLAIN) == 1
    assert spark.read.parquet(str(tmp_path / "target")).select("id", "price").count() == 0
