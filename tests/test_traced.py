"""Bad rows by file and line, against the lines themselves."""

import os

import pytest
from conftest import values
from pyspark.sql import types as T

from tallyferry.plans.imports import import_table
from tallyferry.sources import delimited as D
from tallyferry.sources import traced as E
from tallyferry.specs import MissingInput, Settings, TableSpec, TooManyBadRows

PLAIN = Settings(compression=None)
SCHEMA = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("note", T.StringType()), T.StructField("price", T.DoubleType())])
HEADER = "id\tnote\tprice"


def _files(folder, n=3, rows=400):
    """Files with bad lines, blank lines, quotes, and lines that look like the header; (file, line) of the bad ones."""
    os.makedirs(folder)
    wrong = set()
    for f in range(n):
        lines = [HEADER if f % 2 else HEADER.upper()]
        for k in range(rows * f + 1):
            bad = {7: f"{k}\tx\t1.0\textra", 8: f"{k}\tx", 9: f"a{k}\tx\t1.0", 10: f"{k}\tx\t1,5", 11: "\tx\t1.0", 12: HEADER}.get(k % 50)
            lines.append(bad or ("" if k % 50 == 20 else f'{k}\t"say ""{k}"""\t{k}.5'))
            if bad:
                wrong.add((f"{f}.csv", len(lines)))
        with open(f"{folder}/{f}.csv", "w") as out:
            out.write("".join(line + "\n" for line in lines))
    return wrong


@pytest.fixture
def many_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def _places(bad):
    return {(os.path.basename(r["bad_file"]), r["bad_line_number"]): r["bad_line"] for r in bad.collect()}


def test_lines_as_an_editor_counts_them(spark, tmp_path, many_splits):
    path = str(tmp_path / "in")
    wrong = _files(path)
    traced = E.load_traced(spark, path, SCHEMA, PLAIN)
    assert traced.splits.count() > 12
    found = _places(traced.bad())
    assert set(found) == wrong and traced.count_bad() == len(wrong)
    for (name, number), line in found.items():
        with open(f"{path}/{name}") as f:
            assert f.read().split("\n")[number - 1] == line
    plain = D.load_delimited(spark, path, SCHEMA, PLAIN)
    assert values(traced.good()) == values(plain.good())
    assert values(traced.bad().select("bad_reason", "bad_line")) == values(plain.bad())


@pytest.mark.parametrize("progress", [False, True])
def test_imports_quarantine_file_and_line(spark, tmp_path, progress):
    wrong = _files(str(tmp_path / "in" / "t"))
    args = (spark, TableSpec("t"), SCHEMA, str(tmp_path / "in"), str(tmp_path / "target"))
    kept = {"quarantine": str(tmp_path / "bad"), "progress": str(tmp_path / "progress") if progress else None}
    copy = import_table(*args, settings=Settings(compression=None, files_per_batch=2 if progress else 100), **kept)
    bad = spark.read.option("recursiveFileLookup", "true").parquet(kept["quarantine"])
    assert set(_places(bad)) == wrong
    assert copy.count() == D.load_delimited(spark, str(tmp_path / "in" / "t"), SCHEMA, PLAIN).good().count()
    with pytest.raises(TooManyBadRows):
        import_table(*args[:4], str(tmp_path / "other"), settings=Settings(compression=None, max_bad_rows=1), quarantine=str(tmp_path / "more"))
    assert len(_places(spark.read.parquet(str(tmp_path / "more")))) == len(wrong)


def test_files_of_another_header_and_empty_ones(spark, tmp_path):
    path = str(tmp_path / "in")
    os.makedirs(path)
    for name, text in {"0.csv": HEADER + "\n", "1.csv": HEADER + "\n1\tx\t2\n", "2.csv": ""}.items():
        with open(f"{path}/{name}", "w") as out:
            out.write(text)
    traced = E.load_traced(spark, path, SCHEMA, PLAIN)
    assert values(traced.good()) == [(1, "x", 2.0)] and traced.bad().collect() == []
    with open(f"{path}/3.csv", "w") as out:
        out.write("id\tprice\tnote\n1\t2\tx\n")
    with pytest.raises(ValueError, match="its header is not"):
        E.load_traced(spark, path, SCHEMA, PLAIN)
    with pytest.raises(MissingInput):
        E.load_traced(spark, str(tmp_path / "none"), SCHEMA, PLAIN)
