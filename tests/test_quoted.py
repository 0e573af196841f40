"""Quoted text with line ends in its fields, cut at places that fall anywhere."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termspark.sources import delimited, quoted

SCHEMA = T.StructType([T.StructField("n", T.LongType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])


@pytest.fixture()
def splits(spark):
    """Splits of so many bytes, for one test."""
    name = "spark.sql.files.maxPartitionBytes"
    yield lambda size: spark.conf.set(name, str(size))
    spark.conf.unset(name)


def odd_field(rng):
    return "".join(rng.choice(['"', "\n", "\r\n", ",", "x", "yz", " ", "é", "\n\n"]) for _ in range(rng.randint(0, 9)))


def written(path, rows, end="\n"):
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator=end).writerows(rows)
    path.write_bytes(out.getvalue().encode())


def whole_files(spark, path, header):
    """The same files, each read by one task."""
    reader = spark.read.schema(SCHEMA).options(quote='"', escape='"', multiLine=True, mode="FAILFAST", header=header)
    return sorted(map(tuple, reader.csv(path).collect()), key=repr)


@pytest.mark.parametrize("size", [9, 40, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_any_split(spark, splits, tmp_path, size, end):
    rng, wanted = random.Random(size), []
    for f in range(2):
        rows = [(f * 100 + i, "a" + odd_field(rng) + "a", "b" + odd_field(rng) + "b") for i in range(8)]
        # a field over many blocks
        rows.append((f * 100 + 99, "long\n" * 12, "z"))
        written(tmp_path / f"{f}.csv", [("n", "first\nname", "b"), *rows], end)
        wanted += rows
    wanted = sorted(wanted, key=repr)
    # the reader of whole files leaves a carriage return behind
    assert end == "\r\n" or whole_files(spark, str(tmp_path), True) == wanted
    splits(size)
    found = delimited.load_delimited(spark, str(tmp_path), SCHEMA)
    assert sorted(map(tuple, found.collect()), key=repr) == wanted


def test_one_file_is_many_blocks(spark, splits, tmp_path):
    written(tmp_path / "x.csv", [(i, "a\nb", 'c"d') for i in range(200)])
    splits(256)
    lines = quoted.file_lines(spark, str(tmp_path / "x.csv"))
    assert lines.select("start").distinct().count() > 8
    plan = delimited.load_delimited(spark, str(tmp_path / "x.csv"), SCHEMA, header=False)
    assert plan.filter("a = 'a\nb' and b = 'c\"d'").count() == 200
    assert plan.rdd.getNumPartitions() > 8


def test_blank_lines_and_headers(spark, splits, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'\n\r\n"n\nm",a,b\r\n\r\n1,,""\n\n2,"\n\n",x')
    (tmp_path / "b.csv").write_bytes(b"n,a,b\n")
    (tmp_path / "c.csv").write_bytes(b"")
    (tmp_path / "d.csv").write_bytes(b"\n\n\n")
    for size in (3, 1 << 20):
        splits(size)
        found = delimited.load_delimited(spark, str(tmp_path), SCHEMA).orderBy("n").collect()
        assert [(r.n, r.a, r.b or None) for r in found] == [(1, None, None), (2, "\n\n", "x")]


def test_failures(spark, splits, tmp_path):
    (tmp_path / "open.csv").write_bytes(b'1,a,b\n2,"c,d\n3,e,f\n')
    (tmp_path / "text.csv").write_bytes(b"one,a,b\n")
    (tmp_path / "short.csv").write_bytes(b"1,a\n")
    for size in (6, 1 << 20):
        splits(size)
        for name, error in (("open", "unclosed quote"), ("text", "MALFORMED"), ("short", "MALFORMED")):
            with pytest.raises(Exception, match=error):
                delimited.load_delimited(spark, str(tmp_path / f"{name}.csv"), SCHEMA, header=False).collect()


def test_changed_splits_fail(spark, splits, tmp_path):
    written(tmp_path / "x.csv", [(i, "a\nb", "c") for i in range(50)])
    splits(64)
    found = quoted.read_records(spark, str(tmp_path / "x.csv"), False)
    splits(100)
    with pytest.raises(Exception, match="split in another way"):
        found.agg(F.count("*")).collect()
