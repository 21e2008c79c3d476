"""Broken CSV records set aside, and results published whole or not at all."""

import os
import signal
import subprocess
import sys
import time
from pathlib import Path

import pytest
from conftest import rows, unordered
from pyspark.sql import functions as F

from ratelens.sources import publish, writers
from ratelens.sources.names import MissingColumns
from ratelens.sources.publish import published_files, read_published
from ratelens.sources.readers import read_csv
from ratelens.sources.records import read_csv_apart

CSV = ('k,a,b\n1,x,y\n2,x\n3,x,y,z\n4,x,"open\n5,"q, ""q""",z\n6,"a"b,c\n"7,x,y\n\n   \n8,,\n9,x,"ok "\n'
       'k,a,b\n10,"""",""\n11,☛n,"a\\b"\n')
BAD = [("2,x", "faltan campos"), ("3,x,y,z", "sobran campos"), ('4,x,"open', "comillas"), ('6,"a"b,c', "comillas"),
       ('"7,x,y', "comillas")]


@pytest.fixture
def put(tmp_path):
    def make(text, name="r.csv"):
        (tmp_path / name).write_text(text, encoding="utf-8")
        return f"{tmp_path}/{name}"
    return make


def test_every_record_is_in_one_of_both(spark, put):
    path = put(CSV)
    found = read_csv_apart(spark, path, "k int, a string, b string")
    assert unordered(found.good) == sorted([
        (1, "x", "y"), (5, 'q, "q"', "z"), (8, None, None), (9, "x", "ok "), (10, '"', None), (11, "☛n", "a\\b")], key=repr)
    bad = found.bad.collect()
    assert sorted((r.registro, r.motivo) for r in bad) == sorted(BAD)
    assert {(r.archivo.rsplit("/", 1)[-1], r.bloque) for r in bad} == {("r.csv", 0)}
    records = sum(bool(line.strip()) and line != "k,a,b" for line in CSV.splitlines())
    assert found.good.count() + found.bad.count() == records


def test_values_of_another_type(spark, put):
    path = put("k,n\na,bad\nb,2\nc,\n")
    assert unordered(read_csv_apart(spark, path, "k string, n bigint").good) == [("a", None), ("b", 2), ("c", None)]
    strict = read_csv_apart(spark, path, "k string, n bigint", strict=True)
    assert unordered(strict.good) == [("b", 2), ("c", None)]
    assert [(r.registro, r.motivo) for r in strict.bad.collect()] == [("a,bad", "valor")]


def test_texts_over_several_lines_are_never_cut(spark, put):
    path = put('user,text\nana,"line one\nline two"\nluz,no\n')
    found = read_csv_apart(spark, path)
    assert rows(found.good) == [("luz", "no")]
    assert sorted(r.registro for r in found.bad.collect()) == ['ana,"line one', 'line two"']


def test_headers(spark, put, tmp_path):
    put("a,b\n1,2\n", "1.csv")
    put("b,a\n3,4\n", "2.csv")
    with pytest.raises(MissingColumns, match="2.csv"):
        read_csv_apart(spark, f"{tmp_path}/*.csv", "a string, b string")
    assert read_csv_apart(spark, f"{tmp_path}/*.csv", "a string, b string", header=False).good.count() == 4
    assert rows(read_csv_apart(spark, put(",s\n7,5\n", "u.csv")).good) == [("7", "5")]


def test_long_records_and_no_records(spark, put):
    long = '"' + 'say ""so"" , ' * 50_000 + '"'
    found = read_csv_apart(spark, put(f"a,b\n1,{long}\n2,{long[:-1]}\n"), "a int, b string")
    ((k, text),) = rows(found.good)
    assert k == 1 and len(text) == 50_000 * len('say "so" , ')
    assert [r.motivo for r in found.bad.collect()] == ["comillas"]
    empty = read_csv_apart(spark, put("a,b\n"), "a int, b string")
    assert rows(empty.good) == [] and rows(empty.bad) == []


def test_what_write_csv_writes_is_whole(spark, tmp_path):
    df = spark.createDataFrame([(1, 'two\nlines, "q"'), (2, None), (3, " x ")], "k int, t string")
    writers.write_csv(df, f"{tmp_path}/t")
    found = read_csv_apart(spark, f"{tmp_path}/t", "k int, t string")
    assert unordered(found.good) == unordered(df) and found.bad.isEmpty()


def broken(spark):
    return spark.range(1000).select(
        F.when(F.col("id") == 999, F.raise_error(F.lit("no more"))).otherwise(F.col("id")).cast("long").alias("k"))


def beside(folder):
    return [p.name for p in folder.iterdir() if p.name.startswith(".")]


@pytest.mark.parametrize("write", [writers.write_table, writers.write_csv])
def test_a_failed_write_leaves_the_old_result(spark, tmp_path, write):
    write(spark.range(3).toDF("k"), f"{tmp_path}/t")
    before = sorted(p.name for p in (tmp_path / "t").iterdir())
    with pytest.raises(Exception, match="no more"):
        write(broken(spark), f"{tmp_path}/t")
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == before and beside(tmp_path) == []
    write(spark.range(4).toDF("k"), f"{tmp_path}/t")
    back = spark.read.parquet(f"{tmp_path}/t") if write is writers.write_table else read_csv(spark, f"{tmp_path}/t", "k long")
    assert unordered(back) == [(k,) for k in range(4)] and beside(tmp_path) == []


def test_several_places_get_it_or_none(spark, tmp_path, monkeypatch):
    writers.write_each(spark.range(2).toDF("k"), [f"{tmp_path}/x", f"{tmp_path}/y"], writers.write_table)
    put_manifest, made = publish._Folder.put_manifest, []

    def fail_second(self, folder):
        made.append(folder)
        if len(made) == 2:
            raise OSError("disk full")
        put_manifest(self, folder)

    monkeypatch.setattr(publish._Folder, "put_manifest", fail_second)
    with pytest.raises(OSError, match="disk full"):
        writers.write_each(spark.range(5).toDF("k"), [f"{tmp_path}/x", f"{tmp_path}/y"], writers.write_table)
    assert [read_published(spark, f"{tmp_path}/{p}").count() for p in "xy"] == [2, 2] and beside(tmp_path) == []


@pytest.mark.parametrize("at", [1, 2])
def test_a_switch_that_ends_in_the_middle_is_settled(spark, tmp_path, monkeypatch, at):
    path = f"{tmp_path}/t"
    writers.write_table(spark.range(2).toDF("k"), path)
    rename, calls = publish._Folder.rename, []

    class Killed(BaseException):
        pass

    def die(self, source, target):
        calls.append(target)
        if len(calls) == at:
            raise Killed
        rename(self, source, target)

    with monkeypatch.context() as patch:
        patch.setattr(publish._Folder, "rename", die)
        patch.setattr(publish._Folder, "remove", lambda self, folder: None)       # nothing runs any more
        with pytest.raises(Killed):
            writers.write_table(spark.range(5).toDF("k"), path)
    assert Path(path).exists() == (at == 1)
    assert read_published(spark, path).count() == (2 if at == 1 else 5)
    assert beside(tmp_path) == []


def test_a_half_written_result_is_not_taken(spark, tmp_path):
    path = f"{tmp_path}/t"
    writers.write_table(spark.range(2).toDF("k"), path)
    os.rename(path, f"{tmp_path}/.t.old-1")
    spark.range(9).toDF("k").write.parquet(f"{tmp_path}/.t.new-1")                # without a manifest
    assert read_published(spark, path).count() == 2 and beside(tmp_path) == []


def test_files_are_those_of_the_manifest(spark, tmp_path):
    path = f"{tmp_path}/t"
    writers.write_table(spark.range(20).selectExpr("id % 2 as p", "id as k"), path, partition_by=["p"])
    listed = dict(rows(published_files(spark, path)))
    assert listed == {str(p.relative_to(path)): p.stat().st_size for p in Path(path).rglob("*.parquet")}
    assert rows(published_files(spark, f"{tmp_path}/nothing")) == []
    next(Path(path).rglob("*.parquet")).unlink()
    with pytest.raises(OSError, match="manifest"):
        read_published(spark, path)


SLOW = """
import sys
sys.path.insert(0, {repo!r})
from suite.compare import session
from ratelens.sources import writers
spark = session(1)
slow = spark.range(0, 400, 1, 4).selectExpr("java_method('java.lang.Thread', 'sleep', 100L) as s", "id as k")
print("writing", flush=True)
writers.write_table(slow.select("k", "s"), {path!r})
"""


def test_a_killed_run_leaves_the_old_result(spark, tmp_path):
    path = f"{tmp_path}/t"
    writers.write_table(spark.range(3).toDF("k"), path)
    code = SLOW.format(repo=str(Path(__file__).parent.parent), path=path)
    run = subprocess.Popen([sys.executable, "-c", code], stdout=subprocess.PIPE, stderr=subprocess.DEVNULL,
                           text=True, start_new_session=True)
    try:
        while run.stdout.readline().strip() != "writing":
            assert run.poll() is None
        until = time.time() + 60
        while not beside(tmp_path) and time.time() < until:
            time.sleep(0.2)
        time.sleep(2)
    finally:
        os.killpg(run.pid, signal.SIGKILL)
        run.wait()
    assert len(beside(tmp_path)) == 1
    assert spark.read.parquet(path).count() == 3
    assert read_published(spark, path).count() == 3 and beside(tmp_path) == []
