import pytest
from conftest import rows, unordered
from pyspark.errors import AnalysisException

from ratelens.operators import ranking
from ratelens.plans import reports
from ratelens.sources import readers, shared, writers
from ratelens.sources.frames import ratings_by_number


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def put(folder, name, text):
    with open(f"{folder}/{name}", "w", encoding="utf-8") as file:
        file.write(text)
    return f"{folder}/{name}"


def test_csv_with_schema(spark, folder):
    path = put(folder, "m.csv", "ym,n_calif\n2023-11,66\n2023-12,\n")
    df = readers.read_csv(spark, path, "ym string, n_calif bigint")
    assert rows(df) == [("2023-11", 66), ("2023-12", None)]
    assert dict(readers.read_csv(spark, path).dtypes) == {"ym": "string", "n_calif": "string"}
    assert dict(readers.read_csv(spark, path, infer=True).dtypes)["n_calif"] == "int"


def test_csv_with_another_header_is_an_error(spark, folder):
    put(folder, "a.csv", "id,marca\n1,x\n")
    put(folder, "b.csv", "marca,id\ny,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_csv(spark, f"{folder}/*.csv", "id string, marca string").collect()


def test_csv_with_an_unnamed_first_column(spark, folder):
    path = put(folder, "u.csv", ",estrellas\n7,5\n")
    assert readers.read_csv(spark, path).columns == ["_c0", "estrellas"]
    assert rows(ratings_by_number(readers.read_csv(spark, path))) == [(7, 5.0)]


TEXTS = [
    ('say "hi", all',), (" blanks ",), ("two\nlines",), ("back\\slash\"",), ("ñ\t;",), (None,),
    ("",), ("\r\n\u241bn \u241b0\u241b\n",), ("a\\nb",),
]


def test_texts_survive_csv(spark, folder):
    df = spark.createDataFrame([(i, *t) for i, t in enumerate(TEXTS)], "k int, t string")
    writers.write_csv(df, f"{folder}/t")
    back = readers.read_csv(spark, f"{folder}/t", "k int, t string")
    assert unordered(back) == [(i, t or None) for i, (t,) in enumerate(TEXTS)]
    assert back.select("k").count() == len(TEXTS)


def test_broken_records_of_others_fail(spark, folder):
    path = put(folder, "r.csv", 'user,text,day\nana,"line one\nline two",2024-01-02\nluz,no,2024-01-03\n')
    schema = "user string, text string, day date"
    for wanted in ("user", "text", "day"):
        with pytest.raises(Exception, match="MALFORMED_RECORD"):
            readers.read_csv(spark, path, schema).select(wanted).collect()
    whole = readers.read_csv(spark, path, schema, multi_line=True)
    assert [(r.user, r.text, str(r.day)) for r in whole.collect()] == [
        ("ana", "line one\nline two", "2024-01-02"), ("luz", "no", "2024-01-03")]


def test_bad_values_are_missing_not_broken(spark, folder):
    path = put(folder, "v.csv", "k,n\na,bad\nb,2\n")
    assert rows(readers.read_csv(spark, path, "k string, n bigint")) == [("a", None), ("b", 2)]


def test_groups_of_files(spark, folder):
    put(folder, "autos1.csv", "id,make\n1,Seat\n")
    put(folder, "autos2.csv", "id,make\n1,Seat\n")
    put(folder, "more.csv", "modelo,id\nIbiza,2\n")
    globs = [f"{folder}/autos*.csv", f"{folder}/more*.csv", f"{folder}/none*.csv"]
    assert unordered(readers.read_csv_groups(spark, globs)) == sorted([
        ("1", "Seat", None), ("1", "Seat", None), ("2", None, "Ibiza")], key=repr)
    assert unordered(reports.build_catalogue(spark, globs)) == sorted([
        ("1", "Seat", None), ("2", None, "Ibiza")], key=repr)


def test_no_files_give_an_empty_catalogue(spark, folder):
    assert readers.read_csv_groups(spark, [f"{folder}/none*.csv"]) is None
    empty = reports.build_catalogue(spark, [f"{folder}/none*.csv"])
    assert empty.columns == ["id_vehiculo", "marca", "nombre_vehiculo"] and rows(empty) == []
    writers.write_csv(empty, f"{folder}/empty")
    assert rows(readers.read_csv(spark, f"{folder}/empty", empty.schema)) == []


def test_missing_sources(spark, folder):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND.*nothing"):
        readers.read_table(spark, f"{folder}/nothing")
    assert readers.optional(lambda: readers.read_table(spark, f"{folder}/nothing")) is None
    made = readers.or_empty(
        lambda: readers.read_csv(spark, f"{folder}/nothing.csv"), spark, "a string")
    assert made.columns == ["a"] and made.isEmpty()
    with pytest.raises(AnalysisException):
        readers.optional(lambda: spark.range(1).select("nothing"))


def test_source_total_falls_back(spark, folder):
    def missing():
        return readers.read_table(spark, f"{folder}/nothing")

    assert rows(readers.source_total(spark, lambda: spark.range(3), missing)) == [(3, "original")]
    assert rows(readers.source_total(spark, missing, lambda: spark.range(2))) == [(2, "guardado")]
    assert rows(readers.source_total(spark, missing, missing)) == [(0, None)]


def test_source_total_hides_no_other_error(spark, folder):
    bad = put(folder, "bad.parquet", "no table")
    for read in (lambda: readers.read_table(spark, bad), lambda: spark.range(3).select("nothing")):
        with pytest.raises(Exception, match="CANNOT_READ_FILE|UNRESOLVED_COLUMN|FAILED_READ"):
            readers.source_total(spark, read, lambda: spark.range(2)).collect()


def test_read_files(spark, folder):
    spark.range(7).coalesce(1).write.parquet(f"{folder}/t")
    (found,) = rows(readers.read_files(readers.read_table(spark, f"{folder}/t")))
    assert found[0].startswith("part-") and found[1] == 7 and found[2] is not None


def test_freshness(spark, folder):
    put(folder, "a.csv", "x\n1\n")
    put(folder, "b.csv", "x\n12\n")
    found = unordered(readers.freshness(spark, folder))
    assert [r[:2] for r in found] == [("a.csv", 4), ("b.csv", 5)]
    assert all(len(r[2]) == 19 for r in found)
    missing = readers.freshness(spark, f"{folder}/nothing")
    assert rows(missing) == [] and missing.dtypes == readers.freshness(spark, folder).dtypes


def test_table_by_month(spark, folder):
    df = spark.createDataFrame([("2024-01", 1), ("2024-02", 2)], "ym string, n long")
    writers.write_table(df, f"{folder}/t", partition_by=["ym"])
    assert unordered(readers.read_table(spark, f"{folder}/t").select("ym", "n")) == [
        ("2024-01", 1), ("2024-02", 2)]
    writers.write_table(df.limit(1), f"{folder}/t")
    assert readers.read_table(spark, f"{folder}/t").count() == 1


def test_report_is_one_file(spark, folder, tmp_path):
    df = spark.range(0, 100, 1, 8).toDF("k")
    writers.write_report(ranking.top(df, 10, ranking.falling("k")), f"{folder}/r", at_most=10)
    assert len(list((tmp_path / "r").glob("part-*.csv"))) == 1
    assert rows(readers.read_csv(spark, f"{folder}/r", "k long")) == [
        (k,) for k in range(99, 89, -1)]


def test_report_that_is_too_long_is_not_written(spark, folder, tmp_path):
    with pytest.raises(ValueError, match="more than 10"):
        writers.write_report(spark.range(11), f"{folder}/r", at_most=10)
    assert not (tmp_path / "r").exists()


def test_sorted_export_is_in_order(spark, folder, tmp_path):
    df = spark.range(0, 1000, 1, 8).selectExpr("id % 10 as a", "id as b")
    writers.write_sorted(df, f"{folder}/s", ranking.falling("a"))
    lines = []
    for part in sorted((tmp_path / "s").glob("part-*.csv")):
        lines += [tuple(map(int, x.split(","))) for x in part.read_text().splitlines()[1:]]
    assert lines == sorted(lines, key=lambda r: (-r[0], r[1])) and len(lines) == 1000


def test_same_result_in_two_places(spark, folder):
    df = spark.range(5).toDF("k")
    writers.write_each(df, [f"{folder}/x", f"{folder}/y"])
    for place in "xy":
        assert unordered(readers.read_csv(spark, f"{folder}/{place}", "k long")) == [
            (k,) for k in range(5)]


def test_preview(spark):
    assert rows(writers.preview(spark.range(9).toDF("k"), 2, ranking.falling("k"))) == [(8,), (7,)]


def test_shared_folder(spark, monkeypatch):
    first = shared.shared_folder(spark)
    assert shared.shared_folder(spark) == first
    assert shared.new_folder(spark, "t") != shared.new_folder(spark, "t")
    assert shared.new_folder(spark, "t").startswith(first + "/t-")


class Cluster:
    """As much of a session as ``shared_folder`` looks at."""

    def __init__(self, named):
        self.conf = self.sparkContext = self
        self.master, self.named = "spark://head:7077", named

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.named or default

    def getCheckpointDir(self):
        return None


@pytest.mark.parametrize("own_temp", ["/tmp", "/proc/self/cwd/.tmp", "/scratch/7"])
def test_a_cluster_must_name_its_folder(monkeypatch, own_temp):
    monkeypatch.setattr(shared.tempfile, "gettempdir", lambda: own_temp)
    assert shared.shared_folder(Cluster("hdfs://data/scratch/")) == "hdfs://data/scratch"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared.shared_folder(Cluster(None))
    assert shared.shared_folder(Cluster("file:///mnt/shared")) == "file:///mnt/shared"
    for own in ("/tmp/checkpoints", "file:///tmp/checkpoints", "file:/tmp", f"{own_temp}/x", "/dev/shm/x"):
        with pytest.raises(RuntimeError, match="each machine"):
            shared.shared_folder(Cluster(own))


def test_intermediate_tables_go(spark):
    from pathlib import Path

    with shared.intermediate_tables(spark) as place:
        assert unordered(shared.stored(spark.range(2), "t")) == [(0,), (1,)]
        local = Path(place.removeprefix("file:"))
        assert list(local.iterdir())
    assert not local.exists()
    assert not shared.new_folder(spark, "t").startswith(place)
    with pytest.raises(ZeroDivisionError), shared.intermediate_tables(spark) as place:
        shared.stored(spark.range(2), "t")
        1 / 0
    assert not Path(place.removeprefix("file:")).exists()
