from __future__ import annotations

import pytest
from pyspark.sql import types as T

from flowgauge.sources import contract, csv_files, scratch


def _write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


@pytest.fixture()
def folder(tmp_path):
    base = tmp_path / "raw"
    _write(base, "a.csv", "flow_id,bytes_s,label\n1,1.5,x\n2,inf,NULL\n")
    _write(base, "b.csv", "Label, Bytes/s ,Flow ID\ny,7,3\nz,TCP,4\n")
    _write(base, "c d.csv", 'flow_id,"label"\r\n5,"a,b"\r\n6,')
    return str(base)


SCHEMA = T.StructType(
    [T.StructField("flow_id", T.LongType()), T.StructField("bytes_s", T.DoubleType()), T.StructField("label", T.StringType())]
)


def test_values_follow_their_names(spark, folder):
    rows = {r.flow_id: (r.bytes_s, r.label) for r in csv_files.read_by_name(spark, folder, SCHEMA).collect()}
    assert rows == {
        1: (1.5, "x"), 2: (float("inf"), "NULL"), 3: (7.0, "y"), 4: (None, "z"), 5: (None, "a,b"), 6: (None, None)
    }


def test_types_do_not_depend_on_the_file(spark, folder):
    df = csv_files.read_by_name(spark, folder)
    assert dict(df.dtypes) == {"flow_id": "bigint", "bytes_s": "string", "label": "string"}


def test_numbers_are_found_over_all_files(spark, tmp_path):
    _write(tmp_path / "n", "a.csv", "i,d\n1,1\n")
    _write(tmp_path / "n", "b.csv", "d,i\n2.5,2\n,3\n")
    assert dict(csv_files.read_by_name(spark, str(tmp_path / "n")).dtypes) == {"i": "bigint", "d": "double"}


def test_equal_names_are_an_error(spark, tmp_path):
    _write(tmp_path / "n", "a.csv", "Flow ID,flow/id\n1,2\n")
    with pytest.raises(ValueError, match="flow_id"):
        csv_files.read_by_name(spark, str(tmp_path / "n"))
    with pytest.raises(ValueError, match="a_b"):
        csv_files.normalise_columns(spark.createDataFrame([(1, 2)], ["A b", " a/b"]))


def test_no_files_is_an_error(spark, tmp_path):
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        csv_files.read_by_name(spark, str(tmp_path / "none"))


def test_file_without_header_is_an_error(spark, tmp_path):
    _write(tmp_path / "n", "a.csv", "i\n1\n")
    _write(tmp_path / "n", "empty.csv", "")
    assert csv_files.read_by_name(spark, str(tmp_path / "n")).count() == 1
    _write(tmp_path / "n", "blank.csv", "\n1\n")
    with pytest.raises(ValueError, match="blank.csv"):
        csv_files.read_by_name(spark, str(tmp_path / "n"))


def test_quoted_values(spark, tmp_path):
    _write(tmp_path / "n", "a.csv", 's,i\n"say ""hi"", you",1\n')
    assert [tuple(r) for r in csv_files.read_by_name(spark, str(tmp_path / "n")).collect()] == [('say "hi", you', 1)]


def test_strict_scan_refuses_another_header(spark, folder):
    text = T.StructType([T.StructField(n, T.StringType()) for n in ("flow_id", "bytes_s", "label")])
    with pytest.raises(Exception, match="(?i)header"):
        csv_files.scan_csv(spark, folder, text, strict_header=True).collect()


def test_long_header_line_is_read_whole(spark, tmp_path):
    names = [f"column_{i:05d}" for i in range(2000)]
    _write(tmp_path / "n", "a.csv", ",".join(names) + "\n" + ",".join(["1"] * 2000) + "\n")
    assert csv_files.read_text_by_name(spark, str(tmp_path / "n")).columns == names


def test_rows_per_file_in_path_order(spark, folder):
    scan = spark.read.option("header", True).csv(folder)
    rows = csv_files.rows_per_file(scan).collect()
    assert [r.file.rsplit("/", 1)[1] for r in rows] == ["a.csv", "b.csv", "c%20d.csv"]
    assert [r["rows"] for r in rows] == [2, 2, 2]


def test_schema_faults_are_named(spark, folder):
    text = csv_files.read_text_by_name(spark, folder)
    wanted = T.StructType([*SCHEMA.fields, T.StructField("dst_port", T.LongType())])
    report = {r.column: r for r in contract.schema_report(text, wanted).collect()}
    assert (report["bytes_s"].bad_values, report["bytes_s"].null_values) == (1, 2)
    assert not report["dst_port"].present
    with pytest.raises(contract.SchemaMismatch, match="bytes_s.*dst_port"):
        contract.require_schema(text, wanted)
    good = T.StructType([T.StructField("flow_id", T.LongType())])
    assert contract.require_schema(text, good) is text


def test_profile_and_types(spark):
    df = spark.range(100).repartition(4)
    profile = contract.table_profile(df).first()
    assert (profile["rows"], profile["columns"], profile.filled_partitions) == (100, 1, 4)
    assert [tuple(r) for r in contract.column_types(df).collect()] == [(0, "id", "bigint")]


class _Session:
    """Just what the scratch folder asks of a session."""

    def __init__(self, master, configured=None):
        self.sparkContext, self.conf, self.master = self, self, master
        self.configured, self.folder = configured, None

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.configured or default

    def setCheckpointDir(self, folder):
        self.folder = f"file:{folder}/app"

    def getCheckpointDir(self):
        return self.folder


def test_scratch_follows_the_session(spark):
    assert scratch.fresh_dir(_Session("yarn", "hdfs://shared/dir/"), "x").startswith("hdfs://shared/dir/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.fresh_dir(_Session("yarn"), "x")
    local = _Session("local[2]")
    assert scratch.scratch_base(local) == scratch.scratch_base(local) == local.folder
    assert scratch.fresh_dir(spark, "x") != scratch.fresh_dir(spark, "x")


@pytest.mark.parametrize("name", ["a#b.csv", "a%41.csv", "a[1].csv", "a{x}.csv", "a b.csv", "a*.csv", "é.csv"])
def test_file_names_are_taken_as_they_are(spark, tmp_path, name):
    _write(tmp_path / "odd", name, "i,j\n1,2\n")
    _write(tmp_path / "odd", "a1.csv", "j,i\n4,3\n")
    rows = csv_files.read_text_by_name(spark, str(tmp_path / "odd")).collect()
    assert sorted((r.i, r.j) for r in rows) == [("1", "2"), ("3", "4")]


def test_question_mark_in_a_name(spark, tmp_path):
    _write(tmp_path / "odd", "a?b.csv", "i,j\n1,2\n")
    assert [tuple(r) for r in csv_files.read_text_by_name(spark, str(tmp_path / "odd")).collect()] == [("1", "2")]


def test_rows_of_another_shape_are_kept_and_reported(spark, tmp_path):
    _write(tmp_path / "r", "a.csv", 'a,b\n1,2\n3,4,5\n6\n7,"x\ny"\n')
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    text = scratch.written(csv_files.read_text_by_name(spark, str(tmp_path / "r"), corrupt="bad"))
    # A quoted line break is one row with multi_line only; else its second half is a row of another shape.
    assert {r.bad for r in text.collect()} == {None, "3,4,5", "6", 'y"'}
    report = {r.column: r.bad_values for r in contract.schema_report(text, schema, "bad").collect()}
    assert report == {contract.ROW_SHAPE: 3, "a": 0, "b": 0}
    with pytest.raises(contract.SchemaMismatch, match="row"):
        contract.require_schema(text, schema, "bad")
    whole = scratch.written(csv_files.read_text_by_name(spark, str(tmp_path / "r"), corrupt="bad", multi_line=True))
    assert sorted((r.a, r.b) for r in whole.where("bad is null").collect()) == [("1", "2"), ("7", "x\ny")]


def test_a_column_may_not_have_the_name_of_the_corrupt_one(spark, tmp_path):
    _write(tmp_path / "r", "a.csv", "a,bad\n1,2\n")
    with pytest.raises(ValueError, match="bad"):
        csv_files.read_text_by_name(spark, str(tmp_path / "r"), corrupt="bad")
