"""Landing files with the faults that real ones have.  Files are written by hand."""

from __future__ import annotations

import os

import pytest

from orelake.constants import FEATURES, TICKET_COLUMNS, VERSION_PATTERN
from orelake.plans import bronze
from orelake.plans.lake import Lake
from orelake.schemas import CODE_METRICS
from orelake.sources import files

HEADER = ",".join(["name", *FEATURES, "bug"])


def code_line(name: str, value: float = 1.0, bug: str = "0") -> str:
    return ",".join([name, *[str(value)] * len(FEATURES), bug])


@pytest.fixture()
def landing(tmp_path):
    def write(path: str, *lines: str) -> None:
        target = tmp_path / path
        os.makedirs(target.parent, exist_ok=True)
        target.write_text("\n".join(lines) + "\n")

    write("code/ant/ant-1.3.csv", HEADER, code_line("a.A"), code_line("a.B", bug="2"))
    write("code/ant/ant-1.4.4.csv", HEADER, code_line("a.A", bug="1.0"), "short,1.0")
    write("code/my proj/nodash.csv", HEADER, code_line("b.B", bug="x"))
    write("code/ant/ant-9.csv", HEADER)
    write("code/ant/ant-8.csv")
    (tmp_path / "code/ant/ant-8.csv").write_text("")
    write("code/odd/odd-1.csv", HEADER.rsplit(",", 1)[0], ",".join(["c", *["1"] * len(FEATURES)]))
    write("tickets/SYS.csv", ",".join(TICKET_COLUMNS), "S-1,Bug,Done,SYS,System,software,Fixed,16/06/2022 23:13,")
    return str(tmp_path)


def test_typed_scan(spark, landing):
    rows = files.read_typed_csv(spark, f"{landing}/code/ant/*.csv", CODE_METRICS)
    assert rows.schema["name"].nullable  # file sources drop the required mark
    got = {(r.name, r._source_file.rsplit("-", 1)[-1]): r.bug for r in rows.collect()}
    assert got == {("a.A", "1.3.csv"): 0, ("a.B", "1.3.csv"): 2, ("a.A", "1.4.4.csv"): None, ("short", "1.4.4.csv"): None}


def test_path_columns(spark, landing):
    rows = files.read_typed_csv(spark, f"{landing}/code/*/*.csv", CODE_METRICS)
    named = files.with_path_columns(rows, {"_project": "/code/([^/]+)/", "_version": VERSION_PATTERN})
    got = {(r._project, r._version) for r in named.collect()}
    assert got == {("ant", "1.3"), ("ant", "1.4.4"), ("my proj", ""), ("odd", "1")}


def test_untyped_scan_is_all_text(spark, landing):
    rows = files.read_text_csv(spark, f"{landing}/tickets/*.csv")
    assert {f.dataType.simpleString() for f in rows.schema.fields} == {"string"}
    assert rows.first()["Created"] == "16/06/2022 23:13" and rows.first()["Resolved"] is None


def test_header_check(spark, landing):
    checked = files.check_headers(spark, f"{landing}/code/*/*.csv", len(FEATURES) + 2)
    got = {r._source_file.rsplit("/", 1)[-1]: (r.n_columns, r.data_rows, r.conforms) for r in checked.collect()}
    assert got == {
        "ant-1.3.csv": (22, 2, True),
        "ant-1.4.4.csv": (22, 2, True),
        "nodash.csv": (22, 1, True),
        "ant-9.csv": (22, 0, False),
        "ant-8.csv": (0, 0, False),
        "odd-1.csv": (21, 1, False),
    }
    rows = files.read_typed_csv(spark, f"{landing}/code/*/*.csv", CODE_METRICS)
    assert {r.name for r in files.keep_conforming(rows, checked).collect()} == {"a.A", "a.B", "short", "b.B"}
    assert files.conforming_paths(spark, f"{landing}/code/*/*.csv", 22).count() == 3
    assert files.exclude_files(rows, ["odd-1.csv", "nodash.csv"]).count() == 4


def test_header_check_on_split_files(spark, landing):
    """The header is found although the file is read in many pieces."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        got = {r._source_file.rsplit("/", 1)[-1]: r.n_columns for r in files.check_headers(spark, f"{landing}/code/ant/*.csv", 22).collect()}
        assert got == {"ant-1.3.csv": 22, "ant-1.4.4.csv": 22, "ant-9.csv": 22, "ant-8.csv": 0}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_totals(spark, landing):
    assert tuple(files.landing_totals(spark, f"{landing}/code/*/*.csv").first()) == (6, 6)
    counts = {r._source_file.rsplit("/", 1)[-1]: r.data_rows for r in files.file_line_counts(spark, f"{landing}/code/ant/*.csv").collect()}
    assert counts == {"ant-1.3.csv": 2, "ant-1.4.4.csv": 2, "ant-9.csv": 0, "ant-8.csv": 0}


def test_separator_is_plain_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ab|cd^ef\n1|2^3\n")
    for separator, n in (("|", 2), ("^", 2), (",", 1)):
        assert files.check_headers(spark, f"{tmp_path}/*.csv", 2, separator).first().n_columns == n


def test_project_is_the_folder_of_the_file(spark, tmp_path):
    """The area's name may come up higher in the path, and a folder may hold a space."""
    root = tmp_path / "code" / "landing"
    os.makedirs(root / "code" / "my proj")
    (root / "code" / "my proj" / "my proj-2.0.csv").write_text("\n".join([HEADER, code_line("a.A")]) + "\n")
    lake = Lake(landing=str(root), artifacts=str(tmp_path))
    row = bronze.landed_code(spark, lake).first()
    assert (row._project, row._version) == ("my proj", "2.0")
    assert bronze.landed_code(spark, Lake(landing=str(root), artifacts="", excluded_files=("my proj-2.0.csv",))).count() == 0


def test_lines_are_not_sorted_for_their_headers(spark, landing, plan_of):
    for frame in (files.check_headers(spark, f"{landing}/code/*/*.csv", 22), files.file_line_counts(spark, f"{landing}/code/*/*.csv")):
        assert "SortAggregate" not in plan_of(frame) and "HashAggregate" in plan_of(frame)


def test_separators_of_many_letters_and_empty_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ä||b||\n1||2||3\n")
    (tmp_path / "b.csv").write_text("\n1||2\n")
    got = {r._source_file.rsplit("/", 1)[-1]: r.n_columns for r in files.check_headers(spark, f"{tmp_path}/*.csv", 3, "||").collect()}
    assert got == {"a.csv": 3, "b.csv": 1}


def test_partitioned_write_keeps_a_file_open_per_value(spark, tmp_path):
    """Values beyond the limit are written too, and the session's setting comes back."""
    from orelake import storage

    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    rows = spark.range(200).selectExpr("id", "nullif(id % 9, 4) AS kind")
    with storage.one_writer_per_value(spark, most=3):
        assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "3"
        rows.write.partitionBy("kind").parquet(f"{tmp_path}/t")
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    assert sorted(map(str, spark.read.parquet(f"{tmp_path}/t").collect())) == sorted(map(str, rows.collect()))
