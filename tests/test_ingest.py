from __future__ import annotations

import pytest

from tallymart.sources.ingest import (
    FAILED,
    MULTILINE,
    SUCCESS,
    CORRUPT,
    IngestOptions,
    audit_log,
    create_audit_table,
    ingest_folder,
    list_csv_files,
    read_csv,
    table_name,
)

REVIEWS = 'id,text,zip\nr1,"two\nlines",1000\nr2,"said ""no""",2000\n'


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "olist_sellers_dataset.csv").write_text("seller_id,zip,price\ns1,1000,1.5\ns2,,2\n")
    (tmp_path / "reviews.csv").write_text(REVIEWS)
    (tmp_path / "olist_broken_dataset.csv").write_text("")
    (tmp_path / "notes.txt").write_text("not,a,table\n")
    return tmp_path


def test_table_names():
    assert table_name("olist_order_items_dataset.csv") == "order_items"
    assert table_name("product_category_name_translation.csv") == "product_category_name_translation"
    assert table_name("my_olist_x_dataset_2.csv") == "my_olist_x_dataset_2"
    assert table_name("raw_x.csv", prefix="^raw_", suffix="$^") == "x"


def test_only_csv_files_are_listed(spark, folder):
    names = [path.rsplit("/", 1)[-1] for path in list_csv_files(spark, str(folder))]
    assert names == ["olist_broken_dataset.csv", "olist_sellers_dataset.csv", "reviews.csv"]


def test_a_failing_file_does_not_stop_the_run(spark, folder):
    options = IngestOptions(layer="raw1")
    results = ingest_folder(spark, str(folder), options, run_id="run-1")
    by_name = {r.source_file: r for r in results}
    assert by_name["olist_sellers_dataset.csv"].status == SUCCESS
    assert by_name["olist_sellers_dataset.csv"].rows_read == 2
    assert by_name["olist_sellers_dataset.csv"].target_table == "raw1.sellers"
    broken = by_name["olist_broken_dataset.csv"]
    assert (broken.status, broken.rows_read) == (FAILED, 0) and broken.error_message
    assert dict(spark.table("raw1.sellers").dtypes) == {
        "seller_id": "string",
        "zip": "int",
        "price": "double",
    }
    log = audit_log(spark, "raw1.ingestion_audit")
    assert log.columns == [
        "run_id",
        "source_file",
        "target_table",
        "rows_read",
        "ingestion_timestamp",
        "status",
        "error_message",
    ]
    assert log.count() == 3 and {r["run_id"] for r in log.collect()} == {"run-1"}

    # A second run replaces the tables and appends to the log; the newest rows come first.
    again = ingest_folder(spark, str(folder), options)
    assert len({r.run_id for r in again}) == 1 and again[0].run_id != "run-1"
    assert spark.table("raw1.sellers").count() == 2
    log_rows = audit_log(spark, "raw1.ingestion_audit").collect()
    assert len(log_rows) == 6 and log_rows[0]["run_id"] == again[0].run_id
    create_audit_table(spark, "raw1.ingestion_audit")  # keeps the rows that are there
    assert spark.table("raw1.ingestion_audit").count() == 6


def test_quoted_line_breaks(spark, folder):
    path = str(folder / "reviews.csv")
    # By default a quoted line break splits the record and shifts its columns.
    assert read_csv(spark, path).count() == 3
    whole = read_csv(spark, path, MULTILINE)
    assert dict(whole.dtypes)["zip"] == "int"
    assert [r["text"] for r in whole.orderBy("id").collect()] == ["two\nlines", 'said "no"']


def test_explicit_schema_and_reader_options(spark, folder):
    options = IngestOptions(
        layer="raw2",
        reader=MULTILINE,
        schemas={"sellers": "seller_id string, zip string, price decimal(10,2)"},
    )
    ingest_folder(spark, str(folder), options)
    assert dict(spark.table("raw2.sellers").dtypes)["zip"] == "string"
    assert spark.table("raw2.reviews").count() == 2


DAMAGED = 'id,qty,price\n1,2,3.5\n2,x,4.5\n3,1\n4,5,6.5,7\n"5",6,7.5\n'


@pytest.fixture()
def damaged(tmp_path):
    (tmp_path / "olist_lines_dataset.csv").write_text(DAMAGED)
    (tmp_path / "whole.csv").write_text("id,qty,price\n1,2,3.5\n")
    (tmp_path / "empty.csv").write_text("")
    return str(tmp_path)


SCHEMA = "id int, qty int, price double"


def test_damaged_records_go_to_quarantine(spark, damaged):
    options = IngestOptions(layer="raw4", quarantine=True, schemas={"lines": SCHEMA, "whole": SCHEMA})
    found = {r.source_file: r for r in ingest_folder(spark, damaged, options, run_id="run-4")}
    lines, whole = found["olist_lines_dataset.csv"], found["whole.csv"]
    assert (lines.status, lines.rows_read, lines.rows_loaded, lines.rows_quarantined) == (SUCCESS, 5, 2, 3)
    assert (whole.status, whole.rows_read, whole.rows_quarantined, whole.error_message) == (SUCCESS, 1, 0, None)
    assert found["empty.csv"].status == FAILED
    assert [tuple(r) for r in spark.table("raw4.lines").orderBy("id").collect()] == [(1, 2, 3.5), (5, 6, 7.5)]
    aside = spark.table("raw4.lines__quarantine").orderBy("id").collect()
    assert [r[CORRUPT] for r in aside] == ["2,x,4.5", "3,1", "4,5,6.5,7"]
    assert {(r.run_id, r.source_file) for r in aside} == {("run-4", "olist_lines_dataset.csv")}
    assert spark.table("raw4.whole__quarantine").count() == 0
    note = audit_log(spark, "raw4.ingestion_audit").filter("source_file LIKE '%lines%'").first()
    assert note["rows_read"] == 5 and "3 of 5" in note["error_message"]

    # by default they stay, with NULLs for what could not be read
    kept = ingest_folder(spark, damaged, IngestOptions(layer="raw5", schemas={"lines": SCHEMA}))
    assert {r.source_file: r.rows_read for r in kept}["olist_lines_dataset.csv"] == 5
    assert spark.table("raw5.lines").filter("price IS NULL OR qty IS NULL").count() == 2


def test_quarantine_with_inferred_types(spark, damaged):
    found = ingest_folder(spark, damaged, IngestOptions(layer="raw6", quarantine=True))
    lines = next(r for r in found if "lines" in r.source_file)
    # a column with a word in it is text, so only the number of fields tells
    assert (lines.rows_read, lines.rows_loaded, lines.rows_quarantined) == (5, 3, 2)


def test_a_failing_load_keeps_the_table(spark, damaged):
    options = IngestOptions(layer="raw7", replace_schema=False)
    ingest_folder(spark, damaged, options)
    assert spark.table("raw7.whole").count() == 1
    with open(f"{damaged}/whole.csv", "w") as file:
        file.write("id,qty,price\n1,2,many\n3,4,few\n")
    again = {r.source_file: r for r in ingest_folder(spark, damaged, options)}["whole.csv"]
    assert again.status == FAILED and "incompatible price" in again.error_message
    assert [tuple(r) for r in spark.table("raw7.whole").collect()] == [(1, 2, 3.5)]
    replaced = ingest_folder(spark, damaged, IngestOptions(layer="raw7"))
    assert {r.source_file: r.status for r in replaced}["whole.csv"] == SUCCESS
    assert dict(spark.table("raw7.whole").dtypes)["price"] == "string"


def test_listing_uses_no_private_handles(spark, damaged):
    import inspect

    from tallymart.sources import ingest

    assert "_jvm" not in inspect.getsource(ingest) and "_jsc" not in inspect.getsource(ingest)
    assert len(list_csv_files(spark, damaged)) == 3


def test_header_only_and_ambiguous_files(spark, tmp_path):
    (tmp_path / "nothing_yet.csv").write_text("a,b\n")
    (tmp_path / "twice.csv").write_text("a,a\n1,2\n")
    (tmp_path / "archive.csv").mkdir()
    results = ingest_folder(spark, str(tmp_path), IngestOptions(layer="raw3"))
    found = {r.source_file: (r.status, r.rows_read) for r in results}
    assert found["nothing_yet.csv"] == (SUCCESS, 0)
    assert spark.table("raw3.nothing_yet").columns == ["a", "b"]
    assert set(found) == {"nothing_yet.csv", "twice.csv"}
