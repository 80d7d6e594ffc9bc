import pytest

from tallyferry.functions.predicates import date_window
from tallyferry.specs import (
    JobSpec, ModeConflict, Settings, TableSpec, Window, check_mode, moves_in_one_piece,
)


def test_job_spec_maps_columns_to_tables():
    job = JobSpec.from_mapping(
        {
            "tables": ["mart.orders", "mart.notes", "people.users"],
            "partitioning_columns": ["mart.orders.id", "people.users.changed"],
        },
        date_cols={"people": "changed"},
        default_date_col="stamp",
        undated=["mart.notes"],
    )
    assert job.tables == (
        TableSpec("mart.orders", "id", "stamp"),
        TableSpec("mart.notes", None, None),
        TableSpec("people.users", "changed", "changed"),
    )


def test_target_name_defaults_to_source_name():
    assert TableSpec("a.b").target == "a.b"
    assert TableSpec("a.b", target_name="a.c").target == "a.c"


def test_sample_and_window_exclude_each_other():
    check_mode(10, None)
    check_mode(0, Window(start="2024-01-01 00:00:00"))
    with pytest.raises(ModeConflict):
        check_mode(10, Window(start="2024-01-01 00:00:00"))


def test_window_checks_its_text_and_knows_its_length():
    with pytest.raises(ValueError):
        Window(start="2024-01-01")
    assert not Window()
    assert Window(end="2024-01-01 00:00:00").weeks == -1
    assert Window("2024-01-01 00:00:00", "2024-01-08 12:00:00").weeks == pytest.approx(7.5 / 7)


@pytest.mark.parametrize(
    "size_mb, weeks, chunking, expected",
    [
        (50000, 10, False, True),
        (9999, -1, True, True),
        (10000, -1, True, False),
        (19999, 149.9, True, True),
        (19999, 150, True, False),
        (20000, 1, True, False),
        (15000, 0, True, False),
    ],
)
def test_chunk_or_not(size_mb, weeks, chunking, expected):
    assert moves_in_one_piece(size_mb, weeks, Settings(chunking=chunking)) is expected


def test_no_date_column_means_no_date_filter(table):
    orders = table("orders")
    window = Window("1996-01-01 00:00:00", "1996-02-01 00:00:00")
    assert orders.where(date_window(orders, None, window)).count() == orders.count()
    assert orders.where(date_window(orders, "o_orderdate", Window())).count() == orders.count()
