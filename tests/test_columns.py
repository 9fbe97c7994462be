from tests.helpers import rows
from trendframe.operators.columns import column_catalog, find_columns
from trendframe.schemas import TABLES


def test_tables_of_a_column(spark):
    columns, tables = column_catalog(spark, TABLES)
    assert columns.count() == sum(len(s.fields) for s in TABLES.values())
    assert rows(find_columns(columns, tables, "sdc_cod")) == [("sdc_cod", "calendar")]
    got = rows(find_columns(columns, tables, "ID_TERM%"), "tabela", "coluna")
    assert got == [
        ("id_term_date", "foreseen_progress"),
        ("id_term_activity", "real_progress"),
        ("id_term", "term"),
        ("id_term", "term_activity"),
        ("id_term_activity", "term_activity"),
        ("id_term", "term_input_data"),
    ]
    assert rows(find_columns(columns, tables, "ID_TERM%", case_sensitive=True)) == []


def test_columns_of_unknown_tables_are_left_out(spark):
    columns, tables = column_catalog(spark, TABLES)
    assert rows(find_columns(columns, tables.filter("table_name <> 'calendar'"), "sdc_cod")) == []
