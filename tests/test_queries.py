"""Every document-structure query against its DuckDB text."""

import pytest

import __spark_entry__ as entry
from oracle import SF, check

NAMES = sorted(n for module in entry.PLANS for n in module.QUERIES)


#: Running states and similarities that SQL can't express; test_grouped.py, test_running.py, test_contents.py, test_markup.py and test_books.py hold them against brute force.
NO_SQL = {"w3_rtl_reading_order", "w6_heading_levels", "w14_list_indent", "w17_merge_math_lines", "w21_lesson_numbers", "t29_fuzz_ratio", "j25_check_rules", "c2_assign_numbers", "c3_decorative_toc", "c4_contents_rows", "r3_reconstruct_table", "m3_document_markdown", "m3_page_markdown", "w7_ignored_headers"}


def test_every_query_has_an_oracle():
    assert {n for n in NAMES if n not in entry.oracle_sql()} == NO_SQL


@pytest.mark.parametrize("name", sorted(set(NAMES) - NO_SQL))
def test_query(spark, name):
    check(spark, name, entry.queries()[name], entry.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(NO_SQL))
def test_rows(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
