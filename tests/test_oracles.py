"""Every registered query of the library against its SQL."""

import pytest
from conftest import DATA, same

from textloom.plans import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    same(QUERIES[name](spark, DATA), duck.sql(ORACLE[name]))


def test_entry(spark):
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).columns == ["doc_id", "item_id", "n_shared", "n_passage", "score"]


@pytest.mark.parametrize("name", ["duplicate_groups", "inverted_index", "split_by_lang", "nested_books"])
def test_no_group_is_held_in_an_array(spark, name):
    assert "collect_" not in QUERIES[name](spark, DATA)._jdf.queryExecution().toString()
