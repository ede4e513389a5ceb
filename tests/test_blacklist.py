import pytest

from demandlab.operators.blacklist import flag_listed, not_listed

PROBES = [(1, "A"), (2, "A"), (None, "A"), (None, "B"), (3, "B")]


def kept(spark, rows_of, make_tables, entries):
    tables = make_tables(blacklist=[(element, "product_id", region) for element, region in entries])
    df = spark.createDataFrame(PROBES, "product_id bigint, region_code string")
    result = rows_of(not_listed(df, tables.blacklist, "product_id", "product_id"))
    flagged = flag_listed(df, tables.blacklist, "product_id", "product_id", "listed")
    assert rows_of(flagged.filter("NOT listed").drop("listed")) == result
    assert flagged.count() == len(PROBES)
    df.createOrReplaceTempView("probes")
    tables.blacklist.createOrReplaceTempView("entries")
    by_sql = spark.sql(
        "SELECT * FROM probes p WHERE product_id NOT IN "
        "(SELECT element_id FROM entries e WHERE e.type = 'product_id' AND e.region_code = p.region_code)"
    )
    assert rows_of(by_sql) == result
    return result


def test_empty_list_keeps_null_ids(spark, rows_of, make_tables):
    assert kept(spark, rows_of, make_tables, [(1, "A")]) == [(None, "B"), (2, "A"), (3, "B")]


def test_null_entry_excludes_the_region(spark, rows_of, make_tables):
    assert kept(spark, rows_of, make_tables, [(1, "A"), (None, "A")]) == [(None, "B"), (3, "B")]


def test_repeated_entries_do_not_multiply(spark, rows_of, make_tables):
    assert kept(spark, rows_of, make_tables, [(3, "B"), (3, "B")]) == [(None, "A"), (1, "A"), (2, "A")]


@pytest.mark.parametrize("kind", ["user_id", "order_id"])
def test_other_kinds_do_not_count(spark, rows_of, make_tables, kind):
    tables = make_tables(blacklist=[(1, kind, "A")])
    df = spark.createDataFrame(PROBES, "product_id bigint, region_code string")
    assert not_listed(df, tables.blacklist, "product_id", "product_id").count() == len(PROBES)
