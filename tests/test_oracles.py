"""Queries beside their SQL in DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

from docloom.plans import catalog

SF = "/root/testdata/sf0.001"
NAMES = "repeated_lines line_reasons cleaned_markdown typed_lines page_titles section_numbers section_tree section_texts graph_nodes catalogue_matches block_types reading_edges page_measures markdown_blocks validation_report owner_names asof_quantities nearby_codes box_overlaps table_texts filled_tables numbered_records term_blocks block_roles".split()


def plain(v):
    return f"{v:.6g}" if isinstance(v, float) else str(v)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, name):
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    df = catalog.queries()[name](spark, SF)
    columns = sorted(df.columns)
    want = con.sql(catalog.oracle_sql()[name])
    at = [want.columns.index(c) for c in columns]
    assert sorted(want.columns) == columns
    assert sorted(tuple(plain(r[c]) for c in columns) for r in df.collect()) == sorted(tuple(plain(r[k]) for k in at) for r in want.fetchall())
