"""Every core query: against its reference SQL where it has one, else that it runs and keeps its schema."""

import pytest

from factloom.plans import registry

from .oracle import DATA, agree

ORACLES = registry.oracles()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    agree(spark, registry.queries()[name], ORACLES[name])


# What each row of a query without reference SQL is known by; unit tests hold its values to plain loops.
KEYS = {
    "p2_found": "row_id field_name", "p5_found": "row_id", "d_sections_merged": "infocode section_id", "g_blocks": "infocode page_number row_no", "g_grids": "infocode page_number block_no", "g_edge_clusters": "infocode page_number",
    "c_pairs": "exp_id", "c_matching_sizes": "infocode", "c_backtest_docs": "doc", "c_backtest_causes": "kind cause", "c_compare_docs_contained": "doc", "c_compare_fields_contained": "field", "c_unpaired_contained": "kind id",
    "c_simple_compare_contained": "doc name", "c_strategies_matched": "strategy", "f_merged_tables": "doc table_no fact_no", "t_grids_classified": "table_id", "t_grid_facts": "table_id fact_no", "t_grid_metrics": "doc name start_date end_date metric",
    "r_records": "doc STARTDATE REPORTDATE PRODUCTNAME", "r_outcomes": "doc",
}
ONE_ROW = {"c_backtest_corpus", "c_compare_corpus_contained", "c_continuity_matched", "c_conflicts_matched"}


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(ORACLES)))
def test_keys(spark, name):
    """Rows are told apart by their key, which is never null; a roll-up has one row."""
    df = registry.queries()[name](spark, DATA).toPandas()
    if name in ONE_ROW:
        assert len(df) == 1 and not df.isna().to_numpy().all()
        return
    keys = KEYS[name].split(" ")
    assert not df[keys].isna().to_numpy().any() and not df.duplicated(keys).any()
    assert len(df) or name in ("t_grid_metrics", "c_pairs", "c_matching_sizes", "f_merged_tables")


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(registry.queries())
