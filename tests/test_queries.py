"""Every named query runs; those with SQL agree with DuckDB on every row."""

import oracle
import pytest

from riskframe.plans import catalog

con = None


def _con(sf_dir):
    global con
    con = con or oracle.connect(sf_dir)
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_agrees_with_sql(spark, sf_dir, name):
    found = oracle.differences(catalog.QUERIES[name](spark, sf_dir), catalog.ORACLES[name], _con(sf_dir))
    assert found == []


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_has_rows(spark, sf_dir, name):
    assert catalog.QUERIES[name](spark, sf_dir).limit(1).count() == 1


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


LARGE = (
    "sample_exact", "temporal_split_3way", "walk_forward", "fit_amount_stats", "model_matrix",
    "category_codes", "merge_identity", "roc_auc", "precision_recall_at_k", "numeric_profile",
    "drift_ks", "drift_psi", "graph_nodes", "graph_edges", "graph_features_2hop",
    "trailing_sequences", "sequence_features",
)


@pytest.mark.parametrize("name", LARGE)
def test_large_table_paths_agree_with_sql(spark, sf_dir, monkeypatch, name):
    """The same queries when every size limit is tiny: pivots, buckets, chunks, salted joins."""
    from riskframe.operators import ordering, sequences, skew

    monkeypatch.setattr(ordering, "LEAF_ROWS", 40)
    monkeypatch.setattr(ordering, "PIVOT_ROWS", 300)
    monkeypatch.setattr(skew, "PIVOT_ROWS", 300)
    monkeypatch.setattr(ordering, "SINGLE_BUCKET_ROWS", 20)
    monkeypatch.setattr(ordering, "STRING_BOUNDS", 8)
    monkeypatch.setattr(skew, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(sequences, "CHUNK_ROWS", 7)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = catalog.QUERIES[name](spark, sf_dir)
        assert oracle.differences(df, catalog.ORACLES[name], _con(sf_dir)) == []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
