"""Catalog tables and object listings."""

from tidemark.plans import catalog as cat
from tidemark.sources.objects import list_objects, table_has_files


def test_catalog_create_if_missing_and_insert(spark, tmp_root):
    db = "tm_test_" + tmp_root.rsplit("-", 1)[-1]
    current = spark.catalog.currentDatabase()
    cat.ensure_database(spark, db, f"{tmp_root}/db")
    try:
        assert spark.catalog.currentDatabase() == db
        name = f"{db}.sample_trades"
        cat.create_table_if_missing(spark, name, cat.SAMPLE_TRADES_SCHEMA, f"{tmp_root}/sample")
        cat.create_table_if_missing(spark, name, cat.SAMPLE_TRADES_SCHEMA, f"{tmp_root}/sample")  # no-op
        df = spark.createDataFrame([(1, "A", 1.5, 2.0, None)],
                                   "trade_id long, symbol string, price double, quantity double, trade_time timestamp")
        cat.insert(df, name, cat.SAMPLE_TRADES_SCHEMA)
        assert spark.table(name).count() == 1
        assert spark.table(name).schema == cat.SAMPLE_TRADES_SCHEMA
    finally:
        spark.catalog.setCurrentDatabase(current)


def test_list_objects_and_has_files(spark, tmp_root):
    spark.range(10).write.parquet(f"{tmp_root}/t")
    listing = list_objects(spark, f"{tmp_root}/t")
    assert listing.count() >= 1
    assert all(r.path.endswith(".parquet") for r in listing.collect())
    assert table_has_files(listing).first().has_files is True
    spark.range(0).write.json(f"{tmp_root}/empty")
    assert table_has_files(list_objects(spark, f"{tmp_root}/empty")).first().has_files is False
