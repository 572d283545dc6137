from tradeweave.plans import views as v


def test_products_of_unlisted_categories_are_kept(spark, tmp_path):
    rows = [(1, "a", "B#1", "PROMO", 1, 1.0), (2, "b", "B#2", "UNLISTED", 2, 2.0), (3, "c", "B#3", None, 3, 3.0)]
    spark.createDataFrame(
        rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ).write.parquet(f"{tmp_path}/part.parquet")
    assert sum(df.count() for df in v.tables_b(spark, str(tmp_path))) == 3
    assert sum(df.count() for df in v.collections_a(spark, str(tmp_path)).values()) == 3
