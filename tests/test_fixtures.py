"""The fixtures reproduce the properties FIXTURES.md section 4 records for sf0.01."""

from pyspark.sql import functions as F

from ledgerlint.sources.fixtures import FixtureSet

SF = "/root/testdata/sf0.01"


def test_fact_fixture_matches_the_recorded_counts(spark):
    f = FixtureSet.of(spark, SF)
    fact = f.fact_sellout()
    assert fact.count() == 60000
    assert fact.select("unique_id").distinct().count() == 45832
    products = f.product().select("product_code").distinct()
    assert fact.join(products, "product_code", "left_anti").count() == 6571
    dup = f.product().groupBy("product_code").count().filter(F.col("count") > 1).select("product_code")
    assert fact.join(dup, "product_code", "left_semi").count() == 6184


def test_a_fact_with_a_split_for_each_core_is_written_without_a_shuffle(spark, tmp_path):
    import shutil

    cores = spark.sparkContext.defaultParallelism
    small, d = "/root/testdata/sf0.001", str(tmp_path / "many")
    shutil.copytree(small, d, ignore=shutil.ignore_patterns("lineitem.parquet"))
    spark.read.parquet(f"{small}/lineitem.parquet").repartition(3 * cores).write.parquet(f"{d}/lineitem.parquet")
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "32k")
    try:
        many = FixtureSet(spark, d)
        assert spark.read.parquet(f"{d}/lineitem.parquet").rdd.getNumPartitions() >= 3 * cores
        assert len(many.fact_sellout().inputFiles()) >= 3 * cores  # a file a split; a shuffle would leave one a core
        # the projections of the fact are not written again
        for fixture in (many.fact_sellthrough, many.sku_traffic, many.amz):
            assert set(fixture().inputFiles()) == set(many.fact_sellout().inputFiles())
        one = FixtureSet(spark, small, materialize=False).fact_sellout()
        assert many.fact_sellout().exceptAll(one).count() == 0 and many.fact_sellout().count() == one.count()
        assert many.stock().count() == FixtureSet(spark, small, materialize=False).stock().count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_further_set_leaves_the_files_of_the_first(spark, sf_small):
    """Two sets of one folder in one session: the first still reads what it has written."""
    first = FixtureSet(spark, sf_small).pos()
    second = FixtureSet(spark, sf_small).pos()
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, second.collect())) != []
