import pytest
from helpers import actions, rows
from pyspark.sql import functions as F

from footfall.operators import areas, categories, skew

CITIES = "city_id bigint, city_name string, area string"
PRODUCTS = "product_id bigint, product_name string, extend_info string"


def test_area_products(spark):
    clicks = [(1, 7), (1, 7), (12, 7), (2, 7), (2, 8), (1, 9), (1, 10), (1, 11), (99, 7), (1, None), (2, 404)]
    log = actions(spark, [{"city_id": city, "click_product_id": product} for city, product in clicks])
    cities = spark.createDataFrame([(1, "x", "华北"), (12, "x", "华北"), (2, "y", "华中"), (3, "z", "别处")], CITIES)
    products = spark.createDataFrame(
        [(n, f"p{n}", '{"product_status": %d}' % (n % 2)) for n in (7, 8, 9)]
        + [(10, "p10", None), (11, "p11", "bad"), (50, "p50", "{}")],
        PRODUCTS,
    )
    basic = areas.click_product_basic(areas.click_city_product(log), cities)
    assert basic.count() == 9
    by_area = areas.area_product_clicks(areas.click_city_product(log), cities)
    assert rows(by_area.where("product_id = 7")) == [("华中", 7, 1, "2:y"), ("华北", 7, 3, "12:x,1:x")]
    top = areas.area_top_products(areas.area_full_product_clicks(by_area, products))
    assert rows(top.select("area", "area_level", "product_id", "click_count", "product_status")) == [
        ("华中", "B级", 7, 1, "第三方"),
        ("华中", "B级", 8, 1, "自营"),
        ("华北", "A级", 10, 1, "第三方"),
        ("华北", "A级", 7, 3, "第三方"),
        ("华北", "A级", 9, 1, "第三方"),
    ]


def test_area_levels(spark):
    names = ["华北", "华东", "华南", "华中", "西北", "西南", "东北", None]
    df = spark.createDataFrame([(name,) for name in names], "area string")
    levels = [row[0] for row in df.select(areas.area_level()).collect()]
    assert levels == ["A级", "A级", "B级", "B级", "C级", "C级", "D级", "D级"]


@pytest.fixture(scope="module")
def left(spark):
    # Key 0 holds a third of the rows.
    return spark.range(300).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40).alias("k"),
        F.col("id").alias("v"),
    )


@pytest.fixture(scope="module")
def right(spark):
    return spark.range(45).select((F.col("id") % 42).alias("k"), F.col("id").alias("w"))


@pytest.mark.parametrize("rows_per_part, row_id", [(1, None), (3, "v"), (10, None), (50, "v"), (1000, None)])
def test_skew_join_equals_join(left, right, rows_per_part, row_id):
    assert rows(skew.skew_join(left, right, "k", rows_per_part, row_id)) == rows(left.join(right, "k"))


def test_parts_follow_the_sizes_of_keys(spark):
    """40 hot keys of 1,000 to 40,000 rows and 2,000 small ones: no part is twice as large as asked for."""
    sizes = {key: 1000 * (key + 1) for key in range(40)} | {key: 2 for key in range(100, 2100)}
    table = spark.createDataFrame(list(sizes.items()), "k int, n int")
    left = table.select("k", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("v")).repartition(4, "v")
    parts = skew.key_parts(left, "k", 2000)
    assert {row.k: row.parts for row in parts.collect()} == {key: -(-n // 2000) for key, n in sizes.items() if n > 2000}
    for row_id in ("v", None):
        found = skew.dealt(left, parts, "k", row_id).groupBy("k", "__part").count().collect()
        assert max(row["count"] for row in found) <= 4000
        assert len(found) == sum(-(-n // 2000) for n in sizes.values())
        assert sum(row["count"] for row in found) == sum(sizes.values())


def test_equal_rows_of_a_hot_key_are_spread(spark):
    """All left rows are equal; the salt is read from the plan's exchange key by the partitions that have rows."""
    left = spark.range(1000).select(F.lit(1).alias("k"), F.lit("x").alias("v"))
    right = spark.createDataFrame([(1, "y")], "k int, w string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        joined = skew.skew_join(left, right, "k", 63)
        used = joined.select(F.spark_partition_id().alias("p")).distinct().count()
        assert joined.count() == 1000
    finally:
        for name, value in (("adaptive.enabled", "true"), ("autoBroadcastJoinThreshold", "10m"), ("shuffle.partitions", "4")):
            spark.conf.set(f"spark.sql.{name}", value)
    assert used >= 10


def test_skew_join_keeps_columns(left, right):
    assert skew.skew_join(left, right, "k").dtypes == left.join(right, "k").dtypes


def test_hot_keys(left):
    first = skew.hot_keys(left, "k", 1).collect()
    assert [row.k for row in first] == [0]
    assert skew.hot_keys(left, "k", 1).collect() == first
    assert [tuple(row) for row in skew.hot_keys(left, "k", 2).collect()][0] == (0, left.where("k = 0").count())


def test_hot_keys_of_equal_rows(left):
    """A frame of the key alone: half of the rows are one value."""
    for seed in range(5):
        keys = left.sparkSession.range(400).select(F.when(F.col("id") % 2 == 0, seed).otherwise(F.col("id") + 1000).alias("k"))
        assert [tuple(row) for row in skew.hot_keys(keys, "k").collect()] == [(seed, 200)]


def _no_full_count(monkeypatch):
    def fail(*_):
        raise AssertionError("all keys were counted")

    monkeypatch.setattr(skew, "hot_keys", fail)


def test_heavy_keys_that_stand_out_are_found_by_the_summary(spark, monkeypatch):
    """Three heavy keys among 60,000 others, more than the summary keeps; ties go to the smaller key."""
    heavy = F.when(F.col("id") % 10 < 2, -1).when(F.col("id") % 10 < 3, -3).when(F.col("id") % 10 < 4, -2)
    keys = spark.range(100_000).select(F.coalesce(heavy, F.col("id")).alias("k"))
    expected = [tuple(row) for row in skew.hot_keys(keys, "k", 3).collect()]
    assert expected == [(-1, 20_000), (-3, 10_000), (-2, 10_000)]
    _no_full_count(monkeypatch)
    assert [tuple(row) for row in skew.heavy_keys(keys, "k", 3, kept=1024).collect()] == expected


def test_heavy_keys_of_few_values(spark, monkeypatch):
    keys = spark.range(1000).select(F.concat(F.lit("k"), F.floor(F.sqrt("id"))).alias("k"))
    expected = [tuple(row) for row in skew.hot_keys(keys, "k", 4).collect()]
    assert [tuple(row) for row in skew.heavy_keys(keys, "k", 4).collect()] == expected
    # Fewer keys than asked for, and none at all.
    assert skew.heavy_keys(keys, "k", 40).count() == 32
    assert skew.heavy_keys(keys.where("k IS NULL"), "k", 3).count() == 0


def test_heavy_keys_of_uniform_data_are_counted(spark):
    keys = spark.range(30_000).select((F.col("id") % 15_000).alias("k"))
    assert [tuple(row) for row in skew.heavy_keys(keys, "k", 3, kept=64).collect()] == [(0, 2), (1, 2), (2, 2)]


@pytest.mark.parametrize("salts", [1, 3, 10])
def test_salted_count_equals_count(left, salts):
    plain = left.groupBy("k").agg(F.count("*").alias("n"))
    assert rows(skew.salted_count(left.repartition(7), "k", salts)) == rows(plain)


def test_salted_clicks_equal_click_counts(spark):
    log = actions(spark, [{"click_category_id": n % 3} for n in range(20)] + [{}])
    clicks = log.select(F.col("click_category_id").alias("category_id")).where("category_id IS NOT NULL")
    assert rows(skew.salted_count(clicks, "category_id")) == rows(categories.category_click_counts(log))
