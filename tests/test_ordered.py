"""The ordered primitives against plain windows, with hot values, hot groups and tiny blocks."""

import pytest
from pyspark.sql import Window, functions as F

from ferrolite.functions.ordered import framed, next_valid, number_rows, running, with_cells
from ferrolite.functions.quantiles import quantiles


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows in one group, half of the values equal, some nulls and NaNs."""
    df = spark.range(4000).withColumn("g", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 37).cast("string"))))
    v = (F.when(F.col("id") % 3 == 0, 7.0).when(F.col("id") % 41 == 0, None).when(F.col("id") % 43 == 0, float("nan"))
         .otherwise(F.pmod(F.xxhash64("id"), F.lit(1000)) / 10.0))
    return df.withColumn("v", v).withColumn("s", F.substring(F.md5(F.col("id").cast("string")), 1, 3)).repartition(7, "s")


ORDERS = [["v", "id"], ["-v", "id"], ["v", "-id"], ["s", "id"], ["id"], ["-id"]]


@pytest.mark.parametrize("order", ORDERS)
@pytest.mark.parametrize("group", [[], ["g"]])
def test_number_rows(skewed, order, group):
    keys = [F.col(k.lstrip("-")).desc_nulls_last() if k[0] == "-" else F.col(k).asc_nulls_first() for k in order]
    w = Window.partitionBy(*group).orderBy(*keys)
    got = number_rows(skewed, order, group, total="n").withColumn("want", F.row_number().over(w) - 1)
    got = got.withColumn("want_n", F.count(F.lit(1)).over(Window.partitionBy(*group)))
    assert got.count() == 4000
    assert got.where("pos <> want OR n <> want_n").count() == 0


@pytest.mark.parametrize("group", [[], ["g"]])
def test_running(skewed, group):
    df = skewed.withColumn("x", F.when(F.isnan("v"), None).otherwise(F.col("v")))
    w = Window.partitionBy(*group).orderBy(F.col("v").asc_nulls_first(), "id").rowsBetween(Window.unboundedPreceding, 0)
    got = running(df, ["v", "id"], group, sums={"total": F.lit(1)}, minima={"low": F.col("id")}, maxima={"high": F.col("id")})
    got = got.select("*", F.sum(F.lit(1)).over(w).alias("wt"), F.min("id").over(w).alias("wl"), F.max("id").over(w).alias("wh"))
    assert got.count() == 4000
    assert got.where("total <> wt OR low <> wl OR high <> wh").count() == 0


def test_next_valid(skewed):
    df = skewed.withColumn("x", F.when(F.col("id") % 97 == 0, F.col("id")))
    w = Window.partitionBy("g").orderBy("s", "id").rowsBetween(0, Window.unboundedFollowing)
    got = next_valid(df, ["s", "id"], "x", "filled", "g").withColumn("want", F.first("x", ignorenulls=True).over(w))
    assert got.where("NOT (filled <=> want)").count() == 0


@pytest.mark.parametrize("size", [3, 10, 4096])
def test_framed(skewed, size):
    pos = number_rows(skewed, ["id"], "g")
    got = framed(pos, "pos", lambda w: {"a": F.lag("id", 3).over(w), "b": F.lead("id", 2).over(w)}, "g", before=3, after=2, size=size)
    w = Window.partitionBy("g").orderBy("id")
    got = got.select("*", F.lag("id", 3).over(w).alias("wa"), F.lead("id", 2).over(w).alias("wb"))
    assert got.count() == 4000
    assert got.where("NOT (a <=> wa) OR NOT (b <=> wb)").count() == 0


def test_quantiles_match_percentile(skewed):
    df = skewed.where("NOT isnan(v)")
    got = {row["g"]: (row["a"], row["b"]) for row in quantiles(df, "v", {"a": 0.1, "b": 0.75}, "g").collect()}
    want = {row["g"]: (row["a"], row["b"]) for row in df.groupBy("g").agg(F.percentile("v", 0.1).alias("a"), F.percentile("v", 0.75).alias("b")).collect()}
    assert got.keys() == want.keys()
    for g in want:
        assert got[g] == pytest.approx(want[g])


def test_empty(spark):
    empty = spark.range(0).withColumn("v", F.lit(1.0))
    assert number_rows(empty, ["v", "id"]).count() == 0
    assert quantiles(empty, "v", {"m": 0.5}).count() == 0


def test_shuffle_partitions_do_not_matter(spark, skewed):
    def positions():
        return sorted((row["id"], row["pos"]) for row in number_rows(skewed, ["v", "id"], "g").select("id", "pos").collect())

    before = positions()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "31")
        assert positions() == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_back_fill_meets_each_row_once(spark):
    """A frame up to the end of its cell is gone through anew for each row: 150,000 rows of one cell took minutes."""
    df = spark.range(150_000).select("id", F.when(F.col("id") % 50_000 == 49_999, F.col("id")).alias("v"))
    back = next_valid(df.repartition(4), ["-id"], "v", "f")
    assert "unboundedfollowing" not in back._jdf.queryExecution().optimizedPlan().toString().lower()
    want = F.when(F.col("id") >= 49_999, F.floor((F.col("id") + 1) / 50_000) * 50_000 - 1)
    assert back.where(~F.col("f").eqNullSafe(want)).count() == 0
    ahead = next_valid(df, ["id"], "v", "f")
    assert ahead.where(F.col("f") != F.ceil((F.col("id") + 1) / 50_000) * 50_000 - 1).count() == 0 and ahead.where("f IS NULL").count() == 0


def test_cells_are_found_without_higher_order_functions(spark):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 9 > 0, F.pmod(F.xxhash64("id"), F.lit(40)).cast("double")).alias("x"))
    for n in (2, 3, 13):
        cells = with_cells(df, ["-x", "id"], n)
        assert "lambdafunction" not in cells._jdf.queryExecution().optimizedPlan().toString().lower()
        spans = cells.groupBy("__cell").agg(F.count(F.lit(1)).alias("n")).collect()
        assert sorted(r["__cell"] for r in spans) == list(range(n)) and max(r["n"] for r in spans) < 2 * 20_000 / n
        w = Window.orderBy(F.desc_nulls_last("x"), "id")
        assert cells.withColumn("before", F.lag("__cell").over(w)).where("before > __cell").count() == 0
