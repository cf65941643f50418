"""Ordered cells under hard keys, and results outside the shared tables."""

import pytest
from pyspark.sql import functions as F

from ferrolite.functions import ordered
from ferrolite.functions.cols import skew_safe_lookup
from ferrolite.operators import levels, neighbors, profile, shape, text
from ferrolite.sources import readers, writers


@pytest.mark.parametrize("order", [["name"], ["-n", "name"], ["same", "-name"], ["amount", "name"]])
def test_no_cell_holds_much_more_than_its_share(spark, order):
    df = spark.range(40_000).select(F.concat(F.lit("Customer#with-a-long-prefix-"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("name"),
                                    F.lit(1).alias("n"), F.lit("x").alias("same"), (F.floor(F.col("id") / 20_000) + F.lit(2**60)).cast("decimal(38,0)").alias("amount"))
    sizes = [r["count"] for r in ordered.with_cells(df, order, 16).groupBy("__cell").count().collect()]
    assert sum(sizes) == 40_000 and len(sizes) >= 14
    assert max(sizes) <= 3 * 40_000 / 16


def test_cells_follow_the_rows(spark):
    assert ordered.cells_for(10, spark) == 1
    assert ordered.cells_for(10**11, spark) == -(-(10**11) // ordered.ROWS_PER_CELL)


def test_codes_of_values_with_a_common_prefix(spark):
    df = spark.range(3000).select(F.format_string("Customer#%09d", F.col("id") % 1500).alias("c"))
    got = {r["level"]: r["code"] for r in levels.level_table(df, "c", "value").collect()}
    assert got == {f"Customer#{i:09d}": i for i in range(1500)}


def test_null_labels_and_values_do_not_count(spark):
    rows = [("a", "x"), ("a", "x"), ("b", "y"), ("b", "y"), (None, "x"), (None, "y"), ("a", None), ("b", None)]
    df = spark.createDataFrame(rows, "f string, y string")
    got = profile.chi_square(df, ["f"], "y").first()
    assert (got["statistic"], got["degrees"]) == (4.0, 1)
    assert profile.cramers_v(df, "y", ["f"]).first()["cramers_v"] == 1.0


def test_map_entries_have_slots_of_their_own(spark):
    rows = [({"a": "x", "b": "y"},), ({"a": "x", "b": "z"},), ({"a": "x", "n": "2.5"},), ({"n": "4"},), ({"a": None},), (None,)]
    out = shape.dict_features(spark.createDataFrame(rows, "bag map<string,string>"), "bag", 512)
    v = [r[0] for r in out.select(shape.vector_to_array("features")).collect()]
    shared = [i for i in range(512) if v[0][i] and v[1][i]]
    assert len(shared) == 1 and v[2][shared[0]] == 1.0
    assert sum(v[2]) == 3.5 and sum(v[3]) == 4.0 and sum(v[4]) == sum(v[5]) == 0


def test_accents_of_any_plane(spark):
    got = text.strip_accents(spark.createDataFrame([("Việt tiếng é é Ώ ñ",)], "t string"), "t").first()["t"]
    assert got == "Viet tieng e e Ω n"


def test_first_line_goes_whatever_it_says(spark, tmp_path):
    (tmp_path / "a.txt").write_text("No||Body\n1||x||y\nID||Text\n")
    (tmp_path / "b.txt").write_text('other\n2||"q" and \\\n')
    got = sorted(tuple(r) for r in readers.read_delimited(spark, str(tmp_path), ["ID", "Text"]).collect())
    assert got == [("1", "x||y"), ("2", '"q" and \\'), ("ID", "Text")]


def test_line_breaks_are_refused(spark, tmp_path):
    df = spark.createDataFrame([("1", "a\nb")], "k string, v string")
    with pytest.raises(Exception, match="line break"):
        writers.write_delimited(df, str(tmp_path / "x"))
    writers.write_delimited(df, str(tmp_path / "y"), header="h", line_breaks="space")
    assert [tuple(r) for r in readers.read_delimited(spark, str(tmp_path / "y"), ["k", "v"]).collect()] == [("1", "a b")]


def test_hot_key_is_sliced_by_its_own_size(spark):
    left = spark.range(6000).select((F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id"))).alias("k"), F.col("id").alias("x"))
    right = left.select("k").distinct().withColumn("y", F.col("k") * 10)
    got = skew_safe_lookup(left, right, "k", "x", slice_rows=100)
    assert got.count() == 6000 and got.where("y <> k * 10").count() == 0


def test_spearman_plan_grows_with_the_columns_only(spark):
    df = spark.range(200).select(*[F.pmod(F.xxhash64("id", F.lit(i)), F.lit(50)).alias(f"c{i}") for i in range(6)])
    plan = profile.corr_matrix(df, df.columns, "spearman")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 200") <= 20


def test_listed_classes_only(spark):
    rows = [(1, [0.0, 1.0], "a"), (2, [0.0, 2.0], "b"), (3, [0.0, 3.0], "c")]
    df = spark.createDataFrame(rows, "id long, v array<double>, l string")
    got = {r[0]: tuple(r)[1:] for r in neighbors.matches_per_class(df, df.where("id <> 1"), "id", "v", "l", ["a", "c"]).collect()}
    assert got == {1: (None, 3), 2: (None, 3), 3: (None, 3)}
