"""Cases of the third findings file, taken up a second time, on rows of their own."""

import pytest
from ferrolite.functions import ordered
from ferrolite.operators import models


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("most", [0, 10])
def test_a_models_predictions_do_not_meet_in_one_task(spark, monkeypatch, most):
    monkeypatch.setattr(models, "SENT_WEIGHTS", most)
    preds = spark.createDataFrame([(k, m, p) for k in range(40) for m, p in (("a", 1.0 * k), ("b", 2.0 * k), (None, 5.0), ("c", 7.0))], "id long, model string, p double")
    weights = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 1.0), (None, 4.0)], "model string, weight double")
    got = models.weighted_ensemble(preds, weights, "id")
    assert {tuple(x) for x in got.collect()} == {(k, round((k + 3 * 2 * k) / 8, 6)) for k in range(40)}
    if most:
        assert "BroadcastHashJoin" in plan(got) and "SortMergeJoin" not in plan(got)


@pytest.mark.parametrize("order", [["n", "name", "x"], ["-n", "-name", "-x"], ["-n", "name", "-x"]])
def test_many_cells_keep_the_order_and_a_small_plan(spark, order):
    """The search for a row's cell wrote each step into the next one a dozen times: 50 bounds kept the optimizer busy for minutes."""
    rows = [(None if i % 9 == 0 else i % 23, None if i % 7 == 0 else f"s{i * 37 % 101:03d}", float(i)) for i in range(6000)]
    df = spark.createDataFrame(rows, "n int, name string, x double")
    cut = ordered.cutter(df, ordered.keys_of(order), 300)
    held = cut(df)
    steps = str(held._jdf.queryExecution().optimizedPlan().toString()).count("<=")
    assert steps < 2 * 512
    got = held.select("n", "name", "x", "__cell").collect()

    key = [(c.lstrip("-"), c.startswith("-")) for c in order]
    null = {"n": -1, "name": ""}
    for c, down in reversed(key):
        got = sorted(got, key=lambda r: null[c] if r[c] is None else r[c], reverse=down)
    cells = [r["__cell"] for r in got]
    assert cells == sorted(cells) and len(set(cells)) > 200
    numbered = ordered.number_rows(df, order).collect()
    assert [r["x"] for r in sorted(numbered, key=lambda r: r["pos"])] == [r["x"] for r in got]
