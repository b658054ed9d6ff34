"""Labels of windows are rounded as in C."""

from strandline.operators import reports


def test_labels_are_rounded_by_the_exact_value(spark):
    ratios = [0.0625, 0.1875, 0.0005, 0.2675, 1.0005, 2.5]
    df = spark.createDataFrame([("g", i, i, f"W{i}", x, "Low") for i, x in enumerate(ratios)], "gene string, w_start long, w_end long, window_id string, ratio double, status string")
    text = reports.window_labels(df).first()["labels"]
    assert text.split("\n")[1:] == [f"W{i}: {x:.3f}" for i, x in enumerate(ratios)]
