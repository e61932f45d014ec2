"""The classifier on a fixture whose features tell the classes apart, and on one whose features tell nothing."""

import random

from reelstat.plans import classify

ROW = "id long, label int, a double, b double"


def table(spark, n, telling):
    rng = random.Random(8)
    rows = []
    for k in range(n):
        label = int(rng.random() < 0.3)
        shift = 3.0 * label if telling else 0.0
        rows.append((k, label, rng.gauss(shift, 0.7), rng.gauss(-shift, 0.7)))
    return spark.createDataFrame(rows, ROW)


def counts(spark, telling):
    model, accuracy, data = classify.train_classifier(table(spark, 1500, telling), "label", ["id"])
    found = {(int(r["label"]), int(r["prediction"])): r["rows"] for r in classify.held_out_counts(model, data).collect()}
    right = sum(n for (label, guess), n in found.items() if label == guess)
    assert sum(found.values()) == data.where("held_out").count() and accuracy == right / sum(found.values())
    return found


def test_both_classes_are_found_where_features_tell(spark):
    found = counts(spark, True)
    for label in (0, 1):
        own = sum(n for (x, _), n in found.items() if x == label)
        assert own > 50 and found[label, label] >= 0.95 * own


def test_nothing_is_learned_from_nothing(spark):
    found = counts(spark, False)
    rare = sum(n for (label, _), n in found.items() if label == 1)
    assert found.get((1, 1), 0) <= 0.2 * rare  # the held-out rows are not those it learned from
