"""Lookups whose answers are kept from run to run."""

from orbitlake.sources import catalog


def test_only_new_keys_are_looked_up(spark, tmp_path):
    asked = []

    def lookup(keys):
        asked.append(sorted(r["k"] for r in keys.collect()))
        return keys.where("k < 90").selectExpr("k", "concat('place ', k) AS place")

    path = str(tmp_path / "answers")
    table = lambda ks: spark.createDataFrame([(k,) for k in ks], "k int")
    first = catalog.kept_lookup(table([1, 2, 2]), ["k"], lookup, path)
    assert sorted((r["k"], r["place"]) for r in first.collect()) == [(1, "place 1"), (2, "place 2"), (2, "place 2")]
    again = catalog.kept_lookup(table([2, 3, 99]), ["k"], lookup, path)
    assert sorted(r["k"] for r in again.collect()) == [2, 3]
    assert catalog.kept_lookup(table([1, 3]), ["k"], lookup, path).count() == 2
    assert asked == [[1, 2], [3, 99], []]


def test_products_labels_and_reports(spark, tmp_path):
    from orbitlake.sources import files

    schema = spark.createDataFrame([], "k string, v double").schema
    path = str(tmp_path / "product")
    assert files.create_or_get(spark, path, schema).count() == 0
    files.append_features(spark.createDataFrame([("a", 1.0)], schema), path)
    assert files.create_or_get(spark, path, schema).collect() == [("a", 1.0)]
    arrays = spark.createDataFrame([([1.0, 2.0],)], "x array<double>")
    files.write_labelled(arrays, str(tmp_path / "arrays"), 1)
    files.write_labelled(arrays, str(tmp_path / "arrays"), 0)
    assert sorted((r["x"], r["label"]) for r in spark.read.parquet(str(tmp_path / "arrays")).collect()) == [([1.0, 2.0], 0), ([1.0, 2.0], 1)]
    report = spark.createDataFrame([("0", 0.99, 0.5, 0.75, 737658), ("weighted avg", 0.9, 0.8, 0.85, 758560)], "class string, precision double, recall double, f1 double, support long")
    files.write_report(report, str(tmp_path / "report"), {"epochs": 15, "batch": 128})
    text = [line for f in sorted((tmp_path / "report").glob("part*")) for line in f.read_text().splitlines()]
    assert text[:2] == ["epochs: 15", "batch: 128"] and text[3] == "class precision recall f1 support"
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "a.txt").write_text("Epochs: 15\n\n              precision    recall  f1-score   support\n\n  No Mine        0.99      1.00      0.99    737658\n    accuracy                           0.99    758560\n")
    got = files.read_reports(spark, str(tmp_path / "report")).drop("file").collect()
    assert sorted(map(tuple, got)) == [("0", 0.99, 0.5, 0.75, 737658), ("weighted_avg", 0.9, 0.8, 0.85, 758560)]
    assert [tuple(r) for r in files.read_reports(spark, str(tmp_path / "other")).collect()] == [("a.txt", "No Mine", 0.99, 1.0, 0.99, 737658)]
