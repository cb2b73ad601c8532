"""Validation gate (V1-V11), restating the reference's cases."""

import pytest

from tessera.operators import validate as VA
from tessera.operators.validate import DataValidationError, profile, quarantine, validate


def _df(spark, rows):
    return spark.createDataFrame(rows, "text string, label int")


def test_balanced_passes(spark):
    r, warnings = validate(_df(spark, [("good", 1), ("bad", 0), ("fine", 1), ("poor", 0)]))
    assert not warnings and [tuple(c) for c in r.classes] == [(0, 2, 0.5), (1, 2, 0.5)]
    assert (r.len_min, r.len_median, r.len_max, r.len_mean) == (3, 4, 4, 3.75)


def test_null_text_fails(spark):
    with pytest.raises(DataValidationError, match="null"):
        validate(_df(spark, [(None, 1), ("bad", 0)]))


def test_blank_text_fails(spark):
    with pytest.raises(DataValidationError, match="empty text"):
        validate(_df(spark, [("   ", 1), ("bad", 0)]))


def test_imbalance_warns(spark):
    _, warnings = validate(_df(spark, [("a", 1), ("b", 1), ("c", 1), ("d", 1), ("e", 0)]))
    assert any("60/40" in w for w in warnings)


def test_duplicates_warn(spark):
    _, warnings = validate(_df(spark, [("a", 1), ("a", 1), ("b", 0), ("b", 0)]))
    assert any("2 duplicated" in w for w in warnings)


def test_non_binary_labels_fail(spark):
    with pytest.raises(DataValidationError, match="binary"):
        validate(_df(spark, [("a", 1), ("b", 2)]))


def test_missing_columns(spark):
    df = spark.createDataFrame([("a",)], "sentence string")
    with pytest.raises(DataValidationError, match="Missing required columns"):
        validate(df)


def test_report_duplicates_over_all_columns(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (3, "b", 0), (3, "b", 0)],
                               "doc_id long, text string, label int")
    r, warnings = validate(df)
    assert any("2 duplicated" in w for w in warnings)  # (text, label) copies
    assert (r.duplicate_count, r.duplicate_rows) == (2, 1)


def test_every_bad_label_is_named(spark):
    with pytest.raises(DataValidationError) as e:
        validate(_df(spark, [(f"t{i}", i) for i in range(60)]))
    assert str(list(range(60))) in str(e.value)


def test_empty_dataset_fails(spark):
    with pytest.raises(DataValidationError, match="empty"):
        validate(_df(spark, []))


def test_null_cells_count_all_columns(spark):
    df = spark.createDataFrame([(None, "a", 1), (2, "b", 0), (None, "c", 1), (4, "d", 0)], "doc_id long, text string, label int")
    r, _ = validate(df)
    assert (r.null_count, r.null_cells) == (0, 2)


def test_quarantine_splits_off_what_the_gate_stops_at(spark):
    df = _df(spark, [("a", 1), (None, 1), ("  ", 0), ("b", None), ("c", 7), (None, None), ("d", 0)])
    good, bad = quarantine(df)
    assert sorted(r.text for r in good.collect()) == ["a", "d"]
    assert sorted(map(tuple, (r.reasons for r in bad.collect()))) == [
        ("empty text",), ("label not 0 or 1",), ("null label",), ("null text",), ("null text", "null label")]
    validate(good)


def test_gate_is_one_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("text", "cast(n_chars % 2 as int) as label")
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    assert plan(VA._grouped(df, "text", "label")).count("FileScan parquet") == 1
    assert "documents.parquet" not in plan(profile(df))  # all else is read from that table


def test_a_report_lists_a_bounded_number_of_labels(spark, monkeypatch):
    monkeypatch.setattr(VA, "LISTED", 5)
    df = spark.createDataFrame([(f"t{i}", f"label {i:02d}") for i in range(12)], "text string, label string")
    p = profile(df.withColumn("label", df.label.substr(7, 2).cast("int"))).first()
    assert p.n_labels == 12 and [c.label for c in p.classes] == list(range(5))
    with pytest.raises(DataValidationError, match=r"\[0, 1, 2, 3, 4\] and 7 more"):
        validate(df.withColumn("label", df.label.substr(7, 2).cast("int")))


def test_quantiles_equal_numpy(spark):
    import numpy as np
    from pyspark.sql import functions as F
    from tessera.operators.quantiles import quantiles
    rng = np.random.default_rng(1)
    qs = {"a": 0.0, "b": 0.05, "c": 0.5, "d": 0.951, "e": 1.0}
    for x in (rng.standard_normal(997), np.round(rng.gamma(1, 3, 1200)), np.where(rng.random(1000) < 0.6, 7.0, rng.random(1000)),
              np.array([3.0]), np.array([1.0, 2.0]), rng.standard_normal(500) * 10.0 ** rng.integers(-200, 200, 500)):
        df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "v double").repartition(5)
        got = quantiles(df, F.col("v"), qs).first()
        assert np.allclose([got[n] for n in qs], np.quantile(x, list(qs.values())), rtol=1e-12, atol=0)
    w = rng.integers(0, 5, 300)
    x = rng.standard_normal(300)
    df = spark.createDataFrame([(float(v), int(n)) for v, n in zip(x, w)], "v double, n long")
    got = quantiles(df, F.col("v"), qs, F.col("n")).first()
    assert np.allclose([got[n] for n in qs], np.quantile(np.repeat(x, w), list(qs.values())))
    assert quantiles(df.limit(0), F.col("v"), qs).first().asDict() == dict.fromkeys(qs)


def test_quantiles_hold_no_value_map(spark):
    from pyspark.sql import functions as F
    from tessera.operators.quantiles import quantiles
    plan = quantiles(spark.range(1000).select(F.col("id").cast("double").alias("v")), F.col("v"), {"m": 0.5})
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "CartesianProduct" not in plan


def test_absent_columns_break_their_not_null_rules(spark):
    from tessera.schemas import check_constraints, split_valid
    rows = spark.createDataFrame([("a",), (None,)], "id string")
    bad = [set(r.violations) for r in check_constraints(rows, "predictions").orderBy("id").collect()]
    assert "confidence:not_null" in bad[1] and "input_text_hash:not_null" in bad[1] and "id:not_null" not in bad[1]
    assert not any("varchar" in v or "numeric" in v for r in bad for v in r)
    good, wrong = split_valid(rows, "predictions")
    assert good.count() == 0 and wrong.count() == 2


def test_softmax_of_one_pass(spark):
    import numpy as np
    from tessera.functions import mathx as MX
    rows = [([1.0, 3.0, 3.0],), ([-1000.0, 1000.0],), ([0.5],), ([],), (None,)]
    df = spark.createDataFrame(rows, "s array<double>")
    i, p = MX.softmax_argmax("s")
    got = [tuple(r) for r in df.select(i.alias("i"), p.alias("p"), MX.softmax("s").alias("all")).collect()]
    for (s,), (k, prob, every) in zip(rows, got):
        if s:
            e = np.exp(np.array(s) - max(s))
            assert k == int(np.argmax(s)) and np.isclose(prob, (e / e.sum())[k]) and np.allclose(every, e / e.sum())
        else:
            assert prob is None and not every
