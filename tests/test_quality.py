from tidewater.operators import check_quality, result_frame
from tidewater.spec import FieldSpec, QualitySpec


def _people(spark, rows):
    return spark.createDataFrame(rows, "id bigint, name string")


def test_pass(spark):
    r = check_quality(_people(spark, [(1, "a"), (2, "b")]), QualitySpec(min_row_count=1))
    assert r.passed and r.row_count == 2 and r.violations == []


def test_row_count_floor(spark):
    r = check_quality(_people(spark, [(1, "a")]), QualitySpec(min_row_count=5))
    assert not r.passed
    assert [(v.check, v.detail) for v in r.violations] == [("min_row_count", "row_count=1 < min_row_count=5")]


def test_null_fraction(spark):
    r = check_quality(_people(spark, [(1, None), (2, None), (3, "c")]),
                      QualitySpec(max_null_fraction={"name": 0.1}))
    assert [(v.check, v.detail) for v in r.violations] == [
        ("max_null_fraction", "column=name null_fraction=0.6667 > max=0.1")]


def test_null_fraction_is_strict(spark):
    r = check_quality(_people(spark, [(1, None), (2, "b")]), QualitySpec(max_null_fraction={"name": 0.5}))
    assert r.passed


def test_nulls_skipped_on_empty(spark):
    r = check_quality(_people(spark, []), QualitySpec(max_null_fraction={"name": 0.0}))
    assert r.passed and r.row_count == 0


def test_schema_presence(spark):
    r = check_quality(spark.createDataFrame([(1,)], "id bigint"), QualitySpec(),
                      [FieldSpec("id", "int"), FieldSpec("missing_col", "string")])
    assert [(v.check, v.detail) for v in r.violations] == [
        ("schema_validation", "missing expected column 'missing_col'")]


def test_schema_type_level(spark):
    r = check_quality(spark.createDataFrame([(1,)], "id bigint"), QualitySpec(schema_level="type"),
                      [FieldSpec("id", "int")])
    assert [v.detail for v in r.violations] == ["column 'id' has type bigint, expected int"]


def test_null_limit_on_missing_column_is_a_schema_violation(spark):
    r = check_quality(_people(spark, [(1, "a")]), QualitySpec(max_null_fraction={"zz": 0.0}))
    assert [v.detail for v in r.violations] == ["missing expected column 'zz'"]


def test_disabled_still_counts(spark):
    r = check_quality(spark.createDataFrame([(1,)], "id bigint"), QualitySpec(enabled=False, min_row_count=9))
    assert r.passed and r.row_count == 1


def test_order_and_result_frame(spark):
    df = _people(spark, [(1, None)])
    r = check_quality(df, QualitySpec(min_row_count=2, max_null_fraction={"name": 0.0}), [FieldSpec("zz", "int")])
    assert [v.check for v in r.violations] == ["min_row_count", "max_null_fraction", "schema_validation"]
    frame = result_frame(spark, "ds", r)
    assert frame.count() == 3 and frame.filter("passed").count() == 0


def test_profile_is_one_aggregate(spark):
    from tidewater.operators.quality import profile_columns

    df = _people(spark, [(1, None)])
    plan = df.agg(*profile_columns(df, QualitySpec(max_null_fraction={"name": 0.1, "id": 0.1}), "id"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1
