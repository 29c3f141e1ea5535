from ingot.functions.names import clean_name, sanitize_columns, sanitized_names, split_columns


def test_awkward_names_are_unique_and_keep_leading_underscore():
    names = ["a b", "a_b", "(x)", "=", "_run_id", "A B", "x\ty;z"]
    assert sanitized_names(names) == ["a_b", "a_b_2", "x", "col", "_run_id", "A_B_3", "x_y_z"]


def test_collision_with_existing_name_does_not_merge_columns(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `a_b` int")
    out = sanitize_columns(df)
    assert out.columns == ["a_b", "a_b_2"]
    assert out.first() == (1, 2)


def test_clean_name_edges():
    assert clean_name("  ") == "col"
    assert clean_name("__") == "__col"
    assert clean_name("_ingested at", keep_leading_underscore=False) == "ingested_at"


def test_split_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "_run_id int, a int, b int")
    assert split_columns(df) == (["_run_id"], ["a", "b"])
