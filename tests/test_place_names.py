from waymark.plans.report_queries import q35_bad_names


def test_every_name_of_a_place_is_tested(spark, tmp_path):
    rows = [("pl_a", "Q12", "Fine", ["Good", "<b>x</b>", None]), ("pl_b", "Fine", "a&amp;b", None), ("pl_c", None, None, ["y" * 61]), ("pl_d", "Fine", "Fine", []), ("pl_a", "Q12", "Fine", ["Good"])]
    spark.createDataFrame(rows, "place_id string, name_en string, name_local string, aliases array<string>").write.parquet(f"{tmp_path}/place.parquet")
    got = sorted(map(tuple, q35_bad_names(spark, str(tmp_path)).collect()))
    assert got == [("pl_a", "aliases", "<b>x</b>"), ("pl_a", "name_en", "Q12"), ("pl_b", "name_local", "a&amp;b"), ("pl_c", "aliases", "y" * 61)]
