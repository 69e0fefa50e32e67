from pyspark.sql import functions as F

from waymark.plans.report_queries import q40_resolver_candidates

ADMIT = "admit_id long, qid string, alt_qids array<string>, iso3 string, family string, label_en string, label_loc string, lat double, lon double, sitelinks long, population long, classes array<string>, heritage array<string>, whs string, wdpa string, voyage boolean, retrieved timestamp"
H1 = ["golden_id", "expected_name", "aliases", "lat", "lon", "tol_km", "whs_id"]


def tables(spark, folder, items, rows):
    """``items``: qid, label_en, label_loc, lat, lon, sitelinks, whs; ``rows``: columns of H1."""
    admit = [(i, q, [], "XAA", "attention", en, loc, la, lo, n, None, [], [], w, None, False, None) for i, (q, en, loc, la, lo, n, w) in enumerate(items)]
    spark.createDataFrame(admit, ADMIT).write.parquet(f"{folder}/admit.parquet")
    spark.createDataFrame(rows, ", ".join(f"{c} string" for c in H1)).write.parquet(f"{folder}/h1.parquet")
    spark.createDataFrame([("700",)], "id_number string").write.parquet(f"{folder}/whs_properties.parquet")
    return str(folder)


def test_numbers_as_typed(spark, tmp_path):
    items = [("Q1", "A", None, 4.913, -146.48, 20, None), ("Q2", "B", None, -53.631, -65.286, 20, None), ("Q3", "C", None, 10.09, 20.0, 20, None), ("Q4", "D", None, -30.0, 40.03, 3, None)]
    rows = [
        ("degree", "w", "", "4.913°", "-146.480°", "5", None), ("comma", "x", "", "-53,631", "-65,286", "5", None),
        ("wide", "y", "", "10.0", "20.0", "15 km", None), ("narrow", "z", "", "-30.0", "40.0", "1,5 km", None),
    ]
    got = q40_resolver_candidates(spark, tables(spark, tmp_path, items, rows)).where(F.col("qid").isNotNull())
    assert {(r.golden_id, r.qid, r.status) for r in got.collect()} == {("degree", "Q1", "unique"), ("comma", "Q2", "unique"), ("wide", "Q3", "unique")}


def test_every_way_to_a_candidate(spark, tmp_path):
    items = [
        ("Q1", "Old Mill", None, 10.0, 20.06, 20, None), ("Q2", "Other", None, 10.0, 20.0, 3, None), ("Q3", "Elsewhere", "Xana Fôo", 50.0, 60.0, 40, None),
        ("Q4", "Numbered", None, -70.0, 5.0, 9, "700"), ("Q5", "Part", None, -70.0, 5.0, 9, "700-001"), ("Q6", "Lost", None, None, None, 50, None), ("Q7", "Far off", None, 10.0, 20.08, 20, None),
    ]
    rows = [
        ("near", "OLD MILL", "", "10.0", "20.0", "5", None), ("name", "Nothing", "none such|xana foo", None, None, "5", None),
        ("number", "Unheard", "", None, None, "5", "700bis"), ("unplaced", "Lost", "", "10.0", "170.0", "5", None), ("nobody", "Nowhere", "", "80.0", "170.0", "5", None),
    ]
    got = {(r.golden_id, r.qid, r.found_by, r.name_match, r.status, r.km is None) for r in q40_resolver_candidates(spark, tables(spark, tmp_path, items, rows)).collect()}
    assert got == {
        # 6.6 km with a tolerance of 5 is within 1.5 tolerances, 8.8 km is not.
        ("near", "Q1", "name", True, "unique", False), ("near", "Q2", "position", False, "near", False),
        ("name", "Q3", "name", False, "far", True), ("number", "Q4", "whs", False, "far", True), ("unplaced", "Q6", "name", True, "far", True),
        ("nobody", None, None, None, "none", True),
    }
