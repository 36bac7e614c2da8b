"""Roster rules on edge rows (FIXTURES.md section 2)."""

from pyspark.sql import functions as F

from rosterflow.operators import roster as ro

RUN = "2024-02-01"


def test_age_promotion_boundaries(spark):
    # 18th birthday minus one day is the cut: strictly before the run date.
    rows = [("a", "31", "2006-02-01"), ("b", "31", "2006-02-02"), ("c", "31", "2006-02-03"),
            ("d", "37", "2000-01-01"), ("e", "33", "2000/01/01"), ("f", "25", "2000-01-01")]
    df = spark.createDataFrame(rows, "id string, bty string, birth string")
    got = dict(df.select("id", ro.age_promotion(F.col("bty"), F.col("birth"), run_date=RUN)).collect())
    assert got == {"a": "46", "b": "31", "c": "31", "d": "47", "e": "33", "f": "25"}


def test_guarantor_stop_date(spark):
    rows = [("young", "2015-06-01", "MOM"), ("old", "2010-01-01", "DAD"), ("edge", "2011-02-02", "X"),
            ("bad", "2015/06/01", "AUNT"), ("none", "2015-06-01", "")]
    df = spark.createDataFrame(rows, "id string, birth string, g string")
    got = dict(df.select("id", ro.guarantor_stop_date(F.col("g"), F.col("birth"), run_date=RUN,
                                                      expiration="2026-10-01")).collect())
    assert got == {"young": "2026-10-01: MOM", "old": "", "edge": "2024-02-01: X",
                   "bad": "2026-10-01: AUNT", "none": ""}


def test_phone_and_permission_rules_are_independent(spark):
    df = spark.createDataFrame([("(615) 555-0100 ext 1234", ""), ("6155550100", "")], "phone string, permission string")
    out = ro.flags_yes_no(df.withColumn("laptop", F.lit("Y")).withColumn("tech_optout", F.lit("N"))
                          .withColumn("phone", ro.phone_clean(F.col("phone")))).collect()
    assert [r.phone for r in out] == ["61555501001234", "6155550100"]
    assert [r.permission for r in out] == ["Yes", "Yes"]
    assert out[0].laptop == "Yes" and out[0].tech_optout == "No"


def test_school_remap_and_optout(spark):
    df = spark.createDataFrame([("7F748 ",), ("83116A",), ("65185 ",)], "s string")
    assert [r[0] for r in df.select(ro.school_remap(F.col("s"))).collect()] == ["7Z999", "7Z999", "65185"]
    df = spark.createDataFrame([("21", "N"), ("29", "No"), ("33", "N"), ("33", "Y"), ("38", "N")], "b string, p string")
    assert [r[0] for r in df.select(ro.optout_type(F.col("b"), F.col("p"))).collect()] == ["35", "36", "37", "33", "38"]


def test_dedupe_student_prefers_address(spark):
    df = spark.createDataFrame([("190000001", "", "A"), ("190000001", "1 MAIN ST", "B"), ("190000002", "", "C")],
                               "patron_id string, street string, x string")
    got = {r.patron_id: r.x for r in ro.dedupe_student(df).collect()}
    assert got == {"190000001": "B", "190000002": "C"}


def test_dedupe_staff_overrides_win(spark):
    ext = spark.createDataFrame([("100004", "40", "A", "65185"), ("100004", "40", "A", "65999")],
                                "patron_id string, bty string, last_name string, school_code string")
    ov = spark.createDataFrame([("100004", "12", "OVERRIDE", "65185")], ext.schema)
    got = ro.dedupe_staff(ext, ov, fields=["patron_id", "bty", "last_name", "school_code"]).collect()
    assert [(r.last_name, r.school_code) for r in got] == [("OVERRIDE", "65185")]
    got = ro.dedupe_staff(ext, ov.limit(0), fields=["patron_id", "bty", "last_name", "school_code"]).collect()
    assert [r.school_code for r in got] == ["65999"]
