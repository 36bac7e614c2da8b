"""SQL functions equal their DataFrame counterparts."""

from pyspark.sql import functions as F

from rosterflow.functions import net, text
from rosterflow.functions.sql import register_sql_functions
from rosterflow.operators import roster as ro

VALUES = ["  José \\r\\n", '"quoted"', "37211-1234", "t.n.", "(615) 555-0100 ext 1234567", "7F748 ", "84117X",
          "65185", "10.1.2.3", "300.1.1.1", "", None]


def test_sql_functions_match_column_functions(spark):
    register_sql_functions(spark)
    df = spark.createDataFrame([(v,) for v in VALUES], "v string")
    df.createOrReplaceTempView("rf_values")
    got = spark.sql("SELECT v, rf_scrub_ascii(v) a, rf_trim_fields(v) b, rf_std_zip(v) c, rf_std_state(v) d, "
                    "rf_phone_clean(v) e, rf_school_remap(v) f, rf_ip_to_long(v) g FROM rf_values").collect()
    want = df.select("v", text.scrub_ascii("v").alias("a"), text.trim_fields("v", quote_to_apostrophe=True).alias("b"),
                     text.std_zip("v").alias("c"), text.std_state("v").alias("d"), ro.phone_clean(F.col("v")).alias("e"),
                     ro.school_remap(F.col("v")).alias("f"), net.ip_to_long(F.col("v")).alias("g")).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_sql_namecase_matches_column_namecase(spark, views):
    from tests.test_text import CASES

    register_sql_functions(spark)
    names = [c[0] for c in CASES] + ["MACDONALD-MCKAY", "O'NEIL", "JUAN Y MARIA E JOSE", "BIN LADEN X", "AL"]
    df = spark.createDataFrame([(v,) for v in names], "v string")
    parts = views.table("part").select(F.concat("p_name", F.lit(" "), "p_type").alias("v"))
    roster = views.patron.select(F.upper(F.concat("last_name", F.lit(" "), "first_name")).alias("v"))
    for src in (df, parts, roster):
        got = src.select("v", F.expr("rf_namecase(v)").alias("a"), text.namecase(F.col("v")).alias("b"))
        assert got.filter(~F.col("a").eqNullSafe(F.col("b"))).count() == 0
