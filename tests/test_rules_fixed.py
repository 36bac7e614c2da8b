"""Edge rows and plan rules that the driver tables do not reach."""

import uuid

import pytest
from pyspark.sql import functions as F

from rosterflow.operators import actions, circulation, eligibility, netrange, notes, reconcile
from rosterflow.plans import catalog
from rosterflow.plans.catalog import spark_queries
from rosterflow.session import ensure_checkpoint_dir
from rosterflow.sources.versioned import VersionedTable
from rosterflow.streaming import jobs


def test_not_in_follows_sql_null_logic(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "k string")
    for sub in ([], [("a",)], [("a",), (None,)], [(None,)]):
        s = spark.createDataFrame(sub, "x string")
        df.createOrReplaceTempView("t_left")
        s.createOrReplaceTempView("t_sub")
        expected = spark.sql("SELECT k FROM t_left WHERE k NOT IN (SELECT x FROM t_sub)").collect()
        found = circulation.not_in(df, "k", s, "x").collect()
        assert sorted(map(str, found)) == sorted(map(str, expected))


def test_update_payload_keeps_the_sor_email(spark):
    row = {c: "x" for c in ("patron_id", "bty", "last_name", "first_name", "middle_name", "suffix", "default_branch", "email",
                            "expiration_date", "teacher_id", "teacher_name", "street", "city", "state", "zip", "phone")}
    roster = spark.createDataFrame([{**row, "birth_date": "2010-05-06", "collection_status": "78"}])
    update = actions.payload_update(roster, run_date="2024-02-01", start="2024-01-08", twenty_day="2024-02-05", test_pin="0000")
    assert "email" not in update.columns and update.first().pin == "0506"
    late = actions.payload_update(roster, run_date="2024-02-05", start="2024-01-08", twenty_day="2024-02-05", test_pin="0000")
    assert late.first().pin is None and actions.payload_create(roster, run_date="2024-02-05", test_pin="0000").first().email == "x"


def test_the_clean_up_finds_the_notes_that_the_removal_writes(spark):
    gone = spark.createDataFrame([("1", None, 12, 21, 0, "a@b.c")], "patron_id string, last_seen date, default_branch int, bty int, "
                                                                    "collection_status int, email string")
    text = actions.payload_remove(gone, run_date="2024-02-01").first().note_text
    written = spark.createDataFrame([("1", 7, text)], "patron_id string, note_id bigint, text string").withColumn("ts", F.current_timestamp())
    assert notes.expired_note_ids(written, marker=notes.EXPIRED_MARKER).first().expired_note_ids == "7"


def test_a_read_fault_is_no_empty_state(spark, tmp_path):
    assert VersionedTable(spark, str(tmp_path / "nothing")).read() is None
    table = VersionedTable(spark, str(tmp_path / "state"))
    table.replace(spark.createDataFrame([(1,)], "a int"))
    (folder,) = table.manifest()["parts"][""]
    for part in (tmp_path / "state" / folder).glob("*.parquet"):
        part.with_name(f".{part.name}.crc").unlink()
        part.write_bytes(b"not parquet")
    with pytest.raises(Exception):
        table.read().collect()


def test_streams_are_awaited_without_a_limit():
    class Query:
        waited = None

        def awaitTermination(self, *limit):
            Query.waited = limit

    jobs._run(Query())
    assert Query.waited == ()


def test_checkpoint_folder_is_required_off_local_mode():
    class Conf(dict):
        def get(self, key, default=None):
            return super().get(key, default)

    class Session:
        conf = Conf({"spark.master": "spark://host:7077"})

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


def test_ip_match_takes_any_number_of_targets(spark):
    ranges = spark.createDataFrame([(i, f"10.{i % 250}.{i // 250}.5", f"10.{i % 250}.{i // 250}.9") for i in range(500)],
                                   "range_id bigint, start_ip string, end_ip string")
    blocks = [(20_000 + i, f"10.{i}.0.0/16") for i in range(0, 250, 2)]
    exact = [(i, f"192.168.{i // 250}.{i % 250}") for i in range(12_000)]
    other = [(5, "10.7.1.9"), (30_000, "^10\\.9\\."), (40_000, "0.0.0.0/0"), (40_001, "10.1.0.5/32")]
    targets = spark.createDataFrame(exact + blocks + other, "target_order int, target string")
    found = {r.range_id: r.target for r in netrange.ip_match(ranges, targets).collect()}
    expected = {}
    for i in range(500):
        second, third = i % 250, i // 250
        expected[i] = ("10.7.1.9" if (second, third) == (7, 1) else f"10.{second}.0.0/16" if second % 2 == 0
                       else "^10\\.9\\." if second == 9 else "0.0.0.0/0")
    assert found == expected


def test_collisions_need_two_patrons(spark):
    p = spark.createDataFrame([("111111", "222222"), ("222222", "x"), ("333333", "333333"), ("444444", None), ("a", "444444"), ("b", "444444")],
                              "patron_id string, guid string")
    assert sorted(r.value for r in eligibility.id_collisions(p).collect()) == ["222222", "444444"]


def test_update_is_except_on_known_ids(spark):
    schema = "patron_id string, a string, b int"
    new = [("1", "x", 1), ("1", "x", 1), ("2", None, 1), ("3", None, None), ("4", "n", 1), ("5", "x", 2)]
    old = [("1", "x", 1), ("2", "y", 1), ("3", None, None), ("5", "x", 1), ("5", "x", 2)]
    found = reconcile.reconcile_update(spark.createDataFrame(new, schema), spark.createDataFrame(old, schema), compare_cols=["a", "b"])
    assert [tuple(r) for r in found.collect()] == [("2", None, 1)]


@pytest.mark.parametrize("key", ["txn_gap", "in_house_circ", "daily_checkouts", "fee_waiver", "vendor_usage_a", "patron_snapshot"])
def test_building_a_plan_starts_no_job(spark, views, key):
    spark_queries()
    build = catalog.REGISTRY[key].build
    build(views)  # reads the schemas of the tables
    group = f"plan-{key}-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, key)
    try:
        build(views)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == 0
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_staff_payloads_follow_type_and_status(spark):
    row = {c: "x" for c in ("last_name", "first_name", "middle_name", "suffix", "default_branch", "email", "expiration_date")}
    rows = [{**row, "patron_id": i, "bty": t, "collection_status": s} for i, t, s in (
        ("123456", "13", 78), ("123457", "13", 0), ("999001", "11", 2), ("123458", "11", 1), ("123459", "11", None), ("123460", "11", 78))]
    df = spark.createDataFrame(rows, "patron_id string, bty string, collection_status int, last_name string, first_name string, "
                                     "middle_name string, suffix string, default_branch string, email string, expiration_date string")
    made = {r.patron_id: r for r in actions.payload_staff_create(df, run_date="2024-02-01", test_pin="0000").collect()}
    assert {i: (r.collection_status, r.pin, r.draw_pin) for i, r in made.items() if i in ("123456", "999001", "123458")} == {
        "123456": ("do not send", None, True), "999001": ("not sent", "0000", False), "123458": ("not sent", None, True)}
    assert made["123456"].reg_branch == made["123456"].last_edit_branch == "x" and made["123456"].patron_status == "G"
    changed = {r.patron_id: (r.collection_status, r.pin) for r in actions.payload_staff_update(df, run_date="2024-02-01", test_pin="0000").collect()}
    assert changed == {"123456": ("do not send", None), "123457": ("not sent", None), "999001": ("sent", "0000"), "123458": ("not sent", None),
                       "123459": ("not sent", None), "123460": (None, None)}
    gone = df.withColumn("last_seen", F.lit(None).cast("date")).withColumn("bty", F.col("bty").cast("int"))
    first = actions.payload_staff_remove(gone, run_date="2024-02-01").where("patron_id = '123456'").first()
    assert first.collection_status == "not sent" and "email" not in first.asDict()
    assert first.note_text.startswith("Former MNPS staffer, patron expired 2024-01-31. Previous branchcode: x. Previous bty: 13.")


def test_a_removal_clears_phone_and_sponsor(spark):
    rows = [("1", "a@MNPS.org", 78, None), ("2", "a@b.c", 5, "2024-01-03"), ("3", None, 1, None)]
    df = (spark.createDataFrame(rows, "patron_id string, email string, collection_status int, last_seen string")
          .select("*", F.lit(12).alias("default_branch"), F.lit(21).alias("bty")).withColumn("last_seen", F.col("last_seen").cast("date")))
    got = {r.patron_id: r for r in actions.payload_remove(df, run_date="2024-02-01").collect()}
    assert [(got[i].email, got[i].email_notices, got[i].collection_status) for i in "123"] == [
        ("", "do not send email", "not sent"), ("a@b.c", None, None), (None, None, "not sent")]
    assert all(r.phone2 == r.sponsor_name == r.addresses[0].street == "" and r.addresses[0].type == "Secondary" for r in got.values())
    assert str(got["2"].expiration_date) == "2024-01-03" and str(got["1"].expiration_date) == "2024-01-31"
    left = {r.patron_id: (r.email, r.email_notices) for r in actions.payload_graduation(df, run_date="2024-02-01").collect()}
    assert left == {"1": ("", "do not send email"), "2": (None, None), "3": (None, None)}


def test_item_payload_has_every_field(spark):
    row = actions.payload_item_create(spark.createDataFrame([("i1", "9.99", "z")], "item_id string, price string, other string")).first()
    assert list(row.asDict()) == ["action", *actions.ITEM_FIELDS] and (row.item_id, row.price, row.status) == ("i1", "9.99", None)


def test_short_codes_have_no_tail(spark):
    from rosterflow.functions.text import code_part, code_tail

    df = spark.createDataFrame([("ab",), ("abc",), ("abcdef",), ("",), (None,)], "c string")
    assert [r[0] for r in df.select(code_tail("c")).collect()] == [None, "abc", "def", None, None]
    assert [r[0] for r in df.select(code_part("c", 3, 3)).collect()] == [None, "c", "cde", None, None]


def test_the_report_takes_one_whole_row_of_a_repeated_id(spark):
    """Two rows of one id differ from the SoR each in another column; no mixture of them may equal it."""
    ext = spark.createDataFrame([("1", 5, "a", "z"), ("1", 5, "b", "y")], "patron_id string, bty int, last_name string, city string")
    sor = spark.createDataFrame([("1", 5, "b", "z", "x")], "patron_id string, bty int, last_name string, city string, edit_branch string")
    state = spark.createDataFrame([], "patron_id string, last_seen date")
    (row,) = reconcile.reconcile_report_onepass(ext, sor, state, by="bty", compare_cols=["last_name", "city"], run_date="2024-02-01").collect()
    assert (row.sor, row.extract, row.updated, row.created, row.removed) == (1, 1, 1, 0, 0)


def test_a_person_meets_a_usage_row_by_either_key(spark):
    from rosterflow.operators import usage

    staff = spark.createDataFrame([("123456", "Ann", "Bo", "Lee", 4), ("123457", "Al", None, "Lee", 4), ("123458", "Abe", "", "Lee", 5)],
                                  "patron_id string, first_name string, middle_name string, last_name string, default_branch int")
    rows = [("alee@x.y", 4), ("ABLEE@x.y", 4), ("alee@x.y", 5), ("ablee@x.y", 5), ("alee", 4)]
    use = spark.createDataFrame([(u, b, "S", "d", i) for i, (u, b) in enumerate(rows)],
                                "user_id string, sor_branch int, school_code string, year_month_day string, checkouts int")
    got = sorted((r.checkouts, r.patron_id) for r in usage.email_name_match(use, staff).collect())
    assert got == [(0, "123456"), (0, "123457"), (1, "123456"), (2, "123458")]
