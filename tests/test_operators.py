import io
import re
from contextlib import redirect_stdout
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wardhouse.operators import keys, merge, quality, skew, star
from wardhouse.operators.canonical import canonicalize, normalize_name
from wardhouse.operators.dates import build_date_dim
from wardhouse.plans import facts, staging
from wardhouse.plans.vocabulary import SOURCE_COLUMNS, alias_map


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# Canonical columns


def test_names_compare_by_letters_and_digits():
    assert normalize_name("Prescription-No. 2") == "prescriptionno2"


def test_canonical_columns(spark):
    df = spark.createDataFrame([(7, "bn1", "x", 3)], "`Patient ID` long, PatientNo string, keep string, `patient.id` int")
    out = canonicalize(df, {"patient_id": (), "patient_code": ("patient_no",), "phone": ("phone_number",)})
    assert out.columns == ["Patient ID", "PatientNo", "keep", "patient.id", "patient_id", "patient_code", "phone"]
    # Of two names with one normal form the later counts.
    assert out.select("patient_id", "patient_code", "phone").first() == ("3", "bn1", None)
    assert set(t for _, t in out.dtypes[4:]) == {"string"}


def test_canonical_name_beats_aliases_and_replaces_its_source(spark):
    df = spark.createDataFrame([(1, 2)], "code_no int, CODE int")
    out = canonicalize(df, {"code": ("code_no",)})
    assert out.columns == ["code_no", "code"] and out.first().code == "2"


@pytest.mark.parametrize("table, column, names", [
    ("patients", "patient_code", ("patient_no",)), ("patients", "gender_raw", ("gender",)),
    ("patients", "date_of_birth", ("dob", "birth_date")), ("services", "standard_price", ("standard_price_raw",)),
    ("prescriptions", "total_amount_raw", ("total_amount", "medicine_revenue_amount_raw", "medicine_revenue_amount")),
    ("service_transactions", "insurance_paid_raw", ("insurance_paid_amount",)), ("visits", "visit_id", ()),
])
def test_alias_rules(table, column, names):
    assert alias_map(table)[column] == names
    assert list(alias_map(table)) == list(SOURCE_COLUMNS[table])


# Quality


def test_verdict_is_an_exact_partition(spark):
    data = [(None, 1), ("", 2), ("a", None), ("a", -1), ("a", 3)]
    df = spark.createDataFrame(data, "code string, n int")
    rules = [quality.present("no_code", "code"), quality.Rule("bad_n", F.col("n") > 0)]
    good, bad = quality.classify(df, rules)
    assert rows(good) == [("a", 3)]
    assert rows(bad) == [("", 2, "no_code"), ("a", -1, "bad_n"), ("a", None, "bad_n"), (None, 1, "no_code")]
    assert good.count() + bad.count() == df.count()


def test_cleansing_runs_once_below_the_verdict_filter(spark):
    raw = spark.range(3).select(*[F.col("id").cast("string").alias(c) for c in SOURCE_COLUMNS["visits"]])
    text = plan(staging.silver(staging.stage_visits(raw), "stg_visits"))
    assert text.count("9999-99-99") == 2  # the two waiting times


def test_fill_from_parent_keeps_child_rows(spark):
    child = spark.createDataFrame([(1, "v1", None, " "), (2, "v1", "p9", "d9"), (3, None, None, None), (4, "v3", None, None)],
                                  "id int, v string, p string, d string")
    parent = spark.createDataFrame([("v1", "p1", "d1", "1"), ("v1", "p2", "d2", "2"), ("v2", "p3", "d3", "1")], "v string, p string, d string, t string")
    out = quality.fill_from_parent(child, parent, "v", ["p", "d"], [F.desc("t")])
    assert rows(out) == [(1, "v1", "p2", "d2"), (2, "v1", "p9", "d9"), (3, None, None, None), (4, "v3", None, None)]


def test_results_equal_a_plain_join(spark):
    child = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None)
                                       .otherwise(F.col("id").cast("string")).alias("k"))
    parent = spark.range(20_000).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("p")).union(
        spark.createDataFrame([("hot", -1)], "k string, p long"))
    salted = skew.skew_safe_left_join(child, parent, "k")
    assert rows(salted.select("k", "id", "p")) == rows(child.join(parent, "k", "left").select("k", "id", "p"))


def test_rows_without_a_key_are_spread_and_a_hot_key_is_split_at_run_time(spark, tmp_path):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string"))
    spark.range(0, 90_000, 1, 6).select(key.alias("k"), "id", F.lit(1).alias("same")).write.parquet(f"{tmp_path}/child")
    spark.createDataFrame([("hot", 1), ("1", 2)], "k string, p int").write.parquet(f"{tmp_path}/parent")
    child, parent = spark.read.parquet(f"{tmp_path}/child"), spark.read.parquet(f"{tmp_path}/parent")
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, value in settings.items():
            spark.conf.set(k, value)
        joined = skew.skew_safe_left_join(child, parent, "k")
        found = joined.select("*", F.spark_partition_id().alias("task")).collect()
        joined.collect()
        final = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, value in before.items():
            spark.conf.unset(k) if value is None else spark.conf.set(k, value)
    assert "skew=true" in final
    assert final.split("Initial Plan")[-1].count("FileScan") == 2
    assert len(found) == 90_000 and sum(r.p == 1 for r in found) == 30_000 and sum(r.p == 2 for r in found) == 1
    without = [r.task for r in found if r.k is None]
    assert len(without) == 30_000 and max(map(without.count, set(without))) < 15_000


def test_cleansing_stays_below_the_limit_of_the_jit_compiler(spark, tmp_path):
    for table, stage in (("visits", staging.stage_visits), ("service_transactions", staging.stage_service_transactions), ("patients", staging.stage_patients)):
        path = f"{tmp_path}/{table}"
        spark.range(3).select(*[F.col("id").cast("string").alias(c) for c in SOURCE_COLUMNS[table]]).write.parquet(path)
        out = io.StringIO()
        with redirect_stdout(out):
            stage(spark.read.parquet(path)).explain("codegen")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]
        assert sizes and max(sizes) < 8_000, table


# Latest rows and keys


def test_latest_row_with_ties(spark):
    data = [("a", "2026-01-01 00:00:00", "9"), ("a", "2026-01-01 00:00:00", "10"), ("b", None, "1"), ("b", "2025-01-01 00:00:00", "0")]
    df = spark.createDataFrame(data, "k string, updated_at string, id string")
    latest = lambda text: dict((r.k, r.id) for r in keys.latest_by(df, ["k"], staging.newest_first("id", text_order=text)).collect())
    assert latest(False) == {"a": "10", "b": "0"}
    assert latest(True) == {"a": "9", "b": "0"}


def test_latest_row_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    text = plan(keys.latest_by(df, ["k"], [F.desc("id")]))
    below = text[text.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below


@pytest.mark.parametrize("dense", [True, False])
def test_keys_do_not_depend_on_partitions(spark, dense):
    codes = spark.range(5_000).select(F.concat(F.lit("c"), F.col("id")).alias("code"), "id")
    results = []
    for n in (1, 8, 200):
        results.append(rows(keys.assign_keys(codes.repartition(n), "code", "key", dense=dense)))
    assert results[0] == results[1] == results[2]
    found = [r[0] for r in results[0]]
    assert len(set(found)) == 5_000 and min(found) > 0
    if dense:
        assert sorted(found) == list(range(1, 5_001))


@pytest.mark.parametrize("dense", [True, False])
def test_known_codes_keep_their_keys(spark, dense):
    code = F.concat(F.lit("c"), F.col("id")).alias("code")
    first = keys.assign_keys(spark.range(0, 4_000, 2).select(code), "code", "key", dense=dense)
    both = keys.assign_keys(spark.range(0, 4_000).select(code), "code", "key", first, dense=dense)
    old, new = dict((c, k) for k, c in rows(first)), dict((c, k) for k, c in rows(both))
    assert all(new[c] == k for c, k in old.items())
    assert len(set(new.values())) == 4_000
    if dense:
        assert sorted(new.values()) == list(range(1, 4_001))
    # Codes that left the source keep their keys reserved.
    later = keys.assign_keys(spark.range(3_999, 4_500).select(code), "code", "key", both, dense=dense)
    known, fresh = set(new.values()), {c: k for k, c in rows(later)}
    assert all(k not in known for c, k in fresh.items() if c not in new)


def test_no_cross_join_or_single_task_sort_of_rows(spark):
    text = plan(keys.assign_keys(spark.range(10).select(F.col("id").cast("string").alias("code")), "code", "key"))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    single = text[text.index("Exchange SinglePartition"):]
    assert "HashAggregate" in single.splitlines()[1]  # only the counts per bucket go to one task


# Dimensions, star join, upsert


def test_date_dimension(spark):
    a = spark.sql("SELECT date'2026-05-02' d UNION ALL SELECT NULL")
    b = spark.sql("SELECT date'2026-05-02' x UNION ALL SELECT date'2026-05-04'")
    out = build_date_dim(a, b).orderBy("DateKey").collect()
    assert tuple(out[0])[2:] == (2, 5, "May", 2, 2026, 7, "Saturday", 1) and out[1].IsWeekend == 0 and len(out) == 2


def star_case(spark, rows_known=None):
    fact = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, None, "y"), (4, "a", None), (5, "a", "z")], "id int, A string, B string")
    left = spark.createDataFrame([("a", 10)], "A string, AKey int")
    right = spark.createDataFrame([("x", 20, 0.5), ("y", 21, 0.7)], "B string, BKey int, rate double")
    return fact, [star.DimRef("first", left, "A", "A", "AKey", rows=rows_known), star.DimRef("second", right, "B", "B", "BKey", ("rate",), rows_known)]


def test_star_join_and_orphans_split_the_fact(spark):
    fact, dims = star_case(spark)
    matched, orphans = star.split_orphans(fact, dims)
    assert [r.id for r in matched.collect()] == [1]
    assert rows(orphans.select("id", "error_reason")) == [(2, "missing_first_dimension"), (3, "missing_first_dimension"),
                                                         (4, "missing_second_dimension"), (5, "missing_second_dimension")]
    assert orphans.columns == ["id", "A", "B", "error_reason"]


def test_broadcast_needs_a_known_small_size(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = plan(star.resolve(*star_case(spark, 2)))
        unknown = plan(star.resolve(*star_case(spark)))
        large = plan(star.resolve(*star_case(spark, star.BROADCAST_ROWS + 1)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert small.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in small
    assert unknown.count("SortMergeJoin") == large.count("SortMergeJoin") == 2


def test_hot_dimension_code_is_split_at_run_time(spark, tmp_path):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    spark.range(200).select(F.col("id").cast("string").alias("A"), F.col("id").alias("AKey")).write.parquet(f"{tmp_path}/dim")
    spark.range(0, 90_000, 1, 6).select("id", F.when(F.col("id") % 3 == 0, "7").otherwise((F.col("id") % 300).cast("string")).alias("A")).write.parquet(f"{tmp_path}/fact")
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, value in settings.items():
            spark.conf.set(k, value)
        dim = star.DimRef("a", spark.read.parquet(f"{tmp_path}/dim"), "A", "A", "AKey", rows=star.BROADCAST_ROWS + 1)
        out = star.resolve(spark.read.parquet(f"{tmp_path}/fact"), [dim])
        found = out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, value in before.items():
            spark.conf.unset(k) if value is None else spark.conf.set(k, value)
    assert len(found) == 90_000
    assert sum(r.AKey is None for r in found) == sum(1 for i in range(90_000) if i % 3 and i % 300 >= 200)


def test_upsert_replaces_by_key_and_repeats_safely(spark):
    old = spark.createDataFrame([("a", 1, 1), ("b", 2, 1)], "k string, v int, at int")
    new = spark.createDataFrame([("b", 3, 2), ("b", 4, 3), ("c", 5, 2)], "k string, v int, at int")
    once = merge.upsert_by_key(old, new, ["k"], "at")
    assert rows(once) == [("a", 1, 1), ("b", 4, 3), ("c", 5, 2)]
    assert rows(merge.upsert_by_key(once, new, ["k"], "at")) == rows(once)


def test_prescription_lines_collapse_unless_the_line_number_is_a_key(spark):
    dims = {"Dim_Date": build_date_dim(spark.sql("SELECT date'2026-05-02' d"))}
    for kind in ("Patient", "Doctor", "Department", "Medicine", "Insurance"):
        extra = ", CAST(80 AS decimal(5,2)) CoverageRate" if kind == "Insurance" else ""
        dims[f"Dim_{kind}"] = spark.sql(f"SELECT 1L {kind}Key, 'X' {kind}Code{extra}")
    raw = spark.createDataFrame(
        [(str(i), "p1", str(line), "v1", "2026-05-02", "x", "x", "x", "x", "x", "2", "1000", None, "dispensed", None, "2026-05-02 00:00:00") for i, line in ((1, 1), (2, 2))],
        "prescription_id string, prescription_no string, prescription_line_no string, visit_no string, prescription_date string, patient_no string, "
        "doctor_no string, department_no string, medicine_no string, insurance_no string, quantity string, unit_price string, total_amount string, "
        "dispense_status string, created_at string, updated_at string")
    visits = staging.silver(staging.stage_visits(raw.select("visit_no", "updated_at")), "stg_visits")
    stg = quality.accepted(staging.stage_prescriptions(raw, visits))
    one = facts.build_fact_prescription(stg, dims)
    assert [(r.Quantity, r.MedicineRevenueAmount, r.InsurancePaidAmount) for r in one.collect()] == [(2, Decimal(2000), Decimal(1600))]
    lines = facts.build_fact_prescription(stg, dims, keys=("PrescriptionCode", "prescription_line_no"))
    assert lines.count() == 2 and lines.select("PrescriptionFactKey").distinct().count() == 2


def test_line_level_keys_of_known_rows_stay(spark):
    one = "DateKey int, PatientKey int, DoctorKey int, DepartmentKey int, MedicineKey int, InsuranceKey int, VisitCode string, PrescriptionCode string, Quantity int, UnitPrice decimal(18,2), MedicineRevenueAmount decimal(18,2), CoverageRate decimal(5,2), updated_at string, prescription_id string, line int"
    line = lambda code, n: (1, 1, 1, 1, 1, 1, "v", code, 1, None, None, None, "2026-01-01", "1", n)
    first = spark.createDataFrame([line("a", 1), line("b", 1)], one)
    second = spark.createDataFrame([line(c, n) for c in "abcd" for n in (1, 2)], one)
    identity = ["PrescriptionCode", "line"]
    before = facts.finish_fact("Fact_Prescription", first, keys=identity)
    after = facts.finish_fact("Fact_Prescription", second, before, keys=identity)
    known = {(r.PrescriptionCode, r.line): r.PrescriptionFactKey for r in before.collect()}
    found = {(r.PrescriptionCode, r.line): r.PrescriptionFactKey for r in after.collect()}
    assert len(set(found.values())) == 8 and known.items() <= found.items()


def test_date_side_is_broadcast_at_any_size(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        days = spark.range(100).select(F.expr("date_add(date'2026-01-01', CAST(id AS INT))").alias("FullDate"), F.col("id").alias("DateKey"))
        out = star.resolve(days.select(F.col("FullDate").alias("d")), [star.DimRef("date", days, "d", "FullDate", "DateKey", bounded=True)])
        assert "BroadcastHashJoin" in plan(out) and "SortMergeJoin" not in plan(out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hot_codes_are_joined_apart(spark, tmp_path):
    """Without the adaptive split: a third of the rows has one code, a tenth none, and no task gets them together."""
    spark.range(300).select(F.col("id").cast("string").alias("A"), F.col("id").alias("AKey"), (F.col("id") * 2).alias("extra")).write.parquet(f"{tmp_path}/dim")
    code = "CASE WHEN id % 3 = 0 THEN '7' WHEN id % 10 = 1 THEN NULL WHEN id % 50 = 5 THEN 'lost' ELSE CAST(id % 400 AS STRING) END"
    fact = spark.range(0, 60_000, 1, 6).select("id", F.expr(code).alias("A"))
    seen = fact.agg(star.hot_metric("A").alias("hot")).first()["hot"]
    hot = star.hot_codes(seen, 60_000)
    assert {"7", "lost"} <= set(hot) and star.hot_codes(None, 5) == []
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, value in settings.items():
            spark.conf.set(k, value)
        frame = spark.read.parquet(f"{tmp_path}/dim")
        ref = lambda **k: star.DimRef("a", frame, "A", "A", "AKey", ("extra",), rows=star.BROADCAST_ROWS + 1, **k)
        plain, apart = star.resolve(fact, [ref()]), star.resolve(fact, [ref(hot=tuple(hot))])
        assert rows(plain) == rows(apart) and plain.columns == apart.columns
        text = plan(apart)
        assert text.count("BroadcastHashJoin") == 1 and text.count("SortMergeJoin") == 1
        sizes = lambda df: [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes(plain)) > 20_000 and max(sizes(apart)) < 1.5 * 60_000 / 8
    finally:
        for k, value in before.items():
            spark.conf.unset(k) if value is None else spark.conf.set(k, value)
