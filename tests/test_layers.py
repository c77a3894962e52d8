import datetime as dt
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from wardhouse.plans import pipeline
from wardhouse.plans.vocabulary import REPLACE_KEYS, SOURCE_COLUMNS
from wardhouse.session import scratch_dir
from wardhouse.sources import jdbc, layers, snapshots

DAY = "2026-05-10"


def test_a_repeated_day_is_replaced_even_by_nothing(spark, tmp_path):
    base = str(tmp_path)
    layers.write_layer(spark.range(5), base, "t", "2026-05-09")
    for rows in (3, 2, 0):
        layers.write_layer(spark.range(rows), base, "t", DAY)
        assert layers.read_layer(spark, base, "t", DAY).count() == rows
    assert spark.read.parquet(f"{base}/t").groupBy("run_date").count().collect() == [(dt.date(2026, 5, 9), 5)]
    assert layers.layer_dates(spark, base, "t") == ["2026-05-09", DAY]
    assert layers.layer_dates(spark, base, "absent") == []
    assert layers.read_layer_before(spark, base, "t", DAY).count() == 5
    assert layers.read_layer_before(spark, base, "t", "2026-05-09") is None


def test_only_the_day_is_listed(spark, tmp_path):
    for day in ("2026-05-09", DAY):
        layers.write_layer(spark.range(3), str(tmp_path), "t", day)
    files = layers.read_layer(spark, str(tmp_path), "t", DAY).inputFiles()
    assert files and all(f"run_date={DAY}" in f for f in files)


def test_days_and_parts_are_stored_small(spark, tmp_path):
    rows = spark.range(50).select(F.col("id").cast("string").alias("code"), F.lit("a text").alias("t"))
    layers.write_layer(rows, str(tmp_path), "t", DAY)
    snapshots.append(spark, str(tmp_path), "w", DAY, rows, "code", bucket_rows=20)
    files = [pq.ParquetFile(f).metadata for f in tmp_path.rglob("*.parquet")]
    columns = [m.row_group(g).column(c) for m in files for g in range(m.num_row_groups) for c in range(m.num_columns)]
    assert len(files) > 2 and {c.compression for c in columns} == {"ZSTD"}


def test_shuffle_files_go_with_their_query(spark):
    """And a frame that is collected again makes them again."""
    blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    stored = lambda: {b for b in blocks.getAllBlocks().mkString(",").split(",") if b.startswith("shuffle_")}
    before = stored()
    df = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count().orderBy("k")
    first, until = df.collect(), time.time() + 20
    while stored() - before and time.time() < until:
        time.sleep(0.1)
    assert stored() <= before
    assert df.collect() == first and len(first) == 100


def test_quarantine_keeps_text_and_schema(spark, tmp_path):
    df = spark.createDataFrame([("Đức", 1, "thiếu mã")], "a string, b int, error_reason string")
    layers.write_quarantine(df, str(tmp_path), "bad", DAY)
    back = layers.read_layer(spark, str(tmp_path), "bad", DAY)
    assert back.dtypes == df.dtypes and back.collect() == df.collect()


def test_counts_ride_along_with_the_write(spark, tmp_path):
    df, seen = layers.with_row_counts(spark.range(10), "t", small=F.col("id") < 3)
    layers.write_layer(df, str(tmp_path), "t", DAY)
    assert seen.get == {"rows": 10, "small": 3}


def test_land_tables_and_views(spark, tmp_path):
    layers.land_tables(spark, lambda t: spark.range(len(t)), {"ab": "ab_raw", "abc": "abc_raw"}, str(tmp_path), DAY)
    layers.register_views({"v_abc": layers.read_layer(spark, str(tmp_path), "abc_raw", DAY)})
    assert spark.sql("SELECT count(*) FROM v_abc").first()[0] == 3


def test_jdbc_options(monkeypatch):
    """The options only: no database is started for a test."""
    props = {"user": "u", "password": "p", "driver": "d"}
    calls = {}

    class Fake:
        def format(self, name):
            calls["format"] = name
            return self

        def options(self, **options):
            calls["options"] = options
            return self

        def mode(self, mode):
            calls["mode"] = mode
            return self

        def load(self):
            return "frame"

        def save(self):
            calls["saved"] = True

    class Session:
        read = Fake()

    class Frame:
        write = Fake()

    part = jdbc.Partitioning("id", 1, 1_000, 8)
    assert jdbc.read_jdbc(Session, "jdbc:x", "t", props, part) == "frame"
    assert calls["options"] == {**props, "url": "jdbc:x", "dbtable": "t", "fetchsize": "10000", "partitionColumn": "id",
                                "lowerBound": "1", "upperBound": "1000", "numPartitions": "8"}
    jdbc.write_jdbc(Frame, "jdbc:x", "t", props, connections=4)
    assert calls["options"] == {**props, "url": "jdbc:x", "dbtable": "t", "batchsize": "10000", "numPartitions": "4"}
    assert calls["mode"] == "append" and calls["saved"]


@pytest.mark.parametrize("ids, fair", [("id", 1.2), ("id * id * id", 1.2), ("id % 3", 99), ("CASE WHEN id % 5 > 0 THEN id END", 1.2), ("CAST(id AS STRING)", 1.2)])
def test_splits_meet_every_row_once(spark, tmp_path, ids, fair):
    """On a landed table in place of the database's: even, skewed, few, missing and textual ids."""
    spark.range(8_000).select(F.expr(ids).alias("k")).write.parquet(f"{tmp_path}/t")
    landed = spark.read.parquet(f"{tmp_path}/t")
    tests = jdbc.range_predicates("k", jdbc.split_points(landed, "k", 8)) if "STRING" not in ids else jdbc.range_predicates("k", ["2", "o'x"])
    met = landed.select(sum((F.expr(f"CASE WHEN {t} THEN 1 ELSE 0 END") for t in tests), F.lit(0)).alias("n"))
    assert met.groupBy("n").count().collect() == [(1, 8_000)]
    if fair < 99 and "STRING" not in ids:
        sizes = [landed.where(f"({t}) AND k IS NOT NULL").count() for t in tests]
        assert len(sizes) == 8 and max(sizes) <= fair * sum(sizes) / 8
    assert jdbc.range_predicates("k", jdbc.split_points(landed.limit(0), "k", 8)) == ["1 = 1"]


def test_scan_by_predicates():
    calls = {}

    class Session:
        class read:
            jdbc = staticmethod(lambda url, table, predicates, properties: calls.update(url=url, table=table, predicates=predicates, properties=properties) or "frame")

    assert jdbc.read_jdbc(Session, "jdbc:x", "t", {"user": "u"}, predicates=["a < 1", "a >= 1"]) == "frame"
    assert calls == {"url": "jdbc:x", "table": "t", "predicates": ["a < 1", "a >= 1"], "properties": {"fetchsize": "10000", "user": "u"}}
    with pytest.raises(ValueError):
        jdbc.read_jdbc(Session, "jdbc:x", "t", {}, jdbc.Partitioning("a", 1, 2, 3), ["a < 1"])


def test_scratch_folder_comes_from_the_session(spark):
    folder = scratch_dir(spark)
    assert spark.conf.get("spark.checkpoint.dir").rstrip("/") == folder


# The whole run on a handful of rows


def rows(spark, table, *records):
    columns = SOURCE_COLUMNS[table]
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in records], ", ".join(f"{c} string" for c in columns))


def sources(spark, fee="100", patient="An", more_patients=()):
    t = "2026-05-02 08:00:00"
    people = [{"patient_id": "1", "patient_code": "p1", "full_name": patient, "updated_at": t}, *more_patients]
    visit = {"visit_id": "1", "visit_code": "v1", "visit_date": "02/05/2026", "patient_code": "p1", "doctor_code": "d1",
             "department_code": "k1", "insurance_code": "b1", "consultation_fee_raw": fee, "visit_status": "completed", "updated_at": t}
    line = {"visit_code": "v1", "doctor_code": "d1", "department_code": "k1", "insurance_code": "b1", "patient_code": "p1",
            "quantity_raw": "2", "unit_price_raw": "1,000", "updated_at": t}
    return {
        "patients": rows(spark, "patients", *people),
        "doctors": rows(spark, "doctors", {"doctor_id": "1", "doctor_code": "d1", "updated_at": t}),
        "departments": rows(spark, "departments", {"department_id": "1", "department_code": "k1", "updated_at": t}),
        "services": rows(spark, "services", {"service_id": "1", "service_code": "s1", "updated_at": t}),
        "medicines": rows(spark, "medicines", {"medicine_id": "1", "medicine_code": "m1", "updated_at": t}),
        "insurance": rows(spark, "insurance", {"insurance_id": "1", "insurance_code": "b1", "coverage_rate_raw": "80%", "updated_at": t}),
        "visits": rows(spark, "visits", visit, {**visit, "visit_id": "2", "visit_code": "v2", "doctor_code": "d9"},
                       {**visit, "visit_id": "3", "visit_code": None}),
        "service_transactions": rows(spark, "service_transactions", {**line, "service_transaction_id": "1", "service_transaction_code": "x1",
                                                                     "service_date": "2026-05-02", "service_code": "s1", "payment_status": "PAID"}),
        "prescriptions": rows(spark, "prescriptions", {**line, "prescription_id": "1", "prescription_code": "r1", "medicine_code": "m1",
                                                       "patient_code": " ", "dispense_status": "DISPENSED"}),
    }


def stored(spark, conf, name, day):
    return snapshots.read(spark, conf.layer("warehouse"), name, day)


def test_two_days_and_a_repeat(spark, tmp_path):
    loaded = []
    conf = pipeline.Config(str(tmp_path), sources(spark).__getitem__, sink=lambda df, name: loaded.append(name))
    counts = pipeline.run(spark, "all", DAY, conf)
    assert counts["silver.stg_visits"] == {"rows": 3, "valid": 2, "rejected": 1}
    assert loaded == list(REPLACE_KEYS)
    orphan = layers.read_layer(spark, conf.layer("quarantine"), "fact_visit_missing_dimension", DAY).first()
    assert (orphan.VisitCode, orphan.error_reason) == ("V2", "missing_doctor_dimension")
    script = stored(spark, conf, "fact_prescription", DAY).first()
    assert (str(script.MedicineRevenueAmount), str(script.InsurancePaidAmount), str(script.PatientPaidAmount)) == ("2000.00", "1600.00", "400.00")
    first = {n: sorted(map(str, stored(spark, conf, n, DAY).collect())) for n in REPLACE_KEYS}

    # Next day: patient 1 left the source, two new ones came, the visit got dearer.
    t = "2026-05-02 08:00:00"
    more = [{"patient_id": str(i), "patient_code": f"p{i}", "full_name": "new", "updated_at": t} for i in (2, 3)]
    later = sources(spark, fee="150", patient="Binh", more_patients=more)
    conf2 = pipeline.Config(str(tmp_path), later.__getitem__)
    pipeline.run(spark, "all", "2026-05-11", conf2)
    people = {r.PatientCode: r for r in stored(spark, conf2, "dim_patient", "2026-05-11").collect()}
    assert people["P1"].PatientKey == stored(spark, conf, "dim_patient", DAY).first().PatientKey
    assert len({r.PatientKey for r in people.values()}) == 3 and people["P1"].FullName == "Binh"
    visits = stored(spark, conf2, "fact_visit", "2026-05-11").collect()
    assert [(r.VisitCode, str(r.ConsultationFee)) for r in visits] == [("V1", "150.00")]
    assert visits[0].VisitFactKey == stored(spark, conf, "fact_visit", DAY).first().VisitFactKey

    # The first day again: same rows, although a later day exists.
    pipeline.run(spark, "all", DAY, pipeline.Config(str(tmp_path), sources(spark).__getitem__))
    assert {n: sorted(map(str, stored(spark, conf, n, DAY).collect())) for n in REPLACE_KEYS} == first
    with pytest.raises(ValueError, match="unknown stage"):
        pipeline.run(spark, "nothing", DAY, conf)


def test_forecast_stage(spark, tmp_path, monkeypatch):
    conf = pipeline.Config(str(tmp_path))
    search = pipeline.forecasting.fc.grid_search
    monkeypatch.setattr(pipeline.forecasting.fc, "grid_search", lambda split: search(split, values=2))
    fact = spark.range(60).select(
        F.date_format(F.expr("date_add(date'2026-03-01', CAST(id AS INT))"), "yyyyMMdd").cast("int").alias("DateKey"),
        (F.col("id") % 5).alias("PatientKey"), (F.col("id") % 7 * 10 + 100).cast("decimal(18,2)").alias("RevenueAmount"))
    for day in (DAY, "2026-05-11"):
        layers.write_layer(fact, conf.layer("warehouse"), "fact_service_revenue", day)
        pipeline.run(spark, "forecast", day, conf)
        pipeline.run(spark, "forecast", day, conf)
        assert layers.read_layer(spark, conf.layer("forecast"), "champions", day).count() == 2
        assert layers.read_layer(spark, conf.layer("forecast"), "predictions", day).count() == 90
        status = layers.read_layer(spark, conf.layer("forecast"), "status", day).collect()
        assert {(r.series_id, r.status) for r in status} == {("revenue", "fitted"), ("user_count", "fitted")}
        assert layers.read_layer(spark, conf.layer("forecast"), "champions", day).where("ar_coef IS NULL").count() == 0
    runs = spark.read.parquet(conf.layer("forecast/runs"))
    assert runs.count() == runs.select("run_id").distinct().count() == 4
    champions = layers.read_layer(spark, conf.layer("forecast"), "champions", "2026-05-11")
    assert champions.join(runs, "run_id").count() == 2 and {r.version for r in champions.collect()} == {2}
    layers.write_layer(fact.limit(0), conf.layer("warehouse"), "fact_service_revenue", "2026-05-12")
    with pytest.raises(ValueError, match="no service revenue"):
        pipeline.run(spark, "forecast", "2026-05-12", conf)
