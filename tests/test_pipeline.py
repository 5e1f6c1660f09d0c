"""Raw csv to gold on disk: events, audit, failures, catalog, foreign files."""

import json

import pandas as pd
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from caudal import schemas
from caudal.operators import entities
from caudal.plans import pipeline, sample_bank
from caudal.sources import audit, catalog, folders, paths, tables

AS_OF = sample_bank.AS_OF


@pytest.fixture
def zones(tmp_path):
    return paths.Zones(*(f"file:{tmp_path}/{z}" for z in ("bronze", "silver", "gold")))


def put(zones, entity, text):
    folder = f"{zones.bronze.removeprefix('file:')}/{entity}"
    pd.io.common.os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{entity}.csv", "w", encoding="utf-8") as f:
        f.write(text)
    return f"{zones.bronze}/{entity}/{entity}.csv"


LOANS = """loan_id,user_id,monto_otorgado,tasa_interes_anual,plazo_meses,fecha_desembolso,cuota_mensual,estado_prestamo,proposito
l1,u1,1000000,20,12,2020-01-05,90258.31,Activo,"Libre ""Inversión"", otra"
l2,u2,x,N/A,24,bad,1,En Mora,
l3,u3,5,16,12
"""


def test_event_to_gold(spark, zones, tmp_path):
    path = put(zones, "prestamos", LOANS)
    log = f"{tmp_path}/audit"
    answer = pipeline.handle_event(spark, {"input_path": path}, "prestamos", zones, AS_OF, log)
    body = json.loads(answer["body"])
    assert answer["statusCode"] == 200 and body["processed_rows"] == 3
    assert body["silver"].endswith("silver/prestamos/prestamos_cleaned.parquet")
    gold = {r.loan_id: r for r in tables.load_all_gold(spark, zones.gold)["prestamos"].collect()}
    assert gold["l1"].proposito == "LIBRE_INVERSION" and gold["l1"].interes_total_estimado == 200000.0
    assert (gold["l2"].monto_otorgado, gold["l2"].tasa_interes_anual, gold["l2"].proposito) == (None, None, "OTRO")
    assert gold["l3"].estado_prestamo == "DESCONOCIDO"
    row = audit.read(spark, log).first()
    assert (row.status, row.processed_rows, row.bad_rows, row.bad_dates) == ("ok", 3, 1, 2)


def test_failures_are_reported(spark, zones, tmp_path):
    log = f"{tmp_path}/audit"
    missing = pipeline.handle_event(spark, {"input_path": f"{zones.bronze}/x/x.csv"}, "cuentas", zones, AS_OF, log)
    nothing = pipeline.handle_event(spark, {}, "cuentas", zones, AS_OF, log)
    path = put(zones, "usuarios", "user_id,fecha_de_nacimiento\nu1,bad\n")
    strict = pipeline.handle_event(spark, {"input_path": path}, "usuarios", zones, AS_OF, log,
                                   options=entities.Options(on_bad_date="fail"))
    assert [a["statusCode"] for a in (missing, nothing, strict)] == [500] * 3
    assert "error" in json.loads(strict["body"])
    assert audit.read(spark, log).where("status = 'failed'").count() == 3


def test_paths():
    event = {"Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": "t/t.csv"}}}]}
    assert paths.event_path(event) == "s3://b/t/t.csv"
    zones = paths.Zones("s3a://b", "s3a://silver", "s3a://gold")
    assert paths.event_path(event, zones) == "s3a://b/t/t.csv"
    assert zones.silver_path(paths.event_path(event, zones)) == "s3a://silver/t/t_cleaned.parquet"
    assert paths.object_path("s3://b/t/x/t.v1.csv", "silver", "_cleaned.parquet") == "s3://silver/t/x/t.v1_cleaned.parquet"
    for bad in ("/local/t.csv", "s3://b", "s3://b/folder/"):
        with pytest.raises(ValueError):
            paths.object_path(bad, "silver", "_cleaned.parquet")
    with pytest.raises(ValueError):
        paths.Zones("s3://b", "s3://s", "s3://g").silver_path("s3://other/t.csv")


def test_path_column_like_path_function(spark):
    given = ["s3://b/t/t.csv", "s3://b/t", "s3://b/.csv", "s3://b/a..csv", "s3://b/d.x/f", "s3://b/", "http://b/t.csv", None]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(given)], "i int, p string").orderBy("i")
    got = [r[0] for r in df.select(paths.object_path_column(F.col("p"), "z", "_e.parquet")).collect()]
    expected = []
    for p in given:
        try:
            expected.append(paths.object_path(p, "z", "_e.parquet"))
        except (ValueError, TypeError):
            expected.append(None)
    assert got == expected


def test_empty_or_foreign_gold(spark, tmp_path):
    absent = tables.load_gold(spark, f"{tmp_path}/none", "cuentas")
    assert absent.columns == schemas.GOLD_COLUMNS["cuentas"] and absent.count() == 0
    (tmp_path / "broken.parquet").write_bytes(b"not parquet")
    with pytest.raises((PySparkException, Py4JJavaError)):  # unreadable is not missing
        tables.load_gold(spark, f"{tmp_path}/broken.parquet", "cuentas").count()
    frame = pd.DataFrame({"account_id": ["a"], "fecha_apertura": pd.to_datetime(["2020-01-02 03:04:05.5"])})
    frame.to_parquet(tmp_path / "nanos.parquet", engine="pyarrow", version="2.6")
    try:
        got = tables.load_gold(spark, f"{tmp_path}/nanos.parquet", "cuentas", nanos=True)
        assert got.select(F.col("fecha_apertura").cast("string")).first()[0] == "2020-01-02 03:04:05.5"
    finally:
        spark.conf.unset("spark.sql.legacy.parquet.nanosAsLong")


def test_catalog_gains_columns_and_keeps_old_ones(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(2).selectExpr("id", "'x' as old").write.parquet(path)
    name = catalog.register(spark, "test_zone", "t", path)
    spark.range(3).selectExpr("id", "id * 2 as added").write.mode("overwrite").parquet(path)
    catalog.register(spark, "test_zone", "t", path)
    got = spark.table(name)
    assert set(got.columns) == {"id", "old", "added"} and got.where("old is null").count() == 3
    spark.range(7).selectExpr("id", "'x' as old", "id as added").write.parquet(f"{tmp_path}/moved")
    catalog.register(spark, "test_zone", "t", f"{tmp_path}/moved")
    assert spark.table(name).count() == 7
    spark.sql(f"DROP TABLE {name}")


def test_partitioned_gold(spark, zones, sf):
    path = f"{zones.bronze}/transacciones/transacciones.csv"
    tables.write_bronze(sample_bank.transacciones(spark, sf), path)
    pipeline.run_table(spark, "transacciones", path, zones, AS_OF, partitioned=True)
    gold = tables.load_gold(spark, zones.gold_path(path), "transacciones")
    assert gold.columns == schemas.GOLD_COLUMNS["transacciones"]
    plain = entities.refine(sample_bank.transacciones(spark, sf), "transacciones", AS_OF)
    assert gold.exceptAll(plain).count() == 0 and gold.count() == plain.count()
    assert "PartitionFilters: [isnotnull" in gold.where("anio = 1999")._jdf.queryExecution().toString()


def test_corrected_rules_reach_gold(spark, zones):
    path = put(zones, "usuarios", "user_id,estado_laboral\nu1,Desempleado\n")
    for mode, label in (("reference", "EMPLEADO"), ("corrected", "DESEMPLEADO")):
        pipeline.run_table(spark, "usuarios", path, zones, AS_OF, entities.Options(rules=mode))
        assert spark.read.parquet(zones.gold_path(path)).first().estado_laboral == label


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from caudal import session

    conf = {}
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(session.NoSharedFolder):
        session.scratch_dir(fake, "x")
    conf["spark.checkpoint.dir"] = "s3a://shared"
    assert session.scratch_dir(fake, "x").startswith("s3a://shared/caudal-x-")


@pytest.mark.parametrize("multi_line", [False, True])
def test_unreadable_rows_have_a_table_of_their_own(spark, zones, tmp_path, multi_line):
    path, log = put(zones, "prestamos", LOANS + 'l4,u4,1,2,3,2020-01-01,5,Activo,Viaje,"more, and"\nNA\n'), f"{tmp_path}/audit"
    assert pipeline.handle_event(spark, {"input_path": path}, "prestamos", zones, AS_OF, log, multi_line=multi_line)["statusCode"] == 200
    silver = spark.read.parquet(zones.silver_path(path))
    assert sorted(r.loan_id or "" for r in silver.collect()) == ["", "l1", "l2", "l3"] and "_archivo" not in silver.columns
    rejected = {r.text: r for r in spark.read.parquet(zones.rejected_path(path)).collect()}
    assert {t[:2]: (r.reason, r.kept) for t, r in rejected.items()} == {
        "l3": ("5 of 9 fields", True), "l4": ("10 of 9 fields", False), "NA": ("1 of 9 fields", True)}
    assert all(r.file.endswith("prestamos/prestamos.csv") for r in rejected.values())
    row = audit.read(spark, log).first()
    assert (row.processed_rows, row.bad_rows, row.rejected_rows) == (4, 3, 1)
    put(zones, "prestamos", LOANS.replace("l3,u3,5,16,12\n", ""))
    pipeline.handle_event(spark, {"input_path": path}, "prestamos", zones, AS_OF, log)
    assert not folders.exists(spark, zones.rejected_path(path))


def test_only_what_failed_is_run_again(spark, zones, tmp_path):
    log, missing = f"{tmp_path}/audit", f"{zones.bronze}/cuentas/cuentas.csv"
    loans = put(zones, "prestamos", LOANS)
    for entity, path in (("prestamos", loans), ("cuentas", missing)):
        pipeline.handle_event(spark, {"input_path": path}, entity, zones, AS_OF, log)
    assert pipeline.run_failed(spark, zones, AS_OF, log)["cuentas", missing]["statusCode"] == 500
    put(zones, "cuentas", "account_id,user_id\na,u\n")
    again = pipeline.run_failed(spark, zones, AS_OF, log)
    assert list(again) == [("cuentas", missing)] and again["cuentas", missing]["statusCode"] == 200
    assert pipeline.run_failed(spark, zones, AS_OF, log) == {}


def test_line_breaks_in_quotes_reach_gold(spark, zones):
    path = put(zones, "prestamos", LOANS.replace('"", otra"', '"",\n otra"'))
    assert pipeline.run_table(spark, "prestamos", path, zones, AS_OF, multi_line=True)["processed_rows"] == 3
    assert {r.loan_id for r in spark.read.parquet(zones.gold_path(path)).collect()} == {"l1", "l2", "l3"}


def test_no_query_goes_on_without_a_table_that_failed(spark, tmp_path, monkeypatch):
    """A failed table has no gold, which the next step would take for an empty one."""
    from caudal.plans import sample_queries

    customers = ["id as c_custkey", "id % 25 as c_nationkey", "cast(id as double) as c_acctbal"]
    orders = ["id as o_orderkey", "id % 40 as o_custkey", "'O' as o_orderstatus", "cast(id as double) as o_totalprice", "date'1996-01-02' as o_orderdate"]
    spark.range(40).selectExpr(*customers).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(80).selectExpr(*orders).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(5).selectExpr("id as s_suppkey").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(200).selectExpr(
        "id % 80 as l_orderkey", "id as l_linenumber", "id % 5 as l_suppkey", "1.0d as l_extendedprice", "1.0d as l_quantity",
        "date'1996-01-02' as l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    whole = entities.enrich

    def broken(df, entity, *rest):
        if entity == "transacciones":
            raise OSError("no space left")
        return whole(df, entity, *rest)

    monkeypatch.setattr(entities, "enrich", broken)
    for name in ("m10_support", "m9_predictions", "s6_load_all_gold"):
        with pytest.raises(pipeline.RunFailed, match="transacciones.*no space left"):
            sample_queries.QUERIES[name](spark, str(tmp_path))
    log = sample_queries._zone_paths(spark, str(tmp_path))[1]
    assert {r["entity"] for r in audit.read(spark, log).where("status = 'failed'").collect()} == {"transacciones"}


def test_run_all_runs_every_table_and_tells_of_failures(spark, zones, tmp_path):
    log = f"{tmp_path}/audit"
    put(zones, "prestamos", LOANS)
    with pytest.raises(pipeline.RunFailed, match="usuarios"):
        pipeline.run_all(spark, zones, AS_OF, log)
    status = {r["entity"]: r["status"] for r in audit.read(spark, log).collect()}
    assert status == dict.fromkeys(schemas.ENTITIES, "failed") | {"prestamos": "ok"}


def test_runs_at_the_same_time_each_have_their_audit_row(spark, tmp_path):
    from multiprocessing.pool import ThreadPool

    with ThreadPool(5) as pool:
        pool.map(lambda e: audit.append(spark, f"{tmp_path}/audit", entity=e, status="ok"), schemas.ENTITIES, 1)
    assert {r["entity"] for r in audit.read(spark, f"{tmp_path}/audit").collect()} == set(schemas.ENTITIES)
