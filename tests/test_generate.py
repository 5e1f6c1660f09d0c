"""Constraints of the synthetic tables, and their independence of partitioning."""

import math

from pyspark.sql import functions as F

from caudal.operators import generate
from caudal.plans import pipeline
from caudal.sources import tables

AS_OF = "2025-01-01 00:00:00"
USERS = 400


def make(spark, parts=4):
    return generate.generate_all(spark.range(0, USERS, 1, parts), spark.range(50), AS_OF)


def test_constraints(spark):
    t = {k: v.persist() for k, v in make(spark).items()}
    users = t["usuarios"].withColumns({
        "birth": F.to_date("fecha_de_nacimiento"), "reg": F.to_timestamp("fecha_registro_banco")})
    assert users.select("user_id").distinct().count() == users.select("cedula").distinct().count() == USERS
    bad = users.where(
        "not (length(cedula) between 8 and 10) or reg < date_add(birth, 18 * 365) or reg > timestamp'2025-01-01' "
        "or not (floor(datediff(date'2025-01-01', birth) / 365.25) between 18 and 75) "
        "or not (ingreso_mensual_estimado = 0 or ingreso_mensual_estimado between 800000 and 15000000)")
    assert bad.count() == 0
    zero = users.where("ingreso_mensual_estimado = 0").count() / USERS
    assert 0.04 < zero < 0.17

    accounts = t["cuentas"].join(users.select("user_id", "reg"), "user_id")
    assert accounts.count() == t["cuentas"].count()
    assert accounts.where("to_timestamp(fecha_apertura) < reg or saldo_actual not between -50000 and 25000000").count() == 0
    per_user = t["cuentas"].groupBy("user_id").count().agg(F.min("count"), F.max("count"), F.count("*")).first()
    assert tuple(per_user) == (1, 3, USERS)

    tx = t["transacciones"].join(
        t["cuentas"].select("account_id", F.col("user_id").alias("owner"), "fecha_apertura"), "account_id")
    assert tx.count() == t["transacciones"].count() == tx.select("transaction_id").distinct().count()
    assert tx.where("owner <> user_id or fecha < fecha_apertura or fecha > '2025-01-01T00:00:00'").count() == 0
    sizes = tx.groupBy("user_id").count().agg(F.min("count"), F.max("count")).first()
    assert 5 <= sizes[0] and sizes[1] <= 50
    sent = tx.where("tipo_transaccion = 'Transferencia Enviada'")
    assert 0.6 < sent.where("recipient_id_fk is not null").count() / sent.count() < 0.8
    assert tx.where("recipient_id_fk is not null and tipo_transaccion <> 'Transferencia Enviada'").count() == 0
    assert sent.select("recipient_id_fk").dropna().join(
        t["destinatarios"], F.col("recipient_id_fk") == F.col("recipient_id"), "left_anti").count() == 0
    for name, low, high, _ in generate.TRANSACCIONES:
        assert tx.where((F.col("tipo_transaccion") == name) & ~F.col("monto").between(low, high)).count() == 0

    loans = t["prestamos"].join(users.select("user_id", "reg"), "user_id")
    assert loans.count() == round(USERS * 0.25) == loans.select("user_id").distinct().count()
    assert loans.where("to_timestamp(fecha_desembolso) < reg + interval 90 days").count() == 0


def test_annuity(spark):
    got = spark.sql("select 1000000d as p, 12 as n").select(generate.instalment(F.col("p"), F.col("n"))).first()[0]
    assert math.isclose(got, 90258.31)


def test_same_output_for_any_partitioning(spark):
    one, many = make(spark, 1), make(spark, 9)
    for name in one:
        assert one[name].exceptAll(many[name]).count() == 0


def test_any_recipient_ids(spark):
    """Ids with gaps, repeated ids and a null: every recipient is named, none other, and gaps alone change nothing else."""
    ids = spark.createDataFrame([(i,) for i in [5, 5, None, 17, 10**12, -3]], "id long")
    t = generate.generate_all(spark.range(USERS), ids, AS_OF)
    named = {r[0] for r in t["transacciones"].where("recipient_id_fk is not null").select("recipient_id_fk").collect()}
    assert named == {r[0] for r in t["destinatarios"].where("recipient_id is not null").select("recipient_id").collect()} - {
        r[0] for r in generate.generate_recipients(ids.where("id is null")).select("recipient_id").collect()}
    plain = generate.generate_transactions(spark.range(USERS), AS_OF, generate.numbering(spark.range(4)))
    assert t["transacciones"].drop("recipient_id_fk").exceptAll(plain.drop("recipient_id_fk")).count() == 0
    assert generate.numbering(spark.range(7, 9)) == generate.Recipients(2, 7)
    none = generate.generate_transactions(spark.range(5), AS_OF, generate.numbering(ids.limit(0)))
    assert none.where("recipient_id_fk is not null").count() == 0 < none.count()


def test_written_tables_run_through(spark, tmp_path):
    from caudal.sources.paths import Zones

    z = Zones(f"{tmp_path}/b", f"{tmp_path}/s", f"{tmp_path}/g")
    pipeline.write_synthetic(spark, z.bronze, AS_OF, users=40)
    answers = pipeline.run_all(spark, z, AS_OF)
    assert {a["statusCode"] for a in answers.values()} == {200}
    assert tables.load_all_gold(spark, z.gold)["usuarios"].where("edad between 18 and 75").count() == 40


def test_one_part_of_ids_becomes_many_tasks(spark):
    ids = spark.range(100).coalesce(1)
    for made in (generate.generate_transactions(ids, AS_OF), generate.generate_accounts(ids, AS_OF)):
        assert made.rdd.getNumPartitions() >= 4
    gapped = generate.numbering(spark.range(50).select((F.col("id") * 10).alias("id")))
    assert "Window" not in gapped.table._jdf.queryExecution().optimizedPlan().toString()
    made = generate.generate_transactions(ids, AS_OF, gapped)
    assert "SortMergeJoin" not in made._jdf.queryExecution().sparkPlan().toString()
