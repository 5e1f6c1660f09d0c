"""Aggregates, joins and label, also with heavy and missing keys."""

import random

from pyspark.sql import functions as F

from caudal import schemas
from caudal.operators import features, lookup, risk, skew
from caudal.schemas import gold_schema


def gold(spark, entity, rows):
    schema = gold_schema(entity)
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def bank(spark, loans=()):
    users = gold(spark, "usuarios", [
        dict(user_id="u1", edad=30, ingreso_mensual_estimado=1e6, antiguedad_cliente=1, estado_laboral="EMPLEADO"),
        dict(user_id="u2", edad=20, ingreso_mensual_estimado=0.0, antiguedad_cliente=9, estado_laboral="ESTUDIANTE"),
        dict(user_id=None, edad=50, ingreso_mensual_estimado=9e6, antiguedad_cliente=9, estado_laboral="OTRO"),
    ])
    accounts = gold(spark, "cuentas", [
        dict(account_id="a1", user_id="u1", saldo_actual=10.0), dict(account_id="a2", user_id="u1"),
        dict(account_id="a2", user_id="u1", saldo_actual=5.0), dict(account_id=None, user_id="u1", saldo_actual=1.0),
        dict(account_id="a9", user_id=None, saldo_actual=99.0),
    ])
    tx = gold(spark, "transacciones", [
        *[dict(transaction_id=str(i), account_id="a1", monto=float(i)) for i in range(4)],
        dict(transaction_id="x", account_id=None, monto=1e9),
    ])
    return users, accounts, tx, gold(spark, "prestamos", loans)


def rows(df, key="user_id"):
    return {r[key]: r for r in df.collect()}


def test_null_accounts_are_ignored(spark):
    _, _, tx, _ = bank(spark)
    got = features.transactions_per_account(tx).collect()
    assert [(r.account_id, r.num_total_transacciones_cuenta, r.monto_total_transacciones_cuenta) for r in got] == [("a1", 4, 6.0)]


def test_feature_table(spark):
    got = rows(features.feature_table(*bank(spark)))
    u1 = got["u1"]
    assert len(got) == 3
    assert (u1.num_total_cuentas, u1.saldo_total_en_cuentas) == (2, 16.0)
    assert u1.promedio_transacciones_por_cuenta == 4.0      # accounts without transactions do not count
    assert u1.monto_total_movido_por_usuario == 6.0
    for user in ("u2", None):
        assert [got[user][c] for c in [*schemas.ACCOUNT_FEATURES, *schemas.LOAN_FEATURES]] == [0] * 7


def test_label_with_empty_loans(spark):
    got = rows(risk.with_risk(features.feature_table(*bank(spark)), "regla"))
    assert {u: (r.regla, r.riesgo) for u, r in got.items()} == {"u1": (1, 1), "u2": (4, 1), None: (None, 0)}


def test_label_with_loans(spark):
    loans = [dict(loan_id="l1", user_id="u2", monto_otorgado=10.0), dict(loan_id="l2", user_id="u2"),
             dict(loan_id="l3", user_id=None, monto_otorgado=5.0)]
    got = rows(risk.with_risk(features.feature_table(*bank(spark, loans)), "regla"))["u2"]
    assert (got.num_total_prestamos, got.monto_total_prestado, got.promedio_monto_prestamo, got.regla) == (2, 10.0, 5.0, 2)


def skewed(spark):
    """A third of the rows on one key, a tenth without key."""
    rnd = random.Random(3)
    left = [(i, None if i % 10 == 0 else ("hot" if i % 3 == 0 else f"k{rnd.randrange(400)}")) for i in range(6000)]
    right = [("hot", 1)] + [(f"k{i}", i) for i in range(0, 400, 2)]
    return left, right, spark.createDataFrame(left, "id int, k string"), spark.createDataFrame(right, "k string, v int")


def test_spread_join_equals_plain_join(spark):
    left, right, l, r = skewed(spark)
    lookup_ = dict(right)
    expected = sorted((i, k, lookup_.get(k)) for i, k in left if True)
    for min_rows in (1, skew.MIN_ROWS):
        got = skew.spread_left_join(l, r, ["k"], ["id"], min_rows).select("id", "k", "v")
        assert sorted(map(tuple, got.collect())) == expected


def test_spread_join_spreads_the_heavy_key(spark):
    _, _, l, r = skewed(spark)
    keys = skew.heavy_keys(l.select("k"), F.xxhash64("k"), 1000)
    assert keys == [spark.sql("select xxhash64('hot')").first()[0]]
    assert skew.heavy_keys(l.select("k"), F.xxhash64("k")) == []
    assert skew.heavy_keys(l.where("id < 0").select("k"), F.xxhash64("k")) == []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew.spread_left_join(l, r, ["k"], ["id"], 1000)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [k" in plan and plan.count("_salt") > 4
        largest = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        plain = l.join(r, "k", "left").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert largest < 0.4 * l.count() < plain


def test_account_list_and_pick(spark):
    accounts = [("big" if i % 3 == 0 else f"u{i % 7}", f"a{i}") for i in range(900)]
    df = spark.createDataFrame(accounts, "user_id string, account_id string")
    listed = lookup.account_list(df).collect()
    assert len(listed) == 900
    for user in {u for u, _ in accounts}:
        mine = [r for r in listed if r.user_id == user]
        assert sorted(r.orden for r in mine) == list(range(1, len(mine) + 1))
        assert {r.num_cuentas for r in mine} == {len(mine)}
    dated = df.withColumn("fecha_apertura", F.lit("2020-01-01").cast("timestamp"))
    wanted = spark.createDataFrame([(i, "big" if i % 2 else "nobody") for i in range(500)], "id int, user_id string")
    picked = lookup.pick_account(wanted, dated, F.col("id"), ["id"], min_rows=10).collect()
    assert len(picked) == 250
    assert {r.account_id for r in picked} <= {a for u, a in accounts if u == "big"}


def test_independent_of_shuffle_partitions(spark, sf):
    from caudal.plans.sample_queries import QUERIES

    seen = []
    for n in ("1", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        seen.append(sorted(map(tuple, QUERIES["j5_feature_table"](spark, sf).collect()), key=repr))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert seen[0] == seen[1]
