"""Synthetic banking tables of any size.

Every value is a function of the row's own key and the seed, so no made row is shuffled (but for a look-up where
recipient ids have gaps and are many), a transaction knows its account without looking it up, and the output does not depend on
partitioning. Only ids are, where each becomes many rows: a file of ids is small and would be one task.
``ids`` is any table with a distinct bigint ``id``; ``as_of`` is a midnight.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from caudal.functions.dates import instant
from caudal.operators.hashing import below, choose_per_group, digest, uuid_text, whole
from caudal.operators.numbering import numbered
from caudal.operators.skew import dealt
from caudal.session import scratch_dir

# Value domains, amount ranges in pesos, and table sizes.
ESTADOS_LABORALES = ["Empleado", "Independiente", "Desempleado", "Estudiante", "Pensionado"]
NIVELES_EDUCATIVOS = ["Primaria", "Secundaria", "Técnico", "Universitario", "Postgrado", "Ninguno"]
ESTADOS_CIVILES = ["Soltero(a)", "Casado(a)", "Unión Libre", "Divorciado(a)", "Viudo(a)"]
TIPOS_VIVIENDA = ["Propia", "Alquilada", "Familiar"]
TIPOS_CUENTA = ["Ahorros", "Corriente", "Nómina"]
ESTADOS_CUENTA = ["Activa", "Inactiva", "Bloqueada"]
COMPRAS = ["Alimentación", "Transporte", "Entretenimiento", "Ropa y Accesorios", "Hogar", "Salud",
           "Tecnología", "Viajes"]
SERVICIOS = ["Agua", "Luz", "Gas", "Internet", "Telefonía", "Televisión", "Administración"]
TRANSACCIONES = [  # type, lowest and highest amount, possible categories
    ("Compra", 5_000, 500_000, COMPRAS),
    ("Transferencia Enviada", 10_000, 2_000_000, ["Transferencia"]),
    ("Transferencia Recibida", 10_000, 3_000_000, ["Transferencia"]),
    ("Pago Servicio", 15_000, 300_000, SERVICIOS),
    ("Retiro ATM", 20_000, 1_000_000, ["Retiro"]),
    ("Depósito", 50_000, 5_000_000, ["Depósito"]),
    ("Pago Préstamo", 50_000, 1_500_000, ["Pago Obligación"]),
    ("Salario", 800_000, 10_000_000, ["Ingreso Nómina"]),
]
CANALES = ["Online", "POS", "ATM", "Sucursal", "App Móvil"]
TARJETAS = ["Crédito", "Débito", "N/A"]
ESTADOS_PRESTAMO = ["Activo", "Pagado", "En Mora"]
PROPOSITOS = ["Libre Inversión", "Compra Vehículo", "Educación", "Vivienda", "Deuda"]
PLAZOS = [12, 24, 36, 48, 60, 72]
BANCOS = ["Davivienda", "Bancolombia", "BBVA", "Banco de Bogotá", "Itaú", "Scotiabank Colpatria",
          "Banco Agrario", "Nequi", "Daviplata"]
USERS, RECIPIENTS, LOAN_SHARE = 150, 50, 0.25
ACCOUNTS_PER_USER, TRANSACTIONS_PER_USER = (1, 3), (5, 50)
INSTALMENT_RATE = 0.15

NOMBRES = ["Ana", "Luis", "María", "José", "Camila", "Andrés", "Sofía", "Jorge", "Lucía", "Óscar"]
APELLIDOS = ["Gómez", "Rodríguez", "Pérez", "Muñoz", "Castaño", "Ríos", "Herrera", "Vélez"]
CIUDADES = ["Bogotá", "Medellín", "Cali", "Cúcuta", "Ibagué", "Pereira", "Montería", "Tunja"]
PROFESIONES = ["Ingeniero", "Médica", "Docente", "Contador", "Abogada", "Electricista", "Diseñador"]

_CEDULA_RANGE, _CEDULA_STEP, _CEDULA_FIRST = 1_090_000_000, 618_033_989, 10_000_000
_MIN_AGE_DAYS, _MAX_AGE_DAYS = 6_575, 27_758   # at least 18 and less than 76 years of 365.25 days
SEED = 7


def _draws(seed: int, table: str, *key) -> Column:
    return digest(seed, table, *key)


def _pick(values: list, h: Column, draw: int) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (below(h, draw, len(values)) + 1).cast("int"))


def _money(h: Column, draw: int, low: int, high: int) -> Column:
    return (F.lit(low * 100) + below(h, draw, (high - low) * 100 + 1)) / 100


def _iso(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")


def _between(h: Column, draw: int, start: Column, end: Column) -> Column:
    """Second between two moments; the start itself when the end lies before it."""
    room = F.greatest(F.unix_seconds(end) - F.unix_seconds(start), F.lit(0)) + 1
    return F.timestamp_seconds(F.unix_seconds(start) + below(h, draw, room))


def _person(user: Column, seed: int, as_of) -> dict[str, Column]:
    """What other tables need to know about a user."""
    h = _draws(seed, "usuarios", user, 0)
    birth = F.date_sub(instant(as_of).cast("date"), (
        F.lit(_MIN_AGE_DAYS) + below(h, 2, _MAX_AGE_DAYS - _MIN_AGE_DAYS + 1)).cast("int"))
    adult = F.date_add(birth, 18 * 365).cast("timestamp")
    low, high = ACCOUNTS_PER_USER
    return {
        "user_id": uuid_text(_draws(seed, "user_id", user)),
        "_birth": birth,
        "_registered": _between(h, 3, adult, instant(as_of)),
        "_accounts": F.lit(low) + below(h, 0, high - low + 1),
    }


def generate_users(ids: DataFrame, as_of, seed: int = SEED) -> DataFrame:
    user = F.col("id")
    people = ids.select("id").withColumns(_person(user, seed, as_of))
    h1, h2, h3 = (_draws(seed, "usuarios", user, n) for n in (1, 2, 3))
    people = people.withColumns({"_h1": h1, "_h2": h2, "_h3": h3})
    h1, h2, h3 = F.col("_h1"), F.col("_h2"), F.col("_h3")
    cedula = (
        F.pmod(F.pmod(user, F.lit(_CEDULA_RANGE)) * _CEDULA_STEP, F.lit(_CEDULA_RANGE)) + _CEDULA_FIRST
        + F.floor(user / _CEDULA_RANGE) * 10_000_000_000
    )
    income = F.when(below(h1, 0, 10) == 0, F.lit(0.0)).otherwise(_money(h1, 1, 800_000, 15_000_000))
    return people.select(
        "user_id",
        cedula.cast("string").alias("cedula"),
        _pick(NOMBRES, h1, 2).alias("nombre"),
        _pick(APELLIDOS, h1, 3).alias("apellido"),
        _pick(CIUDADES, h2, 0).alias("ciudad_residencia"),
        F.col("_birth").cast("string").alias("fecha_de_nacimiento"),
        _pick(PROFESIONES, h2, 1).alias("profesion"),
        income.alias("ingreso_mensual_estimado"),
        _pick(ESTADOS_LABORALES, h2, 2).alias("estado_laboral"),
        _pick(NIVELES_EDUCATIVOS, h2, 3).alias("nivel_educativo"),
        _pick(ESTADOS_CIVILES, h3, 0).alias("estado_civil"),
        below(h3, 1, 6).cast("int").alias("numero_dependientes"),
        _pick(TIPOS_VIVIENDA, h3, 2).alias("tipo_vivienda"),
        _iso(F.col("_registered")).alias("fecha_registro_banco"),
    )


def _account(user: Column, number: Column, registered: Column, seed: int, as_of) -> dict[str, Column]:
    h = _draws(seed, "cuentas", user, number)
    return {
        "account_id": uuid_text(_draws(seed, "account_id", user, number)),
        "_opened": _between(h, 0, registered, instant(as_of)),
    }


def generate_accounts(ids: DataFrame, as_of, seed: int = SEED) -> DataFrame:
    """One to three accounts per user, opened after registration."""
    user, number = F.col("id"), F.col("_n")
    rows = dealt(ids.select("id")).withColumns(_person(user, seed, as_of)).withColumn(
        "_n", F.explode(F.sequence(F.lit(1), F.col("_accounts").cast("int")))
    ).withColumns(_account(user, number, F.col("_registered"), seed, as_of))
    rows = rows.withColumns(
        {"_h1": _draws(seed, "cuentas", user, number, 1), "_h2": _draws(seed, "cuentas", user, number, 2)})
    h1, h2 = F.col("_h1"), F.col("_h2")
    balance = (F.lit(-5_000_000) + below(h1, 0, 25_050_000) * 100 + below(h1, 1, 100)) / 100
    # 95 % take a random state, the rest are active
    state = F.when(below(h2, 0, 20) == 0, F.lit("Activa")).otherwise(_pick(ESTADOS_CUENTA, h2, 1))
    return rows.select(
        "account_id", "user_id",
        F.concat(F.lpad(whole(h1, 2).cast("string"), 10, "0"), F.lpad(whole(h1, 3).cast("string"), 10, "0"))
        .alias("numero_cuenta"),
        _pick(TIPOS_CUENTA, h2, 2).alias("tipo_cuenta"),
        _iso(F.col("_opened")).alias("fecha_apertura"),
        balance.alias("saldo_actual"),
        F.lit("COP").alias("moneda"),
        state.alias("estado_cuenta"),
    )


def _recipient_id(number: Column, seed: int) -> Column:
    return uuid_text(_draws(seed, "recipient_id", number))


def generate_recipients(ids: DataFrame, seed: int = SEED) -> DataFrame:
    number = F.col("id")
    rows = ids.select("id").withColumns(
        {"_h1": _draws(seed, "destinatarios", number, 1), "_h2": _draws(seed, "destinatarios", number, 2)})
    h1, h2 = F.col("_h1"), F.col("_h2")
    return rows.select(
        _recipient_id(number, seed).alias("recipient_id"),
        F.concat_ws(" ", _pick(NOMBRES, h1, 0), _pick(APELLIDOS, h1, 1)).alias("nombre_registrado"),
        _pick(BANCOS, h1, 2).alias("banco_destinatario"),
        _pick(TIPOS_CUENTA[:2], h1, 3).alias("tipo_cuenta_dest"),
        F.concat(F.lpad(whole(h2, 0).cast("string"), 10, "0"), F.lpad(whole(h2, 1).cast("string"), 10, "0"))
        .alias("numero_cuenta_dest"),
    )


@dataclass(frozen=True)
class Recipients:
    """Which recipients there are: `count` consecutive ids from `first` on, or a table (place, id) of other ids."""

    count: int
    first: int = 0
    table: DataFrame | None = None


def numbering(ids: DataFrame) -> Recipients:
    """Recipients a transaction can name. Where ids are consecutive it computes one instead of looking it up; any
    other ids get places without gaps, stored, to be looked up. Null and repeated ids count once or not at all."""
    known = ids.select("id").where("id is not null").distinct()
    first, last, count = known.agg(F.min("id"), F.max("id"), F.count("id")).first()
    if not count or last - first + 1 == count:
        return Recipients(count, first or 0)
    path = scratch_dir(ids.sparkSession, "places")
    numbered(known, ["id"], "place").write.parquet(path)  # its size decides how transactions look it up
    return Recipients(count, table=ids.sparkSession.read.parquet(path))


def _with_recipient(rows: DataFrame, place: Column, named: Column, recipients: Recipients) -> DataFrame:
    """Adds `_recipient`, the id of the recipient of that place, for the rows that name one."""
    if recipients.table is None:
        return rows.withColumn("_recipient", F.when(named, F.lit(recipients.first) + place))
    # Rows that name none get keys of their own, so they don't meet in one partition.
    apart = -1 - F.pmod(F.xxhash64("id", "_t"), F.lit(1 << 20))
    listed = recipients.table.select(F.col("place").alias("_place"), F.col("id").alias("_recipient"))
    return rows.withColumn("_at", F.when(named, place).otherwise(apart)).join(listed, F.col("_at") == F.col("_place"), "left")


def generate_transactions(
    ids: DataFrame, as_of, recipients: Recipients = Recipients(RECIPIENTS), seed: int = SEED
) -> DataFrame:
    """Five to fifty transactions per user on the user's own accounts, after their opening.

    ``recipients`` is what ``numbering`` says of the recipient ids. 70 % of outgoing transfers name one.
    """
    user, number = F.col("id"), F.col("_t")
    low, high = TRANSACTIONS_PER_USER
    size = F.lit(low) + below(_draws(seed, "volumen", user), 0, high - low + 1)
    rows = dealt(ids.select("id")).withColumns(_person(user, seed, as_of)).withColumn(
        "_t", F.explode(F.sequence(F.lit(1), size.cast("int")))
    )
    rows = rows.withColumns({
        f"_h{n}": _draws(seed, "transacciones", user, number, n) for n in (1, 2)
    })
    h1, h2 = F.col("_h1"), F.col("_h2")
    rows = rows.withColumns({
        "_n": below(h1, 0, F.col("_accounts")) + 1,
        "_type": below(h1, 1, len(TRANSACCIONES)),
    }).withColumns(_account(user, F.col("_n"), F.col("_registered"), seed, as_of))
    kind, amount, category = F, F, F
    for n, (name, least, most, categories) in enumerate(TRANSACCIONES):
        is_type = F.col("_type") == n
        kind = kind.when(is_type, F.lit(name))
        amount = amount.when(is_type, _money(h1, 2, least, most))
        category = category.when(is_type, _pick(categories, h1, 3))
    named = (kind == "Transferencia Enviada") & (below(h2, 2, 10) < 7) & F.lit(recipients.count > 0)
    place = below(_draws(seed, "destino", user, number), 0, max(recipients.count, 1))
    rows = _with_recipient(rows, place, named, recipients)
    return rows.select(
        uuid_text(_draws(seed, "transaction_id", user, number)).alias("transaction_id"),
        "account_id", "user_id",
        amount.alias("monto"),
        _iso(_between(h2, 0, F.col("_opened"), instant(as_of))).alias("fecha"),
        kind.alias("tipo_transaccion"),
        category.alias("categoria"),
        _pick(CANALES, h2, 1).alias("canal"),
        _pick(TARJETAS, h2, 3).alias("tipo_tarjeta_usada"),
        F.when(named, _recipient_id(F.col("_recipient"), seed)).alias("recipient_id_fk"),
        F.concat_ws(" ", F.lit("Movimiento"), number.cast("string"), F.lit("de"), kind).alias("descripcion"),
    )


def instalment(principal: Column, months: Column) -> Column:
    """Annuity at a fixed yearly rate, whatever rate the row itself states."""
    rate = INSTALMENT_RATE / 12
    return F.round(principal * (F.lit(rate) / (1 - F.pow(F.lit(1 + rate), -months))), 2)


def generate_loans(ids: DataFrame, as_of, share: float = LOAN_SHARE, seed: int = SEED) -> DataFrame:
    """An exact share of the users, each with one loan paid out 90 days after registration or later."""
    keyed = ids.select("id", F.lit(0).alias("_all"))
    quota = keyed.groupBy("_all").agg(F.round(F.count("*") * share).cast("bigint").alias("quota"))
    user = F.col("id")
    rows = choose_per_group(keyed, "_all", "id", quota, seed).where("chosen").select("id")
    rows = rows.withColumns(_person(user, seed, as_of)).withColumns(
        {"_h1": _draws(seed, "prestamos", user, 1), "_h2": _draws(seed, "prestamos", user, 2)})
    h1, h2 = F.col("_h1"), F.col("_h2")
    rows = rows.withColumns({"plazo_meses": _pick(PLAZOS, h1, 0), "_pesos": below(h1, 1, 49_000_000),
                             "_cents": below(h1, 2, 100)})
    rows = rows.withColumn("monto_otorgado", (F.lit(100_000_000) + F.col("_pesos") * 100 + F.col("_cents")) / 100)
    start = F.col("_registered") + F.expr("INTERVAL 90 DAYS")
    return rows.select(
        uuid_text(_draws(seed, "loan_id", user)).alias("loan_id"),
        "user_id", "monto_otorgado",
        ((F.lit(1_500) + below(h1, 3, 2_001)) / 100).alias("tasa_interes_anual"),
        "plazo_meses",
        _iso(_between(h2, 0, start, instant(as_of))).alias("fecha_desembolso"),
        instalment(F.col("monto_otorgado"), F.col("plazo_meses")).alias("cuota_mensual"),
        _pick(ESTADOS_PRESTAMO, h2, 1).alias("estado_prestamo"),
        _pick(PROPOSITOS, h2, 2).alias("proposito"),
    )


def generate_all(
    user_ids: DataFrame, recipient_ids: DataFrame, as_of, seed: int = SEED
) -> dict[str, DataFrame]:
    recipients = numbering(recipient_ids)
    return {
        "usuarios": generate_users(user_ids, as_of, seed),
        "cuentas": generate_accounts(user_ids, as_of, seed),
        "destinatarios": generate_recipients(recipient_ids, seed),
        "transacciones": generate_transactions(user_ids, as_of, recipients, seed),
        "prestamos": generate_loans(user_ids, as_of, seed=seed),
    }
