"""The same results as ``sample_queries`` in plain SQL over the test tables.

Written independently of the DataFrame code: the SQL states rules, bins and joins in its own
words. Statements are put together from named common table expressions.
"""

from __future__ import annotations

import re

_WS = "E' \\t\\n\\r'"


def _pick(items: str, index: str) -> str:
    return f"([{items}])[CAST({index} AS INTEGER) + 1]"


def _norm(column: str) -> str:
    return f"upper(trim(strip_accents({column}), {_WS}))"


def _num(column: str) -> str:
    return f"try_cast({column} AS DOUBLE)"


def _money(expression: str) -> str:
    return f"CAST(CAST({expression} AS DECIMAL(18, 2)) AS VARCHAR)"


_NOW = "TIMESTAMP '2002-01-01 00:00:00'"


def _days(moment: str) -> str:
    return f"floor((epoch_us({_NOW}) - epoch_us({moment})) / 86400000000.0)"


def _years(moment: str) -> str:
    return f"CAST(floor({_days(moment)} / 365.25) AS INTEGER)"


def _bins(column: str, *cases: str, low: str | None = None) -> str:
    first = f"WHEN {column} < {low} THEN NULL " if low else ""
    steps = " ".join(f"WHEN {column} < {edge} THEN '{label}'" for edge, label in (c.split(":") for c in cases))
    return f"CASE WHEN {column} IS NULL THEN NULL {first}{steps} END"


def _employment(order: str) -> str:
    steps = " ".join(f"WHEN estado_laboral LIKE '%{w}%' THEN '{w}'" for w in order.split())
    return f"CASE WHEN estado_laboral IS NULL THEN 'DESCONOCIDO' {steps} ELSE 'OTRO' END"


def _account_state(order: str) -> str:
    steps = " ".join("WHEN estado_cuenta LIKE '%{}%' THEN '{}'".format(*w.split(":")) for w in order.split())
    return f"CASE WHEN estado_cuenta IS NULL THEN 'DESCONOCIDO' {steps} ELSE estado_cuenta END"


def _transaction_type(salary: str) -> str:
    t = "tipo_transaccion"
    return f"""CASE WHEN {t} IS NULL THEN 'DESCONOCIDO'
        WHEN {t} LIKE '%DEPOSITO%' THEN 'DEPOSITO'
        WHEN {t} LIKE '%TRANSFERENCIA%' THEN
            CASE WHEN {t} LIKE '%ENVIADA%' THEN 'TRANSFERENCIA_ENVIADA'
                 WHEN {t} LIKE '%RECIBIDA%' THEN 'TRANSFERENCIA_RECIBIDA' ELSE 'TRANSFERENCIA' END
        WHEN {t} LIKE '%PAGO%' AND {t} LIKE '%PRESTAMO%' THEN 'PAGO_PRESTAMO'
        WHEN {t} LIKE '%PAGO%' AND {t} LIKE '%SERVICIO%' THEN 'PAGO_SERVICIO'
        WHEN {t} LIKE '%COMPRA%' THEN 'COMPRA'
        WHEN {t} LIKE '%RETIRO%' OR {t} LIKE '%ATM%' THEN 'RETIRO'
        WHEN {t} LIKE '%SALARIO%' {salary} THEN 'SALARIO' ELSE {t} END"""


_USER_SILVER = """SELECT * REPLACE ({employment} AS estado_laboral,
    CASE WHEN nivel_educativo IS NULL THEN 'DESCONOCIDO'
         WHEN nivel_educativo LIKE '%NINGUNO%' THEN 'NINGUNO' WHEN nivel_educativo LIKE '%PRIMARIA%' THEN 'PRIMARIA'
         WHEN nivel_educativo LIKE '%SECUNDARIA%' THEN 'SECUNDARIA' WHEN nivel_educativo LIKE '%TECNICO%' THEN 'TECNICO'
         WHEN nivel_educativo LIKE '%UNIVERSITARIO%' THEN 'UNIVERSITARIO'
         WHEN nivel_educativo LIKE '%POSTGRADO%' THEN 'POSTGRADO' ELSE 'OTRO' END AS nivel_educativo),
    {age} AS edad, {tenure} AS antiguedad_cliente FROM usuarios_t"""

_USER_GOLD = """SELECT user_id, cedula, nombre, apellido, ciudad_residencia, fecha_de_nacimiento, edad,
    {age} AS rango_edad, profesion, ingreso_mensual_estimado, {income} AS categoria_ingresos, estado_laboral,
    nivel_educativo, estado_civil, numero_dependientes, CAST(numero_dependientes > 0 AS INTEGER) AS tiene_dependientes,
    tipo_vivienda, CAST(coalesce(tipo_vivienda = 'PROPIA', false) AS INTEGER) AS vivienda_propia,
    fecha_registro_banco, antiguedad_cliente FROM {silver}""".format(
    age=_bins("edad", "25:18-25", "35:26-35", "45:36-45", "55:46-55", "65:56-65", "1e300:65+",
              low="0"),
    income=_bins("ingreso_mensual_estimado", "1000000:MUY BAJOS", "3000000:BAJOS", "6000000:MEDIOS", "10000000:ALTOS",
                 "1e300:MUY ALTOS"),
    silver="{silver}",
)

_FEATURES = """SELECT u.*,
    coalesce(a.num_total_cuentas, 0) AS num_total_cuentas,
    coalesce(a.saldo_total_en_cuentas, 0) AS saldo_total_en_cuentas,
    coalesce(a.promedio_transacciones_por_cuenta, 0) AS promedio_transacciones_por_cuenta,
    coalesce(a.monto_total_movido_por_usuario, 0) AS monto_total_movido_por_usuario,
    coalesce(l.num_total_prestamos, 0) AS num_total_prestamos,
    coalesce(l.monto_total_prestado, 0) AS monto_total_prestado,
    coalesce(l.promedio_monto_prestamo, 0) AS promedio_monto_prestamo
    FROM {gold} u LEFT JOIN per_user a ON u.user_id = a.user_id LEFT JOIN loans_user l ON u.user_id = l.user_id"""

_LABEL = """SELECT *, CASE
    WHEN ingreso_mensual_estimado < 1500000 AND antiguedad_cliente < 2 THEN 1
    WHEN estado_laboral IN ('DESEMPLEADO', 'ESTUDIANTE') AND num_total_prestamos > 0 THEN 2
    WHEN ingreso_mensual_estimado < 2000000 AND num_total_prestamos > 1 THEN 3
    WHEN edad < 22 AND ingreso_mensual_estimado = 0 THEN 4 END AS regla,
    CASE WHEN regla IS NULL THEN 0 ELSE 1 END AS riesgo FROM {features}"""

_ACCOUNT_SILVER = """SELECT * REPLACE (
    CASE WHEN tipo_cuenta IS NULL THEN 'DESCONOCIDO' WHEN tipo_cuenta LIKE '%CORRIENTE%' THEN 'CORRIENTE'
         WHEN tipo_cuenta LIKE '%AHORROS%' THEN 'AHORROS' WHEN tipo_cuenta LIKE '%NOMINA%' THEN 'NOMINA'
         ELSE tipo_cuenta END AS tipo_cuenta, {state} AS estado_cuenta),
    CASE WHEN length(numero_cuenta) > 4 THEN '****' || right(numero_cuenta, 4) ELSE numero_cuenta END
        AS numero_cuenta_masked,
    CAST(year(fecha_apertura) AS INTEGER) AS anio_apertura, CAST(month(fecha_apertura) AS INTEGER) AS mes_apertura,
    CAST(day(fecha_apertura) AS INTEGER) AS dia_apertura FROM cuentas_t"""

_TX_SILVER = """SELECT * EXCLUDE (descripcion) REPLACE ({type} AS tipo_transaccion,
    CASE WHEN categoria IS NULL THEN 'OTRO' WHEN categoria LIKE '%TECNOLOG%' THEN 'TECNOLOGIA'
         WHEN categoria LIKE '%ENTRETENIMIENTO%' THEN 'ENTRETENIMIENTO'
         WHEN categoria LIKE '%ROPA%' OR categoria LIKE '%ACCESORIO%' THEN 'ROPA_Y_ACCESORIOS'
         WHEN categoria LIKE '%ALIMENT%' THEN 'ALIMENTACION' WHEN categoria LIKE '%SALUD%' THEN 'SALUD'
         WHEN categoria LIKE '%VIAJE%' THEN 'VIAJES' WHEN categoria LIKE '%HOGAR%' THEN 'HOGAR'
         WHEN categoria LIKE '%TRANSPORTE%' THEN 'TRANSPORTE' WHEN categoria LIKE '%SERVICIO%' THEN 'SERVICIO'
         WHEN categoria LIKE '%OBLIGACION%' THEN 'PAGO_OBLIGACION' ELSE categoria END AS categoria),
    CAST(year(fecha) AS INTEGER) AS anio, CAST(month(fecha) AS INTEGER) AS mes, CAST(day(fecha) AS INTEGER) AS dia,
    CAST(hour(fecha) AS INTEGER) AS hora FROM transacciones_t"""

_E_REF = "EMPLEADO INDEPENDIENTE DESEMPLEADO PENSIONADO ESTUDIANTE"
_E_FIX = "DESEMPLEADO EMPLEADO INDEPENDIENTE PENSIONADO ESTUDIANTE"

CTES = {
    "usuarios_b": f"""SELECT CAST(k AS VARCHAR) AS user_id, lpad(CAST(k AS VARCHAR), 10, '0') AS cedula,
        {_pick("' José', 'María ', 'Ángela', 'Zoë', 'Iñigo'", "k % 5")} AS nombre,
        {_pick("'Núñez', 'Pérez', 'Gómez', ' Ríos '", "k % 4")} AS apellido,
        'Ciudad ' || c_nationkey AS ciudad_residencia,
        CAST(DATE '2002-01-01' - CAST(6570 + k * 53 % 20800 AS INTEGER) AS VARCHAR) AS fecha_de_nacimiento,
        {_pick("'Ingeniero', 'Médica', 'Abogado', 'Diseñador ', NULL, 'Electricista', 'N/A'", "k % 7")} AS profesion,
        {_money("greatest(c_acctbal, 0) * 1500")} AS ingreso_mensual_estimado,
        {_pick("' Empleado', 'Independiente', 'Desempleado', 'Estudiante', 'Pensionado', NULL", "k % 6")}
            AS estado_laboral,
        {_pick("'Primaria', 'Secundaria', ' Técnico', 'Universitario', 'Postgrado', 'Ninguno', NULL, 'Doctorado'", "k % 8")}
            AS nivel_educativo,
        {_pick("'Soltero(a)', 'Casado(a)', 'Unión Libre', NULL, 'Separado(a)'", "k % 5")} AS estado_civil,
        {_pick("' 2', '0', 'x', NULL, '3.7'", "k % 5")} AS numero_dependientes,
        {_pick("'Propia', E' Alquilada\\t', 'Familiar', 'N/A'", "k % 4")} AS tipo_vivienda,
        CAST(DATE '2002-01-01' - CAST(k * 37 % 3650 AS INTEGER) AS VARCHAR) || 'T00:00:00' AS fecha_registro_banco
        FROM (SELECT *, c_custkey AS k FROM customer)""",
    "usuarios_t": f"""SELECT user_id, cedula, {_norm("nombre")} AS nombre, {_norm("apellido")} AS apellido,
        {_norm("ciudad_residencia")} AS ciudad_residencia, try_cast(fecha_de_nacimiento AS TIMESTAMP) AS fecha_de_nacimiento,
        {_norm("nullif(profesion, 'N/A')")} AS profesion,
        coalesce({_num("ingreso_mensual_estimado")}, 0) AS ingreso_mensual_estimado,
        {_norm("estado_laboral")} AS estado_laboral, {_norm("nivel_educativo")} AS nivel_educativo,
        {_norm("estado_civil")} AS estado_civil,
        CAST(coalesce(trunc({_num("numero_dependientes")}), 0) AS INTEGER) AS numero_dependientes,
        {_norm("nullif(tipo_vivienda, 'N/A')")} AS tipo_vivienda,
        try_cast(fecha_registro_banco AS TIMESTAMP) AS fecha_registro_banco FROM usuarios_b""",
    "usuarios_s": _USER_SILVER.format(employment=_employment(_E_REF), age=_years("fecha_de_nacimiento"),
                                      tenure=_years("fecha_registro_banco")),
    "usuarios_sc": _USER_SILVER.format(employment=_employment(_E_FIX), age=_years("fecha_de_nacimiento"),
                                       tenure=_years("fecha_registro_banco")),
    "usuarios_g": _USER_GOLD.format(silver="usuarios_s"),
    "usuarios_gc": _USER_GOLD.format(silver="usuarios_sc"),
    "cuentas_b": f"""SELECT CAST(k AS VARCHAR) AS account_id, CAST(o_custkey AS VARCHAR) AS user_id,
        right(lpad(CAST(k AS VARCHAR), 12, '0'), CASE WHEN k % 50 = 0 THEN 4 ELSE 12 END) AS numero_cuenta,
        {_pick("'Ahorros', 'Corriente', 'Nómina', NULL", "k % 4")} AS tipo_cuenta,
        CASE WHEN k % 307 = 306 THEN 'bad' ELSE strftime(o_orderdate, '%Y-%m-%d') ||
            {_pick("'T00:00:00', 'T23:30:00.5'", "k % 2")} END AS fecha_apertura,
        CASE WHEN k % 97 = 96 THEN 'x' ELSE {_money("o_totalprice * 55 - 500000")} END AS saldo_actual,
        ' cop ' AS moneda,
        CASE o_orderstatus WHEN 'O' THEN 'Activa' WHEN 'F' THEN ' Inactiva' WHEN 'P' THEN 'Bloqueada' END AS estado_cuenta
        FROM (SELECT *, o_orderkey AS k FROM orders)""",
    "cuentas_t": f"""SELECT account_id, user_id, numero_cuenta, {_norm("tipo_cuenta")} AS tipo_cuenta,
        try_cast(fecha_apertura AS TIMESTAMP) AS fecha_apertura, {_num("saldo_actual")} AS saldo_actual,
        {_norm("moneda")} AS moneda, {_norm("estado_cuenta")} AS estado_cuenta FROM cuentas_b""",
    "cuentas_s": _ACCOUNT_SILVER.format(state=_account_state("ACTIV:ACTIVA INACTIV:INACTIVA BLOQUEAD:BLOQUEADA")),
    "cuentas_sc": _ACCOUNT_SILVER.format(state=_account_state("INACTIV:INACTIVA ACTIV:ACTIVA BLOQUEAD:BLOQUEADA")),
    "cuentas_g": f"""SELECT account_id, user_id, numero_cuenta_masked, tipo_cuenta, fecha_apertura, anio_apertura,
        mes_apertura, dia_apertura, round({_days("fecha_apertura")} / 365.0, 1) AS antiguedad_anios, saldo_actual,
        {_bins("saldo_actual", "1000000:MUY_BAJO", "5000000:BAJO", "10000000:MEDIO", "20000000:ALTO", "1e300:MUY_ALTO")}
            AS categoria_saldo, moneda, estado_cuenta,
        CAST(tipo_cuenta = 'AHORROS' AS INTEGER) AS cuenta_protegida,
        CAST(estado_cuenta = 'BLOQUEADA' AS INTEGER) AS cuenta_bloqueada FROM cuentas_s""",
    "transacciones_b": f"""SELECT o || '-' || n AS transaction_id,
        CASE WHEN o % 41 = 40 THEN 'N/A' ELSE CAST(o AS VARCHAR) END AS account_id,
        CAST(l_suppkey AS VARCHAR) AS user_id,
        CASE WHEN (o + n) % 113 = 112 THEN 'x' ELSE {_money("l_extendedprice * l_quantity")} END AS monto,
        strftime(l_shipdate, '%Y-%m-%d') || 'T' || lpad(CAST((o * 7 + n) % 24 AS VARCHAR), 2, '0') || ':15:00' AS fecha,
        {_pick("'Compra', 'Transferencia Enviada', 'Transferencia Recibida', 'Pago Servicio', 'Retiro ATM', 'Depósito', "
               "'Pago Préstamo', 'Salario', 'Nómina', NULL, ' Ajuste ', 'Transferencia'", "(o + n) % 12")}
            AS tipo_transaccion,
        {_pick("'Alimentación', 'Transporte', 'Entretenimiento', 'Ropa y Accesorios', 'Hogar', 'Salud', 'Tecnología', "
               "'Viajes', 'Servicio de aseo', 'Pago Obligación', NULL, 'Comisión Bancaria', 'Agua', 'Retiro'",
               "(o * 3 + n) % 14")} AS categoria,
        {_pick("'Online', 'POS', 'ATM', 'Sucursal', 'App Móvil'", "n % 5")} AS canal,
        {_pick("'Crédito', 'Débito', 'N/A'", "(o + n) % 3")} AS tipo_tarjeta_usada,
        CASE WHEN (o + n) % 12 = 1 THEN CAST(l_suppkey AS VARCHAR) END AS recipient_id_fk,
        'mov ' || n AS descripcion FROM (SELECT *, l_orderkey AS o, l_linenumber AS n FROM lineitem)""",
    "transacciones_t": f"""SELECT transaction_id, nullif(account_id, 'N/A') AS account_id, user_id,
        coalesce({_num("monto")}, 0) AS monto, try_cast(fecha AS TIMESTAMP) AS fecha,
        {_norm("tipo_transaccion")} AS tipo_transaccion, {_norm("categoria")} AS categoria, {_norm("canal")} AS canal,
        {_norm("nullif(tipo_tarjeta_usada, 'N/A')")} AS tipo_tarjeta_usada, recipient_id_fk, descripcion
        FROM transacciones_b""",
    "transacciones_s": _TX_SILVER.format(type=_transaction_type("")),
    "transacciones_sc": _TX_SILVER.format(type=_transaction_type("OR tipo_transaccion LIKE '%NOMINA%'")),
    "transacciones_g": f"""SELECT transaction_id, account_id, user_id, monto,
        {_bins("monto", "100000:MUY_PEQUEÑO", "500000:PEQUEÑO", "1000000:MEDIANO", "5000000:GRANDE", "1e300:MUY_GRANDE")}
            AS categoria_monto, CAST(monto > 1000000 AS INTEGER) AS transaccion_grande, fecha, anio, mes, dia, hora,
        {_bins("hora", "6:MADRUGADA", "12:MAÑANA", "18:TARDE", "24:NOCHE", low="0")} AS periodo_dia,
        tipo_transaccion, categoria, canal, tipo_tarjeta_usada, recipient_id_fk FROM transacciones_s""",
    "prestamos_b": f"""SELECT CAST(k AS VARCHAR) AS loan_id, CAST(o_custkey AS VARCHAR) AS user_id,
        CASE WHEN k % 29 = 28 THEN 'x' ELSE {_money("o_totalprice * 100")} END AS monto_otorgado,
        CASE WHEN k % 31 = 30 THEN '-1' ELSE CAST(CAST(10 + (k % 250) / 10 AS DECIMAL(6, 1)) AS VARCHAR) END
            AS tasa_interes_anual,
        {_pick("'12', '24', '36', '48', '60', '72'", "k % 6")} AS plazo_meses,
        strftime(o_orderdate, '%Y-%m-%d') AS fecha_desembolso, {_money("o_totalprice")} AS cuota_mensual,
        {_pick("'Activo', 'Pagado', 'En Mora', NULL, 'Castigado'", "k % 5")} AS estado_prestamo,
        {_pick("'Libre Inversión', 'Compra Vehículo', 'Educación', 'Vivienda', 'Deuda', NULL, 'Viaje'", "k % 7")}
            AS proposito
        FROM (SELECT *, o_orderkey AS k FROM orders)""",
    "prestamos_t": f"""SELECT loan_id, user_id, {_num("monto_otorgado")} AS monto_otorgado,
        {_num("tasa_interes_anual")} AS tasa_interes_anual, {_num("plazo_meses")} AS plazo_meses,
        try_cast(fecha_desembolso AS TIMESTAMP) AS fecha_desembolso, {_num("cuota_mensual")} AS cuota_mensual,
        {_norm("estado_prestamo")} AS estado_prestamo, {_norm("proposito")} AS proposito FROM prestamos_b""",
    "prestamos_s": """SELECT * REPLACE (
        CASE WHEN estado_prestamo IS NULL THEN 'DESCONOCIDO' WHEN estado_prestamo LIKE '%ACTIV%' THEN 'ACTIVO'
             WHEN estado_prestamo LIKE '%MORA%' THEN 'EN_MORA' WHEN estado_prestamo LIKE '%PAGAD%' THEN 'PAGADO'
             ELSE estado_prestamo END AS estado_prestamo,
        CASE WHEN proposito IS NULL THEN 'OTRO' WHEN proposito LIKE '%VIVIENDA%' THEN 'VIVIENDA'
             WHEN proposito LIKE '%VEHICULO%' THEN 'VEHICULO' WHEN proposito LIKE '%EDUCACION%' THEN 'EDUCACION'
             WHEN proposito LIKE '%DEUDA%' THEN 'DEUDA'
             WHEN proposito LIKE '%LIBRE%' AND proposito LIKE '%INVERSION%' THEN 'LIBRE_INVERSION'
             ELSE proposito END AS proposito),
        CAST(year(fecha_desembolso) AS INTEGER) AS anio_desembolso, CAST(month(fecha_desembolso) AS INTEGER) AS mes_desembolso,
        CAST(day(fecha_desembolso) AS INTEGER) AS dia_desembolso FROM prestamos_t""",
    "prestamos_g": f"""SELECT loan_id, user_id, monto_otorgado,
        {_bins("monto_otorgado", "10000000:PEQUEÑO", "20000000:MEDIANO", "30000000:GRANDE", "40000000:MUY_GRANDE",
               "1e300:EXTRA_GRANDE")} AS categoria_monto,
        CAST(coalesce(monto_otorgado > 20000000, false) AS INTEGER) AS prestamo_grande, tasa_interes_anual,
        {_bins("tasa_interes_anual", "15:MUY_BAJA", "20:BAJA", "25:MEDIA", "30:ALTA", "1e300:MUY_ALTA", low="0")}
            AS categoria_tasa,
        monto_otorgado * (tasa_interes_anual / 100) * (plazo_meses / 12) AS interes_total_estimado, plazo_meses,
        fecha_desembolso, anio_desembolso, mes_desembolso, dia_desembolso, cuota_mensual, estado_prestamo, proposito
        FROM prestamos_s""",
    "destinatarios_b": f"""SELECT CAST(k AS VARCHAR) AS recipient_id,
        {_pick("'José  Pérez', 'Ana', 'María José Ríos', NULL", "k % 4")} AS nombre_registrado,
        {_pick("'Davivienda', 'Bancolombia', 'BBVA', 'Banco de Bogotá', 'Itaú', 'Scotiabank Colpatria', 'Banco Agrario', "
               "'Nequi', 'Daviplata', NULL, 'Banco X'", "k % 11")} AS banco_destinatario,
        {_pick("'Ahorros', 'cuenta de ahorro', 'Corriente', NULL, 'Depósito'", "k % 5")} AS tipo_cuenta_dest,
        CASE WHEN k % 13 = 12 THEN NULL ELSE CAST(k * 7919 % 1000003 AS VARCHAR) END AS numero_cuenta_dest
        FROM (SELECT *, s_suppkey AS k FROM supplier)""",
    "destinatarios_t": f"""SELECT recipient_id, {_norm("nombre_registrado")} AS nombre_registrado,
        {_norm("banco_destinatario")} AS banco_destinatario, {_norm("tipo_cuenta_dest")} AS tipo_cuenta_dest,
        numero_cuenta_dest FROM destinatarios_b""",
    "destinatarios_s": """SELECT * REPLACE (
        CASE WHEN banco_destinatario IS NULL THEN 'DESCONOCIDO' WHEN banco_destinatario LIKE '%DAVIPLATA%' THEN 'DAVIPLATA'
             WHEN banco_destinatario LIKE '%DAVIVIENDA%' THEN 'DAVIVIENDA'
             WHEN banco_destinatario LIKE '%BOGOTA%' THEN 'BANCO_DE_BOGOTA'
             WHEN banco_destinatario LIKE '%BANCOLOMBIA%' THEN 'BANCOLOMBIA' WHEN banco_destinatario LIKE '%ITAU%' THEN 'ITAU'
             WHEN banco_destinatario LIKE '%NEQUI%' THEN 'NEQUI'
             WHEN banco_destinatario LIKE '%SCOTIABANK%' OR banco_destinatario LIKE '%COLPATRIA%' THEN 'SCOTIABANK_COLPATRIA'
             WHEN banco_destinatario LIKE '%AGRARIO%' THEN 'BANCO_AGRARIO' WHEN banco_destinatario LIKE '%BBVA%' THEN 'BBVA'
             ELSE banco_destinatario END AS banco_destinatario,
        CASE WHEN tipo_cuenta_dest IS NULL THEN 'DESCONOCIDO' WHEN tipo_cuenta_dest LIKE '%CORRIENTE%' THEN 'CORRIENTE'
             WHEN tipo_cuenta_dest LIKE '%AHORRO%' THEN 'AHORROS' ELSE tipo_cuenta_dest END AS tipo_cuenta_dest),
        (regexp_split_to_array(nombre_registrado, '\\s+'))[1] AS primer_nombre,
        (regexp_split_to_array(nombre_registrado, '\\s+'))[2] AS primer_apellido,
        CASE WHEN length(numero_cuenta_dest) > 4 THEN '****' || right(numero_cuenta_dest, 4) ELSE numero_cuenta_dest END
            AS numero_cuenta_masked FROM destinatarios_t""",
    "destinatarios_g": """SELECT recipient_id, nombre_registrado, primer_nombre, primer_apellido, banco_destinatario,
        CASE WHEN banco_destinatario IN ('DAVIPLATA', 'NEQUI') THEN 'DIGITAL' ELSE 'TRADICIONAL' END AS tipo_banco,
        tipo_cuenta_dest, CAST(tipo_cuenta_dest = 'AHORROS' AS INTEGER) AS cuenta_protegida, numero_cuenta_masked
        FROM destinatarios_s""",
    "per_account": """SELECT account_id, count(transaction_id) AS num_total_transacciones_cuenta,
        CAST(sum(CAST(monto AS DECIMAL(18, 2))) AS DOUBLE) AS monto_total_transacciones_cuenta,
        CAST(sum(CAST(monto AS DECIMAL(18, 2))) AS DOUBLE) / count(*) AS monto_promedio_transaccion_cuenta
        FROM transacciones_g WHERE account_id IS NOT NULL GROUP BY account_id""",
    "activity": """SELECT c.*, p.* EXCLUDE (account_id) FROM cuentas_g c LEFT JOIN per_account p
        ON c.account_id = p.account_id""",
    "per_user": """SELECT user_id, count(DISTINCT account_id) AS num_total_cuentas,
        CAST(sum(CAST(coalesce(saldo_actual, 0) AS DECIMAL(18, 2))) AS DOUBLE) AS saldo_total_en_cuentas,
        avg(num_total_transacciones_cuenta) AS promedio_transacciones_por_cuenta,
        CAST(sum(CAST(coalesce(monto_total_transacciones_cuenta, 0) AS DECIMAL(18, 2))) AS DOUBLE)
            AS monto_total_movido_por_usuario
        FROM activity WHERE user_id IS NOT NULL GROUP BY user_id""",
    "loans_user": """SELECT user_id, count(loan_id) AS num_total_prestamos,
        CAST(sum(CAST(coalesce(monto_otorgado, 0) AS DECIMAL(18, 2))) AS DOUBLE) AS monto_total_prestado,
        CAST(sum(CAST(coalesce(monto_otorgado, 0) AS DECIMAL(18, 2))) AS DOUBLE) / count(*) AS promedio_monto_prestamo
        FROM prestamos_g WHERE user_id IS NOT NULL GROUP BY user_id""",
    "features": _FEATURES.format(gold="usuarios_g"),
    "features_c": _FEATURES.format(gold="usuarios_gc"),
    "labelled": _LABEL.format(features="features"),
    "labelled_c": _LABEL.format(features="features_c"),
    "account_numbers": """SELECT user_id, account_id, fecha_apertura,
        row_number() OVER (PARTITION BY user_id ORDER BY substr(md5(account_id), 1, 2), account_id) AS orden,
        count(*) OVER (PARTITION BY user_id) AS num_cuentas FROM cuentas_s""",
    "class_sizes": "SELECT riesgo, count(*) AS n, sum(count(*)) OVER () AS total FROM labelled GROUP BY riesgo",
    "class_shares": """SELECT *, ceil(total * 0.25) AS wanted, n * ceil(total * 0.25) / total AS ideal FROM class_sizes""",
    "class_quotas": """SELECT riesgo, floor(ideal) + CASE WHEN row_number() OVER (ORDER BY ideal - floor(ideal) DESC, riesgo)
        <= wanted - sum(floor(ideal)) OVER () THEN 1 ELSE 0 END AS quota FROM class_shares""",
    "split": """SELECT l.user_id, l.riesgo, row_number() OVER (PARTITION BY l.riesgo ORDER BY md5(l.user_id || '|42'))
        <= q.quota AS es_prueba FROM labelled l JOIN class_quotas q ON l.riesgo = q.riesgo""",
    "requests": """SELECT 'e' || event_id AS request_id, CASE
        WHEN event_id % 17 = 16 THEN '[1]' WHEN event_id % 19 = 18 THEN NULL
        WHEN event_id % 31 = 30 THEN '{"edad": "abc", "estado_laboral": "Desempleado"}'
        WHEN event_id % 37 = 36 THEN '{"edad": 44, "estado_laboral": "Desempleado"}'
        WHEN event_id % 23 = 22 THEN '{"edad": ' || user_id
        WHEN event_id % 5 = 4 THEN '{"edad": ' || (user_id % 70) || '}'
        WHEN event_id % 29 = 28 THEN '{"edad":' || (user_id % 70) || ',"ingreso_mensual_estimado":1500000,' ||
            '"numero_dependientes":1,"tiene_dependientes":1,"vivienda_propia":0,"antiguedad_cliente":' || (event_id % 9) ||
            ',"num_total_cuentas":2,"saldo_total_en_cuentas":5000000.5,"promedio_transacciones_por_cuenta":4,' ||
            '"monto_total_movido_por_usuario":100000,"num_total_prestamos":' || (event_id % 3) ||
            ',"monto_total_prestado":0,"promedio_monto_prestamo":0,"ciudad_residencia":"CALI","rango_edad":"26-35",' ||
            '"profesion":"MEDICA","categoria_ingresos":"BAJOS","estado_laboral":"EMPLEADO","nivel_educativo":"OTRO",' ||
            '"estado_civil":"VIUDO(A)","tipo_vivienda":"FAMILIAR"}'
        ELSE '{"edad": ' || (user_id % 70) || ', "ingreso_mensual_estimado": ' || CAST(floor(value * 100000) AS BIGINT) ||
            ', "estado_laboral": " ' || (['Estudiante', 'empleado', 'Pensionado'])[CAST(event_id % 3 AS INTEGER) + 1] ||
            '", "numero_dependientes": ' || (event_id % 3) || ', "tipo_vivienda": "Propia", "num_total_prestamos": ' ||
            (event_id % 4) || '}' END AS body FROM events
        UNION ALL SELECT 'c' || conv_id || '-' || turn, text FROM conversations""",
    "checked": """SELECT *, CASE WHEN body IS NULL OR NOT json_valid(body) THEN 'body is not valid JSON'
        WHEN json_type(body) <> 'OBJECT' THEN 'body is not a JSON object'
        WHEN json_extract_string(body, '$.edad') IS NOT NULL AND try_cast(json_extract_string(body, '$.edad') AS DOUBLE) IS NULL
        THEN 'unreadable inputs: edad' END AS error FROM requests""",
}


def _statement(body: str) -> str:
    """Puts the common table expressions a statement needs in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text) and name not in stack:
                stack.append(name)
                visit(CTES[name])
                needed.append(name)

    stack: list[str] = []
    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in needed) + "\n" + body


def _bin_order(column: str, labels: str) -> str:
    return f"CAST(list_position([{labels}], {column}) - 1 AS INTEGER)"


_A_SUMS = """round(saldo_total_en_cuentas, 2) AS saldo_total_en_cuentas,
    round(promedio_transacciones_por_cuenta, 6) AS promedio_transacciones_por_cuenta,
    round(monto_total_movido_por_usuario, 2) AS monto_total_movido_por_usuario"""
_L_SUMS = """round(monto_total_prestado, 2) AS monto_total_prestado,
    round(promedio_monto_prestamo, 6) AS promedio_monto_prestamo"""

_ROUNDED = f"REPLACE ({_A_SUMS}, {_L_SUMS})"

_PAIRS = "(SELECT quality AS y, toxic AS p FROM labels)"

_INPUTS_NUM = ["edad", "ingreso_mensual_estimado", "numero_dependientes", "tiene_dependientes", "vivienda_propia",
               "antiguedad_cliente", "num_total_cuentas", "saldo_total_en_cuentas",
               "promedio_transacciones_por_cuenta", "monto_total_movido_por_usuario", "num_total_prestamos",
               "monto_total_prestado", "promedio_monto_prestamo"]
_INPUTS_TEXT = ["ciudad_residencia", "rango_edad", "profesion", "categoria_ingresos", "estado_laboral",
                "nivel_educativo", "estado_civil", "tipo_vivienda"]


def _histogram(column: str, n: int) -> str:
    return f"""SELECT '{column}' AS columna, CAST(b AS INTEGER) AS bin, round(lo + b * step, 4) AS desde,
        round(lo + (b + 1) * step, 4) AS hasta, (SELECT count(*) FROM usuarios_g u WHERE u.{column} >= lo + b * step
            AND (u.{column} < lo + (b + 1) * step OR b = {n - 1})) AS n
        FROM (SELECT min({column})::DOUBLE AS lo, (max({column})::DOUBLE - min({column})::DOUBLE) / {n} AS step
              FROM usuarios_g), range({n}) r(b)"""


def _profile() -> str:
    parts = [
        f"SELECT '{c}' AS feature, 'numeric' AS kind, count({c}) AS filled, CAST(NULL AS BIGINT) AS levels, "
        f"round(avg({c}), 2) AS mean, round(stddev_pop({c}), 2) AS deviation FROM labelled" for c in _INPUTS_NUM
    ] + [
        f"SELECT '{c}', 'categorical', count({c}), count(DISTINCT {c}), NULL, NULL FROM labelled" for c in _INPUTS_TEXT
    ]
    return " UNION ALL ".join(parts)


def _crosstab(by: str) -> str:
    return f"""SELECT '{by}' AS columna, {by} AS valor, round(sum(riesgo) * 100.0 / count(*), 4)::DOUBLE AS alto_riesgo_pct,
        round(sum(1 - riesgo) * 100.0 / count(*), 4)::DOUBLE AS bajo_riesgo_pct FROM labelled WHERE {by} IS NOT NULL
        GROUP BY {by}"""


_FREQ_COLUMNS = ["rango_edad", "estado_laboral", "nivel_educativo", "categoria_ingresos", "tipo_vivienda"]


def _frequencies() -> str:
    parts = [f"SELECT '{c}' AS columna, {c} AS valor, count(*) AS n FROM labelled WHERE {c} IS NOT NULL GROUP BY {c}"
             for c in _FREQ_COLUMNS]
    parts.append("SELECT 'riesgo_etiqueta', CASE riesgo WHEN 1 THEN 'Alto Riesgo' ELSE 'Bajo Riesgo' END, count(*) "
                 "FROM labelled GROUP BY riesgo")
    return " UNION ALL ".join(parts)


_CHOICES = {
    "estado_laboral": "'EMPLEADO', 'INDEPENDIENTE', 'DESEMPLEADO', 'ESTUDIANTE', 'PENSIONADO', 'OTRO', 'DESCONOCIDO'",
    "nivel_educativo": "'NINGUNO', 'PRIMARIA', 'SECUNDARIA', 'TECNICO', 'UNIVERSITARIO', 'POSTGRADO', 'OTRO', 'DESCONOCIDO'",
    "estado_civil": "'SOLTERO(A)', 'CASADO(A)', 'UNION LIBRE', 'DIVORCIADO(A)', 'VIUDO(A)', 'DESCONOCIDO'",
    "tipo_vivienda": "'PROPIA', 'ALQUILADA', 'FAMILIAR', 'OTRO', 'DESCONOCIDO'",
}


def _options() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS columna, opcion FROM (SELECT {c} AS opcion FROM usuarios_g WHERE {c} IS NOT NULL "
        f"UNION SELECT unnest([{items}]))" for c, items in _CHOICES.items())


def _level_index(column: str) -> str:
    return f"""SELECT level, CAST(row_number() OVER (ORDER BY count(*) DESC, level) - 1 AS INTEGER) AS i
        FROM (SELECT coalesce({column}, 'DESCONOCIDO') AS level FROM usuarios_g) GROUP BY level"""


def _request_features() -> str:
    def num(c):
        return f"TRY_CAST(json_extract_string(body, '$.{c}') AS DOUBLE) AS {c}"

    def txt(c):
        return f"{_norm(f'''json_extract_string(body, '$.{c}')''')} AS {c}"

    plain = [c for c in _INPUTS_NUM if c not in ("tiene_dependientes", "vivienda_propia")]
    texts = [c for c in _INPUTS_TEXT if c not in ("rango_edad", "categoria_ingresos")]
    raw = ", ".join([num(c) for c in _INPUTS_NUM] + [txt(c) for c in _INPUTS_TEXT])
    cols = ", ".join([f"coalesce({c}, 0) AS {c}" for c in plain] + [f"coalesce({c}, 'DESCONOCIDO') AS {c}" for c in texts])
    # The first rule of the employment table also matches the word it is part of.
    cols = cols.replace("coalesce(estado_laboral,", "coalesce(CASE WHEN estado_laboral LIKE '%EMPLEADO%' THEN 'EMPLEADO' ELSE estado_laboral END,")
    age = _bins("edad", "25:18-25", "35:26-35", "45:36-45", "55:46-55", "65:56-65", "1e300:65+")
    income = _bins("coalesce(ingreso_mensual_estimado, 0)", "1000000:MUY BAJOS", "3000000:BAJOS", "6000000:MEDIOS",
                   "10000000:ALTOS", "1e300:MUY ALTOS")
    return f"""SELECT request_id, {cols},
        coalesce(tiene_dependientes, CAST(coalesce(numero_dependientes > 0, false) AS INTEGER))::DOUBLE AS tiene_dependientes,
        coalesce(vivienda_propia, CAST(coalesce(tipo_vivienda = 'PROPIA', false) AS INTEGER))::DOUBLE AS vivienda_propia,
        CASE WHEN edad > 0 THEN {age} ELSE 'DESCONOCIDO' END AS rango_edad, {income} AS categoria_ingresos
        FROM (SELECT request_id, {raw} FROM checked WHERE error IS NULL)"""


def _prompt() -> str:
    lines = []
    for c in _INPUTS_NUM:
        r = f"round({c}::DOUBLE, 2)"
        lines.append(f"'- {c.replace('_', ' ').capitalize()}: ' || coalesce(CASE WHEN {r} = floor({r}) "
                     f"THEN CAST(CAST({r} AS BIGINT) AS VARCHAR) ELSE printf('%.2f', {r}) END, 'nan')")
    for c in _INPUTS_TEXT:
        lines.append(f"'- {c.replace('_', ' ').capitalize()}: ' || coalesce({c}, 'nan')")
    listed = "concat_ws(chr(10), " + ", ".join(lines) + ")"
    return f"""SELECT user_id, caracteristicas, concat_ws(chr(10), 'Informe para el comité de crédito de el banco.', '',
        'Perfil evaluado:', caracteristicas, '',
        'El modelo clasifica este perfil como ' || CASE riesgo WHEN 1 THEN 'ALTO RIESGO' ELSE 'BAJO RIESGO' END ||
        ' (alto riesgo ' || printf('%.2f', round(edad / 128.0 * 100, 2)) || '%, bajo riesgo ' ||
        printf('%.2f', round((1 - edad / 128.0) * 100, 2)) || '%).', '',
        'Responde en tres párrafos. Primero, qué cifras del perfil se apartan de lo habitual y en qué sentido, citando ' ||
        'su valor. Segundo, qué campos faltan, valen cero o no son coherentes entre sí, y qué documento los aclararía. ' ||
        'Tercero, si la clasificación se sostiene sin esos campos, y el siguiente paso que propones.') AS prompt
        FROM (SELECT *, {listed} AS caracteristicas FROM labelled)"""


# --- generator -----------------------------------------------------------------------------------

def _h(*parts: str) -> str:
    return "md5(concat_ws('|', '7', " + ", ".join(p if p.startswith("(") else f"'{p}'" for p in parts) + "))"


def _w(h: str, i: int) -> str:
    return f"CAST('0x' || substr({h}, {1 + 8 * i}, 8) AS BIGINT)"


def _below(h: str, i: int, n) -> str:
    return f"(({_w(h, i)} * {n}) >> 32)"


def _from(items: str, h: str, i: int) -> str:
    n = len(items.split(","))
    values = ", ".join(f"'{x.strip()}'" for x in items.split(","))
    return f"([{values}])[CAST({_below(h, i, n)} AS INTEGER) + 1]"


def _uuid(h: str) -> str:
    return f"concat_ws('-', substr({h},1,8), substr({h},9,4), substr({h},13,4), substr({h},17,4), substr({h},21,12))"


def _iso(seconds: str) -> str:
    return f"strftime(make_timestamp(({seconds}) * 1000000), '%Y-%m-%dT%H:%M:%S')"


_END = 1735689600  # 2025-01-01 in seconds
_FIRST = "Ana,Luis,María,José,Camila,Andrés,Sofía,Jorge,Lucía,Óscar"
_LAST = "Gómez,Rodríguez,Pérez,Muñoz,Castaño,Ríos,Herrera,Vélez"

CTES |= {
    "gen_base": f"""SELECT c_custkey AS id, {_h("usuarios", "(c_custkey)", "0")} AS h0,
        {_uuid(_h("user_id", "(c_custkey)"))} AS user_id FROM customer""",
    "gen_birth": f"""SELECT *, DATE '2025-01-01' - CAST(6575 + {_below("h0", 2, 21184)} AS INTEGER) AS birth,
        1 + {_below("h0", 0, 3)} AS accounts FROM gen_base""",
    "gen_adult": "SELECT *, epoch_us(CAST(birth + 6570 AS TIMESTAMP)) // 1000000 AS adult FROM gen_birth",
    "gen_person": f"SELECT *, adult + {_below('h0', 3, f'(greatest({_END} - adult, 0) + 1)')} AS registered FROM gen_adult",
    "gen_numbers": f"""SELECT p.*, k, {_h("cuentas", "(id)", "(k)")} AS ha, {_uuid(_h("account_id", "(id)", "(k)"))} AS account_id
        FROM gen_person p, range(1, 4) r(k) WHERE k <= accounts""",
    "gen_accounts": f"""SELECT *, registered + {_below('ha', 0, f'(greatest({_END} - registered, 0) + 1)')} AS opened
        FROM gen_numbers""",
    "gen_tx_size": f"SELECT *, 5 + {_below(_h('volumen', '(id)'), 0, 46)} AS size FROM gen_person",
    "gen_tx_rows": f"""SELECT id, user_id, accounts, t, {_h("transacciones", "(id)", "(t)", "1")} AS h1,
        {_h("transacciones", "(id)", "(t)", "2")} AS h2 FROM gen_tx_size, range(1, 51) r(t) WHERE t <= size""",
    "gen_tx": f"""SELECT x.*, a.account_id, a.opened, {_below("h1", 1, 8)} AS kind FROM
        (SELECT *, 1 + {_below("h1", 0, "accounts")} AS pick FROM gen_tx_rows) x
        JOIN gen_accounts a ON x.id = a.id AND x.pick = a.k""",
    "gen_loan_ids": f"""SELECT p.*, {_h("prestamos", "(id)", "1")} AS h1, {_h("prestamos", "(id)", "2")} AS h2
        FROM gen_person p QUALIFY row_number() OVER (ORDER BY md5(id || '|7')) <= round(count(*) OVER () * 0.25)""",
    "gen_loans": f"""SELECT *, CAST(({_from("12,24,36,48,60,72", "h1", 0)}) AS INTEGER) AS plazo,
        (100000000 + {_below("h1", 1, 49000000)} * 100 + {_below("h1", 2, 100)}) / 100 AS monto,
        registered + 7776000 AS earliest FROM gen_loan_ids""",
}


def _generated() -> dict[str, str]:
    h1, h2, h3 = (_h("usuarios", "(id)", n) for n in "123")
    cash = [(5000, 500000), (10000, 2000000), (10000, 3000000), (15000, 300000), (20000, 1000000), (50000, 5000000),
            (50000, 1500000), (800000, 10000000)]
    amount = " ".join(f"WHEN {i} THEN {lo * 100} + {_below('h1', 2, (hi - lo) * 100 + 1)}" for i, (lo, hi) in enumerate(cash))
    kinds = "Compra,Transferencia Enviada,Transferencia Recibida,Pago Servicio,Retiro ATM,Depósito,Pago Préstamo,Salario"
    category = f"""CASE kind
        WHEN 0 THEN {_from("Alimentación,Transporte,Entretenimiento,Ropa y Accesorios,Hogar,Salud,Tecnología,Viajes", "h1", 3)}
        WHEN 1 THEN 'Transferencia' WHEN 2 THEN 'Transferencia'
        WHEN 3 THEN {_from("Agua,Luz,Gas,Internet,Telefonía,Televisión,Administración", "h1", 3)}
        WHEN 4 THEN 'Retiro' WHEN 5 THEN 'Depósito' WHEN 6 THEN 'Pago Obligación' WHEN 7 THEN 'Ingreso Nómina' END"""
    kind = f"([{', '.join(repr(k) for k in kinds.split(','))}])[CAST(kind AS INTEGER) + 1]"
    a1, a2 = _h("cuentas", "(id)", "(k)", "1"), _h("cuentas", "(id)", "(k)", "2")
    d1, d2 = _h("destinatarios", "(s_suppkey)", "1"), _h("destinatarios", "(s_suppkey)", "2")
    _place = _below(_h("destino", "(id)", "(t)"), 0, "(SELECT count(*) FROM supplier)")
    target = "((SELECT min(s_suppkey) FROM supplier) + " + _below(_h("destino", "(id)", "(t)"), 0, "(SELECT count(*) FROM supplier)") + ")"
    return {
        "g1_users": f"""SELECT user_id, CAST((id % 1090000000 * 618033989) % 1090000000 + 10000000
            + (id // 1090000000) * 10000000000 AS VARCHAR) AS cedula,
            {_from(_FIRST, h1, 2)} AS nombre, {_from(_LAST, h1, 3)} AS apellido,
            {_from("Bogotá,Medellín,Cali,Cúcuta,Ibagué,Pereira,Montería,Tunja", h2, 0)} AS ciudad_residencia,
            CAST(birth AS VARCHAR) AS fecha_de_nacimiento,
            {_from("Ingeniero,Médica,Docente,Contador,Abogada,Electricista,Diseñador", h2, 1)} AS profesion,
            CASE WHEN {_below(h1, 0, 10)} = 0 THEN 0.0 ELSE (80000000 + {_below(h1, 1, 1420000001)}) / 100 END::DOUBLE
                AS ingreso_mensual_estimado,
            {_from("Empleado,Independiente,Desempleado,Estudiante,Pensionado", h2, 2)} AS estado_laboral,
            {_from("Primaria,Secundaria,Técnico,Universitario,Postgrado,Ninguno", h2, 3)} AS nivel_educativo,
            {_from("Soltero(a),Casado(a),Unión Libre,Divorciado(a),Viudo(a)", h3, 0)} AS estado_civil,
            CAST({_below(h3, 1, 6)} AS INTEGER) AS numero_dependientes,
            {_from("Propia,Alquilada,Familiar", h3, 2)} AS tipo_vivienda, {_iso("registered")} AS fecha_registro_banco
            FROM gen_person""",
        "g2_accounts": f"""SELECT account_id, user_id,
            lpad(CAST({_w(a1, 2)} AS VARCHAR), 10, '0') || lpad(CAST({_w(a1, 3)} AS VARCHAR), 10, '0') AS numero_cuenta,
            {_from("Ahorros,Corriente,Nómina", a2, 2)} AS tipo_cuenta, {_iso("opened")} AS fecha_apertura,
            (-5000000 + {_below(a1, 0, 25050000)} * 100 + {_below(a1, 1, 100)}) / 100 AS saldo_actual, 'COP' AS moneda,
            CASE WHEN {_below(a2, 0, 20)} = 0 THEN 'Activa' ELSE {_from("Activa,Inactiva,Bloqueada", a2, 1)} END
                AS estado_cuenta FROM gen_accounts""",
        "g3_recipients": f"""SELECT {_uuid(_h("recipient_id", "(s_suppkey)"))} AS recipient_id,
            {_from(_FIRST, d1, 0)} || ' ' || {_from(_LAST, d1, 1)} AS nombre_registrado,
            {_from("Davivienda,Bancolombia,BBVA,Banco de Bogotá,Itaú,Scotiabank Colpatria,Banco Agrario,Nequi,Daviplata", d1, 2)}
                AS banco_destinatario, {_from("Ahorros,Corriente", d1, 3)} AS tipo_cuenta_dest,
            lpad(CAST({_w(d2, 0)} AS VARCHAR), 10, '0') || lpad(CAST({_w(d2, 1)} AS VARCHAR), 10, '0') AS numero_cuenta_dest
            FROM supplier""",
        "g4_transactions": f"""SELECT {_uuid(_h("transaction_id", "(id)", "(t)"))} AS transaction_id, account_id, user_id,
            (CASE kind {amount} END) / 100 AS monto,
            {_iso(f"opened + {_below('h2', 0, f'(greatest({_END} - opened, 0) + 1)')}")} AS fecha,
            {kind} AS tipo_transaccion, {category} AS categoria,
            {_from("Online,POS,ATM,Sucursal,App Móvil", "h2", 1)} AS canal,
            {_from("Crédito,Débito,N/A", "h2", 3)} AS tipo_tarjeta_usada,
            CASE WHEN kind = 1 AND {_below("h2", 2, 10)} < 7 THEN {_uuid(_h("recipient_id", "(" + target + ")"))} END
                AS recipient_id_fk,
            'Movimiento ' || t || ' de ' || {kind} AS descripcion FROM gen_tx""",
        "g4_gapped_recipients": f"""SELECT {_uuid(_h("transaction_id", "(id)", "(t)"))} AS transaction_id,
            CASE WHEN kind = 1 AND {_below("h2", 2, 10)} < 7 THEN {_uuid(_h("recipient_id", "(key)"))} END AS recipient_id_fk
            FROM gen_tx JOIN (SELECT s_suppkey * 1000 + s_nationkey AS key, row_number() OVER (ORDER BY key) - 1 AS place FROM supplier)
            ON place = {_place}""",
        "g4_gapped_dangling": "SELECT CAST(0 AS BIGINT) AS n",
        "g5_loans": f"""SELECT {_uuid(_h("loan_id", "(id)"))} AS loan_id, user_id, monto AS monto_otorgado,
            (1500 + {_below("h1", 3, 2001)}) / 100 AS tasa_interes_anual, plazo AS plazo_meses,
            {_iso(f"earliest + {_below('h2', 0, f'(greatest({_END} - earliest, 0) + 1)')}")} AS fecha_desembolso,
            round(monto * ((0.15::DOUBLE / 12) / (1 - pow(1 + 0.15::DOUBLE / 12, -plazo))), 2) AS cuota_mensual,
            {_from("Activo,Pagado,En Mora", "h2", 1)} AS estado_prestamo,
            {_from("Libre Inversión,Compra Vehículo,Educación,Vivienda,Deuda", "h2", 2)} AS proposito FROM gen_loans""",
        "g5_annuity": """SELECT loan_id, round(monto_otorgado * ((0.15::DOUBLE / 12)
            / (1 - pow(1 + 0.15::DOUBLE / 12, -plazo_meses))), 2) AS cuota FROM prestamos_g WHERE monto_otorgado IS NOT NULL""",
        "g6_all_tables": """SELECT 'usuarios' AS entity, count(*) AS n FROM gen_person
            UNION ALL SELECT 'cuentas', count(*) FROM gen_accounts
            UNION ALL SELECT 'destinatarios', count(*) FROM supplier
            UNION ALL SELECT 'transacciones', count(*) FROM gen_tx
            UNION ALL SELECT 'prestamos', count(*) FROM gen_loans""",
    }


def _bodies() -> dict[str, str]:
    zones = ["usuarios", "cuentas", "destinatarios", "transacciones", "prestamos"]
    gold = {f"s4_gold_{e}": f"SELECT * FROM {e}_g" for e in zones}
    bodies = {
        "s1_read_bronze": "SELECT * FROM usuarios_b",
        "p1_scripts": """SELECT c_custkey, (['ATHENA', 'PSUKHE THESSALONIKE', 'MOSKVA', 'SHCHIOLKOVO ZHUKOVSKII', 'KIYIV', 'BEOGRAD LJUBLJANA', 'FIN FLUSS DZEP', 'BOGOTA VIII',
            'SEOUL HANGUG', 'TOUKIYOU', 'EREWAN', 'TBILISI', 'YRVSHLYM', 'BGDAD', '東京 NUNOA', 'STRASSE OEUVRE', 'X2 1/2'])[c_custkey % 17 + 1] || ' ' || upper(c_name) AS ciudad
            FROM customer""",
        "s1_column_orders": "SELECT * REPLACE (CASE WHEN CAST(user_id AS BIGINT) % 3 <> 2 THEN profesion END AS profesion) FROM usuarios_b",
        "s1_multi_line": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, source, md5(coalesce(text, '')) AS text_md5 FROM documents",
        "s10_failures": """SELECT * FROM (
            WITH o AS (SELECT count(*) AS n, count(*) FILTER (o_orderkey % 7 IN (3, 4)) AS bad, count(*) FILTER (o_orderkey % 7 = 4) AS gone FROM orders)
            SELECT 'prestamos' AS entity, 'ok' AS status, n - gone AS processed_rows, bad AS bad_rows, gone AS rejected_rows, false AS con_error FROM o
            UNION ALL SELECT 'cuentas', 'ok', (SELECT count(*) FROM orders), 0, 0, false
            UNION ALL SELECT 'cuentas', 'failed', NULL, NULL, NULL, true
            UNION ALL SELECT 'usuarios', 'failed', NULL, NULL, NULL, true
            UNION ALL SELECT 'usuarios', 'ok', (SELECT count(*) FROM customer), 0, 0, false
            UNION ALL SELECT 'destinatarios', 'failed', NULL, NULL, NULL, true
            UNION ALL SELECT 'destinatarios', 'failed', NULL, NULL, NULL, true)""",
        "s10_rejected": """SELECT 'L' || o_orderkey AS first, 'L' || o_orderkey || ',u' || o_custkey || ',' || CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR)
                || CASE o_orderkey % 7 WHEN 4 THEN ',20,12,2020-01-05,90,Activo,Viaje,extra,"a,b"' ELSE '' END AS text,
            CASE o_orderkey % 7 WHEN 4 THEN '11 of 9 fields' ELSE '3 of 9 fields' END AS reason, o_orderkey % 7 = 3 AS kept, 'prestamos.csv' AS file
            FROM orders WHERE o_orderkey % 7 IN (3, 4)""",
        "s10_silver": """SELECT 'L' || o_orderkey AS loan_id, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) AS monto_otorgado,
            CASE o_orderkey % 7 WHEN 3 THEN 'OTRO' WHEN 5 THEN 'VIAJE, LARGO' ELSE 'VIAJE' END AS proposito FROM orders WHERE o_orderkey % 7 <> 4""",
        "s2_null_tokens": """SELECT transaction_id, nullif(account_id, 'N/A') AS account_id,
            nullif(tipo_tarjeta_usada, 'N/A') AS tipo_tarjeta_usada FROM transacciones_b""",
        **{f"s3_silver_{e}": f"SELECT * FROM {e}_s" for e in zones},
        **gold,
        "s5_missing_gold": "SELECT loan_id, estado_prestamo FROM prestamos_g",
        "s6_load_all_gold": " UNION ALL ".join(f"SELECT '{e}' AS entity, count(*) AS n FROM {e}_g" for e in zones),
        "s7_zone_path": """SELECT CAST(doc_id AS VARCHAR) AS id,
            's3://silver-zone/' || source || '/' || lang || '/d.' || doc_id || '_cleaned.parquet' AS silver_path,
            's3://gold-zone/' || source || '/' || lang || '/d.' || doc_id || '_enriched.parquet' AS gold_path FROM documents
            UNION ALL SELECT 'p' || page_id, NULL, NULL FROM pages""",
        "s9_run_summary": """SELECT 'usuarios' AS entity, count(*) AS processed_rows, CAST(0 AS BIGINT) AS bad_rows,
                CAST(0 AS BIGINT) AS bad_dates, 'ok' AS status FROM usuarios_s
            UNION ALL SELECT 'cuentas', count(*), 0, count(*) FILTER (fecha_apertura IS NULL), 'ok' FROM cuentas_s
            UNION ALL SELECT 'destinatarios', count(*), 0, 0, 'ok' FROM destinatarios_s
            UNION ALL SELECT 'transacciones', count(*), 0, count(*) FILTER (fecha IS NULL), 'ok' FROM transacciones_s
            UNION ALL SELECT 'prestamos', count(*), 0, count(*) FILTER (fecha_desembolso IS NULL), 'ok' FROM prestamos_s""",
        "s11_catalog_table": "SELECT tipo_cuenta, estado_cuenta, count(*) AS n FROM cuentas_g GROUP BY ALL",
        "s12_write_bronze": "SELECT * FROM destinatarios_b",
        "p1_normalise_text": """SELECT user_id, nombre, apellido, ciudad_residencia, profesion, estado_laboral,
            nivel_educativo, estado_civil, tipo_vivienda FROM usuarios_t""",
        "p2_parse_ts": "SELECT account_id, fecha_apertura FROM cuentas_s",
        "p3_number_zero": "SELECT transaction_id, monto FROM transacciones_s",
        "p4_number_null": """SELECT 'cuenta-' || account_id AS id, saldo_actual AS valor FROM cuentas_s
            UNION ALL SELECT 'monto-' || loan_id, monto_otorgado FROM prestamos_s
            UNION ALL SELECT 'tasa-' || loan_id, tasa_interes_anual FROM prestamos_s
            UNION ALL SELECT 'plazo-' || loan_id, plazo_meses FROM prestamos_s
            UNION ALL SELECT 'cuota-' || loan_id, cuota_mensual FROM prestamos_s""",
        "p5_int_zero": "SELECT user_id, numero_dependientes FROM usuarios_s",
        "p6_zero_fill_amounts": """SELECT 'cuentas' AS tabla, account_id AS clave, coalesce(saldo_actual, 0) AS monto FROM cuentas_g
            UNION ALL SELECT 'transacciones', transaction_id, coalesce(monto, 0) FROM transacciones_g
            UNION ALL SELECT 'prestamos', loan_id, coalesce(monto_otorgado, 0) FROM prestamos_g""",
        "p7_date_parts": "SELECT transaction_id, fecha, anio, mes, dia, hora FROM transacciones_s",
        "p8_drop_description": "SELECT * FROM transacciones_s",
        "p9_gold_projection_users": gold["s4_gold_usuarios"],
        "p9_gold_projection_accounts": gold["s4_gold_cuentas"],
        "p9_gold_projection_tx": gold["s4_gold_transacciones"],
        "p9_gold_projection_loans": gold["s4_gold_prestamos"],
        "p9_gold_projection_recipients": gold["s4_gold_destinatarios"],
        "p10_age": "SELECT user_id, edad FROM usuarios_s",
        "p11_tenure": "SELECT user_id, antiguedad_cliente FROM usuarios_s",
        "p12_account_age": "SELECT account_id, antiguedad_anios FROM cuentas_g",
        "p13_14_name_parts": "SELECT recipient_id, primer_nombre, primer_apellido FROM destinatarios_s",
        "p15_mask": "SELECT account_id, numero_cuenta_masked FROM cuentas_s",
        "p15_mask_strict": """SELECT recipient_id, CASE WHEN length(numero_cuenta_dest) > 4 THEN '****' ||
            right(numero_cuenta_dest, 4) WHEN numero_cuenta_dest IS NOT NULL THEN '****' END AS numero_cuenta_masked
            FROM destinatarios_b""",
        "p16_interest": "SELECT loan_id, interes_total_estimado FROM prestamos_g",
        "c1_employment": "SELECT user_id, estado_laboral FROM usuarios_s",
        "c1_employment_corrected": "SELECT user_id, estado_laboral FROM usuarios_sc",
        "c2_education": "SELECT user_id, nivel_educativo FROM usuarios_s",
        "c3_account_type": "SELECT account_id, tipo_cuenta FROM cuentas_s",
        "c4_account_state": "SELECT account_id, estado_cuenta FROM cuentas_s",
        "c4_account_state_corrected": "SELECT account_id, estado_cuenta FROM cuentas_sc",
        "c5_transaction_type": "SELECT transaction_id, tipo_transaccion FROM transacciones_s",
        "c5_transaction_type_corrected": "SELECT transaction_id, tipo_transaccion FROM transacciones_sc",
        "c6_spending_category": "SELECT transaction_id, categoria FROM transacciones_s",
        "c7_loan_purpose": "SELECT loan_id, proposito FROM prestamos_s",
        "c8_loan_state": "SELECT loan_id, estado_prestamo FROM prestamos_s",
        "c9_bank": "SELECT recipient_id, banco_destinatario FROM destinatarios_s",
        "c10_recipient_account_type": "SELECT recipient_id, tipo_cuenta_dest FROM destinatarios_s",
        "c11_bank_kind": "SELECT recipient_id, tipo_banco FROM destinatarios_g",
        "c12_label": """SELECT user_id, CASE riesgo WHEN 1 THEN 'Alto Riesgo' ELSE 'Bajo Riesgo' END AS etiqueta,
            CASE riesgo WHEN 1 THEN 'ALTO RIESGO' ELSE 'BAJO RIESGO' END AS etiqueta_mayuscula FROM labelled""",
    }
    orders = {
        "b1_income": ("user_id", "categoria_ingresos", "usuarios", "'MUY BAJOS', 'BAJOS', 'MEDIOS', 'ALTOS', 'MUY ALTOS'"),
        "b2_age_range": ("user_id", "rango_edad", "usuarios", "'18-25', '26-35', '36-45', '46-55', '56-65', '65+'"),
        "b3_balance": ("account_id", "categoria_saldo", "cuentas", "'MUY_BAJO', 'BAJO', 'MEDIO', 'ALTO', 'MUY_ALTO'"),
        "b4_amount": ("transaction_id", "categoria_monto", "transacciones",
                      "'MUY_PEQUEÑO', 'PEQUEÑO', 'MEDIANO', 'GRANDE', 'MUY_GRANDE'"),
        "b5_part_of_day": ("transaction_id", "periodo_dia", "transacciones", "'MADRUGADA', 'MAÑANA', 'TARDE', 'NOCHE'"),
        "b6_loan_amount": ("loan_id", "categoria_monto", "prestamos",
                           "'PEQUEÑO', 'MEDIANO', 'GRANDE', 'MUY_GRANDE', 'EXTRA_GRANDE'"),
        "b7_interest_rate": ("loan_id", "categoria_tasa", "prestamos", "'MUY_BAJA', 'BAJA', 'MEDIA', 'ALTA', 'MUY_ALTA'"),
    }
    for name, (key, column, entity, labels) in orders.items():
        bodies[name] = f"SELECT {key}, {column}, {_bin_order(column, labels)} AS orden FROM {entity}_g"
    for name, key, column, entity in (
        ("b8_has_dependants", "user_id", "tiene_dependientes", "usuarios"),
        ("b9_owns_home", "user_id", "vivienda_propia", "usuarios"),
        ("b10_protected_account", "account_id", "cuenta_protegida", "cuentas"),
        ("b10_protected_recipient", "recipient_id", "cuenta_protegida", "destinatarios"),
        ("b11_blocked_account", "account_id", "cuenta_bloqueada", "cuentas"),
        ("b12_large_transaction", "transaction_id", "transaccion_grande", "transacciones"),
        ("b13_large_loan", "loan_id", "prestamo_grande", "prestamos"),
    ):
        bodies[name] = f"SELECT {key}, {column} FROM {entity}_g"
    bodies |= {
        "f1_not_null": "SELECT user_id, estado_civil FROM usuarios_g WHERE estado_civil IS NOT NULL",
        "f2_risk_label": "SELECT user_id, regla, riesgo FROM labelled",
        "f2_risk_label_corrected": "SELECT user_id, regla, riesgo FROM labelled_c",
        "f3_member": "SELECT user_id, estado_laboral FROM usuarios_g WHERE estado_laboral IN ('DESEMPLEADO', 'ESTUDIANTE')",
        "a1_tx_per_account": """SELECT account_id, num_total_transacciones_cuenta,
            round(monto_total_transacciones_cuenta, 2) AS monto_total_transacciones_cuenta,
            round(monto_promedio_transaccion_cuenta, 6) AS monto_promedio_transaccion_cuenta FROM per_account""",
        "a2_account_per_user": f"SELECT user_id, num_total_cuentas, {_A_SUMS} FROM per_user",
        "a3_loans_per_user": f"SELECT user_id, num_total_prestamos, {_L_SUMS} FROM loans_user",
        "j1_accounts_tx": """SELECT account_id, user_id, saldo_actual, num_total_transacciones_cuenta,
            round(monto_total_transacciones_cuenta, 2) AS monto_total_transacciones_cuenta,
            round(monto_promedio_transaccion_cuenta, 6) AS monto_promedio_transaccion_cuenta FROM activity""",
        "j2_users_accounts": f"""SELECT u.user_id, estado_laboral, num_total_cuentas, {_A_SUMS}
            FROM usuarios_g u LEFT JOIN per_user a ON u.user_id = a.user_id""",
        "j3_users_loans": f"""SELECT u.user_id, estado_laboral, num_total_prestamos, {_L_SUMS}
            FROM usuarios_g u LEFT JOIN loans_user l ON u.user_id = l.user_id""",
        "j4_pick_account": """SELECT event_id, e.user_id, num_cuentas, account_id, fecha_apertura
            FROM (SELECT event_id, CAST(user_id AS VARCHAR) AS user_id FROM events) e
            JOIN account_numbers a ON e.user_id = a.user_id AND a.orden = e.event_id % a.num_cuentas + 1""",
        "j5_feature_table": f"SELECT * {_ROUNDED} FROM features",
        "m1_training_table": f"SELECT * EXCLUDE (regla) {_ROUNDED} FROM labelled",
        "m2_model_inputs": f"""SELECT * EXCLUDE (regla, riesgo, user_id, cedula, nombre, apellido, fecha_de_nacimiento,
            fecha_registro_banco) {_ROUNDED} FROM labelled""",
        "risk_share_by_employment": """SELECT estado_laboral, CAST(sum(riesgo) AS BIGINT) AS alto_riesgo,
            count(*) AS clientes, round(avg(riesgo), 6) AS tasa FROM labelled GROUP BY estado_laboral""",
        "a4_label_share": """SELECT riesgo, count(*) AS n, round(count(*) / (SELECT count(*) FROM labelled), 6) AS share
            FROM labelled GROUP BY riesgo""",
        "a5_kpis": """SELECT count(*) AS total_clientes,
            round(CAST(sum(CAST(ingreso_mensual_estimado AS DECIMAL(18, 2))) AS DOUBLE) / count(*), 4) AS ingreso_promedio,
            round(avg(edad), 4) AS edad_promedio, round(avg(riesgo) * 100, 4) AS riesgo_alto_pct FROM labelled""",
        "a6_frequencies": _frequencies(),
        "o2_by_frequency": f"SELECT * FROM ({_frequencies()}) ORDER BY columna, n DESC, valor",
        "o1_by_category": """SELECT 'categoria_ingresos' AS columna, categoria_ingresos AS valor, count(*) AS n
            FROM labelled GROUP BY categoria_ingresos""",
        "a7_risk_crosstab": f"{_crosstab('categoria_ingresos')} UNION ALL {_crosstab('rango_edad')}",
        "a8_histogram": " UNION ALL ".join(
            _histogram(c, n) for c, n in (("edad", 10), ("ingreso_mensual_estimado", 15), ("antiguedad_cliente", 10))),
        "a9_collect_accounts": "SELECT user_id, account_id, orden, num_cuentas FROM account_numbers",
        "a10_confusion": f"""SELECT CAST(a AS INTEGER) AS real, CAST(b AS INTEGER) AS predicho,
            (SELECT count(*) FROM {_PAIRS} WHERE y = a AND p = b) AS n FROM range(2) r(a), range(2) s(b)""",
        "a11_accuracy": f"SELECT round(avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS accuracy FROM {_PAIRS}",
        "a12_auc": """SELECT round((sum(avg_rank) FILTER (y = 1) - pos * (pos + 1) / 2) / (pos * neg), 8) AS roc_auc FROM (
            SELECT y, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2 AS avg_rank,
                count(*) FILTER (y = 1) OVER () AS pos, count(*) FILTER (y = 0) OVER () AS neg
            FROM (SELECT c_nationkey % 2 AS y, c_acctbal AS x FROM customer)) GROUP BY pos, neg""",
        "a12_auc_ties": """SELECT round((sum(avg_rank) FILTER (y = 1) - pos * (pos + 1) / 2) / (pos * neg), 8) AS roc_auc FROM (
            SELECT y, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2 AS avg_rank,
                count(*) FILTER (y = 1) OVER () AS pos, count(*) FILTER (y = 0) OVER () AS neg
            FROM (SELECT c_nationkey % 2 AS y, round(c_acctbal, -2) AS x FROM customer)) GROUP BY pos, neg""",
        "a13_report": f"""WITH pairs AS (SELECT * FROM {_PAIRS}), one AS (SELECT c,
                count(*) FILTER (y = c AND p = c) AS hit, count(*) FILTER (p = c) AS said, count(*) FILTER (y = c) AS support
                FROM pairs, range(2) r(c) GROUP BY c),
            rates AS (SELECT c, support, coalesce(hit / nullif(said, 0), 0) AS p, coalesce(hit / nullif(support, 0), 0) AS r
                FROM one),
            scores AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM rates)
            SELECT CAST(c AS VARCHAR) AS clase, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support
                FROM scores
            UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6),
                CAST(sum(support) AS BIGINT) FROM scores
            UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6),
                round(sum(r * support) / sum(support), 6), round(sum(f * support) / sum(support), 6),
                CAST(sum(support) AS BIGINT) FROM scores""",
        "a14_feature_profile": _profile(),
        "m3_feature_types": f"SELECT feature, kind, filled FROM ({_profile()})",
        "o3_detail_top20": """SELECT user_id, edad, rango_edad, profesion, ingreso_mensual_estimado, categoria_ingresos,
            estado_laboral, antiguedad_cliente, num_total_cuentas, round(saldo_total_en_cuentas, 2) AS saldo_total_en_cuentas,
            num_total_prestamos, round(monto_total_prestado, 2) AS monto_total_prestado,
            CASE riesgo WHEN 1 THEN 'Alto Riesgo' ELSE 'Bajo Riesgo' END AS riesgo_etiqueta
            FROM labelled ORDER BY user_id LIMIT 20""",
        "u1_options": _options(),
        "m4_scaled": "SELECT user_id, " + ", ".join(
            f"round(coalesce((coalesce({c}, 0) - avg(coalesce({c}, 0)) OVER ()) / nullif(stddev_samp(coalesce({c}, 0)) OVER (), 0), 0), 6) AS {c}"
            for c in _INPUTS_NUM) + " FROM labelled",
        "m5_one_hot": "SELECT user_id, " + ", ".join(f"t_{c}.i AS {c}" for c in _INPUTS_TEXT) + " FROM usuarios_g u " + " ".join(
            f"JOIN ({_level_index(c)}) t_{c} ON t_{c}.level = coalesce(u.{c}, 'DESCONOCIDO')" for c in _INPUTS_TEXT),
        "m6_vector_length": f"SELECT CAST({len(_INPUTS_NUM)} + " + " + ".join(
            f"(SELECT count(DISTINCT coalesce({c}, 'DESCONOCIDO')) FROM usuarios_g)" for c in _INPUTS_TEXT) + " AS INTEGER) AS n",
        "m7_split": "SELECT user_id, riesgo, es_prueba FROM split",
        "m7_split_counts": "SELECT riesgo, es_prueba, count(*) AS n FROM split GROUP BY riesgo, es_prueba",
        "m8_class_weight": """SELECT user_id, l.riesgo, round(total / (2 * n), 8) AS peso FROM labelled l
            JOIN class_sizes c ON l.riesgo = c.riesgo""",
        "m8_bootstrap_weights": """SELECT * FROM (
            WITH w AS (SELECT riesgo, t AS tree, CAST('0x' || substr(md5(user_id || '|42|bootstrap ' || (t // 4)), 1 + 8 * (t % 4), 8) AS BIGINT) AS word
                FROM labelled, range(100) r(t)),
            p AS (SELECT k, sum(exp(-1) / factorial(k)) OVER (ORDER BY k) AS upto FROM (SELECT CAST(unnest(range(12)) AS INTEGER) AS k)),
            m AS (SELECT list(CAST(floor(upto * 4294967296) AS BIGINT)) AS limits FROM p),
            d AS (SELECT tree, riesgo, len(list_filter(limits, lambda x: x <= word)) AS n FROM w, m),
            c AS (SELECT tree, riesgo, count(*) AS n_rows, CAST(sum(n) AS BIGINT) AS drawn FROM d WHERE n > 0 GROUP BY tree, riesgo),
            s AS (SELECT *, sum(drawn) OVER t / (count(*) OVER t * drawn) AS weight FROM c WINDOW t AS (PARTITION BY tree))
            SELECT CAST(tree AS INTEGER) AS tree, riesgo, n_rows AS rows, drawn, round(weight, 8) AS weight, round(drawn * weight, 6) AS total FROM s)""",
        "m5_many_levels": """SELECT * FROM (
            WITH l AS (SELECT l_orderkey || '-' || l_linenumber AS transaction_id, l_orderkey::VARCHAR AS account_id, year(l_shipdate) AS anio FROM lineitem),
            d AS (SELECT account_id, row_number() OVER (ORDER BY count(*) DESC, account_id) - 1 AS place FROM l WHERE anio < 1997 GROUP BY account_id)
            SELECT transaction_id, place FROM l LEFT JOIN d USING (account_id))""",
        "m9_contract": "SELECT user_id, riesgo, true AS suman, true AS mayor, true AS etiqueta FROM split",
        "m10_support": "SELECT riesgo, count(*) AS n FROM split WHERE es_prueba GROUP BY riesgo",
        "r6_contract": """SELECT request_id, CASE WHEN error IS NULL THEN 200 ELSE 400 END AS status, error,
            error IS NULL AS con_puntaje FROM checked""",
        "t2_stream_scoring": """SELECT CASE WHEN error IS NULL THEN 200 ELSE 400 END AS status, error,
            error IS NULL AS con_puntaje, count(*) AS n FROM checked GROUP BY ALL""",
        "g4_dangling_recipients": "SELECT CAST(0 AS BIGINT) AS n",
        "s8_event_paths": """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 's3a://bronze/' || o_orderstatus || '/' || o_orderkey || '.csv'
            WHEN 1 THEN '/data/' || o_orderkey || '.csv' END AS path FROM orders""",
        "r1_event_body": """SELECT request_id, CASE WHEN request_id NOT LIKE '%3' AND body IS NULL
            THEN md5('{"path":"/riesgo"}') ELSE md5(body) END AS body_md5 FROM requests""",
        "r2_request_status": """SELECT request_id, CASE WHEN error IS NULL THEN 200 ELSE 400 END AS status, error
            FROM checked""",
        "r2_request_status_reject": "SELECT request_id, CASE WHEN error IS NULL AND "
            + " AND ".join(f"json_extract_string(body, '$.{c}') IS NOT NULL" for c in _INPUTS_NUM + _INPUTS_TEXT)
            + " THEN 200 ELSE 400 END AS status FROM checked",
        "r3_r4_request_features": _request_features(),
        "r7_prompt": _prompt(),
        "t1_stream_ingest": gold["s4_gold_transacciones"],
        "t1_replaced_files": gold["s4_gold_prestamos"],
        "t2_stream_rows": """SELECT md5(translate(coalesce(body, ''), chr(13) || chr(10), '  ')) AS body_md5,
            CASE WHEN error IS NULL THEN 200 ELSE 400 END AS status, error, error IS NULL AS con_puntaje, 'v000001' AS version FROM checked""",
    }
    return bodies | _generated()


def oracle_sql() -> dict[str, str]:
    return {name: _statement(body) for name, body in _bodies().items()}
