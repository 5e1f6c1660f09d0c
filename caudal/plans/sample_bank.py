"""Raw banking tables made from the order-and-customer test tables.

Texts are dirty on purpose (accents, blanks, unknown words, missing-value words, unreadable
numbers and dates), so that every cleaning step has something to do. All columns are text, as in a
raw csv.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2002-01-01 00:00:00"


def source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def usuarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "k").selectExpr(
        "cast(k as string) as user_id",
        "lpad(cast(k as string), 10, '0') as cedula",
        "array(' José', 'María ', 'Ángela', 'Zoë', 'Iñigo')[k % 5] as nombre",
        "array('Núñez', 'Pérez', 'Gómez', ' Ríos ')[k % 4] as apellido",
        "concat('Ciudad ', c_nationkey) as ciudad_residencia",
        "cast(date_sub(date'2002-01-01', cast(6570 + k * 53 % 20800 as int)) as string) as fecha_de_nacimiento",
        "array('Ingeniero', 'Médica', 'Abogado', 'Diseñador ', null, 'Electricista', 'N/A')[k % 7] as profesion",
        "cast(cast(greatest(c_acctbal, 0) * 1500 as decimal(18, 2)) as string) as ingreso_mensual_estimado",
        "array(' Empleado', 'Independiente', 'Desempleado', 'Estudiante', 'Pensionado', null)[k % 6] as estado_laboral",
        "array('Primaria', 'Secundaria', ' Técnico', 'Universitario', 'Postgrado', 'Ninguno', null, 'Doctorado')[k % 8]"
        " as nivel_educativo",
        "array('Soltero(a)', 'Casado(a)', 'Unión Libre', null, 'Separado(a)')[k % 5] as estado_civil",
        "array(' 2', '0', 'x', null, '3.7')[k % 5] as numero_dependientes",
        "array('Propia', ' Alquilada\\t', 'Familiar', 'N/A')[k % 4] as tipo_vivienda",
        "concat(date_sub(date'2002-01-01', cast(k * 37 % 3650 as int)), 'T00:00:00') as fecha_registro_banco",
    )


def cuentas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "k").selectExpr(
        "cast(k as string) as account_id",
        "cast(o_custkey as string) as user_id",
        "right(lpad(cast(k as string), 12, '0'), if(k % 50 = 0, 4, 12)) as numero_cuenta",
        "array('Ahorros', 'Corriente', 'Nómina', null)[k % 4] as tipo_cuenta",
        "if(k % 307 = 306, 'bad', concat(date_format(o_orderdate, 'yyyy-MM-dd'), "
        "array('T00:00:00', 'T23:30:00.5')[k % 2])) as fecha_apertura",
        "if(k % 97 = 96, 'x', cast(cast(o_totalprice * 55 - 500000 as decimal(18, 2)) as string)) as saldo_actual",
        "' cop ' as moneda",
        "case o_orderstatus when 'O' then 'Activa' when 'F' then ' Inactiva' when 'P' then 'Bloqueada' end"
        " as estado_cuenta",
    )


def transacciones(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = source(spark, sf_dir, "lineitem").withColumnsRenamed({"l_orderkey": "o", "l_linenumber": "n"})
    return lines.selectExpr(
        "concat(o, '-', n) as transaction_id",
        "if(o % 41 = 40, 'N/A', cast(o as string)) as account_id",
        "cast(l_suppkey as string) as user_id",
        "if((o + n) % 113 = 112, 'x', cast(cast(l_extendedprice * l_quantity as decimal(18, 2)) as string)) as monto",
        "concat(date_format(l_shipdate, 'yyyy-MM-dd'), 'T', lpad((o * 7 + n) % 24, 2, '0'), ':15:00') as fecha",
        "array('Compra', 'Transferencia Enviada', 'Transferencia Recibida', 'Pago Servicio', 'Retiro ATM', "
        "'Depósito', 'Pago Préstamo', 'Salario', 'Nómina', null, ' Ajuste ', 'Transferencia')[(o + n) % 12]"
        " as tipo_transaccion",
        "array('Alimentación', 'Transporte', 'Entretenimiento', 'Ropa y Accesorios', 'Hogar', 'Salud', 'Tecnología', "
        "'Viajes', 'Servicio de aseo', 'Pago Obligación', null, 'Comisión Bancaria', 'Agua', 'Retiro')[(o * 3 + n) % 14]"
        " as categoria",
        "array('Online', 'POS', 'ATM', 'Sucursal', 'App Móvil')[n % 5] as canal",
        "array('Crédito', 'Débito', 'N/A')[(o + n) % 3] as tipo_tarjeta_usada",
        "if((o + n) % 12 = 1, cast(l_suppkey as string), null) as recipient_id_fk",
        "concat('mov ', n) as descripcion",
    )


def prestamos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "k").selectExpr(
        "cast(k as string) as loan_id",
        "cast(o_custkey as string) as user_id",
        "if(k % 29 = 28, 'x', cast(cast(o_totalprice * 100 as decimal(18, 2)) as string)) as monto_otorgado",
        "if(k % 31 = 30, '-1', cast(cast(10 + (k % 250) / 10 as decimal(6, 1)) as string)) as tasa_interes_anual",
        "array('12', '24', '36', '48', '60', '72')[k % 6] as plazo_meses",
        "date_format(o_orderdate, 'yyyy-MM-dd') as fecha_desembolso",
        "cast(cast(o_totalprice as decimal(18, 2)) as string) as cuota_mensual",
        "array('Activo', 'Pagado', 'En Mora', null, 'Castigado')[k % 5] as estado_prestamo",
        "array('Libre Inversión', 'Compra Vehículo', 'Educación', 'Vivienda', 'Deuda', null, 'Viaje')[k % 7] as proposito",
    )


def destinatarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "k").selectExpr(
        "cast(k as string) as recipient_id",
        "array('José  Pérez', 'Ana', 'María José Ríos', null)[k % 4] as nombre_registrado",
        "array('Davivienda', 'Bancolombia', 'BBVA', 'Banco de Bogotá', 'Itaú', 'Scotiabank Colpatria', 'Banco Agrario', "
        "'Nequi', 'Daviplata', null, 'Banco X')[k % 11] as banco_destinatario",
        "array('Ahorros', 'cuenta de ahorro', 'Corriente', null, 'Depósito')[k % 5] as tipo_cuenta_dest",
        "if(k % 13 = 12, null, cast(k * 7919 % 1000003 as string)) as numero_cuenta_dest",
    )


BRONZE = {
    "usuarios": usuarios, "cuentas": cuentas, "destinatarios": destinatarios,
    "transacciones": transacciones, "prestamos": prestamos,
}


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring requests: mostly objects, some arrays and broken texts, some with few inputs."""
    events = source(spark, sf_dir, "events").selectExpr(
        "concat('e', event_id) as request_id",
        """case
            when event_id % 17 = 16 then '[1]'
            when event_id % 19 = 18 then null
            when event_id % 31 = 30 then '{"edad": "abc", "estado_laboral": "Desempleado"}'
            when event_id % 37 = 36 then '{"edad": 44, "estado_laboral": "Desempleado"}'
            when event_id % 23 = 22 then concat('{"edad": ', user_id)
            when event_id % 5 = 4 then concat('{"edad": ', user_id % 70, '}')
            when event_id % 29 = 28 then to_json(named_struct(
                'edad', user_id % 70, 'ingreso_mensual_estimado', 1500000, 'numero_dependientes', 1,
                'tiene_dependientes', 1, 'vivienda_propia', 0, 'antiguedad_cliente', event_id % 9,
                'num_total_cuentas', 2, 'saldo_total_en_cuentas', 5000000.5, 'promedio_transacciones_por_cuenta', 4,
                'monto_total_movido_por_usuario', 100000, 'num_total_prestamos', event_id % 3,
                'monto_total_prestado', 0, 'promedio_monto_prestamo', 0, 'ciudad_residencia', 'CALI',
                'rango_edad', '26-35', 'profesion', 'MEDICA', 'categoria_ingresos', 'BAJOS',
                'estado_laboral', 'EMPLEADO', 'nivel_educativo', 'OTRO', 'estado_civil', 'VIUDO(A)',
                'tipo_vivienda', 'FAMILIAR'))
            else concat('{"edad": ', user_id % 70, ', "ingreso_mensual_estimado": ', cast(floor(value * 100000) as bigint),
                ', "estado_laboral": " ', array('Estudiante', 'empleado', 'Pensionado')[event_id % 3],
                '", "numero_dependientes": ', event_id % 3, ', "tipo_vivienda": "Propia", "num_total_prestamos": ',
                event_id % 4, '}')
        end as body""",
    )
    talk = source(spark, sf_dir, "conversations").selectExpr(
        "concat('c', conv_id, '-', turn) as request_id", "text as body"
    )
    return events.unionByName(talk)
