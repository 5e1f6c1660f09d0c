"""Column contracts of the five banking tables in each zone, and the model inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

# Table and column names of the raw zone.
BRONZE_COLUMNS = {
    "usuarios": [
        "user_id", "cedula", "nombre", "apellido", "ciudad_residencia", "fecha_de_nacimiento",
        "profesion", "ingreso_mensual_estimado", "estado_laboral", "nivel_educativo",
        "estado_civil", "numero_dependientes", "tipo_vivienda", "fecha_registro_banco",
    ],
    "cuentas": [
        "account_id", "user_id", "numero_cuenta", "tipo_cuenta", "fecha_apertura",
        "saldo_actual", "moneda", "estado_cuenta",
    ],
    "destinatarios": [
        "recipient_id", "nombre_registrado", "banco_destinatario", "tipo_cuenta_dest",
        "numero_cuenta_dest",
    ],
    "transacciones": [
        "transaction_id", "account_id", "user_id", "monto", "fecha", "tipo_transaccion",
        "categoria", "canal", "tipo_tarjeta_usada", "recipient_id_fk", "descripcion",
    ],
    "prestamos": [
        "loan_id", "user_id", "monto_otorgado", "tasa_interes_anual", "plazo_meses",
        "fecha_desembolso", "cuota_mensual", "estado_prestamo", "proposito",
    ],
}

ENTITIES = list(BRONZE_COLUMNS)

# Types that differ from string once a table is cleaned or enriched.
_TYPES = {
    "fecha_de_nacimiento": "timestamp", "fecha_registro_banco": "timestamp",
    "fecha_apertura": "timestamp", "fecha": "timestamp", "fecha_desembolso": "timestamp",
    "ingreso_mensual_estimado": "double", "saldo_actual": "double", "monto": "double",
    "monto_otorgado": "double", "tasa_interes_anual": "double", "plazo_meses": "double",
    "cuota_mensual": "double", "antiguedad_anios": "double", "interes_total_estimado": "double",
    "numero_dependientes": "int", "edad": "int", "antiguedad_cliente": "int",
    "tiene_dependientes": "int", "vivienda_propia": "int", "cuenta_protegida": "int",
    "cuenta_bloqueada": "int", "transaccion_grande": "int", "prestamo_grande": "int",
    "anio_apertura": "int", "mes_apertura": "int", "dia_apertura": "int",
    "anio_desembolso": "int", "mes_desembolso": "int", "dia_desembolso": "int",
    "anio": "int", "mes": "int", "dia": "int", "hora": "int",
}

# Column order of the enriched zone.
GOLD_COLUMNS = {
    "usuarios": [
        "user_id", "cedula", "nombre", "apellido", "ciudad_residencia", "fecha_de_nacimiento",
        "edad", "rango_edad", "profesion", "ingreso_mensual_estimado", "categoria_ingresos",
        "estado_laboral", "nivel_educativo", "estado_civil", "numero_dependientes",
        "tiene_dependientes", "tipo_vivienda", "vivienda_propia", "fecha_registro_banco",
        "antiguedad_cliente",
    ],
    "cuentas": [
        "account_id", "user_id", "numero_cuenta_masked", "tipo_cuenta", "fecha_apertura",
        "anio_apertura", "mes_apertura", "dia_apertura", "antiguedad_anios", "saldo_actual",
        "categoria_saldo", "moneda", "estado_cuenta", "cuenta_protegida", "cuenta_bloqueada",
    ],
    "destinatarios": [
        "recipient_id", "nombre_registrado", "primer_nombre", "primer_apellido",
        "banco_destinatario", "tipo_banco", "tipo_cuenta_dest", "cuenta_protegida",
        "numero_cuenta_masked",
    ],
    "transacciones": [
        "transaction_id", "account_id", "user_id", "monto", "categoria_monto",
        "transaccion_grande", "fecha", "anio", "mes", "dia", "hora", "periodo_dia",
        "tipo_transaccion", "categoria", "canal", "tipo_tarjeta_usada", "recipient_id_fk",
    ],
    "prestamos": [
        "loan_id", "user_id", "monto_otorgado", "categoria_monto", "prestamo_grande",
        "tasa_interes_anual", "categoria_tasa", "interes_total_estimado", "plazo_meses",
        "fecha_desembolso", "anio_desembolso", "mes_desembolso", "dia_desembolso",
        "cuota_mensual", "estado_prestamo", "proposito",
    ],
}

# Aggregates of the feature table with their types.
ACCOUNT_FEATURES = {
    "num_total_cuentas": "bigint",
    "saldo_total_en_cuentas": "double",
    "promedio_transacciones_por_cuenta": "double",
    "monto_total_movido_por_usuario": "double",
}
LOAN_FEATURES = {
    "num_total_prestamos": "bigint",
    "monto_total_prestado": "double",
    "promedio_monto_prestamo": "double",
}

LABEL = "riesgo"

# Model inputs, and the identifiers and raw dates that are not inputs.
NUMERIC_FEATURES = [
    "edad", "ingreso_mensual_estimado", "numero_dependientes", "tiene_dependientes",
    "vivienda_propia", "antiguedad_cliente", "num_total_cuentas", "saldo_total_en_cuentas",
    "promedio_transacciones_por_cuenta", "monto_total_movido_por_usuario",
    "num_total_prestamos", "monto_total_prestado", "promedio_monto_prestamo",
]
CATEGORICAL_FEATURES = [
    "ciudad_residencia", "rango_edad", "profesion", "categoria_ingresos", "estado_laboral",
    "nivel_educativo", "estado_civil", "tipo_vivienda",
]
NOT_FEATURES = [
    "user_id", "cedula", "nombre", "apellido", "fecha_de_nacimiento", "fecha_registro_banco",
]

UNKNOWN = "DESCONOCIDO"


def bronze_schema(entity: str) -> T.StructType:
    """Every raw column is text, so identifiers keep their leading zeros."""
    return T.StructType([T.StructField(c, T.StringType()) for c in BRONZE_COLUMNS[entity]])


def gold_schema(entity: str) -> T.StructType:
    return T._parse_datatype_string(
        ", ".join(f"{c} {_TYPES.get(c, 'string')}" for c in GOLD_COLUMNS[entity])
    )


def only_existing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Ordered projection that keeps the listed columns the table really has."""
    present = set(df.columns)
    return df.select(*[c for c in columns if c in present])
