"""Edge rows of cleaning and enrichment, one by one."""

import pytest
from pyspark.sql import functions as F

from caudal import schemas
from caudal.functions import bins, coerce, dates, rules, text
from caudal.operators import entities

AS_OF = "2024-06-01 12:00:00"


def values(spark, inputs, build, kind="string"):
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


def one(spark, entity, **columns):
    names = schemas.BRONZE_COLUMNS[entity]
    row = tuple(columns.get(c) for c in names)
    return spark.createDataFrame([row], schemas.bronze_schema(entity))


def test_text(spark):
    given = ["\t ahorros \t", "Técnico", "Unión  Libre", "Straße", "Œuvre", "  ", None, "café", " Ñandú"]
    assert values(spark, given, text.normalise) == [
        "AHORROS", "TECNICO", "UNION  LIBRE", "STRASSE", "OEUVRE", "", None, "CAFE", "NANDU"]


def test_missing_words(spark):
    df = spark.createDataFrame([("N/A",), ("None",), ("",), ("Ninguno",), ("n/a",), (" ",)], "v string")
    assert [r.v for r in coerce.null_tokens(df).collect()] == [None, None, None, "Ninguno", None, " "]


def test_timestamps_row_by_row(spark):
    given = ["2020-01-01T10:00:00", "2020-01-01T10:00:00.5", "2020-01-02", "bad", "10:00", None]
    got = values(spark, given, lambda c: coerce.timestamp(c).cast("string"))
    assert got == ["2020-01-01 10:00:00", "2020-01-01 10:00:00.5", "2020-01-02 00:00:00", None, None, None]


def test_numbers(spark):
    given = ["1e5", " 12 ", "1,000", "1.0d", "0x10", "2f ", "inf", "-Infinity", "nan", "true", None]
    inf = float("inf")
    assert values(spark, given, coerce.number) == [
        100000.0, 12.0, None, None, None, None, inf, -inf, None, None, None]
    assert values(spark, ["x", None, "7"], coerce.number_or_zero) == [0.0, 0.0, 7.0]
    assert values(spark, ["3.7", "x", "-2.9", None, "1e300"], coerce.integer_or_zero) == [3, 0, -2, 0, 0]


def test_whole_days_round_down(spark):
    given = ["2024-06-01 00:00:00", "2024-06-02 00:00:00", "2024-05-31 12:00:01", None]
    assert values(spark, given, lambda c: dates.whole_days(c.cast("timestamp"), AS_OF)) == [0, -1, 0, None]
    assert values(spark, given[:2], lambda c: dates.whole_years(c.cast("timestamp"), AS_OF)) == [0, -1]


@pytest.mark.parametrize("name, given, expected", [
    ("estado_laboral", ["DESEMPLEADO", "BECARIO", None, "PENSIONADO"], ["EMPLEADO", "OTRO", "DESCONOCIDO", "PENSIONADO"]),
    ("estado_cuenta", ["INACTIVA", "BLOQUEADO", "CERRADA", None], ["ACTIVA", "BLOQUEADA", "CERRADA", "DESCONOCIDO"]),
    ("tipo_transaccion", ["NOMINA", "TRANSFERENCIA X", "PAGO DE SERVICIO", "ATM", "PAGO"],
     ["NOMINA", "TRANSFERENCIA", "PAGO_SERVICIO", "RETIRO", "PAGO"]),
    ("categoria", [None, "PAGO OBLIGACION", "AGUA"], ["OTRO", "PAGO_OBLIGACION", "AGUA"]),
    ("proposito", [None, "LIBRE INVERSION", "INVERSION"], ["OTRO", "LIBRE_INVERSION", "INVERSION"]),
    ("banco_destinatario", ["DAVIPLATA", "BANCO X", None, "COLPATRIA"],
     ["DAVIPLATA", "BANCO X", "DESCONOCIDO", "SCOTIABANK_COLPATRIA"]),
])
def test_rules(spark, name, given, expected):
    assert values(spark, given, lambda c: rules.categorise(c, name)) == expected


def test_corrected_rules(spark):
    for name, given, expected in (("estado_laboral", "DESEMPLEADO", "DESEMPLEADO"),
                                  ("estado_cuenta", "INACTIVA", "INACTIVA"), ("tipo_transaccion", "NOMINA", "SALARIO")):
        assert values(spark, [given], lambda c: rules.categorise(c, name, "corrected")) == [expected]
    with pytest.raises(ValueError):
        rules.rule_table("categoria", "other")


@pytest.mark.parametrize("name, given, expected", [
    ("periodo_dia", [0.0, 6.0, 23.0, 24.0, -1.0], ["MADRUGADA", "MAÑANA", "NOCHE", None, None]),
    ("rango_edad", [-1.0, 0.0, 24.0, 25.0, 65.0], [None, "18-25", "18-25", "26-35", "65+"]),
    ("categoria_tasa", [-1.0, 15.0, None], [None, "BAJA", None]),
    ("monto_transaccion", [1e6, float("inf"), float("-inf"), float("nan")], ["GRANDE", None, "MUY_PEQUEÑO", None]),
])
def test_bins(spark, name, given, expected):
    assert values(spark, given, lambda c: bins.bin_label(c, name), "double") == expected


@pytest.mark.parametrize("name", list(bins.BINS))
def test_bins_cover_their_range_once(spark, name):
    edges, labels = bins.BINS[name].edges, bins.BINS[name].labels
    inner = [e for e in edges if abs(e) != bins.INF]
    probes = sorted({float(x) for e in inner for x in (e - 0.5, e, e + 0.5)})
    expected = []
    for x in probes:
        hits = [label for lo, hi, label in zip(edges, edges[1:], labels) if lo <= x < hi]
        expected.append(hits[0] if hits else None)
    assert values(spark, probes, lambda c: bins.bin_label(c, name), "double") == expected


def test_masking(spark):
    given = ["123456", "1234", None]
    assert values(spark, given, text.mask_account) == ["****3456", "1234", None]
    assert values(spark, given, lambda c: text.mask_account(c, strict=True)) == ["****3456", "****", None]


def test_name_parts(spark):
    given = ["ANA", "   ", "JOSE  PEREZ", None]
    assert values(spark, given, lambda c: text.name_part(c, 0)) == ["ANA", None, "JOSE", None]
    assert values(spark, given, lambda c: text.name_part(c, 1)) == [None, None, "PEREZ", None]


def test_bad_birth_date(spark):
    df = one(spark, "usuarios", user_id="1", fecha_de_nacimiento="bad", fecha_registro_banco="2020-01-01")
    assert entities.refine(df, "usuarios", AS_OF).first().edad is None
    with pytest.raises(Exception, match="fecha_de_nacimiento"):
        entities.clean(df, "usuarios", AS_OF, entities.Options(on_bad_date="fail")).collect()


def test_flags_at_the_limit(spark):
    tx = entities.refine(one(spark, "transacciones", monto="1000000"), "transacciones", AS_OF).first()
    assert (tx.categoria_monto, tx.transaccion_grande) == ("GRANDE", 0)
    loan = entities.refine(one(spark, "prestamos", monto_otorgado="x"), "prestamos", AS_OF).first()
    assert (loan.categoria_monto, loan.prestamo_grande, loan.interes_total_estimado) == (None, 0, None)


@pytest.mark.parametrize("entity", schemas.ENTITIES)
def test_gold_contract(spark, entity):
    got = entities.refine(one(spark, entity), entity, AS_OF)
    assert got.columns == schemas.GOLD_COLUMNS[entity]
    assert not {"numero_cuenta", "numero_cuenta_dest", "descripcion"} & set(got.columns)
    wanted = {f.name: f.dataType for f in schemas.gold_schema(entity)}
    assert {f.name: f.dataType for f in got.schema} == wanted


def test_missing_columns_are_skipped(spark):
    df = spark.createDataFrame([("1", "12")], "loan_id string, plazo_meses string")
    assert entities.refine(df, "prestamos", AS_OF).columns == ["loan_id", "plazo_meses"]


def test_every_script_with_a_rule_like_character_by_character(spark):
    """The column of any text is what its characters give one by one; characters without rule stay."""
    from caudal.functions import scripts, text

    blocks = [(0x00A1, 0x0250), (0x0370, 0x0700), (0x10A0, 0x1100), (0x1E00, 0x2190), (0x2460, 0x2500), (0x3041, 0x3100),
              (0x4E00, 0x4E40), (0xAC00, 0xAE00), (0xD700, 0xD7A4), (0xFB00, 0xFB50), (0xFF01, 0xFFDD)]
    chars = [chr(c) for a, b in blocks for c in range(a, b) if chr(c).isprintable()]
    listed = set(text.SHORT_FORMS) | set(text.LONG_FORMS)
    df = spark.createDataFrame([(c,) for c in chars], "c string").select("c", text.to_ascii(F.concat(F.lit("x"), "c")).alias("t"))
    got = {r.c: r.t for r in df.collect()}
    hangul = {"가": "xga", "각": "xgag", "힣": "xhih", "읽": "xilg"}
    for c in chars:
        if "가" <= c <= "힣":
            assert got[c].isascii() and got[c] == hangul.get(c, got[c])
        elif c not in listed:
            assert got[c] == "x" + (scripts.latin(c) or c)
    assert sum(len(x.encode()) == len(x) for x in got.values()) > 2_500


def test_capitals_follow_their_small_letters():
    from caudal.functions.scripts import latin

    assert "".join(map(latin, "Ωμέγα Щука Įž ΐ")) == "Omega Shchuka Iz i"
    assert latin("日") is None and latin("½") == "1/2"
