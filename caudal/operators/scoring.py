"""Batch scoring of JSON requests: parse, check, default, derive, predict, respond, explain."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F

from caudal.functions import bins, rules, text
from caudal.operators import model as models
from caudal.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES, UNKNOWN

FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES

OK, BAD_REQUEST, FAILED = 200, 400, 500

RESPONSE = [
    "prediccion_numerica", "prediccion_etiqueta", "probabilidad_bajo_riesgo",
    "probabilidad_alto_riesgo",
]


def event_body(event: Column) -> Column:
    """Request text of a call record: its ``body`` (text or object), else the record itself."""
    return F.coalesce(F.try_variant_get(F.try_parse_json(event), "$.body", "string"), event)


def parse_requests(df: DataFrame, body: str = "body", on_missing: str = "default") -> DataFrame:
    """Adds ``status``, ``error`` and one column per model input.

    The text is parsed once. An input that is present and can't be read is a bad request.
    ``on_missing="default"`` leaves absent inputs null for later; ``"reject"`` turns a request that lacks any
    input into a bad request.
    """
    if on_missing not in ("default", "reject"):
        raise ValueError(f"unknown on_missing {on_missing!r}")
    parsed = df.withColumn("_json", F.try_parse_json(body))
    fields = {c: F.try_variant_get("_json", f"$.{c}", "double") for c in NUMERIC_FEATURES}
    fields |= {c: F.try_variant_get("_json", f"$.{c}", "string") for c in CATEGORICAL_FEATURES}
    parsed = parsed.withColumns(fields)
    problem = F.when(F.col("_json").isNull(), F.lit("body is not valid JSON")).when(
        ~F.schema_of_variant("_json").startswith("OBJECT"), F.lit("body is not a JSON object")
    )
    # A number must read as one; a text must not be an object or a list.
    def bad(name, value):
        kind = F.schema_of_variant(value)
        no_number = name.isin(NUMERIC_FEATURES) & ~F.is_variant_null(value) & F.try_variant_get(value, "$", "double").isNull()
        return no_number | (name.isin(CATEGORICAL_FEATURES) & (kind.startswith("OBJECT") | kind.startswith("ARRAY")))

    inputs = F.try_variant_get("_json", "$", "map<string,variant>")
    unreadable = F.coalesce(F.array_join(F.array_sort(F.map_keys(F.map_filter(inputs, bad))), ", "), F.lit(""))
    problem = problem.when(unreadable != "", F.concat(F.lit("unreadable inputs: "), unreadable))
    if on_missing == "reject":
        absent = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in FEATURES])
        problem = problem.when(absent != "", F.concat(F.lit("missing inputs: "), absent))
    return parsed.withColumn("error", problem).withColumn(
        "status", F.when(F.col("error").isNull(), F.lit(OK)).otherwise(F.lit(BAD_REQUEST))
    ).drop("_json")


def trained_texts(df: DataFrame, mode: str = "reference") -> DataFrame:
    """Text inputs as training has them: normalised, and put into the categories of the two columns that have some."""
    return df.withColumns({c: text.normalise(F.col(c)) for c in CATEGORICAL_FEATURES}).withColumns({
        c: F.when(F.col(c).isNotNull(), rules.categorise(F.col(c), c, mode)) for c in ("estado_laboral", "nivel_educativo")
    })


def complete(df: DataFrame, rules_mode: str = "reference") -> DataFrame:
    """Fills absent inputs and derives what training derives.

    Texts are normalised and categorised as in training, the two flags come from their source column when absent,
    and age range and income category always follow from age and income.
    """
    age = F.col("edad")
    flags = {
        "tiene_dependientes": F.coalesce(
            F.col("tiene_dependientes"), bins.flag(F.col("numero_dependientes") > 0).cast("double")),
        "vivienda_propia": F.coalesce(
            F.col("vivienda_propia"), bins.flag(F.col("tipo_vivienda") == "PROPIA").cast("double")),
    }
    defaults = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in NUMERIC_FEATURES}
    defaults |= {c: F.coalesce(F.col(c), F.lit(UNKNOWN)) for c in CATEGORICAL_FEATURES}
    derived = {
        "rango_edad": F.coalesce(
            F.when(age > 0, bins.bin_label(age, "rango_edad")), F.lit(UNKNOWN)),
        "categoria_ingresos": F.coalesce(
            bins.bin_label(F.col("ingreso_mensual_estimado"), "categoria_ingresos"), F.lit(UNKNOWN)),
    }
    return trained_texts(df, rules_mode).withColumns(flags).withColumns(defaults).withColumns(derived)


def request_features(
    df: DataFrame, body: str = "body", on_missing: str = "default", rules_mode: str = "reference"
) -> DataFrame:
    """Parsed and completed requests; rejected mode takes derived inputs as given. ``rules_mode`` is that of the training
    data."""
    parsed = parse_requests(df, body, on_missing)
    return complete(parsed, rules_mode) if on_missing == "default" else trained_texts(parsed, rules_mode)


def score_requests(
    model: PipelineModel | str, df: DataFrame, body: str = "body", on_missing: str = "default", rules_mode: str = "reference"
) -> DataFrame:
    """One response per request, bad ones included with their error. Given a path, the model is loaded; if that fails,
    good requests are answered with 500."""
    keep = [c for c in df.columns if c not in FEATURES]
    rows = request_features(df, body, on_missing, rules_mode)
    try:
        scored = models.predict(models.load(model) if isinstance(model, str) else model, rows)
    except models.ModelNotLoaded as problem:
        good = F.col("status") == OK
        scored = rows.withColumns({
            "error": F.when(good, F.lit(str(problem))).otherwise(F.col("error")),
            "status": F.when(good, F.lit(FAILED)).otherwise(F.col("status")),
            **{c: F.lit(None).cast("string" if c == "prediccion_etiqueta" else "double") for c in RESPONSE},
        })
    good = F.col("status") == OK
    answers = scored.select(
        *keep, "status", "error", *[F.when(good, F.col(c)).alias(c) for c in RESPONSE]
    )
    failure = F.to_json(F.struct("error"))
    return answers.withColumn(
        "response", F.when(good, F.to_json(F.struct(*RESPONSE))).otherwise(failure)
    )


def _shown(column: str, numeric: bool) -> Column:
    value = F.col(column)
    if not numeric:
        return F.coalesce(value.cast("string"), F.lit("nan"))
    number = F.round(value.cast("double"), 2)
    whole = number == F.floor(number)
    return F.when(whole, F.floor(number).cast("string")).otherwise(
        F.coalesce(F.format_string("%.2f", number), F.lit("nan"))
    )


def feature_lines(numeric: list[str] = NUMERIC_FEATURES, texts: list[str] = CATEGORICAL_FEATURES) -> Column:
    """Readable list, one ``- Name: value`` line per input."""
    lines = [
        F.concat(F.lit(f"- {c.replace('_', ' ').capitalize()}: "), _shown(c, c in numeric))
        for c in numeric + texts
    ]
    return F.concat_ws("\n", *lines)


PROMPT = """Informe para el comité de crédito de {bank}.

Perfil evaluado:
%s

El modelo clasifica este perfil como %s (alto riesgo %s, bajo riesgo %s).

Responde en tres párrafos. Primero, qué cifras del perfil se apartan de lo habitual y en qué sentido, citando su valor. \
Segundo, qué campos faltan, valen cero o no son coherentes entre sí, y qué documento los aclararía. \
Tercero, si la clasificación se sostiene sin esos campos, y el siguiente paso que propones."""


def percent(value: Column) -> Column:
    return F.concat(F.format_string("%.2f", F.round(value * 100, 2)), F.lit("%"))


def with_prompt(df: DataFrame, bank: str = "el banco") -> DataFrame:
    """Adds the feature list and the explanation request for every scored row."""
    label = F.upper("prediccion_etiqueta")
    listed = df.withColumn("caracteristicas", feature_lines())
    return listed.withColumn(
        "prompt",
        F.format_string(
            PROMPT.replace("{bank}", bank.replace("%", "%%")), F.col("caracteristicas"), label,
            percent(F.col("probabilidad_alto_riesgo")), percent(F.col("probabilidad_bajo_riesgo")),
        ),
    )
