"""Training, storage, scoring and both streams."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from caudal import schemas
from caudal.operators import entities, model, scoring
from caudal.plans import sample_bank, sample_queries, training
from caudal.sources import folders, registry, tables
from caudal.streaming import ingest, scoring as stream


@pytest.fixture(scope="module")
def table(spark, sf):
    return training.materialise(spark, sample_queries.labelled(spark, sf).drop("regla"), "table")


@pytest.fixture(scope="module")
def fitted(table):
    return model.train(table, trees=10, depth=5)


def test_fit_store_load(spark, table, tmp_path):
    done = training.fit_and_evaluate(spark, table, f"{tmp_path}/model", trees=10, depth=5)
    figures = {(r.metrica, r.clase): r.valor for r in done.evaluation.collect()}
    assert 0.5 < figures[("accuracy", None)] <= 1 and 0.5 < figures[("roc_auc", None)] <= 1
    loaded = model.load(f"{tmp_path}/model")
    before = model.predict(done.model, table).select("user_id", *scoring.RESPONSE)
    after = model.predict(loaded, table).select("user_id", *scoring.RESPONSE)
    assert before.exceptAll(after).count() == 0
    with pytest.raises(model.ModelNotLoaded):
        model.load(f"{tmp_path}/nothing")


def test_unseen_levels_and_nulls_are_scored(fitted, table):
    odd = table.limit(5).withColumns({"profesion": F.lit("ASTRONAUTA"), "edad": F.lit(None).cast("int"),
                                      "tipo_vivienda": F.lit(None).cast("string")})
    got = model.predict(fitted, odd).collect()
    assert len(got) == 5
    assert all(abs(r.probabilidad_bajo_riesgo + r.probabilidad_alto_riesgo - 1) < 1e-9 for r in got)
    vector = fitted.transform(model.prepare(odd)).select("_v_profesion").first()[0]
    assert vector.numNonzeros() == 0


def test_encoding_is_the_callers_choice(table, monkeypatch, tmp_path):
    hashed = model.train(table, trees=3, depth=3, encoding="hash")
    assert model.predict(hashed, table.limit(3)).count() == 3
    with pytest.raises(ValueError):
        model.train(table, encoding="none")
    with pytest.raises(ValueError):
        model.train(table, weights="none")
    monkeypatch.setattr(model, "MAX_LEVELS", 4)
    stored = model.train(table, trees=3, depth=3)
    monkeypatch.undo()
    assert stored.stages[-1].getNumTrees == 3 and any(type(x).__name__ == "LevelIndexerModel" for x in stored.stages)
    odd = table.withColumn("profesion", F.when(F.col("edad") % 2 == 0, F.col("profesion")).otherwise("ASTRONAUTA"))
    in_memory = model.train(table, trees=3, depth=3)
    same = [m.transform(model.prepare(odd)).select("user_id", *[f"_v_{c}" for c in schemas.CATEGORICAL_FEATURES]) for m in (stored, in_memory)]
    assert same[0].exceptAll(same[1]).count() == 0
    model.save(stored, f"{tmp_path}/stored")
    again = model.predict(model.load(f"{tmp_path}/stored"), odd).select("user_id", *scoring.RESPONSE)
    assert again.exceptAll(model.predict(stored, odd).select("user_id", *scoring.RESPONSE)).count() == 0


def test_requests_are_read_as_training_reads(spark, fitted):
    bodies = ['{"edad": "abc"}', '{"edad": [1]}', '{"profesion": {"a": 1}}', '{"edad": null, "estado_laboral": " desempleado"}']
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "id int, body string")
    got = {r.id: r for r in scoring.score_requests(fitted, df).collect()}
    assert [got[i].status for i in range(4)] == [400, 400, 400, 200]
    assert got[0].error == "unreadable inputs: edad"
    made = {r.id: r for r in scoring.request_features(df).collect()}
    assert made[3].estado_laboral == "EMPLEADO"  # as training in reference mode has it
    fixed = {r.id: r for r in scoring.request_features(df, rules_mode="corrected").collect()}
    assert fixed[3].estado_laboral == "DESEMPLEADO"


def test_unusable_model_answers_500(spark, tmp_path):
    df = spark.createDataFrame([("{}",), ("bad",)], "body string")
    got = {r.body: r for r in scoring.score_requests(f"{tmp_path}/none", df).collect()}
    assert (got["{}"].status, got["bad"].status) == (500, 400)
    assert "could not be loaded" in json.loads(got["{}"].response)["error"]


def test_requests(spark, fitted):
    bodies = ['{"edad": 30}', "[1]", "bad", None, '{"edad": "41", "profesion": " Médica "}', "5", "null"]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "id int, body string")
    got = {r.id: r for r in scoring.score_requests(fitted, df).collect()}
    assert [got[i].status for i in range(7)] == [200, 400, 400, 400, 200, 400, 400]
    answer = json.loads(got[0].response)
    assert set(answer) == set(scoring.RESPONSE) and got[1].prediccion_numerica is None
    assert "error" in json.loads(got[1].response)
    strict = {r.id: r.status for r in scoring.score_requests(fitted, df, on_missing="reject").collect()}
    assert set(strict.values()) == {400}
    made = {r.id: r for r in scoring.request_features(df).collect()}
    assert (made[0].rango_edad, made[0].categoria_ingresos, made[0].profesion) == ("26-35", "MUY BAJOS", "DESCONOCIDO")
    assert (made[4].edad, made[4].profesion) == (41.0, "MEDICA")


def test_event_body(spark):
    calls = ['{"body": "{\\"edad\\": 1}"}', '{"body": {"edad": 2}}', '{"edad": 3}', "oops"]
    df = spark.createDataFrame([(c,) for c in calls], "e string").select(scoring.event_body(F.col("e")).alias("b"))
    assert [r.b for r in df.collect()] == ['{"edad": 1}', '{"edad":2}', '{"edad": 3}', "oops"]


def test_prompt_names_the_bank(fitted, table):
    text = scoring.with_prompt(model.predict(fitted, table.limit(1)), bank="Banco 100% Ñ").first().prompt
    assert "Banco 100% Ñ" in text and "- Edad: " in text and "RIESGO" in text


def test_scoring_stream_equals_batch(spark, fitted, tmp_path):
    lines = spark.range(200).selectExpr(
        "if(id % 9 = 0, 'bad', concat('{\"edad\": ', id % 80, ', \"ingreso_mensual_estimado\": ', id * 10000, '}')) as value")
    lines.repartition(3).write.text(f"{tmp_path}/in")
    for _ in range(2):  # the second run finds nothing new
        stream.score_stream(fitted, stream.read_requests(spark, f"{tmp_path}/in", 1), f"{tmp_path}/out",
                            f"{tmp_path}/check").awaitTermination()
    streamed = spark.read.parquet(f"{tmp_path}/out").select("body", "status", "response")
    batch = scoring.score_requests(fitted, lines.select(F.col("value").alias("body"))).select("body", "status", "response")
    assert streamed.count() == 200 and streamed.exceptAll(batch).count() == 0


def test_ingest_stream_equals_batch(spark, sf, tmp_path):
    raw = sample_bank.cuentas(spark, sf)
    tables.write_bronze(raw.repartition(3), f"{tmp_path}/in")
    batch = entities.refine(raw, "cuentas", sample_bank.AS_OF)
    for _ in range(2):  # the second run finds nothing new
        ingest.ingest(spark, "cuentas", f"{tmp_path}/in", f"{tmp_path}/silver", f"{tmp_path}/gold",
                      f"{tmp_path}/check", sample_bank.AS_OF, files_per_batch=1, audit_path=f"{tmp_path}/audit").awaitTermination()
        got = spark.read.parquet(f"{tmp_path}/gold")
        assert got.count() == raw.count()
        assert got.select(*schemas.GOLD_COLUMNS["cuentas"]).exceptAll(batch).count() == 0
    assert got.select("archivo").distinct().count() == 3
    audit = spark.read.parquet(f"{tmp_path}/audit").collect()
    assert len(audit) == 3 and sum(r.processed_rows for r in audit) == raw.count()


def test_ingest_stream_loses_no_file(spark, sf, tmp_path):
    """Two folders with the same file name, and a file that is ten days old when it arrives third."""
    head = tables.write_bronze(sample_bank.cuentas(spark, sf).limit(3).coalesce(1), f"{tmp_path}/raw")
    assert head is None
    part = next((tmp_path / "raw").glob("part-*")).read_text()
    for n, day in enumerate(("day1", "day2", "day3")):
        folder = tmp_path / "in" / day
        folder.mkdir(parents=True)
        (folder / "cuentas.csv").write_text(part)
        if n == 2:
            old = time.time() - 10 * 86400
            os.utime(folder / "cuentas.csv", (old, old))
        ingest.ingest(spark, "cuentas", f"{tmp_path}/in/*", f"{tmp_path}/silver", f"{tmp_path}/gold",
                      f"{tmp_path}/check", sample_bank.AS_OF).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/gold")
    assert got.count() == 9 and got.select("archivo").distinct().count() == 3


def _arrive(folder, name, keys, day="2020-01-05"):
    folder.mkdir(exist_ok=True)
    lines = [",".join(schemas.BRONZE_COLUMNS["prestamos"]), *(f"{k},u,100,20,12,{day},9,Activo,Viaje" for k in keys)]
    (folder / name).write_text("\n".join(lines) + "\n")


def test_replaced_files_replace_their_rows(spark, tmp_path):
    landing, out = tmp_path / "in dir", {n: f"{tmp_path}/{n}" for n in ("silver", "gold", "checkpoint", "audit_path")}

    def run():
        ingest.ingest(spark, "prestamos", str(landing), out["silver"], out["gold"], out["checkpoint"], sample_bank.AS_OF,
                      files_per_batch=1, audit_path=out["audit_path"]).awaitTermination()
        for zone in ("silver", "gold"):
            got = spark.read.parquet(out[zone])
            yield sorted(r.loan_id for r in got.collect())
        yield {r.archivo.rpartition("/")[2]: r.processed_rows for r in spark.read.parquet(out["audit_path"]).collect()}

    for n in range(4):
        _arrive(landing, f"f {n}.csv", [f"{n}a", f"{n}b"])
    _arrive(landing, "empty.csv", [])
    first = ["0a", "0b", "1a", "1b", "2a", "2b", "3a", "3b"]
    assert list(run())[:2] == [first, first]
    assert list(run())[:2] == [first, first]  # nothing new
    _arrive(landing, "f 1.csv", ["1c", "1d", "1e"], "2021-01-01")  # other rows
    _arrive(landing, "f 2.csv", [])  # no rows any more
    _arrive(landing, "empty.csv", ["e1"])  # rows for the first time
    _arrive(landing, "f 9.csv", ["9a"])  # new as well
    second = ["0a", "0b", "1c", "1d", "1e", "3a", "3b", "9a", "e1"]
    assert list(run()) == [second, second, {"f%200.csv": 2, "f%201.csv": 3, "f%203.csv": 2, "f%209.csv": 1, "empty.csv": 1}]
    _arrive(landing, "f 2.csv", ["2z"])
    third = sorted([*second, "2z"])
    assert list(run())[:2] == [third, third]

    tables_now = ingest.Tables(spark, "prestamos", out["silver"], out["gold"], out["audit_path"], None, sample_bank.AS_OF, entities.Options())
    before = len(list((tmp_path / "gold").glob("lote=*")))
    assert ingest.merge_batches(tables_now, 6) == before - 2 and len(list((tmp_path / "gold").rglob("part-*.parquet"))) == 2
    assert list(run())[:2] == [third, third]
    _arrive(landing, "f 3.csv", ["3y"])
    fourth = sorted({*third, "3y"} - {"3a", "3b"})
    assert list(run())[:2] == [fourth, fourth]
    assert ingest.merge_batches(tables_now) == 1 and list(run())[:2] == [fourth, fourth]


def test_a_merge_that_was_cut_off_counts_no_row_twice(spark, tmp_path, monkeypatch):
    landing, silver, gold = tmp_path / "in", f"{tmp_path}/silver", f"{tmp_path}/gold"
    for n in range(3):
        _arrive(landing, f"f{n}.csv", [f"{n}a"])
    ingest.ingest(spark, "prestamos", str(landing), silver, gold, f"{tmp_path}/c", sample_bank.AS_OF, files_per_batch=1).awaitTermination()
    out = ingest.Tables(spark, "prestamos", silver, gold, None, None, sample_bank.AS_OF, entities.Options())
    with monkeypatch.context() as m:
        m.setattr(ingest, "read_manifest", lambda *a, seen=[], real=ingest.read_manifest: seen.append(1) or (1 / 0 if len(seen) > 3 else real(*a)))
        with pytest.raises(ZeroDivisionError):
            ingest.merge_batches(out)
    assert spark.read.parquet(silver).count() > 3  # the moment between
    assert ingest.merge_batches(out) == 2
    assert sorted(r.loan_id for r in spark.read.parquet(silver).collect()) == ["0a", "1a", "2a"] == sorted(r.loan_id for r in spark.read.parquet(gold).collect())


def test_versions(spark, fitted, tmp_path):
    root = f"{tmp_path}/models"
    with pytest.raises(model.ModelNotLoaded):
        registry.current(spark, root)
    assert registry.publish(fitted, root) == "v000001" == registry.current(spark, root)
    assert registry.publish(fitted, root, registry.About(rules_mode="corrected")) == "v000002" == registry.current(spark, root)
    assert registry.load(spark, root, "v000002")[1].rules_mode == "corrected"
    registry.point_to(spark, root, "v000001")
    assert registry.current(spark, root) == "v000001" and registry.versions(spark, root) == ["v000001", "v000002"]
    fitted.write().save(f"{root}/versions/v000003/model")  # a publisher that died
    assert registry.versions(spark, root) == ["v000001", "v000002"]
    with pytest.raises(model.ModelNotLoaded):
        registry.point_to(spark, root, "v000003")
    assert registry.publish(fitted, root) == "v000004"


def test_a_version_saved_during_a_stream_is_taken_up(spark, fitted, tmp_path, monkeypatch):
    root, landing = f"{tmp_path}/models", tmp_path / "in"
    landing.mkdir()
    for n in range(3):
        (landing / f"{n}.txt").write_text('{"edad": 30, "estado_laboral": "Desempleado"}\nbad\n')
    seen, real = [], registry.current

    def current(spark, root):
        if len(seen) == 1:  # between the first and the second batch
            registry.publish(fitted, root, registry.About(rules_mode="corrected"))
        seen.append(1)
        return real(spark, root)

    def run(name):
        requests = stream.read_requests(spark, str(landing), 1)
        stream.score_versions(root, requests, f"{tmp_path}/{name}", f"{tmp_path}/c-{name}").awaitTermination()
        return spark.read.parquet(f"{tmp_path}/{name}")

    assert {(r.status, r.version) for r in run("none").collect()} == {(500, None), (400, None)}
    registry.publish(fitted, root)
    used, real_score = [], scoring.score_requests
    monkeypatch.setattr(scoring, "score_requests", lambda *a, **k: used.append(k["rules_mode"]) or real_score(*a, **k))
    monkeypatch.setattr(registry, "current", current)
    got = run("out").where("status = 200").collect()
    assert sorted(r.version for r in got) == ["v000001", "v000002", "v000002"]
    assert used == ["reference", "corrected", "corrected"]


def test_a_query_builds_the_zones_it_returns(spark, sf, monkeypatch):
    monkeypatch.setattr(sample_queries, "_shared", {})
    assert sample_queries.QUERIES["s3_silver_destinatarios"](spark, sf).count() > 0
    z, _ = sample_queries._zone_paths(spark, sf)
    assert folders.children(spark, z.silver) == ["destinatarios"] == folders.children(spark, z.bronze)
