"""Sources/sinks in a fresh folder, and whole-pipeline properties."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tidyrent.operators import dedupe as D
from tidyrent.operators import stats as S
from tidyrent.plans import pipeline as P
from tidyrent.plans.catalog import raw, typed_stage
from tidyrent.sources import files as SRC


@pytest.fixture()
def folder(spark):
    d = SRC.scratch_dir(spark, "test-json")
    os.makedirs(os.path.join(d, "sub"), exist_ok=True)
    recs = [{"descripcion": "a", "precio_soles": "S/ 100", "extra": 1},
            {"descripcion": "b\n\"q\"", "precio_soles": None, "extra": 2}]
    with open(os.path.join(d, "a_array.json"), "w", encoding="utf-8") as f:
        json.dump(recs, f, ensure_ascii=False, indent=4)
    with open(os.path.join(d, "b_object.json"), "w", encoding="utf-8") as f:
        json.dump({"descripcion": "c", "precio_soles": "US$1200"}, f, ensure_ascii=False)
    with open(os.path.join(d, "sub", "c_notes.txt"), "w") as f:
        f.write("not json")
    with open(os.path.join(d, "d_bad.json"), "w") as f:
        f.write("42")
    return d


def test_json_folder_shapes_and_key_intersection(spark, folder):
    recs = SRC.read_json_records(spark, folder)
    assert recs.count() == 3  # array extends, object appends, scalar file skipped, .txt ignored
    out = SRC.read_listing_folder(spark, folder)
    # "extra" is missing in one record → dropped; null-valued precio_soles kept
    assert sorted(c for c in out.columns if c != "row_id") == ["descripcion", "precio_soles"]
    vals = sorted((r.descripcion, r.precio_soles) for r in out.collect())
    assert vals == [("a", "S/ 100"), ("b\n\"q\"", None), ("c", "US$1200")]
    assert out.select("row_id").distinct().count() == 3


def test_skipped_documents_counted(spark, folder):
    assert SRC.skipped_documents(spark, folder) == 1  # the file holding a bare number


def test_first_n_files(spark, folder):
    listed = SRC.list_files(spark, folder).count()
    assert listed == 4
    assert SRC.first_files(spark, folder, 0) == []
    assert len(SRC.first_files(spark, folder, 1)) == 1
    assert len(SRC.first_files(spark, folder, 100)) == 3  # the .txt uses a slot only when inside the cut
    with pytest.raises(ValueError):
        SRC.first_files(spark, folder, -1)


def test_empty_paths_rejected(spark):
    with pytest.raises(ValueError):
        SRC.list_files(spark, "")
    with pytest.raises(ValueError):
        SRC.write_csv(spark.range(1), " ")


def test_csv_roundtrip_with_newlines(spark):
    df = spark.createDataFrame([(1, 'a "quoted"\nline', 2.5), (2, None, None)], "id long, t string, x double")
    out = SRC.write_csv(df, SRC.scratch_dir(spark, "test-csv"))
    back = SRC.read_csv(spark, out, schema="id long, t string, x double")
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0]) == [(1, 'a "quoted"\nline', 2.5), (2, None, None)]


def test_keep_first_is_idempotent(spark, small_dir):
    t = typed_stage(spark, small_dir)
    keys = ["latitud", "longitud", "area", "dormitorios", "banos", "precio", "distrito", "antiguedad"]
    once = D.keep_first(t, keys)
    twice = D.keep_first(once, keys)
    assert once.count() == twice.count()
    assert once.exceptAll(twice).count() == 0


def test_fence_never_adds_rows(spark, small_dir):
    t = S.with_price_m2(typed_stage(spark, small_dir))
    assert S.iqr_fence(t).count() <= t.count()
    assert S.low_price_fix(t).count() <= t.count()


@pytest.fixture(scope="module")
def run_small(spark, small_dir):
    return P.run(raw(spark, small_dir))


def test_pipeline_schema_and_quality(run_small):
    cleaned = run_small["cleaned"]
    for c in ("row_id", "precio", "area", "precioxm2", "antiguedad", "antiguedad_categoria", "dorm_ban",
              "direccion", "precision", "type"):
        assert c in cleaned.columns
    assert "descripcion" not in cleaned.columns
    n = cleaned.count()
    assert 0 < n < run_small["formatted"].count()
    assert cleaned.where(F.col("precio").isNull() | F.col("distrito").isNull()).count() == 0
    assert cleaned.where("precioxm2 > 120 OR precioxm2 < 8 OR dormitorios > 6 OR precio < 600").count() == 0
    q = {r.check: r for r in run_small["quality"].collect()}
    assert {"sale_rent_ratio", "critical_null_share", "price_ratio"} <= set(q)


def test_pipeline_is_deterministic(spark, small_dir, run_small):
    again = P.run(raw(spark, small_dir))["cleaned"].drop("area")
    first = run_small["cleaned"].drop("area")  # forest predictions aside, the rows are the same
    assert first.select("row_id").exceptAll(again.select("row_id")).count() == 0
    assert again.count() == first.count()


def test_upper_case_extension_and_malformed_line(spark, tmp_path):
    from tidyrent.sources import files
    (tmp_path / "X.JSON").write_text('[{"a": 1}, {"a": 2}]')
    assert files.read_by_extension(spark, str(tmp_path / "X.JSON")).count() == 2
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "a.json").write_text('{"a": 1, "b": 2}\n{"a": 3, "b"\n{"a": 4, "b": 5}\n')
    recs = files.read_json_records(spark, str(tmp_path / "l"), shape="lines")
    assert recs.count() == 2 and sorted(files.common_keys(recs)) == ["a", "b"]


def test_rows_without_area_are_rejected(spark):
    from tidyrent.plans.rules import REJECT_RULES
    df = spark.createDataFrame([(1, 2, 1, 0.0, 900.0, 10.0), (2, 2, 1, 50.0, 900.0, 18.0), (3, 2, 1, None, 900.0, None)],
                               "row_id int, dormitorios int, banos int, area double, precio double, precioxm2 double")
    for rule in REJECT_RULES:
        df = df.where(f"NOT coalesce({rule}, false)")
    assert sorted(r.row_id for r in df.collect()) == [2, 3]
