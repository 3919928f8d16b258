"""Line numbers, table swaps, dead letters, literal replies, null join keys."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidyrent.functions import text as T
from tidyrent.operators import enrich as E
from tidyrent.operators.joins import left_join_known
from tidyrent.operators.quality import QualityReport
from tidyrent.sources import files as S


@pytest.fixture()
def split_bytes(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    yield lambda n: spark.conf.set(key, n)
    spark.conf.set(key, before)


def test_line_ids_do_not_move_with_splits(spark, tmp_path, split_bytes):
    for name, n in (("a", 400), ("b", 3)):
        body = "".join(f'{{"n": {i}, "t": "{"x" * (i % 37)}"}}\n' + ("\n" if i % 5 == 0 else "") for i in range(n))
        (tmp_path / f"{name}.JSON").write_text(body + "{broken\n")

    def ids():
        recs = S.read_json_records(spark, str(tmp_path), shape="lines")
        return {(r.row_id, r.source_file.rsplit("/", 1)[-1], r.rec["n"]) for r in recs.collect()}

    split_bytes("128m")
    whole = ids()
    lines = {(r.source_file.rsplit("/", 1)[-1], r.line, r.value)
             for r in S.numbered_lines(spark, str(tmp_path)).collect()}
    want = {(f, i, line) for f in ("a.JSON", "b.JSON")
            for i, line in enumerate((tmp_path / f).read_text().split("\n")[:-1])}
    assert lines == want and len(whole) == 403
    split_bytes("700b")
    assert S.file_lines(spark, str(tmp_path)).select("block").distinct().count() > 10
    assert ids() == whole
    assert S.malformed_lines(spark, str(tmp_path)) == 2


def test_no_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text("")
    assert S.numbered_lines(spark, str(tmp_path)).count() == 0
    assert S.malformed_lines(spark, str(tmp_path)) == 0


def test_junk_in_an_upper_case_file_is_counted(spark, tmp_path):
    (tmp_path / "A.json").write_text('[{"a": 1}]')
    (tmp_path / "B.JSON").write_text("junk")
    assert S.skipped_documents(spark, str(tmp_path)) == 1


def test_failed_replacement_leaves_the_table(spark, tmp_path):
    at, name = str(tmp_path / "t"), "swapped_table"
    spark.sql(f"DROP TABLE IF EXISTS {name}")

    def rows():
        return sorted(r.a for r in spark.table(name).collect())

    S.replace_table(spark.range(3).select(F.col("id").alias("a")), name, at)
    assert rows() == [0, 1, 2]
    failing = spark.range(5).select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("no"))).cast("bigint").alias("a"))
    with pytest.raises(Exception, match="no"):
        S.replace_table(failing, name, at)
    assert rows() == [0, 1, 2]
    with pytest.raises(S.AuditFailed, match="small"):
        S.replace_table(spark.range(9).select(F.col("id").alias("a")), name, at, {"small": F.col("a") < 8})
    with pytest.raises(S.AuditFailed):
        S.replace_table(spark.range(0).select(F.col("id").alias("a")), name, at, min_rows=1)
    assert rows() == [0, 1, 2]
    S.replace_table(spark.range(7, 9).select(F.col("id").alias("a")), name, at, {"small": F.col("a") < 10})
    assert rows() == [7, 8]
    # read and replaced by its own rows, with other columns
    own = spark.table(name).select("a", (F.col("a") * 2).alias("b"))
    S.replace_table(own, name, at)
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [(7, 14), (8, 16)]
    done = [p for p in (tmp_path / "t").iterdir() if (p / "_SUCCESS").exists()]
    assert len(done) == 2  # the table's and the one before
    spark.sql(f"DROP TABLE {name}")


def test_dead_letters_are_kept_and_resumed(spark, tmp_path):
    df = spark.range(0, 100, numPartitions=1).select(
        F.col("id").alias("row_id"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("ñ"), "id")).alias("txt"),
        F.array(F.col("id") / 7).alias("list"))

    def down(chunk):
        if chunk["row_id"].min() in (20, 60):
            raise RuntimeError("boom")
        return good(chunk)

    def good(chunk):
        return pd.DataFrame({"tag": "ok", "row_id": chunk["row_id"], "more": 1})

    report, letters = QualityReport(), str(tmp_path / "letters")
    first = E.ask(df, down, "row_id long, tag string", retries=1, base_wait=0.0, dead_letters=letters, report=report)
    assert (first.n_answers, first.n_failed) == (60, 40)
    assert first.failed.select("request.*").exceptAll(df.where("row_id between 20 and 39 or row_id between 60 and 79")).count() == 0
    assert {r.error.count("boom") for r in first.failed.collect()} == {2}  # both attempts
    assert [(c.check, c.value, c.passed) for c in report.checks] == [("provider_failed_requests_1", 40.0, False)]
    second = E.resume(spark, letters, good, "row_id long, tag string", report=report)
    assert second.n_failed == 0 and report.checks[-1].passed
    both = first.answers.unionByName(second.answers)
    assert sorted(r.row_id for r in both.collect()) == list(range(100))
    # nothing left: a third attempt has nothing to ask
    assert E.resume(spark, letters, down, "row_id long, tag string", attempt=3).n_answers == 0


def test_answer_without_its_columns_is_a_failure(spark):
    out = E.ask(spark.range(5), lambda c: c, "id long, tag string", retries=0)
    assert out.n_failed == 5 and out.answers.count() == 0


@pytest.mark.parametrize("reply, want", [
    ("[{'id': 1, 'nota': 'a'}]", [(1, "a", None)]),
    ("Claro: {'id': 1, 'nota': None} fin", [(1, None, None)]),
    ("[{'id': 1, 'nota': 'l'Hospitalet, d'en Pau'}]", [(1, "l'Hospitalet, d'en Pau", None)]),
    ("[{'id': 2, 'nota': \"it's\", 'ok': True},]", [(2, "it's", True)]),
    ("{'id': 3, 'nota': 'dice \"hola\", se va', 'ok': False}", [(3, 'dice "hola", se va', False)]),
    ("({'id': 4, 'nota': 'None, True'}, {'id': 5})", [(4, "null, True", None)]),
    ("[{'id': 6, 'nota': 'a [b] {c}', 'ok': True}]", [(6, "a [b] {c}", True)]),
    ("Lo siento", None), ("", None), (None, None), ("[{'id': 1", None), ("{]}", None)])
def test_replies(spark, reply, want):
    got = spark.createDataFrame([(reply,)], "r string").select(
        T.repair_reply(F.col("r"), "struct<id:bigint,nota:string,ok:boolean>").alias("x")).first().x
    assert (None if got is None else [tuple(r) for r in got]) == want


def test_long_text_of_a_reply(spark):
    text = "d'a, \\n" * 20000
    got = spark.createDataFrame([("[{'id': 1, 'nota': 'x" + text + "'}]",)], "r string").select(
        T.repair_reply(F.col("r"), "struct<id:bigint,nota:string>").alias("x")).first().x
    assert got[0].nota == "x" + text.replace("\\n", "\n")


def test_null_keys_stay_out_of_the_join(spark):
    left = spark.createDataFrame([(1, 1.0, 1.0), (2, None, 1.0), (3, None, None), (4, 2.0, 2.0)], "row_id int, a double, b double")
    right = spark.createDataFrame([(1.0, 1.0, "x"), (None, 1.0, "y")], "a double, b double, v string")
    out = left_join_known(left, right, ["a", "b"])
    assert sorted((r.row_id, r.v) for r in out.collect()) == [(1, "x"), (2, None), (3, None), (4, None)]
    assert set(out.columns) == {"row_id", "a", "b", "v"}
    plan = left_join_known(left, right.hint("merge"), ["a", "b"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "isnotnull(a" in plan.split("Join")[1]


def test_half_a_coordinate_pair_is_none(spark):
    df = spark.createDataFrame([("1.5", "x"), ("NaN", "2"), ("1", "2"), (None, "1")], "la string, lo string")
    la, lo = T.parse_coordinate_pair(F.col("la"), F.col("lo"))
    assert [tuple(r) for r in df.select(la, lo).collect()] == [(None, None), (None, None), (1.0, 2.0), (None, None)]
