import pytest
from pyspark.sql import functions as F

from textgrain.operators import features as ft
from textgrain.sources import labelled, sinks, word_vectors


def test_labelled_round_trip_with_line_breaks_and_quotes(spark, tmp_path):
    rows = [('one "quoted"\nline, two', "1"), ("plain", "0"), ("x" * 200_000, "1")]
    sinks.write_table(spark.createDataFrame(rows, "text string, label string"), str(tmp_path / "c"), "csv")
    back = labelled.read_labelled(spark, str(tmp_path / "c"))
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_positional_and_trimmed(spark, tmp_path):
    (tmp_path / "a.csv").write_text('first text,0\n"second, text",1\n')
    rows = labelled.read_positional(spark, str(tmp_path / "a.csv")).collect()
    assert [(r["text"], r["label"]) for r in rows] == [("first text", "0"), ("second, text", "1")]
    (tmp_path / "b.csv").write_text("text ,label,other\nhello,1,x\n,0,y\n")
    rows = labelled.read_trimmed(spark, str(tmp_path / "b.csv")).collect()
    assert [(r["text"], r["label"]) for r in rows] == [("hello", 1)]


def test_missing_columns_are_listed(spark):
    df = spark.createDataFrame([(1,)], "other int")
    with pytest.raises(ValueError, match=r"\['label', 'text'\]"):
        labelled.require_columns(df, ["text", "label"])


def test_column_pruning_reaches_the_scan(spark, tmp_path):
    spark.range(3).select("id", F.lit("a").alias("word_1grams"), F.lit("b").alias("char_2grams"), F.lit(1).alias("label")).write.parquet(str(tmp_path / "p"))
    df = labelled.select_columns(spark.read.parquet(str(tmp_path / "p")), ["word_1grams"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<word_1grams:string,label:int>" in plan


def test_word_vectors_order_dimensions_by_number(spark, tmp_path):
    df = spark.createDataFrame([("mare", 10.0, 2.0, 1.0)], "Term string, dim10 double, dim2 double, dim0 double")
    assert word_vectors.word_vectors(df).first()["vec"] == [1.0, 2.0, 10.0]
    path = str(tmp_path / "v")
    word_vectors.converted_word_vectors(spark, df, path)
    kept = word_vectors.converted_word_vectors(spark, df.limit(0), path)
    assert kept.count() == 1
    with pytest.raises(ValueError):
        word_vectors.word_vectors(spark.range(1))


def test_conversion_notices_changed_files(spark, tmp_path):
    files, path = tmp_path / "source", str(tmp_path / "kept")
    files.mkdir()

    def write(name, *rows):
        (files / name).write_text("word,dim0,dim1\n" + "".join(f"{w},{a},{b}\n" for w, a, b in rows))

    def converted():
        source = spark.read.option("header", True).csv(str(files))
        table = word_vectors.converted_word_vectors(spark, source, path)
        return {r["token"]: list(r["vec"]) for r in table.collect()}, len(list((tmp_path / "kept" / "tables").iterdir()))

    write("a.csv", ("mare", 1, 2))
    assert converted() == ({"mare": [1, 2]}, 1)
    assert converted() == ({"mare": [1, 2]}, 1)
    write("b.csv", ("sole", 3, 4))
    assert converted() == ({"mare": [1, 2], "sole": [3, 4]}, 2)
    write("a.csv", ("mare", 1, 25))
    assert converted() == ({"mare": [1, 25], "sole": [3, 4]}, 3)
    (files / "b.csv").unlink()
    assert converted() == ({"mare": [1, 25]}, 4)
    assert converted() == ({"mare": [1, 25]}, 4)


def test_interrupted_conversion_is_never_read(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("word,dim0\nmare,1\n")
    source, path = spark.read.option("header", True).csv(str(tmp_path / "a.csv")), str(tmp_path / "kept")
    whole = word_vectors.word_vectors
    # The rows are written, but the process ends before the manifest is: nothing names the folder.
    monkeypatch.setattr(word_vectors, "word_vectors", lambda table: whole(table).filter("false"))
    monkeypatch.setattr(word_vectors, "MANIFEST", "fingerprint int, folder string")
    with pytest.raises(Exception):
        word_vectors.converted_word_vectors(spark, source, path)
    monkeypatch.undo()
    assert [r["token"] for r in word_vectors.converted_word_vectors(spark, source, path).collect()] == ["mare"]


def test_profile_tables(spark):
    a = spark.createDataFrame([("t_1", "1.5", "x")], "ilename string, f1 string, f2 string")
    b = spark.createDataFrame([("t_1", 2.0, 1)], "filename string, f1 double, label int")
    assert ft.common_features(ft.repair_key(a), b) == ["f1"]
    mapped = ft.remap_labels(a, spark.createDataFrame([("t_1", 1)], "filename string, label int"))
    assert mapped.first()["label"] == 1
    twice = ft.remap_labels(mapped, spark.createDataFrame([("t_1", 0)], "filename string, label int"))
    assert twice.columns.count("label") == 1 and twice.first()["label"] == 0
    numbers = spark.createDataFrame([("1.5",), ("abc",), (None,), ("NaN",)], "v string")
    assert [r["v"] for r in ft.coerce_numeric(numbers, ["v"]).collect()] == [1.5, 0.0, 0.0, 0.0]


def test_exports(spark, tmp_path):
    docs = spark.createDataFrame([(7, "Uno. Due!", 1, "train")], "doc_id long, text string, label int, split string")
    row = sinks.document_export(docs).first()
    assert (row["filename"], row["text"]) == ("train_00007", "Uno.\nDue!")
    sinks.write_documents(docs, str(tmp_path / "d"))
    assert spark.read.parquet(str(tmp_path / "d")).first()["split"] == "train"
    assert sinks.label_mapping(docs).first()["label"] == 1
    wide = sinks.wide_matrix(docs.withColumn("vec", F.array(F.lit(1.0), F.lit(2.0))), 2, "f")
    assert wide.columns == ["f_0", "f_1", "label"]
    assert sinks.with_legend(wide.withColumn("C", F.lit(1.0))).schema["C"].metadata["comment"]
    sinks.write_result(wide, str(tmp_path / "r"))
    assert len(list((tmp_path / "r").glob("*.csv"))) == 1
    names, matrix = labelled.features_and_label(wide)
    assert names == ["f_0", "f_1"] and matrix.first()["vec"] == [1.0, 2.0]
    model, _ = ft.label_codes(docs)
    sinks.save_model(model, str(tmp_path / "m"))
