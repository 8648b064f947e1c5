import json

import pytest
from pyspark.sql import functions as F

from brandlens import contract
from brandlens.operators import prepare, schema
from brandlens.sources import csv_files, staging

FEATURE_ROW = {
    "name": "Test Brand", "country_origin": "Россия", "description": "Сеть основана в 2012 году, 15 магазинов",
    "presence_world": "120", "presence_russia": "12 и 4 франчайзинговых", "presence_regions": "Москва;Казань;Уфа", "plans": "6",
}


def test_contract():
    assert contract.FEATURE_CONTRACT_VERSION == "inference_safe_v1"
    assert not set(contract.SAFE_FEATURES) & set(contract.FORBIDDEN_FEATURES)
    contract.check_feature_contract(contract.SAFE_FEATURES)
    with pytest.raises(ValueError, match="Feature contract violation"):
        contract.check_feature_contract([*contract.SAFE_FEATURES, "domain"])
    with pytest.raises(ValueError, match="Missing inference-safe"):
        contract.check_feature_contract([c for c in contract.SAFE_FEATURES if c != "description"])


def test_label_columns():
    assert contract.label_column("люкс / премиум") == "люкс_премиум"
    assert contract.label_column("ниже среднего") == "ниже_среднего"


def test_serving_row(spark):
    df = spark.createDataFrame([FEATURE_ROW])
    row = prepare.prepare_features(df).first()
    assert row.name_clean == "test brand"
    assert (row.presence_own, row.presence_franchise, row.n_regions) == (12.0, 4.0, 3)
    assert (row.desc_has_digits, row.desc_year_mentions, row.presence_world, row.plans) == (1, 1, 120.0, 6.0)
    ready = schema.model_input(prepare.prepare_features(df))
    assert ready.columns == contract.SAFE_FEATURES


def test_harmonize(spark):
    assert schema.harmonize(spark.createDataFrame([("a", "b")], "name string, contry_origin string")).columns == [
        "name", "country_origin"]
    both = spark.createDataFrame([("a", "b")], "country_origin string, contry_origin string")
    assert schema.harmonize(both).columns == ["country_origin"]


def test_absent_columns_are_filled(spark):
    row = schema.model_input(spark.createDataFrame([("x",)], "name string")).first()
    assert (row.description, row.name_clean, row.country_origin, row.plans) == ("", "", "Неизвестно", None)


def test_required_columns(spark):
    with pytest.raises(ValueError, match=r"\['plans', 'founded'\]"):
        schema.require_columns(spark.createDataFrame([("x",)], "name string"), ["name", "plans", "founded"])


def test_only_files_with_quoted_newlines_are_read_whole(spark, tmp_path):
    bodies = {"plain": "x,1\n" * 5000, "quoted 1": '"a, ""b""",2\n"",3\n""",""",4\n', "open": '"a\nb",5\n"c\n\n""\nd",6\n',
              "stray": '5",\'7\n6" x,8\n', "long": '"' + 'y""' * 60_000 + '",9\n'}
    folder = tmp_path / "in 1"
    folder.mkdir()
    for name, body in bodies.items():
        (folder / f"{name}.csv").write_text("k,v\n" + body)
    path = str(folder)
    assert [f.rsplit("/", 1)[1] for f in csv_files.files_with_quoted_newlines(spark, path)] == ["open.csv", "stray.csv"]
    default, whole = csv_files.read_brand_csv(spark, path), csv_files.read_brand_csv(spark, path, multi_line=True)
    assert sorted(map(tuple, default.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    assert {("a\nb", "5"), ('c\n\n"\nd', "6"), ('a, "b"', "2")} <= {tuple(r) for r in default.collect()}
    # A large file without quoted newlines is split.
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        only = str(folder / "plain.csv")
        assert csv_files.read_brand_csv(spark, only).rdd.getNumPartitions() >= 4
        assert csv_files.read_brand_csv(spark, only).count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_csv(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes('﻿name,plans,description\r\n"A, ""b""",NA,"line\nbreak"\r\nNone,5,\r\n'.encode())
    rows = csv_files.read_brand_csv(spark, str(path)).collect()
    assert [r.asDict() for r in rows] == [
        {"name": 'A, "b"', "plans": None, "description": "line\nbreak"}, {"name": None, "plans": "5", "description": None}]
    (tmp_path / "b.csv").write_text("name,name\n1,2\n")
    with pytest.raises(ValueError, match="unique"):
        csv_files.read_brand_csv(spark, str(tmp_path / "b.csv"))
    (tmp_path / "c.csv").write_text("name,plans\n")
    with pytest.raises(ValueError, match="no rows"):
        csv_files.require_rows(csv_files.read_brand_csv(spark, str(tmp_path / "c.csv")))


def test_json_object(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"status": "PASSED", "n": 1}))
    assert csv_files.read_json_object(spark, str(tmp_path / "a.json")).first().status == "PASSED"
    (tmp_path / "b.json").write_text("[{\"a\": 1}, {\"a\": 2}]")
    with pytest.raises(ValueError):
        csv_files.read_json_object(spark, str(tmp_path / "b.json"))


def test_staged_frames_live_in_the_named_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert staging.shared_folder(spark) == folder
    df = staging.staged(spark.range(10).withColumn("x", F.lit("a")))
    assert df.count() == 10 and all(folder in f for f in df.inputFiles())


def test_price_rows_refuse_unexpected_labels(spark):
    df = spark.createDataFrame([("средний;чужой",), ("дисконт",)], "price_category string")
    with pytest.raises(ValueError, match="1, listed in") as error:
        prepare.refuse_unexpected_labels(df)
    assert [r.label for r in spark.read.parquet(str(error.value).split("listed in ")[1]).collect()] == ["чужой"]
    prepare.refuse_unexpected_labels(df.filter("price_category = 'дисконт'"))
