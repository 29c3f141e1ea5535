import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ingot.operators.landing import write_dated_parquet
from ingot.operators.ordering import with_global_row_number
from ingot.sources.files import dated_paths, read_csv, read_date_range
from ingot.sources.documents import expand_documents, raw_documents


def test_global_row_number_matches_window(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5003).alias("k"))
    ours = {r["k"]: r["row_number"] for r in with_global_row_number(df, "k", num_partitions=5).collect()}
    ref = {r["k"]: r["rn"] for r in df.withColumn("rn", F.row_number().over(Window.orderBy("k"))).collect()}
    assert ours == ref


def test_date_range_skips_absent_days(spark, ws):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    write_dated_parquet(df, ws, "t", dt.date(2026, 8, 1))
    write_dated_parquet(df.withColumn("extra", F.lit(2)), ws, "t", dt.date(2026, 8, 3))
    assert len(dated_paths(spark, ws, "t", dt.date(2026, 8, 1), dt.date(2026, 8, 3))) == 2
    out = read_date_range(spark, ws, "t", dt.date(2026, 8, 1), dt.date(2026, 8, 3))
    assert out.count() == 2 and "extra" in out.columns
    assert read_date_range(spark, ws, "t", dt.date(2026, 9, 1), dt.date(2026, 9, 2)) is None


def test_csv_reader_options(spark, ws):
    with open(f"{ws}/a.csv", "w") as fh:
        fh.write("x;y\n1;b\n")
    path = f"{ws}/a.csv"
    assert dict(read_csv(spark, path, sep=";").dtypes) == {"x": "int", "y": "string"}
    assert dict(read_csv(spark, path, sep=";", inferSchema=False).dtypes)["x"] == "string"
    assert read_csv(spark, path, "x long, y string", sep=";").first() == (1, "b")


def test_raw_documents_and_expand_drop_duplicate_id(spark):
    src = spark.createDataFrame([(1, "a", None)], "_id long, name string, note string")
    raw = raw_documents(src, "_id")
    r = raw.first()
    assert r["_id"] == "1" and '"note":null' in r["body"]
    exp = expand_documents(raw)
    assert exp.columns.count("_id") == 1 and exp.first()["name"] == "a"
    missing = raw_documents(spark.createDataFrame([("x",)], "name string"), "_id").first()
    assert missing["_id"] == ""


def test_catalog_listing_sorted(spark):
    from ingot.sources.tables import list_catalog_tables
    spark.range(1).createOrReplaceTempView("zz_inv")
    spark.range(1).createOrReplaceTempView("aa_inv")
    names = [r[0] for r in list_catalog_tables(spark).collect() if r[0].endswith("_inv")]
    assert names == ["aa_inv", "zz_inv"]


def test_sample_export_one_file_per_document(spark, ws):
    from ingot.operators.landing import export_sample, landed_file_facts
    export_sample(spark.range(0, 50).orderBy("id"), ws, 5, one_file_per_doc=True)
    facts = landed_file_facts(spark, ws, "*.json")
    assert facts.count() == 5
    assert sorted(r[0] for r in spark.read.json(ws).collect()) == [0, 1, 2, 3, 4]


def test_extract_result_reports_pages_and_files(spark, ws):
    from ingot.operators.landing import write_landing_pages
    df = spark.range(0, 25).withColumnRenamed("id", "_id")
    r = write_landing_pages(df, f"{ws}/land", "_id", batch_size=10)
    facts = r.files(spark).collect()
    assert r.docs == 25 and r.pages == len(facts) >= 3
    assert all(f.file_size_bytes > 0 for f in facts) and r.started_at <= r.finished_at


def test_table_discovery_and_file_facts(spark, ws):
    from ingot.sources.files import list_tables, table_files
    for name, n in (("beta", 3), ("alpha", 2)):
        spark.range(n).write.parquet(f"{ws}/inv/{name}")
    assert list_tables(spark, f"{ws}/inv") == ["alpha", "beta"]
    facts = {r.table_name for r in table_files(spark, f"{ws}/inv").collect()}
    assert facts == {"alpha", "beta"}


def test_payload_files_multiline_and_arrays(spark, ws):
    import os
    from ingot.sources.files import read_payloads
    os.makedirs(f"{ws}/p".replace("file:", ""), exist_ok=True)
    with open(f"{ws}/p/one.json".replace("file:", ""), "w") as fh:
        fh.write('{\n  "cep": "0",\n  "uf": "AA"\n}')
    with open(f"{ws}/p/many.json".replace("file:", ""), "w") as fh:
        fh.write('[{"cep": "1", "uf": "SP"},\n {"cep": "2", "uf": "RJ"}]')
    rows = sorted(tuple(r) for r in read_payloads(spark, f"{ws}/p", "cep string, uf string").collect())
    assert rows == [("0", "AA"), ("1", "SP"), ("2", "RJ")]
