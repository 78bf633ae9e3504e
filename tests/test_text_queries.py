import glob

from pyspark.sql import functions as F

from workloads import text_queries

SF = "/root/testdata/sf0.001"


def test_every_group_of_documents_has_a_task_of_its_own(spark):
    rows = text_queries._in_groups(spark, SF).groupBy(F.spark_partition_id()).agg(F.count_distinct("g").alias("groups"))
    assert [r.groups for r in rows.collect()] == [1] * text_queries.FILES


def test_splits_of_landed_files_grow_with_the_files(spark, monkeypatch):
    key, seen = "spark.sql.files.maxPartitionBytes", []
    read = text_queries.read_lines

    def spy(spark, path, **more):
        seen.append((int(spark.conf.get(key)), text_queries.largest_file(spark, path)))
        return read(spark, path, **more)

    monkeypatch.setattr(text_queries, "read_lines", spy)
    monkeypatch.setattr(text_queries, "LEAST_SPLIT", 1000)
    assert text_queries.landed_lines(spark, SF).count() > 0
    size, largest = seen[0]
    assert 3 < largest / size <= text_queries.SPLITS and size > 1000


def test_landing_is_written_by_all_tasks_and_told_by_folder(spark, folder, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(3)
    docs.write.parquet(f"{folder}/documents.parquet")
    monkeypatch.setattr(text_queries, "workspace", lambda spark, purpose: f"{folder}/{purpose}")
    rows = text_queries.landing_status(spark, folder).collect()
    want = {r.g: r.n for r in docs.groupBy((F.col("doc_id") % 16).alias("g")).agg(F.sum(F.octet_length("text") + 1).alias("n")).collect()}
    assert {r.g: r.length for r in rows} == want and len(rows) == 16 and all(r.landed for r in rows)
    assert len(glob.glob(f"{folder}/sizes/g=*/*.txt")) > 16
