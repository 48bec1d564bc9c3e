"""Small side inputs and report/table writers."""

import pytest

from citeweave.sinks import writers
from citeweave.sources import jsonl, tables

U = "0a000000-0000-4000-8000-000000000001"


def test_id_map_roundtrip(spark, tmp_path):
    papers = spark.createDataFrame([(1, U), (2, U.replace("1", "2"))],
                                   "paper_id long, source_uuid string")
    out = str(tmp_path / "paper_ids.csv")
    writers.write_id_map(papers, out)
    back = tables.read_id_map(spark, out)
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in papers.collect())


def test_uuid_list_missing_file_is_empty(spark, tmp_path):
    assert tables.read_uuid_list(spark, str(tmp_path / "absent.txt")).count() == 0
    p = tmp_path / "has_mentions.csv"
    p.write_text(U + "\n\n" + U.replace("1", "3") + "\n")
    assert tables.read_uuid_list(spark, str(p)).count() == 2


def test_identifier_input_must_be_jsonl(spark, tmp_path):
    with pytest.raises(ValueError):
        jsonl.read_identifiers(spark, str(tmp_path / "ids.json"))


def test_report_keeps_order_and_separator(spark, tmp_path):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("b", 1), ("a", 3), ("c", 3), ("d;e", 0)], "name string, n long")
    out = str(tmp_path / "report")
    writers.write_report(df.orderBy(F.desc("n"), "name"), out)
    assert writers.read_report_lines(spark, out) == ["a;3", "c;3", "b;1", "d;e;0"]


def test_table_comments_and_partitioned_write(spark, tmp_path):
    df = writers.with_comments(spark.createDataFrame([(1, "x")], "k int, v string"),
                               {"k": "the key"})
    out = str(tmp_path / "t")
    writers.write_table(df, out, partition_by=["v"])
    back = spark.read.parquet(out)
    assert writers.table_comment(back, "k") == "the key" and back.count() == 1


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    from pyspark.sql import functions as F

    papers = spark.range(2000).select(F.col("id").alias("paper_id"),
                                      (F.col("id") % 30 + 1990).cast("int").alias("published_year"))
    mentions = spark.range(8000).select((F.col("id") % 2000).alias("paper_id"),
                                        (F.col("id") % 7).cast("string").alias("software"))
    writers.write_bucketed_table(papers, "cw_papers", str(tmp_path / "p"), num_buckets=8)
    writers.write_bucketed_table(mentions, "cw_mentions", str(tmp_path / "m"), num_buckets=8)
    p, m = spark.table("cw_papers"), spark.table("cw_mentions")
    joined = (p.where("published_year >= 2010").join(m, "paper_id")
              .select("paper_id", "software").distinct())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = (p.where("published_year >= 2010").join(m, "paper_id")
                .select("paper_id", "software").distinct()
                ._jdf.queryExecution().executedPlan().toString())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Exchange" not in plan.split("SortMergeJoin")[1].split(
        "HashAggregate")[0]
    want = {(i % 2000, str(i % 7)) for i in range(8000) if (i % 2000) % 30 + 1990 >= 2010}
    assert {(r.paper_id, r.software) for r in joined.collect()} == want


def test_tables_and_collections_take_the_fast_gzip(spark, tmp_path):
    rows = spark.range(0, 20_000, 1, 1).selectExpr(
        "'paper' AS parse_type", "'ab' AS prefix", "lpad(id, 36, '0') AS uuid",
        "concat('a line of text, ', sha2(string(id), 256), ', and words: ', id % 97) AS line")

    def size(folder):
        return sum(f.stat().st_size for f in (tmp_path / folder).rglob("part-*"))

    fast, slow = (rows.write.option("compression", "gzip").option("zlib.compress.level", level)
                  for level in ("BEST_SPEED", "DEFAULT_COMPRESSION"))
    fast.parquet(str(tmp_path / "fast"))
    slow.parquet(str(tmp_path / "slow"))
    writers.write_table(rows, str(tmp_path / "table"))
    assert size("table") == size("fast") > size("slow")
    writers.write_collection(rows, str(tmp_path / "collection"), num_partitions=1)
    lines = rows.select("line").sort("line").coalesce(1)
    rows.sort("uuid").select("line").coalesce(1).write.option("compression", "gzip").text(
        str(tmp_path / "plain"))
    assert size("collection") > size("plain")
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "collection")).collect()) == [
        r.line for r in lines.collect()]
