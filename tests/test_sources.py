import pytest
from pyspark.sql import functions as F

from fleetwright import session
from fleetwright.operators import firmware, quality
from fleetwright.schemas import RAW_FLEET
from fleetwright.sources import loads, sinks, tables
from tests.plan import plan_of


@pytest.mark.parametrize("parts", [1, 2, 7, 64, 300])
def test_key_ranges_cover_every_id_once(spark, parts):
    predicates = tables.key_range_predicates("device_id", "DEV-", parts)
    assert len(predicates) == parts
    ids = spark.range(5_000).select(
        F.format_string("DEV-%08x", F.pmod(F.xxhash64("id"), F.lit(2**32))).alias("device_id"))
    odd = spark.createDataFrame([("AAA",), ("DEV-",), ("DEV-zz",), ("zzz",), (None,)], "device_id string")
    rows = ids.union(odd).select("device_id", *[F.expr(p).alias(f"p{i}") for i, p in enumerate(predicates)])
    hits = F.array(*[F.coalesce(F.col(f"p{i}"), F.lit(False)) for i in range(parts)])
    assert rows.filter(F.size(F.array_remove(hits, False)) != 1).count() == 0


def test_replace_table_may_read_its_old_version(spark):
    sinks.replace_table(spark.range(3).withColumnRenamed("id", "device_id"), "ota_logs", 1)
    assert spark.table("ota_logs").count() == 3
    grown = spark.table("ota_logs").union(spark.range(10, 12))
    sinks.replace_table(grown, "ota_logs", 2)
    assert spark.table("ota_logs").count() == 5
    assert spark.table("ota_logs_v1").count() == 3


def test_append(spark, tmp_path):
    path = str(tmp_path / "events")
    for _ in range(2):
        sinks.append(spark.range(4), path)
    assert spark.read.parquet(path).count() == 8


def test_csv_header_must_match_the_schema(spark, tmp_path):
    path = str(tmp_path / "rows")
    sinks.write_csv(spark.range(2).select(F.col("id").alias("a"), F.lit("x").alias("b")), path)
    assert tables.csv_table(spark, path, "a long, b string").count() == 2
    with pytest.raises(Exception):
        tables.csv_table(spark, path, "other long, b string").collect()


def test_bucketed_tables_join_without_a_shuffle(spark, settings):
    keys = ["firmware_id", "chunk_index"]
    chunks = spark.range(2_000).select(
        (F.col("id") % 50).alias("firmware_id"), (F.col("id") / 50).cast("int").alias("chunk_index"))
    hash_ = F.sha2(F.col("chunk_index").cast("string"), 256)
    sinks.save_bucketed(chunks.withColumn("actual_hash", hash_), "landed_chunks", keys, 4)
    sinks.save_bucketed(chunks.withColumn("expected_hash", hash_), "known_entries", keys, 4)
    with settings(spark__sql__autoBroadcastJoinThreshold=-1):
        matched = firmware.match_chunks(spark.table("landed_chunks"), spark.table("known_entries"))
        assert matched.filter("result = 'OK'").count() == 2_000
        assert "Exchange" not in plan_of(matched)


def test_scratch_paths_are_below_the_shared_folder(spark):
    folder = session.shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir", folder)
    a, b = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert a != b and a.startswith(folder)


def test_scratch_lies_in_a_shared_folder():
    class Remote:
        conf = {"spark.sql.warehouse.dir": "hdfs:///warehouse/"}

    assert session.scratch_path(Remote, "x").startswith("hdfs:///warehouse/_scratch/x-")
    Remote.conf["spark.checkpoint.dir"] = "hdfs:///shared"
    assert session.scratch_path(Remote, "x").startswith("hdfs:///shared/x-")


def test_jdbc_options(spark, monkeypatch):
    """No database here: only what is handed to Spark's reader and writer."""
    calls = {}
    monkeypatch.setattr(type(spark.read), "jdbc", lambda self, url, table, **kw: calls.update(read=(url, table, kw)))
    tables.jdbc_table(spark, "jdbc:postgresql://db/postgres", "ota_logs", parts=4, properties={"user": "u"})
    url, table, kw = calls["read"]
    assert table == "ota_logs" and len(kw["predicates"]) == 4 and kw["properties"] == {"user": "u"}

    writer = type(spark.range(1).write)
    monkeypatch.setattr(writer, "option", lambda self, k, v: calls.setdefault(k, v) and self or self)
    monkeypatch.setattr(writer, "jdbc", lambda self, url, table, **kw: calls.update(write=(url, table)))
    sinks.append_jdbc(spark.range(1), "jdbc:postgresql://db/postgres", "ota_logs")
    assert calls["write"][1] == "ota_logs" and calls["batchsize"] == 500


def test_a_cluster_has_to_name_a_shared_folder():
    class Other:
        class conf:
            @staticmethod
            def get(key, default=None):
                return default

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Other)


def test_a_load_goes_on_where_it_was_cut_off(spark, tmp_path):
    path, schema = str(tmp_path / "load"), "batch_id bigint, device_id bigint"
    rows = spark.range(1_234).withColumnRenamed("id", "device_id")
    assert loads.read_load(spark, path, schema).collect() == []
    for until in (0, 0, 1, None, None):
        loads.load(rows, path, "device_id", batch_rows=100, until=until)
        found = loads.read_load(spark, path, schema).collect()
        wanted = 1_234 if until is None else 100 * (until + 1)
        assert sorted((r["device_id"], r["batch_id"]) for r in found) == [(i, i // 100) for i in range(wanted)]


def test_broken_lines_are_kept(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text("device_id,region,battery_voltage,signal_strength,update_status\n"
                    "a,R,12.0,50,Partial\nb,R,12.0\nc,R,12.0,strong,Partial\n\nd,R,12.0,50,Success,more\ne,R,UNKNOWN,50,Success\n"
                    '"f,R,12.0,50,Success\n')
    rows = tables.csv_lines(spark, str(path), RAW_FLEET)
    clean, bad = quality.quarantine(rows)
    assert [r["device_id"] for r in clean.collect()] == ["a"]
    found = {r["device_id"]: (r["defects"], r["unreadable_line"]) for r in bad.collect()}
    assert found["b"] == (["UNREADABLE_LINE"], "b,R,12.0") and found["c"][1] == "c,R,12.0,strong,Partial"
    assert found["d"][1] == "d,R,12.0,50,Success,more" and found["e"] == (["CORRUPT_TYPE"], None)
    assert len(found) == 5 and clean.count() + bad.count() == rows.count() == 6
