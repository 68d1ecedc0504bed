"""Bucketed master tables: results as with plain tables, and no shuffle of the master."""

import pytest
from pyspark.sql import functions as F

from formsieve.operators import joins
from formsieve.operators.corrections import apply_log
from formsieve.sources import master
from tests.conftest import rows


def shuffles_of(df, table):
    """Exchanges above the scans of ``table`` in the physical plan."""
    found, above, scans = 0, [], 0
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-*|"))
        above = [(d, x) for d, x in above if d < depth] + [(depth, line)]
        if "FileScan" in line and f".{table}[" in line:
            scans += 1
            found += sum("Exchange" in x for _, x in above)
    assert scans, "the table isn't read"
    return found


@pytest.fixture(params=["4", "64"])
def no_broadcast(spark, request):
    """Sort-merge joins, with fewer and with more shuffle partitions than buckets."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": request.param}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _sites(spark, lo, hi, tag):
    return spark.range(lo, hi).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("uuid"),
                                      (F.col("id") % 7).cast("int").alias("n"), F.lit(tag).alias("name"))


def test_appends_and_corrections_leave_the_master_where_it_is(spark, tmp_path, no_broadcast):
    name = f"m_{tmp_path.name.replace('-', '_')}".lower()
    first = _sites(spark, 0, 500, "first")
    master.create_master(first, name, "uuid", 8, f"{tmp_path}/v1")
    assert master.bucketing(spark, name) == ("uuid", 8)
    batch = _sites(spark, 400, 650, "second")
    new = master.new_rows(batch, name)
    assert shuffles_of(new, name) == 0
    assert rows(new) == rows(joins.new_rows_only(batch, first, "uuid"))
    grown = master.append_new(batch.select("name", "uuid", F.col("n").cast("string").alias("n")), name)
    plain = first.unionByName(joins.new_rows_only(batch, first, "uuid"))
    assert grown.columns == first.columns and grown.schema["n"].dataType == first.schema["n"].dataType
    assert rows(grown) == rows(plain)
    assert master.append_new(batch, name).count() == 650  # a second run finds nothing new
    log = spark.createDataFrame([("u3", "name", "fixed", "TRUE", 1), ("u600", "n", "99", "TRUE", 2), ("u5", "n", "x", "TRUE", 3)],
                                "uuid string, variable string, new_value string, change string, ord long")
    fixed = master.corrected(name, log)
    assert shuffles_of(fixed, name) == 0
    assert rows(fixed) == rows(apply_log(plain, log))
    trail = master.corrections_trail(name, log)
    assert shuffles_of(trail, name) == 0
    second = master.rewrite(fixed, name, f"{name}_2", f"{tmp_path}/v2")
    assert master.bucketing(spark, f"{name}_2") == ("uuid", 8)
    back = master.undone(f"{name}_2", trail)
    assert shuffles_of(back, f"{name}_2") == 0 and rows(back) == rows(plain)
    # one file per bucket again, however many runs had appended
    assert second.select(F.input_file_name().alias("f")).distinct().count() <= 8


def test_what_a_master_refuses(spark, tmp_path):
    name = f"r_{tmp_path.name.replace('-', '_')}".lower()
    master.create_master(_sites(spark, 0, 10, "x"), name, "uuid", 4, f"{tmp_path}/v1")
    with pytest.raises(ValueError, match="doesn't have"):
        master.append_new(_sites(spark, 0, 3, "y").withColumn("extra", F.lit(1)), name)
    with pytest.raises(Exception, match="already exists"):
        master.create_master(_sites(spark, 0, 10, "x"), name, "uuid", 4, f"{tmp_path}/v2")
    spark.range(3).write.mode("overwrite").option("path", f"{tmp_path}/p").saveAsTable(f"{name}_p")
    with pytest.raises(ValueError, match="not bucketed"):
        master.bucketing(spark, f"{name}_p")


def test_buckets_follow_the_size():
    assert [master.buckets_for(n) for n in (0, 1, 1 << 30, 50 << 40, 1 << 60)] == [1, 1, 2, 100_000, 100_000]
