"""The written order of rows over files and splits."""

import os
import time

import pytest

from formsieve.operators import lookup
from formsieve.operators.corrections import apply_log
from formsieve.sources import io, order


@pytest.fixture
def small_splits(spark):
    """Splits of 4 kB, packed by size: tasks no longer follow the files."""
    keys = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "1024"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _write(folder, sizes, header="n,code,label"):
    """CSV files of the given numbers of rows; returns the rows in written order."""
    os.makedirs(folder, exist_ok=True)
    out, n = [], 0
    for i, size in enumerate(sizes):
        with open(f"{folder}/part-{i:03d}.csv", "w") as f:
            f.write(header + "\n")
            for _ in range(size):
                f.write(f"{n},c{n * 7919 % 50},label {n} {'x' * (n % 40)}\n")
                out.append(n)
                n += 1
    return out


def test_numbers_follow_files_and_splits(spark, small_splits, tmp_path):
    written = _write(f"{tmp_path}/d", [900, 3, 400, 0, 1200, 60])
    df = order.read_in_order(spark, f"{tmp_path}/d")
    assert [int(r["n"]) for r in df.orderBy("ord").collect()] == written
    assert sorted(r["ord"] for r in df.collect()) == list(range(1, len(written) + 1))
    # the reason for it: ids alone follow how splits are packed into tasks
    raw = order.load_in_order(spark, f"{tmp_path}/d")
    assert raw.select(order.FILE, order.BLOCK).distinct().count() > 6
    assert [int(r["n"]) for r in raw.orderBy(order.ROW).collect()] != written
    # the key form sorts alike, without a job
    key = order.read_in_order(spark, f"{tmp_path}/d", numbers=False)
    assert [int(r["n"]) for r in key.orderBy("ord").collect()] == written
    assert "Exchange" not in key._jdf.queryExecution().executedPlan().toString()


def test_paths_in_the_order_given_and_by_time(spark, tmp_path):
    for i, name in enumerate("ba"):
        os.makedirs(f"{tmp_path}/{name}")
        with open(f"{tmp_path}/{name}/x.csv", "w") as f:
            f.write(f"n,code,label\n{i},c,{name}\n")
        os.utime(f"{tmp_path}/{name}/x.csv", (time.time() + i,) * 2)
    say = lambda df: [r["label"] for r in df.orderBy("ord").collect()]
    assert say(order.read_in_order(spark, [f"{tmp_path}/b", f"{tmp_path}/a"])) == ["b", "a"]
    assert say(order.read_in_order(spark, f"{tmp_path}/*")) == ["a", "b"]
    assert say(order.read_in_order(spark, f"{tmp_path}/*", by="time")) == ["b", "a"]
    with pytest.raises(ValueError):
        order.read_in_order(spark, f"{tmp_path}/a", by="size")


def test_first_match_of_a_dictionary_of_many_files(spark, small_splits, tmp_path):
    _write(f"{tmp_path}/d", [700, 5, 900], header="n,name,label::english")
    for i in range(3):  # a list name column, as dictionaries have
        p = f"{tmp_path}/d/part-{i:03d}.csv"
        lines = open(p).read().splitlines()
        with open(p, "w") as f:
            f.write("list_name," + lines[0] + "\n" + "".join(f"l,{x}\n" for x in lines[1:]) + ",,,\n")
    d = io.read_dictionary(spark, f"{tmp_path}/d")
    assert d.columns == ["ord", "list_name", "name", "label_english"] and d.count() == 1605
    got = lookup.lookup_first(spark.createDataFrame([(f"c{i}",) for i in range(50)], "code string"), "code", d, "label")
    first = {}
    for n in range(1605):
        first.setdefault(f"c{n * 7919 % 50}", n)
    assert {r["code"]: int(r["label"].split()[1]) for r in got.collect()} == first


def test_last_entry_of_a_log_of_many_files(spark, small_splits, tmp_path):
    os.makedirs(f"{tmp_path}/log")
    last, n = {}, 0
    for i, size in enumerate([800, 2, 500]):
        with open(f"{tmp_path}/log/part-{i}.csv", "w") as f:
            f.write("uuid,variable,new_value,fix,change\n")
            for _ in range(size):
                u = f"u{n * 31 % 40}"
                f.write(f"{u},name,v{n} {'y' * (n % 30)},,TRUE\n")
                last[u], n = n, n + 1
    log = io.read_correction_log(spark, f"{tmp_path}/log")
    data = spark.createDataFrame([(f"u{i}", "old") for i in range(41)], "uuid string, name string")
    got = {r["uuid"]: r["name"].split()[0] for r in apply_log(data, log).collect()}
    assert got == {f"u{i}": f"v{last[f'u{i}']}" if f"u{i}" in last else "old" for i in range(41)}


def test_a_stored_ord_is_kept(spark, tmp_path):
    with open(f"{tmp_path}/d.csv", "w") as f:
        f.write("ord,list_name,name,label::english\n10,l,a,late\n9,l,a,early\n")
    d = io.read_dictionary(spark, f"{tmp_path}/d.csv")
    got = lookup.lookup_first(spark.createDataFrame([("a",)], "code string"), "code", d, "label")
    assert got.first()["label"] == "early"
