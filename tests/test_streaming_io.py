"""Stream append and readers."""

import os
import tempfile

from pyspark.sql import functions as F

from formsieve.sources import io
from formsieve.streaming.append_stream import append_batch, start_append_stream
from tests.conftest import rows


def test_stream_append_is_idempotent(spark):
    base = tempfile.mkdtemp(prefix="formsieve-stream-")
    src, master, ckpt = f"{base}/in", f"{base}/master", f"{base}/ckpt"
    schema = "uuid string, v int"
    spark.createDataFrame([("u1", 1), ("u2", 2)], schema).write.parquet(f"{src}/b1")
    q = start_append_stream(spark, f"{src}/*", spark.createDataFrame([], schema).schema, master, ckpt)
    q.awaitTermination()
    spark.createDataFrame([("u2", 20), ("u3", 3)], schema).write.parquet(f"{src}/b2")
    q = start_append_stream(spark, f"{src}/*", spark.createDataFrame([], schema).schema, master, ckpt)
    q.awaitTermination()
    assert rows(spark.read.parquet(master)) == [("u1", 1), ("u2", 2), ("u3", 3)]
    # replaying a batch appends nothing
    assert append_batch(spark, spark.createDataFrame([("u3", 3)], schema), master) == 0


def test_dictionary_reader_normalises_header_and_order(spark):
    d = tempfile.mkdtemp(prefix="formsieve-dict-")
    path = os.path.join(d, "choices.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("list_name,name,label::english,,label::arabic\n")
        f.write("ngo,mdf,MDF first,,x\n,,,,\nngo2,mdf,MDF second,,y\nqq3 ,Gas_stove,Gas stove,,z\n")
    dic = io.read_dictionary(spark, path)
    assert dic.columns == ["ord", "list_name", "name", "label_english", "label_arabic"]
    got = [tuple(r) for r in dic.orderBy("ord").select("name", "label_english").collect()]
    assert got == [("mdf", "MDF first"), ("mdf", "MDF second"), ("Gas_stove", "Gas stove")]


def test_responses_reader_renames_server_columns(spark):
    d = tempfile.mkdtemp(prefix="formsieve-resp-")
    spark.createDataFrame([(1, "a")], "_index int, _uuid string").write.parquet(f"{d}/r")
    assert io.read_responses(spark, f"{d}/r").columns == ["index", "uuid"]


def test_plan_reader(spark):
    d = tempfile.mkdtemp(prefix="formsieve-plan-")
    path = os.path.join(d, "plan.csv")
    with open(path, "w") as f:
        f.write(",".join(io.PLAN_COLUMNS) + "\n")
        f.write("I1,RQ,SRQ,H,,a1_governorate_name,categorical,b1_site_management,categorical,direct_reporting\n")
    from formsieve.plans.analysis import plan_rows
    rows_ = plan_rows(io.read_plan(spark, path))
    assert rows_[0].dependent == "b1_site_management" and rows_[0].repeat is None


def test_correction_log_reader_keeps_order(spark):
    d = tempfile.mkdtemp(prefix="formsieve-log-")
    path = os.path.join(d, "log.csv")
    with open(path, "w") as f:
        f.write("uuid,variable,new_value,fix,change\nu1,hh,11,x,TRUE\nu1,hh,12,x,TRUE\n")
    log = io.read_correction_log(spark, path)
    from formsieve.operators.corrections import reduce_log
    assert reduce_log(log).collect()[0]["new_value"] == "12"


def test_questionnaire_reader(spark):
    d = tempfile.mkdtemp(prefix="formsieve-q-")
    qp, cp = os.path.join(d, "questions.csv"), os.path.join(d, "choices.csv")
    with open(qp, "w") as f:
        f.write("type,name\nselect_one yes_no,B1_site_management\ninteger,a7_hh\ntext,comments\n")
    with open(cp, "w") as f:
        f.write("list_name,name,label::english\nyes_no,yes,Yes\nyes_no,no,No\n")
    types, choices, lists = io.read_questionnaire(spark, qp, cp)
    assert types == {"b1_site_management": "select_one yes_no", "a7_hh": "integer", "comments": "text"}
    assert [tuple(r) for r in lists.collect()] == [("b1_site_management", "yes_no")]
    assert choices.count() == 2


def test_site_master_reader_trims(spark):
    d = tempfile.mkdtemp(prefix="formsieve-master-")
    spark.createDataFrame([(" Camp A\t", "C1")], "`site.name` string, `new.code` string").write.parquet(f"{d}/m")
    assert [tuple(r) for r in io.read_site_master(spark, f"{d}/m").collect()] == [("Camp A", "C1")]


def test_checkpoint_dir_needs_a_shared_folder_off_local_mode():
    import pytest

    from formsieve.session import checkpoint_dir

    class _Ctx:
        master = "spark://cluster:7077"

        def getCheckpointDir(self):
            return None

    class _Conf:
        def get(self, key, default=None):
            return default

    class _Session:
        sparkContext = _Ctx()
        conf = _Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Session())
