from __future__ import annotations

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from opsreport.llm import order_minhash as O
from opsreport.llm.common import shared_folder, table, written
from opsreport.llm.queries import ORACLE, QUERIES


def test_stages_one_by_one(spark):
    data = "/root/testdata/sf0.001"
    docs = table(spark, data, "documents")
    columns, seen = docs.columns, {}
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, data), "test")
        assert docs.columns == columns, name
        seen[name] = docs
    ids = {n: {r.doc_id for r in d.select("doc_id").collect()} for n, d in seen.items()}
    assert ids["line dedup"] == ids["quality rules"]
    assert ids["near dedup"] < ids["line dedup"]
    assert ids["mixing"] <= ids["near dedup"]
    once = seen["near dedup"].groupBy("doc_id").count().where("count > 1")
    assert once.count() == 0
    classes = O.near_duplicate_classes(seen["line dedup"])
    assert ids["near dedup"] == {r.doc_id for r in classes.where("kept").collect()}
    last = corpus_pipeline.STAGES[-1][1](spark, docs, data)
    assert last.where(~F.col("decodes")).count() == 0
    assert last.count() == docs.count()


def test_run_equals_the_stages(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.count() > 50 and "ids_crc32" in rows.columns


def test_every_operator_is_registered():
    numbers = {n.split("_")[0] for n in QUERIES}
    assert numbers == {f"op{k}" for k in range(1, 14)}
    assert set(ORACLE) <= set(QUERIES)


class Session:
    """As much of a session as the folder asks for."""

    def __init__(self, master, folder):
        self.sparkContext = self.conf = self
        self.master, self.folder = master, folder

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.folder or default


def test_shared_folder_follows_the_session():
    named = shared_folder(Session("spark://h:1", "hdfs:///shared/"), "x")
    assert named.startswith("hdfs:///shared/x-")
    own = [shared_folder(Session("local[2]", None), "x") for _ in range(2)]
    assert own[0] != own[1] and all(f.startswith("file:///") for f in own)
    for master in ("spark://h:1", "local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(ValueError):
            shared_folder(Session(master, None), "x")
