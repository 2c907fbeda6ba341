import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_cases import corpus, odd_texts  # noqa: F401

from rosterline.llm import sharding as S


def plain_jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_agrees_with_the_plain_loop():
    keys = np.random.default_rng(0).integers(0, 1 << 64, 500, dtype=np.uint64)
    for n in (1, 2, 7, 16, 1000):
        assert S.jump(keys, n).tolist() == [plain_jump(int(k), n) for k in keys]
    with pytest.raises(ValueError):
        S.jump(keys, 0)


def test_one_more_shard_takes_only_into_itself():
    keys = np.random.default_rng(1).integers(0, 1 << 64, 20000, dtype=np.uint64)
    a, b = S.jump(keys, 16), S.jump(keys, 17)
    assert set(b[a != b]) == {16}
    assert abs((a != b).mean() - 1 / 17) < 0.01


def test_table(spark, corpus, odd_texts):
    rows = S.shard_table(corpus(odd_texts)).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(odd_texts)))
    for r in rows:
        body = (odd_texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law) == (len(body) + 1, zlib.crc32(body), "key")
        assert r.grown_shard in (r.shard, 16)
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    again = S.shard_table(corpus(odd_texts, partitions=7))
    assert sorted((r.doc_id, r.shard) for r in again.collect()) == sorted((r.doc_id, r.shard) for r in rows)


def test_one_key_for_all_rows_null_keys_empty_table_and_clashing_names(spark, corpus):
    same = S.shard_table(corpus(["t"] * 500, ids=[7] * 400 + [None] * 100).withColumn("shard", F.lit("x")).withColumn("slot", F.lit(1)))
    rows = same.collect()
    assert len(rows) == 500 and len({(r.doc_id, r.shard) for r in rows}) == 2
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert S.shard_table(corpus([])).collect() == []


def test_written_shards(spark, corpus, tmp_path):
    S.write_shards(corpus([str(i) for i in range(100)]), str(tmp_path / "s"), ["doc_id"], 4, files=2)
    back = spark.read.parquet(str(tmp_path / "s"))
    want = {r.doc_id: r.shard for r in S.assign_shards(corpus([str(i) for i in range(100)]), ["doc_id"], 4).collect()}
    assert {r.doc_id: r["shard"] for r in back.collect()} == want


def test_written_shards_keep_columns_of_that_name(spark, corpus, tmp_path):
    docs = corpus([str(i) for i in range(40)]).withColumn("Shard", F.lit("own")).withColumn("shard_1", F.col("doc_id"))
    name = S.write_shards(docs, str(tmp_path / "s"), ["doc_id"], 4)
    back = spark.read.parquet(str(tmp_path / "s")).collect()
    want = {r.doc_id: r.at for r in S.assign_shards(docs, ["doc_id"], 4, "at").collect()}
    assert name == "shard_2" and len(back) == 40
    assert all((r["Shard"], r["shard_1"], r[name]) == ("own", r["doc_id"], want[r["doc_id"]]) for r in back)
