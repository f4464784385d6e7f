from collections import defaultdict

from pyspark.sql import functions as F

from cadence.llm import sharding
from cadence.llm.common import new_path


def test_shards_fit_and_split_only_when_needed(frame, odd_rows):
    rows = odd_rows * 3 + [(7, f"one hot key {i} " * 3) for i in range(150)] + [(7, "equal rows " * 5)] * 150
    for limit in (10**9, 4000, 900):
        out = sharding.shard_report(frame(rows), limit).collect()
        assert len(out) == len(rows)
        shards = defaultdict(list)
        for r in out:
            shards[r["shard"]].append(r)
        for shard, members in shards.items():
            size = sum(r["n_bytes"] for r in members)
            assert (size, len(members), len(shard)) == (members[0]["shard_bytes"], members[0]["shard_docs"], members[0]["depth"])
            assert size <= limit or len(members) == 1
            if shard:       # the bucket that was split was over the limit
                assert sum(r["n_bytes"] for r in out if r["shard"].startswith(shard[:-1])) > limit
            assert not any(other != shard and other.startswith(shard) for other in shards)
    assert sharding.shard_report(frame([])).collect() == []


def test_shards_are_written_with_all_columns(spark, frame, odd_rows):
    path = new_path(spark, "shards")
    docs = frame(odd_rows)
    sharding.write_shards(docs, path, 2000)
    back = spark.read.parquet(path)
    got = back.select("doc.*")
    assert got.columns == docs.columns and got.exceptAll(docs).count() == 0 and docs.exceptAll(got).count() == 0
    sizes = back.groupBy("shard").agg(F.sum(F.octet_length(F.coalesce("doc.text", F.lit("")))).alias("b"), F.count("*").alias("n"))
    assert sizes.where("b > 2000 and n > 1").count() == 0


def test_a_group_of_rows_without_text_is_split(frame):
    rows = [(7, None)] * 300 + [(7, "")] * 300 + [(None, None)] * 200
    out = sharding.shard_report(frame(rows), 2000).collect()
    sizes = defaultdict(int)
    for r in out:
        assert r["n_bytes"] == sharding.ROW_BYTES
        sizes[r["shard"]] += r["n_bytes"]
    assert len(out) == 800 and max(sizes.values()) <= 2000
