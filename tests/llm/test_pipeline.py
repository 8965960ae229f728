"""The pipeline against a brute-force version of every stage."""

import zlib

import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from condmon.llm import quality_zstd
from condmon.llm.common import read_table, save

from . import test_decontam, test_mixing, test_sharding, test_simhash
from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage, in order."""
    docs, out = read_table(spark, SF_SMALL, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        new = save(stage(spark, docs, SF_SMALL), f"test-{name}")
        out.append((docs, new))
        docs = new
    return out


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_stage_columns(stages, spark):
    names = read_table(spark, SF_SMALL, "documents").columns
    assert all(new.columns == names for _, new in stages[:4])
    assert stages[4][1].columns == [*names, "shard", "slot"]


def test_quality_stage(stages, spark):
    before, after = (rows(x) for x in stages[0])
    scores = quality_zstd.quality_scores(read_table(spark, SF_SMALL, "documents"), read_table(spark, SF_SMALL, "labels"))
    good = {r["doc_id"] for r in scores.collect() if r["predicted"] == 1}
    want = [r for r in before if r["doc_id"] in good]
    key = lambda r: r["doc_id"]
    assert sorted(after, key=key) == sorted(want, key=key) and len(after) <= len(before)


def test_near_duplicate_stage(stages):
    before, after = (rows(x) for x in stages[1])
    before.sort(key=lambda r: r["doc_id"])
    comp = test_simhash.brute_components([test_simhash.brute_fingerprint(r["text"]) for r in before])
    want = [r for i, r in enumerate(before) if comp[i] == i]
    assert sorted(after, key=lambda r: r["doc_id"]) == want and len(after) < len(before)


def test_decontamination_stage(stages):
    bench = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF_SMALL}/benchmark.parquet").to_pylist()]
    before, after = (rows(x) for x in stages[2])
    want = {r["doc_id"] for r in before if not test_decontam.brute(r["text"], bench)[4]}
    assert {r["doc_id"] for r in after} == want and len(after) == len(want)


def test_mix_stage(stages):
    before, after = (rows(x) for x in stages[3])
    want = test_mixing.brute_passes([(r["doc_id"], r["text"], r["source"]) for r in before])
    got = {}
    for r in after:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == {d: n for d, n in want.items() if n}
    whole = {r["doc_id"]: r for r in before}
    assert all(r == whole[r["doc_id"]] for r in after)


def test_shard_stage(stages):
    before, after = (rows(x) for x in stages[4])
    assert len(before) == len(after)
    test_sharding.check_shards([(r["shard"], r["slot"]) for r in after])
    strip = lambda r: tuple(str(r[c]) for c in ("doc_id", "text", "source"))
    assert sorted(map(strip, before)) == sorted(map(strip, after))


def test_run_returns_the_last_stage(spark, stages):
    got, want = rows(corpus_pipeline.run(spark, SF_SMALL)), rows(stages[4][1])
    key = lambda r: (r["shard"], r["slot"])
    assert sorted(got, key=key) == sorted(want, key=key)


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table("/root/testdata/sf0.01/labels.parquet").to_pylist()}
    got = quality_zstd.quality_scores(
        read_table(spark, "/root/testdata/sf0.01", "documents"), read_table(spark, "/root/testdata/sf0.01", "labels")
    ).collect()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [(labels[r["doc_id"]], r["predicted"], r["score"]) for r in got if r["held_out"] and r["doc_id"] in labels]
    good, bad = [s for y, _, s in held if y == 1], [s for y, _, s in held if y == 0]
    assert sum(y == p for y, p, _ in held) / len(held) > 0.9
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) > 0.95


def test_an_empty_table_runs_through(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        read_table(spark, SF_SMALL, t).limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns[-2:] == ["shard", "slot"] and out.collect() == []
