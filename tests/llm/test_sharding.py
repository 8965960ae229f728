"""Sharding: law, slots, mixture of every shard, edge cases, files."""

import zlib
from collections import Counter

from condmon.llm import sharding


def check_shards(pairs, n=8):
    """Counts at most one apart, slots gapless from 0."""
    by = {s: sorted(k for x, k in pairs if x == s) for s in range(n)}
    counts = [len(v) for v in by.values()]
    assert max(counts) - min(counts) <= 1
    assert all(v == list(range(len(v))) for v in by.values())


def test_plan(docs_of):
    sources = [["hot", "hot", "a", None, "b"][i % 5] for i in range(503)]
    texts = [None if i % 50 == 0 else "é" * (i % 9) for i in range(503)]
    rows = sharding.shard_plan(docs_of(texts, sources=sources)).collect()
    assert len(rows) == 503
    check_shards([(r["shard"], r["slot"]) for r in rows])
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
        assert r["law"] == "rows" and r["grown_shard"] is None
    total = Counter(sources)
    for s in range(8):
        own = Counter(sources[r["doc_id"]] for r in rows if r["shard"] == s)
        assert all(abs(own[x] - n / 8) <= 2 for x, n in total.items())


def test_edge_cases(docs_of):
    assert sharding.shard_plan(docs_of([])).count() == 0
    rows = sharding.shard_plan(docs_of(["x", "x", None], ids=[1, 1, None])).collect()
    assert len(rows) == 3
    check_shards([(r["shard"], r["slot"]) for r in rows])


def test_documents_keep_their_columns(docs_of):
    docs = docs_of([f"text {i}" for i in range(40)] + [None])
    out = sharding.shard_documents(docs)
    assert out.columns == [*docs.columns, "shard", "slot"]
    got = out.collect()
    check_shards([(r["shard"], r["slot"]) for r in got])
    assert sorted(str(r["text"]) for r in got) == sorted(str(r["text"]) for r in docs.collect())
    again = sharding.shard_documents(out)
    assert again.columns == out.columns


def test_files_read_back_in_slot_order(docs_of, spark, tmp_path):
    out = sharding.shard_documents(docs_of([f"t{i}" for i in range(100)]))
    sharding.write_shards(out, str(tmp_path / "s"), file_rows=5)
    for s in range(8):
        rows = spark.read.parquet(str(tmp_path / "s" / f"shard={s}")).select("part", "slot").collect()
        slots = [r["slot"] for r in sorted(rows, key=lambda r: r["part"])]
        assert sorted(slots) == list(range(len(slots))) and max(Counter(r["part"] for r in rows).values()) <= 5


def test_repeated_rows_and_a_very_long_text(docs_of):
    """A third of all rows repeat one row; each takes a place of its own."""
    long = "long text " * 400_000
    texts = ["same"] * 200 + [f"t{i}" for i in range(399)] + [long]
    ids = [5] * 200 + list(range(100, 500))
    out = sharding.shard_documents(docs_of(texts, ids=ids)).collect()
    check_shards([(r["shard"], r["slot"]) for r in out])
    assert sorted((r["doc_id"], len(r["text"])) for r in out) == sorted((d, len(t)) for d, t in zip(ids, texts, strict=True))
    (row,) = [r for r in sharding.shard_plan(docs_of(texts, ids=ids)).collect() if r["size"] > 1000]
    assert row["size"] == len(long) + 1 and row["text_crc32"] == zlib.crc32(long.encode())


def test_tiny_sources_and_a_hot_id(docs_of):
    """Sources of one row share a fractional rank; a third of the rows an id."""
    ids = [None] * 300 + list(range(600))
    texts = [f"text {i % 170}" for i in range(900)]
    sources = ["hot"] * 300 + [f"s{i}" for i in range(600)]
    rows = sharding.shard_plan(docs_of(texts, ids=ids, sources=sources)).collect()
    assert len(rows) == 900
    check_shards([(r["shard"], r["slot"]) for r in rows])
    tiny = Counter(r["shard"] for r in rows if r["doc_id"] is not None)
    middle = [r["shard"] for r in rows if r["doc_id"] is None]
    # the tiny sources lie in the middle, the hot one's halves around them
    assert len(tiny) <= 6 and min(Counter(middle)[0], Counter(middle)[7]) >= 112
