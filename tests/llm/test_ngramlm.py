"""N-gram trie: exact counts against a brute force, probabilities, coding."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from condmon.llm import eliasfano, ngramlm
from condmon.llm.queries import queries

from .conftest import SF_SMALL


def tokens(text):
    return [*(text or "").encode().lower().split(), b"<end>"]


class Brute:
    def __init__(self, texts):
        self.uni, self.pair, self.ctx, self.types = Counter(), Counter(), Counter(), Counter()
        for t in texts:
            w = tokens(t)
            self.uni.update(w)
            for a, b in zip([None, *w], w, strict=False):
                self.types[a] += (a, b) not in self.pair
                self.pair[a, b] += 1
                self.ctx[a] += 1
        self.n, self.v = sum(self.uni.values()), len(self.uni)

    def p1(self, w):
        return (self.uni[w] + 0.5) / (self.n + 0.5 * (self.v + 1))

    def p(self, a, w):
        if not self.ctx[a]:
            return self.p1(w)
        d = ngramlm.DISCOUNT
        return max(self.pair[a, w] - d, 0) / self.ctx[a] + d * self.types[a] / self.ctx[a] * self.p1(w)

    def score(self, text):
        w = tokens(text)
        base = sum(math.log10(self.p1(x)) for x in w)
        return len(w), sum(x in self.uni for x in w), base, sum(
            math.log10(self.p(a, x)) for a, x in zip([None, *w], w, strict=False)
        )


def close(got, want):
    assert (got["n_tokens"], got["n_known"]) == want[:2]
    assert got["base_score"] == pytest.approx(want[2], rel=1e-9)
    assert abs(got["score"] - want[3]) <= 2 * ngramlm.STEP * got["n_tokens"] + 1e-9


def test_query_against_brute_force(spark, docs_rows):
    fold = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 5 for r in docs_rows}
    model = Brute([r["text"] for r in docs_rows if fold[r["doc_id"]] != 1])
    got = {r["doc_id"]: r for r in queries()["op6_lm_score"](spark, SF_SMALL).collect()}
    assert len(got) == len(docs_rows)
    for r in docs_rows:
        g = got[r["doc_id"]]
        assert g["train_tokens"] == model.n and g["held_out"] == (fold[r["doc_id"]] == 1)
        close(g, model.score(r["text"]))
    held = [g for g in got.values() if g["held_out"]]
    assert sum(g["score"] for g in held) > sum(g["base_score"] for g in held)


@pytest.mark.parametrize("shard_bytes", [40, 1 << 20])
def test_edge_cases_and_shards(spark, docs_of, shard_bytes):
    texts = [None, "", "a b a b c", "A  B\tc", "new words a b", "x " * 20 + "y", "a b c"]
    long = " ".join(f"v{i % 613}" for i in range(350_000))
    docs = docs_of([*texts, long])
    trie = ngramlm.train(docs.where("doc_id <> 4"), shard_bytes=shard_bytes)
    model = Brute([t for i, t in enumerate([*texts, long]) if i != 4])
    assert trie.tokens == model.n and trie.vocabulary == model.v
    rows = ngramlm.score(docs, trie).collect()
    assert len(rows) == 8
    for r in rows:
        close(r, model.score([*texts, long][r["doc_id"]]))


def test_many_shards_and_few_open_maps(spark, docs_of, monkeypatch):
    """Shards are mapped and let go again in turn; scores stay the same."""
    texts = [" ".join(f"w{(i * k) % 97}" for k in range(60)) for i in range(40)]
    docs = docs_of(texts)
    trie = ngramlm.train(docs, shard_bytes=200)
    assert trie.shards > 40
    want = {r["doc_id"]: r["score"] for r in ngramlm.score(docs, trie).collect()}
    monkeypatch.setattr(ngramlm, "OPEN_SHARDS", 3)
    level1, level2 = trie.levels()
    model = Brute(texts)
    for i, text in enumerate(texts):
        words = [*text.encode().split(), ngramlm.END]
        hashes = np.array([ngramlm.word_hash(w) for w in words], np.uint64)
        order = np.argsort(hashes)
        ids, counts = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        ids[order], counts[order] = level1.find(hashes[order])
        assert (ids >= 0).all() and len(level1.open) <= 3
        keys = np.concatenate([[trie.begin], ids[:-1]]) << 32 | ids
        distinct, first, back = np.unique(keys, return_index=True, return_inverse=True)
        logp = level2.find(distinct, trie.log_unigram(counts[first]))[back]
        assert len(level2.open) <= 3 and logp.sum() == pytest.approx(want[i], abs=1e-9)
        assert abs(logp.sum() - model.score(text)[3]) <= 2 * ngramlm.STEP * len(words)


def test_probabilities_sum_to_one(spark, docs_of):
    texts = ["a b a c", "b b c a", "c"]
    trie = ngramlm.train(docs_of(texts))
    model = Brute(texts)
    level1, level2 = trie.levels()
    words = [*model.uni, b"unknown"]
    hashes = np.array([ngramlm.word_hash(ngramlm.END if w == b"<end>" else w) for w in words], np.uint64)
    order = np.argsort(hashes)
    ids, counts = level1.find(hashes[order])
    unknown = (1 << 32) - 1
    for ctx in [*ids[(ids >= 0) & (hashes[order] != ngramlm.word_hash(ngramlm.END))], trie.begin]:
        key = int(ctx) << 32 | np.where(ids < 0, unknown, ids)
        at = np.argsort(key)
        p = 10 ** level2.find(key[at], trie.log_unigram(counts[at]))
        assert p.sum() == pytest.approx(1, abs=0.01)


def test_empty_tables(spark, docs_of):
    trie = ngramlm.train(docs_of([]))
    assert trie.tokens == 0 and ngramlm.score(docs_of([]), trie).count() == 0
    (row,) = ngramlm.score(docs_of(["a"]), trie).collect()
    assert row["n_known"] == 0 and row["score"] == row["base_score"] == 0


def test_needs_a_file_path():
    with pytest.raises(ValueError):
        ngramlm.local_path("hdfs://name/folder")
    assert ngramlm.local_path("file:///a/b") == "/a/b" == ngramlm.local_path("/a/b")


@pytest.mark.parametrize("universe,n", [(10, 0), (1, 1), (100, 80), (10**6, 1000), (2**63, 3000), (2**64 - 1, 500)])
def test_elias_fano_round_trip(universe, n):
    rng = np.random.default_rng(n)
    v = np.unique(rng.integers(0, universe, n, dtype=np.uint64))
    view = eliasfano.View(eliasfano.encode(v, universe))
    assert (view.access(np.arange(len(v))) == v).all()
    ask = np.concatenate([v, rng.integers(0, universe, 300, dtype=np.uint64)])
    place = {int(x): i for i, x in enumerate(v)}
    assert view.find(ask).tolist() == [place.get(int(x), -1) for x in ask]
    repeated = np.sort(np.concatenate([v, v]))
    view = eliasfano.View(eliasfano.encode(repeated, universe))
    assert (view.access(np.arange(len(repeated))) == repeated).all()


def test_last_merge_gets_few_runs(spark):
    import pyarrow as pa

    rng, want, rows = np.random.default_rng(3), Counter(), []
    for _ in range(150):  # a hot shard 0 with a run per buffer, and a small one
        keys = np.unique(rng.integers(0, 500, 40))
        shards = np.where(keys < 490, 0, 1)
        counts = rng.integers(1, 9, len(keys))
        want.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
        rows += ngramlm._blobs(shards, keys, counts).to_pylist()
    blobs = spark.createDataFrame([(r["shard"], r["keys"], r["counts"]) for r in rows], ngramlm._BLOB)
    out = ngramlm._few_runs(blobs, 4).collect()
    runs = Counter(r["shard"] for r in out)
    assert set(runs) == {0, 1} and max(runs.values()) <= 4
    got = Counter()
    for shard in runs:
        some = [r for r in out if r["shard"] == shard]
        table = pa.table({c: [bytes(r[c]) for r in some] for c in ("keys", "counts")})
        keys, counts = ngramlm._merge(table)
        assert all((k < 490) == (shard == 0) for k in keys.tolist())
        got.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
    assert got == want
