"""Segment search, counts and calibration against brute force; held-out
accuracy on planted passages; edge cases."""

import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from condmon.llm import toxicity as T
from condmon.llm.common import pieces
from condmon.llm.queries import queries

from .conftest import SF_SMALL

LABELS = "doc_id bigint, quality int, toxic int, score string"
INSULTS = ["grumpkin", "fleabrain", "snotface", "dunderhead", "mudslug", "warthog"]


def fold(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def brute_segments(s):
    """All maximal scoring segments: the best one, then left and right of it."""

    def best(lo, hi):
        sums = [(sum(s[i:j]), i - j, i, j) for i in range(lo, hi) for j in range(i + 1, hi + 1)]
        top = max(sums, default=(0, 0, 0, 0))
        if top[0] <= 0:
            return []
        return [*best(lo, top[2]), (top[2], top[3] - 1, top[0]), *best(top[3], hi)]

    return best(0, len(s))


@pytest.mark.parametrize("seed", range(40))
def test_segments(seed):
    rng = random.Random(seed)
    s = [rng.gauss(-0.3, 1) for _ in range(rng.randint(0, 30))]
    words = [f"w{i}" for i in range(len(s))]
    scores = dict(zip((w.encode() for w in words), s, strict=True))
    n, found = T.scan(" ".join(words).encode(), scores)
    want = brute_segments(s)
    assert n == len(s) and [f[:2] for f in found] == [w[:2] for w in want]
    assert np.allclose([f[2] for f in found], [w[2] for w in want])


def test_pieces_do_not_matter(monkeypatch):
    rng = random.Random(1)
    scores = {f"w{i}".encode(): rng.gauss(-0.2, 1) for i in range(40)}
    text = "".join(f"w{rng.randrange(40)}{rng.choice([' ', ', ', chr(10) * 2, ' ä '])}" for _ in range(500)).encode()
    scores["ä".encode()] = -0.1
    n, found = T.scan(text, scores)
    where = T.spans(text, found)
    monkeypatch.setattr(T, "pieces", lambda data: pieces(data, 64))
    m, again = T.scan(text, scores)
    assert n == m and [f[:2] for f in found] == [f[:2] for f in again] and T.spans(text, again) == where
    words = re.findall(r"[0-9a-zä]+", text.decode())
    for (first, last, _), (a, b) in zip(found, where, strict=True):
        assert re.findall(r"[0-9a-zä]+", text.decode()[a:b]) == words[first : last + 1]


def test_scripts_without_spaces_are_read_by_letter():
    text = "漢字 mixed語 café".encode()
    assert [t.decode() for t in T.pattern(text).findall(text)] == ["漢", "字", "mixed", "語", "café"]


def test_linear_time():
    s = {b"a": 1.0, b"b": -1.5, b"c": 0.01}
    text = b" ".join([b"a", b"b"] * 200_000 + [b"c", b"b"] * 200_000)
    n, found = T.scan(text, s)
    assert n == 800_000 and found[0][:2] == (0, 0)


def test_decay():
    s, w = np.array([2.0, 0.5, -0.3, -1.0]), np.array([1.0, 2.0, 60.0, 30.0])
    d = T.decay_of(s, w)
    assert abs((w / w.sum()) @ np.exp(d * s) - 1) < 1e-9
    assert T.decay_of(np.array([-1.0]), np.array([1.0])) == T._LAMBDA


def test_counts(spark):
    texts = [("One one two", 1), ("two three", 0), ("three THREE; four", 0), ("", 0)]
    df = spark.createDataFrame([(y, t) for t, y in texts], "toxic int, text string")
    got = {(r["kind"], r["slot"]): (r["clean"], r["toxic"], r["tokens"]) for r in T.token_counts(df).to_pylist()}
    want = {"one": (0, 1, 0), "two": (1, 1, 1), "three": (2, 0, 3), "four": (1, 0, 1)}
    assert {k: v for k, v in got.items() if k[0] == 0} == {(0, T.slots(w.encode())[0]): v for w, v in want.items()}
    assert got[1, T.slots(b"thre")[1]][:2] == (2, 0)


def planted(n, seed):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.randint(20, 200))]
        if i % 5 == 0:
            at = rng.randrange(len(words))
            words[at:at] = rng.sample(INSULTS, 4)
        elif i % 7 == 0:  # one document that repeats itself
            words += [f"own{i}"] * 40
        rows.append(" ".join(words).capitalize() + ".")
        labels.append((i, 1, int(i % 5 == 0), "x"))
    return rows, labels


def test_held_out_accuracy_and_passages(spark, docs_of):
    texts, labels = planted(600, 2)
    docs = docs_of(texts)
    rows = {r["doc_id"]: r for r in T.toxicity_scores(docs, spark.createDataFrame(labels, LABELS)).collect()}
    assert len(rows) == 600
    for i, r in rows.items():
        assert r["held_out"] == fold(i) and r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1
        if r["held_out"]:
            assert r["predicted"] == (i % 5 == 0)
    for i in range(0, 600, 5):
        found = " ".join(texts[i][p["start"] : p["end"]].lower() for p in rows[i]["passages"])
        assert sum(w in found for w in INSULTS) == 4
        assert all(p["e_value"] <= T.E_VALUE * 1.0001 for p in rows[i]["passages"])
    again = {r["doc_id"]: r["score"] for r in T.toxicity_scores(docs, spark.createDataFrame(labels, LABELS)).collect()}
    assert again == {i: r["score"] for i, r in rows.items()}


def test_held_out_labels_and_other_columns_are_no_inputs(spark, docs_of):
    texts, labels = planted(300, 3)
    flipped = [(i, 0, 1 - t if fold(i) else t, "z") for i, _, t, _ in labels]
    one = T.toxicity_scores(docs_of(texts), spark.createDataFrame(labels, LABELS)).collect()
    two = T.toxicity_scores(docs_of(texts, sources=["t"] * 300), spark.createDataFrame(flipped, LABELS)).collect()
    assert sorted((r["doc_id"], r["score"]) for r in one) == sorted((r["doc_id"], r["score"]) for r in two)


def test_edge_cases(spark, docs_of):
    texts, labels = planted(300, 4)
    long = " ".join(["plain words and more"] * 300_000) + " " + " ".join(INSULTS)
    extra = [None, "", "  \n", texts[5], texts[5], long]
    ids = [*range(300), 1000, 1001, 1002, None, 5, 1003]
    more = [*labels, (5, 1, 1, "x"), (5, 1, None, "x"), (None, 1, 1, "x"), (7777, 0, 1, "x")]
    rows = T.toxicity_scores(docs_of(texts + extra, ids), spark.createDataFrame(more, LABELS)).collect()
    assert len(rows) == 306
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[1000][0]["score"] == by[1001][0]["score"] == by[1002][0]["score"] < 0.3
    assert by[1000][0]["passages"] == [] and len({r["score"] for r in by[5]} | {by[None][0]["score"]}) == 1
    assert by[None][0]["held_out"] == (zlib.crc32(b"") % 4 == 2)
    assert long[by[1003][0]["passages"][-1]["start"] :].startswith(INSULTS[0])
    empty = spark.createDataFrame([], LABELS)
    none = T.toxicity_scores(docs_of(texts[:3]), empty).collect()
    assert [r["score"] for r in none] == [0.5] * 3 and none[0]["passages"] == []
    one_class = T.toxicity_scores(docs_of(texts[:9]), spark.createDataFrame([(i, 1, 0, "x") for i in range(9)], LABELS))
    assert {r["score"] for r in one_class.collect()} == {0.0}
    assert T.toxicity_scores(docs_of([]), empty).collect() == []


def test_query_covers_its_table(spark, docs_rows):
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{SF_SMALL}/labels.parquet").to_pylist()}
    rows = queries()["op11_toxicity"](spark, SF_SMALL).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in docs_rows) and labels
    assert all(r["held_out"] == fold(r["doc_id"]) for r in rows)
