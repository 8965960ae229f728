"""Quality rules: base counts against a brute force, held-out accuracy; both
classifiers on edge cases."""

import re
import zlib
from collections import Counter

import pyarrow.parquet as pq
import pytest

from condmon.llm import quality_rules as R
from condmon.llm import quality_zstd as Z
from condmon.llm.queries import queries

SF = "/root/testdata/sf0.01"
WORD = re.compile("[^\x20\x09-\x0d]+")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    wins = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {k for i in range(len(w) - 2) if wins[tuple(w[i : i + 3])] > 1 for k in range(i, i + 3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)
    return n, n[0] < 50 or 100 * n[4] > 50 * n[0]


def test_rules_query(spark):
    docs = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    rows = queries()["op8_quality_rules"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        counts, failed = brute(docs[r["doc_id"]])
        assert tuple(r[c] for c in COUNTS) == counts and r["base_failed"] == failed
        assert r["kept"] == (not failed and r["score"] >= R.KEEP) and 0 <= r["score"] <= 1
    held = [(labels[r["doc_id"]], r) for r in rows if r["doc_id"] in labels and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    good = [r for y, r in held if y == 1]
    bad = [r for y, r in held if y == 0]
    assert sum(g["score"] > b["score"] for g in good for b in bad) / len(good) / len(bad) > 0.95
    assert sum(r["kept"] or r["base_failed"] for r in good) / len(good) > 0.97
    assert sum(not r["kept"] for r in bad) / len(bad) > 0.9


TEXTS = [None, "", " \n\n", "a", "é ü\né ü\n é ü", "x y z x y z", "a " * 100, "#*$ %&| <>", "w " * 400_000, "l\nl\nl\n\n\n"]


def test_rules_edge_cases(spark, docs_of):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows = {r["doc_id"]: r for r in R.quality_verdicts(docs_of(TEXTS), labels).collect()}
    for i, t in enumerate(TEXTS):
        counts, failed = brute(t)
        assert tuple(rows[i][c] for c in COUNTS) == counts and rows[i]["base_failed"] == failed
        assert rows[i]["score"] == 0.5
    assert R.quality_verdicts(docs_of([]), labels).count() == 0


def test_repeated_words_with_a_large_vocabulary():
    import numpy as np

    ids = np.array([3, 1 << 22, 5, 9, 3, 1 << 22, 5, 7], np.int64)
    assert R.repeated_words(ids) == 6


@pytest.mark.parametrize("fit", [R.quality_verdicts, Z.quality_scores])
def test_labels_with_nulls_and_conflicts(spark, docs_of, fit):
    good = [f"the quiet river runs past house {i} and its green old garden wall " * 3 for i in range(60)]
    bad = [f"buy$$$ now*** {i} win### cash&&& click%%% " * 4 for i in range(60)]
    texts = [t for p in zip(good, bad, strict=True) for t in p] + [None, ""]
    ids = [*range(121), None]
    rows = [(i, 1 - i % 2, 0) for i in range(120)] + [(None, 1, 0), (5, None, 0), (999, 0, 0), (4, 1, 1), (4, 0, 1)]
    labels = spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
    got = fit(docs_of(texts, ids=ids), labels).collect()
    assert len(got) == 122 and all(0 <= r["score"] <= 1 for r in got)
    score = {r["doc_id"]: r["score"] for r in got}
    assert min(score[i] for i in range(0, 120, 2)) > max(score[i] for i in range(1, 120, 2))


def test_zstd_edge_cases(spark, docs_of):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows = Z.quality_scores(docs_of(TEXTS), labels).collect()
    assert len(rows) == len(TEXTS) and {r["score"] for r in rows} == {0.5} and {r["predicted"] for r in rows} == {1}
    docs = docs_of(["kept", None])
    assert Z.drop_low_quality(docs, labels).collect() == docs.collect()
    assert Z.quality_scores(docs_of([]), labels).count() == 0


def sample(spark, docs_of, extra=()):
    good = [f"the quiet river runs past house {i} and its green old garden wall\n" * 3 for i in range(60)]
    bad = [f"buy$$$ now*** {i} win### cash&&& click%%% " * 4 for i in range(60)]
    texts = [t for p in zip(good, bad, strict=True) for t in p]
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(120)], "doc_id bigint, quality int, toxic int")
    return [*texts, *extra], docs_of([*texts, *extra]), labels


def test_long_texts_are_read_in_pieces(monkeypatch):
    """Pieces of any size, and windows in parts, give the same values."""
    import numpy as np

    rng = np.random.default_rng(5)
    weights = rng.normal(size=1 << R.BITS).astype(np.float32)
    words = [f"wörd{i}" for i in range(40)] + ["#a", "b"]
    for k in range(25):
        text = "".join(rng.choice(words) + rng.choice([" ", "\n", "\n\n", " \t"]) for _ in range(k * k)).encode()
        f = R.Features([text], [text.split()])
        chars, symbols, lines, repeats = f.base()
        want = (len(text.split()), int(chars[0]), int(symbols[0]), lines[0], repeats[0])
        assert want == brute(text.decode())[0]
        for size, part in ((40, 7), (1 << 20, 1 << 20), (300, 50)):
            monkeypatch.setattr(R, "LONG_BYTES", size)
            monkeypatch.setattr(R, "WINDOWS", part)
            *counts, logit = R.long_text(text, weights)
            assert tuple(counts) == want and logit == pytest.approx(float(f.logits(weights)[0]), abs=1e-9)


def test_a_long_text_among_short_ones(spark, docs_of, monkeypatch):
    long = "the quiet river runs past house and old garden\n" * 30_000 + "x " * 10
    texts, docs, labels = sample(spark, docs_of, [long, "a b c"])
    rows = {r["doc_id"]: r for r in R.quality_verdicts(docs, labels).collect()}
    for i in (0, 1, 120, 121):
        assert tuple(rows[i][c] for c in COUNTS) == brute(texts[i])[0]
    assert rows[120]["score"] > 0.5 > rows[1]["score"]


@pytest.mark.parametrize("fit", [R.quality_verdicts, Z.quality_scores])
def test_edge_texts_through_a_fitted_model(spark, docs_of, fit):
    texts, docs, labels = sample(spark, docs_of, [*TEXTS, *TEXTS])
    rows = {r["doc_id"]: r for r in fit(docs, labels).collect()}
    assert len(rows) == len(texts) and all(0 <= r["score"] <= 1 for r in rows.values())
    n = len(TEXTS)
    for k in range(n):  # repeated texts score alike
        assert rows[120 + k]["score"] == rows[120 + n + k]["score"]
    assert rows[120]["score"] == rows[121]["score"] and len({r["score"] for r in rows.values()}) > 10


def test_zstd_scores_recomputed(spark):
    """Each score from the dictionaries and coefficients of a fit, by hand."""
    import math

    import zstandard as zs

    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    m = Z.fit(docs, labels)
    size = lambda t, d=None: len(
        zs.ZstdCompressor(level=Z.LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False,
                          **({"dict_data": zs.ZstdCompressionDict(d)} if d else {})).compress(t)
    )
    mean, scale, beta = m.platt
    rows = {r["doc_id"]: r["score"] for r in queries()["op7_quality_classifier"](spark, SF).collect()}
    for r in docs.where("doc_id % 9 = 0").collect():
        t = r["text"].encode()
        diff, own, n = size(t, m.bad) - size(t, m.good), size(t), len(t)
        x = (diff / n, diff / own, diff * own / n**2, own / n)
        z = sum((v - a) / b * c for v, a, b, c in zip(x, mean, scale, beta, strict=False)) + beta[-1]
        assert rows[r["doc_id"]] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)


def test_labels_without_texts_do_not_thin_out_the_sample(spark, docs_of):
    from condmon.llm.labelled import training_sample

    texts, docs, labels = sample(spark, docs_of, ["x" * 30_000])
    absent = spark.createDataFrame([(i, i % 2, 0) for i in range(120, 4000)], "doc_id bigint, quality int, toxic int")
    rows, _ = training_sample(docs, labels.union(absent), "s", per_class=20)
    assert len(rows) == 40 and {t.decode() for t, _ in rows} <= set(texts[:120])
