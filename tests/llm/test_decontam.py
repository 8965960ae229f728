"""Decontamination against a brute force over all windows, and edge cases."""

import hashlib
import re
from functools import partial

import pyarrow.parquet as pq
import pytest

from condmon.llm import decontam
from condmon.llm.queries import queries

from .conftest import SF_SMALL

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        p = words(t)
        for win in {tuple(p[i : i + 10]) for i in range(max(1, len(p) - 9))} if p else ():
            for s in range(len(w) - len(win) + 1):
                if tuple(w[s : s + len(win)]) == win:
                    hit.update(range(s, s + len(win)))
                    found.add(str(item))
    ids = sorted(found)
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)


def _row(r):
    return r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]


def test_query_against_brute_force(spark, docs_rows):
    bench = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF_SMALL}/benchmark.parquet").to_pylist()]
    got = {r["doc_id"]: _row(r) for r in queries()["op2_decontaminate"](spark, SF_SMALL).collect()}
    assert got == {r["doc_id"]: brute(r["text"], bench) for r in docs_rows}
    assert any(v[4] for v in got.values())


ITEMS = [
    (1, "a b c d e f g h i j k l"),
    (2, "Short Item"),
    (3, "z"),
    (4, ""),
    (5, None),
    (6, "a a a a a a a a a a a"),
    (7, "b c d e f g h i j k"),
    (7, "b c d e f g h i j k"),
]
TEXTS = [
    None, "", "...", "x a b c d e f g h i j y", "SHORT-item, short", "q z q", "a " * 30, "short", "été short item é",
    "a b c d e f g h i", "x " * 300_000 + "b c d e f g h i j k " + "y " * 300_000,
]


@pytest.mark.parametrize("block", [decontam.BLOCK_WINDOWS, 2])
def test_edge_cases(spark, docs_of, block):
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = docs_of(TEXTS)
    rows = decontam.contamination(docs, bench, block_windows=block).collect()
    got = {r["doc_id"]: (r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), list(r["items"])) for r in rows}
    for i, t in enumerate(TEXTS):
        if i < 10:
            n, hit, k, _, _ = brute(t, ITEMS)
            assert got[i][:2] == (n, hit) and len(got[i][2]) == k
    assert got[10] == (600_010, 10, ["1", "7"])


def test_windows_across_text_parts():
    tables = decontam.search_tables([("1", " ".join("abcdefghij"))])
    size = 1 << 20
    for shift in range(0, 24, 3):
        text = b"x " * ((size - shift) // 2) + b"a b c d e f g h i j" + b" y" * 10
        assert decontam.find_windows(text, tables)[1] == [((size - shift) // 2, (size - shift) // 2 + 10)]


def test_filter_keeps_clean_rows_and_columns(spark, docs_of):
    bench = spark.createDataFrame(ITEMS[:1], "item_id bigint, text string")
    docs = docs_of([None, "clean text", "a b c d e f g h i j"])
    kept = decontam.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 1]


@pytest.mark.parametrize("windows", [2, 5])
def test_blocks_of_the_benchmark_change_nothing(spark, docs_rows, windows):
    """Whole texts, repeated rows and shared columns, whatever the blocks."""
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").orderBy("item_id").limit(3)
    own = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    bench = bench.selectExpr("item_id", "text").union(own)
    rows = [(r["doc_id"], r["text"]) for r in docs_rows[:80]] + list(enumerate(TEXTS[:10], 5000))
    docs = spark.createDataFrame(rows + rows[:5] + rows[-3:] * 2, "doc_id bigint, text string")
    one = decontam.contamination(docs, bench)
    many = decontam.contamination(docs, bench, block_windows=windows * 40)
    assert many.columns == one.columns
    assert sorted(map(str, many.collect())) == sorted(map(str, one.collect()))


def test_filter_with_blocks_writes_no_text(spark, docs_of, tmp_path, monkeypatch):
    """Many blocks: the same rows stay, and what is written is narrow."""
    written = []
    save = decontam.save
    monkeypatch.setattr(decontam, "save", lambda df, name: written.append(df.columns) or save(df, name))
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = docs_of(TEXTS)
    one = decontam.drop_contaminated(docs, bench).select("doc_id").collect()
    monkeypatch.setattr(decontam, "contamination", partial(decontam.contamination, block_windows=2))
    many = decontam.drop_contaminated(docs, bench)
    assert many.columns == docs.columns
    assert sorted(r["doc_id"] for r in many.collect()) == sorted(r["doc_id"] for r in one)
    assert not any({"text", "row"} & set(cols) for cols in written)


def test_empty_tables(spark, docs_of):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert decontam.contamination_report(docs_of([]), bench).count() == 0
    (row,) = decontam.contamination_report(docs_of(["a b"]), bench).collect()
    assert _row(row) == (2, 0, 0, hashlib.sha256(b"").hexdigest(), False)
