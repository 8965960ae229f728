"""Line dedup against a brute force over all windows, and edge cases."""

import random
import re
import time

import pytest

from condmon.llm import linededup
from condmon.llm.queries import queries

SPACE = " \t\n\r\x0b\x0c"


def brute(docs, w):
    """docs: (id, text) in order of rank; -> {id: (n_lines, removed, text)}"""
    seen, out = set(), {}
    for d, text in docs:
        lines = (text or "").split("\n")
        at = [i for i, x in enumerate(lines) if x.strip(SPACE)]
        gone = set()
        for s in range(len(at) - w + 1):
            key = tuple(lines[i].strip(SPACE) for i in at[s : s + w])
            if key in seen:
                gone.update(at[s : s + w])
            seen.add(key)
        left = "\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text
        out[d] = (len(at), ",".join(map(str, sorted(gone))), left)
    return out


def brute_words(docs, least):
    """The same with windows of at least ``least`` words."""
    seen, out = set(), {}
    for d, text in docs:
        lines = (text or "").split("\n")
        at = [i for i, x in enumerate(lines) if x.strip(SPACE)]
        size = [max(len(re.findall(r"[^\x20\x09-\x0D]+", lines[i])), len(lines[i].strip(SPACE)) // 8) for i in at]
        wins = [(s, e) for s in range(len(at)) for e in range(s + 1, len(at) + 1) if sum(size[s:e]) >= least > sum(size[s : e - 1])]
        gone = set()
        for s, e in wins or ([(0, len(at))] if at else []):
            key = tuple(lines[i].strip(SPACE) for i in at[s:e])
            if key in seen:
                gone.update(at[s:e])
            seen.add(key)
        left = "\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text
        out[d] = (len(at), ",".join(map(str, sorted(gone))), left)
    return out


def collect(df, **kw):
    rows = linededup.dedup_lines(df, **kw).collect()
    for r in rows:
        assert r["n_removed"] == len([x for x in r["removed_lines"].split(",") if x])
    return {r["doc_id"]: (r["n_lines"], r["removed_lines"], r["text"]) for r in rows}


@pytest.mark.parametrize("window", [1, 2, 3, 5])
def test_random_documents(docs_of, window):
    rng = random.Random(window)
    runs = [[rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(rng.randint(3, 7))] for _ in range(6)]
    texts = []
    for _ in range(80):
        lines = []
        for _ in range(rng.randint(0, 4)):
            lines += rng.choice(runs) if rng.random() < 0.7 else [rng.choice("abcdefghijklmnop")]
            lines += rng.choice([[], [""], ["  "], ["x" * rng.randint(1, 9)]])
        texts.append("\n".join(rng.choice(["", " ", "\t"]) + x for x in lines))
    assert collect(docs_of(texts), window=window) == brute(list(enumerate(texts)), window)


@pytest.mark.parametrize("least", [1, 4, linededup.WORDS])
def test_windows_in_words(docs_of, least):
    rng = random.Random(least)
    line = lambda: " ".join(rng.choice("abcdefg") for _ in range(rng.choice([1, 2, 3, 9])))
    runs = [[line() for _ in range(rng.randint(1, 7))] for _ in range(6)] + [["漢字" * 40]]
    texts = []
    for _ in range(80):
        lines = []
        for _ in range(rng.randint(0, 4)):
            lines += rng.choice(runs) if rng.random() < 0.7 else [line()]
            lines += rng.choice([[], [""], ["  "]])
        texts.append("\n".join(rng.choice(["", " ", "\t"]) + x for x in lines))
    assert collect(docs_of(texts), words=least) == brute_words(list(enumerate(texts)), least)


def test_repeated_lines_of_a_long_text_take_linear_time(docs_of):
    def seconds(texts):
        start = time.time()
        rows = linededup.dedup_lines(docs_of(texts), words=linededup.WORDS).collect()
        return time.time() - start, rows

    same = "\n".join(f"this line of eight words has number {i % 10}" for i in range(80_000))
    other = "\n".join(f"this line of eight words has number {i}" for i in range(80_000))
    seconds([other[:1000]])
    alone, _ = seconds([other])
    repeated, rows = seconds([same])
    assert rows[0]["n_removed"] == 79_990 and rows[0]["text"].count("\n") == 9
    assert repeated < 2 * alone + 2


def test_edge_cases(docs_of):
    run = "one\ntwo\nthree"
    big = "\n".join(f"line {i}" for i in range(20_000))
    texts = [None, "", "\n\n", run, f"x\n{run}\ny", "one\ntwo", "same\n" * 9, big, "z\n" + big, run]
    got = collect(docs_of(texts, ids=[0, 1, 2, 3, 4, 5, 6, 7, 8, None]))
    want = brute(list(zip([0, 1, 2, 3, 4, 5, 6, 7, 8, None], texts, strict=True)), 3)
    assert got == want and got[4][2] == "x\ny" and got[None][2] == ""


def test_repeated_rows_are_one_document(docs_of):
    docs = docs_of(["a\nb\nc", "a\nb\nc", "a\nb\nc"], ids=[1, 1, 2])
    rows = sorted((r["doc_id"], r["n_removed"]) for r in linededup.dedup_lines(docs).collect())
    assert rows == [(1, 0), (1, 0), (2, 3)]


def test_empty_table(docs_of):
    assert linededup.dedup_lines(docs_of([])).count() == 0


def test_no_python_in_the_plan(docs_of):
    plan = linededup.dedup_lines(docs_of(["a\nb"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan


def test_query_removes_long_lines_and_short_copies(spark, docs_of, tmp_path):
    line = " ".join(f"word{i}" for i in range(60))
    list_of = "one\ntwo three\nfour five six\nseven eight nine"
    texts = [
        f"a\n{line}\nb", f"c\n{line}\nd", "one line", "one line", f"e\n{line}\nb\nf",
        f"x y z\n{list_of}\nz y x", f"{list_of}\nown end", "yes\nno", "yes\nwell",
    ]
    docs_of(texts).write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r["doc_id"]: r["text"] for r in queries()["op4_line_dedup"](spark, str(tmp_path)).collect()}
    gone = {1: "c\nd", 3: "", 4: "e\nb\nf", 6: "own end"}
    assert rows == {**dict(enumerate(texts)), **gone}
