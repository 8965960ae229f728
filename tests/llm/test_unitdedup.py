"""Unit dedup against a brute force, pasted passages, edge cases."""

import random
import re

from condmon.llm import unitdedup as U
from condmon.llm.queries import queries

from .conftest import SF_SMALL


def parts(text):
    """Atoms of a text without dense scripts, read letter by letter: (start,
    end, words, newlines before it) of those that hold a word."""
    assert not U._DENSE_TEXT.search(text)
    out, at, newlines, i = [], 0, 0, 0

    def close(end):
        nonlocal newlines
        words = re.findall(r"\w+", text[at:end].lower())
        if words:
            out.append((at, end, words, newlines))
            newlines = 0

    while i < len(text):
        if not text[i].isspace():
            i += 1
            continue
        j = i
        while j < len(text) and text[j].isspace():
            j += 1
        gap = text[i:j]
        upper = j < len(text) and (text[j] in UPPER or "\u0391" <= text[j] <= "\u03a9" or "\u0410" <= text[j] <= "\u042f")
        lower = j + 1 < len(text) and re.match(r"\w", text[j + 1]) and not text[j + 1].isdecimal() and text[j + 1] not in UPPER
        if "\n" in gap or i and text[i - 1] in ".!?…" or upper and lower:
            close(i)
            at, newlines = j, max(newlines, gap.count("\n"))
        i = j
    close(len(text))
    return out


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ" + "".join(chr(c) for c in range(0xC0, 0xDF) if c != 0xD7)


def brute(docs, whole=False):
    """docs: (id, text) in rank order -> {id: (atoms, spans, first ids)}"""
    seen, out = {}, {}
    for d, text in docs:
        a = parts(text or "")
        found = {}  # (first atom, end): a whole line, paragraph or text
        for i in range(len(a)):
            n, j = 0, i
            while j < len(a) and n < U.UNIT_WORDS:
                n += len(a[j][2])
                j += 1
            if n >= U.UNIT_WORDS:
                found[i, j] = False
        for least in (1, 2, 10**9) if whole else ():
            heads = [i for i in range(len(a)) if i == 0 or a[i][3] >= least]
            found.update({(i, j): True for i, j in zip(heads, [*heads[1:], len(a)], strict=True)} if a else {})
        cover, always, ids = set(), set(), set()
        for (i, j), is_whole in sorted(found.items(), key=lambda x: (x[0][0], x[1], x[0][1])):
            key = " ".join(w for x in a[i:j] for w in x[2])
            if key in seen:
                cover.update(range(i, j))
                always.update(range(i, j) if is_whole else ())
                ids.add(seen[key])
            else:
                seen[key] = d
        for run in runs(cover):
            if sum(len(a[k][2]) for k in run) >= U.RUN_WORDS:
                always.update(run)
        spans = [(a[run[0]][0], a[run[-1]][1]) for run in runs(always)]
        out[d] = (len(a), spans, sorted(ids) if spans else [])
    return out


def runs(numbers):
    """Maximal runs of consecutive numbers."""
    out = []
    for k in sorted(numbers):
        if out and out[-1][-1] == k - 1:
            out[-1].append(k)
        else:
            out.append([k])
    return out


def collect(df):
    return {r["doc_id"]: (r["n_atoms"], [tuple(s) for s in r["spans"]], list(r["first_ids"])) for r in df.collect()}


def test_query_against_brute_force(spark, docs_rows):
    rows = sorted(docs_rows, key=lambda r: r["doc_id"])
    want = brute([(r["doc_id"], r["text"]) for r in rows], whole=True)
    assert collect(queries()["op10_unit_dedup"](spark, SF_SMALL)) == want
    assert sum(bool(spans) for _, spans, _ in want.values()) > 20


def sentence(rng, n):
    w = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n)]
    return " ".join(w).capitalize() + "."


def test_pasted_passages_are_caught_and_clean_texts_left(docs_of):
    rng = random.Random(5)
    clean = [" ".join(sentence(rng, rng.randint(4, 14)) for _ in range(20)) for _ in range(30)]
    passage = " ".join(sentence(rng, rng.randint(5, 12)) for _ in range(8))
    texts = list(clean)
    for i in (3, 9, 17, 25):
        words = texts[i].split(" ")
        words.insert(len(words) // 2 + i, passage)
        texts[i] = " ".join(words)
    rows = {r["doc_id"]: r for r in U.dedup_units(docs_of(texts)).collect()}
    for i, r in rows.items():
        if i in (9, 17, 25):
            cut = "".join(texts[i][s["start"] : s["end"]] for s in r["spans"])
            assert len(cut) > 0.9 * len(passage) and cut in passage
            assert list(r["first_ids"]) == [3] and r["n_removed_chars"] == len(cut)
        else:
            assert r["spans"] == [] and r["text"] == texts[i]


def test_common_short_lines_stay(docs_of):
    rng = random.Random(6)
    line = "All rights reserved by the owner of this page."
    texts = [f"{sentence(rng, 12)}\n{line}\n{sentence(rng, 12)}" for _ in range(20)]
    assert all(r["text"] == texts[r["doc_id"]] for r in U.dedup_units(docs_of(texts)).collect())


def test_edge_cases(docs_of):
    rng = random.Random(8)
    text = " ".join(sentence(rng, 9) for _ in range(5))
    long = " ".join(sentence(rng, 9) for _ in range(20_000))
    docs = docs_of([None, "", "...", text, text, text, long, long], ids=[0, 1, 2, 3, 3, None, 6, 7])
    rows = U.dedup_units(docs).collect()
    assert len(rows) == 8
    assert [r["text"] for r in rows if r["doc_id"] == 3] == [text, text]
    by = {r["doc_id"]: r for r in rows}
    assert by[0]["text"] is None and by[1]["text"] == "" and by[2]["text"] == "..."
    assert by[None]["text"] == "" and list(by[None]["first_ids"]) == [3]
    assert by[6]["text"] == long and by[7]["text"] == ""
    assert U.dedup_units(docs_of([])).count() == 0


def test_whole_lines_and_texts_are_removed_whatever_their_length(docs_of):
    rng = random.Random(9)
    own = [sentence(rng, 12) for _ in range(12)]
    line = "All Rights reserved by the Owner of this page."
    texts = [
        f"{own[0]}\n{line}\n{own[1]}",
        f"{own[2]}\n{line}\n{own[3]}",
        f"{own[4]} {line} {own[5]}",  # inside a line: under RUN_WORDS, stays
        "Two words",
        "two words",
        f"{own[6]}\n\nin two\nlines\n\n{own[7]}",
        f"{own[8]}\n\nin\ntwo lines\n\n{own[9]}",  # a paragraph wrapped anew
        "---",
        "---",
    ]
    got = {r["doc_id"]: r["text"] for r in U.dedup_units(docs_of(texts), whole=True).collect()}
    gone = {1: f"{own[2]}\n{own[3]}", 4: "", 6: f"{own[8]}\n\n{own[9]}"}
    assert got == {**dict(enumerate(texts)), **gone}


def test_scripts_without_spaces(docs_of):
    rng = random.Random(10)
    han = ["".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(30)) + "。" for _ in range(8)]
    short = "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(5))
    texts = [
        han[0] + han[1] + han[2],
        han[3] + han[1] + han[4],  # inside a line, in letters enough for a run
        f"{han[5]}\n{short}\n{han[6]}",
        f"{short}\n{han[7]}",
    ]
    got = {r["doc_id"]: r["text"] for r in U.dedup_units(docs_of(texts), whole=True).collect()}
    assert got == {**dict(enumerate(texts)), 1: han[3] + han[4], 3: han[7]}


def test_query_removes_every_repeated_line_of_the_smallest_tables(spark, docs_rows):
    rows = sorted(docs_rows, key=lambda r: r["doc_id"])
    base = brute([(r["doc_id"], r["text"]) for r in rows])
    assert collect(U.dedup_units(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))) == base
    got = collect(queries()["op10_unit_dedup"](spark, SF_SMALL))
    seen, more = set(), 0
    for r in rows:
        text, spans, at = r["text"] or "", got[r["doc_id"]][1], 0
        assert all(any(s <= x and y <= e for s, e in spans) for x, y in base[r["doc_id"]][1])
        for line in text.split("\n"):
            lo = at + len(line) - len(line.lstrip())
            hi, at = at + len(line.rstrip()), at + len(line) + 1
            key = " ".join(x[3] for x in U.atoms(line))
            if key and key in seen:
                words = [(a[0] + lo, a[1] + lo) for a in U.atoms(line.strip())]
                assert all(any(s <= x and y <= e for s, e in spans) for x, y in words)
                more += not any(s <= lo and hi <= e for s, e in base[r["doc_id"]][1])
            seen.add(key)
    assert more > 50
