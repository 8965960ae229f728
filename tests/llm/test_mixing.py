"""Mixing against a brute force of targets and streams, schedule, edge cases."""

import hashlib
import re

import pytest

from condmon.llm import mixing

WORD = re.compile("[^\x20\x09-\x0d]+")


def size(text):
    return len(WORD.findall(text or ""))


def brute_targets(sizes):
    """Resharing round by round, as the contract says."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = [s for s in order if s not in capped]
        rest = total - sum(3 * sizes[s] for s in capped)
        over = [s for s in left if weight[s] * rest / sum(weight[x] for x in left) > 3 * sizes[s]]
        if not over:
            return {
                s: 3 * sizes[s] if s in capped else weight[s] * rest / sum(weight[x] for x in left) for s in order
            }
        capped.update(over)


def brute_taken(docs):
    sizes, streams = {}, {}
    for d, t, s in docs:
        sizes[s] = sizes.get(s, 0) + size(t)
        streams.setdefault(s, []).append((hashlib.md5(f"{mixing.SEED}:{d}".encode()).hexdigest(), d, size(t)))
    taken = {}
    for s, target in brute_targets(sizes).items():
        want = int(target + 0.5)
        for _, d, _ in streams[s]:
            taken[d] = 0
        while want > 0 and sizes[s]:
            for _, d, z in sorted(streams[s]):
                n = min(z, want)
                taken[d] += n
                want -= n
    return taken


def brute_passes(docs):
    """How often each document is kept: whole passes, and the last one if at
    least half of its words are taken."""
    taken = brute_taken(docs)
    return {d: taken[d] // z + (2 * (taken[d] % z) >= z) if (z := size(t)) else 0 for d, t, _ in docs}


def _docs(n_by_source):
    out, d = [], 0
    for s, n in n_by_source.items():
        for i in range(n):
            out.append((d, " ".join(["w"] * ((i * 7) % 23)), s))
            d += 1
    return out


CASES = {
    "hot": {"a": 10, "b": 200, "c": 3, None: 5, "é": 40},
    "one": {"a": 30},
    "capped": {"a": 1, "b": 2, "c": 90, "d": 90},
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("block", [7, 1024])
def test_totals_against_brute_force(docs_of, name, block):
    docs = _docs(CASES[name])
    df = docs_of([t for _, t, _ in docs], ids=[d for d, _, _ in docs], sources=[s for _, _, s in docs])
    rows = mixing.mix_totals(df, block_tokens=block).collect()
    want = brute_taken(docs)
    assert {r["doc_id"]: r["taken"] for r in rows} == want
    sizes = {}
    for _, t, s in docs:
        sizes[s] = sizes.get(s, 0) + size(t)
    targets = brute_targets(sizes)
    source = {d: s for d, _, s in docs}
    for r in rows:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(targets[s])
        assert r["taken"] <= 3 * r["size"]


def test_schedule_interleaves(spark):
    """Every prefix of the mix has each source near its share."""
    targets = spark.createDataFrame(
        [("0a", 50_000, 5, 50_000.0), ("0b", 20_000, 2, 20_000.0), ("0c", 3_000, 1, 9_000.0)],
        "_g string, source_size bigint, weight bigint, target double",
    )
    slots = mixing.schedule(targets, 100).orderBy("place").collect()
    assert len(slots) == len({r["place"] for r in slots}) == 790
    count = {"0a": 0, "0b": 0, "0c": 0}
    for i, r in enumerate(slots, 1):
        count[r["_g"]] += 1
        for g, n in (("0a", 500), ("0b", 200), ("0c", 90)):
            assert abs(count[g] - i * n / 790) < 8
    c = [(r["pass"], r["block"]) for r in slots if r["_g"] == "0c"]
    assert c == [(p, b) for p in range(3) for b in range(30)]


def test_edge_cases(docs_of):
    assert mixing.mix_totals(docs_of([])).count() == 0
    rows = mixing.mix_totals(docs_of([None, "", " "])).collect()
    assert [(r["size"], r["taken"], r["target"]) for r in rows] == [(0, 0, 0.0)] * 3
    docs = docs_of(["a b c", "a b c", None, "x"], ids=[1, 1, None, None], sources=[None, None, "s", "s"])
    rows = mixing.mix_totals(docs).collect()
    assert len(rows) == 4 and sum(r["taken"] for r in rows) == 7


@pytest.mark.parametrize("name", CASES)
def test_mixed_documents_are_whole(docs_of, name):
    docs = _docs(CASES[name])
    df = docs_of([t for _, t, _ in docs], ids=[d for d, _, _ in docs], sources=[s for _, _, s in docs])
    out = mixing.mix_documents(df, block_tokens=64)
    assert out.columns == df.columns
    rows, got = out.collect(), {}
    text = {d: t for d, t, _ in docs}
    for r in rows:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
        assert r["text"] == text[r["doc_id"]]
    assert got == {d: n for d, n in brute_passes(docs).items() if n}
    targets, largest = brute_targets({s: sum(size(t) for _, t, x in docs if x == s) for _, _, s in docs}), 22
    for s, target in targets.items():
        assert abs(sum(size(text[r["doc_id"]]) for r in rows if r["source"] == s) - target) <= largest
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix_documents(df, block_tokens=64).collect()))


def test_long_document_and_repeated_rows(docs_of):
    long = "\n" + "".join(f"w{i}" + [" ", "\n", "\t "][i % 3] for i in range(30_000))
    docs = docs_of(["a  b", long, None, "c"], sources=["a", "b", "b", "a"])
    assert sorted(r["text"] for r in mixing.mix_documents(docs).collect()) == [long, *["a  b"] * 3, *["c"] * 3]
    # a third of all rows repeat one row
    texts = ["same words here"] * 300 + [f"own text {i}" for i in range(600)]
    ids, sources = [7] * 300 + list(range(100, 700)), ["a"] * 300 + ["b"] * 600
    docs = docs_of(texts, ids=ids, sources=sources)
    taken = mixing.mix_totals(docs).groupBy("doc_id").sum("taken").collect()
    rows = mixing.mix_documents(docs).collect()
    want = {r["doc_id"]: r["sum(taken)"] // 3 for r in taken}
    got = {d: sum(r["doc_id"] == d for r in rows) for d in want}
    assert all(abs(got[d] - want[d]) <= 1 for d in want) and got[7] > 300
    plan = mixing.mix_documents(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "Cartesian" not in plan
