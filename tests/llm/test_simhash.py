"""SimHash near-duplicates against a brute force, covering guarantee, edge cases."""

import itertools
import random
import re

import pytest
import xxhash

from condmon.llm import simhash
from condmon.llm.components import connected_components
from condmon.llm.queries import queries

from .conftest import SF_SMALL

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fingerprint(text):
    w = WORD.findall((text or "").translate(LOWER))
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    """Index of the smallest member reachable by links of at most 3 bits."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 3:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in range(len(fps))]


def test_query_against_brute_force(spark, docs_rows):
    rows = sorted(docs_rows, key=lambda r: r["doc_id"])
    fps = [brute_fingerprint(r["text"]) for r in rows]
    comp = brute_components(fps)
    want = {r["doc_id"]: (f"{f:016x}", rows[c]["doc_id"]) for r, f, c in zip(rows, fps, comp, strict=True)}
    got = queries()["op3_simhash_dedup"](spark, SF_SMALL).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == want
    assert len(set(comp)) < len(rows)


def test_masks_cover_radius_3():
    masks = simhash.cover_masks(list(range(64)))
    for bits in itertools.combinations(range(64), 3):
        diff = sum(1 << b for b in bits)
        assert any(m & diff == 0 for m in masks)


def test_refined_masks_make_progress():
    for n in range(7, 40):
        free = list(range(n))
        assert all(m for m in simhash.cover_masks(free))


def test_refined_masks_cover_inside_a_bucket():
    rng = random.Random(1)
    for m in simhash.cover_masks(list(range(64)))[:4]:
        free = [p for p in range(64) if not m >> p & 1]
        finer = simhash.refined_masks(m)
        assert all(f & m == m for f in finer)
        for _ in range(300):
            diff = sum(1 << b for b in rng.sample(free, 3))
            assert any(f & diff == 0 for f in finer)


@pytest.mark.parametrize("bucket", [64, 512])
def test_links_with_refined_buckets(spark, bucket):
    """A large group of near fingerprints gives the same components however
    small the directly compared buckets are."""
    rng = random.Random(7)
    base = rng.getrandbits(64)
    fps, near = {base}, [base]
    while len(fps) < 400:
        x = rng.choice(near)
        for b in rng.sample(range(64), rng.randint(1, 2)):
            x ^= 1 << b
        fps.add(x)
        near.append(x)
    fps |= {rng.getrandbits(64) for _ in range(40)}
    fps = sorted(fps)
    df = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp bigint")
    roots = {r["node"]: r["root"] for r in connected_components(simhash.links(df, bucket=bucket)).collect()}
    got = [roots.get(simhash._signed(f), simhash._signed(f)) for f in fps]
    comp = brute_components(fps)
    pairs = set(zip(comp, got, strict=True))
    assert len(pairs) == len(set(comp)) == len(set(got))


def test_edge_cases(docs_of):
    long = " ".join(f"w{i % 977}" for i in range(400_000))
    texts = [None, "", " \n", "one", "one two", "one two three", "ONE two Three", long, long, "é à ü", "same row"]
    got = simhash.near_duplicates(docs_of(texts, ids=[0, 1, 2, 3, 4, 5, 6, 7, 8, None, 10])).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(texts)
    assert {by[i]["fingerprint"] for i in (0, 1, 2)} == {"0" * 16} and by[2]["component_id"] == 0
    assert by[6]["component_id"] == 5 and by[8]["component_id"] == 7
    assert by[None]["component_id"] is None
    for i, t in enumerate(texts[:9]):
        assert by[i]["fingerprint"] == f"{brute_fingerprint(t):016x}"


def test_repeated_rows_and_kept_columns(docs_of):
    docs = docs_of(["a b c d", "a b c d", "x y z", None], ids=[3, 3, 1, None])
    assert [r["component_id"] for r in simhash.near_duplicates(docs).orderBy("doc_id").collect()] == [None, 1, 3, 3]
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [(False, 1), (False, 3), (True, 0)]


def test_refinement_in_tasks_equals_the_masks(spark):
    masks = [simhash._signed(m) for m in simhash.cover_masks(list(range(64)))[:3]]
    rows = [(simhash._signed(fp), masks[i % 3]) for i, fp in enumerate([0, 1, 2**63, 2**64 - 1, 5, 5])]
    got = simhash._refined(spark.createDataFrame(rows, "fp bigint, mask bigint")).collect()
    want = [(fp, simhash._signed(m)) for fp, mask in rows for m in simhash.refined_masks(simhash._unsigned(mask))]
    assert sorted(map(tuple, got)) == sorted(want)
    none = spark.createDataFrame([], "fp bigint, mask bigint")
    assert simhash._refined(none).count() == 0


def test_a_row_repeated_very_often_stays_once(spark):
    """A third of the table is one row; it is cut before the shuffle."""
    hot = spark.range(3000).selectExpr("7L AS doc_id", "'one hot text that repeats' AS text", "map('k', 1) AS extra")
    rest = spark.range(6000).selectExpr(
        "id + 100 AS doc_id", "concat(md5(string(id)), ' ', md5(string(id + 1)), ' ', md5(string(-id))) AS text",
        "map('k', 2) AS extra",
    )
    kept = simhash.drop_near_duplicates(hot.union(rest))
    assert kept.where("doc_id = 7").count() == 1 and kept.columns == ["doc_id", "text", "extra"]
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_empty_table(docs_of):
    assert simhash.near_duplicates(docs_of([])).count() == 0
    assert simhash.drop_near_duplicates(docs_of([])).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(500, 501), (7, 7)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, 501: 500}
