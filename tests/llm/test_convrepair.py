"""The audit program against brute force; repair of conversations; edge cases."""

import hashlib
import itertools
import random

import pytest

from condmon.llm import auditdp as A
from condmon.llm import convrepair as C

DDL = "conv_id bigint, turn bigint, role string, text string, audit string, g string"


def plain(rows):
    """(cost, audit, lines) with whole scripts as strings, row by row;
    rows: (role, text, fault)."""
    best = {0: (0, "", [])}

    def relax():
        for s in (0, 1, 3, 2):
            if s in best:
                c, a, r = best[s]
                role, t = A.WANTED[s]
                best[t] = min(best.get(t, (10**9,)), (c + 3, a + "I", [*r, f"{role}:"]))

    relax()
    for role, text, fault in rows:
        old, new = best, {}
        extra = 3 * (fault == "truncated")
        for s, (c, a, r) in old.items():
            options = [(s, (c + 4, a + "D", r))]
            if fault not in ("blank", "duplicate"):
                if (s, role[:1]) in A.NEXT:
                    options.append((A.NEXT[s, role[:1]], (c + extra, a + "K", [*r, f"{role}:{text}"])))
                want, t = A.WANTED[s]
                options.append((t, (c + 3 + extra, a + "R", [*r, f"{want}:{text}"])))
            for t, o in options:
                new[t] = min(new.get(t, (10**9,)), o)
        best = new
        relax()
    return min(best[s] for s in (0, 3) if s in best)


def fault_of(seen, role, text):
    t = text.strip(C.SPACE)
    out = "blank" if not t else "duplicate" if (role, text) in seen else None if t[-1] in C.ENDS else "truncated"
    seen.add((role, text))
    return out


def brute(rows):
    """rows: (conv_id, turn, role, text) after damage -> report per conv_id"""
    out = {}
    key = lambda r: (r[0] is None, r[0] or 0)
    for _, group in itertools.groupby(sorted(rows, key=key), key=key):
        group = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in group]
        group.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen = set()
        faults = [fault_of(seen, r, x) for _, _, r, x in group]
        cost, audit, lines = plain([(r, x, f) for (_, _, r, x), f in zip(group, faults, strict=True)])
        turns = [t for _, t, _, _ in group if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        n = [faults.count(f) for f in C.FAULTS]
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(group))
        out[group[0][0]] = (gaps, *n, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def report(df):
    names = ("gaps", *C.FAULTS, "illegal", "cost", "audit", "repaired_sha256")
    rows = df.collect()
    assert len(rows) == len({r["conv_id"] for r in rows})
    return {r["conv_id"]: tuple(r[n] for n in names) for r in rows}


def test_cheapest_script_of_all():
    """Against every script, written out."""

    def every(rows):
        todo, best = [(0, 0, 0, "")], None
        while todo:
            i, s, c, a = todo.pop()
            if best and c > best[0] or c > 14:
                continue
            if i == len(rows) and s in A.ACCEPT:
                best = min(best or (99,), (c, a))
            role, t = A.WANTED[s]
            todo.append((i, t, c + 3, a + "I"))
            if i < len(rows):
                initial, fault = rows[i]
                extra = 3 * (fault == "truncated")
                todo.append((i + 1, s, c + 4, a + "D"))
                if fault not in A.FORCED:
                    if (s, initial) in A.NEXT:
                        todo.append((i + 1, A.NEXT[s, initial], c + extra, a + "K"))
                    todo.append((i + 1, t, c + 3 + extra, a + "R"))
        return best

    kinds = [("s", None), ("u", None), ("a", None), ("t", None), ("u", "truncated"), ("a", "blank")]
    for n in range(4):
        for rows in itertools.product(kinds, repeat=n):
            chain = A.Chain()
            if rows:
                chain.block(A.block_scripts([(i, f, 1) for i, f in rows], True))
            cost, audit, _ = chain.result()
            assert (cost, audit.decode()) == every(rows)
            assert (cost, audit.decode()) == plain([(i, "x", f) for i, f in rows])[:2]


@pytest.mark.parametrize("prime", [A._PRIME, 2, 7])
def test_scripts_compare_by_their_common_prefix(prime):
    """Small primes make every hash collide; the order stays right."""
    rng = random.Random(prime)
    tree = A.Audits(prime)
    nodes = [0]
    for _ in range(400):
        nodes.append(tree.add(rng.choice(nodes[-6:]), bytes(rng.choice(b"DK") for _ in range(rng.randint(0, 4)))))
    for _ in range(3000):
        a, b = rng.choice(nodes), rng.choice(nodes)
        x, y = tree.script(a), tree.script(b)
        assert tree.common(a, b) == A._common(x, y)
        assert tree.less(a, b) == (x < y)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 50])
def test_blocks_chain_to_the_same_script(size):
    rng = random.Random(size)
    for _ in range(60):
        rows = [(rng.choice("suat"), rng.choice([None, None, "truncated", "blank"]), rng.choice([1, 1, 1, 3])) for _ in range(rng.randint(1, 50))]
        chain = A.Chain()
        for k in range(0, len(rows), size):
            chain.block(A.block_scripts(rows[k : k + size], k == 0))
        flat = [x for i, f, n in rows for x in [(i, "x", f)] + [(i, "x", "duplicate")] * (n - 1)]
        cost, audit, _ = chain.result()
        assert (cost, audit.decode()) == plain(flat)[:2]


def test_long_ties_take_linear_time():
    rows = [("u", None, 1), ("a", None, 1)] + [("t", "truncated", 1), ("u", "blank", 1)] * 2000
    (_, _, cost, audit), *_ = [s for s in A.block_scripts(rows, True) if s[1] == 3]
    assert len(audit) >= len(rows) and cost == plain([(i, "x", f) for i, f, _ in rows])[0]


def random_rows(rng, convs):
    texts = ["Yes.", "No", "", " \t", "What?", "Fine!\n", "end ", ". x"]
    return [
        (c, rng.choice([None, *range(8)]), rng.choice(["user", "assistant", "system", "tool", "", None]), rng.choice([*texts, None]))
        for c in convs
        for _ in range(rng.randint(1, 9))
    ]


@pytest.mark.parametrize("block", [2, C.BLOCK_ROWS])
def test_repair_against_brute_force(spark, block):
    rng = random.Random(block)
    rows = random_rows(rng, [None, *range(40)])
    rows += [(100, None, "user", "Again.")] * 40 + [(101, 5, "user", " ")] * 9
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], DDL)
    got = report(C.repair_report(df, df.select("conv_id", "turn", "role", "text"), block))
    assert got == brute(rows)


def test_a_conversation_of_a_third_of_all_rows(spark):
    rng = random.Random(4)
    hot = [(None, rng.choice([None, t]), rng.choice(["user", "assistant"]), f"text {t % 50}" + rng.choice([".", ""])) for t in range(400)]
    rows = hot + random_rows(rng, range(100))
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], DDL)
    assert report(C.repair_report(df, df, 16)) == brute(rows)
    lines, whole = C.repair(df, 16)
    audit = whole.where("g = '1'").first()["audit"]
    mine = lines.where("g = '1'").orderBy("i", "place").collect()
    assert [r["edit"] for r in mine] == [e for e in audit if e != "D"]
    roles = "".join(r["role"][0] for r in mine)
    assert roles.removeprefix("s") == "ua" * (len(roles) // 2)


def test_damage(spark):
    import zlib

    rows = [(c, t, "assistant", "One. Two? x") for c in (None, *range(30)) for t in (None, 0, 1, 2)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], DDL)
    want = []
    for c, t, r, x in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        x = "" if k == 1 else "One Two x" if k == 2 else x
        want += [(c, t, "user" if k == 4 else r, x)] * ((k != 0) + (k == 3))
    got = [tuple(r) for r in C.damage(df).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_edge_cases(spark):
    empty = spark.createDataFrame([], DDL)
    assert C.repair_report(empty, empty).collect() == []
    long = "word " * 400_000 + "end."
    rows = [(1, 0, "user", long), (1, 1, "assistant", long), (2, 0, "user", "gone")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], DDL)
    got = report(C.repair_report(df, df.where("conv_id = 1")))
    assert got[1] == brute(rows[:2])[1] and got[1][-2] == "KK"
    assert got[2] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    wide = [(3, -(1 << 63), "user", "Hi."), (3, (1 << 63) - 1, "assistant", "Ho.")]
    df = spark.createDataFrame([(*r, "x", "y") for r in wide], DDL)
    assert report(C.repair_report(df, df))[3][0] is None
