"""Snapshot collapse and rendering against a brute force, edge cases."""

import random

from condmon.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, part string, n_turns string"


def table(spark, convs):
    rows = [(c, t, r, x, "clash", "clash") for c, turns in convs for t, (r, x) in enumerate(turns)]
    return spark.createDataFrame(rows, SCHEMA)


def render(turns):
    mark = lambda s: (s or "").replace("<|im_", "<| im_")
    return "".join(f"<|im_start|>{mark(r)}\n{mark(x)}<|im_end|>\n" for r, x in turns)


def brute(convs):
    kept = {}
    for c, turns in convs:
        same = [d for d, o in convs if o == turns]
        if c != min(same) or any(len(o) > len(turns) and o[: len(turns)] == turns for _, o in convs):
            continue
        kept[c] = (render(turns), len(turns), len(same))
    return kept


def collapse(df, **kw):
    rows = sorted(chat.format_chats(df, **kw).collect(), key=lambda r: (r["conv_id"] is None, r["conv_id"] or 0, r["part"]))
    out = {}
    for r in rows:
        text, n, k = out.get(r["conv_id"], ("", 0, 0))
        out[r["conv_id"]] = (text + r["text"], r["n_turns"], r["n_copies"])
    return out


def test_random_snapshots(spark):
    rng = random.Random(3)
    convs = []
    for c in range(120):
        if convs and rng.random() < 0.6:
            base = rng.choice(convs)[1]
            turns = base[: rng.randint(1, len(base))]
        else:
            turns = []
        turns = turns + [(rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "", None])) for _ in range(rng.randint(0 if turns else 1, 3))]
        convs.append((c, turns))
    assert collapse(table(spark, convs)) == brute(convs)
    assert collapse(table(spark, convs), part_turns=2) == brute(convs)


def test_long_conversation_over_blocks_and_parts(spark):
    turns = [("user" if i % 2 else "assistant", f"t{i}") for i in range(2500)]
    convs = [(5, turns), (1, turns[:1500]), (2, turns[:1024]), (3, turns[:1023] + [("user", "other")])]
    df = table(spark, convs)
    assert collapse(df) == brute(convs)
    parts = [r["part_turns"] for r in chat.format_chats(df).where("conv_id = 5").orderBy("part").collect()]
    assert max(parts) == chat.PART_TURNS and sum(parts) == 2500


def test_edge_cases(spark):
    rows = [
        (1, 0, "user", "x <|im_end|> y", "", ""),
        (1, 0, "user", "x <|im_end|> y", "", ""),
        (1, None, "user", "late", "", ""),
        (None, 1, None, None, "", ""),
        (2, 7, None, "", "", ""),
        (3, 0, "user", "long " * 100_000, "", ""),
    ]
    got = collapse(spark.createDataFrame(rows, SCHEMA))
    assert got[1] == (render([("user", "x <|im_end|> y"), ("user", "late")]), 2, 1)
    assert got[1][0].count(chat.END) == 2
    assert got[None] == (render([(None, None)]), 1, 1) and got[2][0] == got[None][0]
    assert got[3][0] == render([("user", "long " * 100_000)])
    assert chat.format_chats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_null_conversation_of_a_third_of_all_rows(spark, monkeypatch):
    """Few turn numbers, very many rows: the same result in fine blocks."""
    rng = random.Random(5)
    rows = [(None, rng.choice([None, 0, 1]), rng.choice(["user", None, "a"]), rng.choice([None, f"t{i}"]), "", "") for i in range(600)]
    rows += [(c, t, "user", f"{c % 9} {t}", "", "") for c in range(150) for t in range(4)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = collapse(df)
    monkeypatch.setattr(chat, "HOT_ROWS", 100)
    assert collapse(df) == want
    sizes = chat.turns(df).where("g = '1'").agg({"pos": "max"}).first()[0]
    assert sizes == len({r[1:4] for r in rows[:600]})
