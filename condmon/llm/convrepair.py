"""Conversation structure repair by a persistent audit program.

Every conversation gets the cheapest edits that turn its rows into one of the
role pattern ``(system? (user assistant)+)?``: keep, rerole, delete (a must
for blank and repeated rows) and insert, with a charge for truncated rows that
stay.  Of equally cheap edit scripts the ASCII-least audit wins
(``auditdp.py``: scripts share prefixes as linked nodes with binary-lifting
ancestors and rolling hashes; ties go by longest common prefix, verified).

Scale: equal rows of one turn are pre-aggregated to one row with a number of
copies.  Rows are numbered by range partitions (``ordinal_within``), so a
conversation, or a NULL ``conv_id``, that holds a third of the table spreads
over many tasks.  It is cut into blocks of ``BLOCK_ROWS`` distinct rows; each
block finds, for every state it may start in, the best script to every state
it may end in, in a task of its own.  A conversation's blocks are then chained
as a stream of those scripts (no texts), in memory of a few bytes per row, as
its audit is one string anyway.  The chosen scripts go back to their blocks
and become one edit per row, joined to the texts by (conversation, row).  Only
a digest of a whole repaired conversation, which is sequential by its nature,
reads that conversation's texts in one task, as a sorted stream in bounded
memory.  Intermediate tables are written to the shared folder.

Defined cases: a NULL role or text counts as one space, a NULL ``conv_id`` is
one conversation, a NULL ``turn`` comes first; equal turns are ordered by role
and text; repeated rows are copies of one another and only the first may stay;
an empty role fits no state; a conversation without rows has an empty audit;
``gaps`` is NULL where it is no long; an empty table gives no rows; other
columns are ignored, whatever their names.  Texts are moved whole, of any
length, and never held together in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby, islice
from operator import itemgetter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from condmon.llm.auditdp import Chain, block_scripts, edits
from condmon.llm.common import bound_batches, group_key, save
from condmon.operators.ordinal import ordinal_within

#: Distinct rows of one block.
BLOCK_ROWS = 1024
#: Rows of one returned batch.
STREAM_ROWS = 500
#: The characters that are no content, and those that end a text.
SPACE, ENDS = " \t\n\x0b\f\r", ".!?"
FAULTS = ("blank", "duplicate", "truncated")
_COUNTS = (*FAULTS, "illegal")
_LEGAL = ("su", "ua", "au")


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with the faults that their CRC asks for, of 20 remainders: 0 drops
    a row, 1 empties its text, 2 removes sentence ends, 3 repeats the row,
    4 sets role ``user``.  NULL role and text become one space."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), fault.alias("_f"))
    rows = rows.where("_f <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("_f") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_f") == 1, "").when(F.col("_f") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("_f") == 3, 2).otherwise(1))).alias("_copy"),
    )
    return rows.drop("_copy")


def _fault(first: Column) -> Column:
    kept = F.rtrim("text", F.lit(SPACE))
    return (
        F.when(kept == "", "blank")
        .when(~first, "duplicate")
        .when(~F.substring(kept, -1, 1).isin(*ENDS), "truncated")
    )


def numbered(conversations: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Distinct rows ``g`` (conversation key), ``turn, role, text, copies, h,
    i`` (number from 1) and block ``b``, written to the shared folder."""
    space = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    g = group_key(F.col("conv_id").cast("string"))
    rows = conversations.select(g.alias("g"), "turn", space("role"), space("text"))
    rows = rows.groupBy("g", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    rows = rows.withColumn("h", F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256))
    rows = ordinal_within(rows, ["g"], [F.col("turn").asc_nulls_first(), "role", "text"], name="i")
    return save(rows.withColumn("b", F.floor((F.col("i") - 1) / block_rows).cast("long")), "repair-rows")


def _narrow(rows: DataFrame) -> DataFrame:
    """``g, b, i, initial, fault, copies`` per distinct row."""
    repeated = rows.groupBy("g", "h").agg(F.min("i").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    joined = rows.join(repeated, ["g", "h"], "left")
    first = F.coalesce(F.col("first") == F.col("i"), F.lit(True))
    return joined.select(
        "g", "b", "i", F.substring("role", 1, 1).alias("initial"), _fault(first).alias("fault"), "copies"
    )


def _sorted(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Rows of each ``by`` in one task, in ``order``, as a stream."""
    bound_batches(df.sparkSession)
    return df.repartition(*by).sortWithinPartitions(*by, *order)


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True)


def _stream(df: DataFrame, fn, ddl: str) -> DataFrame:
    """``fn`` over the rows of each task in order, as an iterator of tuples."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(T.StructType.fromDDL(ddl))

    def run(batches):
        import pyarrow as pa

        rows = fn(_rows(batches))
        while part := list(islice(rows, STREAM_ROWS)):
            cols = [pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)]
            yield pa.RecordBatch.from_arrays(cols, schema=schema)

    return df.mapInArrow(run, ddl)


_BLOCK = "g string, b bigint, head string, tail string, blank bigint, duplicate bigint, truncated bigint, illegal bigint, scripts array<struct<start:int, end:int, cost:bigint, script:binary>>"  # noqa: E501
_PATH = "g string, b bigint, start int, script binary, cost bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint"  # noqa: E501
_EDIT = "g string, i bigint, place int, edit string, as_role string"


def _blocks(rows):
    """Per block its best scripts, fault counts and outer role initials."""
    for (g, b), rows in groupby(rows, key=itemgetter(0, 1)):
        rows = [(initial, fault, copies) for _, _, _, initial, fault, copies in rows]
        n = dict.fromkeys(_COUNTS, 0)
        for initial, fault, copies in rows:
            if fault == "blank":
                n["blank"] += copies
            else:
                n["duplicate"] += copies - 1
                if fault:
                    n[fault] += 1
            n["illegal"] += copies - 1
        n["illegal"] += sum(x[0] + y[0] not in _LEGAL for x, y in zip(rows, rows[1:], strict=False))
        scripts = [dict(zip(("start", "end", "cost", "script"), s, strict=True)) for s in block_scripts(rows, b == 0)]
        yield (g, b, rows[0][0], rows[-1][0], *n.values(), scripts)


def _paths(rows):
    """Per conversation one row with the whole audit (``b`` NULL) and one per
    block with the script chosen for it."""
    for g, blocks in groupby(rows, key=itemgetter(0)):
        chain, n, tail = Chain(), dict.fromkeys(_COUNTS, 0), None
        for _, b, head, last, *counts, scripts in blocks:
            chain.block([(s["start"], s["end"], s["cost"], s["script"]) for s in scripts])
            n = {k: n[k] + c for k, c in zip(n, counts, strict=True)}
            n["illegal"] += tail is not None and tail + head not in _LEGAL
            tail = last
        cost, audit, path = chain.result()
        yield (g, None, None, audit, cost, *n.values())
        yield from ((g, b, start, script, None, None, None, None, None) for b, (start, script) in enumerate(path))


def _edits(rows):
    """One row per edit; each block's script comes before its rows."""
    for (g, _), rows in groupby(rows, key=itemgetter(0, 1)):
        _, _, _, start, script, _, _ = next(rows)
        own = ((i, initial, copies) for _, _, i, _, _, initial, copies in rows)
        for i, place, edit, role in edits(script, start, own):
            yield (g, i or 0, place, edit, role)


def audits(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of ``numbered`` rows: per conversation ``g, cost, audit`` and the fault
    counts; and ``g, i, place, edit, as_role`` per edit (of a row and its
    copies, the first's)."""
    narrow = save(_narrow(rows), "repair-narrow")
    blocks = _stream(_sorted(narrow, ["g", "b"], ["i"]), _blocks, _BLOCK)
    paths = save(_stream(_sorted(blocks, ["g"], ["b"]), _paths, _PATH), "repair-paths")
    none = lambda kind: F.lit(None).cast(kind)
    scripts = paths.where("b IS NOT NULL").select(
        "g", "b", F.lit(0).cast("long").alias("i"), "start", "script", none("string").alias("initial"), none("long").alias("copies")
    )
    own = narrow.select("g", "b", "i", none("int").alias("start"), none("binary").alias("script"), "initial", "copies")
    steps = _stream(_sorted(scripts.unionByName(own), ["g", "b"], ["i"]), _edits, _EDIT)
    whole = paths.where("b IS NULL").select("g", "cost", F.col("script").cast("string").alias("audit"), *_COUNTS)
    return whole, steps


def repaired_rows(rows: DataFrame, steps: DataFrame) -> DataFrame:
    """``g, i, place, edit, turn, role, text`` of the rows that stay or are
    inserted; ``(i, place)`` is their order in the conversation."""
    stay = steps.where("edit IN ('K', 'R')").join(rows.select("g", "i", "turn", "role", "text"), ["g", "i"])
    stay = stay.select("g", "i", "place", "edit", "turn", F.coalesce("as_role", "role").alias("role"), "text")
    new = steps.where("edit = 'I'").select(
        "g", "i", "place", "edit", F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"),
        F.col("as_role").alias("role"), F.lit("").alias("text"),
    )
    return stay.unionByName(new)


def _digests(rows):
    for g, lines in groupby(rows, key=itemgetter(0)):
        sha, first = hashlib.sha256(), True
        for _, _, _, role, text in lines:
            sha.update(f"{'' if first else chr(10)}{role}:{text}".encode())
            first = False
        yield (g, sha.hexdigest())


def repair(conversations: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """The repaired conversations (``repaired_rows``) and, per conversation
    key ``g`` that has rows, ``gaps``, the counts, ``cost`` and ``audit``."""
    rows = numbered(conversations, block_rows)
    whole, steps = audits(rows)
    per_turn = rows.select("g", "turn").distinct().groupBy("g")
    turns = per_turn.agg(F.min("turn").alias("lo"), F.max("turn").alias("hi"), F.count("turn").alias("n"))
    gaps = F.expr("CASE WHEN n = 0 THEN 0L ELSE try_subtract(try_add(try_subtract(hi, lo), 1L), n) END")
    return repaired_rows(rows, steps), whole.join(turns.select("g", gaps.cast("long").alias("gaps")), "g")


def repair_report(original: DataFrame, damaged: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per conversation of ``original`` on the repair of its rows in
    ``damaged``; the digest is of ``role:text`` lines."""
    lines, report = repair(damaged, block_rows)
    lines = _sorted(lines.select("g", "i", "place", "role", "text"), ["g"], ["i", "place"])
    digests = _stream(lines, _digests, "g string, repaired_sha256 string")
    ids = original.select(group_key(F.col("conv_id").cast("string")).alias("g"), "conv_id").distinct()
    found = ids.join(report, "g", "left").join(digests, "g", "left")
    here = F.col("audit").isNotNull()
    zero = lambda c: F.when(here, F.col(c)).otherwise(F.lit(0)).cast("long").alias(c)
    return found.select(
        "conv_id",
        *map(zero, ("gaps", *_COUNTS, "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
