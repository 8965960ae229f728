"""Mixing sources to target weights with a low-discrepancy schedule.

1. *Targets.*  Source weights share the wanted number of words; a source
   stops at ``MAX_PASSES`` times its own words and its excess is reshared by
   weight until no target is above that.
2. *Blocks.*  The documents of a source, in a seeded-shuffled order, form one
   stream of words that is cut into equal-token blocks; a target beyond the
   source's size passes over the stream again.
3. *Schedule.*  A source needs a known number of block slots.  The cells
   ``0..slots-1`` are dealt to the sources as consecutive intervals (the
   cumulative weights); the van der Corput radical inverse of a cell is its
   place in the mix.  The first ``2^m`` van der Corput points visit every cell
   once, so each source gets exactly its slots, evenly interleaved.
4. *Join.*  Slots are ranked per source by place; slot ``r`` takes block
   ``r mod blocks`` in pass ``r div blocks``; the last slot of a source is cut
   so that its words meet the target to the word.

Scale: prefix sums and ranks are taken inside hash buckets of a source, with
offsets from one pre-aggregated row per bucket; the join key is (source,
block) with at most ``MAX_PASSES`` slots and ``BLOCK_TOKENS`` documents per
key, so a source holding a third of all words is spread evenly.  Per-source
tables have one row per source.  DataFrame functions only.

``mix_documents`` gives whole documents; their words come near the targets.

Defined cases: NULL or wordless texts have size 0 and are never taken; a NULL
source is a source of its own, last in order; very long texts span many
blocks; repeated rows are separate rows; a table without words takes nothing; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from condmon.llm.common import (
    bucket_bits,
    first_of,
    group_key,
    keyed_rows,
    row_keys,
    running_totals,
    save,
    shuffle_key,
    top_bits,
    word_count,
)

WEIGHTS = (5, 2, 1)
MAX_PASSES = 3
BLOCK_TOKENS = 1024
SEED = "mix-1"
#: Cells of a source that one row of the interval table stands for.
CELL_CHUNK = 4096
#: Copies of a mixed document that one row stands for.
COPY_CHUNK = 4096


def sized(docs: DataFrame, seed: str = SEED, keep=()) -> DataFrame:
    """Narrow table ``_rid, doc_id, size, _g (source key), _k (shuffle key)``
    and the columns ``keep``."""
    return save(
        docs.select(
            F.monotonically_increasing_id().alias("_rid"),
            "doc_id",
            word_count(F.col("text")).alias("size"),
            group_key(F.col("source")).alias("_g"),
            shuffle_key(seed, F.col("doc_id")).alias("_k"),
            *keep,
        ),
        "mix-sizes",
    )


def source_targets(rows: DataFrame, weights=WEIGHTS, max_passes: int = MAX_PASSES, share: float = 1.0) -> DataFrame:
    """``_g, source_size, weight, target`` per source.

    The water level ``level`` (target = weight * level for sources that are
    not capped) rises from round to round as capped sources hand on their
    excess; only two sums per round reach the driver.
    """
    per = rows.groupBy("_g").agg(F.sum("size").alias("source_size"))
    nth = F.row_number().over(Window.orderBy("_g")) - 1  # one row per source
    cycle = F.array(*[F.lit(w) for w in weights])
    per = save(per.withColumn("weight", F.get(cycle, (nth % len(weights)).cast("int")).cast("long")), "mix-sources")
    total = per.agg(F.sum("source_size")).first()[0] or 0
    goal, level, capped = total * share, 0.0, -1
    cap = F.col("source_size") * max_passes
    while True:
        full = (F.col("weight") * F.lit(level) > cap) if capped >= 0 else F.lit(False)
        taken, left, n = per.agg(
            F.sum(F.when(full, cap).otherwise(F.lit(0))),
            F.sum(F.when(full, F.lit(0)).otherwise(F.col("weight"))),
            F.sum(full.cast("int")),
        ).first()
        if not left or n == capped:
            break
        capped, level = n, (goal - taken) / left
    return per.withColumn("target", F.least(F.col("weight") * F.lit(float(level)), cap.cast("double")))


def schedule(targets: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Slots ``_g, place, pass, block, cut``: ``place`` orders the mix, words
    of the block from position ``cut`` of the source's stream on are not
    taken."""
    b = f"{block_tokens}L"
    per = (
        targets.withColumn("_want", F.floor(F.col("target") + 0.5).cast("long"))
        .where("source_size > 0 AND _want > 0")
        .withColumn("_blocks", F.expr(f"(source_size + {b} - 1) div {b}"))
        .withColumn("_full", F.expr("_want div source_size"))
        .withColumn("_rest", F.expr("_want % source_size"))
        .withColumn("_slots", F.expr(f"_full * _blocks + (_rest + {b} - 1) div {b}"))
    )
    before = Window.orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    per = save(
        per.withColumn("_first", F.coalesce(F.sum("_slots").over(before), F.lit(0).cast("long"))), "mix-intervals"
    )
    total = per.agg(F.sum("_slots")).first()[0] or 0
    bits = max(1, (max(total, 1) - 1).bit_length())
    # the interval of a source in chunks of cells, then the cells
    chunks = per.select(
        "_g", "_blocks", "_full", "_rest", "source_size", "_first", "_slots",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("_slots") - 1, F.lit(CELL_CHUNK).cast("long"))).alias("_at"),
    )
    cells = chunks.repartition("_g", "_at").select(
        "_g", "_blocks", "_full", "_rest", "source_size",
        F.explode(
            F.sequence(F.col("_first") + F.col("_at"), F.col("_first") + F.least(F.col("_at") + CELL_CHUNK, "_slots") - 1)
        ).alias("cell"),
    )
    place = F.conv(F.reverse(F.lpad(F.bin("cell"), bits, "0")), 2, 10).cast("long")
    cells = cells.withColumn("place", place)
    bucket = bucket_bits(total)
    cells = cells.withColumn("_b", F.shiftright("place", max(0, bits - bucket)))
    slots = running_totals(save(cells, "mix-slots"), ["_g"], "_b", ["place"])
    return slots.select(
        "_g",
        "place",
        F.expr("rank div _blocks").alias("pass"),
        F.expr("rank % _blocks").alias("block"),
        F.when(F.expr("rank div _blocks = _full"), F.col("_rest")).otherwise(F.col("source_size")).alias("cut"),
    )


def blocks(rows: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Document pieces ``_rid, _g, block, lo, hi, _from`` : the piece covers
    positions ``lo..hi-1`` of the source's shuffled stream, beginning with word
    ``_from`` of the document."""
    some = rows.where("size > 0")
    bits = bucket_bits(rows.count())
    some = some.withColumn("_b", top_bits(F.col("_k"), bits))
    placed = running_totals(some, ["_g"], "_b", ["_k", "doc_id", "size", "_rid"], ["size"])
    b = f"{block_tokens}L"
    cut = placed.select(
        "_rid", "_g", "size_before", "size",
        F.explode(F.expr(f"sequence(size_before div {b}, (size_before + size - 1) div {b})")).alias("block"),
    )
    lo = F.greatest(F.col("size_before"), F.expr(f"block * {b}"))
    hi = F.least(F.col("size_before") + F.col("size"), F.expr(f"(block + 1) * {b}"))
    return cut.select("_rid", "_g", "block", lo.alias("lo"), hi.alias("hi"), (lo - F.col("size_before")).alias("_from"))


def mix(rows: DataFrame, targets: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The mix: ``place, pass, _rid, from_word, words``, one row per document
    piece of each slot; sort by ``(place, from_word)`` for its order."""
    slots = schedule(targets, block_tokens)
    joined = slots.join(blocks(rows, block_tokens), ["_g", "block"])
    words = F.least("hi", "cut") - F.col("lo")
    return joined.where(words > 0).select(
        "place", "pass", "_rid", F.col("_from").alias("from_word"), words.alias("words")
    )


def mix_totals(docs: DataFrame, seed: str = SEED, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` per document."""
    rows = sized(docs, seed)
    targets = save(source_targets(rows), "mix-targets")
    taken = mix(rows, targets, block_tokens).groupBy("_rid").agg(F.sum("words").alias("taken"))
    return (
        rows.join(targets, "_g")
        .join(taken, "_rid", "left")
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))
    )


def mix_documents(docs: DataFrame, seed: str = SEED, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The mixed documents, whole and with the columns of ``docs``: one row for
    each pass over a document.  The document per source inside which the mix
    meets its target is kept whole if at least half of its words are taken,
    else left out, whichever is nearer to the target."""
    rows = sized(docs, seed, row_keys(docs))
    targets = save(source_targets(rows), "mix-targets")
    passes = mix(rows, targets, block_tokens).groupBy("_rid", "pass").agg(F.sum("words").alias("_words"))
    kept = passes.join(rows.select("_rid", "size", "_id", "_th"), "_rid").where("2 * _words >= size")
    # rows that repeat each other come out alike: one of them, as often as all of them are taken
    times = kept.groupBy("_id", "_th").agg(F.count(F.lit(1)).alias("_n"))
    chunks = times.select("_id", "_th", "_n", F.explode(F.expr(f"sequence(0L, (_n - 1) div {COPY_CHUNK})")).alias("_at"))
    chunks = save(
        chunks.select("_id", "_th", F.least(F.lit(COPY_CHUNK), F.expr(f"_n - _at * {COPY_CHUNK}")).alias("_n")), "mix-copies"
    )
    out = first_of(keyed_rows(docs), ["_id", "_th"]).join(chunks, ["_id", "_th"])
    return out.select("row", F.explode(F.expr("sequence(1L, _n)"))).select("row.*")
