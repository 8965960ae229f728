"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of ``WINDOW`` consecutive words of each benchmark
item (an item with fewer words is one shorter pattern); the symbols are words.
For patterns of one length ``m`` a shift table holds, per block of two words,
how far the search may skip; a block that ends some pattern has shift 0 and
names the bucket of patterns with that suffix, which the first word narrows
down; the remaining candidates are compared word by word.

Scale: one scan of the documents without a shuffle.  The benchmark is the
query set: its windows are counted first and searched in blocks of at most
``BLOCK_WINDOWS`` windows, each broadcast on its own, so a task never holds
more than one block.  With several blocks there is one scan per block, which
writes only its hits, once per distinct text; they are joined to the documents
by the text's digest, so no text is rewritten.  Texts are searched in parts that
overlap by a window.

Words: maximal runs of ``0-9``, ``a-z`` and all characters above ASCII, after
lower-casing ``A-Z``.  Defined cases: NULL and wordless texts have no words
and no hits; wordless items match nothing; a NULL ``item_id`` counts as the
empty id; repeated items count once; an empty benchmark or an empty table is
allowed; repeated rows are judged alike; other columns are ignored
(``contamination``) or kept (``drop_contaminated``).
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from condmon.llm.common import ascii_lower, map_texts, pieces, save

WINDOW = 10
#: Windows that one pass over the documents searches for.
BLOCK_WINDOWS = 100_000
WORDS = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
SPANS, ITEMS = "array<struct<start:bigint,end:bigint>>", "array<string>"
_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item, words`` (space-joined) of every pattern, once per item."""
    words = F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(WORDS), F.lit(0))
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words.alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    return (
        items.where(F.size("w") > 0)
        .select("item", "w", F.explode(starts).alias("s"))
        .select("item", F.array_join(F.expr(f"slice(w, s, {window})"), " ").alias("words"))
        .distinct()
    )


class WuManber:
    """Search tables for patterns (tuples of words) of one length."""

    def __init__(self, patterns: dict[tuple[bytes, ...], Sequence[str]]):
        self.m = len(next(iter(patterns)))
        self.block = min(2, self.m)
        self.skip = self.m - self.block + 1
        self.shift: dict = {}
        self.bucket: dict = {}
        for p in patterns:
            for j in range(self.skip):
                key = p[j : j + self.block]
                self.shift[key] = min(self.shift.get(key, self.skip), self.skip - 1 - j)
            self.bucket.setdefault(p[-self.block :], {}).setdefault(p[0], []).append((p, patterns[p]))

    def search(self, words: list[bytes], first: int):
        """(start, items) of all occurrences that end at ``first`` or later."""
        m, b, shift, skip, bucket = self.m, self.block, self.shift, self.skip, self.bucket
        end, n = max(m - 1, first), len(words)
        while end < n:
            key = (words[end - 1], words[end]) if b == 2 else (words[end],)
            s = shift.get(key, skip)
            if s:
                end += s
                continue
            start = end - m + 1
            for pattern, items in bucket[key].get(words[start], ()):
                if tuple(words[start : end + 1]) == pattern:
                    yield start, items
            end += 1


def search_tables(windows: Sequence[tuple[str, str]]) -> list[WuManber]:
    by_length: dict[int, dict] = {}
    for item, words in windows:
        p = tuple(words.encode().split(b" "))
        by_length.setdefault(len(p), {}).setdefault(p, []).append(item)
    return [WuManber(by_length[m]) for m in sorted(by_length)]


def find_windows(text: bytes | None, tables: Sequence[WuManber]):
    """Number of words, merged hit spans (start, end) in words, item ids."""
    if not text:
        return 0, [], []
    keep = max((t.m for t in tables), default=1) - 1
    spans: list[tuple[int, int]] = []
    items: set[str] = set()
    tail: list[bytes] = []
    base = 0  # position of tail[0]
    for part in pieces(text.lower()):
        words = tail + _WORDS.findall(part)
        for t in tables:
            for start, found in t.search(words, len(tail)):
                spans.append((base + start, base + start + t.m))
                items.update(found)
        drop = max(0, len(words) - keep)
        base, tail = base + drop, words[drop:]
    return base + len(tail), merge(spans), sorted(items)


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _search(docs: DataFrame, windows: list, keep: Sequence[str]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(windows)

    def make():
        tables = search_tables(shared.value)

        def fn(texts):
            found = [find_windows(t, tables) for t in texts]
            return [
                [x[0] for x in found],
                [[{"start": s, "end": e} for s, e in x[1]] for x in found],
                [x[2] for x in found],
            ]

        return fn

    fields = [("n_words", "bigint"), ("spans", SPANS), ("items", ITEMS)]
    return map_texts(docs, "text", keep, fields, make)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: Sequence[str] = ("doc_id",),
    window: int = WINDOW,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """``keep`` columns, ``n_words``, ``spans`` (merged word spans of the
    hits) and ``items`` (sorted ids of the items found) per document."""
    patterns = save(item_windows(benchmark, window), "bench-windows")
    blocks = max(1, -(-patterns.count() // block_windows))
    if blocks == 1:
        return _search(docs, [tuple(r) for r in patterns.collect()], keep)
    patterns = save(patterns.withColumn("b", F.pmod(F.xxhash64("item", "words"), F.lit(blocks))), "bench-blocks")

    cols = dict.fromkeys([*keep, "text"])
    rows = docs.select(*cols, F.sha2("text", 256).alias("_digest"))
    hits = []
    for b in range(blocks):
        some = patterns.where(F.col("b") == b).select("item", "words")
        hits.append(_hits(_search(rows, [tuple(r) for r in some.collect()], ["_digest"])))
    found = save(_merged(hits), "bench-found")
    n_words = F.size(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(WORDS), F.lit(0)))
    out = rows.select(*keep, "_digest", F.coalesce(n_words, F.lit(0)).cast("long").alias("n_words"))
    return out.join(found, "_digest", "left").select(
        *keep, "n_words", *[F.coalesce(c, F.expr("array()").cast(t)).alias(c) for c, t in (("spans", SPANS), ("items", ITEMS))]
    )


def _hits(found: DataFrame) -> DataFrame:
    """``_digest, spans, items`` of the texts with a hit, written once per
    distinct text: equal texts have equal hits, so any row stands for all."""
    some = found.where(F.size("spans") > 0)
    return save(some.groupBy("_digest").agg(F.first("spans").alias("spans"), F.first("items").alias("items")), "bench-hits")


def _merged(hits: Sequence[DataFrame]) -> DataFrame:
    """The hits of all blocks, one row per text; a group has at most one row
    of each block."""
    rows = reduce(DataFrame.union, hits).groupBy("_digest")
    lists = rows.agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            spans = [
                [{"start": s, "end": e} for s, e in merge([(x["start"], x["end"]) for x in row])]
                for row in batch.column(1).to_pylist()
            ]
            items = [sorted(set(row)) for row in batch.column(2).to_pylist()]
            types = batch.schema.types
            cols = [batch.column(0), pa.array(spans, types[1]), pa.array(items, types[2])]
            yield pa.RecordBatch.from_arrays(cols, names=["_digest", "spans", "items"])

    return lists.mapInArrow(run, f"_digest string, spans {SPANS}, items {ITEMS}")


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans``."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return contamination(docs, benchmark).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        "spans",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that contain a benchmark window."""
    rows = docs.select(F.struct("*").alias("row"), "text")
    return contamination(rows, benchmark, keep=("row",)).where(F.size("spans") == 0).select("row.*")
