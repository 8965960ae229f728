"""SimHash near-duplicate groups by covering locality-sensitive hashing.

Fingerprint: each bit is the majority over the XXH64 hashes (seed 42) of the
text's word shingles, repeats counted.

Links: every bit position gets one of the 15 non-zero vectors of GF(2)^4.
Mask ``v`` keeps the positions whose vector has an odd inner product with
``v``.  The vectors of any three differing positions span at most three
dimensions, so some ``v`` is orthogonal to all of them and its mask skips all
three: a pair within radius 3 agrees on the kept bits of at least one of the
15 masks and meets in that table.

Scale: equal fingerprints are one node (pre-aggregated), so copies cost
nothing.  A bucket of at most ``BUCKET`` fingerprints is compared directly
and gives a spanning forest of its true links, never its pairs.  A larger
bucket is exactly refined: its members go to the 15 masks over the bits that
its own mask leaves free, which again cover radius 3.  Each refinement about
halves the free bits, so after three or four of them a bucket cannot hold more
than ``BUCKET`` (at least 64) distinct fingerprints; nothing is capped.  Hot tables are
sized by a map-side count before any bucket is gathered.  Finer masks follow from a
bucket's own mask, so tasks derive them: no list of masks is broadcast or reaches the driver.

Defined cases: NULL and wordless texts have fingerprint zero and are linked
like any other; repeated rows each get a row with the same component; a
component whose rows all lack a ``doc_id`` has a NULL id; an empty table
gives no rows; other columns are ignored (``near_duplicates``) or kept
(``drop_near_duplicates``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from condmon.llm.common import first_of, gathered, keyed_rows, map_texts, pieces, row_keys, save
from condmon.llm.components import connected_components

SHINGLE = 3
RADIUS = 3
#: Largest bucket that is compared directly; larger ones are refined.
BUCKET = 512
_BITS = 64
#: Shingle hashes that are expanded to bits at once.
_CHUNK = 1 << 16


#: The non-zero vectors, a basis and its sum first: with five positions or
#: more every mask keeps at least one of them.
_VECTORS = sorted(range(1, 16), key=lambda x: (x.bit_count() not in (1, 4), x))


def _vectors(positions: list[int]) -> dict[int, int]:
    return {p: _VECTORS[i % 15] for i, p in enumerate(positions)}


def cover_masks(positions: list[int], kept: int = 0) -> list[int]:
    """15 masks that keep ``kept`` and cover radius 3 over ``positions``."""
    vec = _vectors(positions)
    masks = (kept | sum(1 << p for p, x in vec.items() if (x & v).bit_count() % 2) for v in range(1, 16))
    return list(dict.fromkeys(masks))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _unsigned(x: int) -> int:
    return x & (1 << 64) - 1


def refined_masks(mask: int) -> list[int]:
    return cover_masks([p for p in range(_BITS) if not mask >> p & 1], mask)


def fingerprint_batch(texts: list[bytes | None], shingle: int = SHINGLE):
    """Unsigned 64-bit fingerprints of the texts."""
    import numpy as np
    import xxhash

    h = xxhash.xxh64_intdigest
    ones = np.zeros((len(texts), _BITS), np.int64)
    total = np.zeros(len(texts), np.int64)
    hashes: list[int] = []
    owner: list[tuple[int, int]] = []  # (row, shingles) in the order of hashes

    def flush():
        if not hashes:
            return
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        rows, counts = (np.array(x, np.int64) for x in zip(*owner, strict=True))
        starts = np.cumsum(counts) - counts
        np.add.at(ones, rows, np.add.reduceat(bits, starts, axis=0, dtype=np.int64))
        np.add.at(total, rows, counts)
        hashes.clear()
        owner.clear()

    def add(row, words):
        joined, at, bounds = b" ".join(words), 0, []
        for w in words:
            bounds.append(at)
            at += len(w) + 1
        new = [h(joined[s : e - 1], 42) for s, e in zip(bounds, [*bounds[shingle:], at], strict=False)]
        for k in range(0, len(new), _CHUNK):
            part = new[k : k + _CHUNK]
            hashes.extend(part)
            owner.append((row, len(part)))
            if len(hashes) >= _CHUNK:
                flush()

    for row, text in enumerate(texts):
        if not text:
            continue
        tail: list[bytes] = []
        seen = False
        for part in pieces(text.lower()):
            words = tail + part.split()
            if len(words) >= shingle:
                add(row, words)
                seen, tail = True, words[len(words) - shingle + 1 :]
            else:
                tail = words
        if not seen and tail:
            add(row, tail)
    flush()
    major = (ones * 2 > total[:, None]).astype(np.uint8)
    return np.packbits(major, axis=1, bitorder="little").view("<u8").reshape(-1)


def fingerprints(docs: DataFrame, keep=("doc_id",), shingle: int = SHINGLE) -> DataFrame:
    """``keep`` columns and ``fp`` (the 64 bits as a signed long)."""

    def make():
        import pyarrow as pa

        return lambda texts: [pa.array(fingerprint_batch(texts, shingle).view("<i8"))]

    return map_texts(docs, "text", keep, [("fp", "bigint")], make)


def _forest(lists, radius: int):
    """Spanning forest of the links inside one bucket, as (a, b) pairs."""
    import numpy as np

    out_a, out_b = [], []
    for fps in lists:
        if len(fps) == 2:
            if _unsigned(fps[0] ^ fps[1]).bit_count() <= radius:
                out_a.append(fps[0])
                out_b.append(fps[1])
            continue
        f = np.array(fps, np.int64).view(np.uint64)
        near = np.bitwise_count(f[:, None] ^ f[None, :]) <= radius
        todo = np.ones(len(f), bool)
        while todo.any():
            first = int(todo.argmax())
            front = np.zeros(len(f), bool)
            front[first] = True
            todo[first] = False
            while front.any():
                new = near[front].any(axis=0) & todo
                todo &= ~new
                members = np.flatnonzero(new)
                out_a += [fps[first]] * len(members)
                out_b += [fps[m] for m in members]
                front = new
    return out_a, out_b


def _local_links(lists: DataFrame, radius: int) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            a, b = _forest(batch.column(0).to_pylist(), radius)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return lists.mapInArrow(run, "a bigint, b bigint")


def _refined(members: DataFrame) -> DataFrame:
    """``fp, mask`` of the members of hot buckets under the masks that refine
    their bucket's; a task keeps the refinements of the masks that it meets."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        finer: dict[int, np.ndarray] = {}
        for batch in batches:
            fps, masks = (batch.column(i).to_numpy() for i in (0, 1))
            out = []
            for mask in np.unique(masks).tolist():
                if mask not in finer:
                    finer[mask] = np.array([_signed(m) for m in refined_masks(_unsigned(mask))], np.int64)
                own = fps[masks == mask]
                out.append((np.repeat(own, len(finer[mask])), np.tile(finer[mask], len(own))))
            arrays = [pa.array(np.concatenate(x)) for x in zip(*out, strict=True)] or [pa.array([], pa.int64())] * 2
            yield pa.RecordBatch.from_arrays(arrays, names=["fp", "mask"])

    return members.mapInArrow(run, "fp bigint, mask bigint")


def links(fps: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Edges ``a, b`` between distinct fingerprints ``fps(fp)`` that connect
    exactly the fingerprints joined by links of at most ``radius`` bits."""
    if radius > RADIUS:
        raise ValueError(f"the masks cover a radius of {RADIUS}")
    if bucket < 64:
        raise ValueError("buckets of fewer than 64 fingerprints cannot always be refined")
    n = 15 * fps.count()  # rows of a level of tables
    masks = [_signed(m) for m in cover_masks(list(range(_BITS)))]
    rows = fps.select("fp", F.explode(F.array(*[F.lit(m) for m in masks])).alias("mask"))
    found = None
    while True:
        n = n if found is None else rows.count()
        rows = rows.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = rows.groupBy("mask", "key").agg(
            F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")
        )
        sizes = gathered(save(gathered(sizes.where("n > 1"), n), "simhash-buckets"), n)
        pairs = sizes.where("n = 2").select("a", "b").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
        some = rows.join(sizes.where(f"n > 2 AND n <= {bucket}").select("mask", "key"), ["mask", "key"], "left_semi")
        lists = some.groupBy("mask", "key").agg(F.collect_list("fp").alias("fps")).select("fps")
        edges = save(pairs.union(_local_links(gathered(lists, n), radius)), "simhash-links")
        found = edges if found is None else found.union(edges)
        hot = sizes.where(f"n > {bucket}")
        if hot.isEmpty():
            return found
        members = rows.join(hot.select("mask", "key"), ["mask", "key"], "left_semi").select("fp", "mask")
        rows = save(_refined(members).distinct(), "simhash-finer")


def components_of(fps: DataFrame) -> DataFrame:
    """``fp, root``: the component's smallest fingerprint per distinct ``fp``."""
    distinct = save(gathered(fps.select("fp").distinct(), fps.count()), "simhash-fps")
    roots = connected_components(links(distinct))
    return distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` per row of ``docs(doc_id, text)``."""
    fps = save(fingerprints(docs, shingle=shingle), "simhash-docs")
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    comp = save(components_of(fps).join(classes, "fp"), "simhash-components")
    ids = comp.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return fps.join(comp.select("fp", "root").join(ids, "root"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row of each near-duplicate group of ``docs``: that of the smallest
    ``doc_id`` (NULL last; repeated rows: one of them)."""
    narrow = docs.select("doc_id", "text", *row_keys(docs))
    fps = save(fingerprints(narrow, keep=("doc_id", "_id", "_th"), shingle=shingle), "simhash-docs")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_id", "_th")
    best = fps.groupBy("fp").agg(F.min(rank).alias("best"))
    kept = components_of(fps).join(best, "fp").groupBy("root").agg(F.min("best").alias("best"))
    kept = save(kept.select("best._id", "best._th"), "simhash-kept")
    # repeated rows are cut to one before their shuffle, so a hot one meets no join
    return first_of(keyed_rows(docs), ["_id", "_th"]).join(kept, ["_id", "_th"]).select("row.*")
