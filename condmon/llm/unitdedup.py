"""Substring dedup by hashing of line and paragraph units.

A text is cut into atoms at line ends, after sentence ends and before a
capitalised word, so a passage pasted into other text still begins and ends
at cuts.  A *unit* is the shortest row of consecutive atoms with at least
``UNIT_WORDS`` words; one begins at every atom.  Units are normalised (lower
case, words only) and digested; digests are grouped over all documents, the
occurrence of the smallest ``(doc_id, text hash, position)`` is kept, and
every other one is a repeat.  Atoms covered by repeats form runs; runs of at
least ``RUN_WORDS`` words are removed.  Shorter ones are everyday phrases and
stay.  With ``whole`` (the registered query) whole lines, paragraphs and texts
are units too, whatever their length, and a repeated one is always removed.
Removed spans are given as character offsets of the original text.

In scripts without spaces (Chinese, Japanese, Thai, Lao, Khmer, Burmese) every
letter counts as a word, and texts are also cut after full-width sentence ends
and at white space that follows such a letter.

Scale: one row of a 96-bit digest and its position per unit is shuffled, never
text; groups are reduced to their first occurrence by a map-side minimum and
joined back, so a passage found in a third of all documents is not gathered
anywhere.  Text is shuffled once, to meet its own repeats.

Defined cases: NULL and empty texts have no units and stay as they are; rows
that repeat both ``doc_id`` and text are one document, each copy treated
alike; the same text under another id is a repeat of the smallest id (NULL
last); texts of fewer than ``UNIT_WORDS`` words have no units but whole ones;
lines without a word are no units and go only with removed atoms on both sides;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from condmon.llm.common import bound_batches, save

UNIT_WORDS = 8
RUN_WORDS = 25

#: Letters of scripts without spaces between words.
_DENSE = (
    "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff"
    "\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
)
_STOP = "。！？｡．।။។"
_CLOSE = "”’」』）】》"
_CUT = re.compile(
    r"\s*\n\s*|(?<=[.!?…])\s+|\s+(?=[A-ZÀ-ÖØ-ÞΑ-ΩА-Я][^\W\dA-ZÀ-ÖØ-Þ])"
)
_WORDS = re.compile(r"\w+")
#: The same for texts that hold such a letter or sentence end.
_DENSE_TEXT = re.compile(rf"[{_DENSE}{_STOP}]")
_DENSE_CUT = re.compile(
    rf"{_CUT.pattern}|(?<=[{_DENSE}])\s+"
    rf"|(?<=[{_STOP}])(?![{_STOP}{_CLOSE}])\s*|(?<=[{_STOP}][{_CLOSE}])\s*"
)
_DENSE_WORDS = re.compile(rf"[{_DENSE}]|[^\W{_DENSE}]+")

#: Kinds of units; a unit's code is its first atom times KINDS plus its kind.
KINDS = 4
ROW, LINE, PARAGRAPH, TEXT = range(KINDS)


def atoms(text: str) -> list[tuple[int, int, int, str, int]]:
    """(start, end, words, normalised, begins) of the atoms that hold a word;
    ``begins`` is the largest kind of whole that begins there."""
    dense = not text.isascii() and _DENSE_TEXT.search(text) is not None
    out, at, begins = [], 0, TEXT
    for cut in (_DENSE_CUT if dense else _CUT).finditer(text):
        if cut.start() > at:
            out.append((at, cut.start(), begins))
            begins = ROW
        at = cut.end()
        begins = max(begins, min(cut.group().count("\n"), PARAGRAPH))
    if at < len(text):
        out.append((at, len(text), begins))
    found, begins = [], ROW
    for s, e, b in out:
        part = text[s:e].lower()
        words = _WORDS.findall(part)
        begins = max(begins, b)  # a line may begin with an atom without words
        if words:
            n = (len(_DENSE_WORDS.findall(part)) or 1) if dense else len(words)
            found.append((s, e, n, " ".join(words), begins))
            begins = ROW
    return found


def wholes(a: list[tuple[int, int, int, str, int]]) -> dict[int, int]:
    """End (exclusive) of the whole lines, paragraphs and the text by code;
    one that is the same as a smaller whole is left out."""
    out = {}
    last = [len(a)] * KINDS  # beginning of the next whole of each kind
    for i in range(len(a) - 1, -1, -1):
        least = 0
        for kind in range(LINE, a[i][4] + 1):
            if last[kind] > least:
                least = out[i * KINDS + kind] = last[kind]
            last[kind] = i
    return out


def unit_ends(counts: list[int], least: int = UNIT_WORDS) -> list[int]:
    """End (exclusive) of the unit that begins at each atom, for the atoms
    whose unit is complete."""
    ends, j, have = [], 0, 0
    for i, _ in enumerate(counts):
        while have < least and j < len(counts):
            have += counts[j]
            j += 1
        if have < least:
            break
        ends.append(j)
        have -= counts[i]
    return ends


def units(docs: DataFrame, least: int = UNIT_WORDS, whole: bool = False) -> DataFrame:
    """``doc_id, th, idx, h, c`` for every unit; ``idx`` is its code, ``h, c``
    its digest and ``th`` tells apart different texts under one id."""
    bound_batches(docs.sparkSession)
    src = docs.select("doc_id", F.xxhash64("text").alias("th"), "text").where("text IS NOT NULL")
    id_type = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        digest = xxhash.xxh3_128_intdigest

        def emit(ids, ths, rows, idx, found):
            h = np.array([d >> 64 for d in found], np.uint64).view(np.int64)
            c = np.array([d & 0xFFFFFFFF for d in found], np.uint32).view(np.int32)
            take = pa.array(rows, pa.int64())
            arrays = [ids.take(take), ths.take(take), pa.array(idx, pa.int32()), pa.array(h), pa.array(c)]
            return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "th", "idx", "h", "c"])

        for batch in batches:
            rows, idx, found = [], [], []
            for r, text in enumerate(batch.column(2)):
                a = atoms(text.as_py())
                norm = [x[3] for x in a]
                ends = unit_ends([x[2] for x in a], least)
                spans = wholes(a) if whole else {}
                same = {(code // KINDS, j) for code, j in spans.items()}
                for i, j in enumerate(ends):
                    if (i, j) not in same:
                        spans[i * KINDS + ROW] = j
                for code, j in spans.items():
                    i = code // KINDS
                    found.append(digest(norm[i] if j == i + 1 else " ".join(norm[i:j])))
                rows += [r] * len(spans)
                idx += spans
                if len(found) > 200_000:
                    yield emit(batch.column(0), batch.column(1), rows, idx, found)
                    rows, idx, found = [], [], []
            yield emit(batch.column(0), batch.column(1), rows, idx, found)

    return src.mapInArrow(run, f"doc_id {id_type}, th bigint, idx int, h bigint, c int")


def repeated_units(docs: DataFrame, least: int = UNIT_WORDS, whole: bool = False) -> DataFrame:
    """``doc_id, th, idx, first_id``: units that occur earlier."""
    all_units = save(units(docs, least, whole), "units")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", "idx")
    first = all_units.groupBy("h", "c").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n"))
    # a table of its own, so that the join below has a shuffle on either side
    # and a digest with very many occurrences can be split over tasks
    first = save(first.where("n > 1").select("h", "c", "first"), "unit-firsts")
    same = (
        F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
        & (F.col("th") == F.col("first.th"))
        & (F.col("idx") == F.col("first.idx"))
    )
    return all_units.join(first, ["h", "c"]).where(~same).select(
        "doc_id", "th", "idx", F.col("first.doc_id").alias("first_id")
    )


def removed_spans(text: str, repeats, least: int = UNIT_WORDS, run_words: int = RUN_WORDS):
    """(number of atoms, character spans to remove) of a text, given the codes
    of its repeated units."""
    a = atoms(text)
    ends = unit_ends([x[2] for x in a], least)
    whole = wholes(a) if repeats else {}
    cover, always = bytearray(len(a)), bytearray(len(a))
    for code in repeats:
        i, kind = divmod(code, KINDS)
        j = whole[code] if kind else ends[i]
        cover[i:j] = b"\x01" * (j - i)
        if kind:
            always[i:j] = b"\x01" * (j - i)
    spans, i = [], 0
    while i < len(a):
        j = i
        while j < len(a) and cover[j]:
            j += 1
        if j > i and sum(x[2] for x in a[i:j]) >= run_words:
            always[i:j] = b"\x01" * (j - i)
        i = j + 1 if j == i else j
    i = 0
    while i < len(a):
        j = i
        while j < len(a) and always[j]:
            j += 1
        if j > i:
            spans.append((a[i][0], a[j - 1][1]))
        i = j + 1 if j == i else j
    return len(a), spans


def cut_text(text: str, spans) -> str:
    """``text`` without the spans and the white space that then follows."""
    parts, at = [], 0
    for s, e in spans:
        parts.append(text[at:s])
        while e < len(text) and text[e].isspace():
            e += 1
        at = e
    parts.append(text[at:])
    return "".join(parts)


def dedup_units(
    docs: DataFrame, least: int = UNIT_WORDS, run_words: int = RUN_WORDS, whole: bool = False
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_atoms, n_removed_chars, spans`` (of the
    original text), ``first_ids`` (documents that keep an earlier occurrence
    of a repeated unit, when a span is removed) and the remaining ``text``."""
    none = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"))
    own = (
        repeated_units(docs, least, whole)
        .groupBy(none.alias("key"), "th")
        .agg(F.collect_set("idx").alias("idx"), F.collect_set("first_id").alias("first_ids"))
    )
    rows = docs.select("doc_id", "text", none.alias("key"), F.xxhash64("text").alias("th")).join(own, ["key", "th"], "left")
    return _cut(rows.select("doc_id", "first_ids", "idx", "text"), least, run_words)



def _cut(rows: DataFrame, least: int, run_words: int) -> DataFrame:
    bound_batches(rows.sparkSession)
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        names = ["doc_id", "n_atoms", "n_removed_chars", "spans", "first_ids", "text"]
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            ids, firsts, idx, texts = batch.columns
            out = [[], [], [], [], []]
            for k in range(batch.num_rows):
                text, at = texts[k].as_py(), idx[k].as_py()
                if text is None:
                    n, spans = 0, []
                else:
                    n, spans = removed_spans(text, at or (), least, run_words)
                left = cut_text(text, spans) if spans else text
                out[0].append(n)
                out[1].append(sum(e - s for s, e in spans))
                out[2].append([{"start": s, "end": e} for s, e in spans])
                out[3].append(sorted(firsts[k].as_py()) if spans else [])
                out[4].append(left)
            kinds = [pa.int64(), pa.int64(), span, firsts.type, pa.string()]
            yield pa.RecordBatch.from_arrays([ids, *[pa.array(o, t) for o, t in zip(out, kinds, strict=True)]], names=names)

    schema = (
        f"doc_id {id_type}, n_atoms bigint, n_removed_chars bigint, "
        f"spans array<struct<start:bigint,end:bigint>>, first_ids array<{id_type}>, text string"
    )
    return rows.mapInArrow(run, schema)
