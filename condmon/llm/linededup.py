"""Line dedup by winnowing over line hashes.

The lines of a document that hold a word, trimmed, are hashed.  A window is the
shortest run of lines from some line on with at least ``words`` words (or of
``window`` lines), so a long line is a window by itself and short ones form
windows of several lines.  In every window the smallest hash (the last one on
ties) is selected as a fingerprint, so any repeated run that holds a window
shares a fingerprint: the guarantee of winnowing.  Fingerprint positions are
joined over all documents; around a position whose hash occurs again the match
is extended both ways, to each of the windows that selected it.  A window whose
whole content (a 128-bit digest) occurs earlier is a repeat, and the union of
overlapping repeats is a later repeated run, which is deleted; the first
occurrence, by ``(doc_id, text hash, line)``, stays.

The registered query measures windows in words (``WORDS``): every repeated line
of that many words goes, alone or in a run, and shorter ones in repeated runs of
that many.  A document of fewer words is one window, so a short exact copy goes
as a whole.  A word is a run without white space; eight characters count as a
word at least, for scripts without spaces.

Scale: DataFrame functions only.  Few of the lines that share windows are
selected; positions meet by their hash through a map-side count, never as
pairs, and repeats join the first occurrence of their content, so a run that a
third of all documents share costs one row per occurrence.  Text is shuffled
once, to meet its own repeats, and cut in time linear in its lines.

Defined cases: lines without a word are not counted and stay; NULL texts have
no lines and stay NULL; with windows of lines, documents of fewer lines are
never changed; rows that repeat both ``doc_id`` and text are one document, each
copy treated alike; a NULL ``doc_id`` comes last; very long texts are one row
each, of any number of lines; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from condmon.llm.common import WORD, save

#: Words of a window of the registered query and its SQL.
WORDS = 8
#: Characters that count as a word at least.
WORD_CHARS = 8
#: Lines of a window where a caller names none.
DEFAULT_WINDOW = 3
_TRIM = "^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$"


def _lines(text: Column) -> Column:
    """Array of (at, line): original index and trimmed content of the lines
    with a word."""
    split = F.transform(
        F.split(text, "\n", -1),
        lambda x, i: F.struct(i.alias("at"), F.regexp_replace(x, _TRIM, "").alias("line")),
    )
    return F.filter(split, lambda x: x["line"] != "")


def _let(value: Column, fn) -> Column:
    """``fn(value)`` with the value computed once, wherever it is used."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def fingerprints(docs: DataFrame, window: int = DEFAULT_WINDOW, words: int | None = None) -> DataFrame:
    """One row per selected position: ``none, doc_id, th`` (document), ``fp``
    (its hash), ``lo`` (first line of the first window that selected it),
    ``lens`` (lines of each of those windows) and ``a, b`` (two hashes per line
    of the lines they span)."""
    some = docs if words or window == 1 else docs.where(F.col("text").contains("\n"))
    lines = some.select(
        F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64("text").alias("th"), _lines(F.col("text")).alias("l")
    )
    count = lambda x: F.greatest(F.size(F.regexp_extract_all(x, F.lit(WORD), F.lit(0))), F.floor(F.length(x) / WORD_CHARS).cast("int"))
    hashed = lines.where(F.size("l") >= (1 if words else window)).select(
        "none", "doc_id", "th",
        F.transform("l", lambda x: F.xxhash64(x["line"])).alias("a"),
        F.transform("l", lambda x: F.xxhash64(F.lit("second"), x["line"])).alias("b"),
        *([F.transform("l", lambda x: count(x["line"])).alias("w")] if words else []),
    )
    if words:
        # lines of the window from line s on, 0 where the words do not suffice
        lens = (
            f"transform(sequence(0, size(w) - 1), s -> if(w[s] >= {words}, 1, aggregate(sequence(1, {words - 1}), "
            f"struct(w[s] as t, 1 as k), (x, j) -> if(x.t >= {words}, x, struct(x.t + coalesce(get(w, s + j), 0) as t, x.k + 1 as k)), "
            f"x -> if(x.t >= {words}, x.k, 0))))"
        )
        full = F.filter(F.expr(lens), lambda n: n > 0)
        hashed = hashed.withColumn("lens", full)
        hashed = hashed.withColumn("lens", F.when(F.size("lens") > 0, F.col("lens")).otherwise(F.array(F.size("a"))))
    else:
        hashed = hashed.withColumn("lens", F.expr(f"array_repeat({window}, size(a) - {window - 1})"))
    # position of the smallest hash of each window, the last one on ties
    picks = F.expr(
        "transform(lens, (n, s) -> if(n = 1, s, "
        "array_min(transform(sequence(0, n - 1), k -> struct(a[s + k] as h, -(s + k) as p))).p * -1))"
    )
    picked = hashed.withColumn("p", picks)
    # windows that selected the same position are consecutive
    starts = F.expr("filter(sequence(0, size(p) - 1), s -> s = 0 or p[s] <> p[s - 1])")
    runs = picked.withColumn("s", starts).select(
        "none", "doc_id", "th", "a", "b", "p", "lens",
        F.explode(F.expr("transform(s, (x, i) -> struct(x as lo, coalesce(get(s, i + 1), size(p)) - x as n))")).alias("r"),
    )
    # windows end in the order in which they begin
    span = "lens[r.lo + r.n - 1] + r.n - 1"
    return runs.select(
        "none", "doc_id", "th",
        F.expr("a[p[r.lo]]").alias("fp"),
        F.col("r.lo").alias("lo"),
        F.expr("slice(lens, r.lo + 1, r.n)").alias("lens"),
        F.expr(f"slice(a, r.lo + 1, {span})").alias("a"),
        F.expr(f"slice(b, r.lo + 1, {span})").alias("b"),
    )


def repeated_windows(docs: DataFrame, window: int = DEFAULT_WINDOW, words: int | None = None) -> DataFrame:
    """``none, doc_id, th, s, n``: first line and lines of the windows that
    occur earlier."""
    picked = save(fingerprints(docs, window, words), "line-fingerprints")
    # tables of their own: the joins below then have a shuffle on either side,
    # and a line or window with very many occurrences can be split over tasks
    again = save(picked.groupBy("fp").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("fp"), "line-repeats")
    near = picked.join(again, "fp", "left_semi")
    wins = near.select("none", "doc_id", "th", "lo", "a", "b", F.posexplode("lens").alias("k", "n")).select(
        "none", "doc_id", "th", "n",
        (F.col("lo") + F.col("k")).alias("s"),
        F.xxhash64(F.expr("slice(a, k + 1, n)")).alias("da"),
        F.xxhash64(F.expr("slice(b, k + 1, n)")).alias("db"),
    )
    wins = save(wins, "line-windows")
    first = wins.groupBy("da", "db").agg(
        F.min(F.struct("none", "doc_id", "th", "s")).alias("first"), F.count(F.lit(1)).alias("m")
    )
    first = save(first.where("m > 1").select("da", "db", "first"), "line-firsts")
    same = F.struct("none", "doc_id", "th", "s").eqNullSafe(F.col("first"))
    return wins.join(first, ["da", "db"]).where(~same).select("none", "doc_id", "th", "s", "n")


def _without(lines: Column, gone: Column) -> Column:
    """``lines`` less the positions in the sorted array ``gone``, as the
    slices between them."""
    edges = F.concat(F.array(F.lit(-1)), gone, F.array(F.size(lines)))

    def cut(x):
        between = F.transform(
            F.sequence(F.lit(0), F.size(x["g"]) - 2),
            lambda k: F.struct(
                (F.get(x["g"], k) + 2).alias("at"), (F.get(x["g"], k + 1) - F.get(x["g"], k) - 1).alias("n")
            ),
        )
        kept = F.filter(between, lambda r: r["n"] > 0)
        return F.flatten(F.transform(kept, lambda r: F.slice(x["l"], r["at"], r["n"])))

    return _let(F.struct(lines.alias("l"), edges.alias("g")), cut)


def dedup_lines(docs: DataFrame, window: int = DEFAULT_WINDOW, words: int | None = None) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_lines`` (with a word), ``n_removed``,
    ``removed_lines`` (comma-joined original line numbers from 0) and the
    remaining ``text``.  Windows hold ``words`` words, or else ``window``
    lines."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    own = (
        repeated_windows(docs, window, words)
        .groupBy("none", key.alias("id"), "th")
        .agg(F.array_sort(F.collect_set(F.struct("s", "n"))).alias("s"))
    )
    rows = docs.select(
        "doc_id", "text", F.col("doc_id").isNull().alias("none"), key.alias("id"), F.xxhash64("text").alias("th")
    ).join(own, ["none", "id", "th"], "left")
    lines = rows.withColumn("l", F.coalesce(_lines(F.col("text")), F.array().cast("array<struct<at:int,line:string>>")))
    covered = F.array_distinct(F.flatten(F.transform("s", lambda x: F.sequence(x["s"], x["s"] + x["n"] - 1))))
    gone = F.coalesce(F.transform(F.array_sort(covered), lambda i: F.get("l", i)["at"]), F.array().cast("array<int>"))
    cut = lines.select("doc_id", "text", F.size("l").cast("long").alias("n_lines"), gone.alias("gone"))
    left = F.array_join(_without(F.split("text", "\n", -1), F.col("gone")), "\n")
    return cut.select(
        "doc_id",
        "n_lines",
        F.size("gone").cast("long").alias("n_removed"),
        F.array_join(F.col("gone").cast("array<string>"), ",").alias("removed_lines"),
        F.when(F.size("gone") > 0, left).otherwise(F.col("text")).alias("text"),
    )
