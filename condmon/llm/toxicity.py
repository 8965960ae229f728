"""Toxic passages by maximum-scoring segment search.

Every token gets a log-odds score: how much likelier documents labelled toxic
are to hold it.  The toxic share of a word's documents is estimated under a
Dirichlet (for two classes, beta) prior whose mean is the share of the word's
stem, whose own prior mean is the share of all documents; scores are shrunk
towards zero by their posterior deviation, so a word that a single document
holds says little.  A token counts once per document, so a document that
repeats itself teaches no more than others; in scoring, the k-th occurrence of
a word with positive odds has a k-th of them.  Less ``DRIFT`` per token, the
score of ordinary text falls, and a linear-time scan (Ruzzo and Tompa) finds
all maximal segments of positive total.

Extreme-value calibration: under the scores' distribution in clean documents,
the number of segments of score s or more in n tokens has the mean
``K * n * exp(-lambda * s)`` (Karlin and Altschul); lambda solves
``sum p * exp(lambda * s) = 1`` and K is fitted to clean documents that the
scores have not seen.  Segments of a mean of at most ``E_VALUE`` are the toxic
passages.  The best segment's surprise, the passages' total and their
number become a probability by logistic calibration on those documents.

Fitting uses a bounded sample: at most ``PER_CLASS`` labelled documents of each
class outside the held-out fold (``crc32(doc_id as text) mod 4 = 2``), those
first in a seeded order of all that have a text; half count, half calibrate.
Class shares come from all such labels.  Scoring is one scan of whole texts
without a shuffle; the broadcast model is ``2 ** BITS`` words' and stems' scores.
A text is read in pieces of about 1 MB, cut at whitespace, of which only the
positive runs are kept, so memory does not follow the text.

Defined cases: NULL and empty texts have no passages and get the calibrated
value of such texts; without usable labels of both classes every score is the
toxic share of the labels (0.5 without labels); a document with several labels
is toxic if half of them say so; with several texts the least is learned from;
repeated rows score alike; a NULL ``doc_id`` hashes as empty text; other columns
are never inputs of a score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from condmon.llm.calibration import apply_platt, fit_platt
from condmon.llm.common import held_out, map_texts, pieces, save, shuffle_key

SEED = "toxicity-1"
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
PER_CLASS = 20_000
BITS = 20
STEM_BYTES = 4
#: Prior masses in documents: of a word against its stem, of a stem against all.
WORD_MASS, STEM_MASS = 4.0, 20.0
SHRINK, DRIFT = 2.33, 0.3
E_VALUE = 0.05
#: Bounds on lambda, and on the surprise of one segment.
_LAMBDA, _SURPRISE = 20.0, 60.0
_CACHE = 500_000

_PLAIN = re.compile(rb"[0-9a-z\x80-\xff]+")
#: The same with every letter of scripts without spaces as a token of its own.
_DENSE = re.compile(
    rb"[\xe3-\xe9][\x80-\xbf]{2}|(?:[0-9a-z]|[\xc2-\xdf][\x80-\xbf]|[\xe0-\xe2\xea-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3})+"
)
_HAS_DENSE = re.compile(rb"[\xe3-\xe9]")


@dataclass
class Model:
    words: Any  # float32 scores by slot, NaN where the stem decides
    stems: Any
    decay: float  # lambda
    rate: float  # K
    platt: tuple | None
    constant: float


def pattern(piece: bytes):
    return _DENSE if _HAS_DENSE.search(piece) else _PLAIN


def slots(word: bytes) -> tuple[int, int]:
    import xxhash

    return xxhash.xxh64_intdigest(word) >> 64 - BITS, xxhash.xxh64_intdigest(word[:STEM_BYTES], 1) >> 64 - BITS


class Scores(dict):
    """Score per word, filled on demand and emptied when it grows large."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: bytes) -> float:
        if len(self) >= _CACHE:
            self.clear()
        own, stem = slots(word)
        s = float(self.model.words[own])
        s = (s if s == s else float(self.model.stems[stem])) - DRIFT
        self[word] = s
        return s


def segments(runs):
    """All maximal scoring segments (first, last, score) from runs (first,
    last, sum of all scores before the run, sum up to its end)."""
    found: list[tuple[int, int, float, float, int]] = []
    for first, last, low, high in runs:
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j = found[j][4]
            if j < 0 or found[j][3] >= high:
                found.append((first, last, low, high, j))
                break
            first, low = found[j][0], found[j][2]
            del found[j:]
    return [(first, last, high - low) for first, last, low, high, _ in found]


def scan(text: bytes, scores: Scores):
    """Number of tokens of a text and its maximal segments, by token number."""
    import numpy as np

    n, before, runs, nth = 0, 0.0, [], {}
    for piece in pieces(text.lower()):
        tokens = pattern(piece).findall(piece)
        s = np.fromiter(map(scores.__getitem__, tokens), float, len(tokens))
        for i in np.flatnonzero(s > 0).tolist():
            k = nth[tokens[i]] = nth.get(tokens[i], 0) + 1
            if k > 1:
                s[i] = (s[i] + DRIFT) / k - DRIFT
        up = s > 0
        if up.any():
            total = np.concatenate([[before], before + np.cumsum(s)])
            edge = np.diff(np.concatenate([[False], up, [False]]).astype(np.int8))
            first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            runs += zip((first + n).tolist(), (end - 1 + n).tolist(), total[first].tolist(), total[end].tolist(), strict=True)
        n += len(tokens)
        before += float(s.sum())
    return n, segments(runs)


def _chars(data: bytes) -> int:
    return len(data.decode("utf-8", "replace"))


def spans(text: bytes, wanted: list[tuple[int, int, float]]):
    """(start, end) in characters of segments given by token numbers."""
    begin = {first: k for k, (first, _, _) in enumerate(wanted)}
    end = {last: k for k, (_, last, _) in enumerate(wanted)}
    out = [[0, 0] for _ in wanted]
    n = chars = 0
    for piece in pieces(text.lower()):  # the whitespace of a cut begins the next piece
        seen = 0
        for m in pattern(piece).finditer(piece):
            if n in begin or n in end:
                start = chars + _chars(piece[seen : m.start()])
                chars, seen = start + _chars(m[0]), m.end()
                if n in begin:
                    out[begin[n]][0] = start
                if n in end:
                    out[end[n]][1] = chars
            n += 1
        chars += _chars(piece[seen:])
    return out


def surprise(n: int, score: float, model: Model) -> float:
    """Minus the logarithm of the expected number of such segments."""
    import math

    return model.decay * score - math.log(model.rate * n) if n else 0.0


def evidence(n: int, found, model: Model):
    """Inputs of the calibration, and the significant segments."""
    import math

    if not found:
        return (0.0, 0.0, 0.0), []
    rated = [(seg, surprise(n, seg[2], model)) for seg in found]
    best = max(min(x, _SURPRISE) for _, x in rated)
    mean = math.exp(-best)  # expected number; -log of the chance of any
    best = -math.log(-math.expm1(-mean)) if mean < 700 else 0.0
    good = [(seg, x) for seg, x in rated if x >= -math.log(E_VALUE)]
    return (best, math.log1p(sum(min(x, _SURPRISE) for _, x in good)), math.log1p(len(good))), good


def toxic_labels(labels: DataFrame) -> DataFrame:
    """``doc_id, toxic`` (0/1) of the training fold."""
    return (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .where(~held_out(F.col("doc_id"), FOLDS, HELD_OUT))
        .groupBy("doc_id")
        .agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
    )


def training_texts(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, seed: str = SEED):
    """``doc_id, toxic, part, text`` of the bounded sample (part 0 counts,
    part 1 calibrates; None without labels of both classes), and the share of
    toxic labels."""
    spark = docs.sparkSession
    known = toxic_labels(labels)
    count = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = count.get(1, 0) / sum(count.values()) if count else 0.5
    there = docs.where(F.length(F.trim("text")) > 0).select("doc_id").distinct()
    usable = save(known.join(there, "doc_id", "left_semi"), "toxicity-labels")
    picked = []
    for c in (0, 1):
        top = usable.where(F.col("toxic") == c).orderBy(shuffle_key(seed, F.col("doc_id")), "doc_id").limit(per_class)
        picked += [(r["doc_id"], c, k % 2) for k, r in enumerate(top.select("doc_id").collect())]
    if any(sum(p[1:] == (c, part) for p in picked) < 2 for c in (0, 1) for part in (0, 1)):
        return None, share
    id_type = usable.schema["doc_id"].dataType.simpleString()
    ids = spark.createDataFrame(picked, f"doc_id {id_type}, toxic int, part int")  # at most 2 * PER_CLASS rows
    texts = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(ids), "doc_id")
    return save(texts.groupBy("doc_id", "toxic", "part").agg(F.min("text").alias("text")), "toxicity-sample"), share


def token_counts(texts: DataFrame):
    """Per slot of words (kind 0) and stems (1): documents of each class that
    hold it, and the tokens that clean ones have, as an Arrow table of at most
    ``2 ** (BITS + 1)`` rows."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        size = 1 << BITS
        held = np.zeros((2, 2, size), np.int64)
        seen = np.zeros(size, np.int64)
        for batch in batches:
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words: dict[bytes, int] = {}
                for piece in pieces(text.lower()):
                    for w in pattern(piece).findall(piece):
                        words[w] = words.get(w, 0) + 1
                at = np.array([slots(w) for w in words], np.int64).reshape(-1, 2)
                for kind in (0, 1):
                    held[y, kind, np.unique(at[:, kind])] += 1
                if y == 0:
                    np.add.at(seen, at[:, 0], np.fromiter(words.values(), np.int64, len(words)))
        for kind in (0, 1):
            used = np.flatnonzero(held[0, kind] + held[1, kind])
            for k in range(0, len(used), 100_000):
                i = used[k : k + 100_000]
                cols = [np.full(len(i), kind, np.int32), i, held[0, kind, i], held[1, kind, i], seen[i] * (kind == 0)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["kind", "slot", "clean", "toxic", "tokens"])

    parts = texts.select("toxic", F.col("text").cast("binary").alias("text"))
    parts = parts.mapInArrow(run, "kind int, slot bigint, clean bigint, toxic bigint, tokens bigint")
    return parts.groupBy("kind", "slot").agg(*[F.sum(c).alias(c) for c in ("clean", "toxic", "tokens")]).toArrow()


def _log_odds(toxic, clean, mean, mass, base):
    """Shrunk log-odds of the posterior toxic share against ``base``."""
    import numpy as np

    a, b = toxic + mass * mean, clean + mass * (1 - mean)
    odds = np.log(a / b) - np.log(base / (1 - base))
    return np.sign(odds) * np.maximum(0, np.abs(odds) - SHRINK * np.sqrt(1 / a + 1 / b)), a / (a + b)


def _stem_slots(texts: DataFrame) -> DataFrame:
    """Which stem slot each word slot belongs to (the least, of a clash)."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            pairs = {slots(w) for t in batch.column(0).to_pylist() for p in pieces(t.lower()) for w in pattern(p).findall(p)}
            own, stem = zip(*pairs, strict=True) if pairs else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(stem, pa.int64())], names=["slot", "stem"])

    parts = texts.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "slot bigint, stem bigint")
    return parts.groupBy("slot").agg(F.min("stem").alias("stem"))


def word_scores(counts, stems_of, n_clean: int, n_toxic: int) -> tuple[Any, Any, Any]:
    """Scores by slot of words and of stems, and the clean tokens by slot."""
    import numpy as np

    size, base = 1 << BITS, n_toxic / (n_toxic + n_clean)
    held = np.zeros((2, 2, size))
    tokens = np.zeros(size)
    kind, slot = counts["kind"].to_numpy(), counts["slot"].to_numpy()
    held[0, kind, slot], held[1, kind, slot] = counts["clean"].to_numpy(), counts["toxic"].to_numpy()
    tokens[slot[kind == 0]] = counts["tokens"].to_numpy()[kind == 0]
    stems, share = _log_odds(held[1, 1], held[0, 1], base, STEM_MASS, base)
    mean = np.full(size, base)
    mean[stems_of["slot"].to_numpy()] = share[stems_of["stem"].to_numpy()]
    words, _ = _log_odds(held[1, 0], held[0, 0], mean, WORD_MASS, base)
    words[held[0, 0] + held[1, 0] == 0] = np.nan
    return words.astype(np.float32), stems.astype(np.float32), tokens


def decay_of(scores, weights) -> float:
    """The positive solution of ``sum p * exp(lambda * s) = 1``."""
    import numpy as np

    p = weights / weights.sum()
    if not (scores > 0).any() or p @ scores >= 0:
        return _LAMBDA if not (scores > 0).any() else 1e-3
    low, high = 0.0, 1e-3
    while high < _LAMBDA and p @ np.exp(np.minimum(high * scores, 700)) < 1:
        low, high = high, 2 * high
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if p @ np.exp(np.minimum(mid * scores, 700)) < 1 else (low, mid)
    return min(low, _LAMBDA)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    import numpy as np

    texts, share = training_texts(docs, labels, per_class)
    if texts is None:
        return Model(None, None, 0.0, 0.0, None, share)
    count = {(r["toxic"], r["part"]): r["count"] for r in texts.groupBy("toxic", "part").count().collect()}
    own = texts.where("part = 0")
    counts = token_counts(own)
    words, stems, tokens = word_scores(counts, _stem_slots(own).toArrow(), count[0, 0], count[1, 0])
    used = ~np.isnan(words)
    decay = decay_of(words[used].astype(float) - DRIFT, tokens[used] + 0.5)
    model = Model(words, stems, decay, 1.0, None, share)
    rows = _measured(texts.where("part = 1"), model, ("toxic",)).select("toxic", "n_tokens", "best").collect()
    clean = [(r["n_tokens"], r["best"]) for r in rows if r["toxic"] == 0 and r["n_tokens"]]
    model.rate = len(clean) / sum(n * np.exp(-decay * s) for n, s in clean) if clean else 1.0
    rows = _measured(texts.where("part = 1"), model, ("toxic",)).select("toxic", "x").collect()
    x, y = np.array([r["x"] for r in rows]), np.array([r["toxic"] for r in rows])
    n = np.bincount(y, minlength=2)
    weight = np.array([(1 - share) / n[0], share / n[1]])[y] * len(y)
    model.platt = fit_platt(x, y, weight)
    return model


def _measured(docs: DataFrame, model: Model, keep) -> DataFrame:
    """``keep`` columns, ``n_tokens, best`` (score), ``x`` (inputs of the
    calibration), ``score`` and the significant ``passages``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        import math

        import numpy as np

        m = shared.value
        scores = Scores(m)

        def one(text):
            n, found = scan(text, scores)
            x, good = evidence(n, found, m)
            where = spans(text, [seg for seg, _ in good]) if good else []
            passages = [
                {"start": a, "end": b, "score": seg[2], "e_value": math.exp(-min(v, 700.0))}
                for (seg, v), (a, b) in zip(good, where, strict=True)
            ]
            return n, max((s for _, _, s in found), default=0.0), x, passages

        def fn(texts):
            if not texts:
                return [[]] * 5
            n, best, x, passages = zip(*[one(t or b"") for t in texts], strict=True)
            score = np.clip(apply_platt(m.platt, np.array(x)), 0, 1).tolist() if m.platt else [m.constant] * len(n)
            return [n, best, x, score, passages]

        return fn

    fields = [
        ("n_tokens", "bigint"),
        ("best", "double"),
        ("x", "array<double>"),
        ("score", "double"),
        ("passages", "array<struct<start:bigint, end:bigint, score:double, e_value:double>>"),
    ]
    return map_texts(docs, "text", keep, fields, make)


def toxic_passages(docs: DataFrame, model: Model, keep=("doc_id",)) -> DataFrame:
    """``keep`` columns, ``score`` (0 to 1) and ``passages`` (start and end in
    characters, score, expected number by chance)."""
    if model.words is None:
        none = F.array().cast("array<struct<start:bigint, end:bigint, score:double, e_value:double>>")
        return docs.select(*keep, F.lit(float(model.constant)).alias("score"), none.alias("passages"))
    return _measured(docs, model, keep).select(*keep, "score", "passages")


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_passages, passages`` per row."""
    return toxic_passages(docs, fit(docs, labels)).select(
        "doc_id",
        held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        F.size("passages").cast("long").alias("n_passages"),
        "passages",
    )
