"""Quality classifier by compression.

Two zstandard dictionaries are trained, one on good and one on bad labelled
texts.  A text that compresses better with the good dictionary resembles the
good texts: the difference of the two compressed sizes, normalised by the
text's own length and by its plain compressed size, is mapped to a calibrated
probability of label 1 by logistic (Platt) calibration on labelled rows that
the dictionaries have not seen.  The calibration also sees how far the text
compresses by itself, because a difference means less in a text that repeats
itself and shrinks to little under any dictionary.

Fitting uses the bounded sample of ``labelled.py`` (documented there); half of
it trains the dictionaries and half the calibration, weighted to the true
class shares.  Scoring is one scan of whole texts in Arrow batches, without a
shuffle; the broadcast model is two dictionaries of ``DICT_BYTES``.

Defined cases: NULL and empty texts score the calibrated value of an average
text; a class without usable labels gives the share of the labels as
everyone's score (0.5 without labels); repeated rows score alike; a NULL
``doc_id`` hashes as empty text; other columns are never inputs of a score.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from condmon.llm.calibration import apply_platt, fit_platt
from condmon.llm.common import held_out, map_texts
from condmon.llm.labelled import FOLDS, HELD_OUT, training_sample

SEED = "quality-zstd-1"
THRESHOLD = 0.3
DICT_BYTES = 64 * 1024
LEVEL = 3


@dataclass
class Model:
    good: bytes | None
    bad: bytes | None
    platt: tuple | None
    constant: float


class Sizes:
    """Normalised compressed-size differences of texts and their own
    compression; NaN for empty texts."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard as zs

        plain = dict(level=LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False)
        self.good, self.bad = (zs.ZstdCompressor(dict_data=zs.ZstdCompressionDict(d), **plain) for d in (good, bad))
        self.plain = zs.ZstdCompressor(**plain)

    def __call__(self, texts):
        import numpy as np

        out = np.full((len(texts), 4), np.nan)
        for i, t in enumerate(texts):
            if t:
                diff = len(self.bad.compress(t)) - len(self.good.compress(t))
                own = len(self.plain.compress(t))
                out[i] = diff / len(t), diff / own, diff * own / len(t) ** 2, own / len(t)
        return out


def fit(docs: DataFrame, labels: DataFrame, seed: str = SEED) -> Model:
    import numpy as np
    import zstandard as zs

    rows, share = training_sample(docs, labels, seed)
    dicts = []
    for c in (1, 0):
        own = [t for t, y in rows[::2] if y == c]
        if sum(y == c for _, y in rows[1::2]) < 2 or len(own) < 8:
            return Model(None, None, None, share[1])
        size = min(DICT_BYTES, max(1024, sum(map(len, own)) // 4))
        dicts.append(zs.train_dictionary(size, own, level=LEVEL).as_bytes())
    x = Sizes(*dicts)([t for t, _ in rows[1::2]])
    y = np.array([y for _, y in rows[1::2]])
    n = np.bincount(y, minlength=2)
    weight = np.array([share[c] / n[c] for c in (0, 1)])[y] * len(y)
    return Model(*dicts, fit_platt(x, y, weight), share[1])


def score(docs: DataFrame, model: Model, keep=("doc_id",)) -> DataFrame:
    """``keep`` columns and ``score`` (0 to 1, higher: label 1 likelier)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        import numpy as np

        m = shared.value
        sizes = Sizes(m.good, m.bad) if m.platt else None

        def fn(texts):
            if sizes is None:
                return [[m.constant] * len(texts)]
            return [np.clip(apply_platt(m.platt, sizes(texts)), 0, 1).tolist()]

        return fn

    return map_texts(docs, "text", keep, [("score", "double")], make)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``."""
    return score(docs, fit(docs, labels)).select(
        "doc_id",
        held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def drop_low_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted to be of low quality."""
    rows = docs.select(F.struct("*").alias("row"), "text")
    return score(rows, fit(docs, labels), keep=("row",)).where(F.col("score") >= THRESHOLD).select("row.*")
