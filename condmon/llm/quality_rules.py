"""Quality rules: fixed base limits and a learned verdict.

The learned part is a logistic regression on hashed n-grams of words (1 and 2)
and of bytes (3), each family weighted by its share of the text, so the length
of a text does not matter.  It is fitted on the bounded labelled sample of
``labelled.py`` (documented there), probability-calibrated on a part of the
sample that the weights have not seen, and scored in Arrow batches against
the fixed threshold ``KEEP``.

Scale: one scan of whole texts, no shuffle; texts are taken in groups of at
most ``GROUP_WORDS`` words.  A text of over ``LONG_BYTES`` is read in pieces:
sums run on across them, with a word and two bytes carried over, and what
looks at the whole text keeps a number per word and a digest per line; its
three-word windows are then compared in parts of at most ``WINDOWS``.  The
broadcast model is one table of ``2 ** BITS`` weights.

Base rules per text, with words as maximal runs without ASCII whitespace:
``n_words``; ``word_chars`` (code points in words); ``n_symbols`` (characters
of ``SYMBOLS``); ``n_dup_lines`` (lines with a word that equal an earlier
line); ``n_repeat_words`` (words inside a window of three that occurs twice or
more).  A text fails with fewer than ``MIN_WORDS`` words or more than half of
its words repeated.

Defined cases: NULL counts as the empty text, has no words and fails the base
rules; without usable labels the learned verdict is the share of good labels
(0.5 without any); repeated rows get equal results; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from condmon.llm.calibration import apply_platt, fit_platt
from condmon.llm.common import map_texts, pieces
from condmon.llm.labelled import training_sample

SEED = "quality-rules-1"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Fixed value: the characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
BITS = 18
KEEP = 0.3
GROUP_WORDS = 200_000
LONG_BYTES = 1 << 20
WINDOWS = 2_000_000
_MIX = 0x9E3779B97F4A7C15


@dataclass
class Model:
    weights: Any  # float32 table, or None
    platt: tuple | None
    constant: float


def groups(texts: list[bytes | None]):
    """Consecutive (texts, word lists) of at most GROUP_WORDS words, or one text."""
    part, words, n = [], [], 0
    for t in texts:
        t = t or b""
        w = t.split()
        if part and n + len(w) > GROUP_WORDS:
            yield part, words
            part, words, n = [], [], 0
        part.append(t)
        words.append(w)
        n += len(w)
    if part:
        yield part, words


class Features:
    """Hashed n-grams of a group of texts as flat arrays."""

    def __init__(self, texts: list[bytes], words: list[list[bytes]]):
        import numpy as np
        import xxhash

        index: dict[bytes, int] = {}
        flat = [index.setdefault(x, len(index)) for w in words for x in w]
        self.ids = np.array(flat, np.int64)
        self.n_words = np.array([len(w) for w in words], np.int64)
        self.hash = np.fromiter((xxhash.xxh64_intdigest(x) for x in index), np.uint64, len(index))
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.n_bytes = np.array([len(t) for t in texts], np.int64)
        self.texts = texts

    def families(self):
        """(owner text, table index) arrays per family; overlaps between
        neighbouring texts are left out."""
        import numpy as np

        mix, down = np.uint64(_MIX), np.uint64(64 - BITS)
        h = self.hash[self.ids] if len(self.ids) else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(self.n_words)), self.n_words)
        yield owner, ((h * mix) >> down).astype(np.int32)
        same = owner[1:] == owner[:-1]
        pair = (h[:-1] * mix + h[1:]) * mix
        yield owner[1:][same], (pair[same] >> down).astype(np.int32)
        b = self.bytes
        if len(b) < 3:
            yield np.zeros(0, np.int64), np.zeros(0, np.int32)
            return
        slot = _gram_slots(b)
        owner = np.repeat(np.arange(len(self.n_bytes), dtype=np.int32), self.n_bytes)
        inside = owner[2:] == owner[:-2]
        yield owner[2:][inside], slot[inside].astype(np.int32)

    def logits(self, weights):
        """Sum over the families of the mean weight of a text's n-grams."""
        import numpy as np

        out = np.zeros(len(self.texts))
        for owner, slot in self.families():
            n = np.bincount(owner, minlength=len(out))
            out += np.bincount(owner, weights[slot], minlength=len(out)) / np.maximum(n, 1)
        return out

    def base(self):
        """word_chars, n_symbols, n_dup_lines, n_repeat_words per text."""
        import numpy as np

        starts = np.cumsum(self.n_bytes) - self.n_bytes
        kind, symbol = _kinds()
        chars, symbols = _sums(kind[self.bytes], starts, self.n_bytes), _sums(symbol[self.bytes], starts, self.n_bytes)
        lines = [duplicate_lines(t) for t in self.texts]
        ends = np.cumsum(self.n_words)
        repeats = [repeated_words(self.ids[e - n : e]) for e, n in zip(ends, self.n_words, strict=True)]
        return chars, symbols, lines, repeats


def _gram_slots(b):
    """Table index of every three bytes in a row."""
    import numpy as np

    gram = b[:-2].astype(np.uint32) | b[1:-1].astype(np.uint32) << 8 | b[2:].astype(np.uint32) << 16
    return ((gram + np.uint32(1)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)


def _kinds():
    """Per byte: whether it begins a code point of a word, and is a symbol."""
    import numpy as np

    kind = np.ones(256, np.uint8)
    kind[0x80:0xC0] = 0
    kind[[0x20, *range(0x09, 0x0E)]] = 0
    symbol = np.zeros(256, np.uint8)
    symbol[list(SYMBOLS)] = 1
    return kind, symbol


def long_text(text: bytes, weights=None):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the
    logit of a text, read in pieces."""
    import numpy as np
    import xxhash

    mix, down = np.uint64(_MIX), np.uint64(64 - BITS)
    kind, symbol = _kinds()
    index: dict[bytes, int] = {}
    parts, totals, counts = [], np.zeros(3), np.zeros(3, np.int64)
    n_words = chars = symbols = 0
    last, tail = np.zeros(0, np.uint64), np.zeros(0, np.uint8)
    for piece in pieces(text, LONG_BYTES):
        words = piece.split()
        ids = np.array([index.setdefault(w, len(index)) for w in words], np.int32)
        parts.append(ids)
        n_words += len(ids)
        data = np.frombuffer(piece, np.uint8)
        chars += int(kind[data].sum(dtype=np.int64))
        symbols += int(symbol[data].sum(dtype=np.int64))
        if weights is None:
            continue
        own, back = np.unique(ids, return_inverse=True)
        first = np.empty(len(own), np.int64)
        first[back[::-1]] = np.arange(len(ids))[::-1]
        h = np.fromiter((xxhash.xxh64_intdigest(words[i]) for i in first), np.uint64, len(own))[back]
        run, data = np.concatenate([last, h]), np.concatenate([tail, data])
        pair = (run[:-1] * mix + run[1:]) * mix
        for k, slot in enumerate((h * mix >> down, pair >> down, _gram_slots(data) if len(data) > 2 else data[:0])):
            totals[k] += weights[slot.astype(np.int64)].sum(dtype=np.float64)
            counts[k] += len(slot)
        last, tail = run[-1:], data[-2:]
    ids = np.concatenate(parts)
    logit = float((totals / np.maximum(counts, 1)).sum())
    return n_words, chars, symbols, duplicate_lines(text), repeated_words(ids), logit


def _sums(values, starts, lengths):
    import numpy as np

    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[starts + lengths] - total[starts]


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier one, told by a 128-bit digest
    where they are long."""
    import xxhash

    seen: set[bytes] = set()
    n, start = 0, 0
    while start <= len(text):
        end = text.find(b"\n", start)
        if end < 0:
            end = len(text)
        if not start and end == len(text):
            return 0
        line = text[start:end]
        start = end + 1
        if len(line) > 64:
            key = b"\n" + xxhash.xxh3_128_digest(line)
        else:
            key = line
        if key in seen:
            n += 1
        elif line.strip():
            seen.add(key)
    return n


def repeated_words(ids) -> int:
    """Words inside a window of three that occurs at least twice."""
    import numpy as np

    if len(ids) < 4:
        return 0
    cover = np.zeros(len(ids), bool)
    parts = -(-len(ids) // WINDOWS)
    # equal windows have equal numbers of their words, so they are in one part
    part = (ids[:-2].astype(np.uint32) * np.uint32(0x9E3779B1) + ids[2:].astype(np.uint32)) % np.uint32(parts) if parts > 1 else None
    for k in range(parts):
        at = np.arange(len(ids) - 2) if part is None else np.flatnonzero(part == k)
        hit = at[_repeated(ids[at], ids[at + 1], ids[at + 2])]
        for j in range(3):
            cover[hit + j] = True
    return int(cover.sum())


def _repeated(a, b, c):
    """Which of the triples occur at least twice."""
    import numpy as np

    a, b, c = (x.astype(np.int64) for x in (a, b, c))
    if not len(a):
        return np.zeros(0, bool)
    if max(int(a.max()), int(b.max()), int(c.max())) < 1 << 21:
        key = a << 42 | b << 21 | c
    else:  # more words than fit three to a key: number the pairs first
        _, pair = np.unique(a << 32 | b, return_inverse=True)
        key = pair.astype(np.int64) << 32 | c
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(len(key), bool)
    return twice[np.minimum(np.searchsorted(twice, key), len(twice) - 1)] == key


def _train(rows: list[tuple[bytes, int]], rounds: int = 60, rate: float = 3.0, decay: float = 1e-4):
    """Weights by Adagrad over the whole (bounded) sample."""
    import numpy as np

    owner, slot, value, y, at = [], [], [], [], 0
    texts = [t for t, _ in rows]
    for part, words in groups(texts):
        f = Features(part, words)
        for own, s in f.families():
            key = own.astype(np.int64) << BITS | s
            key.sort()
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
            count = np.diff(np.append(first, len(key)))
            own, s = key[first] >> BITS, key[first] & (1 << BITS) - 1
            total = np.bincount(own, count, minlength=len(part))
            owner.append((own + at).astype(np.int32))
            slot.append(s.astype(np.int32))
            value.append((count / total[own]).astype(np.float32))
        at += len(part)
    owner, slot, value = np.concatenate(owner), np.concatenate(slot), np.concatenate(value)
    y = np.array([c for _, c in rows], float)
    balance = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    w, seen, bias = np.zeros(1 << BITS), np.full(1 << BITS, 1e-12), 0.0
    for _ in range(rounds):
        z = np.bincount(owner, w[slot] * value, minlength=len(y)) + bias
        err = balance * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        grad = np.bincount(slot, err[owner] * value, minlength=1 << BITS) + decay * w / len(y)
        seen += grad * grad
        w -= rate * grad / np.sqrt(seen)
        bias -= err.sum()
    return w.astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, seed: str = SEED) -> Model:
    import numpy as np

    rows, share = training_sample(docs, labels, seed)
    own, rest = [r for i, r in enumerate(rows) if i % 3], rows[::3]
    if min([sum(y == c for _, y in part) for part in (own, rest) for c in (0, 1)], default=0) < 2:
        return Model(None, None, share[1])
    weights = _train(own)
    x = np.concatenate([Features(p, w).logits(weights) for p, w in groups([t for t, _ in rest])])[:, None]
    y = np.array([y for _, y in rest])
    n = np.bincount(y, minlength=2)
    weight = np.array([share[c] / n[c] for c in (0, 1)])[y] * len(y)
    return Model(weights, fit_platt(x, y, weight), share[1])


def quality_verdicts(docs: DataFrame, labels: DataFrame, keep=("doc_id",)) -> DataFrame:
    """``keep`` columns, the base counts, ``score``, ``base_failed``, ``kept``."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def make():
        import numpy as np

        model = shared.value

        def chance(logits):
            if model.platt is None:
                return np.full(len(logits), model.constant)
            return apply_platt(model.platt, np.asarray(logits, float)[:, None])

        def fn(texts):
            rows: list = [None] * len(texts)
            short = [i for i, t in enumerate(texts) if len(t or b"") <= LONG_BYTES]
            at = iter(short)
            for part, words in groups([texts[i] for i in short]):
                f = Features(part, words)
                p = chance(f.logits(model.weights) if model.platt else np.zeros(len(part)))
                for values in zip(f.n_words.tolist(), *f.base(), p.tolist(), strict=True):
                    rows[next(at)] = values
            for i, t in enumerate(texts):
                if rows[i] is None:
                    *counts, logit = long_text(t, model.weights if model.platt else None)
                    rows[i] = (*counts, float(chance([logit])[0]))
            return [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * 6

        return fn

    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    out = map_texts(docs, "text", keep, [*[(c, "bigint") for c in counts], ("score", "double")], make)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.select(
        *keep, *counts, "score", failed.alias("base_failed"), (~failed & (F.col("score") >= KEEP)).alias("kept")
    )
