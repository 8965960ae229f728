"""Language-model scoring with an Elias-Fano n-gram trie.

The model is an interpolated bigram model with absolute discounting over an
add-half unigram model:

    P1(w)     = (c(w) + 0.5) / (N + 0.5 (V + 1))          (unknown words: c = 0)
    P(w | v)  = max(c(v w) - D, 0) / c(v) + D T(v) / c(v) * P1(w)

with ``c(v)`` the tokens and ``T(v)`` the distinct tokens seen after ``v``;
after an unseen ``v`` it is ``P1``.  Tokens are the words of a text and one end
token; the first context is a begin mark.

The trie has two levels of files in the shared folder:

* level 1: the sorted 64-bit word hashes and the running totals of their
  counts, both Elias-Fano coded; a word's id is its rank;
* level 2: for a range of context ids, the monotone pointers to their
  children and the children themselves, stored relative to their context (a
  child id plus the end of the context's predecessor, which makes the whole
  level one monotone sequence), both Elias-Fano coded, and the quantised
  (``STEP`` in log10) smoothed probabilities and back-off weights.

Tasks map the files into memory and look up batches of sorted bigrams: the
pointers give a context's range, a successor search its child; nothing is
decoded as a whole and nothing of the model is on the heap or the driver.  A task keeps the
``OPEN_SHARDS`` shards of a level that it used last.

Scale: counts are taken over all training documents.  A map task counts its
own words and bigrams in bounded buffers and sends sorted, compressed runs
for each shard; shards are hash ranges whose number grows with the text, so
each is merged and written by one task within bounded memory (a context has at
most one child per vocabulary word, however many rows it holds).  A hot context
has a run for every buffer of the input, so the runs of a bigram shard are first
merged in groups of about ``FAN``, in rounds, until the last task gets at most
``FAN`` of them.  Files are
written under a private name and renamed, so a task that runs again replaces
them.  The shared folder must be a file path on all machines, as a mapped
file has to be; pass ``folder`` if ``spark.checkpoint.dir`` is not.

Limit: 2^31 distinct words, beyond which ``train`` raises an error.

Defined cases: NULL counts as the empty text (one end token); without
training rows every token is unknown; very long texts are read in parts;
repeated rows count and score like any others; a NULL ``doc_id`` hashes as
empty text; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import uuid
from itertools import chain, islice
from urllib.parse import urlparse

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from condmon.llm.common import bound_batches, held_out, map_texts, pieces, save
from condmon.session import work_dir

FOLDS, HELD_OUT = 5, 1
DISCOUNT = 0.75
#: Step of the quantised log10 probabilities (16 bits: down to -32).
STEP = 0.0005
#: Text bytes per shard of a level.
SHARD_BYTES = 32 << 20
#: Distinct words, bigrams and words of a group that a task holds at once.
WORD_BUFFER, PAIR_BUFFER, GROUP_WORDS = 300_000, 2_000_000, 1_000_000
#: Runs of a bigram shard that its last merge gets at most.
FAN = 64
#: Shards of a level that a task keeps mapped at once.
OPEN_SHARDS = 1024
END = b"\n"  # no word contains white space
_ID_BITS = 32


def local_path(folder: str) -> str:
    url = urlparse(folder)
    if url.scheme not in ("", "file"):
        raise ValueError(f"a memory-mapped trie needs a shared folder that is a file path, not {folder}")
    return url.path


def word_hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word)


def segments(texts):
    """(row, words, first, last) of texts, long ones in parts."""
    for row, text in enumerate(texts):
        before = None
        for part in pieces((text or b"").lower()):
            if before is not None:
                yield row, before[0], before[1], False
            before = part.split(), before is None
        yield row, before[0], before[1], True


def segment_groups(texts):
    """Lists of segments with about GROUP_WORDS words."""
    part, n = [], 0
    for seg in segments(texts):
        part.append(seg)
        n += len(seg[1]) + 1
        if n >= GROUP_WORDS:
            yield part
            part, n = [], 0
    if part:
        yield part


def _publish(folder: str, name: str, words) -> None:
    os.makedirs(folder, exist_ok=True)
    own = os.path.join(folder, f".{name}-{uuid.uuid4().hex}")
    words.tofile(own)
    os.replace(own, os.path.join(folder, name))


def _pad(codes):
    """16-bit codes as whole 64-bit words."""
    import numpy as np

    out = np.zeros(-(-len(codes) // 4) * 4, np.uint16)
    out[: len(codes)] = codes
    return out.view(np.uint64)


def _kept(open_shards: dict, k: int, load):
    """The shard ``k`` of ``open_shards``, which holds the last used ones."""
    if k in open_shards:
        open_shards[k] = open_shards.pop(k)
    else:
        while len(open_shards) >= OPEN_SHARDS:
            open_shards.pop(next(iter(open_shards)))  # its mapping ends with its last view
        open_shards[k] = load(k)
    return open_shards[k]


class Level1:
    """Words: hash -> id, id -> count."""

    def __init__(self, folder: str, bits: int, offsets):
        self.folder, self.bits, self.offsets = folder, bits, offsets
        self.open: dict[int, tuple] = {}

    def shard(self, k: int):
        return _kept(self.open, k, self._load)

    def _load(self, k: int):
        import numpy as np

        from condmon.llm.eliasfano import View

        words = np.memmap(os.path.join(self.folder, f"words-{k:06d}"), np.uint64, "r")
        hashes = View(words)
        return hashes, View(words[hashes.words :])

    def find(self, hashes):
        """Ids and counts of sorted word hashes (-1 and 0 if unknown)."""
        import numpy as np

        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        top = (hashes >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(hashes), np.int64)
        rest = hashes & np.uint64((1 << 64 - self.bits) - 1)
        cuts = np.searchsorted(top, np.arange((1 << self.bits) + 1))
        for k in np.flatnonzero((np.diff(cuts) > 0) & (np.diff(self.offsets) > 0)):
            own = slice(cuts[k], cuts[k + 1])
            keys, totals = self.shard(int(k))
            at = keys.find(rest[own])
            hit = np.flatnonzero(at >= 0)
            ids[own.start + hit] = at[hit] + self.offsets[k]
            counts[own.start + hit] = self._count(totals, at[hit])
        return ids, counts

    @staticmethod
    def _count(totals, at):
        return (totals.access(at + 1) - totals.access(at)).astype("int64")

    def counts(self, ids):
        """Counts of ids in ascending order."""
        import numpy as np

        out = np.zeros(len(ids), np.int64)
        cuts = np.searchsorted(ids, self.offsets)
        for k in range(len(self.offsets) - 1):
            if cuts[k + 1] > cuts[k]:
                part = slice(cuts[k], cuts[k + 1])
                out[part] = self._count(self.shard(k)[1], ids[part] - self.offsets[k])
        return out


class Level2:
    """Bigrams: (context id, word id) -> log10 probability."""

    def __init__(self, folder: str, shards: int, contexts: int):
        self.folder, self.shards, self.contexts = folder, shards, contexts
        self.open: dict[int, tuple] = {}

    def first(self, k: int) -> int:
        """First context id of a shard."""
        return -(-k * self.contexts // self.shards)

    def shard(self, k: int):
        return _kept(self.open, k, self._load)

    def _load(self, k: int):
        import numpy as np

        from condmon.llm.eliasfano import View

        path = os.path.join(self.folder, f"pairs-{k:06d}")
        if not os.path.exists(path):  # no bigram of these contexts
            return None
        words = np.memmap(path, np.uint64, "r")
        pointers = View(words)
        children = View(words[pointers.words :])
        rest = words[pointers.words + children.words :]
        n = -(-children.n // 4)
        return pointers, children, rest[:n].view(np.uint16), rest[n:].view(np.uint16)

    def find(self, keys, tail):
        """log10 P for sorted, distinct keys ``context << 32 | word``; ``tail``
        is log10 P1 of their words."""
        import numpy as np

        out = np.array(tail, float)
        ctx = keys >> _ID_BITS
        word = keys & (1 << _ID_BITS) - 1
        cuts = np.searchsorted(ctx, [self.first(k) for k in range(self.shards + 1)])
        for k in np.flatnonzero(np.diff(cuts)):
            view = self.shard(int(k))
            if view is None:
                continue
            pointers, children, probs, backoff = view
            part = slice(cuts[k], cuts[k + 1])
            own = ctx[part] - self.first(int(k))
            start = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            c = own[start]
            lo, hi = pointers.access(c).astype(np.int64), pointers.access(c + 1).astype(np.int64)
            base = np.zeros(len(c), np.uint64)
            later = np.flatnonzero((lo > 0) & (hi > lo))
            base[later] = children.access(lo[later] - 1) + np.uint64(1)
            which = np.repeat(np.arange(len(c)), np.diff(np.append(start, len(own))))
            at = children.find(base[which] + word[part].astype(np.uint64))
            hit = (at >= lo[which]) & (at < hi[which])
            seen = hi[which] > lo[which]
            values = out[part]
            values[seen] -= backoff[own[seen]] * STEP
            values[hit] = probs[at[hit]] * -STEP
            out[part] = values
        return out


class Trie:
    """What a task needs to know of a built trie; opened lazily."""

    def __init__(self, folder, bits, offsets, tokens, shards):
        self.folder, self.bits, self.offsets, self.tokens, self.shards = folder, bits, offsets, tokens, shards
        self.vocabulary = int(offsets[-1])
        self.begin = self.vocabulary  # context id of the begin mark

    def levels(self):
        return (
            Level1(self.folder, self.bits, self.offsets),
            Level2(self.folder, self.shards, self.vocabulary + 1),
        )

    def log_unigram(self, counts):
        import numpy as np

        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.vocabulary + 1)))


class _Places(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


class Lookup:
    """Words of a task -> places in growing arrays of ids and counts."""

    def __init__(self, level1: Level1):
        self.level1 = level1
        self._reset()

    def _reset(self):
        import numpy as np

        self.place = _Places()
        self.ids, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __call__(self, group):
        """Places of all tokens of the segments, the end token included."""
        import numpy as np

        if len(self.place) > WORD_BUFFER:
            self._reset()
        known, size = len(self.place), sum(len(words) + last for _, words, _, last in group)
        end = (END,)
        tokens = chain.from_iterable(part for _, words, _, last in group for part in (words, end if last else ()))
        out = np.fromiter(map(self.place.__getitem__, tokens), np.int64, size)
        new = len(self.place) - known
        if new:
            hashes = np.fromiter(map(word_hash, islice(self.place, known, None)), np.uint64, new)
            order = np.argsort(hashes)
            ids, counts = np.empty(new, np.int64), np.empty(new, np.int64)
            ids[order], counts[order] = self.level1.find(hashes[order])
            self.ids, self.counts = np.concatenate([self.ids, ids]), np.concatenate([self.counts, counts])
        return out


def _contexts(group, ids, begin: int, carry: int):
    """Previous id of every token, rows and segment starts."""
    import numpy as np

    n = np.array([len(words) + last for _, words, _, last in group])
    starts = np.cumsum(n) - n
    prev = np.empty(len(ids), np.int64)
    prev[1:] = ids[:-1]
    for s, k, (_, _, first, _) in zip(starts, n, group, strict=True):
        if first and k:
            prev[s] = begin
        elif s == 0 and k:
            prev[0] = carry
    return prev, n


def _runs(sorted_keys):
    """Distinct keys and their counts."""
    import numpy as np

    first = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
    return sorted_keys[first], np.diff(np.append(first, len(sorted_keys)))


def _blobs(shards, keys, counts):
    """One row (shard, keys, counts) per shard of the sorted keys, compressed."""
    import numpy as np
    import pyarrow as pa
    import zstandard as zs

    z = zs.ZstdCompressor(level=1)
    names, which = _runs(shards)
    ends = np.cumsum(which)
    kb, cb = [], []
    for e, n in zip(ends, which, strict=True):
        part = keys[e - n : e].view(np.uint64)
        step = np.diff(part, prepend=np.uint64(0))
        # byte planes of the differences: the high ones are zeros
        kb.append(z.compress(step.view(np.uint8).reshape(-1, 8).T.tobytes()))
        cb.append(z.compress(counts[e - n : e].astype(np.int64).view(np.uint8).reshape(-1, 8).T.tobytes()))
    arrays = [pa.array(names, pa.int32()), pa.array(kb, pa.binary()), pa.array(cb, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, names=["shard", "keys", "counts"])


def _unblob(blob):
    import numpy as np
    import zstandard as zs

    planes = np.frombuffer(zs.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(np.uint64)


def _merge(table):
    """Distinct sorted keys and summed counts of all blobs of a shard; runs
    are folded together whenever the pending ones outgrow what is merged."""
    import numpy as np

    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    pending: list[tuple] = []

    def fold():
        k = np.concatenate([keys, *[p[0] for p in pending]])
        c = np.concatenate([counts, *[p[1] for p in pending]])
        order = np.argsort(k, kind="stable")
        k, c = k[order], c[order]
        first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
        return k[first], np.add.reduceat(c, first) if len(k) else c

    waiting = 0
    for kb, cb in zip(table.column("keys"), table.column("counts"), strict=True):
        pending.append((np.cumsum(_unblob(kb.as_py()), dtype=np.uint64), _unblob(cb.as_py()).view(np.int64)))
        waiting += len(pending[-1][0])
        if waiting > max(1_000_000, len(keys)):
            (keys, counts), pending, waiting = fold(), [], 0
    return fold()


_BLOB = "shard int, keys binary, counts binary"


def _count_words(train: DataFrame, bits: int) -> DataFrame:
    def run(batches):
        from collections import Counter

        import numpy as np

        seen: Counter = Counter()

        def flush():
            hashes = np.fromiter(map(word_hash, seen), np.uint64, len(seen))
            counts = np.fromiter(seen.values(), np.int64, len(seen))
            order = np.argsort(hashes)
            hashes, counts = hashes[order], counts[order]
            shards = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
            seen.clear()
            return _blobs(shards, hashes, counts)

        for batch in batches:
            for _, words, _, last in segments(batch.column(0).to_pylist()):
                seen.update(words)
                if last:
                    seen[END] += 1
                if len(seen) > WORD_BUFFER:
                    yield flush()
        if seen:
            yield flush()

    return train.mapInArrow(run, _BLOB)


def _write_words(blobs: DataFrame, folder: str, bits: int) -> DataFrame:
    def build(table):
        import numpy as np
        import pyarrow as pa

        from condmon.llm.eliasfano import encode

        shard = table.column("shard")[0].as_py()
        hashes, counts = _merge(table)
        hashes = hashes & np.uint64((1 << 64 - bits) - 1)
        total = int(counts.sum())
        running = np.concatenate([[0], np.cumsum(counts)]).astype(np.uint64)
        words = np.concatenate([encode(hashes, 1 << 64 - bits), encode(running, total + 1)])
        _publish(folder, f"words-{shard:06d}", words)
        return pa.table({"shard": pa.array([shard], pa.int32()), "n": [len(hashes)], "tokens": [total]})

    return blobs.groupBy("shard").applyInArrow(build, "shard int, n bigint, tokens bigint")


def _count_pairs(train: DataFrame, trie: Trie) -> DataFrame:
    shared = train.sparkSession.sparkContext.broadcast(trie)

    def run(batches):
        import numpy as np

        trie = shared.value
        level1, level2 = trie.levels()
        look = Lookup(level1)
        firsts = np.array([level2.first(k) for k in range(trie.shards + 1)])
        waiting, size = [], 0

        def flush():
            keys = np.concatenate(waiting)
            keys.sort()
            keys, counts = _runs(keys)
            shards = np.searchsorted(firsts, keys >> _ID_BITS, "right") - 1
            return _blobs(shards, keys, counts)

        for batch in batches:
            carry = -1
            for group in segment_groups(batch.column(0).to_pylist()):
                place = look(group)
                ids = look.ids[place]
                prev, _ = _contexts(group, ids, trie.begin, carry)
                carry = int(ids[-1]) if len(ids) else carry
                waiting.append(prev << _ID_BITS | ids)
                size += len(ids)
                if size >= PAIR_BUFFER:
                    yield flush()
                    waiting, size = [], 0
        if size:
            yield flush()

    return train.mapInArrow(run, _BLOB)


def _few_runs(blobs: DataFrame, fan: int = FAN) -> DataFrame:
    """The same counts in at most ``fan`` (2 or more) runs per shard.  A task
    merges about ``fan`` runs of a shard; only the largest number of runs of a
    shard comes to the driver, once per round."""

    def merge(table):
        import numpy as np
        import pyarrow as pa

        keys, counts = _merge(table)
        shards = np.full(len(keys), table.column("shard")[0].as_py())
        return pa.Table.from_batches([_blobs(shards, keys, counts)])

    blobs = save(blobs, "ngram-runs")
    while True:
        most = blobs.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
        if most <= fan:
            return blobs
        # ids of a written table, hashed as they may go in step with the shards
        salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(-(-most // fan)))
        blobs = save(
            blobs.withColumn("salt", salt).groupBy("shard", "salt").applyInArrow(merge, _BLOB), "ngram-runs"
        )


def _write_pairs(blobs: DataFrame, trie: Trie) -> DataFrame:
    shared = blobs.sparkSession.sparkContext.broadcast(trie)

    def build(table):
        import numpy as np
        import pyarrow as pa

        from condmon.llm.eliasfano import encode

        trie = shared.value
        level1, level2 = trie.levels()
        shard = table.column("shard")[0].as_py()
        keys, counts = _merge(table)
        keys = keys.view(np.int64)
        first, size = level2.first(shard), level2.first(shard + 1) - level2.first(shard)
        ctx, word = (keys >> _ID_BITS) - first, keys & (1 << _ID_BITS) - 1
        types = np.bincount(ctx, minlength=size)
        total = np.bincount(ctx, counts, minlength=size)
        ends = np.cumsum(types)
        # P1 of the children: counts by ascending id
        order = np.argsort(word)
        unigram = np.empty(len(word))
        unigram[order] = 10.0 ** trie.log_unigram(level1.counts(word[order]))
        back = DISCOUNT * types / np.maximum(total, 1)
        p = np.maximum(counts - DISCOUNT, 0) / total[ctx] + back[ctx] * unigram
        span = np.zeros(size, np.int64)
        some = types > 0
        span[some] = word[ends[some] - 1] + 1
        base = np.cumsum(span) - span
        code = lambda x: np.clip(np.rint(-np.log10(x) / STEP), 0, 65535).astype(np.uint16)
        words = [
            encode(np.concatenate([[0], ends]).astype(np.uint64), len(keys) + 1),
            encode((base[ctx] + word).astype(np.uint64), int(span.sum()) + 1),
            _pad(code(p)),
            _pad(code(np.where(some, back, 1.0))),
        ]
        _publish(trie.folder, f"pairs-{shard:06d}", np.concatenate(words))
        return pa.table({"shard": pa.array([shard], pa.int32()), "n": [len(keys)]})

    return blobs.groupBy("shard").applyInArrow(build, "shard int, n bigint")


def train(docs: DataFrame, folder: str | None = None, shard_bytes: int = SHARD_BYTES) -> Trie:
    """Build the trie of ``docs(text)`` in the shared folder.  Of the files
    only their sizes come to the driver (a row per shard)."""
    import numpy as np

    spark = docs.sparkSession
    bound_batches(spark)
    folder = local_path(folder or work_dir(spark, "ngram-trie"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    bits = max(1, (shards - 1).bit_length())
    texts = docs.select(F.col("text").cast("binary"))
    meta = _write_words(_count_words(texts, bits), folder, bits).collect()
    n = np.zeros((1 << bits) + 1, np.int64)
    for r in meta:
        n[r["shard"] + 1] = r["n"]
    trie = Trie(folder, bits, np.cumsum(n), sum(r["tokens"] for r in meta), int(shards))
    if trie.vocabulary >= 1 << _ID_BITS - 1:  # a context and a word share a signed 64-bit key
        raise ValueError("more than 2^31 distinct words")
    _write_pairs(_few_runs(_count_pairs(texts, trie)), trie).agg(F.sum("n")).first()
    return trie


def score(docs: DataFrame, trie: Trie, keep=("doc_id",)) -> DataFrame:
    """``keep`` columns, ``n_tokens, n_known, base_score, score`` per text."""
    shared = docs.sparkSession.sparkContext.broadcast(trie)

    def make():
        import numpy as np

        trie = shared.value
        level1, level2 = trie.levels()
        look = Lookup(level1)

        def fn(texts):
            out = np.zeros((4, len(texts)))
            carry = -1
            for group in segment_groups(texts):
                place = look(group)
                ids, unigram = look.ids[place], trie.log_unigram(look.counts)[place]
                prev, n = _contexts(group, ids, trie.begin, carry)
                carry = int(ids[-1]) if len(ids) else carry
                logp = unigram.copy()
                # contexts that are known; an unknown word backs off like an unseen one
                ask = np.flatnonzero(prev >= 0)
                key = prev[ask] << _ID_BITS | np.where(ids[ask] < 0, (1 << _ID_BITS) - 1, ids[ask])
                order = np.argsort(key)
                distinct, times = _runs(key[order]) if len(key) else (key, key)
                at = np.cumsum(times) - times
                found = level2.find(distinct, unigram[ask[order[at]]]) if len(key) else key
                logp[ask[order]] = np.repeat(found, times)
                rows = np.repeat([row for row, _, _, _ in group], n)
                for k, x in enumerate((np.ones(len(ids)), ids >= 0, unigram, logp)):
                    out[k] += np.bincount(rows, x, minlength=len(texts))
            return [out[0].astype(np.int64).tolist(), out[1].astype(np.int64).tolist(), out[2].tolist(), out[3].tolist()]

        return fn

    fields = [("n_tokens", "bigint"), ("n_known", "bigint"), ("base_score", "double"), ("score", "double")]
    return map_texts(docs, "text", keep, fields, make)


def score_corpus(docs: DataFrame) -> DataFrame:
    """Train on the documents outside the held-out fold and score all."""
    held = held_out(F.col("doc_id"), FOLDS, HELD_OUT)
    trie = train(docs.where(~held).select("text"))
    return score(docs, trie).select(
        "doc_id",
        held.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(trie.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
