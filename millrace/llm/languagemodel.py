"""A hierarchical Pitman-Yor language model, learned and applied as Spark jobs.

Each previous word (or the begin of a text) is a restaurant whose customers are the words seen
after it; a table serves one word, and every table is a customer of the unigram restaurant,
whose parent is uniform over the known words and one unknown word. Texts are blocks of
word numbers, and the pairs (previous word, word) and the words are dealt over many buckets
and parts by their hashes, so neither the corpus nor the vocabulary ever passes through one
task or the driver.

Seating is sampled by Gibbs: the customers of a word in a restaurant leave and sit down again
one by one, each joining a table or opening one with the model's odds given all others, and
the arrangement is taken with its Metropolis-Hastings chance. The predictive probabilities of
several samples are averaged. ``_Block``, ``_merge``, ``_Part`` and ``_answer`` are the same
seating and prediction over numpy arrays of one part, with classes of words as contexts.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.frames import dropped, saved, slices, table, texts_of
from millrace.llm.langid import remainder
from millrace.llm.words import mix, words_of

#: Context classes; the last is the begin of a text.
CONTEXTS = 256
#: Bytes of text that one block, and one bucket of pairs or part of the words, stands for. Each block
#: asks each of them once, so a large corpus takes larger ones (and executors with the memory for them).
BLOCK_BYTES, PART_BYTES = 16 << 20, 16 << 20
SLICE = 256 << 10
#: Rounds of seating: first to settle with starting totals, then one for each sample.
SETTLE, SAMPLES = 2, 3
STRENGTH = 1.0
#: Customers seated one by one; beyond, in groups of a twentieth of those that sit.
SINGLY = 64
END = np.uint64(0x2545F4914F6CDD1D)

_BLOCKS = ("block binary, part int, doc_ids array<long>, held_out array<boolean>, lengths binary, tokens binary, "
           "words binary, firsts binary, contexts binary, counts binary")


def _contexts(words) -> np.ndarray:
    """The class of each word as a context: by its last three bytes."""
    data = np.frombuffer(words.data, np.uint8)
    ending = np.zeros(len(words.starts), np.uint64)
    for back in (1, 2, 3):
        at = words.ends - back
        ending = ending << np.uint64(8) | np.where(at >= words.starts, data[np.maximum(at, 0)], 0).astype(np.uint64)
    return (mix(ending) % np.uint64(CONTEXTS - 1)).astype(np.uint8)


def _planes(values: np.ndarray) -> bytes:
    """32-bit numbers byte plane after byte plane, which compress well."""
    return values.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplaned(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel()


def _before(classes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The context of each token: the class of the word before it, or the begin of its text."""
    out = np.empty(len(classes), np.uint8)
    out[1:] = classes[:-1]
    out[np.cumsum(lengths) - lengths] = CONTEXTS - 1
    return out


class _Block:
    """Texts gathered into tokens: their word's hash and its class as a context."""

    def __init__(self):
        self.docs, self.held, self.lengths, self.words, self.classes, self.size = [], [], [], [], [], 0

    def add(self, docs: list, held: list[bool], texts: list[str]) -> None:
        found = words_of(texts)
        lengths = np.diff(found.first)
        inner = np.ones(int(lengths.sum()) + len(texts), bool)
        inner[np.cumsum(lengths + 1) - 1] = False
        words, classes = np.full(len(inner), END), np.zeros(len(inner), np.uint8)
        words[inner] = found.hashes
        classes[inner] = _contexts(found)
        self.words.append(words)
        self.classes.append(classes)
        self.docs += docs
        self.held += held
        self.lengths.append(lengths + 1)
        self.size += len(found.data)

    def rows(self, parts: int) -> Iterator[pa.RecordBatch]:
        """One row with the block's tokens, and one for each part with what is asked of it."""
        lengths = np.concatenate(self.lengths)
        distinct, word = np.unique(np.concatenate(self.words), return_inverse=True)
        word = word.astype(np.uint32)
        of_word = np.zeros(len(distinct), np.uint8)
        classes = np.concatenate(self.classes)
        of_word[word] = classes
        # Frequent words get small numbers.
        order = np.argsort(-np.bincount(word, minlength=len(distinct)), kind="stable").astype(np.uint32)
        rank = np.empty(len(distinct), np.uint32)
        rank[order] = np.arange(len(distinct), dtype=np.uint32)
        block = os.urandom(12)
        yield self._row(block, -1, doc_ids=self.docs, held_out=self.held, lengths=lengths.astype(np.int32).tobytes(),
                        tokens=_planes(rank[word]), words=_planes(order), contexts=of_word.tobytes())
        pairs, token = np.unique(_pairs(word, _before(classes, lengths)), return_inverse=True)
        learned = np.repeat(~np.array(self.held, bool), lengths)
        counts = np.bincount(token[learned], minlength=len(pairs))
        # Words are sorted by hash, so parts are stretches of them.
        bounds = np.searchsorted(distinct, _part_bounds(parts))
        owner = pairs // CONTEXTS
        for part in range(parts):
            a, b = bounds[part], bounds[part + 1]
            if a < b:
                x, y = np.searchsorted(owner, [a, b])
                starts = np.searchsorted(owner[x:y], np.arange(a, b)).astype(np.uint32)
                yield self._row(block, part, words=distinct[a:b].tobytes(), firsts=_planes(starts),
                                contexts=(pairs[x:y] % CONTEXTS).astype(np.uint8).tobytes(), counts=_planes(counts[x:y]))

    @staticmethod
    def _row(block: bytes, part: int, **values) -> pa.RecordBatch:
        names = ("doc_ids", "held_out", "lengths", "tokens", "words", "firsts", "contexts", "counts")
        kinds = dict.fromkeys(names, pa.binary()) | {"doc_ids": pa.list_(pa.int64()), "held_out": pa.list_(pa.bool_())}
        return pa.RecordBatch.from_arrays([pa.array([block], pa.binary()), pa.array([part], pa.int32())]
                                          + [pa.array([values.get(n)], kinds[n]) for n in names], ["block", "part", *names])


def _pairs(words: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """One number for a block's word and a context; they sort as the words do."""
    return words.astype(np.int64) * CONTEXTS + contexts


def _part_bounds(parts: int) -> np.ndarray:
    return np.array([min(i * (1 << 64) // parts, (1 << 64) - 1) for i in range(parts)] + [(1 << 64) - 1], np.uint64)


def _merge(rows: pd.DataFrame) -> pd.DataFrame:
    """One part's counts over all blocks, without words that were not learned from."""
    words, contexts, counts = [], [], []
    for row in rows.itertuples(index=False):
        own, firsts = np.frombuffer(row.words, np.uint64), _unplaned(row.firsts)
        kind = np.frombuffer(row.contexts, np.uint8)
        words.append(np.repeat(own, np.diff(np.append(firsts, len(kind)).astype(np.int64))))
        contexts.append(kind)
        counts.append(_unplaned(row.counts))
    words, contexts, counts = np.concatenate(words), np.concatenate(contexts), np.concatenate(counts).astype(np.int64)
    seen = counts > 0
    words, contexts, counts = words[seen], contexts[seen], counts[seen]
    order = np.lexsort((contexts, words))
    words, contexts, counts = words[order], contexts[order], counts[order]
    new = np.flatnonzero(np.diff(words, prepend=~words[:1]).astype(bool) | np.diff(contexts.astype(np.int16), prepend=-1).astype(bool))
    counts = np.add.reduceat(counts, new) if len(new) else counts
    words, contexts = words[new], contexts[new]
    distinct, firsts = np.unique(words, return_index=True)
    total = np.add.reduceat(counts, firsts) if len(firsts) else counts
    # Totals: customers and tables of the contexts, words, tokens, and how many counts are one and two.
    sums = np.concatenate([np.bincount(contexts, counts, CONTEXTS), np.bincount(contexts, minlength=CONTEXTS),
                           [len(distinct), counts.sum(), (counts == 1).sum(), (counts == 2).sum(), (total == 1).sum(), (total == 2).sum()]])
    tables = np.ones((1, len(counts) + len(distinct)), np.uint32)
    return pd.DataFrame({"part": rows["part"].iloc[:1].astype("int32").to_numpy(), "words": [distinct.tobytes()], "firsts": [_planes(firsts)],
                         "contexts": [contexts.tobytes()], "counts": [_planes(counts)], "tables": [_planes(tables)], "sums": [sums.tolist()]})


def _discount(ones: float, twos: float) -> float:
    return float(np.clip(ones / max(1.0, ones + 2 * twos), 0.1, 0.95))


def seated(counts: np.ndarray, strength: np.ndarray, discount: float, pick: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Seats the customers of each word again: the tables, and the log weight of the seating.

    ``strength`` is the weight of a new table, (theta + discount * tables) * parent.
    """
    order = np.argsort(-counts, kind="stable")
    left, power = counts[order], strength[order]
    tables, weight = np.ones(len(counts)), np.zeros(len(counts))
    sitting = 1
    active = int(np.searchsorted(-left, -sitting, "left"))
    while active:
        group = 1 if sitting < SINGLY else sitting // 20
        now = np.minimum(group, left[:active] - sitting)
        base = sitting - discount * tables[:active] + power[:active]
        chance = np.minimum(1.0, power[:active] / base)
        opened = (pick.random(active) < chance) if group == 1 else pick.binomial(now, chance)
        tables[:active] += opened
        weight[:active] += now * np.log(base)
        sitting += group
        active = int(np.searchsorted(-left, -sitting, "left"))
    out, weights = np.empty(len(counts)), np.empty(len(counts))
    out[order], weights[order] = np.minimum(tables, left), weight
    return out, weights


class _Part:
    """The customers of a part's words, with the totals of the other parts."""

    def __init__(self, row, totals: dict):
        self.words = np.frombuffer(row["words"], np.uint64)
        self.firsts = _unplaned(row["firsts"]).astype(np.int64)
        self.contexts = np.frombuffer(row["contexts"], np.uint8)
        self.counts = _unplaned(row["counts"]).astype(np.int64)
        self.tables = _unplaned(row["tables"]).reshape(len(totals["sums"]), len(self.counts) + len(self.words)).astype(np.float64)
        self.totals = totals

    def gather(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.firsts) if len(self.firsts) else np.empty(0)

    def parent(self, tables: np.ndarray, tops: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """The unigram restaurant's probability of each word."""
        t = self.totals
        return (self.gather(tables) - t["d0"] * tops + (STRENGTH + t["d0"] * sums[-1]) / (t["words"] + 1)) / (STRENGTH + sums[-2])

    def sampled(self, rounds: int, seed: list[int]) -> np.ndarray:
        """Tables of each round, contexts' and then the unigram restaurant's, round by round."""
        pick, t, n = np.random.default_rng(seed), self.totals, len(self.counts)
        sums = t["sums"][-1]
        tables, tops = self.tables[-1][:n], self.tables[-1][n:]
        several = np.flatnonzero(self.counts > 1)
        of_word = np.repeat(np.arange(len(self.words)), np.diff(np.append(self.firsts, n)))
        held, out = None, []
        for _ in range(rounds):
            prior = self.parent(tables, tops, sums)
            strength = (STRENGTH + t["d1"] * sums[:CONTEXTS])[self.contexts] * prior[of_word]
            new, weight = seated(self.counts[several], strength[several], t["d1"], pick)
            # The weight of the seating that is held is the one it had when it was made.
            take = np.ones(len(several), bool) if held is None else np.log(pick.random(len(several))) < weight - held
            tables = tables.copy()
            tables[several[take]] = new[take]
            held = weight if held is None else np.where(take, weight, held)
            customers = self.gather(tables).astype(np.int64)
            top_strength = np.full(len(self.words), (STRENGTH + t["d0"] * sums[-1]) / (t["words"] + 1))
            # The number of customers changes with the tables below, so these sit anew each time.
            tops, _ = seated(customers, top_strength, t["d0"], pick)
            out.append(np.concatenate([tables, tops]))
        return np.array(out).reshape(rounds, n + len(self.words))


def _sums_of(part: _Part, tables: np.ndarray) -> list[float]:
    """For each round: tables of the contexts, then customers and tables of the unigram restaurant."""
    n = len(part.counts)
    return np.concatenate([np.concatenate([np.bincount(part.contexts, row[:n], CONTEXTS), [row[:n].sum(), row[n:].sum()]]) for row in tables]).tolist()


def _answer(questions: pd.DataFrame, state: pd.DataFrame, totals: dict) -> pd.DataFrame:
    """For each block's words and contexts the averaged probability and the training count."""
    part = _Part(state.iloc[0], totals) if len(state) else None
    n = 0 if part is None else len(part.counts)
    keys = np.empty(0, np.uint64) if part is None else np.repeat(part.words, np.diff(np.append(part.firsts, n)))
    order_key = _pair_key(keys, part.contexts if part else np.empty(0, np.uint8))
    sort = np.argsort(order_key)
    word_total = part.gather(part.counts).astype(np.uint32) if part else np.empty(0, np.uint32)
    priors = [part.parent(row[:n], row[n:], sums) for row, sums in zip(part.tables, totals["sums"], strict=True)] if part else []
    customers = totals["customers"]
    out = []
    for row in questions.itertuples(index=False):
        words, firsts = np.frombuffer(row.words, np.uint64), _unplaned(row.firsts).astype(np.int64)
        contexts = np.frombuffer(row.contexts, np.uint8)
        each = np.diff(np.append(firsts, len(contexts)))
        at = np.searchsorted(part.words, words) if part else np.zeros(len(words), np.int64)
        known = part.words[np.minimum(at, len(part.words) - 1)] == words if part and len(part.words) else np.zeros(len(words), bool)
        at = np.where(known, at, 0)
        wanted = _pair_key(np.repeat(words, each), contexts)
        place = np.searchsorted(order_key, wanted, sorter=sort)
        pair = sort[np.minimum(place, n - 1)] if n else np.zeros(len(wanted), np.int64)
        met = order_key[pair] == wanted if n else np.zeros(len(wanted), bool)
        mean = np.zeros(len(contexts))
        for s, sums in enumerate(totals["sums"]):
            unknown = (STRENGTH + totals["d0"] * sums[-1]) / (totals["words"] + 1) / (STRENGTH + sums[-2])
            prior = np.where(known, priors[s][at], unknown) if n else np.full(len(words), unknown)
            own = np.where(met, part.counts[pair] - totals["d1"] * part.tables[s][pair], 0.0) if n else 0.0
            mean += (own + (STRENGTH + totals["d1"] * sums[:CONTEXTS])[contexts] * np.repeat(prior, each)) / (STRENGTH + customers[contexts])
        counts = np.where(known, word_total[at], 0).astype(np.uint32) if n else np.zeros(len(words), np.uint32)
        out.append((row.block, row.part, (mean / len(totals["sums"])).astype(np.float32).tobytes(), _planes(np.repeat(counts, each))))
    return pd.DataFrame(out, columns=["block", "part", "probabilities", "known"])


def _pair_key(words: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    return mix(words ^ (contexts.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))


#: The begin of a text as a context; no word's hash but by chance, as END.
BEGIN = ~END
#: What a row carries: a block's texts, the state of a bucket of pairs or of a part of the words, a
#: message about words or previous words, or the places in a bucket's state of the pairs of a block.
TEXTS, PAIRS, OWNED, WORDS, PREVS, PLACES = range(6)
_ROWS = "at int, kind int, src int, block binary, data binary, moving binary, sums array<double>"
_ARROW = pa.schema([("at", pa.int32()), ("kind", pa.int32()), ("src", pa.int32()), ("block", pa.binary()), ("data", pa.binary()),
                    ("moving", pa.binary()), ("sums", pa.list_(pa.float64()))])
_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
_KINDS = ("u1", "u2", "u4", "u8", "f8")
#: Drops an action's shuffle files when it has ended; else they stay until the driver collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers (integers from 0) as one value, byte plane after byte plane, compressed."""
    heads, planes = [len(arrays)], []
    for a in arrays:
        most = 0 if a.dtype.kind == "f" or not len(a) else int(a.max())
        kind = 4 if a.dtype.kind == "f" else next(k for k in range(4) if most < 1 << (8 << k))
        a = np.ascontiguousarray(a, _KINDS[kind])
        heads += [kind, len(a)]
        planes.append(a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes())
    raw = np.array(heads, np.int64).tobytes() + b"".join(planes)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unpacked(data: bytes) -> list[np.ndarray]:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    heads = np.frombuffer(raw, np.int64, 1 + 2 * n)[1:].reshape(n, 2).tolist()
    at, out = 8 * (1 + 2 * n), []
    for kind, size in heads:
        width = np.dtype(_KINDS[kind]).itemsize
        planes = np.frombuffer(raw, np.uint8, size * width, at).reshape(width, size)
        out.append(planes.T.copy().view(_KINDS[kind]).reshape(size))
        at += size * width
    return out


def _gaps(hashes: np.ndarray) -> np.ndarray:
    """Sorted hashes as differences, which compress better; their running sum gives them back."""
    return np.diff(hashes, prepend=np.uint64(0))


def _part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return np.minimum(np.searchsorted(_part_bounds(parts), hashes, "right") - 1, parts - 1)


def _stretches(numbers: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Each number of a sorted array with the start and the end of its stretch."""
    starts = np.flatnonzero(np.diff(numbers, prepend=-1))
    ends = np.append(starts, len(numbers))[1:]
    return zip(numbers[starts].tolist(), starts.tolist(), ends.tolist(), strict=True)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct keys, and the place of each key among them; np.unique needs more memory."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    place = np.empty(len(keys), np.int32 if len(keys) < 1 << 31 else np.int64)
    place[order] = np.cumsum(new, dtype=place.dtype) - place.dtype.type(1)
    return keys[new], place


def _summed(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(at, values, size).astype(np.int64)


def _row(at: int, kind: int, src: int = -1, block: bytes | None = None, data: bytes | None = None, moving: bytes | None = None,
         sums: list[float] | None = None) -> dict:
    return {"at": at, "kind": kind, "src": src, "block": block, "data": data, "moving": moving, "sums": sums}


class _Texts:
    """Texts gathered into one block: their tokens, as numbers of the block's own sorted words."""

    def __init__(self):
        self.ids, self.held, self.lengths, self.hashes, self.size = [], [], [], [], 0

    def add(self, batch: pa.RecordBatch) -> None:
        texts = texts_of(batch)
        found = words_of(texts)
        lengths = np.diff(found.first)
        inner = np.ones(int(lengths.sum()) + len(texts), bool)
        inner[np.cumsum(lengths + 1) - 1] = False
        hashes = np.full(len(inner), END)
        hashes[inner] = found.hashes
        self.ids += batch.column("doc_id").to_pylist()
        self.held += batch.column("held").to_pylist()
        self.lengths.append(lengths + 1)
        self.hashes.append(hashes)
        self.size += len(found.data)

    def row(self) -> dict:
        words, token = _distinct(np.concatenate([*self.hashes, np.array([BEGIN])]))
        token = token[:-1]
        # Frequent words get small numbers, which compress better.
        order = np.argsort(-np.bincount(token, minlength=len(words)), kind="stable")
        rank = np.empty(len(words), np.int32)
        rank[order] = np.arange(len(words), dtype=np.int32)
        ids = np.array([i or 0 for i in self.ids], np.int64).view(np.uint64)
        data = _packed(ids, np.array([i is None for i in self.ids]), np.array(self.held, bool), np.concatenate(self.lengths), rank[token],
                       order, _gaps(words))
        return _row(-1, TEXTS, block=os.urandom(12), data=data, sums=[float(self.size)])


def _blocks(most: int):
    """Gathers the texts of a task into blocks of about ``most`` bytes."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = _Texts()
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                texts.add(part)
                if texts.size >= most:
                    yield pa.RecordBatch.from_pylist([texts.row()], _ARROW)
                    texts = _Texts()
        if texts.ids:
            yield pa.RecordBatch.from_pylist([texts.row()], _ARROW)

    return gather


class _Tokens:
    """A block's tokens and their distinct pairs, dealt to a grid of groups of previous words by groups of words."""

    def __init__(self, data: bytes, side: int):
        ids, nulls, held, lengths, rank, order, gaps = _unpacked(data)
        self.ids, self.nulls, self.held, self.lengths = ids.astype(np.uint64).view(np.int64), nulls.astype(bool), held.astype(bool), lengths.astype(np.int64)
        self.words = np.cumsum(gaps, dtype=np.uint64)
        self.token = order.astype(np.int32)[rank]
        n = len(self.words)
        key = np.empty(len(self.token), np.int64)
        key[1:] = self.token[:-1]
        key[np.cumsum(self.lengths) - self.lengths] = np.searchsorted(self.words, BEGIN)
        key *= n
        key += self.token
        pairs, self.pair = _distinct(key)
        self.prev, self.word = pairs // n, pairs % n
        group = _part_of(self.words, side * side) // side
        bucket = group[self.prev] * side + group[self.word]
        # The pairs in the order in which their buckets are asked.
        self.order = np.argsort(bucket, kind="stable")
        self.bucket = bucket[self.order]

    def learned(self) -> np.ndarray:
        return np.bincount(self.pair[np.repeat(~self.held, self.lengths)], minlength=len(self.prev))


def _asked_pairs(side: int):
    """From each block to each bucket: the block's distinct pairs there, and how often it learns from them."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            tokens = _Tokens(row["data"], side)
            counts, out = tokens.learned(), []
            for bucket, a, b in _stretches(tokens.bucket):
                own = tokens.order[a:b]
                prevs, runs = np.unique(tokens.prev[own], return_counts=True)
                words, word = np.unique(tokens.word[own], return_inverse=True)
                data = _packed(_gaps(tokens.words[prevs]), runs, _gaps(tokens.words[words]), word, counts[own])
                out.append(_row(bucket, TEXTS, block=row["block"], data=data))
            yield pa.RecordBatch.from_pylist(out, _ARROW)

    return ask


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(len(batch)):
            yield batch.slice(i, 1).to_pylist()[0]


class _Bucket:
    """The pairs that all blocks have in one bucket, sorted, and how often they were learned from."""

    def __init__(self, asked: list[dict]):
        got = [_unpacked(row["data"]) for row in asked]
        prevs = [np.cumsum(x[0], dtype=np.uint64) for x in got]
        words = [np.cumsum(x[2], dtype=np.uint64) for x in got]
        self.prevs, self.words = np.unique(np.concatenate(prevs)), np.unique(np.concatenate(words))
        n = len(self.words)
        keys = [np.repeat(np.searchsorted(self.prevs, p), x[1].astype(np.int64)) * n + np.searchsorted(self.words, w)[x[3]]
                for p, w, x in zip(prevs, words, got, strict=True)]
        self.sizes = [len(k) for k in keys]
        pairs, self.at = _distinct(np.concatenate(keys))
        self.prev, self.word = pairs // n, pairs % n
        self.counts = _summed(self.at, np.concatenate([x[4] for x in got]), len(pairs))


def _counted(side: int):
    """A bucket's counts: its pairs that were seen more than once as its state, sums of all to the owners of the words,
    and for each block the counts of its pairs and the places in the state of those seen more than once."""
    parts = side * side

    def count(key: tuple, table: pa.Table) -> pa.Table:
        rows, at = table.to_pylist(), key[0].as_py()
        own = _Bucket(rows)
        c, out = own.counts, []
        one, more = c == 1, c > 1
        place, ends = np.cumsum(more) - 1, np.cumsum(own.sizes)
        for row, size, end in zip(rows, own.sizes, ends, strict=True):
            asked = own.at[end - size:end]
            out.append(_row(at, PLACES, block=row["block"], data=_packed(c[asked], place[asked[more[asked]]])))
        for kind, hashes, of in ((WORDS, own.words, own.word), (PREVS, own.prevs, own.prev)):
            n, ones, several = (_summed(of, x, len(hashes)) for x in (c, one, more))
            seen = n > 0
            hashes, n, ones, several = hashes[seen], n[seen], ones[seen], several[seen]
            for part, a, b in _stretches(_part_of(hashes, parts)):
                out.append(_row(part, kind, at, data=_packed(_gaps(hashes[a:b]), n[a:b], ones[a:b], several[a:b])))
        prevs, prev = np.unique(own.prev[more], return_inverse=True)
        words, word = np.unique(own.word[more], return_inverse=True)
        m = int(more.sum())
        data = _packed(_gaps(own.prevs[prevs]), np.bincount(prev, minlength=len(prevs)), _gaps(own.words[words]), word, c[more])
        out.append(_row(at, PAIRS, data=data, moving=_packed(np.ones(m, np.int64), np.full(m, np.nan)),
                        sums=[float((c > 0).sum()), float(one.sum()), float((c == 2).sum())]))
        return pa.Table.from_pylist(out, _ARROW)

    return count


def _owned(key: tuple, table: pa.Table) -> pa.Table:
    """The words of one part with their sums, and which of them each bucket asks for in each round."""
    rows = table.to_pylist()
    got = [_unpacked(row["data"]) for row in rows]
    hashes = [np.cumsum(x[0], dtype=np.uint64) for x in got]
    words = np.unique(np.concatenate(hashes))
    sums, heads, asked = np.zeros((2, 3, len(words)), np.int64), [], []
    for row, own, x in zip(rows, hashes, got, strict=True):
        at = np.searchsorted(words, own)
        for k in range(3):
            sums[row["kind"] - WORDS, k, at] += x[1 + k].astype(np.int64)
        if len(several := at[x[3] > 0]):
            heads.append((row["kind"], row["src"], len(several)))
            asked.append(several)
    (n, ones, several), (customers, prev_ones, prev_several) = sums
    data = _packed(_gaps(words), n, ones, customers, prev_ones, np.array(heads, np.int64).reshape(-1), np.concatenate([*asked, np.empty(0, np.int64)]))
    # To start, one table for each restaurant's word, and one in the unigram restaurant.
    moving = _packed(ones + several, (n > 0).astype(np.int64), prev_several)
    known = [float((n > 0).sum()), float(n.sum()), float((n == 1).sum()), float((n == 2).sum())]
    return pa.Table.from_pylist([_row(key[0].as_py(), OWNED, data=data, moving=moving, sums=known)], _ARROW)


class _Owner:
    """One part of the words: what was counted of each, the moving totals, and those of the samples kept."""

    def __init__(self, row: dict):
        gaps, *rest = _unpacked(row["data"])
        self.words = np.cumsum(gaps, dtype=np.uint64)
        self.n, self.ones, self.customers, self.prev_ones, heads, asked = (x.astype(np.int64) for x in rest)
        self.cu, self.tu, self.tables, *self.kept = (x.astype(np.int64) for x in _unpacked(row["moving"]))
        ends = np.cumsum(heads[2::3])
        self.asked = {(k, s): asked[e - m:e] for k, s, m, e in zip(heads[0::3].tolist(), heads[1::3].tolist(), heads[2::3].tolist(), ends.tolist(), strict=True)}


def _told(known: dict):
    """From each part to each bucket: the unigram probabilities of the words, and the tables of the previous words, that it asks for."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            own = _Owner(row)
            values = {WORDS: _prior(own.cu, own.tu, known, known["tu"], known["cu"]), PREVS: own.prev_ones + own.tables}
            yield pa.RecordBatch.from_pylist([_row(src, kind, row["at"], data=_packed(values[kind][at])) for (kind, src), at in own.asked.items()], _ARROW)

    return tell


def _prior(customers: np.ndarray, tables: np.ndarray, known: dict, tu: float, cu: float) -> np.ndarray:
    """The unigram restaurant's probability of words that have so many customers and tables there."""
    return (customers - known["d0"] * tables + (STRENGTH + known["d0"] * tu) / (known["words"] + 1)) / (STRENGTH + cu)


def _reseated(known: dict, run: int, keep: bool, side: int):
    """Seats again the customers of each restaurant (a previous word) that one word has, for a bucket's pairs."""
    parts = side * side

    def seat(key: tuple, table: pa.Table) -> pa.Table:
        rows, at = sorted(table.to_pylist(), key=lambda row: (row["kind"], row["src"])), key[0].as_py()
        state = next(row for row in rows if row["kind"] == PAIRS)
        prevs, runs, words, word, c = _unpacked(state["data"])
        prevs, words = np.cumsum(prevs, dtype=np.uint64), np.cumsum(words, dtype=np.uint64)
        prev, word, c = np.repeat(np.arange(len(prevs)), runs.astype(np.int64)), word.astype(np.int64), c.astype(np.int64)
        t, held, *ts = _unpacked(state["moving"])
        t = t.astype(np.int64)
        if len(c):
            # Parts are stretches of the sorted hashes, so their answers in order are those for all.
            prior, tables = (np.concatenate([_unpacked(row["data"])[0] for row in rows if row["kind"] == kind]) for kind in (WORDS, PREVS))
            pick = np.random.default_rng([run, at])
            # A restaurant's tables, but for those of the word seated again.
            new, weight = seated(c, (STRENGTH + known["d1"] * (tables.astype(np.int64)[prev] - t)) * prior[word], known["d1"], pick)
            # The weight of the seating that is held is the one it had when it was made.
            take = np.isnan(held) | (np.log(pick.random(len(c))) < weight - np.nan_to_num(held))
            t, held = np.where(take, new, t).astype(np.int64), np.where(take, weight, held)
        out = [_row(at, PAIRS, data=state["data"], moving=_packed(t, held, *ts, *[t] * keep))]
        for kind, hashes, of in ((WORDS, words, word), (PREVS, prevs, prev)):
            sums = _summed(of, t, len(hashes))
            out += [_row(part, kind, at, data=_packed(sums[a:b])) for part, a, b in _stretches(_part_of(hashes, parts))]
        return pa.Table.from_pylist(out, _ARROW)

    return seat


def _updated(known: dict, run: int, keep: bool):
    """Sums the tables of all buckets, and seats the unigram restaurant anew: its customers are the tables of a word below."""

    def update(key: tuple, table: pa.Table) -> pa.Table:
        rows, at = table.to_pylist(), key[0].as_py()
        state = next(row for row in rows if row["kind"] == OWNED)
        own = _Owner(state)
        cu, tables = own.ones.copy(), np.zeros(len(own.words), np.int64)
        for row in rows:
            if row["kind"] != OWNED:
                (cu if row["kind"] == WORDS else tables)[own.asked[row["kind"], row["src"]]] += _unpacked(row["data"])[0].astype(np.int64)
        tu, _ = seated(cu, np.full(len(cu), (STRENGTH + known["d0"] * known["tu"]) / (known["words"] + 1)), known["d0"], np.random.default_rng([run, 1 << 20, at]))
        tu = tu.astype(np.int64)
        moving = _packed(cu, tu, tables, *own.kept, *[cu, tu, own.prev_ones + tables] * keep)
        return pa.Table.from_pylist([_row(at, OWNED, data=state["data"], moving=moving, sums=[float(tu.sum()), float(cu.sum())])], _ARROW)

    return update


def _asked_words(side: int):
    """From each block to each part of the words: the block's words there."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            words = np.cumsum(_unpacked(row["data"])[-1], dtype=np.uint64)
            yield pa.RecordBatch.from_pylist([_row(part, TEXTS, block=row["block"], data=_packed(_gaps(words[a:b])))
                                              for part, a, b in _stretches(_part_of(words, side * side))], _ARROW)

    return ask


def _word_answers(key: tuple, table: pa.Table) -> pa.Table:
    """For each block's words their training counts, as words and as previous words, and the samples' totals."""
    rows = table.to_pylist()
    own = next((_Owner(row) for row in rows if row["kind"] == OWNED), None)
    out = []
    for row in rows:
        if row["kind"] == TEXTS:
            asked = np.cumsum(_unpacked(row["data"])[0], dtype=np.uint64)
            if own is None:
                answers = [np.zeros(len(asked), np.int64)] * (2 + 3 * SAMPLES)
            else:
                at = np.minimum(np.searchsorted(own.words, asked), len(own.words) - 1)
                met = own.words[at] == asked
                answers = [np.where(met, x[at], 0) for x in (own.n, own.customers, *own.kept)]
            out.append(_row(key[0].as_py(), WORDS, key[0].as_py(), row["block"], _packed(*answers)))
    return pa.Table.from_pylist(out, _ARROW)


def _pair_answers(key: tuple, table: pa.Table) -> pa.Table:
    """For each block's pairs their training counts, and the tables in each sample of those seen more than once."""
    rows, at = table.to_pylist(), key[0].as_py()
    ts = _unpacked(next(row["moving"] for row in rows if row["kind"] == PAIRS))[2:]
    out = []
    for row in rows:
        if row["kind"] == PLACES:
            c, place = _unpacked(row["data"])
            out.append(_row(at, PAIRS, at, row["block"], _packed(c, *[t[place] for t in ts])))
    return pa.Table.from_pylist(out, _ARROW)


def _scored(known: dict, side: int):
    """The scores of a block's texts from the answers to its words and pairs."""

    def score(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda row: (row["kind"], row["src"]))
        tokens = _Tokens(next(row["data"] for row in rows if row["kind"] == TEXTS), side)
        n, customers, *totals = (np.concatenate(x).astype(np.int64) for x in zip(*[_unpacked(row["data"]) for row in rows if row["kind"] == WORDS], strict=True))
        c, *ts = (np.concatenate(x).astype(np.int64) for x in zip(*[_unpacked(row["data"]) for row in rows if row["kind"] == PAIRS], strict=True))
        prev, word = tokens.prev[tokens.order], tokens.word[tokens.order]
        fresh, mean = customers[prev] == 0, np.zeros(len(c))
        for s, (tu, cu) in enumerate(known["sums"]):
            # A pair that is not seated again has as many tables as customers: none or one.
            tables = c.copy()
            tables[c > 1] = ts[s]
            p1 = _prior(totals[3 * s], totals[3 * s + 1], known, tu, cu)[word]
            below = (c - known["d1"] * tables + (STRENGTH + known["d1"] * totals[3 * s + 2][prev]) * p1) / (STRENGTH + customers[prev])
            mean += np.where(fresh, p1, below)
        of_pair = np.empty(len(c))
        of_pair[tokens.order] = np.log10(mean / len(known["sums"]))
        base = np.log10((n + 0.5) / (known["tokens"] + 0.5 * (known["words"] + 1)))
        starts = np.cumsum(tokens.lengths) - tokens.lengths
        sums = [np.add.reduceat(x, starts) for x in ((n > 0).astype(np.int64)[tokens.token], base[tokens.token], of_pair[tokens.pair])]
        return pa.table([pa.array(tokens.ids, mask=tokens.nulls), pa.array(tokens.held), pa.array(tokens.lengths), *map(pa.array, sums)],
                        ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return score


def _kept(df: DataFrame, label: str, *used: DataFrame) -> DataFrame:
    """The frame saved, without its shuffle files; ``used`` are saved frames that nothing reads from now on."""
    conf = df.sparkSession.conf
    was = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        out = saved(df, label)
    finally:
        conf.unset(_CLEANUP) if was is None else conf.set(_CLEANUP, was)
    for frame in used:
        dropped(frame)
    return out


def _totals(df: DataFrame, kind: int, many: int) -> list[float]:
    """The sums that the rows of one kind carry, added up."""
    got = df.where(F.col("kind") == kind).agg(*[F.sum(F.col("sums")[i]) for i in range(many)]).first()
    return [float(x or 0) for x in got]


def score_texts(documents: DataFrame, held_out) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row a document.

    A bigram hierarchical Pitman-Yor model: each previous word (or the begin of a text) is a
    restaurant whose customers are the words seen after it; its tables are customers of the
    unigram restaurant, whose parent is uniform over the known words and one unknown word.
    Texts are read once, into blocks of word numbers. Pairs live in the buckets of a square grid,
    by group of the previous word and group of the word, and words in as many parts, so a
    bucket asks the parts of one group each; each round of Gibbs seating sends the buckets
    the unigram probabilities and the tables that they ask for, and the parts their sums.

    Learns from the rows where the column ``held_out`` is false (a null counts as false) and
    scores all. Needs ``doc_id`` and ``text``; a null or empty text is the end token alone.
    Rows with a null or repeated id are learned from and scored like any other. With nothing
    to learn from, every token is the unknown word, of probability one. An empty table gives
    no rows. The perplexity of a text is 10 ** (-score / n_tokens).
    """
    docs = documents.select(F.col("doc_id").cast("long"), F.coalesce(held_out, F.lit(False)).alias("held"), "text")
    blocks = _kept(docs.mapInArrow(_blocks(BLOCK_BYTES), _ROWS), "lm-texts")
    side = max(1, math.ceil(math.sqrt(_totals(blocks, TEXTS, 1)[0] / PART_BYTES)))
    counted = _kept(blocks.mapInArrow(_asked_pairs(side), _ROWS).groupBy("at").applyInArrow(_counted(side), _ROWS), "lm-counts")
    words = _kept(counted.where(F.col("kind").isin(WORDS, PREVS)).groupBy("at").applyInArrow(_owned, _ROWS), "lm-words")
    distinct, ones, twos = _totals(counted, PAIRS, 3)
    v, n, word_ones, word_twos = _totals(words, OWNED, 4)
    known = {"words": v, "tokens": n, "d1": _discount(ones, twos), "d0": _discount(word_ones, word_twos), "tu": v, "cu": distinct, "sums": []}
    # A word seen once after a previous word has one table there in every seating, so only the
    # others are seated again; the ones are counted into the totals of the word and the context.
    pairs = counted
    for run in range(SETTLE + SAMPLES):
        keep = run >= SETTLE
        told = words.mapInArrow(_told(known), _ROWS).unionAll(pairs.where(F.col("kind") == PAIRS))
        pairs = _kept(told.groupBy("at").applyInArrow(_reseated(known, run, keep, side), _ROWS), "lm-pairs", *[pairs] * (run > 0))
        told = words.unionAll(pairs.where(F.col("kind") != PAIRS))
        words = _kept(told.groupBy("at").applyInArrow(_updated(known, run, keep), _ROWS), "lm-words", words)
        tu, cu = _totals(words, OWNED, 2)
        known = known | {"tu": tu, "cu": cu, "sums": known["sums"] + [(tu, cu)] * keep}
    told = counted.where(F.col("kind") == PLACES).unionAll(pairs.where(F.col("kind") == PAIRS))
    of_pairs = _kept(told.groupBy("at").applyInArrow(_pair_answers, _ROWS), "lm-pair-answers", counted, pairs)
    told = blocks.mapInArrow(_asked_words(side), _ROWS).unionAll(words)
    of_words = _kept(told.groupBy("at").applyInArrow(_word_answers, _ROWS), "lm-word-answers", words)
    scores = blocks.unionAll(of_words).unionAll(of_pairs).groupBy("block").applyInArrow(_scored(known, side), _SCORES)
    return scores.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(int(n)).cast("long").alias("train_tokens"), "base_score", "score")


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores of all documents, learned from those with another remainder (mod 5) than 1."""
    return score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), remainder("doc_id", 5) == 1)
