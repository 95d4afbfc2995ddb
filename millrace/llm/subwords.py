"""Piece encoding of the merge type (BPE) by a table of last pieces, and decoding.

For every prefix of a text the last piece of its encoding is unique. An automaton over the
vocabulary gives, at each place, the pieces that end there; the right one is the piece that
is its own encoding and compatible with the last piece of the prefix before it: the two
stand side by side after all merges. The table of last pieces is read backwards.
"""

from __future__ import annotations

import codecs
import re
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.frames import table, texts_of, with_columns

SPACE_MARK = "▁"
#: Encoded runs kept in a task; the store is emptied when it is full.
CACHE_RUNS = 600_000
#: Tested pairs of pieces kept in a task, likewise.
COMPATIBLE_PAIRS = 1_000_000


def _replaced(error: UnicodeError) -> tuple[str, int]:
    return "\ufffd", error.start + 1


codecs.register_error("each byte", _replaced)


class Codec:
    """Encodes and decodes by one model; rejects models it would treat wrongly."""

    def __init__(self, model: bytes):
        vocabulary = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.byte_ids = [0] * 256
        self.ids: dict[str, int] = {}
        self.scores: list[float] = []
        self.surface: list[bytes] = []
        self.special: set[int] = set()
        for i in range(vocabulary.get_piece_size()):
            piece = vocabulary.id_to_piece(i)
            self.scores.append(vocabulary.get_score(i))
            if vocabulary.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.surface.append(bytes([int(piece[1:-1], 16)]))
            elif vocabulary.is_control(i):
                self.surface.append(b"")
                self.special.add(i)
            elif vocabulary.is_unknown(i):
                self.surface.append(" ⁇ ".encode())
                self.special.add(i)
            else:
                self.ids[piece] = i
                self.surface.append(piece.replace(SPACE_MARK, " ").encode())
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in self.ids) or "\n" in self.ids:
            raise ValueError("pieces that run over a word start or a line end are not supported")
        # Merges never cross the start of a word or a line end, so texts are encoded in runs.
        self.runs = re.compile(f"\n|{SPACE_MARK}+[^{SPACE_MARK}\n]*|[^{SPACE_MARK}\n]+")
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if self.merged(piece) == (i,):
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self.names = {i: p for p, i in self.ids.items()}
        self.letters = {p for p in self.ids if len(p) == 1}
        self.trees: dict[str, tuple[str, str] | None] = {}
        self.edges: dict[tuple[str, int], list[tuple[str, float]] | None] = {}
        self.compatible: dict[int, bool] = {}
        self.cache: dict[str, bytes] = {}
        # Runs that are one piece, which the table would give back as they are.
        self.whole = {p: array("i", [i]).tobytes() for p, i in self.ids.items() if p in self.automaton}

    def merged(self, text: str) -> tuple[int, ...]:
        """Plain merging of known characters, best score first and leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.scores[i] > best):
                    best, at = self.scores[i], k
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return tuple(self.ids.get(p, -1) for p in parts)

    def halves(self, piece: str) -> tuple[str, str] | None:
        """The two pieces whose merge makes ``piece``; None for a single character."""
        if len(piece) > 1 and piece not in self.trees:
            parts = list(piece)
            while len(parts) > 2:
                best = max((self.scores[i], -k) for k in range(len(parts) - 1)
                           if (i := self.ids.get(parts[k] + parts[k + 1])) is not None)
                k = -best[1]
                parts[k:k + 2] = [parts[k] + parts[k + 1]]
            self.trees[piece] = (parts[0], parts[1])
        return self.trees.get(piece)

    def edge(self, piece: str, side: int) -> list[tuple[str, float]] | None:
        """What stands at one edge of ``piece`` as it grows, each with the score of the merge
        that ends it; None if a part has a worse score than the whole, so that the order of
        merges does not follow the scores."""
        known = self.edges.get((piece, side), ...)
        if known is ...:
            parts, part = [piece], piece
            while halves := self.halves(part):
                part = halves[side]
                parts.append(part)
            scores = [self.scores[self.ids[p]] for p in parts[:-1]]
            rising = all(a < b for a, b in zip(scores, scores[1:], strict=False))
            known = [*zip(parts[:0:-1], scores[::-1], strict=True), (piece, -np.inf)] if rising else None
            self.edges[piece, side] = known
        return known

    def stand_apart(self, left: str, right: str) -> bool:
        """Whether no merge crosses the border of the two pieces."""
        inner, outer = self.edge(left, 1), self.edge(right, 0)
        if inner is None or outer is None:
            return self.merged(left + right) == (self.ids[left], self.ids[right])
        i = j = 0
        while True:
            (a, a_ends), (b, b_ends) = inner[i], outer[j]
            across = self.ids.get(a + b)
            if across is not None and self.scores[across] > a_ends and self.scores[across] >= b_ends:
                return False
            if i == len(inner) - 1 and j == len(outer) - 1:
                return True
            if a_ends >= b_ends:
                i += 1
            else:
                j += 1

    def fits(self, left: int, right: int) -> bool:
        known = self.stand_apart(self.names[left], self.names[right])
        if len(self.compatible) > COMPATIBLE_PAIRS:
            self.compatible.clear()
        self.compatible[left << 32 | right] = known
        return known

    def encode_known(self, text: str) -> list[int]:
        """Encodes characters that are all pieces themselves."""
        last = [None] * (len(text) + 1)  # the last piece of each prefix and its length
        pairs = self.compatible
        for end, piece in self.automaton.iter(text):  # longer pieces first
            end += 1
            if last[end]:
                continue
            start = end - piece[1]
            if not start:
                last[end] = piece
            elif before := last[start]:
                pair = before[0] << 32 | piece[0]
                if pair in pairs:
                    if pairs[pair]:
                        last[end] = piece
                elif self.fits(before[0], piece[0]):
                    last[end] = piece
        out, at = [], len(text)
        while at:
            i, size = last[at]
            out.append(i)
            at -= size
        return out[::-1]

    def encode_run(self, run: str) -> bytes:
        if self.letters.issuperset(run):
            return array("i", self.encode_known(run)).tobytes()
        out, start = [], 0
        for k, char in enumerate(run):
            if char not in self.letters:
                if start < k:
                    out += self.encode_known(run[start:k])
                out += [self.byte_ids[b] for b in char.encode()]
                start = k + 1
        if start < len(run):
            out += self.encode_known(run[start:])
        return array("i", out).tobytes()

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, without begin and end."""
        if not text:
            return np.empty(0, np.int32)
        runs = self.runs.findall(SPACE_MARK + text.replace(" ", SPACE_MARK))
        cache = self.cache
        try:
            return np.frombuffer(b"".join([cache[r] for r in runs]), np.int32)
        except KeyError:
            pass
        if len(cache) > CACHE_RUNS:
            cache.clear()
        out = []
        for r in runs:
            ids = cache.get(r)
            if ids is None:
                ids = self.whole.get(r) or self.encode_run(r)
                if len(r) <= 64:
                    cache[r] = ids
            out.append(ids)
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: the space put before the first word goes, bytes become characters."""
        surface = self.surface
        data = b"".join([surface[i] for i in ids.tolist()])
        skip = 0
        while skip < len(ids) and int(ids[skip]) in self.special and not surface[ids[skip]]:
            skip += 1
        if skip < len(ids) and self.names.get(int(ids[skip]), "").startswith(SPACE_MARK):
            data = data[1:]
        try:
            return data.decode()
        except UnicodeDecodeError:
            return data.decode("utf-8", "each byte")


_codecs: dict[int, Codec] = {}


def codec_for(model: bytes) -> Codec:
    """One codec a worker, kept over tasks without its stores."""
    key = hash(model)
    if key not in _codecs:
        _codecs[key] = Codec(model)
    return _codecs[key]


class _Encoder:
    """The function of one task; what it has stored is given up with the task."""

    def __init__(self, codec: Codec):
        self.codec = codec

    def __call__(self, batch: pa.RecordBatch) -> list[pa.Array]:
        ids = [self.codec.encode(t) for t in texts_of(batch)]
        ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
        values = pa.array(np.concatenate([*ids, np.empty(0, np.int32)]))
        return [pa.ListArray.from_arrays(pa.array(ends), values), pa.array([self.codec.decode(i) for i in ids], pa.string())]

    def close(self) -> None:
        self.codec.cache, self.codec.compatible = {}, {}


def encode_documents(documents: DataFrame, model_path: str) -> DataFrame:
    """Adds ``ids`` (array<int>) and ``decoded`` (string) to every row.

    The ids equal the public library's for the model file, without begin and end; ``decoded``
    is what its decode makes of them. A null or empty text has no ids and decodes to the
    empty text. Other columns are kept, ``ids`` and ``decoded`` replaced; repeated rows stay.
    """
    with open(model_path, "rb") as file:  # a vocabulary file of the installed package
        model = file.read()
    added = [T.StructField("ids", T.ArrayType(T.IntegerType(), False), False), T.StructField("decoded", T.StringType(), False)]
    return with_columns(documents, "text", added, lambda: _Encoder(codec_for(model)))


def op7_subwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and decoded texts of all documents."""
    import public_tokenizers

    encoded = encode_documents(table(spark, sf_dir, "documents").select("doc_id", "text"),
                               public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
