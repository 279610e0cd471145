"""Encoding and decoding with merge-type SentencePiece models, with seeded merge dropout.

The vocabulary is read from a model file; it is never trained here. A text becomes symbols (a space is U+2581, one is
put in front), and an agenda merges the adjacent pair of the best-scored piece, leftmost first. With dropout, a pair
that comes up on the agenda is skipped for good if a keyed hash of (seed, text, place of the chunk in the text, where
the pair starts and ends) falls below the rate; so one seed always gives a text one segmentation, other seeds give
others, and every occurrence of a word is cut on its own, in one text and in others. Symbols without a piece become
byte pieces, and every segmentation decodes to the text it came from. Without dropout the result is the model's own.

No piece has U+2581 after another character, so merges never cross the start of a run of them, and texts are cut there
into chunks. Many chunks are worked off together, by width, in arrays: every step takes the next pair of each agenda and
decides it for every occurrence of the chunk. Occurrences of a chunk share the agendas that they have in common, and
nothing is kept from one batch of texts to the next.

Defined results: null and empty texts have no pieces and decode to the empty text. A literal U+2581 in a text is one
that decoding cannot tell from a space; it is encoded as its bytes, which it can. Repeated rows are separate rows and
come out alike; an empty table gives an empty one; null ids stay; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import sys
import types
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import trimmed

SPACE = "▁"
RATE, SEED = 0.1, 1
#: Chunks of at most so many symbols are cut together, by width; longer ones, which are rare, one by one.
WIDTHS = (4, 6, 8, 10, 12, 16, 24, 40)
#: Occurrences of chunks that are cut together, and characters of texts that are read together.
TOGETHER, CHARACTERS = 1 << 14, 1 << 19
_CHUNK = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_MASK = (1 << 64) - 1
#: What the starts of a pair's symbols and its end add to a hash.
_START, _MID, _STOP = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
_PLACE, _STIR, _SKIP = 0x9FB21C651E98DF25, 0x94D049BB133111EB, 0xBF58476D1CE4E5B9
#: The price of a pair without a piece; and bits of a symbol in the key of a pair.
_NEVER, _SYMBOL = np.int32(1 << 30), 21


class Vocabulary:
    """Pieces and scores of a merge-type model."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str]):
        self.pieces = pieces
        self.rank = {p: (-s, i) for i, (p, s, k) in enumerate(zip(pieces, scores, kinds, strict=True)) if k == "normal"}
        self.byte = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)) if k == "byte"}
        self.text = [bytes([int(p[3:5], 16)]) if k == "byte" else b"" if k == "control" else p.replace(SPACE, " ").encode() for p, k in zip(pieces, kinds, strict=True)]

    @classmethod
    def load(cls, model_file: str) -> Vocabulary:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        kind = lambda i: "control" if sp.is_control(i) or sp.is_unknown(i) else "byte" if sp.is_byte(i) else "unused" if sp.is_unused(i) else "normal"
        ids = range(sp.get_piece_size())
        return cls([sp.id_to_piece(i) for i in ids], [sp.get_score(i) for i in ids], [kind(i) for i in ids])


class Pairs:
    """Which two symbols merge, at which price and into what: a hash table for arrays of symbols.

    A symbol is the number of its piece, or for a character without one the number of pieces plus its code point.
    """

    def __init__(self, v: Vocabulary):
        self.pieces = len(v.pieces)
        if self.pieces + sys.maxunicode >= 1 << _SYMBOL:
            raise ValueError("too many pieces")
        self.of_char = np.arange(sys.maxunicode + 1, dtype=np.int32) + np.int32(self.pieces)
        for p, (_, i) in v.rank.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i
        number = lambda x: v.rank[x][1] if x in v.rank else self.pieces + ord(x) if len(x) == 1 else None
        # prices are ranks of scores, so equal scores stay equal
        ranked = {x: i for i, x in enumerate(sorted({x for x, _ in v.rank.values()}))}
        found = []
        for p, (x, i) in v.rank.items():
            for k in range(1, len(p)):
                a, b = number(p[:k]), number(p[k:])
                if a is not None and b is not None:
                    found.append((a << _SYMBOL | b, ranked[x], i))
        self.bits = max(4, (4 * len(found)).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size + 1, -1, np.int64)
        self.price, self.into = np.full(size + 1, _NEVER, np.int32), np.zeros(size + 1, np.int32)
        for key, price, into in found:
            at = (key * _START & _MASK) >> 64 - self.bits
            while self.keys[at] != -1:
                at = (at + 1) % size
            self.keys[at], self.price[at], self.into[at] = key, price, into

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Prices of merging ``a`` with ``b``, and the symbols that they merge into."""
        key = a.astype(np.int64) << _SYMBOL | b
        at = (key.view(np.uint64) * np.uint64(_START) >> np.uint64(64 - self.bits)).astype(np.int64)
        held = self.keys[at]
        other = np.flatnonzero((held != key) & (held != -1))
        while len(other):
            at[other] = (at[other] + 1) % (len(self.keys) - 1)
            held = self.keys[at[other]]
            other = other[(held != key[other]) & (held != -1)]
        at[self.keys[at] != key] = len(self.keys) - 1  # the last place says that there is no such pair
        return self.price[at], self.into[at]


def _drawn(x: np.ndarray) -> np.ndarray:
    """The hash that is held against the rate."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(_SKIP)
    return x ^ (x >> np.uint64(32))


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0] .. first[0] + size[0] - 1, first[1] .. and so on, in one array."""
    ends = np.cumsum(size)
    return np.repeat(first - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


class Codec:
    """Encoder and decoder of one vocabulary, seed and rate."""

    def __init__(self, vocabulary: Vocabulary, rate: float = 0.0, seed: int = SEED):
        self.v, self.rate = vocabulary, rate
        self.key = seed.to_bytes(8, "big", signed=True)
        self.limit = min(int(rate * (1 << 64)), _MASK)
        self.pairs = Pairs(vocabulary)
        self.byte = np.array([vocabulary.byte.get(b, 0) for b in range(256)], np.int32)
        self.flat = np.frombuffer(b"".join(vocabulary.text), np.uint8)
        self.sizes = np.array([len(x) for x in vocabulary.text], np.int64)
        self.firsts = np.cumsum(self.sizes) - self.sizes

    def _state(self, text: str) -> int:
        return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8, key=self.key).digest(), "big")

    # ---- one chunk at a time: what the method says, and the way for chunks beyond all widths

    def _skipped(self, state: int, i: int, mid: int, stop: int) -> bool:
        x = (state + i * _START + mid * _MID + stop * _STOP) & _MASK
        x = ((x ^ (x >> 32)) * _SKIP) & _MASK
        return x ^ (x >> 32) < self.limit

    def _ids(self, symbols: list[str]) -> tuple[int, ...]:
        out, rank, byte = [], self.v.rank, self.v.byte
        for x in symbols:
            piece = rank.get(x)
            if piece:
                out.append(piece[1])
            else:
                out.extend(byte[b] for b in x.encode("utf-8"))
        return tuple(out)

    def chunk(self, text: str, state: int = 0) -> tuple[int, ...]:
        """Ids of one chunk, by a heap of candidate merges."""
        rank = self.v.rank
        n = len(text)
        end = list(range(1, n + 1))  # of the symbol that starts here
        before = list(range(-1, n - 1))
        alive = [True] * n
        agenda = []
        for i in range(n - 1):
            found = rank.get(text[i : i + 2])
            if found:
                agenda.append((found[0], i, i + 1, i + 2))
        heapq.heapify(agenda)
        pop, push = heapq.heappop, heapq.heappush
        while agenda:
            _, i, mid, stop = pop(agenda)
            if not alive[i] or end[i] != mid or mid >= n or not alive[mid] or end[mid] != stop:
                continue
            if self.rate and self._skipped(state, i, mid, stop):
                continue
            alive[mid] = False
            end[i] = stop
            if stop < n:
                before[stop] = i
                found = rank.get(text[i : end[stop]])
                if found:
                    push(agenda, (found[0], i, stop, end[stop]))
            left = before[i]
            if left >= 0:
                found = rank.get(text[left:stop])
                if found:
                    push(agenda, (found[0], left, i, stop))
        symbols, i = [], 0
        while i < n:
            symbols.append(text[i : end[i]])
            i = end[i]
        return self._ids(symbols)

    @staticmethod
    def _occurrence(doc: int, place: int) -> int:
        """The state of the chunk at ``place`` of the text of state ``doc``."""
        x = (doc + place * _PLACE) & _MASK
        x = ((x ^ (x >> 29)) * _STIR) & _MASK
        return x ^ (x >> 32)

    def encode(self, text: str | None) -> list[int]:
        """Ids of one text, chunk by chunk."""
        doc, out, place = self._state(text) if self.rate and text else 0, [], 0
        literal = [self.v.byte[b] for b in SPACE.encode()]
        for i, part in enumerate((" " + text).split(SPACE) if text else ()):
            if i:
                out.extend(literal)
                place += 1
            for c in _CHUNK.findall(part.replace(" ", SPACE)):
                out.extend(self.chunk(c, self._occurrence(doc, place)))
                place += len(c)
        return out

    # ---- many chunks at a time

    def _grow(self, chunks: list[str], width: int, of: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Cut occurrences of ``chunks`` (occurrence k is of chunk of[k]), one decision of all of them at a time.

        Returns the ending of every occurrence, and the sizes and symbols of the endings. A node is an agenda; an
        occurrence goes on from its node to that with the pair merged or the pair skipped. Occurrences of one chunk
        share nodes as long as they decide alike, and only nodes that an occurrence reaches are made.
        """
        n, w = len(chunks), width + 1
        points = np.frombuffer("".join([c.ljust(w, "\0") for c in chunks]).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, w)
        size = np.array([len(c) for c in chunks])
        inside = np.arange(w) < size[:, None]
        symbol = np.where(inside, self.pairs.of_char[points], np.int32((1 << _SYMBOL) - 1))
        price, into = np.full((n, w), _NEVER, np.int32), np.zeros((n, w), np.int32)
        price[:, :-1], into[:, :-1] = (x.reshape(n, w - 1) for x in self.pairs.find(symbol[:, :-1].ravel(), symbol[:, 1:].ravel()))
        end = np.where(inside, np.arange(1, w + 1, dtype=np.int8), np.int8(0))
        before = np.broadcast_to(np.arange(-1, w - 1, dtype=np.int8), (n, w)).copy()
        limit = np.uint64(self.limit)
        ending, endings, sizes, symbols = np.zeros(len(of), np.int64), 0, [], []
        node, who = of, np.arange(len(of))
        while len(who):
            row = np.arange(len(price))
            at = price.argmin(1)
            over = price[row, at] == _NEVER
            if over.any():
                kept = end[over] > 0
                sizes.append(kept.sum(1))
                symbols.append(symbol[over][kept])
                done = over[node]
                ending[who[done]] = (np.cumsum(over) - 1 + endings)[node[done]]
                endings += int(over.sum())
                node, who = node[~done], who[~done]
                if not len(who):
                    break
            side = 2 * node
            if self.limit:
                mid = end[row, at]
                stop = end[row, mid]
                pair = at.astype(np.uint64) * np.uint64(_START) + mid.astype(np.uint64) * np.uint64(_MID) + stop.astype(np.uint64) * np.uint64(_STOP)
                side += _drawn(state[who] + pair[node]) < limit
            reached = np.zeros(2 * len(price), bool)
            reached[side] = True
            node = (np.cumsum(reached) - 1)[side]
            came = np.flatnonzero(reached)
            parent, skips = came >> 1, (came & 1).astype(bool)
            at = at[parent]
            price, into, symbol, end, before = price[parent], into[parent], symbol[parent], end[parent], before[parent]
            row = np.flatnonzero(skips)
            price[row, at[row]] = _NEVER
            row = np.flatnonzero(~skips)
            at = at[row]
            mid = end[row, at]
            stop = end[row, mid]
            merged = into[row, at]
            symbol[row, at], end[row, at], end[row, mid], price[row, mid] = merged, stop, 0, _NEVER
            before[row, stop] = at  # the last column stands for the end of a chunk
            price[row, at], into[row, at] = self.pairs.find(merged, symbol[row, stop])
            left = before[row, at]
            some = np.flatnonzero(left >= 0)
            row, left = row[some], left[some]
            price[row, left], into[row, left] = self.pairs.find(symbol[row, left], merged[some])
        return ending, sizes, symbols

    def _as_bytes(self, size: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols without a piece become byte pieces; ``size`` are the numbers of symbols of the endings."""
        bare = symbols >= self.pairs.pieces
        if not bare.any():
            return size, symbols
        point = np.where(bare, symbols - self.pairs.pieces, 0)
        n = 1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000)
        out, point, left = np.repeat(symbols, n), np.repeat(point, n), np.repeat(np.cumsum(n), n) - np.arange(n.sum()) - 1
        wide = np.repeat(n, n)
        lead = np.where(wide == 1, point, (0xF00 >> wide & 0xFF) | point >> 6 * (wide - 1))
        unit = np.where(left == wide - 1, lead, 0x80 | point >> 6 * left & 0x3F)
        bare = np.repeat(bare, n)
        out[bare] = self.byte[unit[bare]]
        ends = np.concatenate(([0], np.cumsum(n)))
        at = np.cumsum(size)
        return ends[at] - ends[at - size], out

    def _cut(self, chunks: list[str], of: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(how many ids each occurrence has, all ids in order)."""
        width = np.array([len(c) for c in chunks])
        kind = np.searchsorted(WIDTHS, width)
        # chunks of one width with some TOGETHER occurrences are a group; arrays of that size stay in the caches
        times = np.bincount(of, minlength=len(chunks))
        order = np.argsort(kind, kind="stable")
        at = np.cumsum(times[order]) // TOGETHER
        fresh = np.concatenate(([False], (np.diff(at) > 0) | (np.diff(kind[order]) > 0)))
        group, number = np.empty(len(chunks), np.int64), np.empty(len(chunks), np.int64)
        group[order] = np.cumsum(fresh)
        firsts = np.concatenate(([0], np.flatnonzero(fresh), [len(chunks)]))
        number[order] = np.arange(len(chunks)) - np.repeat(firsts[:-1], np.diff(firsts))
        own = group[of]
        by_group = np.argsort(own.astype(np.uint16) if len(firsts) < 1 << 16 else own, kind="stable")
        ends = np.cumsum(np.bincount(own, minlength=len(firsts) - 1))
        ending, endings, sizes, flat = np.zeros(len(of), np.int64), 0, [], []
        for g, (a, b) in enumerate(zip(firsts, firsts[1:], strict=False)):
            members, here = order[a:b], by_group[ends[g - 1] if g else 0 : ends[g]]
            k = kind[members[0]]
            if k < len(WIDTHS):
                found, size, symbols = self._grow([chunks[i] for i in members], WIDTHS[k], number[of[here]], state[here])
                size, symbols = self._as_bytes(np.concatenate(size), np.concatenate(symbols))
            else:
                ids = [self.chunk(chunks[of[i]], int(state[i])) for i in here]
                found, size, symbols = np.arange(len(here)), np.array([len(x) for x in ids]), np.array([x for part in ids for x in part], np.int32)
            ending[here] = found + endings
            endings += len(size)
            sizes.append(size)
            flat.append(symbols)
        size, flat = np.concatenate(sizes), np.concatenate(flat)
        first = np.cumsum(size) - size
        return size[ending], flat[_ranges(first[ending], size[ending])].astype(np.int32)

    def encode_all(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of many texts: ``encode`` of each, computed together."""
        known: defaultdict[str, int] = defaultdict()
        known.default_factory = known.__len__  # a new chunk gets the next number
        number, stream, per_text, docs, plain = known.__getitem__, [], [], [], []
        for t in texts:
            if not t or SPACE in t:
                plain.append(bool(t))
                per_text.append(0)
                docs.append(0)
                continue
            plain.append(False)
            if "  " in t or t[0] == " ":
                found = _CHUNK.findall(SPACE + t.replace(" ", SPACE))
            else:  # every space starts a chunk
                found = (SPACE + t.replace(" ", " " + SPACE)).split(" ")
            stream.append(np.fromiter(map(number, found), np.int64, len(found)))
            per_text.append(len(found))
            docs.append(self._state(t) if self.rate else 0)
        chunks, of, per_text = list(known), np.concatenate(stream or [np.zeros(0, np.int64)]), np.array(per_text)
        known.default_factory = None  # it refers to its own dictionary
        del known, number, stream
        ends = np.cumsum(per_text)
        n, ids = np.zeros(len(texts), np.int64), np.zeros(0, np.int32)
        if len(of):
            size = np.array([len(c) for c in chunks])[of]
            place = np.cumsum(size) - size
            first = place[np.minimum(ends - per_text, len(of) - 1)]
            state = np.repeat(np.array(docs, np.uint64), per_text) + (place - np.repeat(first, per_text)).astype(np.uint64) * np.uint64(_PLACE)
            state = (state ^ (state >> np.uint64(29))) * np.uint64(_STIR)
            state ^= state >> np.uint64(32)
            count, ids = self._cut(chunks, of, state)
            total = np.concatenate(([0], np.cumsum(count)))
            n = total[ends] - total[ends - per_text]
        if any(plain):  # texts with a literal U+2581
            parts, at = [], 0
            for i, own in enumerate(plain):
                parts.append(np.array(self.encode(texts[i]), np.int32) if own else ids[at : at + n[i]])
                at += n[i]
                n[i] = len(parts[-1])
            ids = np.concatenate(parts)
        return np.concatenate(([0], np.cumsum(n))), ids

    def decode(self, ids: list[int]) -> str:
        text = self.v.text
        return b"".join([text[i] for i in ids]).decode("utf-8", "replace")[1:]

    def decode_all(self, offsets: np.ndarray, ids: np.ndarray) -> list[str]:
        """``decode`` of the ids of many texts."""
        size = self.sizes[ids]
        data = self.flat[_ranges(self.firsts[ids], size)].tobytes()
        ends = np.concatenate(([0], np.cumsum(size)))[offsets].tolist()
        return [data[a:b].decode("utf-8", "replace")[1:] for a, b in zip(ends, ends[1:], strict=False)]


def _codec(model_file: str, rate: float, seed: int) -> Codec:
    """One codec per worker process; it holds the vocabulary and no texts."""
    held = sys.modules.setdefault("_worker_codecs", types.ModuleType("_worker_codecs")).__dict__
    key = (model_file, rate, seed)
    if held.get("key") != key:
        held["codec"], held["key"] = Codec(Vocabulary.load(model_file), rate, seed), key
    return held["codec"]


def _parts(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Runs of texts of some CHARACTERS together, and where they start."""
    size = np.concatenate(([0], np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))))
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(size, size[at] + CHARACTERS, "right")) - 1)
        yield at, texts.slice(at, to - at).to_pylist()
        at = to


def encode_documents(docs: DataFrame, model_file: str, key: str = "doc_id", text: str = "text", rate: float = RATE, seed: int = SEED) -> DataFrame:
    """(key, token_ids): the pieces of every text. ``model_file`` must be at the same place on every executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model_file, rate, seed)
        for batch in batches:
            for at, texts in _parts(batch.column(1)):
                offsets, ids = codec.encode_all(texts)
                tokens = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), tokens], names=[key, "token_ids"])

    return docs.select(key, text).mapInArrow(trimmed(run), f"`{key}` bigint, token_ids array<int>")


def round_trip(docs: DataFrame, model_file: str, key: str = "doc_id", text: str = "text", rate: float = RATE, seed: int = SEED) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256, lossless) of every text: encoded, decoded and compared.

    ids_sha256 digests the ids as little-endian 32-bit integers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model_file, rate, seed)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for batch in batches:
            for at, texts in _parts(batch.column(1)):
                offsets, ids = codec.encode_all(texts)
                back, data, ends = codec.decode_all(offsets, ids), ids.astype("<i4").tobytes(), (4 * offsets).tolist()
                ids_sha = [sha(data[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
                columns = [np.diff(offsets), ids_sha, [sha(x.encode()) for x in back], [x == (t or "") for x, t in zip(back, texts, strict=True)]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), *(pa.array(x, kind) for x, kind in zip(columns, (pa.int64(), pa.string(), pa.string(), pa.bool_()), strict=True))],
                    names=[key, "n_tokens", "ids_sha256", "decoded_sha256", "lossless"],
                )

    return docs.select(F.col(key), F.col(text)).mapInArrow(trimmed(run), f"`{key}` bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, lossless boolean")
