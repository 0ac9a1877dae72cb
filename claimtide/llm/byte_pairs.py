"""Byte-level BPE: encoding by a lazily determinised transducer, decoding by a UTF-8 state machine.

A sequence of tokens is the BPE form of its bytes exactly if every two
neighbours are the BPE form of theirs. So the encoder is a transducer over the
trie of the tokens: a path is a chain of tokens that fit, plus a begun token.
Its determinised states are sets of live paths, made when first met; a token is
emitted as soon as all live paths agree on it, which takes no more bytes of
lookahead than the longest token has.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import sys
import threading
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import packed

#: Most states of each of a transducer's two generations; forgetting costs time and changes nothing.
CACHE = 1 << 16
#: Most entries of each of the two generations of known pieces.
CACHED_PIECES = 1 << 17
CACHED_PIECE = 64
#: Moves asked for less often are not determinised, but for pieces longer than SEARCHED bytes.
ASKED = 8
SEARCHED = 256
CHUNK = 1 << 20
BATCH_BYTES = 2 << 20
NEVER = 1 << 62


#: Seconds without a next task after which a worker lets its coders go.
IDLE = 2.0
#: A worker keeps the coder it used last, with its caches, for its next tasks.
KEPT: dict[str, tuple] = {}
LEAVING: list[threading.Timer] = []


def kept(kind, key: tuple, *args):
    while LEAVING:
        LEAVING.pop().cancel()
    found = KEPT.get(kind.__name__, (None,))
    if found[0] != key:
        found = KEPT[kind.__name__] = (key, kind(*args))
    return found[1]


def forget() -> None:
    KEPT.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()


def rest() -> None:
    """Lets the coders go unless a task asks for them soon; a task that runs holds its own."""
    LEAVING.append(threading.Timer(IDLE, forget))
    LEAVING[-1].daemon = True
    LEAVING[-1].start()


def fingerprint(ranks: dict[bytes, int]) -> str:
    digest = hashlib.sha256()
    for token, rank in ranks.items():
        digest.update(b"%d %d " % (rank, len(token)) + token)
    return digest.hexdigest()


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a token in base64 and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Transducer:
    """BPE of one piece of bytes, state by state."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values()) + 1
        self.ranks = ranks
        self.token_bytes = [b""] * size
        for token, rank in ranks.items():
            self.token_bytes[rank] = token
        #: The trie: per node, the nodes below it by byte, none in a common empty one; and the token that ends there, or -1.
        nothing: dict[int, int] = {}
        self.below: list[dict[int, int]] = [nothing]
        self.ends = [-1]
        #: Of each token the two whose merge makes it (-1 of a byte), its length, and the longest other token it starts with.
        self.left, self.right, self.sizes, self.shorter = [-1] * size, [-1] * size, [0] * size, [-1] * size
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                if self.below[node] is nothing:
                    self.below[node] = {}
                if byte not in self.below[node]:
                    self.below[node][byte] = len(self.ends)
                    self.ends.append(-1)
                    self.below.append(nothing)
                node = self.below[node][byte]
            halves = self.merged(token, 2)
            if len(halves) == 2:
                self.left[rank], self.right[rank] = ranks[halves[0]], ranks[halves[1]]
            # a token that no merges reach is none
            self.ends[node] = rank if len(halves) < 3 else -1
        for token, rank in ranks.items():
            self.sizes[rank], node, longest = len(token), 0, -1
            for byte in token:
                self.shorter[rank] = longest
                node = self.below[node][byte]
                longest = self.ends[node] if self.ends[node] >= 0 else longest
        self.fits: dict[int, bool] = {}
        self.met: dict[int, int] = {}
        self.made = 1
        self.states: dict[tuple, int] = {}
        self.paths: dict[int, tuple] = {}
        self.moves: dict[int, tuple[tuple, int]] = {}
        self._forget()

    def _forget(self) -> None:
        """What is known becomes the older generation; what was in that one and not met since goes."""
        self.older = self.states, self.paths, self.moves
        start = (((), -1, 0),)
        self.states, self.paths, self.moves = {start: 0}, {0: start}, {}

    def _next(self, state: int, byte: int) -> tuple[tuple, int]:
        """A move that the younger generation doesn't know, and its state, both known to it from now on."""
        states, paths, moves = self.older
        at = state << 8 | byte
        move = moves.get(at)
        if move is None:
            emitted, following = self._move(state, byte)
            number = self.states.get(following)
            if number is None:
                number = states.get(following)
            if number is None:
                number, self.made = self.made, self.made + 1
            move = emitted, number
        else:
            following = paths[move[1]]
        self.states[following], self.paths[move[1]] = move[1], following
        self.moves[at] = move
        return move

    def merged(self, piece: bytes, until: int = 1) -> list[bytes]:
        """Parts by the merges themselves, lowest rank first and leftmost of equals, until so few are left."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        ranks = [self.ranks.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while len(parts) > until:
            best = min(ranks)
            if best == NEVER:
                break
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = self.ranks.get(parts[i] + parts[i + 1], NEVER)
            if i:
                ranks[i - 1] = self.ranks.get(parts[i - 1] + parts[i], NEVER)
        return parts

    def follows(self, left: int, right: int) -> bool:
        """Whether the two tokens side by side stay as they are.

        Seen backwards, the parts at the border are the last parts of the left
        token and the first parts of the right one. Two of them lie side by side
        until one is merged away from the border; a merge across it with a lower
        rank would have come first (at equal ranks, the one more to the left).
        """
        until, ranks, token_bytes, left_of, right_of = NEVER, self.ranks, self.token_bytes, self.left, self.right
        while True:
            if ranks.get(token_bytes[left] + token_bytes[right], NEVER) < until:
                return False
            of_left, of_right = right_of[left], left_of[right]
            if of_left < 0 and of_right < 0:
                return True
            if of_right < 0 or (of_left >= 0 and left > right):
                until, left = left, of_left
            else:
                until, right = right + 1, of_right

    def _fits(self, left: int, right: int) -> bool:
        """`follows`, of pairs asked before."""
        pair = left << 32 | right
        fits = self.fits.get(pair)
        if fits is None:
            if len(self.fits) >= CACHE:
                self.fits.clear()
            fits = self.fits[pair] = self.follows(left, right)
        return fits

    def _move(self, state: int, byte: int) -> tuple[tuple, tuple]:
        """Tokens emitted, and the live paths of the state that follows."""
        live, whole = [], False
        below, ends, fits = self.below, self.ends, self._fits
        known = self.paths.get(state)
        for out, last, node in self.older[1][state] if known is None else known:
            node = below[node].get(byte)
            if node is None:
                continue
            if below[node]:
                live.append((out, last, node))
            if whole:  # the bytes so far have one BPE form only
                continue
            token = ends[node]
            if token >= 0 and (last < 0 or fits(last, token)):
                live.append(((*out, token), token, 0))
                whole = True
        agreed = 0
        if live[0][0]:
            outs = [out for out, _, _ in live]
            shortest = min(map(len, outs))
            while agreed < shortest and all(out[agreed] == outs[0][agreed] for out in outs):
                agreed += 1
        emitted = live[0][0][:agreed]
        return emitted, tuple((out[agreed:], last, node) for out, last, node in live) if agreed else tuple(live)

    def _searched(self, piece: bytes) -> list[int]:
        """Token ids of a piece by the paths themselves, one at a time, longer tokens first.

        The bytes before a place have one BPE form, so a place that led nowhere
        once never does.
        """
        n, below, ends, sizes, shorter, fits = len(piece), self.below, self.ends, self.sizes, self.shorter, self.fits
        tokens: list[int] = []
        dead: set[int] = set()
        at, last, token = 0, -1, -2
        while True:
            if token == -2:  # the longest token from here
                node, end = 0, at
                while end < n:
                    node = below[node].get(piece[end])
                    if node is None:
                        break
                    end += 1
                    if ends[node] >= 0:
                        token = ends[node]
            while token >= 0:
                end = at + sizes[token]
                if end not in dead:
                    if last < 0:
                        break
                    pair = last << 32 | token
                    fit = fits.get(pair)
                    if fit is None:
                        fit = self._fits(last, token)
                    if fit:
                        break
                token = shorter[token]
            if token >= 0:
                tokens.append(token)
                if end == n:
                    return tokens
                at, last, token = end, token, -2
            else:
                dead.add(at)
                token = tokens.pop()
                at -= sizes[token]
                last = tokens[-1] if tokens else -1
                token = shorter[token]

    def encode(self, piece: bytes) -> list[int]:
        """Token ids of a piece; a piece that is a token is that token.

        A move is determinised once pieces have asked for it ASKED times; until
        then a piece that asks for it is searched, unless it is long.
        """
        if piece in self.ranks:
            return [self.ranks[piece]]
        if len(self.paths) >= CACHE:
            self._forget()
        ids: list[int] = []
        state, moves = 0, self.moves
        for byte in piece:
            move = moves.get(state << 8 | byte)
            if move is None:
                at = state << 8 | byte
                asked = self.met.get(at, 0)
                if asked < ASKED and at not in self.older[2] and len(piece) <= SEARCHED:
                    if len(self.met) >= CACHE:
                        self.met.clear()
                    self.met[at] = asked + 1
                    return self._searched(piece)
                move = self._next(state, byte)
            if move[0]:
                ids.extend(move[0])
            state = move[1]
        ids.extend(next(out for out, _, node in self.paths[state] if node == 0))
        return ids


def packed_ids(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


class Pieces(dict):
    """Ids of pieces, as little-endian unsigned 32-bit integers.

    When the cache is full it becomes the older one, and what was in the older
    one before and not asked for since is forgotten.
    """

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = packed_ids(self.transducer.encode(piece.encode()))
            if len(piece) > CACHED_PIECE:
                return ids
        if len(self) >= CACHED_PIECES:
            self.older = dict(self)
            self.clear()
        self[piece] = ids
        return ids


def chunks(text: str, size: int = CHUNK) -> Iterator[str]:
    """Cuts a long text before white space that follows other characters, where pieces always end."""
    cut = regex.compile(r"(?<=\S)(?=\s)")
    start = 0
    while len(text) - start > size:
        found = cut.search(text, start + size)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = regex.compile(pattern)
        self.pieces = Pieces(Transducer(ranks))

    def encode(self, text: str) -> bytes:
        known = self.pieces.__getitem__
        return b"".join(b"".join(map(known, self.pattern.findall(part))) for part in chunks(text))


# Bytes that may follow in UTF-8. (first, last) of the lead, state after it.
LEADS = [
    (0x00, 0x7F, 0), (0xC2, 0xDF, 1), (0xE0, 0xE0, 4), (0xE1, 0xEC, 2), (0xED, 0xED, 5), (0xEE, 0xEF, 2),
    (0xF0, 0xF0, 6), (0xF1, 0xF3, 3), (0xF4, 0xF4, 7),
]
# (state, first, last, state after it): plain continuations, then those after E0, ED, F0 and F4.
TAILS = [
    (1, 0x80, 0xBF, 0), (2, 0x80, 0xBF, 1), (3, 0x80, 0xBF, 2),
    (4, 0xA0, 0xBF, 1), (5, 0x80, 0x9F, 1), (6, 0x90, 0xBF, 2), (7, 0x80, 0x8F, 2),
]
BROKEN = 8


def utf8_moves() -> list[list[int]]:
    moves = [[BROKEN] * 256 for _ in range(BROKEN + 1)]
    for state, first, last, then in [(0, *lead) for lead in LEADS] + TAILS:
        moves[state][first : last + 1] = [then] * (last + 1 - first)
    return moves


class Decoder:
    """Bytes of ids, fed in any portions; `state` is 0 between characters, BROKEN after bytes that no UTF-8 text has."""

    def __init__(self, ranks: dict[bytes, int]):
        self.vocabulary = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.vocabulary[rank] = token
        self.moves = utf8_moves()
        self.after: dict[tuple[int, int], int] = {}
        self.complete = np.array([self._run(0, token) == 0 for token in self.vocabulary])
        self.state = 0

    def _run(self, state: int, token: bytes) -> int:
        for byte in token:
            state = self.moves[state][byte]
        return state

    def feed(self, ids: np.ndarray) -> bytes:
        """Bytes of the next ids; tokens that start and end between characters leave the state as it is."""
        numbers = ids.tolist()
        i, pending = 0, iter(np.flatnonzero(~self.complete[ids]).tolist())
        if self.state:
            pending = chain([0], pending)
        for at in pending:
            if at < i:
                continue
            i = at
            while i < len(numbers) and (self.state or i == at):
                key = (self.state, numbers[i])
                if key not in self.after:
                    self.after[key] = self._run(self.state, self.vocabulary[numbers[i]])
                self.state = self.after[key]
                i += 1
                if self.state == BROKEN:
                    i = len(numbers)
        return b"".join(map(self.vocabulary.__getitem__, numbers))

    def decode(self, ids: bytes, portion: int = CHUNK) -> tuple[bytes, bool]:
        """All bytes, and whether they are whole UTF-8."""
        numbers = np.frombuffer(ids, dtype="<u4")
        self.state = 0
        out = b"".join(self.feed(numbers[i : i + portion]) for i in range(0, len(numbers), portion))
        return out, self.state == 0


def _portions(batches: Iterator[pa.RecordBatch], schema: pa.Schema, made, column: str) -> Iterator[pa.RecordBatch]:
    """Rows with what `made` gives for the column's value; output batches stay small."""
    for batch in batches:
        start, values, size = 0, [], 0
        given = batch.column(batch.schema.get_field_index(column))
        for i in range(batch.num_rows):
            values.append(made(given[i].as_py()))
            size += sum(len(v) for v in values[-1] if isinstance(v, bytes))
            if size >= BATCH_BYTES or i == batch.num_rows - 1:
                part = batch.slice(start, i + 1 - start)
                added = [pa.array(list(v), type=f.type) for v, f in zip(zip(*values), list(schema)[1:])]
                yield pa.RecordBatch.from_arrays([part.column(0), *added], schema=schema)
                start, values, size = i + 1, [], 0


def _mapped(df: DataFrame, column: str, fields: list[T.StructField], builder) -> DataFrame:
    schema = T.StructType([df.schema["row"], *fields])
    kinds = {T.LongType: pa.int64(), T.BinaryType: pa.binary(), T.BooleanType: pa.bool_()}
    added = [pa.field(f.name, kinds[type(f.dataType)]) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.default_memory_pool().release_unused()  # of the worker's earlier tasks
        made = builder()
        for batch in batches:
            yield from _portions(iter([batch]), pa.schema([batch.schema.field(0), *added]), made, column)
        rest()

    return df.mapInArrow(run, schema)


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Per row: struct `row` of the `carry` columns (default all), `n_tokens`, `token_ids` (little-endian unsigned 32-bit).

    The driver reads the vocabulary file, about a megabyte, and broadcasts it.

    Null text: as an empty one, no ids. Repeated rows, null ids, columns of any
    name: each row by itself, its columns kept. Empty table: no rows. Texts of
    any length are cut where pieces end, never shortened.
    """
    return _coded(docs, ranks_path, pattern, text, carry, False)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """As `encode`, and the ids decoded again in the same task: `decoded` bytes, and `whole` as in `decode`."""
    return _coded(docs, ranks_path, pattern, text, carry, True)


def _coded(docs: DataFrame, ranks_path: str, pattern: str, text: str, carry: list[str] | None, back: bool) -> DataFrame:
    known = read_ranks(ranks_path)
    key = (fingerprint(known), pattern)
    ranks = docs.sparkSession.sparkContext.broadcast(known)
    wanted = docs.columns if carry is None else carry
    source = docs.select(F.struct(*[docs[f"`{c}`"] for c in wanted]).alias("row"), F.col(text).alias("text"))

    def builder():
        encoder = kept(Encoder, key, ranks.value, pattern)
        decoder = kept(Decoder, key, ranks.value) if back else None

        def made(value: str | None):
            ids = encoder.encode(value or "")
            return (len(ids) // 4, ids, *decoder.decode(ids)) if back else (len(ids) // 4, ids)

        return made

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("token_ids", T.BinaryType())]
    if back:
        fields += [T.StructField("decoded", T.BinaryType()), T.StructField("whole", T.BooleanType())]
    return _mapped(source, "text", fields, builder)


def decode(encoded: DataFrame, ranks_path: str, ids: str = "token_ids") -> DataFrame:
    """Per row: struct `row` of all its columns, `decoded` bytes, and `whole`: whether they are whole UTF-8 text.

    Null ids: no bytes. Ids outside the vocabulary raise.
    """
    known = read_ranks(ranks_path)
    key = (fingerprint(known),)
    ranks = encoded.sparkSession.sparkContext.broadcast(known)
    source = packed(encoded, ids=F.col(ids))

    def builder():
        decoder = kept(Decoder, key, ranks.value)
        return lambda value: decoder.decode(value or b"")

    fields = [T.StructField("decoded", T.BinaryType()), T.StructField("whole", T.BooleanType())]
    return _mapped(source, "ids", fields, builder)
