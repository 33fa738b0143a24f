"""Byte-level BPE as a finite-state transducer, and its streaming decoder.

Encoding. Merges by rank have a local rule: a token sequence is the encoding of its bytes exactly if each
two neighbours t, u are the encoding of the bytes of t and u (no merge can cross a border that it doesn't
cross when only its two neighbours are there). So the encoding is the run of a nondeterministic
transducer: a thread has read a place in the vocabulary's prefix tree since a last token t, and may end a
token u wherever the tree has one and (t, u) fit. At each byte exactly one thread ends a token, since
every prefix has one encoding; the others read on.

The threads' places are determinised while the transducer runs: a state is the set of places, and is made
when an input byte first asks for it. The finite memory beside it holds the tokens that ended at the
last bytes, as far back as the longest token reaches; they say which of a state's candidates ended here.
A token is emitted once all living threads descend from it. A thread lives for the length of the longest
token at most, so the lookahead is bounded by the vocabulary, not by the text.

Texts are cut into pieces by the vocabulary's pattern first, as ranks hold within a piece. A piece that is
itself in the vocabulary is that token, also if no merges lead to it. Short pieces that are not remembered
run through the transducer side by side, a byte of each at a time, in numpy; long ones run alone.

Decoding. The decoder's states are the unfinished UTF-8 sequences; a token moves it from one to another
and emits the characters it completes, so a stream of ids can be shown as it comes.
"""

from __future__ import annotations

import codecs
from array import array
from base64 import b64decode
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append, quoted, text_bytes

#: Characters of a text that are cut into pieces at once.
STRETCH = 1 << 20
#: States, judged pairs of tokens, and decoder steps that a worker keeps; beyond, it begins anew.
STATES, PAIRS, STEPS = 50_000, 400_000, 200_000
#: Pieces whose ids are remembered, in each of two generations, and their longest.
PIECES, LONGEST = 150_000, 32
#: Bytes of a long piece after which agreed tokens are emitted.
LOOK = 4096
#: Pieces that run through the transducer side by side.
ABREAST = 8192
#: A character that is neither letter, digit nor white space (private use).
OTHER = "\ue000"

_ENDS, _PLACES, _UNFINISHED = -1, -2, -3  # keys of a state besides bytes or ids
_START = -1  # the last token before the first
_NEVER = 1 << 40  # above all ranks


class Transducer:
    """Encodes the bytes of single pieces by merges alone."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        self.ranks = ranks
        self.words = {number: word for word, number in ranks.items()}
        self.children: list[dict[int, int]] = [{}]
        self.token: list[int | None] = [None]
        self.depth = [0]
        for word, number in ranks.items():
            node = 0
            for byte in word:
                above, node = node, self.children[node].setdefault(byte, len(self.children))
                if node == len(self.children):
                    self.children.append({})
                    self.token.append(None)
                    self.depth.append(self.depth[above] + 1)
            self.token[node] = number
        self.sides: dict[int, tuple[list, list] | None] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.states: dict[tuple[int, ...], dict] = {}
        self.start = self.state((0,))

    def merged(self, data: bytes, left: list | None = None, right: list | None = None) -> tuple[list[bytes], bool]:
        """Merges by rank, the leftmost of the lowest first, for the bytes of one or two tokens; and
        whether the ranks never fell. ``left`` and ``right`` get each first and last part with the rank
        of the merge that took it up."""
        parts = [data[i : i + 1] for i in range(len(data))]
        rising, before, none = True, -1, len(self.ranks)
        while len(parts) > 1:
            rank, i = min((self.ranks.get(a + b, none), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == none:
                break
            if left is not None and i == 0:
                left.append((parts[0], rank))
            if right is not None and i == len(parts) - 2:
                right.append((parts[-1], rank))
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            rising, before = rising and rank >= before, rank
        return parts, rising

    def edges(self, token: int) -> tuple[list, list] | None:
        """A token's first and last parts while it is merged, each with the rank at which it ends; none
        if its merges don't come in the order of their ranks, or don't lead to it."""
        if token not in self.sides:
            word, left, right = self.words[token], [], []
            parts, rising = self.merged(word, left, right)
            whole = rising and parts == [word]
            self.sides[token] = ([*left, (word, _NEVER)], [*right, (word, _NEVER)]) if whole else None
        return self.sides[token]

    def fit(self, last: int, token: int) -> bool:
        """Whether ``token`` can follow ``last``, or begin a piece: whether no merge crosses their border
        while the two are merged side by side."""
        if last == _START:
            return self.merged(self.words[token])[0] == [self.words[token]]
        a, b = self.edges(last), self.edges(token)
        if a is None or b is None:
            pair = [self.words[last], self.words[token]]
            return self.merged(b"".join(pair))[0] == pair
        rank, i, j = self.ranks.get, 0, 0
        while True:
            (x, x_ends), (y, y_ends) = a[1][i], b[0][j]
            crossing = rank(x + y, _NEVER)
            # of equal ranks the leftmost merge comes first
            if crossing < x_ends and crossing <= y_ends and crossing != _NEVER:
                return False
            if x_ends == y_ends == _NEVER:
                return True
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1

    def judged(self, last: int, token: int) -> bool:
        """:meth:`fit`, remembered."""
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        found = self.pairs[last, token] = self.fit(last, token)
        return found

    def state(self, places: tuple[int, ...]) -> dict:
        """The state of a set of places, the deepest first."""
        found = self.states.get(places)
        if found is None:
            if len(self.states) >= STATES:
                self.states.clear()
                self.start = self.state((0,))
            ends = tuple((self.token[p], self.depth[p]) for p in places if self.token[p] is not None)
            found = self.states[places] = {_PLACES: places, _ENDS: ends}
        return found

    def step(self, state: dict, byte: int) -> dict:
        """The state after one more byte; made once."""
        moved = [self.children[place].get(byte) for place in state[_PLACES]]
        found = state[byte] = self.state((*(place for place in moved if place is not None), 0))
        return found

    def agreed(self, state: dict, ended: list[int]) -> int:
        """The last offset at which all living threads have ended a token."""
        starts = {len(ended) - 1 - self.depth[place] for place in state[_PLACES]}
        while len(starts) > 1:
            last = max(starts)
            starts.remove(last)
            starts.add(last - len(self.words[ended[last]]))
        return starts.pop()

    def emit(self, ended: list[int], end: int) -> list[int]:
        """The tokens up to an offset."""
        out = []
        while end > 0:
            out.append(ended[end])
            end -= len(self.words[ended[end]])
        return out[::-1]

    def stream(self, piece: bytes) -> Iterator[list[int]]:
        """The ids of one piece, as soon as they are certain, but not oftener than every ``LOOK`` bytes."""
        state, pairs = self.start, self.pairs
        ended = [_START]  # by offset, from the last token that was emitted on
        for byte in piece:
            state = state.get(byte) or self.step(state, byte)
            ends = state[_ENDS]
            if len(ends) > 1:
                for token, length in ends:  # one of them fits, so the last needs no look
                    if length == 1:
                        break
                    last = ended[-length]
                    fits = pairs.get((last, token))
                    if fits or fits is None and self.judged(last, token):
                        break
            else:
                ((token, _),) = ends
            ended.append(token)
            if len(ended) > LOOK:
                end = self.agreed(state, ended)
                yield self.emit(ended, end)
                del ended[:end]
        yield self.emit(ended, len(ended) - 1)

    def encode(self, piece: bytes) -> list[int]:
        return list(chain.from_iterable(self.stream(piece)))


class Lockstep:
    """A transducer run over many short pieces side by side: its states have numbers, the steps between
    them are a table that is filled when a byte first asks for one, and judged pairs lie in a hash table."""

    def __init__(self, transducer: Transducer) -> None:
        self.transducer = transducer
        self.base = max(transducer.words) + 1
        self.lengths = np.zeros(self.base, np.int64)
        for number, word in transducer.words.items():
            self.lengths[number] = len(word)
        self.reset()

    def reset(self) -> None:
        self.numbers: dict[tuple[int, ...], int] = {}
        self.states: list[dict] = []
        self.next = np.empty((0, 256), np.int32)
        #: Where a state's candidates begin; their tokens and lengths, the longest first.
        self.first, self.tokens, self.backs = np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int32)
        self.number(self.transducer.state((0,)))
        self.tables()
        self.judged, size = 0, 1 << (2 * PAIRS).bit_length()
        self.codes, self.fit = np.full(size, -1, np.int64), np.zeros(size, bool)  # judged pairs

    def number(self, state: dict) -> int:
        found = self.numbers.setdefault(state[_PLACES], len(self.states))
        if found == len(self.states):
            self.states.append(state)
        return found

    def tables(self) -> None:
        """The arrays for states that were added."""
        if len(self.states) > len(self.next):
            more = np.full((len(self.states) - len(self.next) + 1024, 256), -1, np.int32)
            self.next = np.concatenate([self.next, more])
        added = [state[_ENDS] for state in self.states[len(self.first) :]]
        starts = np.cumsum([len(self.tokens), *map(len, added)])[:-1]
        pairs = np.array([pair for ends in added for pair in ends], np.int32).reshape(-1, 2)
        self.first = np.concatenate([self.first, starts])
        self.tokens, self.backs = np.concatenate([self.tokens, pairs[:, 0]]), np.concatenate([self.backs, pairs[:, 1]])

    def moved(self, states: np.ndarray, data: np.ndarray) -> np.ndarray:
        """The states after one more byte each."""
        found = self.next[states, data]
        new = np.flatnonzero(found < 0)
        if len(new):
            for code in np.unique(states[new].astype(np.int64) << 8 | data[new]).tolist():
                self.next[code >> 8, code & 255] = self.number(self.transducer.step(self.states[code >> 8], code & 255))
            self.tables()
            found[new] = self.next[states[new], data[new]]
        return found

    def slots(self, codes: np.ndarray) -> np.ndarray:
        """Where each pair lies, or the free place where it belongs."""
        last = len(self.codes) - 1
        slots = (codes * 0x9E3779B97F4A7C1 >> 20) & last
        rows = np.arange(len(codes))
        while len(rows):
            held = self.codes[slots[rows]]
            rows = rows[(held != codes[rows]) & (held >= 0)]
            slots[rows] = slots[rows] + 1 & last
        return slots

    def fits(self, lasts: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Whether each token can follow the one before it."""
        codes = (lasts.astype(np.int64) - _START) * self.base + tokens
        slots = self.slots(codes)
        new = self.codes[slots] < 0
        if new.any():
            asked = np.unique(codes[new])
            if self.judged + len(asked) > PAIRS:
                self.codes[:], self.judged = -1, 0
                return self.plainly(codes)
            self.judged += len(asked)
            left = asked
            while len(left):  # of two for one place the other looks on
                places = self.slots(left)
                self.codes[places] = left
                left = left[self.codes[places] != left]
            self.fit[self.slots(asked)] = self.plainly(asked)
            slots = self.slots(codes)
        return self.fit[slots]

    def plainly(self, codes: np.ndarray) -> np.ndarray:
        """As :meth:`fits`, not remembered."""
        fit, base = self.transducer.fit, self.base
        return np.fromiter((fit(c // base + _START, c % base) for c in codes.tolist()), bool, len(codes))

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece as 32-bit numbers. No piece is empty."""
        if len(self.states) >= STATES // 4:  # a state's row in the table is larger than the state
            self.reset()
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        order = np.argsort(-sizes, kind="stable")  # so those that go on are the first ones
        sizes = sizes[order]
        width = int(sizes[0])
        data = np.zeros((len(pieces), width), np.uint8)
        data[np.arange(width) < sizes[:, None]] = np.frombuffer(b"".join([pieces[i] for i in order.tolist()]), np.uint8)
        ended = np.full((len(pieces), width + 1), _START, np.int32)
        states = np.zeros(len(pieces), np.int32)
        for j, going in enumerate(np.searchsorted(-sizes, -np.arange(width)).tolist()):
            states = self.moved(states[:going], data[:going, j])
            rows, at = np.arange(going), self.first[states]
            while len(rows):
                tokens, backs = self.tokens[at], self.backs[at]
                fit = backs == 1  # one of them fits, so the last needs no look
                asked = np.flatnonzero(~fit)
                fit[asked] = self.fits(ended[rows[asked], j + 1 - backs[asked]], tokens[asked])
                ended[rows[fit], j + 1] = tokens[fit]
                rows, at = rows[~fit], at[~fit] + 1
        # from each piece's end back to its beginning, written from the right
        out, free = np.zeros((len(pieces), width), np.int32), np.full(len(pieces), width)
        rows, ends = np.arange(len(pieces)), sizes
        while len(rows):
            tokens = ended[rows, ends]
            free[rows] -= 1
            out[rows, free[rows]] = tokens
            ends = ends - self.lengths[tokens]
            rows, ends = rows[ends > 0], ends[ends > 0]
        ids, found = out.tobytes(), [b""] * len(pieces)
        for row, (i, begin) in enumerate(zip(order.tolist(), free.tolist())):
            found[i] = ids[4 * (row * width + begin) : 4 * (row + 1) * width]
        return found


def stretches(text: str) -> Iterator[str]:
    """Parts of a long text, cut where white space follows a character that is none: no piece reaches
    over such a place."""
    start = 0
    while len(text) - start > STRETCH:
        place = _EDGE.search(text, start + STRETCH)
        if place is None:
            break
        yield text[start : place.start()]
        start = place.start()
    yield text[start:]


_EDGE = regex.compile(r"(?<=\S)(?=\s)")


class Encoder:
    """Cuts texts into pieces and encodes those. ``others`` are characters that the vocabulary's own
    library takes neither for letters nor for digits, though regex does."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, others: str = "") -> None:
        self.transducer = Transducer(ranks)
        self.lockstep = Lockstep(self.transducer)
        self.pattern = regex.compile(pattern)
        self.others = dict.fromkeys(map(ord, others), OTHER)
        self.unsure = frozenset(others)
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def pieces(self, text: str) -> Iterable[str]:
        if not text.isascii() and not self.unsure.isdisjoint(text):
            shown = text.translate(self.others)  # character by character, so places stay the same
            return (text[m.start() : m.end()] for m in self.pattern.finditer(shown))
        if len(text) <= 2 * STRETCH:
            return self.pattern.findall(text)
        return (m.group() for m in self.pattern.finditer(text))

    def stream(self, text: str) -> Iterator[bytes]:
        """The ids of a text as 32-bit numbers, stretch by stretch."""
        for part in stretches(text):
            yield from self.filled([self.looked(part)])

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text; pieces that are not remembered are encoded together, for some texts at
        once."""
        waiting, missing, length = [], 0, 0
        for text in texts:
            if missing >= ABREAST or length + len(text) > STRETCH:
                yield from self.filled(waiting)
                waiting, missing, length = [], 0, 0
            if len(text) > STRETCH:
                yield b"".join(self.stream(text))
            else:
                waiting.append(self.looked(text))
                missing += len(waiting[-1][1])
                length += len(text)
        yield from self.filled(waiting)

    def looked(self, text: str) -> tuple[list[bytes | None], list[tuple[int, str]]]:
        """The ids of a text's pieces, as far as they are among the recent ones, and the other pieces with
        their places."""
        pieces = list(self.pieces(text))
        found = list(map(self.recent.get, pieces))
        return found, [(i, pieces[i]) for i, ids in enumerate(found) if ids is None] if None in found else []

    def filled(self, waiting: list[tuple[list[bytes | None], list[tuple[int, str]]]]) -> Iterator[bytes]:
        """The ids of texts that were looked up, with those of their other pieces."""
        new = self.learnt(piece for _, others in waiting for _, piece in others)
        for found, others in waiting:
            for i, piece in others:
                found[i] = new[piece]
            yield b"".join(found)

    def learnt(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """The ids of pieces that were not among the recent ones."""
        found = dict.fromkeys(pieces, b"")
        short = []
        for piece in found:
            ids = self.older.get(piece)
            if ids is None:
                data = piece.encode()
                whole = self.transducer.ranks.get(data)
                if whole is None and len(piece) <= LONGEST:
                    short.append((piece, data))
                    continue
                ids = array("i", self.transducer.encode(data) if whole is None else [whole]).tobytes()
            found[piece] = ids
        for start in range(0, len(short), ABREAST):
            part = short[start : start + ABREAST]
            found.update(zip([piece for piece, _ in part], self.lockstep.encode([data for _, data in part])))
        for piece, ids in found.items():
            if len(piece) <= LONGEST:
                if len(self.recent) >= PIECES:
                    self.older, self.recent = self.recent, {}
                self.recent[piece] = ids
        return found


class Decoder:
    """Ids to text as they come; ids outside the vocabulary are an error, bytes that are no UTF-8 become
    U+FFFD."""

    def __init__(self, words: dict[int, bytes]) -> None:
        self.words = words
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")
        self.reset()

    def reset(self) -> None:
        #: By unfinished sequence: id to (characters completed, the state that follows).
        self.states: dict[bytes, dict] = {}
        self.learnt = 0
        self.now = self.state(b"")

    def state(self, unfinished: bytes) -> dict:
        return self.states.setdefault(unfinished, {_UNFINISHED: unfinished})

    def step(self, state: dict, number: int) -> tuple[str, dict]:
        if number not in self.words:
            raise ValueError(f"no token has the id {number}")
        self.machine.setstate((state[_UNFINISHED], 0))
        made = self.machine.decode(self.words[number])
        unfinished = self.machine.getstate()[0]
        self.learnt += 1
        if self.learnt > STEPS:
            self.reset()
        found = state[number] = (made, self.state(unfinished))
        return found

    def begin(self) -> None:
        self.now = self.state(b"")

    def feed(self, ids: Iterable[int]) -> str:
        """The characters that these ids complete."""
        out, state = [], self.now
        for number in ids:
            made, state = state.get(number) or self.step(state, number)
            out.append(made)
        self.now = state
        return "".join(out)

    def finish(self) -> str:
        """What an unfinished sequence at the end is shown as."""
        return self.now[_UNFINISHED].decode("utf-8", "replace")


def read_ranks(path: str) -> dict[bytes, int]:
    """A table of ranks: a line for each token, its bytes in base64 and its number."""
    with open(path, "rb") as lines:
        return {b64decode(word): int(number) for word, number in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str, others: str = "") -> Encoder:
    """One transducer for each worker process; a reused worker keeps what it has determinised."""
    return Encoder(read_ranks(path), pattern, others)


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder({number: word for word, number in read_ranks(path).items()})


@lru_cache(maxsize=4)
def newer_characters(pattern: str) -> str:
    """Letters and digits of the regex library that tiktoken's tables don't know as such.

    The two libraries follow different versions of Unicode. Characters that Python's own, older tables
    lack, but regex has, are tried in tiktoken: they are one piece with a letter (or digit) before them,
    or they are not.
    """
    import unicodedata

    import tiktoken

    new = "".join(c for c in map(chr, chain(range(0xD800), range(0xE000, 0x110000))) if unicodedata.category(c) == "Cn")
    found = []
    for kind, lead in (("L", "a"), ("N", "1")):
        asked = regex.findall(rf"\p{{{kind}}}", new)
        ranks = {bytes([b]): b for b in range(256)}
        ranks.update({(lead + c).encode(): 256 + i for i, c in enumerate(asked)})
        tried = tiktoken.Encoding("tried", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        found += [c for c in asked if len(tried.encode_ordinary(lead + c)) > 1]
    return "".join(found)


def encode(docs: DataFrame, ranks: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text as the array ``ids``. ``ranks`` is the path of a table of
    ranks that every executor can read, ``pattern`` the vocabulary's regular expression; texts that spell
    special tokens are ordinary texts.

    Null and empty texts have no ids. Very long texts are encoded stretch by stretch. Repeated rows get
    the same ids; an empty table gives an empty table. A column named like ``ids`` is replaced.
    """
    others = newer_characters(pattern)

    def make():
        own = encoder(ranks, pattern, others)

        def step(texts: pa.Array):
            found = list(own.encode(t.decode("utf-8", "replace") for t in texts.to_pylist()))
            ends = np.cumsum([0, *(len(ids) // 4 for ids in found)], dtype=np.int32)
            return [pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(found), np.int32))]

        return step

    return append(docs, [text_bytes(quoted(text))], T.StructType([T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)]), make)


def decode(frame: DataFrame, ranks: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``frame`` with the text of the ids as ``text``; null ids count as none, nulls among them are
    skipped. A column named like ``text`` is replaced."""

    def make():
        own = decoder(ranks)

        def one(numbers: np.ndarray) -> str:
            own.begin()
            return own.feed(numbers.tolist()) + own.finish()

        def step(arrays: pa.ListArray):
            numbers, ends = arrays.values.to_numpy(zero_copy_only=False), arrays.offsets.to_numpy()
            return [pa.array([one(numbers[a:b]) for a, b in zip(ends, ends[1:])], pa.string())]

        return step

    some = F.coalesce(quoted(ids), F.array().cast("array<int>"))
    if frame.select(quoted(ids)).schema[0].dataType.containsNull:
        some = F.array_compact(some)
    return append(frame, [some], T.StructType([T.StructField(text, T.StringType(), False)]), make)
