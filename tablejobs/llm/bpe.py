"""Byte-level BPE as a transducer, and streaming decoding.

Encoding. Merges by rank define one encoding for every byte string, and every
prefix's encoding is found from left to right: the prefix of a string that ends
in token ``t`` is encoded as the encoding of what comes before ``t`` plus ``t``
exactly when ``t`` and the token before it stay apart if their bytes are merged
alone. The transducer's states hold the bytes whose tokens can still change,
with the token before them. Reading a byte finds the last token of each prefix;
tokens on which every continuation agrees are emitted, after a lookahead no
longer than the longest token. States are made when first reached (lazily), and
each transition, once found, is a dictionary entry.

Decoding. Token bytes are fed to an incremental UTF-8 state machine whose
transition for a (state, token) pair is likewise computed once.

What a worker remembers (states, transitions, answers, frequent pre-tokens) is
bounded in bytes, so that memory does not depend on the texts; past a bound, that
memory starts anew.

Defined results: a null text is the empty text, with no ids; ids and bytes of a
text don't depend on its neighbours; repeated rows and ties need no special case, as
every pre-token is encoded separately; a very long text is read as a stream of
pre-tokens, ``RUN`` at a time; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from itertools import chain, islice
from struct import Struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablejobs.llm.store import read
from tablejobs.llm.textbatch import kept, slices, trim_memory

#: Bounds, in bytes, of what one worker remembers: states with their transitions, answers
#: whether tokens stay apart, and each of two generations of pre-tokens.
STATE_BYTES = 224 << 20
APART_BYTES = 24 << 20
WORD_BYTES = 64 << 20
#: What an entry of a dictionary with an integer (or string) key takes beside the sizes of its objects.
ENTRY = 100


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merge_by_rank(piece: bytes, ranks: dict[bytes, int], stop: int = 1) -> list[bytes]:
    """The definition: repeat the merge of lowest rank, leftmost first, down to ``stop`` parts."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > stop:
        best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], 1 << 60))
        if parts[best] + parts[best + 1] not in ranks:
            break
        parts[best:best + 2] = [parts[best] + parts[best + 1]]
    return parts


_BYTES = [bytes((b,)) for b in range(256)]
#: A state: the length of the token before (-1: none), of the pending bytes, and the number of
#: alive places; then both byte strings, the alive places and the other cuts, each number a byte
#: (two with more than ``NARROW`` pending bytes).
_HEAD = Struct("=hHH")
_START = [(0, 0)]
NARROW = 255


def _state(before: bytes | None, pending: bytes, alive: list[tuple[int, int]],
           others: list[tuple[int, int]]) -> bytes:
    numbers = chain.from_iterable(alive + others)
    places = bytes(numbers) if len(pending) <= NARROW else array("H", numbers).tobytes()
    if before is None:
        return _HEAD.pack(-1, len(pending), len(alive)) + pending + places
    return _HEAD.pack(len(before), len(pending), len(alive)) + before + pending + places


def _parts(state: bytes) -> tuple[bytes | None, bytes, list[tuple[int, int]], list[tuple[int, int]]]:
    a, b, places = _HEAD.unpack_from(state)
    lo = _HEAD.size + max(a, 0)
    numbers = state[lo + b:] if b <= NARROW else array("H", state[lo + b:])
    pairs = list(zip(numbers[::2], numbers[1::2]))
    return None if a < 0 else state[_HEAD.size:lo], state[lo:lo + b], pairs[:places], pairs[places:]


class Transducer:
    """Encodes byte strings; shared by all pre-tokens of a task."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.beginnings = {t[:i] for t in ranks for i in range(1, len(t))}
        #: token: the two parts of its last merge; none for a byte or where merging doesn't give the token
        self.halves: dict[bytes, tuple[bytes, bytes] | None] = {}
        #: one token's rank plus 1 (0: none) and the next one's rank: whether they stay apart
        self.apart: dict[int, bool] = {}
        self.reset()

    def reset(self) -> None:
        #: a state (see ``_state``): token before; pending bytes; (place, length of the last token
        #: there) for each place of the pending bytes at which a later token can still start; the
        #: same for other cuts on the way to those places
        self.states = [_state(None, b"", _START, [])]
        #: the state found last, with its parts: mostly the next one asked for
        self.latest: tuple = (-1, ())
        self.numbers = {self.states[0]: 0}
        #: number of a state, times 256, plus a byte: that of the next state, times 256, plus 1
        #: if ids are emitted
        self.moves: dict[int, int] = {}
        self.emitted: dict[int, tuple[int, ...]] = {}
        self.ends: dict[int, tuple[int, ...]] = {}
        self.bytes = 0

    def split(self, token: bytes) -> tuple[bytes, bytes] | None:
        known = self.halves.get(token, ())
        if known == ():
            parts = merge_by_rank(token, self.ranks, stop=2)
            whole = len(parts) == 2 and len(token) > 1
            known = self.halves[token] = (parts[0], parts[1]) if whole else None
        return known

    def stay_apart(self, a: bytes | None, b: bytes) -> bool:
        """Whether the bytes of ``a`` and ``b``, merged together, end as ``a`` and ``b``
        (which needs ``b`` to be what its own bytes merge to, as in any trained vocabulary).

        Undoes the merges inside both, the latest first: the two would have joined
        if at some moment the parts that touched had a merge due before the next one."""
        if len(self.apart) * ENTRY > APART_BYTES:
            self.apart.clear()
        key = (0 if a is None else self.ranks[a] + 1) << 32 | self.ranks[b]
        if a is None or len(b) > 1 and self.split(b) is None:
            known = self.apart[key] = len(b) == 1 or self.split(b) is not None
            return known
        ranks, left, right, due = self.ranks, a, b, 1 << 60
        while True:
            joined = ranks.get(left + right)
            if joined is not None and joined < due:
                known = False
                break
            l, r = self.split(left), self.split(right)
            if l is None and r is None:
                known = True
                break
            # Of equal merges the left one comes first, so the right one is undone first.
            if r is None or l is not None and ranks[left] > ranks[right]:
                due, left = ranks[left], l[1]
            else:
                due, right = ranks[right] + 1, r[0]
        self.apart[key] = known
        return known

    def step(self, move: int) -> int:
        """Find a transition (a key of ``moves``) and return its value."""
        known, parts = self.latest
        before, pending, alive, others = parts if known == move >> 8 else _parts(self.states[move >> 8])
        pending += _BYTES[move & 255]
        n, size, ongoing = len(pending), 0, []
        ranks, beginnings, apart = self.ranks, self.beginnings, self.apart
        for place in alive:
            p, k = place
            token = pending[p:] if p else pending
            if not size:
                rank = ranks.get(token)
                if rank is not None:
                    previous = pending[p - k:p] if p else before
                    fits = apart.get((0 if previous is None else ranks[previous] + 1) << 32 | rank)
                    if fits if fits is not None else self.stay_apart(previous, token):
                        size = n - p                # the longest: places ascend
            if token in beginnings:
                ongoing.append(place)
        if not size:
            raise ValueError("bytes that no token covers")
        if not ongoing:
            emitted, cut, last = (), n, dict(others)
            last.update(alive)
            last[n] = size
            while cut:
                emitted = (ranks[pending[cut - last[cut]:cut]], *emitted)
                cut -= last[cut]
            parts = (pending[n - size:], b"", _START, [])
        else:
            last = dict(alive)
            last.update(others)
            last[n] = size
            ongoing.append((n, size))
            # The encodings up to these places form a tree of cuts; its deepest common
            # cut is final, as every continuation starts from one of them.
            nodes = {p for p, _ in ongoing}
            while len(nodes) > 1:
                deepest = max(nodes)
                nodes.remove(deepest)
                nodes.add(deepest - last[deepest])
            agreed = cut = nodes.pop()
            emitted = ()
            while cut:
                emitted = (ranks[pending[cut - last[cut]:cut]], *emitted)
                cut -= last[cut]
            if agreed:
                before = pending[agreed - last[agreed]:agreed]
                pending = pending[agreed:]
            here = {p for p, _ in ongoing}
            here.add(agreed)
            more = {}
            for p, k in ongoing:
                while p > agreed:
                    p -= last[p]
                    if p not in here:
                        more[p - agreed] = last[p]
            # Without a token that may start there, what comes before the first place is of no use.
            if ongoing[0][0] > agreed:
                before = None
            parts = (before, pending, [(p - agreed, k if p > agreed else 0) for p, k in ongoing],
                     sorted(more.items()))
        state = _state(*parts)
        number = self.numbers.get(state)
        if number is None:
            number = self.numbers[state] = len(self.states)
            self.states.append(state)
            self.bytes += len(state) + 40 + ENTRY
        self.latest = (number, parts)
        value = number << 8
        if emitted:
            self.emitted[move] = emitted
            self.bytes += 8 * len(emitted) + 40 + ENTRY
            value |= 1
        self.moves[move] = value
        self.bytes += 32 + ENTRY
        return value

    def finish(self, state: int) -> tuple[int, ...]:
        """The ids of the bytes still pending in a state (its number times 256)."""
        _, pending, alive, others = _parts(self.states[state >> 8])
        last, cut, out = dict(alive) | dict(others), len(pending), []
        while cut:
            out.append(self.ranks[pending[cut - last[cut]:cut]])
            cut -= last[cut]
        known = self.ends[state] = tuple(out[::-1])
        self.bytes += 8 * len(known) + 40 + ENTRY
        return known

    def encode(self, piece: bytes) -> list[int]:
        if self.bytes > STATE_BYTES:
            self.reset()
        moves, emitted, state, out = self.moves.get, self.emitted, 0, []
        for byte in piece:
            move = state | byte
            state = moves(move)
            if state is None:
                state = self.step(move)
            if state & 1:
                out += emitted[move]
                state -= 1
        out += self.ends.get(state) or self.finish(state)
        return out


#: Lead byte ranges of UTF-8 and the range of the byte after them (well-formed sequences).
_LEADS = ((0xC2, 0xDF, 1, 0x80, 0xBF), (0xE0, 0xE0, 2, 0xA0, 0xBF), (0xE1, 0xEC, 2, 0x80, 0xBF),
          (0xED, 0xED, 2, 0x80, 0x9F), (0xEE, 0xEF, 2, 0x80, 0xBF), (0xF0, 0xF0, 3, 0x90, 0xBF),
          (0xF1, 0xF3, 3, 0x80, 0xBF), (0xF4, 0xF4, 3, 0x80, 0x8F))
#: States: 0 between characters; (left, low, high): continuation bytes expected; -1: not UTF-8.
START, BROKEN = 0, -1


def utf8_step(state, byte: int):
    if state == START:
        if byte < 0x80:
            return START
        for lo, hi, left, low, high in _LEADS:
            if lo <= byte <= hi:
                return (left, low, high)
        return BROKEN
    if state == BROKEN or not state[1] <= byte <= state[2]:
        return BROKEN
    return (state[0] - 1, 0x80, 0xBF) if state[0] > 1 else START


class StreamDecoder:
    """Bytes of ids as they come, with the UTF-8 state after them. Ids are given
    as their decimal digits, the form in which they are stored."""

    def __init__(self, tokens: dict[str, bytes]):
        self.tokens = tokens
        self.known: dict[tuple, object] = {}
        #: Tokens of whole characters: between characters they lead back there.
        self.whole = frozenset(i for i, t in tokens.items() if self._after(START, t) == START)

    @staticmethod
    def _after(state, token: bytes):
        for byte in token:
            state = utf8_step(state, byte)
        return state

    def decode(self, ids: list[str], state=START) -> tuple[bytes, object]:
        """(bytes, state). The caller passes the state on with the next ids."""
        if state != START or not self.whole.issuperset(ids):
            for i in ids:
                if state == START and i in self.whole:
                    continue
                after = self.known.get((state, i))
                if after is None:
                    after = self.known[state, i] = self._after(state, self.tokens[i])
                state = after
        return b"".join(map(self.tokens.__getitem__, ids)), state


class Tokenizer:
    """Pre-tokens by pattern, each encoded by the transducer and remembered, as their
    ids' digits, in two generations of bounded size."""

    #: Pre-tokens handled at once, and the length from which a text is read as a stream of them.
    RUN = 20_000
    LONG = 1 << 20

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.transducer = Transducer(ranks)
        self.decoder = StreamDecoder({str(i): t for t, i in ranks.items()})
        self.pattern = regex.compile(pattern)
        self.words: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.bytes = 0

    def runs(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of a text, up to ``RUN`` at a time."""
        if len(text) <= self.LONG:
            found = self.pattern.findall(text)
            for lo in range(0, len(found), self.RUN):
                yield found[lo:lo + self.RUN]
            return
        matches = (m.group() for m in self.pattern.finditer(text))
        while found := list(islice(matches, self.RUN)):
            yield found

    def digits(self, found: list[str]) -> str:
        """The ids of pre-tokens, in decimal, joined by spaces."""
        if self.bytes > WORD_BYTES:
            self.older, self.words, self.bytes = self.words, {}, 0
        words, older = self.words, self.older
        for piece in set(found).difference(words):
            known = older.get(piece)
            if known is None:
                known = " ".join(map(str, self.transducer.encode(piece.encode())))
            words[piece] = known
            self.bytes += len(piece) + len(known) + 100 + ENTRY
        return " ".join(map(words.__getitem__, found))

    def encode(self, text: str) -> list[int]:
        return [int(i) for found in self.runs(text) for i in self.digits(found).split(" ")]

    def digest(self, text: str, packed: bytearray | None = None) -> tuple[int, str, str, bool]:
        """(number of ids, digest of the ids, digest of the decoded bytes, decoded bytes are
        UTF-8); the ids themselves are added to ``packed``, four bytes each."""
        n, state, plain, back = 0, START, hashlib.sha256(), hashlib.sha256()
        for found in self.runs(text):
            digits = self.digits(found)
            ids = digits.split(" ")
            plain.update((f" {digits}" if n else digits).encode())
            n += len(ids)
            decoded, state = self.decoder.decode(ids, state)
            back.update(decoded)
            if packed is not None:
                packed += np.fromstring(digits, "<i4", sep=" ").tobytes()
        return n, plain.hexdigest(), back.hexdigest(), state == START


def tokenizer(path: str, pattern: str) -> Tokenizer:
    """One per Python worker and vocabulary, until the worker gets other work."""
    return kept(("bpe", path, pattern), lambda: Tokenizer(load_ranks(path), pattern))


def encode_decode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                  text: str = "text", ids: bool = False) -> DataFrame:
    """Per document: id, n_tokens, ids_sha256, decoded_sha256 and whether the
    decoded stream ended between characters; with ``ids`` also the ids, as a binary
    column of little-endian 32-bit numbers (``unpack_ids``). ``path``: the rank file,
    present on every machine."""
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))
    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256", "valid_utf8", *(["ids"] if ids else [])]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim_memory()
        t = tokenizer(path, pattern)
        for part, _, _ in slices(batches):
            packed = [bytearray() if ids else None for _ in range(part.num_rows)]
            rows = [t.digest(x or "", p) for x, p in zip(part.column(1).to_pylist(), packed)]
            n, sha, back, valid = zip(*rows)
            columns = [part.column(0), pa.array(n, pa.int64()), pa.array(sha), pa.array(back), pa.array(valid)]
            if ids:
                columns.append(pa.array([bytes(p) for p in packed], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = dict(slim.dtypes)["id"]
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, valid_utf8 boolean"
    return slim.mapInArrow(work, schema + (", ids binary" if ids else "")).withColumnRenamed("id", id_col)


def unpack_ids(packed: bytes) -> list[int]:
    return np.frombuffer(packed, "<i4").tolist()


def vocabulary() -> tuple[str, str]:
    """(rank file, pattern) of the public 50k byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op5_bpe(spark, sf_dir: str) -> DataFrame:
    return encode_decode(read(spark, sf_dir, "documents"), *vocabulary())
