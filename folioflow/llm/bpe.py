"""Byte-level BPE as a lazily determinised finite-state transducer, and streaming decoding.

Encoding. A sequence of tokens is what BPE makes of its bytes exactly if each token is its own encoding and each pair of
neighbours is stable, that is, encoding their joined bytes gives the pair back. So the last token of the encoding of
every prefix follows from the last tokens of shorter prefixes. The transducer's state holds, for each prefix that some
token may still extend, the trie node of the bytes since then, that prefix's last token, and the tokens not yet
emitted; prefixes that no vocabulary entry can extend are dropped, and tokens that all remaining prefixes share are
emitted. Lookahead is thus bounded by the longest entry. States and transitions are made when first met and kept (up to
a limit, after which they are made anew).

As in the public rank files' encoders, a piece that is itself an entry is that one token.

Decoding. ``StreamDecoder`` takes ids in any portions and gives text as soon as it is complete, by an incremental UTF-8
state machine whose state is how many bytes of which sequence are open; broken sequences become U+FFFD.

Defined results: a null text is the empty text and gives no tokens; lone surrogates can't occur in Spark strings;
keys of any type come back as they were, null beside large ones too; repeated rows stay rows; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import contextlib
import ctypes
import gc
import hashlib
import marshal
import re
import threading
from collections.abc import Iterable, Iterator
from functools import lru_cache
from struct import pack

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import table

#: Most states of the transducer, and most bytes of remembered pieces and words, in each Python worker. What is
#: remembered changes how long a text takes, never its ids.
MAX_STATES, MAX_BYTES = 350_000, 200_000_000
#: What an entry of a dict of short strings and bytes takes besides their characters.
ENTRY = 190
#: Seconds without a partition after which a worker lets go of all it remembers.
IDLE = 2.0


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge_by_rank(piece: bytes, ranks: dict[bytes, int], down_to: int = 1) -> list[int]:
    """BPE from its definition: join the adjacent pair of lowest rank, leftmost first, until none is left. For short inputs."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > down_to:
        low = min(((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1)))
        if low[0] == 1 << 60:
            break
        parts[low[1] : low[1] + 2] = [parts[low[1]] + parts[low[1] + 1]]
    return [ranks[p] for p in parts]


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.bytes_of = ranks, {i: b for b, i in ranks.items()}
        self.next: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        for b, i in ranks.items():
            at = 0
            for x in b:
                to = self.next[at].get(x)
                if to is None:
                    to = self.next[at][x] = len(self.next)
                    self.next.append({})
                    self.token.append(-1)
                at = to
            self.token[at] = i
        self._halves: dict[int, tuple[int, int]] = {}
        self._own: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        #: A state: one (trie node, last token or -1, tokens not yet emitted) for each live prefix, oldest first.
        #: Kept as marshalled bytes, a fifth of the size; the version without references gives equal states equal bytes.
        start = marshal.dumps(((0, -1, ()),), 2)
        self.ids, self.states = {start: 0}, [start]
        #: state << 8 | byte -> (next state << 8, tokens)
        self.arcs: dict[int, tuple[int, tuple[int, ...]]] = {}

    def halves(self, token: int) -> tuple[int, int]:
        """The two tokens of a token's last merge; itself twice for a single byte."""
        known = self._halves.get(token)
        if known is None:
            piece, ranks = self.bytes_of[token], self.ranks
            known = (token, token)
            if len(piece) > 1:
                two = merge_by_rank(piece, ranks, 2)
                known = (two[0], two[1]) if len(two) == 2 else known
            self._halves[token] = known
        return known

    def stable(self, left: int, right: int) -> bool:
        """Does BPE leave this pair apart?

        Going back through the merges on both sides of the border, latest first, no two neighbours across it may have
        had a merge that came before the next merge on either side.
        """
        ranks, text, halves = self.ranks, self.bytes_of, self._halves
        limit = 1 << 60
        while True:
            if ranks.get(text[left] + text[right], 1 << 60) < limit:
                return False
            a = (halves[left] if left in halves else self.halves(left))[1]
            b = (halves[right] if right in halves else self.halves(right))[0]
            if left > right and a != left or b == right:
                if a == left:
                    return True
                limit, left = left, a
            else:
                limit, right = right + 1, b

    def own(self, token: int) -> bool:
        """Does BPE make this one token of its bytes?"""
        if (known := self._own.get(token)) is None:
            known = self._own[token] = merge_by_rank(self.bytes_of[token], self.ranks) == [token]
        return known

    def _arc(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        live, whole, follow, token, own = [], None, self.next, self.token, self._own
        for node, last, pending in marshal.loads(self.states[state]):
            to = follow[node].get(byte)
            if to is None:
                continue
            live.append((to, last, pending))
            if whole is None:
                t = token[to]
                if t >= 0 and (own[t] if t in own else self.own(t)) and (last < 0 or self.stable(last, t)):
                    whole = (0, t, (*pending, t))
        live.append(whole)
        out: tuple[int, ...] = ()
        if live[0][2]:  # what all live prefixes have in common is certain
            low, high = min(p[2] for p in live), max(p[2] for p in live)
            n, most = 0, min(len(low), len(high))
            while n < most and low[n] == high[n]:
                n += 1
            if n:
                out = low[:n]
                live = [(node, last, pending[n:]) for node, last, pending in live]
        key = marshal.dumps(tuple(live), 2)
        to = self.ids.get(key)
        if to is None:
            to = self.ids[key] = len(self.states)
            self.states.append(key)
        arc = self.arcs[state << 8 | byte] = (to << 8, out)
        return arc

    def run(self, piece: bytes) -> list[int]:
        """The ids of a piece, without the rule for whole entries."""
        if len(self.states) > MAX_STATES:
            self._reset()
        at, out, known = 0, [], self.arcs.get
        for byte in piece:
            at, got = known(at | byte) or self._arc(at >> 8, byte)
            if got:
                out += got
        out += marshal.loads(self.states[at >> 8])[-1][2]
        return out

    def encode_piece(self, piece: bytes) -> list[int]:
        known = self.ranks.get(piece)
        return [known] if known is not None else self.run(piece)


class Encoder(dict):
    """A stretch from one white-space character to the next -> its packed ids, remembered up to MAX_BYTES.

    No piece goes on past white space that follows something else, so where white-space characters stand alone, a text
    can be cut before each of them and every stretch looked up whole. Pieces come from the rank files' pattern.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        # \s of the rank files' own engine is the property White_Space
        own = pattern.replace(r"[^\s\p{L}", r"[^\p{White_Space}\p{L}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.transducer, self.split = Transducer(ranks), regex.compile(own).findall
        self.single = [pack("<I", i) for i in range(max(ranks.values(), default=-1) + 1)]
        #: Pieces of stretches that hold several, and what was remembered of stretches and pieces before.
        self.pieces: dict[str, bytes] = {}
        self.before: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})
        self.room = MAX_BYTES // 2

    def _keep(self, known: dict[str, bytes], name: str, packed: bytes) -> None:
        """Two generations: once the newer one is full, it becomes the older, and what nothing asks for again goes."""
        if len(name) <= 64:
            known[name] = packed
            self.room -= ENTRY + len(name) + len(packed)
            if self.room < 0:
                self.before = (dict(self), self.pieces)
                self.clear()
                self.pieces, self.room = {}, MAX_BYTES // 2

    def piece(self, piece: str) -> bytes:
        ids = self.transducer.encode_piece(piece.encode())
        return self.single[ids[0]] if len(ids) == 1 else pack(f"<{len(ids)}I", *ids)

    def __missing__(self, word: str) -> bytes:
        packed = self.before[0].get(word)
        if packed is None:
            found = self.split(word if word[:1] == "\n" else " " + word)
            packed = self.piece(found[0]) if len(found) == 1 else self._joined(found)
        self._keep(self, word, packed)
        return packed

    def _joined(self, found: list[str]) -> bytes:
        out = []
        for piece in found:
            packed = self.pieces.get(piece)
            if packed is None:
                packed = self.before[1].get(piece) or self.piece(piece)
                self._keep(self.pieces, piece, packed)
            out.append(packed)
        return b"".join(out)

    def packed(self, text: str) -> bytes:
        if _TWO_BLANKS(text):
            return self._joined(self.split(text))
        first, *rest = text.replace("\n", " \n").split(" ")
        return b"".join([self._joined(self.split(first)), *map(self.__getitem__, rest)])

    def encode(self, text: str) -> list[int]:
        return memoryview(self.packed(text)).cast("I").tolist()


_TWO_BLANKS = re.compile(r"\s\s").search


class Utf8Machine:
    """Which bytes may follow: state 0 is between characters; others say how many bytes are missing and their first range."""

    def __init__(self) -> None:
        self.open = b""

    @staticmethod
    def missing(lead: int) -> int:
        return 0 if lead < 0xC2 or lead > 0xF4 else 1 if lead < 0xE0 else 2 if lead < 0xF0 else 3

    def feed(self, data: bytes) -> str:
        """The text that is complete; an open sequence at the end waits."""
        data = self.open + data
        cut = len(data)
        for back in range(1, min(3, cut) + 1):
            x = data[cut - back]
            if x >= 0xC0:
                if self.missing(x) >= back and self._fits(data[cut - back :]):
                    cut -= back
                break
            if x < 0x80:
                break
        self.open = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    @staticmethod
    def _fits(seq: bytes) -> bool:
        if len(seq) < 2:
            return True
        low, high = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(seq[0], (0x80, 0xBF))
        return low <= seq[1] <= high

    def close(self) -> str:
        rest, self.open = self.open, b""
        return rest.decode("utf-8", "replace")


class StreamDecoder:
    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of, self.machine = bytes_of, Utf8Machine()

    def feed(self, ids: Iterable[int]) -> str:
        return self.machine.feed(b"".join(map(self.bytes_of.__getitem__, ids)))

    def close(self) -> str:
        return self.machine.close()


@lru_cache(1)
def encoder(path: str | None = None) -> Encoder:
    """One for each Python worker. path: of a rank file; it is on every machine, as the library that holds it is."""
    import public_tokenizers

    return Encoder(read_ranks(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)


class _Lease:
    """While a partition runs, the worker's encoder stays; IDLE seconds after the last one it goes, and its memory with it.

    Workers outlive stages, so what they remember would otherwise stay beside the stages that follow.
    """

    running, timer = 0, None
    lock = threading.Lock()

    def __enter__(self) -> None:
        with _Lease.lock:
            _Lease.running += 1
            if _Lease.timer:
                _Lease.timer.cancel()

    def __exit__(self, *_: object) -> None:
        with _Lease.lock:
            _Lease.running -= 1
            _Lease.timer = threading.Timer(IDLE, self.release)
            _Lease.timer.daemon = True
            _Lease.timer.start()

    @staticmethod
    def release() -> None:
        with _Lease.lock:
            if not _Lease.running:
                encoder.cache_clear()
                gc.collect()
                with contextlib.suppress(OSError, AttributeError):  # where the C library has it
                    ctypes.CDLL(None).malloc_trim(0)


#: Ids decoded at a time.
PORTION = 1 << 16


def round_trip(text: str, e: Encoder) -> tuple[int, str, str]:
    packed = e.packed(text)
    ids, h, decoder = memoryview(packed).cast("I"), hashlib.sha256(), StreamDecoder(e.transducer.bytes_of)
    for i in range(0, len(ids), PORTION):
        h.update(decoder.feed(ids[i : i + PORTION].tolist()).encode())
    h.update(decoder.close().encode())
    return len(ids), hashlib.sha256(packed).hexdigest(), h.hexdigest()


def encode_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, ids: bool = False) -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256 and, on request, the ids themselves: one pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _Lease():
            e, collects = encoder(path), gc.isenabled()
            gc.disable()  # nothing here makes cycles, and passes over the transducer's many tuples take a fifth of the time
            try:
                for b in batches:
                    texts = [t if t is not None else "" for t in b.column(1).to_pylist()]
                    got = [round_trip(t, e) for t in texts]
                    out = [b.column(0), pa.array([x[0] for x in got], pa.int64()), *(pa.array([x[i] for x in got], pa.string()) for i in (1, 2))]
                    names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
                    if ids:
                        out, names = [*out, pa.array([e.encode(t) for t in texts], pa.list_(pa.int64()))], [*names, "ids"]
                    yield pa.RecordBatch.from_arrays(out, names)
            finally:
                del e
                if collects:
                    gc.enable()

    rows = docs.select(F.col(f"`{key}`"), F.col(f"`{text}`"))
    more = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<long>" * ids
    return rows.mapInArrow(run, StructType([rows.schema[0], *StructType.fromDDL(more)]))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))
