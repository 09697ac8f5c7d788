"""Byte-level BPE by a lazily determinised finite-state transducer.

Encoding.  A string's BPE encoding is the one token sequence whose adjacent
pairs are all *compatible*: merging the bytes of the two tokens gives back
exactly these two.  So the encoding of every prefix is fixed by its last
token, and reading one more byte only asks which token ending here is
compatible with the last token before it.  That makes a transducer:

* a state holds every boundary from which a token can still start, with what
  has been read since (shorter than a token) and the last token before it;
* reading a byte finds the token that ends at the new boundary, which is the
  arc's output, and forgets boundaries no token can start from any more;
* tokens up to the last boundary that all open ones go back to are settled
  and emitted.  Open boundaries lie within one token's length, so settling
  needs a bounded lookahead.

States and arcs are made when first needed and kept while there is room
(``MAX_STATES``); beyond that a state is worked out where it is met, which
costs time and never changes a result.  Pieces that recur are composite arcs
from the start state, at most ``MAX_PIECES`` of them.

Decoding runs an incremental UTF-8 state machine over the ids: its state is
the unfinished code point (at most three bytes).  Invalid bytes give U+FFFD.

The vocabulary (path given by the caller, bounded by its file) is read on the
driver and broadcast.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoal.llm.common import resident, ship, strings

MAX_STATES = 80_000
MAX_PAIRS = 300_000
MAX_PIECES = 500_000
MET_SLOTS = 1 << 23
MAX_PIECE_CHARS = 64
LOOKAHEAD = 512


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        return {base64.b64decode(tok): int(rank) for tok, rank in map(bytes.split, f)}


def merge_bytes(data: bytes, ranks: dict[bytes, int], down_to: int = 1) -> list[bytes]:
    """Plain BPE: merge the leftmost adjacent pair of lowest rank until none
    is left, or ``down_to`` parts are."""
    parts = [data[i:i + 1] for i in range(len(data))]
    while len(parts) > down_to:
        rank, at = min((ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == 1 << 60:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Transducer:
    """Bytes in, token ids out; arcs are determinised on first use."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks, self.max_states = ranks, max_states
        self.tokens = {r: t for t, r in ranks.items()}
        self.sizes = {r: len(t) for r, t in self.tokens.items()}
        prefixes = (t[:k] for t in ranks for k in range(1, len(t)))
        self.begins = {p: p for p in prefixes}  # one object per prefix
        self.pairs: dict[tuple[int, int], bool] = {}
        self.splits: dict[int, tuple[int, int] | None] = {}
        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.arcs: list[dict[int, tuple[int, int]]] = []
        self.start = self._number((b"", -1))  # what was read since, and the token before, per boundary

    def _number(self, state: tuple) -> int:
        """Number of a state; -1 if it is new and there is no room."""
        n = self.numbers.get(state, -1)
        if n < 0 and len(self.states) < self.max_states:
            n = self.numbers[state] = len(self.states)
            self.states.append(state)
            self.arcs.append({})
        return n

    def _parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge made ``token``; None for a byte."""
        if token not in self.splits:
            parts = merge_bytes(self.tokens[token], self.ranks, down_to=2)
            self.splits[token] = tuple(self.ranks[p] for p in parts) if len(parts) == 2 else None
        return self.splits[token]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the border between two tokens survives all merges.

        Goes back in time: undo the later of the two last merges beside the
        border.  A merge across the border of what is then exposed would have
        come first if its rank is below that of the merge just undone (at
        equal rank the leftmost comes first).
        """
        known = self.pairs.get((left, right))
        if known is not None:
            return known
        ranks, tokens = self.ranks, self.tokens
        l, r, limit, known = left, right, 1 << 60, True
        while True:
            across = ranks.get(tokens[l] + tokens[r])
            if across is not None and across < limit:
                known = False
                break
            lp, rp = self._parts(l), self._parts(r)
            if lp is None and rp is None:
                break
            if rp is None or (lp is not None and l > r):
                limit, l = l, lp[1]
            else:
                limit, r = r + 1, rp[0]
        if len(self.pairs) < MAX_PAIRS:
            self.pairs[left, right] = known
        return known

    def _step(self, state: tuple, byte: int) -> tuple[tuple, int]:
        """The state after a byte, and the token that ends with it."""
        char, ranks, begins = bytes((byte,)), self.ranks, self.begins
        new, live = None, []
        for i in range(0, len(state), 2):  # the longest token first
            tail, last = state[i] + char, state[i + 1]
            if new is None and (token := ranks.get(tail)) is not None and (last < 0 or self.compatible(last, token)):
                new = token
            tail = begins.get(tail)
            if tail is not None:  # some token can still start at this boundary
                live += (tail, last)
        if new is None:
            raise ValueError(f"the vocabulary has no token for byte {byte}")
        live += (b"", new)
        return tuple(live), new

    def _ends(self, data: Iterable[int]) -> Iterator[tuple[int, tuple | None, int]]:
        """Per byte: the token that ends with it, and the state, by itself if
        it has no number."""
        arcs, state, loose = self.arcs, self.start, None
        for byte in data:
            if loose is None:
                arc = arcs[state].get(byte)
                if arc is not None:
                    state, token = arc
                else:
                    loose, token = self._step(self.states[state], byte)
                    after = self._number(loose)
                    if after >= 0:
                        arcs[state][byte] = after, token
                        state, loose = after, None
            else:
                loose, token = self._step(loose, byte)
                after = self._number(loose)
                if after >= 0:
                    state, loose = after, None
            yield token, loose, state

    def _back(self, ends: list[int], i: int) -> Iterator[int]:
        """Boundaries on the way back from boundary ``i``."""
        while i:
            yield i
            i -= self.sizes[ends[i - 1]]
        yield 0

    def _settled(self, ends: list[int], state: tuple) -> int:
        """The last boundary that all open boundaries go back to."""
        n = len(ends)
        common: set[int] | None = None
        for tail in state[::2]:
            way = set(self._back(ends, n - len(tail)))
            common = way if common is None else common & way
        return max(common)

    def _emit(self, ends: list[int], upto: int) -> list[int]:
        out = [ends[i - 1] for i in self._back(ends, upto) if i]
        out.reverse()
        return out

    def stream(self, data: Iterable[int]) -> Iterator[list[int]]:
        """Token ids of one piece, as soon as ``LOOKAHEAD`` bytes later than
        they end (at the piece's end: the rest)."""
        ends = []
        for token, loose, state in self._ends(data):
            ends.append(token)
            if len(ends) >= LOOKAHEAD and (upto := self._settled(ends, loose or self.states[state])):
                yield self._emit(ends, upto)
                del ends[:upto]
        if ends:
            yield self._emit(ends, len(ends))

    def encode(self, data: bytes) -> list[int]:
        """Token ids of one piece."""
        whole = self.ranks.get(data)
        if whole is not None:  # a vocabulary entry stands for itself
            return [whole]
        if len(data) >= LOOKAHEAD:
            return [i for ids in self.stream(data) for i in ids]
        ends = [token for token, _, _ in self._ends(data)]
        return self._emit(ends, len(ends))


class Utf8Decoder:
    """Streaming decoder: ids in, text out, unfinished code points held back."""

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens = tokens

    @staticmethod
    def step(held: bytes, data: bytes) -> tuple[str, bytes]:
        """Text completed by ``data`` after ``held``, and what is held now
        (the machine's state: at most three bytes)."""
        data = held + data
        end = len(data)
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if lead & 0xC0 == 0x80:
                continue
            need = 2 if lead >> 5 == 6 else 3 if lead >> 4 == 14 else 4 if lead >> 3 == 30 else 1
            if need > back:
                end = len(data) - back
            break
        return data[:end].decode("utf-8", "replace"), data[end:]

    def decode(self, ids: Sequence[int], chunk: int = 4096) -> Iterator[str]:
        """Pieces of text, one per ``chunk`` ids; the last call flushes."""
        held, get = b"", self.tokens.__getitem__
        for k in range(0, len(ids), chunk):
            text, held = self.step(held, b"".join(map(get, ids[k:k + chunk])))
            yield text
        if held:
            yield held.decode("utf-8", "replace")


class Codec:
    """Pieces of a text by ``pattern``, each through the transducer.

    A piece's ids are kept from the second time it is met (a bitmap of hashes
    tells), so words that occur once do not displace those that recur."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.fst = Transducer(ranks)
        self.find = regex.compile(pattern).findall
        self.decoder = Utf8Decoder(self.fst.tokens)
        self.known: dict[str, bytes] = {}
        self.met = bytearray(MET_SLOTS)

    def _piece(self, piece: str) -> bytes:
        packed = self.known.get(piece)
        if packed is None:
            ids = self.fst.encode(piece.encode("utf-8"))
            packed = struct.pack(f"<{len(ids)}I", *ids)
            slot = hash(piece) % MET_SLOTS
            if not self.met[slot]:
                self.met[slot] = 1
            elif len(piece) <= MAX_PIECE_CHARS:
                if len(self.known) >= MAX_PIECES:
                    self.known.clear()
                self.known[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        pieces = self.find(text)
        packed = list(map(self.known.get, pieces))
        if None in packed:
            packed = [p if p is not None else self._piece(x) for p, x in zip(packed, pieces)]
        return b"".join(packed)

    def decode(self, packed: bytes) -> str:
        return "".join(self.decoder.decode(memoryview(packed).cast("I")))


def codec(ranks: dict[bytes, int], pattern: str, key: str) -> Codec:
    """One codec per vocabulary and Python worker; its arcs serve all tasks."""
    return resident(key, lambda: Codec(ranks, pattern))


def _vocabulary(spark: SparkSession, path: str, pattern: str):
    ship(spark)
    ranks = load_ranks(path)
    key = hashlib.sha256(repr(sorted(ranks.items())).encode() + pattern.encode()).hexdigest()
    return spark.sparkContext.broadcast(ranks), key


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: every text's token ids, one row per input row.

    Null and empty texts have no ids; repeated rows stay; a text of any
    length is one value in and one out."""
    ranks, key = _vocabulary(docs.sparkSession, path, pattern)

    def run(batches):
        c = codec(ranks.value, pattern, key)
        for b in batches:
            ids = [memoryview(c.encode(t)).cast("I").tolist() for t in strings(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return _texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` from token ids (null ids: empty text)."""
    ranks, key = _vocabulary(tokens.sparkSession, path, pattern)

    def run(batches):
        c = codec(ranks.value, pattern, key)
        for b in batches:
            texts = ["".join(c.decoder.decode(i or ())) for i in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return (tokens.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
            .mapInArrow(run, "doc_id long, text string"))


def token_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Encode and decode every text in one pass and return digests of both:
    ``doc_id, n_tokens, ids_sha256, decoded_sha256``; one row per input row."""
    ranks, key = _vocabulary(docs.sparkSession, path, pattern)

    def run(batches):
        c = codec(ranks.value, pattern, key)
        for b in batches:
            n, ids, back = [], [], []
            for t in strings(b.column(1)):
                packed = c.encode(t)
                n.append(len(packed) // 4)
                ids.append(hashlib.sha256(packed).hexdigest())
                back.append(hashlib.sha256(c.decode(packed).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _texts(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
