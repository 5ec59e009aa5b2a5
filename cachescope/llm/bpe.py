"""Operator 10: byte-level BPE encoding and decoding.

Texts are cut into pieces without a regex.  Every code point gets a class; an
apostrophe that a contraction suffix follows gets a class that says how long the
suffix is.  A class acts on a small automaton as a transition function; the
functions compose associatively, so a blocked scan of function numbers gives the
state before each code point, and (state, class, next class) says whether a piece
starts there.  Distinct pieces are then merged together: each round
finds the lowest-ranked adjacent pair of every piece and joins it; merged pieces
are kept in a bounded cache for later batches.  Offsets of pieces and ids are
kept, so decoding is a gather of the ids' bytes.

The work is one ``mapInArrow`` over the documents: no shuffle, memory bounded by a
slice of texts and the caches.  Null texts are encoded as empty ones (no ids).
Rows are independent, so repeated rows, ties, empty tables and extra columns
need no rule.  A text is read whole; a very long one is its own slice.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cachescope.llm.common import map_batches, row_slices, span_hashes, utf8

# --------------------------------------------------------------------------
# pre-tokenisation
# --------------------------------------------------------------------------

# The classes.  Q1/Q2 is an apostrophe before a contraction suffix of 1/2 letters.
LETTER, NUMBER, BLANK, SPACE, OTHER, Q1, Q2, EDGE = range(8)
# The contraction suffixes.
SUFFIXES = ("s", "t", "re", "ve", "m", "ll", "d")
# Code points of White_Space.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# Automaton states: what the code point just read leaves open.
S_FRESH, S_LETTER, S_NUMBER, S_OTHER, S_BLANK, S_SPACE, S_TAKE1, S_TAKE2, S_DONE = range(9)
N_STATES = 9


def _step(state: int, cls: int) -> int:
    """State after reading ``cls`` in ``state``; one letter or two belong to an open contraction."""
    if cls == EDGE:
        return S_FRESH
    if state == S_TAKE2:
        return S_TAKE1
    if state == S_TAKE1:
        return S_DONE
    if cls in (Q1, Q2):
        # a contraction needs a match that starts at the apostrophe: not inside a run of
        # other signs and not behind a space, which would be taken along
        if state in (S_OTHER, S_SPACE):
            return S_OTHER
        return S_TAKE1 if cls == Q1 else S_TAKE2
    return {LETTER: S_LETTER, NUMBER: S_NUMBER, BLANK: S_BLANK, SPACE: S_SPACE, OTHER: S_OTHER}[cls]


def _starts(state: int, cls: int, nxt: int) -> bool:
    """Whether a piece starts at a code point of ``cls`` read in ``state``; ``nxt`` is the next class."""
    if cls == EDGE or state == S_FRESH:
        return True
    if state in (S_TAKE1, S_TAKE2):
        return False
    if state == S_DONE:
        return True
    if cls in (BLANK, SPACE):
        # a run of blanks is one piece, but its last one is cut off when text follows
        return state not in (S_BLANK, S_SPACE) or nxt not in (BLANK, SPACE, EDGE)
    kind = {LETTER: S_LETTER, NUMBER: S_NUMBER, OTHER: S_OTHER, Q1: S_OTHER, Q2: S_OTHER}[cls]
    return state not in (kind, S_SPACE)


@lru_cache(1)
def class_table() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    t = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)], np.uint8)
    t[WHITE] = BLANK
    t[0x20] = SPACE
    return t


@lru_cache(1)
def scan_tables():
    """Transition functions closed under composition: (number of each class, products, images)."""
    functions = [tuple(range(N_STATES))] + [tuple(_step(s, c) for s in range(N_STATES)) for c in range(8)]
    known = {f: i for i, f in reversed(list(enumerate(functions)))}
    every, at = list(functions), 0
    while at < len(every):
        for g in functions:
            f = tuple(g[s] for s in every[at])
            if f not in known:
                known[f] = len(every)
                every.append(f)
        at += 1
    product = np.array([[known[tuple(g[s] for s in f)] for g in every] for f in every], np.uint16)
    starts = np.array([[[_starts(s, c, n) for n in range(8)] for c in range(8)] for s in range(N_STATES)], bool)
    return product, np.array(every, np.uint8), starts


def scan_states(classes: np.ndarray, block: int = 128) -> np.ndarray:
    """State before each code point, by a two-level scan of composed transition functions."""
    product, image, _ = scan_tables()
    n = len(classes)
    rows = -(-n // block)
    f = np.zeros(rows * block, np.uint16)      # function 0 is the identity
    f[:n] = classes + 1
    f = np.ascontiguousarray(f.reshape(rows, block).T)
    for j in range(1, block):                 # inclusive scan inside all blocks at once
        f[j] = product[f[j - 1], f[j]]
    carry = np.empty(rows, np.uint8)          # state before each block
    if rows > 4 * block:
        totals = f[-1]
        # the same scan over the blocks' totals, themselves transition functions
        upper = -(-rows // block)
        g = np.zeros(upper * block, np.uint16)
        g[:rows] = totals
        g = np.ascontiguousarray(g.reshape(upper, block).T)
        for j in range(1, block):
            g[j] = product[g[j - 1], g[j]]
        head = np.empty(upper, np.uint8)
        s = S_FRESH
        for k, t in enumerate(g[-1].tolist()):
            head[k] = s
            s = image[t, s]
        after = image[g, head[None, :]].T.reshape(-1)[:rows]
        carry[0] = S_FRESH
        carry[1:] = after[:-1]
    else:
        s = S_FRESH
        for k, t in enumerate(f[-1].tolist()):
            carry[k] = s
            s = image[t, s]
    before = np.empty((rows, block), np.uint8)
    before[:, 0] = carry
    before[:, 1:] = image[f[:-1], carry[None, :]].T
    return before.reshape(-1)[:n]


def piece_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts of all pieces of the rows (ends are the next starts) and piece counts per row."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    lead = np.flatnonzero((data & 0xC0) != 0x80)          # byte position of each code point
    rows = np.searchsorted(lead, offsets)                 # code point offsets of the rows
    cls = class_table()[points]
    n = len(points)
    quotes = np.flatnonzero(points == 0x27)
    if len(quotes):
        row_end = rows[np.searchsorted(rows, quotes, "right")]
        for suffix in SUFFIXES:
            hit = quotes + len(suffix) < row_end
            for k, ch in enumerate(suffix, 1):
                hit &= points[np.minimum(quotes + k, n - 1)] == ord(ch)
            cls[quotes[hit]] = Q1 if len(suffix) == 1 else Q2
    # a row edge is an extra symbol before each row's first code point
    first = rows[:-1][rows[:-1] < rows[1:]]
    at = np.arange(n) + np.searchsorted(first, np.arange(n), "right")
    marked = np.full(n + len(first) + 1, EDGE, np.uint8)
    marked[at] = cls
    state = scan_states(marked)
    _, _, starts = scan_tables()
    begin = starts[state[at], cls, marked[at + 1]]
    begins = lead[begin]
    return begins, np.diff(np.searchsorted(begins, offsets))


# --------------------------------------------------------------------------
# merging
# --------------------------------------------------------------------------

class Vocabulary:
    """Ranks of a tiktoken file, with all mergeable pairs of ids in a hashed array."""

    LONG = 1024      # bytes from which a piece is merged by a heap

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.ranks = ranks
        size = max(ranks.values()) + 1
        self.bytes = [b""] * size
        for token, i in ranks.items():
            self.bytes[i] = token
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        left, right, made = [], [], []
        for token, i in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), made.append(i)
        keys = np.array(left, np.uint64) << np.uint64(32) | np.array(right, np.uint64)
        self.bits = 20
        self.key = np.full(1 << self.bits, (1 << 64) - 1, np.uint64)
        self.made = np.full(1 << self.bits, -1, np.int32)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        made = np.array(made, np.int32)
        self.probes = 0
        while len(todo):                       # linear probing, all waiting keys at once
            self.probes += 1
            free = self.key[slot] == (1 << 64) - 1
            self.key[slot[free]] = keys[todo[free]]
            won = self.key[slot] == keys[todo]
            self.made[slot[won]] = made[todo[won]]
            todo, slot = todo[~won], (slot[~won] + 1) & ((1 << self.bits) - 1)
        decimal = [str(i).encode() + b"," for i in range(size)]
        self.digits = np.array([len(d) for d in decimal], np.int64)
        width = int(self.digits.max())
        self.decimal = np.frombuffer(b"".join(d.ljust(width, b"\0") for d in decimal), np.uint8).reshape(size, width)
        self.length = np.array([len(t) for t in self.bytes], np.int64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair_ids(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of each merged pair, -1 where the two do not merge."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slot = self._slot(keys)
        out = np.where(self.key[slot] == keys, self.made[slot], -1)
        open_ = np.flatnonzero((out < 0) & (self.key[slot] != (1 << 64) - 1))
        for _ in range(self.probes):
            if not len(open_):
                break
            slot = (self._slot(keys[open_]) if _ == 0 else slot) + 1 & ((1 << self.bits) - 1)
            got = self.key[slot] == keys[open_]
            out[open_[got]] = self.made[slot[got]]
            more = ~got & (self.key[slot] != (1 << 64) - 1)
            open_, slot = open_[more], slot[more]
        return out

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, one after the other, and the number of ids of each.

        All pieces are merged in step: a round joins, in every open piece, the
        leftmost pair of lowest rank.  A piece that is a token itself is that token.
        """
        whole = np.array([self.ranks.get(p, -1) for p in pieces], np.int64)
        long_ = [i for i in np.flatnonzero(whole < 0).tolist() if len(pieces[i]) > self.LONG]
        if long_:
            return self._merge_with_long(pieces, set(long_))
        todo = np.flatnonzero(whole < 0)
        counts = np.ones(len(pieces), np.int64)
        if not len(todo):
            return whole.astype(np.int32), counts
        raw = np.frombuffer(b"".join([pieces[i] for i in todo]), np.uint8)
        ids = self.byte_id[raw]
        sizes = np.array([len(pieces[i]) for i in todo], np.int64)
        owner = np.repeat(np.arange(len(todo)), sizes)
        done_ids, done_owner = [], []
        big = np.int64(1) << 62
        pair = np.full(len(ids), -1, np.int64)
        same = owner[1:] == owner[:-1]
        pair[:-1][same] = self.pair_ids(ids[:-1][same], ids[1:][same])
        while len(ids):
            # lowest rank of each piece, leftmost first: one number orders both
            rank = np.where(pair >= 0, (pair << 32) + np.arange(len(ids)), big)
            heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.minimum.reduceat(rank, heads)
            over = best == big
            if over.any():
                shut = np.repeat(over, np.diff(np.r_[heads, len(ids)]))
                done_ids.append(ids[shut]), done_owner.append(owner[shut])
                stay = ~shut
                shift = np.cumsum(stay) - 1
                at = shift[(best[~over] & 0xFFFFFFFF)]
                ids, owner, pair = ids[stay], owner[stay], pair[stay]
                if not len(ids):
                    break
            else:
                at = best & 0xFFFFFFFF
            ids[at] = pair[at]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            new = np.cumsum(keep)[at] - 1
            ids, owner, pair = ids[keep], owner[keep], pair[keep]
            # only the pairs beside a merge change
            for left in (new, new - 1):
                left = left[(left >= 0)]
                pair[left] = -1
                left = left[left + 1 < len(ids)]
                left = left[owner[left] == owner[left + 1]]
                pair[left] = self.pair_ids(ids[left], ids[left + 1])
        flat, owners = np.concatenate(done_ids), np.concatenate(done_owner)
        order = np.argsort(owners, kind="stable")
        counts[todo] = np.bincount(owners, minlength=len(todo))
        out = np.empty(int(counts.sum()), np.int32)
        begin = np.cumsum(counts) - counts
        single = np.ones(len(pieces), bool)
        single[todo] = False
        out[begin[single]] = whole[single]
        slots = np.ones(len(out), bool)
        slots[begin[single]] = False
        out[slots] = flat[order]
        return out, counts


    def _merge_with_long(self, pieces: list[bytes], long_: set[int]) -> tuple[np.ndarray, np.ndarray]:
        rest = [i for i in range(len(pieces)) if i not in long_]
        ids, counts = self.merge([pieces[i] for i in rest])
        parts = dict(zip(rest, np.split(ids, np.cumsum(counts)[:-1]))) if rest else {}
        parts.update((i, self._merge_long(pieces[i])) for i in long_)
        out = [parts[i] for i in range(len(pieces))]
        return np.concatenate(out), np.array([len(x) for x in out], np.int64)

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """One long piece by a heap of its pairs, O(n log n) instead of a round a merge."""
        ids = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, prior = list(range(1, n + 1)), list(range(-1, n - 1))
        made = self.pair_ids(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(made) if r >= 0]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = r, -1, after[j]
            if after[j] < n:
                prior[after[j]] = i
            for left in (prior[i], i):
                right = after[left] if left >= 0 else n
                if right < n:
                    got = int(self.pair_ids(np.array([ids[left]]), np.array([ids[right]]))[0])
                    if got >= 0:
                        heapq.heappush(heap, (got, left, ids[left], ids[right]))
        return np.array([x for x in ids if x >= 0], np.int32)


class Encoder:
    """Encodes slices of texts; keeps merged pieces of earlier slices (bounded)."""

    CACHE = 150_000

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.cache: dict[int, int] = {}
        self.forget()

    def forget(self) -> None:
        self.cache.clear()
        self.ids = np.zeros(0, np.int32)
        self.begin = np.zeros(1, np.int64)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, one after the other, and the row offsets into them."""
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        starts, per_row = piece_bounds(data, offsets)
        ends = np.r_[starts[1:], len(data)]
        hashes, first, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.cache) > self.CACHE:
            self.forget()
        known = self.cache
        number = np.array([known.get(h, -1) for h in hashes.tolist()], np.int64)
        new = np.flatnonzero(number < 0)
        if len(new):
            raw = data.tobytes()
            a, b = starts[first[new]].tolist(), ends[first[new]].tolist()
            ids, counts = self.vocabulary.merge([raw[i:j] for i, j in zip(a, b)])
            base = len(known)
            known.update(zip(hashes[new].tolist(), range(base, base + len(new))))
            number[new] = np.arange(base, base + len(new))
            self.begin = np.r_[self.begin, self.begin[-1] + np.cumsum(counts)]
            self.ids = np.r_[self.ids, ids]
        piece = number[which]
        lengths = self.begin[piece + 1] - self.begin[piece]
        total = np.cumsum(lengths)
        source = np.arange(int(total[-1])) + np.repeat(self.begin[piece] - (total - lengths), lengths)
        row_at = np.r_[0, np.cumsum(per_row)]
        return self.ids[source], np.r_[0, total][row_at]

    def decode(self, ids: np.ndarray) -> bytes:
        table = self.vocabulary.bytes
        return b"".join([table[i] for i in ids.tolist()])

    def joined(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Decimal ids with a comma behind each, and the byte offset before each."""
        v = self.vocabulary
        width = v.digits[ids]
        text = v.decimal[ids][np.arange(v.decimal.shape[1]) < width[:, None]]
        return text.tobytes(), np.r_[0, np.cumsum(width)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode_documents(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text",
                     ids: bool = True) -> DataFrame:
    """Columns ``keep`` with ``token_ids`` (if asked), n_tokens, ids_sha256, decoded_sha256.

    ``path`` is the rank file, found at the same place on every executor.
    """
    source = docs.select(*[docs[c] for c in keep], docs[text].alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    schema += ", n_tokens long, ids_sha256 string, decoded_sha256 string" + (", token_ids array<int>" if ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            data, offsets = utf8(batch.column(len(keep)))
            for lo, hi in row_slices(offsets):
                part = data[offsets[lo]:offsets[hi]]
                out, at = enc.encode(part, offsets[lo:hi + 1] - offsets[lo])
                text_, pos = enc.joined(out)
                sha, back = [], []
                for i, j in zip(at[:-1].tolist(), at[1:].tolist()):
                    sha.append(hashlib.sha256(text_[pos[i]:max(pos[i], pos[j] - 1)]).hexdigest())
                    back.append(hashlib.sha256(enc.decode(out[i:j])).hexdigest())
                columns = [batch.column(k).slice(lo, hi - lo) for k in range(len(keep))]
                columns += [pa.array(np.diff(at), pa.int64()), pa.array(sha), pa.array(back)]
                names = [*keep, "n_tokens", "ids_sha256", "decoded_sha256"]
                if ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(out, pa.int32())))
                    names.append("token_ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return map_batches(source, run, schema)


def decode_documents(encoded: DataFrame, path: str, ids: str = "token_ids", into: str = "text") -> DataFrame:
    """The other way round: adds the text of ``token_ids`` (null ids: null text)."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields) + f", `{into}` binary"
    names = [*encoded.columns, into]
    at = encoded.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            texts = [None if x is None else enc.decode(np.asarray(x, np.int64)) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names)

    return map_batches(encoded, run, schema).withColumn(into, F.decode(F.col(into), "UTF-8"))
