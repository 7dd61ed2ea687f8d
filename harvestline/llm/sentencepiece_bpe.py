"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

The vocabulary comes from a merge-type (BPE) SentencePiece model with byte
fallback. A text is cut before each run of spaces (no piece of such a model
has a space mark after another character, so no merge crosses the cut), and
each chunk is merged with an agenda: a heap of candidate merges, best score
first, leftmost on ties. With dropout, a candidate taken from the agenda is
skipped if a keyed hash of (seed, document, the chunk's place in it, position,
pair) falls below the dropout rate; a skipped merge returns only if a later
merge makes a new candidate. Every occurrence of a chunk is thus drawn on its
own. What a task remembers is not segmentations of occurrences but the order of
merges: for a chunk and the candidates skipped so far, the candidates that come
next and the ids if none of them is skipped. An occurrence's draws lead through
these; chunks that are rare or long are merged by themselves, with equal
results. A document goes by its id and its text. Everything is determined by
seed, document and text: a retried task gives the same ids. Dropout 0 gives the
library's own segmentation.

Characters outside the vocabulary become byte pieces, as does the space mark
itself where a text holds it, so decoding gives back every text exactly; null texts have null ids and decode to null, empty texts
have no ids. Rows are encoded one by one; other columns are not looked at.
"""

from __future__ import annotations

import gc
import heapq
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from harvestline.llm.common import worker_state

MARK = "▁"
CHUNKS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
CACHE_CHUNKS = 800_000  # orders of merges that a task remembers; beyond, it starts anew
LOCKSTEP = 24  # longest chunk that is merged together with others
NEVER = 1 << 40
OFFSET = 1 << 21  # makes ids and numbers of characters positive
WORD = (1 << 64) - 1
MIX = 0xD6E8FEB86659FD93
ROWS = 128  # per output batch
OWN_MARK = -1
SCALE = 1 << 64
SPREAD = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers spread evenly, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grown(array: np.ndarray, size: int) -> np.ndarray:
    """``array``, or a longer one that begins with it if it holds fewer than ``size``."""
    if size <= len(array):
        return array
    return np.concatenate([array, np.full(max(size, 2 * len(array)) - len(array), -1, array.dtype)])


def pair_key(left, right):
    """Two ids (or characters, as numbers under -1) as one non-zero 64-bit number."""
    if isinstance(left, np.ndarray):
        return ((left + np.uint64(OFFSET)) << np.uint64(32)) | ((right + np.uint64(OFFSET)) & np.uint64(0xFFFFFFFF))
    return (left + OFFSET) << 32 | (right + OFFSET)


@dataclass
class Vocabulary:
    ids: dict[str, int]
    scores: dict[str, float]
    pieces: list[str]
    byte_ids: list[int]
    dummy_prefix: bool

    def __post_init__(self) -> None:
        """Tables for merging many chunks at once."""
        self.numbers = list(range(len(self.pieces)))
        # what each id stands for, as UTF-8
        self.shown = [p.replace(MARK, " ").encode() for p in self.pieces]
        for b, i in enumerate(self.byte_ids):
            self.shown[i] = bytes([b])
        # rank: place by score, best first, equal scores sharing one
        order = sorted(self.scores, key=lambda p: -self.scores[p])
        self.char_ids = np.full(1 + max(ord(p) for p in self.ids if len(p) == 1), -1, np.int32)
        pairs, rank, self_rank = [], -1, {}
        for p in order:
            rank += 1
            self_rank[p] = rank
            if len(p) == 1:
                self.char_ids[ord(p)] = self.ids[p]
            for cut in range(1, len(p)):
                # a part is a piece or any single character (of another script, say)
                a, b = self.ids.get(p[:cut]), self.ids.get(p[cut:])
                a = a if a is not None or cut > 1 else -2 - ord(p[0])
                b = b if b is not None or len(p) - cut > 1 else -2 - ord(p[-1])
                if a is not None and b is not None:
                    pairs.append((pair_key(a, b), rank))
        self.by_rank = np.array([self.ids[p] for p in order], np.int64)
        keys = np.array([k for k, _ in pairs], np.uint64)
        ranks = np.array([r for _, r in pairs], np.int64)
        # open addressing: a slot by multiplicative hash, then the next ones
        self.bits = max(4, (8 * len(pairs)).bit_length())
        self.slots = np.zeros(1 << self.bits, np.uint64)
        self.slot_rank = np.full(1 << self.bits, NEVER, np.int64)
        for k, r in zip(keys.tolist(), ranks.tolist()):
            at = (k * SPREAD & WORD) >> (64 - self.bits)
            step = 0
            while self.slots[(at + step) % len(self.slots)]:
                step += 1
            self.slots[(at + step) % len(self.slots)] = k
            self.slot_rank[(at + step) % len(self.slots)] = r

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair of ids, NEVER where there is none."""
        key = pair_key(left.astype(np.uint64), right.astype(np.uint64))
        at = ((key * np.uint64(SPREAD)) >> np.uint64(64 - self.bits)).astype(np.int64)
        slot = self.slots[at]
        out = np.where(slot == key, self.slot_rank[at], NEVER)
        # another pair's slot: look on, until the pair or an empty slot
        open_ = np.nonzero((slot != key) & (slot != 0))
        while len(open_[0]):
            at = (at[open_] + 1) % len(self.slots) if at.shape == out.shape else (at + 1) % len(self.slots)
            wanted = key[open_]
            slot = self.slots[at]
            hit = slot == wanted
            out[tuple(x[hit] for x in open_)] = self.slot_rank[at[hit]]
            more = ~hit & (slot != 0)
            open_, at = tuple(x[more] for x in open_), at[more]
        return out

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        from sentencepiece import sentencepiece_model_pb2 as model_pb2

        model = model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces:
            raise ValueError("this model's normaliser changes texts; encoding would lose them")
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == p.NORMAL}
        bytes_ = {p.piece: i for i, p in enumerate(model.pieces) if p.type == p.BYTE}
        byte_ids = [bytes_[f"<0x{b:02X}>"] for b in range(256)]
        return cls(
            normal,
            {p: model.pieces[i].score for p, i in normal.items()},
            [p.piece for p in model.pieces],
            byte_ids,
            spec.add_dummy_prefix,
        )


class Encoder:
    def __init__(self, vocab: Vocabulary, dropout: float = 0.1, seed: int = 0, remember: int = CACHE_CHUNKS):
        self.remember = remember
        self.vocab, self.dropout, self.seed = vocab, dropout, seed
        self.limit = int(dropout * SCALE)
        self.forget()

    def forget(self) -> None:
        """Start anew with what is known: a node per chunk and candidates skipped so far.

        A node has the chunk, the places of what was skipped among the candidates,
        its ids if nothing more is skipped, and the candidates from ``start`` to
        ``end`` in ``codes``, with the node that skipping each leads to.
        """
        self.roots: dict[str | None, int] = {}
        self.nodes: list[tuple[str | None, tuple[int, ...]]] = []
        self.node_ids: list[tuple[int, ...]] = []
        self.start, self.end = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.codes, self.child = np.zeros(4096, np.uint64), np.full(4096, -1, np.int64)
        self.n_codes = 0
        # A space mark that the text itself holds is written as bytes, so that
        # decoding tells it from a space.
        self.roots[None] = self.add(None, (), [], tuple(self.vocab.byte_ids[b] for b in MARK.encode()))

    def add(self, chunk: str | None, skips: tuple[int, ...], codes: list[int], ids: tuple[int, ...]) -> int:
        """A new node's number."""
        node, n = len(self.nodes), self.n_codes
        self.nodes.append((chunk, skips))
        self.node_ids.append(ids)
        self.start, self.end = grown(self.start, node + 1), grown(self.end, node + 1)
        self.n_codes = n + len(codes)
        if self.n_codes > len(self.codes):
            self.codes = np.concatenate([self.codes, np.zeros(self.n_codes, np.uint64)])
            self.child = grown(self.child, len(self.codes))
        self.start[node], self.end[node] = n, self.n_codes
        self.codes[n : self.n_codes] = np.array([c * SPREAD & WORD for c in codes], np.uint64)
        return node

    def node(self, chunk: str, skips: tuple[int, ...]) -> int:
        """A new node for ``chunk`` with the candidates at the places ``skips`` skipped."""
        taken: list[int] = []

        def skip(at: int, cut: int, piece: int) -> bool:
            taken.append(at << 44 | cut << 24 | piece)
            return len(taken) - 1 in skips

        ids = tuple(map(self.vocab.numbers.__getitem__, self.agenda(chunk, skip)))
        return self.add(chunk, skips, taken[skips[-1] + 1 :] if skips else taken, ids)

    def skipped(self, key: int, at: int, cut: int, piece: int) -> bool:
        """Keyed hash of one candidate merge against the dropout rate."""
        x = key ^ ((at << 44 | cut << 24 | piece) * SPREAD & WORD)
        x = (x ^ x >> 32) * MIX & WORD
        return x ^ x >> 29 < self.limit

    def key(self, chunk: str, place: int) -> int:
        """Key of the hash for the chunk at a place (see ``places``)."""
        return int(mixed(np.array([place & WORD], np.uint64))[0])

    def merged(self, chunk: str, place: int) -> list[int]:
        """Ids of one chunk by agenda merging."""
        if not self.limit:
            return self.agenda(chunk, lambda at, cut, piece: False)
        key = self.key(chunk, place)
        return self.agenda(chunk, lambda at, cut, piece: self.skipped(key, at, cut, piece))

    def agenda(self, chunk: str, skip: Callable[[int, int, int], bool]) -> list[int]:
        """Ids of one chunk; ``skip`` is asked for each candidate in turn."""
        vocab = self.vocab
        parts: list[str | None] = list(chunk)
        n = len(parts)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        agenda: list[tuple[float, int, int, str]] = []
        scores = vocab.scores

        def propose(left: int, right: int) -> None:
            piece = parts[left] + parts[right]
            if (score := scores.get(piece)) is not None:
                heapq.heappush(agenda, (-score, left, right, piece))

        for i in range(n - 1):
            propose(i, i + 1)
        while agenda:
            _, left, right, piece = heapq.heappop(agenda)
            # stale: one side is gone or has grown since
            if parts[left] is None or parts[right] is None or after[left] != right:
                continue
            if parts[left] + parts[right] != piece:
                continue
            if skip(left, len(parts[left]), vocab.ids[piece]):
                continue
            parts[left], parts[right] = piece, None
            after[left] = after[right]
            if after[right] < n:
                before[after[right]] = left
                propose(left, after[right])
            if before[left] >= 0:
                propose(before[left], left)
        ids: list[int] = []
        for p in parts:
            if p is None:
                continue
            i = vocab.ids.get(p)
            if i is None:
                ids.extend(vocab.byte_ids[b] for b in p.encode())
            else:
                ids.append(i)
        return ids

    def lockstep(self, chunks: list[str], keys: np.ndarray) -> list[tuple[int, ...]]:
        """The agenda of many short chunks at once: each step takes one candidate of every chunk.

        The same merges as ``merged`` makes: a chunk's best candidate is the
        least rank, the leftmost on ties; a skipped one leaves the agenda; a
        merge makes new candidates with both neighbours.
        """
        v = self.vocab
        n = np.array([len(c) for c in chunks])
        width = int(n.max())
        points = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32)
        grid = np.full((len(chunks), width), -1, np.int64)
        inside = np.arange(width) < n[:, None]
        ids = np.where(points < len(v.char_ids), v.char_ids[np.minimum(points, len(v.char_ids) - 1)], -1)
        grid[inside] = np.where(ids >= 0, ids, -2 - points.astype(np.int64))
        size = inside.astype(np.int64)
        alive = inside.copy()
        after = np.tile(np.arange(1, width + 1), (len(chunks), 1))
        before = np.tile(np.arange(-1, width - 1), (len(chunks), 1))
        rank = np.full((len(chunks), width), NEVER, np.int64)
        if width > 1:
            rank[:, :-1] = v.rank_of(grid[:, :-1], grid[:, 1:])
        row = np.arange(len(chunks))
        while len(row):
            at = rank[row].argmin(axis=1)
            best = rank[row, at]
            row, at, best = row[best < NEVER], at[best < NEVER], best[best < NEVER]
            if not len(row):
                break
            rank[row, at] = NEVER
            piece = v.by_rank[best]
            if self.limit:
                x = (at.astype(np.uint64) << np.uint64(44)) | (
                    size[row, at].astype(np.uint64) << np.uint64(24)
                ) | piece.astype(np.uint64)
                x = keys[row] ^ (x * np.uint64(SPREAD))
                x = (x ^ (x >> np.uint64(32))) * np.uint64(MIX)
                go = (x ^ (x >> np.uint64(29))) >= np.uint64(self.limit)
                r, a, piece = row[go], at[go], piece[go]
            else:
                r, a = row, at
            right = after[r, a]
            grid[r, a] = piece
            size[r, a] += size[r, right]
            alive[r, right] = False
            rank[r, right] = NEVER
            far = after[r, right]
            after[r, a] = far
            more = far < n[r]
            rank[r[more], a[more]] = v.rank_of(grid[r[more], a[more]], grid[r[more], far[more]])
            before[r[more], far[more]] = a[more]
            left = before[r, a]
            more = left >= 0
            rank[r[more], left[more]] = v.rank_of(grid[r[more], left[more]], grid[r[more], a[more]])
        flat = grid[alive]
        ends = np.cumsum(alive.sum(axis=1)).tolist()
        odd = set(np.flatnonzero(((grid < -1) & alive).any(axis=1)).tolist())
        # one object per id, however often it is kept
        flat = [v.numbers[x] if x >= 0 else x for x in flat.tolist()]
        out, start = [], 0
        for i, end in enumerate(ends):
            got = tuple(flat[start:end])
            if i in odd:  # characters outside the vocabulary
                got = tuple(
                    y
                    for x in got
                    for y in ([x] if x >= 0 else [v.byte_ids[b] for b in chr(-2 - x).encode()])
                )
            out.append(got)
            start = end
        return out

    def chunks(self, text: str) -> list[str | None]:
        """A text's chunks; None for a space mark of the text's own."""
        out: list[str | None] = []
        shown = (" " if self.vocab.dummy_prefix else "") + text
        for nth, part in enumerate(shown.split(MARK)):
            if nth:
                out.append(None)
            out += CHUNKS.findall(part.replace(" ", MARK))
        return out

    def places(self, text: str, doc_id: int | None, n: int) -> np.ndarray:
        """A 64-bit number for each of the ``n`` chunks of a document."""
        document = xxhash.xxh3_64_intdigest(text, xxhash.xxh3_64_intdigest(f"{self.seed}|{doc_id}"))
        return np.uint64(document) + np.arange(n, dtype=np.uint64) * np.uint64(SPREAD)

    def blocks(self, text: str, doc_id: int | None) -> list[tuple[int, list[str]]]:
        """(place, [chunk]) of each chunk of a text."""
        chunks = self.chunks(text)
        return [
            (OWN_MARK, [MARK]) if c is None else (v, [c])
            for c, v in zip(chunks, self.places(text, doc_id, len(chunks)).tolist())
        ]

    def encode(self, text: str, doc_id: int | None = 0) -> list[int]:
        return self.encode_all([text], [doc_id])[0]

    def encode_all(self, texts: list[str | None], doc_ids: list) -> list[list[int]]:
        """Ids of each text; none for null and empty ones."""
        if len(self.nodes) > self.remember:
            self.forget()
        found = [self.chunks(t) if t else [] for t in texts]
        every = list(chain.from_iterable(found))
        if not every:
            return [[] for _ in texts]
        places = np.concatenate([self.places(t, d, len(c)) for t, d, c in zip(texts, doc_ids, found) if c])
        roots = self.roots
        for c, n in Counter(every).items():
            if n > 1 and c not in roots and len(c) <= LOCKSTEP:
                roots[c] = self.node(c, ())
        node = np.array([roots.get(c, -1) for c in every], np.int64)
        if self.limit:
            self.draw(node, mixed(places))
        ids = list(map(self.node_ids.__getitem__, node.tolist()))
        self.alone(every, places, np.flatnonzero(node < 0), ids)
        out, at = [], 0
        for chunks in found:
            out.append(list(chain.from_iterable(ids[at : at + len(chunks)])))
            at += len(chunks)
        return out

    def draw(self, node: np.ndarray, keys: np.ndarray) -> None:
        """Replace each occurrence's root by the node that its draws lead to, or -1 if that is a rare one."""
        row = np.flatnonzero(node >= 0)
        at, end = self.start[node[row]], self.end[node[row]]
        while True:
            more = at < end
            row, at, end = row[more], at[more], end[more]
            if not len(row):
                return
            x = keys[row] ^ self.codes[at]
            x = (x ^ (x >> np.uint64(32))) * np.uint64(MIX)
            skip = np.flatnonzero((x ^ (x >> np.uint64(29))) < np.uint64(self.limit))
            was = at[skip]
            unknown = self.child[was] < 0
            codes, first, n = np.unique(was[unknown], return_index=True, return_counts=True)
            for code, i in zip(codes[n > 1].tolist(), first[n > 1].tolist()):
                parent = int(node[row[skip[unknown][i]]])
                chunk, skips = self.nodes[parent]
                place = code - int(self.start[parent]) + (skips[-1] + 1 if skips else 0)
                made = self.node(chunk, (*skips, place))
                self.child[code] = made
            to = self.child[was]
            node[row[skip]] = to
            at = at + 1
            at[skip] = np.where(to < 0, 0, self.start[to])
            end[skip] = np.where(to < 0, 0, self.end[to])

    def alone(self, every: list, places: np.ndarray, rows: np.ndarray, ids: list) -> None:
        """Merge the chunks at ``rows`` by themselves: short ones together, by length, long ones one by one."""
        short: list[tuple[int, int]] = []
        for i in rows.tolist():
            if len(every[i]) <= LOCKSTEP:
                short.append((len(every[i]), i))
            else:
                ids[i] = self.merged(every[i], int(places[i]))
        short.sort()
        for k in range(0, len(short), 20_000):
            part = [i for _, i in short[k : k + 20_000]]
            for i, got in zip(part, self.lockstep([every[i] for i in part], mixed(places[part]))):
                ids[i] = got


def decode(vocab: Vocabulary, ids) -> str:
    """The text of ids; byte pieces are put together as UTF-8."""
    text = b"".join(map(vocab.shown.__getitem__, ids)).decode()
    return text[1:] if vocab.dummy_prefix and text else text


ENCODED = "doc_id long, ids array<int>"
CHECKED = "doc_id long, n_tokens long, ids_crc32 long, n_chars long, lossless boolean"


def shared_encoder(model: str, dropout: float, seed: int, remember: int = CACHE_CHUNKS) -> Encoder:
    """One per worker process: what it has merged serves the process's later tasks."""
    # Strings and tuples of numbers by the hundred thousand, without cycles:
    # searching them for garbage again and again takes a tenth of the time.
    gc.set_threshold(200_000, 50, 100)
    key = ("sentencepiece", model, dropout, seed, remember)
    return worker_state(key, lambda: Encoder(Vocabulary.load(model), dropout, seed, remember))


def encode(
    docs: DataFrame,
    model: str,
    dropout: float = 0.1,
    seed: int = 20,
    remember: int = CACHE_CHUNKS // 8,
) -> DataFrame:
    """(doc_id, ids) of each row of ``docs`` (doc_id, text); null text has null ids.

    ``remember`` bounds the orders of merges a worker keeps; it changes no result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(model, dropout, seed, remember)
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                rows = batch.slice(i, ROWS)
                texts = rows.column(1).to_pylist()
                found = encoder.encode_all(texts, rows.column(0).to_pylist())
                ids = [None if t is None else x for t, x in zip(texts, found)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"]
                )

    return keyed_text(docs).mapInArrow(run, ENCODED)


def decoded(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) of each row of (doc_id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared_encoder(model, 0.0, 0).vocab
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                rows = batch.slice(i, ROWS)
                texts = [None if x is None else decode(vocab, x) for x in rows.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"]
                )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, model: str, dropout: float = 0.1, seed: int = 20) -> DataFrame:
    """Encode each whole text, decode the ids again, compare.

    (doc_id, n_tokens, ids_crc32 of the ids as u32, n_chars of the decoded
    text, lossless). Null text: no ids, null crc and length, lossless.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(model, dropout, seed)
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                rows = batch.slice(i, ROWS)
                texts = rows.column(1).to_pylist()
                out: list[tuple] = []
                for text, ids in zip(texts, encoder.encode_all(texts, rows.column(0).to_pylist())):
                    if text is None:
                        out.append((0, None, None, True))
                        continue
                    back = decode(encoder.vocab, ids)
                    crc = zlib.crc32(np.array(ids, dtype="<u4").tobytes())
                    out.append((len(ids), crc, len(back), back == text))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0)]
                    + [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 3 + [pa.bool_()])],
                    names=["doc_id", "n_tokens", "ids_crc32", "n_chars", "lossless"],
                )

    return keyed_text(docs).mapInArrow(run, CHECKED)


def keyed_text(docs: DataFrame) -> DataFrame:
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
