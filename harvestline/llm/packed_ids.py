"""Token ids as fixed-width bit-packed files.

Format of a file (all integers little-endian):
  magic ``HLPK`` | version u16 | bits u16 | ids per block u32 | n_ids u64 |
  n_blocks u64 | block offsets u64 x (n_blocks + 1) | blocks | document index
Each id takes the fewest bits that hold the largest id of the vocabulary. A
block holds a fixed number of ids (the last one fewer), starts on a byte and is
found by its offset, so any id range is read by seeking to its blocks and
unpacked with numpy at once. The document index is doc_id i64, first id u64 per
document, in file order.

Documents are tokenised with a tokenizers file; texts are cut at white space
first (its normaliser and splitter never join across white space), so
that each distinct word is encoded once per task. Null text is empty text: a
document of the end id alone. Files follow ascending doc_id; a null doc_id
comes first; rows with equal doc_id keep a row each, in the order of their texts'
hash, so that starts are the same in every run. Very long
texts are one document of many blocks. An empty table gives no file.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, repeat
from unicodedata import normalize

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harvestline.llm.common import open_fs, scratch, worker_state, write_once

MAGIC = b"HLPK"
HEAD = struct.Struct("<4sHHIQQ")
BLOCK_IDS = 8192
END_ID = 2
SEPARATORS = "\x1c\x1d\x1e\x1f"
SPACES = re.compile(r"[ \t\n\r\v\f]+")
NO_ID = -(1 << 63)  # in the document index, for a null doc_id
PART_BYTES = 128 << 20  # text in a range partition, about
CACHE_WORDS = 1_500_000  # words that a worker remembers; beyond, it starts anew

MANIFEST = "part int, file string, at int, doc_id long, first long, n_tokens long"


def bits_for(vocab_size: int) -> int:
    """Fewest bits for ids 0 .. vocab_size - 1."""
    return max(1, int(vocab_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in ``bits`` bits each, lowest bit first, filled up to a byte."""
    if bits == 16:
        return ids.astype("<u2").tobytes()
    planes = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(block: bytes, n: int, bits: int) -> np.ndarray:
    """The first ``n`` ids of a block, vectorised."""
    if bits == 16:
        return np.frombuffer(block, "<u2", n).astype(np.uint32)
    flat = np.unpackbits(np.frombuffer(block, np.uint8), count=n * bits, bitorder="little")
    weights = np.uint32(1) << np.arange(bits, dtype=np.uint32)
    return (flat.reshape(n, bits) * weights).sum(axis=1, dtype=np.uint32)


def file_parts(doc_ids: list, arrays: list[np.ndarray], bits: int, block_ids: int = BLOCK_IDS):
    """The bytes of one file, piece by piece."""
    lengths = np.array([len(a) for a in arrays], dtype=np.int64)
    ids = np.concatenate(arrays) if arrays else np.zeros(0, np.uint32)
    n_blocks = -(-len(ids) // block_ids)
    sizes = [
        (min(block_ids, len(ids) - b * block_ids) * bits + 7) // 8 for b in range(n_blocks)
    ]
    start = HEAD.size + 8 * (n_blocks + 1)
    offsets = start + np.concatenate([[0], np.cumsum(sizes, dtype=np.uint64)]).astype("<u8")
    yield HEAD.pack(MAGIC, 1, bits, block_ids, len(ids), n_blocks)
    yield offsets.astype("<u8").tobytes()
    for b in range(n_blocks):
        yield pack(ids[b * block_ids : (b + 1) * block_ids], bits)
    firsts = np.concatenate([[0], np.cumsum(lengths)])[: len(lengths)]
    for d, f in zip(doc_ids, firsts):
        yield struct.pack("<qQ", NO_ID if d is None else d, f)


class PackedFile:
    """Random access to the ids of a file."""

    def __init__(self, source):
        self.source = source
        magic, _, self.bits, self.block_ids, self.n_ids, n_blocks = HEAD.unpack(source.read(HEAD.size))
        if magic != MAGIC:
            raise ValueError("not a packed id file")
        self.offsets = np.frombuffer(source.read(8 * (n_blocks + 1)), "<u8")

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start .. stop - 1; reads the blocks that hold them, no others."""
        stop = min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint32)
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        at = int(self.offsets[first])
        self.source.seek(at)
        raw = self.source.read(int(self.offsets[last + 1]) - at)
        out = [
            unpack(
                raw[int(self.offsets[b]) - at : int(self.offsets[b + 1]) - at],
                min(self.block_ids, self.n_ids - b * self.block_ids),
                self.bits,
            )
            for b in range(first, last + 1)
        ]
        return np.concatenate(out)[start - first * self.block_ids : stop - first * self.block_ids]


class WordEncoder:
    """Whole texts to ids, with each distinct white-space-free word encoded once.

    New words are encoded many at a time, with spaces between them, and cut
    apart after the tokens that end a word. Only words of letters alone are
    joined this way, as they are one piece for the splitter; others are encoded
    one by one.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        vocabulary = self.tok.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}  # word -> its place in starts and lengths
        self.starts = np.zeros(1024, np.int64)
        self.lengths = np.zeros(1024, np.int64)
        self.flat = np.zeros(4096, np.uint32)
        self.used = 0

    def keep(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        n = len(self.known)
        self.known.update(zip(words, range(n, n + len(words))))
        self.starts = _room(self.starts, n + len(words))
        self.lengths = _room(self.lengths, n + len(words))
        self.flat = _room(self.flat, self.used + len(ids))
        self.starts[n : n + len(words)] = np.cumsum(lengths) - lengths + self.used
        self.lengths[n : n + len(words)] = lengths
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)

    def learn(self, words: list[str]) -> None:
        plain, other = [], []
        for w in words:
            # letters that stay letters when the normaliser has changed them
            if w.isalpha() and (w.isascii() or normalize("NFC", w).lower().isalpha()):
                plain.append(w)
            else:
                other.append(w)
        for i in range(0, len(plain), 2000):
            part = plain[i : i + 2000]
            (joined,) = self.tok.encode_batch_fast([" ".join(part)], add_special_tokens=False)
            ids = np.array(joined.ids, np.uint32)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(part):
                self.keep(part, ids, np.diff(stops, prepend=0))
            else:
                other += part
        if other:
            found = self.tok.encode_batch_fast(other, add_special_tokens=False)
            ids = [e.ids for e in found]
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            self.keep(other, np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum())), lengths)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.known) > CACHE_WORDS:
            self.forget()
        split = [words_of(t or "") for t in texts]
        words = list(chain.from_iterable(split))
        at = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        if len(missing := np.flatnonzero(at < 0)):
            unseen = [words[i] for i in missing.tolist()]
            self.learn(list(dict.fromkeys(unseen)))
            at[missing] = np.fromiter(map(self.known.__getitem__, unseen), np.int64, len(unseen))
        # all texts' ids in one gather, then cut by text
        n = self.lengths[at]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.arange(total) + np.repeat(self.starts[at] - ends + n, n)]
        cuts = np.concatenate([[0], ends])[np.cumsum([0, *map(len, split)])].tolist()
        return [np.append(ids[a:b], np.uint32(END_ID)) for a, b in zip(cuts, cuts[1:])]


def words_of(text: str) -> list[str]:
    """The parts of a text between white space as the tokenizer sees it."""
    # Python also splits at four separators that the tokenizer takes as characters.
    return text.split() if not any(c in text for c in SEPARATORS) else SPACES.split(text.strip(" \t\n\r\v\f"))


def _room(x: np.ndarray, n: int) -> np.ndarray:
    """``x``, or a copy at least twice as long, with room for ``n`` values."""
    return x if n <= len(x) else np.concatenate([x, np.zeros(max(n, 2 * len(x)) - len(x), x.dtype)])


def word_encoder(path: str) -> WordEncoder:
    """One per worker process: what it has learnt serves the process's later tasks."""
    return worker_state(("packed_ids", path), lambda: WordEncoder(path))


def write_files(
    docs: DataFrame, tokenizer: str, folder: str, vocab_size: int, file_ids: int = 1 << 22
) -> DataFrame:
    """Write files of about ``file_ids`` ids from rows sorted by doc_id; returns manifest rows."""
    bits = bits_for(vocab_size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        fs, base = open_fs(folder)
        fs.create_dir(base, recursive=True)
        encoder = word_encoder(tokenizer)
        held: tuple[list, list] = ([], [])
        at = 0

        def flush():
            nonlocal held, at
            ids, arrays = held
            # an attempt's own name: the manifest of the committed attempt names it
            path = f"{base}/part-{part:06d}-{at:06d}-{uuid.uuid4().hex[:12]}.ids"
            write_once(fs, path, file_parts(ids, arrays, bits))
            n = np.array([len(a) for a in arrays], dtype=np.int64)
            first = np.cumsum(n) - n
            rows = pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(n), part), pa.int32()),
                    pa.array([path] * len(n), pa.string()),
                    pa.array(np.full(len(n), at), pa.int32()),
                    pa.array(ids, pa.int64()),
                    pa.array(first),
                    pa.array(n),
                ],
                names=["part", "file", "at", "doc_id", "first", "n_tokens"],
            )
            held, at = ([], []), at + 1
            return rows

        size = 0
        for batch in batches:
            texts = batch.column(1)
            for i in range(0, batch.num_rows, 256):
                chunk = texts.slice(i, 256).to_pylist()
                held[0].extend(batch.column(0).slice(i, 256).to_pylist())
                arrays = encoder.encode(chunk)
                held[1].extend(arrays)
                size += sum(map(len, arrays))
                if size >= file_ids:
                    yield flush()
                    size = 0
        if held[0]:
            yield flush()

    return docs.select("doc_id", "text").mapInArrow(run, MANIFEST)


def read_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: its number of ids and the crc32 of their u32 bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_fs(folder)
        path, source, packed = None, None, None
        try:
            for batch in batches:
                files, at, first, n = (batch.column(c).to_pylist() for c in (1, 2, 4, 5))
                crc, counts = [], []
                for f, a, k in zip(files, first, n):
                    if f != path:
                        if source:
                            source.close()
                        path, source = f, fs.open_input_file(f)
                        packed = PackedFile(source)
                    ids = packed.ids(a, a + k)
                    counts.append(len(ids))
                    crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(at, pa.int32()),
                        batch.column(3),
                        batch.column(4),
                        pa.array(counts, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["part", "at", "doc_id", "first", "n_tokens", "ids_crc32"],
                )
        finally:
            if source:
                source.close()

    return manifest.mapInArrow(
        run, "part int, at int, doc_id long, first long, n_tokens long, ids_crc32 long"
    )


def tokenised(
    spark: SparkSession, docs: DataFrame, tokenizer: str, vocab_size: int, folder: str | None = None
) -> DataFrame:
    """Write all documents' ids in ascending doc_id order and read them back.

    Returns (doc_id, start, n_tokens, ids_crc32); ``start`` counts the ids of
    all documents before it.
    """
    folder = folder or scratch(spark, "ids")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    # Range partitions in doc_id order, each sorted: files follow the order. The text's
    # hash settles ties, and splits rows of one doc_id or none.
    rows = rows.withColumn("tie", F.xxhash64("text"))
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // PART_BYTES))
    ordered = rows.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    write_files(ordered, tokenizer, f"{folder}/files", vocab_size).write.parquet(f"{folder}/manifest")
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    found = read_files(manifest, f"{folder}/files")
    return found.join(file_starts(spark, manifest), ["part", "at"]).select(
        "doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )


def file_starts(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """(part, at, base): ids before each file, a row per file.

    Sums run within a range partition by a window; the totals of the range
    partitions, a row per ``PART_BYTES`` of text or ``spark.sql.shuffle.partitions``
    rows if that is more, are summed up on the driver.
    """
    sizes = manifest.groupBy("part", "at").agg(F.sum("n_tokens").alias("n"))
    parts = sorted(tuple(r) for r in sizes.groupBy("part").agg(F.sum("n")).collect())
    before, rows = 0, []
    for part, n in parts:
        rows.append((part, before))
        before += n
    starts = spark.createDataFrame(rows, "part int, part_base long")
    order = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    within = sizes.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0)))
    return within.join(F.broadcast(starts), "part").select(
        "part", "at", (F.col("part_base") + F.col("before")).alias("base")
    )
