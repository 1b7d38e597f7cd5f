"""Token ids written as directly addressable codes.

An id is split into chunks of ``CHUNK_BITS`` bits, lowest first. Level 0 holds the first
chunk of every id, level 1 the second chunk of those ids that need one, and so on. Beside
each level but the last, a *continuation bitmap* has a 1 where the id goes on, and a *rank
directory* counts the ones before every 512th bit: the place of an id's next chunk is the
rank of its bit, so any token is read by one step a level, without decoding a block.

File format: a Parquet table in the shared folder with a row per segment of whole
documents (about ``SEGMENT_IDS`` ids, more only if one document has more), in ascending
id order: part, segment, offset (ids of the part before it), total, doc_ids, lengths, and
``codes``. All numbers in ``codes`` are little-endian:

    4 bytes ``DAC1``; u8 chunk bits; u8 levels; u16 0; u32 count
    for each level: u32 entries; the chunks (8 bits each); and, but for the last level,
    the bitmap (lowest bit first) and a u32 for each 512 bits begun

Scale: texts are range-partitioned by id (ties by text hash) and encoded in the task that
writes them; only a count per part (one row each) is summed to place the parts.

Encoding uses the tokenizers library. With the tokenizer meant here no token crosses ASCII
white space, so the ids of a text are those of its white-space-separated words in order;
words are looked up in a bounded memory of past encodings and the library encodes the
others. ``whole_texts=True`` hands it each text whole instead, for tokenizers that differ.

Null texts are empty: they hold just the end id. Null ids come first, repeated rows stay,
an empty table gives empty files, and other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, kept_in_worker, stage

CHUNK_BITS = 8
RANK_BITS = 512
SEGMENT_IDS = 1 << 16
REMEMBERED_BYTES = 48 << 20  # of words, and of cores, in each of the two generations that an encoder remembers
_ENTRY_BYTES = 180  # of a remembered word beside its letters and ids
_MAGIC = b"DAC1"
_PUNCTUATION = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


# --- the code ------------------------------------------------------------------------------

def encode(ids: np.ndarray) -> bytes:
    """The code of an array of ids below 2**32."""
    left = ids.astype(np.uint32)
    levels: list[bytes] = []
    while True:
        low, rest = (left & 0xFF).astype(np.uint8), left >> CHUNK_BITS
        more = rest > 0
        head = struct.pack("<I", len(left)) + low.tobytes()
        if not more.any():
            levels.append(head)
            break
        bitmap = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(np.bitwise_count(bitmap), np.arange(0, len(bitmap), RANK_BITS // 8), dtype=np.uint32)
        before = np.concatenate(([0], np.cumsum(ones)[:-1])).astype("<u4")
        levels.append(head + bitmap.tobytes() + before.tobytes())
        left = rest[more]
    return _MAGIC + struct.pack("<BBHI", CHUNK_BITS, len(levels), 0, len(ids)) + b"".join(levels)


def _levels(codes: bytes) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(chunks, bitmap bytes, rank directory) of each level; the last has no bitmap."""
    bits, n_levels, _, _ = struct.unpack_from("<BBHI", codes, 4)
    if codes[:4] != _MAGIC or bits != CHUNK_BITS:
        raise ValueError("not a code of this format")
    at, out = 12, []
    for k in range(n_levels):
        n = struct.unpack_from("<I", codes, at)[0]
        at += 4
        chunks = np.frombuffer(codes, np.uint8, n, at)
        at += n
        bitmap, ranks = np.empty(0, np.uint8), np.empty(0, "<u4")
        if k < n_levels - 1:
            bitmap = np.frombuffer(codes, np.uint8, -(-n // 8), at)
            at += len(bitmap)
            ranks = np.frombuffer(codes, "<u4", -(-n // RANK_BITS), at)
            at += 4 * len(ranks)
        out.append((chunks, bitmap, ranks))
    return out


def decode(codes: bytes) -> np.ndarray:
    """All ids, in order."""
    out: np.ndarray | None = None
    for chunks, bitmap, _ in reversed(_levels(codes)):
        ids = chunks.astype(np.uint32)
        if out is not None:
            ids[np.flatnonzero(np.unpackbits(bitmap, count=len(chunks), bitorder="little"))] += out << CHUNK_BITS
        out = ids
    return out


def access(codes: bytes, positions: np.ndarray) -> np.ndarray:
    """The ids at ``positions``, each by one rank a level."""
    at = np.asarray(positions, dtype=np.int64)
    out, who, shift = np.zeros(len(at), np.uint32), np.arange(len(at)), 0
    for chunks, bitmap, ranks in _levels(codes):
        out[who] |= chunks[at].astype(np.uint32) << shift
        if not len(bitmap):
            break
        goes_on = (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        who, at = who[goes_on], at[goes_on]
        block = at // RANK_BITS
        first = block * (RANK_BITS // 8)
        byte = first[:, None] + np.arange(RANK_BITS // 8)
        inside = bitmap[np.minimum(byte, len(bitmap) - 1)]
        bits_kept = np.clip(at[:, None] - 8 * byte, 0, 8).astype(np.uint16)
        masked = inside & ((np.uint16(1) << bits_kept) - 1).astype(np.uint8)
        at = ranks[block].astype(np.int64) + np.bitwise_count(masked).sum(axis=1, dtype=np.int64)
        shift += CHUNK_BITS
    return out


# --- ids of texts --------------------------------------------------------------------------

def _byte_letters() -> dict[int, str]:
    """The letters that byte-level tokenizers write bytes as: printable ones stand for
    themselves, the others for the code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordEncoder:
    """Ids of texts through their words, for a lower-casing byte-level tokenizer whose tokens cross
    neither ASCII white space nor the border between letters and ASCII punctuation (other
    than an apostrophe). Remembers words and their cores in two generations each: when the
    young one holds ``remembered`` bytes it becomes the old one, so frequent words stay and
    memory is bounded, however long the words are.
    A core of letters goes straight to the library's model, all else through its whole pipeline."""

    def __init__(self, tokenizer_path: str, remembered: int = REMEMBERED_BYTES):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.normalize, self.model = self.tokenizer.normalizer.normalize_str, self.tokenizer.model.tokenize
        self.remembered = remembered
        self.words: dict[bytes, bytes] = {}
        self.old_words: dict[bytes, bytes] = {}
        self.cores: dict[bytes, bytes] = {}
        self.old_cores: dict[bytes, bytes] = {}
        self.word_bytes = self.core_bytes = 0

    def whole(self, text: bytes | None) -> np.ndarray:
        plain = (text or b"").decode("utf-8", "replace")
        return np.array(self.tokenizer.encode(plain, add_special_tokens=False).ids, np.uint32)

    def __call__(self, text: bytes | None) -> np.ndarray:
        text = text or b""
        if b"<|" in text:  # perhaps a special token's name, which only counts as written
            return self.whole(text)
        words = text.lower().split()
        found = list(map(self.words.get, words))
        if None in found:
            found = [self._word(w) if ids is None else ids for w, ids in zip(words, found, strict=True)]
            if self.word_bytes > self.remembered:
                self.old_words, self.words, self.word_bytes = self.words, {}, 0
            if self.core_bytes > self.remembered:
                self.old_cores, self.cores, self.core_bytes = self.cores, {}, 0
        return np.frombuffer(b"".join(found), np.uint32)

    def _word(self, word: bytes) -> bytes:
        ids = self.words.get(word) or self.old_words.get(word)
        if ids is None:
            rest = word.lstrip(_PUNCTUATION)
            core = rest.rstrip(_PUNCTUATION)
            if core and len(core) < len(word) and self._plain(core).isalpha():
                parts = word[:len(word) - len(rest)], core, rest[len(core):]
                ids = b"".join(self._core(part) for part in parts if part)
            else:
                ids = self._core(word)
        self.words[word] = ids
        self.word_bytes += len(word) + len(ids) + _ENTRY_BYTES
        return ids

    def _plain(self, core: bytes) -> str:
        text = core.decode("utf-8", "replace")
        return text if core.isalpha() else self.normalize(text)  # ASCII letters are as they should be

    def _core(self, core: bytes) -> bytes:
        ids = self.cores.get(core) or self.old_cores.get(core)
        if ids is None:
            plain = self._plain(core)
            if plain.isalpha():
                spelt = plain.encode().decode("latin-1").translate(_SPELT)
                ids = np.array([t.id for t in self.model(spelt)], np.uint32).tobytes()
            else:
                ids = self.whole(core).tobytes()
        self.cores[core] = ids
        self.core_bytes += len(core) + len(ids) + _ENTRY_BYTES
        return ids


_SPELT = _byte_letters()


def encoder(tokenizer_path: str) -> WordEncoder:
    """This Python worker's encoder, until another operator uses the worker."""
    return kept_in_worker(("encoder", tokenizer_path), lambda: WordEncoder(tokenizer_path))


# --- files ---------------------------------------------------------------------------------

def write_codes(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1,
                segment_ids: int = SEGMENT_IDS, whole_texts: bool = False) -> DataFrame:
    """Encode, append ``end_id`` to each document, write the files and return the table that
    reads them. ``id_col`` must be an integer."""
    bounded_batches(df.sparkSession)
    source = (df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
              .withColumn("tie", F.xxhash64("text")))
    ordered = source.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    names = ["part", "segment", "offset", "total", "doc_ids", "lengths", "codes"]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, segment, offset = TaskContext.get().partitionId(), 0, 0
        ids: list[int | None] = []
        kept: list[np.ndarray] = []
        held = 0
        end = np.array([end_id], np.uint32)
        enc = encoder(tokenizer_path)

        def row() -> pa.RecordBatch:
            lengths = [len(x) for x in kept]
            values = [[part], [segment], [offset], [held], [ids], [lengths], [encode(np.concatenate(kept))]]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = enc.whole(text.as_py()) if whole_texts else enc(text.as_py())
                ids.append(i)
                kept.append(np.concatenate((own, end)))
                held += len(own) + 1
                if held >= segment_ids:
                    yield row()
                    segment, offset, ids, kept, held = segment + 1, offset + held, [], [], 0
        if ids:
            yield row()

    schema = ("part int, segment int, offset long, total long, doc_ids array<long>, lengths array<long>, codes binary")
    return stage(ordered.mapInArrow(run, schema), "token-codes")


def with_start(files: DataFrame) -> DataFrame:
    """``files`` with ``start``: all ids before the segment. Only one row per part is ordered."""
    parts = files.groupBy("part").agg(F.sum("total").alias("ids"))
    before = parts.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("before"))
    return (files.join(F.broadcast(before), "part")  # a row per part: bounded by the number of tasks
            .withColumn("start", F.col("before") + F.col("offset")).drop("before"))


def read_digests(files: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document, from the files: id, start, n_tokens, ids_crc32 (of its ids as little-endian
    unsigned 32-bit integers)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = decode(r["codes"]).astype("<u4")
                ends = np.cumsum(np.array(r["lengths"], dtype=np.int64))
                begins = ends - r["lengths"]
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array(begins + r["start"], pa.int64()),
                     pa.array(r["lengths"], pa.int64()), pa.array(sums, pa.int64())],
                    ["id", "start", "n_tokens", "ids_crc32"])

    out = with_start(files).select("start", "doc_ids", "lengths", "codes").mapInArrow(
        run, "id long, start long, n_tokens long, ids_crc32 long")
    return out.withColumnRenamed("id", id_col)


def tokens_at(files: DataFrame, positions: DataFrame, block: int = SEGMENT_IDS) -> DataFrame:
    """(position, token_id) for every row of ``positions`` (position: counted over all files,
    from 0) that exists, read in place. Segments and positions meet on blocks of positions."""
    placed = with_start(files).withColumn("last", F.col("start") + F.col("total") - 1)
    spread = placed.withColumn("block", F.explode(F.sequence(
        F.floor(F.col("start") / block), F.floor(F.col("last") / block))))
    asked = positions.select(F.col("position").cast("long")).withColumn("block", F.floor(F.col("position") / block))
    wanted = (asked.join(spread.select("block", "part", "segment", "start", "last"), "block")
              .filter("position between start and last")
              .groupBy("part", "segment", "start", F.floor(F.rand(7) * 16).alias("share"))
              .agg(F.collect_list("position").alias("positions")))
    found = wanted.join(files.select("part", "segment", "codes"), ["part", "segment"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                at = np.array(r["positions"], dtype=np.int64)
                ids = access(r["codes"], at - r["start"])
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(ids.astype(np.int64))], ["position", "token_id"])

    schema = T.StructType([T.StructField("position", T.LongType()), T.StructField("token_id", T.LongType())])
    return found.select("start", "positions", "codes").mapInArrow(run, schema)
