"""Token-id output as directly addressable codes.

An id is cut into 8-bit chunks. Level 0 holds the lowest chunk of every id, level k the next chunk of
those ids that go on; a bitmap beside each level says which do, and a rank directory holds the number
of set bits before every 512th. Any token is found from its position by ranks, level by level, and no
other token is decoded.

File format: segments in ascending document order, as rows of a Parquet table (shard, segment, doc_ids,
lengths, n_tokens, codes). `codes` is, little-endian: "DAC1", n_levels u32, then for each level n_ids u64,
n_ids chunk bytes, the bitmap of ceil(n_ids / 8) bytes (lowest bit first) and one u64 rank per 512 bits.
"""

from __future__ import annotations

import json
import os
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import end_stops, split_many
from .common import kept, lean, ragged, slices, text_parts

BITS_PER_RANK, PORTION = 512, 1 << 24
#: Bytes of words that a worker's table holds at most, besides one portion's.
WORD_BYTES = 1 << 25


def pack(ids: np.ndarray) -> bytes:
    """Codes of unsigned 32-bit ids."""
    rest, levels = np.ascontiguousarray(ids, np.uint32), []
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        counts = np.add.reduceat(more, np.arange(0, len(more), BITS_PER_RANK), dtype=np.uint64) if len(more) else np.zeros(0, np.uint64)
        ranks = (np.cumsum(counts) - counts).astype("<u8")
        levels.append(struct.pack("<Q", len(rest)) + (rest & 0xFF).astype(np.uint8).tobytes() + bits.tobytes() + ranks.tobytes())
        if not more.any():
            break
        rest = rest[more] >> 8
    return b"DAC1" + struct.pack("<I", len(levels)) + b"".join(levels)


class Reader:
    """Random access to packed ids."""

    def __init__(self, codes: bytes):
        if codes[:4] != b"DAC1":
            raise ValueError("not directly addressable codes")
        at, self.levels = 8, []
        for _ in range(struct.unpack_from("<I", codes, 4)[0]):
            (n,) = struct.unpack_from("<Q", codes, at)
            chunks = np.frombuffer(codes, np.uint8, n, at + 8)
            bits = np.frombuffer(codes, np.uint8, -(-n // 8), at + 8 + n)
            ranks = np.frombuffer(codes, "<u8", -(-n // BITS_PER_RANK), at + 8 + n + len(bits))
            self.levels.append((chunks, bits, ranks))
            at += 8 + n + len(bits) + 8 * len(ranks)
        self.n = len(self.levels[0][0])

    def get(self, i: int) -> int:
        """The i-th id."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value, shift = 0, 0
        for chunks, bits, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            i, shift = self._rank(bits, ranks, i), shift + 8
        return value

    @staticmethod
    def _rank(bits: np.ndarray, ranks: np.ndarray, i: int) -> int:
        """Set bits before bit i."""
        block = i // BITS_PER_RANK
        if block == len(ranks):  # just behind the last bit
            block -= 1
        if block < 0:
            return 0
        first = block * BITS_PER_RANK // 8
        part = bits[first : i >> 3]
        n = int(ranks[block]) + int(np.bitwise_count(part).sum())
        return n + int(bits[i >> 3] & ((1 << (i & 7)) - 1)).bit_count() if i & 7 else n

    def range(self, start: int, n: int) -> np.ndarray:
        """Ids start .. start + n - 1, reached through the rank directories."""
        out, where, shift = np.zeros(n, np.uint32), None, 0
        for chunks, bits, ranks in self.levels:
            part = chunks[start : start + n].astype(np.uint32) << shift
            if where is None:
                out[:] = part
            else:
                out[where] |= part
            first = start >> 3
            more = np.unpackbits(bits[first : -(-(start + n) // 8)], bitorder="little")[start - 8 * first :][:n].astype(bool)
            if not more.any():
                break
            where = np.flatnonzero(more) if where is None else where[more]
            start, n, shift = self._rank(bits, ranks, start), len(where), shift + 8
        return out


class _Ids(dict):
    """A number for each word, in order of appearance, and the ids that the tokenizer gives it.

    Words of letters only are encoded together, some hundred to a text: each is one piece, so its ids end with the one
    token that ends a word. Stops and commas at the end of a word are looked up apart.
    """

    def __init__(self, path: str, most: int):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.new = Tokenizer.from_file(path), most, []
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        if suffix:
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.size_of_words = 0
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.first, self.size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        self.size_of_words += len(word)
        self[word] = n = len(self)
        return n

    def _put(self, numbers: list[int], ids: np.ndarray, sizes: np.ndarray) -> None:
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        self.flat[self.used : self.used + len(ids)] = ids
        self.first[numbers] = self.used + np.cumsum(sizes) - sizes
        self.size[numbers] = sizes
        self.used += len(ids)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, group: int = 256) -> None:
        lettered, others, stopped = [], [], []
        for word in self.new:  # grows by words without their stops
            if stops := end_stops(word):
                stopped.append((self[word], self[word[: -len(stops)]], self[stops]))
            else:
                text = word.decode("utf-8", "replace")
                (lettered if text.isalpha() else others).append((self[word], text))
        self.new = []
        while len(self) > len(self.first):
            self.first, self.size = (np.concatenate((x, np.zeros_like(x))) for x in (self.first, self.size))
        groups = [lettered[i : i + group] for i in range(0, len(lettered), group)]
        for own, found in zip(groups, self._encode([" ".join(t for _, t in own) for own in groups])):
            ids = np.array(found, np.uint32)
            last = np.flatnonzero(self.ends[ids])
            if len(last) == len(own) and last[-1] == len(ids) - 1:
                self._put([n for n, _ in own], ids, np.diff(np.concatenate(([-1], last))))
            else:
                others += own
        found = self._encode([t for _, t in others])
        self._put([n for n, _ in others], np.array([i for x in found for i in x], np.uint32), np.array([len(x) for x in found], np.int64))
        if stopped:
            whole, base, stops = map(np.array, zip(*stopped))
            parts = np.stack((base, stops), 1).ravel()
            self._put(whole, self.flat[ragged(self.first[parts], self.size[parts])], self.size[base] + self.size[stops])

    def ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words (Arrow strings) together, and the offsets of the words' ids. Only a portion's distinct words are looked up one by one."""
        if len(self) >= self.most or self.size_of_words >= WORD_BYTES:
            self.reset()
        coded = words.dictionary_encode()
        distinct = coded.dictionary.cast(pa.binary()).to_pylist()
        numbers = np.fromiter(map(self.__getitem__, distinct), np.int64, len(distinct))
        if self.new:
            self._learn()
        sizes = self.size[numbers]
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        found = pa.ListArray.from_arrays(pa.array(offsets), pa.array(self.flat[ragged(self.first[numbers], sizes)])).take(coded.indices)
        return found.flatten().to_numpy(), found.offsets.to_numpy()


def write_segments(df: DataFrame, vocabulary: str, text_col: str = "text", id_col: str = "doc_id", end_id: int = 1, segment_tokens: int = 1 << 20, most: int = 1_500_000) -> DataFrame:
    """Tokenised documents in ascending id order as rows of the file format above; write them as Parquet.

    Each document's ids end with end_id. Null ids come first, rows of equal ids follow in the order of
    their texts, and a null text counts as empty. A segment ends with the document that fills it, so a
    document's ids are never divided. Texts are dealt by ranges of ids and tokenised where they arrive.
    """
    schema = "shard int, segment int, doc_ids array<bigint>, lengths array<bigint>, n_tokens bigint, codes binary"
    name = f"dac {vocabulary} {most}"

    def run(batches):
        table = kept(name, lambda: _Ids(vocabulary, most))
        shard, segment, docs, sizes, parts, total = TaskContext.get().partitionId(), 0, [], [], [], 0

        def row():
            ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([segment], pa.int32()), pa.array([docs], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())), pa.array([total], pa.int64()), pa.array([pack(ids)], pa.binary())], names=["shard", "segment", "doc_ids", "lengths", "n_tokens", "codes"])

        for batch in batches:
            texts, names = batch.column(1).fill_null(""), batch.column(0).to_pylist()
            for i, j in slices(text_parts(texts)[1], PORTION):
                split = split_many(texts.slice(i, j - i))
                ids, offsets = table.ids(split.flatten())
                ends = offsets[split.offsets.to_numpy()[1:] - split.offsets[0].as_py()]
                for k, (a, b) in enumerate(zip(np.concatenate(([0], ends[:-1])).tolist(), ends.tolist())):
                    docs.append(names[i + k])
                    sizes.append(b - a + 1)
                    parts += [ids[a:b], np.array([end_id], np.uint32)]
                    total += b - a + 1
                    if total >= segment_tokens:
                        yield row()
                        segment, docs, sizes, parts, total = segment + 1, [], [], [], 0
        if docs:
            yield row()

    dealt = df.select(F.col(id_col).cast("long"), F.col(text_col)).repartitionByRange(F.col(id_col).asc_nulls_first())
    return dealt.sortWithinPartitions(F.col(id_col).asc_nulls_first(), F.col(text_col).asc_nulls_first()).mapInArrow(lean(run, name), schema)


def read_segments(segments: DataFrame, id_col: str = "doc_id", keep: bool = False) -> DataFrame:
    """Documents of written segments: id, start (ids of all documents before it), n_tokens, ids_crc32; with keep also ids.

    Each document is reached through its position; a segment's first position is the sum of the shards before its own, one small
    row a writing task, and of the segments before it in its shard. A null id stays null; no segments give no rows.
    """
    schema = f"shard int, segment int, {id_col} bigint, within bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * keep

    def run(batches):
        for batch in batches:
            for shard, segment, docs, sizes, codes in zip(*(c.to_pylist() for c in batch.columns)):
                reader, ends = Reader(codes), np.cumsum(sizes)
                starts = ends - sizes
                found = [reader.range(a, n) for a, n in zip(starts.tolist(), sizes)]
                n = len(docs)
                columns = [pa.array([shard] * n, pa.int32()), pa.array([segment] * n, pa.int32()), pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array([zlib.crc32(x.astype("<u4")) for x in found], pa.int64())]
                names = ["shard", "segment", id_col, "within", "n_tokens", "ids_crc32"]
                if keep:
                    columns, names = [*columns, pa.array([x.tolist() for x in found], pa.list_(pa.int64()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    before = lambda w: F.coalesce(F.sum("n_tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = segments.groupBy("shard").agg(F.sum("n_tokens").alias("n_tokens")).select("shard", before(Window.orderBy("shard")).alias("ahead"))
    within = segments.select("shard", "segment", before(Window.partitionBy("shard").orderBy("segment")).alias("behind"))
    first = within.join(shards, "shard").select("shard", "segment", (F.col("ahead") + F.col("behind")).alias("first"))
    docs = segments.select("shard", "segment", "doc_ids", "lengths", "codes").mapInArrow(lean(run), schema)
    return docs.join(first, ["shard", "segment"]).select(id_col, (F.col("first") + F.col("within")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if keep else []))
