"""BPE encoding and decoding.

A word's symbols form a doubly linked list and its adjacent pairs stand in a priority queue by
merge rank. Entries whose symbols have changed since are stale and skipped. Text decodes by joining
the vocabulary strings of its ids.
"""

from __future__ import annotations

import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType
from tokenizers import Regex, normalizers, pre_tokenizers

from .common import kept, lean, slices, text_parts

PORTION, LONG, TABLE = 1 << 21, 256, 192 << 20
#: Bytes of a table's entry beside its strings: three strings, a tuple and a place in the table.
OVERHEAD = 270
#: Code points that are looked up at once.
STEP = 1 << 12


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if visible Latin-1, else the next code point from 256 on."""
    seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(seen) else chr(next(rest)) for b in range(256)]


def newer(kind: str) -> str:
    """The code points of a Unicode class (as \\p{L}) by the tables of `regex` that are not in it by the library's, which are older; as a regex set, or nothing.

    Asked for STEP code points at a time: the library takes hundreds of MB to split all of them at once.
    """
    split, found = pre_tokenizers.Split(Regex(kind + "+"), "removed", invert=True), []
    for first in range(0, 0x110000, STEP):
        points = "".join(chr(c) for c in range(first, first + STEP) if not 0xD800 <= c < 0xE000)
        known = {c for run, _ in split.pre_tokenize_str(points) for c in run}
        found += [c for c in regex.findall(kind, points) if c not in known]
    starts = [c for c, before in zip(found, [None, *found]) if before is None or ord(c) != ord(before) + 1]
    ends = [c for c, after in zip(found, [*found[1:], None]) if after is None or ord(after) != ord(c) + 1]
    return "[" + "".join(f"{a}-{b}" for a, b in zip(starts, ends)) + "]" if found else ""


class WordBpe:
    """A BPE vocabulary with word ends from a tokenizers JSON file (lower case, NFC, white space dropped)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        self.end: str = spec["model"]["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.special.items()}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.ascii_pieces = regex.compile(pattern)
        for kind in (r"\p{L}", r"\p{N}"):
            if later := newer(kind):
                pattern = pattern.replace(kind, f"[{kind}--{later}]")
        self.pieces = regex.compile(pattern, regex.V1)
        #: Unicode tables only, of the library's own age; what they do is named in the file.
        self.fold = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]).normalize_str
        ids, self.known = dict(self.vocab), max(self.vocab.values()) + 1

        def number(symbol: str) -> int:
            return ids.setdefault(symbol, self.known + len(ids))  # symbols outside the vocabulary take part in merges and give no id

        symbols = byte_symbols()
        self.inner, self.last = [number(x) for x in symbols], [number(x + self.end) for x in symbols]
        #: For each pair of symbols, as left << 32 | right: merge rank << 32 | merged symbol.
        self.pairs: dict[int, int] = {}
        for rank, m in enumerate(spec["model"]["merges"]):
            left, right = m.split(" ") if isinstance(m, str) else m
            self.pairs[number(left) << 32 | number(right)] = rank << 32 | number(left + right)

    def merge(self, symbols: list[int]) -> list[int]:
        """Merges of the symbols, lowest rank first and leftmost among equals.

        A queue entry is rank << 32 | place. It is stale if the pair that now stands there has another rank, as ranks tell pairs apart.
        """
        n, pairs, rank, place = len(symbols), self.pairs, -1 << 32, (1 << 32) - 1
        if n < 2:
            return symbols
        symbols, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [v & rank | i for i in range(n - 1) if (v := pairs.get(symbols[i] << 32 | symbols[i + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            entry = heapq.heappop(queue)
            i = entry & place
            j = after[i]
            if j >= n or symbols[i] < 0 or (v := pairs.get(symbols[i] << 32 | symbols[j])) is None or v & rank != entry & rank:
                continue
            symbols[i], symbols[j] = v & place, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (v := pairs.get(symbols[i] << 32 | symbols[k])) is not None:
                    heapq.heappush(queue, v & rank | i)
            h = before[i]
            if h >= 0 and (v := pairs.get(symbols[h] << 32 | symbols[i])) is not None:
                heapq.heappush(queue, v & rank | h)
        return [s for s in symbols if s >= 0]

    def tokens(self, text: str) -> list[int]:
        """Ids of a text. Strings of special tokens become those tokens."""
        out: list[int] = []
        for part in self.split_special.split(text) if self.split_special and "<" in text else [text]:
            if part in self.special:
                out.append(self.special[part])
                continue
            plain = part.isascii()
            for piece in self.ascii_pieces.findall(part.lower()) if plain else self.pieces.findall(self.fold(part)):
                raw = piece.encode()
                symbols = [self.inner[b] for b in raw]
                symbols[-1] = self.last[raw[-1]]
                out += self.merge(symbols)
        return [i for i in out if i in self.strings]

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.strings[i] for i in ids if i in self.strings)


def split_words(raw: bytes) -> list[bytes]:
    """The text's parts between ASCII white space, where no token crosses.

    ASCII letters are lower-cased first unless that could change a result: special tokens are matched
    before lower-casing, and some combining marks compose with a small letter only.
    """
    return raw.split() if b"<|" in raw or b"\xcc" in raw or b"\xcd" in raw else raw.lower().split()


def split_many(texts: pa.Array) -> pa.ListArray:
    """split_words of many texts (Arrow strings), by Arrow; parts may be empty."""
    raw = texts.cast(pa.binary())
    kept = pc.or_(pc.or_(pc.match_substring(raw, b"<|"), pc.match_substring(raw, b"\xcc")), pc.match_substring(raw, b"\xcd"))
    return pc.ascii_split_whitespace(pc.if_else(kept, texts, pc.ascii_lower(texts)))


_PLAIN = frozenset(b"abcdefghijklmnopqrstuvwxyz0123456789")


def end_stops(word: bytes) -> bytes:
    """The stops and commas that end a word, if they are a piece of their own, as behind an ASCII letter or digit."""
    base = word.rstrip(b".,")
    return word[len(base) :] if base and base[-1] in _PLAIN else b""


class _Words(dict):
    """What each word encodes to: decimal ids and vocabulary strings, each joined by spaces. It is emptied at about `most` bytes, and holds no word over LONG bytes."""

    def __init__(self, bpe: WordBpe, most: int):
        super().__init__()
        self.bpe, self.most, self.size = bpe, most, 0

    def __missing__(self, word: bytes) -> tuple[bytes, bytes]:
        if stops := end_stops(word):
            got = tuple(b" ".join(x) for x in zip(self[word[: -len(stops)]], self[stops]))
        else:
            ids = self.bpe.tokens(word.decode("utf-8", "replace"))
            got = (" ".join(map(str, ids)).encode(), self.bpe.decode(ids).encode())
        if len(word) > LONG:
            return got
        if self.size >= self.most:
            self.clear()
            self.size = 0
        self.size += len(word) + len(got[0]) + len(got[1]) + OVERHEAD
        self[word] = got
        return got


def bpe_round_trip(df: DataFrame, vocabulary: str, text_col: str = "text", id_col: str = "doc_id", keep: bool = False, most: int = TABLE) -> DataFrame:
    """Encodes every whole text and decodes it again: id, n_tokens, ids_sha256, decoded_sha256; with keep also ids (array) and decoded.

    A null or empty text has no tokens and the digests of the empty string. Each input row gives one
    row, repeated ones too; columns besides id and text are not carried, so their names can't clash.
    Memory: one Arrow batch and a table of about `most` bytes a worker.
    """
    schema = df.select(F.col(id_col)).schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    if keep:
        schema = schema.add("ids", ArrayType(IntegerType())).add("decoded", "string")

    name = f"bpe {vocabulary} {most}"

    def run(batches):
        table = kept(name, lambda: _Words(WordBpe(vocabulary), most))
        for batch in batches:
            texts = batch.column(1).fill_null("")
            for i, j in slices(text_parts(texts)[1], PORTION):
                split = split_many(texts.slice(i, j - i))
                coded = split.flatten().dictionary_encode()
                found = [table[w] for w in coded.dictionary.cast(pa.binary()).to_pylist()]
                some = np.fromiter((bool(x[0]) for x in found), bool, len(found))[coded.indices.to_numpy()] if found else np.zeros(0, bool)
                ends = np.concatenate(([0], np.cumsum(some)))[split.offsets.to_numpy() - split.offsets[0].as_py()]
                at, which = pa.array(ends.astype(np.int32)), coded.indices.filter(pa.array(some))
                ids, strings = (pc.binary_join(pa.ListArray.from_arrays(at, pa.array([x[k] for x in found], pa.binary()).take(which)), b" ").to_pylist() for k in (0, 1))
                rows = [(x.count(b" ") + 1 if x else 0, hashlib.sha256(x).hexdigest(), hashlib.sha256(y).hexdigest()) for x, y in zip(ids, strings)]
                if keep:
                    rows = [(*r, [int(n) for n in x.split()], y.decode()) for r, x, y in zip(rows, ids, strings)]
                kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string()][: len(schema) - 1]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds))], names=[f.name for f in schema])

    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(lean(run, name), schema)
