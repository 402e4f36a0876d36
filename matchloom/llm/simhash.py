"""SimHash near-duplicates through a segment-popcount embedding.

A 64-bit fingerprint becomes 32 coordinates, the bit counts of its 2-bit segments. Manhattan distance of
coordinates is at most the Hamming distance of fingerprints. Of two points within Manhattan distance 3, the first or the
second half of the coordinates is within 1. So there is a grid over each half, whose cells have a width of 1, and
the range join takes each point to its own cell and to the neighbours that are one step higher in one coordinate: two
points within 1 then meet in the cell of one of them. Points that meet are compared by Manhattan distance over
all coordinates and then exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, lean, text_parts
from .components import components

LINK = 3
LOW = 0x5555555555555555
TILE = 16384
#: For counting bits: row v has the bits of byte v, the highest first.
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_COLUMN = np.arange(8, dtype=np.int64) * 256


def fingerprint(text: bytes, shingle: int = 3, portion: int = 1 << 16) -> int:
    """Majority of the bits of XXH64 (seed 42) over the shingles of ASCII-lower-cased words, repeats included; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    if len(words) < shingle:
        return int.from_bytes(digest(b" ".join(words), 42), "big")
    total, ones = len(words) - shingle + 1, np.zeros((8, 8), np.int64)
    for i in range(0, total, portion):
        part = words[i : i + portion + shingle - 1]
        hashes = b"".join([digest(b" ".join(x), 42) for x in zip(*(part[k:] for k in range(shingle)))])
        held = np.frombuffer(hashes, np.uint8).reshape(-1, 8) + _COLUMN
        ones += np.bincount(held.ravel(), minlength=2048).reshape(8, 256) @ _BYTE_BITS
    return int.from_bytes(np.packbits((2 * ones > total).ravel()).tobytes(), "big")


def fingerprints(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = 3) -> DataFrame:
    """Fingerprint of every whole text as a signed long: id, fp. A null or empty text has 0; rows keep their number, null and repeated ids too."""
    schema = df.select(F.col(id_col).alias("id")).schema.add("fp", "long")

    def run(batches):
        for batch in batches:
            body, at = text_parts(batch.column(1))
            raw = body.tobytes()
            found = np.fromiter((fingerprint(raw[i:j], shingle) for i, j in zip(at[:-1].tolist(), at[1:].tolist())), np.uint64, len(at) - 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["id", "fp"])

    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(lean(run), schema)


def embed(x: np.ndarray) -> np.ndarray:
    """Bit counts of 2-bit segments in unary (0: 00, 1: 01, 2: 11), so that Manhattan distance is the bit count of an exclusive or."""
    x = x.astype(np.uint64)
    high = x >> np.uint64(1)
    return (x & high & np.uint64(LOW)) << np.uint64(1) | (x | high) & np.uint64(LOW)


def _embedded(fp: Column) -> Column:
    high = F.shiftrightunsigned(fp, 1)
    return F.shiftleft(fp.bitwiseAND(high).bitwiseAND(F.lit(LOW)), 1).bitwiseOR(fp.bitwiseOR(high).bitwiseAND(F.lit(LOW)))


def reached(e: str = "e") -> Column:
    """The grid cells that a point (its coordinates in unary) is taken to: half, cell and whether it is the point's own."""
    halves = []
    for half, mask in enumerate((0xFFFFFFFF, -1 << 32)):
        own = f"({e} & {mask}L)"
        low, high = (f"shiftleft(1L, 2 * c + {32 * half + k})" for k in (0, 1))
        up = f"transform(sequence(0, 15), c -> CASE WHEN {e} & {low} = 0 THEN named_struct('half', {half}, 'cell', {own} | {low}, 'home', false) WHEN {e} & {high} = 0 THEN named_struct('half', {half}, 'cell', {own} | {high}, 'home', false) END)"
        halves.append(f"concat(array(named_struct('half', {half}, 'cell', {own}, 'home', true)), filter({up}, x -> x IS NOT NULL))")
    return F.expr(f"concat({', '.join(halves)})")


def spanning_links(x: np.ndarray, link: int = LINK) -> tuple[np.ndarray, np.ndarray]:
    """Enough of the links among distinct fingerprints to connect all that are linked, by search from point to point.

    A point that has been reached is compared no more, so a dense group costs little more than its size.
    """
    u, left, right = embed(x), [], []
    todo, queue = np.arange(1, len(x)), [0]
    while True:
        while queue and len(todo):
            i = queue.pop()
            near = np.bitwise_count(u[todo] ^ u[i]) <= link
            near &= np.bitwise_count(x[todo] ^ x[i]) <= link
            if near.any():
                found = todo[near]
                left.append(np.full(len(found), x[i]))
                right.append(x[found])
                queue += found.tolist()
                todo = todo[~near]
        if not len(todo):
            break
        queue, todo = [int(todo[0])], todo[1:]
    empty = np.zeros(0, np.uint64)
    return (np.concatenate(left), np.concatenate(right)) if left else (empty, empty)


def _cell_links(batches):
    """Links within each cell (and tile) of rows sorted by cell; a cell is held only while its rows come, and has 2 * TILE rows at most in a tile."""
    names = ["a", "b"]

    def out(a, b):
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=names)

    held = None
    for batch in batches:
        cols = [c.to_numpy() for c in batch.columns]
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols)]
        keys, x = cols[:-1], cols[-1].view(np.uint64)
        if not len(x):
            continue
        new = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        starts = np.concatenate(([0], new))
        held = [c[starts[-1] :] for c in cols]
        yield from _runs(x, starts, out)
    if held is not None:
        yield from _runs(held[-1].view(np.uint64), np.array([0, len(held[-1])]), out)


def _runs(x: np.ndarray, starts: np.ndarray, out):
    """Links of the runs between consecutive starts."""
    sizes = np.diff(starts)
    two = starts[:-1][sizes == 2]
    a, b = x[two], x[two + 1]
    near = np.bitwise_count(embed(a) ^ embed(b)) <= LINK
    near &= np.bitwise_count(a ^ b) <= LINK
    left, right = [a[near]], [b[near]]
    for i, n in zip(starts[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        p, q = spanning_links(np.unique(x[i : i + n]))
        left.append(p)
        right.append(q)
    left, right = np.concatenate(left), np.concatenate(right)
    if len(left):
        yield out(left, right)


def links(distinct: DataFrame) -> DataFrame:
    """(a, b) links among distinct fingerprints (column fp), enough to connect all that are within 3 bits by steps of at most 3 bits.

    Cells of one point, or that are no point's own, are dropped after a count. A cell of over TILE points is dealt into tiles of two
    parts each, so that every two of its points meet in some tile and no task holds the whole cell.
    """
    own = distinct.select("fp", _embedded(F.col("fp")).alias("e"))
    cells = own.select("fp", F.explode(reached()).alias("to")).select("fp", "to.*")
    counts = cells.groupBy("half", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("home").alias("homes")).where("n > 1 AND homes").select(F.col("half").alias("c"), F.col("cell").alias("d"), "n")
    shared = cells.join(counts, (F.col("half") == F.col("c")) & (F.col("cell") == F.col("d"))).withColumn("parts", F.ceil(F.col("n") / TILE).cast("int"))
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    tiles = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.least(part, j) * F.col("parts") + F.greatest(part, j)))
    dealt = shared.select("half", "cell", F.explode(tiles).alias("tile"), "fp")
    return dealt.repartition("half", "cell", "tile").sortWithinPartitions("half", "cell", "tile", "fp").mapInArrow(lean(_cell_links), "a long, b long")


def near_duplicates(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = 3) -> DataFrame:
    """Near-duplicate groups: id, fingerprint (16 hexadecimal digits), component_id (smallest id of the group).

    Two texts are linked if their fingerprints differ in 3 bits at most, and a group is all that links
    reach. A null or empty text has fingerprint zero, linked like any other. Rows keep their number; null
    ids belong to a group but never name it unless all its ids are null. Other columns are not carried.
    """
    scratch = Scratch(df.sparkSession, "simhash")
    prints = scratch.cut(fingerprints(df, text_col, id_col, shingle), "prints")
    nodes = scratch.cut(prints.groupBy("fp").agg(F.min("id").alias("first")), "nodes")
    roots = components(links(nodes), scratch)
    named = roots.join(nodes, roots.node == nodes.fp).select("node", "root", "first")
    best = named.groupBy("root").agg(F.min("first").alias("component")).withColumnRenamed("root", "r")
    renamed = scratch.cut(named.join(best, F.col("root") == F.col("r")).select("node", "component"), "renamed")
    owner = nodes.join(renamed, nodes.fp == renamed.node, "left").select(F.col("fp").alias("owner_fp"), F.coalesce("component", "first").alias("component_id"))
    joined = prints.join(owner, prints.fp == owner.owner_fp)
    return joined.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
