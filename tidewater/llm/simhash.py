"""SimHash near-duplicates with BK-trees over sharded fingerprints.

Fingerprints: A-Z lower-cased, words are runs without ASCII white space,
``shingle`` consecutive words joined by spaces (fewer words: the whole
sequence) are hashed with XXH64 (seed 42); a fingerprint bit is set if it is
set in over half of the hashes.  No words: fingerprint zero.

Links: distinct fingerprints at ``radius`` or fewer differing bits.  The 64
bits are cut into ``radius + 2`` blocks; two linked fingerprints agree on at
least two of them, so every pair of blocks gives one sharding in which they
meet, whatever the data.  A shard's BK-tree keys children by their Hamming
distance to the parent, and a search follows only edges within the radius of
the probe's distance.  A shard of more than ``tree_nodes`` fingerprints is
cut into trees of at most about that many; each tree is sent to the probes
of all the shard's parts, so a task holds two parts and no link between
parts is missed.  Each task emits spanning links only (one per linked
fingerprint), never all pairs, and components are joined in Spark.

Copies share one fingerprint and are one node.  Only distinct fingerprints
and their links are shuffled; nothing of them reaches the driver.

Edge cases: null text and text without words have fingerprint zero, which
links like any other; repeated rows are kept and share a component; a null
id is kept but never the name of a component unless all its ids are null;
an empty table gives an empty result.  Other input columns are not read by
``fingerprints``; ``dedup`` keeps all columns of its input, whatever their
names and types.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import add_columns, extended, map_batches, spare_names, stage
from tidewater.llm.components import components

SHINGLE = 3
RADIUS = 2
SEED = 42
TREE_NODES = 1 << 15
_PROBES = 1 << 13
_PORTION = 1 << 17


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of UTF-8 ``text``."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    stops = (ends[-n:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)], np.uint64)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 14):
        part = hashes[i : i + (1 << 14)].astype("<u8").view(np.uint8)
        counts += np.unpackbits(part.reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp)`` for every row; ``fp`` is the fingerprint as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return map_batches(source, run, extended(source.select("doc_id").schema, "fp bigint"))


class BKForest:
    """BK-trees of many shards, built and searched with whole arrays.

    ``fps`` are distinct within a tree; ``tree`` numbers the tree of each.
    Edges are kept sorted by (parent, distance), so the children within a
    range of distances are one slice.
    """

    def __init__(self, fps: np.ndarray, tree: np.ndarray):
        self.fps = fps
        _, first, number = np.unique(tree, return_index=True, return_inverse=True)
        self.root = first[number]
        below = np.flatnonzero(self.root != np.arange(len(fps)))
        at, keys, kids = self.root[below], [], []
        while len(below):
            key = at * 65 + np.bitwise_count(fps[below] ^ fps[at])
            edge, new, place = np.unique(key, return_index=True, return_inverse=True)
            keys.append(edge)
            kids.append(below[new])
            at = below[new][place]
            stay = at != below
            below, at = below[stay], at[stay]
        self.key = np.concatenate([*keys, np.empty(0, np.int64)])
        order = np.argsort(self.key, kind="stable")
        self.key, self.kid = self.key[order], np.concatenate([*kids, np.empty(0, np.int64)]).astype(np.int64)[order]

    def links(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs within ``radius`` of each other in the same tree, in bounded
        portions, found from every member by a search from its root."""
        for i in range(0, len(self.fps), _PROBES):
            probe = np.arange(i, min(i + _PROBES, len(self.fps)))
            node = self.root[probe]
            while len(probe):
                away = np.bitwise_count(self.fps[probe] ^ self.fps[node]).astype(np.int64)
                near = (away <= radius) & (node < probe)
                if near.any():
                    yield probe[near], node[near]
                low = np.searchsorted(self.key, node * 65 + np.maximum(away - radius, 0))
                high = np.searchsorted(self.key, node * 65 + np.minimum(away + radius, 64), side="right")
                fan = high - low
                edge = np.repeat(low - np.cumsum(fan) + fan, fan) + np.arange(fan.sum())
                probe, node = np.repeat(probe, fan), self.kid[edge]


def spanning(n: int, portions: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest member of the component of each of ``n`` nodes."""
    label = np.arange(n)
    for a, b in portions:
        while True:
            ra, rb = label[a], label[b]
            apart = ra != rb
            if not apart.any():
                break
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(label, np.maximum(ra, rb), np.minimum(ra, rb))
            while not np.array_equal(label, onward := label[label]):
                label = onward
    return label


def block_masks(radius: int) -> list[int]:
    """Bit masks of every pair of the ``radius + 2`` blocks of 64 bits."""
    cuts = [round(64 * i / (radius + 2)) for i in range(radius + 3)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [x | y for x, y in combinations(blocks, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(distinct: DataFrame, radius: int = RADIUS, tree_nodes: int = TREE_NODES) -> DataFrame:
    """Spanning links ``(a, b)`` of the distinct fingerprints in ``fp``."""
    masks = F.array(*[F.struct(F.lit(i).alias("no"), F.lit(_signed(m)).alias("mask")) for i, m in enumerate(block_masks(radius))])
    keyed = distinct.select("fp", F.explode(masks).alias("m")).select("fp", F.col("m.no").alias("no"), F.col("fp").bitwiseAND(F.col("m.mask")).alias("key"))
    shards = keyed.withColumns({"part": F.lit(0), "other": F.lit(0)})
    large = stage(keyed.groupBy("no", "key").count().where(F.col("count") > tree_nodes), "large-shards")
    if not large.isEmpty():
        parts = large.select("no", "key", F.ceil(F.col("count") / tree_nodes).cast("int").alias("parts"))
        cut = keyed.join(parts, ["no", "key"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        cut = cut.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        cut = cut.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        shards = cut.select("fp", "no", "key", F.least("own", "with").alias("part"), F.greatest("own", "with").alias("other"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fps, tree in _whole_trees(batches):
            edge = np.concatenate(([True], tree[1:] != tree[:-1]))
            alone = edge & np.concatenate((edge[1:], [True]))
            fps, tree = fps[~alone].view(np.uint64), tree[~alone]
            if len(fps):
                label = spanning(len(fps), BKForest(fps, tree).links(radius))
                moved = np.flatnonzero(label != np.arange(len(fps)))
                a, b = (pa.array(x.view(np.int64)) for x in (fps[moved], fps[label[moved]]))
                yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"])

    dealt = shards.select("fp", F.xxhash64("no", "key", "part", "other").alias("tree"))
    return map_batches(dealt.repartition("tree").sortWithinPartitions("tree", "fp"), run, "a bigint, b bigint")


def _whole_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows sorted by tree, dealt out as portions that split no tree."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)))
        if sum(len(t) for _, t in held) >= _PORTION:
            fps, tree = (np.concatenate(x) for x in zip(*held, strict=True))
            cut = int(np.searchsorted(tree, tree[-1]))
            if cut:
                yield fps[:cut], tree[:cut]
            held = [(fps[cut:], tree[cut:])]
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _classes(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int, tree_nodes: int) -> tuple[DataFrame, DataFrame]:
    """Staged fingerprints of all rows, and per distinct fingerprint its
    component's name and the id and fingerprint of the row that stays."""
    fps = stage(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = stage(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(links(distinct.select("fp"), radius, tree_nodes))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    stays = F.min(F.struct(F.col("least").isNull().alias("no_id"), "least", "fp")).alias("stays")
    names = named.groupBy("root").agg(F.min("least").alias("component_id"), stays)
    of_fp = named.join(names, "root").select("fp", "component_id", F.col("stays.least").alias("id"), F.col("stays.fp").alias("id_fp"))
    return fps, stage(of_fp, "fingerprint-components")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, tree_nodes: int = TREE_NODES) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs``."""
    fps, of_fp = _classes(docs, id_col, text_col, shingle, radius, tree_nodes)
    return fps.join(of_fp, "fp").select("doc_id", "fp", "component_id")


def hex64(fp: str = "fp"):
    """A long as 16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, tree_nodes: int = TREE_NODES) -> DataFrame:
    """``docs`` with one row left of each component, all columns kept.

    The row with the smallest id stays (of several, the one with the
    smallest fingerprint, then the smallest other columns).
    """
    fps, of_fp = _classes(docs, id_col, text_col, shingle, radius, tree_nodes)
    name, print_, text, own, rank = spare_names(docs.columns, "stays_id", "stays_fp", "raw", "own_fp", "rank")
    here = F.col(f"`{id_col}`")
    stays = of_fp.select(F.col("id").alias(name), F.col("id_fp").alias(print_)).distinct()
    odd = stage(fps.groupBy("doc_id").count().where("count > 1 or doc_id is null").select(F.col("doc_id").alias(name)), "odd-ids")
    if odd.isEmpty():
        return docs.join(stays, here == F.col(name), "left_semi")
    # Null and repeated ids do not name one row: these rows are told apart by
    # their fingerprint, and exact repeats by a rank.
    plain = docs.join(odd, here.eqNullSafe(F.col(name)), "left_anti").join(stays, here == F.col(name), "left_semi")
    some = docs.join(odd, here.eqNullSafe(F.col(name)), "left_semi")
    some = add_columns(some.withColumn(text, F.col(f"`{text_col}`").cast("binary")), f"{own} bigint", lambda texts: [[_signed(fingerprint(t, shingle)) for t in texts]], text).drop(text)
    some = some.join(stays, here.eqNullSafe(F.col(name)) & (F.col(own) == F.col(print_)), "left_semi")
    one = Window.partitionBy(own, here).orderBy(*[_orderable(docs, c) for c in docs.columns])
    some = some.withColumn(rank, F.row_number().over(one)).where(F.col(rank) == 1)
    return plain.unionByName(some.drop(own, rank))


def _orderable(docs: DataFrame, column: str):
    """The column, or its JSON text if its kind has no order (maps)."""
    c, kind = F.col(f"`{column}`"), docs.schema[column].dataType.simpleString()
    return F.to_json(F.struct(c)) if "map<" in kind or "variant" in kind else c
