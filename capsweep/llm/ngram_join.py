"""N-gram Jaccard join: which documents' word-shingle sets are alike, by count-vector R-trees, as components.

Every pair of different sets that reaches the similarity is found, whatever the size of its group:

1. Copies (the same words) count once. Each set is cut into as many hash groups as pairs of its size may differ in,
   and more; a pair that links has then a group in common, whole. Documents that share a group's signature are
   joined to the first that has it (not pair by pair), which gives rough components that no link crosses.
2. A rough component of at most TILE sets is searched by one R-tree. Its points are counts of shingles by hash group;
   the overlap of a set with any point below a node is at most the sum of the coordinates' minima with the node's
   upper corner, so most subtrees fall away; the rest are verified on the sets. A set already connected to a
   candidate skips it.
3. A larger one is dealt in tiles, each with the same few centres, and searched tile by tile; what stays apart from
   its largest component is then searched against every tile, in blocks. Each tile meets one block in a round, so that
   the sets that a round moves grow as the component does, and not with its square; the rounds are as many as blocks.

Defined results: a null text, or one without words, has no shingles and links with nothing; a text of fewer words
than a shingle is one shingle; repeated rows and repeated doc_ids are documents like any other; a component's id is
its smallest doc_id (nulls aside). An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, claim, materialise, release, sorted_groups, text_slices
from .graph import connected_components
from .words import forget, mix, shingle_set, split_words

TILE = 1000
CENTRES = 8
LEAF = 16
#: Groups for each that differences can reach.
SPARE = 1.2
#: Rows of a table that is sent to all executors; beyond it, the join shuffles.
BROADCAST_ROWS = 1_000_000
#: Parts in which signatures are dealt; each makes them anew and keeps its own, so that disk holds one part.
PARTS = 2
#: Signatures that one task sorts, about: so few that it needn't spill.
TASK_SIGNATURES = 4_000_000
#: Bytes of sets up to which several rounds of what tiles left apart go at once.
ROUND_BYTES = 256 << 20
_MEMORY_KEYS = 200_000


def levels(t: Fraction, most: int) -> list[tuple[int, int]]:
    """(upper size, groups) of each size class; sets that link are of the same class or of neighbours.

    A pair of level l has its smaller set in class l; its sets, of sizes s and at most s / t, differ in at most
    (1 - t) / t * s shingles. More groups than that are cut, so that the small ones needn't count.
    """
    out, low = [], 1
    while low <= most:
        high = math.floor(low / t)
        apart = math.floor((1 - t) / t * high)
        out.append((high, math.ceil((apart + 1) * SPARE) + 4 if apart else 1))
        low = high + 1
    return out


def signatures(sets: list[np.ndarray], t: Fraction) -> list[np.ndarray]:
    """For each set, 64-bit signatures; sets that link share one.

    A set that differs in at most k shingles from any it links with has more than k groups of m shingles and more,
    for the largest such m, and gives those. Of two sets that link, the one with the larger m keeps one of its groups whole,
    which the other has too, and gives.
    """
    table = levels(t, max((len(s) for s in sets), default=0) or 1)
    upper = np.array([x[0] for x in table])
    out: list[list[np.ndarray]] = [[] for _ in sets]
    size = np.array([len(s) for s in sets], np.int64)
    own = np.searchsorted(upper, size)
    p, q = t.numerator, t.denominator
    for back in (0, 1):
        use = np.flatnonzero((size > 0) & (own - back >= 0))
        if not len(use):
            continue
        level, n = own[use] - back, size[use]
        groups = np.array([table[k][1] for k in level], np.int64)
        # most differences: as the smaller of a pair, or as the larger beside one of the class below
        apart = (q - p) * n // p if not back else (q - p) * (n + np.minimum(n, upper[level])) // (q + p)
        begin = np.concatenate(([0], np.cumsum(groups)))
        h = np.concatenate([sets[i] for i in use])
        cell = np.repeat(begin[:-1], n) + (mix(h ^ np.uint64(0x5851F42D4C957F2D)) % np.repeat(groups.astype(np.uint64), n)).astype(np.int64)
        total = np.zeros(begin[-1], np.uint64)
        np.add.at(total, cell, mix(h))
        count = np.bincount(cell, minlength=begin[-1])
        number = np.arange(begin[-1]) - np.repeat(begin[:-1], groups)
        sig = mix(total ^ mix((np.repeat(level, groups).astype(np.uint64) << np.uint64(40)) + number.astype(np.uint64)))
        for j, i in enumerate(use.tolist()):
            a, b = begin[j], begin[j + 1]
            mine = count[a:b]
            k = min(int(apart[j]), b - a - 1)
            least = np.partition(mine, b - a - 1 - k)[b - a - 1 - k]
            out[i].append(sig[a:b][mine >= least])
    return [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in out]


class CountTree:
    """An R-tree, packed bottom-up, over vectors of shingle counts by hash group."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.size = np.array([len(s) for s in sets], np.int64)
        dims = 16
        while dims < 256 and dims * 8 < float(np.median(self.size)):
            dims *= 2
        self.points = np.array([np.bincount((mix(s) >> np.uint64(20)).astype(np.int64) & (dims - 1), minlength=dims) for s in sets], np.int32).reshape(len(sets), dims)
        widest = np.argsort(-self.points.var(axis=0), kind="stable")[:2]
        slab = np.argsort(self.size, kind="stable")
        per = max(LEAF, math.isqrt(len(sets) * LEAF))
        self.order = np.concatenate([part[np.lexsort((self.points[part, widest[-1]], self.points[part, widest[0]]))] for part in (slab[k : k + per] for k in range(0, len(sets), per))]) if len(sets) else slab
        # levels[0] are leaves' corners; each level's nodes hold LEAF of the level below
        self.levels = []
        high, small, large = self.points[self.order], self.size[self.order], self.size[self.order]
        while len(high):
            at = np.arange(0, len(high), LEAF)
            high, small, large = np.maximum.reduceat(high, at), np.minimum.reduceat(small, at), np.maximum.reduceat(large, at)
            self.levels.append((high, small, large))
            if len(high) == 1:
                break

    def candidates(self, point: np.ndarray, size: int, t: Fraction) -> np.ndarray:
        """Sets whose bound on the overlap reaches the similarity, best first."""
        if not self.levels:
            return np.zeros(0, np.int64)
        p, q = t.numerator, t.denominator
        reach = lambda high, small: np.minimum(high, point).sum(axis=1) * (p + q) >= p * (size + small)
        nodes = np.arange(1)
        for high, small, large in reversed(self.levels):
            nodes = nodes[nodes < len(high)]
            ok = reach(high[nodes], small[nodes]) & (small[nodes] * p <= size * q) & (size * p <= large[nodes] * q)
            nodes = (nodes[ok][:, None] * LEAF + np.arange(LEAF)).ravel()
        rows = self.order[nodes[nodes < len(self.order)]]
        bound = np.minimum(self.points[rows], point).sum(axis=1)
        ok = bound * (p + q) >= p * (size + self.size[rows])
        return rows[ok][np.argsort(-bound[ok], kind="stable")]


def _root(parent: np.ndarray, x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def search(sets: list[np.ndarray], t: Fraction, probes: list[int] | None = None, parts: list | None = None) -> list[tuple[int, int]]:
    """Links that connect what the similarity connects: for every pair that links, its ends are connected by them.

    probes: the sets to search for (all, if None). parts: components known already; links inside one are not looked for.
    """
    tree, links = CountTree(sets), []
    parent = np.arange(len(sets))
    first: dict = {}
    for i, part in enumerate(parts or ()):
        parent[i] = first.setdefault(part, i)
    p, q = t.numerator, t.denominator
    for i in range(len(sets)) if probes is None else probes:
        for j in tree.candidates(tree.points[i], int(tree.size[i]), t).tolist():
            a, b = _root(parent, i), _root(parent, j)
            if a == b:
                continue
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if both * q >= p * (len(sets[i]) + len(sets[j]) - both):
                parent[max(a, b)] = min(a, b)
                links.append((i, j))
    return links


def _profile(words: int):
    """(doc_id, text) -> (doc_id, key, n_shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("ngram_join", forget)
        for batch in text_slices(batches, 1):
            keys, sizes = [], []
            known: dict[bytes, int] = {}
            for text in batch.column(1).to_pylist():
                w = split_words(text or "")
                key = hashlib.md5(b" ".join(w)).digest() if w else None
                if key not in known:
                    known[key] = len(shingle_set(w, words))
                keys.append(key)
                sizes.append(known[key])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64())], ["doc_id", "key", "n_shingles"])

    return run


def _node(key: bytes) -> int:
    """The first eight bytes of a key, which name it in rough components; the same as NODE."""
    return int.from_bytes(key[:8], "big", signed=True)


NODE = "cast(conv(hex(substring(key, 1, 8)), 16, -10) as long)"


def _signed(words: int, t: Fraction, part: int, parts: int):
    """(text) -> (sig, node): those of the texts' signatures that fall into a part of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        claim("ngram_join", forget)
        for batch in text_slices(batches, 0):
            nodes, sets = [], []
            if len(seen) > _MEMORY_KEYS:
                seen.clear()
            for text in batch.column(0).to_pylist():
                w = split_words(text or "")
                key = hashlib.md5(b" ".join(w)).digest() if w else None
                if key is not None and key not in seen:
                    seen.add(key)
                    nodes.append(_node(key))
                    sets.append(shingle_set(w, words))
            if sets:
                sigs = [s[(s >> np.uint64(32)) % np.uint64(parts) == part] for s in signatures(sets, t)]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.repeat(np.array(nodes, np.int64), [len(s) for s in sigs]))], ["sig", "node"])

    return run


def _runs_to_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sig, node) sorted -> (u, v): each node of a signature with the signature's first."""
    last_sig, first = None, None
    for batch in batches:
        sig, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(sig):
            continue
        starts = np.concatenate(([True], sig[1:] != sig[:-1]))
        if last_sig is not None and sig[0] == last_sig:
            starts[0] = False
        at = np.maximum.accumulate(np.where(starts, np.arange(len(sig)), -1))
        head = np.where(at >= 0, node[np.maximum(at, 0)], first if first is not None else 0)
        last_sig, first = sig[-1], head[-1]
        use = head != node
        if use.any():
            yield pa.RecordBatch.from_arrays([pa.array(node[use]), pa.array(head[use])], ["u", "v"])


def _shingles(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("ngram_join", forget)
        for batch in text_slices(batches, 0):
            keys, sets = [], []
            for text in batch.column(0).to_pylist():
                w = split_words(text or "")
                keys.append(hashlib.md5(b" ".join(w)).digest() if w else None)
                sets.append(shingle_set(w, words).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), *batch.columns[1:], pa.array(sets, pa.binary())], ["key", *batch.schema.names[1:], "shingles"])

    return run


def _search_groups(keys: list[str], t: Fraction, probing: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, keys):
            rows: dict[bytes, int] = {}
            sets, parts, probes = [], [], set()
            for r in group.select(["key", "shingles", *(["fine", "probe"] if probing else [])]).to_pylist():
                if r["key"] not in rows:
                    rows[r["key"]] = len(sets)
                    sets.append(np.frombuffer(r["shingles"], np.uint64))
                    parts.append(r.get("fine"))
                if r.get("probe"):
                    probes.add(rows[r["key"]])
            names = list(rows)
            links = search(sets, t, sorted(probes) if probing else None, parts if probing else None)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([names[i] for i, _ in links], pa.binary()), pa.array([names[j] for _, j in links], pa.binary())], ["u", "v"])

    return run


def ngram_components(docs: DataFrame, words: int = 5, similarity: tuple[int, int] = (4, 5), tile: int = TILE) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs(doc_id, text).

    Documents link whose sets of word shingles have at least `similarity` (numerator, denominator) as their Jaccard
    index. A-Z count as a-z; words are runs without ASCII white space.
    """
    return _components(docs, words, similarity, tile).drop("key")


def _components(docs: DataFrame, words: int, similarity: tuple[int, int], tile: int = TILE) -> DataFrame:
    """ngram_components, with the key of each row's words."""
    spark, t = docs.sparkSession, Fraction(*similarity)
    bounded_batches(spark)
    given = docs.select("doc_id", "text")
    profile = materialise(given.mapInArrow(_profile(words), "doc_id long, key binary, n_shingles long"), "profile")

    # signatures take more room than the texts: they are made where they are dealt, a part of them at a time
    # a text has about as many signatures as shingles
    dealt = [n] if (n := (profile.agg(F.sum("n_shingles")).first()[0] or 0) // (PARTS * TASK_SIGNATURES)) > int(spark.conf.get("spark.sql.shuffle.partitions")) else []
    near = [materialise(given.select("text").mapInArrow(_signed(words, t, part, PARTS), "sig long, node long").repartition(*dealt, "sig").sortWithinPartitions("sig", "node").mapInArrow(_runs_to_edges, "u long, v long").distinct(), "near") for part in range(PARTS)]
    rough = connected_components(reduce(DataFrame.unionByName, near))
    for table in near:
        release(table)

    # one document for each set of words in a rough component, and the tile where it is searched
    wanted = profile.where("key is not null").select("doc_id", "key", F.expr(NODE).alias("node")).join(rough, "node").groupBy("key", "component").agg(F.min("doc_id").alias("id"))
    wanted = materialise(wanted.select("id", F.col("key").alias("want"), F.col("component").alias("rough")), "wanted")
    release(rough)
    count = wanted.groupBy("rough").agg(F.count("*").alias("members"))
    placed = wanted.join(count, "rough").select("id", "want", "rough", F.ceil(F.col("members") / tile).cast("int").alias("tiles"), (F.pmod(F.xxhash64("want", F.lit(1)), "members") < CENTRES).alias("centre"))
    placed = materialise(placed.withColumn("tile", F.pmod(F.xxhash64("want"), "tiles").cast("int")), "placed")
    release(wanted)

    all_tiles = F.sequence(F.lit(0), F.col("tiles") - 1)
    near = _sets(given, placed, words).select("key", "rough", "shingles", F.explode(F.when(F.col("centre") & (F.col("tiles") > 1), all_tiles).otherwise(F.array("tile"))).alias("tile"))
    links = materialise(near.repartition("rough", "tile").sortWithinPartitions("rough", "tile", "key").mapInArrow(_search_groups(["rough", "tile"], t, False), "u binary, v binary"), "links")
    fine = connected_components(links)
    large = placed.where("tiles > 1")
    if not large.isEmpty():
        large = materialise(_sets(given, large, words), "large")
        was = fine
        links = reduce(DataFrame.unionByName, [links, *_rest(large, fine, t, tile)])
        fine = connected_components(links)
        release(was)
        release(large)
    release(placed)

    least = profile.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("least"))
    named = least.join(fine.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    # a component is at most as many keys as its documents differ in words; minima meet before the shuffle
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.select("key", "component").join(ids, "component").select("key", "component_id")
    out = profile.select("doc_id", "key", "n_shingles").join(named, "key", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "key")


def _sets(given: DataFrame, placed: DataFrame, words: int) -> DataFrame:
    """placed, with the shingles of its documents' texts, read from the documents again; ids that repeat with other words fall out."""
    bounded_batches(given.sparkSession)
    places = F.broadcast(placed) if placed.count() <= BROADCAST_ROWS else placed
    texts = given.join(places, F.col("doc_id").eqNullSafe(F.col("id"))).select("text", "want", "rough", "tiles", "centre", "tile")
    return texts.mapInArrow(_shingles(words), "key binary, want binary, rough long, tiles int, centre boolean, tile int, shingles binary").where("key = want").drop("want")


def _rest(large: DataFrame, fine: DataFrame, t: Fraction, tile: int) -> list[DataFrame]:
    """Links between what the tiles left apart, a table for each turn: every set outside its rough component's largest part meets
    all tiles. In a round, a tile meets the block whose number is the tile's and the round's sum, so that every set moves
    once as one of its tile, and a block's sets to as many tiles as there are for each block."""
    at = large.select("key", "rough", F.octet_length("shingles").alias("bytes")).join(fine.withColumnRenamed("node", "key"), "key", "left")
    at = materialise(at.select("key", "rough", "bytes", F.coalesce("component", "key").alias("fine")), "fine")
    size = at.groupBy("rough", "fine").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    largest = size.groupBy("rough").agg(F.max_by("fine", F.struct("n", "fine")).alias("largest"), F.sum("n").alias("n"), F.max("n").alias("most"), F.sum("bytes").alias("bytes"))
    largest = largest.select("rough", "largest", F.ceil((F.col("n") - F.col("most")) / tile).cast("int").alias("blocks"), "bytes").where("blocks > 0")
    rounds, moved = largest.agg(F.max("blocks"), F.sum("bytes")).first()
    if not rounds:
        release(at)
        return []
    apart = materialise(at.select("key", "rough", "fine").distinct().join(largest, "rough").select("key", "fine", (F.col("fine") != F.col("largest")).alias("probe"), "blocks"), "apart")
    release(at)
    # sets lie where they were written; only narrow rows go to them
    apart, was = (F.broadcast(apart) if apart.count() <= BROADCAST_ROWS else apart), apart
    at = large.join(apart, "key").withColumn("block", F.pmod(F.xxhash64("key", F.lit(2)), "blocks").cast("int"))
    keys, step, links = ["rough", "tile", "block"], max(1, ROUND_BYTES // (2 * moved)), []
    for begin in range(0, rounds, step):
        last, now = F.least(F.lit(begin + step), F.col("blocks")) - 1, at.where(F.col("blocks") > begin)
        to = F.filter(F.sequence(F.lit(0), F.col("tiles") - 1), lambda x: F.pmod(F.col("block") - x, "blocks").between(begin, last))
        met = F.transform(F.sequence(F.lit(begin), last), lambda r: F.pmod(F.col("tile") + r, "blocks").cast("int"))
        probes = now.where("probe").select("key", "shingles", "rough", "fine", "probe", F.explode(to).alias("tile"), "block")
        others = now.select("key", "shingles", "rough", "fine", F.lit(False).alias("probe"), "tile", F.explode(met).alias("block"))
        links.append(materialise(probes.unionByName(others).repartition(*keys).sortWithinPartitions(*keys, "key").mapInArrow(_search_groups(keys, t, True), "u binary, v binary"), "links"))
    release(was)
    return links


def _keyed(docs: DataFrame, name: str) -> DataFrame:
    """docs with the key of the text's words, under a name that docs hasn't."""
    bounded_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, at):
            words = [split_words(x or "") for x in batch.column(at).to_pylist()]
            keys = [hashlib.md5(b" ".join(w)).digest() if w else None for w in words]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], [*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.BinaryType())]))


def one_of_each(docs: DataFrame, words: int = 5, similarity: tuple[int, int] = (4, 5)) -> DataFrame:
    """docs without the documents of a component but its smallest doc_id.

    Rows that repeat a doc_id and text are one document; rows that share a doc_id but not their words are judged each
    for itself. Documents without id can't be named, and stay.
    """
    parts = materialise(_components(docs, words, similarity), "parts")
    gone = parts.where(F.col("doc_id") != F.col("component_id")).select("doc_id", "key").distinct()
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    again = parts.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    if again.isEmpty():
        return docs.join(gone.select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
    key = "key_of_words"
    while key in {c.lower() for c in docs.columns}:
        key += "_"
    once = docs.join(again, "doc_id", "left_anti").join(gone.select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
    more = _keyed(docs.join(again, "doc_id", "left_semi").select(*docs.columns), key).join(gone.withColumnRenamed("key", key), ["doc_id", key], "left_anti")
    return once.unionByName(more.select(*docs.columns).dropDuplicates(["doc_id", "text"]))
