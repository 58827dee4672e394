"""N-gram Jaccard join with a count-vector R-tree, and its connected groups.

A document is the set of its hashed word shingles. The hash space is cut into groups, and
the counts per group are the document's point. For two documents the overlap is at most the
sum of their coordinate minima, which prunes nodes and pairs of an R-tree; the parities of
finer counts rule out most of the other pairs before they leave the tree, and what is left
is verified on the sets themselves.

The tree is distributed by the groups: two sets that are alike enough differ in few
shingles, so when the space is cut into more groups than they may differ in, at least one
group holds the same shingles in both. Documents meet in the blocks of their groups'
contents, and each block has its own tree. Every qualifying pair meets somewhere, and a
frequent passage alone brings nobody together, since a group also holds other shingles.

Equal sets go on as one. Blocks are first linked along a chain, and only blocks whose
documents do not form one component yet go through the tree, where every document tries its
best partners first, so large groups of copies cost their size, not their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.components import connected_components
from ledgerlens.llm.common import chunks, mix, packed, prepare, shingle_sets, stored, unpack

_U = np.uint64
SPARE_GROUPS = 2
SPARE_SHARE = 16
POINT_GROUPS = 128
LEAF = 32
FIRST_PARTNERS = 1
MORE_PARTNERS = 16
PARITY_CELLS = 2048
MOST_PARITY_CELLS = 1 << 14
EARLIER_BLOCKS = 16


@dataclass(frozen=True)
class Likeness:
    """Shingles of ``words`` words; linked when share_of * intersection >= share * union."""

    words: int = 3
    share: int = 90
    share_of: int = 100

    def least_overlap(self, sizes: np.ndarray) -> np.ndarray:
        """The smallest intersection of linked sets with these summed sizes."""
        return -(-self.share * sizes // (self.share + self.share_of))

    def most_differing(self, sizes: int) -> int:
        """The most shingles that only one of two linked sets with these summed sizes can have."""
        return sizes * (self.share_of - self.share) // (self.share_of + self.share)

    def may_differ(self, differing: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return differing * (self.share + self.share_of) <= sizes * (self.share_of - self.share)

    def linked(self, shared: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return shared * self.share_of >= (sizes - shared) * self.share


@lru_cache(maxsize=8)
def _level_starts(like: Likeness) -> tuple[int, ...]:
    """First set size of every level; sets of one level or of neighbouring levels may be linked."""
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(starts[-1] * like.share_of**3 // like.share**3 + 1)
    return tuple(starts)


def _levels_of(size: int, like: Likeness) -> list[int]:
    """The set's own level, and the one below when its largest sets may be linked with this one."""
    starts = _level_starts(like)
    own = int(np.searchsorted(starts, size, "right")) - 1
    least_partner = -(-size * like.share // like.share_of)
    return [own - 1, own] if own and least_partner < starts[own] else [own]


@lru_cache(maxsize=256)
def _group_borders(level: int, like: Likeness) -> np.ndarray:
    """Borders of the hash space: more groups than a linked pair can differ in whose smaller set is of this level."""
    end = _level_starts(like)[level + 1] - 1
    differing = like.most_differing(end + end * like.share_of // like.share)
    groups = differing + differing // SPARE_SHARE + 1 + SPARE_GROUPS
    return np.array([(g << 64) // groups for g in range(1, groups)], _U)


def block_keys(hashes: np.ndarray, like: Likeness) -> np.ndarray:
    """Keys of the contents of a set's groups, on every level it meets others on.

    A set gives its first filled groups, one more than it and a partner can differ in. Of two
    linked sets the one that stops earlier has a group among its own that is equal in both,
    and the other one, which goes on further, gives that group too. A set with fewer filled
    groups gives all groups, empty ones included. Sets meet on the level of the smaller one,
    whose larger partners may be of the next level.
    """
    if not len(hashes):
        return np.empty(0, np.int64)
    keys = []
    starts, size = _level_starts(like), len(hashes)
    with np.errstate(over="ignore"):
        summed = np.concatenate([np.zeros(1, _U), np.cumsum(mix(hashes))])
        for level in _levels_of(size, like):
            end = starts[level + 1] - 1
            largest_partner = size * like.share_of // like.share if size <= end else end
            wanted = like.most_differing(size + largest_partner) + 1
            cuts = np.concatenate([[0], np.searchsorted(hashes, _group_borders(level, like)), [size]])
            sizes = np.diff(cuts)
            places = np.flatnonzero(sizes)[:wanted]
            if len(places) < wanted:
                places = np.arange(len(sizes))
            content = summed[cuts[places + 1]] - summed[cuts[places]] + sizes[places].astype(_U)
            keys.append(mix(content ^ mix(places.astype(_U) + (_U(level + 1) << _U(40)))))
    return np.concatenate(keys).view(np.int64)


def point(hashes: np.ndarray) -> np.ndarray:
    """Counts of a set's shingles per group of the hash space."""
    return np.bincount((hashes >> _U(64 - POINT_GROUPS.bit_length() + 1)).astype(np.int64), minlength=POINT_GROUPS)


def packed_point(counts: np.ndarray) -> bytes:
    """A point for a shuffle: one byte a count where all fit, four otherwise, compressed."""
    return zstandard.compress(counts.astype("u1" if counts.max() < 256 else "<u4").tobytes(), 1)


def unpacked_points(data: list[bytes]) -> np.ndarray:
    """The points of some sets, one a row."""
    expand = zstandard.ZstdDecompressor()
    plain = [expand.decompress(d) for d in data]
    return np.stack([np.frombuffer(d, "u1" if len(d) == POINT_GROUPS else "<u4") for d in plain]).astype(np.int32)


def parities(hashes: np.ndarray) -> np.ndarray:
    """For each cell of a finer cut, whether a set has an odd number of shingles in it, as 64-bit words.

    Two sets differ in at least as many shingles as their parities do in cells. Large sets have as
    many cells as shingles, up to ``MOST_PARITY_CELLS``, since few cells let all pairs of long texts pass.
    """
    count = min(max(PARITY_CELLS, 1 << len(hashes).bit_length()), MOST_PARITY_CELLS)
    odd = np.bincount((hashes & _U(count - 1)).astype(np.int64), minlength=count) % 2 == 1
    return np.packbits(odd).view(np.int64)


def folded(parity: pa.ListArray) -> np.ndarray:
    """The parities of some sets over as many cells as the smallest of them has, one set a row.

    A cell is named by the low bits of the hash, so the cells that a coarser cut holds together lie its count apart.
    """
    words, lengths = parity.flatten().to_numpy().view(_U), parity.value_lengths().to_numpy()
    least = lengths.min()
    starts = np.cumsum(lengths // least) - lengths // least
    return np.bitwise_xor.reduceat(words.reshape(-1, least), starts, axis=0)


def cells_apart(parity: np.ndarray, other: np.ndarray) -> np.ndarray:
    """In how many cells the parities in each row differ."""
    return np.bitwise_count(parity ^ other).sum(axis=1, dtype=np.int64)


class CountTree:
    """An R-tree over count vectors, bulk-loaded by halving along the widest coordinate.

    ``earlier`` are some blocks of each row, one a column; pairs with a common one below ``block`` are left to that block.
    """

    def __init__(
        self, points: np.ndarray, sizes: np.ndarray, groups: np.ndarray, parity: np.ndarray | None = None,
        earlier: np.ndarray | None = None, block: int = 0,
    ):
        self.points, self.sizes, self.groups, self.parity = points, sizes, groups, parity
        self.earlier, self.block = earlier, block
        self.root = self._load(np.arange(len(points)))

    def _load(self, rows: np.ndarray) -> tuple:
        """(rows or None, children, coordinate maxima, smallest size, smallest and largest group)."""
        points = self.points[rows]
        known = (points.max(axis=0), int(self.sizes[rows].min()), self.groups[rows].min(), self.groups[rows].max())
        if len(rows) <= LEAF:
            return (rows, (), *known)
        widest = int(np.argmax(points.max(axis=0) - points.min(axis=0)))
        order = rows[np.argsort(points[:, widest], kind="stable")]
        half = len(order) // 2
        return (None, (self._load(order[:half]), self._load(order[half:])), *known)

    def best(self, like: Likeness, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For every row its ``most`` best partners by bound, and whether there were more.

        Returns rows, partners, bounds, and per entry whether the row has partners left out.
        """
        rows, partners, scores = (np.empty(0, t) for t in (np.int64, np.int64, float))
        more = np.zeros(len(self.points), bool)
        waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def settle():
            nonlocal rows, partners, scores
            parts = [(rows, partners, scores), *waiting, *((b, a, s) for a, b, s in waiting)]
            rows, partners, scores = (np.concatenate(c) for c in zip(*parts))
            order = np.lexsort((partners, -scores, rows))
            rows, partners, scores = rows[order], partners[order], scores[order]
            first = np.concatenate([[True], rows[1:] != rows[:-1]]) if len(rows) else np.empty(0, bool)
            start = np.maximum.accumulate(np.where(first, np.arange(len(rows)), 0)) if len(rows) else rows
            keep = np.arange(len(rows)) - start < most
            more[rows[~keep]] = True
            rows, partners, scores = rows[keep], partners[keep], scores[keep]
            waiting.clear()

        held = 0
        for a, b, score in self.pairs(like):
            waiting.append((a, b, score))
            held += len(a)
            if held > 500_000:
                settle()
                held = 0
        settle()
        return rows, partners, scores, more[rows]

    def pairs(self, like: Likeness) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Pairs of rows of different groups that may be linked by summed minima and parities, each pair once, with the bound."""
        todo = [(self.root, self.root)]
        while todo:
            a, b = todo.pop()
            if a[4] == a[5] == b[4] == b[5]:
                continue  # one group already
            if np.minimum(a[2], b[2]).sum() < like.least_overlap(np.int64(a[3] + b[3])):
                continue
            if a[0] is not None and b[0] is not None:
                yield self._leaves(a[0], b[0], a is b, like)
            elif a is b:
                left, right = a[1]
                todo += [(left, left), (left, right), (right, right)]
            elif b[0] is not None or a[0] is None and a[3] >= b[3]:
                todo += [(child, b) for child in a[1]]
            else:
                todo += [(a, child) for child in b[1]]

    def _leaves(self, a: np.ndarray, b: np.ndarray, same: bool, like: Likeness):
        bound = np.minimum(self.points[a][:, None, :], self.points[b][None, :, :]).sum(axis=2)
        sizes = self.sizes[a][:, None] + self.sizes[b][None, :]
        keep = bound >= like.least_overlap(sizes)
        keep &= self.groups[a][:, None] != self.groups[b][None, :]
        if same:
            keep = np.triu(keep, 1)
        x, y = np.nonzero(keep)
        if self.parity is not None:
            near = like.may_differ(cells_apart(self.parity[a[x]], self.parity[b[y]]), sizes[x, y])
            x, y = x[near], y[near]
        if self.earlier is not None:
            of_a, of_b = self.earlier[a[x]], self.earlier[b[y]]
            met = ((of_a[:, :, None] == of_b[:, None, :]) & (of_a < self.block)[:, :, None]).any(axis=(1, 2))
            x, y = x[~met], y[~met]
        return a[x], b[y], bound[x, y] / sizes[x, y]


# --- Spark stages --------------------------------------------------------------------------

_SET_ID = ["n_shingles", "set_a", "set_b"]


def _set_ids(sets: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
    """Both halves of the 128-bit ids of sets."""
    with np.errstate(over="ignore"):
        a = np.array([mix(s).sum() for s in sets], _U).view(np.int64)
        b = np.array([mix(s ^ _U(0xA5A5A5A5A5A5A5A5)).sum() for s in sets], _U).view(np.int64)
    return pa.array(a), pa.array(b)


def signatures(df: DataFrame, like: Likeness) -> DataFrame:
    """Per row: doc_id, set size, 128-bit id of the set."""
    prepare(df.sparkSession)

    def run(batches):
        for batch in batches:
            sets = shingle_sets([(t or "").encode() for t in batch.column(1).to_pylist()], like.words)
            sizes = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, *_set_ids(sets)], names=["doc_id", *_SET_ID])

    return df.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint")


def _texts_of(df: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id and compressed text of the wanted documents."""
    return packed(df.filter(F.col("doc_id").isNotNull()), "doc_id").join(wanted, "doc_id", "left_semi")


def _keyed(df: DataFrame, wanted: DataFrame, like: Likeness) -> DataFrame:
    """(key, doc_id) of the wanted documents, each once however often its rows repeat."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            texts = unpack(batch.column(1))
            for low, high in chunks(texts):
                keys = [block_keys(s, like) for s in shingle_sets(texts[low:high], like.words)]
                owners = np.repeat(ids[low:high], [len(k) for k in keys])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(owners)], names=["key", "doc_id"])

    keyed = _texts_of(df, wanted).mapInArrow(run, "key bigint, doc_id bigint")
    return keyed.repartition("key").dropDuplicates(["key", "doc_id"])


def _sets(df: DataFrame, wanted: DataFrame, like: Likeness) -> DataFrame:
    """doc_id, set size and id, point, parities and compressed text of the wanted documents' rows."""

    def run(batches):
        for batch in batches:
            sets = shingle_sets(unpack(batch.column(1)), like.words)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([packed_point(point(s)) for s in sets], pa.binary()),
                    pa.array([parities(s) for s in sets], pa.list_(pa.int64())),
                    batch.column(1),
                    *_set_ids(sets),
                ],
                names=["doc_id", "size", "point", "parity", "packed", "set_a", "set_b"],
            )

    schema = "doc_id bigint, size bigint, point binary, parity array<bigint>, packed binary, set_a bigint, set_b bigint"
    return _texts_of(df, wanted).mapInArrow(run, schema)


def _joined(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    """The pairs (u, v) with their sizes (u_size, v_size) and one more column of both sets."""
    for end in ("u", "v"):
        side = sets.select(F.col("doc_id").alias(end), F.col("size").alias(f"{end}_size"), F.col(column).alias(f"{end}_{column}"))
        pairs = pairs.join(side, end)
    return pairs


def _ends(pairs: DataFrame) -> DataFrame:
    """The doc_id of every document of the pairs, once for each of them."""
    return pairs.select(F.explode(F.array("u", "v")).alias("doc_id"))


def _near(pairs: DataFrame, sets: DataFrame, like: Likeness) -> DataFrame:
    """The pairs (u, v) that parities do not rule out, so that few texts travel."""

    def run(batches):
        for batch in batches:
            sizes = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            odd = [
                cells_apart(*np.split(folded(pa.concat_arrays([u, v])), 2))[0]
                for u, v in ((batch.column(4).slice(i, 1), batch.column(5).slice(i, 1)) for i in range(batch.num_rows))
            ]
            yield batch.select([0, 1]).filter(pa.array(like.may_differ(np.array(odd, np.int64), sizes), pa.bool_()))

    joined = _joined(pairs, sets, "parity").select("u", "v", "u_size", "v_size", "u_parity", "v_parity")
    return joined.mapInArrow(run, "u bigint, v bigint")


def _verified(pairs: DataFrame, sets: DataFrame, like: Likeness) -> DataFrame:
    """The pairs (u, v) whose sets are linked, once for each two sets."""

    def run(batches):
        for batch in batches:
            u_sets, v_sets = (shingle_sets(unpack(batch.column(c)), like.words) for c in (2, 3))
            sizes = np.array([len(u) + len(v) for u, v in zip(u_sets, v_sets)], np.int64)
            shared = np.array([len(np.intersect1d(u, v, assume_unique=True)) for u, v in zip(u_sets, v_sets)], np.int64)
            yield batch.select([0, 1]).filter(pa.array(like.linked(shared, sizes), pa.bool_()))

    pairs = stored(pairs)
    named = sets.join(stored(_ends(pairs)), "doc_id", "left_semi")  # broadcast where few are named, so that few texts travel
    texts = _joined(pairs, named, "packed").select("u", "v", "u_packed", "v_packed")
    return texts.mapInArrow(run, "u bigint, v bigint")


def _tree_pairs(rows: DataFrame, like: Likeness, most: int) -> DataFrame:
    """Pairs (u, v, more) from the trees of the blocks: the best partners of every document.

    ``rows`` are (key, doc_id, component, size, point, parity); ``more`` says that a document
    has partners beyond its ``most`` best ones. Pairs that are no links are as many as the
    square of a block's documents, so parities drop them here and not behind a shuffle.
    With the smallest keys of a document in ``earlier``, a pair comes from the first block it
    shares among them and not from every one.
    """
    if "earlier" not in rows.columns:
        rows = rows.withColumn("earlier", F.array().cast("array<bigint>"))
    names = ["doc_id", "partner", "bound", "more"]

    def best(
        key: int, ids: np.ndarray, component: np.ndarray, sizes: np.ndarray, points: list[bytes], parity: np.ndarray, earlier: pa.Array
    ) -> pa.RecordBatch:
        others = np.full((len(ids), EARLIER_BLOCKS), key)  # its own key stands for none
        given = earlier.flatten().to_numpy()
        lengths = earlier.value_lengths().to_numpy()
        others[np.arange(EARLIER_BLOCKS) < lengths[:, None]] = given
        a, b, bound, more = CountTree(unpacked_points(points), sizes, component, parity, others, key).best(like, most)
        return pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b]), pa.array(bound), pa.array(more)], names=names)

    def run(batches):
        held: pa.Table | None = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            held = part if held is None else pa.concat_tables([held, part])
            keys = held.column("key").to_numpy()
            # The last block may go on in the next batch.
            whole = int(np.searchsorted(keys, keys[-1]))
            yield from blocks(held.slice(0, whole))
            held = held.slice(whole)
        if held is not None:
            yield from blocks(held)

    def blocks(rows: pa.Table):
        if not rows.num_rows:
            return
        keys, ids, component, sizes = (rows.column(c).to_numpy() for c in ("key", "doc_id", "component", "size"))
        points = rows.column("point").to_pylist()
        parity = rows.column("parity").combine_chunks()
        earlier = rows.column("earlier").combine_chunks()
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
            at = slice(low, high)
            words, others = folded(parity.slice(low, high - low)), earlier.slice(low, high - low)
            yield best(keys[low], ids[at], component[at], sizes[at], points[at], words, others)

    dealt = rows.select("key", "doc_id", "component", "size", "point", "parity", "earlier").repartition("key").sortWithinPartitions("key")
    partners = dealt.mapInArrow(run, "doc_id bigint, partner bigint, bound double, more boolean")
    partners = partners.groupBy("doc_id", "partner").agg(F.max("bound").alias("bound"), F.max("more").alias("more"))
    order = Window.partitionBy("doc_id").orderBy(F.desc("bound"), "partner")
    placed = partners.withColumns(
        {"place": F.row_number().over(order), "left_out": F.max("more").over(Window.partitionBy("doc_id"))}
    )
    tried = placed.filter(F.col("place") <= most + 1)  # one beyond them shows that there are more
    ends = [F.least("doc_id", "partner").alias("u"), F.greatest("doc_id", "partner").alias("v")]
    beyond = F.col("left_out") | (F.col("place") > most)
    return tried.select(*ends, beyond.alias("more")).groupBy("u", "v").agg(F.max("more").alias("more"))


def _open_rows(members: DataFrame, sets: DataFrame, found: DataFrame) -> DataFrame:
    """(key, doc_id, component, size, point, parity, earlier) of the blocks that hold more than one component.

    ``earlier`` are the document's ``EARLIER_BLOCKS`` smallest keys of such blocks.
    """
    placed = members.select("key", "doc_id").join(found, "doc_id", "left")
    placed = placed.withColumn("component", F.coalesce("component", "doc_id"))
    blocks = placed.groupBy("key").agg(
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("doc_id")).alias("first"),
        F.bit_xor(F.xxhash64(F.lit(1), "doc_id")).alias("second"),
    )
    # Blocks with the same members are one.
    apart = blocks.filter("low != high").groupBy("n", "first", "second").agg(F.min("key").alias("key"))
    rows = placed.join(apart.select("key"), "key", "left_semi")
    kept = rows.groupBy("doc_id", "component").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    each = kept.join(sets.select("doc_id", "size", "point", "parity"), "doc_id")
    earlier = F.slice("keys", 1, EARLIER_BLOCKS).alias("earlier")
    return each.select(F.explode("keys").alias("key"), "doc_id", "component", "size", "point", "parity", earlier)


def _in_blocks(keyed: DataFrame) -> DataFrame:
    """(key, doc_id, before): members of blocks with at least two documents, and the member before each."""
    order = Window.partitionBy("key").orderBy("doc_id")
    placed = keyed.select(
        "key", "doc_id", F.lag("doc_id").over(order).alias("before"), F.lead("doc_id").over(order).alias("after")
    )
    return placed.filter(F.col("before").isNotNull() | F.col("after").isNotNull()).drop("after")


def linked_groups(df: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest doc_id reachable by links).

    Null, empty and blank texts have no shingles and are linked with nothing. Rows with a
    null doc_id are linked with nothing either and have a null component. Rows with one
    doc_id are one document; its links are those of all its texts.
    """
    known = stored(signatures(df, like))
    some = known.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    representatives = some.groupBy(*_SET_ID).agg(F.min("doc_id").alias("doc_id"))
    members = stored(_in_blocks(_keyed(df, representatives, like)))
    sets = stored(_sets(df, members.select("doc_id").distinct(), like))
    repeated = some.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    repeats = not repeated.isEmpty()
    if repeats:
        sets = stored(sets.dropDuplicates(["doc_id", "size", "set_a", "set_b"]))

    # Chains: every document with the one that is before it in most of its blocks.
    before = members.filter("before IS NOT NULL").groupBy("doc_id", "before").count()
    chain = before.groupBy("doc_id").agg(F.max_by("before", F.struct("count", "before")).alias("before"))
    neighbours = chain.select(F.col("before").alias("u"), F.col("doc_id").alias("v"))
    links = stored(_verified(_near(neighbours, sets, like), sets, like))
    if repeats:
        # A document of several sets holds their first documents together.
        own_sets = some.join(repeated, "doc_id", "left_semi").join(representatives.withColumnRenamed("doc_id", "u"), _SET_ID)
        links = links.unionByName(own_sets.select("u", F.col("doc_id").alias("v")).filter("u != v").distinct())
    found = stored(connected_components(links).select(F.col("node").alias("doc_id"), "component"))

    # Blocks that hold several components still: their trees. Every document tries its best
    # partners of other components; linked ones merge, and the next round tries more, until
    # no document has partners left out. Both documents of a pair that was left out have
    # partners left out, so only these go on; what was tried before and is apart is no link.
    most, past = FIRST_PARTNERS, None
    while True:
        tried = stored(_tree_pairs(_open_rows(members, sets, found), like, most))
        pairs = tried.select("u", "v")
        new = pairs if past is None else pairs.join(past, ["u", "v"], "left_anti")
        found = _merge(found, stored(_verified(new, sets, like)))
        more = tried.filter("more")
        if more.isEmpty():
            break
        going_on = stored(_ends(more))
        members, sets = (stored(rows.join(going_on, "doc_id", "left_semi")) for rows in (members, sets))
        most, past = most * MORE_PARTNERS, pairs if past is None else past.unionByName(pairs)

    same_set = some.groupBy(*_SET_ID).agg(F.min("doc_id").alias("first_doc"))
    out = known.select("doc_id", *_SET_ID).join(same_set, _SET_ID, "left")
    out = out.join(found.select(F.col("doc_id").alias("first_doc"), "component"), "first_doc", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "first_doc", "doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"))


def _merge(found: DataFrame, more: DataFrame) -> DataFrame:
    """Components after further links between their documents."""
    if more.isEmpty():
        return found

    def component_of(column: str) -> DataFrame:
        named = found.select(F.col("doc_id").alias(column), F.col("component").alias(f"{column}_component"))
        return named

    edges = more.join(component_of("u"), "u", "left").join(component_of("v"), "v", "left").select(
        F.coalesce("u_component", "u").alias("u"), F.coalesce("v_component", "v").alias("v")
    )
    merged = connected_components(edges).select(F.col("node").alias("component"), F.col("component").alias("smallest"))
    alone = merged.select(F.col("component").alias("doc_id"), "component").join(found, "doc_id", "left_anti")
    everyone = found.select("doc_id", "component").unionByName(alone)
    return stored(
        everyone.join(merged, "component", "left").select("doc_id", F.coalesce("smallest", "component").alias("component"))
    )


def one_of_each(df: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of ``df`` whose document stands for its group, all columns; repeated rows of it go too.

    Rows with a null doc_id stay.
    """
    kept = groups.filter("doc_id = component_id").select("doc_id").distinct()
    named = df.filter(F.col("doc_id").isNotNull()).join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.select(*df.columns).unionByName(df.filter(F.col("doc_id").isNull()))
