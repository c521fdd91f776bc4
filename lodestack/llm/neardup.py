"""MinHash near-duplicates with tensored banding.

Two collections of m pairs of minhashes each are combined into m * m table keys,
so 4 * m minhashes serve m * m tables of four minhashes; with m = 14 two sets at
a similarity of 0.75 miss all 196 tables about once in 40,000 times, and share
about sixty of them.

Equal shingle sets are one node.  Candidates are nodes that share a table key;
each is confirmed on the full sets, in three steps, so that no step lists all
pairs of a large group:

1. In the buckets of a few tables every node is compared with the bucket's
   smallest; that joins groups of near copies, a row a node and bucket.
2. In the buckets of all tables that still hold several components, the nodes are
   compared with a node of another component.
3. Nodes of buckets that are mixed even then are compared with all others of
   these by a prefix filter, which is exact: shingles are ordered from rare to
   frequent, where those that only one component has count as rarest; two sets
   can only be linked if they share one of the first n - ceil(0.75 * n) + 1 of
   each.  Nodes that share none are done.  The others form clusters, in which
   each node outside the cluster's largest component is compared with all nodes
   of other components, in bounded blocks.

With ``exact`` the third step takes all nodes, so that no link can be missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, docs_of, list_array, release, stored, text_parts
from .graph import components
from .textwords import Words, mix, shingles

#: Pairs of minhashes in each of the two collections, and those of them that the first step uses.
PAIRS, FIRST_PAIRS = 14, 5
HASHES = 4 * PAIRS
#: Shingles on each side of a block.
BLOCK_SHINGLES = 1 << 20


def similar_least(percent: int) -> int:
    """The fewest equal minhashes of HASHES for a likely pair: five standard deviations below the mean at that similarity.

    In the first two steps an unlikely pair isn't looked up; the third meets it again.
    """
    p = percent / 100
    return max(1, int(HASHES * p - 5 * (HASHES * p * (1 - p)) ** 0.5))


def signatures(docs: DataFrame, size: int = 5) -> DataFrame:
    """doc_id, n (distinct shingles), digest of the set (two numbers) and minhashes of every whole text."""
    factor = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    shift = mix(factor)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_parts(batches):
            sets = shingles(Words(texts), size)
            mins = np.zeros((len(sets), HASHES), np.uint64)
            first = np.zeros(len(sets), np.uint64)
            second = np.zeros(len(sets), np.uint64)
            for k, s in enumerate(sets):
                if not len(s):
                    continue
                low = np.full(HASHES, np.uint64(2**64 - 1))
                for a in range(0, len(s), 4096):
                    np.minimum(low, ((s[a : a + 4096, None] ^ shift) * factor).min(axis=0), out=low)
                mins[k] = low
                first[k], second[k] = mix(s).sum(), mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum()
            n = np.array([len(s) for s in sets], np.int64)
            small = (mins >> np.uint64(32)).astype(np.uint32).view(np.int32)
            yield pa.record_batch([part.column(0), pa.array(n), pa.array(first.view(np.int64)), pa.array(second.view(np.int64)), list_array(small.ravel(), np.full(len(sets), HASHES), pa.int32())], ["doc_id", "n", "d1", "d2", "mins"])

    return docs_of(docs).mapInArrow(run, "doc_id long, n long, d1 long, d2 long, mins array<int>")


def shingle_sets(docs: DataFrame, size: int = 5) -> DataFrame:
    """doc_id, n, a digest and the sorted set of hashed shingles of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_parts(batches):
            sets = shingles(Words(texts), size)
            n = np.array([len(s) for s in sets], np.int64)
            digest = np.array([mix(s).sum() for s in sets], np.uint64).view(np.int64)
            yield pa.record_batch([part.column(0), pa.array(n), pa.array(digest), list_array(np.concatenate(sets).view(np.int64), n, pa.int64())], ["doc_id", "n", "d1", "shingles"])

    return docs_of(docs).mapInArrow(run, "doc_id long, n long, d1 long, shingles array<long>")


def _half(side: int, pairs: int = PAIRS) -> F.Column:
    """The numbers of one collection: each from two minhashes."""
    base = 2 * PAIRS * side
    return F.array(*(F.xxhash64(F.col("mins")[base + 2 * i], F.col("mins")[base + 2 * i + 1], F.lit(i)) for i in range(pairs)))


def table_keys(nodes: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """key, and id and component: each node's key in every table of the first ``pairs`` pairs of both collections."""
    one = nodes.select("id", "component", _half(1, pairs).alias("_b"), F.explode(_half(0, pairs)).alias("_x"))
    return one.select("id", "component", "_x", F.explode("_b").alias("_y")).select(F.xxhash64("_x", "_y").alias("key"), "id", "component")


class Forest:
    """Union-find over small numbers; ``edges`` has the pairs that joined two trees."""

    def __init__(self, n: int):
        self.up = list(range(n))
        self.edges: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, x: int, y: int) -> bool:
        a, b = self.root(x), self.root(y)
        if a != b:
            self.up[b] = a
            self.edges.append((x, y))
        return a != b


def _segments(values: np.ndarray) -> list[tuple[int, int]]:
    cuts = (np.flatnonzero(values[1:] != values[:-1]) + 1).tolist()
    return list(zip([0, *cuts], [*cuts, len(values)], strict=True)) if len(values) else []


def shared_only(nodes: DataFrame) -> DataFrame:
    """Nodes whose number in the first collection is met twice at some place; the others share no table."""
    rows = nodes.select("id", F.explode(_half(0)).alias("_x"))
    twice = rows.groupBy("_x").agg(F.min("id").alias("_lo"), F.max("id").alias("_hi")).where("_lo < _hi").select("_x")
    met = stored(rows.join(twice, "_x").select("id").distinct(), "met")
    return nodes.join(met, "id")


def confirmed(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are links by their full sets; those that the minhashes make unlikely are not looked up."""
    own = nodes.select("id", "n", "mins")
    for end in ("a", "b"):
        pairs = pairs.join(own.select(F.col("id").alias(end), F.col("n").alias(f"n_{end}"), F.col("mins").alias(f"m_{end}")), end)
    alike = F.size(F.filter(F.zip_with("m_a", "m_b", lambda x, y: x == y), lambda x: x))
    likely = (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")) & (alike >= similar_least(percent))
    found = stored(pairs.where(likely).select("a", "b").distinct(), "pairs")
    for end in ("a", "b"):
        found = found.join(sets.select(F.col("id").alias(end), F.col("n").alias(f"n_{end}"), F.col("shingles").alias(f"s_{end}")), end)
    both = F.size(F.array_intersect("s_a", "s_b"))
    return stored(found.where(100 * both >= percent * (F.col("n_a") + F.col("n_b") - both)).select("a", "b"), "links")


def _named(nodes: DataFrame, label: DataFrame) -> DataFrame:
    """``nodes`` with the components that ``label`` gives, or their own ids."""
    return nodes.drop("component").join(bounded(label), "id", "left").withColumn("component", F.coalesce("component", "id"))


def prefix_clusters(sets: DataFrame, percent: int) -> DataFrame:
    """id and cluster of the nodes that share a shingle of their prefixes with a node of another component.

    ``sets``: id, component, d1, n and shingles.  Two sets of different
    components that are linked are always in one cluster.
    """
    rows = sets.select("id", "component", "d1", "n", F.explode("shingles").alias("s"))
    counts = rows.groupBy("s").agg(F.count("*").alias("c"), F.min("component").alias("_lo"), F.max("component").alias("_hi")).where("_lo < _hi").select("s", "c")
    counts = stored(counts, "shingle-counts")  # shingles of one component come first and need no place
    mine = Window.partitionBy("id", "d1")  # a document's own shingles
    placed = rows.join(counts, "s").withColumns({"_place": F.row_number().over(mine.orderBy("c", "s")), "_met": F.count("*").over(mine)})
    need = F.floor((percent * F.col("n") + 99) / 100)
    prefix = stored(placed.where(F.col("n") - F.col("_met") + F.col("_place") <= F.col("n") - need + 1).select("s", "id", "component"), "prefixes")
    hubs = prefix.groupBy("s").agg(F.min("id").alias("a"), F.min("component").alias("_lo"), F.max("component").alias("_hi")).where("_lo < _hi").select("s", "a")
    found = components(prefix.join(stored(hubs, "hubs"), "s").select("a", F.col("id").alias("b")).distinct())
    release(counts, prefix)
    return found.withColumnRenamed("component", "cluster")


def links_across(sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join all components of linked sets: a spanning forest of each block.

    ``sets``: id, component (of the links known so far), d1, n and shingles.
    """
    cluster = stored(prefix_clusters(sets, percent), "clusters")
    light = stored(sets.select("id", "component", "n").join(bounded(cluster), "id"), "clustered")
    each = light.groupBy("cluster", "component").agg(F.sum("n").alias("n"))
    sizes = each.groupBy("cluster").agg(F.sum("n").alias("total"), F.max(F.struct("n", "component")).alias("_top"))
    sizes = stored(sizes.select("cluster", "total", F.col("_top.component").alias("major"), (F.col("total") - F.col("_top.n")).alias("minor")).where("minor > 0"), "sizes")
    total = sizes.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    rows = sets.join(bounded(cluster), "id").join(bounded(sizes), "cluster")
    rows = rows.withColumns({"down": F.ceil(F.col("total") / BLOCK_SHINGLES).cast("int"), "across": F.ceil(F.col("minor") / BLOCK_SHINGLES).cast("int"), "probe": F.col("component") != F.col("major")})
    h = F.xxhash64("id", "d1")
    part = lambda n: F.pmod(h, F.col(n)).cast("int")
    to = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    # Clusters of one block are sent once, several in a group; of a larger one each row is sent as an index row to all probe blocks, and as a probe to all index blocks.
    place = lambda g, i, p, probe, index: F.struct(g.alias("g"), i.alias("i"), p.alias("p"), probe.alias("probe"), index.alias("index"))
    no, yes, zero = F.lit(False), F.lit(True), F.lit(0)
    small = F.array(place(F.pmod(F.xxhash64("cluster"), F.lit(1 + total // BLOCK_SHINGLES)), zero, zero, F.col("probe"), yes))
    index = F.transform(to("across"), lambda p: place(F.col("cluster"), part("down"), p, no, yes))
    probe = F.transform(to("down"), lambda i: place(F.col("cluster"), i, part("across"), yes, no))
    places = F.when(F.col("down") <= 1, small).when(F.col("probe"), F.concat(index, probe)).otherwise(index)
    dealt = rows.select("cluster", "id", "component", "shingles", (F.col("down") > 1).alias("cut"), F.explode(places).alias("_to")).select("cluster", "id", "component", "shingles", "cut", "_to.*")

    def compare(group: pa.Table) -> pa.Table:
        group = group.sort_by([("cluster", "ascending"), ("id", "ascending")]).combine_chunks()
        cluster, ids, comp = (group[c].to_numpy() for c in ("cluster", "id", "component"))
        probe, index = (group[c].to_numpy(zero_copy_only=False) for c in ("probe", "index"))
        size = pc.list_value_length(group["shingles"]).to_numpy().astype(np.int64)
        flat = np.concatenate([c.flatten().to_numpy() for c in group["shingles"].chunks])
        start = np.cumsum(size) - size
        out: list[tuple[int, int]] = []
        for a, b in _segments(cluster):
            lo, hi = int(start[a]), int(start[b - 1] + size[b - 1])
            words, local = np.unique(flat[lo:hi], return_inverse=True)
            first = start[a:b] - lo
            forest = Forest(b - a)
            for rows_of in _segments(order := np.sort(comp[a:b])):
                same = np.flatnonzero(comp[a:b] == order[rows_of[0]])
                for y in same[1:].tolist():
                    forest.up[y] = int(same[0])
            mark = np.zeros(len(words), bool)
            for x in np.flatnonzero(probe[a:b]).tolist():
                mine = local[first[x] : first[x] + size[a + x]]
                mark[mine] = True
                both = np.add.reduceat(mark[local].astype(np.int32), first)
                mark[mine] = False
                ok = (100 * both >= percent * (size[a + x] + size[a:b] - both)) & index[a:b] & (comp[a:b] != comp[a + x])
                for y in np.flatnonzero(ok).tolist():
                    if forest.join(x, y):
                        out.append((int(ids[a + x]), int(ids[a + y])))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return stored(dealt.groupBy("g", "cut", "i", "p").applyInArrow(compare, "a long, b long"), "links")


def _linked(docs: DataFrame, nodes: DataFrame, percent: int, size: int, exact: bool) -> DataFrame:
    """id and component of the nodes (id, n, mins) that have links, in the three steps."""
    alone = nodes.withColumn("component", F.col("id"))

    # Step 1, in few tables.
    rows = table_keys(alone, FIRST_PAIRS)
    bucket = rows.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("_hi")).where("a < _hi").select("key", "a")
    pairs = stored(rows.join(stored(bucket, "buckets"), "key").where("id != a").select("a", F.col("id").alias("b")).distinct(), "pairs")
    ids = nodes.select(F.col("id").alias("doc_id")).distinct()
    sets = stored(shingle_sets(docs.join(ids, "doc_id", "left_semi"), size).where("n > 0").dropDuplicates(["doc_id", "d1"]).withColumnRenamed("doc_id", "id"), "sets")
    links = confirmed(pairs, nodes, sets, percent)
    label = components(links)

    # Step 2, in all tables, where a bucket holds several components.
    rows = table_keys(_named(nodes, label))
    several = rows.groupBy("key").agg(F.min(F.struct(F.xxhash64("id").alias("_h"), F.col("id").alias("a"), F.col("component").alias("of"))).alias("_m"), F.min("component").alias("_lo"), F.max("component").alias("_hi")).where("_lo < _hi").select("key", "_m.a", "_m.of")
    mixed = stored(rows.join(stored(several, "mixed-buckets"), "key").select("key", "id", "component", "a", "of"), "mixed")
    if not mixed.isEmpty():
        more = confirmed(mixed.where("component != of").select("a", F.col("id").alias("b")).distinct(), nodes, sets, percent)
        links = links.unionByName(more)
        label = components(links)

    # Step 3, what is mixed even now.
    rows = _named(mixed.select("key", "id"), label)
    several = rows.groupBy("key").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi")).where("_lo < _hi").select("key")
    rest = nodes.select("id") if exact else rows.join(stored(several, "mixed-buckets"), "key").select("id")
    rest = stored(rest.distinct(), "rest")
    release(mixed, pairs)
    if not rest.isEmpty():
        left = stored(_named(sets.join(rest, "id"), label), "rest-sets")
        links = links.unionByName(links_across(left, percent))
        label = components(links)
        release(left)
    return label


def near_duplicates(docs: DataFrame, percent: int = 75, size: int = 5, exact: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id and kept.

    Documents are linked if 100 * intersection >= percent * union of their sets
    of distinct shingles (``size`` words; fewer words: the whole sequence).
    component_id is the smallest doc_id reachable by links, itself included.
    A null, empty or blank text has an empty set and no link.  Rows that share a
    doc_id count as one document with several texts.  A row with a null doc_id
    gets the component of its equals, or null, and isn't kept.  An empty table
    gives no row; other columns are left out.  With ``exact`` no link is missed,
    at the cost of a prefix join over all documents.
    """
    docs = docs_of(docs)
    sig = stored(signatures(docs, size), "signatures")
    # Stored, so that a set with many copies is a join side that Spark can split.
    classes = stored(sig.where("n > 0").groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("id")), "classes")
    member = stored(sig.select("doc_id", "n", "d1", "d2").join(classes, ["d1", "d2", "n"], "left").select("doc_id", "n", F.coalesce("id", "doc_id").alias("id")), "members")
    nodes = sig.join(classes.where("id IS NOT NULL").select(F.col("id").alias("doc_id"), "d1", "d2", "n"), ["doc_id", "d1", "d2", "n"], "left_semi")
    nodes = stored(nodes.dropDuplicates(["doc_id", "d1", "d2"]).select(F.col("doc_id").alias("id"), "n", "mins"), "nodes")
    release(sig, classes)
    if not exact:
        every, nodes = nodes, stored(shared_only(nodes), "nodes")
        release(every)
    label = _linked(docs, nodes, percent, size, exact) if not nodes.isEmpty() else nodes.select("id", F.col("id").alias("component"))
    out = member.join(label, "id", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
