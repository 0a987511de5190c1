"""MinHash near-duplicates by a signature-coordinate inverted join.

A document's set is its distinct word shingles. Documents of equal sets form a
class, and one of each class goes on. Its signature has ``COORDINATES``
minima; each is posted under its coordinate and value. Two sets of similarity
0.8 agree in at least ``MATCHES`` coordinates but for one pair in millions
(binomial tail), and then share one of the ``COORDINATES - MATCHES + 1`` rarest
postings of either (one rarity order for all: count, then value). Only these
prefixes are joined; the frequent postings are skipped, and counted only for
pairs that meet in a prefix, by comparing the signatures.

Groups of thousands of near copies are not enumerated as pairs: first every
member of a posting list meets a few hubs of the list. What is confirmed is
joined to components; a node's cluster is the component of most nodes that it
agrees with in enough coordinates. Two steps then cover all that is left: inside a cluster, the
members outside its largest component are compared with all members, tile by
tile, and only links come out; between clusters, pairs that share a prefix
posting are made, each once (in their least common posting), by letting the
members outside a list's largest cluster meet all others. So no link between
components is missed, and none is looked for inside one. Links are confirmed on
the full sets, read again from the texts of the documents that need it.

Defined cases: null, empty and white-space texts have the empty set, link with
nothing and stay; texts with fewer words than a shingle have one shingle, the
whole sequence; equal rows and equal texts share a class; a null id stays, links
with nothing and has no component id; ids may repeat. An empty table gives no
rows. Only id and text are read. Long texts are hashed in parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from insight.llm.common import arrow_map, parts, utf8, written

#: Length of a signature, and coordinates that must agree.
COORDINATES = 48
MATCHES = 24
#: Links need NUM * |union| <= DEN * |intersection|.
NUM, DEN = 80, 100
#: Hubs that a member of a posting list meets.
HUBS = 4
#: Nodes, and bytes of their sets, in a tile of a cluster.
TILE_NODES, TILE_BYTES = 256, 16 << 20
SALTS = 32
_RNG = np.random.Generator(np.random.PCG64(20_260_101))
ODD = _RNG.integers(1, 1 << 62, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
STEP = np.uint64(0x9E3779B97F4A7C15)
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def shingle_set(data: bytes, width: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text's words, A-Z in lower case."""
    hashes = []
    for part in parts(data.lower()):
        words = part.split()
        hashes.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
    h = np.concatenate(hashes)
    if not len(h):
        return h
    n = min(width, len(h))
    v = np.full(len(h) - n + 1, n, np.uint64)
    for j in range(n):
        v = mixed(v * STEP + h[j:len(h) - n + 1 + j])
    return np.unique(v)


def signature(s: np.ndarray) -> np.ndarray:
    """One value per coordinate, told apart by the coordinate too."""
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), 4096):
        x = s[None, at:at + 4096] * ODD[:, None]
        x ^= x >> np.uint64(29)
        x *= M1
        np.minimum(low, x.min(axis=1), out=low)
    return mixed(low + np.arange(1, COORDINATES + 1, dtype=np.uint64) * STEP)


def sketch(sig: np.ndarray) -> bytes:
    """One byte of each coordinate: equal coordinates have equal bytes."""
    return (sig & np.uint64(255)).astype(np.uint8).tobytes()


def print_of(s: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return xxhash.xxh3_128_digest(s.tobytes())


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return DEN * both >= NUM * (len(a) + len(b) - both)


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, node, sig, sketch) of every row; the last three null for empty sets."""
    id_type = docs.dtypes[0][1]

    def run(batch: pa.RecordBatch) -> dict:
        sizes, nodes, sigs, sketches = [], [], [], []
        for text in batch.column(1):
            s = shingle_set(utf8(text.as_py()), width)
            sig = signature(s) if len(s) else None
            sizes.append(len(s))
            nodes.append(print_of(s) if len(s) else None)
            sigs.append(sig.view(np.int64) if len(s) else None)
            sketches.append(sketch(sig) if len(s) else None)
        return {"doc_id": batch.column(0), "n_shingles": pa.array(sizes, pa.int64()), "node": pa.array(nodes, pa.binary()),
                "sig": pa.array(sigs, pa.list_(pa.int64())), "sketch": pa.array(sketches, pa.binary())}

    return arrow_map(docs, run, f"doc_id {id_type}, n_shingles bigint, node binary, sig array<bigint>, sketch binary")


def classes_of(sigs: DataFrame) -> DataFrame:
    """One row per distinct non-empty set: node, least id, n, sig, sketch."""
    return (sigs.filter("n_shingles > 0 and doc_id is not null").groupBy("node")
            .agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n"),
                 F.first("sig").alias("sig"), F.first("sketch").alias("sketch")))


def prefixes(classes: DataFrame) -> DataFrame:
    """(elem, node, n, sketch): each node's rarest postings, those that no other node has left out.

    A node's postings that are its own are its rarest; they use up places of
    its prefix but can meet nobody. Postings are ranked under a short hash of
    the node, as they are by far the most rows of the whole join.
    """
    short = F.xxhash64("node").alias("short")
    posted = classes.select(short, F.explode("sig").alias("elem"))
    shared = posted.groupBy("elem").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    held = posted.join(shared, "elem")
    # all postings - shared ones = own ones; the prefix has COORDINATES - MATCHES + 1 places
    mine = W.partitionBy("short")
    kept = (held.withColumn("rank", F.row_number().over(mine.orderBy("df", "elem")))
            .withColumn("shared", F.count(F.lit(1)).over(mine))
            .filter(F.col("rank") + COORDINATES - F.col("shared") <= COORDINATES - MATCHES + 1)
            .select("short", "elem"))
    return kept.join(classes.select(short, "node", "n", "sketch"), "short").drop("short")


def similar_size(a: str, b: str) -> F.Column:
    small, large = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    return DEN * small >= NUM * large


def colliding(pairs: DataFrame) -> DataFrame:
    """Distinct (a, b), a < b, of (node, sketch, other, other_sketch) that agree in enough coordinates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, COORDINATES) for c in (1, 3))
                kept = batch.filter(pa.array((a == b).sum(axis=1) >= MATCHES))
                yield pa.RecordBatch.from_pydict({"a": kept.column(0), "b": kept.column(2)})

    return (pairs.select("node", "sketch", "other", "other_sketch").mapInArrow(run, "a binary, b binary")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def hub_pairs(posts: DataFrame) -> DataFrame:
    """Each member of a list against the list's hubs, the members least by seeded hashes."""
    def hub(seed: int) -> F.Column:
        return F.min(F.struct(F.xxhash64(F.lit(seed), "node").alias("h"), "node", "n", "sketch"))

    hubs = posts.groupBy("elem").agg(F.count(F.lit(1)).alias("size"), *[hub(s).alias(f"hub{s}") for s in range(HUBS)])
    hubs = hubs.filter("size > 1").select("elem", F.array(*[f"hub{s}" for s in range(HUBS)]).alias("hubs"))
    met = posts.join(hubs, "elem").select("node", "n", "sketch", F.explode(F.array_distinct("hubs")).alias("hub"))
    met = met.select("node", "n", "sketch", F.col("hub.node").alias("other"), F.col("hub.n").alias("other_n"),
                     F.col("hub.sketch").alias("other_sketch"))
    return met.filter((F.col("node") != F.col("other")) & similar_size("n", "other_n"))


def cross_pairs(posts: DataFrame, labels: DataFrame) -> DataFrame:
    """All pairs of a list that have different labels, each pair in its least common posting only.

    Per list, the members outside its largest label meet all others, so the
    nodes of a label, however many, are never paired with each other.
    """
    posts = posts.join(labels, "node", "left").withColumn("label", F.coalesce("comp", "node")).drop("comp")
    sizes = posts.groupBy("elem", "label").agg(F.count(F.lit(1)).alias("size"))
    mixed_lists = (sizes.groupBy("elem").agg(F.max(F.struct("size", "label")).alias("top"), F.count(F.lit(1)).alias("n_labels"))
                   .filter("n_labels > 1").select("elem", F.col("top.label").alias("top")))
    open_posts = posts.join(mixed_lists, "elem")
    several = open_posts.groupBy("node", "label", "n", "sketch").agg(F.collect_list(F.struct("elem", "top")).alias("in"))
    several = several.withColumn("elems", F.transform("in", lambda x: x["elem"]))
    each = written(several.select("node", "label", "n", "sketch", "elems", F.explode("in").alias("l"))
                   .select("node", "label", "n", "sketch", "elems", F.col("l.elem").alias("elem"), F.col("l.top").alias("top")), "open-posts")
    minor = each.filter("label <> top")
    other = each.select(F.col("node").alias("other"), F.col("label").alias("other_label"), F.col("n").alias("other_n"),
                        F.col("sketch").alias("other_sketch"), F.col("elems").alias("other_elems"), F.col("elem").alias("other_elem"))
    once = (F.col("other_label") == F.col("top")) | (F.col("node") < F.col("other"))
    least = F.array_min(F.array_intersect("elems", "other_elems"))
    return minor.join(other, (F.col("elem") == F.col("other_elem")) & (F.col("label") != F.col("other_label")) & once
                      & similar_size("n", "other_n") & (F.col("elem") == least))


def texts_of(nodes: DataFrame, classes: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(node, words): the compressed words of one document of each node (of more, if its id repeats)."""
    wanted = classes.select("node", "first_id").join(nodes, "node", "left_semi")
    found = docs.join(wanted, docs["doc_id"] == wanted["first_id"]).withColumn("print", F.xxhash64("text"))
    found = found.dropDuplicates(["first_id", "node", "print"])  # dealt by id already: no shuffle

    def run(batch: pa.RecordBatch) -> dict:
        nodes, words = [], []
        for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            data = b" ".join(b" ".join(p.split()) for p in parts(utf8(text).lower()))
            if print_of(shingle_set(data, width)) == node:  # an id that repeats may have other texts
                nodes.append(node)
                words.append(zstandard.compress(data, 3))
        return {"node": pa.array(nodes, pa.binary()), "words": pa.array(words, pa.binary())}

    return arrow_map(found.select("node", "text"), run, "node binary, words binary")


def confirmed(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """The pairs whose full sets are similar enough; pairs without texts are left out."""
    full = (pairs.join(texts.select(F.col("node").alias("a"), F.col("words").alias("a_words")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("words").alias("b_words")), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, np.ndarray] = {}

        def of(node: bytes, words: bytes) -> np.ndarray:
            if node not in known:
                if len(known) >= 64:
                    known.clear()
                known[node] = shingle_set(zstandard.decompress(words), width)
            return known[node]

        for batch in batches:
            a, b, a_words, b_words = (batch.column(c).to_pylist() for c in range(4))
            keep = [linked(of(x, p), of(y, q)) for x, y, p, q in zip(a, b, a_words, b_words)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return full.select("a", "b", "a_words", "b_words").mapInArrow(run, "a binary, b binary")


def cluster_tiles(members: DataFrame) -> DataFrame:
    """(node, comp, cluster, n, sketch) -> the two sides to compare, dealt to tiles (cluster, i, j).

    ``minor`` rows are the nodes outside their cluster's largest component, the
    others all nodes of clusters with more than one component. Tiles are
    bounded in nodes and bytes, whatever the size of a cluster.
    """
    sizes = members.groupBy("cluster", "comp").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"))
    size, shingles = F.col("size"), F.col("shingles")

    def tiles(count: F.Column, total: F.Column) -> F.Column:
        return F.greatest(F.ceil(count / TILE_NODES), F.ceil(total * 8 / TILE_BYTES)).cast("int")

    top = sizes.groupBy("cluster").agg(
        F.max(F.struct("size", "comp", "shingles")).alias("top"), F.sum("size").alias("all"), F.sum("shingles").alias("total"),
        F.count(F.lit(1)).alias("comps")).filter("comps > 1")
    top = top.select("cluster", F.col("top.comp").alias("top"), tiles(F.col("all"), F.col("total")).alias("right_tiles"),
                     tiles(F.col("all") - F.col("top.size"), F.col("total") - F.col("top.shingles")).alias("left_tiles"))
    # a cluster may hold a third of all nodes: its nodes meet its row of figures under SALTS keys
    place = F.xxhash64("node")
    salted = top.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    open_nodes = members.withColumn("salt", F.pmod(place, F.lit(SALTS)).cast("int")).join(salted, ["cluster", "salt"])

    def dealt(minor: bool, own: str, other: str, own_tiles: str, other_tiles: str) -> DataFrame:
        rows = open_nodes.filter("comp <> top") if minor else open_nodes
        return rows.select("cluster", "node", "comp", "top", "n", "sketch", F.lit(minor).alias("minor"),
                           F.pmod(place, F.col(own_tiles)).cast("int").alias(own),
                           F.explode(F.sequence(F.lit(0), F.col(other_tiles) - 1)).alias(other))

    return dealt(True, "i", "j", "left_tiles", "right_tiles").unionByName(
        dealt(False, "j", "i", "right_tiles", "left_tiles"))


def links_in_clusters(members: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """(a, b) confirmed between different components of a cluster. ``members`` as of ``cluster_tiles``."""
    def run(tile: pd.DataFrame) -> pd.DataFrame:
        minor, all_ = tile[tile["minor"]], tile[~tile["minor"]]
        known: dict[bytes, np.ndarray] = {}

        def set_of(row) -> np.ndarray:
            if row.node not in known:
                known[row.node] = shingle_set(zstandard.decompress(row.words), width)
            return known[row.node]

        others = list(all_.itertuples(index=False))
        sketches = np.frombuffer(b"".join(all_["sketch"]), np.uint8).reshape(-1, COORDINATES)
        n = all_["n"].to_numpy()
        found = []
        for row in minor.itertuples(index=False):
            agree = (sketches == np.frombuffer(row.sketch, np.uint8)).sum(axis=1) >= MATCHES
            alike = DEN * np.minimum(n, row.n) >= NUM * np.maximum(n, row.n)
            for k in np.flatnonzero(agree & alike):
                other = others[k]
                # two nodes outside the largest component meet twice
                if other.comp != row.comp and (other.comp == row.top or row.node < other.node) \
                        and linked(set_of(row), set_of(other)):
                    found.append((min(row.node, other.node), max(row.node, other.node)))
        return pd.DataFrame(found, columns=["a", "b"])

    return cluster_tiles(members).join(texts, "node").groupBy("cluster", "i", "j").applyInPandas(run, "a binary, b binary")


def forest(edges: DataFrame) -> DataFrame:
    """Edges (u, v), u > v, of any graph to edges from each node to the least node of its component.

    Large and small stars in turn: every round cuts each node's neighbours
    over to the least of them. Edges are written each round, and the rounds end
    when each node has one edge and no node is at both ends.
    """
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(
            F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        edges = written(small.filter("u <> v").distinct(), "edges")
        ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                              F.struct(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e"))
        loose = ends.groupBy("e.x").agg(F.sum("e.up").alias("up"), F.max("e.down").alias("down")).filter("up + down > 1")
        if loose.isEmpty():
            return edges


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(u, v) from each node linked by (a, b), or by edges known before, to its component's least node."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    return forest(edges.unionByName(known) if known is not None else edges)


def labels_of(edges: DataFrame) -> DataFrame:
    """(node, comp) of a forest's nodes, roots included."""
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def clusters_of(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """(node, comp): the component that most of the nodes a node collides with are in.

    Any split into clusters gives the same links; this one puts the copies of
    a text that link with nothing beside the copies that do.
    """
    met = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")),
                                         F.struct(F.col("b").alias("node"), F.col("a").alias("other")))).alias("m")).select("m.*")
    placed = met.join(comps.select(F.col("node").alias("other"), "comp"), "other", "left")
    votes = placed.groupBy("node", F.coalesce("comp", "other").alias("vote")).agg(F.count(F.lit(1)).alias("size"))
    return votes.groupBy("node").agg(F.max(F.struct("size", "vote")).alias("most")).select("node", F.col("most.vote").alias("comp"))


def all_links(classes: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(node, comp) of the classes that link with others."""
    posts = written(prefixes(classes), "postings")

    def nodes(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.explode(F.array("a", "b")).alias("node"))

    pairs = written(colliding(hub_pairs(posts)), "hub-pairs")
    texts = written(texts_of(nodes(pairs), classes, docs, width), "texts")
    edges = components(written(confirmed(pairs, texts, width), "hub-links"))
    comps = labels_of(edges)
    clusters = written(clusters_of(pairs, comps), "clusters")
    members = (clusters.select("node", F.col("comp").alias("cluster")).join(comps, "node", "left")
               .withColumn("comp", F.coalesce("comp", "node")).join(classes.select("node", "n", "sketch"), "node"))
    inside = written(links_in_clusters(members, texts, width), "cluster-links")
    pairs = written(colliding(cross_pairs(posts, clusters)), "cross-pairs")
    more = nodes(pairs).join(texts.select("node"), "node", "left_anti")
    texts = texts.unionByName(written(texts_of(more, classes, docs, width), "more-texts"))
    between = written(confirmed(pairs, texts, width), "cross-links")
    return labels_of(components(inside.unionByName(between), edges))


def near_duplicates(docs: DataFrame, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; links and components as told above."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sigs = written(signatures(docs, width), "signatures")
    classes = written(classes_of(sigs), "classes")
    labels = all_links(classes, docs, width)
    placed = (classes.select("node", "first_id").join(labels, "node", "left")
              .withColumn("comp", F.coalesce("comp", "node")))
    first = placed.groupBy("comp").agg(F.min("first_id").alias("least_id"))
    own = placed.join(first, "comp").select("node", F.col("least_id").alias("first_id"))
    out = sigs.select("doc_id", "n_shingles", "node").join(own, "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("first_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))
