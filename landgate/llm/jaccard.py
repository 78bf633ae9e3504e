"""Groups of documents linked by the Jaccard similarity of their 5-word shingles, by signature trees.

1. Every text's shingles are hashed to 64 bits. Equal sets are one node from here on, so copies cost nothing.
2. Every set gets KEYS keys; a key is made of KEY_PARTS of the set's MINIMA minima, each the smallest of its
   numbers after multiplication by one constant. Two sets of similarity 0.75 miss each other in all keys
   with a chance below 1e-9, more similar ones with less. A task keeps one row per key and links other
   holders to the first, so what is shuffled of a common key is a row per batch. Components of sets that
   share keys are clusters.
3. The sets of a cluster are arranged in signature trees, and a dual traversal finds links. A large cluster
   is dealt into chunks of bounded size. After the links within chunks, one set of every group of each
   chunk meets the others, which joins groups that lie in several chunks. What a cluster then still
   holds besides its largest group meets all its chunks, tree against tree, one pair of chunks a task.
4. Components of the links are the groups.

No pair is expanded that is connected already, no task holds more than two chunks, and ids, links and
components stay distributed. Only the ids of candidate documents are sent to all executors, if there
are few; more of them are joined instead.

Defined results: without words or text n_shingles is 0 and the document is linked with nothing; with fewer
words than a shingle the whole sequence is one; equal texts are in one group; rows that share a doc_id are
documents of their own; a null doc_id takes no part and gets a null component; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landgate.llm import words as W
from landgate.llm.batches import measured
from landgate.llm.components import components
from landgate.llm.signature_tree import Groups, links
from landgate.llm.tables import stored, table

SHINGLE = 5
#: Keys of a set; minima that one is made of; minima of a set; the draw of multipliers and minima.
KEYS, KEY_PARTS, MINIMA, SEED = 120, 5, 256, 20240
#: Most numbers, and most sets, in one chunk or one bin of small clusters.
CHUNK_NUMBERS, CHUNK_SETS = 1 << 20, 2048
#: Most candidate documents whose ids are broadcast (16 bytes each in memory).
BROADCAST_IDS = 1 << 20


def shingle_sets(column: pa.Array, size: int = SHINGLE):
    """(numbers, first) for each slice of texts: text i has the sorted numbers[first[i]:first[i + 1]]."""
    for texts in W.slices(column):
        data = W.LOWER[texts.data]
        found = W.spans(texts, W.NOT_SPACE[data])
        hashes = W.span_hashes(data, found)
        grams, at = W.gram_hashes(hashes, found.text, size)
        owner = found.text[at]
        n_words = found.per_text(len(texts))
        few = np.flatnonzero((n_words > 0) & (n_words < size))
        if len(few):
            first = np.searchsorted(found.text, few)
            whole = np.zeros(len(few), np.uint64)
            for k in range(size - 1):
                more = n_words[few] > k
                whole[more] = whole[more] * W.GRAM + hashes[first[more] + k]
            whole = W.mixed(whole + n_words[few].astype(np.uint64))
            grams, owner = np.concatenate((grams, whole)), np.concatenate((owner, few))
        order = np.lexsort((grams, owner))
        grams, owner = grams[order], owner[order]
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
        grams, owner = grams[new], owner[new]
        yield grams, np.searchsorted(owner, np.arange(len(texts) + 1))


def node_names(numbers: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(W.mixed(numbers ^ W.BASE), dtype=np.uint64)))
    size = np.diff(first).astype(np.uint64)
    return W.mixed((total[first[1:]] - total[first[:-1]]) ^ (size * W.GRAM)).view(np.int64)


def set_keys(numbers: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The keys of each set, (sets, KEYS); no set is empty."""
    draw = np.random.default_rng(SEED)
    factors = draw.integers(1, 1 << 62, MINIMA).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    parts = np.stack([draw.choice(MINIMA, KEY_PARTS, replace=False) for _ in range(KEYS)])
    minima = np.stack([np.minimum.reduceat(numbers * f, first[:-1]) for f in factors])
    keys = np.zeros((KEYS, len(first) - 1), np.uint64)
    for k in range(KEY_PARTS):
        keys = keys * W.GRAM + W.mixed(minima[parts[:, k]])
    return W.mixed(keys).T


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, n, node, keys, near): set size, name of the set, the keys that no set before it in its
    batch has, and the sets before it that have the other ones."""

    def measure(column: pa.Array) -> dict:
        sizes, names, keys = [], [], []
        for numbers, first in shingle_sets(column):
            size = np.diff(first)
            name = node_names(numbers, first)
            held = np.flatnonzero(size)
            own = np.zeros((len(size), KEYS), np.uint64)
            if len(held):
                own[held] = set_keys(numbers, np.append(first[:-1][held], first[-1]))
            sizes.append(size)
            names.append(name)
            keys.append(own)
        if not sizes:
            return {"n": [], "node": [], "keys": [], "near": []}
        size, name, keys = np.concatenate(sizes), np.concatenate(names), np.concatenate(keys)
        held = np.flatnonzero(size)
        held = held[np.unique(name[held], return_index=True)[1]]
        flat = keys[held].ravel()
        _, at, which = np.unique(flat, return_index=True, return_inverse=True)
        is_first = np.zeros(len(flat), bool)
        is_first[at] = True
        before = name[held][(at // KEYS)[which]].reshape(-1, KEYS)
        is_first = is_first.reshape(-1, KEYS)
        new: list = [None] * len(size)
        near: list = [None] * len(size)
        for i, row in enumerate(held.tolist()):
            new[row] = keys[row][is_first[i]].view(np.int64)
            near[row] = np.setdiff1d(before[i][~is_first[i]], name[row])
        return {"n": size, "node": [v if n else None for v, n in zip(name.tolist(), size, strict=True)], "keys": new, "near": near}

    return measured(docs, measure, "n long, node long, keys array<long>, near array<long>")


def clusters(found: DataFrame) -> DataFrame:
    """(node, component): components of sets that share a key; sets that share none are left out."""
    rows = found.select("node", F.explode("keys").alias("key"))
    least = F.first("node").over(Window.partitionBy("key").orderBy("node"))
    shared = rows.select("node", least.alias("other")).filter("node <> other")
    near = found.select("node", F.explode("near").alias("other"))
    edges = shared.union(near).select(F.col("node").alias("a"), F.col("other").alias("b"))
    return components(edges, "jaccard-clusters")


def candidate_sets(docs: DataFrame, found: DataFrame, grouped: DataFrame) -> DataFrame:
    """(cluster, node, n, numbers): the sets of all clusters, each once, numbers as bytes."""
    one = found.filter("doc_id IS NOT NULL AND node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    wanted = one.join(grouped, "node").select("doc_id", F.col("node").alias("_node"), F.col("component").alias("_cluster"))
    wanted = stored(wanted, "jaccard-candidates")
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    texts = docs.select("doc_id", "text").join(wanted, "doc_id")

    def measure(column: pa.Array) -> dict:
        out: dict[str, list] = {"n": [], "name": [], "numbers": []}
        for numbers, first in shingle_sets(column):
            out["name"] += node_names(numbers, first).tolist()
            out["n"] += np.diff(first).tolist()
            out["numbers"] += [numbers[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
        return out

    sets = measured(texts, measure, "n long, name long, numbers binary", keep=("_cluster", "_node"))
    sets = sets.filter("name = _node")
    return sets.select(F.col("_cluster").alias("cluster"), F.col("_node").alias("node"), "n", "numbers")


def dealt(sets: DataFrame) -> DataFrame:
    """``sets`` with (unit, chunks): small clusters share bins, larger ones are dealt into chunks."""
    size = sets.groupBy("cluster").agg(F.sum("n").alias("_n"), F.count("*").alias("_sets"))
    chunks = F.greatest(F.ceil(F.col("_n") / CHUNK_NUMBERS), F.ceil(F.col("_sets") / CHUNK_SETS))
    size = size.select("cluster", "_n", "_sets", chunks.cast("int").alias("chunks"))
    total = size.filter("chunks = 1").agg(F.sum("_n"), F.sum("_sets")).first()
    bins = max(1, -(-2 * (total[0] or 0) // CHUNK_NUMBERS), -(-2 * (total[1] or 0) // CHUNK_SETS))
    small = F.pmod(F.xxhash64("cluster"), F.lit(bins))
    large = F.xxhash64("cluster", F.pmod(F.xxhash64("node"), F.col("chunks")))
    unit = F.when(F.col("chunks") == 1, small).otherwise(large)
    return sets.join(size.select("cluster", "chunks"), "cluster").withColumn("unit", unit)


def _numbers(column) -> list[np.ndarray]:
    return [np.frombuffer(b, np.uint64) for b in column]


def inner_links(units: DataFrame) -> DataFrame:
    """(a, b): each set that is linked within its unit, with the first set of its group there."""

    def run(rows):
        out = []
        for _, own in rows.groupby("cluster", sort=True):
            if len(own) > 1:
                own = own.sort_values("node")
                node = own["node"].tolist()
                groups = Groups(list(range(len(node))))
                for i, j in links(_numbers(own["numbers"])):
                    groups.join(i, j)
                out += [(node[i], node[root]) for i, root in enumerate(groups.roots().tolist()) if i != root]
        return type(rows)({"a": [a for a, _ in out], "b": [b for _, b in out]}, dtype="int64")

    rows = units.select("unit", "cluster", "node", "numbers")
    return rows.groupBy("unit").applyInPandas(run, "a long, b long")


def cross_links(left: DataFrame, right: DataFrame) -> DataFrame:
    """(a, b): links between rows of ``left`` and ``right`` (unit, node, numbers, grp) of one unit."""

    def run(some, others):
        out = []
        if len(some) and len(others):
            some, others = some.sort_values("node"), others.sort_values("node")
            node = [*some["node"].tolist(), *others["node"].tolist()]
            pairs = links(
                _numbers(some["numbers"]), some["grp"].tolist(), _numbers(others["numbers"]), others["grp"].tolist()
            )
            out = [(node[i], node[j]) for i, j in pairs]
        return type(some)({"a": [a for a, _ in out], "b": [b for _, b in out]}, dtype="int64")

    own = [F.col(c).alias(c) for c in ("unit", "node", "numbers", "grp")]  # both sides may come of one table
    sides = [df.select(*own).groupBy("unit") for df in (left, right)]
    return sides[0].cogroup(sides[1]).applyInPandas(run, "a long, b long")


def large_cluster_groups(large: DataFrame, found: DataFrame) -> DataFrame:
    """(node, component) of all links: those ``found`` within units, and those between the chunks of
    large clusters (cluster, node, n, numbers, chunks)."""
    ones = large
    for _ in range(3):  # sets that stand for their group in a chunk meet those of the other chunks
        absorbed = found.select(F.col("a").alias("node")).distinct()
        ones = ones.drop("chunks", "unit").join(absorbed, "node", "left_anti")
        ones = stored(dealt(ones), "jaccard-ones")
        found = stored(found.union(inner_links(ones)), "jaccard-links")
        if ones.filter("chunks > 1").isEmpty():
            break
    groups = stored(components(found, "jaccard-groups"), "jaccard-groups")
    known = groups.select("node", F.col("component").alias("_grp"))
    grouped = large.join(known, "node", "left").withColumn("grp", F.coalesce("_grp", "node")).drop("_grp", "unit")

    sizes = grouped.groupBy("cluster", "grp").agg(F.sum("n").alias("n"), F.count("*").alias("sets"))
    main = sizes.groupBy("cluster").agg(
        F.max_by("grp", F.struct("n", "grp")).alias("main"), F.count("*").alias("groups")
    )
    main = main.filter("groups > 1").drop("groups")
    rest_size = sizes.join(main, "cluster").filter("grp <> main").groupBy("cluster")
    rest_size = rest_size.agg(F.sum("n").alias("n"), F.sum("sets").alias("sets"))
    parts = F.greatest(F.ceil(F.col("n") / CHUNK_NUMBERS), F.ceil(F.col("sets") / CHUNK_SETS)).cast("int")
    main = stored(main.join(rest_size.select("cluster", parts.alias("parts")), "cluster"), "jaccard-rest")
    if main.isEmpty():
        return groups
    open_ = stored(grouped.join(main, "cluster"), "jaccard-open")
    part, chunk = F.pmod(F.xxhash64("node"), F.col("parts")), F.pmod(F.xxhash64("node"), F.col("chunks"))
    rest = open_.filter("grp <> main").withColumn("part", part.cast("int"))
    rest = rest.withColumn("chunk", F.explode(F.expr("sequence(0, chunks - 1)")))
    whole = open_.withColumn("chunk", chunk.cast("int"))
    whole = whole.withColumn("part", F.explode(F.expr("sequence(0, parts - 1)")))
    unit = F.xxhash64("cluster", "part", "chunk").alias("unit")
    own = ("node", "numbers", "grp")
    across = stored(cross_links(rest.select(unit, *own), whole.select(unit, *own)), "jaccard-links")
    return groups if across.isEmpty() else components(found.union(across), "jaccard-groups")


def linked_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, node, first_node) for every row of ``docs`` (doc_id, text): also the
    name of its set, and that of the set by which its group has the component_id."""
    docs = docs.select("doc_id", "text")
    found = stored(keyed(docs), "jaccard-keys")
    grouped = stored(clusters(found), "jaccard-clusters")
    sets = stored(candidate_sets(docs, found, grouped), "jaccard-sets")
    units = dealt(sets)
    linked = stored(inner_links(units), "jaccard-links")
    large = units.filter("chunks > 1")
    groups = components(linked, "jaccard-groups") if large.isEmpty() else large_cluster_groups(large, linked)
    nodes = found.filter("node IS NOT NULL AND doc_id IS NOT NULL")
    nodes = nodes.groupBy("node").agg(F.min("doc_id").alias("first"))
    nodes = nodes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    firsts = nodes.groupBy("component").agg(F.min(F.struct("first", "node")).alias("_first"))
    firsts = firsts.select("component", F.col("_first.first").alias("component_id"), F.col("_first.node").alias("first_node"))
    named = nodes.join(firsts, "component").select("node", "component_id", "first_node")
    rows = found.select("doc_id", "n", "node").join(named, "node", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"), "node", "first_node")


def jaccard_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text)."""
    return linked_rows(docs).select("doc_id", "n_shingles", "component_id")


def with_nodes(docs: DataFrame) -> DataFrame:
    """(doc_id, _hash, _row, node): the rows of ``docs`` with the names of their sets."""

    def measure(column: pa.Array) -> dict:
        names: list = []
        for numbers, first in shingle_sets(column):
            sized = zip(node_names(numbers, first).tolist(), np.diff(first), strict=True)
            names += [name if size else None for name, size in sized]
        return {"node": names}

    row = F.struct(*[docs[c] for c in docs.columns]).alias("_row")
    rows = docs.select("doc_id", F.xxhash64(*docs.columns).alias("_hash"), row, "text")
    return measured(rows, measure, "node long", keep=("doc_id", "_hash", "_row"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of every group of ``docs``, of the smallest doc_id.

    Rows that share a doc_id are judged each by its own text; of those left in one group the set with the
    smallest name stays, and of its rows the one with the smallest hash of all columns. Rows without a
    doc_id or without words stay, as they are in no group.
    """
    stays = F.expr("node IS NULL OR (doc_id = component_id AND node = first_node)").alias("stays")
    found = linked_rows(docs).filter("doc_id IS NOT NULL").select("doc_id", "node", stays)
    found = stored(found, "jaccard-kept")
    gone = found.filter("NOT stays").select("doc_id").distinct()
    again = stored(found.groupBy("doc_id").count().filter("count > 1").select("doc_id"), "jaccard-again")
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    left = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    n_again = again.count()
    if not n_again:
        return left
    if n_again <= BROADCAST_IDS:
        again = F.broadcast(again)
    out = found.filter("NOT stays").join(again, "doc_id", "left_semi").select("doc_id", "node").distinct()
    rows = with_nodes(docs.join(again, "doc_id", "left_semi").select(*docs.columns))
    rows = rows.join(out, ["doc_id", "node"], "left_anti")
    firsts = rows.filter("node IS NOT NULL").groupBy("doc_id", "node").agg(F.min_by("_row", "_hash").alias("_row"))
    repeated = rows.filter("node IS NULL").select("_row.*").union(firsts.select("_row.*"))
    return left.join(again, "doc_id", "left_anti").select(*docs.columns).union(repeated)


def op6_signature_tree(spark, sf_dir):
    return jaccard_groups(table(spark, sf_dir, "documents"))


QUERIES = {"op6_signature_tree": (op6_signature_tree, None)}
