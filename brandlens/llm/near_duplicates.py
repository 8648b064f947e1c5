"""Near duplicates: a Jaccard join of shingle sets by token-combination prefixes, and its classes.

A document's set holds the hashes of its distinct five-word shingles. Two sets link when their
Jaccard similarity is at least 0.75. Linked sets form classes, named by their smallest doc_id.

Prefixes. Sets are ordered by (frequent or not, hash). A set of n may differ from a partner in
u = n - ceil(0.75 n) of its own elements, so among u + 1 of its first elements one is shared. Rare
elements are indexed one by one. If a set has fewer than u + 1 rare elements, its prefix is
extended by frequent ones, which are parted into classes by hash, and pairs of elements of one
class are indexed: a class of c elements counts c - 1, as sharing two of them is what is asked
for. Classes depend on the size band of the larger set, so a set is indexed for each band in which
a partner may lie. Frequent means that the element's cell of a fixed table of counts over all
documents holds over twice the mean load; that only steers the order, any order gives all links.

Verification. Equal sets are one node. A node is first compared with one leader of its index
entries only; groups of copies thereby fall into few components. Then every two nodes
that share an entry but not a component are counted over their entries; pairs that cannot reach
the threshold by length, by the number of shared prefix elements or by their parities are left out,
and the rest are compared. A set's parities tell for each of 512 cells whether an odd number of its
elements fall there: cells that differ between two sets are no more than elements that differ. No link between components can be missed, links inside a component change nothing.

Hashes have 64 bits; a set's name is a 64-bit hash of its elements.

Cases: a null, empty or blank text has the empty set and is linked with nothing; with one to four
words the whole sequence is the one shingle; rows without doc_id have no component and name none;
rows with one doc_id but other texts are rows of their own; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .components import components
from .shared import drop_staged, partitions, slices, staged, text_column
from .sketches import count_chunks, marked, occurrence_bits, total_counts
from .text_hash import Stretches, joined, mixed, words

WORDS = 5
_COUNT_BITS = 20
_STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
_FACTS = "doc_id long, n long, node long, chunk int, counts binary"
_SALTS = 16
_CELLS = 512
_PAIRS = "a long, b long, m long, n long, common long"
# Nodes of a leader that one task compares with as many others.
_BLOCK_NODES = 1024


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Each text's set as rising unsigned 64-bit hashes."""
    buffer, begins = joined([t.encode() for t in texts])
    start, end = words(buffer)
    word = Stretches(buffer, lower=True).hashes(start, end)
    first = np.searchsorted(start, begins)
    if len(word) >= WORDS:
        m = len(word) - WORDS + 1
        runs = np.zeros(m, dtype=np.uint64)
        for k in range(WORDS):
            runs += word[k:m + k] * _STEPS[k]
        runs = mixed(runs)
    out = []
    for low, high in zip(first[:-1], first[1:]):
        if high - low >= WORDS:
            out.append(np.unique(runs[low:high - WORDS + 1]))
        elif high > low:
            out.append(mixed((word[low:high] * _STEPS[:high - low]).sum(keepdims=True) + np.uint64(high - low)))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def _node(tokens: np.ndarray) -> np.uint64:
    """A name of the set."""
    return mixed(mixed(tokens).sum(keepdims=True) + np.uint64(len(tokens)))[0]


def parities(tokens: np.ndarray) -> bytes:
    """Of each of 512 cells, whether an odd number of elements fall there."""
    return np.packbits(np.bincount((tokens % np.uint64(_CELLS)).astype(np.int64), minlength=_CELLS) & 1).tobytes()


def _facts(docs: DataFrame) -> DataFrame:
    """A row for each document with its size, node and parities, and rows with each task's counts of
    elements (those with a chunk)."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << _COUNT_BITS, dtype=np.int64)
        for batch in batches:
            for rows in slices(batch):
                sets = shingle_sets(text_column(rows))
                counts += np.bincount((np.concatenate(sets) >> np.uint64(64 - _COUNT_BITS)).astype(np.int64), minlength=len(counts))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(np.array([_node(s) for s in sets], dtype=np.uint64).view(np.int64)),
                     pa.nulls(rows.num_rows, pa.int32()), pa.array([parities(s) for s in sets], pa.binary())], names=["doc_id", "n", "node", "chunk", "counts"])
        chunks = count_chunks(counts)
        none = pa.nulls(chunks.num_rows, pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, *chunks.columns], names=["doc_id", "n", "node", "chunk", "counts"])

    return staged(docs.mapInArrow(read, _FACTS), "shingle-facts")


def _bands(n: int) -> range:
    """Size bands (powers of two) in which the larger set of a linked pair with a set of n may lie."""
    return range(n.bit_length(), (n * 4 // 3).bit_length() + 1)


def index_entries(tokens: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Index entries of a set: even numbers for rare elements, odd ones for pairs of frequent elements."""
    n = len(tokens)
    if n < 1:
        return np.empty(0, dtype=np.uint64)
    need = n - -(-3 * n // 4) + 1
    rare = tokens[~frequent][:need]
    out = [rare & ~np.uint64(1)]
    if len(rare) < need:
        often = tokens[frequent]
        for band in _bands(n):
            parts = max(1, (1 << band) // 16)
            part = (mixed(often + np.uint64(band)) % np.uint64(parts)).astype(np.int64)
            # An element counts if one of its class is in the prefix already.
            order = np.argsort(part, kind="stable")
            opens = np.ones(len(often), dtype=bool)
            opens[1:] = part[order][1:] != part[order][:-1]
            counts = np.ones(len(often), dtype=np.int64)
            counts[order[opens]] = 0
            last = int(np.searchsorted(np.cumsum(counts), need - len(rare))) + 1
            chosen, part = often[:last], part[:last]
            order = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.diff(part[order])) + 1
            for group in np.split(chosen[order], cuts):
                i, j = np.triu_indices(len(group), 1)
                out.append(mixed(group[i] * _STEPS[0] + group[j] * _STEPS[1] + np.uint64(band)) | np.uint64(1))
    return np.concatenate(out)


def _entries(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """(entry, node, size, weight): weight is the number of frequent elements of the set."""
    limit = 2 * counts.mean() + 64
    table = docs.sparkSession.sparkContext.broadcast(np.packbits(counts > limit))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for rows in slices(batch):
                entries, nodes, sizes, weights = [], [], [], []
                for tokens in shingle_sets(text_column(rows)):
                    node = _node(tokens)
                    if node in seen or not len(tokens):
                        continue
                    # Equal sets met again in a task need no second entry; the memory starts anew when full.
                    if len(seen) >= 200_000:
                        seen.clear()
                    seen.add(node)
                    frequent = marked(table.value, tokens, _COUNT_BITS)
                    own = index_entries(tokens, frequent)
                    entries.append(own)
                    nodes.append(np.full(len(own), node))
                    sizes.append(np.full(len(own), len(tokens), dtype=np.int32))
                    weights.append(np.full(len(own), frequent.sum(), dtype=np.int32))
                if entries:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(entries).view(np.int64)), pa.array(np.concatenate(nodes).view(np.int64)),
                         pa.array(np.concatenate(sizes)), pa.array(np.concatenate(weights))], names=["entry", "node", "size", "weight"])

    return docs.select("text").mapInArrow(emit, "entry long, node long, size int, weight int")


def _shared_entries(entries: DataFrame) -> DataFrame:
    """Entries of two nodes or more, with the leader of each: the node with most frequent elements,
    since of a group of edited copies that is one of the least edited.

    An entry of frequent elements may be hot: it is dealt over salts, and its salts' leaders meet
    in a second, small step.
    """
    pair = F.col("entry").bitwiseAND(F.lit(1)) == 1
    salted = entries.withColumn("salt", F.when(pair, F.pmod("node", F.lit(_SALTS))).otherwise(F.lit(0)))
    own = Window.partitionBy("entry", "salt")
    led = (salted.withColumn("led", F.max(F.struct("weight", "node", "size")).over(own))
           .withColumn("low", F.min("node").over(own)).withColumn("high", F.max("node").over(own)))
    return led.filter(pair | (F.col("low") != F.col("high"))).select("entry", "node", "size", "led")


def _behind(n: Column) -> Column:
    """Elements of a set of n behind the first u + 1."""
    return F.ceil(n * 3 / 4) - 1


def _may_link(m: Column, n: Column, common: Column) -> Column:
    """Whether sets of m and n elements with at most so many common entries can reach the threshold.

    Shared elements of the prefix that ends first are counted: rare ones have an entry each, and of
    a class of frequent ones all but one have at least one; the one is what the class added to the
    prefix. What lies behind may be shared as a whole.
    """
    return (175 * F.least(m, n) >= 75 * (m + n)) & (175 * (common + F.greatest(_behind(m), _behind(n))) >= 75 * (m + n))


def _star_pairs(shared: DataFrame) -> DataFrame:
    """(a, b): each node with the leader with which it shares most entries.

    Leaders of salts are compared with their entries' leaders in the same way. Pairs left out here
    are met later.
    """
    direct = shared.select("led", "node", "size")
    leaders = shared.filter(F.col("entry").bitwiseAND(F.lit(1)) == 1).select("entry", "led").distinct()
    upper = leaders.groupBy("entry").agg(F.max("led").alias("top"), F.count("*").alias("k")).filter("k > 1").select("entry", "top")
    second = leaders.join(upper, "entry").select(F.col("top").alias("led"), F.col("led.node").alias("node"), F.col("led.size").alias("size"))
    counted = direct.unionByName(second).filter("node != led.node").groupBy("led", "node", "size").agg(F.count("*").alias("common"))
    return (counted.filter(_may_link(F.col("led.size"), F.col("size"), F.col("common")))
            .groupBy(F.col("node").alias("b")).agg(F.max(F.struct("common", F.col("led.node").alias("a"))).alias("best")).select("best.a", "b"))


def _open_pairs(shared: DataFrame, labels: DataFrame, bits: DataFrame) -> DataFrame:
    """Pairs of nodes that share an entry but no component and may reach the threshold.

    Entries with one leader (over all salts) are counted together, since near copies share many of
    them. A leader's nodes are dealt over blocks of a bounded number, and every two of its blocks
    meet in one group, which holds a row for each of its nodes, with the node's entries. A
    pair leaves it once, unless it cannot reach the threshold even if all its other entries were
    shared. ``bits`` has the parities of nodes.
    """
    known = shared.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    several = (known.groupBy("entry").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.max("led").alias("top"))
               .filter("low != high").select("entry", F.col("top.node").alias("leader")))
    rows = staged(known.join(several, "entry").select("leader", "entry", "node", "size", "label").distinct(), "open-rows")
    most = rows.groupBy("node").agg(F.count("*").alias("most"))
    own_bits = bits.join(most.select("node"), "node", "left_semi").groupBy("node").agg(F.first("bits").alias("bits"))
    # No more entries than the node's own prefix has.
    members = staged(rows.groupBy("leader", "node", "size", "label").agg(F.collect_list("entry").alias("entries"))
                     .join(most, "node").join(own_bits, "node"), "open-nodes")
    # Written, so that the join knows its size: only leaders of several blocks.
    parts = staged(members.groupBy("leader").agg(F.ceil(F.count("*") / _BLOCK_NODES).alias("parts")).filter("parts > 1"), "open-parts")

    placed = members.join(parts, "leader", "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("own", F.pmod(F.xxhash64("node"), "parts"))
    # Each block of a leader meets each other one, and itself, once.
    dealt = (placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
             .withColumn("x", F.least("own", "other")).withColumn("y", F.greatest("own", "other")))
    groups = (dealt.select("leader", "x", "y", "node", "own", "size", "label", "most", "bits", "entries")
              .repartition(partitions(shared.sparkSession), "leader", "x", "y").sortWithinPartitions("leader", "x", "y"))
    counted = groups.mapInArrow(_count_pairs, _PAIRS).groupBy("a", "b", "m", "n").agg(F.sum("common").alias("common"))
    return counted.filter(_may_link(F.col("m"), F.col("n"), F.col("common"))).select("a", "b")


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of each group (leader, x, y) with their numbers of common entries in it."""
    held: list[pa.RecordBatch] = []
    key: tuple[int, ...] = ()
    for batch in batches:
        keys = np.stack([np.asarray(batch.column(c)) for c in ("leader", "x", "y")])
        cuts = np.flatnonzero((np.diff(keys) != 0).any(axis=0)) + 1
        for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
            if high == low:
                continue
            own = tuple(keys[:, low].tolist())
            if held and own != key:
                yield _pairs_of_group(pa.Table.from_batches(held), key[1] == key[2])
                held = []
            key = own
            held.append(batch.slice(int(low), int(high - low)))
    if held:
        yield _pairs_of_group(pa.Table.from_batches(held), key[1] == key[2])


def _pairs_of_group(rows: pa.Table, one_block: bool) -> pa.RecordBatch:
    """Pairs of the nodes of a group, each a row with its entries."""
    order = np.argsort(np.asarray(rows["node"]))
    nodes, own, size, label, most = (np.asarray(rows[c])[order] for c in ("node", "own", "size", "label", "most"))
    bits = np.frombuffer(b"".join(rows["bits"].to_pylist()), dtype=np.uint8).reshape(-1, _CELLS // 8)[order]
    size = size.astype(np.int64)
    lists = rows["entries"].take(pa.array(order))
    entry, at = np.asarray(pc.list_flatten(lists)), np.repeat(np.arange(len(nodes)), np.asarray(pc.list_value_length(lists)))
    by_entry = np.argsort(entry, kind="stable")
    entry, at = entry[by_entry], at[by_entry]
    here = np.bincount(at, minlength=len(nodes))
    total: dict[int, int] = {}
    keys: list[np.ndarray] = []
    held = 0

    def add() -> None:
        codes, n = np.unique(np.concatenate(keys), return_counts=True)
        for code, k in zip(codes.tolist(), n.tolist()):
            total[code] = total.get(code, 0) + k

    for members_ in np.split(at, np.flatnonzero(np.diff(entry)) + 1):
        # Nodes in order, one of each label pair; two blocks meet across, a block meets itself.
        members_ = np.sort(members_)
        i, j = np.triu_indices(len(members_), 1)
        i, j = members_[i], members_[j]
        m, n = size[i], size[j]
        fit = (label[i] != label[j]) & (175 * np.minimum(m, n) >= 75 * (m + n))
        if not one_block:
            fit &= own[i] != own[j]
        i, j, m, n = i[fit], j[fit], m[fit], n[fit]
        behind = np.maximum(-(-3 * m // 4), -(-3 * n // 4)) - 1
        fit = 175 * (np.minimum(most[i], most[j]) + behind) >= 75 * (m + n)
        keys.append(i[fit] * len(nodes) + j[fit])
        held += len(keys[-1])
        if held > 2_000_000:
            add()
            keys, held = [], 0
    if keys:
        add()
    codes = np.fromiter(total, dtype=np.int64, count=len(total))
    common = np.fromiter(total.values(), dtype=np.int64, count=len(total))
    i, j = codes // len(nodes), codes % len(nodes)
    m, n = size[i], size[j]
    behind = np.maximum(-(-3 * m // 4), -(-3 * n // 4)) - 1
    elsewhere = np.minimum(most[i] - here[i], most[j] - here[j])
    fit = 175 * (common + elsewhere + behind) >= 75 * (m + n)
    # Linked sets of m and n elements differ in at most (m + n) / 7.
    for low in range(0, len(i), 1 << 16):
        part = slice(low, low + (1 << 16))
        fit[part] &= 7 * np.bitwise_count(bits[i[part]] ^ bits[j[part]]).sum(axis=1, dtype=np.int64) <= m[part] + n[part]
    return pa.RecordBatch.from_arrays([pa.array(v[fit]) for v in (nodes[i], nodes[j], m, n, common)], names=["a", "b", "m", "n", "common"])


def _links(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those pairs (a, b) whose sets are similar enough, by their whole sets.

    The sets of b are sent to a's, over salts so that a node of many pairs is split.
    """
    written = staged(pairs, "pairs")
    pairs = written.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(_SALTS)))
    asked = (pairs.select(F.col("b").alias("node"), "a", "salt", F.lit(1).alias("role"))
             .unionByName(pairs.select(F.col("a").alias("node"), "a", "salt", F.lit(0).alias("role")).distinct()))
    table = docs.sparkSession.sparkContext.broadcast(occurrence_bits(asked.select("node").distinct()))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for rows in slices(batch):
                nodes, sets = [], []
                for tokens in shingle_sets(text_column(rows)):
                    node = _node(tokens)
                    if len(tokens) and node not in seen and marked(table.value, np.array([node]))[0]:
                        if len(seen) >= 200_000:
                            seen.clear()
                        seen.add(node)
                        nodes.append(node)
                        sets.append(tokens.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(np.array(nodes, dtype=np.uint64).view(np.int64)), pa.array(sets, pa.binary())], names=["node", "tokens"])

    sets = docs.select("text").mapInArrow(emit, "node long, tokens binary").groupBy("node").agg(F.first("tokens").alias("tokens"))
    rows = sets.join(asked, "node").repartition(partitions(docs.sparkSession), "a", "salt").sortWithinPartitions("a", "salt", "role")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = np.empty(0, dtype=np.uint64)
        for batch in batches:
            found: list[tuple[int, int]] = []
            for a, b, role, tokens in zip(*(batch.column(c).to_pylist() for c in ("a", "node", "role", "tokens"))):
                own = np.frombuffer(tokens, dtype=np.uint64)
                if role == 0:
                    head = own
                    continue
                both = len(np.intersect1d(head, own, assume_unique=True))
                if 100 * both >= 75 * (len(head) + len(own) - both):
                    found.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    links = staged(rows.select("a", "salt", "role", "node", "tokens").mapInArrow(compare, "a long, b long"), "links")
    drop_staged(written)
    return links


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of each document (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    facts = _facts(docs)
    rows = facts.filter(F.col("chunk").isNull()).select("doc_id", "n", "node")
    bits = facts.filter(F.col("chunk").isNull()).select("node", F.col("counts").alias("bits"))
    counts = total_counts(facts.filter(F.col("chunk").isNotNull()).select("chunk", "counts"), _COUNT_BITS)
    shared = staged(_shared_entries(_entries(docs, counts)), "shared-entries")
    first = _links(docs, _star_pairs(shared))
    second = _links(docs, _open_pairs(shared, components(first), bits))
    drop_staged(shared)
    labels = components(first.unionByName(second))
    named = (rows.filter(F.col("n") > 0).join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))
    # A class is as large as its copies are many: it is summed up before the shuffle, and rows meet only its name.
    names = named.groupBy("label").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("k")).filter("k > 1").select("label", "component_id")
    alone = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    whole = rows.join(labels, "node", "left").withColumn("label", F.when(F.col("n") > 0, F.coalesce("label", "node")))
    return whole.join(names, "label", "left").select("doc_id", F.col("n").alias("n_shingles"), alone.alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """docs with the first row of each class: the smallest doc_id, null ones last, then text and key.

    Each row is on its own, also one of equal rows or one without doc_id. Rows without words stay.
    """
    # Written once, so that a row has the same key wherever it is read.
    keyed = staged(docs.select(F.struct(*docs.columns).alias("row"), F.monotonically_increasing_id().alias("key")), "keyed")
    classes = staged(near_duplicates(keyed.select(F.col("key").alias("doc_id"), "row.text")).select(
        F.col("doc_id").alias("key"), F.col("component_id").alias("class")), "classes")
    doc = F.col("row.doc_id").cast("long")
    order = keyed.select("key", F.struct(doc.isNull().alias("no_id"), doc.alias("id"), F.xxhash64(F.col("row.text").cast("string")).alias("hash"), "key").alias("order"))
    # Written, so that the join knows its size: only classes of several rows.
    firsts = staged(classes.join(order, "key").groupBy("class").agg(F.min("order").alias("first"), F.count("*").alias("k"))
                    .filter("k > 1").select("class", F.col("first.key").alias("first")), "firsts")
    gone = classes.join(firsts, "class").filter("key != first").select("key")
    return keyed.join(gone, "key", "left_anti").select("row.*")
