"""N-gram Jaccard join with prefix trees (operator 9).

Documents are sets of word n-grams, each in one global order: n-grams that many documents
have stand last, all others go by name. Two sets that are similar enough share one of
their first few n-grams (their prefix), so:

1. Equal sets become one class; its smallest document stands for it.
2. Shards ask which prefix n-grams two classes have. All n-grams with the same list of
   classes are one bucket.
3. In a bucket, classes are held against one another by size and by a parity sketch,
   whose distance never exceeds the sets' difference, so no similar pair is dropped. A
   forest of the surviving pairs is verified first; then all surviving pairs that still
   lie in different components.
4. A short sketch says nothing of long sets. Pairs of such are held against one another by
   a sketch that grows with the set, before any set is sent anywhere.
5. Verification: the sets to be compared with one probe are stored in a prefix tree. The
   traversal carries the overlap with the probe down shared paths and leaves a subtree
   as soon as overlap and remaining length cannot reach what is needed.
6. Verified pairs are links; components are followed to the smallest document.

The result is components, not links: in buckets of any size, pairs that already lie in one
component are not verified, so the links, or their number, are not known. Candidates come
from the prefixes and sketches; the prefix tree only verifies.

A bucket or a probe with many sets is split into blocks of bounded size; pairs between the
blocks go through their leaders first and, where components differ, through copies of the
smaller side. Nothing is left out.

Defined cases: a null or empty text, or one without words, has an empty set and is linked
with nothing; a text of fewer words than an n-gram has its whole word sequence as its only
one; rows that share a doc_id are one document; rows with a null doc_id are one document
too, after all others; other columns do not matter; an empty table gives no rows. Names are
64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairmill.llm.common import components, lookup
from pairmill.llm.shards import (
    ANSWER,
    Answers,
    answered,
    ask,
    bucket_count,
    chunks,
    give_back,
    group_starts,
    grouped,
    pack_bytes,
    partitions,
    stable,
    summed,
    text_of,
    unpack_bytes,
    whole_groups,
    with_answers,
)
from pairmill.llm.textscan import SPACED, mix, pieces, scan, windows
from pairmill.session import durable

LAST_ID = np.iinfo(np.int64).max
# An n-gram that this share of the documents has goes to the end of the global order.
FREQUENT_SHARE = 0.0005
# ... counted where a shard has it in so many classes.
FREQUENT_IN_SHARD = 4
SKETCH_BITS = 1024
# Sets of more n-grams than this have a wide sketch too, of at least a bit for each n-gram.
WIDE_FROM = 1024
# Classes of a bucket, and sets of a prefix tree, that one task holds at a time.
BLOCK = 4096
TREE = 512
# Text read, and sets sent to trees, by one task at a time.
SENT_BYTES = 4 << 20
# Groups up to this size are compared all at once, so many pairs at a time.
SMALL_GROUP = 256
PAIRS = 1 << 17


def gram_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Each text's distinct n-grams, sorted by name."""
    words = scan(texts, SPACED, lower=True)
    names = windows(words.names, k)
    for a, z in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if z - a >= k:
            found = np.sort(names[a : z - k + 1])
            yield found[np.concatenate(([True], found[1:] != found[:-1]))]
        elif z > a:
            yield windows(words.names[a:z], z - a)
        else:
            yield np.empty(0, np.uint64)


def class_name(grams: np.ndarray) -> int:
    total = np.add.reduce(mix(grams ^ np.uint64(0x6A09E667F3BCC909))) + np.uint64(len(grams))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def sketch(grams: np.ndarray) -> bytes:
    """Bit j tells whether an odd number of n-grams falls on j."""
    odd = np.bincount((mix(grams) >> np.uint64(54)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def wide_sketch(grams: np.ndarray, above: int) -> np.ndarray | None:
    """A sketch of the least power of two of bits that the set does not exceed, as 64-bit words.

    One of twice the length becomes the shorter one when its halves are combined by xor.
    """
    if len(grams) <= above:
        return None
    bits = max(64, 1 << (len(grams) - 1).bit_length())
    odd = np.bincount((mix(grams) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


class Rule:
    """Two sets link when den * intersection >= num * union."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def need(self, a, b=0):
        """Smallest intersection of two linked sets of these sizes."""
        return -(-(a + b) * self.num // (self.num + self.den))

    def prefix(self, n: int) -> int:
        return n - -(-n * self.num // self.den) + 1

    def possible(self, n: int, sizes: np.ndarray, own: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Which others a set may link with, by sizes and sketches."""
        low, high = np.minimum(sizes, n), np.maximum(sizes, n)
        fits = np.flatnonzero(low * self.den >= high * self.num)
        apart = np.bitwise_count(others[fits] ^ own).sum(axis=1, dtype=np.int64)
        return fits[apart <= sizes[fits] + n - 2 * self.need(sizes[fits], n)]


def prefix_of(grams: np.ndarray, count: int, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first `count` n-grams in global order."""
    if not len(frequent):
        return grams[:count]
    at = np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)
    often = frequent[at] == grams
    rare = grams[~often]
    if len(rare) >= count:
        return rare[:count]
    late = grams[often][np.argsort(rank[at[often]], kind="stable")]
    return np.concatenate((rare, late))[:count]


def _facts(docs: DataFrame, k: int) -> DataFrame:
    """One row per document (kind 0: id, size, class) and per n-gram that a shard often has.

    The first document of each class of a shard has the wide sketch of a long set.
    """
    above = WIDE_FROM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, table in enumerate(chunks(batches)):
            sizes, names, wide, sets = [], [], [], {}
            for grams in gram_sets(text_of(table), k):
                sizes.append(len(grams))
                names.append(class_name(grams))
                wide.append(None if names[-1] in sets else wide_sketch(grams, above))
                sets.setdefault(names[-1], grams)
            kept = np.sort(np.concatenate(list(sets.values()))) if sets else np.empty(0, np.uint64)
            order, first = grouped(kept)
            number_of = np.diff(np.append(first, len(kept)))
            often = number_of >= FREQUENT_IN_SHARD
            grams, counts = kept[first[often]].view(np.int64), number_of[often]
            n, m = len(sizes), len(grams)
            ids = table.column("doc_id").to_numpy()
            yield pa.RecordBatch.from_pydict(
                {
                    "kind": pa.array(np.repeat([0, 1], [n, m]), pa.int32()),
                    "part": pa.array(np.full(n + m, part), pa.int32()),
                    "chunk": pa.array(np.full(n + m, number), pa.int32()),
                    "doc_id": pa.array(np.concatenate((ids, np.zeros(m, np.int64))), pa.int64()),
                    "n": pa.array(np.concatenate((sizes, counts)).astype(np.int64)),
                    "name": pa.array(np.concatenate((names, grams)).astype(np.int64)),
                    "wide": pa.array(wide + [None] * m, pa.list_(pa.int64())),
                }
            )
        give_back()

    schema = "kind int, part int, chunk int, doc_id bigint, n bigint, name bigint, wide array<bigint>"
    return durable(docs.mapInArrow(run, schema), "gram-facts")


def _frequent(facts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams that stand last, by name, and their order. At most (mean set size / share)."""
    seen = facts.where("kind = 0").count()
    least = max(4 * FREQUENT_IN_SHARD, seen * FREQUENT_SHARE)
    rows = facts.where("kind = 1").groupBy("name").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    found = sorted((r["name"] & 0xFFFFFFFFFFFFFFFF, r["n"]) for r in rows.collect())
    names = np.array([x for x, _ in found], np.uint64)
    return names, np.array([n for _, n in found], np.int64)


def _own_classes(classes: DataFrame, seen: DataFrame) -> DataFrame:
    """To each shard the classes whose smallest document it holds."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        # Every partition's last shard is here too, so that each has a list.
        lists = [np.empty(0, np.int64)] * (int(rows["chunk"].max()) + 1)
        for chunk, own in rows[rows["own"]].groupby("chunk")["name"]:
            lists[chunk] = np.sort(own.to_numpy().astype(np.int64))
        made = [(key[0], 0, "own", list(range(len(lists))), [pack_bytes(x) for x in lists])]
        return pd.DataFrame(made, columns=["part", "bucket", "topic", "shards", "answers"])

    own = classes.select("part", "chunk", "name", F.lit(True).alias("own"))
    last = seen.groupBy("part").agg(F.max("chunk").alias("chunk"))
    last = last.select("part", "chunk", F.lit(0).cast("bigint").alias("name"), F.lit(False).alias("own"))
    return own.union(last).groupBy("part").applyInPandas(run, ANSWER)


def _lists(names: np.ndarray, packed: np.ndarray) -> tuple[np.ndarray, None]:
    """Name of the list of classes that have an n-gram; 0 for a list of one."""
    count = summed(names, packed & 255)
    total = summed(names, packed >> 8) & ((1 << 55) - 1)
    return np.where(count > 1, total * 2 + 1, 0), None


def _members(docs: DataFrame, classes: DataFrame, seen: DataFrame, rule: Rule, k: int, frequent, rank) -> DataFrame:
    """`bucket, name, n, sketch`: the classes of each bucket."""
    buckets = bucket_count(docs)
    own = durable(_own_classes(classes, seen), "own-classes")

    def own_sets(table: pa.Table, got: Answers) -> Iterator[tuple[int, np.ndarray]]:
        mine = set(unpack_bytes(got["own"][0], np.int64).tolist()) if "own" in got else set()
        for grams in gram_sets(text_of(table), k):
            name = class_name(grams)
            if len(grams) and name in mine:
                mine.discard(name)
                yield name, grams

    def ask_prefixes(table: pa.Table, got: Answers) -> tuple[np.ndarray, np.ndarray]:
        names, numbers = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for name, grams in own_sets(table, got):
            head = prefix_of(grams, rule.prefix(len(grams)), frequent, rank)
            mark = int(mix(np.array([name], np.int64).view(np.uint64))[0] >> np.uint64(9))
            names.append(head)
            numbers.append(np.full(len(head), mark, np.int64))
        flat, marks = np.concatenate(names), np.concatenate(numbers)
        order, first = grouped(flat)
        if not len(flat):
            return flat, marks
        total = np.add.reduceat(marks[order], first) & ((1 << 55) - 1)
        count = np.minimum(np.diff(np.append(first, len(flat))), 255)
        return flat[order][first], (total << 8) | count

    asked = ask(docs, own, ask_prefixes, buckets)
    lists = durable(answered(asked, "lists", _lists, np.int64), "gram-lists")

    def emit(part: int, shards: Iterator) -> Iterator[tuple]:
        for table, got in shards:
            yield from bucket_rows(table, got)

    def bucket_rows(table: pa.Table, got: Answers) -> Iterator[tuple]:
        held = list(own_sets(table, got))
        if not held:
            return
        heads = [prefix_of(g, rule.prefix(len(g)), frequent, rank) for _, g in held]
        names = np.unique(np.concatenate(heads))
        answers = got.get_list("lists", names, buckets, np.int64)
        for (name, grams), head in zip(held, heads, strict=True):
            met = np.unique(answers[np.searchsorted(names, head)])
            met = met[met != 0]
            if len(met):
                own = sketch(grams)
                for bucket in met.tolist():
                    yield bucket, name, len(grams), own

    schema = T.StructType.fromDDL("bucket bigint, name bigint, n bigint, sketch binary")
    return durable(with_answers(docs, own.unionByName(lists), emit, schema), "gram-buckets")


def _arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint64)
    return table.column("name").to_numpy(), table.column("n").to_numpy(), sketches.reshape(table.num_rows, -1)


def _near_pairs(starts: np.ndarray, sizes, sketches, rule: Rule, wanted=None) -> Iterator[tuple]:
    """(i, j) of all pairs of rows of one group that may link; a group is `starts[g:g + 2]`."""
    ends = np.repeat(starts[1:], np.diff(starts))
    number = ends - np.arange(len(ends)) - 1
    upto = np.cumsum(number)
    at = 0
    while at < len(number):
        base = upto[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(upto, base + PAIRS, side="right")))
        own = number[at:to]
        i = np.repeat(np.arange(at, to), own)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(own) - own, own)
        fits = np.minimum(sizes[i], sizes[j]) * rule.den >= np.maximum(sizes[i], sizes[j]) * rule.num
        if wanted is not None:
            fits &= wanted(i, j)
        i, j = i[fits], j[fits]
        apart = np.bitwise_count(sketches[i] ^ sketches[j]).sum(axis=1, dtype=np.int64)
        both = sizes[i] + sizes[j]
        near = apart <= both - 2 * rule.need(both)
        yield i[near], j[near]
        at = to


def _forest(members: DataFrame, rule: Rule) -> DataFrame:
    """`a, b`: pairs that may link and that join all that such pairs join through leaders.

    Each class is held against the leaders so far and follows the first that fits, else
    leads itself. Blocks of a large bucket are done apart, then their leaders together.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["bucket", "block"]):
            names, sizes, sketches = _arrays(table)
            starts = group_starts(table, ["bucket", "block"])
            counts = np.diff(starts)
            split = table.column("split").to_numpy()
            edges, leaders = [], []
            # Small groups all at once: all pairs, of which a forest is kept.
            root = np.arange(table.num_rows).tolist()

            def find(x: int) -> int:
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            small = (counts <= SMALL_GROUP) & ~split[starts[:-1]]
            rows = np.flatnonzero(np.repeat(small, counts))
            packed = np.append(0, np.cumsum(counts[small]))
            for i, j in _near_pairs(packed, sizes[rows], sketches[rows], rule):
                for x, y in zip(rows[i].tolist(), rows[j].tolist(), strict=True):
                    a, b = find(x), find(y)
                    if a != b:
                        root[b] = a
                        edges.append((x, y))
            # Large ones class by class.
            for g in np.flatnonzero(~small).tolist():
                rest = np.arange(starts[g], starts[g + 1])
                while len(rest):
                    head, rest = rest[0], rest[1:]
                    near = rule.possible(int(sizes[head]), sizes[rest], sketches[head], sketches[rest])
                    edges += [(head, y) for y in rest[near].tolist()]
                    if split[head]:
                        leaders.append(head)
                    rest = np.delete(rest, near)
            pairs = np.array(edges, np.int64).reshape(-1, 2)
            lead = np.array(leaders, np.int64)
            bucket = table.column("bucket").to_numpy()
            n, m = len(pairs), len(lead)
            yield pa.RecordBatch.from_pydict(
                {
                    "a": pa.array(np.concatenate((names[pairs[:, 0]], names[lead]))),
                    "b": pa.array(np.concatenate((names[pairs[:, 1]], bucket[lead]))),
                    "leads": pa.array(np.repeat([False, True], [n, m])),
                    "n": pa.array(np.concatenate((np.zeros(n, np.int64), sizes[lead]))),
                    "sketch": pa.array([b""] * n + [sketches[x].tobytes() for x in leaders], pa.binary()),
                }
            )
        give_back()

    schema = "a bigint, b bigint, leads boolean, n bigint, sketch binary"
    wide = ["bucket", "block", "split", "name", "n", "sketch"]
    dealt = members.select(wide).repartition("bucket", "block").sortWithinPartitions("bucket", "block", "name")
    first = durable(dealt.mapInArrow(run, schema), "forest")
    again = first.where("leads").select(
        F.col("b").alias("bucket"), F.lit(0).alias("block"), F.lit(False).alias("split"),
        F.col("a").alias("name"), "n", "sketch",
    )
    again = again.repartition("bucket").sortWithinPartitions("bucket", "name").mapInArrow(run, schema)
    return first.where("not leads").select("a", "b").union(again.select("a", "b"))


def _crossing(members: DataFrame, found: DataFrame, rule: Rule) -> DataFrame:
    """`a, b`: all pairs of a bucket that may link and lie in different components."""
    labelled = lookup(members, found.withColumnsRenamed({"node": "name"}), ["name"]).withColumn(
        "component", F.coalesce("component", "name")
    )
    mixed = labelled.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.mode("component").alias("main")
    )
    mixed = durable(mixed.where("low <> high").select("bucket", "main"), "mixed-buckets")
    rows = lookup(labelled, mixed, ["bucket"], "inner")
    # Every block sees all classes outside the main component; those are few.
    own = rows.withColumn("seen", F.lit(False))
    blocks = F.sequence(F.lit(0), F.col("blocks") - 1)
    copies = rows.where("blocks > 1 and component <> main").withColumn("to", F.explode(blocks))
    copies = copies.where("to <> block").withColumn("block", F.col("to")).drop("to").withColumn("seen", F.lit(True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["bucket", "block"]):
            names, sizes, sketches = _arrays(table)
            starts = group_starts(table, ["bucket", "block"])
            parts, copied = table.column("component").to_numpy(), table.column("seen").to_numpy()
            cross = lambda i, j: (parts[i] != parts[j]) & ~(copied[i] & copied[j])
            for i, j in _near_pairs(starts, sizes, sketches, rule, cross):
                yield pa.RecordBatch.from_pydict({"a": pa.array(names[i]), "b": pa.array(names[j])})
        give_back()

    both = own.unionByName(copies).select("bucket", "block", "component", "seen", "name", "n", "sketch")
    dealt = both.repartition("bucket", "block").sortWithinPartitions("bucket", "block", "name")
    met = dealt.mapInArrow(run, "a bigint, b bigint")
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def tree_matches(probe: np.ndarray, sets: list[np.ndarray], rule: Rule) -> list[int]:
    """Which sets link with the probe, by one walk over their prefix tree.

    Sorted as sequences, the sets are the tree's leaves in order, and a set shares with
    the one before the path down to their first difference.
    """
    order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
    found = []
    last = np.empty(0, np.uint64)
    # Overlap and place in the probe after each n-gram of the path, and how far it is known.
    overlap, place = np.empty(0, np.int64), np.empty(0, np.int64)
    for i in order:
        own = sets[i]
        m = min(len(own), len(last))
        differs = np.flatnonzero(own[:m] != last[:m])
        shared = min(int(differs[0]) if len(differs) else m, len(overlap))
        overlap, place, last = overlap[:shared], place[:shared], own
        need = rule.need(len(own), len(probe))
        if shared and overlap[-1] + min(len(own) - shared, len(probe) - place[-1]) < need:
            continue
        at = shared
        alive = True
        while alive and at < len(own):
            step = own[at : at + 64]
            where = np.searchsorted(probe, step)
            same = probe[np.minimum(where, len(probe) - 1)] == step
            base = overlap[-1] if at else 0
            overlap = np.concatenate((overlap, base + np.cumsum(same)))
            place = np.concatenate((place, where + same))
            at += len(step)
            alive = overlap[-1] + min(len(own) - at, len(probe) - place[-1]) >= need
        if alive and overlap[-1] >= need:
            found.append(i)
    return found


def _wide_sketches(facts: DataFrame) -> DataFrame:
    """`name, n, wide`: the wide sketch of each class of long sets."""
    rows = facts.where("kind = 0 and wide is not null")
    return durable(rows.groupBy("name").agg(F.first("n").alias("n"), F.first("wide").alias("wide")), "wide-sketches")


def _not_apart(pairs: DataFrame, wide: DataFrame, rule: Rule) -> DataFrame:
    """The stored pairs without those whose wide sketches differ in more bits than linked sets can.

    The distance of two sketches of one length never exceeds the difference of the sets.
    Pairs without two sketches that can be brought to one length stay.
    """
    side = lambda x: wide.select(F.col("name").alias(x), F.col("n").alias(f"n_{x}"), F.col("wide").alias(f"wide_{x}"))
    met = lookup(durable(lookup(pairs, side("a"), ["a"]), "half-sketched"), side("b"), ["b"])
    length = F.least(F.size("wide_a"), F.size("wide_b"))

    def xor(x, y):
        return x.bitwiseXOR(y)

    def cut(name: str):
        own = F.col(name)
        halves = F.zip_with(F.slice(own, F.lit(1), length), F.slice(own, length + 1, length), xor)
        return F.when(F.size(own) == length, own).when(F.size(own) == 2 * length, halves)

    differing = F.transform(F.zip_with(cut("wide_a"), cut("wide_b"), xor), F.bit_count)
    apart = F.aggregate(differing, F.lit(0), lambda total, n: total + n)
    both = F.col("n_a") + F.col("n_b")
    need = F.expr(f"((n_a + n_b) * {rule.num} + {rule.num + rule.den - 1}) div {rule.num + rule.den}")
    return met.where(F.coalesce(apart <= both - 2 * need, F.lit(True))).select("a", "b")


def _columns(rows: list[tuple], kinds: dict[str, pa.DataType]) -> list[pa.Array]:
    return [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds.values())]


def _verified(
    docs: DataFrame, classes: DataFrame, wide: DataFrame, pairs: DataFrame, rule: Rule, k: int
) -> DataFrame:
    """The pairs of classes that link. Each set goes once to each prefix tree it stands in."""
    pairs = durable(_not_apart(durable(pairs.distinct(), "near-pairs"), wide, rule), "gram-pairs")
    trees = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("members"))
    trees = durable(trees.select("a", F.ceil(F.col("members") / TREE).cast("int").alias("trees")), "trees")
    placed = lookup(pairs, trees, ["a"], "inner").withColumn(
        "tree", F.pmod(F.xxhash64("b"), F.col("trees")).cast("int")
    )
    probes = trees.withColumn("tree", F.explode(F.sequence(F.lit(0), F.col("trees") - 1)))
    needed = placed.select(F.col("b").alias("name"), F.struct("a", "tree").alias("job")).union(
        probes.select(F.col("a").alias("name"), F.struct("a", "tree").alias("job"))
    )
    gathered = needed.groupBy("name").agg(F.collect_list("job").alias("jobs"))
    where = classes.select("name", "doc_id").join(gathered, "name")
    by_doc = where.groupBy("doc_id").agg(F.collect_list(F.struct("name", "jobs")).alias("wanted"))
    asked = lookup(docs, durable(by_doc, "wanted-sets"), ["doc_id"], "inner")

    kinds = {"a": pa.int64(), "tree": pa.int32(), "name": pa.int64(), "grams": pa.binary()}

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", SENT_BYTES):
            wanted = batch.column("wanted").to_pylist()
            sent, size = [], 0
            for grams, jobs in zip(gram_sets(batch.column("text"), k), wanted, strict=True):
                name, data = class_name(grams), grams.tobytes()
                for job in (job for entry in jobs if entry["name"] == name for job in entry["jobs"]):
                    sent.append((job["a"], job["tree"], name, data))
                    size += len(data)
                    # A set may have many trees: they go out a few at a time.
                    if size > SENT_BYTES:
                        yield pa.RecordBatch.from_arrays(_columns(sent, kinds), names=list(kinds))
                        sent, size = [], 0
            yield pa.RecordBatch.from_arrays(_columns(sent, kinds), names=list(kinds))
        give_back()

    sets = asked.mapInArrow(emit, "a bigint, tree int, name bigint, grams binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["a", "tree"]):
            starts = group_starts(table, ["a", "tree"])
            heads, names = table.column("a").to_numpy(), table.column("name").to_numpy()
            grams = table.column("grams")
            out_a, out_b = [], []
            for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                held = {}
                for row in range(s, e):
                    held.setdefault(int(names[row]), np.frombuffer(grams[row].as_py(), np.uint64))
                head = int(heads[s])
                probe = held.pop(head)
                others = list(held)
                hits = tree_matches(probe, [held[x] for x in others], rule)
                out_a += [head] * len(hits)
                out_b += [others[i] for i in hits]
            yield pa.RecordBatch.from_pydict({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})
        give_back()

    dealt = sets.repartition("a", "tree").sortWithinPartitions("a", "tree")
    return durable(dealt.mapInArrow(run, "a bigint, b bigint"), "gram-links")


def join(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    k: int = 5,
    num: int = 8,
    den: int = 10,
) -> DataFrame:
    """`doc_id, n_shingles, component_id`, one row per row of the documents."""
    rule = Rule(num, den)
    ids = F.coalesce(F.col(key).cast("bigint"), F.lit(LAST_ID)).alias("doc_id")
    rows = stable(docs.select(ids, F.col(text).alias("text")))
    schema = "doc_id bigint, n_shingles bigint, component_id bigint"
    if not partitions(rows):
        return docs.sparkSession.createDataFrame([], schema)
    facts = _facts(rows, k)
    seen = facts.where("kind = 0").select("doc_id", "n", "name", "part", "chunk")
    least = F.min_by(F.struct("part", "chunk"), "doc_id").alias("at")
    classes = seen.where("n > 0").groupBy("name").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), least)
    classes = durable(classes.select("name", "doc_id", "n", "at.part", "at.chunk"), "gram-classes")
    wide = _wide_sketches(facts)
    frequent, rank = _frequent(facts)
    members = _members(rows, classes, seen, rule, k, frequent, rank)
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"))
    blocks = durable(
        sizes.where(F.col("members") > BLOCK).select(
            "bucket", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks")
        ),
        "bucket-blocks",
    )
    members = lookup(members, blocks, ["bucket"]).withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    members = members.withColumns(
        {
            "block": F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int"),
            "split": F.col("blocks") > 1,
        }
    )
    tried = _forest(members, rule)
    tried = durable(tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "tried")
    links = _verified(rows, classes, wide, tried, rule, k)
    found = components(links, "gram-components")
    more = _crossing(members, found, rule).join(tried, ["a", "b"], "left_anti")
    links = links.union(_verified(rows, classes, wide, more, rule, k))
    # Nodes are documents now: a class stands at its smallest.
    place = classes.select(F.col("name"), "doc_id")
    by_doc = (
        links.join(place.withColumnsRenamed({"name": "a", "doc_id": "x"}), "a")
        .join(place.withColumnsRenamed({"name": "b", "doc_id": "y"}), "b")
        .select(F.col("x").alias("a"), F.col("y").alias("b"))
    )
    # Rows of one document with different texts join their classes.
    twice = seen.where("n > 0").join(
        seen.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "doc_id"
    )
    same = lookup(twice.select("name", F.col("doc_id").alias("a")), place, ["name"], "inner").select(
        "a", F.col("doc_id").alias("b")
    )
    found = components(by_doc.union(same), "document-components")
    least = place.join(found.withColumnsRenamed({"node": "doc_id"}), "doc_id", "left").select(
        "name", F.coalesce("component", "doc_id").alias("component_id")
    )
    least = durable(least, "class-components")
    done = lookup(seen, least, ["name"]).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )
    return done.select(
        F.nullif("doc_id", F.lit(LAST_ID)).alias("doc_id"),
        "n_shingles",
        F.nullif("component_id", F.lit(LAST_ID)).alias("component_id"),
    )


def keep_first(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """One row of each component, with the columns that came in.

    Each row is a document of its own here, under a row key stored with it: rows without
    an id, or with one id, are linked by their texts alone. The row with the smallest id
    stays, null ids last; of equal ids the one with the smallest row key.
    """
    ids = F.coalesce(F.col(key).cast("bigint"), F.lit(LAST_ID))
    order = F.struct(F.col(key).isNull().alias("none"), ids.alias("id"))
    rows = docs.select(F.struct("*").alias("doc"), order.alias("at"), F.monotonically_increasing_id().alias("row"))
    rows = durable(rows, "keyed-rows")
    found = join(rows.select("row", F.col("doc").getField(text).alias("text")), "text", "row", **options)
    found = durable(found.select(F.col("doc_id").alias("row"), F.col("component_id").alias("component")), "row-components")
    # Components of more rows than one; the others keep their row.
    many = durable(found.where("row <> component").select("component").distinct(), "shared-components")
    members = lookup(found, many, ["component"], "inner").join(rows.select("row", "at"), "row")
    members = durable(members, "component-rows")
    first = members.groupBy("component").agg(F.min(F.struct("at", "row")).alias("first"))
    marked = lookup(members, durable(first, "first-rows"), ["component"]).where("row <> first.row")
    gone = durable(marked.select("row", F.lit(True).alias("goes")), "near-copies")
    return lookup(rows, gone, ["row"]).where("goes is null").select("doc.*")
