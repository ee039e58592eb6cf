"""N-gram Jaccard join: prefixes, grouped by identical prefix and size.

A document's set holds its distinct shingles in one order for all documents: first
those in the lowest part of hash space, twice as wide as prefixes are, from rare to
frequent by a count sketch over all documents, then the others by hash. Two sets that reach the similarity
share a shingle among their first n - ceil(t * n) + 1. Documents with the same set
are one class, and classes with the same prefix and size one group; only groups
send their prefix. The groups that share a prefix shingle make a list. Lists are expanded to classes. Pairs are filtered
by size, by the places of the shared shingle, and by profiles (how many shingles
fall into each of ``PROFILE`` parts of hash space: the sum of the lesser counts is
no less than the intersection); the rest are verified on their whole sets, and
verified pairs are the links.

Groups of copies can be large, so a list doesn't emit all its pairs. Members are
tried against one hub first: the member for which the list's shingle comes earliest
in its prefix, as it does for the text that others were made from. What a hub
links is one component; members already connected need no link of their own.
After ``hubs`` rounds the pairs in a list that could still connect two components
are tried in blocks: of the pairs between the same two components the most alike first, and more of
them in each round while the two stay apart. One link is enough to connect two
components, so pairs that say nothing new never become rows, and none that could is lost. The sketch has a fixed size; it decides the
order, thus the work, never the result.

Words are maximal runs of characters other than space and tab to carriage return,
with A-Z in lower case.

Defined cases: null and empty texts and texts without words have no set (size 0)
and no links; with fewer words than a shingle the whole sequence is the one
shingle; null ids are one id after all others; rows that share an id are judged
each by its own text; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.blocks import PACKED, PACKED_DDL, bit_table, bucket_count, each_group, entries_of, gathered, group_starts, in_table, maybe_among, packed
from llm.common import WORDS, as_batch, mixed, row_key, rows_in_batches, shingle_hashes, stored
from llm.components import components

LAST = (1 << 63) - 1
#: Counters of the sketch, counters in one of its pages, and parts of a profile.
COUNTERS, PAGE, PROFILE = 1 << 22, 1 << 16, 256
HUBS = 3
#: Members of a list in one block, about; pairs between two components in the first round, and how many times more in each later one.
MEMBERS, MORE = 256, 16
ENTRY = np.dtype([("h", "<u8"), ("prefix", "<i8"), ("n", "<i4"), ("at", "<i4")])
ABOUT = np.dtype([("doc", "<i8"), ("key", "<i8"), ("n", "<i8"), ("set", "<i8"), ("prefix", "<i8"), ("profile", f"V{PROFILE}")])
FIELDS = pa.schema([("doc", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("set", pa.int64()), ("prefix", pa.int64()), ("profile", pa.binary()), ("token", pa.int64()), ("at", pa.int32())])
FIELDS_DDL = "doc long, key long, n long, set long, prefix long, profile binary, token long, at int"


def shingle_set(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    codes = WORDS.of(words)
    if len(codes) < width:
        return mixed(shingle_hashes(codes, len(codes)) + np.uint64(len(codes)))
    return np.unique(shingle_hashes(codes, width))


def _digest(values: np.ndarray) -> int:
    value = xxhash.xxh3_64_intdigest(values.tobytes())
    return value - (1 << 64) if value >> 63 else value


def low_part(values: np.ndarray, percent: int) -> np.ndarray:
    """Which shingles lie in the part of hash space that is ordered by frequency."""
    return values >> np.uint64(32) < np.uint64(min(100, 2 * (100 - percent)) * (1 << 32) // 100)


def prefix_of(values: np.ndarray, ranks: np.ndarray, percent: int) -> np.ndarray:
    """The shingles that come first; enough of them to meet every similar set's."""
    n = len(values)
    length = n + percent * n // -100 + 1
    rank = np.where(low_part(values, percent), ranks[values & np.uint64(len(ranks) - 1)], 255).astype(np.uint64)
    return values[np.argsort(rank << np.uint64(56) | values >> np.uint64(8), kind="stable")[:length]]


def profile_of(values: np.ndarray) -> bytes:
    """Shingles in each part of hash space; 255 stands for that many or more."""
    return np.minimum(np.bincount((values >> np.uint64(40) & np.uint64(PROFILE - 1)).astype(np.int64), minlength=PROFILE), 255).astype(np.uint8).tobytes()


def frequency_ranks(narrow: DataFrame, width: int, percent: int) -> np.ndarray:
    """Four times log2 of the count of every counter of the sketch, over the low shingles of all documents."""
    schema = pa.schema([("bucket", pa.int64()), ("data", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.uint32)

        def take(sets: list[np.ndarray]) -> None:
            np.add.at(counts, (np.concatenate(sets) & np.uint64(COUNTERS - 1)).view(np.int64), np.uint32(1))

        for batch in batches:
            sets, size = [], 0
            for text in batch.column("text"):
                values = shingle_set(text.as_py(), width)
                sets.append(values[low_part(values, percent)])
                size += len(sets[-1])
                if size > PAGE:
                    take(sets)
                    sets, size = [], 0
            if sets:
                take(sets)
        # One byte a counter: what a task has seen more often is frequent anyhow.
        pages = np.minimum(counts, 255).astype(np.uint8).reshape(-1, PAGE)
        yield as_batch(schema, [np.arange(len(pages)), [p.tobytes() for p in pages]])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for page, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums[page] = sums.get(page, np.zeros(PAGE, np.uint64)) + np.frombuffer(data.as_buffer(), np.uint8)
        if sums:
            yield as_batch(schema, [list(sums), [np.minimum(4 * np.log2(s + 1.0), 254).astype(np.uint8).tobytes() for s in sums.values()]])

    summed = narrow.select("text").mapInArrow(count, PACKED_DDL).repartition(COUNTERS // PAGE, "bucket").mapInArrow(add, PACKED_DDL)
    ranks = np.zeros(COUNTERS, np.uint8)
    for row in summed.collect():  # one byte a counter
        ranks[row["bucket"] * PAGE : (row["bucket"] + 1) * PAGE] = np.frombuffer(row["data"], np.uint8)
    return ranks


def _once(entries: np.ndarray) -> np.ndarray:
    """One entry per shingle and group."""
    entries = entries[np.lexsort((entries["prefix"], entries["h"]))]
    new = (entries["h"][1:] != entries["h"][:-1]) | (entries["prefix"][1:] != entries["prefix"][:-1])
    return entries[np.concatenate([[True], new])]


def _received(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows about documents as they came, and the groups that share a shingle with another group."""

    def fields(part: np.ndarray, **columns) -> pa.RecordBatch:
        arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(len(part), f.type) for f in FIELDS]
        return pa.RecordBatch.from_arrays(arrays, schema=FIELDS)

    for bucket, values in each_group(batches):
        if bucket < 0:
            for value in values:
                about = np.frombuffer(value, ABOUT)
                for a in range(0, len(about), 4096):
                    part = about[a : a + 4096]
                    profiles = [x.tobytes() for x in part["profile"]]
                    yield fields(part, **{n: np.ascontiguousarray(part[n]) for n in ("doc", "key", "n", "set", "prefix")}, profile=profiles)
            continue
        entries = _once(entries_of(values, ENTRY))
        starts = group_starts(entries["h"])
        sizes = np.diff(np.append(starts, len(entries)))
        shared = entries[np.repeat(sizes > 1, sizes)]
        for a in range(0, len(shared), 65_536):
            part = shared[a : a + 65_536]
            plain = {n: np.ascontiguousarray(part[n]) for n in ("h", "prefix", "n", "at")}
            yield fields(part, token=plain["h"].view(np.int64), prefix=plain["prefix"], n=plain["n"].astype(np.int64), at=plain["at"])


def _fitting(percent: int) -> Column:
    """Sizes and the places of a shared shingle that leave room for enough common ones."""
    most = F.least("at", "hub_at") + 1 + F.least(F.col("n") - F.col("at"), F.col("hub_n") - F.col("hub_at")) - 1
    sizes = 100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n")
    return sizes & (100 * most >= percent * (F.col("n") + F.col("hub_n") - most))


def _alike(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose profiles leave room for enough common shingles."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(n).to_pylist()), np.uint8).reshape(-1, PROFILE) for n in ("x", "y"))
            full = (x == 255) & (y == 255)
            n, m = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("na", "nb"))
            most = np.where(full.any(1), np.minimum(n, m), np.minimum(np.minimum(x, y).sum(1, dtype=np.int64), np.minimum(n, m)))
            chosen = pa.array(100 * most >= percent * (n + m - most))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(chosen), batch.column("b").filter(chosen)], schema=schema)

    both = pairs
    for side, profile, n in (("a", "x", "na"), ("b", "y", "nb")):
        both = both.join(classes.select(F.col("set").alias(side), F.col("profile").alias(profile), F.col("n").alias(n)), side)
    return both.select("a", "b", "x", "y", "na", "nb").mapInArrow(keep, "a long, b long")


def linked_sets(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the similarity."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for batch in batches:
            found = []
            for a, b, x, y in zip(*(batch.column(k) for k in range(4))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    found.append((a.as_py(), b.as_py()))
            if found:
                yield as_batch(schema, list(zip(*found)))

    full = pairs.join(sets.select(F.col("set").alias("a"), F.col("values").alias("x")), "a")
    full = full.join(sets.select(F.col("set").alias("b"), F.col("values").alias("y")), "b")
    return full.select("a", "b", "x", "y").mapInArrow(verify, "a long, b long")


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80, hubs: int = HUBS) -> DataFrame:
    """(doc_id, n_shingles, component_id): size of each row's set, and the smallest id that links can reach.

    Two sets are linked when 100 * intersection >= percent * union. Runs the join at
    once; the result is lazy.
    """
    real = lambda c: F.when(F.col(c) < LAST, F.col(c))
    rows = _rows(docs, width, percent, hubs)
    return rows.select(real("doc").alias("doc_id"), F.col("n").alias("n_shingles"), real("smallest").alias("component_id"))


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80, hubs: int = HUBS) -> DataFrame:
    """One row of each component, the one with the smallest id (of rows that share it, any one), with all its columns.

    Rows without a set all stay, but for repetitions of the same id and text.
    """
    rows = stored(_rows(docs, width, percent, hubs), "rows")
    alone = rows.filter("n = 0").select("key").distinct()
    kept = rows.filter("n > 0").groupBy("component").agg(F.min(F.struct("doc", "key")).alias("least")).select("least.key").union(alone)
    # Most rows stay and are not repeated: only the others, and some more, are moved to be looked up.
    doubtful = rows.groupBy("key").agg(F.count("*").alias("n")).join(kept.withColumn("kept", F.lit(True)), "key", "left")
    doubtful = stored(doubtful.filter("n > 1 OR kept IS NULL").select("key"), "doubtful")
    keyed = docs.withColumn("__key", row_key("doc_id", "text"))
    keyed = keyed.withColumn("__doubt", maybe_among(doubtful, "key")("__key"))
    sure, unsure = (keyed.filter(x).drop("__doubt") for x in (~F.col("__doubt"), F.col("__doubt")))
    found = unsure.join(kept.withColumnRenamed("key", "__key"), "__key", "left_semi").dropDuplicates(["__key"])
    return sure.unionByName(found).drop("__key")


def _rows(docs: DataFrame, width: int, percent: int, hubs: int) -> DataFrame:
    """(doc, key, n, component, smallest) of every row."""
    spark = docs.sparkSession
    narrow = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.col("text").cast("binary").alias("text"), row_key("doc_id", "text").alias("key"))
    ranks = spark.sparkContext.broadcast(frequency_ranks(narrow, width, percent))  # one byte a counter
    buckets = bucket_count(narrow)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Packed prefixes by shingle, and rows about documents in buckets below zero."""
        held: list[tuple] = []

        def about() -> pa.RecordBatch:
            rows = np.array(held, ABOUT)
            held.clear()
            where = rows["set"] % buckets
            order = np.argsort(where, kind="stable")
            rows, where = rows[order], where[order]
            starts = group_starts(where)
            parts = [rows[a:b].tobytes() for a, b in zip(starts, np.append(starts[1:], len(rows)))]
            return as_batch(PACKED, [-1 - where[starts], parts])

        def entries() -> Iterator[np.ndarray]:
            seen: set[int] = set()
            for batch in batches:
                for doc, key, text in zip(batch.column("doc").to_pylist(), batch.column("key").to_pylist(), batch.column("text")):
                    values = shingle_set(text.as_py(), width)
                    first = prefix_of(values, ranks.value, percent) if len(values) else values
                    prefix = _digest(np.append(first, np.uint64(len(values))))
                    held.append((doc, key, len(values), _digest(values), prefix, profile_of(values)))
                    if len(values) and prefix not in seen:
                        if len(seen) > 100_000:
                            seen.clear()
                        seen.add(prefix)
                        out = np.empty(len(first), ENTRY)
                        out["h"], out["prefix"], out["n"], out["at"] = first, prefix, len(values), np.arange(len(first))
                        yield out

        for rows in packed(entries(), buckets):
            yield rows
            if held:
                yield about()
        if held:
            yield about()

    sent = narrow.mapInArrow(describe, PACKED_DDL)
    received = stored(gathered(sent, 2 * buckets).mapInArrow(_received, FIELDS_DDL), "sets")
    info = received.filter("doc IS NOT NULL").select("doc", "key", "n", "set", "prefix")
    classes = received.filter("doc IS NOT NULL AND n > 0").groupBy("set", "n", "prefix").agg(F.min("doc").alias("rep"), F.first("profile").alias("profile"))
    classes = stored(classes, "classes")
    groups = received.filter("token IS NOT NULL").select("token", "prefix", "n", "at")
    # Several sets in one group are a list of their own, by the group itself.
    crowded = classes.groupBy("prefix", "n").agg(F.count("*").alias("sets")).filter("sets > 1")
    own = crowded.select(F.col("prefix").alias("token"), "prefix", "n", F.lit(0).alias("at"))
    listed = stored(groups.union(own).join(classes.select("prefix", "set"), "prefix").select("token", "set", "n", "at"), "lists")
    return _labelled(info, classes, _links(listed, classes, narrow, width, percent, hubs))


def most_alike(low: np.ndarray, size: np.ndarray, one: np.ndarray, other: np.ndarray, most: int) -> np.ndarray:
    """Which pairs are among the ``most`` with the greatest share low / size between the same two components."""
    p, q = np.minimum(one, other), np.maximum(one, other)
    order = np.lexsort((-low / size, q, p))
    new = np.append(True, (p[order][1:] != p[order][:-1]) | (q[order][1:] != q[order][:-1]))
    first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - first < most]


def _crossing(rest: DataFrame, classes: DataFrame, percent: int, most_pairs: int) -> DataFrame:
    """Pairs (a, b) of a list that are not connected and may be similar by sizes, places and profiles.

    A list's members are packed into blocks, and blocks of a list meet pairwise: what
    grows with the square of a list is spread over tasks. Of the pairs between the same two
    components in two blocks, the ``most_pairs`` most alike become rows; a row
    without a tells that there are more.
    """
    sizes = rest.groupBy("token").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("blocks"))
    member = F.struct("set", "n", "at", "part", "profile")
    members = rest.join(sizes, "token").join(classes.select("set", "profile"), "set")
    blocks = members.groupBy("token", F.pmod(F.xxhash64("set"), F.col("blocks")).alias("block")).agg(F.collect_list(member).alias("x"))
    blocks = stored(blocks, "blocks")
    both = blocks.join(blocks.select("token", F.col("block").alias("other"), F.col("x").alias("y")), "token").filter("block <= other")

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

        def fields(value) -> tuple:
            rows = value.values
            numbers = [rows.field(k).to_numpy(zero_copy_only=False) for k in range(4)]
            return *numbers, np.frombuffer(b"".join(rows.field(4).to_pylist()), np.uint8).reshape(-1, PROFILE).astype(np.int32)

        for batch in batches:
            for x, y in zip(batch.column("x"), batch.column("y")):
                (s, n, i, p, f), (t, m, j, q, g) = fields(x), fields(y)
                most = np.minimum(i[:, None], j) + np.minimum((n - i)[:, None], m - j)
                fit = (p[:, None] != q) & (s[:, None] != t) & (100 * np.minimum(n[:, None], m) >= percent * np.maximum(n[:, None], m))
                fit &= 100 * most >= percent * (n[:, None] + m - most)
                at, to = np.nonzero(fit)
                found = []
                for k in range(0, len(at), 8192):
                    u, v = at[k : k + 8192], to[k : k + 8192]
                    low = np.minimum(f[u], g[v]).sum(1)
                    full = ((f[u] == 255) & (g[v] == 255)).any(1)
                    low = np.where(full, np.minimum(n[u], m[v]), low)
                    found.append([z[100 * low >= percent * (n[u] + m[v] - low)] for z in (u, v, low)])
                if not found:
                    continue
                u, v, low = (np.concatenate(z) for z in zip(*found))
                if not len(u):
                    continue
                chosen = most_alike(low, n[u] + m[v] - low, p[u], q[v], most_pairs)
                u_, v_ = s[u[chosen]], t[v[chosen]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u_, v_)), pa.array(np.maximum(u_, v_))], schema=schema)
                if len(chosen) < len(u):
                    yield as_batch(schema, [[None], [len(u) - len(chosen)]])

    return stored(both.select("x", "y").mapInArrow(cross, "a long, b long"), "crossing")


def _whole_sets(narrow: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(set, values) of the classes whose first documents are ``wanted`` (rep), and of some others.

    Documents are picked by a table of bits, so texts are read but not moved.
    """
    table = narrow.sparkSession.sparkContext.broadcast(bit_table(wanted.select(F.xxhash64("rep").alias("hash")), "hash"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("set", pa.int64()), ("values", pa.binary())])
        seen: set[int] = set()

        def found() -> Iterator[tuple]:
            for batch in batches:
                text = batch.column("text")
                for i in np.flatnonzero(in_table(table.value, batch.column("hash").to_numpy(zero_copy_only=False))):
                    values = shingle_set(text[int(i)].as_py(), width)
                    if len(values) and (name := _digest(values)) not in seen:
                        if len(seen) > 100_000:
                            seen.clear()
                        seen.add(name)
                        yield name, values.tobytes()

        yield from rows_in_batches(found(), schema, 256)

    return narrow.select(F.xxhash64("doc").alias("hash"), "text").mapInArrow(read, "set long, values binary")


def _links(listed: DataFrame, classes: DataFrame, narrow: DataFrame, width: int, percent: int, hubs: int) -> DataFrame:
    """(node, component) of the sets that verified links connect."""

    def verified(pairs: DataFrame) -> DataFrame:
        """Links among the pairs; sets that equal texts in several tasks have repeat, links don't."""
        likely = stored(_alike(pairs, classes, percent), "likely")
        ends = likely.select(F.col("a").alias("set")).union(likely.select(F.col("b").alias("set"))).distinct()
        wanted = stored(ends.join(classes.select("set", "rep"), "set"), "wanted")
        if not wanted.head(1):
            return likely
        sets = stored(_whole_sets(narrow, wanted, width).join(ends, "set", "left_semi"), "whole")
        return stored(linked_sets(likely, sets, percent).distinct(), "links")

    edges = tried = label = None
    rest = listed
    for _ in range(hubs):
        hub = rest.groupBy("token").agg(F.min(F.struct("at", "set", "n")).alias("hub"), F.count("*").alias("members")).filter("members > 1")
        against = rest.join(hub.select("token", F.col("hub.at").alias("hub_at"), F.col("hub.set").alias("hub_set"), F.col("hub.n").alias("hub_n")), "token")
        against = against.filter(F.col("set") != F.col("hub_set"))
        pairs = against.filter(_fitting(percent)).select(F.least("set", "hub_set").alias("a"), F.greatest("set", "hub_set").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        tried = pairs if tried is None else tried.union(pairs)
        if edges is None or pairs.head(1):
            found = verified(pairs)
            edges = found if edges is None else edges.union(found)
            label = components(edges)
        # Lists go on without their hub, as long as their other members are not all connected.
        parts = _apart(against, label)
        if not parts.head(1):
            return label
        rest = parts.drop("part")
    most_pairs = MORE
    while True:
        crossed = _crossing(parts, classes, percent, most_pairs)
        pairs = stored(crossed.filter("a IS NOT NULL").distinct().join(tried, ["a", "b"], "left_anti"), "pairs")
        if pairs.head(1):
            tried, edges = tried.union(pairs), edges.union(verified(pairs))
            label = components(edges)
        if not crossed.filter("a IS NULL").head(1):
            return label
        parts, most_pairs = _apart(parts, label), MORE * most_pairs
        if not parts.head(1):
            return label


def _apart(members: DataFrame, label: DataFrame) -> DataFrame:
    """(token, set, n, at, part) of the lists whose members are in more than one component."""
    rest = members.select("token", "set", "n", "at").join(label.withColumnRenamed("node", "set"), "set", "left").withColumn("part", F.coalesce("component", "set"))
    apart = rest.groupBy("token").agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q").select("token")
    return stored(rest.join(apart, "token", "left_semi").select("token", "set", "n", "at", "part"), "rest")


def _labelled(info: DataFrame, classes: DataFrame, label: DataFrame) -> DataFrame:
    label = label.select(F.col("node").alias("set"), "component")
    least = classes.join(label, "set", "left").withColumn("component", F.coalesce("component", "set"))
    smallest = least.groupBy("component").agg(F.min("rep").alias("smallest"))
    known = least.join(smallest, "component").select("set", "component", "smallest")
    rows = info.join(known, "set", "left").withColumn("smallest", F.when(F.col("n") > 0, F.col("smallest")).otherwise(F.col("doc")))
    return rows.select("doc", "key", "n", "component", "smallest")
