"""Exact sums and thresholds at chosen ranks, without ranking or shuffling a row.

Rows are ordered by a number and, where numbers tie, by a key. A histogram counts
the rows per bin of the number; a bin that a wanted rank cuts through is divided again, between the
least and the greatest number in it, until every cut falls between two bins. A
bin that holds one number is divided by the key in the same way. Each pass reads
the narrow rows, sums them per bin in the map tasks, and shuffles bins alone.

The driver holds what the passes leave of the order: some thousand bins a pass (beyond
that, 64 for each cut at most), however many rows there are. A row finds its bin by one small broadcast join a pass.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType

from holdfast.session import settle

#: Bins that a pass aims at over all it divides; at least and at most so many bits of bins for each.
BINS, LEAST_BITS, MOST_BITS = 1 << 14, 6, 12
#: Blocks that ``scan`` deals rows out to, and rows of a block while there are fewer blocks.
BLOCKS, BLOCK_ROWS = 4096, 2_000_000
_EXACT = (DoubleType, FloatType, IntegerType, ShortType, ByteType)
_LEAST = -(1 << 63)
_CHUNK = 7
# Places of a number in the order, low to high.
_NAN_FIRST, _BELOW, _NUMBER, _ABOVE, _NAN_LAST, _NULL = range(6)


@dataclass
class _Bin:
    """What one pass found about a bin: rows, sums, the range of its numbers and of two words of its keys, its last row."""

    parent: int
    slot: int
    rows: int
    sums: tuple
    number: tuple[float, float]
    word: tuple
    next_word: tuple
    last: tuple


@dataclass
class _Node:
    """A bin to divide: ``depth`` 0 by the number, else by that word of the key."""

    group: int
    depth: int
    before: int
    sums_before: tuple
    number: tuple[float, float]
    word: tuple[int, int]
    ranks: list[int]
    places: list[int]


@dataclass(frozen=True)
class Cut:
    """The first ``rank`` rows of a group: sums over them, and the last one's (class, number, key)."""

    group: object
    rank: int
    total: int
    sums: dict
    last: tuple


@dataclass
class Cuts:
    """Cuts by group and rank, numbers at single places, and how a row finds its block between cuts."""

    cuts: dict[object, list[Cut]] = field(default_factory=dict)
    totals: dict[object, int] = field(default_factory=dict)
    values: dict[object, dict[int, float | None]] = field(default_factory=dict)
    levels: list[tuple[list[tuple], int]] = field(default_factory=list)


def _ordered(value: Column, descending: bool) -> tuple[Column, Column]:
    """Class and number of a value, ascending in the wanted order, nulls last."""
    number = value.cast("double") * (-1.0 if descending else 1.0) + F.lit(0.0)  # 0.0 and -0.0 tie
    special = (
        F.when(value.isNull(), _NULL).when(F.isnan(number), _NAN_FIRST if descending else _NAN_LAST)
        .when(number == float("-inf"), _BELOW).when(number == float("inf"), _ABOVE).otherwise(_NUMBER)
    )
    return special, F.when(special == _NUMBER, number).otherwise(0.0)


def _word(key: Column, text: bool, depth: Column) -> Column:
    """Word ``depth`` (from 0) of a key, in the order of signed numbers: the key itself, or seven bytes of a text and how many there are."""
    if not text:
        return F.when(depth == 0, F.coalesce(key.cast("long"), F.lit(_LEAST)))
    part = F.substring(key.cast("binary"), depth * _CHUNK + 1, F.lit(_CHUNK))
    digits = F.concat(F.rpad(F.hex(part), 2 * _CHUNK, "0"), F.lpad(F.octet_length(part).cast("string"), 2, "0"))
    return F.coalesce(F.conv(digits, 16, -10).cast("long").bitwiseXOR(F.lit(_LEAST)), F.lit(_LEAST))


def _checked(df: DataFrame, value: str, key: str) -> bool:
    """Whether the key is text; raises if order could be lost on the way to doubles and words."""
    kind, keys = df.schema[value].dataType, df.schema[key].dataType
    if not (isinstance(kind, _EXACT) or isinstance(kind, DecimalType) and kind.precision <= 15):
        raise TypeError(f"{value} must be a number that a double holds exactly, not {kind.simpleString()}")
    if not isinstance(keys, (StringType, LongType, IntegerType, ShortType, ByteType)):
        raise TypeError(f"{key} must be a whole number or text, not {keys.simpleString()}")
    return isinstance(keys, StringType)


def _narrowed(df: DataFrame, value: str, key: str, sums: Mapping[str, Column], descending: bool, group: Column | None) -> DataFrame:
    special, number = _ordered(F.col(value), descending)
    return df.select(
        (F.lit(0) if group is None else group).alias("_g"), special.alias("_class"), number.alias("_v"), F.col(key).alias("_k"),
        *[x.alias(f"_s{i}") for i, x in enumerate(sums.values())],
    )


def _slot(text: bool, bits: int) -> Column:
    """The bin within a node. Differences and quotients of doubles keep order, so equal numbers meet and smaller ones never pass larger."""
    most = (1 << bits) - 1
    share = (F.col("_v") * F.col("_f") - F.col("_lo")) / F.col("_span")
    by_number = F.least(F.floor(share * (1 << bits)), F.lit(most))
    word = _word(F.col("_k"), text, F.col("_depth") - 1)
    by_word = F.call_function("shiftrightunsigned", word.bitwiseXOR(F.lit(_LEAST)), F.col("_shift")).bitwiseAND(F.lit(most))
    return F.when(F.col("_depth") == 0, by_number).otherwise(by_word).cast("long")


def _node_rows(nodes: list[_Node], bits: int) -> list[tuple]:
    """(depth, lo, span, f, shift) of each node."""
    rows = []
    for node in nodes:
        (lo, hi), (least, greatest) = node.number, node.word
        f = 0.5 if max(abs(lo), abs(hi)) > 1e300 else 1.0
        shift = max(0, (((least ^ greatest) & (1 << 64) - 1).bit_length()) - bits)
        rows.append((node.depth, lo * f, hi * f - lo * f if node.depth == 0 else 1.0, f, shift))
    return rows


_PLACED = "_parent int, _slot long, _node int, _block int, _depth int, _lo double, _span double, _f double, _shift int"
_STATE = ["_node", "_depth", "_lo", "_span", "_f", "_shift"]


def _found(rows: DataFrame, level: list[tuple], text: bool, bits: int, kept: Sequence[str] = (), how: str = "inner") -> DataFrame:
    """Rows with the node of their bin, as one pass left it; its rows are bins, so they can be broadcast."""
    table = F.broadcast(rows.sparkSession.createDataFrame(level, _PLACED))
    at = rows.withColumn("_slot", _slot(text, bits)) if "_node" in rows.columns else rows.withColumns({"_node": F.col("_g"), "_slot": F.col("_class").cast("long")})
    before = at.withColumnRenamed("_node", "_parent").drop("_depth", "_lo", "_span", "_f", "_shift")
    return before.join(table.drop(*[c for c in ("_block",) if c not in kept]), ["_parent", "_slot"], how).drop("_parent", "_slot")


def _bins(rows: DataFrame, text: bool, bits: int | None, n_sums: int) -> list[_Bin]:
    """One pass: the bins of all nodes (of the groups, when ``bits`` is None), each with its sums and ranges."""
    if bits is None:
        parent, slot, depth = F.col("_g"), F.col("_class").cast("long"), F.lit(0)
    else:
        parent, slot, depth = F.col("_node"), _slot(text, bits), F.col("_depth")
    word, next_word = _word(F.col("_k"), text, depth - 1), _word(F.col("_k"), text, depth)
    word = F.when(depth > 0, word)
    ranges = [x for c in (F.col("_v"), word, next_word) for x in (F.min(c), F.max(c))]
    last = F.max(F.struct("_class", "_v", "_k"))
    sums = [F.coalesce(F.sum(f"_s{i}"), F.lit(0)) for i in range(n_sums)]
    measures = [x.alias(f"_m{i}") for i, x in enumerate([F.count("*"), *ranges, last, *sums])]
    made = rows.groupBy(parent.alias("_p"), slot.alias("_b")).agg(*measures).collect()
    return sorted(
        (_Bin(r[0], r[1], r[2], tuple(r[10:]), (r[3], r[4]), (r[5], r[6]), (r[7], r[8]), tuple(r[9])) for r in made),
        key=lambda b: (b.parent, b.slot),
    )


def _opened(one: _Bin, group: int, depth: int, before: int, sums_before: tuple, ranks: list[int], places: list[int], text: bool) -> _Node:
    """The bin as a node: by the number while numbers differ, then by the first word that differs."""
    if depth == 0 and one.number[0] < one.number[1]:
        return _Node(group, 0, before, sums_before, one.number, (0, 0), ranks, places)
    if depth > 0 and one.word[0] < one.word[1]:
        return _Node(group, depth, before, sums_before, one.number, one.word, ranks, places)
    word = one.next_word
    ended = not text and depth > 0 or word[0] is None or (word[0] == word[1] and (not text or ((word[0] ^ _LEAST) & 0xFF) < _CHUNK))
    if ended:
        raise ValueError("rows share both number and key: the order between them is not defined")
    return _Node(group, depth + 1, before, sums_before, one.number, word, ranks, places)


def refine(
    df: DataFrame, value: str, key: str, wanted: Callable[[int], Sequence[int]], sums: Mapping[str, Column] | None = None,
    descending: bool = True, group: Column | None = None, labels: Sequence[object] = (None,),
    places: Callable[[int, int], Sequence[int]] = lambda rows, scored: (),
) -> Cuts:
    """Cut the order by ``value`` and ``key`` after the ranks that ``wanted`` names for a number of rows.

    ``group``, a whole number from 0, orders each group for itself; ``labels`` are their names,
    a handful. ``places`` (from the rows, and those with a value) are ranks whose value alone is wanted. Nulls come last. The
    key must be unique among equal values where a cut falls between them. Eager, a job a pass;
    ``df`` is read by each, so store what is dear to compute.
    """
    text, sums = _checked(df, value, key), dict(sums or {})
    rows = _narrowed(df, value, key, sums, descending, group)
    out, bits = Cuts(), None
    nodes: list[_Node] = []
    while True:
        bins = _bins(rows, text, bits, len(sums))
        if bits is None:
            for g, label in enumerate(labels):
                own = [b for b in bins if b.parent == g]
                total = sum(b.rows for b in own)
                out.totals[label], out.cuts[label], out.values[label] = total, [], {}
                scored = sum(b.rows for b in own if b.slot != _NULL)
                ranks = sorted({r for r in wanted(total) if 0 < r <= total})
                nodes.append(_Node(g, 0, 0, (0,) * len(sums), (0.0, 0.0), (0, 0), ranks, sorted({p for p in places(total, scored) if 0 < p <= total})))
        inside: dict[int, list[_Bin]] = {}
        for b in bins:
            inside.setdefault(b.parent, []).append(b)
        placed, after = [], []
        for number, node in enumerate(nodes):
            before, added, exact = node.before, node.sums_before, set(node.ranks)
            for b in inside.get(number, ()):
                upto, sums_upto = before + b.rows, tuple(x + y for x, y in zip(added, b.sums))
                label = labels[node.group]
                if upto in exact:
                    out.cuts[label].append(Cut(label, upto, out.totals[label], dict(zip(sums, sums_upto)), b.last))
                ranks = node.ranks[bisect_right(node.ranks, before) : bisect_left(node.ranks, upto)]
                asked = node.places[bisect_right(node.places, before) : bisect_right(node.places, upto)]
                if b.number[0] == b.number[1]:
                    out.values[label].update(dict.fromkeys(asked, _plain(b.last, descending)))
                    asked = []
                child = None
                if ranks or asked:
                    child = len(after)
                    after.append(_opened(b, node.group, node.depth, before, added, ranks, asked, text))
                placed.append((number, b.slot, child, None if child is not None else (node.group, before)))
                before, added = upto, sums_upto
        next_bits = max(LEAST_BITS, min(MOST_BITS, (BINS // max(1, len(after))).bit_length() - 1))
        shapes = _node_rows(after, next_bits)
        out.levels.append(([(p, s, c, b, *(shapes[c] if c is not None else (None,) * 5)) for p, s, c, b in placed], bits or 0))
        if not after:
            break
        opened = [(p, s, c, None, *rest) for p, s, c, _, *rest in out.levels[-1][0] if c is not None]
        rows = _found(rows, opened, text, bits or 0)
        nodes, bits = after, next_bits
    for label in labels:
        out.cuts[label].sort(key=lambda c: c.rank)
    return out


def _plain(last: tuple, descending: bool) -> float | None:
    """The value as it was, from class and number."""
    special, number, _ = last
    if special == _NULL:
        return None
    if special in (_NAN_FIRST, _NAN_LAST):
        return float("nan")
    number = {_BELOW: float("-inf"), _ABOVE: float("inf")}.get(special, number)
    return (-number if descending else number) + 0.0


def first_rows(df: DataFrame, k: int, value: str, key: str, descending: bool = True) -> DataFrame:
    """The first ``k`` rows by ``value`` and ``key``, unordered: a filter, by the row that holds place ``k``.

    Finding that row takes a few passes over the two columns; nothing is shuffled or
    stored. ``key`` must be unique. Eager.
    """
    if k <= 0:
        return df.limit(0)
    cuts = refine(df, value, key, lambda n: [k], descending=descending).cuts[None]
    if not cuts:
        return df
    special, number = _ordered(F.col(value), descending)
    place, at, last = cuts[0].last
    keys = F.col(key) <= F.lit(last) if last is not None else F.col(key).isNull()
    keys = F.coalesce(keys, F.lit(True)) if last is not None else keys  # a null key comes first
    return df.where((special < place) | (special == place) & ((number < at) | (number == at) & keys))


def _blocks(total: int) -> list[int]:
    """Ranks after which a new block begins, evenly spaced."""
    n = min(BLOCKS, -(-total // BLOCK_ROWS))
    return [total * i // n for i in range(1, n)] if n > 1 else []


def scan(
    df: DataFrame, value: str, key: str, running: Mapping[str, Column] | None = None, previous: Mapping[str, str] | None = None,
    descending: bool = True, rank: str = "rank", peers: str | None = None, total: str = "n_rows",
    wanted: Callable[[int], Sequence[int]] = _blocks,
) -> DataFrame:
    """Every row with its rank, running sums and the row before's columns, over all rows in order.

    Cuts at even ranks make blocks of equal size, ties included, and carry into each the
    rank and the sums of all before it. Rows move once, to their block, where windows do
    the rest; the first row of a block gets the last row of the block before.

    ``running`` names sums of whole numbers or decimals, which do not depend on the order
    of addition; ``previous`` maps new columns to those whose value one row earlier they take.
    ``peers`` names the least rank among rows of equal value. Eager for the cuts; the rows
    are left to Spark. Blocks grow beyond ``BLOCK_ROWS`` only when there are ``BLOCKS``.
    """
    running, previous, text = dict(running or {}), dict(previous or {}), _checked(df, value, key)
    found = refine(df, value, key, lambda n: [*wanted(n), n], running, descending)
    n_rows, cuts = found.totals[None], found.cuts[None]
    starts = [0, *[c.rank for c in cuts[:-1]]]
    at_cuts = {c.rank: c for c in cuts}

    rows = df.withColumns({"_row": F.struct(*df.columns)}).select("_row", F.col(value).alias("_value"), F.col(key).alias("_k"), *[x.alias(f"_s{i}") for i, x in enumerate(running.values())])
    special, number = _ordered(F.col("_value"), descending)
    rows = rows.withColumns({"_g": F.lit(0), "_class": special, "_v": number, "_block": F.lit(None).cast("int")})
    for level, bits in found.levels:
        numbered = [(p, s, c, None if b is None else bisect_right(starts, b[1]) - 1, *shape) for p, s, c, b, *shape in level]
        rows = _found(rows.withColumnRenamed("_block", "_settled"), numbered, text, bits, ["_block"], "left")
        rows = rows.withColumn("_block", F.coalesce("_settled", "_block")).drop("_settled")
    kinds = [f.dataType for f in df.agg(F.count("*"), *[F.sum(x) for x in running.values()]).schema][1:]
    if not all(isinstance(kind, (LongType, DecimalType)) for kind in kinds):
        raise TypeError("running sums must be of whole numbers or decimals")
    exact = [int if isinstance(kind, LongType) else Decimal for kind in kinds]
    before = [(i, s, *[kind(at_cuts[s].sums[name] if s else 0) for name, kind in zip(running, exact)]) for i, s in enumerate(starts)]
    carried = df.sparkSession.createDataFrame(before, ", ".join(["_block int", "_start long", *[f"_c{i} {kind.simpleString()}" for i, kind in enumerate(kinds)]]))
    if len(starts) > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        rows = rows.repartition(len(starts), "_block")

    order = [F.col("_class"), F.col("_v"), F.col("_k")]
    within = W.partitionBy("_block").orderBy(*order)
    upto = within.rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = rows.join(F.broadcast(carried), "_block").drop(*_STATE)
    columns = {rank: F.col("_start") + F.row_number().over(within)}
    columns |= {name: F.col(f"_c{i}") + F.coalesce(F.sum(f"_s{i}").over(upto), F.lit(0)) for i, name in enumerate(running)}
    columns |= {f"_lag_{name}": F.lag(F.col(f"_row.{source}")).over(within) for name, source in previous.items()}
    made = placed.select("_row", "_block", "_class", "_v", "_start", *[x.alias(name) for name, x in columns.items()])
    if previous:
        lasts = _lasts(df, value, key, sorted(set(previous.values())), starts, at_cuts, descending)
        made = made.join(F.broadcast(lasts), "_block", "left")
        first = F.col(rank) == F.col("_start") + 1
        made = made.withColumns({name: F.when(first, F.col(f"_last.{source}")).otherwise(F.col(f"_lag_{name}")) for name, source in previous.items()})
    out = [*[F.col(f"_row.{c}").alias(c) for c in df.columns], *[F.col(c) for c in (rank, *running, *previous)], F.lit(n_rows).cast("long").alias(total)]
    if peers:
        made = made.join(F.broadcast(_first_ranks(df, value, key, starts, at_cuts, descending)), ["_class", "_v"], "left")
        least = F.col("_start") + F.rank().over(W.partitionBy("_block").orderBy("_class", "_v"))
        out.append(F.coalesce("_first", least).cast("long").alias(peers))
    return made.select(*out)


def _located(df: DataFrame, value: str, key: str, spots: list[tuple], descending: bool, *also: Column) -> DataFrame:
    """Rows whose value is that of a spot (number, class, value, key), with it; there are no more spots than blocks."""
    special, number = _ordered(F.col(value), descending)
    kinds = f"_spot int, _class int, _v double, _at {df.schema[key].dataType.simpleString()}"
    table = F.broadcast(df.sparkSession.createDataFrame(spots, kinds))
    return df.select(*also, special.alias("_class"), number.alias("_v"), F.col(key).alias("_k")).join(table, ["_class", "_v"])


def _lasts(df: DataFrame, value: str, key: str, sources: Sequence[str], starts: list[int], at_cuts: dict[int, Cut], descending: bool) -> DataFrame:
    """The row right before each block, found by its value and key."""
    spots = [(i, *at_cuts[s].last) for i, s in enumerate(starts) if s]
    rows = _located(df, value, key, spots, descending, F.struct(*sources).alias("_last"))
    return settle(rows.where(F.col("_k").eqNullSafe(F.col("_at"))).select(F.col("_spot").alias("_block"), "_last"))


def _first_ranks(df: DataFrame, value: str, key: str, starts: list[int], at_cuts: dict[int, Cut], descending: bool) -> DataFrame:
    """For each value that reaches over the end of a block, the rank of its first row."""
    spots, seen = [], set()
    for s in starts:
        if s and at_cuts[s].last[:2] not in seen:
            seen.add(at_cuts[s].last[:2])
            spots.append((s, *at_cuts[s].last))
    rows = _located(df, value, key, [(i, *rest) for i, (_, *rest) in enumerate(spots)], descending)
    upto = F.count_if(F.coalesce(F.col("_k") <= F.col("_at"), F.col("_k").isNull()))
    ends = df.sparkSession.createDataFrame([(i, s) for i, (s, *_) in enumerate(spots)], "_spot int, _end long")
    counted = rows.groupBy("_spot", "_class", "_v").agg(upto.alias("_upto")).join(F.broadcast(ends), "_spot")
    return settle(counted.select("_class", "_v", (F.col("_end") - F.col("_upto") + 1).alias("_first")))
