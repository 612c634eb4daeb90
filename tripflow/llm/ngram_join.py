"""Exact similarity join of documents' shingle sets, with skipping by set relations.

Two sets link when they share at least 80 % of their union. Shingles are put in
one order for all sets, rare ones first; a set's *prefix* is so long that linked
sets have a prefix shingle in common. Each shingle has an index list of the sets
that have it in their prefix, ordered by size and by place in the set.

Skipping inside a list: entries whose sizes differ too much, or whose places
leave too few shingles for the overlap needed, are passed over as blocks.

Skipping by answers: equal sets are one set from the start. Then each list is
read once, and every entry is compared with its block's central set and with the
entry before it only: a number of pairs in proportion to the list. Central is the set
with the fewest shingles before the list's own: what near copies have in common is more
frequent than what sets them apart, so that is the set most of them link with, also
those that link with few others. Verified links make groups. The answers of a group's sets are derived from each other's: two of
one group need no comparison, since the class of either is known. Only lists in
which several groups meet are read again: in ``TURNS`` rounds each entry is compared
with a few of other groups beside it, and groups that link become one. At last all
pairs across groups are compared that the lists' blocks leave. So a list of thousands
of near copies costs a few comparisons a set, not one a pair, and no link between
different groups is lost.

Rarity: shingles are counted in the prefixes by number alone, and wherever a task
meets one in several sets; those of many sets go to the end of the order. At most
``FREQUENT`` such shingles, the most frequent, travel to the tasks; any choice of them
gives the same links. Then the prefixes of that order are counted, and shingles of
one set only are left out of the lists, by a bit map of fixed size.

Set numbers, shingles, lists and links stay in Spark tables. A pair is first judged
by what its two prefixes share; whole sets are shuffled only for pairs that remain,
found by their numbers in a bit map of fixed size.

Defined cases: null, empty and blank texts have 0 shingles and are alone; a text of
fewer words than a shingle has one; rows of one doc_id are one node of the
links, each with its own size; a null doc_id is linked like others and its
component has the smallest non-null id, or null if there is none; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tripflow.llm import base
from tripflow.llm.components import components
from tripflow.llm.shingles import Shingler, set_number

#: A link: 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Shingles that travel to the tasks as frequent, and the least count of one.
FREQUENT, LEAST_COUNT = 300_000, 16
#: Entries of an index list that go to one task; longer lists are salted.
LIST = 50_000
#: Rounds in which neighbours of different groups are compared before all that is left, and entries beside one.
TURNS, BESIDE = 2, 3
#: Bits of the map of set numbers, 8 MB, and the power of two of bits in the map of shared shingles.
MOST_BITS, MAP_BITS = 1 << 26, 26
#: Shingles that are counted in one task, and shingles that a task counts together before it ships them.
PART, TOGETHER = 1_000_000, 1_500_000


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - (-(-percent * n // 100)) + 1


class Order:
    """Rare shingles first: those not counted as frequent by number, then the frequent by count."""

    def __init__(self, shingles: np.ndarray, counts: np.ndarray):
        at = np.argsort(shingles)
        self.shingles, self.counts = shingles[at], counts[at]

    def count(self, s: np.ndarray) -> np.ndarray:
        if not len(self.shingles):
            return np.zeros(len(s), dtype=np.int64)
        k = np.minimum(np.searchsorted(self.shingles, s), len(self.shingles) - 1)
        return np.where(self.shingles[k] == s, self.counts[k], 0)

    def prefix(self, s: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The first shingles of an ascending set in this order, and their counts."""
        c = self.count(s)
        at = np.argsort(c, kind="stable")[:length]
        return s[at], c[at]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def long(name: str) -> T.StructField:
    return T.StructField(name, T.LongType())


def map_arrays(df: DataFrame, work, fields: list[T.StructField]) -> DataFrame:
    """``mapInArrow``: record batches in, tuples of numpy arrays or lists out."""
    schema = T.StructType(fields)
    kind = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in fields])

    def run(batches):
        for columns in work(batches):
            if len(columns[0]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)], schema=kind
                )
                del columns
                base.give_back()

    return df.mapInArrow(run, schema)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, n, s, shingles): size, number and bytes of each document's set.

    A task gives the bytes of a set once, as a rule; its repetitions have null.
    """

    def work(batches):
        shingler = Shingler()
        seen: set[int] = set()
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for a in range(0, len(ids), 1000):
                sets = [shingler.of(t) for t in texts[a : a + 1000]]
                numbers = [set_number(x) if len(x) else None for x in sets]
                blobs = []
                for s, x in zip(numbers, sets, strict=True):
                    blobs.append(None if s is None or s in seen else x.tobytes())
                    if len(seen) > 200_000:
                        seen.clear()
                    seen.add(s)
                yield ids[a : a + 1000], [len(x) for x in sets], numbers, blobs

    fields = [long("doc_id"), long("n"), long("s"), T.StructField("shingles", T.BinaryType())]
    return map_arrays(docs.select(F.col("doc_id").cast("long"), "text"), work, fields)


def fresh_sets(batches):
    """(number, shingles) of the rows (s, shingles) of a task."""
    for b in batches:
        for s, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            yield s, np.frombuffer(blob, dtype="<u8")


def pieces(rows, size: int = 4000):
    """Lists of up to ``size`` items."""
    held = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def counted_together(sets):
    """Lists of sets with about ``TOGETHER`` shingles in all, at least one set each."""
    held, total = [], 0
    for x in sets:
        held.append(x)
        total += len(x)
        if total >= TOGETHER:
            yield held
            held, total = [], 0
    if held:
        yield held


BLOBS = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("blob", T.BinaryType())])


def counted_in_parts(sets: DataFrame, bits: int, counted, reduced, fields: list[T.StructField]) -> DataFrame:
    """Counts of shingles over all documents, worked out part by part.

    ``counted`` makes ascending shingles and their counts of a list of sets, the
    sets that a task has met together. A part holds the shingles that begin with
    the same ``bits`` bits: 2**bits is chosen so that a part is about ``PART``
    shingles. Tasks count first and ship (shingle, count) as bytes, without the
    weight of rows; a shingle of very many sets is one entry for all that a task
    counts together, sets of about ``TOGETHER`` shingles. ``reduced`` makes columns of a part's number, shingles and counts.
    """

    def work(batches):
        for some in counted_together(x for _, x in fresh_sets(batches)):
            x, n = counted(some)
            cuts = np.searchsorted(x, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
            cuts = np.append(cuts, len(x))
            for k in np.flatnonzero(np.diff(cuts)).tolist():
                own = slice(cuts[k], cuts[k + 1])
                yield [k], [x[own].tobytes() + n[own].astype("<u4").tobytes()]

    def reduce(part: pa.Table) -> pa.Table:
        blobs = part["blob"].to_pylist()
        x = np.concatenate([np.frombuffer(b, "<u8", len(b) // 12) for b in blobs])
        n = np.concatenate([np.frombuffer(b, "<u4", len(b) // 12, 8 * (len(b) // 12)) for b in blobs])
        at = np.argsort(x, kind="stable")
        x, n = x[at], n[at].astype(np.int64)
        first = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
        columns = reduced(part["part"][0].as_py(), x[first], np.add.reduceat(n, first))
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)], schema=kind)

    kind = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in fields])
    blobs = map_arrays(sets, work, list(BLOBS))
    return blobs.groupBy("part").applyInArrow(reduce, T.StructType(fields))


def frequent(sets: DataFrame, bits: int, percent: int, most: int) -> Order:
    """The order: shingles that many sets hold, counted over all documents.

    A shingle counts in the sets where it is among the first by number, and wherever
    a task meets it in several sets at once: the shingles of large groups all do,
    and those of one set alone, most of them, need not be shipped.
    """
    low = LEAST_COUNT

    def counted(some: list[np.ndarray]):
        x, n = np.unique(np.concatenate(some), return_counts=True)
        first = np.unique(np.concatenate([x[: prefix_length(len(x), percent)] for x in some]))
        kept = n > 1
        kept[np.searchsorted(x, first)] = True
        return x[kept], n[kept]

    def reduced(_: int, x: np.ndarray, n: np.ndarray):
        return signed(x[n >= low]), n[n >= low]

    many = base.keep(counted_in_parts(sets, bits, counted, reduced, [long("shingle"), long("n")]))
    sizes = many.groupBy(F.floor(F.log2("n")).cast("int").alias("k")).agg(F.count("*").alias("c")).collect()
    total, least = 0, 64
    for r in sorted(sizes, key=lambda r: -r["k"]):  # at most 64 rows
        total += r["c"]
        if total > most:
            break
        least = r["k"]
    got = many.where(F.col("n") >= 2**least).toArrow() if least < 63 else None  # at most ``most`` rows
    if got is None or not got.num_rows:
        return Order(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    order = Order(got["shingle"].to_numpy().view(np.uint64), got["n"].to_numpy())
    del got
    base.give_back()
    return order


def shared(sets: DataFrame, bits: int, map_bits: int, order: Order, percent: int) -> np.ndarray:
    """A bit map of the prefix shingles that several sets have, by their first bits.

    Shingles of one set only make no pairs; most are left out of the lists by this map
    of fixed size, and some stay when their bit is another's.
    """

    def reduced(part: int, x: np.ndarray, n: np.ndarray):
        held = np.zeros(1 << (map_bits - bits), dtype=bool)
        held[(x[n > 1] >> np.uint64(64 - map_bits)).astype(np.int64) - (part << (map_bits - bits))] = True
        return [part], [np.packbits(held).tobytes()]

    def counted(some: list[np.ndarray]):
        own = [order.prefix(x, prefix_length(len(x), percent))[0] for x in some]
        return np.unique(np.concatenate(own), return_counts=True)

    got = counted_in_parts(sets, bits, counted, reduced, list(BLOBS)).toArrow()  # 2**map_bits bits in all
    out = np.zeros((1 << map_bits) // 8, dtype=np.uint8)
    size = len(out) >> bits
    for part, blob in zip(got["part"].to_pylist(), got["blob"].to_pylist(), strict=True):
        out[part * size : (part + 1) * size] = np.frombuffer(blob, np.uint8)
    del got
    base.give_back()
    return out


ENTRY = [long("shingle"), T.StructField("salt", T.IntegerType()), long("n"), long("place"), long("s")]


def index(
    sets: DataFrame, order: Order, held: np.ndarray, map_bits: int, percent: int, list_size: int
) -> DataFrame:
    """Entries of the index lists; a list longer than ``list_size`` is salted by the set."""

    def work(batches):
        for part in pieces(fresh_sets(batches)):
            cols: list[list] = [[], [], [], [], []]
            for s, x in part:
                own, count = order.prefix(x, prefix_length(len(x), percent))
                bit = (own >> np.uint64(64 - map_bits)).astype(np.int64)
                place = np.flatnonzero((held[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1)
                own, count = own[place], count[place]
                salts = count // list_size + 1
                cols[0].append(signed(own))
                cols[1].append(np.where(salts > 1, (s & 0x7FFFFFFF) % salts, -1).astype(np.int32))
                cols[2].append(np.full(len(own), len(x)))
                cols[3].append(place)
                cols[4].append(np.full(len(own), s))
            yield tuple(np.concatenate(c) for c in cols)

    return map_arrays(sets, work, ENTRY)


LIVE = ["shingle", "salt", "n", "place", "s"]


def read_lists(entries: DataFrame, percent: int) -> DataFrame:
    """Entries of lists with several sets, with ``central`` and ``before``: the sets to compare each with.

    A block holds sizes within one factor; its central set is the one of the least
    place. Either is compared only if sizes and places allow a link. Null
    where there is nothing to compare. An entry of a salted list comes back even
    if it is alone there.
    """
    lists = Window.partitionBy("shingle", "salt").orderBy("n", "place", "s")
    rows = entries.dropDuplicates(LIVE).select(
        *LIVE,
        F.lag("s").over(lists).alias("s0"), F.lag("n").over(lists).alias("n0"), F.lag("place").over(lists).alias("place0"),
        F.lead("s").over(lists).alias("s1"),
    ).where("s0 is not null or s1 is not null or salt >= 0")
    block = F.floor(F.log("n") / float(np.log(100 / percent))).alias("block")
    rows = rows.withColumn("block", block)
    blocks = Window.partitionBy("shingle", "salt", "block").orderBy("place", "n", "s")
    central = F.first(F.struct("s", "n", "place")).over(blocks.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("c", central)
    before = may_link(F.col("n0"), F.col("place0"), F.col("n"), F.col("place"), percent)
    from_central = F.when(
        F.col("c.n") <= F.col("n"), may_link(F.col("c.n"), F.col("c.place"), F.col("n"), F.col("place"), percent)
    ).otherwise(may_link(F.col("n"), F.col("place"), F.col("c.n"), F.col("c.place"), percent))
    return rows.select(
        *LIVE,
        F.when(from_central & (F.col("c.s") != F.col("s")), F.col("c.s")).alias("central"),
        F.when(before & (F.col("s0") != F.col("s")), F.col("s0")).alias("before"),
        (F.col("c.s") == F.col("s")).alias("is_central"),
    )


def may_link(n0: Column, place0: Column, n: Column, place: Column, percent: int) -> Column:
    """Do sizes and places leave room for a link? n0 <= n; the places are of the first common shingle."""
    overlap = F.least(n0 - place0, n - place)
    return (n0 * 100 >= n * percent) & (overlap * (100 + percent) >= (n0 + n) * percent)


def sets_in(sets: DataFrame, numbers: DataFrame) -> DataFrame:
    """(s, shingles) of the sets in ``numbers`` (s), and of some others, as arrays."""
    count = numbers.count()
    bits = 1 << 16
    while bits < min(MOST_BITS, 16 * count):
        bits *= 2
    # a bit map of fixed size: at most MOST_BITS / 64 rows come to the driver
    words = numbers.groupBy(F.expr(f"shiftright(s & {bits - 1}L, 6)").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(s & 63L as int)))").alias("mask")
    ).toArrow()
    held = np.zeros(bits // 64, dtype=np.int64)
    held[words["word"].to_numpy()] = words["mask"].to_numpy()
    del words
    base.give_back()

    def work(batches):
        wanted = ((s, x) for s, x in fresh_sets(batches) if (int(held[(s & (bits - 1)) >> 6]) >> (s & 63)) & 1)
        for part in pieces(wanted, 500):
            yield [s for s, _ in part], [signed(x).tolist() for _, x in part]

    fields = [long("s"), T.StructField("shingles", T.ArrayType(T.LongType()))]
    return map_arrays(sets, work, fields).groupBy("s").agg(F.first("shingles").alias("shingles"))


def may_still_link(pairs: DataFrame, heads: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose prefixes have enough in common for a link.

    Of two sets take the one whose prefix ends earlier in the order. What the sets
    share is in both prefixes, or behind the end of that one's prefix.
    """
    left = heads.select(F.col("s").alias("a"), F.col("n").alias("na"), F.col("head").alias("x"))
    right = heads.select(F.col("s").alias("b"), F.col("n").alias("nb"), F.col("head").alias("y"))
    behind = F.ceil(F.greatest("na", "nb") * percent / 100) - 1
    most = F.size(F.array_intersect("x", "y")) + behind
    return pairs.join(right, "b").join(left, "a").where(
        most * (100 + percent) >= (F.col("na") + F.col("nb")) * percent
    ).select("a", "b")


def links_of(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link, each verified on its whole sets."""
    left = sets.select(F.col("s").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("s").alias("b"), F.col("shingles").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    met = pairs.join(right, "b").join(left, "a").select(
        "a", "b", common.alias("common"), F.size("x").alias("nx"), F.size("y").alias("ny")
    )
    return met.where(F.col("common") * 100 >= percent * (F.col("nx") + F.col("ny") - F.col("common"))).select("a", "b")


def verified(pairs: DataFrame, heads: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that link. Whole sets are fetched only for pairs that their prefixes leave."""
    left = base.keep(may_still_link(pairs, heads, percent))
    numbers = left.select(F.col("a").alias("s")).unionByName(left.select(F.col("b").alias("s"))).distinct()
    return base.keep(links_of(left, sets_in(sets, numbers), percent))


def ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def mixed_lists(named: DataFrame) -> DataFrame:
    """The entries (shingle, salt, n, place, s, g) of lists in which several groups meet."""
    lists = named.groupBy("shingle").agg(F.min("g").alias("g0"), F.max("g").alias("g1")).where("g0 <> g1")
    return named.join(lists.select("shingle"), "shingle")


def in_groups(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """``entries`` with the group of their set, ``g``; a set without links is its own."""
    own = groups.select(F.col("node").alias("s"), "root")
    return entries.join(own, "s", "left").select("shingle", "salt", "n", "place", "s", F.coalesce("root", "s").alias("g"))


def regrouped(named: DataFrame, old: DataFrame, groups: DataFrame) -> DataFrame:
    """``named`` in the groups that ``old`` ones, and sets that had no links, have become."""
    was = old.select("node", F.col("root").alias("was"))
    moved = groups.join(was, "node", "left").select(F.coalesce("was", "node").alias("g"), "root").where("g <> root")
    # few rows as a rule, so the entries need not be shuffled
    return named.join(base.keep(moved.distinct()), "g", "left").select(
        "shingle", "salt", "n", "place", "s", F.coalesce("root", "g").alias("g")
    )


def with_main(named: DataFrame) -> DataFrame:
    """``named`` with the largest group of each list, ``main``."""
    sizes = named.groupBy("shingle", "g").agg(F.count("*").alias("c"))
    return named.join(sizes.groupBy("shingle").agg(F.max(F.struct("c", "g"))["g"].alias("main")), "shingle")


def neighbours(named: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs (a, b) of different groups: each entry with ``BESIDE`` entries beside it in its list,
    and with the nearest of the list's largest group.

    Sizes within one factor stand together, in them the places that may link with equal
    sizes, and there the order changes with ``turn``. So pairs grow with the entries.
    """
    block = F.floor(F.log("n") / float(np.log(100 / percent)))
    late = F.col("place") * (100 + percent) > F.col("n") * (100 - percent)
    lists = Window.partitionBy("shingle", "salt").orderBy(block, late, F.xxhash64("s", F.lit(turn)), "s")
    entry = F.struct("s", "g", "n", "place")
    of_main = F.last(F.when((F.col("g") == F.col("main")) & ~late, entry), ignorenulls=True)
    beside = [F.lag(entry, k).over(lists) for k in range(1, BESIDE + 1)]
    beside.append(of_main.over(lists.rowsBetween(Window.unboundedPreceding, -1)))
    met = with_main(named).select("s", "g", "n", "place", F.array(*beside).alias("beside"))
    met = met.select("s", "g", "n", "place", F.explode("beside").alias("p")).where("p.g <> g")
    small = F.col("p.n") <= F.col("n")
    ends = [
        F.when(small, F.col(x + c)).otherwise(F.col(y + c)) for x, y in (("p.", ""), ("", "p.")) for c in ("n", "place")
    ]
    return met.where(may_link(*ends, percent)).select(*ordered("p.s", "s")).distinct()


def across(named: DataFrame, percent: int) -> DataFrame:
    """All pairs of sets in one list but of different groups, where sizes and places allow a link.

    Each list's largest group is met with the others only, never with itself.
    """
    lists = with_main(named)
    x, y = lists.where("g <> main").alias("x"), lists.alias("y")
    small = F.col("x.n") <= F.col("y.n")
    ends = [F.when(small, F.col(f"{p}.{c}")).otherwise(F.col(f"{q}.{c}")) for p, q in ("xy", "yx") for c in ("n", "place")]
    met = x.join(
        y,
        (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.g") != F.col("y.g"))
        & ((F.col("y.g") == F.col("y.main")) | (F.col("x.s") < F.col("y.s"))) & may_link(*ends, percent),
    )
    return met.select(*ordered("x.s", "y.s")).distinct()


def link_components(
    docs: DataFrame, percent: int = PERCENT, most: int = FREQUENT, list_size: int = LIST
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text)."""
    made = base.keep(shingle_sets(docs))
    own = made.select("doc_id", "n", "s")
    sets = made.where("shingles is not null").select("s", "shingles")
    total = own.agg(F.sum("n").alias("n")).first()["n"] or 0
    bits = 4
    while total * (100 - percent) // 100 >> bits > PART:
        bits += 1
    map_bits = max(bits + 3, 16)
    while map_bits < MAP_BITS and 1 << map_bits < 2 * total:
        map_bits += 1
    order = frequent(sets, bits, percent, most)
    held = shared(sets, bits, map_bits, order, percent)
    entries = index(sets, order, held, map_bits, percent, list_size)
    live = base.keep(read_lists(entries.repartition("shingle", "salt"), percent))
    # central sets of the salted parts of a list meet in a list of their own
    parts = live.where("salt >= 0 and is_central").select(*LIVE).withColumn("salt", F.lit(-2))
    between = read_lists(parts.repartition("shingle"), percent)
    near = live.unionByName(between)
    central = near.where("central is not null").select(*ordered("s", "central"))
    before = near.where("before is not null").select(*ordered("s", "before"))
    pairs = base.keep(central.unionByName(before).distinct())
    # a set's prefix, without the shingles that no other set has
    heads = base.keep(live.groupBy("s").agg(F.max("n").alias("n"), F.collect_list("shingle").alias("head")))
    links = verified(pairs, heads, sets, percent)
    groups = components(links)
    named = base.keep(mixed_lists(in_groups(live, groups)))
    for turn in range(TURNS):
        tested = neighbours(named, turn, percent).join(pairs, ["a", "b"], "left_anti")
        tested = base.keep(tested)
        more = verified(tested, heads, sets, percent)
        pairs = pairs.unionByName(tested)
        if more.isEmpty():  # another order may still bring one
            continue
        links = links.unionByName(more)
        old, groups = groups, components(links)
        named = base.keep(mixed_lists(regrouped(named, old, groups)))
    more = verified(across(named, percent).join(pairs, ["a", "b"], "left_anti"), heads, sets, percent)
    if not more.isEmpty():
        links = links.unionByName(more)
        groups = components(links)
    # the same document may stand in several rows: its sets belong together
    named = own.where("s is not null").select("doc_id", "s").distinct()
    root = F.coalesce("root", "s")
    ties = (
        named.join(groups, F.col("s") == F.col("node"), "left").select("doc_id", root.alias("g")).where("doc_id is not null")
        .groupBy("doc_id").agg(F.min("g").alias("a"), F.max("g").alias("b")).where("a <> b")
    )
    ties = base.keep(ties)
    if not ties.isEmpty():
        groups = components(links.unionByName(ties_of(own, ties)))
    sets_to = (
        own.where("s is not null").groupBy("s").agg(F.min("doc_id").alias("least"))
        .join(groups, F.col("s") == F.col("node"), "left").select("s", "least", root.alias("g"))
    )
    least = sets_to.groupBy("g").agg(F.min("least").alias("component_id"))
    by_set = base.keep(sets_to.join(least, "g").select("s", "component_id"))
    return own.join(by_set, "s", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def ties_of(own: DataFrame, ties: DataFrame) -> DataFrame:
    """Links between the sets of documents with several different ones."""
    sets = own.where("s is not null").join(ties.select("doc_id"), "doc_id", "left_semi")
    least = sets.groupBy("doc_id").agg(F.min("s").alias("first"))
    return sets.join(least, "doc_id").where("s <> first").select(*ordered("s", "first")).distinct()


def op6_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Every document's set size and component."""
    return link_components(base.table(spark, sf_dir, "documents").select("doc_id", "text"))


#: Column that the stage adds on the way.
NODE = "__llm_node"


def join_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group stays, the one with the smallest id.

    Texts without words are in no group and stay as they are. Ids are below 2**62: a row
    without id is known by a larger number made of its text, so it stays only where no
    row of its group has an id. Of several rows with the id that stays one is left, the
    first by its columns as JSON.
    """
    if NODE in docs.columns or base.OUT in docs.columns:
        raise ValueError(f"columns {NODE} and {base.OUT} are not allowed")
    of_text = F.xxhash64("text").bitwiseAND((1 << 62) - 1) + (1 << 62)
    has_words = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    named = docs.withColumn(NODE, F.when(has_words, F.coalesce(F.col("doc_id").cast("long"), of_text)))
    found = link_components(named.where(F.col(NODE).isNotNull()).select(F.col(NODE).alias("doc_id"), "text"))
    gone = found.where("component_id <> doc_id").select(F.col("doc_id").alias(NODE)).distinct()
    again = found.where("component_id = doc_id").groupBy(F.col("doc_id").alias(NODE)).count().where("count > 1")
    again = base.keep(again.select(NODE))
    left = named.join(gone, NODE, "left_anti")
    if again.isEmpty():
        return left.select(docs.columns)
    row = F.struct(*docs.columns)
    # partial minima first: many rows of one id are never in one task
    first = left.join(again, NODE, "left_semi").groupBy(NODE).agg(F.min_by(row, F.to_json(row)).alias(base.OUT))
    return left.join(again, NODE, "left_anti").select(docs.columns).unionByName(first.select(f"{base.OUT}.*"))
