"""A trie of conversations by SQL ROLLUP over columns of turns.

Turns become ids; a conversation's turns lie in blocks of ``WIDTH`` columns t1 .. t8.
``GROUP BY block, node before the block, ROLLUP(t1, ..., t8)`` forms every prefix of
the block together, and ``grouping_id`` tells how many turns a group has. A longer
conversation goes on in a further block, keyed by the node that its block before
ends at; all blocks of all conversations are in one statement, with no round
for each depth. A node's key is the exclusive or of the hashes of its blocks so far, each
with the block's number, so the keys before all blocks come from a running aggregate,
over ``RUN`` blocks at a time and then over those runs.

A first ROLLUP gives each node its members and their smallest conv_id, which
represents it. The children of a key are counted; a node without any is a leaf. What a
subtree adds up comes from a second ROLLUP over values of whole conversations: a
conversation represents the nodes of its path from some depth on, so the text
lengths of a subtree's distinct nodes are those of its conversations from that
depth, and its leaves are those that conversations represent.

No step holds a group in one task. Turns are numbered by a global sort that splits a
conversation of very many turns; joins on a conversation are salted by runs of rows or
blocks; sums are partial first. A node with more than ``CHILDREN`` children, or a
10,000th of all nodes, hands its conv_id down by a broadcast: there are at
most 10,000 such nodes. The ids that end at a node are put together 4,096 at a time,
and those pieces pass one after another through one digest.

Turns, blocks and nodes are known by two 64-bit hashes each; two different ones agree
with a chance of about 2**-100. Texts are only hashed, whatever their length.

Defined cases: a null role or text is empty; turns of equal number are ordered by their
hashes, so a turn that stands twice counts twice; a null turn comes first; rows without
conv_id take no part; a table without conversations has no nodes; columns other than
conv_id, turn, role and text are ignored. ``%`` is that of SQL: it has the dividend's sign.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.functions.numbering import number_rows
from tripflow.llm import base

#: Turn columns of a block, blocks of a run, rows of a salted part, ids of a piece.
WIDTH, RUN, ROWS, PIECE = 8, 4096, 65_536, 4096
#: Children of a node from which it is broadcast, and the least share of nodes.
CHILDREN, SHARE = 1000, 10_000
#: Seeds of the two hashes.
SEEDS = (11, 47)
KEY = ("k1", "k2")


def hashes(*columns: Column) -> list[Column]:
    return [F.xxhash64(F.lit(seed), *columns) for seed in SEEDS]


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, row, h1, h2, n): turns in order, rows numbered over all conversations."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text")]
    h1, h2 = hashes(*parts)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        h1.alias("h1"), h2.alias("h2"), F.char_length(parts[1]).cast("long").alias("n"),
    )
    order = ["conv_id", "turn", "h1", "h2"]
    spread = rows.withColumn("at", F.monotonically_increasing_id())
    return base.keep(number_rows(spread, [*order, "at"], "row").select("conv_id", "row", "h1", "h2", "n"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conv_ids, and (conv_id, pos, h1, h2, n): the turns of the query's rebuilt conversations.

    The first h turns are those of the conversation c - c % 100, the others c's own.
    """
    own = turns.groupBy("conv_id").agg(F.min("row").alias("first"), F.count("*").alias("n_own")).withColumns({
        "h": F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(6)),
        "base": F.col("conv_id") - F.col("conv_id") % 100,
    })
    own = base.keep(own)
    bases = own.where("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.col("first").alias("base_first"), F.col("n_own").alias("n_base"))
    convs = base.keep(own.join(bases, "base", "left").withColumn("lent", F.least("h", F.coalesce("n_base", F.lit(0)))))
    # the rows of a conversation meet its figures in parts of ROWS rows
    part = F.expr(f"row div {ROWS}").alias("part")
    parts = turns.select("conv_id", part).distinct().join(convs.select("conv_id", "first", "h", "lent"), "conv_id")
    rest = (
        turns.withColumn("part", part).join(parts, ["conv_id", "part"]).where("row - first >= h")
        .select("conv_id", F.expr("row - first - h + lent").alias("pos"), "h1", "h2", "n")
    )
    heads = (
        turns.where("conv_id % 100 = 0").withColumn("part", part)
        .join(parts.where("conv_id % 100 = 0"), ["conv_id", "part"]).where("row - first < 5")
        .select(F.col("conv_id").alias("base"), F.expr("row - first").alias("pos"), "h1", "h2", "n")
    )
    lent = convs.where("lent > 0").select("conv_id", "base", "lent").join(heads, "base").where("pos < lent")
    return convs.select("conv_id"), rest.unionByName(lent.select(*rest.columns))


def turn(j: int) -> str:
    return f"t{j}"


TURNS = [turn(j) for j in range(1, WIDTH + 1)]


def block_key(block: Column, size: Column, turns: list[Column]) -> list[Column]:
    """Two hashes of a block's first turns; columns behind them are null and do not count."""
    return hashes(block.cast("long"), size.cast("long"), *turns)


def turn_blocks(turns: DataFrame) -> DataFrame:
    """(conv_id, block, part, size, t1.., k1, k2, chars) and the key and length before: p1, p2, before.

    One row for every ``WIDTH`` turns of a conversation.
    """
    at = F.pmod("pos", F.lit(WIDTH))
    cells = [F.max(F.when(at == j, F.col(c))).alias(f"{c}_{j}") for j in range(WIDTH) for c in ("h1", "h2", "n")]
    wide = turns.groupBy("conv_id", F.expr(f"pos div {WIDTH}").alias("block")).agg(
        F.count("*").alias("size"), F.sum("n").alias("chars"), *cells
    )
    shaped = wide.select(
        "conv_id", "block", F.expr(f"block div {RUN}").alias("part"), "size", "chars",
        *[
            F.when(F.col(f"n_{j}").isNotNull(), F.struct(*[F.col(f"{c}_{j}").alias(c) for c in ("h1", "h2", "n")])).alias(turn(j + 1))
            for j in range(WIDTH)
        ],
    )
    k1, k2 = block_key(F.col("block"), F.col("size"), [F.col(t) for t in TURNS])
    shaped = base.keep(shaped.withColumns({"k1": k1, "k2": k2}))
    earlier = Window.partitionBy("conv_id", "part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    runs = shaped.groupBy("conv_id", "part").agg(
        F.bit_xor("k1").alias("k1"), F.bit_xor("k2").alias("k2"), F.sum("chars").alias("chars")
    )
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")

    def over(window, prefix: str) -> list[Column]:
        return [
            F.coalesce(F.bit_xor("k1").over(window), none).alias(f"{prefix}1"),
            F.coalesce(F.bit_xor("k2").over(window), none).alias(f"{prefix}2"),
            F.coalesce(F.sum("chars").over(window), none).alias(f"{prefix}c"),
        ]

    outer = runs.select("conv_id", "part", *over(before, "q"))
    inner = shaped.select("*", *over(earlier, "p"))
    both = inner.join(outer, ["conv_id", "part"])
    return base.keep(both.select(
        *shaped.columns,
        F.col("p1").bitwiseXOR(F.col("q1")).alias("p1"), F.col("p2").bitwiseXOR(F.col("q2")).alias("p2"),
        (F.col("pc") + F.col("qc")).alias("before"),
    ))


def rolled_up(blocks: DataFrame, aggregates: str) -> DataFrame:
    """One row for each node but the root: its key, its parent's, depth, the lengths before and of its last turn, and ``aggregates``."""
    columns = ", ".join(TURNS)
    groups = blocks.sparkSession.sql(
        f"""
        SELECT block, p1, p2, before, {columns}, {WIDTH} - bit_count(grouping_id()) AS level, {aggregates}
        FROM {{blocks}}
        GROUP BY block, p1, p2, before, ROLLUP({columns})
        """,
        blocks=blocks,
    )
    level = F.col("level")
    last = F.coalesce(*[F.when(level == j, F.col(turn(j))) for j in range(1, WIDTH + 1)])
    # groups without turns are the node before the block; where the last turn is null, conversations have ended before
    nodes = groups.where((level > 0) & last.isNotNull())
    upper = [F.when(level > j, F.col(turn(j))) for j in range(1, WIDTH + 1)]
    own = block_key(F.col("block"), level, [F.col(t) for t in TURNS])
    above = block_key(F.col("block"), level - 1, upper)
    p = (F.col("p1"), F.col("p2"))
    lengths = [F.when(level > j, F.col(turn(j))["n"]).otherwise(0) for j in range(1, WIDTH)]
    others = [c for c in groups.columns if c not in ("block", "p1", "p2", "before", "level", *TURNS)]
    return nodes.select(
        *[p[i].bitwiseXOR(own[i]).alias(KEY[i]) for i in range(2)],
        *[F.when(level > 1, p[i].bitwiseXOR(above[i])).otherwise(p[i]).alias(f"parent_{KEY[i]}") for i in range(2)],
        (F.col("block") * WIDTH + level).alias("depth"),
        sum(lengths, F.col("before")).alias("before"),
        *others,
    )


def streamed_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (k1, k2, piece, ids) -> (k1, k2, ends_sha256): one digest for each key, piece by piece."""
    key, state = None, None
    names = [*KEY, "ends_sha256"]

    def batch(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string()), strict=True)], names
        )

    for b in batches:
        done = []
        for k1, k2, ids in zip(*(b.column(c).to_pylist() for c in (*KEY, "ids")), strict=True):
            if (k1, k2) != key:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (k1, k2), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        if done:
            yield batch(done)
    if key is not None:
        yield batch([(*key, state.hexdigest())])


def end_digests(ends: DataFrame) -> DataFrame:
    """(k1, k2, conv_id) -> (k1, k2, ends_sha256), the ids of each key in order."""
    numbered = number_rows(ends, [*KEY, "conv_id"], "row")
    pieces = numbered.groupBy(*KEY, F.expr(f"row div {PIECE}").alias("piece")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    )
    ordered = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "piece")
    return ordered.mapInArrow(streamed_digests, "k1 long, k2 long, ends_sha256 string")


def with_parent(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``parent_conv_id``: the conv_id of the node with the parent's key."""
    share = nodes.count() // SHARE
    least = max(CHILDREN, share)  # so at most SHARE nodes have more children
    above = nodes.where("n_children > 0").select(
        *[F.col(k).alias(f"parent_{k}") for k in KEY], F.col("conv_id").alias("parent_conv_id"), "n_children"
    )
    on = [f"parent_{k}" for k in KEY]
    crowded = above.where(F.col("n_children") > least).select(*on, F.col("parent_conv_id").alias("crowded"))
    marked = nodes.join(F.broadcast(crowded), on, "left")
    near = marked.where("crowded is not null").withColumn("parent_conv_id", F.col("crowded"))
    rest = marked.where("crowded is null").join(above.where(F.col("n_children") <= least).drop("n_children"), on, "left")
    return near.unionByName(rest.select(*near.columns))


def trie(conv_ids: DataFrame, turns: DataFrame) -> DataFrame:
    """Nodes of the conversations ``conv_ids`` (conv_id) with ``turns`` (conv_id, pos, h1, h2, n).

    Positions count from 0 without gaps. Columns as in the query.
    """
    blocks = turn_blocks(turns)
    shape = base.keep(rolled_up(blocks, "count(*) AS n_convs, min(conv_id) AS conv_id"))
    children = shape.groupBy(*[f"parent_{k}" for k in KEY]).agg(F.count("*").alias("n_children"))
    children = base.keep(children.select(*[F.col(f"parent_{k}").alias(k) for k in KEY], "n_children"))
    nodes = base.keep(shape.join(children, list(KEY), "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))

    # what each conversation stands for: nodes from some depth on, and maybe a leaf
    represented = nodes.groupBy("conv_id").agg(
        F.min("before").alias("before_first"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf")
    )
    held = blocks.groupBy("conv_id").agg(
        F.sum("chars").alias("total"), F.max("part").alias("parts"),
        F.bit_xor("k1").alias("k1"), F.bit_xor("k2").alias("k2"),
    )
    none = F.lit(0).cast("long")
    convs = base.keep(
        conv_ids.join(held, "conv_id", "left").join(represented, "conv_id", "left").select(
            "conv_id", "parts", *[F.coalesce(c, none).alias(c) for c in ("total", "leaf", *KEY)],
            F.coalesce(F.col("total") - F.col("before_first"), none).alias("own"),
        )
    )
    salted = convs.where("parts is not null").select(
        "conv_id", "total", "leaf", "own", F.explode(F.sequence(F.lit(0).cast("long"), "parts")).alias("part")
    )
    weighed = blocks.join(salted, ["conv_id", "part"])
    sums = rolled_up(
        weighed,
        "sum(total) AS totals, sum(own) AS owns, sum(leaf) AS n_leaves, "
        "min_by(total, conv_id) AS total, min_by(own, conv_id) AS own",
    ).select(*KEY, "totals", "owns", "n_leaves", "total", "own")
    full = nodes.join(sums, list(KEY))
    root_children = children.where("k1 = 0 and k2 = 0").agg(F.coalesce(F.sum("n_children"), none)).scalar()
    root = convs.agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum("total").alias("totals"),
        F.sum("own").alias("owns"), F.sum("leaf").alias("n_leaves"),
    ).where("n_convs > 0").withColumn("n_children", root_children)
    root = root.select(
        *[none.alias(k) for k in KEY], *[F.lit(None).cast("long").alias(f"parent_{k}") for k in KEY],
        none.alias("depth"), none.alias("before"), "n_convs", "conv_id", "n_children", "totals", "owns",
        F.greatest("n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(0)).cast("long").alias("n_leaves"),
        none.alias("total"), none.alias("own"),
    )
    ends = end_digests(convs.select(*KEY, "conv_id"))
    everything = full.select(*root.columns).unionByName(root).join(ends, list(KEY), "left")
    # members' texts from this depth on, less those of the subtree's distinct nodes
    members = F.col("totals") - F.col("n_convs") * F.col("before")
    distinct = F.col("total") - F.col("before") + F.col("owns") - F.col("own")
    return with_parent(base.keep(everything)).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (members - distinct).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def op13_rollup_trie(spark, sf_dir: str) -> DataFrame:
    """All prefixes of the rebuilt conversations."""
    conversations = base.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return trie(*rebuilt(turn_rows(conversations)))
