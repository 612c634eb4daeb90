"""The trie of conversations against a plain one."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tripflow.llm import prefix_trie

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def plain_nodes(paths):
    """Nodes of {conv_id: [(role, text), ...]}, by their definition."""
    members, kids = defaultdict(list), defaultdict(list)
    for c, v in paths.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0) + sum(saved[k] for k in kids[p])
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(paths[c]) == len(p))
        out.append((
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=lambda r: r[:2])


def plain_rebuilt(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append((-1 if t is None else t, r or "", x or ""))
    turns = {c: [(r, x) for _, r, x in sorted(v, key=lambda z: z[0])] for c, v in convs.items()}
    out = {}
    for c, v in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = turns.get(c - c % 100, [])[:h] + v[h:]
    return out


def made(spark, paths):
    """(conv_ids, turns) as ``trie`` takes them."""
    ids = spark.createDataFrame([(c,) for c in paths], "conv_id long")
    rows = [(c, i, r, x) for c, v in paths.items() for i, (r, x) in enumerate(v)]
    turns = spark.createDataFrame(rows, "conv_id long, pos long, role string, text string")
    h1, h2 = prefix_trie.hashes(F.col("role"), F.col("text"))
    return ids, turns.select("conv_id", "pos", h1.alias("h1"), h2.alias("h2"), F.char_length("text").cast("long").alias("n"))


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2])


@pytest.fixture
def small_parts(monkeypatch):
    """Runs, salted parts, pieces and crowds that small tables reach."""
    for name, value in {"RUN": 2, "ROWS": 5, "PIECE": 3, "CHILDREN": 2, "SHARE": 4}.items():
        monkeypatch.setattr(prefix_trie, name, value)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(prefix_trie.op13_rollup_trie(spark, SMALL)) == plain_nodes(plain_rebuilt(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_long_conversations_share_blocks(spark, small_parts, seed):
    rnd = random.Random(seed)
    text = lambda: (rnd.choice("ua"), rnd.choice(["", "x", "yy", "ü" * 3, "zzzz"]))
    stems = [[text() for _ in range(n)] for n in (0, 3, 8, 16, 17, 45)]
    paths = {}
    for c in range(60):
        stem = rnd.choice(stems)
        paths[c] = stem[: rnd.choice([len(stem), rnd.randrange(len(stem) + 1)])] + [text() for _ in range(rnd.choice([0, 0, 1, 2, 9]))]
    assert found(prefix_trie.trie(*made(spark, paths))) == plain_nodes(paths)


def test_ends_of_blocks(spark):
    """Conversations that end where a block does, one short of it and one beyond, with and without company."""
    turns = [("u", str(i)) for i in range(18)]
    paths = {c: turns[:n] for c, n in enumerate([8, 7, 9, 8, 16, 16, 17, 0, 0, 1])}
    assert found(prefix_trie.trie(*made(spark, paths))) == plain_nodes(paths)


def test_rebuilding_edges(spark, small_parts):
    rnd = random.Random(9)
    rows = []
    for c in [0, 1, 2, 3, 50, 99, 100, 101, 205, 310, 311, 10**12, 10**12 + 1]:
        for t in range(rnd.randrange(0, 9)):
            rows.append((c, t, rnd.choice(["u", None]), rnd.choice(["a", "b", None, "", "c" * 50_000])))
    rows += [(None, 0, "u", "lost"), (7, None, "u", "first"), (7, 0, "u", "second"), (99, 20, "u", "x"), (310, 3, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("row", "k1", "n", "block", "depth", "h1", "at")})
    assert found(prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.turn_rows(df)))) == plain_nodes(plain_rebuilt(rows))


def test_turns_of_equal_number_and_repeated_rows(spark):
    rows = [(1, 5, "u", "a"), (1, 5, "u", "a"), (1, 5, "u", "b"), (2, 5, "u", "b"), (2, 5, "u", "a"), (2, 5, "u", "a")]
    first = found(prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.turn_rows(spark.createDataFrame(rows, SCHEMA)))))
    again = found(prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.turn_rows(spark.createDataFrame(rows[::-1], SCHEMA).repartition(3)))))
    assert first == again


def test_only_turnless_conversations(spark):
    paths = {4: [], 2: []}
    assert found(prefix_trie.trie(*made(spark, paths))) == plain_nodes(paths)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.turn_rows(empty))).collect() == []


def test_many_conversations_end_at_one_node(spark, small_parts):
    paths = {c: [("u", "hello"), ("a", "hi")] for c in range(300, 100, -1)} | {c: [("u", "hello"), ("a", str(c))] for c in range(40)}
    assert found(prefix_trie.trie(*made(spark, paths))) == plain_nodes(paths)
