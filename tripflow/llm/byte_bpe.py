"""Byte-level BPE with Spark's higher-order functions over distinct words.

A text is cut into words by the tokenizer's pattern. A word begins as the ids of its
bytes, and a fold joins, step by step, the adjacent pair of least rank, leftmost
first, until no pair has a rank; the rank of a pair is the id of the joined piece.
After a step only the two pairs beside the new piece are looked up again. Ranks
are a literal in the expression: each left piece has its row of right pieces, and the
rows are laid over each other in one flat array, so that a look-up is two places read
and one comparison; a literal map would be searched from end to end. The ids of a word's
bytes and the ranks of neighbouring bytes, the fold's start, come with the word. Decoding takes the bytes of all ids of a batch from one
table and cuts them by text.

Words are counted over all documents, by task first. Those that recur are folded once,
in a job of their own, and their ids are broadcast, as flat arrays looked up by
two 64-bit numbers of the word: at most ``COMMON`` words, the most frequent, of at most
``LONG`` bytes. Each of the others stands in few places, mostly in one, and is folded
there, once for a document. Both folds are the same expression; which word goes
which way decides time only. Texts are cut twice, which is cheap, and never
shuffled; only counted words are.

Words of more than ``LONG`` bytes join all places of the best pair at one step. That
is the same in a table where every piece is what the fold makes of its own bytes, as in
any trained one (the tests check it for the table in use): a joined piece that
ranked before the pair would have been made before. It keeps the steps to the
number of different pairs instead of the number of bytes.

Defined cases: null is the empty text, without ids, and decodes to nothing;
very long texts and words are cut and folded like any other, in one task; equal rows
give equal results; an empty table gives an empty result; other columns are kept by
``encode_texts``, which refuses its own names, and ignored by the query. White space,
letters and numbers are those of the tokenizer's library.
"""

from __future__ import annotations

import base64
import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions.project import select_once
from tripflow.llm import base
from tripflow.llm.word_cutter import PATTERN, Cutter, Words, classes, groups, spread

#: Words whose ids are broadcast, at most; bytes of a long word; counted words that a task holds before it adds and ships them.
COMMON, LONG, HELD = 1_000_000, 48, 600_000
#: Ids of some texts that are put together at a time.
AT_ONCE = 200_000
#: Columns that ``encode_texts`` adds on the way.
CODED, RARE_IDS = "__llm_coded", "__llm_rare_ids"


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: lines of a piece in base 64 and its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}


def bound(value: Column, body) -> Column:
    """``body(value)`` with the value worked out, or a literal held, once."""
    return F.get(F.transform(F.array(value), body), 0)


#: Row of a piece that begins no pair: every look-up is before the first slot.
NO_ROW = -(1 << 20)
#: Places tried at a time.
BLOCK = 2048
#: How a fold begins: ids of a word's bytes, and the rank of each with the next one.
START = pa.struct([("ids", pa.list_(pa.int32())), ("ranks", pa.list_(pa.int32()))])


def pair_rows(ranks: dict[bytes, int]) -> tuple[list[int], list[int]]:
    """Rows of joined ids by left id, laid over each other: row starts, and slots.

    The slot at a row's start plus the right id holds left * 65536 + joined id, as a signed
    32-bit number; -1 is none. Rows with many pairs are laid first, each at the first place
    behind the row before where all its slots are free.
    """
    if max(ranks.values()) >= (1 << 16) - 1:
        raise ValueError("ids must be below 65535")
    own: dict[int, dict[int, int]] = {}
    for t, r in ranks.items():
        for k in range(1, len(t)):
            a, b = ranks.get(t[:k]), ranks.get(t[k:])
            if a is not None and b is not None:
                own.setdefault(a, {})[b] = r
    starts = np.full(max(ranks.values()) + 1, NO_ROW, dtype=np.int64)
    slots = np.full(4 << 16, -1, dtype=np.int64)
    free = np.ones(len(slots), dtype=bool)
    low, length = 0, 65
    for a, row in sorted(own.items(), key=lambda x: (-len(x[1]), x[0])):
        right = np.array(sorted(row), dtype=np.int64)
        beside = right[1:] - right[0]
        if len(row) < length:  # short rows fit where longer ones did not
            low, length = int(np.argmax(free)), len(row)
        at = None
        while at is None:
            if low + BLOCK + right[-1] >= len(slots):
                slots = np.append(slots, np.full(len(slots), -1, dtype=np.int64))
                free = np.append(free, np.ones(len(free), dtype=bool))
            places = low + np.flatnonzero(free[low : low + BLOCK])
            for b in beside.tolist():
                places = places[free[places + b]]
                if len(places) <= 4:
                    break
            at = next((p for p in places.tolist() if free[p + beside].all()), None)
            low = low + BLOCK if at is None else at
        starts[a] = at - right[0]
        free[starts[a] + right] = False
        slots[starts[a] + right] = (a << 16) + np.array([row[b] for b in right.tolist()], dtype=np.int64)
    slots = slots[: int(np.flatnonzero(~free).max(initial=0)) + 1].astype(np.uint32).view(np.int32)
    return starts.tolist(), slots.tolist()


def literal_pairs(ranks: dict[bytes, int]) -> Column:
    """A literal struct of arrays: the rows of ``pair_rows``."""
    starts, slots = pair_rows(ranks)
    return F.from_json(F.lit(json.dumps({"starts": starts, "slots": slots}, separators=(",", ":"))), "starts array<int>, slots array<int>")


def joined(table: Column, left: Column, right: Column) -> Column:
    """Id of two pieces joined, null where there is none."""
    slot = F.get(table["slots"], F.get(table["starts"], left) + right)
    return F.when(F.shiftrightunsigned(slot, 16) == left, slot.bitwiseAND(0xFFFF))


class Bytes:
    """Ids of single bytes, and of two bytes joined (-1: none)."""

    def __init__(self, ranks: dict[bytes, int]):
        self.one = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.two = np.full(1 << 16, -1, dtype=np.int32)
        for t, r in ranks.items():
            if len(t) == 2:
                self.two[t[0] * 256 + t[1]] = r

    def starts(self, words: pa.StringArray) -> pa.StructArray:
        """How the fold of each word begins, as START."""
        cuts = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int32)
        held = words.buffers()[2] if len(words) else None
        x = np.frombuffer(held, np.uint8)[cuts[0] : cuts[-1]] if held is not None else np.zeros(0, np.uint8)
        cuts = cuts - cuts[0]
        ranks = np.append(self.two[x[:-1].astype(np.int32) * 256 + x[1:]], np.int32(-1))[: len(x)]
        ranks[cuts[1:][np.diff(cuts) > 0] - 1] = -1
        ends = pa.array(cuts, pa.int32())
        lists = [pa.ListArray.from_arrays(ends, v) for v in (pa.array(self.one[x]), pa.array(ranks, mask=ranks < 0))]
        return pa.StructArray.from_arrays(lists, fields=list(START))


def pair_ranks(ids: Column, table: Column) -> Column:
    """Rank of each piece with the next one; null where the pair has none, and at the end."""
    return F.zip_with(ids, F.slice(ids, F.lit(2), F.size(ids)), lambda a, b: joined(table, a, b))


def best_place(ranks: Column) -> Column:
    """The first place, from 1, of the least rank; null if there is none."""
    return F.array_position(ranks, F.array_min(ranks)).cast("int")


def join_first(state: Column, table: Column) -> Column:
    """The state with the pair at its best place joined."""
    ids, ranks, at = state["ids"], state["ranks"], state["at"]
    new = F.get(ranks, at - 1)
    rest = F.slice(ranks, at + 2, F.size(ranks))
    right = F.array(joined(table, new, F.get(ids, at + 1)))
    beside = F.when(
        at > 1,
        F.flatten(F.array(F.slice(ranks, F.lit(1), at - 2), F.array(joined(table, F.get(ids, at - 2), new)), right, rest)),
    ).otherwise(F.flatten(F.array(right, rest)))
    after = F.flatten(F.array(F.slice(ids, F.lit(1), at - 1), F.array(new), F.slice(ids, at + 2, F.size(ids))))
    return bound(beside, lambda r: F.struct(after.alias("ids"), r.alias("ranks"), best_place(r).alias("at")))


def join_all(state: Column, table: Column) -> Column:
    """The state with every place of the best pair joined, from the left."""
    ids, ranks, at = state["ids"], state["ranks"], state["at"]
    text = F.concat(F.lit("<"), F.array_join(ids, "><"), F.lit(">"))
    pair = F.concat(F.lit("<"), F.get(ids, at - 1).cast("string"), F.lit("><"), F.get(ids, at).cast("string"), F.lit(">"))
    done = F.replace(text, pair, F.concat(F.lit("<"), F.get(ranks, at - 1).cast("string"), F.lit(">")))
    after = F.split(F.substring(done, F.lit(2), F.length(done) - 2), "><").cast("array<int>")
    return bound(after, lambda x: begin(x, table))


def begin(ids: Column, table: Column) -> Column:
    return bound(pair_ranks(ids, table), lambda r: F.struct(ids.alias("ids"), r.alias("ranks"), best_place(r).alias("at")))


def fold(start: Column, table: Column, join) -> Column:
    """Ids of a word after all merges, from its start."""
    steps = F.sequence(F.lit(1), F.greatest(F.size(start["ids"]) - 1, F.lit(1)))
    first = F.struct(start["ids"].alias("ids"), start["ranks"].alias("ranks"), best_place(start["ranks"]).alias("at"))
    step = lambda state, _: F.when(state["at"].isNull(), state).otherwise(join(state, table))
    return F.aggregate(steps, first, step, lambda state: state["ids"])


def folded_ids(start: Column, table: Column) -> Column:
    """Ids of a word by the fold; ``start`` is one of ``Bytes.starts``."""
    return F.when(
        F.size(start["ids"]) <= LONG, fold(start, table, join_first)
    ).otherwise(fold(start, table, join_all))


@dataclass
class Ready:
    """Ids of words, by two numbers of each: sorted by the first."""

    h1: np.ndarray
    h2: np.ndarray
    cuts: np.ndarray
    ids: np.ndarray

    def places(self, words: Words) -> np.ndarray:
        """The place of each distinct word in the table, -1 if it is not there."""
        if not len(self.h1) or not len(words):
            return np.full(len(words), -1, dtype=np.int64)
        k = np.searchsorted(self.h1, words.h1)
        out = np.full(len(words), -1, dtype=np.int64)
        # more than one word of the table may have the first number
        for step in range(self.same):
            at = np.minimum(k + step, len(self.h1) - 1)
            hit = (self.h1[at] == words.h1) & (self.h2[at] == words.h2)
            out[hit] = at[hit]
        return out

    @property
    def same(self) -> int:
        """How many words of the table share a first number, at most."""
        runs = np.diff(np.flatnonzero(np.concatenate([[True], self.h1[1:] != self.h1[:-1], [True]])))
        return int(runs.max())


def added(held: list[tuple]) -> pa.RecordBatch:
    """Words and their counts, from (number, count, word) of several groups of texts.

    Two words of one number would be counted as the first: that may only make a word rare.
    """
    numbers, first, which = np.unique(np.concatenate([h for h, _, _ in held]), return_index=True, return_inverse=True)
    n = np.zeros(len(numbers), dtype=np.int64)
    np.add.at(n, which, np.concatenate([n for _, n, _ in held]))
    return pa.RecordBatch.from_arrays([pa.concat_arrays([w for _, _, w in held]).take(pa.array(first)), pa.array(n)], ["word", "n"])


def counted_words(df: DataFrame, cutter: tuple[str, bytes], column: str) -> DataFrame:
    """(word, n) of the distinct words of all texts."""

    def work(batches):
        cut, held, size = Cutter(*cutter), [], 0
        for b in batches:
            texts = b.column(0).to_pylist()
            for low, high in groups([len(t) for t in texts]):
                words = cut.cut(texts[low:high])
                if len(words):
                    held.append((words.h1, np.bincount(words.codes, minlength=len(words)), words.names(np.arange(len(words)))))
                    size += len(words)
                if size >= HELD:
                    yield added(held)
                    held, size = [], 0
                    base.give_back()
        if held:
            yield added(held)
        del held
        base.give_back()

    parts = df.select(base.text_of(df, column).alias("text")).mapInArrow(work, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def ready_words(
    df: DataFrame, cutter: tuple[str, bytes], table: Column, letters: Bytes, column: str, most: int = COMMON
) -> Ready:
    """The words that recur, up to ``most`` by classes of their counts, folded once each."""
    several = base.keep(counted_words(df, cutter, column).where((F.col("n") > 1) & (F.octet_length("word") <= LONG)))
    kind = F.when(F.col("n") < 64, F.col("n")).otherwise(58 + F.floor(F.log2("n")))
    sizes = several.groupBy(kind.cast("int").alias("k")).agg(F.count("*").alias("c"), F.min("n").alias("n")).collect()
    total, least = 0, None
    for r in sorted(sizes, key=lambda r: -r["k"]):  # at most 128 rows
        total += r["c"]
        if total > most:
            break
        least = r["n"]
    if least is None:
        none = np.zeros(0, dtype=np.uint64)
        return Ready(none, none, np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.int32))

    @F.arrow_udf("struct<h1: long, h2: long, start: struct<ids: array<int>, ranks: array<int>>>")
    def numbers(words: pa.Array) -> pa.Array:
        own = [x.view(np.int64) for x in Cutter(*cutter).numbered(words.to_pylist())]
        return pa.StructArray.from_arrays([*own, letters.starts(words)], ["h1", "h2", "start"])

    slots = 4 * df.sparkSession.sparkContext.defaultParallelism
    chosen = several.where(F.col("n") >= least).select("word").repartition(slots).select(numbers("word").alias("h"))
    ids = F.get(F.transform(F.array("h.start"), lambda w: bound(table, lambda t: folded_ids(w, t))), 0)
    got = chosen.select("h.h1", "h.h2", ids.alias("ids")).toArrow()  # ``most`` rows, some 50 bytes each
    h1, h2 = (got[c].to_numpy().view(np.uint64) for c in ("h1", "h2"))
    order = np.argsort(h1, kind="stable")
    sizes = np.concatenate([x.value_lengths().to_numpy() for x in got["ids"].chunks])
    flat = np.concatenate([x.flatten().to_numpy().astype(np.uint16) for x in got["ids"].chunks])
    del got
    h1, h2 = h1[order], h2[order]
    first, sizes = (np.cumsum(sizes, dtype=np.int64) - sizes)[order], sizes[order]
    ready = Ready(h1, h2, np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), flat[spread(first, sizes)])
    del flat, first, order, sizes
    base.give_back()
    return ready


def coded_rows(df: DataFrame, rank_path: str, pattern: str, column: str, most: int) -> DataFrame:
    """``df`` with CODED, the ids of each text but for its rare words, and RARE_IDS, theirs."""
    for name in (base.OUT, CODED, RARE_IDS):
        if name in df.columns:
            raise ValueError(f"a column {name} is not allowed")
    ranks = read_ranks(rank_path)
    table, letters = literal_pairs(ranks), Bytes(ranks)
    del ranks
    cutter = (pattern, classes() if pattern == PATTERN else b"")
    base.give_back()
    shared = df.sparkSession.sparkContext.broadcast(ready_words(df, cutter, table, letters, column, most))

    @F.arrow_udf("struct<ids: array<int>, rare: array<struct<ids: array<int>, ranks: array<int>>>>")
    def coded(column: pa.Array) -> pa.Array:
        """Ids of the words that are ready, and the starts of the others; of a text, its k-th is -1 - k among the ids."""
        base.give_back()
        cut, ready, ids, rare = Cutter(*cutter), shared.value, [], []
        texts = column.to_pylist()
        for a, b in groups([len(t) for t in texts]):
            words = cut.cut(texts[a:b])
            at = ready.places(words)
            start = ready.cuts[np.maximum(at, 0)]
            size = np.where(at >= 0, ready.cuts[np.minimum(at, len(ready.cuts) - 2) + 1] - start, 1) if len(ready.h1) else np.ones(len(at), dtype=np.int64)
            own = size[words.codes]
            before = np.concatenate([[0], np.cumsum(own)])
            flat = np.empty(int(before[-1]), dtype=np.int32)
            held = at[words.codes] >= 0
            flat[spread(before[:-1][held], own[held])] = ready.ids[spread(start[words.codes][held], own[held])]
            absent = np.flatnonzero(~held)
            text_of = np.searchsorted(words.cuts, absent, side="right") - 1
            # distinct words of each text, as one number
            pairs, which = np.unique(text_of * len(words) + words.codes[absent], return_inverse=True)
            first = np.searchsorted(pairs, np.arange(b - a) * len(words))
            flat[before[absent]] = -1 - (which - first[text_of])
            ids.append(pa.ListArray.from_arrays(pa.array(before[words.cuts], pa.int32()), pa.array(flat)))
            starts = letters.starts(words.names(pairs % max(len(words), 1)))
            rare.append(pa.ListArray.from_arrays(pa.array(np.append(first, len(starts)), pa.int32()), starts))
        joined = [pa.concat_arrays(x) if x else pa.array([], t) for x, t in ((ids, pa.list_(pa.int32())), (rare, pa.list_(START)))]
        return pa.StructArray.from_arrays(joined, ["ids", "rare"])

    marked = df.withColumn(CODED, coded(base.text_of(df, column)))
    folded = F.transform(F.col(CODED)["rare"], lambda w: bound(table, lambda t: folded_ids(w, t)))
    # a generator's output: Catalyst would otherwise copy the fold into the second UDF's arguments
    return select_once(marked, F.col(CODED)["ids"].alias(CODED), folded.alias(RARE_IDS), keep=tuple(df.columns))


def encode_texts(df: DataFrame, rank_path: str, pattern: str, column: str = "text", most: int = COMMON) -> DataFrame:
    """``df`` with array column OUT: the ids of every text."""
    coded = coded_rows(df, rank_path, pattern, column, most)
    return coded.withColumn(base.OUT, completed(CODED, RARE_IDS)).drop(CODED, RARE_IDS)


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def completed(ids: pa.Array, rare_ids: pa.Array) -> pa.Array:
    """Lists of ids in which the k-th of each row's further lists stands for -1 - k."""
    return complete_all(ids, rare_ids)


def complete_all(ids: pa.Array, rare_ids: pa.Array) -> pa.Array:
    out = [complete(ids.slice(a, b - a), rare_ids.slice(a, b - a)) for a, b in groups(lengths(ids).tolist(), AT_ONCE)]
    return pa.concat_arrays(out) if out else ids


def lengths(lists: pa.Array) -> np.ndarray:
    return lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def complete(ids: pa.Array, rare_ids: pa.Array) -> pa.Array:
    flat = ids.flatten().to_numpy(zero_copy_only=False)
    cuts = np.concatenate([[0], np.cumsum(lengths(ids))])
    later = np.flatnonzero(flat < 0)
    lists = rare_ids.flatten()
    first = np.concatenate([[0], np.cumsum(lengths(rare_ids))])
    sizes = lengths(lists)
    starts = np.cumsum(sizes) - sizes
    k = first[np.searchsorted(cuts, later, side="right") - 1] - 1 - flat[later]
    own = np.ones(len(flat), dtype=np.int64)
    own[later] = sizes[k]
    before = np.concatenate([[0], np.cumsum(own)])
    out = np.empty(int(before[-1]), dtype=np.int32)
    ready = flat >= 0
    out[before[:-1][ready]] = flat[ready]
    out[spread(before[later], sizes[k])] = lists.flatten().to_numpy(zero_copy_only=False)[spread(starts[k], sizes[k])]
    return pa.ListArray.from_arrays(pa.array(before[cuts], pa.int32()), pa.array(out))


class Pieces:
    """The bytes of the pieces, one after another."""

    def __init__(self, rank_path: str):
        ranks = read_ranks(rank_path)
        pieces = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            pieces[rank] = piece
        self.sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        self.letters = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def joined(self, ids: pa.Array) -> pa.Array:
        """The bytes of lists of ids: their pieces, concatenated."""
        done = []
        for a, b in groups(lengths(ids).tolist(), AT_ONCE):
            part = ids.slice(a, b - a)
            flat = part.flatten().to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(lengths(part))])
            out = self.letters[spread(self.starts[flat], self.sizes[flat])].tobytes()
            cuts = np.concatenate([[0], np.cumsum(self.sizes[flat])])[ends].tolist()
            done.append(pa.array([out[x:y] for x, y in zip(cuts, cuts[1:], strict=False)], pa.binary()))
        return pa.concat_arrays(done) if done else pa.array([], pa.binary())


def decoded(ids: Column, rank_path: str) -> Column:
    """Bytes of ids."""
    pieces = Pieces(rank_path)

    @F.arrow_udf("binary")
    def bytes_of(ids: pa.Array) -> pa.Array:
        return pieces.joined(ids)

    return bytes_of(ids)


def round_trip(df: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row of ``df`` (doc_id, text).

    Ids are written before they are completed and decoded, so that a task has one Python worker at a time.
    """
    pieces = Pieces(rank_path)

    @F.arrow_udf("struct<ids: array<int>, bytes: binary>")
    def both(ids: pa.Array, rare_ids: pa.Array) -> pa.Array:
        """Ids, and what they decode to: one Python worker a task for the two."""
        base.give_back()
        whole = complete_all(ids, rare_ids)
        return pa.StructArray.from_arrays([whole, pieces.joined(whole)], ["ids", "bytes"])

    coded = coded_rows(df.select("doc_id", "text"), rank_path, pattern, "text", COMMON)
    coded = base.keep(coded.select("doc_id", CODED, RARE_IDS))
    out = F.col(base.OUT)
    return coded.withColumn(base.OUT, both(CODED, RARE_IDS)).select(
        "doc_id",
        F.size(out["ids"]).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(out["ids"].cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(out["bytes"], 256).alias("decoded_sha256"),
    )


def op8_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    import public_tokenizers

    docs = base.table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def code_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: the documents' ids and digests."""
    import public_tokenizers

    return round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
