"""Line dedup by a log-template tree.

A line is cut into tokens at white space, and a token with a digit becomes the
variable ``<*>``. The tree has a fixed depth: token count, then ``DEPTH`` leading
tokens. At a leaf of lines with at least ``SHORTEST`` tokens, the token most common at
a place (over the distinct lines of the leaf, ties to the token first in order)
makes the leaf's first template; a line that agrees with it at ``SHARE`` of its
places or more belongs to the template, whose other places are variable. A leaf
may hold more templates: of the lines left over, those that agree with each other at
``SHARE`` of their places are of one template (see ``more_templates``). Every other
line is its own template.

``ORACLE`` states the same rule as SQL.

A template recurs if it stands in several documents. It stays in the document
with the smallest id and is dropped everywhere else.

Lines travel as (document, line number, digests), not as text. Only lines of
leaves with several distinct lines are read again, found by a bit map of fixed
size. Nothing is gathered by leaf: places are counted by (leaf, place, token), lines
left over meet by runs of equal tokens, and equal lines are one before that.

Defined cases: null text counts as empty and stays null; lines without a token
are kept; documents are told apart by id, a null id is one of its own before all
others, so documents of one id drop nothing because of each other; equal rows
give equal results; an empty table gives an empty result; other columns are kept
by ``drop_lines`` and ignored by the query.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm import base
from tripflow.llm.components import components

DEPTH, SHARE = 3, 0.8
#: Shortest line of which one place may vary: of 4 tokens 80 % are all 4.
SHORTEST = 5
NO_ID = -(1 << 63)
#: Bits of the map of leaves, 8 MB.
MOST_BITS = 1 << 26
# white space without the line end
GAPS = str.maketrans("\t\v\f\r", "    ")
DIGIT = re.compile("[0-9]")


def tokens_of(line: str) -> list[str]:
    """Tokens of a line, those with a digit masked."""
    tokens = line.translate(GAPS).split(" ") if not line.isprintable() else line.split(" ")
    if "" in tokens:
        tokens = [t for t in tokens if t]
    if DIGIT.search(line):
        tokens = ["<*>" if DIGIT.search(t) else t for t in tokens]
    return tokens


def digest(text: str) -> bytes:
    return hashlib.md5(text.encode("utf-8", "surrogatepass")).digest()


def leaf_of(tokens: list[str]) -> bytes:
    return digest(f"{len(tokens)} " + " ".join(tokens[:DEPTH]))


def leaf_bit(leaf: bytes, bits: int) -> int:
    return int.from_bytes(leaf[:4], "big") & (bits - 1)


LINES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("text_hash", T.LongType()),
    T.StructField("place", T.IntegerType()),
    T.StructField("n", T.IntegerType()),
    T.StructField("leaf", T.BinaryType()),
    T.StructField("line", T.BinaryType()),
])
TEXTS = T.StructType([
    T.StructField("leaf", T.BinaryType()),
    T.StructField("line", T.BinaryType()),
    T.StructField("n", T.IntegerType()),
    T.StructField("masked", T.StringType()),
])


def lines_of(docs: DataFrame) -> DataFrame:
    """(id, text digest, place, tokens, leaf, digest) of every line with a token."""

    def work(batches):
        for ids, hashes, texts in batches:
            for a in range(0, len(ids), 500):
                rows = []
                for i, h, text in zip(ids[a : a + 500], hashes[a : a + 500], texts[a : a + 500], strict=True):
                    for place, line in enumerate(text.split("\n") if text else ()):
                        tokens = tokens_of(line)
                        if tokens:
                            rows.append((i, h, place, len(tokens), leaf_of(tokens), digest(" ".join(tokens))))
                yield rows

    own = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).cast("long").alias("id"), F.xxhash64("text").alias("h"), "text")
    return base.map_texts(own, work, LINES)


def bit_map(leaves: DataFrame) -> np.ndarray:
    """Bits of the leaves in ``leaves``: at most MOST_BITS / 64 rows come to the driver."""
    count, bits = leaves.count(), 1 << 16
    while bits < min(MOST_BITS, 16 * count):
        bits *= 2
    at = f"(conv(hex(substring(leaf, 1, 4)), 16, 10) % {bits}L)"
    words = leaves.select(F.expr(f"cast({at} as bigint)").alias("at")).groupBy(F.expr("shiftright(at, 6)").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(at & 63L as int)))").alias("mask")
    ).toArrow()
    held = np.zeros(bits // 64, dtype=np.int64)
    held[words["word"].to_numpy()] = words["mask"].to_numpy()
    return np.unpackbits(held.view(np.uint8), bitorder="little").astype(bool)


def texts_of(docs: DataFrame, held: np.ndarray, least: int) -> DataFrame:
    """(leaf, line, n, masked line) of the distinct lines whose leaf's bit is set, and ``least`` tokens or more."""
    packed = np.packbits(held)

    def work(batches):
        marked = np.unpackbits(packed).astype(bool)
        seen: set[bytes] = set()
        for (texts,) in batches:
            for a in range(0, len(texts), 500):
                rows = []
                for text in texts[a : a + 500]:
                    for line in text.split("\n") if text else ():
                        if line.count(" ") + 1 < least and line.isprintable():
                            continue
                        tokens = tokens_of(line)
                        if len(tokens) >= least and marked[leaf_bit(leaf := leaf_of(tokens), len(marked))]:
                            masked = " ".join(tokens)
                            if (d := digest(masked)) not in seen:
                                if len(seen) > 200_000:
                                    seen.clear()
                                seen.add(d)
                                rows.append((leaf, d, len(tokens), masked))
                yield rows

    return base.map_texts(docs.select("text"), work, TEXTS).dropDuplicates(["leaf", "line"])


def more_templates(rest: DataFrame, share: float) -> DataFrame:
    """(node, root) of the lines of ``rest`` (leaf, line, n, masked) that agree with another of their leaf.

    Lines that differ at k places or fewer are equal in one of k + 1 runs of places,
    so lines meet by (leaf, run, tokens) only. First each line is compared with the
    least line it meets in each run, which takes the lines of a frequent template at
    linear cost; then lines that agreed with no lesser one are compared with each
    other. Lines that agree are linked. As in any log-template tree, a line already
    linked to a lesser one brings no others into its template.
    """
    rest = base.keep(rest.select("leaf", "line", "n", F.split("masked", " ").alias("tokens")))
    runs = rest.withColumn("k", F.expr(f"cast(n - ceil(n * {share}D - 1e-9D) as int) + 1")).select(
        "leaf", "line",
        F.posexplode(F.expr(
            f"transform(sequence(0, k - 1), i -> xxhash64(array_join(slice(tokens, {DEPTH + 1} + cast(i * (n - {DEPTH}) div k as int),"
            f" cast((i + 1) * (n - {DEPTH}) div k - i * (n - {DEPTH}) div k as int)), ' ')))"
        )).alias("run", "key"),
    )
    by = ["leaf", "run", "key"]
    least = runs.groupBy(*by).agg(F.min("line").alias("a"), F.max("line").alias("z")).where("a <> z").select(*by, "a")
    met = base.keep(runs.join(least, by))
    links = base.keep(agreeing(met.where("line <> a").select("a", F.col("line").alias("b")).distinct(), rest, share))
    heads = base.keep(met.join(links.select(F.col("b").alias("line")).distinct(), "line", "left_anti").select(*by, "line"))
    pairs = (
        heads.withColumnRenamed("line", "a").join(heads.withColumnRenamed("line", "b"), by)
        .where("a < b").select("a", "b").distinct()
    )
    return components(links.unionByName(agreeing(pairs, rest, share)))


def agreeing(pairs: DataFrame, texts: DataFrame, share: float) -> DataFrame:
    """Those of ``pairs`` (a, b) whose lines agree at ``share`` of their places."""
    one = texts.select(F.col("line").alias("a"), "n", F.col("tokens").alias("own"))
    two = texts.select(F.col("line").alias("b"), F.col("tokens").alias("other"))
    same = F.size(F.filter(F.zip_with("own", "other", lambda x, y: x == y), lambda x: x))
    return pairs.join(one, "a").join(two, "b").where(same >= F.ceil(F.col("n") * share - 1e-9)).select("a", "b")


def templates(docs: DataFrame, lines: DataFrame, least: int, share: float) -> DataFrame:
    """(line, first): lines whose template recurs, with the smallest id of the template."""
    own = base.keep(lines.groupBy("leaf", "line", "n").agg(F.min("id").alias("first"), F.max("id").alias("last")))
    several = base.keep(
        own.where(F.col("n") >= least).groupBy("leaf").agg(F.min("line").alias("a"), F.max("line").alias("b"))
        .where("a <> b").select("leaf")
    )
    distinct = base.keep(texts_of(docs, bit_map(several), least).join(several, "leaf", "left_semi"))
    tokens = distinct.select("leaf", F.posexplode(F.split("masked", " ")).alias("place", "token"))
    common = (
        tokens.groupBy("leaf", "place", "token").agg(F.count("*").alias("c"))
        .groupBy("leaf", "place").agg(F.min(F.struct((-F.col("c")).alias("c"), "token"))["token"].alias("token"))
        .groupBy("leaf").agg(F.array_sort(F.collect_list(F.struct("place", "token")))["token"].alias("common"))
    )
    same = F.size(F.filter(F.zip_with(F.split("masked", " "), "common", lambda a, b: a == b), lambda x: x))
    near = base.keep(
        distinct.join(common, "leaf").where(same >= F.ceil(F.col("n") * share - 1e-9)).select("leaf", "line")
    )
    rest = distinct.join(near, ["leaf", "line"], "left_anti")
    groups = more_templates(rest, share).withColumnRenamed("node", "line")
    grouped = own.join(near.withColumn("near", F.lit(True)), ["leaf", "line"], "left").join(groups, "line", "left")
    # a template is a leaf's first, a further one by its least line or, for any other line, the line itself
    name = F.when(F.col("near"), F.col("leaf")).otherwise(F.coalesce("root", "line"))
    named = base.keep(grouped.select("line", name.alias("name"), "first", "last"))
    recurring = (
        named.groupBy("name").agg(F.min("first").alias("first"), F.max("last").alias("last")).where("first <> last")
    )
    return named.select("line", "name").join(recurring.select("name", "first"), "name").select("line", "first")


def drop_lines(docs: DataFrame, least: int = SHORTEST, share: float = SHARE) -> DataFrame:
    """``docs`` with struct column OUT: number of lines, of dropped lines, and the text that stays."""
    lines = base.keep(lines_of(docs))
    gone = (
        lines.join(templates(docs, lines, least, share), "line").where(F.col("id") != F.col("first"))
        .groupBy("id", "text_hash").agg(F.collect_set("place").alias("gone"))
        .withColumnsRenamed({"id": "__id", "text_hash": "__hash", "gone": "__gone"})
    )
    joined = docs.join(
        gone,
        (F.coalesce(docs["doc_id"], F.lit(NO_ID)) == gone["__id"]) & (F.xxhash64(docs["text"]) == gone["__hash"]),
        "left",
    )
    parts = F.split(docs["text"], "\n")
    stay = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("__gone")))
    text = F.when(F.col("__gone").isNull(), docs["text"]).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(parts, i)), "\n")
    )
    out = F.struct(
        F.when(docs["text"].isNull(), 0).otherwise(F.size(parts)).cast("long").alias("n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_dropped"),
        text.alias("text"),
    )
    return joined.withColumn(base.OUT, out).drop("__id", "__hash", "__gone")


def op10_line_templates(spark, sf_dir: str) -> DataFrame:
    """Every document with the lines that stay."""
    docs = base.table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_lines(docs).select("doc_id", f"{base.OUT}.*")


def line_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: texts without recurring lines; a document of nothing else goes, all of it stands elsewhere."""
    out = drop_lines(docs)
    found = F.col(base.OUT)
    emptied = (found["n_dropped"] > 0) & (F.trim(F.regexp_replace(found["text"], "[\\t-\\r ]+", " ")) == "")
    kept = out.where(~emptied)
    text = {"text": found["text"]}
    size = {"n_chars": F.length(found["text"]).cast("long")} if "n_chars" in docs.columns else {}
    return kept.withColumns(text | size).select(*docs.columns)


ORACLE = rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(doc_id, {NO_ID}) AS id, text, string_split(text, chr(10)) AS parts FROM documents),
raw AS (
  SELECT id, text, unnest(range(len(parts))) AS place, unnest(parts) AS line FROM (SELECT DISTINCT id, text, parts FROM d)
),
mask AS (
  SELECT id, text, place, regexp_replace(trim(regexp_replace(line, '[\t\v\f\r ]+', ' ', 'g')),
    '[^ ]*[0-9][^ ]*', '<*>', 'g') AS line FROM raw
),
leafed AS (
  SELECT *, len(string_split(line, ' ')) AS n,
    array_to_string(list_slice(string_split(line, ' '), 1, {DEPTH}), ' ') AS lead
  FROM mask WHERE line <> ''
),
own AS (SELECT n, lead, line, min(id) AS first, max(id) AS last FROM leafed GROUP BY ALL),
tokens AS (
  SELECT n, lead, line, unnest(range(n)) AS place, unnest(string_split(line, ' ')) AS token FROM own WHERE n >= {SHORTEST}
    AND (n, lead) IN (SELECT (n, lead) FROM own GROUP BY n, lead HAVING count(*) > 1)
),
counted AS (SELECT n, lead, place, token, count(*) AS c FROM tokens GROUP BY ALL),
common AS (
  SELECT n, lead, place, token AS best FROM counted
  QUALIFY row_number() OVER (PARTITION BY n, lead, place ORDER BY c DESC, token) = 1
),
near AS (
  SELECT n, lead, line FROM tokens JOIN common USING (n, lead, place) GROUP BY n, lead, line
  HAVING sum(CASE WHEN token = best THEN 1 ELSE 0 END) >= ceil(n * {SHARE} - 1e-9)
),
rest AS (
  SELECT DISTINCT n, lead, line, md5(line) AS h, string_split(line, ' ') AS t, n - ceil(n * {SHARE} - 1e-9)::INT + 1 AS k
  FROM tokens WHERE (n, lead, line) NOT IN (SELECT (n, lead, line) FROM near)
),
runs AS (
  SELECT n, lead, line, h, t, run,
    array_to_string(t[{DEPTH} + 1 + run * (n - {DEPTH}) // k : {DEPTH} + (run + 1) * (n - {DEPTH}) // k], ' ') AS key
  FROM (SELECT *, unnest(range(k)) AS run FROM rest)
),
met AS (SELECT *, arg_min(line, h) OVER g AS a, arg_min(t, h) OVER g AS a_t FROM runs WINDOW g AS (PARTITION BY n, lead, run, key)),
first_links AS (
  SELECT DISTINCT a, line AS b FROM met
  WHERE a <> line AND len(list_filter(list_zip(t, a_t), lambda x: x[1] = x[2])) >= ceil(n * {SHARE} - 1e-9)
),
heads AS (SELECT * FROM runs WHERE line NOT IN (SELECT b FROM first_links)),
links AS (
  SELECT a, b FROM first_links
  UNION
  SELECT x.line, y.line FROM heads x JOIN heads y USING (n, lead, run, key)
  WHERE x.h < y.h AND len(list_filter(list_zip(x.t, y.t), lambda z: z[1] = z[2])) >= ceil(x.n * {SHARE} - 1e-9)
),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (
  SELECT DISTINCT a AS line, a AS other FROM both_ways
  UNION SELECT r.line, e.b FROM reached r JOIN both_ways e ON r.other = e.a
),
grouped AS (SELECT line, min(other) AS root FROM reached GROUP BY line),
named AS (
  SELECT own.*, CASE WHEN near.line IS NOT NULL THEN 'leaf ' || own.n || ' ' || own.lead
    ELSE 'line ' || coalesce(grouped.root, own.line) END AS name
  FROM own LEFT JOIN near ON own.n = near.n AND own.lead = near.lead AND own.line = near.line
  LEFT JOIN grouped ON own.line = grouped.line
),
recurring AS (SELECT name, min(first) AS owner FROM named GROUP BY name HAVING min(first) <> max(last)),
gone AS (
  SELECT l.id, l.text, l.place FROM leafed l JOIN named USING (n, lead, line) JOIN recurring USING (name)
  WHERE l.id <> recurring.owner
),
stay AS (
  SELECT r.id, r.text, count(g.place) AS n_dropped,
    string_agg(r.line, chr(10) ORDER BY r.place) FILTER (WHERE g.place IS NULL) AS kept
  FROM raw r LEFT JOIN gone g ON r.id = g.id AND r.text = g.text AND r.place = g.place GROUP BY r.id, r.text
)
SELECT d.doc_id, coalesce(len(d.parts), 0)::BIGINT AS n_lines, coalesce(s.n_dropped, 0)::BIGINT AS n_dropped,
  CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(s.kept, '') END AS text
FROM d LEFT JOIN stay s ON d.id = s.id AND d.text = s.text
"""
