"""Licence scan by canonical digests. DataFrame functions only.

The canonical form of a text: lower case; lines that state a copyright go;
punctuation and white space of any kind are one space; words with several
spellings take one. The SHA-256 of a whole text's form is joined with the digests
of known licences, and so is that of each line that is not longer than the longest
known text, for licence notices inside other text.

``ORACLE`` holds the texts of ``known()`` alone, not those of ``whole_texts()``.

Known texts are a parameter. Their table is broadcast if it has at most
``SMALL`` rows, which is counted; a larger one is joined by a shuffle on the digest.

Defined cases: null and empty text, and text of copyright lines and punctuation
alone, have the digest of the empty string and no licence; of known texts with
one digest the first id counts; equal rows give equal results; an empty table
gives an empty result, empty known texts find nothing; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm import base
from tripflow.llm.license_texts import SPELLINGS, known, whole_texts

#: Rows of known texts up to which they are broadcast.
SMALL = 10_000
#: A line, lower-cased, that states a copyright.
COPYRIGHT = (
    r"^[^a-z0-9]*(copyright[^a-z].*([0-9]{4}|\(c\)|©|<year>|\[year\]|\[yyyy\]).*|(\(c\)|©).*[0-9]{4}.*|all rights reserved[^a-z0-9]*)$"
)
#: ASCII other than letters and digits, and the quotes, dashes, dots and signs outside ASCII.
PUNCTUATION = r"[\x{0}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}\x{A0}\x{A9}\x{AB}\x{BB}\x{2010}-\x{201F}\x{2022}\x{2026}]+"


def canonical_lines(text: Column) -> Column:
    """Canonical form of the lines of a text, '' for those that go."""
    spelling = F.create_map(*[F.lit(x) for pair in SPELLINGS.items() for x in (pair[0], pair[1].replace("-", " "))])

    def line(x: Column) -> Column:
        words = F.split(F.trim(F.regexp_replace(x, PUNCTUATION, " ")), " ")
        same = F.transform(words, lambda w: F.coalesce(F.try_element_at(spelling, w), w))
        return F.when(x.rlike(COPYRIGHT), F.lit("")).otherwise(F.array_join(same, " "))

    return F.transform(F.split(F.lower(text), "\n"), line)


def scan(df: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """(doc_id, digest, license_id, n_notices, notices) of every row of ``df`` (doc_id, text).

    texts: (license_id, text) of known licences and notices, the built-in ones if
    not given.
    """
    spark = df.sparkSession
    if texts is None:
        texts = spark.createDataFrame(known() + whole_texts(), "license_id string, text string")
    table = (
        texts.where("text is not null and license_id is not null")
        .select("license_id", whole(canonical_lines(F.col("text"))).alias("form"))
        .where("form <> ''")
        .groupBy(F.sha2("form", 256).alias("digest"))
        .agg(F.min("license_id").alias("license_id"), F.max(F.length("form")).alias("size"))
    )
    facts = table.agg(F.count("*").alias("n"), F.max("size").alias("longest")).first()
    longest = facts["longest"] or 0
    table = table.select("digest", "license_id")
    if facts["n"] <= SMALL:
        table = F.broadcast(table)

    lines = df.select("doc_id", F.xxhash64("text").alias("text_hash"), canonical_lines(base.text_of(df)).alias("lines"))
    short = F.filter("lines", lambda x: (x != "") & (F.length(x) <= longest))
    formed = lines.select(
        "doc_id", "text_hash", F.sha2(whole(F.col("lines")), 256).alias("digest"),
        F.array_distinct(F.transform(short, lambda x: F.sha2(x, 256))).alias("short"),
    )
    notices = (
        formed.select("doc_id", "text_hash", F.explode("short").alias("digest"))
        .join(table, "digest")
        .groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("license_id")).alias("notices"))
    )
    found = formed.drop("short").join(table, "digest", "left").alias("a").join(
        notices.alias("b"),
        F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & F.col("a.text_hash").eqNullSafe(F.col("b.text_hash")),
        "left",
    )
    held = F.coalesce("b.notices", F.array().cast("array<string>"))
    return found.select(
        "a.doc_id", "a.digest", "a.license_id",
        F.size(held).cast("long").alias("n_notices"), F.array_join(held, ",").alias("notices"),
    )


def whole(lines: Column) -> Column:
    return F.array_join(F.filter(lines, lambda x: x != ""), " ")


def op3_license_digests(spark, sf_dir: str) -> DataFrame:
    """Every document's canonical digest, its licence if it is one, and the notices in it."""
    return scan(base.table(spark, sf_dir, "documents").select("doc_id", "text"))


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


FORM = f"""list_transform(string_split(lower(TEXT), chr(10)), lambda x: CASE WHEN regexp_matches(x, {quoted(COPYRIGHT)})
  THEN '' ELSE array_to_string(list_transform(string_split(trim(regexp_replace(x, {quoted(PUNCTUATION)}, ' ', 'g')), ' '),
  lambda w: CASE w {' '.join(f"WHEN {quoted(a)} THEN {quoted(b.replace('-', ' '))}" for a, b in SPELLINGS.items())} ELSE w END), ' ') END)"""
WHOLE = "array_to_string(list_filter(lines, lambda x: x <> ''), ' ')"
ORACLE = f"""
WITH given (license_id, text) AS (VALUES {', '.join(f'({quoted(a)}, {quoted(b)})' for a, b in known())}),
known AS (
  SELECT sha256({WHOLE}) AS digest, min(license_id) AS license_id
  FROM (SELECT license_id, {FORM.replace('TEXT', 'text')} AS lines FROM given) GROUP BY 1
),
formed AS (SELECT row_number() OVER () AS row, doc_id, {FORM.replace('TEXT', "coalesce(text, '')")} AS lines FROM documents),
notices AS (
  SELECT row, list_sort(list(DISTINCT known.license_id)) AS held
  FROM (SELECT row, sha256(unnest(list_filter(lines, lambda x: x <> ''))) AS digest FROM formed) JOIN known USING (digest)
  GROUP BY row
)
SELECT doc_id, sha256({WHOLE}) AS digest, known.license_id, coalesce(len(held), 0)::BIGINT AS n_notices,
  coalesce(array_to_string(held, ','), '') AS notices
FROM formed LEFT JOIN known ON known.digest = sha256({WHOLE}) LEFT JOIN notices USING (row)
"""
