"""Operators that compare texts with each other or with tables, and the pipeline."""

from __future__ import annotations

import hashlib
import os
import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.llm.common import OUT, clashing, documents, lower_ascii, tables
from tripflow.llm import base, byte_bpe, components, license_scan, license_texts, line_dedup, ngram_join, topk

SF = "/root/testdata/sf0.001"


def by_sql(sql, **frames):
    con = duckdb.connect()
    for name, df in frames.items():
        con.register(name, df.toArrow())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return Counter(tuple(r[names.index(c)] for c in sorted(names)) for r in cur.fetchall())


def rows_of(df):
    return Counter(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


# --- licences -------------------------------------------------------------------------------------


def test_licences_against_sql_and_cases(spark, tmp_path):
    mit = dict(license_scan.known())["MIT"]
    body = next(t for n, t in license_scan.known() if n == "MIT")
    rows = [
        (1, body), (2, "MIT LICENCE\nCopyright (c) 2020 Some One\n\n" + body.split("\n", 1)[1].replace('"', "“").upper()),
        (3, None), (4, ""), (5, "Copyright 2001 X\n--\n"), (6, "text\nLicensed under CC BY-NC 4.0.\nmore\nReleased under the MIT Licence"),
        (6, "text\nLicensed under CC BY-NC 4.0.\nmore\nReleased under the MIT Licence"), (None, "Released under the MIT License."),
        (8, body + " extra"), (9, "word " * 30000),
    ]
    df = documents(spark, rows)
    got = license_scan.scan(clashing(df))
    assert rows_of(got) == by_sql(license_scan.ORACLE, documents=df)
    held = {r.doc_id: r for r in got.collect()}
    assert held[1].license_id == held[2].license_id == "MIT" and held[8].license_id is None
    assert held[6].notices == "CC-BY-NC-4.0,MIT" and held[None].notices == "MIT"
    empty = hashlib.sha256(b"").hexdigest()
    assert held[3].digest == held[4].digest == held[5].digest == empty and mit
    sf = tables(spark, tmp_path, documents=df.limit(0))
    assert license_scan.op3_license_digests(spark, sf).count() == 0
    none = spark.createDataFrame([], "license_id string, text string")
    assert license_scan.scan(df, none).where("license_id is not null or n_notices > 0").count() == 0


def test_whole_licences_with_and_without_title(spark):
    common, rows, want = "/usr/share/common-licenses", [], {}
    for name, file in (("Apache-2.0", "Apache-2.0"), ("GPL-2.0", "GPL-2"), ("GPL-3.0", "GPL-3"), ("LGPL-3.0", "LGPL-3"),
                       ("MPL-2.0", "MPL-2.0"), ("CC0-1.0", "CC0-1.0")):
        with open(f"{license_texts.__file__.rpartition('/')[0]}/licenses/{name}.txt", encoding="utf-8") as f:
            text = f.read()
        if os.path.exists(f"{common}/{file}"):
            with open(f"{common}/{file}", encoding="utf-8") as f:
                assert f.read() == text
        lines = [x for x in text.split("\n") if x.strip()]
        bare = "\n".join(lines[3 if name == "Apache-2.0" else 2 :])
        terms = text.partition("END OF TERMS AND CONDITIONS")[0]
        for form in (text, bare, terms, "Copyright 2020 Some One\n\n" + bare.upper().replace("  ", " \t")):
            want[len(rows)] = name
            rows.append((len(rows), form))
    for name in ("ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause", "MIT"):
        want[len(rows)] = name
        rows.append((len(rows), "Copyright (c) 2020, Some One\n\n" + license_texts.TEXTS[name].split("\n", 1)[1]))
    got = {r.doc_id: r.license_id for r in license_scan.scan(documents(spark, rows)).collect()}
    assert got == want
    digests = {r.digest: r.license_id for r in license_scan.scan(documents(spark, [(0, rows[4][1] + " more")])).collect()}
    assert list(digests.values()) == [None]


def test_licences_run_no_python(spark):
    plan = license_scan.op3_license_digests(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- lines ----------------------------------------------------------------------------------------


def line_rows():
    rnd = random.Random(4)
    words = [f"w{chr(97 + k)}" for k in range(20)]
    line = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    common = [line(14) for _ in range(4)]
    rows = []
    for k in range(60):
        parts = [line(rnd.randint(1, 16)) for _ in range(rnd.randint(0, 4))]
        for c in rnd.sample(common, rnd.randint(0, 3)):
            tokens = c.split()
            for _ in range(rnd.randint(0, 3)):
                tokens[rnd.randrange(3, 14)] = rnd.choice([*words, "7", "x9"])
            parts.append("\t ".join(tokens) if k % 5 == 0 else " ".join(tokens))
        rows.append((k, "\n".join(parts)))
    full = next(t for _, t in rows if t.count("\n") > 2)
    rows += [(100, None), (101, ""), (102, "\n \n"), (103, full), (3, rows[3][1]), (None, rows[4][1]), (104, "page 1 of 9"),
             (105, "page 12 of 9\nown words here"), (106, "z " * 20000), (107, "z " * 20000)]
    return rows


def test_lines_against_sql(spark, tmp_path):
    df = documents(spark, line_rows())
    sf = tables(spark, tmp_path, documents=clashing(df))
    got = line_dedup.op10_line_templates(spark, sf)
    assert rows_of(got) == by_sql(line_dedup.ORACLE, documents=df)
    held = {r.doc_id: r for r in got.collect()}
    assert held[104].n_dropped == 0 and held[105].text == "own words here" and held[103].n_dropped == held[103].n_lines > 2
    sf = tables(spark, tmp_path / "e", documents=df.limit(0))
    assert line_dedup.op10_line_templates(spark, sf).count() == 0


def plain_line_dedup(rows, least):
    """Kept text of documents (id, text) of one id each: a leaf's modal template, then linked lines."""
    lines, leaves, first = {}, defaultdict(set), {}
    agree = lambda a, b: 100 * sum(x == y for x, y in zip(a, b, strict=True)) >= 80 * len(a)
    for i, text in rows:
        for place, line in enumerate(text.split("\n")):
            t = lines[i, place] = tuple("<*>" if re.search("[0-9]", w) else w for w in line.split())
            leaves[len(t), t[:3]].add(t)
    name = {t: t for own in leaves.values() for t in own}
    for leaf, own in leaves.items():
        if leaf[0] < least or len(own) < 2:
            continue
        modal = [min(Counter(p).items(), key=lambda x: (-x[1], x[0]))[0] for p in zip(*own, strict=True)]
        near = {t for t in own if agree(t, modal)}
        left, group = own - near, {}
        for t in left:
            joined = {group[u] for u in group if agree(t, u)} | {t}
            group |= {u: t for u in group if group[u] in joined} | {t: t}
        name |= dict.fromkeys(near, leaf) | group
    owners = defaultdict(set)
    for (i, _), t in lines.items():
        owners[name[t]].add(i)
    first = {n: min(ids) for n, ids in owners.items()}
    return {i: "\n".join(x for p, x in enumerate(text.split("\n")) if first[name[lines[i, p]]] == i) for i, text in rows}


def test_a_leaf_holds_several_templates(spark):
    rnd = random.Random(12)
    words = [f"w{chr(97 + k)}{chr(97 + j)}" for k in range(20) for j in range(20)]
    rows = [[k, []] for k in range(40)]
    for leaf in range(12):
        n = rnd.randint(10, 30)
        lead = [rnd.choice(words) for _ in range(3)]
        shared = [rnd.choice(words) for _ in range(n)]
        for _ in range(rnd.randint(2, 4)):  # templates of the leaf, equal at some places, with one variable place each
            own = lead + [shared[p] if rnd.random() < 0.3 else rnd.choice(words) for p in range(3, n)]
            at = rnd.randrange(3, n)
            for k in rnd.sample(range(40), 2 if leaf < 6 else rnd.randint(1, 9)):
                rows[k][1].append(" ".join(own[:at] + [rnd.choice(words)] + own[at + 1 :]))
    rows = [(k, "\n".join(lines)) for k, lines in rows if lines]
    got = {r.doc_id: r[OUT].text for r in line_dedup.drop_lines(documents(spark, rows)).collect()}
    want = plain_line_dedup(rows, 10)
    assert got == want
    pair = [f"And reornd atou {a} x {b}" for a, b in (("p q r s t", "u v w y z"), ("c d e f g", "h i j k l"))]
    rows = [(k, pair[k // 2].replace(" x ", f" {'mn'[k % 2]} ")) for k in range(4)]
    out = {r.doc_id: r[OUT].n_dropped for r in line_dedup.drop_lines(documents(spark, rows)).collect()}
    assert out == {0: 0, 1: 1, 2: 0, 3: 1}


def test_short_lines_have_templates(spark):
    names = ["alice", "bob", "carol", "dave"]
    forms = ["User logged in from {}", "User ran the job {} here", "now it {} so", "User {} logged in from host"]
    rows = [(k, "\n".join(f.format(names[k]) for f in forms)) for k in range(4)]
    out = {r.doc_id: r[OUT] for r in line_dedup.drop_lines(documents(spark, rows)).collect()}
    assert {i: o.text for i, o in out.items()} == plain_line_dedup(rows, 5)
    assert [out[k].n_dropped for k in range(4)] == [0, 2, 2, 2]  # lines of 4 tokens are exact, and a leading token tells leaves apart


def test_line_stage(spark):
    df = documents(spark, [(1, "one two three\nfour"), (2, "one two three"), (3, "one two three\nfive"), (4, ""), (5, None)])
    out = {r.doc_id: r for r in line_dedup.line_stage(spark, df, "").collect()}
    assert set(out) == {1, 3, 4, 5} and out[3].text == "five" and out[3].n_chars == 4 and out[1].text == "one two three\nfour"


# --- n-gram join ----------------------------------------------------------------------------------


def plain_components(rows):
    sets = []
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text or ""))
        sets.append((i, frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            (i, a), (j, b) = sets[x], sets[y]
            if a and b and 100 * len(a & b) >= 80 * len(a | b) or i == j and a and b and i is not None:
                root[find(x)] = find(y)
    groups = defaultdict(list)
    for x, (i, _) in enumerate(sets):
        groups[find(x)].append(i)
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return Counter((i, len(a), least[find(x)] if a else i) for x, (i, a) in enumerate(sets))


def near_copies(seed, n=160):
    rnd = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdefgh" for b in "xyzuvw"]
    text = lambda k: [rnd.choice(words) for _ in range(k)]
    passage, seeds, rows = text(25), [text(rnd.choice([4, 8, 30, 60, 90])) for _ in range(12)], []
    for k in range(n):
        own = list(rnd.choice(seeds)) if rnd.random() < 0.8 else text(rnd.randint(0, 50))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
            if own:
                own[rnd.randrange(len(own))] = rnd.choice(words)
        if rnd.random() < 0.3:
            own = own + passage if rnd.random() < 0.5 else passage + own
        if rnd.random() < 0.2:
            own = own[: rnd.randint(0, len(own))]
        rows.append((k, " ".join(own).title() if k % 3 else "  ".join(own)))
    return rows


@pytest.mark.parametrize(("seed", "most", "list_size"), [(1, 300_000, 50_000), (2, 0, 50_000), (3, 300_000, 8)])
def test_join_against_brute_force(spark, seed, most, list_size, monkeypatch):
    monkeypatch.setattr(ngram_join, "LEAST_COUNT", 4)
    rows = near_copies(seed) + [(900, None), (901, ""), (902, " \n"), (5, "a b c d e f g h"), (None, "a b c d e f g h"), (903, "p q")]
    rows += [(904, "one two three four five six"), (904, "one two three four five six"), (905, "long " * 30000)]
    got = ngram_join.link_components(clashing(documents(spark, rows)), most=most, list_size=list_size)
    assert Counter(tuple(r) for r in got.collect()) == plain_components(rows)


def test_sets_around_the_threshold_are_met_by_a_few(spark, monkeypatch):
    rng, words, rows = random.Random(3), [f"w{k}" for k in range(150)], []
    for k in range(400):
        own = list(words)
        for _ in range(rng.randrange(9)):
            at = rng.randrange(len(own))
            own[at : at + 1] = [] if rng.random() < 0.5 else [f"x{k}y{at}"]
        rows.append((k, " ".join(own)))
    met, whole = [], ngram_join.verified
    monkeypatch.setattr(ngram_join, "verified", lambda pairs, *rest: (met.append(pairs.count()), whole(pairs, *rest))[1])
    got = ngram_join.link_components(documents(spark, rows))
    assert Counter(tuple(r) for r in got.collect()) == plain_components(rows)
    # pairs left at last: 275; 2,112 where entries meet the set of least size first
    assert len(met) <= 4 and met[-1] < len(rows)


def test_join_of_an_empty_table_and_stage(spark, tmp_path):
    sf = tables(spark, tmp_path, documents=documents(spark, [(1, "a")]).limit(0))
    assert ngram_join.op6_ngram_jaccard_join(spark, sf).count() == 0
    text = " ".join(f"w{k}" for k in range(40))
    df = documents(spark, [(4, text), (2, text + " end"), (7, "other words are here and stay"), (8, ""), (9, None)])
    assert sorted(r.doc_id for r in ngram_join.join_stage(spark, df, "").collect()) == [2, 7, 8, 9]


def test_join_stage_keeps_one_row_of_a_group(spark):
    words = [f"w{k}" for k in range(60)]
    one, near, other = " ".join(words), " ".join([*words[:-1], "x"]), " ".join(reversed(words))
    df = documents(
        spark,
        [(5, one), (5, one), (5, near), (None, one), (7, near), (8, other), (None, "a b"), (None, "a b"), (9, ""), (9, ""), (7, " "), (None, None)],
    )
    got = ngram_join.join_stage(spark, clashing(df), "").collect()
    # group 5: one row; 8; one of the group without ids; rows without words stay
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == sorted(
        [(5, min(one, near)), (8, other), (0, "a b"), (9, ""), (9, ""), (7, " "), (0, "")]
    )
    with pytest.raises(ValueError, match="not allowed"):
        ngram_join.join_stage(spark, df.withColumn(ngram_join.NODE, F.lit(1)), "")


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(5, k) for k in range(200, 260)] + [(7, 7), (160, 100)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[k] == 100 for k in range(100, 161)) and all(got[k] == 5 for k in [5, *range(200, 260)]) and 7 not in got


# --- top-k ----------------------------------------------------------------------------------------


@pytest.mark.parametrize(("slices", "block"), [(4, 1024), (1, 3), (7, 2)])
def test_top_k_against_sql(spark, slices, block):
    rnd = random.Random(6)
    rows = [(k, [round(rnd.gauss(0, 1), 2) for _ in range(6)]) for k in range(300)]
    rows += [(k, rows[k % 50][1]) for k in range(300, 340)]  # ties
    rows += [(400, None), (401, [1.0, None] + [0.0] * 4), (402, [float("nan")] + [1.0] * 5), (403, [float("inf")] + [1.0] * 5),
             (450, [1.0, 2.0]), (451, [2.0, 1.0]), (500, []), (501, [0.0] * 6), (50, rows[50][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(df, df.where("vec_id % 50 = 0"), slices=slices, block=block)
    assert rows_of(got) == by_sql(topk.ORACLE, embeddings=df)


def test_top_k_edge_cases(spark):
    df = spark.createDataFrame([(0, [1.0, 1.0]), (1, [1.0, 0.0]), (None, [9.0, 9.0])], "vec_id long, embedding array<double>")
    df = clashing(df).withColumn("rank", F.lit("x"))
    got = [tuple(r) for r in topk.top_k(df, df.where("vec_id = 0")).collect()]
    assert got == [(0, 1, 1, 65536)]
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0
    big = spark.createDataFrame([(0, [1e30, 1.0]), (1, [1e30, 0.0]), (2, [-1e30, 1.0])], "vec_id long, embedding array<double>")
    assert [r.vec_id for r in topk.top_k(big, big.where("vec_id = 0")).orderBy("rank").collect()] == [1, 2]


# --- byte-level BPE -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def coder():
    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = byte_bpe.read_ranks(path)
    return path, public_tokenizers.PATTERN, tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_bpe_is_the_librarys(spark, coder):
    path, pattern, library = coder
    rnd = random.Random(3)
    parts = ["a", "th", "ing", " ", "  ", "\n", "\t", "é", "日本", "😀", "1", "23", ".", "!!", "'s", "'re", "　", " ",
             "\u0085", "ß", "Ж", "A", "\x00", "٣", "²", "́", "ā", "Ā"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30))) for _ in range(300)]
    texts += ["a" * 2000, "ab" * 500, "".join(rnd.choice("abcdethins") for _ in range(2000)), "āĀ" * 100, "word " * 4000]
    rows = [(k, t) for k, t in enumerate(texts)] + [(-1, None), (-2, ""), (None, "x"), (3, texts[3])]
    got = byte_bpe.round_trip(clashing(documents(spark, rows)), path, pattern)
    want = Counter()
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want[i, len(ids), digest, hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in got.collect()) == want
    assert byte_bpe.round_trip(documents(spark, rows).limit(0), path, pattern).count() == 0


# --- pipeline -------------------------------------------------------------------------------------


def test_pipeline(spark):
    import corpus_pipeline

    docs = base.table(spark, SF, "documents")
    kept = {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()}
    assert kept < {r.doc_id for r in docs.select("doc_id").collect()} and len(kept) > 50
    step = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        step = base.keep(stage(spark, step, SF))
        assert step.columns == docs.columns
    assert {r.doc_id for r in step.collect()} == kept
    # near copies and benchmark windows are gone from what is left
    left = [(r.doc_id, r.text) for r in step.collect()]
    assert all(i == root for i, _, root in plain_components(left))
    last = corpus_pipeline.STAGES[-1][1](spark, step, SF)
    texts = dict(left)
    assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in last.collect())
    assert OUT not in step.columns
