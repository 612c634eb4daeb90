"""Operators that work text by text: personal data, language, quality, token counts, benchmark windows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.common import OUT, clashing, documents, lower_ascii, tables
from tripflow.llm import decontaminate, language_id, pii, quality, token_counts
from tripflow.llm.transducer import Transducer

SF = "/root/testdata/sf0.001"

# --- personal data --------------------------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    def luhn(d):
        total = sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d)))
        return total % 10 == 0

    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m.group())
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


def test_base_spans_are_those_of_the_plain_patterns():
    rnd = random.Random(5)
    parts = ["a", "b.c", "@", "x@y.z", ".", "..", "1", "255", "256.1", "10.0.0.1", " ", "-", "+1", "(415)", "555-1234",
             "4111111111111111", "4111 1111 1111 1111", "é", "\n", "+", "00255", "%"]
    for _ in range(4000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_long_runs_take_linear_time():
    for text in ("9" * 300_000, "a" * 300_000 + "@", "1." * 100_000, "+1" + "(" * 200_000, "x@" * 50_000):
        pii.Graph(text)


def test_a_repeated_value_is_found_where_its_pattern_fails(spark):
    card = "4111111111111111"
    rows = [(k, f"pay {card} now or mail me@b.example.org from 10.1.2.{k}") for k in range(40)]
    rows += [(k, f"see {k} words, version {k % 9}.") for k in range(40, 80)]
    rows.append((99, f"card {card} ok. Then 12 {card} again."))
    df = documents(spark, rows)
    got = {r.doc_id: r[OUT] for r in pii.detect(df).collect()}
    assert [(s.kind, df_text(rows, 99)[s.start : s.end]) for s in got[99].base] == [(2, card)]
    assert [(s.kind, df_text(rows, 99)[s.start : s.end]) for s in got[99].added] == [(2, card)]
    assert not any(got[k].added or got[k].base for k in range(40, 80))


def df_text(rows, doc_id):
    return next(t for i, t, *_ in rows if i == doc_id)


def test_pii_query_edge_cases(spark, tmp_path):
    rows = [(1, None), (2, ""), (None, "a@b.cd"), (4, "a@b.cd"), (4, "a@b.cd"), (5, "z " * 20000 + "10.0.0.1")]
    sf = tables(spark, tmp_path, documents=clashing(documents(spark, rows)))
    got = pii.op1_pii_skip_chain(spark, sf).collect()
    assert len(got) == len(rows)
    empty = hashlib.sha256(b"").hexdigest()
    for r in got:
        text = {1: None, 2: "", None: "a@b.cd", 4: "a@b.cd", 5: rows[5][1]}[r.doc_id]
        spans = plain_spans(text or "")
        assert r.base_sha256 == (hashlib.sha256(pii.listed(spans).encode()).hexdigest() if spans else empty)
        assert (r.n_email, r.n_ip) == (sum(s[1] == 0 for s in spans), sum(s[1] == 1 for s in spans))
    sf = tables(spark, tmp_path / "e", documents=documents(spark, rows).limit(0))
    assert pii.op1_pii_skip_chain(spark, sf).count() == 0


# --- language -------------------------------------------------------------------------------------


def test_language_accuracy_on_held_out_documents(spark):
    got = language_id.op2_language_hyperdimensional(spark, SF).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_vectors_bundle_bound_letters():
    e = language_id.Encoder(128)
    letters = language_id.letter_vectors(np.array([32, 97, 98], dtype=np.uint64), 128).astype(int)
    gap, a, b = letters
    roll = lambda v, k: np.roll(v, k)
    want = roll(gap, 2) * roll(a, 1) * b + roll(a, 2) * roll(b, 1) * gap
    assert (e.vectors(["AB"])[0] == want).all() and (e.vectors([" aB!? "])[0] == want).all()


def test_language_edge_cases(spark, tmp_path):
    long = "the cat sat on the mat " * 5000
    rows = [(k, t, l) for k, (t, l) in enumerate([
        (None, "en"), ("", "en"), ("123 !!", "de"), ("der Hund und die Katze", "de"), ("the dog and the cat", "en"),
        (long, "en"), ("le chien et le chat", None), ("the dog and the cat", "en"),
    ])]
    sf = tables(spark, tmp_path, documents=clashing(documents(spark, [*rows, (None, "the cat", "en")])))
    got = {r.doc_id: r for r in language_id.op2_language_hyperdimensional(spark, sf).collect()}
    assert all(got[k].lang_pred == "und" and got[k].score == 0 for k in (0, 1, 2))
    assert got[5].lang_pred == "en" and got[6].lang_pred in ("en", "de")
    none = documents(spark, [(1, "some text", None)])
    assert language_id.identify(none, language_id.learn(none)).first()[OUT].lang_pred == "und"
    stage = language_id.language_stage(spark, documents(spark, rows), sf)
    assert sorted(r.doc_id for r in stage.collect()) == [3, 4, 5, 6, 7] and stage.columns == documents(spark, rows).columns
    sf = tables(spark, tmp_path / "e", documents=documents(spark, rows).limit(0))
    assert language_id.op2_language_hyperdimensional(spark, sf).count() == 0


# --- quality --------------------------------------------------------------------------------------


def test_quality_on_held_out_documents(spark):
    got = {r.doc_id: r for r in quality.op5_quality_subword(spark, "/root/testdata/sf0.01").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    held = [(r.quality, got[r.doc_id]) for r in labels if got[r.doc_id].held_out]
    assert sum(y == r.predicted for y, r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_quality_edge_cases(spark, tmp_path):
    rows = [(k, "bad bad bad !!" if k % 2 else "a quiet sentence of words") for k in range(30)]
    rows += [(100, None), (101, ""), (102, "x" * 100_000), (None, "a quiet sentence of words")]
    labels = spark.createDataFrame([(k, 1 - k % 2, 0) for k in range(30)] + [(None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    sf = tables(spark, tmp_path, documents=clashing(documents(spark, rows)), labels=labels)
    got = {r.doc_id: r for r in quality.op5_quality_subword(spark, sf).collect()}
    assert len(got) == len(rows) and got[100].score == got[101].score
    assert got[1].predicted == 0 and got[0].predicted == 1 and got[0].score == got[None].score
    docs = documents(spark, rows)
    empty = labels.select("doc_id", F.col("quality").alias("label")).limit(0)
    assert quality.fit(docs, empty).score("anything") == 0.5
    one = spark.createDataFrame([(1, 1)], "doc_id long, label int")
    assert quality.fit(docs, one).score("anything") == 1.0
    sf = tables(spark, tmp_path / "e", documents=docs.limit(0), labels=labels)
    assert quality.op5_quality_subword(spark, sf).count() == 0


# --- token counts ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def pieces():
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    return path, sentencepiece.SentencePieceProcessor(model_file=path)


def test_token_counts_are_the_librarys(spark, pieces):
    import pyarrow.parquet as pq

    texts = pq.read_table(f"{SF}/documents.parquet")["text"].to_pylist()
    rnd = random.Random(2)
    parts = ["a", "e", "th", "ing", " ", "  ", "é", "\n", "▁", "日", "😀", "0", "12", ".", "!!", "\x00", "The", "①", "и", "<s>"]
    texts += ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(1500)]
    texts += ["a" * 3000, "".join(rnd.choice("abcdethins") for _ in range(5000)), " " * 500, "the" * 2000]
    rows = [(k, t) for k, t in enumerate(texts)] + [(-1, None), (None, "x y"), (3, texts[3])]
    path, model = pieces
    out = token_counts.count_tokens(clashing(documents(spark, rows)), path)
    for r in out.select("text", f"{OUT}.*").collect():
        n = len(model.encode(r.text or ""))
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len((r.text or "").encode()), n > 4096)
    assert token_counts.count_tokens(documents(spark, rows).limit(0), path).count() == 0


def test_a_small_table_of_states_gives_the_same(pieces, monkeypatch):
    from tripflow.llm import transducer

    rnd = random.Random(3)
    words = ["▁" + "".join(rnd.choice("abcdethinsßé日😀") for _ in range(rnd.randint(1, 90))) for _ in range(400)]
    path, model = pieces
    machine = Transducer(token_counts.ranked_pieces(path))
    whole = machine.count_words(words)
    monkeypatch.setattr(transducer, "MOST_STATES", 300)
    small = Transducer(token_counts.ranked_pieces(path))
    assert (small.count_words(words, at_once=16) == whole).all()
    assert [len(model.encode(w[1:])) for w in words] == whole.tolist()


# --- benchmark windows ----------------------------------------------------------------------------


def plain_hits(text, items, size=10):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text or ""))
    hit, found = set(), set()
    for item, own in items:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(own or ""))
        for k in range(max(1, len(w) - size + 1) if w else 0):
            window = w[k : k + size]
            for p in range(len(words) - len(window) + 1):
                if words[p : p + len(window)] == window:
                    hit.update(range(p, p + len(window)))
                    found.update([str(item)] if item is not None else [])
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("block", [4_000_000, 60])
def test_windows_against_brute_force(spark, block):
    rnd = random.Random(8)
    items = [(k, " ".join(rnd.choice("ab cd E é 7".split()) for _ in range(rnd.randint(0, 14)))) for k in range(12)]
    items += [(50, None), (None, "ab cd"), (51, "!!"), (3, items[3][1])]
    rows = [(k, " ".join(rnd.choice(["ab", "CD", "e", "É", "7", "é", "x-y"]) for _ in range(rnd.randint(0, 60)))) for k in range(60)]
    rows += [(100, None), (101, ""), (102, "AB, cd! " * 3000), (None, rows[0][1]), (1, rows[1][1])]
    df = clashing(documents(spark, rows))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.hits(df, bench, block_chars=block).select("text", f"{OUT}.*").collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.n_hit, r["items"]) == plain_hits(r.text, items)


def test_windows_query_and_stage(spark, tmp_path):
    rows = [(1, "A b c, d."), (2, "b c"), (3, None)]
    bench = spark.createDataFrame([(7, "b C"), (10, "c d"), (9, None)], "item_id long, text string")
    sf = tables(spark, tmp_path, documents=documents(spark, rows), benchmark=bench)
    got = {r.doc_id: r for r in decontaminate.op4_decontaminate_prefix_join(spark, sf).collect()}
    assert got[1].items_sha256 == hashlib.sha256(b"10,7").hexdigest() and got[1].contaminated
    assert got[3].items_sha256 == hashlib.sha256(b"").hexdigest() and not got[3].contaminated
    stage = decontaminate.decontaminate_stage(spark, documents(spark, rows), sf)
    assert [r.doc_id for r in stage.collect()] == [3]
    none = tables(spark, tmp_path / "e", documents=documents(spark, rows), benchmark=bench.limit(0))
    assert decontaminate.op4_decontaminate_prefix_join(spark, none).where("n_hit > 0").count() == 0
