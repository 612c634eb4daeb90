"""Words of the byte-level tokenizer, and ids of words that recur or do not."""

import hashlib
import random
from collections import Counter

import pytest
import regex

from tests.llm.common import OUT, documents
from tripflow.llm import byte_bpe, word_cutter

PARTS = ["a", "th", "s", "re", "ve", "ll", "l", "d", "m", "t", " ", "  ", "\n", "\t", "é", "日", "😀", "1", "23", ".", "!!", "'", "''",
         "'s", "'re", "'ll", "'x", "　", " ", "\u0085", "ß", "A", "\x00", "٣", "²", "\x1c", "\U0001e030"]


@pytest.fixture(scope="module")
def coder():
    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = byte_bpe.read_ranks(path)
    return path, public_tokenizers.PATTERN, tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    ), ranks


def words_of(words, k):
    return [words.word(w) for w in words.codes[words.cuts[k] : words.cuts[k + 1]].tolist()]


@pytest.mark.parametrize("pattern", [word_cutter.PATTERN, r"\p{L}+|\d"])
def test_words(coder, pattern):
    assert coder[1] == word_cutter.PATTERN
    cutter, rnd = word_cutter.Cutter(pattern, word_cutter.classes()), random.Random(2)
    for _ in range(400):
        texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 14))) for _ in range(rnd.randint(1, 6))]
        words = cutter.cut(texts)
        assert [words_of(words, k) for k in range(len(texts))] == [regex.findall(pattern, t) for t in texts]


def test_equal_first_numbers_are_told_apart(monkeypatch):
    cutter = word_cutter.Cutter(word_cutter.PATTERN, word_cutter.classes())
    numbers = cutter._numbers
    monkeypatch.setattr(cutter, "_numbers", lambda x, a, n, k: numbers(x, a, n, k) % (3 if k == 0 else 1 << 60))
    text = "one two three four one five six seven two"
    assert words_of(cutter.cut([text]), 0) == regex.findall(word_cutter.PATTERN, text)
    held = cutter.cut(["one two three four five six seven"])
    ready = byte_bpe.Ready(held.h1, held.h2, None, None)
    found = cutter.cut([" seven nine one two three"])
    assert [k >= 0 for k in ready.places(found)] == [found.word(k) != " nine" and found.word(k) != " one" for k in range(len(found))]


def test_groups_of_texts(monkeypatch):
    monkeypatch.setattr(word_cutter, "CHARACTERS", 10)
    texts = ["abc", "", "defghij", "k", "l" * 40, "m", ""]
    assert [texts[a:b] for a, b in word_cutter.groups([len(t) for t in texts])] == [["abc", "", "defghij"], ["k"], ["l" * 40], ["m", ""]]
    assert list(word_cutter.groups([])) == []


def test_every_piece_is_what_its_bytes_make(coder):
    """So that long words may join all places of a pair at one step."""
    _, _, library, ranks = coder
    pieces = [p for p in ranks if len(p) > 1]
    assert all(library._core_bpe.encode_single_piece(p) == [ranks[p]] for p in pieces) and len(pieces) > 40_000


@pytest.mark.parametrize("most", [byte_bpe.COMMON, 40, 0])
def test_ids_do_not_depend_on_which_words_are_ready(spark, coder, most):
    path, pattern, library, ranks = coder
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcdeghinorst") for _ in range(rnd.randint(1, 9))) for _ in range(300)]
    joined = [p.decode() for p in rnd.sample([p for p in ranks if len(p) > 3 and p.isalpha()], 60)]
    texts = [" ".join(rnd.choice(words) for _ in range(40)) for _ in range(60)] + ["", "".join(PARTS), "".join(joined), "".join(joined) * 3]
    got = byte_bpe.encode_texts(documents(spark, list(enumerate(texts))), path, pattern, most=most).collect()
    assert {r.doc_id: bytes(r.b).decode() for r in byte_bpe.encode_texts(
        documents(spark, list(enumerate(texts))), path, pattern, most=most
    ).select("doc_id", byte_bpe.decoded(byte_bpe.F.col(OUT), path).alias("b")).collect()} == dict(enumerate(texts))
    assert {r.doc_id: list(r[OUT]) for r in got} == {k: library.encode_ordinary(t) for k, t in enumerate(texts)}


def test_other_patterns_and_refused_names(spark, coder):
    from pyspark.sql import functions as F

    path, _, _, ranks = coder
    import tiktoken

    pattern = r"\p{L}+|\p{N}+| +"
    library = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    df = documents(spark, [(1, "words and 12 numbers, no marks!"), (2, "words words")])
    got = {r.doc_id: list(r[OUT]) for r in byte_bpe.encode_texts(df, path, pattern).collect()}
    assert got == {1: library.encode_ordinary("words and 12 numbers, no marks!"), 2: library.encode_ordinary("words words")}
    with pytest.raises(ValueError):
        byte_bpe.encode_texts(df.withColumn(byte_bpe.CODED, F.lit(1)), path, pattern)


def test_letters_of_late_unicode_versions(spark, coder):
    path, pattern, library, _ = coder
    late = ["\U0001e4d0\U0001e4d1 x", "aᲊb", "\U00010d40 \U00010d41", "\U0001e030\U0001e031 y"]
    got = byte_bpe.round_trip(documents(spark, list(enumerate(late))), path, pattern)
    want = Counter((k, hashlib.sha256(",".join(map(str, library.encode_ordinary(t))).encode()).hexdigest()) for k, t in enumerate(late))
    assert Counter((r.doc_id, r.ids_sha256) for r in got.collect()) == want


def test_rows_of_pairs_hold_every_pair(coder):
    """The look-up of a pair is two places read, in one flat array."""
    ranks = coder[3]
    starts, slots = byte_bpe.pair_rows(ranks)
    found = 0
    for piece, rank in ranks.items():
        for k in range(1, len(piece)):
            if piece[:k] in ranks and piece[k:] in ranks:
                left = ranks[piece[:k]]
                assert slots[starts[left] + ranks[piece[k:]]] & 0xFFFFFFFF == (left << 16) + rank
                found += 1
    assert found == sum(v != -1 for v in slots) and len(slots) < 4 << 17


def test_starts_and_names_of_words(coder):
    ranks = coder[3]
    words = word_cutter.Cutter(word_cutter.PATTERN, word_cutter.classes()).cut(["été été", "", "ab 😀!"])
    names = words.names(byte_bpe.np.arange(len(words)))
    assert names.to_pylist() == [words.word(k) for k in range(len(words))]
    for word, start in zip(names.to_pylist(), byte_bpe.Bytes(ranks).starts(names).to_pylist()):
        x = word.encode()
        assert start["ids"] == [ranks[x[k : k + 1]] for k in range(len(x))]
        assert start["ranks"] == [ranks.get(x[k : k + 2]) for k in range(len(x) - 1)] + [None]


def test_classes_take_little_memory_in_the_driver():
    import tracemalloc

    word_cutter.classes.cache_clear()
    tracemalloc.start()
    word_cutter.classes()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6
