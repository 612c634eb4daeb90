"""Token counts of whole texts by a compiled tokenizer (see ``transducer``).

The space mark stands before the text and for each space in it. A text is cut
before every run of spaces, where the transducer is at its start state; the maps
of the cuts are constant there, so their composition is a running sum. Equal
words of a batch are run once.

Defined cases: null is the empty text, with no tokens; equal rows give equal
results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm import base
from tripflow.llm.transducer import SPACE, Transducer

#: Tokens above which a text is over the limit.
LIMIT = 4096


def ranked_pieces(path: str) -> list[str]:
    """Ordinary pieces of a merge model, best score first."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    held = [i for i in range(m.get_piece_size()) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i))]
    return [m.id_to_piece(i) for i in sorted(held, key=lambda i: (-m.get_score(i), i))]


def words_of(text: str) -> list[str]:
    """The text in space-marked form, cut before every run of space marks."""
    parts = text.replace(SPACE, " ").split(" ")
    if "" not in parts:
        return [SPACE + p for p in parts]
    words, marks = [], 0
    for p in parts:
        marks += 1
        if p:
            words.append(SPACE * marks + p)
            marks = 0
    if marks:
        words.append(SPACE * marks)
    return words


COUNTED = T.StructType([
    T.StructField("n_bytes", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("over_limit", T.BooleanType()),
])


def count_tokens(df: DataFrame, model_path: str, column: str = "text", limit: int = LIMIT) -> DataFrame:
    """``df`` with struct column OUT: bytes, tokens and whether they are above ``limit``."""
    ranked = ranked_pieces(model_path)

    def make():
        machine = Transducer(ranked)

        def work(texts: list) -> list[tuple]:
            rows = []
            for k in range(0, len(texts), 1000):
                part = [t or "" for t in texts[k : k + 1000]]
                number: dict[str, int] = {}
                held = [[number.setdefault(w, len(number)) for w in words_of(t)] if t else [] for t in part]
                n = machine.count_words(list(number)).tolist()
                for t, ids in zip(part, held, strict=True):
                    total = sum(map(n.__getitem__, ids))
                    size = len(t) if t.isascii() else len(t.encode("utf-8", "surrogatepass"))
                    rows.append((size, total, total > limit))
            return rows

        return work

    return base.with_rows(df, make, COUNTED, df[column])


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    import public_tokenizers

    docs = base.table(spark, sf_dir, "documents").select("doc_id", "text")
    out = count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", F.col(f"{base.OUT}.n_bytes"), F.col(f"{base.OUT}.n_tokens"), F.col(f"{base.OUT}.over_limit"))
