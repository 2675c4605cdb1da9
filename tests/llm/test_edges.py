"""Nulls, empty and long texts, repeated rows, empty tables, clashing columns."""

import hashlib
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from packlift.llm import bpe, chat, html_text, packing, phrases, pii, quality, secrets, simhash, toxicity
from packlift.llm.queries import tokenizer_text

DOC = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lorem ipsum dolor " * 6000 + "x" * 5000
ROWS = [
    (1, "A plain text of some words, with a stop. And another one here for good measure.", "en", "a", 80),
    (2, None, "en", "a", None), (3, "", None, None, 0), (4, LONG, "en", "b", len(LONG)),
    (5, "same words here again and so on for ten words or more", "en", "a", 5),
    (5, "same words here again and so on for ten words or more", "en", "a", 5),
    (None, "a text whose id is null, of more than ten words as it happens to be", "fr", "a", 1),
    (7, "é 日本語 \U0001F600 \x1c mixed", "xx", "b", 9),
]
VOCABULARY = tokenizer_text()
MODEL = toxicity.fit([(1, "you idiot person"), (1, "what an idiot"), (0, "a nice day"), (0, "the weather is fine")] * 5)


def odd(spark):
    """The rows above with extra columns named like the operators' own."""
    df = spark.createDataFrame(ROWS, DOC)
    for c in ("fp", "key", "score", "length", "component_id", "_fp", "_hash", "kept", "q", "r", "mask", "use"):
        df = df.withColumn(c, F.lit("x"))
    return df


OPERATORS = {
    "packing": lambda d: packing.pack(d, VOCABULARY),
    "simhash": simhash.simhash,
    "secrets": lambda d: secrets.secrets(d, secrets.fit_field(d)),
    "phrases": phrases.phrase_fingerprints,
    "quality": quality.quality,
    "pii": pii.pii,
    "bpe": lambda d: bpe.bpe(d, VOCABULARY),
    "toxicity": lambda d: toxicity.toxicity(d, MODEL),
}
FILTERS = {
    "toxicity": lambda d: toxicity.keep_clean(d, MODEL),
    "quality": quality.keep_good,
    "simhash": simhash.keep_first,
    "pii": pii.mask,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(spark, name):
    out = OPERATORS[name](odd(spark)).collect()
    ids = [r["doc_id"] for r in out if name != "packing" or r["piece"] == 0]
    assert sorted(ids, key=str) == sorted([r[0] for r in ROWS], key=str)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](odd(spark).where("false")).count() == 0


@pytest.mark.parametrize("name", FILTERS)
def test_stages_keep_columns(spark, name):
    docs = odd(spark)
    out = FILTERS[name](docs)
    assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
    rows = out.collect()
    assert FILTERS[name](docs.where("false")).count() == 0
    if name == "simhash":
        # The repeated row stays once; the two empty texts are one group.
        assert sorted((r["doc_id"] for r in rows), key=str) == sorted([1, 2, 4, 5, 7, None], key=str)
    elif name == "pii":
        assert len(rows) == len(ROWS)
        assert {r["doc_id"]: r["text"] for r in rows}[2] is None
    else:
        assert {1, 5} <= {r["doc_id"] for r in rows}


def test_equal_rows_get_equal_results(spark):
    for name in ("simhash", "secrets", "pii", "bpe", "toxicity", "quality"):
        same = [tuple(r) for r in OPERATORS[name](odd(spark)).where("doc_id = 5").collect()]
        assert len(same) == 2 and same[0] == same[1], name


def test_pages(spark):
    df = spark.createDataFrame([(1, "u", None), (2, None, ""), (None, "u", "<p>a<p>b"), (4, "v", "<div>" * 3000 + "deep"),
                                (4, "v", "<div>" * 3000 + "deep")], "page_id long, url string, html string")
    out = html_text.html_text(df.withColumn("text", F.lit(1)))
    assert sorted((r["text"], r["n_chars"]) for r in out.collect()) == [("", 0), ("", 0), ("a\n\nb", 4), ("deep", 4), ("deep", 4)]
    assert html_text.html_text(df.where("false")).count() == 0


def test_conversations(spark):
    df = spark.createDataFrame(
        [(1, 0, "user", None), (1, 1, "assistant", "a & <| b &lt;|"), (2, 0, None, "x"), (2, 0, "na\nme<|", "y"),
         (None, 5, "assistant", "z"), (3, None, "user", "n"), (3, 1, "user", "again")],
        "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(0))
    chats = chat.format_chats(df)
    got = {r["conv_id"]: [tuple(t) for t in r["t"]] for r in chats.select("conv_id", chat.read_turns(F.col("formatted")).alias("t")).collect()}
    assert got == {1: [("user", ""), ("assistant", "a & <| b &lt;|")], 2: [("", "x"), ("na\nme<|", "y")],
                   None: [("assistant", "z")], 3: [("user", "n"), ("user", "again")]}
    assert {r["conv_id"]: r["valid"] for r in chats.collect()} == {1: True, 2: False, None: False, 3: False}
    loss = {r["conv_id"]: r["loss_sha256"] for r in chat.chat_digests(chats).collect()}
    assert loss[1] == hashlib.sha256(b"a & <| b &lt;|").hexdigest()
    assert chat.chat_digests(chat.format_chats(df.where("false"))).count() == 0


def test_no_training_rows_gives_no_toxic(spark):
    model = toxicity.fit([])
    assert [r["score"] for r in toxicity.toxicity(odd(spark), model).collect()] == [0.0] * len(ROWS)
    assert np.isfinite(MODEL.probability(np.zeros((1, 2)))).all()


def test_unlike_texts_of_one_id_all_stay(spark):
    texts = ["a first text about ships and harbours and the open sea", "quite another one on bread, flour and slow ovens",
             "a third that speaks of mountains, snow and long winters"]
    rows = [(1, texts[0], "en", "a", 1), (1, texts[1], "en", "a", 1), (2, texts[2], "en", "a", 1),
            (3, texts[0], "en", "a", 1), (1, texts[0], "en", "a", 1)]
    kept = simhash.keep_first(spark.createDataFrame(rows, DOC)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted([(1, texts[0]), (1, texts[1]), (2, texts[2])])


def test_an_encoder_keeps_its_texts_to_itself():
    first, second = bpe.encoder(VOCABULARY), bpe.encoder(VOCABULARY)
    assert first(["one two three"]) == second(["one two three"])
    remembered = [c.cell_contents for f in (first, second) for c in f.__closure__ if isinstance(c.cell_contents, bpe.Known)]
    assert len(remembered) == 2 and remembered[0] is not remembered[1]


def test_encoding_costs_no_calls_per_chunk():
    texts = [" ".join(f"{a}{b}{c}{d}." for c in "aeioux" for d in "rstlnm") for a in "bcdfghjk" for b in "lmnprstvw"] * 3
    encode = bpe.encoder(VOCABULARY)
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        encode(texts)
    finally:
        sys.setprofile(None)
    assert calls < sum(len(t.split()) for t in texts[:len(texts) // 3])


def test_forgotten_words_and_mixed_chunks_encode_alike(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    monkeypatch.setattr(bpe, "ROWS", 3)
    tokenizer = Tokenizer.from_str(VOCABULARY)
    texts = ["", "  ", "x" * 63 + " " + "é" * 32 + " " + "ab" * 33, "one,two;three <|endoftext|> ½x <|endoftext|>½ é<|startoftext|>'s",
             "a　b½\xa0c 12² <| |>", *["qw" * n for n in range(1, 40)], "one,two;three", "\n\r\t\x0b\x0c", "<|endoftext|>"]
    encode = bpe.encoder(VOCABULARY)
    for part in (texts, texts[::-1], *([t] for t in texts)):
        assert [np.frombuffer(d, dtype="<u4").tolist() for d in encode(part)] == [
            tokenizer.encode(t, add_special_tokens=False).ids for t in part]
