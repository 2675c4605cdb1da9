"""The field over every token: short and letter-only values, exact cuts, training rows of both classes."""

import hashlib
import random

import numpy as np
import pytest

from packlift.llm import secrets

WORDS = "harbour market winter letter garden station evening river mountain kitchen window bridge paper table".split()


def texts(n, rng):
    def line():
        value = hashlib.sha1(str(rng.random()).encode()).hexdigest()
        return f"{' '.join(rng.choices(WORDS, k=12))} token = \"{value}\" {' '.join(rng.choices(WORDS, k=6))} call +1 (262) 555-3752"
    return [line() for _ in range(n)]


@pytest.fixture(scope="module")
def field():
    return secrets.fit(texts(60, random.Random(4)))


@pytest.mark.parametrize("text, want", [
    ("the password is swordfish-tango", ["swordfish-tango"]), ("the password is QWERTYUIOPASDFGH", ["QWERTYUIOPASDFGH"]),
    ("the password is hunter2024", ["hunter2024"]), ("the secret is winter and", []), (" ".join(WORDS), [])])
def test_short_and_letter_only_values(field, text, want):
    assert [text[a:b] for a, b in field.spans(text)] == want


def test_cut_chains_decode_like_whole_lines():
    rng = np.random.default_rng(5)
    sure, tagged = 0, 0
    for seed in range(20):
        weights = rng.normal(size=(secrets.N_FEATURES, 3))
        weights[0, secrets.O] += 6
        field = secrets.Field(weights, rng.normal(size=(3, 3)))
        for text in texts(6, random.Random(seed)):
            scores, _ = field.scores([text], [secrets._TOKEN.findall(text)])
            scores = scores[:-len(secrets.PAD)]
            whole, outside = np.array(field.best(scores)), field.outside(scores)
            assert not whole[outside].any()
            sure, tagged = sure + outside.sum(), tagged + (whole > 0).sum()
    assert sure > 100 and tagged > 100


def test_texts_read_together_score_like_one_by_one(field):
    sample = [*texts(5, random.Random(7)), "", "the password", "is hunter2024\nor", "swordfish-tango"]
    assert field.spans_of(sample) == [field.spans(t) for t in sample]
    for text in filter(None, sample):
        scores, ends = field.scores([text], [secrets._TOKEN.findall(text)])
        want = [field.weights[run.features.astype(int)].sum(axis=1) for run in secrets.runs_of(text, secrets.Words())]
        assert np.allclose(scores[~ends], np.concatenate(want))


def test_training_takes_rare_secrets_of_the_whole_table(spark):
    rare = "x" * (2 * secrets.TRAIN_CHARS) + " password = abcdefgh1 " + "y" * secrets.TRAIN_CHARS
    rows = [(k, f"plain text number {k}") for k in range(400)] + [(-1, "token: 0123456789"), (-2, rare), (-3, None), (-1, "token: 0123456789")]
    got = secrets.training_texts(spark.createDataFrame(rows, "doc_id long, text string"), rows=3)
    with_span = [t for t in got if secrets.base_spans(t)]
    assert len(got) == 5 and len(with_span) == 2 and "token: 0123456789" in with_span
    assert max(map(len, got)) == secrets.TRAIN_CHARS
