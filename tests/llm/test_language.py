import numpy as np

from tests.llm.rows import empty, odd, odd_rows
from tracewright.llm import language
from tracewright.llm.common import fold, table
from tracewright.llm.pieces import SPACE, Vocabulary

VOCABULARY = Vocabulary()


def brute(word, weights):
    text = SPACE + word

    def rest(i):
        if i == len(text):
            return 1.0
        total = 0.0
        if text[i] not in VOCABULARY.ids:
            raw = text[i].encode()
            total += np.prod([weights[VOCABULARY.byte_ids[b]] for b in raw]) * rest(i + 1)
        for j in range(i + 1, min(len(text), i + 16) + 1):
            if text[i:j] in VOCABULARY.ids:
                total += weights[VOCABULARY.ids[text[i:j]]] * rest(j)
        return total

    return np.log(rest(0))


def test_all_segmentations_are_summed():
    draw = np.random.default_rng(1).random((len(VOCABULARY.bytes), 2))
    weights = draw / draw.sum(0)
    trie = language.Trie(VOCABULARY)
    words = ["the", "international", "x日y", "a", "straße", "▁q", "tion€∂"]
    found = language.Lattice(trie, words).log_likelihood(weights)
    for word, row in zip(words, found):
        wanted = [brute(word, weights[:, n]) for n in range(2)]
        assert np.allclose(row, wanted)
        assert np.allclose(language.long_log_likelihood(trie, word, weights), wanted)


def test_expected_counts_spell_the_word():
    weights = np.full((len(VOCABULARY.bytes), 1), 1 / len(VOCABULARY.bytes))
    words = ["international", "the"]
    found = language.Lattice(language.Trie(VOCABULARY), words).expected(
        weights, np.zeros(2, np.int64), np.array([1.0, 3.0])
    )
    length = sum(found[number, 0] * len(piece) for piece, number in VOCABULARY.ids.items())
    assert np.isclose(length, len("_international") + 3 * len("_the"))


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    model = language.fit(docs.where(fold("doc_id", 5) != 0), per_language=60)
    found = language.with_held_out(language.predict(docs, model), 5, 0).where("held_out")
    rows = found.join(docs, "doc_id").collect()
    assert len(rows) > 150
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    docs = odd(spark)
    model = language.fit(docs)
    assert model.languages == ["en"]
    found = language.predict(docs, model).collect()
    assert len(found) == len(odd_rows())
    for row in found:
        if row.doc_id in (0, 1, 2, 10, 11):
            assert (row.lang_pred, row.score) == ("und", 0.0)
        else:
            assert row.lang_pred == "en"
    assert language.identified(docs, model).columns == docs.columns
    nothing = language.fit(empty(spark))
    assert {r.lang_pred for r in language.predict(docs, nothing).collect()} == {"und"}
    assert language.identified(empty(spark), nothing).count() == 0
