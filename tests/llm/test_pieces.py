import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor

from tests.llm.rows import empty, odd, odd_rows, prose
from tracewright.llm import pieces

VOCABULARY = pieces.Vocabulary()
TEXTS = [
    "", "a", "  two  spaces ", "tab\tand\nline\r\n", "日本語 text ﬁne ①", "x" * 60, "Hello, World! The end.",
    prose(3, 200), "international business of " * 9, " ", "\n",
]


def encoded(texts, dropout, seed=7, streams=4):
    encoder = pieces.Encoder(VOCABULARY, dropout, seed, streams)
    offsets, ids, lost = encoder.encode([t.encode() for t in texts], list(range(len(texts))))
    return [ids[offsets[n] : offsets[n + 1]].tolist() for n in range(len(texts))], lost


def test_without_dropout_it_is_sentencepiece():
    processor = SentencePieceProcessor(model_file=pieces.MODEL)
    assert encoded(TEXTS, 0.0)[0] == [processor.encode(t) for t in TEXTS]


@pytest.mark.parametrize("dropout", [0.1, 0.5, 1.0])
def test_dropout_decodes_losslessly(dropout):
    found, lost = encoded(TEXTS, dropout)
    join = pieces.Pieces(VOCABULARY)
    assert [pieces.decoded(np.array(f, np.int64), join).decode() for f in found] == TEXTS
    assert lost.sum() > 0


def test_literal_space_mark_and_broken_bytes_survive():
    raws = ["▁a ▁▁ b▁".encode(), b"\xff\xfe ok \xe2\x96", b"\x00"]
    encoder = pieces.Encoder(VOCABULARY, 0.2, 1, 4)
    offsets, ids, _ = encoder.encode(raws, [1, 2, 3])
    join = pieces.Pieces(VOCABULARY)
    assert [pieces.decoded(ids[offsets[n] : offsets[n + 1]], join) for n in range(3)] == raws


def test_joint_agenda_equals_heap():
    pattern = VOCABULARY.unit_pattern()
    units = sorted({u for t in TEXTS for u in pattern.findall(" " + t)})
    streams = np.arange(len(units)) % 3
    table = VOCABULARY.pairs()
    offsets, ids, lost = pieces.segment_many(units, streams, VOCABULARY, table, 0.3, 5)
    for n, unit in enumerate(units):
        one = pieces.segment_one(unit, VOCABULARY, table, 0.3, 5, int(streams[n]))
        assert one == (ids[offsets[n] : offsets[n + 1]].tolist(), lost[n])


def test_a_long_unit_equals_the_joint_agenda(monkeypatch):
    """Units beyond the joint agenda's length have the segmentation it would give."""
    draw = np.random.default_rng(4)
    parts = np.array(["inter", "nation", "al", "seg", "ment", "é", "日本", "x", "\x01"])
    units = ["".join(draw.choice(parts, 200)) for _ in range(4)]
    streams, table = np.arange(4), VOCABULARY.pairs()
    alone = pieces.segment_many(units, streams, VOCABULARY, table, 0.2, 9)
    monkeypatch.setattr(pieces, "TOGETHER", 4096)
    joint = pieces.segment_many(units, streams, VOCABULARY, table, 0.2, 9)
    assert min(map(len, units)) > 128
    for one, other in zip(alone, joint):
        assert one.tolist() == other.tolist()


def test_seed_and_stream_vary_the_segmentation():
    text = ["international business segmentation everything"] * 30
    found, _ = encoded(text, 0.3)
    assert len({tuple(f) for f in found}) > 1
    assert found == encoded(text, 0.3)[0]
    assert found != encoded(text, 0.3, seed=8)[0]


def test_every_occurrence_has_its_own_draws(spark):
    word = "internationalisation"
    rows = [(n, " ".join([word] * 100)) for n in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(pieces.encode(docs, dropout=0.5).collect())
    assert len({tuple(r.ids) for r in found}) == len(rows)
    ways = set()
    join = pieces.Pieces(VOCABULARY)
    for row in found:
        unit: list[int] = []
        for number in row.ids:
            if VOCABULARY.bytes[number].startswith(b" ") and unit:
                ways.add(tuple(unit))
                unit = []
            unit.append(number)
        assert pieces.decoded(np.array(row.ids), join).decode() == rows[row.doc_id][1]
    assert len(ways) > 100
    assert found == sorted(pieces.encode(docs.repartition(7), dropout=0.5).collect())
    few = [tuple(r.ids) for r in pieces.encode(docs, dropout=0.5, streams=4).collect()]
    assert len(set(few)) <= 4


def test_dropped_share_follows_the_rate():
    text = [prose(n, 400) for n in range(8)]
    none = sum(map(len, encoded(text, 0.0)[0]))
    some, lost = encoded(text, 0.1)
    assert sum(map(len, some)) > none
    assert 0.05 < lost.sum() / sum(map(len, text)) < 0.2


def test_odd_rows(spark):
    found = pieces.encode_checked(odd(spark)).collect()
    assert len(found) == len(odd_rows())
    assert all(r.lossless and r.n_ids == len(r.ids) for r in found)
    assert sorted(len(r.ids) for r in found if r.doc_id in (0, 1)) == [0, 0, 0]
    back = pieces.decode(pieces.encode(odd(spark)))
    assert {(r.doc_id, r.text) for r in back.collect()} == {(r[0], r[1] or "") for r in odd_rows()}
    assert pieces.encode_checked(empty(spark)).count() == 0
