import random
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.rows import empty, odd, odd_rows
from tracewright.llm import substrings
from tracewright.llm.common import table


def brute(rows, least):
    """Per (id, text): removed bytes, spans and digest, by a dictionary of all strings."""
    first: dict[bytes, tuple] = {}
    ordered = [((-1,) if i is None else (i,), (t or "").encode()) for i, t in rows]
    for key, raw in ordered:
        for at in range(len(raw) - least + 1):
            name = raw[at : at + least]
            first[name] = min(first.get(name, ((1 << 62,), 0)), (key, at))
    out = []
    for key, raw in ordered:
        gone = bytearray(len(raw) + 1)
        for at in range(len(raw) - least + 1):
            if first[raw[at : at + least]] != (key, at):
                gone[at : at + least] = b"\1" * least
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(gone[n] and not (n and gone[n - 1]) for n in range(len(raw)))
        out.append((key[0], len(raw), len(raw) - len(kept), spans, sha256(kept).hexdigest()))
    return sorted(out)


def result(docs, **how):
    found = substrings.remove_repeats(docs, **how).collect()
    return sorted(
        (-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
        for r in found
    )


def test_intervals_against_brute_force():
    draw = random.Random(2)
    for _ in range(200):
        contexts = [
            bytes(draw.choice(b"ab") for _ in range(draw.randrange(5, 30)))
            for _ in range(draw.randrange(1, 8))
        ]
        docs = np.array([draw.randrange(4) for _ in contexts])
        lows = np.array([draw.randrange(50) * 100 for _ in contexts])
        best: dict[bytes, tuple] = {}
        for n, c in enumerate(contexts):
            for at in range(len(c) - 4):
                place = (docs[n], lows[n] + at)
                best[c[at : at + 5]] = min(best.get(c[at : at + 5], place), place)
        for n, at, repeated in zip(*substrings.repeats(contexts, docs, lows, 5)):
            assert repeated == ((docs[n], lows[n] + at) != best[contexts[n][at : at + 5]])


def test_common_prefixes_are_those_of_the_suffixes():
    text = b"abracadabra abracadabra cadabra"
    symbols = np.frombuffer(text + b"\0", np.uint8).astype(np.uint16)
    order, bwt = substrings.transform(symbols, 20)
    values = substrings.common_prefix_values(bwt, 6)
    raw = text + b"\0"
    for n in range(1, len(order)):
        a, b = raw[order[n - 1] :], raw[order[n] :]
        shared = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
        assert values[n] == min(shared, 6)


def test_common_prefixes_of_repeating_texts():
    """Intervals of one place and of many, up to the least length."""
    draw = random.Random(7)
    for letters in (b"ab", b"abcdefgh"):
        passage = bytes(draw.choice(letters) for _ in range(90))
        parts = [passage[draw.randrange(40) : draw.randrange(50, 90)] for _ in range(20)]
        raw = b"|".join(parts) + b"\0"
        order, bwt = substrings.transform(np.frombuffer(raw, np.uint8).astype(np.uint16), 30)
        values = substrings.common_prefix_values(bwt, 30)
        for n in range(1, len(order)):
            a, b = raw[order[n - 1] :], raw[order[n] :]
            shared = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
            assert values[n] == min(shared, 30)


@pytest.mark.parametrize("part", [substrings.PART, 3])
def test_documents_against_brute_force(spark, monkeypatch, part):
    """Also with hot anchors split over many parts."""
    monkeypatch.setattr(substrings, "PART", part)
    draw = random.Random(5)
    passages = ["".join(draw.choice("abcdef gh") for _ in range(260)) for _ in range(4)]
    rows = []
    for n in range(120):
        parts = [draw.choice(passages) for _ in range(draw.randrange(3))]
        parts += ["".join(draw.choice("abcdef gh") for _ in range(draw.randrange(150)))]
        draw.shuffle(parts)
        text = list("é".join(parts))
        for _ in range(draw.randrange(3)):
            if text:
                text[draw.randrange(len(text))] = "X"
        rows.append((n, "".join(text)))
    rows += [(200, passages[0] * 3), (201, "z" * 500), (202, "z" * 130)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(docs) == brute(rows, 100)


def test_stretches_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(substrings, "STRETCH", 300)
    draw = random.Random(6)
    text = "".join(draw.choice("abcdefgh") for _ in range(2_000))
    # In this process too, without Spark: every start is in exactly one run.
    _, low, high = substrings.anchors(text.encode(), 100)
    assert [n for a, b in zip(low, high) for n in range(a, b + 1)] == list(range(1_901))
    rows = [(1, text), (2, "+" + text[100:1_900]), (3, text[950:1_200])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = result(docs)
    assert found[2][2] == 250 and found[1][2] == 1_800 and found[0][2] == 0


def test_given_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(docs) == brute(rows, 100)


def test_odd_rows(spark):
    assert result(odd(spark)) == brute([r[:2] for r in odd_rows()], 100)
    assert substrings.remove_repeats(empty(spark)).count() == 0


def test_texts_without_an_id_of_their_own(spark):
    """Texts that share an id, or have none, are documents of their own: what occurs
    once stays, and a passage on every row stays once."""
    draw = random.Random(8)

    def noise(count):
        return "".join(draw.choice("abcdefgh ij") for _ in range(count))

    shared, everywhere = noise(240), noise(150)
    rows = [(None, noise(300)), (None, noise(50) + shared + noise(70)), (None, shared), (None, None)]
    rows += [(2, noise(200) + shared), (2, noise(300)), (2, shared + noise(10)), (5, shared), (-4, noise(120))]
    rows += [(7, noise(130)), (7, "")]
    rows = [(i, t if t is None else t + everywhere) for i, t in rows]
    rows += [rows[1], rows[4], (2, rows[1][1])]
    assert substrings.copy_of(b"text") == spark.sql("SELECT xxhash64(CAST('text' AS BINARY)) AS h").first().h

    documents = sorted({(i is not None, i or 0, substrings.copy_of((t or "").encode()), (t or "").encode()) for i, t in rows if t is not None})
    first: dict[bytes, tuple] = {}
    for key in documents:
        for at in range(len(key[3]) - 99):
            first.setdefault(key[3][at : at + 100], (key, at))
    wanted = []
    for i, t in rows:
        raw = (t or "").encode()
        key = (i is not None, i or 0, substrings.copy_of(raw), raw)
        gone = {b for at in range(len(raw) - 99) if first[raw[at : at + 100]] != (key, at) for b in range(at, at + 100)}
        kept = bytes(b for n, b in enumerate(raw) if n not in gone)
        spans = sum(n in gone and n - 1 not in gone for n in range(len(raw)))
        wanted.append((-1 if i is None else i, len(raw), len(gone), spans, sha256(kept).hexdigest()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(docs) == sorted(wanted)
    assert sum(r[2] for r in wanted) > 1500


def test_the_table_grows_with_the_repeated_anchors(spark, monkeypatch):
    """A full table marks every anchor, so that all contexts travel."""
    monkeypatch.setattr(substrings, "BITS", 10)
    counted = spark.range(20_000).selectExpr("xxhash64(id) AS anchor")
    table = substrings._bit_table(counted)
    known = np.array([r.anchor for r in counted.collect()], np.int64).view(np.uint64)
    assert substrings._marked(table, known).all()
    others = np.random.default_rng(1).integers(0, 1 << 64, 20_000, np.uint64)
    assert substrings._marked(table, others).mean() < 0.05


def test_contexts_that_only_share_an_anchor_are_not_compared(monkeypatch):
    """Compared are those that agree around the anchor as far as a string would."""
    draw = random.Random(3)
    gram = b"sixteen bytes ok"
    random_bytes = lambda n: bytes(draw.choice(b"abcdefgh") for _ in range(n))
    shared = random_bytes(70) + gram + random_bytes(70)
    alone = [random_bytes(70) + gram + random_bytes(70) for _ in range(30)]
    partly = [shared[20:120] + random_bytes(36), random_bytes(26) + shared[26:130] + random_bytes(26)]
    contexts = [*alone, shared, *partly]
    n = len(contexts)
    rows = pa.table(
        {
            "anchor": pa.array([7] * n), "part": pa.array([0] * n, pa.int32()), "parts": pa.array([1] * n, pa.int32()),
            "context": list(range(n)), "doc": list(range(n)), "copy": [0] * n, "low": [0] * n,
            "at": pa.array([c.index(gram) for c in contexts], pa.int32()), "bytes": pa.array(contexts, pa.binary()),
        }
    )
    compared = []
    real = substrings.repeats
    monkeypatch.setattr(substrings, "repeats", lambda texts, *a: compared.extend(texts) or real(texts, *a))
    found = [row for batch in substrings._judged(rows, 100) for row in batch.to_pylist()]
    assert set(compared) == {shared, *partly}
    gone = {row["doc"]: (row["starts"], row["ends"]) for row in found if row["starts"]}
    assert gone == {31: ([0], [100]), 32: ([26], [130])}
    assert len(found) == n


def test_anchors_of_joined_texts_are_those_of_each(monkeypatch):
    draw = random.Random(5)
    raws = [bytes(draw.choice(b"abc") for _ in range(draw.choice([0, 99, 100, 101, 400]))) for _ in range(60)]
    raws[7] = None
    monkeypatch.setattr(substrings, "STRETCH", 150)
    number, values, place, low, high = substrings.runs(raws, 100)
    for n, raw in enumerate(raws):
        own = number == n
        for together, apart in zip((values[own], low[own], high[own]), substrings.anchors(raw or b"", 100)):
            assert together.tolist() == apart.tolist()
        assert (place[own] >= high[own]).all() and (place[own] <= low[own] + 100 - substrings.GRAM).all()
        starts = [s for a, b in zip(low[own].tolist(), high[own].tolist()) for s in range(a, b + 1)]
        assert starts == list(range(max(0, len(raw or b"") - 99)))
