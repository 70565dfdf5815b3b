"""Lexical search against a loop over all documents, and its blocks against each other."""

import math
import random
import re
from collections import Counter

import pytest

from tests.llm.rows import empty, odd, odd_rows, prose
from tracewright.llm import lexical

CUT = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, doc_id string, score int"


def terms(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return CUT.findall(lower)


def brute(docs, items, k=10):
    cut = [(doc, Counter(terms(text))) for doc, text in docs]
    cut = [(doc, counts) for doc, counts in cut if counts]
    documents = len(cut)
    length = sum(sum(c.values()) for _, c in cut)
    df = Counter(t for _, counts in cut for t in counts)
    found = []
    for item, text in dict.fromkeys(items):
        scored = []
        for doc, counts in cut:
            m = 100 - 90 + (90 * sum(counts.values()) * documents) // length
            score = sum(
                math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1)))
                * ((1000000000 * counts[t]) // (1000 * counts[t] + 8 * m))
                for t in set(terms(text))
                if counts[t]
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        scored.sort(key=lambda s: s[:3])
        found += [(item, n + 1, s[3], -s[0]) for n, s in enumerate(scored[:k])]
    return sorted(found, key=str)


def search(spark, docs, items, **options):
    left = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, m int, bag string")
    right = spark.createDataFrame([(*i, "x", 1) for i in items], ITEMS)
    found = lexical.search(left.repartition(5), right, **options)
    return sorted((tuple(r) for r in found.collect()), key=str)


def corpus(seed, count):
    draw = random.Random(seed)
    texts = [prose(draw.randrange(40), draw.randrange(1, 60)) for _ in range(count // 3)]
    rows = [(n, draw.choice(texts)) for n in range(count)]
    # Copies of another case and other separators: equal bags.
    rows += [(count + n, f"-{draw.choice(texts).upper()}!") for n in range(30)]
    return rows + [(None, texts[0]), (None, texts[0]), (3, texts[1]), (None, None), (9999, ""), (9998, " . ")]


@pytest.mark.parametrize("terms_a_block", [lexical.ITEM_TERMS, 40])
def test_equals_brute_force(spark, terms_a_block):
    docs = corpus(1, 150)
    items = [(n, prose(n, 12)) for n in range(25)] + [(7, prose(99, 5)), (None, prose(3, 4)), (30, None), (31, "?"), (0, prose(0, 12))]
    assert search(spark, docs, items, item_terms=terms_a_block) == brute(docs, items)


def test_ties_at_the_limit(spark):
    """Many classes with equal scores: the smallest ids win, whichever class has them."""
    docs = [(n, f"needle filler{n % 40}") for n in range(200, 0, -1)] + [(500 + n, "needle needle needle") for n in range(3)]
    items = [(1, "needle"), (2, "Needle filler3 FILLER4")]
    assert search(spark, docs, items) == brute(docs, items)


def test_odd_rows(spark):
    docs = [row[:2] for row in odd_rows()]
    items = [(1, docs[4][1]), (2, "日本語"), (3, "x" * 70_000), (4, "7 a")]
    right = spark.createDataFrame([(*i, "x", 1) for i in items], ITEMS)
    found = lexical.search(odd(spark), right)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(docs, items)


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "a", "x", 1)], ITEMS)
    assert lexical.search(empty(spark), items).collect() == []
    assert lexical.search(odd(spark), items.limit(0)).collect() == []
    assert search(spark, [(1, "b")], [(1, "a")]) == []


def test_long_posting_lists(spark, monkeypatch):
    """Scores are whole however a batch is cut into steps."""
    docs = corpus(2, 60)
    items = [(n, prose(n % 7, 30)) for n in range(60)]
    assert search(spark, docs, items, k=3) == brute(docs, items, 3)
