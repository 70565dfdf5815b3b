import random
import re
from collections import Counter

from tests.llm.rows import empty, odd, odd_rows
from tracewright.llm import repetition


def brute(text):
    words = text.split()
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(8)}
    longest = 0
    for i in range(len(words)):
        for j in range(i + 1, len(words)):
            n = 0
            while j + n < len(words) and words[i + n] == words[j + n]:
                n += 1
            longest = max(longest, n if n >= 8 else 0)
    size = sum(map(len, words))
    return len(words), len(covered), sum(len(words[i]) for i in covered), longest, size


def test_against_brute_force():
    draw = random.Random(4)
    texts = [
        " ".join(draw.choice("ab") for _ in range(draw.randrange(60))).encode() for _ in range(150)
    ] + [b"a " * 60, b"", b"x y z " * 21]
    found = repetition.measure(texts)
    names = ("n_words", "n_repeat_words", "repeat_bytes", "longest_repeat", "word_bytes")
    for n, text in enumerate(texts):
        assert tuple(int(found[k][n]) for k in names) == brute(text)


def test_odd_rows(spark):
    rows = repetition.quality(odd(spark)).collect()
    assert len(rows) == len(odd_rows())
    texts = {r[0]: r[1] or "" for r in odd_rows()}
    for row in rows:
        text = texts[row.doc_id]
        words = re.findall("[^\x20\x09-\x0d]+", text)
        lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        assert row.n_words == len(words)
        assert row.word_chars == sum(map(len, words))
        assert row.n_symbols == len(re.findall("[#*$%&|<>]", text))
        assert row.n_dup_lines == len(lines) - len(set(lines))
        assert row.base_failed == (row.n_words < 20 or 100 * row.n_repeat_words > 30 * row.n_words)
        assert not (row.kept and row.base_failed)
    assert repetition.quality(empty(spark)).count() == 0


def test_limits_decide(spark):
    text = " ".join(f"w{n}" for n in range(400))
    half = " ".join(f"w{n}" for n in range(120))
    docs = spark.createDataFrame([(1, text), (2, text + " " + half)], "doc_id long, text string")
    kept = {r.doc_id: r for r in repetition.quality(docs, max_covered=0.9).collect()}
    assert kept[1].kept and not kept[1].base_failed
    assert kept[2].longest_repeat == 120 and not kept[2].kept
