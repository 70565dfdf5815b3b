import random
from itertools import combinations

import pytest

from tests.llm.rows import empty, odd, odd_rows, prose
from tracewright.llm import minhash
from tracewright.llm.common import table
from tracewright.llm.components import components


def brute(rows, width, percent=80):
    """Component of each id by comparing all pairs."""
    sets = {i: minhash.shingles((t or "").encode(), width) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {i: (len(s), root(i)) for i, s in sets.items()}


def edited(text, draw, share):
    return " ".join(w + "x" if draw.random() < share else w for w in text.split())


@pytest.mark.parametrize("width", [2, 5])
def test_groups_against_brute_force(spark, width):
    draw = random.Random(width)
    rows = [(n, prose(100 + n, draw.choice((1, 5, 40, 150)))) for n in range(60)]
    for base in range(6):
        text = prose(base, 120)
        # A chain: each edit starts from the one before, so the ends differ widely.
        for _ in range(12):
            rows.append((len(rows), text))
            text = edited(text, draw, 0.02)
    hot = prose(50, 200)
    rows += [(1000 + n, edited(hot, draw, 0.01 * (n % 8))) for n in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = minhash.near_duplicates(docs, width).collect()
    wanted = brute(rows, width)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == wanted
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    stay = minhash.one_of_each_group(docs, width).collect()
    assert sorted(r.doc_id for r in stay) == sorted({c for _, c in wanted.values()})


def test_prefix_finds_every_pair_with_enough_collisions(spark):
    draw = random.Random(9)
    signed = [(n, [draw.randrange(3) for _ in range(8)]) for n in range(60)]
    reps = spark.createDataFrame(signed, "doc_id long, signature array<int>")
    posted = minhash.postings(reps, 8, 5).collect()
    lists: dict[int, set] = {}
    for row in posted:
        lists.setdefault(row.pair, set()).add(row.doc)
    for (a, x), (b, y) in combinations(signed, 2):
        if sum(p == q for p, q in zip(x, y)) >= 5:
            assert any({a, b} <= docs for docs in lists.values())


def test_only_numbers_travel_for_each_posted_pair(spark):
    draw = random.Random(10)
    signed = [(n, 100 + n, 7 * n, [draw.randrange(3) for _ in range(8)]) for n in range(60)]
    reps = spark.createDataFrame(signed, "doc_id long, n_shingles long, sketch0 long, signature array<int>")
    posted = minhash.postings(reps, 8, 5)
    plan = posted._jdf.queryExecution().optimizedPlan().toString()
    made = [line for line in plan.splitlines() if "Project [" in line and "AS pair#" in line and "shiftleft" in line]
    assert made and not any("sketch0" in line or "n_shingles" in line for line in made)
    rows = posted.collect()
    bare = minhash.postings(reps.select("doc_id", "signature"), 8, 5).collect()
    assert sorted((r.pair, r.doc) for r in rows) == sorted((r.pair, r.doc) for r in bare)
    assert rows and all((r.n_shingles, r.sketch0) == (100 + r.doc, 7 * r.doc) for r in rows)


def test_given_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = minhash.near_duplicates(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows, 2)


def test_rows_without_an_id_of_their_own_stay(spark):
    a, b, c, d, e, f = (prose(200 + n, 80) for n in range(6))
    rows = [
        (None, a), (None, a), (None, a + " more"), (None, b), (None, c), (None, None),
        (7, c), (7, d), (8, d + " more"), (9, e), (9, e), (10, f),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = minhash.one_of_each_group(docs, 5)
    stay = [tuple(r) for r in found.collect()]
    assert found.columns == docs.columns
    assert [r for r in stay if r[0] is not None and r[0] != 7] == [r for r in stay if r[0] in (8, 9, 10)]
    assert sorted(r for r in stay if r[0] in (8, 9, 10)) == [(8, d + " more"), (9, e), (10, f)]
    assert sum((t or "").startswith(a) for _, t in stay) == 1
    assert (None, b) in stay and (None, None) in stay
    assert [i for i, t in stay if t == c] == [7] and (7, d) not in stay
    assert len(stay) == 7


def test_shared_ids_lose_no_link(spark):
    a, b = prose(300, 200), prose(301, 200)
    rows = [(1, a), (1, b), (2, b + " three more words"), (3, a + " more"), (None, b + " tail"), (None, prose(302, 50))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id or 0, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect() if r.doc_id)
    assert found == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False)]
    others = [(r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect() if r.doc_id is None]
    assert sorted(others, key=str) == [(1, False), (None, False)]


def test_clashing_columns_and_large_ids(spark):
    schema = "doc_id long, text string, key string, rows int, `ROWS_` int, kept int, `a.b` string"
    text = prose(303, 90)
    ids = [(1 << 63) - 1, None, None, -(1 << 63), (1 << 63) - 2, (1 << 63) - 2]
    texts = [text, text + " x", prose(304, 80), text + " y", prose(305, 90), prose(306, 70)]
    docs = spark.createDataFrame([(i, t, "k", 1, 2, 3, "d") for i, t in zip(ids, texts)], schema)
    found = minhash.one_of_each_group(docs)
    assert found.columns == docs.columns
    stay = sorted((str(r.doc_id), r.text) for r in found.collect())
    wanted = [(ids[3], texts[3]), (None, texts[2]), (ids[4], texts[4]), (ids[5], texts[5])]
    assert stay == sorted((str(i), t) for i, t in wanted)


def test_recall_near_the_threshold(spark):
    """Pairs of similarity 0.80 to 0.82, each alone: at least 0.99 are found."""
    draw = random.Random(11)
    rows, near = [], 0
    for n in range(700):
        words = [f"w{draw.randrange(10**6)}" for _ in range(201)]
        other = list(words)
        # Each of these edits costs two of 200 shingles on either side.
        for at in range(5, 200, 20):
            other[at] = f"x{draw.randrange(10**6)}"
        one, two = (minhash.shingles(" ".join(w).encode(), 2) for w in (words, other))
        share = len(one & two) / len(one | two)
        assert 0.8 <= share <= 0.82
        rows += [(2 * n, " ".join(words)), (2 * n + 1, " ".join(other))]
        near += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = minhash.near_duplicates(docs)
    linked = found.where("component_id <> doc_id").count()
    assert linked >= 0.99 * near


def test_similar_sizes_across_classes(spark):
    """Links between neighbouring size classes are found when all is compared."""
    base = [f"w{n}" for n in range(126)]
    sets = [(n, " ".join(base[:size])) for n, size in enumerate((101, 125, 126, 81, 65, 21, 17, 3, 2))]
    docs = spark.createDataFrame(sets, "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs).collect()}
    assert found == brute(sets, 2)


@pytest.mark.parametrize("width, share", [(2, 0.1), (5, 0.06)])
def test_large_groups_below_the_threshold_make_few_pairs(spark, monkeypatch, width, share):
    """Documents of one template, half alike: as many pairs as documents, not their square."""
    made = []
    rest = minhash._all_across

    def counted(*args):
        made.append(rest(*args).distinct().count())
        return rest(*args)

    monkeypatch.setattr(minhash, "_all_across", counted)
    draw = random.Random(12)
    words = [f"w{n}" for n in range(150)]
    rows = []
    for n in range(240):
        text = " ".join(f"x{draw.randrange(10**6)}" if draw.random() < share else w for w in words)
        rows.append((n, text))
    # Some have a partner that is linked.
    rows += [(1000 + n, rows[n][1] + " two more words") for n in range(0, 240, 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = minhash.near_duplicates(docs, width).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows, width)
    assert sum(made) < 2 * len(rows)


def test_components(spark):
    draw = random.Random(3)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(150)]
    links += [(n, n + 1) for n in range(1000, 1040)] + [(2000, n) for n in range(2001, 2100)] + [(5, 5)]
    parent: dict[int, int] = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.label for r in found} == {n: root(n) for a, b in links if a != b for n in (a, b)}


def test_odd_rows(spark):
    found = minhash.near_duplicates(odd(spark)).collect()
    assert len(found) == len(odd_rows())
    wanted = brute([r[:2] for r in odd_rows()], 2)
    for row in found:
        if row.doc_id is None:
            assert row.component_id == 4 and not row.kept
        else:
            assert (row.n_shingles, row.component_id) == wanted[row.doc_id]
    assert wanted[5][1] == wanted[6][1] == wanted[12][1] == 4
    stay = minhash.one_of_each_group(odd(spark))
    assert stay.columns == odd(spark).columns
    ids = [r.doc_id for r in stay.collect()]
    assert len(ids) == len(set(ids)) and None not in ids
    assert minhash.near_duplicates(empty(spark)).count() == 0
    assert minhash.one_of_each_group(empty(spark)).count() == 0
