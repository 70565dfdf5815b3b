"""The conversation trie against prefixes in a dictionary, over blocks of every size."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from tests.llm.rows import prose
from tracewright.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, items string, base int, key int"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows):
    """Every node from the dictionary of all prefixes."""
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            inner = "".join(hashlib.md5(x.encode()).hexdigest() for x in (role, text))
            digest = hashlib.md5(inner.encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, digest, (role, text)))
    turns = {c: [t[3] for t in sorted(found)] for c, found in own.items()}
    nodes, ends = defaultdict(set), defaultdict(list)
    for conv in turns:
        head = zlib.crc32(str(conv).encode()) % 4
        base = conv - int(conv / 20) * 20
        whole = tuple(turns.get(conv - base, [])[:head] + turns[conv][head:])
        for depth in range(len(whole) + 1):
            nodes[whole[:depth]].add(conv)
        ends[whole].append(conv)
    found = []
    for node, members in nodes.items():
        below = [n for n in nodes if n[: len(node)] == node]
        children = {n[: len(node) + 1] for n in below if len(n) > len(node)}
        leaves = [n for n in below if not any(o[:-1] == n and o for o in nodes)]
        saved = sum((len(nodes[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in below if n)
        text = ",".join(map(str, sorted(ends.get(node, []))))
        found.append(
            (
                min(members), len(node), min(nodes[node[:-1]]) if node else None, len(members),
                len(children), len(leaves), saved, hashlib.sha256(text.encode()).hexdigest(),
            )
        )
    return sorted(found, key=str)


def conversations(seed, count):
    draw = random.Random(seed)
    rows = []
    for conv in draw.sample(range(-30, 400), count):
        for turn in range(draw.randrange(1, 7)):
            text = draw.choice((None, "", "a b", "c d e", " \t"))
            rows.append((conv, draw.choice((turn, turn, None)), draw.choice(("user", None)), text, "x", 1, 2))
    return rows + rows[:5] + [(None, 0, "user", "lost", "x", 1, 2)]


def nodes(spark, rows, block=trie.BLOCK, parts=5):
    turns = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    found = trie.nodes_of(trie.hold(trie.rebuilt(trie.sequences(turns))), block)
    return sorted((tuple(r) for r in found.select(*COLUMNS).collect()), key=str)


@pytest.mark.parametrize("block", [1, 3, 17, trie.BLOCK])
def test_equals_brute_force(spark, block):
    rows = conversations(block, 60)
    assert nodes(spark, rows, block) == brute(rows)


def test_copies_that_span_blocks(spark):
    """One conversation told by a third of all, some of them longer."""
    rows = [(c, t, "user", f"turn {t}", "x", 1, 2) for c in range(0, 2000, 20) for t in range(3 + (c % 60 == 0))]
    rows += [(c, 0, "user", "turn 0", "x", 1, 2) for c in range(2000, 2600, 20)]
    assert nodes(spark, rows, 4) == brute(rows)


def test_long_conversations(spark):
    """Deep nodes and a long text; depth alone makes no square work."""
    rows = [(c, t, "user", f"t{t if t < 700 else (t, c)}", "x", 1, 2) for c in (0, 20) for t in range(900)]
    rows.append((40, 0, "user", prose(1, 20_000), "x", 1, 2))
    found = nodes(spark, rows, 128)
    assert max(r[1] for r in found) == 900
    assert len(found) == 1 + 700 + 2 * 200 + 1
    root = next(r for r in found if r[1] == 0)
    assert root[3:7] == (3, 2, 3, sum(1 for t in range(700)))


def test_extents_are_independent():
    lcp = trie.np.array([0, 2, 3, 1, 4, 4, 0, 1])
    levels = trie.sparse_table(lcp, trie.np.minimum)
    for at in range(len(lcp)):
        for depth in range(5):
            left = at
            while left > 0 and lcp[left] >= depth:
                left -= 1
            right = at
            while right + 1 < len(lcp) and lcp[right + 1] >= depth:
                right += 1
            one = trie.np.array([at]), trie.np.array([depth])
            assert trie.left_extent(levels, *one)[0] == left
            assert trie.right_extent(levels, *one)[0] == right


def test_odd_inputs(spark):
    assert nodes(spark, []) == []
    assert nodes(spark, [(None, 1, None, None, None, None, None)]) == []
    only = [(7, None, None, None, None, None, None)]
    assert nodes(spark, only) == brute(only)
