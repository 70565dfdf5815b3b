import random
from collections import defaultdict

from tests.llm.rows import empty, odd, odd_rows, prose
from tracewright.llm import templates
from tracewright.llm.common import table

ITEM = (
    "A train leaves Paris at 9:30 and travels 120 km in 2 hours while another leaves Rome "
    "later and Paris is far away from the old station there"
)
SCHEMA = "doc_id long, text string"


def hits(spark, texts, items=((1, ITEM),)):
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    benchmark = spark.createDataFrame(list(items), "item_id long, text string")
    found = templates.contaminated(docs, benchmark).collect()
    return sorted((r.doc_id, r.item_id, r.changed) for r in found)


def test_exact_and_reparameterised(spark):
    changed = ITEM.replace("Paris", "Oslo").replace("120", "75").replace("9:30", "7:15")
    torn = ITEM.replace("Paris is", "Vienna is")  # one name stands for two
    texts = [
        prose(1, 30) + " " + ITEM + "\n" + prose(2, 40),
        prose(3, 10) + " " + changed + " " + prose(4, 10),
        torn.replace("Paris", "Oslo", 1),
        prose(5, 200),
        ITEM.upper(),
        " ".join(ITEM.split()[:9]),
    ]
    found = hits(spark, texts)
    assert (0, 1, False) in found and (1, 1, True) in found
    assert not {d for d, _, _ in found} & {3, 5}


def test_inconsistent_slots_are_no_hit(spark):
    item = "Alice gave the red book back to Alice near the old green house by the river today"
    swapped = item.replace("Alice", "Bob")
    torn = "Bob gave the red book back to Carol near the old green house by the river today"
    assert hits(spark, [swapped, torn], [(4, item)]) == [(0, 4, True)]


def test_one_altered_slot_costs_its_windows_only(spark):
    filler = "so the old men went down to the quiet sea and sang of the lost land until the sun was gone"
    item = f"Alice saw the bridge {filler} and Alice came home with Bob when Alice was old"
    texts = [
        item.replace("with Bob", "with Alice"),  # two names become one
        item.replace("Alice was", "Eve was"),  # one name becomes two
        item.replace("Alice", "Mary").replace("Mary was", "Eve was"),
        item.replace("Alice", "Mary"),
    ]
    assert hits(spark, texts, [(1, item)]) == [(0, 1, False), (1, 1, False), (2, 1, True), (3, 1, True)]


def test_equal_numbers_may_become_different_ones(spark):
    item = "he put 5 apples in a box and 5 pears in a bag and then went home again"
    other = item.replace("5 apples", "3 apples").replace("5 pears", "7 pears")
    assert hits(spark, [other], [(1, item)]) == [(0, 1, True)]


def test_a_run_or_spread_edits_or_other_case_are_enough(spark):
    item = prose(11, 59)
    words = item.split()
    short = prose(12, 30)
    edited = short.split()
    edited[9], edited[19] = "one", "two"
    named = "Then Alice went to Rome with Bob and saw the old town near the river"
    texts = [
        prose(13, 40) + " " + " ".join(words[20:33]) + " " + prose(14, 40),
        prose(13, 40) + " " + " ".join(words[20:32]) + " " + prose(14, 40),
        " ".join(edited),
        named.upper(),
        named.lower(),
    ]
    found = hits(spark, texts, [(1, item), (2, short), (3, named)])
    assert found == [(0, 1, False), (2, 2, False), (3, 3, False), (4, 3, False)]


def test_short_and_all_placeholder_items(spark):
    items = [(1, "what is water made of"), (2, "Alice Bob Carol Dave Eve Frank Grace Heidi Ivan"), (3, ""), (4, None)]
    texts = ["so What is, water made of?", "so what is water made of?", "Alice Bob Carol Dave Eve Frank Grace Heidi Ivan", "Many Other Names In A Long Row Of Nine Or More"]
    assert hits(spark, texts, items) == [(1, 1, False), (2, 2, False)]


def test_units_after_numbers_are_slots(spark):
    item = "the long bridge over the wide river is 300 meters and the old one is shorter by far"
    other = item.replace("300 meters", "4 km")
    assert hits(spark, [other], [(7, item)]) == [(0, 7, True)]


def test_given_documents_hold_their_items(spark):
    folder = "/root/testdata/sf0.01"
    docs, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    wanted = {(r.doc_id, i) for r in docs.collect() for i, t in items if t in r.text}
    found = {(r.doc_id, r.item_id) for r in templates.contaminated(docs, benchmark).collect()}
    assert wanted and found == wanted
    assert templates.clean(docs, benchmark).count() == docs.count() - len({d for d, _ in wanted})


def test_odd_rows(spark):
    benchmark = spark.createDataFrame([(1, ITEM), (1, ITEM), (None, ITEM)], "item_id long, text string")
    assert templates.contaminated(odd(spark), benchmark).count() == 0
    clean = templates.clean(odd(spark), benchmark)
    assert clean.columns == odd(spark).columns and clean.count() == len(odd_rows())
    assert templates.contaminated(odd(spark), benchmark.where("false")).count() == 0
    assert templates.contaminated(empty(spark), benchmark).count() == 0
    twice = spark.createDataFrame([(5, ITEM), (5, ITEM)], SCHEMA)
    assert [(r.doc_id, r.item_id) for r in templates.contaminated(twice, benchmark).collect()] == [(5, 1)]


def typed(text):
    """Each token of a text: itself, what its template shows, whether it is plain."""
    out = []
    for word in (text or "").split():
        low, shown = templates.token(word)
        if low:
            unit = low in templates.UNITS and out and out[-1][1] == "<number>"
            shown = "<unit>" if unit else shown
            out.append((low, shown, shown == low and not unit))
    return out


def windows_agree(doc, item, width):
    """Whether two windows meet: by template, or by tokens where too few are plain; by
    tokens in any case if they are of full width."""
    raw = all(d[0] == i[0] for d, i in zip(doc, item))
    plain = [sum(t[2] for t in side) for side in (doc, item)]
    typed = min(plain) >= min(templates.LITERALS, width)
    if typed and (width < templates.WINDOW or max(plain) < width):
        shown = all(d[1] == i[1] for d, i in zip(doc, item))
        if shown and plain[0] == plain[1]:
            return True
    either = max(plain) < min(templates.LITERALS, width)
    return raw and (width == templates.WINDOW or either)


def brute(docs, items):
    """All (document, item) pairs by comparing every window with every window."""
    found = set()
    for key, text in docs:
        doc = typed(text)
        for item_id, item_text in items:
            item = typed(item_text)
            width = min(len(item), templates.WINDOW)
            if not width or item_id is None:
                continue
            aligned = defaultdict(list)
            for j in range(len(item) - width + 1):
                for i in range(len(doc) - width + 1):
                    ours, theirs = doc[i : i + width], item[j : j + width]
                    if windows_agree(ours, theirs, width) and all(
                        not t[2] or o[0] == t[0] for o, t in zip(ours, theirs)
                    ):
                        names = [
                            {"at": j + n, "b": t[0], "d": o[0]}
                            for n, (o, t) in enumerate(zip(ours, theirs))
                            if t[1] == "<name>"
                        ]
                        same = [o[0] for o in ours] == [t[0] for t in theirs]
                        aligned[i - j].append({"place": j, "identical": same, "names": names})
            places, run = set(), 0
            for windows in aligned.values():
                kept = templates.agreeing(windows)[0]
                places |= set(kept)
                run = max(run, templates.longest_run(kept))
            n_windows = len(item) - width + 1
            held = {p + n for p in places for n in range(width)}
            if places and (
                len(places) >= templates.COVERED * n_windows
                or (run and run + width - 1 >= templates.RUN)
                or len(held) >= templates.WORDS * len(item)
            ):
                found.add((key, item_id))
    return found


def edits(item, seed):
    """An item with some words, names or numbers exchanged, or cut short."""
    draw = random.Random(seed)
    words = item.split()
    for _ in range(draw.randrange(5)):
        words[draw.randrange(len(words))] = draw.choice(("Oslo", "17", "ka", "Bob", "300 km", "lo"))
    begin = draw.randrange(len(words) // 2)
    return " ".join(words[begin : begin + draw.randrange(8, 60)])


def test_equals_nested_loops(spark):
    texts = [r.text for r in table(spark, "/root/testdata/sf0.001", "benchmark").collect()][:12]
    items = [*enumerate([*texts, ITEM, "Alice Bob Carol Dave Eve", "ka lo 7 km mi"]), (None, ITEM)]
    docs = [(n, f"{prose(n, 15)} {edits(items[n % 14][1], n)} {prose(n + 500, 15)}") for n in range(120)]
    docs += [(500 + n, ITEM.replace("Paris", n * "Oslo") if n else ITEM.lower()) for n in range(3)]
    frame = spark.createDataFrame(docs, SCHEMA)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in templates.contaminated(frame, benchmark).collect()}
    assert found == brute(docs, items)
    assert 40 < len(found)


def test_rows_without_an_id_of_their_own(spark):
    """A verdict belongs to a text, whatever its id."""
    schema = "doc_id long, text string, key string, KEY_ string, item_id int"
    held, free = f"{prose(1, 20)} {ITEM}", prose(2, 60)
    rows = [(None, held), (None, free), (None, None), (3, held), (3, free), (4, free), (4, free)]
    docs = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], schema)
    benchmark = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    found = templates.contaminated(docs, benchmark)
    assert sorted((r.doc_id or 0, r.item_id) for r in found.collect()) == [(0, 1), (3, 1)]
    clean = templates.clean(docs, benchmark)
    assert clean.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=str) == sorted(
        (r for r in rows if r[1] != held), key=str
    )
