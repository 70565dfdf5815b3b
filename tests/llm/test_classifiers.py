import numpy as np
import pytest

from tests.llm.rows import empty, odd, odd_rows
from tracewright.llm import features, preference, toxicity
from tracewright.llm.common import fold, table

FOLDER = "/root/testdata/sf0.1"


def area(scores, labels):
    order = np.argsort(np.argsort(scores))
    good = labels == 1
    return (order[good].mean() - (good.sum() - 1) / 2) / (~good).sum()


@pytest.fixture(scope="module")
def labelled(spark):
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    return docs.join(labels, "doc_id").select(docs["*"]).persist(), labels


def judged(found, labels, column, held):
    rows = found.join(labels, "doc_id").where(held).collect()
    return np.array([r.score for r in rows]), np.array([r[column] for r in rows]), rows


def test_quality_on_held_out_rows(labelled):
    docs, labels = labelled
    ranking = preference.fit(docs, labels.where(fold("doc_id", 5) != 0))
    scores, truth, rows = judged(preference.score(docs, ranking), labels, "quality", fold("doc_id", 5) == 0)
    assert area(scores, truth) > 0.97
    assert np.mean((scores >= 0.3) == (truth == 1)) > 0.95
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)


def test_toxicity_on_held_out_rows(labelled):
    docs, labels = labelled
    model = toxicity.fit(docs, labels.where(fold("doc_id", 4) != 2))
    scores, truth, rows = judged(toxicity.score(docs, model), labels, "toxic", fold("doc_id", 4) == 2)
    predicted = scores >= 0.3
    assert area(scores, truth) > 0.85
    assert (predicted & (truth == 1)).sum() / predicted.sum() > 0.9
    assert (predicted & (truth == 1)).sum() / (truth == 1).sum() > 0.7
    assert all(0 <= r.score <= 1 for r in rows)


def test_ranking_orders_pairs():
    draw = np.random.default_rng(0)
    rows = draw.normal(size=(400, 3))
    labels = (rows[:, 0] - rows[:, 2] + 0.1 * draw.normal(size=400) > 0).astype(int)
    ranking = preference.rank(rows, labels)
    strength = ranking.strength(rows)
    assert area(strength, labels) > 0.98
    # The cut is the quantile of the strengths at the share of label 0.
    assert np.isclose((strength < ranking.cut).mean(), (labels == 0).mean(), atol=0.01)
    assert np.isclose(ranking.score(rows)[strength.argsort()], np.sort(ranking.score(rows))).all()


def test_word_features():
    known = toxicity._Words({"foo": 1.5, "bar$": 2.0})
    names = toxicity.FEATURES
    one = dict(zip(names, toxicity_row("You are an 1d10t, idiot! FOOLISH bar barn", known)))
    assert one["fixed"] == 2 / 8 and one["learned"] == 2 / 8 and one["disguised"] == 1 / 8
    assert one["near_you"] > 0 and one["loud_words"] == 1 / 8 and one["mixed_words"] == 1 / 8
    assert not toxicity_row("", known).any() and not toxicity_row(None, known).any()


def toxicity_row(text, known):
    return toxicity.toxicity_features([text], known)[0]


def test_odd_rows(spark):
    docs = odd(spark)
    labels = spark.createDataFrame(
        [(n, n % 2, int(n % 3 == 0)) for n in range(14)] + [(4, 0, 1), (None, 1, 1), (5, None, None), (99, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    for found in (
        preference.score(docs, preference.fit(docs, labels)),
        toxicity.score(docs, toxicity.fit(docs, labels)),
        preference.score(docs, preference.fit(empty(spark), labels)),
        toxicity.score(docs, toxicity.fit(docs, labels.where("false"))),
    ):
        rows = found.collect()
        assert len(rows) == len(odd_rows())
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert preference.score(empty(spark), preference.fit(docs, labels)).count() == 0


def test_sample_is_bounded(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    labels = table(spark, "/root/testdata/sf0.01", "labels")
    found = features.labelled_sample(docs, labels, "toxic", rows=100).count()
    assert 60 < found < 140


def test_every_labelled_row_is_learned_from(spark):
    """All rows are in pairs, and the cut is the quantile over all of them."""
    rows = spark.range(30_000).selectExpr(
        "id AS doc_id", "int(id % 3 = 0) AS label", "array(double(id), double(id) * id) AS scaled"
    )
    pairs = preference.paired(rows, 10_000).selectExpr("margin[0] AS far", "margin[1] AS square").collect()
    assert len(pairs) == 4 * 20_000
    ends = [(p.square / p.far + p.far, p.square / p.far - p.far) for p in pairs]
    assert {round(g / 2) for g, _ in ends} == set(range(0, 30_000, 3))
    assert len({round(b / 2) for _, b in ends}) == 20_000
    values = rows.selectExpr("doc_id / 7.0D AS strength")
    assert np.isclose(preference._cut(values, 0.25), np.quantile(np.arange(30_000) / 7, 0.25))


def test_rows_beyond_the_old_sample_count(spark, monkeypatch):
    """The texts that tell the labels apart are few among many labelled rows."""
    monkeypatch.setattr(features, "SAMPLE_ROWS", 10)
    docs = spark.range(400).selectExpr("id AS doc_id", "if(id % 2 = 0, 'One fine word after another.', '## || 77 $$ ##') AS text")
    labels = docs.selectExpr("doc_id", "int(doc_id % 2 = 0) AS quality")
    seen = features.labelled_features(docs, labels, "quality", lambda: features.quality_features, True)
    assert seen.count() == 400
    found = preference.score(docs, preference.fit(docs, labels)).join(labels, "doc_id")
    assert found.where("predicted = quality").count() == 400


def test_features_are_computed_of_little_text_at_a_time(spark):
    texts = spark.range(400).selectExpr("id AS doc_id", "repeat('word ', 1600) AS text").coalesce(1)

    def together():
        return lambda found: np.full((len(found), 1), float(sum(map(len, found))))

    most = max(r.features[0] for r in features.featured(texts, together, binary=True).collect())
    # Above the limit by one text at most: 8,000 bytes here.
    assert most <= features.TOGETHER + 8_000 <= 1 << 20
