"""Every registered query against DuckDB, at the smallest scale."""

import pytest

from millrace.plans import load_all
from tests.oracle import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES = load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.oracle])
def test_matches_oracle(spark, con, name):
    ok, note = compare(spark, con, QUERIES[name], SF)
    assert ok, note


def test_anchors_are_the_centres_of_their_boxes(spark):
    from millrace.tables import boxes

    rows = boxes(spark, SF).selectExpr("x2 - x1 AS w", "y2 - y1 AS h").collect()
    anchors = [(r.width, r.height) for r in QUERIES["kmeans_anchors"].run(spark, SF).collect()]
    assert len(anchors) == 9 and anchors == sorted(anchors)
    near = [min(range(9), key=lambda k: (r.w - anchors[k][0]) ** 2 + (r.h - anchors[k][1]) ** 2) for r in rows]
    for k, (w, h) in enumerate(anchors):
        own = [r for r, n in zip(rows, near) if n == k]
        assert own and abs(sum(r.w for r in own) / len(own) - w) < 2 and abs(sum(r.h for r in own) / len(own) - h) < 2


def test_naive_bayes_scores_fit_its_predictions(spark):
    rows = QUERIES["classify_nb"].run(spark, SF).collect()
    assert rows and all(0 <= r.score <= 1 and r.prediction == (r.score > 0.5) for r in rows)
    assert all(r.confidence == pytest.approx(max(r.score, 1 - r.score)) for r in rows)


def test_sigmoid_scores_keep_no_overlapping_boxes(spark):
    assert QUERIES["score_sigmoid_nms"].run(spark, SF).count() > 0


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns[0] == "transaction_date"
    assert set(entry.oracle_sql()) <= set(entry.queries())
