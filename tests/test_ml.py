"""Scoring and clustering on ten midfielders of three known styles (``fixtures.MIDFIELD``)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fixtures import CREATORS, FINISHERS, NEW, WORKERS, feature_rows
from periodstats.operators import archetypes, scoring
from periodstats.spec import Spec

FAST = Spec(kmeans_restarts=2)  # fewer restarts only to keep unit tests short


def _styles(df, k):
    return archetypes.cluster_playing_styles(df, NEW, k, FAST).collect()


def _scores(df, n=50, season=NEW):
    return scoring.detect_value_outliers(df, season, n).collect()


@pytest.mark.parametrize("k, fine", [(0, False), (2, False), (3, True), (5, True), (6, False)])
def test_range_of_cluster_counts(k, fine):
    if fine:
        assert archetypes.validate_cluster_count(k) is None
    else:
        with pytest.raises(ValueError, match=f"n_clusters={k}.*3, 4, 5"):
            archetypes.validate_cluster_count(k)


def test_zscores_by_hand(spark):
    rows = [("a", 2.0), ("a", 4.0), ("a", None), ("a", 6.0),    # mean 4, deviation sqrt(8/3)
            ("b", 7.5), ("b", 7.5), ("c", None)]
    df = spark.createDataFrame(rows, "position string, x double").withColumn("season", F.lit(NEW))
    got = {}
    for r in scoring.with_zscores(df, {"z": "x"}).collect():
        got.setdefault(r.position, {})[r.x] = r.z
    s = (8 / 3) ** 0.5
    assert got["a"] == {2.0: pytest.approx(-2 / s), 4.0: 0.0, 6.0: pytest.approx(2 / s), None: None}
    assert got["b"] == {7.5: 0.0} and got["c"] == {None: 0.0}  # constant and empty groups


def test_absent_columns_are_all_named(spark, sample_features):
    with pytest.raises(ValueError, match="position, threat_per_90"):
        archetypes.cluster_playing_styles(sample_features.drop("threat_per_90", "position"),
                                          NEW, 3, FAST)
    with pytest.raises(ValueError, match="points_per_million"):
        scoring.detect_value_outliers(sample_features.drop("points_per_million"), NEW)


def test_three_styles_are_found_and_named(spark, sample_features):
    rows = _styles(sample_features, 3)
    members, labels = {}, {}
    for r in rows:
        members.setdefault(r.cluster, set()).add(r.code)
        labels[r.code] = r.cluster_label
    assert sorted(members) == [0, 1, 2]
    assert {frozenset(m) for m in members.values()} == {
        frozenset(FINISHERS), frozenset(CREATORS), frozenset(WORKERS)}
    assert labels[71] == labels[74] and "influence" in labels[71]
    assert len(set(labels.values())) == 3
    assert 72 not in labels  # 999 minutes; 62 stands exactly on the edge and stays


def test_more_clusters_split_a_style(spark, sample_features):
    rows = _styles(sample_features, 4)
    assert len(rows) == 9 and {r.cluster for r in rows} == {0, 1, 2, 3}


def test_group_smaller_than_k_keeps_its_rows(spark, sample_features):
    keepers = feature_rows(spark, "GK").where("code < 53")
    rows = _styles(sample_features.unionByName(keepers), 3)
    assert len(rows) == 11
    assert [(r.cluster, r.cluster_label) for r in rows if r.position == "GK"] == [
        (-1, archetypes.TOO_FEW_PLAYERS)] * 2


def test_group_without_usable_features_keeps_its_rows(spark, sample_features):
    empty = {c: F.lit(None).cast("double") for c in
             ("goals_per_90", "assists_per_90", "creativity_per_90", "threat_per_90")}
    rows = _styles(sample_features.withColumns(empty), 3)
    assert {(r.cluster, r.cluster_label) for r in rows} == {(-1, archetypes.TOO_FEW_FEATURES)}


def test_missing_value_takes_the_median(spark, sample_features):
    df = sample_features.withColumn("threat_per_90", F.when(F.col("code") != 61,
                                                            F.col("threat_per_90")))
    long, _ = archetypes.cluster_inputs(df, NEW, 3, FAST)
    r = long.where("code = 61 AND feature = 'threat_per_90'").first()
    # the cohort's other values: 1.0 1.1 1.2 2.0 | 2.3 5.6 6.0 6.3
    assert r.raw_value is None and r.imputed_value == pytest.approx(2.15)


def test_order_and_mixed_scores(spark, sample_features):
    rows = _scores(sample_features)
    score = [r.discovery_score for r in rows]
    assert len(rows) == 9 and score == sorted(score, reverse=True)
    assert rows[0].web_name == "Crisp"  # 29 points a million, owned by 0.6 %
    assert [r.web_name for r in _scores(sample_features, 2)] == [r.web_name for r in rows[:2]]
    wolfe = next(r for r in rows if r.web_name == "Wolfe")  # no residuals: hidden part only
    assert wolfe.overperformance_score is None
    assert wolfe.discovery_score == pytest.approx(wolfe.hidden_gem_score)
    for r in rows:
        if r.web_name != "Wolfe":
            assert r.discovery_score == pytest.approx(
                0.7 * r.hidden_gem_score + 0.3 * r.overperformance_score)


def test_scores_do_not_depend_on_a_position_s_scale(spark, sample_features):
    richer = feature_rows(spark, "FWD").withColumn("points_per_million",
                                                   F.col("points_per_million") * 10)
    got = {}
    for r in _scores(sample_features.unionByName(richer)):
        got.setdefault(r.web_name, []).append(r.hidden_gem_score)
    assert len(got) == 9
    assert all(len(v) == 2 and v[0] == pytest.approx(v[1]) for v in got.values())


def test_season_without_rows_keeps_the_columns(spark, sample_features):
    out = scoring.detect_value_outliers(sample_features, "1900-01", 5)
    assert out.isEmpty() and "discovery_score" in out.columns
    out = archetypes.cluster_playing_styles(sample_features, "1900-01", 3, FAST)
    assert out.isEmpty() and {"cluster", "cluster_label"} <= set(out.columns)


def _blobs(spark, n):
    """Three positions of overlapping clouds, with codes in no order."""
    import random
    rng = random.Random(n)
    rows = [(p, rng.randrange(1 << 40), [round(rng.gauss(c, 0.8) * archetypes.UNIT) for c in centre])
            for p in ("A", "B", "C")
            for centre in ((0, 0, 0), (2, 0, 1), (0, 3, 1), (1, 1, 4)) for _ in range(n)]
    return spark.createDataFrame(rows, "position string, code bigint, v array<bigint>")


def _assigned(rows, k=4, restarts=3):
    centres, costs, passes = archetypes.lloyd(rows, archetypes.first_centres(rows, k, restarts, 42))
    return centres, costs


def test_clusters_do_not_depend_on_partitions(spark):
    rows = _blobs(spark, 150).cache()
    want = _assigned(rows.repartition(4, "code"))
    for layout in (rows.repartition(16), rows.repartitionByRange(64, "v"), rows.coalesce(1)):
        assert _assigned(layout) == want  # every centre and cost to the last digit


def test_passes_end_at_the_means_of_the_nearest_rows(spark):
    rows = _blobs(spark, 60)
    centres, costs = _assigned(rows, restarts=2)
    values = {}
    for r in rows.collect():
        values.setdefault(r.position, []).append([x / archetypes.UNIT for x in r.v])
    for (position, restart), found in centres.items():
        groups, cost = {}, 0.0
        for v in values[position]:
            d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in found]
            groups.setdefault(d.index(min(d)), []).append(v)
            cost += min(d)
        assert float(costs[position, restart]) == pytest.approx(cost)
        for i, members in groups.items():
            assert found[i] == pytest.approx([sum(c) / len(members) for c in zip(*members, strict=True)])


def test_fewer_distinct_rows_than_clusters(spark):
    rows = spark.createDataFrame([("A", i, [i % 2 * archetypes.UNIT] * 2) for i in range(9)],
                                 "position string, code bigint, v array<bigint>")
    centres, costs = _assigned(rows, k=3)
    assert set(map(tuple, centres["A", 0])) == {(0.0, 0.0), (1.0, 1.0)} and set(costs.values()) == {0}


def test_certificates_find_planted_faults(spark, sample_features):
    out = archetypes.cluster_playing_styles(sample_features, NEW, 3, FAST)
    long, _ = archetypes.cluster_inputs(sample_features, NEW, 3, FAST)

    def found(df):
        return archetypes.certificates(df, long).first().asDict()
    good = found(out)
    assert good == {"position": "MID", "players": 9, "clustered": 9, "clusters": 3, "misplaced": 0,
                    "mislabelled": 0, "unordered": 0}
    swapped = out.withColumn("cluster", F.when(F.col("code") == min(FINISHERS), (F.col("cluster") + 1) % 3)
                             .otherwise(F.col("cluster")))
    assert found(swapped)["misplaced"] > 0
    assert found(out.withColumn("cluster", 2 - F.col("cluster")))["unordered"] == 3
    assert found(out.withColumn("cluster_label", F.lit("MID_minutes_profile")))["mislabelled"] == 9
