"""Every exact query against its DuckDB SQL, and the model queries' properties."""

import math

import pytest

import __spark_entry__ as E
from conftest import SF_ORACLE, SF_SMALL

EXACT = sorted(E.oracle_sql())
_SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return v


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(repr(_norm(r[i])) for i in order) for r in rows)


@pytest.mark.parametrize("name", EXACT)
def test_exact_against_duckdb(spark, duck, name):
    df = E.queries()[name](spark, SF_ORACLE)
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    spark_types = {c: _SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes}
    rel = duck.sql(E.oracle_sql()[name])
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert spark_types == duck_types
    assert _rows([tuple(r) for r in df.collect()], df.columns) == _rows(orows, ocols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["country_code", "country", "rank", "host", "count", "percent"]


def test_top_tags_of_both_forms_in_one_pass(spark):
    """Repeated tags, an item without tags, items not chosen and chosen twice."""
    from tessera.operators import tags
    items = spark.createDataFrame([(1, "a|a|b"), (2, "a|c"), (3, None), (4, "z|z")], "movieId long, genres string")
    chosen = spark.createDataFrame([(0.4, 1), (0.4, 2), (0.4, 2), (0.4, 3), (0.6, 2), (0.6, 9)], "split double, movieId long")
    both = tags.top_tags_both(chosen, items, 2, ["split"])
    for form, one in (("rows", tags.top_tags_rows), ("items", tags.top_tags_items)):
        expected = one(chosen, items, 2, ["split"]).collect()
        assert sorted(both.where(f"form = '{form}'").drop("form").collect()) == sorted(expected)


def test_cluster_top_tags_ranks(spark):
    rows = E.queries()["cluster_top_tags"](spark, SF_SMALL).collect()
    assert {r["form"] for r in rows} <= {"rows", "items"}
    counts = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        counts.setdefault((r["split"], r["form"]), []).append(r["count"])
    assert counts and all(c == sorted(c, reverse=True) and len(c) <= 10 for c in counts.values())


def test_claim_coefficients_match_the_design_matrix(spark):
    width = E.queries()["assembled_features"](spark, SF_SMALL).select("position").distinct().count()
    rows = E.queries()["claim_coefficients"](spark, SF_SMALL).collect()
    assert len(rows) == 3 * (width + 1)
    assert {r["position"] for r in rows} == set(range(-1, width))
    models = {r["model"]: r for r in E.queries()["claim_models"](spark, SF_SMALL).collect()}
    for name, m in models.items():
        assert m["n_coefficients"] == width and m["converged"]
        assert m["n_nonzero"] == sum(r["coefficient"] != 0 for r in rows if r["model"] == name and r["position"] >= 0)


def test_model_chart_series(spark):
    rows = E.queries()["model_chart_series"](spark, SF_SMALL).collect()
    errors = [r for r in rows if not r["series"].startswith("cluster_size")]
    assert len(errors) == 3 * 3 * 2 and all(r["y"] > 0 for r in errors)
    assert len(rows) > len(errors)


def test_stratified_sample_takes_each_class(spark):
    from tessera.plans import classifiers
    total = {r[0]: r[1] for r in classifiers.features(spark, SF_ORACLE).groupBy("label").count().collect()}
    taken = {r[0]: r[1] for r in E.queries()["stratified_sample"](spark, SF_ORACLE).groupBy("label").count().collect()}
    for label, fraction in classifiers.CLASS_FRACTIONS.items():
        assert abs(taken[label] / total[label] - fraction) < 0.15


def test_changed_input_changes_the_result(spark, tmp_path):
    """Shared tables follow the files they were built from."""
    import shutil

    from tessera import session
    from tessera.plans import ratings
    sf = tmp_path / "sf"
    shutil.copytree(SF_SMALL, sf)
    before = E.queries()["time_split_sizes"](spark, str(sf)).agg({"train_rows": "sum", "test_rows": "sum"}).first()
    again = ratings.ratings(spark, str(sf))
    assert again is ratings.ratings(spark, str(sf))
    half = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").where("l_orderkey % 2 = 0").toPandas()
    import os
    os.chmod(sf, 0o755)
    os.chmod(sf / "lineitem.parquet", 0o644)
    half.to_parquet(sf / "lineitem.parquet", coerce_timestamps="us")
    after = E.queries()["time_split_sizes"](spark, str(sf)).agg({"train_rows": "sum", "test_rows": "sum"}).first()
    assert 0 < after[0] < before[0] and 0 < after[1] < before[1]
    session.release(spark)
    assert not session._SHARED


def test_tag_forms_differ_on_repeats(spark):
    rows = {(r["split"], r["genre"]): r["count"] for r in E.queries()["top_tags_rows"](spark, SF_ORACLE).collect()}
    items = {(r["split"], r["genre"]): r["count"] for r in E.queries()["top_tags_items"](spark, SF_ORACLE).collect()}
    shared = set(rows) & set(items)
    assert shared and all(rows[k] >= items[k] for k in shared)
    assert any(rows[k] > items[k] for k in shared)


def test_seeded_sample_parts_disjoint(spark):
    df = E.queries()["seeded_sample"](spark, SF_SMALL)
    assert df.groupBy("vec_id").count().filter("count > 1").count() == 0


def test_als_errors_properties(spark):
    rows = E.queries()["als_errors"](spark, SF_SMALL).collect()
    assert len(rows) == 6
    for r in rows:
        assert math.isclose(r["rmse"] ** 2, r["mse"], rel_tol=1e-9)
        assert r["mae"] <= r["rmse"] + 1e-12
        assert 0 < r["covered"] <= 1


def test_user_clusters_sizes(spark):
    rows = E.queries()["user_clusters"](spark, SF_SMALL).collect()
    for split in {r["split"] for r in rows}:
        sizes = [r["size"] for r in sorted(rows, key=lambda r: r["rank"]) if r["split"] == split]
        assert sizes == sorted(sizes, reverse=True) and len(sizes) <= 5


def test_full_grids():
    """The registered searches cover all 62 maps of the analysis with 5 folds."""
    import math

    from tessera.plans import classifiers
    maps = {n: math.prod(len(v) for v in g.values()) for n, g in classifiers.REFERENCE_GRIDS.items()}
    assert maps == {"random_forest": 27, "gbt": 27, "perceptron": 8} and classifiers.FOLDS == 5


def test_the_label_can_be_learnt(spark):
    from tessera.plans import classifiers
    grid = {"random_forest": {"maxDepth": [5], "numTrees": [10]}}
    _, _, row = classifiers.tune_models(spark, "/root/testdata/sf0.1", ["random_forest"], grid, folds=2)[0]
    assert row["accuracy"] > row["base_rate"] + 0.05 and row["auc"] > 0.6


def test_bernoulli_sample_is_a_subset_of_train(spark):
    sample = E.queries()["bernoulli_sample"](spark, SF_SMALL)
    train = E.queries()["stratified_split"](spark, SF_SMALL).filter("part = 'train'")
    n, n_train = sample.count(), train.count()
    assert 0 < n < n_train
    assert sample.join(train, "IDpol", "left_anti").count() == 0


def test_claim_models_properties(spark):
    rows = {r["model"]: r for r in E.queries()["claim_models"](spark, SF_SMALL).collect()}
    assert set(rows) == {"poisson", "logistic_l1", "logistic_l2"}
    for r in rows.values():
        assert r["reg_param"] in (0.001, 0.01, 0.1, 1.0, 10.0)
        assert 0.5 <= r["base_rate"] <= 1.0
    assert rows["poisson"]["rmse"] > 0 and rows["poisson"]["auc"] is None
    for name in ("logistic_l1", "logistic_l2"):
        assert 0 <= rows[name]["auc"] <= 1 and 0 <= rows[name]["accuracy"] <= 1
    assert rows["logistic_l1"]["n_nonzero"] <= rows["logistic_l1"]["n_coefficients"]
    grid = E.queries()["claim_grid"](spark, SF_SMALL)
    assert grid.count() == 15 and grid.select("model").distinct().count() == 3


def test_factorisation_on_dense_indices(spark):
    """ALS on dense indices; user factors mapped back to the keys."""
    from tessera import session
    from tessera.plans import ratings

    session.release(spark)
    clusters = ratings._split_clusters(spark, SF_SMALL)
    users = {r["userId"] for r in ratings.ratings(spark, SF_SMALL).select("userId").distinct().collect()}
    ids = {r["id"] for r in clusters.select("id").distinct().collect()}
    assert ids and ids <= users
    assert len(E.queries()["als_errors"](spark, SF_SMALL).collect()) == 6


def test_errors_do_not_depend_on_partitions_or_key_values(spark):
    """Same factorisation errors from other partitions and from shifted keys."""
    from pyspark.sql import functions as F

    from tessera.operators import metrics, models, ranking
    base = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select(
        (F.col("l_orderkey") % 97).alias("u"), (F.col("l_partkey") % 53).alias("i"),
        F.col("l_quantity").alias("r")).groupBy("u", "i").agg(F.avg("r").alias("rating"))

    def error(rows, parts):
        data = rows.join(ranking.dense_index(rows, "u", "user"), "u").join(ranking.dense_index(rows, "i", "item"), "i") \
            .repartition(parts)
        model = models.als(user="user", item="item", rank=4, max_iter=3, blocks=10).fit(data)
        return metrics.regression_metrics(model.transform(data), "rating").first()["rmse"]

    first = error(base, 2)
    shifted = base.select((7 * F.col("u") + 3).alias("u"), (13 * F.col("i") + 2**40).alias("i"), "rating")
    assert math.isclose(first, error(base, 16), rel_tol=1e-6)
    assert math.isclose(first, error(shifted, 5), rel_tol=1e-6)
