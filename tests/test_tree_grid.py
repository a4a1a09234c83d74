from lexispark.operators import classifiers as cl
from lexispark.operators import selection as sel
from tests.test_models import noisy
from verification import queries


def folded(spark, k=2):
    data = noisy(spark)
    folds = sel.stratified_folds(data.select("doc_id", "label"), k)
    return data.join(folds.select("doc_id", "fold"), "doc_id").cache()


def test_query_searches_the_whole_tree_grid(spark, sf_dir, monkeypatch):
    seen = []

    def search(model_of, vectors, grid):
        seen.extend(grid)
        return None, {"cv_results": spark.createDataFrame([], "params map<string,string>, fold int, f1 double")}

    monkeypatch.setattr(queries.sel, "grid_search", search)
    queries.grid_search_ml(spark, sf_dir)
    whole = sel.parameter_grid(cl.SEARCH_GRIDS["decision_tree"])
    assert len(whole) == 270 and seen == whole


def test_points_read_off_one_tree_score_as_trees_of_their_own(spark):
    data = folded(spark)
    axes = {"max_depth": [None, 2, 4], "min_samples_split": [2, 30], "min_samples_leaf": [3], "max_features": ["sqrt", None]}
    grid = sel.parameter_grid(axes)
    _, shared = sel.grid_search(cl.DecisionTree, data, grid, 2)
    _, alone = sel.grid_search(lambda **p: cl.DecisionTree(**p), data, grid, 2)
    scores = [{(r.point, r.fold): round(r.f1, 9) for r in x["cv_results"].collect()} for x in (shared, alone)]
    assert scores[0] == scores[1] and len(scores[0]) == 24 and len(set(scores[0].values())) > 2
    assert shared["best_params"] == alone["best_params"]
