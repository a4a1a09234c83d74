import numpy as np
import pytest
from pyspark.sql import functions as F

from lexispark.operators.features import FeatureExtractor
from verification import queries


@pytest.mark.parametrize("method", ["pca", "svd"])
def test_query_projects_the_whole_vocabulary(spark, sf_dir, method):
    docs = queries.clean(queries.documents(spark, sf_dir)).select("doc_id", "label", "tokens").cache()
    extractor = FeatureExtractor().fit(docs)
    assert extractor.size > 300
    place = {r.doc_id: i for i, r in enumerate(docs.select("doc_id").orderBy("doc_id").collect())}
    x = np.zeros((len(place), extractor.size))
    for r in extractor.transform(docs).collect():
        x[place[r.doc_id], r.idx] = r.weight
    if method == "pca":
        x -= x.mean(0)
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    got = {r.doc_id: (r.c1, r.c2) for r in queries.projected(spark, sf_dir, method).select("doc_id", "c1", "c2").where(F.col("doc_id").isNotNull()).collect()}
    got = np.array([got[k] for k in sorted(got)])
    for i in range(2):
        if s[i] - s[i + 1] > 1e-3 * s[0] and (i == 0 or s[i - 1] - s[i] > 1e-3 * s[0]):
            assert np.allclose(np.abs(got[:, i]), np.abs((u * s)[:, i]), atol=1e-6)
    assert np.allclose(np.linalg.norm(got, axis=0), s[:2], rtol=1e-8)
