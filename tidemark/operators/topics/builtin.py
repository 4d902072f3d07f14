"""The same topic model through Spark's own estimator (batch only)."""

from __future__ import annotations

from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_lda_ml(
    docs: DataFrame, vocab_size: int, k: int = 10, iters: int = 20, alpha: float = 0.001, beta: float = 0.01,
    min_df: int = 5, seed: int = 0,
) -> tuple[LDAModel, DataFrame]:
    """Fit on ``(doc_id, words)``; returns the model and ``(doc_id, topic, p)``.

    The online optimizer is used because the other one needs alpha above one.
    The estimator keeps its vocabulary and topic matrix on the driver.
    """
    counted = CountVectorizer(inputCol="words", outputCol="features", vocabSize=max(vocab_size, 1), minDF=min_df)
    vectors = counted.fit(docs).transform(docs).select("doc_id", "features")
    model = LDA(
        k=k, maxIter=iters, optimizer="online", docConcentration=[alpha], topicConcentration=beta, seed=seed
    ).fit(vectors)
    shares = model.transform(vectors).select(
        "doc_id", F.posexplode(vector_to_array("topicDistribution")).alias("topic", "p")
    )
    return model, shares
