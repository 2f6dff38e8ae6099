"""Feature vectors for MLlib stages."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    CountVectorizerModel, ElementwiseProduct, Normalizer, OneHotEncoder, PCA, StandardScaler, StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.functions.text import drop_words, ngram_range, tokens
from threadlens.functions.times import unix_seconds
from threadlens.operators.ngrams import document_terms, ngram_counts, vocabulary
from threadlens.session import written


def numeric_columns(df: DataFrame, skip: Sequence[str] = ()) -> list[str]:
    kinds = ("double", "float", "int", "bigint", "smallint", "tinyint")
    return [c for c, kind in df.dtypes if c not in skip and kind in kinds]


def assemble(columns: Sequence[str], output: str = "raw_features", invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=invalid)


def standardise(source: str = "raw_features", output: str = "features", scale: bool = True) -> StandardScaler:
    """Centre and, unless told not to, scale to unit deviation; constant columns become 0."""
    return StandardScaler(inputCol=source, outputCol=output, withMean=True, withStd=scale)


def standardise_columns(df: DataFrame, columns: Sequence[str], suffix: str = "_std") -> DataFrame:
    """The same in SQL with the population deviation, one new column each; constant columns become 0."""
    moments = df.agg(*[m for i, c in enumerate(columns) for m in (F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}"))])
    added = {}
    for i, c in enumerate(columns):
        mean, sd = moments.select(f"m{i}").scalar(), moments.select(f"s{i}").scalar()
        added[f"{c}{suffix}"] = F.when(sd > 0, (F.col(c) - mean) / sd).otherwise(F.col(c) - mean)
    return df.withColumns(added)


def one_hot(column: str, output: str, drop_last: bool = False) -> list:
    """Indexer and encoder; categories not seen when fitting get a vector of their own extra slot."""
    index = f"{output}_index"
    return [
        StringIndexer(inputCol=column, outputCol=index, handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCol=index, outputCol=output, dropLast=drop_last),
    ]


class TextVectors:
    """TF-IDF vectors over a capped vocabulary, the same weights as the long form.

    The vocabulary (at most `size` n-grams) and its document counts come from one aggregation; after that each
    row's vector is computed inside the row.
    """

    def __init__(self, train: DataFrame, text: str, size: int, stopwords: Sequence[str] = (), low: int = 1, high: int = 1):
        self.text, self.stopwords, self.low, self.high = text, stopwords, low, high
        terms = document_terms(train, text, stopwords, low, high, keep=())
        top = vocabulary(ngram_counts(terms), size).orderBy("ngram").collect()
        if not top:
            raise ValueError("no n-grams left to build a vocabulary from")
        docs = train.count()
        self.vocabulary = [r.ngram for r in top]
        self.idf = [math.log((1 + docs) / (1 + r.df)) + 1 for r in top]

    def add(self, df: DataFrame, output: str = "text_vector") -> DataFrame:
        grams = df.withColumn("_toks", drop_words(tokens(self.text), self.stopwords)).withColumn(
            "_grams", ngram_range(F.col("_toks"), self.low, self.high)
        )
        stages = [
            CountVectorizerModel.from_vocabulary(self.vocabulary, "_grams", "_tf"),
            ElementwiseProduct(scalingVec=Vectors.dense(self.idf), inputCol="_tf", outputCol="_weighted"),
            Normalizer(inputCol="_weighted", outputCol=output, p=2.0),
        ]
        return PipelineModel(stages).transform(grams).drop("_toks", "_grams", "_tf", "_weighted")


class MixedFeatures:
    """Community one-hot, capped TF-IDF, time as unix seconds and the sentiment column in one vector.

    Fitted on the training rows only; `scale` standardises the vector, without it unix seconds dominate distances. With
    `reuse` the training rows' text vectors are made and written once, for the fit and for `transform` of the same frame; its
    rows may then come in another order, which seeded forests and boosting would show.
    """

    def __init__(
        self, train: DataFrame, text: str = "body", community: str = "subreddit", created: str = "created_ts",
        passed: Sequence[str] = ("sentiment",), size: int = 100, stopwords: Sequence[str] = (), scale: bool = False, reuse: bool = False,
    ):
        self.created, self.passed = created, list(passed)
        self.text = TextVectors(train, text, size, stopwords)
        stages = one_hot(community, "community_vector")
        stages.append(assemble(["community_vector", "text_vector", "_seconds", *self.passed], "raw_features" if scale else "features"))
        if scale:
            stages.append(StandardScaler(inputCol="raw_features", outputCol="features", withMean=False, withStd=True))
        self.fitted_on, staged = (train if reuse else None), self._staged(train)
        self.rows = written(staged, "mixed-rows") if reuse else staged
        self.model = Pipeline(stages=stages).fit(self.rows)
        self.names = self._names(community)

    def _staged(self, df: DataFrame) -> DataFrame:
        return self.text.add(df).withColumn("_seconds", unix_seconds(self.created).cast("double"))

    def _names(self, community: str) -> list[str]:
        labels = list(self.model.stages[0].labels) + ["(other)"]
        return [f"{community}_{c}" for c in labels] + self.text.vocabulary + [self.created, *self.passed]

    def transform(self, df: DataFrame) -> DataFrame:
        staged = self.rows if df is self.fitted_on else self._staged(df)
        return self.model.transform(staged).drop("community_vector", "community_vector_index", "text_vector", "_seconds")


def reduced_text(
    train: DataFrame, text: str = "body", size: int = 1000, components: int = 100, stopwords: Sequence[str] = (), reuse: bool = False
):
    """Function adding a `text_pca` column: TF-IDF over uni- and bigrams projected to fewer dimensions.

    With `reuse` the vectors of `train`, written for the fit, also serve for adding the column to `train` itself; its rows may
    then come in another order, which seeded forests would show.
    """
    vectors = TextVectors(train, text, size, stopwords, 1, 2)
    made = vectors.add(train)
    rows = written(made if reuse else made.select("text_vector"), "text_vectors")
    add = sparse_components(rows, "text_vector", min(components, len(vectors.vocabulary)), "text_pca")
    return lambda df: add(rows if reuse and df is train else vectors.add(df)).drop("text_vector")


def sparse_components(train: DataFrame, source: str, k: int, output: str):
    """Function adding `output`, the centred coordinates of `source` on its first `k` principal components.

    Vectors stay sparse: the covariance comes from the sparse rows' products with the mean taken out of the sum, and the
    mean's own coordinates are taken off after projecting. `train` is read three times, so give it written.
    """
    model = PCA(k=k, inputCol=source, outputCol="_coordinates").fit(train.select(source))
    mean = train.select(Summarizer.mean(F.col(source)).alias("mean")).first()["mean"]
    shift = F.array(*[F.lit(float(v)) for v in mean.toArray() @ model.pc.toArray()])
    centred = array_to_vector(F.zip_with(vector_to_array("_coordinates"), shift, lambda x, m: x - m))
    return lambda df: model.transform(df).withColumn(output, centred).drop("_coordinates")
