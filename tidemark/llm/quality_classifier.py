"""Text quality by regularised quadratic discriminant analysis of document statistics."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import let, stage, words_of

#: Share of the pooled covariance in that of each class, and of the diagonal in the result.
TOWARDS_POOLED, TOWARDS_DIAGONAL = 0.1, 0.1
#: The largest difference of log densities that counts, so that no score is exactly 0 or 1.
MOST = 30.0


def _share(part: Column, whole: Column) -> Column:
    """Log odds of a share, finite for 0 and 1."""
    return F.log((part + 0.5) / (whole - part + 1.0))


def _features(text: Column, words: Column, signs: Column) -> Column:
    chars = F.length(text).cast("double")
    n = F.size(words).cast("double")

    def of_class(name: str) -> Column:
        return F.length(F.regexp_replace(signs, f"[^{name}]+", "")).cast("double")

    repeated = F.size(F.filter(words, lambda word, i: word == F.get(words, i - 1))).cast("double")
    lines = F.split(text, "\n")
    n_lines = F.size(lines).cast("double")
    return F.struct(
        F.log1p(n).alias("length"),
        F.log1p(chars / (n + 1.0)).alias("word_length"),
        F.log1p(n / n_lines).alias("line_length"),
        _share(of_class(r"\p{Lu}"), chars).alias("upper"),
        _share(of_class(r"\p{Nd}"), chars).alias("digits"),
        _share(of_class(r"#*$%&|<>@=_~^"), chars).alias("symbols"),
        _share(of_class(r"!?"), chars).alias("marks"),
        _share(of_class(r".,;:"), chars).alias("stops"),
        _share(F.size(F.array_distinct(words)).cast("double"), n).alias("distinct"),
        _share(repeated, n).alias("repeated"),
        _share(F.size(F.array_distinct(lines)).cast("double"), n_lines).alias("lines"),
    )


def featured(text: Column) -> Column:
    """The struct of transformed statistics of a whole text; a null text is an empty one.

    Each part is computed once wherever the expression stands, also where a rewrite of the plan
    repeats it.  Plain letters and spaces go first, so that the classes are sought in the rest.
    """
    return let(F.coalesce(text, F.lit("")), lambda t: let(words_of(t), lambda w: let(
        F.regexp_replace(t, "[a-z ]+", ""), lambda signs: _features(t, w, signs)
    )))


@dataclass(frozen=True)
class Model:
    """Of class 0 and 1 the means, the inverse Cholesky factors and the log density at the mean."""

    names: list[str]
    means: np.ndarray
    factors: np.ndarray
    heights: np.ndarray

    def score(self, values: Column) -> Column:
        """Probability of class 1 from the difference of the log densities."""
        x = [values[name] for name in self.names]

        def log_density(k: int) -> Column:
            centred = [column - float(mean) for column, mean in zip(x, self.means[k])]
            whitened = [
                reduce(Column.__add__, [c * float(f) for c, f in zip(centred, row[: i + 1])])
                for i, row in enumerate(self.factors[k])
            ]
            return reduce(Column.__add__, [z * z for z in whitened]) * -0.5 + float(self.heights[k])

        difference = log_density(1) - log_density(0)
        return 1.0 / (1.0 + F.exp(-F.greatest(F.least(difference, F.lit(MOST)), F.lit(-MOST))))


@dataclass(frozen=True)
class Constant:
    """The model of labels that name fewer than two classes."""

    value: float

    def score(self, values: Column) -> Column:
        return F.lit(self.value)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit(rows: DataFrame, labels: DataFrame) -> Model | Constant:
    """A model from the columns doc_id and features of rows, and from labels.

    Only the rows that are not held out are learned from, all of them.  Per class Spark adds up
    the values and their products, so two rows of sums reach the driver.  Labels other than 0
    and 1 are ignored.
    """
    learned = labels.select(labels["doc_id"].alias("doc_id"), labels["quality"].alias("quality")).where(
        F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))
    )
    names = rows.schema["features"].dataType.names
    x = [F.col(f"features.{name}") for name in names]
    pairs = [(i, j) for i in range(len(x)) for j in range(i + 1)]
    sums = (
        rows.join(learned, "doc_id")
        .groupBy("quality")
        .agg(
            F.count("*").alias("n"),
            F.array(*[F.sum(c) for c in x]).alias("sums"),
            F.array(*[F.sum(x[i] * x[j]) for i, j in pairs]).alias("products"),
        )
        .collect()
    )
    if len(sums) < 2:
        return Constant(float(sums[0]["quality"]) if sums else 0.5)
    d = len(names)
    n = np.zeros(2)
    means, scatter = np.zeros((2, d)), np.zeros((2, d, d))
    for row in sums:
        k = row["quality"]
        n[k], means[k] = row["n"], np.array(row["sums"]) / row["n"]
        for (i, j), total in zip(pairs, row["products"]):
            scatter[k, i, j] = scatter[k, j, i] = total - row["n"] * means[k, i] * means[k, j]
    pooled = scatter.sum(0) / n.sum()
    factors, heights = np.zeros((2, d, d)), np.zeros(2)
    for k in range(2):
        covariance = (1 - TOWARDS_POOLED) * scatter[k] / n[k] + TOWARDS_POOLED * pooled
        diagonal = np.diag(np.diag(pooled) + 1e-3)
        covariance = (1 - TOWARDS_DIAGONAL) * covariance + TOWARDS_DIAGONAL * diagonal
        lower = np.linalg.cholesky(covariance)
        factors[k] = np.linalg.inv(lower)
        heights[k] = np.log(n[k] / n.sum()) - np.log(np.diag(lower)).sum()
    return Model(names, means, factors, heights)


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: quality 1 likelier) and predicted of each row.

    An empty or null text is scored like any other, by the features of no words; repeated rows
    are scored each; without labels of both classes every score is that of the one class, or 0.5
    without any.  A null doc_id is not held out and never learned from.  An empty table gives no
    rows.  Other columns of docs are left out.

    The features are staged, so the texts are read once.
    """
    rows = stage(docs.select(docs["doc_id"].alias("doc_id"), featured(docs["text"]).alias("features")), "features")
    score = fit(rows, labels).score(F.col("features"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that are predicted to be of quality 1, with all their columns.

    Learns as `score_quality` does, in a pass that keeps only the narrow features of labelled
    rows, and scores in a second, so that no text is shuffled.
    """
    rows = docs.select(docs["doc_id"].alias("doc_id"), featured(docs["text"]).alias("features"))
    model = fit(rows, labels)
    return docs.where(let(featured(docs["text"]), model.score) >= 0.5)
