"""A network on each transaction's trailing sequence of its card."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.operators import sequences
from riskframe.operators.models import LABEL, BoostedModel, SequenceDetector
from riskframe.session import balanced, materialise

VECTOR = "_sequence_vector"
WIDTH = 3  # amount, age and mask of a place


def padded(seq: Column, length: int) -> Column:
    """Vector of ``length`` places, the latest first: log amount, log age in seconds, mask.

    Places beyond the sequence are zero in all three; so is a missing amount or time.
    """

    def place(x: Column) -> Column:
        amount = F.log1p(F.greatest(F.when(~F.isnan(x["amt"].cast("double")), x["amt"]), F.lit(0.0)))
        age = F.log1p(F.greatest(F.element_at(seq, -1)["dt"] - x["dt"], F.lit(0)).cast("double"))
        return F.array(F.coalesce(amount, F.lit(0.0)), F.coalesce(age, F.lit(0.0)), F.lit(1.0))

    real = F.flatten(F.transform(F.reverse(seq), place))
    return array_to_vector(F.concat(real, F.array_repeat(F.lit(0.0), F.lit(WIDTH * length) - F.size(real))))


class SequenceNetwork(SequenceDetector):
    """Multilayer perceptron on scaled, padded and masked trailing sequences.

    Trained on all rows with distributed gradients; few iterations, since frauds are few and it soon
    learns them by heart. Stored, loaded and scored on later rows as the tree detector is.
    """

    KIND = "sequence_network"

    def __init__(self, max_seq_len: int = 10, hidden: tuple[int, ...] = (16, 8), max_iter: int = 30, seed: int = 42):
        super().__init__(max_seq_len)
        self.hidden, self.max_iter, self.seed = tuple(hidden), max_iter, seed

    def _matrix(self, df: DataFrame) -> DataFrame:
        rows = sequences.trailing_sequences(df, self.max_seq_len)
        return rows.withColumn(VECTOR, padded(F.col("seq"), self.max_seq_len)).drop("seq")

    def fit(self, df: DataFrame, label: str = LABEL) -> SequenceNetwork:
        rows = self._matrix(df).select(VECTOR, F.col(label).cast("double").alias("_label"))
        rows = balanced(materialise(rows, "sequence-vectors"))
        network = MultilayerPerceptronClassifier(
            featuresCol="_features", labelCol="_label", layers=[WIDTH * self.max_seq_len, *self.hidden, 2],
            maxIter=self.max_iter, seed=self.seed,
        )
        scaler = StandardScaler(inputCol=VECTOR, outputCol="_features", withMean=True)
        self.model = BoostedModel(Pipeline(stages=[scaler, network]).fit(rows), [VECTOR], self.KIND)
        self.keep_recent(df)
        return self
