"""Feature stages for ``pyspark.ml`` pipelines, saved and loaded like Spark's own.

Inside a pipeline the fits happen on the training folds only.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCol, HasOutputCols, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepkit.operators.impute import fit_modes


#: Cells of kernel features made at once in a task.
FEATURE_CELLS = 2**19


class _Columns(HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)


class SquareProduct(_Columns, Transformer):
    """Squares of the input columns."""

    def _transform(self, df: DataFrame) -> DataFrame:
        cells = [F.col(c).cast("double") for c in self.getInputCols()]
        return df.select("*", *[(c * c).alias(o) for c, o in zip(cells, self.getOutputCols())])


class PairwiseProduct(_Columns, Transformer):
    """Products of column pairs; the input lists both columns of each pair in turn."""

    def _transform(self, df: DataFrame) -> DataFrame:
        flat = self.getInputCols()
        pairs = zip(flat[0::2], flat[1::2])
        products = [F.col(a).cast("double") * F.col(b).cast("double") for a, b in pairs]
        return df.select("*", *[p.alias(o) for p, o in zip(products, self.getOutputCols())])


class PairwiseMax(_Columns, Transformer):
    """The larger of each column pair; the input lists both columns of each pair in turn."""

    def _transform(self, df: DataFrame) -> DataFrame:
        flat = self.getInputCols()
        pairs = zip(flat[0::2], flat[1::2])
        return df.select("*", *[F.greatest(a, b).alias(o) for (a, b), o in zip(pairs, self.getOutputCols())])


class KeptIndexImputer(_Columns, Estimator):
    """Puts the most frequent index over the extra one a keeping indexer gave to missing strings."""

    def _fit(self, df: DataFrame) -> KeptIndexModel:
        # The indexer numbers by falling frequency, so the most frequent known value is 0;
        # the extra index is the number of values, which its metadata carries.
        kept = []
        for c in self.getInputCols():
            names = df.schema[c].metadata.get("ml_attr", {}).get("vals", [])
            kept.append(float(len(names) - 1) if names else -1.0)
        known = {c: (0.0, k - 1.0) for c, k in zip(self.getInputCols(), kept) if k >= 0}
        found = fit_modes(df, list(self.getInputCols()), known)
        fills = [float(found.get(c, 0.0)) for c in self.getInputCols()]
        model = KeptIndexModel(inputCols=self.getInputCols(), outputCols=self.getOutputCols())
        return model._set(kept=kept, fills=fills)


class KeptIndexModel(_Columns, Model):
    kept = Param(Params._dummy(), "kept", "the index standing for missing, per column", TypeConverters.toListFloat)
    fills = Param(Params._dummy(), "fills", "the index put in its place, per column", TypeConverters.toListFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        parts = zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault("kept"), self.getOrDefault("fills"))
        return df.select("*", *[F.when(F.col(c) == k, F.lit(v)).otherwise(F.col(c)).alias(o) for c, o, k, v in parts])


class FourierFeatures(HasInputCols, HasOutputCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable, Transformer):
    """A vector whose inner products are near a Gaussian kernel's values, so that a linear model separates as a kernel one.

    Entry i is sqrt(2 / n) * cos(w_i . x + b_i) with w_i drawn from a normal distribution of variance 2 * gamma and b_i from
    [0, 2 pi). The inner product of two rows differs from exp(-gamma * |x - y|^2) by under 5 / sqrt(n), nearly always. Draws
    follow from the seed, so a stage saved and loaded makes the same features. A missing cell is an error, as in assembling.
    All other columns go along through Arrow, which takes every type but intervals of months.
    """

    numFeatures = Param(Params._dummy(), "numFeatures", "entries of the vector", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "how fast the kernel falls with squared distance", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol="features", numFeatures=256, gamma=1.0, seed=42):
        super().__init__()
        self._setDefault(outputCol="features", numFeatures=256, gamma=1.0, seed=42)
        self._set(**self._input_kwargs)

    def draws(self) -> list[list[float]]:
        """w_i followed by b_i, for each entry."""
        rng = random.Random(self.getSeed())
        spread = math.sqrt(2.0 * self.getOrDefault("gamma"))
        width = len(self.getInputCols())
        return [[*[rng.gauss(0.0, spread) for _ in range(width)], rng.uniform(0.0, 2.0 * math.pi)] for _ in range(self.getOrDefault("numFeatures"))]

    def _transform(self, df: DataFrame) -> DataFrame:
        draws = np.array(self.draws())
        weights, offsets = draws[:, :-1].T.copy(), draws[:, -1].copy()
        size = math.sqrt(2.0 / len(draws))
        step = max(FEATURE_CELLS // len(draws), 1)

        n, name = len(df.columns), self.getOutputCol()

        def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, step):
                    batch = whole.slice(at, step)
                    angles = offsets
                    for c, w in zip(batch.columns[n:], weights):
                        angles = angles + np.outer(c.to_numpy(zero_copy_only=False), w)
                    made = size * np.cos(angles)
                    vectors = pa.ListArray.from_arrays(np.arange(0, made.size + 1, made.shape[1], dtype=np.int32), made.ravel())
                    yield batch.select(range(n)).append_column(name, vectors)

        cells = [F.col(c).cast("double") for c in self.getInputCols()]
        gaps = F.greatest(*map(F.isnull, cells), F.lit(False))
        cells[0] = F.when(gaps, F.raise_error(F.lit("a missing cell has no kernel features")).cast("double")).otherwise(cells[0])
        rows = df.select("*", *[c.alias(f"_cell{k}") for k, c in enumerate(cells)])
        wide = rows.mapInArrow(entries, T.StructType([*df.schema.fields, T.StructField(name, T.ArrayType(T.DoubleType()))]))
        return wide.withColumn(name, array_to_vector(name))


def scale_gamma(df: DataFrame, columns: Sequence[str]) -> float:
    """1 / (columns * variance of all their cells): a gamma that fits the data's spread; 1 without spread."""
    cells = [F.col(c).cast("double") for c in columns]
    every = df.select(F.explode(F.array(*cells)).alias("v")).agg(F.var_pop("v")).first()[0]
    return 1.0 / (len(columns) * every) if every else 1.0
