"""The feature matrix: encoded features in model order, and as one vector."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame

from visitrisk.operators.encode import BROADCAST_BYTES, encode
from visitrisk.spec import FeatureSpec

FEATURES = "features"


def feature_matrix(
    cleaned: DataFrame,
    spec: FeatureSpec,
    codes: DataFrame,
    names: Sequence[str] | None = None,
    keep: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Columns to ``keep``, then the features: those of the spec that the frame has, in model order.

    ``names`` is the stored order of a trained model; a name the frame cannot give is an error.
    """
    found = spec.available(cleaned.columns)
    needed = cleaned.select(*keep, *found.raw_features)
    encoded = encode(needed, codes, found.categorical, broadcast_bytes)
    return encoded.select(*keep, *(found.model_features if names is None else names))


def assembler(names: Sequence[str]) -> VectorAssembler:
    # NaN is a legal feature value, so it is kept.
    return VectorAssembler(inputCols=list(names), outputCol=FEATURES, handleInvalid="keep")
