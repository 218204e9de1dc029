"""The train/test split as a function of the visit id and a seed."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default seed and share of test rows, and the names of the two sides.
SEED = 42
TEST_SHARE = 0.20
TRAIN = "TRAIN"
TEST = "TEST"

SPLIT = "data_split"


def _hash(id_column: str, seed: int, instead: str | None) -> Column:
    """The first 32 bits of ``md5('<seed>:<id>')`` as eight hex digits; a NULL id gives way to ``instead``."""
    known = [F.col(c).cast("string") for c in (id_column, instead) if c is not None]
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(*known, F.lit("")))
    return F.substring(F.md5(text), 1, 8)


def split_key(id_column: str, seed: int = SEED, instead: str | None = None) -> Column:
    """Uniform number in [0, 1).

    It depends on nothing but the id and the seed, so neither a rerun, a lost executor nor another
    partitioning moves a row to the other side. Rows without an id would all get one number, so they are
    told apart by the column ``instead``, such as the event time.
    """
    return F.conv(_hash(id_column, seed, instead), 16, 10).cast("double") / F.lit(2.0**32)


def split_label(
    id_column: str, test_share: float = TEST_SHARE, seed: int = SEED, instead: str | None = None
) -> Column:
    """TEST where ``split_key < test_share``, else TRAIN.

    Compares the hex digits, which sort as the numbers do; turning each into a number costs as much
    as the hash.
    """
    bound = math.ceil(test_share * 2**32)
    below = _hash(id_column, seed, instead) < f"{bound:08x}" if bound < 2**32 else F.lit(True)
    return F.when(below, TEST).otherwise(TRAIN).alias(SPLIT)
