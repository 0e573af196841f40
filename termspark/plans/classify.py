"""Description classes from the language refsets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termspark import constants as C
from termspark.operators import filters


def refset_marks(
    refset_lang: DataFrame,
    component: str = "referenced_component_id",
    acceptability: str = "acceptability_id",
) -> DataFrame:
    """Per description: is any row preferred, is any acceptable. One row per description.

    Two flags instead of a join of all rows: combined before the shuffle, however many rows point at
    one description.
    """
    return refset_lang.groupBy(F.col(component).alias("_component")).agg(
        F.max(F.coalesce(F.col(acceptability) == C.PREFERRED, F.lit(False))).alias("_preferred"),
        F.max(F.coalesce(F.col(acceptability) == C.ACCEPTABLE, F.lit(False))).alias("_acceptable"),
    )


def classify_descriptions(
    description: DataFrame,
    refset_lang: DataFrame,
    key: str = "id",
    kind: str = "type_id",
    out: str = "identifier",
) -> DataFrame:
    """Add the class F, P, S or D to each description, the best over its active realm refset rows.

    Descriptions that no such row points at get NULL.
    """
    marks = refset_marks(filters.in_realm(filters.active(refset_lang)))
    joined = description.join(marks, F.col(key) == F.col("_component"), "left")
    type_id, preferred, acceptable = F.col(kind), F.col("_preferred"), F.col("_acceptable")
    found = (
        F.when(preferred & (type_id == C.FULLY_SPECIFIED_NAME), "F")
        .when(preferred & (type_id == C.SYNONYM), "P")
        .when(acceptable & (type_id == C.SYNONYM), "S")
        .when(F.col("_component").isNotNull() & (type_id == C.DEFINITION), "D")
    )
    return joined.select(*description.columns, found.alias(out))
