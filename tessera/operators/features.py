"""Feature stages: index categories, one-hot, assemble, scale.

Multi-column indexer and encoder stages fit every categorical column in one
pass instead of one job per column.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def categorical_columns(df: DataFrame, cols: list[str]) -> list[str]:
    """String columns are categorical (chosen from the schema at run time)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return [c for c in cols if isinstance(types[c], StringType)]


def numeric_columns(df: DataFrame, cols: list[str]) -> list[str]:
    cats = set(categorical_columns(df, cols))
    return [c for c in cols if c not in cats]


def indexer(cols: list[str], handle_invalid: str = "error") -> StringIndexer:
    """Most frequent label gets 0; equal counts ordered by label."""
    return StringIndexer(inputCols=cols, outputCols=[f"{c}_index" for c in cols],
                         stringOrderType="frequencyDesc", handleInvalid=handle_invalid)


def encoder(cols: list[str], drop_last: bool = True) -> OneHotEncoder:
    return OneHotEncoder(inputCols=[f"{c}_index" for c in cols],
                         outputCols=[f"{c}_index_ohe" for c in cols], dropLast=drop_last)


def feature_stages(df: DataFrame, feature_cols: list[str], out_col: str = "features",
                   scaled_col: str | None = "scaledFeatures", handle_invalid: str = "error") -> list:
    """Indexer + one-hot for string columns, then assembler (one-hot first,
    numerics after, as the original), then optional unit-variance scaling."""
    cats = categorical_columns(df, feature_cols)
    nums = numeric_columns(df, feature_cols)
    stages = []
    if cats:
        stages += [indexer(cats, handle_invalid), encoder(cats)]
    stages.append(VectorAssembler(inputCols=[f"{c}_index_ohe" for c in cats] + nums,
                                  outputCol=out_col))
    if scaled_col:
        stages.append(StandardScaler(inputCol=out_col, outputCol=scaled_col,
                                     withStd=True, withMean=False))
    return stages


def fit_features(df: DataFrame, feature_cols: list[str], **kw) -> PipelineModel:
    return Pipeline(stages=feature_stages(df, feature_cols, **kw)).fit(df)


def counted(df: DataFrame, cols: list[str], out_col: str = "n") -> DataFrame:
    """Each combination of ``cols`` once, with its number of rows: a fit on it
    with that weight is the fit on all rows, and its iterations read as many
    rows as there are combinations."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).cast("double").alias(out_col))


def vector_long(df: DataFrame, id_col: str, vec_col: str, value_col: str = "value") -> DataFrame:
    """A vector column as rows ``(id, position, value)``; zeros included."""
    return df.select(id_col, F.posexplode(vector_to_array(F.col(vec_col))).alias("position", value_col))


def vector_entries(df: DataFrame, id_col: str, vec_col: str, value_col: str = "value") -> DataFrame:
    """The non-zero entries of a vector column as rows ``(id, position, value,
    width)``. Sparse vectors are read as they are stored, so a category of a
    million levels costs its one entry; a vector of zeros gives no row, a null
    vector neither."""
    v = F.unwrap_udt(F.col(vec_col))
    sparse = v["type"] == 0
    width = F.when(sparse, v["size"]).otherwise(F.size(v["values"]))
    places = F.when(sparse, v["indices"]).otherwise(F.sequence(F.lit(0), F.greatest(F.size(v["values"]) - 1, F.lit(0))))
    rows = df.select(id_col, width.alias("width"), F.explode(F.arrays_zip(
        places.alias("position"), v["values"].alias("value"))).alias("e"))
    return rows.select(id_col, F.col("e.position").alias("position"), F.col("e.value").alias(value_col), "width") \
        .where(F.col(value_col) != 0)


def feature_names(df: DataFrame, vec_col: str) -> list[str]:
    """Slot names from the vector column's ML attribute metadata."""
    meta = df.schema[vec_col].metadata.get("ml_attr", {})
    names: dict[int, str] = {}
    for group in meta.get("attrs", {}).values():
        for a in group:
            names[a["idx"]] = a.get("name", f"f{a['idx']}")
    size = meta.get("num_attrs", len(names))
    return [names.get(i, f"f{i}") for i in range(size)]
