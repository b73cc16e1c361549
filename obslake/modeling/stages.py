"""Label index -> assembler -> standard scaler -> decision tree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from obslake.functions.expr import day_key
from obslake.schema import FEATURE_COLUMNS, LABEL_INDEX_COL, SOURCE_COL


def build_stages(features: Sequence[str] = tuple(FEATURE_COLUMNS), label: str = SOURCE_COL,
                 label_index: str = LABEL_INDEX_COL, seed: int | None = None) -> Pipeline:
    """ML-1..5.  StringIndexer (most frequent label -> 0.0, ties
    alphabetical), VectorAssembler (a null feature is an error), StandardScaler
    (mean 0, sample std 1, a constant column maps to 0.0), decision tree with
    Spark's defaults (depth 5, 32 bins, gini)."""
    indexer = StringIndexer(inputCol=label, outputCol=label_index)
    assembler = VectorAssembler(inputCols=list(features), outputCol="unscaled_features")
    scaler = StandardScaler(inputCol="unscaled_features", outputCol="features",
                            withMean=True, withStd=True)
    tree = DecisionTreeClassifier(featuresCol="features", labelCol=label_index)
    if seed is not None:
        tree = tree.setSeed(seed)
    return Pipeline(stages=[indexer, assembler, scaler, tree])


def _input_columns(pipeline: Pipeline) -> list[str]:
    cols: list[str] = []
    for st in pipeline.getStages():
        if isinstance(st, StringIndexer):
            cols.append(st.getInputCol())
        elif isinstance(st, VectorAssembler):
            cols.extend(st.getInputCols())
    return list(dict.fromkeys(cols))


def fit(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    """ML-6.  Only the label and the assembler inputs are kept, and those rows
    are persisted (memory, spilling to disk) for the fit's passes: the
    indexer, the scaler and each tree level would otherwise re-read and
    re-parse the source.  A lost executor's blocks are recomputed from
    lineage."""
    needed = _input_columns(pipeline)
    if needed and all(c in train.columns for c in needed):
        train = train.select(*needed)
    cached = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return pipeline.fit(cached)
    finally:
        cached.unpersist()


def fit_counted(pipeline: Pipeline, train: DataFrame) -> tuple[PipelineModel, int]:
    """:func:`fit`, also returning the number of training rows, observed on
    the fit's first pass (no separate count over the source)."""
    seen = Observation("training_rows")
    model = fit(pipeline, train.observe(seen, F.count(F.lit(1)).alias("n")))
    return model, int(seen.get["n"])


def for_scoring(model: PipelineModel, unseen: str = "keep") -> PipelineModel:
    """Let the fitted label indexer accept sources unseen at training time
    (they get index = number of known labels) instead of failing the whole
    scoring job.  Fitting itself keeps ``error`` so the tree never learns a
    spurious extra class."""
    for st in model.stages:
        if isinstance(st, StringIndexerModel):
            st.setHandleInvalid(unseen)
    return model


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """ML-7: transform; works on a batch or a streaming DataFrame."""
    return for_scoring(model).transform(df)


def label_order(model_or_indexer) -> list[str]:
    """The fitted label order (index i -> label)."""
    if isinstance(model_or_indexer, PipelineModel):
        model_or_indexer = next(s for s in model_or_indexer.stages
                                if isinstance(s, StringIndexerModel))
    return list(model_or_indexer.labels)


def label_index_table(df: DataFrame, label: str, index_col: str = LABEL_INDEX_COL) -> DataFrame:
    """AGG-7 / ML-1: the fitted index of every label, as a table (the fitted
    indexer applied to the distinct labels)."""
    model = StringIndexer(inputCol=label, outputCol=index_col).fit(df)
    return model.transform(df.select(label).distinct())


# --- model store -------------------------------------------------------------

def save_model(model: PipelineModel, store: str, day: str) -> str:
    """SNK-4: ``<store>/date=<day>/model`` (overwrite), plus one row in the
    store's registry table (once per day and path) so loaders never list
    directories."""
    from obslake.session import path_exists
    spark = SparkSession.getActiveSession()
    path = f"{store.rstrip('/')}/date={day}/model"
    model.write().overwrite().save(path)
    reg = f"{store.rstrip('/')}/_registry"
    entry = spark.createDataFrame([(day, path)], "model_day string, model_path string")
    if path_exists(spark, reg):
        # A rerun of the same day overwrites the model; its registry row is
        # already there.
        entry = entry.join(spark.read.parquet(reg), ["model_day", "model_path"], "left_anti")
    entry.write.mode("append").parquet(reg)
    return path


def _discovered_models(spark: SparkSession, store: str) -> DataFrame:
    """Models saved without a registry (``<store>/date=<day>/model``, e.g. by
    an earlier system): found through partition discovery over the model
    metadata files, not by listing directories on the driver."""
    base = store.rstrip("/")
    meta = (spark.read.option("basePath", base)
            .text(f"{base}/date=*/model/metadata"))
    return meta.select(F.col("date").cast("string").alias("model_day")).distinct() \
               .select("model_day", F.concat(F.lit(f"{base}/date="), "model_day",
                                             F.lit("/model")).alias("model_path"))


def latest_model_path(spark: SparkSession, store: str, as_of_day: str | None = None) -> str | None:
    """SRC-4 resolver: path of the newest model saved on or before
    ``as_of_day`` (newest overall when None).  Reads the store's registry
    when it has one, else discovers ``date=<day>/model`` directories."""
    from obslake.session import path_exists
    reg_path = f"{store.rstrip('/')}/_registry"
    if path_exists(spark, reg_path):
        reg = spark.read.parquet(reg_path)
    elif path_exists(spark, store):
        reg = _discovered_models(spark, store)
    else:
        return None
    if as_of_day is not None:
        reg = reg.where(F.col("model_day") <= as_of_day)
    row = reg.orderBy(F.col("model_day").desc(), F.col("model_path").desc()).first()
    return row["model_path"] if row else None


def load_model(spark: SparkSession, store: str, as_of_day: str | None = None) -> PipelineModel:
    """SRC-4: load the newest model on or before the given day."""
    path = latest_model_path(spark, store, as_of_day)
    if path is None:
        raise FileNotFoundError(f"no model in {store} on or before {as_of_day}")
    return PipelineModel.load(path)


METADATA_SCHEMA = ("input_columns array<string>, training_split_used string, "
                   "training_entries_count bigint, paramGridBuilderValues string")


def read_metadata(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Training metadata documents; ``multiline`` for pretty-printed files
    (one document per file)."""
    return spark.read.schema(METADATA_SCHEMA).option("multiLine", multiline).json(path)


def metadata_document(spark: SparkSession, features: Sequence[str], n_rows: int,
                      split_used: str = "None") -> DataFrame:
    """ML-9 from an already known row count: a one-row document."""
    return spark.createDataFrame(
        [(list(features), split_used, int(n_rows), None)], METADATA_SCHEMA)


def training_metadata(train: DataFrame, features: Sequence[str],
                      split_used: str = "None") -> DataFrame:
    """ML-9: one row — feature names, split used, training row count, grid
    (none searched).  The count is an aggregate of ``train``, so building the
    document costs one aggregate and no collect."""
    return train.agg(F.count(F.lit(1)).alias("training_entries_count")).select(
        F.array(*[F.lit(f) for f in features]).alias("input_columns"),
        F.lit(split_used).alias("training_split_used"),
        F.col("training_entries_count"),
        F.lit(None).cast("string").alias("paramGridBuilderValues"),
    )


def model_day(ts=None):
    """Day key for a model directory (today when no timestamp column)."""
    return day_key(ts if ts is not None else F.current_timestamp())
