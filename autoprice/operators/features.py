"""Feature encoders.

Label dictionaries are tables that join (free text can have any number of values). One-hot encoding uses
Spark ML's ``StringIndexer`` / ``OneHotEncoder``: a column per category, so only columns with few
categories come into question, and their dictionary (the model itself) reaches the driver. Standard scaling needs the *population* standard deviation with
``std = 0 -> 1`` (Spark ML's scaler uses the sample one), so it is fitted by one aggregate job whose
single row is applied as literals.
"""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def select_features(df: DataFrame, features: list[str], target: str | None = None,
                    keep: list[str] | None = None) -> DataFrame:
    """Keep ids, the features (in order) and the target."""
    cols = list(keep or []) + list(features) + ([target] if target else [])
    return df.select(*cols)


# Dictionaries of at most this many values are numbered by one window per column and broadcast; larger ones are ranked and joined in parts.
SMALL_DICTIONARY = 200_000


def _sort_form(df: DataFrame, c: str) -> list:
    """(bigint, double, string) of a value, one of them set: in the value's own order."""
    t = df.schema[c].dataType
    whole = isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType))
    number = isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType))
    value = F.col(c).cast("int").cast("bigint") if isinstance(t, T.BooleanType) else F.col(c).cast("bigint")
    return [(value if whole else F.lit(None).cast("bigint")).alias("n"), (F.col(c).cast("double") if number else F.lit(None).cast("double")).alias("d"),
            (F.lit(None) if whole or number else F.col(c)).cast("string").alias("s")]


def fit_label_encoders(df: DataFrame, cols: list[str]) -> dict[str, tuple[DataFrame, int]]:
    """E1 fit: per column a table (value, code) of its sorted distinct values with codes 0..k-1, and k.

    One pass over the rows: the distinct (column, value) pairs of all columns are one table, from which the codes of every column
    follow. The dictionaries are tables (a free-text column can have as many values as rows)."""
    from pyspark.sql import Window

    from autoprice.operators.ranking import global_index
    from autoprice.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), *_sort_form(df, c)) for i, c in enumerate(cols)])).alias("p")
    d = df.select(pairs).select("p.*").where("n is not null or d is not null or s is not null").distinct().checkpoint()
    sizes = {r.c: r["count"] for r in d.groupBy("c").count().collect()}  # one row a column
    order = ["c", "n", "d", "s"]
    if max(sizes.values(), default=0) <= SMALL_DICTIONARY:
        coded = d.withColumn("code", F.row_number().over(Window.partitionBy("c").orderBy("n", "d", "s")) - 1)
    else:
        ranked = global_index(d, order, "_i")
        first = F.broadcast(ranked.groupBy(F.col("c").alias("_c")).agg(F.min("_i").alias("_first")))  # one row a column
        coded = ranked.join(first, F.col("c") == F.col("_c")).withColumn("code", F.col("_i") - F.col("_first"))
    coded = coded.select(*order, "code").checkpoint()
    value = F.coalesce(F.col("n").cast("string"), F.col("d").cast("string"), F.col("s"))
    out = {}
    for i, c in enumerate(cols):
        t = df.schema[c].dataType
        own = (F.col("n") != 0) if isinstance(t, T.BooleanType) else F.col("n").cast(t) if isinstance(t, T.IntegralType) else \
            F.col("d").cast(t) if isinstance(t, T.FractionalType) else value.cast(t)
        out[c] = (coded.where(F.col("c") == i).select(own.alias("value"), F.col("code").cast("bigint").alias("code")), sizes.get(i, 0))
    return out


def label_encode(df: DataFrame, cols: list[str], model=None) -> DataFrame:
    """Append ``<c>_code`` integer columns; NULL and unseen values get k, like an extra class. Dictionaries known to be small are
    broadcast, so that all columns are coded in one pass without a shuffle."""
    model = model or fit_label_encoders(df, cols)
    out = df
    for c in cols:
        values, k = model[c]
        known = values.select(F.col("value").alias("_value"), F.col("code").cast("int").alias("_code"))
        if k <= SMALL_DICTIONARY:
            known = F.broadcast(known)
        out = out.join(known, F.col(c) == F.col("_value"), "left") \
                 .withColumn(f"{c}_code", F.coalesce("_code", F.lit(k))).drop("_value", "_code")
    return out.select(*df.columns, *[f"{c}_code" for c in cols])


MAX_CATEGORIES = 10_000


def fit_one_hot(df: DataFrame, cols: list[str]):
    """E2 fit: index (alphabetical) + one-hot with the unknown / NULL slot dropped -> all zeros. A column of more than
    MAX_CATEGORIES values (counted within two per cent) is a ValueError: its dictionary is not for the driver (see E1)."""
    from pyspark.ml import Pipeline
    counts = df.agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in cols]).first()
    many = [c for c in cols if counts[c] > MAX_CATEGORIES]
    if many:
        raise ValueError(f"too many categories for one column each: {', '.join(many)}")
    idx = StringIndexer(inputCols=list(cols), outputCols=[f"{c}_idx" for c in cols], stringOrderType="alphabetAsc",
                        handleInvalid="keep")
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in cols], outputCols=[f"{c}_ohe" for c in cols],
                        dropLast=True, handleInvalid="keep")
    return Pipeline(stages=[idx, ohe]).fit(df)


def one_hot(df: DataFrame, cols: list[str], model=None, explode_columns: bool = True) -> DataFrame:
    """One indicator per seen category; unseen and NULL values give all zeros.

    With ``explode_columns`` the vector is expanded into ``<col>_<category>`` 0/1 integer columns.
    """
    model = model or fit_one_hot(df, cols)
    out = model.transform(df)
    if not explode_columns:
        return out.drop(*[f"{c}_idx" for c in cols])
    labels = dict(zip(cols, model.stages[0].labelsArray))
    extra = []
    for c in cols:
        arr = vector_to_array(F.col(f"{c}_ohe"))
        for i, lab in enumerate(labels[c]):
            extra.append(arr[i].cast("int").alias(f"{c}_{lab}"))
    return out.select(*df.columns, *extra)


def standard_scale(df: DataFrame, cols: list[str], suffix: str = "_z", stats_from: DataFrame | None = None) -> DataFrame:
    """``(x - mean) / population std`` with a zero std replaced by 1 (scikit-learn's rule).

    ``stats_from`` lets a test set be scaled with the training statistics.
    """
    src = stats_from if stats_from is not None else df
    # fit: one aggregate job, one row of (mean, std) per column
    st = src.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    outs = []
    for c in cols:
        sd = st[f"s_{c}"]
        sd = 1.0 if sd is None or sd == 0 else float(sd)
        mean = st[f"m_{c}"]
        outs.append(((F.col(c) - F.lit(mean).cast("double")) / F.lit(sd)).alias(f"{c}{suffix}"))
    return df.select(*df.columns, *outs)


def url_chars(url: str = "url"):
    """Characters of the lower-cased URL (the character vectoriser's analyzer)."""
    return F.filter(F.split(F.lower(F.col(url)), ""), lambda ch: ch != F.lit(""))


def char_counts_long(df: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """E4 long form: (key, character, count)."""
    return (df.select(key, F.explode(url_chars(url)).alias("ch"))
              .groupBy(key, "ch").agg(F.count(F.lit(1)).alias("cnt")))


def fit_char_vectorizer(df: DataFrame, url: str = "url", vocabulary: int = 1 << 18):
    """E4 fit: vocabulary of characters seen in training (unknown characters ignored later), at most
    ``vocabulary`` (Spark's default; there are fewer Unicode characters in use)."""
    return CountVectorizer(inputCol="_chars", outputCol="features", minDF=1.0, vocabSize=vocabulary).fit(df.select(url_chars(url).alias("_chars")))


def char_count_vector(df: DataFrame, model, url: str = "url") -> DataFrame:
    """Sparse character-count vector ``features``."""
    return model.transform(df.withColumn("_chars", url_chars(url))).drop("_chars")


def assemble_features(df: DataFrame, inputs: list[str], output: str = "features") -> DataFrame:
    """E5: concatenate numeric and encoded blocks in a fixed order (error on NULL)."""
    return VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid="error").transform(df)


def assembled_names(df: DataFrame, output: str = "features") -> list[str]:
    """Slot names of an assembled vector (for feature importances)."""
    meta = df.schema[output].metadata.get("ml_attr", {})
    attrs = []
    for group in meta.get("attrs", {}).values():
        attrs.extend(group)
    return [a["name"] for a in sorted(attrs, key=lambda a: a["idx"])]


def feature_importance(spark, model, names: list[str], k: int | None = None) -> DataFrame:
    """(feature, importance) descending; top ``k`` when given. The importances are the fitted
    model's vector, one value per feature slot."""
    imp = model.featureImportances.toArray().tolist()
    rows = [(n, float(v)) for n, v in zip(names, imp)]
    df = spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), F.asc("feature"))
    return df.limit(k) if k else df
