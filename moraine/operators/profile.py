"""Column profiles and the searchable catalog made from them."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from moraine.functions.values import cosine

#: Sample values that are kept.
SHOWN = 5


def profile(df: DataFrame, table: str, *, exact: bool = False, samples: bool = True) -> DataFrame:
    """One row per column; its statistics come from one aggregation over the table, its sample values from another one over distinct values.

    ``exact`` counts distinct values exactly instead of approximately, also in
    an aggregation of their own, whose rows carry nothing but values.
    """
    distinct = (lambda c: F.lit(None).cast("long")) if exact else F.approx_count_distinct

    def stats(f) -> Column:
        c = F.col(f.name)
        mean = F.avg(c).cast("double") if isinstance(f.dataType, NumericType) else F.lit(None).cast("double")
        return F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(c.isNull()).alias("null_count"),
            distinct(c).alias("distinct_count"),
            F.min(c).cast("string").alias("min_value"),
            F.max(c).cast("string").alias("max_value"),
            mean.alias("mean_value"),
        )

    wide = df.agg(*[stats(f).alias(f"s{i}") for i, f in enumerate(df.schema)])
    rows = wide.select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(df.schema))])))
    if exact:
        rows = rows.drop("distinct_count").join(F.broadcast(exact_counts(df).withColumnRenamed("exact", "distinct_count")), "column_name")
    if samples:
        rows = rows.join(F.broadcast(sampled(df).drop("exact")), "column_name")
    rate = F.coalesce(F.col("null_count") / F.nullif(F.col("row_count"), F.lit(0)), F.lit(0.0))
    return rows.select(F.lit(table).alias("table_name"), "column_name", "data_type", "row_count", "null_count", rate.alias("null_rate"), "distinct_count", "min_value", "max_value", "mean_value", *(["sample_values"] if samples else []))


def exact_counts(df: DataFrame) -> DataFrame:
    """``column_name, exact``: how many distinct values each column has, nulls not counted."""
    wide = df.agg(*[F.count_distinct(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("exact")) for i, c in enumerate(df.columns)])))


def sampled(df: DataFrame) -> DataFrame:
    """``column_name, exact, sample_values``: how many distinct texts each column has, and up to ``SHOWN`` of them.

    Of each of ``SHOWN`` parts of the hash space it is the value hashed
    lowest, in the order of the hashes: a bottom-k sketch of constant size, the
    same whatever the order of rows and however the table is cut. Values are
    made distinct first, so a text is hashed once however often it stands.
    """
    values = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").cast("string").alias("v")) for i, c in enumerate(df.columns)])
    texts = df.select(F.inline(values)).filter("v is not null").distinct().select("i", "v", F.md5("v").alias("h"))
    digit = F.ascii(F.substring("h", 32, 1))
    part = F.when(digit < 58, digit - 48).otherwise(digit - 87) % SHOWN
    placed = texts.select("i", (F.col("i") * SHOWN + part).alias("place"), F.concat("h", "v").alias("text"))

    def found(i: int, c: str) -> Column:
        lowest = F.array_compact(F.array(*[F.min(F.when(F.col("place") == i * SHOWN + k, F.col("text"))) for k in range(SHOWN)]))
        return F.struct(F.lit(c).alias("column_name"), F.count_if(F.col("i") == i).alias("exact"), F.transform(F.array_sort(lowest), lambda s: F.substr(s, F.lit(33))).alias("sample_values"))

    wide = placed.agg(*[found(i, c).alias(f"s{i}") for i, c in enumerate(df.columns)])
    return wide.select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(df.columns))])))


#: Two to this power registers in a sketch, whose standard error is 1.04 over the root of their number.
LG_REGISTERS = 12
SKETCHED = "table_name string, version string, column_name string, data_type string, row_count long, null_count long, sketch binary, total double, least_number decimal(38,10), most_number decimal(38,10), least_text string, most_text string"


def sketched(df: DataFrame, table: str, version: str) -> DataFrame:
    """One row per column with all that a profile needs, in a form that can be merged with other versions' or parts' rows.

    Distinct values are held as a sketch; numbers have sums and numeric
    extremes (null where 38 digits don't hold them, NaN and infinity too),
    other types extremes of their text.
    """

    def stats(f) -> Column:
        c, number = F.col(f.name), isinstance(f.dataType, NumericType)
        none = lambda kind: F.lit(None).cast(kind)
        text = c.cast("string")
        return F.struct(
            F.lit(table).alias("table_name"),
            F.lit(version).alias("version"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(c.isNull()).alias("null_count"),
            F.hll_sketch_agg(text, F.lit(LG_REGISTERS)).alias("sketch"),
            (F.sum(c.cast("double")) if number else none("double")).alias("total"),
            (F.min(c).try_cast("decimal(38,10)") if number else none("decimal(38,10)")).alias("least_number"),
            (F.max(c).try_cast("decimal(38,10)") if number else none("decimal(38,10)")).alias("most_number"),
            (none("string") if number else F.min(text)).alias("least_text"),
            (none("string") if number else F.max(text)).alias("most_text"),
        )

    wide = df.agg(*[stats(f).alias(f"s{i}") for i, f in enumerate(df.schema)])
    return wide.select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(df.schema))])))


def merged_profile(rows: DataFrame) -> DataFrame:
    """A profile of all that ``sketched`` rows cover, from those rows alone; the tables aren't read.

    A column that was retyped has the type of its last version in the alphabet.
    """
    merged = rows.groupBy("table_name", "column_name").agg(
        F.max_by("data_type", "version").alias("data_type"),
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_count"),
        *[f(c).alias(c) for f, c in ((F.min, "least_number"), (F.max, "most_number"), (F.min, "least_text"), (F.max, "most_text"), (F.sum, "total"))],
    )
    plain = lambda c: F.regexp_replace(F.regexp_replace(c.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    filled = F.col("row_count") - F.col("null_count")
    return merged.select(
        "table_name",
        "column_name",
        "data_type",
        "row_count",
        "null_count",
        F.coalesce(F.col("null_count") / F.nullif(F.col("row_count"), F.lit(0)), F.lit(0.0)).alias("null_rate"),
        "distinct_count",
        F.coalesce(plain(F.col("least_number")), "least_text").alias("min_value"),
        F.coalesce(plain(F.col("most_number")), "most_text").alias("max_value"),
        (F.col("total") / F.nullif(filled, F.lit(0))).alias("mean_value"),
    )


def store_sketches(df: DataFrame, table: str, version: str, path: str) -> None:
    """Adds a version's (or a part's) sketches to those at ``path``; the same version again replaces its rows."""
    from moraine.operators.cdc import upsert

    upsert(df.sparkSession, sketched(df, table, version), path, ["table_name", "version", "column_name"])


#: The stored profile's columns; written by ``store_profile``, read in this order of rows by ``stored_profiles``.
PROFILE_DDL = "table_name string, column_name string, data_type string, row_count long, null_count long, null_rate double, distinct_count long, min_value string, max_value string, mean_value double, sample_values array<string>, profiled_at timestamp"


def store_profile(profiles: DataFrame, path: str) -> None:
    """Profiles replace those of the same table and column; the table is made with its schema where there is none."""
    from pyspark.sql.types import StructType

    from moraine.operators.cdc import upsert

    stamped = profiles.withColumn("profiled_at", F.current_timestamp())
    rows = stamped.select(*[(F.col(f.name) if f.name in stamped.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(PROFILE_DDL)])
    upsert(profiles.sparkSession, rows, path, ["table_name", "column_name"])


def stored_profiles(spark, path: str) -> DataFrame:
    """All stored profiles by table and column; none, with their schema, before the first is stored."""
    from moraine.sources.versioned import VersionedTable

    store = VersionedTable(spark, path)
    rows = store.read() if store.exists() else spark.createDataFrame([], PROFILE_DDL)
    return rows.orderBy("table_name", "column_name")


def catalog_documents(profiles: DataFrame) -> DataFrame:
    """``doc_id, kind, table_name, column_name, text``: a document per column and one per table, numbered without gaps.

    A profile is some rows per table, so the numbering window holds metadata only.
    """
    from pyspark.sql import Window as W

    percent = F.format_string("%.1f%%", F.bround(F.col("null_rate") * 100, 1))
    samples = F.array_join(F.slice(F.coalesce("sample_values", F.array().cast("array<string>")), 1, SHOWN), ", ")
    text = F.concat_ws(
        " ",
        F.format_string("Table %s, column %s (%s).", "table_name", "column_name", "data_type"),
        F.format_string("Represents %s in the %s table.", F.translate("column_name", "_", " "), "table_name"),
        F.concat(F.lit("Cardinality "), F.col("distinct_count").cast("string"), F.lit(", null rate "), percent, F.lit(".")),
        F.when(samples != "", F.concat(F.lit("Sample values: "), samples, F.lit("."))),
    )
    # A table's documents come from one reading of its profile, which may not be stored yet.
    column = F.struct(F.lit("column").alias("kind"), F.col("column_name"), text.alias("text"))
    gathered = profiles.groupBy("table_name").agg(F.collect_list(column).alias("c"))
    names = F.array_join(F.array_sort(F.filter(F.transform("c", lambda x: x["column_name"]), lambda x: x.isNotNull())), ", ")
    table = F.struct(F.lit("table").alias("kind"), F.lit(None).cast("string").alias("column_name"), F.format_string("Table %s contains columns: %s. It holds %s records in the migrated warehouse.", F.col("table_name"), names, F.col("table_name")).alias("text"))
    documents = gathered.select("table_name", F.inline(F.concat("c", F.array(table))))
    number = F.row_number().over(W.orderBy("kind", "table_name", F.asc_nulls_last("column_name"))) - 1
    return documents.select(number.cast("long").alias("doc_id"), "kind", "table_name", "column_name", "text")


def hashed_embedding(dim: int = 384) -> Callable[[pd.Series], pd.Series]:
    """A stand-in for a model: words and their trigrams hashed into ``dim`` signed counts, scaled to length one."""
    import zlib

    import numpy as np

    def embed(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            v = np.zeros(dim, np.float32)
            for w in (t or "").lower().replace("_", " ").split():
                w = w.strip(".,():;")
                for g in {w, *(w[i : i + 3] for i in range(len(w) - 2))}:
                    h = zlib.crc32(g.encode())
                    v[h % dim] += 1 if h & 0x10000 else -1
            n = float(np.linalg.norm(v))
            out.append((v / n if n else v).tolist())
        return pd.Series(out)

    return embed


def index_documents(documents: DataFrame, embed: Callable[[pd.Series], pd.Series] | None = None) -> DataFrame:
    """Documents with a vector each; any vectorised embedder can be given."""
    return documents.withColumn("vector", F.pandas_udf(embed or hashed_embedding(), "array<float>")("text"))


def nearest(vectors: DataFrame, query: list[float], *, vector: str = "vector", limit: int = 5, tie: str = "doc_id") -> DataFrame:
    """The ``limit`` rows most like ``query`` by cosine, rounded to four digits."""
    score = cosine(F.col(vector), F.array(*[F.lit(float(x)) for x in query]))
    return vectors.withColumn("score", score).filter("score is not null").orderBy(F.desc("score"), tie).limit(limit).withColumn("score", F.round("score", 4))


def search(index: DataFrame, query: str, *, limit: int = 5, embed: Callable[[pd.Series], pd.Series] | None = None) -> DataFrame:
    return nearest(index, (embed or hashed_embedding())(pd.Series([query]))[0], limit=limit).drop("vector")
