"""SRC-5 for payloads whose fields drift: nothing that was sent is lost.

``with_rescue`` puts declared fields into a typed struct and everything else
(undeclared fields, values of another kind) into a VARIANT beside it.
``field_counts`` lists what a column of payloads really holds.

Kinds are those of JSON: OBJECT, ARRAY, STRING, BIGINT, DECIMAL, DOUBLE,
BOOLEAN and VOID (JSON null).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.session import scratch_path

# --- fixed values: the kinds a declared type accepts ---
FITS = {
    "string": ("STRING",),
    "boolean": ("BOOLEAN",),
    "int": ("BIGINT",),
    "bigint": ("BIGINT",),
    "float": ("BIGINT", "DECIMAL", "DOUBLE"),
    "double": ("BIGINT", "DECIMAL", "DOUBLE"),
}
# --- end fixed values ---
COUNTS = "path string, kind string, n bigint"


def kind(value: Column) -> Column:
    """The JSON kind of a VARIANT, without its precision or members."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def _typed(value: Column, data_type: str) -> Column:
    """The value as the declared type where its kind fits, else null."""
    return F.when(kind(value).isin(*FITS[data_type]), F.try_variant_get(value, "$", data_type))


def with_rescue(df: DataFrame, text_col: str, declared: Mapping[str, str],
                out_col: str = "doc", rescue_col: str = "rescued") -> DataFrame:
    """``df`` with the declared top-level fields of a JSON text as the struct
    ``out_col``, and the rest as the VARIANT ``rescue_col`` (null: no rest).

    A declared field stays in the rest where its value has another kind or is
    out of range; JSON null fits every type.  A text that is JSON but no
    object is the rest as a whole; a text that is no JSON (an object that
    names a field twice included) is the rest as a string.  ``out_col`` is
    null in both cases.  A null text has neither."""
    unknown = {t for t in declared.values() if t not in FITS}
    if unknown:
        raise ValueError(f"declare one of {sorted(FITS)}, not {sorted(unknown)}")
    parsed = F.try_parse_json(F.col(text_col))
    fields = F.try_variant_get(parsed, "$", "map<string,variant>")

    def left_over(name: Column, value: Column) -> Column:
        lost = ~name.isin(*declared)
        for field, data_type in declared.items():
            here = (name == field) & ~F.is_variant_null(value) & _typed(value, data_type).isNull()
            lost = lost | here
        return lost

    typed = F.struct(*[_typed(F.try_element_at("_fields", F.lit(n)), t).alias(n) for n, t in declared.items()])
    rest = F.map_filter("_fields", left_over)
    out = (df.withColumns({"_parsed": parsed, "_fields": fields})
           .withColumns({
               out_col: F.when(F.col("_fields").isNotNull(), typed),
               rescue_col: F.when(F.col("_fields").isNotNull(),
                                  F.when(F.size(rest) > 0, F.to_variant_object(rest)))
               .otherwise(F.coalesce("_parsed", F.col(text_col).cast("variant")))}))
    return out.drop("_parsed", "_fields")


def field_counts(df: DataFrame, text_col: str) -> DataFrame:
    """(path, kind, n): how many values each path of the payloads holds, by
    kind, at every depth.  ``$`` is the payload itself, ``[*]`` any element of
    an array; texts that are no JSON are counted at ``$`` as INVALID, null
    texts not at all.

    One pass a level of nesting, each counting with partial aggregates; the
    pass after the last level that holds objects or arrays is not started.
    Only the counts of a level are written, never its values."""
    spark = df.sparkSession
    parsed = df.select(F.lit("$").alias("path"), F.col(text_col).alias("text"),
                       F.try_parse_json(F.col(text_col)).alias("value")).where("text is not null")
    level = parsed.select("path", "value", F.coalesce(kind(F.col("value")), F.lit("INVALID")).alias("kind"))
    plain = F.col("name").rlike("^[A-Za-z_][A-Za-z0-9_]*$")
    step = F.when(plain, F.concat(F.lit("."), "name")).otherwise(
        F.concat(F.lit("['"), F.replace("name", F.lit("'"), F.lit("\\'")), F.lit("']")))
    found: DataFrame | None = None
    while True:
        path = scratch_path(spark, "fields", unique=True)
        level.groupBy("path", "kind").agg(F.count(F.lit(1)).alias("n")).write.parquet(path)
        counts = spark.read.schema(COUNTS).parquet(path)
        found = counts if found is None else found.unionByName(counts)
        if counts.where("kind in ('OBJECT', 'ARRAY')").isEmpty():
            return found
        members = (level.where("kind = 'OBJECT'")
                   .select("path", F.explode(F.try_variant_get("value", "$", "map<string,variant>")).alias("name", "value"))
                   .select(F.concat("path", step).alias("path"), "value"))
        elements = (level.where("kind = 'ARRAY'")
                    .select(F.concat("path", F.lit("[*]")).alias("path"),
                            F.explode(F.try_variant_get("value", "$", "array<variant>")).alias("value")))
        level = members.unionByName(elements).withColumn("kind", kind(F.col("value")))
