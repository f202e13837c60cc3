"""Raw API answers landed as JSON text, one document per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from wardline import schemas
from wardline.functions.casts import lenient_cast
from wardline.vocabulary import UNCLASSIFIED_REGION

_TEXTS = T.ArrayType(T.StringType())


def _parse(text: Column, shape: T.DataType | str) -> Column:
    return F.from_json(text, shape if isinstance(shape, str) else shape.simpleString())


def _is_list(text: Column) -> Column:
    return F.ltrim(text).startswith("[")


def _filled(records: Column) -> Column:
    """NULL for an empty list, so that `coalesce` moves on to the next envelope."""
    return F.when(F.size(records) > 0, records)


def unwrap_registry_payload(df: DataFrame, payload: str = "payload", single: bool = False,
                            schema: T.StructType = schemas.REGISTRY) -> DataFrame:
    """Registry records of every document, cast to `schema`.

    Records sit under `estabelecimentos`, else under `data`, else the document
    is itself the list. With `single` (an answer to a lookup of one code) the
    document may also be the record, and of a list only the first entry counts.
    Documents that hold no records, or are not JSON, give no rows.
    """
    text = F.col(payload)
    envelope = _parse(text, "estabelecimentos array<string>, data array<string>, codigo_cnes string")
    is_list = _is_list(text)
    wrapped = F.coalesce(_filled(envelope["estabelecimentos"]), _filled(envelope["data"]))
    records = F.when(is_list, _parse(text, "array<string>")).otherwise(wrapped)
    if single:
        whole = F.when(~is_list & envelope["codigo_cnes"].isNotNull(), F.array(text))
        records = F.coalesce(whole, F.slice(records, 1, 1))
    fields = T.StructType([T.StructField(name, T.StringType()) for name in schema.names])
    record = df.select(F.explode(records).alias("record")).select(F.from_json("record", fields).alias("record"))
    columns = [lenient_cast(F.col(f"record.{f.name}"), T.StringType(), f.dataType).alias(f.name)
               for f in schema.fields]
    return record.filter(F.col("record").isNotNull()).select(*columns)


def flatten_population(df: DataFrame, payload: str = "payload", order: str | None = None) -> DataFrame:
    """(`codigo_municipio`, `populacao`) from statistics documents.

    The population is the last value of a series; series that are empty or end
    in something that is no whole number are left out. With `order` (a column
    that numbers the documents) a code that occurs again keeps its last value.
    """
    series = "array<struct<localidade:struct<id:string>, serie:map<string,string>>>"
    shape = f"array<struct<resultados:array<struct<series:{series}>>>>"
    at = [F.col(order)] if order else []
    blocks = df.select(*[c.alias("_at") for c in at], F.posexplode(_parse(F.col(payload), shape)).alias("_p1", "block"))
    results = blocks.select("*", F.posexplode("block.resultados").alias("_p2", "result"))
    items = results.select("*", F.posexplode("result.series").alias("_p3", "item"))
    values = F.map_values("item.serie")
    last = F.when(F.size(values) > 0, F.element_at(values, -1))
    flat = items.select(
        *(["_at"] if order else []), "_p1", "_p2", "_p3",
        F.col("item.localidade.id").try_cast("bigint").alias("codigo_municipio"),
        last.try_cast("bigint").alias("populacao"),
    ).dropna(subset=["codigo_municipio", "populacao"])
    if not order:
        return flat.select("codigo_municipio", "populacao")
    position = F.struct("_at", "_p1", "_p2", "_p3")
    return flat.groupBy("codigo_municipio").agg(F.max_by("populacao", position).alias("populacao"))


def flatten_municipalities(df: DataFrame, uf: str, payload: str = "payload") -> DataFrame:
    """(`codigo_municipio`, `nome_municipio`, `uf`, `regiao_saude`) from locality documents.

    The region is the mesoregion's name, else the immediate region's; a missing
    or empty name moves on. A level that is present but null leaves the
    municipality unclassified.
    """
    place = df.select(F.explode(_parse(F.col(payload), "array<string>")).alias("place"))
    shape = ("id string, nome string, microrregiao struct<mesorregiao:struct<nome:string>>, "
             "`regiao-imediata` struct<nome:string>")
    parsed = place.select("place", F.from_json("place", shape).alias("p"))
    null_level = F.lit(False)
    for parent, key in (("$", "microrregiao"), ("$.microrregiao", "mesorregiao")):
        inner = F.get_json_object("place", parent)
        absent = ~F.coalesce(F.array_contains(F.json_object_keys(inner), key), F.lit(False))
        null_level = null_level | (~absent & F.get_json_object("place", f"{parent}.{key}").isNull())
    name = F.coalesce(F.nullif(F.col("p.microrregiao.mesorregiao.nome"), F.lit("")),
                      F.nullif(F.col("p.`regiao-imediata`.nome"), F.lit("")),
                      F.lit(UNCLASSIFIED_REGION))
    return parsed.filter(F.col("p.id").isNotNull()).select(
        F.col("p.id").try_cast("bigint").alias("codigo_municipio"),
        F.col("p.nome").alias("nome_municipio"),
        F.lit(uf).alias("uf"),
        F.when(null_level, F.lit(UNCLASSIFIED_REGION)).otherwise(name).alias("regiao_saude"),
    )
