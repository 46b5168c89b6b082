"""Keyed JSON records as batch operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ADD, UPDATE = "add", "update"


def _numbered(changes: DataFrame, batch: str) -> DataFrame:
    """Changes with an id each: an add without one gets it from its batch and number.

    The same batch gives the same ids when it is repeated; equal payloads stay apart.
    """
    made = F.sha2(F.concat_ws(":", F.lit(batch), F.col("seq").cast("string")), 256)
    new = F.when(F.col("op") == ADD, F.coalesce("id", made)).otherwise(F.col("id"))
    return changes.select("op", new.alias("id"), "data", "seq").filter("id is not null")


def upsert(records: DataFrame, changes: DataFrame, batch: str, at: Column | None = None) -> DataFrame:
    """Records after a batch of changes applied in ``seq`` order.

    ``records`` has a unique ``id`` and ``data``, ``changes`` has ``op``, ``id``, ``data`` and a unique
    ``seq``. Every add makes a record or replaces that of its id; one without an id gets an id of its own.
    An update of an id that is not known changes nothing. With ``at``, the time of the batch, records
    also have ``created_at`` and ``updated_at``.

    Only records with a change are merged. The others pass an anti-join, which Spark does without a
    shuffle while the changed ids are few.
    """
    times = [] if at is None else ["created_at", "updated_at"]
    new = _numbered(changes, batch)
    changed = new.select("id").distinct()
    old = records.join(changed, "id", "left_semi").select("id", "data", *times)
    # An id is known from the stored record or its first add on; an update before that misses.
    known = new.filter(F.col("op") == ADD).groupBy("id").agg(F.min("seq").alias("_from"))
    last = new.groupBy("id").agg(F.max_by("data", "seq").alias("_data"), F.max("seq").alias("_last"))
    merged = (
        last.join(known, "id", "left")
        .join(old.withColumn("_stored", F.lit(True)), "id", "left")
        .filter("_stored or _last >= _from")
    )
    columns = {"id": F.col("id"), "data": F.col("_data")}
    if at is not None:
        columns |= {"created_at": F.coalesce("created_at", at), "updated_at": at}
    merged = merged.select(*[c.alias(n) for n, c in columns.items()])
    return delete(records, changed).select("id", "data", *times).unionByName(merged)


def upsert_results(records: DataFrame, changes: DataFrame, batch: str) -> DataFrame:
    """Every change with the id it is about and whether it found or made a record: ``seq, op, id, hit``."""
    new = _numbered(changes, batch).drop("data")
    known = new.filter(F.col("op") == ADD).groupBy("id").agg(F.min("seq").alias("_from"))
    stored = _hits(records, new.select("id").distinct()).select("id", F.lit(True).alias("_stored"))
    found = new.join(known, "id", "left").join(stored, "id", "left")
    hit = (F.col("op") == ADD) | F.col("_stored") | (F.col("_from") < F.col("seq"))
    return found.select("seq", "op", "id", F.coalesce(hit, F.lit(False)).alias("hit"))


def payload(data: str = "data"):
    """JSON text of a record; a record without one stands for its id alone."""
    return F.coalesce(data, F.to_json(F.struct("id")))


def _hits(records: DataFrame, wanted: DataFrame) -> DataFrame:
    """Records with one of the ids, found without shuffling them while the ids are few."""
    return records.join(wanted, "id", "left_semi")


def lookup(records: DataFrame, ids: DataFrame) -> DataFrame:
    """Each distinct requested id with its record's JSON, null when there is no such record."""
    wanted = ids.select("id").distinct()
    found = _hits(records, wanted).select("id", payload().alias("data"), F.lit(True).alias("_found"))
    return wanted.join(found, "id", "left").select(
        "id", "data", F.coalesce("_found", F.lit(False)).alias("found")
    )


def delete(records: DataFrame, ids: DataFrame) -> DataFrame:
    """Records that remain after deleting ``ids``."""
    return records.join(ids.select("id").distinct(), "id", "left_anti")


def deletion_results(records: DataFrame, ids: DataFrame) -> DataFrame:
    """Each distinct id to delete with whether there was such a record."""
    wanted = ids.select("id").distinct()
    known = _hits(records, wanted).select("id", F.lit(True).alias("_known"))
    return wanted.join(known, "id", "left").select(
        "id", F.coalesce("_known", F.lit(False)).alias("deleted")
    )


def _fields(record: Column) -> Column:
    """Top-level keys and values of a VARIANT object, as a map; null for what is no object."""
    return F.try_variant_get(record, "$", "map<string, variant>")


def decode(records: DataFrame, schema: str = "") -> DataFrame:
    """All records with their JSON decoded: ``id``, the fields of ``schema`` as typed columns, and ``others``.

    ``others`` is a VARIANT with all that the columns do not give back, so a record of any shape comes out whole: keys
    that the schema does not name, values that its types cannot take (their column is null) or take only a part of, and
    a payload that is no object as it is. A record without payload stands for its id. Malformed JSON fails the query, as it always did. Names of the
    schema are exact, upper and lower case differ; ``id`` and ``others`` are taken.
    """
    wanted = T._parse_datatype_string(schema) if schema else T.StructType()
    taken = {"id", "others"} & {f.name.lower() for f in wanted}
    if taken:
        raise ValueError(f"fields named like a column: {sorted(taken)}")
    parsed = records.select("id", F.parse_json(payload()).alias("_v")).withColumn("_m", _fields(F.col("_v")))

    def held(value: Column, kind: T.DataType) -> Column:
        return F.try_variant_get(value, "$", kind.simpleString())

    def text(value: Column) -> Column:
        return F.to_json(F.to_variant_object(F.struct(value.alias("v"))))

    def elsewhere(key: Column, value: Column) -> Column:
        kept = F.lit(True)
        for f in wanted:
            whole = F.is_variant_null(value) | F.coalesce(text(held(value, f.dataType)) == text(value), F.lit(False))
            kept = kept & ~((key == f.name) & whole)
        return kept

    others = F.to_variant_object(F.map_filter("_m", elsewhere))
    return parsed.select(
        "id",
        *[held(F.try_element_at("_m", F.lit(f.name)), f.dataType).alias(f.name) for f in wanted],
        F.when(F.col("_m").isNotNull(), others).otherwise(F.col("_v")).alias("others"),
    )


def field_values(records: DataFrame) -> DataFrame:
    """Every top-level field of every record: ``id, key, type, value``, with the value as JSON text.

    For records whose keys nobody declared: group by key to see what there is. A payload that is no object has one row
    with a null key.
    """
    parsed = records.select("id", F.parse_json(payload()).alias("_v"))
    whole = F.map_entries(_fields(F.col("_v")))
    alone = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.col("_v").alias("value")))
    rows = parsed.select("id", F.explode(F.coalesce(whole, alone)).alias("_f"))
    kind = F.regexp_extract(F.schema_of_variant("_f.value"), "^[A-Z_]+", 0)
    return rows.select("id", F.col("_f.key").alias("key"), kind.alias("type"), F.to_json("_f.value").alias("value"))
