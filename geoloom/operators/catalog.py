"""Tables brought to a catalogue: casts with a reject report, entity keys, conformed vintages, tags, schema drift."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.operators.merge import record_hash

# The declared types of portals, shapefiles and census variables, and the types they become. Geometry stays text.
PORTAL_TYPES = {
    "text": "string", "url": "string", "number": "decimal(38,10)", "double": "double", "money": "decimal(19,4)", "percent": "decimal(38,10)", "checkbox": "boolean", "calendar_date": "timestamp", "date": "timestamp",
    "fixed_timestamp": "timestamp", "floating_timestamp": "timestamp_ntz", "point": "string", "multipoint": "string", "line": "string", "multiline": "string", "polygon": "string", "multipolygon": "string",
    "location": "string", "blob": "string", "photo": "string", "document": "string", "html": "string", "email": "string", "phone": "string",
}
SHAPE_TYPES = {"str": "string", "int": "bigint", "int32": "int", "int64": "bigint", "float": "double", "date": "date", "datetime": "timestamp", "time": "time", "bytes": "binary"}
CENSUS_TYPE = "decimal(38,10)"
SYSTEM_RENAMES = {":id": "socrata_id", ":updated_at": "socrata_updated_at", ":created_at": "socrata_created_at", ":version": "socrata_version"}
COMPUTED_PREFIX = ":@computed_region"
KEY_CANDIDATES = ("geoid", "geoidfq", "linearid", "tlid", "areaid")
#: Tags of a street edge that become columns; a column is named like its tag, with "_" for ":".
EDGE_TAGS = (
    "name", "highway", "oneway", "reversed", "maxspeed", "surface", "lanes", "ref", "service", "width", "lit", "access", "bridge", "tunnel",
    "bicycle", "bicycle:lanes", "bicycle:lanes:backward", "bicycle:lanes:forward", "bicycle:right", "bicycle_road", "class:bicycle", "cyclestreet", "oneway:bicycle", "ramp:bicycle", "sidewalk:both:bicycle",
    "cycleway", "cycleway:buffer", "cycleway:lane", "cycleway:oneway", "cycleway:separation", "cycleway:shared_lane", "cycleway:smoothness", "cycleway:surface",
    "cycleway:both", "cycleway:both:buffer", "cycleway:both:colour", "cycleway:both:lane", "cycleway:both:separation", "cycleway:both:shared_lane", "cycleway:both:traffic_sign",
    "cycleway:left", "cycleway:left:buffer", "cycleway:left:lane", "cycleway:left:oneway", "cycleway:left:separation", "cycleway:left:shared_lane", "cycleway:left:traffic_sign",
    "cycleway:right", "cycleway:right:buffer", "cycleway:right:lane", "cycleway:right:oneway", "cycleway:right:separation", "cycleway:right:shared_lane", "cycleway:right:traffic_sign",
)


def spark_type(source: str, declared: str) -> str:
    """The type that a declared type becomes; an unknown one becomes text. source: portal, shape or census."""
    if source == "census":
        return CENSUS_TYPE
    return (PORTAL_TYPES if source == "portal" else SHAPE_TYPES).get(declared.split(":")[0], "string")


def _cast(c: Column, kind: str) -> Column:
    if kind == "time":  # kept as text of one form
        return F.when(c.rlike(r"^([01]\d|2[0-3]):[0-5]\d:[0-5]\d$"), c)
    return F.to_binary(c, F.lit("utf-8")) if kind == "binary" else c.try_cast(kind)


def cast_by_catalog(df: DataFrame, catalog: dict[str, tuple[str, str]], keep: Sequence[str] = ()) -> DataFrame:
    """The catalogue's columns (name to (source, declared type)), cast, and ``rejects``: (column, value) of each cell that its
    type can't hold. Casts and report come from one projection; a column that ``df`` lacks is null."""
    kinds = {c: spark_type(*d) for c, d in catalog.items()}
    has = [c for c in kinds if c in df.columns]
    text = {c: F.col(f"`{c}`").cast("string") for c in has}
    cells = [F.when(text[c].isNotNull() & _cast(text[c], kinds[c]).isNull(), F.struct(F.lit(c).alias("column"), text[c].alias("value"))) for c in has if kinds[c] != "string"]
    rejects = F.array_compact(F.array(*cells)) if cells else F.array().cast("array<struct<column:string,value:string>>")
    return df.select(*keep, *[(_cast(text[c], k) if c in text else F.lit(None).cast("string" if k == "time" else k)).alias(c) for c, k in kinds.items()], rejects.alias("rejects"))


def entity_key(df: DataFrame, candidates: Sequence[str] = KEY_CANDIDATES, within: Sequence[str] = ("vintage",), rsd: float = 0.02) -> list[str] | None:
    """The first candidate that tells rows apart within ``within``, with ``within``; None if none does.

    One aggregation sketches the distinct counts and counts nulls for all candidates at once; only those that may be
    unique by their sketch are tested exactly, in order.
    """
    has, within = [c for c in candidates if c in df.columns], [c for c in within if c in df.columns]
    if not has:
        return None
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.approx_count_distinct(F.struct(c, *within), rsd).alias(f"d_{c}") for c in has], *[F.count(c).alias(f"k_{c}") for c in has]).first()
    for c in has:
        if counts[f"k_{c}"] == counts["n"] and counts[f"d_{c}"] >= (1 - 5 * rsd) * counts["n"] and df.groupBy(c, *within).count().where("count > 1").isEmpty():
            return [c, *within]
    return None


def conform_table(vintages: dict[int, DataFrame], catalog: Sequence[dict], source: str, ingested_at: str, key: Sequence[str] | None = None) -> tuple[DataFrame, list[str] | None]:
    """Vintages as one table, and its entity key.

    catalog: name, type and hidden of each column. Data columns come in catalogue order, without hidden and computed
    ones, under their system names, cast; what a vintage lacks is null. vintage and ingested_at follow, and with a key
    (given or found) record_hash, valid_from and valid_to: a first load of a versioned table.
    """
    listed = [c for c in catalog if not c.get("hidden") and not c["name"].startswith(COMPUTED_PREFIX)]
    names = {c["name"]: SYSTEM_RENAMES.get(c["name"], c["name"]) for c in listed}
    parts = [cast_by_catalog(df, {c["name"]: (source, c["type"]) for c in listed}).drop("rejects").withColumnsRenamed(names).withColumn("vintage", F.lit(year)) for year, df in vintages.items()]
    whole = reduce(lambda a, b: a.unionByName(b), parts).withColumn("ingested_at", F.lit(ingested_at).cast("timestamp"))
    key = list(key) if key else entity_key(whole)
    if key:
        whole = whole.select("*", record_hash(whole, [*key, "ingested_at"]).alias("record_hash"), F.col("ingested_at").alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"))
    return whole, key


def portal_columns(df: DataFrame, names: dict[str, str] | None = None, exported_at: str | None = None) -> DataFrame:
    """A portal's rows under their names here: ``names`` (of file exports) to API names, system fields to theirs, no computed
    regions. ``exported_at``: file exports lack the system fields; they get null, and this time as the time of update."""
    df = df.withColumnsRenamed({c: (names or {}).get(c, c) for c in df.columns})
    df = df.drop(*[c for c in df.columns if c.startswith(COMPUTED_PREFIX)])
    df = df.withColumnsRenamed(SYSTEM_RENAMES)
    if exported_at is None:
        return df
    lacking = [c for c in SYSTEM_RENAMES.values() if c not in df.columns]
    return df.withColumns({c: F.lit(exported_at if c == "socrata_updated_at" else None).cast("string") for c in lacking})


def file_defaults(df: DataFrame, file_name: Column, county: bool = True, lowercase: bool = True) -> DataFrame:
    """Rows with what their file's name tells, as in ``tl_2023_17031_roads.zip``: vintage, and for county files the state's and
    the county's code, each only where the data has no such column in any case."""
    code = F.nullif(F.regexp_extract(file_name, r"_(\d{5})(?:_|\.)", 1), F.lit(""))
    have = {c.lower() for c in df.columns}
    added = {"vintage": F.regexp_extract(file_name, r"_(\d{4})_", 1).try_cast("int")}
    if county:
        added |= {"statefp": code.substr(1, 2), "countyfp": code.substr(3, 3)}
    return df.withColumns({c if lowercase or c == "vintage" else c.upper(): v for c, v in added.items() if c not in have})


def tag_columns(tags: Column, names: Sequence[str] = EDGE_TAGS, flags: Sequence[str] = ("oneway",)) -> list[Column]:
    """Typed columns of a map of tags to JSON values. A list becomes text like ['a', 'b'], NaN and null become null; a flag is
    true only where its tag says so."""

    def text(c: Column) -> Column:
        items = F.from_json(c, "array<string>")
        listed = F.concat(F.lit("['"), F.array_join(items, "', '"), F.lit("']"))
        plain = F.when(c.startswith('"'), F.get_json_object(F.concat(F.lit('{"v":'), c, F.lit("}")), "$.v")).otherwise(c)
        return F.when(c.startswith("["), listed).when(~c.isin("NaN", "null"), plain)

    return [(F.coalesce(tags[n] == "true", F.lit(False)) if n in flags else text(tags[n])).alias(n.replace(":", "_")) for n in names]


def _leaves(kind: T.DataType, path: str) -> Iterator[tuple[str, str]]:
    """(path, type) of all that a type holds: fields by name, elements of arrays as []."""
    if isinstance(kind, T.StructType):
        if path:
            yield path, "struct"
        for f in kind.fields:
            yield from _leaves(f.dataType, f"{path}.{f.name}" if path else f.name)
    elif isinstance(kind, T.ArrayType):
        yield path, "array"
        yield from _leaves(kind.elementType, f"{path}[]")
    elif isinstance(kind, T.MapType):
        yield path, "map"
        yield from _leaves(kind.valueType, f"{path}{{}}")
    else:
        yield path, kind.simpleString()


def json_schema(df: DataFrame, column: str) -> T.StructType:
    """The schema that the JSON texts of a column have together: one aggregation, types merged."""
    said = df.where(F.col(column).isNotNull()).agg(F.schema_of_variant_agg(F.try_parse_json(column)).alias("s")).first()["s"]
    kind = T.DataType.fromDDL(said.replace("OBJECT<", "STRUCT<")) if said and said.startswith("OBJECT") else T.StructType()
    return kind


def schema_drift(df: DataFrame, source: T.StructType, target: T.StructType, ignore: Sequence[str] = ()) -> DataFrame:
    """path, change, severity, source_type, target_type of whatever differs, at any depth.

    A new field is an error, a missing one a warning, another type an error. ``ignore``: fields (with all below) that
    don't count. ``df`` gives the session only.
    """
    skip = lambda p: any(p == i or p.startswith((f"{i}.", f"{i}[", f"{i}{{")) for i in ignore)
    a, b = ({p: k for p, k in _leaves(s, "") if not skip(p)} for s in (source, target))
    rows = [(p, "new" if p not in b else "missing" if p not in a else "type", "warning" if p not in a else "error", a.get(p), b.get(p)) for p in sorted({*a, *b}) if a.get(p) != b.get(p)]
    return df.sparkSession.createDataFrame(rows, "path string, change string, severity string, source_type string, target_type string")
