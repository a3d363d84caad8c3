"""Split and clean a wide export into the nine base tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DateType, DecimalType, MapType, StructType, TimestampNTZType, TimestampType

from tallyport.functions.dates import lenient_timestamp
from tallyport.schemas import BASE_TABLES, KEYS, MISSPELT, TIMESTAMP_COLUMNS, WIDE_ENTITIES

SEQUENCE = "_sequence"

# Texts that stand for a missing value in exports.
NULL_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Approximate state centres (latitude, longitude) and the default.
STATE_CENTRES = {
    "AC": (-8.77, -70.55), "AL": (-9.71, -35.73), "AM": (-3.07, -60.00), "AP": (1.41, -51.77),
    "BA": (-12.96, -38.51), "CE": (-3.71, -38.54), "DF": (-15.83, -47.86), "ES": (-19.19, -40.34),
    "GO": (-16.64, -49.31), "MA": (-2.55, -44.30), "MG": (-18.10, -44.56), "MS": (-20.51, -54.54),
    "MT": (-12.64, -55.42), "PA": (-5.53, -52.29), "PB": (-7.06, -35.55), "PE": (-8.28, -35.07),
    "PI": (-8.28, -43.68), "PR": (-24.89, -51.55), "RJ": (-22.84, -43.15), "RN": (-5.22, -36.52),
    "RO": (-11.22, -62.80), "RR": (1.89, -61.22), "RS": (-30.01, -51.22), "SC": (-27.58, -48.55),
    "SE": (-10.90, -37.07), "SP": (-23.55, -46.64), "TO": (-10.24, -48.25),
}
DEFAULT_CENTRE = (-15.0, -47.0)


def with_sequence(rows: DataFrame) -> DataFrame:
    """Number the rows of a file scan in file order.

    Partitions hold file blocks in no fixed order, so the block position comes
    first and the running number only orders rows inside a block.
    """
    return rows.select(
        "*",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias(SEQUENCE),
    )


def keep_first(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first by `order`, which must be a total order.

    Spark limits each partition to the first row per key before the shuffle, so a
    key with very many copies does not load one task.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def rename_misspelt(rows: DataFrame) -> DataFrame:
    return rows.withColumnsRenamed({k: v for k, v in MISSPELT.items() if k in rows.columns})


def parse_timestamps(rows: DataFrame, columns: Sequence[str] = tuple(TIMESTAMP_COLUMNS)) -> DataFrame:
    """Parse text timestamps; broken ones become null."""
    return rows.withColumns({n: lenient_timestamp(n) for n in columns if n in rows.columns})


def fill_text_nulls(
    rows: DataFrame, columns: Sequence[str] = ("review_comment_title", "review_comment_message")
) -> DataFrame:
    return rows.withColumns({n: F.coalesce(n, F.lit("")) for n in columns})


def null_texts_to_null(rows: DataFrame, spellings: Sequence[str] = NULL_TEXTS) -> DataFrame:
    """Null for texts that only spell a missing value."""
    texts = [f.name for f in rows.schema.fields if f.dataType.typeName() == "string"]
    return rows.withColumns({n: F.when(~F.trim(n).isin(*spellings), F.col(n)) for n in texts})


def finite(number: Column) -> Column:
    """Null for NaN and infinities."""
    return F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)


def nan_to_null(rows: DataFrame) -> DataFrame:
    floats = [f.name for f in rows.schema.fields if f.dataType.typeName() in ("double", "float")]
    return rows.withColumns({n: finite(F.col(n)) for n in floats})


def cast_to(value: Column, kind: DataType) -> Column:
    """Text as a number of the given type, null where it is none.

    Whole numbers may be written with decimals (`3.0`, as exports write columns with
    gaps); a fraction is not cut but null. Numbers are finite.
    """
    name = kind.typeName()
    if name in ("timestamp", "string"):
        return value
    if name in ("double", "float"):
        return finite(value.try_cast(kind))
    number = finite(value.try_cast("double"))
    return F.coalesce(value.try_cast(kind), F.when(number == F.floor(number), number.try_cast(kind)))


def conform(rows: DataFrame, entity: str, keep: Sequence[str] = ()) -> DataFrame:
    """Cast to the declared schema of a base table; its columns and those in `keep` only."""
    schema = BASE_TABLES[entity]
    return rows.select(*[cast_to(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields], *keep)


def lost_values(rows: DataFrame, entity: str) -> DataFrame:
    """One row: for each column of the entity, how many present values its cast would lose."""
    given = null_texts_to_null(rows)
    fields = BASE_TABLES[entity].fields
    return given.agg(*[
        F.count_if(F.col(f.name).isNotNull() & cast_to(F.col(f.name), f.dataType).isNull()).alias(f.name) for f in fields
    ])


def split_entity(wide: DataFrame, entity: str, order: Sequence[str | Column] = (SEQUENCE,)) -> DataFrame:
    """Rows of one entity out of a wide frame: its columns, cast, first row per key.

    Keys are compared after the cast, so `1` and `1.0` are one key. Rows without a key
    value (an order without payment, say) are not an entity.
    """
    keys = KEYS[entity]
    columns = BASE_TABLES[entity].fieldNames()
    extra = [o for o in order if isinstance(o, str) and o not in columns]
    narrow = conform(wide.select(*columns, *extra), entity, extra).dropna(subset=keys)
    return keep_first(narrow, keys, order).select(*columns)


def split_wide(wide: DataFrame, order: Sequence[str | Column] = (SEQUENCE,)) -> dict[str, DataFrame]:
    """The six entities of a wide export, each lazy and reading only its columns."""
    clean = parse_timestamps(null_texts_to_null(rename_misspelt(wide)))
    return {entity: split_entity(clean, entity, order) for entity in WIDE_ENTITIES}


def clean_reviews(raw: DataFrame, order: Sequence[str | Column] = (SEQUENCE,)) -> DataFrame:
    """Reviews: first row per review_id, empty text instead of null, parsed dates."""
    first = keep_first(null_texts_to_null(raw), KEYS["order_reviews"], order)
    return conform(parse_timestamps(fill_text_nulls(first)), "order_reviews")


def clean_geolocation(raw: DataFrame, order: Sequence[str | Column] = (SEQUENCE,)) -> DataFrame:
    """Geolocation: first row per zip prefix."""
    extra = [o for o in order if isinstance(o, str) and o not in BASE_TABLES["geolocation"].fieldNames()]
    cast = conform(null_texts_to_null(raw), "geolocation", extra).dropna(subset=KEYS["geolocation"])
    return keep_first(cast, KEYS["geolocation"], order).drop(*extra)


def zip_directory(customers: DataFrame, sellers: DataFrame) -> DataFrame:
    """(zip, city, state) of all customers and sellers; customers win a shared zip."""
    parts = [
        frame.select(
            F.lit(rank).alias("source"),
            F.col(f"{kind}_id").alias("id"),
            F.col(f"{kind}_zip_code_prefix").alias("zip"),
            F.col(f"{kind}_city").alias("city"),
            F.col(f"{kind}_state").alias("state"),
        )
        for rank, (kind, frame) in enumerate([("customer", customers), ("seller", sellers)])
    ]
    return keep_first(parts[0].unionByName(parts[1]), ["zip"], ["source", "id"]).select("zip", "city", "state")


def state_centre(
    state: Column, centres: Mapping[str, tuple[float, float]] = STATE_CENTRES,
    default: tuple[float, float] = DEFAULT_CENTRE,
) -> Column:
    """(lat, lng) of a state from a short fixed table; the default when unknown."""
    pairs = []
    for name, (lat, lng) in centres.items():
        pairs += [F.lit(name), F.struct(F.lit(float(lat)).alias("lat"), F.lit(float(lng)).alias("lng"))]
    fallback = F.struct(F.lit(float(default[0])).alias("lat"), F.lit(float(default[1])).alias("lng"))
    return F.coalesce(F.try_element_at(F.create_map(*pairs), state), fallback)


def with_state_centre(directory: DataFrame, **kwargs) -> DataFrame:
    centre = state_centre(F.col("state"), **kwargs)
    return directory.select("*", centre["lat"].alias("lat"), centre["lng"].alias("lng"))


def category_translation(products: DataFrame, dictionary: Mapping[str, str]) -> DataFrame:
    """Distinct categories with English names; unknown ones get spaces for '_'."""
    pairs = [F.lit(x) for item in dictionary.items() for x in item]
    name = F.col("product_category_name")
    english = F.try_element_at(F.create_map(*pairs), name) if pairs else F.lit(None).cast("string")
    return (
        products.select("product_category_name")
        .filter(name.isNotNull())
        .distinct()
        .select(name, F.coalesce(english, F.replace(name, F.lit("_"), F.lit(" "))).alias("product_category_name_english"))
    )


def _normalised(col: Column, kind: DataType) -> Column:
    if isinstance(kind, DecimalType):
        return col.cast("double")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        # ISO text; a fraction of a second only where there is one.
        fraction = F.date_format(col, ".SSSSSS")
        return F.concat(F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss"), F.when(fraction != ".000000", fraction).otherwise(""))
    if isinstance(kind, DateType):
        return F.date_format(col, "yyyy-MM-dd")
    if isinstance(kind, ArrayType):
        return F.transform(col, lambda x: _normalised(x, kind.elementType))
    if isinstance(kind, MapType):
        entries = F.transform(F.map_entries(col), lambda e: F.struct(
            _normalised(e["key"], kind.keyType).alias("key"), _normalised(e["value"], kind.valueType).alias("value")))
        return F.map_from_entries(entries)
    if isinstance(kind, StructType):
        fields = F.struct(*[_normalised(col[f.name], f.dataType).alias(f.name) for f in kind.fields])
        return F.when(col.isNotNull(), fields)
    return col


def normalise_types(rows: DataFrame) -> DataFrame:
    """Decimals to double and dates to ISO text, inside arrays, structs and maps as well."""
    return rows.select(*[_normalised(F.col(f.name), f.dataType).alias(f.name) for f in rows.schema.fields])
