"""Nested snapshots to rows: typed structs or VARIANT, same output."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import status_or_unknown, variant_path, variant_rows

# fixed values: attribute names in the payload, new name first, then the older one
CONTRACT_ID_NAMES = ("id", "contractId")
CONTRACT_NAME_NAMES = ("name", "contractName")
CONTRACT_PRICES = {
    "last_trade_price": "lastTradePrice",
    "best_buy_yes_cost": "bestBuyYesCost",
    "best_sell_yes_cost": "bestSellYesCost",
    "best_buy_no_cost": "bestBuyNoCost",
    "best_sell_no_cost": "bestSellNoCost",
    "last_close_price": "lastClosePrice",
}
PRICE_TYPE = "decimal(10,4)"
MARKET_ATTRIBUTES = {"id": "bigint", "name": "string", "shortName": "string", "url": "string", "status": "string"}
CONTRACT_ATTRIBUTES = {
    **dict.fromkeys(CONTRACT_ID_NAMES, "bigint"),
    **dict.fromkeys(CONTRACT_NAME_NAMES, "string"),
    "status": "string",
    **dict.fromkeys(CONTRACT_PRICES.values(), PRICE_TYPE),
    "displayOrder": "int",
}


class _Element:
    """Reads attributes of one array element."""

    def __init__(self, column: str, names: Iterable[str]):
        self.column, self.names = column, set(names)

    def get(self, name: str, type_name: str) -> Column:
        if name not in self.names:
            return F.lit(None).cast(type_name)
        return F.col(f"{self.column}.{name}").cast(type_name)

    def first_of(self, names: tuple[str, ...], type_name: str) -> Column:
        return F.coalesce(*[self.get(n, type_name) for n in names])


def array_length(df: DataFrame, name: str, null_is_zero: bool = True) -> Column:
    """Length of a nested array; a missing or JSON-null array counts as 0 (or NULL).

    An array of structs is measured by one of its attributes, so a Parquet scan reads that
    attribute and not the whole array.
    """
    data_type, value = df.schema[name].dataType, F.col(name)
    if isinstance(data_type, T.VariantType):
        value = F.try_variant_get(value, "$", "array<boolean>")  # only counted: elements of other types are NULL
    elif isinstance(data_type.elementType, T.StructType):
        leaf = [f.name for f in data_type.elementType.fields if isinstance(f.dataType, T.AtomicType)]
        value = F.col(f"{name}.{leaf[0]}") if leaf else value
    size = F.array_size(value).cast("int")
    return F.coalesce(size, F.lit(0)) if null_is_zero else size


def flatten_snapshots(documents: DataFrame) -> DataFrame:
    """One row per (market, snapshot).

    ``documents`` has either typed ``extracted_at`` and ``data.markets`` or a VARIANT ``raw``.
    Optional ``source_file`` and ``loaded_at`` are carried along. Documents without markets
    give no rows.
    """
    if "raw" in documents.columns:
        markets = variant_rows("raw", "$.data.markets", MARKET_ATTRIBUTES | {"contracts": "variant"})
        taken_at = variant_path("raw", "$.extracted_at", "string")
        market = _Element("_market", MARKET_ATTRIBUTES)
    else:
        markets, taken_at = F.col("data.markets"), F.col("extracted_at")
        market = _Element("_market", documents.schema["data"].dataType["markets"].dataType.elementType.names)
    carried = [c for c in ("loaded_at", "source_file") if c in documents.columns]
    exploded = documents.select(
        taken_at.cast("timestamp_ntz").alias("extraction_timestamp"), *carried, F.explode(markets).alias("_market")
    )
    return exploded.select(
        market.get("id", "bigint").alias("market_id"),
        market.get("name", "string").alias("market_name"),
        market.get("shortName", "string").alias("short_name"),
        market.get("url", "string").alias("market_url"),
        status_or_unknown(market.get("status", "string")).alias("market_status"),
        F.col("_market.contracts").alias("contract_data"),
        "extraction_timestamp",
        *carried,
    )


def flatten_contracts(raw: DataFrame) -> DataFrame:
    """One row per (contract, snapshot) of markets with an id; NULL and empty arrays give none."""
    data_type, contracts = raw.schema["contract_data"].dataType, F.col("contract_data")
    if isinstance(data_type, T.VariantType):
        contracts, names = variant_rows(contracts, "$", CONTRACT_ATTRIBUTES), CONTRACT_ATTRIBUTES
    else:
        names = data_type.elementType.names
    exploded = raw.filter(F.col("market_id").isNotNull()).select(
        "market_id", "extraction_timestamp", F.explode(contracts).alias("_contract")
    )
    contract = _Element("_contract", names)
    return exploded.select(
        contract.first_of(CONTRACT_ID_NAMES, "bigint").alias("contract_id"),
        "market_id",
        contract.first_of(CONTRACT_NAME_NAMES, "string").alias("contract_name"),
        contract.get("status", "string").alias("contract_status"),
        *[contract.get(name, PRICE_TYPE).alias(alias) for alias, name in CONTRACT_PRICES.items()],
        contract.get("displayOrder", "int").alias("display_order"),
        F.col("extraction_timestamp").alias("last_updated"),
    )


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], T.DataType]]:
    for field in schema.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, here)
        else:
            yield here, field.dataType


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs as dotted top-level columns; arrays, maps and VARIANT as JSON text."""
    columns = []
    for path, data_type in _leaves(df.schema):
        value = F.col(".".join(f"`{p}`" for p in path))
        if isinstance(data_type, (T.ArrayType, T.MapType, T.VariantType)):
            value = F.to_json(value)
        columns.append(value.alias(sep.join(path)))
    return df.select(*columns)
