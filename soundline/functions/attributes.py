"""Decoding of chart attributes as Column expressions; nulls stay null unless a rule names a default."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: sentinels and defaults of the published schema
UNKNOWN_DEPTH, NO_DEPTH, NO_LIMIT, NO_LAND = -999.0, 99.0, 999.0, 9999.0
MOVABLE = ("3", "4", "5", "6", "7")
PROHIBITED = ("entry prohibited", "entry is prohibited", "verboden toegang")


def is_valid(c: Column, kind: str = "double") -> Column:
    """Not null, not NaN; arrays must have elements."""
    if kind == "array":
        return c.isNotNull() & (F.size(c) > 0)
    return c.isNotNull() & ~F.isnan(c) if kind == "double" else c.isNotNull()


def pick(df: DataFrame, *names: str) -> Column:
    """The first of names that df has, whatever its case; a null column if it has none."""
    have = {c.lower(): c for c in reversed(df.columns)}
    return next((F.col(f"`{have[n.lower()]}`") for n in names if n.lower() in have), F.lit(None))


def first_value(c: Column) -> Column:
    return F.try_element_at(c, F.lit(1))


def categories(text: Column) -> Column:
    """All runs of digits of the text, or the text itself where it has none; null gives no categories."""
    runs = F.regexp_extract_all(text, F.lit(r"(\d+)"), F.lit(1))
    return F.when(text.isNull(), F.array().cast("array<string>")).when(F.size(runs) > 0, runs).otherwise(F.array(text))


def is_movable(cats: Column, vercop: Column) -> Column:
    return F.arrays_overlap(cats, F.array(*map(F.lit, MOVABLE))) | is_valid(vercop)


def clearance(cats: Column, vercop: Column, verclr: Column) -> Column:
    """Air draft under one bridge; movable, unsurveyed and zero clearances do not limit."""
    return F.when(~is_movable(cats, vercop) & is_valid(verclr) & (verclr != 0), verclr).otherwise(NO_LIMIT)


def entry_prohibited(restrn: Column, *texts: Column) -> Column:
    """restrn: array of strings."""
    by_code = F.coalesce(F.exists(restrn, lambda x: F.coalesce(x.try_cast("int") == 1, F.lit(False))), F.lit(False))
    by_text = F.lit(False)
    for t in texts:
        for phrase in PROHIBITED:
            by_text = by_text | F.coalesce(F.lower(t).contains(phrase), F.lit(False))
    return by_code | by_text


def disposition(valsou: Column, watlev: Column) -> Column:
    """struct(is_hard, depth): a sounding makes a soft hazard of that depth, water levels 3 and 4 one of depth 0."""
    depth = valsou.try_cast("double")
    level = F.floor(watlev.try_cast("double"))
    soft = F.when(depth.isNotNull() & ~F.isnan(depth), depth).when(level.isin(3, 4), F.lit(0.0))
    return F.struct(soft.isNull().alias("is_hard"), soft.alias("depth"))


def first_name(*names: Column) -> Column:
    """The first name that isn't blank, trimmed."""
    return F.coalesce(*(F.nullif(F.trim(n), F.lit("")) for n in names))


def first_present(*names: Column) -> Column:
    """The first name that isn't null; an empty one blocks those behind it and gives null."""
    return F.nullif(F.coalesce(*names), F.lit(""))


def traffic_mode(distinct: Column) -> Column:
    """From the array of distinct non-null directions met: 1 one-way, 2 against, 0 for none, two-way or mixed."""
    only = F.try_element_at(distinct, F.lit(1))
    return F.when(F.size(distinct) != 1, 0).when(only.isin(1, 3), 1).when(only.isin(-1, -3), 2).otherwise(0)


def buoyage_direction() -> Column:
    """Extension point: no layer carries it."""
    return F.lit(None).cast("double")


def pixel_size(min_dimension: Column) -> Column:
    return F.least(F.greatest(min_dimension / 200, F.lit(2.0)), F.lit(10.0))


def edge_type_id(name: Column) -> Column:
    return F.when(name == "inland", 1).otherwise(0)


def usage_band(file_name: Column) -> Column:
    """Third character of <2 letters><1-6>...; null for other names."""
    return F.nullif(F.regexp_extract(file_name, r"^[A-Za-z]{2}([1-6])", 1), F.lit("")).cast("int")


def node_id(lon: Column, lat: Column, is_inland: Column) -> Column:
    """Identity of a place on the 1e-5 degree lattice. The product is truncated as a binary number, so it isn't injective."""
    y = F.floor((F.round(lat, 5) + 90.0) * 100000).cast("long")
    x = F.floor((F.round(lon, 5) + 180.0) * 100000).cast("long")
    return F.when(is_inland, F.lit(648000000000000)).otherwise(F.lit(0)) + y * F.lit(36000000) + x


def poi_id(kind: Column, lat: Column, lon: Column) -> Column:
    key = F.concat_ws("_", kind, F.round(lat, 5).cast("string"), F.round(lon, 5).cast("string"))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("long")


def poi_properties(is_bridge: Column, movable: Column, height: Column) -> Column:
    """JSON: subtype of bridges, and the height of fixed ones."""
    fixed = F.to_json(F.struct(F.lit("fixed").alias("subtype"), height.alias("height")))
    return F.when(~is_bridge, F.lit("{}")).when(movable, F.to_json(F.struct(F.lit("opening").alias("subtype")))).otherwise(fixed)


def parse_bbox(text: Column) -> Column:
    """struct(minx, miny, maxx, maxy) of "a,b,c,d"; fails unless there are four numbers."""
    parts = F.split(text, ",")
    ok = F.assert_true(F.size(parts) == 4, F.lit("a bounding box has four numbers"))
    return F.struct(*(F.coalesce(ok, F.element_at(parts, i + 1)).cast("double").alias(n) for i, n in enumerate(("minx", "miny", "maxx", "maxy"))))


def utc_now() -> Column:
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
