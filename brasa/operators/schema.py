"""Schema and column operators.

Categorical columns are strings carrying their domain in column metadata:
``{"categories": [...], "ordered": bool}``; out-of-domain values become NULL.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brasa.functions.text import normalise_header


# ---- S2 / S3 / S4 ---------------------------------------------------------------
def normalise_headers(df: DataFrame) -> DataFrame:
    """strip -> whitespace runs to '_' -> upper case; collisions are an error."""
    new = [normalise_header(c) for c in df.columns]
    if len(set(new)) != len(new):
        raise ValueError(f"header normalisation collides: {new}")
    return df.toDF(*new)


def drop_all_null_rows(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    cols = [c for c in df.columns if c not in set(ignore)]
    return df.na.drop("all", subset=cols) if cols else df


def union_with_lineage(frames: Mapping[str, DataFrame], lineage_col: str = "ARCHIVO",
                       drop_empty_rows: bool = True) -> DataFrame:
    """Outer union by column name of named inputs, each tagged with its name."""
    if not frames:
        raise ValueError("no inputs")
    tagged = []
    for name, df in frames.items():
        if drop_empty_rows:
            df = drop_all_null_rows(df)
        tagged.append(df.withColumn(lineage_col, F.lit(name)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


# ---- C6 ----------------------------------------------------------------------
def column_mismatch(frames: Mapping[str, DataFrame]) -> dict[str, dict[str, list[str]]]:
    """Names only (driver side): missing / extra columns of each frame vs the first."""
    items = list(frames.items())
    ref = set(items[0][1].columns)
    out = {}
    for name, df in items[1:]:
        cols = set(df.columns)
        if cols != ref:
            out[name] = {"missing": sorted(ref - cols), "extra": sorted(cols - ref)}
    return out


def key_overlap(frames: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Keys present in more than one frame, with the number of frames (NULL keys ignored).

    One pass: (key, frame) pairs are deduplicated map-side, then counted per key.
    """
    pairs = reduce(lambda a, b: a.unionByName(b), [
        df.select(F.col(key), F.lit(name).alias("_src")).where(F.col(key).isNotNull())
        for name, df in frames.items()])
    return (pairs.groupBy(key).agg(F.countDistinct("_src").alias("n_files"))
                 .where(F.col("n_files") > 1))


def check_dataset_compatibility(frames: Mapping[str, DataFrame], check_matching_columns: bool = False,
                                check_unique_rows: bool = False, key: str = "FICHA") -> bool:
    if check_matching_columns:
        bad = column_mismatch(frames)
        if bad:
            raise ValueError(f"column mismatch: {bad}")
    if check_unique_rows:
        for name, df in frames.items():
            if key not in df.columns:
                raise KeyError(f"Column '{key}' not found in {name}")
        dup = key_overlap(frames, key)
        sample = [r[0] for r in dup.orderBy(key).limit(10).collect()]
        if sample:
            raise ValueError(f"{key} values occur in more than one input (e.g. {sample})")
    return True


# ---- categorical metadata ---------------------------------------------------------
def set_categories(df: DataFrame, col: str, categories: Sequence[str], ordered: bool = False) -> DataFrame:
    """Restrict ``col`` to a domain (others -> NULL) and record it in the column metadata."""
    meta = {"categories": list(categories), "ordered": bool(ordered)}
    val = F.when(F.col(col).cast("string").isin(list(categories)), F.col(col).cast("string"))
    return df.withColumn(col, val.alias(col, metadata=meta))


def categories_of(df: DataFrame, col: str) -> dict | None:
    m = df.schema[col].metadata or {}
    return {"categories": m["categories"], "ordered": m.get("ordered", False)} if "categories" in m else None


# ---- C4 / C5 -------------------------------------------------------------------
# Type names found in stored schema files -> Spark types.
STORED_TYPES = {
    "float64": "double", "float32": "float", "int64": "bigint", "Int64": "bigint", "int32": "int", "Int32": "int",
    "bool": "boolean", "boolean": "boolean", "object": "string", "string": "string",
    "datetime64[ns]": "timestamp_ntz", "datetime64[us]": "timestamp_ntz",
}


class DtypeSchema:
    """Persisted column types + category domains, applied with ``try_cast``.

    Types are read by their stored name (``float64``, ``int64``, ...) or as a Spark type.
    """

    def __init__(self, entries: Mapping[str, dict]):
        self.entries = dict(entries)

    @classmethod
    def from_df(cls, df: DataFrame) -> "DtypeSchema":
        out = {}
        for f in df.schema.fields:
            cats = (f.metadata or {}).get("categories")
            if cats is not None:
                out[f.name] = {"type": "category", "categories": list(cats), "ordered": bool(f.metadata.get("ordered"))}
            else:
                out[f.name] = {"type": "other", "dtype": f.dataType.simpleString()}
        return cls(out)

    def to_json(self) -> str:
        return json.dumps(self.entries, indent=2)

    @classmethod
    def from_json(cls, text: str) -> "DtypeSchema":
        return cls(json.loads(text))

    def columns(self, include: Iterable[str] | None = None, exclude: Iterable[str] | None = ()) -> list[str]:
        cols = list(self.entries)
        if include is not None:
            inc = set(include)
            cols = [c for c in cols if c in inc]
        exc = set(exclude or ())
        return [c for c in cols if c not in exc]

    def apply(self, df: DataFrame, *, strict: bool = False, include=None, exclude=(), drop_extras: bool = False) -> DataFrame:
        cols = self.columns(include, exclude)
        missing = [c for c in cols if c not in df.columns]
        if strict and missing:
            raise KeyError(f"Missing columns in df: {missing}")
        cols = [c for c in cols if c in df.columns]
        exprs = []
        for c in cols:
            e = self.entries[c]
            if e["type"] == "category":
                cats = list(e["categories"])
                v = F.col(c).cast("string")
                exprs.append(F.when(v.isin(cats), v).alias(c, metadata={"categories": cats, "ordered": e["ordered"]}))
            else:
                exprs.append(F.col(c).try_cast(STORED_TYPES.get(e["dtype"], e["dtype"])).alias(c))
        extras = [] if drop_extras else [F.col(c) for c in df.columns if c not in set(cols)]
        return df.select(*exprs, *extras)


# ---- C2 / C3 -------------------------------------------------------------------
def rename_fire_columns(df: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    """Keep the incident report's canonical columns (in that order) under English names."""
    from brasa.functions.lookups import FIRE_COLUMN_NAMES
    names = dict(names or FIRE_COLUMN_NAMES)
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise KeyError(f"Columns not found in df: {missing}")
    return df.select(*[F.col(src).alias(dst) for src, dst in names.items()])


def rename_dispatch_columns(df: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    """Rename the key columns, lower-case every other name."""
    from brasa.functions.lookups import DISPATCH_COLUMN_NAMES
    names = dict(names or DISPATCH_COLUMN_NAMES)
    return df.toDF(*[names[c] if c in names else c.lower() for c in df.columns])
