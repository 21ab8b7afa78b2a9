"""Binary, JSON and arithmetic helpers (BIN-1, JSON-1/2, MATH-1, MAP-1, STR-6)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aspectflow.schemas import TARGET_WIDTH, VEHICLE_NAMES


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def b64_encode(col) -> Column:
    """Binary -> base64 text on one line (standard alphabet, padded).

    Spark may wrap base64 output every 76 characters (MIME style, session
    option ``spark.sql.chunkBase64String.enabled``); the line breaks are
    removed so the text is the same whatever the session says.
    """
    return F.replace(F.base64(_c(col)), F.lit("\r\n"), F.lit(""))


def b64_decode(col) -> Column:
    """base64 text, on one line or wrapped -> binary; malformed input -> null (not empty bytes)."""
    return F.try_to_binary(F.translate(_c(col), "\r\n\t ", ""), F.lit("base64"))


def proportional_height(width, height, target_width: int = TARGET_WIDTH) -> Column:
    """MATH-1: int(h * (target / w)); null for a non-positive width."""
    w, h = _c(width).cast("double"), _c(height).cast("double")
    scaled = h * (F.lit(float(target_width)) / w)
    return F.when(w > 0, F.floor(scaled).cast("int"))


def counts_json(counts_struct_cols: list[Column], names=VEHICLE_NAMES) -> Column:
    """JSON-1 for the fixed-key counts, in the reference's text layout
    (``{"car": 1, "motorcycle": 0, ...}``: key order fixed, ", " and ": ")."""
    fmt = "{" + ", ".join('"%s": %%d' % n for n in names) + "}"
    return F.format_string(fmt, *counts_struct_cols)


def counts_from_json(col, names=VEHICLE_NAMES) -> Column:
    """JSON-2: stored counts text -> struct of ints; bad JSON -> all zeros,
    missing key -> 0."""
    parsed = F.from_json(_c(col), "map<string,int>")
    return F.struct(*[
        F.coalesce(F.try_element_at(parsed, F.lit(n)), F.lit(0)).alias(n) for n in names
    ])


def counts_variant(col) -> Column:
    """JSON-2 as VARIANT: stored counts text parsed once; bad JSON -> null."""
    return F.try_parse_json(_c(col))


def counts_of_variant(variant, names=VEHICLE_NAMES) -> Column:
    """Typed extraction from :func:`counts_variant`: a struct of ints, 0 where the text was bad, the key is missing or its
    value is no integer (as :func:`counts_from_json`, which parses the text anew for every use)."""
    v = _c(variant)
    return F.struct(*[F.coalesce(F.try_variant_get(v, f"$.{n}", "int"), F.lit(0)).alias(n) for n in names])


def counts_map_of_variant(variant) -> Column:
    """MAP-1: the variant's entries as a map of ints; null where it is no object of integers."""
    return F.try_variant_get(_c(variant), "$", "map<string,int>")
