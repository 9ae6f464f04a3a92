"""Array, struct, map and NULL-handling expressions (Column -> Column)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingmart.functions.util import as_col
from listingmart.schemas import UNKNOWN


def coalesce_unknown(c, label: str = UNKNOWN) -> Column:
    """NULL scalar -> the unknown label."""
    return F.coalesce(as_col(c), F.lit(label))


def coalesce_unknown_array(c, empty_too: bool = False, label: str = UNKNOWN) -> Column:
    """NULL array or ``[NULL]`` -> ``[label]``; with ``empty_too`` also ``[]``.

    Source A keeps empty arrays (they only pad the lockstep unnest); source B
    maps them to the unknown label as well (trap T2).
    """
    c = as_col(c)
    unknown = F.array(F.lit(label))
    cond = c.isNull() | ((F.size(c) == 1) & F.element_at(c, 1).isNull())
    if empty_too:
        cond = cond | (F.size(c) == 0)
    return F.when(cond, unknown).otherwise(c)


def not_null(*cols) -> Column:
    """P5: every named column is not NULL."""
    out = F.lit(True)
    for c in cols:
        out = out & as_col(c).isNotNull()
    return out


def all_in_language(c, lang: str = "fr") -> Column:
    """Every element's ``lang`` equals ``lang``; a NULL or empty list counts as true."""
    c = as_col(c)
    return F.coalesce(F.forall(c, lambda x: x["lang"].eqNullSafe(F.lit(lang))), F.lit(True))


def location_parts(arr) -> dict[str, Column]:
    """country = last part, state = 2nd last, city = **4th** last (trap T3).

    A missing part becomes the unknown label; a NULL list gives NULL parts.
    """
    arr = as_col(arr)

    def part(i: int) -> Column:
        return F.when(arr.isNotNull(), F.coalesce(F.try_element_at(arr, F.lit(i)), F.lit(UNKNOWN)))

    return {"city": part(-4), "state": part(-2), "country": part(-1)}


def struct_labels(c, field: str = "label") -> Column:
    """list of structs -> list of one field."""
    return F.transform(as_col(c), lambda x: x[field])


def wrap(c) -> Column:
    """scalar -> one-element array (NULL stays NULL)."""
    c = as_col(c)
    return F.when(c.isNotNull(), F.array(c))


def unwrap(c) -> Column:
    """one-element array -> scalar."""
    return F.try_element_at(as_col(c), F.lit(1))


def literal_map(pairs: Mapping[str, str] | Iterable[tuple[str, str]]) -> Column | None:
    """A small fixed map as a literal ``MapType`` column (None when empty)."""
    items = list(pairs.items()) if isinstance(pairs, Mapping) else list(pairs)
    if not items:
        return None
    seen: dict[str, str] = {}
    for k, v in items:
        if k in seen and seen[k] != v:
            raise ValueError(f"value map maps {k!r} to both {seen[k]!r} and {v!r}")
        seen[k] = v
    return F.create_map(*[F.lit(x) for kv in seen.items() for x in kv])


def replace_scalar(c, mapping) -> Column:
    """whole-value replacement; unmapped values and NULL are kept."""
    m = literal_map(mapping)
    c = as_col(c)
    return c if m is None else F.coalesce(F.try_element_at(m, c), c)


def replace_in_array(c, mapping) -> Column:
    """the same replacement on every element; NULL and empty arrays are kept."""
    m = literal_map(mapping)
    c = as_col(c)
    if m is None:
        return c
    return F.transform(c, lambda x: F.coalesce(F.try_element_at(m, x), x))


def token_set(c) -> Column:
    """distinct tokens of a list."""
    return F.array_distinct(as_col(c))


def sorted_join(c, sep: str = ", ") -> Column:
    """Sorted set -> one string."""
    return F.array_join(F.array_sort(as_col(c)), sep)


def set_union(a, b) -> Column:
    """Set union of two token lists."""
    return F.array_union(as_col(a), as_col(b))


def set_differs(a, b) -> Column:
    """Two lists differ as sets."""
    return F.array_sort(F.array_distinct(as_col(a))) != F.array_sort(F.array_distinct(as_col(b)))


def lockstep_unnest(df: DataFrame, arrays: list[str], keep: list[str] | None = None) -> DataFrame:
    """unnest several arrays side by side, shorter ones padded with NULL.

    The row count per input row is the longest array, never the product of the
    lengths. A NULL array unnests to no elements, as an empty one does; if all
    arrays are empty the row yields nothing. Runs map-side, no shuffle.
    """
    keep = [c for c in (keep if keep is not None else df.columns) if c not in arrays]
    zipped = F.arrays_zip(*[F.coalesce(F.col(a), F.array().cast(df.schema[a].dataType)).alias(a)
                            for a in arrays])
    return df.select(*keep, F.inline(zipped))


def explode_keep_empty(df: DataFrame, col: str, pos: str = "pos", out: str | None = None) -> DataFrame:
    """F16: list -> rows with position; a NULL or empty list gives one NULL row."""
    out = out or col
    rest = [c for c in df.columns if c != col]
    return df.select(*rest, F.posexplode_outer(col).alias(pos, out))
