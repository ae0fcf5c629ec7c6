"""Identifier, label and code expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Route ids and prefixes that are never buses, prefixes that are.
NON_BUS_ROUTES = ["Red", "Orange", "Blue", "Mattapan", "Green-B", "Green-C", "Green-D", "Green-E"]
NON_BUS_PREFIXES = ["CR-", "Boat-", "Ferry-"]
BUS_PREFIXES = ["SL", "CT"]


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _starts_with_any(text: Column, prefixes: list[str]) -> Column:
    return text.rlike("^(" + "|".join(prefixes) + ")")


def is_bus_route(route_id: Column | str, trim: bool = False) -> Column:
    """Bus test on the route id alone: all digits, SL* or CT*. Never NULL."""
    r = _col(route_id)
    r = F.trim(r) if trim else r
    named_out = r.isin(NON_BUS_ROUTES) | _starts_with_any(r, NON_BUS_PREFIXES)
    bus_like = r.rlike("^[0-9]+$") | _starts_with_any(r, BUS_PREFIXES)
    return F.coalesce(~named_out & bus_like, F.lit(False))


def route_sort_key(route_id: Column | str) -> Column:
    """Struct that orders route ids for riders: numbers by value, SL*, CT*, then the rest."""
    r = _col(route_id)
    digits = r.rlike("^[0-9]+$")
    return F.struct(
        F.when(digits, 0).when(r.startswith("SL"), 1).when(r.startswith("CT"), 2).otherwise(3).alias("rank"),
        F.when(digits, r.try_cast("decimal(38,0)")).alias("number"),
        r.alias("id"),
    )


def route_name_order(name: Column | str) -> list[Column]:
    """Sort columns for dashboard lists: integers by value first, other names after, as text."""
    n = _col(name)
    return [n.try_cast("int").asc_nulls_last(), n.asc()]


def schedule_relation(raw: Column | str) -> Column:
    """Schedule relationship with blank and missing read as SCHEDULED."""
    return F.coalesce(F.nullif(F.trim(_col(raw)), F.lit("")), F.lit("SCHEDULED"))


def first_translation(text: Column | str) -> Column:
    """Text of the first translation of a translated-string struct, whatever its language."""
    return F.get(_col(text)["translation"], 0)["text"]


def rider_text(text: Column | str) -> Column:
    """First translation without language or in English, else the first one, else ''."""
    options = F.coalesce(_col(text)["translation"], F.array())
    english = F.filter(
        options,
        lambda t: (F.coalesce(t["language"], F.lit("")) == "") | F.lower(t["language"]).startswith("en"),
    )
    return F.coalesce(F.get(english, 0)["text"], F.get(options, 0)["text"], F.lit(""))


def bus_routes_of(entities: Column | str) -> Column:
    """Distinct bus routes named by an informed-entity array, in rider order."""
    ids = F.transform(F.coalesce(_col(entities), F.array()), lambda e: e["route_id"])
    buses = F.array_distinct(F.filter(ids, lambda r: is_bus_route(r)))
    ordered = F.array_sort(F.transform(buses, lambda r: route_sort_key(r)))
    return F.transform(ordered, lambda k: k["id"])


def touches_bus(entities: Column | str, route_id: str | None = None) -> Column:
    """Whether an informed-entity array names a bus route, or the given one."""
    wanted = (lambda r: is_bus_route(r) & (r == route_id)) if route_id else is_bus_route
    return F.coalesce(F.exists(_col(entities), lambda e: F.coalesce(wanted(e["route_id"]), F.lit(False))), F.lit(False))


def not_deleted(flag: Column | str = "is_deleted") -> Column:
    return ~F.coalesce(_col(flag), F.lit(False))


def enum_label(code: Column | str, labels: dict[int, str], default: str | None = None) -> Column:
    """Code to name; an unknown code gives ``default`` or, without one, the number as text."""
    c = _col(code)
    table = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    fallback = F.lit(default) if default is not None else c.cast("string")
    return F.coalesce(F.try_element_at(table, c.cast("int")), fallback)
