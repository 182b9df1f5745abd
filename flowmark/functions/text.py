"""String normal forms, road names and classes as column expressions."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

# What the words of road names are reduced to, words that say nothing of the road, and directions.
ROAD_WORDS = {
    "INTERSTATE": "I", "UNITED STATES": "US", "HIGHWAY": "HWY", "BOULEVARD": "BLVD", "AVENUE": "AVE", "PARKWAY": "PKWY", "TURNPIKE": "TPKE", "ROAD": "RD", "STREET": "ST",
}
STOP_WORDS = ["N", "S", "E", "W", "NB", "SB", "EB", "WB", "NORTHBOUND", "SOUTHBOUND", "EASTBOUND", "WESTBOUND", "RD", "ST", "AVE", "BLVD", "PKWY", "HWY", "TPKE"]
DIRECTIONS = {
    "NORTHBOUND": "NB", "SOUTHBOUND": "SB", "EASTBOUND": "EB", "WESTBOUND": "WB", "NORTHEASTBOUND": "NEB", "NORTHWESTBOUND": "NWB", "SOUTHEASTBOUND": "SEB", "SOUTHWESTBOUND": "SWB",
    "CLOCKWISE": "CW", "COUNTERCLOCKWISE": "CCW",
}
TRUE_TEXTS = ["true", "1", "yes", "y"]
CLOSED_TEXTS = ["", "0", "closed", "nan", "none"]


def normal_code(c: Column) -> Column:
    """Category code without a decimal tail: '301.0' is '301'; empty is null."""
    return F.nullif(F.regexp_replace(F.trim(c.cast("string")), r"\.0+$", ""), F.lit(""))


def truth(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin(TRUE_TEXTS), F.lit(False))


def _plain(c: Column) -> Column:
    """Upper-case words of a road name, parted by single blanks, with the usual abbreviations."""
    x = F.trim(F.regexp_replace(F.regexp_replace(F.upper(c), "&", " AND "), r"[^A-Z0-9]+", " "))
    for long, short in ROAD_WORDS.items():
        x = F.regexp_replace(x, rf"\b{long}\b", short)
    return x


def road_tokens(c: Column) -> Column:
    """Words of a road name without those that say nothing of the road."""
    return F.filter(F.split(_plain(c), " "), lambda w: (w != "") & ~w.isin(STOP_WORDS))


def route_ids(c: Column) -> Column:
    """Sorted distinct routes such as I-66, US-50, VA-7; state and plain routes count as VA."""
    text = F.concat_ws(" ", road_tokens(c))
    found = F.regexp_extract_all(text, F.lit(r"\b((?:I|US|VA|SR) ?|ROUTE )[0-9]+\b"), F.lit(0))
    number = lambda x: F.regexp_replace(F.regexp_extract(x, r"[0-9]+", 0), r"^0+(?=[0-9])", "")
    kind = lambda x: F.regexp_replace(F.regexp_extract(x, r"^[A-Z]+", 0), "^(SR|ROUTE)$", "VA")
    return F.array_sort(F.array_distinct(F.transform(found, lambda x: F.concat(kind(x), F.lit("-"), number(x)))))


def token_overlap(a: Column, b: Column) -> Column:
    """The larger of Jaccard share and containment of two word lists; null if they share none."""
    both, union = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    least = F.least(F.size(F.array_distinct(a)), F.size(F.array_distinct(b)))
    return F.when(both > 0, F.greatest(both / F.nullif(union, F.lit(0)), both / F.nullif(least, F.lit(0))))


@pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity, which has no built-in counterpart; each distinct pair of a batch is scored once."""
    pairs = pd.Series(list(zip(a, b)), dtype=object)
    score = {p: None if p[0] is None or p[1] is None else SequenceMatcher(None, p[0], p[1]).ratio() for p in set(pairs)}
    return pairs.map(score).astype("float64")


def road_name_score(a: Column, b: Column) -> Column:
    """1 or 0 where both name routes; else word overlap where words are shared; else sequence similarity, at least 0.5 (neutral). Null if a name has no words."""
    ra, rb, ta, tb = route_ids(a), route_ids(b), road_tokens(a), road_tokens(b)
    routes = F.when((F.size(ra) > 0) & (F.size(rb) > 0), F.arrays_overlap(ra, rb).cast("double"))
    similar = F.greatest(F.lit(0.5), sequence_ratio(F.array_join(ta, " "), F.array_join(tb, " ")))
    return F.when((F.size(ta) > 0) & (F.size(tb) > 0), F.coalesce(routes, token_overlap(ta, tb), similar))


def road_class(c: Column) -> Column:
    """Class inferred from a road's name: 1 interstate, 2 US route, 3 state route, 3.5 otherwise; null without words."""
    routes = F.array_join(route_ids(c), " ")
    return F.when(routes.rlike(r"\bI-"), 1.0).when(routes.rlike(r"\bUS-"), 2.0).when(routes.rlike(r"\bVA-"), 3.0).when(F.size(road_tokens(c)) > 0, 3.5)


def facility_class(link_type: Column) -> Column:
    """Class by the last digit of the type code."""
    digit = F.pmod(normal_code(link_type).try_cast("int"), F.lit(10))
    return F.when(digit == 1, "freeway").when(digit == 2, "arterial").when(digit.between(3, 4), "collector").when(digit >= 5, "ramp").when(digit == 0, "connector")


def direction_short(c: Column) -> Column:
    """Abbreviation of a travel direction: the usual one, else the initials of its words, else UNKNOWN."""
    x = F.upper(F.trim(c))
    known = F.create_map(*[F.lit(v) for kv in DIRECTIONS.items() for v in kv])
    initials = F.array_join(F.transform(F.regexp_extract_all(x, F.lit("[A-Z0-9]+"), F.lit(0)), lambda w: F.substring(w, 1, 1)), "")
    return F.coalesce(F.try_element_at(known, x), F.nullif(initials, F.lit("")), F.lit("UNKNOWN"))


def corridor_key(road: Column, direction: Column) -> Column:
    """Letters and digits of the road's name, an underscore and the direction's abbreviation."""
    name = F.nullif(F.regexp_replace(F.upper(F.trim(road)), "[^A-Z0-9]+", ""), F.lit(""))
    return F.concat(F.coalesce(name, F.lit("UNNAMED")), F.lit("_"), direction_short(direction))


def is_managed(name: Column) -> Column:
    return F.coalesce(F.trim(name).rlike("(?i)(HOV|EXPRESS|HOT|MANAGED)"), F.lit(False))


def base_road(name: Column) -> Column:
    """The road's name in upper case without what stands in brackets."""
    return F.trim(F.regexp_replace(F.upper(name), r"\s*\([^)]*\)", ""))


def is_open(allowed_use: Column) -> Column:
    return F.coalesce(~F.lower(F.trim(allowed_use)).isin(CLOSED_TEXTS), F.lit(False))


def union_of_uses(*uses: Column) -> Column:
    """Distinct modes over several semicolon lists, in order of first appearance; closed ones left out."""
    lists = F.flatten(F.array(*(F.transform(F.split(F.coalesce(u, F.lit("")), "[;,]"), F.trim) for u in uses)))
    return F.array_join(F.array_distinct(F.filter(lists, lambda x: ~F.lower(x).isin(CLOSED_TEXTS))), ";")


def id_list(c: Column) -> Column:
    """Whole numbers of a semicolon list; parts that aren't numbers are left out."""
    return F.filter(F.transform(F.split(c, "[;,]"), lambda x: F.trim(x).try_cast("bigint")), lambda x: x.isNotNull())


def number_text(c: Column) -> Column:
    """Canonical text of a number: no trailing zeros, no exponent; the trimmed text itself if it isn't one."""
    d = F.trim(c).try_cast("decimal(38,9)")
    plain = F.regexp_replace(F.regexp_replace(d.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.coalesce(F.when(plain == "-0", "0").otherwise(plain), F.trim(c))


def facility_role(link_type: Column, managed: Column) -> Column:
    c = facility_class(link_type)
    return F.when(managed, "managed").when(c == "ramp", "ramp").when(c == "connector", "connector").when(c.isNotNull(), "general_purpose").otherwise("unknown")


def route_pattern(kind: str, number: int) -> str:
    """Regular expression for a route with any separator, not as the start of a longer number."""
    return rf"(?i)\b{kind}[\s-]*{number}(?!\d)"
