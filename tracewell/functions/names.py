"""Column expressions on names, URLs and types."""

from __future__ import annotations

from collections.abc import Mapping
from types import MappingProxyType

from pyspark.sql import Column
from pyspark.sql import functions as F

OBJECT_PATHS = {"LIVEBOARD": "pinboard", "PINBOARD": "pinboard", "ANSWER": "saved-answer", "WORKSHEET": "data/tables", "TABLE": "data/tables"}


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def last_part(name: str | Column) -> Column:
    """The part after the last dot; a name without dots is itself."""
    return F.split_part(col(name), F.lit("."), F.lit(-1))


def name_parts(name: str | Column) -> Column:
    """(db, schema, table) of a name of one to three parts; a longer one is kept whole as the table."""
    c = col(name)
    parts = F.split(c, r"\.")
    n = F.size(parts)
    part = lambda i: F.try_element_at(parts, F.lit(i))
    return F.struct(
        F.when(n == 3, part(1)).alias("db"),
        F.when(n == 3, part(2)).when(n == 2, part(1)).alias("schema"),
        F.when(n == 3, part(3)).when(n == 2, part(2)).otherwise(c).alias("table"),
    )


def camel_to_snake(name: str | Column) -> Column:
    """userIdHTTPCode gives user_id_http_code."""
    parted = F.regexp_replace(col(name), r"(.)([A-Z][a-z]+)", r"$1_$2")
    return F.lower(F.regexp_replace(parted, r"([a-z0-9])([A-Z])", r"$1_$2"))


def normal_url(url: str | Column, bases: Mapping[str, str] = MappingProxyType({})) -> Column:
    """A front-end URL template as a route: ${V} of a variable in bases is its text, ${a.b} is {b}, ${userId} is {user_id}; no query."""
    c = col(url)
    for name, text in bases.items():
        c = F.replace(c, F.lit("${" + name + "}"), F.lit(text))
    c = F.regexp_replace(c, F.lit(r"\$\{[\w.]+\.(\w+)\}"), F.lit("{$1}"))
    pieces = F.split(F.regexp_replace(c, r"\?.*$", ""), r"(?=\$\{\w+\})|(?<=\})")
    plain = lambda p: F.concat(F.lit("{"), camel_to_snake(F.regexp_extract(p, r"^\$\{(\w+)\}$", 1)), F.lit("}"))
    return F.trim(F.array_join(F.transform(pieces, lambda p: F.when(p.rlike(r"^\$\{\w+\}$"), plain(p)).otherwise(p)), ""))


def route_key(path: str | Column, base: str = "") -> Column:
    """What two routes must share to match: no base path or slashes at the ends, every parameter as {}."""
    c = F.replace(col(path), F.lit(base), F.lit("")) if base else col(path)
    return F.regexp_replace(F.trim(c, F.lit("/")), r"\{[^{}/]*\}", "{}")


def segment_similarity(a: str | Column, b: str | Column) -> Column:
    """Jaccard similarity of the sets of segments between slashes, empty ones included."""
    x, y = F.array_distinct(F.split(col(a), "/")), F.array_distinct(F.split(col(b), "/"))
    return F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))


def model_name(annotation: str | Column) -> Column:
    """The model inside list[X], Optional[X], Dict[_, X] or Union[X, ...]."""
    c = F.trim(col(annotation))
    for _ in range(3):
        c = F.regexp_replace(c, r"(?i)^\s*(?:typing\.)?(?:list|optional|set|sequence|union)\[\s*(.*?)\s*(?:,\s*None)?\s*\]\s*$", "$1")
        c = F.regexp_replace(c, r"(?i)^\s*(?:typing\.)?dict\[[^,\]]*,\s*(.*)\]\s*$", "$1")
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"\|\s*None\b", ""), r",.*$", ""))


def object_url(base: str | Column, kind: str | Column, guid: str | Column) -> Column:
    """Where a dashboard object is shown; unknown kinds are shown as dashboards."""
    paths = F.create_map(*(F.lit(x) for item in OBJECT_PATHS.items() for x in item))
    place = F.coalesce(F.try_element_at(paths, F.upper(col(kind))), F.lit("pinboard"))
    return F.concat(F.regexp_replace(F.regexp_replace(col(base), "/api/rest/2.0/?$", ""), "/+$", ""), F.lit("/#/"), place, F.lit("/"), col(guid))


def object_name(name: str | Column, guid: str | Column) -> Column:
    """An object's name, or a stand-in made of its id."""
    return F.coalesce(F.nullif(col(name), F.lit("")), F.concat(F.lit("Object "), F.left(col(guid), F.lit(8)), F.lit("...")))


def blank(c: str | Column) -> Column:
    """True for null and white space."""
    return col(c).isNull() | (F.trim(col(c)) == "")
