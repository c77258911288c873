"""First usable value of several: the two kinds of fallback (survey P4-P6, P12-P16, P20-P21, P26, P29, X2-X3, X15)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_truthy(*columns: Column) -> Column:
    """The first that is neither null nor the empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def clipped(text: Column, n: int) -> Column:
    return F.substring(text, 1, n)


def flattened(text: Column, n: int) -> Column:
    """Line breaks as blanks, at most n characters."""
    return clipped(F.regexp_replace(text, r"[\r\n]+", " "), n)


def collapsed(text: Column) -> Column:
    return F.regexp_replace(F.trim(text), r"\s+", " ")


def prefixed(node_id: Column, prefix: str) -> Column:
    """With its kind prefix, unless it has one."""
    return F.when(node_id.rlike("^t[0-9]_"), node_id).otherwise(F.concat(F.lit(prefix), node_id))


def unprefixed(node_id: Column) -> Column:
    return F.regexp_replace(node_id, "^t[13]_", "")


def is_root_reference(parent: Column) -> Column:
    return parent.isNull() | parent.startswith("t3_")


def path_part(url: Column, pattern: str, default: str | None = None) -> Column:
    found = F.nullif(F.regexp_extract(url, pattern, 1), F.lit(""))
    return F.coalesce(found, F.lit(default)) if default is not None else found


def base_identifier(identifier: Column) -> Column:
    """Last path segment without its version suffix."""
    return F.regexp_replace(F.element_at(F.split(identifier, "/"), -1), r"v\d+$", "")


def version_of(identifier: Column) -> Column:
    return F.nullif(F.regexp_extract(identifier, r"v(\d+)$", 1), F.lit("")).cast("int")


def as_flag(text: Column) -> Column:
    return F.coalesce(F.lower(F.trim(text)).isin("1", "true", "yes", "on"), F.lit(False))


def safe_name(text: Column) -> Column:
    return F.regexp_replace(text, "[^a-zA-Z0-9.-]", "_")


def is_removed(text: Column, author: Column) -> Column:
    """Deleted or removed by its marks (survey F7)."""
    return F.coalesce(text.isin("[deleted]", "[removed]", "") | text.startswith("[removed]") | (author == "[deleted]"), F.lit(False))


def source_link(links: Column, identifier: Column, base: str = "https://arxiv.org/e-print/") -> Column:
    """Address of the source archive among links (array of rel, href, type), in falling order of trust, else derived from the identifier."""

    def first(rule) -> Column:
        return F.try_element_at(F.filter(links, rule), F.lit(1))["href"]

    def readable(x: Column) -> Column:
        return ~x["href"].endswith(".pdf") & ~x["href"].endswith(".ps")

    eprint = first(lambda x: (x["rel"] == "related") & x["type"].isin("application/x-eprint-tar", "application/x-eprint") & readable(x))
    tar = first(lambda x: (x["rel"].isNull() | x["rel"].isin("related", "derived")) & (x["type"] == "application/x-tar") & readable(x))
    named = first(lambda x: x["href"].endswith(".tar") | x["href"].endswith(".tar.gz"))
    return F.coalesce(eprint, tar, named, F.concat(F.lit(base), F.element_at(F.split(identifier, "/"), -1)))


def is_withdrawn(comment: Column, summary: Column) -> Column:
    """The marks of withdrawn papers."""
    said = F.lower(F.coalesce(comment, F.lit(""))).rlike("withdrawn|retracted|removed by author")
    told = F.lower(F.coalesce(summary, F.lit(""))).rlike("paper has been withdrawn|this submission has been withdrawn")
    return said | told


def is_truthy(column: Column, kind: str) -> Column:
    """Neither null nor empty nor zero: what counts as given in a required field (survey F2)."""
    empty = F.lit("") if kind == "string" else F.lit(0)
    return F.coalesce(column != empty, F.lit(False))


def entry_text(entry: Column) -> Column:
    """The text of a history entry in JSON, whatever its form (survey X14): the first of an array, the text, body or value of an object, else itself."""
    first = F.trim(entry).startswith("[")
    of_array = F.get_json_object(entry, "$[0]")
    of_object = F.coalesce(F.get_json_object(entry, "$.text"), F.get_json_object(entry, "$.body"), F.get_json_object(entry, "$.value"))
    plain = F.coalesce(F.get_json_object(F.concat(F.lit('{"x":'), entry, F.lit("}")), "$.x"), entry)
    return F.when(first, of_array).when(F.trim(entry).startswith("{"), of_object).otherwise(plain)
