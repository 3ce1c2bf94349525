"""Passages ("nodes") as columns and as strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ascii_id(name: Column) -> Column:
    """An id without its characters beyond ASCII; different ids may become equal."""
    return F.regexp_replace(name.cast("string"), "[^\\x00-\\x7F]", "")


def node_string(doc: Column, s: Column, e: Column) -> Column:
    """``{doc}___{s}_{e}``; null if a part is null."""
    return F.concat(doc.cast("string"), F.lit("___"), s.cast("string"), F.lit("_"), e.cast("string"))


def parse_node(node: Column) -> Column:
    """``struct(doc_id, s, e)`` of a node string; null parts where it has another form."""
    part = lambda i: F.regexp_extract(node, r"^\s*(.*?)___\s*(-?\d+)\s*_\s*(-?\d+)\s*$", i)
    number = lambda i: F.nullif(part(i), F.lit("")).try_cast("int")
    return F.struct(F.nullif(part(1), F.lit("")).alias("doc_id"), number(2).alias("s"), number(3).alias("e"))


def natural_key(name: Column) -> Column:
    """Key for natural order: runs of digits compare as numbers, the rest as text."""
    tokens = F.regexp_extract_all(name, F.lit(r"(\d+|\D+)"), F.lit(1))

    def key(t: Column) -> Column:
        number = F.regexp_replace(t, "^0+(?=.)", "")
        return F.struct(F.when(t.rlike(r"^\d"), F.concat(F.lpad(F.length(number).cast("string"), 5, "0"), number)).alias("n"), t.alias("t"))

    return F.transform(tokens, key)


def old_form(node: Column) -> Column:
    """A node id of the older form ``a_b_c___s_e`` as ``a__b_c___s_e``; an ``_ext`` mark moves into the document."""
    base, span = F.substring_index(node, "___", 1), F.substring_index(node, "___", -1)
    base = F.regexp_replace(base, "^([^_]*)_([^_]*)_([^_]*)$", "$1__$2_$3")
    marked = F.contains(node, F.lit("ext"))
    return F.concat(F.when(marked, F.concat(base, F.lit("_ext"))).otherwise(base), F.lit("___"), F.when(marked, F.substring_index(span, "_ext", 1)).otherwise(span))
