"""Names, paths and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the edge that a search box has at least, in angstrom.
LEAST_EDGE = 25.0


def source_stem(path: Column | str) -> Column:
    """The name of a file without folders and without the ending `.smi.gz`."""
    return F.regexp_replace(F.regexp_replace(path, "^.*/", ""), r"\.smi\.gz$", "")


def slug(name: Column | str) -> Column:
    """Lower case, every run of other characters than letters and digits a hyphen, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def structure_ids(listed: Column | str) -> Column:
    """A comma-separated list of structure ids as an array: trimmed, upper case, blanks dropped."""
    parts = F.transform(F.split(listed, ","), lambda x: F.upper(F.regexp_replace(x, r"^\s+|\s+$", "")))
    return F.filter(parts, lambda x: x != "")


def site_id(member: Column | str, tool: str, rank: Column | str) -> Column:
    """`member:tool:rank`; null if member or rank is null."""
    member, rank = (F.col(c) if isinstance(c, str) else c for c in (member, rank))
    return F.concat(member, F.lit(f":{tool}:"), rank.cast("string"))


def box_edge(edge: Column | str) -> Column:
    """An edge of a search box, LEAST_EDGE at least; null for null."""
    edge = F.col(edge) if isinstance(edge, str) else edge
    return F.when(edge.isNotNull(), F.greatest(F.lit(LEAST_EDGE), edge))


def memory_unit(text: str) -> str:
    """A memory size of a container runtime in the units of an engine: Gi becomes GiB, G becomes GB."""
    text = text.strip()
    for end in ("Ki", "Mi", "Gi", "Ti", "K", "M", "G", "T"):
        if text.endswith(end):
            return text + "B"
    return text
