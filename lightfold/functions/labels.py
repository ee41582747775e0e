"""Labels of targets: splitting, translation, priority, and names of stars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Simulation labels and the classes they mean, by level.
LEVEL1 = {
    "Solar-like": "SOLARLIKE",
    "Transit": "ECLIPSE",
    "Eclipse": "ECLIPSE",
    "multi": "ECLIPSE",
    "MMR": "ECLIPSE",
    "RR Lyrae": "RRLYR_CEPHEID",
    "RRab": "RRLYR_CEPHEID",
    "RRc": "RRLYR_CEPHEID",
    "RRd": "RRLYR_CEPHEID",
    "Cepheid": "RRLYR_CEPHEID",
    "FM": "RRLYR_CEPHEID",
    "1O": "RRLYR_CEPHEID",
    "1O2O": "RRLYR_CEPHEID",
    "FM1O": "RRLYR_CEPHEID",
    "Type II": "RRLYR_CEPHEID",
    "Anomaleous": "RRLYR_CEPHEID",
    "SPB": "GDOR_SPB",
    "dsct": "DSCT_BCEP",
    "bumpy": "GDOR_SPB",
    "gDor": "GDOR_SPB",
    "bCep": "DSCT_BCEP",
    "Spots": "CONTACT_ROT",
    "LPV": "APERIODIC",
    "MIRA": "APERIODIC",
    "SR": "APERIODIC",
    "Constant": "CONSTANT",
    "gDor+dSct hybrid": "DSCT_BCEP;GDOR_SPB",
    "dSct+gDor hybrid": "DSCT_BCEP;GDOR_SPB",
    "bCep+SPB hybrid": "DSCT_BCEP;GDOR_SPB",
}
LEVEL2 = {
    "Solar-like": "SOLARLIKE",
    "Transit": "ECLIPSE",
    "Eclipse": "ECLIPSE",
    "multi": "ECLIPSE",
    "MMR": "ECLIPSE",
    "RR Lyrae": "RRLYR",
    "RRab": "RRLYR",
    "RRc": "RRLYR",
    "RRd": "RRLYR",
    "Cepheid": "CEPHEID",
    "FM": "CEPHEID",
    "1O": "CEPHEID",
    "1O2O": "CEPHEID",
    "FM1O": "CEPHEID",
    "Type II": "CEPHEID",
    "Anomaleous": "CEPHEID",
    "SPB": "SPB",
    "dsct": "DSCT",
    "bumpy": "DSCT",
    "gDor": "GDOR",
    "bCep": "BCEP",
    "roAp": "ROAP",
    "sdBV": "SDB",
    "Flare": "FLARE",
    "Spots": "SPOTS",
    "LPV": "LPV",
    "MIRA": "LPV",
    "SR": "LPV",
    "Constant": "CONSTANT",
    "gDor+dSct hybrid": "GDOR;DSCT",
    "dSct+gDor hybrid": "DSCT;GDOR",
    "bCep+SPB hybrid": "BCEP;SPB",
}
# Of several labels, the first of these counts.
PRIORITY = ("ECLIPSE", "RRLYR_CEPHEID", "CONTACT_ROT", "DSCT_BCEP", "GDOR_SPB", "SOLARLIKE")


def split(c: Column, by: str = ";") -> Column:
    """Distinct labels of a text, in order, without blanks around them; empty ones are left out."""
    return F.array_distinct(F.filter(F.transform(F.split(c, by), lambda x: F.trim(x)), lambda x: x != ""))


def translated(labels: Column, meaning: dict[str, str]) -> Column:
    """Classes of an array of labels; unknown ones are left out, some mean several."""
    known = F.create_map(*(F.lit(x) for pair in meaning.items() for x in pair))
    return F.array_distinct(F.flatten(F.transform(F.filter(labels, lambda x: F.map_contains_key(known, x)), lambda x: F.split(known[x], ";"))))


def single(labels: Column, order: tuple[str, ...] = PRIORITY) -> Column:
    """The label that counts: by ``order``, else the first; null for none."""
    out = F.get(labels, 0)
    for label in reversed(order):
        out = F.when(F.array_contains(labels, label), label).otherwise(out)
    return F.when(F.size(labels) > 1, out).otherwise(F.get(labels, 0))


def star_id(name: Column) -> Column:
    """The number of a star's name; made-up stars have numbers under zero."""
    def after(prefix: str) -> Column:
        return F.try_to_number(F.substring(name, len(prefix) + 1, 12), F.lit("999999999999")).cast("long")

    return F.when(name.startswith("constant_"), F.lit(-10000) - after("constant_")).when(name.startswith("fakerrlyr_"), F.lit(-20000) - after("fakerrlyr_")).otherwise(name.try_cast("long"))


def star_path(label: Column, name: Column) -> Column:
    """``class/name.txt``, numbers of nine digits."""
    own = F.when(name.rlike("^[0-9]+$"), F.lpad(name, F.greatest(F.length(name), F.lit(9)), F.lit("0"))).otherwise(name)
    return F.concat_ws("/", label, F.concat(own, F.lit(".txt")))
