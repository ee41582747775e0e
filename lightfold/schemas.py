"""Types of the store's tables, and the enumerations they use."""

from __future__ import annotations

from enum import Enum, IntEnum

from pyspark.sql import types as T


class Status(IntEnum):
    UNKNOWN = 0
    OK = 1
    ERROR = 2
    WARNING = 3
    ABORT = 4
    SKIPPED = 5
    STARTED = 6


# Class names in order (the order sets matrix columns) and their labels.
class Level1(Enum):
    SOLARLIKE = "solar"
    ECLIPSE = "transit/eclipse"
    RRLYR_CEPHEID = "RRLyr/Ceph"
    DSCT_BCEP = "dSct/bCep"
    GDOR_SPB = "gDor/spB"
    CONTACT_ROT = "contactEB/spots"
    APERIODIC = "aperiodic"
    CONSTANT = "constant"


Level1Instrument = Enum("Level1Instrument", [*((c.name, c.value) for c in Level1), ("INSTRUMENT", "instrumental")])
Level2 = Enum("Level2", "RRLYR CEPHEID GDOR SPB DSCT BCEP LPV SPOTS ROAP SDB WD FLARE")
# Classifiers, the stacking one last, and training sets.
CLASSIFIERS = ("rfgc", "slosh", "xgb", "sortinghat", "meta")
TRAINING_SETS = ("keplerq9v3", "keplerq9v3-instr", "keplerq9v2", "keplerq9", "tdasim", "tdasim-raw", "tdasim-clean", "testing")


def _struct(text: str) -> T.StructType:
    """Fields from "name type, name type!" where ! marks one that may not be null."""
    fields = []
    for part in text.split(", "):
        name, kind = part.split(" ")
        fields.append(T.StructField(name, _KINDS[kind.rstrip("!")], not kind.endswith("!")))
    return T.StructType(fields)


_KINDS = {"long": T.LongType(), "string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType()}

TABLES: dict[str, T.StructType] = {
    "todolist": _struct("priority long!, starid long!, datasource string!, camera int!, ccd int!, method string, tmag double, status int, corr_status int, cbv_area int!, known_class string, final_class string"),
    "diagnostics_corr": _struct("priority long!, lightcurve string, elaptime double, worker_wait_time double, variance double, rms_hour double, ptp double, errors string"),
    "datavalidation_corr": _struct("priority long!, approved boolean!, dataval int!"),
    "settings": _struct("tset string!, version string!"),
    "diagnostics": _struct("priority long!, classifier string!, status int!, elaptime double, worker_wait_time double, errors string"),
    "results": _struct("priority long!, classifier string!, class string!, prob double!"),
}

RESULT = T.StructType([
    T.StructField("priority", T.LongType(), False),
    T.StructField("classifier", T.StringType(), False),
    T.StructField("tset", T.StringType(), False),
    T.StructField("status", T.IntegerType(), False),
    T.StructField("elaptime", T.DoubleType()),
    T.StructField("worker_wait_time", T.DoubleType()),
    T.StructField("errors", T.ArrayType(T.StringType())),
    T.StructField("class_probs", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("features_common", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("features", T.MapType(T.StringType(), T.DoubleType())),
])

LIGHTCURVE = T.StructType([T.StructField("series_id", T.LongType()), T.StructField("time", T.DoubleType()), T.StructField("flux", T.DoubleType()), T.StructField("flux_err", T.DoubleType()), T.StructField("quality", T.LongType())])
