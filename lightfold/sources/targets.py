"""Target lists: ECSV with a header, simulation CSV with a side file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels as lb
from ..operators.tasks import zipped

# Columns of the simulations' target list and of its side file.
SIMULATION = "starname string, tmag double, cadence double, duration double, eclat double, eclon double, Teff double, Teff_error double, logg double, logg_error double, known_class string"
SIDE = "variance double, rms_hour double, ptp double"
OPTIONAL = {"starid": "long", "lightcurve": "string", "tmag": "double", "variance": "double", "rms_hour": "double", "ptp": "double"}


def read_ecsv(spark: SparkSession, path: str, class_column: str = "label") -> DataFrame:
    """A target list with blanks or commas between columns; optional columns that are missing are null. ``class_column`` is
    the file's name of the column with labels, read as known_class."""
    lines = spark.read.text(path).where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    header = lines.first()[0]
    separator = "," if "," in header else " "
    read = spark.read.option("header", "true").option("comment", "#").option("sep", separator).csv(path)
    out = read.select(*(F.trim(c).alias(c.strip()) for c in read.columns))
    out = out.withColumnRenamed(class_column, "known_class")
    for name, kind in OPTIONAL.items():
        out = out.withColumn(name, F.col(name).try_cast(kind) if name in out.columns else F.lit(None).cast(kind))
    return out


def read_simulations(spark: SparkSession, path: str, side: str, level: str = "L1", data: str = "corr") -> DataFrame:
    """Simulated targets and their statistics, side by side by line; labels are translated, unlabelled targets go."""
    def read(p: str, schema: str) -> DataFrame:
        return spark.read.schema(schema).option("comment", "#").option("ignoreLeadingWhiteSpace", "true").option("ignoreTrailingWhiteSpace", "true").csv(p).withColumn("_line", F.monotonically_increasing_id())

    both = zipped(read(path, SIMULATION).withColumnRenamed("_line", "_a"), read(side, SIDE).withColumnRenamed("_line", "_b"), "_a", "_b").drop("_a", "_b")
    meaning = lb.LEVEL1 if level == "L1" else lb.LEVEL2
    classes = F.array_join(lb.translated(lb.split(F.col("known_class")), meaning), ";")
    suffix = {"raw": ".noisy", "clean": ".clean"}.get(data, ".sysnoise")
    named = both.withColumns({"known_class": classes, "starid": F.substring("starname", 5, 20).try_cast("long"), "lightcurve": F.concat(F.col("starname"), F.lit(suffix))})
    return named.where("known_class <> ''")


def without_class(targets: DataFrame, label: str = "INSTRUMENT") -> DataFrame:
    return targets.where(~F.array_contains(lb.split(F.col("known_class")), label))
