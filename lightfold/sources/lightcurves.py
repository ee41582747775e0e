"""Light curve files: whitespace text and FITS tables, read in parallel, one file a row of bytes at most."""

from __future__ import annotations

import gzip
import re
import traceback
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.tasks import placed

TEXT_SUFFIXES = (".txt", ".noisy", ".sysnoise", ".clean")
FITS_PATTERN = r".*\.fits(\.gz)?$"
POINTS = "path string, targetid long, time double, flux double, flux_err double, quality long, centroid_col double, centroid_row double, cadenceno long"
# Columns of corrected files (by which they are known) and of the missions' files.
CORRECTED = {"time": "TIME", "flux": "FLUX_CORR", "flux_err": "FLUX_CORR_ERR", "quality": "QUALITY", "centroid_col": "MOM_CENTR1", "centroid_row": "MOM_CENTR2", "cadenceno": "CADENCENO"}
MISSION = {"time": "TIME", "flux": "PDCSAP_FLUX", "flux_err": "PDCSAP_FLUX_ERR", "quality": "QUALITY", "centroid_col": "MOM_CENTR1", "centroid_row": "MOM_CENTR2", "cadenceno": "CADENCENO"}
KEPLER_LENGTH = 27.4


def files(spark: SparkSession, folder: str, pattern: str = FITS_PATTERN, glob: str | None = None) -> DataFrame:
    """(priority, path, name) of all files under ``folder`` whose name fits; priority is the place by path.

    Only names are read. The listing is the driver's, as any file source's.
    """
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    found = (read.option("pathGlobFilter", glob) if glob else read).load(folder).select("path")
    named = found.withColumn("name", F.element_at(F.split("path", "/"), -1))
    named = named if glob else named.where(F.col("name").rlike(pattern))
    return placed(named, "path").select((F.col("place") + 1).alias("priority"), "path", "name")


def read_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, time, flux, flux_err, quality) of whitespace text; a file of three columns has quality 0. # starts a comment."""
    parts = F.split(F.trim(F.regexp_replace("value", "#.*", "")), r"\s+")
    rows = spark.read.text(path).select(F.input_file_name().alias("path"), parts.alias("p")).where(F.size("p") >= 3)

    def number(i: int) -> Column:
        return F.try_element_at("p", F.lit(i)).try_cast("double")

    return rows.select("path", number(1).alias("time"), number(2).alias("flux"), number(3).alias("flux_err"), F.coalesce(number(4), F.lit(0.0)).cast("long").alias("quality"))


def _cards(data: bytes, at: int) -> tuple[dict, int]:
    """Keywords of the header that starts at a byte, and where its data start."""
    out: dict = {}
    while True:
        block = data[at : at + 2880]
        if len(block) < 2880:
            raise ValueError("the FITS header does not end")
        at += 2880
        for k in range(0, 2880, 80):
            card = block[k : k + 80].decode("ascii", "replace")
            if card[:8].strip() == "END":
                return out, at
            if card[8:10] == "= ":
                raw = card[10:]
                if raw.lstrip().startswith("'"):
                    out[card[:8].strip()] = re.match(r"\s*'((?:[^']|'')*)'", raw)[1].replace("''", "'").rstrip()
                else:
                    value = raw.split("/")[0].strip()
                    out[card[:8].strip()] = {"T": True, "F": False}.get(value) if value in "TF" else (float(value) if re.search(r"[.EeDd]", value.replace("D", "E")) else int(value)) if value else None


_FORMATS = {"L": "i1", "B": "u1", "I": ">i2", "J": ">i4", "K": ">i8", "E": ">f4", "D": ">f8", "A": "S"}


def read_fits(data: bytes) -> tuple[dict, dict, dict[str, np.ndarray]]:
    """Primary keywords, the first table's keywords and its columns, from FITS bytes (gzipped or not)."""
    data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
    primary, at = _cards(data, 0)
    at += _size(primary)
    while at < len(data):
        header, at = _cards(data, at)
        if header.get("XTENSION") == "BINTABLE":
            fields, names = [], []
            for n in range(1, header["TFIELDS"] + 1):
                repeat, kind = re.match(r"(\d*)([A-Z])", header[f"TFORM{n}"]).groups()
                count, name = int(repeat or 1), header.get(f"TTYPE{n}", f"col{n}")
                kind = f"S{count}" if kind == "A" else _FORMATS[kind]
                fields.append((name, kind) if kind[0] == "S" or count == 1 else (name, kind, (count,)))
                names.append(name)
            rows = np.frombuffer(data, np.dtype(fields), header["NAXIS2"], at)
            return primary, header, {n: _scaled(rows[n].astype(rows[n].dtype.newbyteorder("=")), header, k) for k, n in enumerate(names, 1)}
        at += _size(header)
    raise ValueError("the FITS file has no table")


def _scaled(values: np.ndarray, header: dict, k: int) -> np.ndarray:
    """A column by its TSCAL and TZERO; whole numbers stay whole if both are, and TNULL values of a scaled column are NaN."""
    scale, zero = header.get(f"TSCAL{k}") or 1, header.get(f"TZERO{k}") or 0
    if values.dtype.kind not in "iuf" or (scale == 1 and zero == 0):
        return values
    if values.dtype.kind != "f" and float(scale).is_integer() and float(zero).is_integer():
        if zero == 2**63:  # unsigned 64-bit numbers
            return values.view(np.uint64) ^ np.uint64(2**63)
        return values.astype(np.int64) * int(scale) + int(zero)
    out = values.astype(float) * float(scale) + float(zero)
    null = header.get(f"TNULL{k}")
    return out if null is None or values.dtype.kind == "f" else np.where(values == null, np.nan, out)


def _size(header: dict) -> int:
    """Bytes of a unit's data, padded."""
    n = int(header.get("NAXIS", 0) or 0)
    size = abs(int(header.get("BITPIX", 8))) // 8 * int(np.prod([int(header[f"NAXIS{k}"]) for k in range(1, n + 1)])) if n else 0
    return -(-(size + int(header.get("PCOUNT", 0) or 0)) // 2880) * 2880


def curve(data: bytes, truncate: bool = False) -> pd.DataFrame:
    """The points of a light curve file, flux in parts per million; unknown telescopes raise ValueError."""
    primary, _, columns = read_fits(data)
    telescope = primary.get("TELESCOP")
    corrected = telescope == "TESS" and CORRECTED["flux"] in columns
    if not corrected and telescope not in ("TESS", "Kepler"):
        raise ValueError(f"unknown telescope: {telescope}")
    names = CORRECTED if corrected else MISSION | ({"quality": "SAP_QUALITY"} if telescope == "Kepler" else {})
    out = pd.DataFrame({k: columns[c].astype(float if k not in ("quality", "cadenceno") else np.int64) if c in columns else np.full(len(columns["TIME"]), 0 if k in ("quality", "cadenceno") else np.nan) for k, c in names.items()})
    if telescope == "Kepler" and truncate:
        out = out[out["time"] - out["time"].min() <= KEPLER_LENGTH]
    if not corrected:
        middle = out["flux"].median()
        out["flux"], out["flux_err"] = 1e6 * (out["flux"] / middle - 1), 1e6 * out["flux_err"] / abs(middle)
    target = primary.get("TICID") or primary.get("KEPLERID") or 0
    out.insert(0, "targetid", int(target))
    return out


def read_fits_curves(spark: SparkSession, folder: str, glob: str = "*.fits*", truncate: bool = False) -> DataFrame:
    """Points of all FITS light curves under ``folder``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                points = curve(content, truncate)
                points.insert(0, "path", path)
                yield points[[f.split()[0] for f in POINTS.split(", ")]]

    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder)
    return found.select("path", "content").mapInPandas(run, POINTS)


def text_curve(data: bytes) -> pd.DataFrame:
    """The points of a text light curve: three columns of numbers, or four with quality. # starts a comment."""
    rows = [line.split("#")[0].split() for line in data.decode().splitlines()]
    table = np.array([[float(x) for x in r] for r in rows if r], float)
    if table.ndim != 2 or table.shape[1] < 3:
        raise ValueError("a light curve needs three columns")
    quality = table[:, 3].astype(np.int64) if table.shape[1] > 3 else np.zeros(len(table), np.int64)
    return pd.DataFrame({"time": table[:, 0], "flux": table[:, 1], "flux_err": table[:, 2], "quality": quality})


def read_targets(targets: DataFrame, folder: str, truncate: bool = False) -> DataFrame:
    """(priority, t, flux, flux_err, quality, error): the points of each target's file (priority, lightcurve) under ``folder``.

    A file that is missing or cannot be read gives one row with the error and no point, and stops nothing else.
    """
    spark = targets.sparkSession
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    root = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toString().rstrip("/") + "/"
    bare = root.split(":", 1)[-1] if ":" in root.split("/", 1)[0] else root

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for priority, name, content in zip(batch["priority"], batch["name"], batch["content"], strict=True):
                try:
                    if content is None:
                        raise FileNotFoundError(name)
                    if name.endswith(TEXT_SUFFIXES):
                        points = text_curve(content)
                    elif name.endswith((".fits", ".fits.gz")):
                        points = curve(content, truncate)
                    else:
                        raise ValueError(f"unknown kind of file: {name}")
                    if points.empty:
                        raise ValueError("no points")
                    out = pd.DataFrame({"priority": priority, "t": points["time"], "flux": points["flux"], "flux_err": points["flux_err"], "quality": points["quality"], "error": None})
                except Exception:
                    out = pd.DataFrame([(priority, None, None, None, None, traceback.format_exc().strip())], columns=["priority", "t", "flux", "flux_err", "quality", "error"])
                yield out.astype({"t": float, "flux": float, "flux_err": float, "quality": "Int64", "error": object})

    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    found = found.select(F.regexp_replace("path", "^" + re.escape(root), "").alias("name"), "content")
    own = F.regexp_replace("lightcurve", f"^({re.escape(root)}|{re.escape(bare)}|file:{re.escape(bare)}|\\./)", "")
    both = targets.select("priority", own.alias("name")).join(found, "name", "left")
    return both.select("priority", "name", "content").mapInPandas(run, "priority long, t double, flux double, flux_err double, quality long, error string")


def bad_data_removed(points: DataFrame, mask: int) -> DataFrame:
    """Without points that have a bit of ``mask`` set."""
    return points.where(F.col("quality").bitwiseAND(F.lit(mask).cast("long")) == 0)
