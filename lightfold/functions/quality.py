"""Quality bit masks as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HARDEST = (1 << 32) - 1
# Bits of the corrector's and the mission's flags, and what they mean.
CORRECTOR = {
    1: "Bad data based on pixel flags",
    2: "Manual exclude",
    4: "Point removed due to sigma clipping",
    8: "Jump corrected using additive constant",
    16: "Jump corrected using additive linear trend",
    32: "Jumb corrected using multiplicative constant",
    64: "Jump corrected using multiplicative linear trend",
    128: "Point is interpolated",
    256: "Point has been rejected in processing",
}
MISSION = {
    1: "Attitude tweak",
    2: "Safe mode",
    4: "Spacecraft in Coarse point",
    8: "Spacecraft in Earth point",
    16: "Reaction wheel zero crossing",
    32: "Reaction wheel desaturation event",
    64: "Cosmic ray in optimal aperture pixel",
    128: "Manual exclude",
    256: "Sudden sensitivity dropout",
    512: "Impulsive outlier",
    1024: "Cosmic ray in collateral data",
    2048: "Earth, Moon or other planet in camera FOV",
    4096: "Scattered light from Earth or Moon in CCD",
}
CORRECTOR_CBV = 2
MISSION_DEFAULT = 1 | 2 | 4 | 8 | 32 | 64 | 128 | 4096
MISSION_CBV = 2 | 8 | 32 | 128
MISSION_HARD = MISSION_DEFAULT | 256 | 1024
CORRECTOR_DEFAULT = 1 | 2 | 256


def passes(quality: Column, mask: int = CORRECTOR_DEFAULT) -> Column:
    """No bit of ``mask`` set; a null quality passes nothing."""
    return quality.cast("long").bitwiseAND(F.lit(mask).cast("long")) == 0


def decode(quality: Column, flags: dict[int, str] = CORRECTOR) -> Column:
    """What the set bits mean, in the flags' order."""
    q = quality.cast("long")
    told = F.array(*(F.when(q.bitwiseAND(F.lit(bit).cast("long")) != 0, F.lit(text)) for bit, text in flags.items()))
    return F.filter(told, lambda x: x.isNotNull())


def binary(quality: Column) -> Column:
    """32 binary digits."""
    return F.lpad(F.conv(quality.cast("string"), 10, 2), 32, "0")
