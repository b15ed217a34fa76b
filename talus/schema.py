"""Column names of the hazard directory, and groups of them that operators share.

All names in this module are fixed values: they are those of the directory's files.
"""

from __future__ import annotations

#: Fixed values. Without one of these a run stops before any scenario.
REQUIRED = ("praID", "flow", "sector", "subC", "elevMin", "elevMax", "rSize", "LKGebietID", "LWDGebietID")

#: Fixed values. Columns that are numbers, whatever type the file gives them.
NUMERIC = ("subC", "elevMin", "elevMax", "rSize", "PEM", "PPM")

#: Fixed values. Columns whose values compare in lower case without surrounding blanks.
LOWERED = ("flow", "modType")

#: Fixed values. Join key of the hazard matrix.
MATRIX_KEY = ("PPM", "PEM", "rSize", "modType")

#: Fixed values. What a run's release and runout rows share.
PAIR_KEY = ("praID", "resultID")

#: Fixed values. Rows that agree in these (as far as present) are variants of one release area.
VARIANT_KEY = (
    "praID", "praAreaM", "praElevMin", "praElevMax", "praElevMean", "praElevBand", "praElevBandRule",
    "praAreaSized", "LKGebietID", "LKGebiet", "LKRegion", "LWDGebietID", "modType", "subC", "sector",
    "elevMin", "elevMax", "flow",
)

#: Fixed values. Columns whose ranges the diagnostic mode lists.
RANGED = (
    "praAreaM", "praAreaSized", "praAreaVol", "praElevMin", "praElevMax", "praElevMean", "LKGebietID", "subC",
    "elevMin", "elevMax", "PPM", "PEM", "rSize",
)

#: Fixed values. Columns of the viewer's popup, in its order.
POPUP = (
    "LWDGebietID", "LKGebiet", "LKRegion", "praID", "resultID", "modType", "sector", "flow", "praAreaM", "rSize",
    "PPM", "PEM", "avaPotential",
)

POT = "AvaDistributionPotential"
SIZE = "AvaSizePotential"
GEOMETRY = "geometry"
