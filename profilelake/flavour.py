"""The two databases a profile can belong to, and the columns each one keeps."""

from __future__ import annotations

from dataclasses import dataclass

# Public parameter names, in the order of the declared schema.
# Irradiances are measured at the wavelengths (nm) below, and once without one.
IRRADIANCE_WAVELENGTHS = ("", "380", "412", "443", "490", "555")
BASE_PARAMETERS = (
    "PRES", "TEMP", "PSAL", "DOXY",
    "BBP", "BBP470", "BBP532", "BBP700",
    "TURBIDITY", "CP", "CP660",
    "CHLA", "CHLA_FLUORESCENCE", "CDOM",
    "NITRATE", "BISULFIDE", "PH_IN_SITU_TOTAL",
    *(f"DOWN_IRRADIANCE{nm}" for nm in IRRADIANCE_WAVELENGTHS),
    *(f"UP_IRRADIANCE{nm}" for nm in IRRADIANCE_WAVELENGTHS),
    "DOWNWELLING_PAR",
)
CORE_PARAMETERS = ("PRES", "TEMP", "PSAL")

PROFILE_COLUMNS = (
    "PLATFORM_NUMBER", "N_PROF", "N_LEVELS", "CYCLE_NUMBER", "DIRECTION",
    "LATITUDE", "LONGITUDE", "POSITION_QC", "JULD", "JULD_QC",
)

DATA_MODE_SUFFIX = "_DATA_MODE"


def _core_columns() -> tuple[str, ...]:
    at = PROFILE_COLUMNS.index("DIRECTION") + 1
    head = PROFILE_COLUMNS[:at] + ("DATA_MODE",) + PROFILE_COLUMNS[at:]
    kinds = ("", "_QC", "_ADJUSTED", "_ADJUSTED_QC", "_ADJUSTED_ERROR")
    return head + tuple(p + k for p in CORE_PARAMETERS for k in kinds)


def _biogeochemical_columns() -> tuple[str, ...]:
    kinds = (
        "", "_QC", "_dPRES",
        "_ADJUSTED", "_ADJUSTED_QC", "_ADJUSTED_ERROR", DATA_MODE_SUFFIX,
    )
    # A pressure has no distance to its own pressure level.
    return PROFILE_COLUMNS + tuple(
        p + k for p in BASE_PARAMETERS for k in kinds if p + k != "PRES_dPRES"
    )


@dataclass(frozen=True)
class Flavour:
    """One database: its index file, its per-float file suffix, its columns."""

    name: str
    index_file: str
    file_suffix: str
    columns: tuple[str, ...]
    has_sensor_list: bool

    @property
    def data_mode_parameters(self) -> tuple[str, ...]:
        """Parameters that have a ``<PARAM>_DATA_MODE`` column."""
        return tuple(
            c.removesuffix(DATA_MODE_SUFFIX)
            for c in self.columns
            if c.endswith(DATA_MODE_SUFFIX)
        )


# Names of the public index files and per-float files.
CORE = Flavour("phy", "ar_index_global_prof.txt", "_prof.nc", _core_columns(), False)
BIOGEOCHEMICAL = Flavour(
    "bgc", "argo_synthetic-profile_index.txt", "_Sprof.nc", _biogeochemical_columns(), True
)


def flavour(db: str | Flavour) -> Flavour:
    """``phy`` or ``bgc``, in any case; anything else raises before any job runs."""
    if isinstance(db, Flavour):
        return db
    for known in (CORE, BIOGEOCHEMICAL):
        if isinstance(db, str) and db.lower() == known.name:
            return known
    raise ValueError(f"unknown database {db!r}: expected 'phy' or 'bgc'")


def flavours(db: str | Flavour | None = None) -> tuple[Flavour, ...]:
    """The flavours a run covers: both when none is named."""
    return (CORE, BIOGEOCHEMICAL) if db is None else (flavour(db),)
