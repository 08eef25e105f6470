"""What a panel looks like: which columns play which part.

A panel holds one row per (entity, timestamp). Nothing else in the package knows
column names; operators take a :class:`PanelSpec` or plain column names.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class PanelSpec:
    """Roles of the columns of a panel.

    ``hourly`` states the grain: True promises at most one row per entity and hour, so
    that one entity never holds more rows than the period has hours and a window over a
    single entity is bounded whatever the number of entities. Leave it False for tables
    at event grain; ordered operators then split every entity into chunks.
    """

    entity: str
    ts: str
    target: str
    measures: tuple[str, ...] = ()
    sources: tuple[str, ...] = ()
    renewables: tuple[str, ...] = ()
    label: str | None = None
    rate_marks: tuple[str, ...] = ()
    nonnegative: tuple[str, ...] = ()
    renames: dict[str, str] = field(default_factory=dict, hash=False)
    unwanted: tuple[str, ...] = ()
    tie_break: tuple[str, ...] = ()
    hourly: bool = False

    def rates(self, df: DataFrame) -> list[str]:
        """Columns whose name holds one of the rate marks, in table order."""
        return name_matches(df, self.rate_marks)

    def numeric(self, df: DataFrame) -> list[str]:
        """Measures present in ``df``, then its rates."""
        return [c for c in self.measures if c in df.columns] + self.rates(df)

    def at(self, *, hourly: bool) -> PanelSpec:
        return replace(self, hourly=hourly)


def name_matches(df: DataFrame, marks: tuple[str, ...]) -> list[str]:
    return [c for c in df.columns if any(m in c for m in marks)]


# Raw header -> column name.
ENERGY_RENAMES = {
    "Consommation (MW)": "Consommation_MW",
    "Thermique (MW)": "Thermique_MW",
    "Nucléaire (MW)": "Nucleaire_MW",
    "Eolien (MW)": "Eolien_MW",
    "Solaire (MW)": "Solaire_MW",
    "Hydraulique (MW)": "Hydraulique_MW",
    "Pompage (MW)": "Pompage_MW",
    "Bioénergies (MW)": "Bioenergies_MW",
    "Ech. physiques (MW)": "Echanges_physiques_MW",
    "Stockage batterie": "Stockage_batterie_MW",
    "Déstockage batterie": "Destockage_batterie_MW",
    "Eolien terrestre": "Eolien_terrestre_MW",
    "Eolien offshore": "Eolien_offshore_MW",
    "TCO Thermique (%)": "TCO_Thermique",
    "TCH Thermique (%)": "TCH_Thermique",
    "TCO Nucléaire (%)": "TCO_Nucleaire",
    "TCH Nucléaire (%)": "TCH_Nucleaire",
    "TCO Eolien (%)": "TCO_Eolien",
    "TCH Eolien (%)": "TCH_Eolien",
    "TCO Solaire (%)": "TCO_Solaire",
    "TCH Solaire (%)": "TCH_Solaire",
    "TCO Hydraulique (%)": "TCO_Hydraulique",
    "TCH Hydraulique (%)": "TCH_Hydraulique",
    "TCO Bioénergies (%)": "TCO_Bioenergies",
    "TCH Bioénergies (%)": "TCH_Bioenergies",
    "Région": "Region",
    "Date - Heure": "Date_Heure",
}

# The roles of the energy columns.
ENERGY = PanelSpec(
    entity="Region",
    ts="Datetime",
    target="Consommation_MW",
    measures=(
        "Consommation_MW", "Thermique_MW", "Nucleaire_MW", "Eolien_MW", "Solaire_MW",
        "Hydraulique_MW", "Pompage_MW", "Bioenergies_MW", "Echanges_physiques_MW",
        "Stockage_batterie_MW", "Destockage_batterie_MW", "Eolien_terrestre_MW",
        "Eolien_offshore_MW",
    ),
    sources=(
        "Thermique_MW", "Nucleaire_MW", "Eolien_MW", "Solaire_MW", "Hydraulique_MW",
        "Bioenergies_MW",
    ),
    renewables=("Eolien_MW", "Solaire_MW", "Hydraulique_MW", "Bioenergies_MW"),
    label="Nature",
    rate_marks=("TCO", "TCH"),
    nonnegative=(
        "Consommation_MW", "Thermique_MW", "Nucleaire_MW", "Solaire_MW", "Bioenergies_MW",
    ),
    renames=ENERGY_RENAMES,
    unwanted=("Column 30", "Code INSEE région"),
)

# Null categories of the raw table, correlation categories of the clean one.
NULL_CATEGORIES = {
    "Production": (
        "Thermique (MW)", "Nucléaire (MW)", "Eolien (MW)", "Solaire (MW)",
        "Hydraulique (MW)", "Bioénergies (MW)",
    ),
    "Stockage": ("Stockage batterie", "Déstockage batterie", "Pompage (MW)"),
    "Taux de charge": ("TCO*", "TCH*"),
    "Nouvelles tech": ("Eolien terrestre", "Eolien offshore"),
    "Autres": ("Column 30",),
}
CORRELATION_CATEGORIES = {
    "Production": (
        "Nucleaire_MW", "Hydraulique_MW", "Eolien_MW", "Solaire_MW", "Thermique_MW",
    ),
    "Demande": ("Consommation_MW",),
    "Échanges": ("Echanges_physiques_MW", "Balance_MW"),
    "Renouvelable": ("Part_renouvelable", "Production_renouvelable_MW"),
}
# Columns left out of profiles, key variables, tested pairs and groups, lags,
# rolling windows and feature sets of the energy preset.
CALENDAR_EXCLUDED = (
    "Year", "Month", "Day", "Hour", "DayOfWeek", "IsWeekend", "Season_num",
)
KEY_VARIABLES = (
    "Consommation_MW", "Production_totale_MW", "Part_renouvelable", "Nucleaire_MW",
    "Eolien_MW", "Solaire_MW", "Hydraulique_MW", "Thermique_MW", "Balance_MW",
)
TESTED_PAIRS = (
    ("Consommation_MW", "Production_totale_MW"),
    ("Consommation_MW", "Thermique_MW"),
    ("Part_renouvelable", "Nucleaire_MW"),
    ("Eolien_MW", "Solaire_MW"),
    ("Hydraulique_MW", "Balance_MW"),
    ("Hour", "Solaire_MW"),
    ("Consommation_MW", "Echanges_physiques_MW"),
)
TESTED_GROUPS = (
    ("Consommation_MW", "Region"),
    ("Production_totale_MW", "Season"),
    ("Part_renouvelable", "IsWeekend"),
    ("Eolien_MW", "DayOfWeek"),
    ("Balance_MW", "Nature"),
)
ROLLING_PAIRS = (
    ("Consommation_MW", "Thermique_MW"),
    ("Consommation_MW", "Part_renouvelable"),
    ("Solaire_MW", "Hour"),
)
HEATMAP_VARIABLES = (
    "Consommation_MW", "Production_totale_MW", "Nucleaire_MW", "Eolien_MW", "Solaire_MW",
    "Hydraulique_MW", "Thermique_MW", "Part_renouvelable", "Balance_MW", "Hour",
)
LAGS = (1, 2, 3, 24, 48, 168)
ROLLING_WINDOWS = (24, 168)
FEATURE_SETS = {
    "Basique": (
        "Hour", "DayOfWeek", "Month", "IsWeekend", "Production_totale_MW", "Part_renouvelable",
    ),
    "Cyclique": (
        "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos",
        "doy_sin", "doy_cos", "IsWeekend", "Production_totale_MW", "Part_renouvelable",
        "Temperature_simulated",
    ),
    "SansLag": (
        "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos", "IsWeekend",
        "Production_totale_MW", "Nucleaire_MW", "Eolien_MW", "Solaire_MW", "Hydraulique_MW",
        "Thermique_MW", "Part_renouvelable", "Temperature_simulated", "Renew_Nuclear_Ratio",
    ),
    "Complet": (
        "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos", "IsWeekend",
        "Production_totale_MW", "Nucleaire_MW", "Eolien_MW", "Solaire_MW", "Hydraulique_MW",
        "Thermique_MW", "Part_renouvelable", "Consommation_MW_lag_1", "Consommation_MW_lag_24",
        "Consommation_MW_rolling_mean_24", "Consommation_MW_rolling_std_24",
        "Temperature_simulated", "Production_Conso_Ratio",
    ),
}
