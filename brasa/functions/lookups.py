"""Domain constants.

FIXED VALUES — these must equal the source data's code tables for results to
match; they are listed plainly, in natural order, and are not derived.
"""

from __future__ import annotations

# ---- FIXED VALUES: fuel raster codes -> fuel model label (32 entries) ----
FUEL_CODE_LABELS = {
    1: "Pastizales Mesomorficos Densos",
    2: "Pastizales Mesoomorficos Ralos",
    3: "Pastizales Higromorficos Densos",
    4: "Pastizales Higromorficos Ralos",
    5: "Chacareria Vinedos y Frutales",
    6: "Matorrales y Arbustos Mesomorficos Densos",
    7: "Matorrales y Arbustos Mesomorficos Medios y Ralos",
    8: "Matorrales y Arbustos Higromorficos Densos",
    9: "Matorrales y Arbustos Higromorificos Medios y Ralos",
    10: "Formaciones con predominancia de Chuesquea spp",
    11: "Formaciones con predominancia de Ulex spp",
    12: "Renovales Nativos diferentes al Tipo Siempreverde",
    13: "Renovales Nativos del Tipo Siempreverde",
    14: "Formaciones con predominancia de Alerzales",
    15: "Formaciones con predominancia de Araucaria",
    16: "Arbolado Nativo Denso",
    17: "Arbolado Nativo de Densidad Media",
    18: "Arbolado Nativo de Densidad Baja",
    19: "Plantaciones Coniferas Nuevas (0-3) sin Manejo",
    20: "Plantaciones Coniferas Jovenes (4-11) sin Manejo",
    21: "Plantaciones Coniferas Adultas (12-17) sin Manejo",
    22: "Plantaciones Coniferas Mayores (>17) sin Manejo",
    23: "Plantaciones Coniferas Jovenes (4-11) con Manejo",
    24: "Plantaciones Coniferas Adultas (12-17) con Manejo",
    25: "Plantaciones Coniferas Mayores (>17) con Manejo",
    26: "Plantaciones Eucaliptos Nuevas (0-3)",
    27: "Plantaciones Eucaliptos Jovenes (4-10)",
    28: "Plantaciones Eucalipto Adultas (>10)",
    29: "Plantaciones Latifoliadas y Mixtas",
    30: "Desechos Explotacion a Tala Rasa de Plantaciones",
    31: "Desechos Explotacion a Tala Rasa de Bosque Nativo",
    999: "No combustible",
}

# ---- FIXED VALUES: incident-report fuel name -> fuel model label (26 entries) ----
LOCAL_FUEL_LABELS = {
    "Aserrin o Corteza en Acopio": "Desechos Explotacion a Tala Rasa de Plantaciones",
    "Bosque nativo": "Arbolado Nativo Denso",
    "Desecho Agricola": "Matorrales y Arbustos Mesomorficos Medios y Ralos",
    "Desecho de Poda": "Desechos Explotacion a Tala Rasa de Plantaciones",
    "Desecho de Raleo": "Desechos Explotacion a Tala Rasa de Plantaciones",
    "Desecho de cosecha": "Desechos Explotacion a Tala Rasa de Plantaciones",
    "Desecho de cosecha nativo": "Desechos Explotacion a Tala Rasa de Bosque Nativo",
    "Estructurales, Casa, Bodega, etc": "No combustible",
    "Euca > 8 anos": "Plantaciones Eucalipto Adultas (>10)",
    "Euca de 0 - 3 anos": "Plantaciones Eucaliptos Nuevas (0-3)",
    "Euca de 4 - 7 anos": "Plantaciones Eucaliptos Jovenes (4-10)",
    "Maquinaria Pesada": "No combustible",
    "Matorral, Arbustos y O.Especies": "Matorrales y Arbustos Mesomorficos Densos",
    "Otros Combustibles No Vegetales": "No combustible",
    "Pastizal": "Pastizales Mesomorficos Densos",
    "Pi > de 14 anos con manejo": "Plantaciones Coniferas Adultas (12-17) con Manejo",
    "Pi > de 14 anos sin manejo": "Plantaciones Coniferas Adultas (12-17) sin Manejo",
    "Pi de 0 - 3 anos": "Plantaciones Coniferas Nuevas (0-3) sin Manejo",
    "Pi de 4 - 7 anos con manejo": "Plantaciones Coniferas Jovenes (4-11) con Manejo",
    "Pi de 4 - 7 anos sin manejo": "Plantaciones Coniferas Jovenes (4-11) sin Manejo",
    "Pi de 8 - 13 anos con manejo": "Plantaciones Coniferas Jovenes (4-11) con Manejo",
    "Pi de 8 - 13 anos sin manejo": "Plantaciones Coniferas Jovenes (4-11) sin Manejo",
    "Roce": "Desechos Explotacion a Tala Rasa de Plantaciones",
    "SIN INFORMACION": "No combustible",
    "Vehiculos de Carga": "No combustible",
    "Vehiculos de Personal": "No combustible",
}

# ---- FIXED VALUES: target-zone recode (unknown -> "OTRO", then dropped) ----
TARGET_ZONES = {
    "UNIDAD BASICA": "BASICA",
    "ZONA INTERFAZ": "INTERFAZ",
    "CONFLICTO": "CONFLICTO",
    "VALDIVIA": "VALDIVIA",
    "NOCTURNO": "NOCTURNO",
}
TARGET_ZONE_OTHER = "OTRO"

# ---- FIXED VALUES: dispatch zones kept, and the prefix removed ----
DISPATCH_ZONES = ["ZONA CHILLAN", "ZONA CONSTITUCION", "ZONA ARAUCO", "ZONA VALDIVIA"]
ZONE_PREFIX = "ZONA "
REPORT_TYPES = ["FOCO"]

# ---- FIXED VALUES: zone factor levels (ordered) ----
ZONE_WE_LEVELS = ["Costa", "Valle", "Cordillera"]
ZONE_NS_LEVELS = ["1", "2", "3", "4", "5"]
ZONE_FACTORS = ["zone_WE", "zone_NS"]

# ---- FIXED VALUES: speed classes (m/min), bins closed on the left ----
SPEED_BINS = [0.0, 1.7, 10.0, 33.0, 83.0, float("inf")]
SPEED_LABELS = ["baja", "media", "alta", "muy alta", "extrema"]

# ---- FIXED VALUES: model covariates ----
COVARIATES = [
    "temperature", "wind_speed_kmh", "relative_humidity", "slope_degrees",
    "sin_hour", "cos_hour", "initial_fuel_reduced", "diurnal_nocturnal", "high_season",
]
COVARIATES_CATEGORICAL = ["initial_fuel_reduced", "diurnal_nocturnal", "high_season"]
PI_COVARIATES = ["diurnal_nocturnal", "high_season"]
TARGET = "propagation_speed_mm"
# Feature table layout (ids, geo, time, factors, covariates, targets, others).
FEATURE_COLUMNS = (
    ["fire_id", "longitude", "latitude", "start_datetime", "zone_WE", "zone_NS",
     "temperature", "wind_speed_kmh", "relative_humidity", "slope_degrees", "sin_hour",
     "cos_hour", "initial_fuel", "diurnal_nocturnal", "high_season",
     "propagation_speed_mm", "dt_minutes", "initial_radius_m", "zone_alert", "hour"]
)

# Scoring input columns.
SCORING_INPUT = ["fire_id", "longitude", "latitude", "start_datetime",
                 "temperature", "wind_speed_kmh", "relative_humidity"]

# ---- FIXED VALUES: incident report columns kept, raw name -> canonical name (26) ----
FIRE_COLUMN_NAMES = {
    "ID_FOCO_INCENDIO": "fire_id",
    "LATITUD": "latitude",
    "LONGITUD": "longitude",
    "REGION": "region",
    "PROVINCIA": "province",
    "COMUNA": "commune",
    "PREDIO": "property",
    "TEMPORADA": "season",
    "DIA_INICIO": "start_day",
    "HORA_INICIO": "start_time",
    "INICIO": "start_datetime",
    "ARRIBO": "arrival_datetime_inc",
    "CONTROL": "control_datetime",
    "EXTINCION": "extinction_datetime",
    "ZONA_META": "target_zone",
    "COMBUSTIBLE_INICIAL": "initial_fuel",
    "PIRA": "pyre",
    "EUCA": "euca",
    "OTRAS": "other_fuels",
    "GRUPO_CAUSAL": "causal_group",
    "CAUSA": "cause",
    "SUP_INICIAL": "initial_surface_ha",
    "SUP": "final_surface_ha",
    "CLASE": "class",
    "GASTO_COMBATE_UF": "combat_cost_per_unit",
    "ARCHIVO": "file_source",
}

# ---- FIXED VALUES: dispatch columns renamed before lower-casing the rest ----
DISPATCH_COLUMN_NAMES = {"ID_FOCO_INCENDIO": "fire_id", "ZONA": "zone", "ARCHIVO": "file_source"}

COVARIATE_META = {
    "factors": ZONE_FACTORS, "covariates": COVARIATES, "covariates_categorical": COVARIATES_CATEGORICAL,
    "pi_covariates": PI_COVARIATES, "target": TARGET,
}
