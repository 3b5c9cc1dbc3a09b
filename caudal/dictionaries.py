"""Code dictionaries.

Fixed values: they decide the content of the output tables and are therefore
stated as they are, in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.session import literal_table

# Variable name -> output code (fixed values). A name listed twice in the source
# dictionary keeps its last code; only that one is stated here.
VARIABLE_CODES = {
    "Precipitation": "P",
    "PRECIPITAÇÃO TOTAL, DIARIO": "P",
    "PRECIPITAÇÃO TOTAL, MENSAL": "P",
    "PRECIPITAÇÃO TOTAL, HORÁRIO": "P",
    "PRECIPITAÇÃO TOTAL, MENSAL (AUT)": "P",
    "PRECIPITAÇÃO TOTAL, DIARIO (AUT)": "P",
    "totalPrecipitationPast24Hours": "P",
    "totalPrecipitationOrTotalWaterEquivalent": "P",
    "Amount of precipitation": "P",
    "Intensidad de la Precipitación": "P",
    "Chuva": "P",
    "nivel agua": "H",
    "Level": "H",
    "Gage height, stream": "H",
    "Stream level": "H",
    "Nivel de Río": "H",
    "Flux, discharge": "Q",
    "Stream discharge": "Q",
    "Vazao": "Q",
    "Volume": "volume",
    "Reservoir storage": "storage",
    "Air temperature (at specified distance from reference surface)": "temperature",
    "Velocity, wind": "wind velocity",
    "Velocidad del Viento": "wind velocity",
    "Intensidad del Viento": "wind velocity",
    "Velocidad media del viento": "wind velocity",
    "Wind direction": "wind direction",
    "Dirección del Viento": "wind direction",
    "vento, direção": "wind direction",
    "Atmospheric pressure": "atmospheric pressure",
    "Pressure": "atmospheric pressure",
    "Presión a Nivel de Estación": "atmospheric pressure",
    "Pressure reduced to mean sea level": "pressure reduced to mean sea level",
    "Presión a Nivel del Mar": "pressure reduced to mean sea level",
    "Radiation, Global": "solar radiation",
    "Radiación": "solar radiation",
    "Relative humidity": "relative humidity",
    "Snow depth": "snow depth",
    "Temperature, dew point": "dew point temperature",
    "Punto de rocio": "dew point temperature",
    "Temperatura de Rocio": "dew point temperature",
    "Temperature, water": "water temperature",
    "Temperatura del Agua": "water temperature",
    "Sunshine duration": "sunshine duration",
    "Evapotranspiration, actual": "real evapotranspiration",
    "Evapotranspiration, potential": "potential evapotranspiration",
    "Dry bulb temperature": "temperature",
    "Temperatura Media": "temperature",
    "Temperatura del Aire": "temperature",
    "Total reservoir capacity": "total reservoir capacity",
    "Inflow discharge (to the reservoir)": "inflow discharge",
    "Outflow discharge (from the reservoir)": "outflow discharge",
    "Wet bulb temperature": "wet bulb temperature",
    "Temperatura del Bulbo Húmedo": "wet bulb temperature",
    "Soil Moisture": "soil moisture",
    "Evapotranspiración": "real evapotranspiration",
}

# Organisation name -> short code (fixed values).
ORGANISATION_CODES = {
    "National Water Agency of Brazil": "ANA",
    "INMET": "INMET",
    "Dirección de Meteorología e Hidrología (DMH), Paraguay": "DMH",
    "Instituto Nacional del Agua (INA)": "INA",
    "Hydrologic Research Center (HRC)": "PROHMSAT",
    "SAR - Agência Nacional de Águas (ANA)": "SAR",
}

# Variable dictionary rows that precede the harvested ones (fixed values).
DEFAULT_VARIABLES = [
    ("http://hydro.geodab.eu/hydro-ontology/concept/3", "Level", None),
    ("http://hydro.geodab.eu/hydro-ontology/concept/76", "Flux, discharge", None),
    ("https://hydro.geodab.eu/hydro-ontology/concept/65", "Precipitation", None),
]

# Property codes harvested when nothing else is asked for (fixed values).
DEFAULT_PROPERTIES = [
    "02B12CBDEF3984F7ADB9CFDFBF065FC1D3AEF13F",
    "AF6C35E61AC362E0151B6458DADCB032043B67EA",
    "D2DB8BC2930F82D1E5EFA6B529F0262EB0FFE994",
    "5C34E7D199E2643B1AA949D920942C576A406AB4",
    "80B052462E277E0F7D3002CA6C67E481CD953CDC",
    "AEAF735EBFC73611C8A50B6D0319BD4258B45918",
    "54DF3A7E4C8ED47459CDC1E3C81DED8A48797642",
    "4E47D870E717581F520F6C4EBE8E23962A880107",
    "B838A449A5FBC64CBB8A204A5CD614519EB0844A",
    "CEE1F03F85E1231A57C7E756527ED41B9C43820B",
    "47BEF10439748057FFDEAC0E655B86E41E327C0B",
    "435723334E47400E56AAD9E883BC3314709A48D9",
    "7075721786F52D17847D1D6369D0F3E794795E5C",
    "B9240615C51DA438E9E02C9858887F1EE726EE2E",
    "C83AE7E059AF1DB0D94C4036CADEA3B613204DE7",
    "CD59B39DBBD02109859570B58EAA33621CD1F85B",
    "E1BC0D40B78608E3806DA51ED4F5CDE1852EC46E",
    "FA25FBBAD411D74E98BB9B663FA849BF03D0CEDE",
    "42E0859F19D8D3EEAD80DD47CE7A7B5DC94BB52C",
    "49934E86375E010327D50C168DE5EDA6FE12FDF3",
    "6A1207635C2220886869225C67B8F68E0627DDE3",
    "1B4FAD27021F87C7B176D4C5178619495C0777A4",
    "4847D38D5EC11F3A87B3821604DDC622DF6FB5CB",
    "514DB034F5483F30026291BB981096B437EFE11F",
    "6AA6C8AF684BF2DAC15E4B7D7B38EC2FF631A3A8",
    "8ABB624B5F6CE317BEC0D14A4B1AB7F121A3B1F2",
    "8D3F156BB84DC053CB935F58D0F7FB6F816BB38E",
    "941CC3F495C4F4D36921A953A419B73396362B7D",
    "F923311DA0ACB1793D8E5A053F2335192518CDAE",
    "973453E5B8A696A9C7FC01EFC5B6EA5D536A1107",
]

# Catalogue B variable id -> quantity (fixed values).
QUANTITY_BY_VARIABLE = {
    1: "P", 2: "H", 4: "Q", 39: "H", 40: "Q", 31: "P", 34: "P", 101: "H", 85: "H",
}

# Catalogue B variable ids with a fixed column list, and the names and groups of
# the tables written for them (fixed values).
CONFORMED_VARIABLES = {1: "P", 31: "P", 34: "P", 39: "H", 40: "Q", 85: "H", 101: "H"}
TABLE_BY_VARIABLE = {
    1: "INA_P", 39: "INA_H", 40: "INA_Q", 31: "INA_P1h", 34: "INA_P3h", 101: "INA_H4h", 85: "INA_H1h",
}
COMBINED_TABLES = {
    "INA_P_all": ("P", [1, 31, 34]),
    "INA_H_all": ("H", [39, 85, 101]),
    "INA_Q_all": ("Q", [40]),
}

# Catalogue B request defaults (fixed values).
DEFAULT_VARIABLE_IDS = [1, 2, 4, 31, 34, 39, 40, 85, 101]
DEFAULT_PROCEDURES = [1, 2]
DEFAULT_PERCENTILES = [0.05, 0.5, 0.95]
EXCLUDED_STATIONS = [2122, 2123, 2127, 2180, 2220, 2221, 2849, 2196]
TEST_STATION_MARK = "zprueba"
DEFAULT_STATION_FILTER = {
    "has_obs": True, "pais": "Argentina", "habilitar": True, "geom": "-68,-38,-53,-21",
}

# Harvest defaults (fixed values).
ACTIVITY_DAYS = 180
MAX_POINTS = 6000

# Constant texts of the output tables (fixed values).
SOURCE_A = "WHOS"
SOURCE_B = "INA"
CHILD_MARK_A = "WHO"
PARENT_PREFIX_B = "AR_INA_"
UNKNOWN = "Unknown"
GAUGE_VARIABLE = "Gage height"
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
MONTHLY_QUANTITIES = ["mean", "p01", "p10", "p50", "p90", "p99"]
RECORD_SCHEMA_LOCATION = (
    "http://def.wmo.int/wmdr/2017 http://schemas.wmo.int/wmdr/1.0RC9/wmdr.xsd"
)


def variable_codes(spark: SparkSession) -> DataFrame:
    """(variableName, code): a constant table of fixed size, hence safe to broadcast."""
    rows = list(VARIABLE_CODES.items())
    return F.broadcast(literal_table(spark, "variableName string, code string", rows))


def default_variables(spark: SparkSession) -> DataFrame:
    """The rows every variable dictionary starts with."""
    return literal_table(
        spark, "variableCode string, variableName string, unitName string", DEFAULT_VARIABLES
    )


def default_properties(spark: SparkSession) -> DataFrame:
    return literal_table(spark, "code string", [(c,) for c in DEFAULT_PROPERTIES])


def map_lookup(mapping: dict, key) -> "Column":  # noqa: F821
    """Value of ``key`` in a small constant dictionary, NULL when absent."""
    literals = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*literals), key)
