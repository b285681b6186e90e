"""Names, codes, texts and thresholds the results must carry unchanged."""

# Characteristics
TEMPERATURE = "Temperature, water"
DISSOLVED_OXYGEN = "Dissolved oxygen (DO)"
DO_SATURATION = "Dissolved oxygen saturation"
PH = "pH"

# Analytical method by characteristic
METHOD_BY_CHARACTERISTIC = {
    "Conductivity": "120.1",
    "Dissolved oxygen (DO)": "NFM 6.2.1-LUM",
    "Dissolved oxygen saturation": "NFM 6.2.1-LUM",
    "pH": "150.1",
    "Temperature, water": "170.1",
    "Turbidity": "180.1",
    "Total dissolved solids": "160.1",
}
UNKNOWN = "ERROR"

# Logger parameter -> (characteristic, unit)
LOGGER_PARAMETERS = {
    "Temp": ("Temperature, water", "deg C"),
    "DO_mgl": ("Dissolved oxygen (DO)", "mg/l"),
    "DO_Pct": ("Dissolved oxygen saturation", "% saturatn"),
}
LOGGER_FLAG_PATTERN = "<0>|<2>|<3>|<4>|<5>"
LOGGER_INSTRUMENTS = {
    "soschwq": "soschwq_010116-123119",
    "sosecwq": "sosecwq_010116-123119",
    "sosvawq": "sosvawq_010116-123119",
    "soswiwq": "soswiwq_010116-123119",
}

# Completeness of a day, in hours with valid data
COMPLETE_HOURS = 22
ESTIMATED_HOURS = 20
FINAL = "Final"
REJECTED = "Rejected"
GENERATED_COMMENT = "Generated by ORDEQ"

# Statistics
DAILY_MAX = "Daily Maximum"
DAILY_MIN = "Daily Minimum"
DAILY_MEAN = "Daily Mean"
MOVING_MIN_7 = "7DMADMin"
MOVING_MEAN_7 = "7DMADMean"
MOVING_MAX_7 = "7DMADMax"
MOVING_MEAN_30 = "30DMADMean"
SEVEN_DAY_STATISTICS = (MOVING_MIN_7, MOVING_MEAN_7, MOVING_MAX_7)

# Daily/moving column -> statistic name
STATISTIC_COLUMNS = {
    "dyMax": DAILY_MAX,
    "dyMin": DAILY_MIN,
    "dyMean": DAILY_MEAN,
    "ma_min7": MOVING_MIN_7,
    "ma_mean7": MOVING_MEAN_7,
    "ma_max7": MOVING_MAX_7,
    "ma_mean30": MOVING_MEAN_30,
}

# Statistic name here -> statistic name in the results store
STORE_STATISTIC = {
    "Daily Maximum": "Maximum",
    "Daily Mean": "Mean",
    "Daily Minimum": "Minimum",
    "7DMADMax": "7DADM",
    "7DMADMean": "7DADMean",
    "7DMADMin": "7DADMin",
    "30DMADMean": "30DADMean",
}

# Daily-value service: parameter and statistic codes, dropped qualifiers, site types
DAILY_VALUE_COLUMNS = {
    "00010": {"00001": "Wtemp_Max", "00003": "Wtemp", "00002": "Wtemp_Min"},
    "00300": {"00001": "DO_Max", "00003": "DO", "00002": "DO_Min"},
}
DROPPED_QUALIFIERS = ("P Eqp", "P Dis", "P Ssn", "A e", "P e")
EXCLUDED_SITE_TYPES = ("GW", "FA-OF")
SITE_TYPE_NAMES = {
    "ST": "River/Stream",
    "LK": "Lake",
    "ST-CA": "Canal Transport",
    "GW": "Well",
    "WE": "Wetland",
    "AT": "Atmosphere",
}

# City portal: grade 100 is good; approval 1200 is approved, 900 is working
GOOD_GRADE = 100
APPROVED_LEVEL = 1200
WORKING_LEVEL = 900
PORTAL_UNITS = {
    "Dissolved oxygen.Field Visits": "mg/l",
    "Dissolved oxygen.Primary": "mg/l",
    "Dissolved oxygen saturation.Field Visits": "%",
    "Dissolved oxygen saturation.Primary": "%",
    "pH.Field Visits": "pH",
    "pH.Primary": "pH",
    "Specific conductance.Field Visits": "uS/cm",
    "Specific conductance.Primary": "uS/cm",
    "Temperature.Field Visits": "degC",
    "Temperature.Primary": "degC",
    "Temperature.7DADM": "degC",
    "Temperature.Monthly Max": None,
}
PORTAL_INVENTORY_CHARACTERISTICS = (
    "Dissolved oxygen.Primary",
    "pH.Primary",
    "Temperature.Primary",
    "Temperature.7DADM",
)
JSON_PORTAL_ZONE = "America/Los_Angeles"
JSON_PORTAL_PREFIX = "PDX_BES-"
JSON_PORTAL_ALIASES = {
    "PDX_BES-FC-8": "PDX_BES-FC8",
    "PDX_BES-JC1": "PDX_BES-JC-1",
    "PDX_BES-TC-4": "PDX_BES-TC4",
    "PDX_BES-TC-5": "PDX_BES-TC5",
    "PDX_BES-TC-6": "PDX_BES-TC6",
}
JSON_PORTAL_PROJECT = "Integrated Report - Call for Data"
# Labels of the data sets that are asked for, by parameter
JSON_PORTAL_LABELS = {"Temperature": "7DADM", "Dissolved oxygen": "Primary", "pH": "Primary"}
LOOK_BACK_DAYS = 30

# State hydrology service: data sets and value columns
HYDROLOGY_FLOW_SETS = ("MDF", "Instantaneous_Stage", "Instantaneous_Flow", "Measurements")
HYDROLOGY_TEMPERATURE_SETS = ("WTEMP15", "WTEMP_MEASURE", "WTEMP_MEAN", "WTEMP_MAX", "WTEMP_MIN")
HYDROLOGY_VALUE_COLUMNS = (
    "mean_daily_flow_cfs",
    "instananteous_stage_ft",
    "instananteous_flow_cfs",
    "measured_stage_ft",
    "temperature_measurement_C",
    "instantaneous_water_temp_C",
    "daily_mean_water_temp_C",
    "daily_max_water_temp_C",
    "daily_min_water_temp_C",
    "temperature_measurement_F",
    "instantaneous_water_temp_F",
    "daily_mean_water_temp_F",
    "daily_max_water_temp_F",
    "daily_min_water_temp_F",
    "daily_max_water_temp_CÂ",
)
DAILY_MAX_CELSIUS = ("daily_max_water_temp_C", "daily_max_water_temp_CÂ")
PUBLISHED = "PUB"

# Alternate project of the one submitter that leaves the project sheet out
SALEM_PROJECT = "CoSContinuousWQ"

# Rows that trigger the next output file
SPLIT_SIZE = 100_000
