"""Fixed values that results and stored data depend on."""

# State codes, tags and reasons as stored in the data.
TAG_PRODUCTIVE = "termelő"
TAG_NON_PRODUCTIVE = "nem termelő"
TAG_STOPPED = "nem termelő és áll"
STATE_IDLE = "IDLE"
STATE_FAILURE = "FAILURE"
REASON_WAITING = "simple_waiting"
RESULT_GOOD = "good"
RESULT_SCRAP = "scrap"

# The state mapping rows (code, name, tag, OEE loss type).
STATE_MAPPING_ROWS = [
    ("RUN", "Running", "termelő", None),
    ("IDLE", "Idle", "nem termelő", None),
    ("MICRO_STOP", "Micro-stop", "nem termelő", "Performance"),
    ("FAILURE", "Failure", "nem termelő és áll", "Availability"),
]

# Accepted spellings of booleans in CSV input.
TRUE_WORDS = ["true", "1", "yes", "y"]
FALSE_WORDS = ["false", "0", "no", "n"]

# Regression settings.
AGGREGATION_HOURS = 4
MIN_GOOD_PARTS = 2
MIN_OBSERVATIONS = 10
SIGNIFICANCE_LEVEL = 0.05
PRIMARY_TARGET = "system_energy_per_good_part_kwh"
SECONDARY_TARGET = "cycle_energy_per_good_part_kwh"
TARGETS = [PRIMARY_TARGET, SECONDARY_TARGET]
FEATURES = ["availability", "performance", "quality"]
LOG_OLS = "log_ols"
GAMMA_GLM = "gamma_glm"
NORMAL_975 = 1.959963984540054

# Tolerance of the energy component check.
KPI_TOLERANCE = "0.000001"

# Direction words.
DECREASES = "csökkenti"
INCREASES = "növeli"
UNCHANGED = "nem változtatja"

# Labels shown on dashboards.
FEATURE_LABELS = {
    "availability": "rendelkezésre állás",
    "performance": "teljesítmény",
    "quality": "minőség",
}
TARGET_LABELS = {
    PRIMARY_TARGET: "Teljes rendszerenergia / jó darab",
    SECONDARY_TARGET: "Ciklusenergia / jó darab",
}
MODEL_LABELS = {GAMMA_GLM: "Gamma GLM", LOG_OLS: "log-OLS"}
STATE_LABELS = {
    "RUN": "Termelés",
    "IDLE": "Várakozás",
    "MICRO_STOP": "Mikroleállás",
    "FAILURE": "Hiba",
}
SCOPE_TARGETS = {"primary": PRIMARY_TARGET, "secondary": SECONDARY_TARGET}
SCOPE_ORDER = {"primary": 1, "secondary": 2}
EXPLANATION_PANEL_LABELS = {
    "primary": "Teljes rendszerenergia / jó darab (Gamma GLM)",
    "secondary": "Ciklusenergia / jó darab (Gamma GLM)",
}
SENSITIVITY_PANEL_LABELS = {
    "primary": "Teljes rendszerenergia / jó darab",
    "secondary": "Ciklusenergia / jó darab",
}

EXPLANATION_RULE_FEATURES = {
    "primary": ["quality", "availability"],
    "secondary": ["performance"],
}

# Sentences of the published report rows, whole, with places for names and figures.
EXPLANATION_RULE = {
    "primary": (
        "A teljes rendszerenergia / jó darab mutató esetében a minőség és a rendelkezésre állás a legfontosabb tényezők. "
        "Ha ezek javulnak, az energiaintenzitás csökkenhet."
    ),
    "secondary": (
        "A ciklusenergia / jó darab mutató esetében a teljesítmény a legfontosabb tényező. "
        "Ha javul, az energiaintenzitás csökkenhet."
    ),
}
EXPLANATION_ONE = {
    "primary": (
        "A teljes rendszerenergia / jó darab mutató esetében a %s a legfontosabb tényező. "
        "Ha javul, az energiaintenzitás csökkenhet."
    ),
    "secondary": (
        "A ciklusenergia / jó darab mutató esetében a %s a legfontosabb tényező. "
        "Ha javul, az energiaintenzitás csökkenhet."
    ),
}
EXPLANATION_MANY = {
    "primary": (
        "A teljes rendszerenergia / jó darab mutató esetében a %s a legfontosabb tényezők. "
        "Ha ezek javulnak, az energiaintenzitás csökkenhet."
    ),
    "secondary": (
        "A ciklusenergia / jó darab mutató esetében a %s a legfontosabb tényezők. "
        "Ha ezek javulnak, az energiaintenzitás csökkenhet."
    ),
}
EXPLANATION_NONE = {
    "primary": (
        "A teljes rendszerenergia / jó darab mutató esetében a modell most nem mutatott egyértelműen kiemelhető tényezőt."
    ),
    "secondary": (
        "A ciklusenergia / jó darab mutató esetében a modell most nem mutatott egyértelműen kiemelhető tényezőt."
    ),
}
SENSITIVITY_NONE = (
    "A modell alapján most nem emelhető ki egyértelmű szenzitivitási megállapítás."
)
SENSITIVITY_PRIMARY = (
    "A főmodell alapján a %s javulása 1 százalékponttal várhatóan kb. %.2f%%-kal "
    "csökkentheti az egy jó darabra jutó teljes rendszerenergia-fogyasztást."
)
SENSITIVITY_SECONDARY = (
    "A ciklusalapú modell alapján a %s javulása 1 százalékponttal várhatóan kb. %.2f%%-kal "
    "csökkentheti az egy jó darabra jutó ciklusenergia-fogyasztást."
)
SENSITIVITY_OTHER = (
    "A modell alapján a %s javulása 1 százalékponttal várhatóan kb. %.2f%%-os "
    "kedvező változással járhat."
)
TECHNICAL_NOTE = (
    "Modell: %s. Megfigyelések száma: %s. Pseudo R²: %s. "
    "Szignifikáns tényezők: %s. Nem szignifikáns tényezők: %s."
)
NO_FEATURES = "nincs"
NOT_AVAILABLE = "n.a."
LIST_JOINER = " és "
