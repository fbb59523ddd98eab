"""Location rules for the region normaliser (X11) and the coordinates lookup."""

# --- fixed values: province keyword rules, first match wins (dict order) ---
PROVINCE_RULES: list[tuple[str, list[str]]] = [
    ("buenos aires", ["buenos aires", "caba", "bs as", "capital federal"]),
    ("cordoba", ["cordoba", "córdoba"]),
    ("santa fe", ["santa fe", "rosario"]),
    ("mendoza", ["mendoza"]),
    ("tucuman", ["tucuman", "tucumán"]),
    ("entre rios", ["entre rios", "entre ríos"]),
    ("salta", ["salta"]),
    ("misiones", ["misiones"]),
    ("chaco", ["chaco"]),
    ("corrientes", ["corrientes"]),
    ("san juan", ["san juan"]),
    ("san luis", ["san luis", "villa mercedes"]),
    ("la pampa", ["la pampa"]),
    ("neuquen", ["neuquen", "neuquén"]),
    ("rio negro", ["rio negro", "río negro"]),
    ("chubut", ["chubut"]),
    ("santa cruz", ["santa cruz"]),
    ("tierra del fuego", ["tierra del fuego"]),
    ("jujuy", ["jujuy"]),
    ("formosa", ["formosa"]),
    ("la rioja", ["la rioja"]),
    ("catamarca", ["catamarca"]),
    ("santiago del estero", ["santiago del estero"]),
]

# --- fixed values: province coordinates (lat, lon) ---
PROVINCE_COORDS: list[tuple[str, float, float]] = [
    ("buenos aires", -34.61, -58.38),
    ("cordoba", -31.42, -64.18),
    ("santa fe", -31.63, -60.70),
    ("mendoza", -32.89, -68.84),
    ("tucuman", -26.83, -65.22),
    ("entre rios", -31.73, -60.53),
    ("salta", -24.79, -65.41),
    ("misiones", -27.36, -55.90),
    ("chaco", -27.45, -58.99),
    ("corrientes", -27.48, -58.83),
    ("san juan", -31.54, -68.52),
    ("san luis", -33.30, -66.34),
    ("la pampa", -36.62, -64.29),
    ("neuquen", -38.95, -68.06),
    ("rio negro", -40.81, -63.00),
    ("chubut", -43.30, -65.10),
    ("santa cruz", -51.62, -69.22),
    ("tierra del fuego", -54.80, -68.30),
    ("jujuy", -24.19, -65.30),
    ("formosa", -26.18, -58.18),
    ("la rioja", -29.41, -66.85),
    ("catamarca", -28.47, -65.78),
    ("santiago del estero", -27.78, -64.26),
]

# --- fixed values: words that mark a remote location ---
REMOTE_WORDS: list[str] = ["remote", "remoto", "home office"]

# --- fixed values: characters kept by the location noise filter ---
NOISE_KEEP_CLASS = "a-záéíóúñ"
