"""Per-site settings, blocked-page wording and modality keywords."""

# --- fixed values: site base URLs ---
SITE_BASE_URLS: dict[str, str] = {
    "computrabajo": "https://www.computrabajo.com.ar",
    "indeed": "https://ar.indeed.com",
    "portal_empleo": "https://portalempleo.gob.ar",
    "zonajobs": "https://www.zonajobs.com.ar",
    "getonboard": "https://www.getonbrd.com",
}

# --- fixed values: per-site listing page cap and the default for unknown sites ---
SITE_MAX_PAGES: dict[str, int] = {
    "computrabajo": 31,
    "indeed": 31,
    "portal_empleo": 31,
    "zonajobs": 31,
    "getonboard": 31,
}
DEFAULT_MAX_PAGES = 5

# --- fixed values: listing-URL templates ({base}, {slug}, {plus}, {loc}, {p}, {start}) ---
LISTING_TEMPLATES: dict[str, str] = {
    "getonboard": "{base}/empleos-{dash}",
    "zonajobs": "{base}/empleos-busqueda-{slug}.html?page={p}",
    "portal_empleo": "{base}/OfertasLaborales?Q={plus}?page-number={p}",
    "computrabajo": "{base}/trabajo-de-{dash}/?p={p}&q={loc}",
    "indeed": "{base}/jobs?q={plus}&l={loc}&start={start}",
}

# --- fixed values: listing-URL templates of the sites that list every posting ---
ALL_LISTING_TEMPLATES: dict[str, str] = {
    "getonboard": "{base}/empleos/",
    "zonajobs": "{base}/empleos.html?page={p}",
    "portal_empleo": "{base}/OfertasLaborales?page-number={p}",
}

# --- fixed values: phrases that mark a blocked page (matched case-insensitively) ---
BLOCK_PHRASES: list[str] = [
    "Solicitud bloqueada", "Te bloquearon", "Ray ID", "Cloudflare",
    "Blocked", "Access Denied", "captcha", "robot", "verificación de seguridad",
]

# --- fixed values: modality classifier, ordered (label, keywords); default label ---
MODALITY_RULES: list[tuple[str, list[str]]] = [
    ("Remoto", ["remoto"]),
    ("Híbrido", ["híbrido", "hybrid"]),
    ("Presencial", ["presencial"]),
]
MODALITY_DEFAULT = "Otros"

# --- fixed values: tag keywords used to pick job type and modality from tags ---
JOB_TYPE_TAG_WORDS: list[str] = ["jornada"]
MODALITY_TAG_WORDS: list[str] = ["presencial", "remoto", "híbrido"]

# --- fixed values: job-type enumerations ---
JOB_TYPE_HEADINGS: list[str] = ["Full time", "Part time", "Freelance"]
JOB_TYPE_AVAILABILITY: list[tuple[str, str]] = [
    ("tiempo completo", "Tiempo completo"),
    ("tiempo parcial", "Tiempo parcial"),
]

NEGOTIABLE_PHRASE = "a convenir"
NEGOTIABLE_LABEL = "A Convenir"
DEFAULT_CURRENCY = "$ARS"
