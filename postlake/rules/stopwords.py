"""Spanish stopwords removed from title tokens."""

# --- fixed values: stopword list, multi-word entries included as given ---
STOPWORDS_ES: list[str] = [
    # prepositions
    "a", "ante", "bajo", "cabe", "con", "contra", "de", "desde", "durante", "en", "entre",
    "hacia", "hasta", "mediante", "para", "por", "según", "sin", "so", "sobre", "tras",
    # connectors
    "y", "e", "ni", "o", "u", "pero", "mas", "aunque", "sino", "que", "como", "porque",
    "pues", "entonces", "luego", "ya", "ya que", "dado", "dado que", "mientras", "cuando",
    "donde", "si", "siempre", "siempre que", "a fin", "a fin de", "con el objeto de",
    # articles / determiners
    "el", "la", "los", "las", "un", "una", "unos", "unas", "este", "esta", "estos", "estas",
    "ese", "esa", "esos", "esas", "aquel", "aquella", "aquellos", "aquellas",
    # pronouns
    "yo", "tú", "él", "ella", "nosotros", "ustedes", "ellos", "quien", "quienes", "cuyo", "cuya",
    # frequent adverbs
    "muy", "más", "menos", "también", "solo", "incluso", "además", "apenas",
]
